"""SQL of the duplicate queries, for DuckDB: normal texts by its own functions, then plain joins over all word triples.

DuckDB has no NFKC; what NFKC changes in ordinary text is spelled out: full-width signs, dots, and fixed spaces.
"""

from __future__ import annotations

WIDE = "".join(map(chr, range(0xFF01, 0xFF5F))) + "　 "
PLAIN = "".join(map(chr, range(0x21, 0x7F))) + "  "


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_FLAT = f"lower(regexp_replace(nfc_normalize(translate(replace(text, chr(8230), '...'), {_quoted(WIDE)}, {_quoted(PLAIN)})), '\\p{{Cf}}', '', 'g'))"
_LETTERS = "regexp_replace({0}, '[^\\p{{L}}\\p{{N}}]', '', 'g')"


def _form(mark: str) -> str:
    """Sorted canonical fields of a text cut at a mark, null where it isn't a form."""
    parts = f"list_filter(string_split(n, {mark}), lambda x: trim(x, chr(10) || chr(13) || chr(9) || ' ') <> '')"
    field = _LETTERS.format("regexp_extract(x, '^([^:]*):', 1)") + " || '=' || " + _LETTERS.format("regexp_replace(x, '^[^:]*:', '')")
    good = f"regexp_matches(x, '^[^:]{{1,80}}:') and {_LETTERS.format(chr(40) + 'regexp_extract(x, ' + chr(39) + '^([^:]*):' + chr(39) + ', 1)' + chr(41))} <> ''"
    return f"case when len({parts}) >= 4 and len(list_filter({parts}, lambda x: {good})) = len({parts}) then array_to_string(list_sort(list_transform({parts}, lambda x: {field})), '|') end"


_OBJECT = "trim(text, chr(65279) || chr(8203) || chr(10) || chr(13) || ' ')"
_KEY, _VALUE = (_LETTERS.format(_FLAT.replace("replace(text,", f"replace({x},", 1)) for x in ("key", "value"))
#: The fields of texts that are JSON objects.
_JSON = (
    f"o as (select row_id, case when regexp_matches({_OBJECT}, '(?s)^[{{].*[}}]$') and json_valid({_OBJECT}) then {_OBJECT} else '{{}}' end as g from a), "
    "jk as (select row_id, g, unnest(json_keys(g)) as key from o), jv as (select row_id, key, json_extract_string(g, '$.\"' || key || '\"') as value from jk), "
    f"jf as (select row_id, {_KEY} || '=' || {_VALUE} as f from jv), js as (select row_id, case when count(*) >= 4 then string_agg(f, '|' order by f) end as form from jf group by 1)"
)

#: keyed(row_id, split, n, k): normal text and class of each record with a letter or digit.
KEYED = (
    f"a as (select row_id, split, text, {_FLAT} as n from merged_dataset where text is not null), {_JSON}, b as (select *, {_LETTERS.format('n')} as letters from a), "
    f"f as (select b.row_id, split, n, letters, coalesce(js.form, {_form('chr(10)')}, {_form(chr(39) + '|' + chr(39))}, {_form(chr(39) + ';' + chr(39))}) as form from b left join js using (row_id) where letters <> ''), "
    "names as (select letters, min(form) as form from f where form is not null group by 1), keyed as materialized (select f.row_id, f.split, f.n, coalesce(names.form, f.letters) as k from f left join names using (letters))"
)
#: near(a, b): rows of 80 words or more whose distinct triples agree by half, a < b, of different classes.
NEAR = (
    "w as (select row_id, k, regexp_extract_all(n, '[\\p{L}\\p{N}]+') as ws from keyed), t as materialized (select row_id, k, unnest(list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) as tri from w where len(ws) >= 80), "
    "size as (select row_id, any_value(k) as k, count(*) as n from t group by 1), common as (select x.row_id as a, y.row_id as b, count(*) as c from t x join t y on x.tri = y.tri and x.row_id < y.row_id group by 1, 2), "
    "near as (select a, b from common join size p on p.row_id = a join size q on q.row_id = b where p.k <> q.k and 2 * c >= p.n + q.n - c)"
)
_ROLE = "case when lower(trim(regexp_replace({0}, '\\[.*', ''))) in ('train', 'training') then 't' when lower(trim(regexp_replace({0}, '\\[.*', ''))) in ('test', 'validation', 'valid', 'val', 'dev', 'eval', 'evaluation') then 'e' end"

P3_FOUND = f"with {KEYED}, {NEAR} select a as row_id_a, b as row_id_b from near"
P4_FOUND = (
    f"with {KEYED}, {NEAR}, r as (select row_id, k, {_ROLE.format('split')} as role from keyed), same as (select x.row_id as a, y.row_id as b from r x join r y on x.k = y.k and x.row_id < y.row_id) "
    "select p.a as row_id_a, p.b as row_id_b from (select a, b from near union select a, b from same) p join r x on x.row_id = p.a join r y on y.row_id = p.b where x.role <> y.role"
)
P6_FOUND = f"with {KEYED}, g as (select k, min(row_id) as kept_row_id from keyed group by 1) select kept_row_id, row_id from keyed join g using (k) where row_id <> kept_row_id"
P6_COLLAPSED = f"with {KEYED} select min(row_id) as row_id, count(*) as copies from keyed group by k"
P3_CLASSES = (
    f"with recursive {KEYED}, {NEAR}, long as (select row_id, k from w where len(ws) >= 80), c as (select k, min(row_id) as least, count(*) as copies from long group by 1), "
    "e as (select distinct p.k as x, q.k as y from near join long p on p.row_id = a join long q on q.row_id = b), l as (select x, y from e union select y, x from e), "
    "reach as (select k as x, k as y from c union select reach.x, l.y from reach join l on l.x = reach.y), m as (select reach.x as k, min(c.least) as class_id from reach join c on c.k = reach.y group by 1) "
    "select row_id, class_id, copies from long join c using (k) join m using (k)"
)

ORACLES = {"p3_found": P3_FOUND, "p3_classes": P3_CLASSES, "p4_found": P4_FOUND, "p6_found": P6_FOUND, "p6_collapsed": P6_COLLAPSED}
