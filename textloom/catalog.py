"""Registry of the core queries and their SQL.

Each query runs its operator over whole tables. The SQL is for DuckDB on the same Parquet files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions import urls as U
from textloom.operators import active, annotate, checks, discovery, eda, merge, neardup, planning, profile, quality, repair, schema
from textloom.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a query and, where SQL can express it, its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.replace("@WS", r"[\s\x0b\x1c-\x1f\x85\p{Z}]")
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL


STRIP = "regexp_replace({0}, '^@WS+|@WS+$', '', 'g')"


def _strip(c: str) -> str:
    return STRIP.format(c)


def _missing(c: str) -> str:
    return f"({c} is null or {_strip(c)} = '')"


def _norm(c: str) -> str:
    return f"nullif(regexp_replace(lower({_strip(f'coalesce({c}, chr(32))')}), '@WS+', ' ', 'g'), '')"


# ---- profiles

PROFILED = ["text", "target_text", "title", "body", "label", "source", "source_type", "source_url", "metadata", "record_hash", "split"]


@query(
    "with f as (select " + ", ".join(f"{_missing(c)} as {c}" for c in PROFILED) + " from merged_dataset), "
    "a as (select count(*) as total, " + ", ".join(f"count(*) filter (where {c}) as n_{c}" for c in PROFILED) + ", count(*) filter (where " + " or ".join(PROFILED) + ") as n_any from f), "
    "l as (" + " union all ".join([f"select '{c}' as column_name, n_{c} as missing, total from a" for c in PROFILED] + ["select '*', n_any, total from a"]) + ") "
    "select column_name, missing, case when total = 0 then 0.0 else round(100.0::double * missing / total, 4) end as percent from l"
)
def missing_profile(spark, d):
    return profile.missing_profile(_t(spark, d, "merged_dataset"), PROFILED)


@query(
    "with k as (select 'text' as kind, count(*) as n from merged_dataset group by text union all select 'text_source', count(*) from merged_dataset group by text, source "
    f"union all select 'normalized_text', count(*) from (select {_norm('text')} as k from merged_dataset) group by k) "
    "select kind, (sum(n) - count(*))::bigint as duplicates, round(100.0::double * (sum(n) - count(*)) / sum(n), 4) as percent from k group by kind"
)
def duplicate_counts(spark, d):
    df = _t(spark, d, "merged_dataset")
    return profile.duplicate_counts(df, {"text": [F.col("text")], "text_source": [F.col("text"), F.col("source")], "normalized_text": [T.normal_key("text")]})


def _outlier_sql(table: str, cols: list[str]) -> str:
    s = f"with s as (select " + ", ".join(f"quantile_cont({c}, 0.25) as a{i}, quantile_cont({c}, 0.75) as b{i}, avg({c}) as m{i}, stddev_pop({c}) as s{i}" for i, c in enumerate(cols)) + f" from {table}), "
    s += "f as (select " + ", ".join(f"coalesce({c} < a{i} - 1.5 * (b{i} - a{i}) or {c} > b{i} + 1.5 * (b{i} - a{i}), false) as o{i}, coalesce({c} < m{i} - 3 * s{i} or {c} > m{i} + 3 * s{i}, false) as z{i}" for i, c in enumerate(cols)) + f" from {table}, s) "
    parts = [f"select '{c}' as feature, (select count(*) from f where o{i}) as iqr_rows, (select count(*) from f where z{i}) as z_rows, round(a{i} - 1.5 * (b{i} - a{i}), 4) as low, round(b{i} + 1.5 * (b{i} - a{i}), 4) as high from s" for i, c in enumerate(cols)]
    parts.append("select '*', (select count(*) from f where " + " or ".join(f"o{i}" for i in range(len(cols))) + "), (select count(*) from f where " + " or ".join(f"z{i}" for i in range(len(cols))) + "), null, null from s")
    return s + " union all ".join(parts)


@query(_outlier_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def outliers_lineitem(spark, d):
    return profile.outliers(_t(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query(_outlier_sql("events", ["value"]))
def outliers_events(spark, d):
    return profile.outliers(_t(spark, d, "events"), ["value"])


@query(f"with c as (select label, count(*) as n from merged_dataset where not {_missing('label')} group by 1) select label, n, round(n / sum(n) over (), 4) as share, round(max(n) over () / min(n) over (), 4) as ratio, round(max(n) over () / min(n) over (), 4) >= 3 as imbalanced from c")
def class_imbalance(spark, d):
    return profile.imbalance(_t(spark, d, "merged_dataset"), "label")


@query(
    "with s as (select 'source_id' as column_name, source_id as v from merged_dataset union all select 'id', id from merged_dataset union all select 'label', label from merged_dataset) "
    r"select column_name, count(v) as values, round(coalesce(avg(case when v is not null then case when regexp_matches(" + _strip("v") + r", '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$') then 1.0 else 0.0 end end), 0), 6)::double as ratio from s group by 1"
)
def numeric_parse_ratio(spark, d):
    return profile.parse_ratio(_t(spark, d, "merged_dataset"), ["source_id", "id", "label"])


TYPES = {"row_id": "bigint", "collected_at": "timestamp"}
MERGED = ["row_id", "id", "text", "target_text", "title", "body", "label", "source", "source_type", "source_url", "collected_at", "metadata", "audio", "image", "source_id", "record_hash", "split"]


def _kind_sql(c: str) -> str:
    if c in TYPES:
        return f"select '{c}' as column_name, '{'numeric' if TYPES[c] == 'bigint' else 'other'}' as kind"
    number = "regexp_matches(" + _strip(c) + r", '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$')"
    return (
        f"select '{c}' as column_name, case when coalesce(avg(case when {c} is not null then {number}::int end), 0) >= 0.8 then 'numeric' "
        f"when count(*) filter (where not {_missing(c)}) >= 0.1 * greatest(count(*), 1) and coalesce(avg(case when not {_missing(c)} then length({c}) end), 0) >= 2 then 'meaningful_text' else 'other' end as kind from merged_dataset"
    )


@query(" union all ".join(map(_kind_sql, MERGED)))
def infer_columns(spark, d):
    return profile.infer_columns(_t(spark, d, "merged_dataset"))


PII_SQL = {
    "email": r"(?i)[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}",
    "phone": r"(?:\+?\d{1,3}[\s.\-]?)?(?:\(?\d{2,4}\)?[\s.\-]?)?\d{3,4}[\s.\-]?\d{3,5}(?:$|[^\p{L}\p{N}_])",
    "handle": r"(?:^|[^A-Za-z0-9._%+\-])@[A-Za-z0-9_]{2,32}\b",
}


@query(
    "with s as (select coalesce(text, '') as t, " + _strip("coalesce(text, '')") + " as x from merged_dataset), "
    "a as (select count(*) filter (where x = '') as empty, count(*) filter (where x <> '' and length(x) < 15) as short, "
    + ", ".join(f"count(*) filter (where regexp_matches(t, '{p}')) as {k}_rows" for k, p in PII_SQL.items())
    + ", count(*) filter (where " + " or ".join(f"regexp_matches(t, '{p}')" for p in PII_SQL.values()) + ") as pii_rows, count(*) as rows from s) "
    "select unnest(['empty','short','email_rows','phone_rows','handle_rows','pii_rows','rows']) as metric, unnest([empty, short, email_rows, phone_rows, handle_rows, pii_rows, rows]) as n from a"
)
def text_quality(spark, d):
    return profile.text_quality(_t(spark, d, "merged_dataset"), "text")


@query(
    "select row_id, sha256(coalesce(regexp_replace(regexp_replace(regexp_replace(text, '" + PII_SQL["email"] + "', '[REDACTED_EMAIL]', 'g'), '" + PII_SQL["phone"].replace("(?:$|", "($|") + r"', '[REDACTED_PHONE]\1', 'g'), '(^|[^A-Za-z0-9._%+\-])@[A-Za-z0-9_]{2,32}\b', '\1[REDACTED_HANDLE]', 'g'), '')) as digest from merged_dataset"
)
def redact_patterns(spark, d):
    return _t(spark, d, "merged_dataset").select("row_id", F.sha2(F.coalesce(T.redact("text"), F.lit("")), 256).alias("digest"))


@query("select unnest(['text','label','audio','target_text']) as column_name, true as present, unnest([round(avg((text is null)::int), 6), round(avg((label is null)::int), 6), round(avg((audio is null)::int), 6), round(avg((target_text is null)::int), 6)]) as null_share from merged_dataset union all select 'language', false, null")
def null_shares(spark, d):
    return profile.null_shares(_t(spark, d, "merged_dataset"), ["text", "label", "audio", "target_text", "language"])


# ---- repairs


@query(f"select row_id, case when {_missing('text')} then null else text end as text, case when {_missing('label')} then null else label end as label from merged_dataset")
def fix_blank_to_null(spark, d):
    return repair.blank_to_null(_t(spark, d, "merged_dataset").select("row_id", "text", "label"))


@query(
    "with m as (select median(confidence) as med, avg(margin) as mean, (select auto_label from annotations where auto_label is not null group by 1 order by count(*) desc, 1 limit 1) as mode from annotations) "
    f"select annotation_id, row_id, round(coalesce(confidence, med), 6) as confidence, round(coalesce(margin, mean), 6) as margin, case when {_missing('auto_label')} then mode else auto_label end as auto_label, case when {_missing('review_reason')} then 'none' else review_reason end as review_reason from annotations, m where not {_missing('text')}"
)
def fix_impute(spark, d):
    df = _t(spark, d, "annotations").select("annotation_id", "row_id", "text", "confidence", "margin", "auto_label", "review_reason")
    out = repair.impute(df, {"confidence": "median", "margin": "mean", "auto_label": "mode", "review_reason": ("constant", "none"), "text": "drop_rows"})
    return out.select("annotation_id", "row_id", F.round("confidence", 6).alias("confidence"), F.round("margin", 6).alias("margin"), "auto_label", "review_reason")


@query("select min(row_id) as row_id from merged_dataset group by text")
def fix_dedupe_first(spark, d):
    return repair.dedupe(_t(spark, d, "merged_dataset").select("row_id", "text"), ["text"], "row_id").select("row_id")


@query(f"select max(row_id) as row_id from (select row_id, {_norm('text')} as k from merged_dataset) group by k")
def fix_dedupe_last_normalized(spark, d):
    return repair.dedupe(_t(spark, d, "merged_dataset").select("row_id", "text"), ["normalized_text"], "row_id", "last").select("row_id")


@query("with b as (select quantile_cont(value, 0.25) as a, quantile_cont(value, 0.75) as b from events) select event_id, round(case when value is null then null else greatest(least(value, round(b + 1.5 * (b - a), 4)), round(a - 1.5 * (b - a), 4)) end, 3) as value from events, b")
def fix_clip_iqr(spark, d):
    return repair.clip(_t(spark, d, "events").select("event_id", "value"), ["value"]).select("event_id", F.round("value", 3).alias("value"))


@query("with b as (select avg(value) as m, stddev_pop(value) as s from events) select event_id from events, b where not coalesce(value < m - 3 * s or value > m + 3 * s, false)")
def fix_remove_zscore(spark, d):
    return repair.remove_outliers(_t(spark, d, "events").select("event_id", "value"), ["value"], "zscore").select("event_id")


@query(f"with a as (select count(*) filter (where {_missing('text')}) as bt, count(*) filter (where {_missing('label')}) as bl, count(*) filter (where {_missing('text')} or {_missing('label')}) as ba from merged_dataset), "
       f"md as (select label as m from merged_dataset where not {_missing('label')} group by 1 order by count(*) desc, 1 limit 1), k as (select text, case when {_missing('label')} then (select m from md) else label end as label from merged_dataset where not {_missing('text')}), "
       f"c as (select count(*) filter (where {_missing('text')}) as x1, count(*) filter (where {_missing('label')}) as x2, count(*) filter (where {_missing('text')} or {_missing('label')}) as x3 from k) "
       "select unnest(['row_id','text','label','*']) as column_name, unnest([0, bt, bl, ba])::bigint as before, unnest([0, x1, x2, x3])::bigint as after, unnest([0, x1 - bt, x2 - bl, x3 - ba])::bigint as delta from a, c")
def fix_compare(spark, d):
    before = _t(spark, d, "merged_dataset").select("row_id", "text", "label")
    return repair.compare(before, repair.fix(before, {"missing": {"text": "drop_rows", "label": "mode"}}, "row_id"))


@query(f"select row_id, 'removed' as action from merged_dataset where {_missing('text')} union all select row_id, 'changed' from merged_dataset where not {_missing('text')} and {_missing('label')}")
def fix_audit(spark, d):
    before = _t(spark, d, "merged_dataset").select("row_id", "text", "label")
    return repair.audit(before, repair.fix(before, {"missing": {"text": "drop_rows", "label": "mode"}}, "row_id"), "row_id")


@query("select row_id, row_number() over (order by row_id) - 1 as row_no from merged_dataset")
def dense_row_ids(spark, d):
    return repair.with_row_ids(_t(spark, d, "merged_dataset").select("row_id"), ["row_id"])


# ---- the quality stage


def _metrics_sql(t: str, cols: list[str], texts: list[str], key: str, least: int = 15) -> str:
    """The 16 metrics of a table of row_id and strings, as (metric, v); near-duplicates and languages are off."""
    some = " or ".join(_missing(c) for c in cols)
    n = {c: f"length({_strip(f'coalesce({c}, chr(32))')})" for c in texts}
    blank = "(" + " or ".join(f"{n[c]} = 0" for c in texts) + ")"
    short = "(" + " or ".join(f"{n[c]} between 1 and {least - 1}" for c in texts) + ")"
    pii = "(" + " or ".join(f"regexp_matches(coalesce({c}, ''), '{p}')" for c in texts for p in PII_SQL.values()) + ")"
    words = lambda c: f"case when {_strip(f'coalesce({c}, chr(32))')} = '' then 0 else len(regexp_split_to_array({_strip(c)}, '@WS+')) end"
    feats = ["row_id::double"] + [f"length(coalesce({c}, ''))::double" for c in texts] + [f"({words(c)})::double" for c in texts]
    f = f"(select " + ", ".join(f"{x} as f{i}" for i, x in enumerate(feats)) + f" from {t})"
    stats = "(select " + ", ".join(f"quantile_cont(f{i}, 0.25) as a{i}, quantile_cont(f{i}, 0.75) as b{i}, avg(f{i}) as m{i}, stddev_pop(f{i}) as s{i}" for i in range(len(feats))) + f" from {f})"
    iqr = " or ".join(f"f{i} < a{i} - 1.5 * (b{i} - a{i}) or f{i} > b{i} + 1.5 * (b{i} - a{i})" for i in range(len(feats)))
    z = " or ".join(f"s{i} > 0 and (f{i} < m{i} - 3 * s{i} or f{i} > m{i} + 3 * s{i})" for i in range(len(feats)))
    extra = lambda k: f"(select count(*) - count(distinct coalesce('v' || {k}, 'n')) from {t})"
    whole = "concat_ws(chr(31), " + ", ".join(f"coalesce('v' || {c}, 'n')" for c in cols) + ")"
    count = lambda where: f"(select count(*) from {t} where {where})"
    values = {
        "rows": count("true"), "total_missing_cells": "(select coalesce(sum(" + " + ".join(f"({_missing(c)})::int" for c in cols) + f"), 0) from {t})", "rows_with_any_missing": count(some),
        "full_duplicates": extra(whole), "subset_duplicates": extra("row_id"), "normalized_text_duplicates": extra(_norm(key)), "outlier_rows_any_iqr": f"(select count(*) from {f}, {stats} where {iqr})",
        "outlier_rows_any_zscore": f"(select count(*) from {f}, {stats} where {z})", "class_max_min_ratio": f"(select round(max(c) / min(c), 4) from (select count(*) as c from {t} where not {_missing('label')} group by label))",
        "text_empty_or_short_rows": count(f"{blank} or {short}"), "text_any_blank_rows": count(blank), "text_any_short_rows": count(short), "text_pii_rows_flagged": count(pii),
        "text_near_duplicate_rows_flagged": "0", "text_language_mismatch_rows": "0", "text_exact_duplicate_rows_droppable": extra("text"),
    }
    return " union all ".join(f"select '{k}' as metric, ({v})::double as v" for k, v in values.items())


QUALITY_COLUMNS = ["text", "label"]
QUALITY_CONFIG = {"critical_text_columns": ["text"], "normalized_text_columns": ["text"]}
QUALITY_PLAN = {
    "missing": {"per_column": {"text": "drop_rows"}, "default_categorical": "mode"},
    "duplicates": {"action": "drop", "subset": ["normalized_text"]},
    "outliers": {"default": {"strategy": "remove_iqr"}, "columns": ["char_len::text"]},
    "redact_basic_pii": True,
}
_REDACTED = "regexp_replace(regexp_replace(regexp_replace(text, '" + PII_SQL["email"] + "', '[REDACTED_EMAIL]', 'g'), '" + PII_SQL["phone"].replace("(?:$|", "($|") + r"', '[REDACTED_PHONE]\1', 'g'), '(^|[^A-Za-z0-9._%+\-])@[A-Za-z0-9_]{2,32}\b', '\1[REDACTED_HANDLE]', 'g')"
QUALITY_SQL = (
    f"b as (select row_id, text, label from merged_dataset), n as (select row_id, case when {_missing('text')} then null else text end as text, case when {_missing('label')} then null else label end as label from b), "
    "md as (select label as m from n where label is not null group by 1 order by count(*) desc, 1 limit 1), i as (select row_id, text, coalesce(label, m) as label from n, md where text is not null), "
    f"k as (select min(row_id) as row_id from i group by {_norm('text')}), d as (select i.* from i join k using (row_id)), "
    "q as (select quantile_cont(length(text)::double, 0.25) as qa, quantile_cont(length(text)::double, 0.75) as qb from d), o as (select d.* from d, q where length(text) between qa - 1.5 * (qb - qa) and qb + 1.5 * (qb - qa)), "
    f"x as (select row_id, {_REDACTED} as text, label from o)"
)


@query(
    f"with {QUALITY_SQL}, mb as ({_metrics_sql('b', QUALITY_COLUMNS, ['text'], 'text')}), mx as ({_metrics_sql('x', QUALITY_COLUMNS, ['text'], 'text')}) "
    "select metric, mb.v as before, mx.v as after, round(mx.v - mb.v, 4) as delta from mb join mx using (metric)"
)
def quality_compare(spark, d):
    q = quality.Quality(QUALITY_CONFIG)
    before = _t(spark, d, "merged_dataset").select("row_id", "text", "label")
    # the label's lengths are left out by naming the text alone
    q.policy.derived = lambda cols: ["char_len::text", "word_len::text"]
    return q.compare(before, q.fix(before, QUALITY_PLAN)[0])


@query(f"with {QUALITY_SQL} select row_id, sha256(text) as digest, label from x")
def quality_fixed(spark, d):
    q = quality.Quality(QUALITY_CONFIG)
    out, _ = q.fix(_t(spark, d, "merged_dataset").select("row_id", "text", "label"), QUALITY_PLAN)
    return out.select("row_id", F.sha2("text", 256).alias("digest"), "label")


@query(
    f"with {QUALITY_SQL} select 'changed' as action, 'blank_text' as issue_type, 'text' as target, count(*) as n from b where text is not null and {_missing('text')} union all select 'changed', 'blank_text', 'label', count(*) from b where label is not null and {_missing('label')} "
    "union all select 'removed', 'missing', 'text', count(*) from n where text is null union all select 'changed', 'missing', 'label', count(*) from n where label is null union all select 'removed', 'duplicates', 'normalized_text', (select count(*) from i) - (select count(*) from d) "
    "union all select 'removed', 'outliers', 'char_len::text', (select count(*) from d) - (select count(*) from o) union all select 'changed', 'pii', 'text', count(*) from o where " + " or ".join(f"regexp_matches(text, '{p}')" for p in PII_SQL.values())
)
def quality_audit(spark, d):
    q = quality.Quality(QUALITY_CONFIG)
    _, actions = q.fix(_t(spark, d, "merged_dataset").select("row_id", "text", "label"), QUALITY_PLAN)
    counts = actions.groupBy("action", "issue_type", "target").agg(F.count(F.lit(1)).alias("n"))
    every = [("changed", "blank_text", "text"), ("changed", "blank_text", "label"), ("removed", "missing", "text"), ("changed", "missing", "label"), ("removed", "duplicates", "normalized_text"), ("removed", "outliers", "char_len::text"), ("changed", "pii", "text")]
    keys = spark.createDataFrame(every, "action string, issue_type string, target string")
    return keys.join(counts, ["action", "issue_type", "target"], "left").fillna(0, ["n"])


def _lengths_sql(c: str, table: str) -> str:
    words = f"case when {_strip(f'coalesce({c}, chr(32))')} = '' then 0 else len(regexp_split_to_array({_strip(c)}, '@WS+')) end"
    body = _outlier_sql("features", ["chars", "words"]).replace("'chars' as feature", f"'char_len::{c}' as feature").replace("'words' as feature", f"'word_len::{c}' as feature")
    return f"with features as (select length(coalesce({c}, ''))::double as chars, ({words})::double as words from {table}), " + body.removeprefix("with ")


@query(_lengths_sql("text", "merged_dataset"))
def outliers_lengths(spark, d):
    names = ["char_len::text", "word_len::text"]
    f = quality.number_features(_t(spark, d, "merged_dataset").select("text"), names)
    got = profile.outliers(f.select(*[F.col(f"__f{i}").alias(f"f{i}") for i in range(2)]), ["f0", "f1"])
    return got.withColumn("feature", F.coalesce(F.try_element_at(F.create_map(F.lit("f0"), F.lit(names[0]), F.lit("f1"), F.lit(names[1])), F.col("feature")), F.col("feature")))


@query(f"select row_id, try_cast(case when regexp_matches({_strip('row_id::varchar')}, '^[+-]?[0-9]+$') then {_strip('row_id::varchar')} end as double) as number, case when len(map_keys(class_scores)) > 0 then len(map_keys(class_scores)) end as classes from annotations")
def prepared_cells(spark, d):
    a = _t(spark, d, "annotations").select("annotation_id", F.col("row_id").cast("string").alias("row_text"), "class_scores", "row_id")
    out = quality.Quality(order="annotation_id").prepare(a)
    return out.select("row_id", F.col("row_text").alias("number"), F.size(F.from_json("class_scores", "map<string,double>")).alias("classes"))


# ---- schema and merge


@query(f"select row_id, sha256(coalesce(case when {_missing('text')} then nullif(concat_ws(chr(10) || chr(10), nullif({_strip('title')}, ''), nullif({_strip('body')}, '')), '') else text end, '')) as digest from merged_dataset")
def title_body_fill(spark, d):
    return schema.fill_from_title_body(_t(spark, d, "merged_dataset")).select("row_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))


@query("select row_id, sha256(concat_ws(chr(31), " + ", ".join(f"'{c}=' || coalesce({c}, '')" for c in ("text", "target_text", "title", "body", "label", "audio", "image")) + ")) as record_hash from merged_dataset")
def record_hashes(spark, d):
    return schema.record_hash(_t(spark, d, "merged_dataset")).select("row_id", "record_hash")


@query("with h as (select row_id, case when source_type in ('api','scrape') then 'x' end as z, sha256(concat_ws(chr(31), " + ", ".join(f"'{c}=' || coalesce({c}, '')" for c in ("text", "title", "label")) + ")) as h from merged_dataset) select min(row_id) as row_id from h group by h")
def merge_sources(spark, d):
    df = _t(spark, d, "merged_dataset")
    df = schema.record_hash(df, ("text", "title", "label"))
    web = F.coalesce(F.col("source_type").isin("api", "scrape"), F.lit(False))
    parts = [df.where(web).drop("audio"), df.where(~web).drop("image")]
    return merge.keep_first(merge.union_all(parts), "row_id").select("row_id")


@query(
    "with c as (select coalesce(source_type, '__na__') as k, count(*) as n from merged_dataset group by 1), t as (select sum(n) as total, least(500, sum(n)) as most from c), "
    "r as (select k, n, most * n / total::double as raw, floor(most * n / total::double) as base, most from c, t), "
    "o as (select k, base, most, sum(base) over () as given, row_number() over (order by raw - base desc, n desc, k) as p from r) "
    "select k as stratum, (base + case when p <= most - given then 1 else 0 end)::bigint as n from o"
)
def stratified_cap(spark, d):
    capped = merge.stratified_cap(_t(spark, d, "merged_dataset"), 500, "source_type", "row_id")
    return capped.groupBy(F.coalesce("source_type", F.lit("__na__")).alias("stratum")).agg(F.count(F.lit(1)).alias("n"))


def _remainder_sql(rows: str, out: str, units: str, by: str) -> str:
    """Shares of ``units`` among the rows (k, w, pos) of each ``by``: whole parts, then one each to the largest fractions, first come first."""
    return (
        f"{out}_r as (select *, {units} * w / sum(w) over (partition by {by}) as raw from {rows}), "
        f"{out}_o as (select *, floor(raw) as whole, row_number() over (partition by {by} order by raw - floor(raw) desc, pos) as turn from {out}_r), "
        f"{out} as (select *, (whole + case when turn <= {units} - sum(whole) over (partition by {by}) then 1 else 0 end)::bigint as units from {out}_o)"
    )


@query(
    "with s as (select id, coalesce(type, '') as stratum, case when coalesce(estimated_rows, 0) > 0 then estimated_rows::double else 1.0 end as w, row_number() over (order by id) as pos from sources), "
    "g as (select stratum, sum(w) as w, min(pos) as pos, 20000 - (select count(*) from s) as extra from s group by 1), " + _remainder_sql("g", "h", "extra", "extra") + ", "
    "i as (select s.id, s.stratum, s.w, s.pos, h.units as extra from s join h using (stratum)), " + _remainder_sql("i", "j", "extra", "stratum") + " select id as source_id, 1 + units as rows from j"
)
def row_budgets(spark, d):
    specs = [r.asDict() for r in _t(spark, d, "sources").select("id", "name", "type", "estimated_rows").orderBy("id").collect()]
    return spark.createDataFrame(list(merge.row_budgets(specs, 20_000, "source_type").items()), "source_id string, rows bigint")


@query(
    "select row_id, case when " + _missing("text") + " then 'instruction' else 'text' end as way, case when not " + _missing("text") + " then sha256(text) when not " + _missing("title") + f" then sha256({_strip('title')}) end as digest, "
    "case when " + _missing("text") + " and " + _missing("title") + " then 'empty_instruction' end as drop_reason from merged_dataset"
)
def route_instructions(spark, d):
    df = _t(spark, d, "merged_dataset").select("row_id", "text", F.col("title").alias("prompt"), F.col("body").alias("response"))
    routed = schema.route(df.withColumn("was", T.missing("text")))
    return routed.select("row_id", F.when(F.col("was"), "instruction").otherwise("text").alias("way"), F.sha2("text", 256).alias("digest"), "drop_reason")


@query(
    f"select row_id, case when {_missing('title')} then null else {_strip('title')} end as text, nullif({_strip('body')}, '') is not null as answered, case when {_missing('title')} then 'empty_user_content' end as drop_reason from merged_dataset"
)
def route_chats(spark, d):
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.coalesce(F.col(c), F.lit("")).alias("content"))
    df = _t(spark, d, "merged_dataset").select("row_id", F.to_json(F.array(turn("system", "source"), turn("user", "title"), turn("assistant", "body"))).alias("messages"), F.col("body"))
    out = schema.route(df)
    return out.select("row_id", "text", (F.col("target_text").isNotNull() | (F.col("drop_reason").isNotNull() & ~T.missing("body"))).alias("answered"), "drop_reason")


@query("select case when label is null then null when label = 'emergency_red_flag' then 'urgent' else label end as label, count(*) as n from merged_dataset group by 1")
def label_map(spark, d):
    mapped = schema.map_fields(_t(spark, d, "merged_dataset"), {"content": "text"}, {"emergency_red_flag": "urgent"})
    return mapped.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("select id, row_number() over (partition by id order by row_id) - 1 as repeats, row_id from merged_dataset")
def stable_keys(spark, d):
    out = merge.stable_keys(_t(spark, d, "merged_dataset").select("id", "row_id"), "id", "row_id")
    at = F.regexp_extract("stable_key", r"#(\d+)$", 1)
    return out.select("id", F.when(at == "", 0).otherwise(at.try_cast("int")).cast("bigint").alias("repeats"), "row_id")


@query(
    "select row_id, case when metadata is null or trim(metadata) = '' then '{}' when json_valid(metadata) then metadata else to_json({'raw': metadata})::varchar end as metadata from merged_dataset"
)
def metadata_objects(spark, d):
    return _t(spark, d, "merged_dataset").select("row_id", schema.metadata_json("metadata").alias("metadata"))


@query("select row_id, json_extract_string(metadata, '$.thread_id') as thread_id, try_cast(json_extract_string(metadata, '$.reply_count') as bigint) as replies from merged_dataset where metadata is not null and json_valid(metadata)")
def json_path_records(spark, d):
    from textloom.sources.json_records import explode_records

    return explode_records(_t(spark, d, "merged_dataset"), "metadata", None, {"thread_id": "string", "reply_count": "bigint"}, ["row_id"]).withColumnRenamed("reply_count", "replies")


# ---- URLs and files

URL_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


@query(
    f"with p as (select row_id, source_url as u, regexp_extract(coalesce(source_url, ''), '{URL_RE}', 1) as s, regexp_extract(coalesce(source_url, ''), '{URL_RE}', 2) as h, regexp_extract(coalesce(source_url, ''), '{URL_RE}', 3) as p, regexp_extract(coalesce(source_url, ''), '{URL_RE}', 4) as q from merged_dataset), "
    "k as (select *, array_to_string(list_sort(list_filter(string_split(regexp_replace(q, '^\\?', ''), '&'), lambda x: regexp_matches(x, '^[^=]+=.+'))), '&') as qs, list_filter(string_split(p, '/'), lambda x: x <> '') as segs from p) "
    "select row_id, case when coalesce(u, '') = '' then '' else lower(s) || '://' || lower(h) || regexp_replace(p, '/+$', '') || case when qs = '' then '' else '?' || qs end end as canonical, "
    "regexp_replace(regexp_replace(lower(h), ':\\d+$', ''), '^www\\.', '') as host, substr(segs[-1], 1, 128) as thread, "
    "case when lower(coalesce(u, '')) like '%.json' or contains(lower(coalesce(u, '')), '/api/') or contains(lower(coalesce(u, '')), 'format=json') or contains(lower(coalesce(u, '')), '/v1/') or contains(lower(coalesce(u, '')), '/v2/') then 'api_json' "
    "when contains(lower(coalesce(u, '')), 'rss') or lower(coalesce(u, '')) like '%.xml' or contains(lower(coalesce(u, '')), '/feed') then 'feed' else 'html_page' end as kind from k"
)
def url_parts(spark, d):
    return _t(spark, d, "merged_dataset").select("row_id", U.canonical("source_url").alias("canonical"), U.host("source_url").alias("host"), U.thread_id("source_url").alias("thread"), U.kind("source_url").alias("kind"))


@query(
    f"with s as (select id, allowed_domains, regexp_replace(lower(regexp_extract(coalesce(url, ''), '{URL_RE}', 2)), '^www\\.', '') as h from sources) "
    "select id, len(allowed_domains) = 0 or len(list_filter(allowed_domains, lambda x: h = x or ends_with(h, '.' || x))) > 0 as allowed from s"
)
def url_allowed(spark, d):
    return _t(spark, d, "sources").select("id", U.allowed("url", F.col("allowed_domains")).alias("allowed"))


@query(
    "select id, case when type in ('hf_dataset','kaggle') then coalesce(dataset_id, name) is not null when type in ('github_dataset','repository') then repo_url is not null when type = 'api' then endpoint is not null else url is not null end as ready from sources where coalesce(enabled, true) "
    "and case when type in ('hf_dataset','kaggle') then coalesce(dataset_id, name) is not null when type in ('github_dataset','repository') then repo_url is not null when type = 'api' then endpoint is not null else url is not null end"
)
def executable_sources(spark, d):
    return discovery.executable(_t(spark, d, "sources")).select("id", F.lit(True).alias("ready"))


def _candidates(spark, d) -> DataFrame:
    s, p = _t(spark, d, "sources"), _t(spark, d, "topic_profiles").select("profile_id", "topic", "task_type")
    j = s.join(p, "profile_id")
    rich = discovery.richness(F.col("allowed_domains"), F.col("dataset_id").isNotNull())
    rel = discovery.relevance({"topic": discovery.topic_match(F.col("topic"), F.col("name")), "trust": 1.0 / discovery.type_rank("type"), "richness": rich, "task": F.col("task_type").isNotNull().cast("double")})
    return j.select(F.col("id").alias("candidate_id"), "type", "name", F.coalesce("url", "endpoint", "repo_url").alias("url"), rel.alias("relevance"))


CANDIDATES_SQL = (
    "with p as (select id, type, name, coalesce(url, endpoint, repo_url) as url, topic, task_type, allowed_domains, dataset_id from sources join topic_profiles using (profile_id)), "
    "r as (select *, case type " + " ".join(f"when '{t}' then {i + 1}" for i, t in enumerate(discovery.TYPE_ORDER)) + f" else {len(discovery.TYPE_ORDER) + 1} end as type_rank, "
    "len(list_filter(string_split_regex(lower(coalesce(topic, '')), '\\s+'), lambda w: w <> '' and contains(lower(coalesce(name, '')), w))) > 0 as topical from p), "
    "q as (select *, round(0.5 * topical::int + 0.2 / type_rank + 0.1 * least(1.0, (coalesce(len(allowed_domains), 0) + (dataset_id is not null)::int) / 6.0) + 0.05 * (task_type is not null)::int, 4)::double as relevance from r), "
    f"u as (select *, regexp_extract(coalesce(url, ''), '{URL_RE}', 1) as us, regexp_extract(coalesce(url, ''), '{URL_RE}', 2) as uh, regexp_extract(coalesce(url, ''), '{URL_RE}', 3) as up, regexp_extract(coalesce(url, ''), '{URL_RE}', 4) as uq from q), "
    "k as (select *, array_to_string(list_sort(list_filter(string_split(regexp_replace(uq, '^\\?', ''), '&'), lambda x: regexp_matches(x, '^[^=]+=.+'))), '&') as qs from u), "
    "c as (select *, coalesce(nullif(case when coalesce(url, '') = '' then '' else lower(us) || '://' || lower(uh) || regexp_replace(up, '/+$', '') || case when qs = '' then '' else '?' || qs end end, ''), id) as page from k), "
    "one as (select *, row_number() over (partition by page order by relevance desc, id desc) as i from c), two as (select *, row_number() over (partition by type, lower(name) order by relevance desc, id desc) as j from one where i = 1), "
    "best as (select id as candidate_id, type, name, url, relevance, type_rank from two where j = 1) "
)


@query(CANDIDATES_SQL + "select candidate_id, type, name, url, relevance from best")
def candidate_ranking(spark, d):
    return discovery.order(discovery.dedupe(_candidates(spark, d)))


@query(
    CANDIDATES_SQL.rstrip() + ", t as (select *, case when type in ('hf_dataset','kaggle','github_dataset','http_file') then 'open' when type = 'api' then 'api' else 'scrape' end as tier, row_number() over (order by relevance desc, type_rank, name) as rank from best), "
    "v as (select *, row_number() over (partition by tier order by rank) as n from t), "
    "o as (select 0 as no, 'balanced' as plan, candidate_id, lower(name) as name, rank, case when n = 1 and tier = 'open' then 1 when n = 1 and tier = 'api' then 2 when n = 1 and tier = 'scrape' then 3 when rank <= 3 then 3 + rank end as turn from v "
    "union all select 1, 'open', candidate_id, lower(name), rank, case when tier = 'open' and n <= 2 then n when tier = 'api' and n = 1 then 3 end from v union all select 2, 'top', candidate_id, lower(name), rank, case when rank <= 3 then rank end from v), "
    "d as (select *, row_number() over (partition by no, name order by turn) as again from o where turn is not null), e as (select *, row_number() over (partition by no order by turn) as spot from d where again = 1), "
    "f as (select no, plan, list(candidate_id order by rank) as those from e where spot <= 3 group by 1, 2), w as (select *, row_number() over (partition by those order by no) as first from f) "
    "select plan, unnest(range(1, len(those) + 1)) as position, unnest(those) as candidate_id from w where first = 1"
)
def candidate_plans(spark, d):
    return discovery.plans(discovery.dedupe(_candidates(spark, d)))


@query(
    f"with u as (select row_id, coalesce(source_url, '') as u, coalesce(title, '') as t from merged_dataset), h as (select *, lower(regexp_extract(u, '{URL_RE}', 2)) as host, lower(regexp_extract(u, '{URL_RE}', 3)) as path from u) "
    "select row_id, round(least(1.0, 0.2 + case when regexp_matches(u, '" + planning.FORUM + "') or regexp_matches(t, '" + planning.FORUM + "') then 0.5 else 0 end + case when "
    + " or ".join(f"contains(lower(u || ' ' || t || ' '), '{w}')" for w in planning.FORUM_WORDS) + " then 0.15 else 0 end), 4)::double as score, "
    + "(" + " or ".join([f"starts_with(host, '{d}')" for d in planning.DENIED_HOSTS] + [f"contains(path, '{p}')" for p in planning.DENIED_PATHS] + ["contains(host, 'forum')"]) + ") as denied from h"
)
def forum_pages(spark, d):
    df = _t(spark, d, "merged_dataset")
    return df.select("row_id", planning.forum_score("source_url", "title").alias("score"), planning.denied("source_url", ["forum"]).alias("denied"))


@query(
    "with w as (select profile_id, topic, list_filter(regexp_extract_all(lower(coalesce(topic, '')), '[a-zA-Zа-яА-Я0-9_+-]{3,}'), lambda x: not list_contains([" + ", ".join(f"'{x}'" for x in planning.TOPIC_STOPWORDS) + "], x)) as ws from topic_profiles), "
    "t as (select profile_id, topic, list_filter(ws, lambda x, i: list_position(ws, x) = i) as ts from w) select profile_id, array_to_string(ts[1:6], ' ') as terms, "
    "case when regexp_matches(lower(topic), 'text|nlp| caption|transcript') then 'text' when regexp_matches(lower(topic), 'image|photo|vision') then 'image' when regexp_matches(lower(topic), 'audio|speech|sound') then 'audio' when contains(lower(topic), 'video') then 'video' else 'tabular' end as modality, "
    "case when regexp_matches(lower(topic), 'казах|kazakh') then 'kazakh' when regexp_matches(lower(topic), ' russian| rus |русск') then 'russian' when regexp_matches(lower(topic), 'french| german|spanish |italian|mandarin|chinese text') then 'multilingual' else 'english' end as language from t"
)
def topic_facets(spark, d):
    p = _t(spark, d, "topic_profiles")
    return p.select("profile_id", F.array_join(planning.terms("topic"), " ").alias("terms"), planning.topic_modality("topic").alias("modality"), planning.topic_language("topic").alias("language"))


@query(
    f"select unnest(['rows', 'null_ids', 'null_texts', 'blank_texts', 'null_labels', 'usable_labels', 'repeated_ids', 'labels']) as check, unnest([count(*), count(*) filter (where id is null), count(*) filter (where text is null), count(*) filter (where text is not null and {_missing('text')}), "
    f"count(*) filter (where label is null), count(*) filter (where not {_missing('label')} and lower({_strip('label')}) <> 'nan'), count(id) - count(distinct id), count(distinct case when not {_missing('label')} and lower({_strip('label')}) <> 'nan' then {_strip('label')} end)]) as n from merged_dataset"
)
def table_facts(spark, d):
    return checks.facts(_t(spark, d, "merged_dataset"))


@query("select row_id, case when length(x) <= 40 then x when contains(substr(x, 1, 40), ' ') then regexp_replace(substr(x, 1, 40), ' [^ ]*$', '') else substr(x, 1, 40) end as head from (select row_id, trim(regexp_replace(title, '\\s+', ' ', 'g')) as x from merged_dataset)")
def title_heads(spark, d):
    return _t(spark, d, "merged_dataset").select("row_id", planning.at_word_column("title", 40).alias("head"))


# ---- annotation


@query()
def rule_labels(spark, d):
    return annotate.rule_label(_t(spark, d, "documents").select(F.col("doc_id").alias("row_id"), "text")).select("row_id", "auto_label", "confidence", "margin", "entropy", "needs_review", "review_reason")


def _rule_sql() -> str:
    A = annotate

    def kw(words):
        return " + ".join(f"regexp_matches(l, '\\b{w.replace('-', chr(92) + '-')}\\b')::int" for w in words)

    def pat(ps):
        return " + ".join(f"regexp_matches(l, '(?i){p}')::int" for p in ps)

    base = f"select doc_id as row_id, {_strip('regexp_replace(coalesce(text, chr(32)), ' + chr(39) + '@WS+' + chr(39) + ', chr(32), ' + chr(39) + 'g' + chr(39) + ')')} as x0, {_missing('text')} as blank from documents"
    s = f"with b as ({base}), c as (select row_id, blank, case when lower(x0) in ('nan','none','null') then '' else x0 end as x from b), "
    s += "d as (select *, lower(x) as l, length(regexp_replace(x, '[^\\p{L}\\p{N}]', '', 'g')) as signs from c), "
    s += f"e as (select *, {kw(A.HARMFUL_WORDS)} as kw, {pat(A.HARMFUL_INTENT)} as it, {pat(A.SAFE_CONTEXT)} as ctx, {pat(A.BORDERLINE)} as bo, {pat(A.BENIGN)} as be, {kw(A.SAFE_WORDS)} as sw, regexp_matches(l, '{A.REQUEST}') as rq, "
    s += "list_sort(list_filter([case when x <> '' and signs < 0.35 * length(x) then 'low_signal_text' end, case when x <> '' and (signs = 0 or (length(x) >= 8 and length(replace(lower(x), substr(lower(x), 1, 1), '')) = 0)) then 'noisy_text' end, case when x <> '' and len(string_split(x, ' ')) = 1 and length(x) > 24 then 'single_token_text' end, case when x <> '' and length(x) < 3 then 'very_short_text' end, case when x = '' then 'empty_text' end], lambda y: y is not null)) as w from d), "
    s += "f as (select *, case when x = '' then 1.0::double when ctx > 0 then greatest(0.25, 1.0 + kw * 1.35 + it * 2.40 + case when rq and kw > 0 then 0.5 else 0 end - ctx * 0.9) else 1.0 + kw * 1.35 + it * 2.40 + case when rq and kw > 0 then 0.5 else 0 end end::double as u, "
    s += "case when x = '' then 1.15::double else 1.0 + bo * 1.65 + ctx * 1.40 + case when ctx > 0 then least(kw, 2) * 0.55 else 0 end + case when contains(x, '?') and kw > 0 then 0.6 else 0 end + case when len(w) > 0 then 0.75 else 0 end end::double as m, "
    s += "case when x = '' then 1.0::double when len(w) > 0 then greatest(0.25, 1.0 + be * 1.25 + sw * 0.7 + case when kw = 0 and it = 0 then 1.05 else 0 end - 0.3) else 1.0 + be * 1.25 + sw * 0.7 + case when kw = 0 and it = 0 then 1.05 else 0 end end::double as sa from e), "
    s += "g as (select row_id, blank, w, round(sa / (sa + m + u), 6) as ps, round(m / (sa + m + u), 6) as pm, round(u / (sa + m + u), 6) as pu from f), "
    s += "h as (select *, greatest(ps, pm, pu) as top, list_reverse_sort([ps, pm, pu])[2] as second from g), "
    s += "i as (select row_id, blank, w, case when ps = top then 'safe' when pm = top then 'borderline_safe' else 'unsafe' end as auto_label, round(top, 6) as confidence, round(top - second, 6) as margin, round(-(ps * ln(ps) + pm * ln(pm) + pu * ln(pu)) / ln(3), 6) as entropy from h), "
    s += "j as (select *, list_sort(list_distinct(list_concat(list_filter([case when confidence < 0.7 then 'low_confidence' end, case when margin < 0.12 then 'small_margin' end, case when blank then 'empty_text' end], lambda y: y is not null), w))) as r from i) "
    return s + "select row_id, auto_label, confidence, margin, entropy, len(r) > 0 as needs_review, array_to_string(r, '; ') as review_reason from j"


SQL["rule_labels"] = _rule_sql().replace("@WS", r"[\s\x0b\x1c-\x1f\x85\p{Z}]")


@query("select distinct annotation_id, row_id, round(confidence, 6) as confidence, round(margin, 6) as margin from (select distinct annotation_id, row_id, confidence, margin from annotations where coalesce(needs_review, false) order by confidence asc nulls last, margin asc nulls last, annotation_id limit 300)")
def review_queue(spark, d):
    df = _t(spark, d, "annotations").select("annotation_id", "row_id", "confidence", "margin", "needs_review").distinct()
    return annotate.review_queue(df, 300, "annotation_id").select("annotation_id", "row_id", F.round("confidence", 6).alias("confidence"), F.round("margin", 6).alias("margin"))


@query(
    "select a.annotation_id, h.ls_annotation_id, case when length(coalesce(h.human_label, '')) > 0 then h.human_label else a.auto_label end as final_label, "
    f"case when {_missing('h.human_label')} then 'auto' else 'human' end as final_label_source from annotations a left join human_labels h on a.annotation_id = h.annotation_id"
)
def human_merge(spark, d):
    return annotate.merge_human(_t(spark, d, "annotations"), _t(spark, d, "human_labels")).select("annotation_id", "ls_annotation_id", "final_label", "final_label_source")


PAIRS_SQL = f"with p as (select a.auto_label as auto, h.human_label as human from annotations a join human_labels h on a.annotation_id = h.annotation_id where not {_missing('a.auto_label')} and not {_missing('h.human_label')})"


def _pairs(spark, d) -> DataFrame:
    return annotate.paired(annotate.merge_human(_t(spark, d, "annotations"), _t(spark, d, "human_labels")))


@query(PAIRS_SQL + ", c as (select count(*) as n, sum((auto = human)::int) as same from p), h as (select human as x, count(*) as nh from p group by 1), a as (select auto as x, count(*) as na from p group by 1), e as (select coalesce(sum(nh * na), 0) as bb from h join a using (x)) "
       "select n as pairs, round(same / n, 6) as agreement, round((same / n - bb / (n::double * n)) / (1 - bb / (n::double * n)), 6) as kappa from c, e")
def agreement_kappa(spark, d):
    return annotate.agreement(_pairs(spark, d))


@query(PAIRS_SQL + ", l as (select auto as x from p union select human from p) select l.x as human, m.x as auto, (select count(*) from p where p.human = l.x and p.auto = m.x) as n from l cross join l as m")
def confusion_matrix(spark, d):
    return annotate.confusion(_pairs(spark, d))


@query(PAIRS_SQL + " select human, count(*) as n, round(avg((auto = human)::int), 6) as agreement from p group by 1")
def per_class_agreement(spark, d):
    return annotate.per_class(_pairs(spark, d))


@query("select auto_label as value, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share from annotations where auto_label is not null group by 1")
def label_distribution(spark, d):
    return annotate.distribution(_t(spark, d, "annotations"), "auto_label")


@query("select count(*) as rows, round(avg(confidence), 6) as mean_confidence, round(median(confidence), 6) as median_confidence, round(avg(case when confidence is not null then (confidence < 0.72)::int end), 6) as low_share, count(*) filter (where needs_review) as needs_review from annotations")
def confidence_summary(spark, d):
    return annotate.confidence_summary(_t(spark, d, "annotations"))


@query("select annotation_id, arg_max(coalesce(human_label, '∅'), ls_annotation_id) as human_label, max(ls_annotation_id) as ls_annotation_id from human_labels where lower(coalesce(review_status, '')) not in ('skipped','canceled','cancelled') group by 1")
def latest_review(spark, d):
    h = _t(spark, d, "human_labels")
    last = annotate.latest_review(h)
    ids = h.where(~F.lower(F.coalesce("review_status", F.lit(""))).isin("skipped", "canceled", "cancelled")).groupBy("annotation_id").agg(F.max("ls_annotation_id").alias("ls_annotation_id"))
    return last.join(ids, "annotation_id").select("annotation_id", F.coalesce("human_label", F.lit("∅")).alias("human_label"), "ls_annotation_id")


@query("select annotation_id, sha256(coalesce(text, '')) as digest, auto_label as choice, round(confidence, 6) as score from annotations")
def tool_tasks(spark, d):
    tasks = annotate.tool_tasks(_t(spark, d, "annotations"))
    first = F.from_json("task", "data struct<annotation_id string, text string>, predictions array<struct<score double, result array<struct<value struct<choices array<string>>>>>>")
    t = tasks.select(first.alias("t"))
    return t.select("t.data.annotation_id", F.sha2(F.coalesce("t.data.text", F.lit("")), 256).alias("digest"), F.col("t.predictions")[0]["result"][0]["value"]["choices"][0].alias("choice"), F.round(F.col("t.predictions")[0]["score"], 6).alias("score"))


@query("select auto_label, least(count(*), 25) as n, least(count(*), 25) as ids from (select distinct annotation_id, row_id, auto_label from annotations) group by 1")
def audit_sample(spark, d):
    sample = annotate.audit_sample(_t(spark, d, "annotations").select("annotation_id", "row_id", "auto_label").distinct(), 25, row="annotation_id")
    return sample.groupBy("auto_label").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("annotation_id").alias("ids"))


# ---- joins and sets


@query("select m.row_id from merged_dataset m where not exists (select 1 from annotations a where a.row_id = m.row_id)")
def pool_anti_join(spark, d):
    return _t(spark, d, "merged_dataset").select("row_id").join(_t(spark, d, "annotations").select("row_id").distinct(), "row_id", "left_anti")


@query("with h as (select a.row_id, arg_min(h.human_label, h.ls_annotation_id) as new from annotations a join human_labels h on a.annotation_id = h.annotation_id where h.human_label is not null group by 1) select m.row_id, coalesce(h.new, m.label) as final_label from merged_dataset m left join h on m.row_id = h.row_id")
def label_overlay(spark, d):
    acc = _t(spark, d, "annotations").select("annotation_id", "row_id").join(_t(spark, d, "human_labels").where("human_label is not null").select("annotation_id", "ls_annotation_id", F.col("human_label").alias("label")), "annotation_id").select("row_id", "ls_annotation_id", "label")
    return active.overlay_labels(_t(spark, d, "merged_dataset").select("row_id", F.col("label").alias("final_label")), acc, order="ls_annotation_id")


@query("with p as (select lower(trim(a.auto_label)) as pred, lower(trim(h.human_label)) as label from annotations a join human_labels h on a.annotation_id = h.annotation_id where trim(coalesce(h.human_label, '')) <> '' and trim(coalesce(a.auto_label, '')) <> ''), "
       "l as (select label as c, count(*) as actual, sum((label = pred)::int) as hit from p group by 1), q as (select pred as c, count(*) as predicted from p group by 1), "
       "j as (select coalesce(actual, 0) as actual, coalesce(hit, 0) as hit, coalesce(predicted, 0) as predicted from l full join q using (c)), "
       "k as (select *, case when predicted = 0 then 0 else hit / predicted end as pr, case when actual = 0 then 0 else hit / actual end as re from j) "
       "select round(sum(hit) / sum(actual), 6) as accuracy, round(avg(pr), 6) as macro_precision, round(avg(re), 6) as macro_recall, round(avg(case when pr + re = 0 then 0 else 2 * pr * re / (pr + re) end), 6) as macro_f1, sum(actual)::bigint as n from k")
def macro_metrics(spark, d):
    j = _t(spark, d, "annotations").join(_t(spark, d, "human_labels"), "annotation_id")
    p = j.select(F.lower(F.trim("human_label")).alias("label"), F.lower(F.trim("auto_label")).alias("pred")).where("coalesce(label, '') <> '' and coalesce(pred, '') <> ''")
    return active.metrics(p)


@query("with p as (select lower(trim(a.auto_label)) as pred, lower(trim(h.human_label)) as label from annotations a join human_labels h on a.annotation_id = h.annotation_id where trim(coalesce(h.human_label, '')) <> '' and trim(coalesce(a.auto_label, '')) <> ''), "
       "l as (select label, count(*) as support, sum((label = pred)::int) as hit from p group by 1), q as (select pred as label, count(*) as predicted from p group by 1), "
       "k as (select label, coalesce(support, 0)::bigint as support, case when coalesce(predicted, 0) = 0 then 0 else coalesce(hit, 0) / predicted end as p, case when coalesce(support, 0) = 0 then 0 else coalesce(hit, 0) / support end as r from l full join q using (label)) "
       "select label, round(p, 6)::double as precision, round(r, 6)::double as recall, round(case when p + r = 0 then 0 else 2 * p * r / (p + r) end, 6)::double as f1, support from k")
def class_report(spark, d):
    j = _t(spark, d, "annotations").join(_t(spark, d, "human_labels"), "annotation_id")
    p = j.select(F.lower(F.trim("human_label")).alias("label"), F.lower(F.trim("auto_label")).alias("pred")).where("coalesce(label, '') <> '' and coalesce(pred, '') <> ''")
    return active.class_report(p)


@query("with p as (select ls_annotation_id as row_id, case when lower(trim(h.human_label)) like '%emergency%' then 'red' else 'other' end as label, case when lower(trim(a.auto_label)) like '%emergency%' then 'red' else 'other' end as pred from annotations a join human_labels h on a.annotation_id = h.annotation_id), "
       "f as (select label, min(row_id) as at_row from p group by 1), pos as (select label as c from f order by at_row desc limit 1), "
       "n as (select count(*) as n, avg((label = pred)::int) as acc, count(*) filter (where label = c and pred = c) as tp, count(*) filter (where label = c) as sup, count(*) filter (where pred = c) as prd from p, pos) "
       "select round(acc, 6)::double as accuracy, round(case when sup + prd = 0 then 0 else 2.0 * tp / (sup + prd) end, 6)::double as f1, 'binary' as f1_kind, n from n")
def binary_metrics(spark, d):
    red = lambda c: F.when(F.lower(F.trim(c)).contains("emergency"), "red").otherwise("other")
    j = _t(spark, d, "annotations").select("annotation_id", "auto_label").join(_t(spark, d, "human_labels").select("annotation_id", "human_label", "ls_annotation_id"), "annotation_id")
    return active.evaluate(j.select(F.col("ls_annotation_id").alias("row_id"), red("human_label").alias("label"), red("auto_label").alias("pred")))


@query("select annotation_id, round(confidence, 6) as confidence, round(s[1] - s[2], 6) as gap from (select distinct annotation_id, confidence, list_reverse_sort(map_values(class_scores)) as s from annotations)")
def score_margins(spark, d):
    df = _t(spark, d, "annotations").select("annotation_id", "confidence", F.map_values("class_scores").alias("p"))
    return df.select("annotation_id", F.round("confidence", 6).alias("confidence"), F.round(active.margin(F.col("p")), 6).alias("gap")).distinct()


# ---- exploration


@query("with t as (select unnest(regexp_extract_all(lower(text), '[a-z][a-z'']{2,}')) as token from documents) select token, count(*) as n from t where token not in (" + ", ".join(f"'{w}'" for w in eda.STOPWORDS) + ") group by 1 order by n desc, token limit 20")
def top_tokens(spark, d):
    return eda.top_tokens(_t(spark, d, "documents"), "text")


@query("select source as value, count(*) as n from documents where source is not null group by 1 order by n desc, value limit 30")
def value_counts(spark, d):
    return eda.value_counts(_t(spark, d, "documents"), "source", 30)


@query(f"with x as (select length(text) as c, case when {_strip('text')} = '' then 0 else len(regexp_split_to_array({_strip('text')}, '@WS+')) end as w from documents where text is not null) select count(*) as n, round(avg(c), 4) as mean_chars, median(c) as median_chars, round(quantile_cont(c, 0.99), 4) as p99_chars, max(c)::int as max_chars, round(avg(w), 4) as mean_words from x")
def length_stats(spark, d):
    return eda.length_stats(_t(spark, d, "documents"), "text")


@query("with x as (select length(text)::double as c from documents where text is not null), t as (select greatest(quantile_cont(c, 0.99), 1.0) as top from x) select least(floor(least(c, top) * 40 / top), 39)::bigint as bin, count(*) as n from x, t group by 1")
def length_histogram(spark, d):
    return eda.length_histogram(_t(spark, d, "documents"), "text")


def _describe_sql(table: str, cols: list[str]) -> str:
    return " union all ".join(f"select '{c}' as column_name, count({c}) as n, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, min({c})::double as min, round(quantile_cont({c}::double, 0.25), 4) as q1, round(quantile_cont({c}::double, 0.5), 4) as median, round(quantile_cont({c}::double, 0.75), 4) as q3, max({c})::double as max from {table}" for c in cols)


@query(_describe_sql("orders", ["o_totalprice", "o_custkey"]))
def describe_orders(spark, d):
    return eda.describe(_t(spark, d, "orders"), ["o_totalprice", "o_custkey"])


@query("select year(o_orderdate)::int as year, count(*) as n from orders where o_orderdate is not null group by 1")
def year_coverage(spark, d):
    return eda.years(_t(spark, d, "orders"), "o_orderdate")


@query(" union all ".join(f"select '{c}' as column_name, count(distinct {c}) as distinct_values from part having count(distinct {c}) between 2 and 50" for c in ("p_brand", "p_type", "p_name")))
def categorical_columns(spark, d):
    return eda.categorical(_t(spark, d, "part"), ["p_brand", "p_type", "p_name"])


@query("select source, count(*) as n from merged_dataset group by 1")
def source_counts(spark, d):
    return eda.source_counts(_t(spark, d, "merged_dataset"))


# ---- near-duplicates, splits, models


@query()
def near_duplicate_drops(spark, d):
    return neardup.drop_near(_t(ship(spark), d, "merged_dataset"), threshold=0.92)


@query("with c as (select count(*) as n from merged_dataset), t as (select n, least(round_even(n * 0.2, 0)::bigint, n - 3) as test from c) select unnest(['test', 'seed', 'pool']) as part, unnest([test, least(50, n - test - 1), n - test - least(50, n - test - 1)]) as n, unnest([test, least(50, n - test - 1), n - test - least(50, n - test - 1)]) as ids from t")
def al_split(spark, d):
    parts = active.bucket_split(_t(spark, d, "merged_dataset").select("row_id", "label"), label="label")
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("ids"))


@query(
    "with p as (select distinct annotation_id, map_values(class_scores) as v from annotations), s as (select annotation_id, -list_sum(list_transform(v, lambda x: x * ln(x + 1e-12))) as score from p) "
    "select annotation_id, round(score, 6) as selection_score, 'entropy' as strategy from s order by score desc, annotation_id limit 20"
)
def al_query_entropy(spark, d):
    df = _t(spark, d, "annotations").select("annotation_id", F.map_values("class_scores").alias("proba")).distinct()
    return active.query(df, "entropy", 20, "annotation_id").select("annotation_id", F.round("selection_score", 6).alias("selection_score"), "strategy")


@query()
def train_baseline(spark, d):
    df = _t(spark, d, "merged_dataset").where(~T.missing("text") & ~T.missing("label")).select("row_id", "text", F.regexp_replace(F.lower(F.trim("label")), "[ -]", "_").alias("label"))
    parts = active.stratified_split(df, "label")
    model = active.Classifier(features=20_000, iterations=2000).fit(parts.where("part = 'train'"))
    return active.metrics(model.predict(parts.where("part = 'test'")).select("label", F.col("model_pred").alias("pred")))
