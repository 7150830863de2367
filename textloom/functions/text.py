"""Column expressions on text: stripping, blanks, patterns, redaction, fingerprints."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as string methods strip it, in a class that RE2 and Java read alike.
WS = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
NOT_WS = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"
#: The same characters for functions that take a set.
WS_CHARS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

# Patterns of personal data and their tokens.
EMAIL = r"(?i)[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
PHONE = r"(?:\+?\d{1,3}[\s.\-]?)?(?:\(?\d{2,4}\)?[\s.\-]?)?\d{3,4}[\s.\-]?\d{3,5}\b"
HANDLE = r"(?<![A-Za-z0-9._%+\-])@[A-Za-z0-9_]{2,32}\b"
TOKENS = {"email": "[REDACTED_EMAIL]", "phone": "[REDACTED_PHONE]", "handle": "[REDACTED_HANDLE]"}
PATTERNS = {"email": EMAIL, "phone": PHONE, "handle": HANDLE}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """White space of any kind taken from both ends."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def blank(c: Column | str) -> Column:
    """A string of white space only; null is not blank."""
    return _c(c).isNotNull() & ~_c(c).rlike(NOT_WS)


def missing(c: Column | str, kind: str = "string") -> Column:
    """Null, NaN, or a blank string."""
    col = _c(c)
    if kind == "string":
        return col.isNull() | ~col.rlike(NOT_WS)
    if kind in ("double", "float"):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def empty_to_null(c: Column | str) -> Column:
    """The stripped string, null if nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def normal_key(c: Column | str) -> Column:
    """Key for normalised duplicates: stripped, lower case, single spaces; blank and null give null."""
    return F.nullif(F.regexp_replace(F.lower(strip(F.coalesce(_c(c), F.lit("")))), f"{WS}+", " "), F.lit(""))


def collapse(c: Column | str) -> Column:
    """Single spaces and no margins; the words nan, none and null count as nothing."""
    x = strip(F.regexp_replace(F.coalesce(_c(c), F.lit("")), f"{WS}+", " "))
    return F.when(F.lower(x).isin("nan", "none", "null"), "").otherwise(x)


def hits(c: Column | str, kind: str) -> Column:
    """Whether a personal-data pattern occurs; null counts as no."""
    return F.coalesce(_c(c), F.lit("")).rlike(PATTERNS[kind])


def any_hit(c: Column | str) -> Column:
    return hits(c, "email") | hits(c, "phone") | hits(c, "handle")


def redact(c: Column | str, emails: bool = True, phones: bool = True, handles: bool = True) -> Column:
    """Fixed tokens for e-mail addresses, then phone numbers, then handles."""
    out = _c(c)
    for kind, on in (("email", emails), ("phone", phones), ("handle", handles)):
        if on:
            out = F.regexp_replace(out, PATTERNS[kind], TOKENS[kind].replace("[", r"\[").replace("$", r"\$"))
    return out


def words(c: Column | str) -> Column:
    """Number of white-space separated tokens; null has none."""
    x = strip(F.coalesce(_c(c), F.lit("")))
    return F.when(x == "", 0).otherwise(F.size(F.split(x, f"{WS}+"))).cast("int")


def chars(c: Column | str) -> Column:
    return F.length(F.coalesce(_c(c), F.lit("")))


NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def number(c: Column | str) -> Column:
    """A string's number, null if it isn't one; type suffixes and NaN aren't numbers."""
    x = strip(c)
    return F.when(x.rlike(NUMBER), F.try_cast(x, "double")) if hasattr(F, "try_cast") else F.when(x.rlike(NUMBER), x.try_cast("double"))


def percentage(count: Column, total: Column) -> Column:
    """Share in percent to four places; 0 of nothing."""
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(100.0 * count / total, 4))


def token(c: str, kind: str) -> Column:
    """A cell as text for hashing: null is empty, nested values are JSON."""
    nested = kind.startswith(("array", "map", "struct"))
    return F.coalesce(F.to_json(c) if nested else F.col(c).cast("string"), F.lit(""))


def key128(*cols: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a key in groupings, so wide values don't move; nulls differ from all values."""
    parts = [x for c in cols for x in (c.isNull(), c)]
    return [F.xxhash64(*parts).alias("__h1"), F.xxhash64(F.lit(0x9E3779B9), *parts).alias("__h2")]


def fingerprint(dtypes: list[tuple[str, str]]) -> Column:
    """SHA-256 over ``name=value`` of the given columns, in order, joined by the unit separator."""
    return F.sha2(F.concat_ws("\x1f", *[F.concat(F.lit(f"{n}="), token(n, t)) for n, t in dtypes]), 256)


def keyword_hits(c: Column | str, keywords: list[str]) -> Column:
    """How many of the keywords occur as whole words."""
    # the plain search comes first: most texts have none of the words
    return sum(((_c(c).contains(k) & _c(c).rlike(r"\b" + k.replace("-", r"\-") + r"\b")).cast("int") for k in keywords), F.lit(0))


def required(pattern: str) -> list[str]:
    """Literals one of which any match of a pattern contains: the beginnings of the shortest group's alternatives."""
    best: list[str] = []
    for group in re.findall(r"\(([^()]*)\)", pattern):
        heads = []
        for way in group.split("|"):
            head = re.match(r"[a-z0-9 -]*", way).group()
            if way[len(head) : len(head) + 1] in ("?", "*", "{"):
                head = head[:-1]
            heads.append(head)
        if all(len(h) > 2 for h in heads) and (not best or len(heads) < len(best)):
            best = heads
    return best


def pattern_hits(c: Column | str, patterns: list[str]) -> Column:
    """How many of the patterns occur in a lower-case text."""
    out = F.lit(0)
    for p in patterns:
        hit = _c(c).rlike(p)
        literals = required(p)
        if literals:
            hit = reduce(lambda a, b: a | b, [_c(c).contains(x) for x in literals]) & hit
        out = out + hit.cast("int")
    return out


def truncate(c: Column | str, limit: int = 220) -> Column:
    """Single spaces, cut to ``limit`` characters with three dots."""
    x = strip(F.regexp_replace(F.coalesce(_c(c), F.lit("")), f"{WS}+", " "))
    return F.when(F.length(x) > limit, F.concat(F.rtrim(F.substring(x, 1, limit - 3)), F.lit("..."))).otherwise(x)


def slug(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), r"[^A-Za-z0-9._:\-]", "_")


def to_bool(c: Column | str) -> Column:
    """Yes and no words in English and Russian; others null."""
    x = F.lower(strip(c))
    return F.when(x.isin("true", "yes", "y", "1", "да", "д"), True).when(x.isin("false", "no", "n", "0", "нет", "н"), False)


def size_target(c: Column | str) -> Column:
    """The first number with its factor (k, m, тыс, тысяч, млн), as in '15k rows'."""
    x = F.lower(_c(c))
    p = r"(\d+(?:[.,]\d+)?)\s*(тысяч|тыс|млн|k|m)?"
    n = F.nullif(F.regexp_replace(F.regexp_extract(x, p, 1), ",", "."), F.lit("")).try_cast("double")
    unit = F.regexp_extract(x, p, 2)
    return F.floor(n * F.when(unit.isin("k", "тыс", "тысяч"), 1e3).when(unit.isin("m", "млн"), 1e6).otherwise(1.0)).cast("bigint")


def history_years(c: Column | str) -> Column:
    """N of 'last N years' or 'N years'."""
    return F.nullif(F.regexp_extract(F.lower(_c(c)), r"(\d+)\s+years", 1), F.lit("")).try_cast("int")
