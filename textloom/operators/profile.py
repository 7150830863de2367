"""Profiles of a table: missing values, duplicates, outliers, imbalance, text quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.quantiles import quantiles

# Columns that mostly name a label, in order of preference.
LABELS = ("label", "target", "class", "category", "sentiment")


def _any(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols, F.lit(False))


def _long(row: DataFrame, names: list[str], suffixes: dict[str, str], key: str) -> DataFrame:
    """One aggregated row with ``<i>_<suffix>`` columns as one row per name."""
    parts = F.array(*[F.struct(F.lit(n).alias(key), *[F.col(f"{i}_{s}").alias(alias) for s, alias in suffixes.items()]) for i, n in enumerate(names)])
    return row.select(F.explode(parts).alias("x")).select("x.*")


def missing_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, missing, percent): missing cells of each column, and ``*`` for rows with any; one pass."""
    types = dict(df.dtypes)
    names = columns or df.columns
    flags = [T.missing(c, types[c]) for c in names]
    seen = [F.col(f"__m{i}") for i in range(len(flags))]
    aggs = [F.count_if(f).alias(f"{i}_n") for i, f in enumerate(seen)] + [F.count_if(_any(seen)).alias(f"{len(names)}_n"), F.count(F.lit(1)).alias("total")]
    # each flag once a row
    marked = df.select(*[f.alias(f"__m{i}") for i, f in enumerate(flags)])
    row = marked.agg(*aggs)
    for i in range(len(names) + 1):
        row = row.withColumn(f"{i}_p", T.percentage(F.col(f"{i}_n"), F.col("total")))
    return _long(row, [*names, "*"], {"n": "missing", "p": "percent"}, "column_name")


def duplicate_counts(df: DataFrame, subsets: dict[str, list[Column]]) -> DataFrame:
    """(kind, duplicates, percent): rows beyond the first of equal keys; null keys equal each other."""
    # one scan; only hashes of the keys move
    keys = F.array(*[F.struct(F.lit(kind).alias("kind"), *T.key128(*cols)) for kind, cols in subsets.items()])
    counts = df.select(F.explode(keys).alias("k")).groupBy("k.kind", "k.__h1", "k.__h2").agg(F.count(F.lit(1)).alias("n"))
    s = counts.groupBy("kind").agg(F.sum("n").alias("total"), F.sum(F.col("n") - 1).alias("duplicates"))
    every = df.sparkSession.createDataFrame([(k,) for k in subsets], "kind string")
    s = every.join(s, "kind", "left").select("kind", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("duplicates", F.lit(0)).alias("duplicates"))
    return s.select("kind", "duplicates", T.percentage(F.col("duplicates"), F.col("total")).alias("percent"))


def iqr_bounds(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float] | None]:
    """Quartiles by linear interpolation, widened by 1.5 of their distance; None below two values."""
    row = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    wanted = [c for i, c in enumerate(columns) if row[f"n{i}"] >= 2]
    quarts = quantiles(df, wanted, [0.25, 0.75]) if wanted else {}
    return {c: (a - 1.5 * (b - a), b + 1.5 * (b - a)) if (a := quarts.get(c, [None])[0]) is not None and (b := quarts[c][1]) is not None else None for c in columns}


def z_bounds(df: DataFrame, columns: list[str], width: float = 3.0) -> dict[str, tuple[float, float] | None]:
    """Mean and population deviation as bounds; None without spread."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    return {c: (row[f"m{i}"] - width * row[f"s{i}"], row[f"m{i}"] + width * row[f"s{i}"]) if row[f"s{i}"] else None for i, c in enumerate(columns)}


def outside(c: str, bounds: tuple[float, float] | None) -> Column:
    """Whether a value lies outside; null values and missing bounds don't."""
    return F.lit(False) if bounds is None else F.coalesce((F.col(c) < bounds[0]) | (F.col(c) > bounds[1]), F.lit(False))


def outliers(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, iqr_rows, z_rows, low, high): two passes, statistics then counts; ``*`` counts rows outside in any."""
    iqr, z = iqr_bounds(df, columns), z_bounds(df, columns)
    flags = [(outside(c, iqr[c]), outside(c, z[c])) for c in columns]
    aggs = []
    for i, (a, b) in enumerate(flags):
        lo, hi = iqr[columns[i]] or (None, None)
        aggs += [F.count_if(a).alias(f"{i}_a"), F.count_if(b).alias(f"{i}_b"), F.first(F.lit(lo).cast("double")).alias(f"{i}_lo"), F.first(F.lit(hi).cast("double")).alias(f"{i}_hi")]
    k = len(columns)
    none = F.first(F.lit(None).cast("double"))
    aggs += [F.count_if(_any([a for a, _ in flags])).alias(f"{k}_a"), F.count_if(_any([b for _, b in flags])).alias(f"{k}_b"), none.alias(f"{k}_lo"), none.alias(f"{k}_hi")]
    return _long(df.agg(*aggs), [*columns, "*"], {"a": "iqr_rows", "b": "z_rows", "lo": "low", "hi": "high"}, "feature").select("feature", "iqr_rows", "z_rows", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"))


def imbalance(df: DataFrame, label: str, least: float = 3.0) -> DataFrame:
    """(label, n, share, ratio, imbalanced): counts of non-blank labels; ratio of the largest to the smallest."""
    counts = df.where(~T.missing(label)).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"), F.max("n").alias("most"), F.min("n").alias("least"))
    # one row: the totals
    joined = counts.join(F.broadcast(total), F.lit(True))
    ratio = F.round(F.col("most") / F.col("least"), 4)
    return joined.select("label", "n", F.round(F.col("n") / F.col("total"), 4).alias("share"), ratio.alias("ratio"), (ratio >= least).alias("imbalanced"))


def parse_ratio(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, values, ratio): share of non-null cells that read as numbers."""
    aggs = []
    for i, c in enumerate(columns):
        s = F.col(c).cast("string")
        aggs += [F.count(c).alias(f"{i}_v"), F.round(F.coalesce(F.avg(F.when(s.isNotNull(), T.number(s).isNotNull().cast("double"))), F.lit(0.0)), 6).alias(f"{i}_r")]
    return _long(df.agg(*aggs), columns, {"v": "values", "r": "ratio"}, "column_name")


def infer_columns(df: DataFrame, numeric_share: float = 0.8, filled_share: float = 0.1, mean_length: float = 2.0) -> DataFrame:
    """(column_name, kind): numeric, meaningful_text, or other, from the types and one aggregation over strings."""
    strings = [c for c, t in df.dtypes if t == "string"]
    aggs = [F.count(F.lit(1)).alias("total")]
    for i, c in enumerate(strings):
        aggs += [F.avg(F.when(F.col(c).isNotNull(), T.number(c).isNotNull().cast("double"))).alias(f"{i}_r"), F.count_if(~T.missing(c)).alias(f"{i}_f"), F.avg(F.when(~T.missing(c), F.length(c))).alias(f"{i}_l")]
    row = df.agg(*aggs)
    kinds = []
    for c, t in df.dtypes:
        if t == "string":
            i = strings.index(c)
            numeric = F.coalesce(F.col(f"{i}_r"), F.lit(0.0)) >= numeric_share
            full = (F.col(f"{i}_f") >= filled_share * F.greatest(F.col("total"), F.lit(1))) & (F.coalesce(F.col(f"{i}_l"), F.lit(0.0)) >= mean_length)
            kind = F.when(numeric, "numeric").when(full, "meaningful_text").otherwise("other")
        else:
            kind = F.lit("numeric" if t in ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean") or t.startswith("decimal") else "other")
        kinds.append(F.struct(F.lit(c).alias("column_name"), kind.alias("kind")))
    return row.select(F.explode(F.array(*kinds)).alias("x")).select("x.*")


def text_quality(df: DataFrame, column: str, min_chars: int = 15) -> DataFrame:
    """(metric, n): blank, short, exact and normalised duplicates, and personal-data rows of a text column."""
    # each flag once a row
    kinds = list(T.PATTERNS)
    flags = df.select(F.length(T.strip(F.coalesce(F.col(column), F.lit("")))).alias("__n"), *[T.hits(column, k).alias(f"__{k}") for k in kinds])
    flat = flags.agg(
        F.count_if(F.col("__n") == 0).alias("empty"),
        F.count_if((F.col("__n") > 0) & (F.col("__n") < min_chars)).alias("short"),
        *[F.count_if(F.col(f"__{k}")).alias(f"{k}_rows") for k in kinds],
        F.count_if(_any([F.col(f"__{k}") for k in kinds])).alias("pii_rows"),
        F.count(F.lit(1)).alias("rows"),
    )
    names = flat.columns
    return flat.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("bigint").alias("n")) for n in names])).alias("x")).select("x.*")


def null_shares(df: DataFrame, expected: list[str]) -> DataFrame:
    """(column_name, present, null_share) of expected columns."""
    have = [c for c in expected if c in df.columns]
    row = df.agg(*[F.round(F.avg(F.col(c).isNull().cast("double")), 6).alias(f"s_{c}") for c in have], F.count(F.lit(1)).alias("n"))
    parts = [F.struct(F.lit(c).alias("column_name"), F.lit(c in have).alias("present"), (F.col(f"s_{c}") if c in have else F.lit(None).cast("double")).alias("null_share")) for c in expected]
    return row.select(F.explode(F.array(*parts)).alias("x")).select("x.*")


def label_column(columns: list[str], configured: str | None = None) -> str | None:
    """The configured label column, or the first usual name among the columns."""
    if configured in columns:
        return configured
    return next((c for c in LABELS if c in columns), None)


def recommendations(report: dict[str, int | float | bool]) -> list[str]:
    """Rule-based advice from the profile's totals."""
    rules = (
        (report.get("missing_cells", 0) > 0, "Impute or drop missing values; critical text columns should be dropped rather than filled."),
        (report.get("duplicate_rows", 0) > 0, "Drop duplicate rows and keep the first of each key."),
        (report.get("outlier_rows", 0) > 0, "Clip or review outliers before training."),
        (bool(report.get("imbalanced")), "Rebalance or weight the classes."),
        (report.get("pii_rows", 0) > 0, "Redact personal data before sharing."),
    )
    return [advice for on, advice in rules if on] or ["No action needed."]
