"""Repairs of a table: blanks, imputation, duplicates, outliers, text quality; with audit and comparison.

All take and return DataFrames; statistics are taken once before any repair of the same kind. Rows keep their order
through an id column, which decides what first and last mean.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import profile
from textloom.operators.quantiles import modes, quantiles


def blank_to_null(df: DataFrame) -> DataFrame:
    """Blank strings become null."""
    return df.withColumns({c: F.when(T.blank(c), F.lit(None)).otherwise(F.col(c)) for c, t in df.dtypes if t == "string"})


def fill_values(df: DataFrame, strategies: dict[str, str | tuple[str, object]]) -> dict[str, object]:
    """Fill value of each column: mean, median, mode (ties to the smallest) or a constant."""
    types = dict(df.dtypes)
    means, medians, common, out = [], [], [], {}
    for c, s in strategies.items():
        name, const = s if isinstance(s, tuple) else (s, None)
        numeric = types[c] in ("tinyint", "smallint", "int", "bigint", "float", "double")
        if name == "constant":
            out[c] = const
        elif name in ("mean", "median") and numeric:
            if name == "mean":
                means.append(c)
            else:
                medians.append(c)
        elif name == "mode":
            common.append(c)
    if means:
        row = df.agg(*[F.avg(c).alias(f"v{i}") for i, c in enumerate(means)]).first()
        out |= {c: row[f"v{i}"] for i, c in enumerate(means)}
    if medians:
        out |= {c: v[0] for c, v in quantiles(df, medians, [0.5]).items()}
    return out | modes(df, common)


def impute(df: DataFrame, strategies: dict[str, str | tuple[str, object]]) -> DataFrame:
    """Missing cells filled, then rows with missing cells in ``drop_rows`` columns dropped.

    Rows to be dropped still count in the statistics; a mean or median of a column that isn't numeric is skipped.
    """
    types = dict(df.dtypes)
    drop = [c for c, s in strategies.items() if s == "drop_rows"]
    gone = reduce(lambda a, b: a | b, [T.missing(c, types[c]) for c in drop], F.lit(False))
    values = fill_values(df, {c: s for c, s in strategies.items() if s != "drop_rows"})
    filled = {c: F.when(T.missing(c, types[c]), F.lit(v).cast(types[c])).otherwise(F.col(c)) for c, v in values.items() if v is not None}
    return df.where(~gone).withColumns(filled) if filled else df.where(~gone)


def dedupe(df: DataFrame, keys: list[str], order: str, keep: str = "first") -> DataFrame:
    """One row per key: the first or last by ``order``; a key ``normalized_x`` stands for x without case and spacing.

    Survivors come from a map-side combined aggregation of ids and a semi join, so no key gathers its rows in one task.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"unknown way to keep duplicates: {keep}")
    cols = [T.normal_key(k.removeprefix("normalized_")) if k.startswith("normalized_") and k not in df.columns else F.col(k) for k in keys]
    kept = df.groupBy(*T.key128(*cols)).agg((F.min if keep == "first" else F.max)(order).alias(order)).select(order)
    return df.join(kept, order, "left_semi")


def clip(df: DataFrame, columns: list[str], method: str = "iqr") -> DataFrame:
    """Values limited to the bounds, which are rounded to four places; null stays null."""
    bounds = (profile.iqr_bounds if method == "iqr" else profile.z_bounds)(df, columns)
    out = {}
    for c, b in bounds.items():
        if b:
            lo, hi = round(b[0], 4), round(b[1], 4)
            out[c] = F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c).cast("double"), F.lit(hi)), F.lit(lo)))
    return df.withColumns(out) if out else df


def remove_outliers(df: DataFrame, columns: list[str], method: str = "iqr") -> DataFrame:
    """Rows with any value outside its unrounded bounds dropped."""
    bounds = (profile.iqr_bounds if method == "iqr" else profile.z_bounds)(df, columns)
    return df.where(~reduce(lambda a, b: a | b, [profile.outside(c, b) for c, b in bounds.items()], F.lit(False)))


def repair_text(df: DataFrame, column: str, pii: str | None = None, drop_short: int | None = None) -> DataFrame:
    """Personal data redacted or its rows dropped, then rows with empty or short texts dropped."""
    if pii == "redact":
        df = df.withColumn(column, T.redact(column))
    elif pii == "drop":
        df = df.where(~T.any_hit(column))
    if drop_short is not None:
        df = df.where(F.length(T.strip(F.coalesce(F.col(column), F.lit("")))) >= max(drop_short, 1))
    return df


def fix(df: DataFrame, strategy: dict, order: str) -> DataFrame:
    """Steps in fixed order: blanks to null, missing, duplicates, outliers, text quality."""
    df = blank_to_null(df)
    if strategy.get("missing"):
        df = impute(df, strategy["missing"])
    if d := strategy.get("duplicates"):
        df = dedupe(df, d["keys"], order, d.get("keep", "first"))
    if o := strategy.get("outliers"):
        df = (clip if o["action"] == "clip" else remove_outliers)(df, o["columns"], o.get("method", "iqr"))
    if t := strategy.get("text_quality"):
        df = repair_text(df, t["column"], t.get("pii"), t.get("min_chars"))
    return df


def removed(before: DataFrame, after: DataFrame, order: str) -> DataFrame:
    """Rows that a repair took out."""
    return before.join(after.select(order).distinct(), order, "left_anti")


def audit(before: DataFrame, after: DataFrame, order: str) -> DataFrame:
    """(row, action): removed rows, and rows of which a cell changed."""
    shared = [c for c in before.columns if c in after.columns and c != order]
    marks = lambda d: d.select(order, T.fingerprint([(c, t) for c, t in d.dtypes if c in shared]).alias("h"))
    b, a = marks(before), marks(after)
    joined = b.join(a.withColumnRenamed("h", "h2"), order, "left")
    action = F.when(F.col("h2").isNull(), "removed").when(F.col("h") != F.col("h2"), "changed")
    return joined.select(order, action.alias("action")).where("action is not null")


def compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column_name, before, after, delta): missing cells of each column before and after, ``*`` for rows with any."""
    b = profile.missing_profile(before).select("column_name", F.col("missing").alias("before"))
    a = profile.missing_profile(after).select("column_name", F.col("missing").alias("after"))
    j = b.join(a, "column_name", "full_outer")
    return j.select("column_name", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after")).withColumn("delta", F.col("after") - F.col("before"))


def with_row_ids(df: DataFrame, by: list[str], name: str = "row_no") -> DataFrame:
    """Dense numbers from 0 in the order of ``by``: counts per range partition, then numbers within it."""
    spark = df.sparkSession
    parts = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by).withColumn("__p", F.spark_partition_id())
    counts = parts.groupBy("__p").agg(F.count(F.lit(1)).alias("n"))
    # one row per partition
    offsets = counts.select("__p", (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("__at"))
    within = F.row_number().over(Window.partitionBy("__p").orderBy(*by)) - 1
    return parts.withColumn("__i", within).join(F.broadcast(offsets), "__p").withColumn(name, F.col("__i") + F.col("__at")).drop("__p", "__i", "__at")
