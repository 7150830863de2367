"""Exploratory aggregates of a collected table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.quantiles import quantiles

# English stop words left out of token counts.
STOPWORDS = tuple(
    (
        "the a an and or to of in is for on with as at by from that this it be are was were not no yes "
        "if we you he she they i my our their one two all can has have had will would could should"
    ).split()
)


def source_counts(df: DataFrame, by: str = "source") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def top_tokens(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """(token, n): the commonest words of three or more Latin letters, stop words left out; ties by token."""
    t = df.select(F.explode(F.regexp_extract_all(F.lower(F.col(column)), F.lit("([a-z][a-z']{2,})"), 1)).alias("token"))
    c = t.where(~F.col("token").isin(*STOPWORDS)).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.desc("n"), "token").limit(k)


def value_counts(df: DataFrame, column: str, k: int) -> DataFrame:
    """(value, n): the k commonest non-null values; ties by value."""
    c = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.desc("n"), "value").limit(k)


def length_stats(df: DataFrame, column: str) -> DataFrame:
    """(n, mean_chars, median_chars, p99_chars, max_chars, mean_words) of the texts that aren't null."""
    d = df.where(F.col(column).isNotNull()).select(F.length(column).alias("c"), T.words(column).alias("w"))
    half, top = quantiles(d, ["c"], [0.5, 0.99])["c"]
    return d.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("c"), 4).alias("mean_chars"), F.lit(half).cast("double").alias("median_chars"), F.round(F.lit(top).cast("double"), 4).alias("p99_chars"), F.max("c").alias("max_chars"), F.round(F.avg("w"), 4).alias("mean_words"))


def length_histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """(bin, n): lengths clipped at the 99th percentile in equal bins from 0."""
    d = df.where(F.col(column).isNotNull()).select(F.length(column).cast("double").alias("c"))
    top = F.lit(max(quantiles(d, ["c"], [0.99])["c"][0] or 1.0, 1.0))
    b = F.least(F.floor(F.least("c", top) * bins / top), F.lit(bins - 1))
    return d.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n, mean, std, min, q1, median, q3, max) in one pass."""
    aggs, quarts = [], quantiles(df, columns, [0.25, 0.5, 0.75])
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"{i}_n"), F.round(F.avg(x), 4).alias(f"{i}_mean"), F.round(F.stddev_samp(x), 4).alias(f"{i}_std"), F.min(x).alias(f"{i}_min"), F.max(x).alias(f"{i}_max")]
    row = df.agg(*aggs)
    parts = [F.struct(F.lit(c).alias("column_name"), F.col(f"{i}_n").alias("n"), F.col(f"{i}_mean").alias("mean"), F.col(f"{i}_std").alias("std"), F.col(f"{i}_min").alias("min"), *[F.round(F.lit(quarts[c][k]).cast("double"), 4).alias(q) for k, q in enumerate(("q1", "median", "q3"))], F.col(f"{i}_max").alias("max")) for i, c in enumerate(columns)]
    return row.select(F.explode(F.array(*parts)).alias("x")).select("x.*")


def categorical(df: DataFrame, columns: list[str], most: int = 50) -> DataFrame:
    """(column_name, distinct): columns of 2 to ``most`` distinct values."""
    # distinct hashes of (column, value) in one shuffle; several count_distinct would expand every row
    cells = F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("column_name"), *T.key128(F.col(c)))) for c in columns])
    counts = df.select(F.explode(F.array_compact(cells)).alias("x")).select("x.*").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))
    return counts.where((F.col("distinct_values") >= 2) & (F.col("distinct_values") <= most))


def years(df: DataFrame, column: str) -> DataFrame:
    """(year, n) of a date or date-like column."""
    y = F.year(F.try_to_timestamp(F.col(column).cast("string")))
    return df.select(y.alias("year")).where("year is not null").groupBy("year").agg(F.count(F.lit(1)).alias("n"))


def missing_top(df: DataFrame, k: int = 40) -> DataFrame:
    from textloom.operators.profile import missing_profile

    return missing_profile(df).where("column_name <> '*'").orderBy(F.desc("missing"), "column_name").limit(k)


def rank_within(df: DataFrame, by: str, order: list, k: int) -> DataFrame:
    """The first k rows of each group. Meant for groups known to be small, such as candidates of a tier."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)
