"""Scoring, deduplication and ranking of candidate sources and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import urls

# Order of source types, weights of file types, good and bad parts of paths.
TYPE_ORDER = ("hf_dataset", "kaggle", "github_dataset", "http_file", "api", "scrape", "repository")
EXTENSIONS = {".parquet": 18, ".csv": 15, ".jsonl": 14, ".ndjson": 14, ".tsv": 12, ".xlsx": 10, ".xls": 8, ".json": 6, ".zip": 5}
DATA_SEGMENTS = ("data", "dataset", "datasets", "raw", "processed", "train", "test", "sample")
NOISE = ("readme", "license", "copying", "requirements", "setup.py", ".ipynb", "docs/", "doc/", "examples/", "example/", "notebooks/", "benchmark/", "/.github/", "__pycache__")
FEATURES = {"topic": 0.5, "trust": 0.2, "richness": 0.1, "modality": 0.1, "task": 0.05, "language": 0.05}


def type_rank(c: Column | str) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(t) for t in TYPE_ORDER]), x), F.lit(0)), F.lit(len(TYPE_ORDER) + 1))


def relevance(features: dict[str, Column]) -> Column:
    """Weighted sum of feature columns in 0..1, to four places."""
    return F.round(sum((F.coalesce(features[k], F.lit(0.0)) * w for k, w in FEATURES.items() if k in features), F.lit(0.0)), 4)


def keywords(c: Column | str, k: int = 12) -> Column:
    """Up to k distinct words of three or more letters, in order."""
    x = F.lower(F.col(c) if isinstance(c, str) else c)
    return F.slice(F.array_distinct(F.regexp_extract_all(x, F.lit(r"([\p{L}\p{N}]{3,})"), 1)), 1, k)


def topic_overlap(topic: Column, title: Column) -> Column:
    """Share of the topic's keywords that the title has."""
    a = keywords(topic)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, keywords(title))), F.size(a)), F.lit(0.0))


def topic_match(topic: Column, title: Column) -> Column:
    """1 if any word of the topic occurs in the title, else 0."""
    words = F.filter(F.split(F.lower(F.coalesce(topic, F.lit(""))), r"\s+"), lambda w: w != "")
    return F.exists(words, lambda w: F.contains(F.lower(F.coalesce(title, F.lit(""))), w)).cast("double")


def richness(tags: Column, described: Column) -> Column:
    """Tags and a description, six of them being full marks."""
    return F.least(F.lit(1.0), (F.greatest(F.size(tags), F.lit(0)) + described.cast("int")) / 6.0)


def dedupe(df: DataFrame) -> DataFrame:
    """The most relevant candidate per canonical URL, then per type and name."""
    best = lambda d, keys: d.groupBy(*keys).agg(F.max_by(F.struct(*d.columns), F.struct("relevance", "candidate_id")).alias("__b")).select("__b.*")
    one = best(df.withColumn("__u", F.coalesce(F.nullif(urls.canonical("url"), F.lit("")), F.col("candidate_id"))), ["__u"])
    return best(one.withColumn("__n", F.lower("name")), ["type", "__n"]).drop("__u", "__n")


def order(df: DataFrame) -> DataFrame:
    """Most relevant first, then by type and name."""
    return df.orderBy(F.desc("relevance"), type_rank("type"), "name")


def plans(df: DataFrame, size: int = 3) -> DataFrame:
    """(plan, position, candidate_id) of up to three plans of different candidates, each in the order of ranks.

    The balanced plan takes the best open set, API and scrape and fills up from the top; the open plan two open sets and an
    API; the top plan the first three. Candidates of a name count once, plans of the same candidates are given once.
    """
    tier = F.when(F.col("type").isin("hf_dataset", "kaggle", "github_dataset", "http_file"), "open").when(F.col("type") == "api", "api").otherwise("scrape")
    # candidates are few: they come from one discovery
    rank = Window.orderBy(F.desc("relevance"), type_rank("type"), "name")
    ranked = df.withColumn("tier", tier).withColumn("rank", F.row_number().over(rank)).withColumn("in_tier", F.row_number().over(Window.partitionBy("tier").orderBy("rank")))
    first = F.col("in_tier") == 1
    choices = {
        "balanced": F.when(first & (F.col("tier") == "open"), 1).when(first & (F.col("tier") == "api"), 2).when(first & (F.col("tier") == "scrape"), 3).when(F.col("rank") <= size, F.lit(size) + F.col("rank")),
        "open": F.when((F.col("tier") == "open") & (F.col("in_tier") <= 2), F.col("in_tier")).when(first & (F.col("tier") == "api"), 3),
        "top": F.when(F.col("rank") <= size, F.col("rank")),
    }
    offered = F.explode(F.array(*[F.struct(F.lit(i).alias("no"), F.lit(n).alias("plan"), c.alias("turn")) for i, (n, c) in enumerate(choices.items())])).alias("o")
    taken = ranked.select("candidate_id", "rank", F.lower("name").alias("name"), offered).select("candidate_id", "rank", "name", "o.*").where("turn is not null")
    once = taken.withColumn("again", F.row_number().over(Window.partitionBy("no", "name").orderBy("turn"))).where("again = 1")
    kept = once.withColumn("turn", F.row_number().over(Window.partitionBy("no").orderBy("turn"))).where(F.col("turn") <= size)
    whole = kept.groupBy("no", "plan").agg(F.array_sort(F.collect_list(F.struct("rank", "candidate_id"))).alias("those"))
    new = whole.groupBy("those").agg(F.min(F.struct("no", "plan")).alias("p"))
    return new.select("p.plan", F.posexplode("those").alias("position", "c")).select("plan", (F.col("position") + 1).alias("position"), "c.candidate_id")


def file_score(path: Column | str, size: Column | str) -> Column:
    """Rank of a file as the main table: type, folder, noise words and size."""
    p = F.lower(F.col(path) if isinstance(path, str) else path)
    n = F.coalesce(F.col(size) if isinstance(size, str) else size, F.lit(0))
    ext = F.regexp_extract(p, r"(\.[a-z0-9]+)$", 1)
    by_type = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in EXTENSIONS.items() for x in kv]), ext), F.lit(0))
    segments = sum((F.concat(F.lit("/"), p, F.lit("/")).contains(f"/{s}/").cast("int") * 14 for s in DATA_SEGMENTS), F.lit(0))
    noise = sum((p.contains(s).cast("int") * 85 for s in NOISE), F.lit(0))
    small = F.when((n > 0) & (n < 512), 40).when((n > 0) & (n < 4096), 12).otherwise(0)
    return (segments + by_type - noise - small + F.least(F.floor(n / 800), F.lit(3500))).cast("bigint")


def executable(df: DataFrame) -> DataFrame:
    """Sources that a reader can run: enabled, with what their type requires."""
    need = (
        F.when(F.col("type").isin("hf_dataset", "kaggle"), F.coalesce("dataset_id", "name").isNotNull())
        .when(F.col("type").isin("github_dataset", "repository"), F.col("repo_url").isNotNull())
        .when(F.col("type") == "api", F.col("endpoint").isNotNull())
        .otherwise(F.col("url").isNotNull())
    )
    return df.where(F.coalesce("enabled", F.lit(True)) & need)
