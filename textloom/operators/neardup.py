"""Near-duplicates within blocks of equal length class and beginning, compared in a sorted window."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T

#: Blocks: length in steps of STEP and the first PREFIX characters. Each text meets the next SPAN texts of its block.
STEP, PREFIX, SPAN = 40, 48, 3


def _similar(threshold: float, delta: float):
    def close(a: str, b: str) -> bool:
        n, m = len(a), len(b)
        if abs(n - m) / max(n, m) > delta:
            return False
        matcher = difflib.SequenceMatcher(a=a, b=b)
        return matcher.quick_ratio() >= threshold - 0.08 and matcher.ratio() >= threshold

    def go(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for row in pdf.itertuples(index=False):
                for i in range(SPAN):
                    b, tb = row[2 + 2 * i], row[3 + 2 * i]
                    if tb is not None and close(row[1], tb):
                        out.append((row[0], int(b)))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return go


def near_pairs(df: DataFrame, text: str = "text", row: str = "row_id", threshold: float = 0.92, delta: float = 0.25) -> DataFrame:
    """(a, b) of similar texts that stand at most SPAN apart in their block, sorted by normal text.

    Equal texts, which would fill a block, are compared through one of them; null and blank texts take no part.
    """
    norm = df.select(F.col(row).cast("bigint").alias("id"), F.regexp_replace(F.lower(T.strip(text)), r"\s+", " ").alias("t")).where(F.col("t") != "")
    reps = norm.groupBy("t").agg(F.min("id").alias("id"))
    block = reps.withColumns({"k": F.floor(F.length("t") / STEP), "p": F.substring("t", 1, PREFIX)})
    w = Window.partitionBy("k", "p").orderBy("t", "id")
    nexts = [c for i in range(1, SPAN + 1) for c in (F.lead("id", i).over(w).alias(f"b{i}"), F.lead("t", i).over(w).alias(f"t{i}"))]
    pairs = block.select(F.col("id").alias("a"), F.col("t").alias("ta"), *nexts).mapInPandas(_similar(threshold, delta), "a bigint, b bigint")
    same = norm.join(reps.withColumnRenamed("id", "a"), "t").where("id <> a").select("a", F.col("id").alias("b"))
    return pairs.union(same)


def components(pairs: DataFrame, stage) -> DataFrame:
    """(id, root): the smallest id reachable over the pairs, by spreading minima until nothing changes."""
    edges = stage(pairs.union(pairs.select("b", "a")).toDF("a", "b").distinct(), "edges")
    at = stage(edges.select(F.col("a").alias("id")).distinct().withColumn("root", F.col("id")), "roots")
    while True:
        low = edges.join(at, edges["b"] == at["id"]).groupBy(edges["a"].alias("id")).agg(F.min("root").alias("m"))
        step = at.join(low, "id", "left").select("id", F.col("root").alias("old"), F.least("root", F.coalesce("m", "root")).alias("root"))
        # halves paths: a root's own root counts as well
        up = step.select(F.col("id").alias("root"), F.col("root").alias("up"))
        new = stage(step.join(up, "root", "left").select("id", "old", F.coalesce("up", "root").alias("root")), "roots")
        at = new.select("id", "root")
        if new.where("old <> root").isEmpty():
            return at


def drop_near(df: DataFrame, text: str = "text", row: str = "row_id", threshold: float = 0.92) -> DataFrame:
    """(row_id): rows to drop, all of a cluster but the one whose id comes first as text."""
    from textloom.plans.staging import stage

    roots = components(near_pairs(df, text, row, threshold), stage)
    first = roots.groupBy("root").agg(F.min_by("id", F.struct(F.col("id").cast("string"), "id")).alias("keep"))
    return roots.join(first, "root").where("id <> keep").select(F.col("id").alias("row_id"))
