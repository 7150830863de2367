"""Mixing sources to target weights by capped water-filling.

Each mix names sources, weights and the most repeats of each. With a budget of tokens (by default all tokens of the
mix's sources, once), every source gets its weight's share; a source that would need more than its cap (repeats x its
tokens) is clamped to the cap, and what it can't take goes to the others in proportion to their weights, until all
fit. A source's epochs, its tokens over its size, then tell how its documents repeat: all of them floor(epochs)
times, and a seeded sample that makes up the rest, by hash order, up to the document that reaches it.

The sample is cut in two steps, so no source's documents meet in one task: token sums of SLICES slices of the hash
range tell the slice in which the rest is reached, and only that slice is put in order.

Sources without documents get nothing and their weight goes to the others; documents of sources that no mix lists are
left out; null sources belong to no mix; null weights count as 0 and null repeats as 1; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.tokens import FOLDER, VOCABULARY, sized
from textloom.plans.staging import stage

#: Seed of the sample, and slices of a source's hash range.
SEED, SLICES = 17, 4096


def water_fill(weights: list[float], caps: list[float], budget: float) -> list[float]:
    """Amounts that sum to the budget, or to all caps if that is less, in proportion to the weights below the caps."""
    amounts = [0.0] * len(weights)
    free = {i for i, w in enumerate(weights) if w > 0 and caps[i] > 0}
    left = min(budget, sum(caps[i] for i in free))
    while free and left > 0:
        total = sum(weights[i] for i in free)
        over = [i for i in sorted(free) if left * weights[i] / total >= caps[i]]
        if not over:
            for i in free:
                amounts[i] = left * weights[i] / total
            break
        for i in over:
            amounts[i] = float(caps[i])
            left -= caps[i]
            free.discard(i)
    return amounts


def plan(sizes: DataFrame, targets: DataFrame, budget: float | None = None) -> list[dict]:
    """One entry per mix and source: size, target share, amount and epochs. Mix tables are small and fixed."""
    totals = {r["source"]: r["tokens"] for r in sizes.join(targets.select("source").distinct(), "source", "left_semi").groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}
    mixes: dict[str, dict[str, list]] = {}
    for r in targets.where("mix_id is not null and source is not null").orderBy("mix_id", "source", "target_share", "max_repeats").collect():
        entry = mixes.setdefault(r["mix_id"], {}).setdefault(r["source"], [0.0, 0])
        entry[0] += max(r["target_share"] or 0.0, 0.0)
        entry[1] = max(entry[1], 1 if r["max_repeats"] is None else r["max_repeats"])
    out = []
    for mix, sources in mixes.items():
        names = list(sources)
        size = [totals.get(s) or 0 for s in names]
        weights = [sources[s][0] for s in names]
        amounts = water_fill(weights, [float(n * sources[s][1]) for n, s in zip(size, names)], budget or float(sum(size)))
        for s, n, w, a in zip(names, size, weights, amounts):
            out.append({"mix_id": mix, "source": s, "size": int(n), "target_share": w / (sum(weights) or 1.0), "max_repeats": sources[s][1], "amount": a, "epochs": a / n if n else 0.0})
    return out


PLAN = "mix_id string, source string, size bigint, target_share double, max_repeats int, amount double, epochs double"


def mixed(documents: DataFrame, targets: DataFrame, budget: float | None = None, seed: int = SEED, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """(mix_id, source, doc_id, tokens, repeats): every document that a mix takes, and how often."""
    return _mixed(stage(sized(documents, folder, vocabulary).where("tokens > 0"), "mix_sizes"), targets, budget, seed)[0]


def _mixed(sizes: DataFrame, targets: DataFrame, budget: float | None, seed: int) -> tuple[DataFrame, DataFrame]:
    spark = sizes.sparkSession
    entries = plan(sizes, targets, budget)
    plans = spark.createDataFrame([tuple(e.values()) for e in entries], PLAN)
    # mixes and sources are a fixed handful
    taken = F.broadcast(plans.where("amount > 0").select("mix_id", "source", F.floor("epochs").cast("int").alias("whole"), ((F.col("epochs") - F.floor("epochs")) * F.col("size")).alias("rest")))
    h = F.xxhash64(F.lit(seed), "mix_id", "doc_id")
    rows = sizes.join(taken, "source").select("mix_id", "source", "doc_id", "tokens", "whole", "rest", h.alias("h"), F.pmod(h, F.lit(SLICES)).cast("int").alias("slice"))
    rows = stage(rows, "mix_rows")
    # cumulated sums over at most SLICES slices of each mix and source
    sums = rows.groupBy("mix_id", "source", "slice").agg(F.sum("tokens").alias("n"), F.first("rest").alias("rest"))
    w = Window.partitionBy("mix_id", "source").orderBy("slice")
    edges = sums.withColumn("upto", F.sum("n").over(w)).withColumn("before", F.col("upto") - F.col("n"))
    edges = stage(edges.select("mix_id", "source", "slice", "before", F.when(F.col("upto") <= F.col("rest"), "in").when(F.col("before") >= F.col("rest"), "out").otherwise("cut").alias("state")), "mix_edges")
    at = rows.join(edges, ["mix_id", "source", "slice"])
    # only the slice in which the rest is reached is put in order: a share of 1 / SLICES of its source
    inner = Window.partitionBy("mix_id", "source").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    cut = at.where("state = 'cut'").withColumn("extra", (F.col("before") + F.coalesce(F.sum("tokens").over(inner), F.lit(0)) + F.col("tokens") / 2 <= F.col("rest")).cast("int"))
    plain = at.where("state <> 'cut'").withColumn("extra", (F.col("state") == "in").cast("int"))
    cols = ["mix_id", "source", "doc_id", "tokens", (F.col("whole") + F.col("extra")).alias("repeats")]
    out = plain.select(*cols).unionByName(cut.select(*cols)).where("repeats > 0")
    return out, plans


def report(documents: DataFrame, targets: DataFrame, budget: float | None = None, seed: int = SEED, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """(mix_id, source, available_tokens, max_repeats, target_share, planned_share, actual_tokens, actual_share, actual_repeats)."""
    sizes = stage(sized(documents, folder, vocabulary).where("tokens > 0"), "mix_sizes")
    out, plans = _mixed(sizes, targets, budget, seed)
    got = out.groupBy("mix_id", "source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("actual_tokens"))
    mix = Window.partitionBy("mix_id")
    joined = plans.join(got, ["mix_id", "source"], "left").withColumn("actual_tokens", F.coalesce("actual_tokens", F.lit(0)))
    share = lambda c: F.round(F.col(c) / F.greatest(F.lit(1), F.sum(c).over(mix)), 6)
    return joined.select(
        "mix_id", "source", F.col("size").alias("available_tokens"), "max_repeats", F.round("target_share", 6).alias("target_share"), share("amount").alias("planned_share"),
        "actual_tokens", share("actual_tokens").alias("actual_share"), F.round(F.col("actual_tokens") / F.greatest(F.lit(1), F.col("size")), 6).alias("actual_repeats"),
    )
