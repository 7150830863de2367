"""Exact quantiles and modes without a task that holds all values.

Each wanted rank has a bracket of values that contains it. One pass over the table counts the values of every bracket in
BINS equal bins, with the smallest and largest value met in each; the bin that holds the rank is the next bracket. A
bracket ends when its smallest and largest value are equal, which takes few passes, since bins shrink to values that
exist. Only bin counts reach the driver: at most BINS rows for each of the wanted ranks.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 512


def _number(c: Column | str) -> Column:
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(x), x)


def quantiles(df: DataFrame, columns: list[str], shares: list[float]) -> dict[str, list[float | None]]:
    """The quantiles of each numeric column by linear interpolation between neighbours; None for a column without values.

    Nulls and NaN don't count; infinite values come out as themselves where a rank falls on one.
    """
    cols = {c: f"c{i}" for i, c in enumerate(columns)}
    d = df.select(*[_number(c).alias(a) for c, a in cols.items()])
    row = d.agg(*[f(a).alias(f"{n}_{a}") for a in cols.values() for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count))]).first()
    brackets: dict[tuple[str, int], tuple[float, float, int]] = {}
    for a in cols.values():
        n = row[f"n_{a}"]
        for p in shares if n else ():
            at = p * (n - 1)
            for rank in {math.floor(at), math.ceil(at)}:
                brackets[a, rank] = (row[f"lo_{a}"], row[f"hi_{a}"], 0)
    values = {}
    while brackets:
        for key in [k for k, (lo, hi, _) in brackets.items() if lo == hi]:
            values[key] = brackets.pop(key)[0]
        if not brackets:
            break
        spans = sorted({(a, lo, hi) for (a, _), (lo, hi, _) in brackets.items()})
        parts = []
        for i, (a, lo, hi) in enumerate(spans):
            x = F.col(a)
            if math.isinf(lo) or math.isinf(hi):
                # infinite ends get bins of their own, the values between them one
                at = F.when(x == float("-inf"), 0).when(x == float("inf"), 2).otherwise(1)
            else:
                at = F.least(F.floor((x / 2 - lo / 2) / (hi / 2 - lo / 2) * BINS), F.lit(BINS - 1))
            parts.append(F.when((x >= lo) & (x <= hi), F.struct(F.lit(i).alias("span"), at.cast("int").alias("bin"), x.alias("x"))))
        long = d.select(F.explode(F.array_compact(F.array(*parts))).alias("p")).select("p.*")
        bins: dict[int, list] = {}
        for r in long.groupBy("span", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect():
            bins.setdefault(r["span"], []).append((r["bin"], r["n"], r["lo"], r["hi"]))
        order = {s: i for i, s in enumerate(spans)}
        for key, (lo, hi, before) in list(brackets.items()):
            for _, n, low, high in sorted(bins[order[key[0], lo, hi]]):
                if before + n > key[1]:
                    brackets[key] = (low, high, before)
                    break
                before += n
    out: dict[str, list[float | None]] = {}
    for c, a in cols.items():
        n = row[f"n_{a}"]
        got = []
        for p in shares:
            if not n:
                got.append(None)
                continue
            at = p * (n - 1)
            low, high = values[a, math.floor(at)], values[a, math.ceil(at)]
            got.append(low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high)
        out[c] = got
    return out


def modes(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """The commonest non-null value of each column, the smallest on ties; None for a column without values."""
    if not columns:
        return {}
    parts = []
    for i, c in enumerate(columns):
        counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(counts.agg(F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"].alias(f"v{i}")))
    row = reduce(lambda a, b: a.join(F.broadcast(b), F.lit(True)), parts).first()  # one row each
    return {c: row[f"v{i}"] for i, c in enumerate(columns)}
