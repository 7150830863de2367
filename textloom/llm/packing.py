"""Filling fixed-capacity containers with documents.

Documents are dealt by a hash into groups of about GROUP; each group is packed for each capacity by itself, so the work
is spread and linear, and a group wastes at most the gaps that one group leaves. Within a group, by large-item
matching: a document above the capacity is cut into full containers and a rest, which is an item like others. Items above
one third of the capacity are large; at most two share a container, and they are matched greedily, each, from the
largest, with the largest one that still fits. Smaller items, from the largest, go into the container with the least
gap that takes them. Gaps and items are kept by size, so packing a group takes time linear in its items and the capacity.

Documents without tokens need no container and are left out; repeated rows are items of their own; a null or
non-positive capacity is left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.tokens import FOLDER, VOCABULARY, sized
from textloom.plans.staging import stage

#: Documents of a group, on average.
GROUP = 20_000


class _Sizes:
    """A multiset of entries by integer size with the nearest size at most or at least a given one."""

    def __init__(self, most: int) -> None:
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]
        self.words = [0] * (most // 64 + 1)

    def add(self, size: int, entry: int) -> None:
        self.rows[size].append(entry)
        self.words[size >> 6] |= 1 << (size & 63)

    def pop(self, size: int) -> int:
        got = self.rows[size].pop()
        if not self.rows[size]:
            self.words[size >> 6] &= ~(1 << (size & 63))
        return got

    def at_most(self, size: int) -> int:
        """The largest size at most ``size``, or -1."""
        w = size >> 6
        bits = self.words[w] & ((2 << (size & 63)) - 1)
        while not bits:
            w -= 1
            if w < 0:
                return -1
            bits = self.words[w]
        return (w << 6) + bits.bit_length() - 1

    def at_least(self, size: int) -> int:
        """The smallest size at least ``size``, or -1."""
        w = size >> 6
        if w >= len(self.words):
            return -1
        bits = self.words[w] & ~((1 << (size & 63)) - 1)
        while not bits:
            w += 1
            if w == len(self.words):
                return -1
            bits = self.words[w]
        return (w << 6) + (bits & -bits).bit_length() - 1


def pack(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Containers as lists of (item index, start, tokens); each holds at most ``capacity`` tokens."""
    bins: list[list[tuple[int, int, int]]] = []
    items: list[tuple[int, int, int]] = []
    for i, n in enumerate(sizes):
        at = 0
        while n - at > capacity:
            bins.append([(i, at, capacity)])
            at += capacity
        if n - at == capacity:
            bins.append([(i, at, capacity)])
        elif n - at > 0:
            items.append((i, at, n - at))
    third = capacity / 3
    large = _Sizes(capacity)
    small: list[int] = []
    for k in sorted(range(len(items)), key=lambda k: (items[k][2], -k)):
        if items[k][2] > third:
            large.add(items[k][2], k)
        else:
            small.append(k)
    gaps = _Sizes(capacity)
    size = large.at_most(capacity)
    while size > 0:
        k = large.pop(size)
        box = [items[k]]
        left = capacity - size
        mate = large.at_most(left) if left > third else -1
        if mate > 0:
            box.append(items[large.pop(mate)])
            left -= mate
        gaps.add(left, len(bins))
        bins.append(box)
        size = large.at_most(capacity)
    for k in reversed(small):
        n = items[k][2]
        gap = gaps.at_least(n)
        if gap < 0:
            gaps.add(capacity - n, len(bins))
            bins.append([items[k]])
        else:
            b = gaps.pop(gap)
            bins[b].append(items[k])
            gaps.add(gap - n, b)
    return bins


PACKED = "container_kind string, capacity_tokens int, bin_group bigint, bin bigint, doc_id bigint, start_token bigint, tokens bigint"


def _pack_group(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    kind, capacity, group = pdf["container_kind"].iloc[0], int(pdf["capacity_tokens"].iloc[0]), pdf["bin_group"].iloc[0]
    pdf = pdf.sort_values(["doc_id", "tokens"])
    ids = pdf["doc_id"].to_numpy()
    bins = pack(pdf["tokens"].tolist(), capacity)
    flat = [(b, ids[i], at, n) for b, box in enumerate(bins) for i, at, n in box]
    out = np.array(flat, np.int64).reshape(-1, 4)
    return pd.DataFrame({"container_kind": kind, "capacity_tokens": np.int32(capacity), "bin_group": np.int64(group), "bin": out[:, 0], "doc_id": out[:, 1], "start_token": out[:, 2], "tokens": out[:, 3]})


def packed(documents: DataFrame, capacities: DataFrame, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """(container_kind, capacity_tokens, bin_group, bin, doc_id, start_token, tokens): each piece's container."""
    sizes = stage(sized(documents, folder, vocabulary).where("tokens > 0").select("doc_id", "tokens"), "sizes")
    groups = max(1, round(sizes.count() / GROUP))
    kinds = capacities.where("capacity_tokens > 0").select("container_kind", F.col("capacity_tokens").cast("int").alias("capacity_tokens")).distinct()
    dealt = sizes.withColumn("bin_group", F.pmod(F.xxhash64("doc_id", "tokens"), F.lit(groups)))
    # a handful of kinds: one row per document and kind
    rows = [(r[0], r[1]) for r in kinds.orderBy("container_kind", "capacity_tokens").collect()]
    if not rows:
        return dealt.sparkSession.createDataFrame([], PACKED)
    each = F.explode(F.array(*[F.struct(F.lit(k).cast("string").alias("container_kind"), F.lit(c).alias("capacity_tokens")) for k, c in rows])).alias("k")
    return dealt.select("doc_id", "tokens", "bin_group", each).select("k.*", "bin_group", "doc_id", "tokens").groupBy("container_kind", "capacity_tokens", "bin_group").applyInPandas(_pack_group, PACKED)


def report(documents: DataFrame, capacities: DataFrame, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """(container_kind, capacity_tokens, containers, tokens, fill, least_containers) of each capacity."""
    p = packed(documents, capacities, folder, vocabulary)
    by_bin = p.groupBy("container_kind", "capacity_tokens", "bin_group", "bin").agg(F.sum("tokens").alias("tokens"))
    out = by_bin.groupBy("container_kind", "capacity_tokens").agg(F.count(F.lit(1)).alias("containers"), F.sum("tokens").alias("tokens"))
    return out.select("container_kind", "capacity_tokens", "containers", "tokens", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("fill"), F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least_containers"))
