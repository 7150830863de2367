"""Joins that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key counts as heavy from this share of the rows on, so there are at most HEAVY_KEYS of them whatever the data.
HEAVY_KEYS = 256


def join_sized(many: DataFrame, one: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Inner join of ``many`` with ``one``, which has one row per key and, in ``size``, the key's rows in ``many``.

    Keys with at least total / HEAVY_KEYS rows number at most HEAVY_KEYS, so those rows of ``one`` are broadcast
    and their rows in ``many`` never move; all other keys meet in a shuffle whose groups are bounded by that share.
    """
    bound = max(total // HEAVY_KEYS, 10_000)
    heavy = F.broadcast(one.where(F.col(size) >= bound))
    light = one.where(F.col(size) < bound)
    if total <= bound:
        return many.join(one, keys)
    return many.join(heavy, keys).unionByName(many.join(light, keys))
