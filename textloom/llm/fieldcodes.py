"""Duplicates hidden by formatting: dictionary-encoded fields.

Each distinct value is canonicalised once per task (a memo serves repeats), gets an integer code, and a record
becomes the sorted tuple of its (field, value) codes. Grouping then works on these compact tuples and never on text.
A code is the 128-bit hash of the canonical value, so all tasks agree on it without a dictionary table to exchange;
at 10^12 distinct values the chance of any clash is under 10^-14.

A record has one or two tuples: the one-field tuple of its letters and digits, and, if it is a form, the tuple of its
fields in sorted order. Two records are the same if either tuple agrees; ``same_records`` closes that relation.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.normal import normal, words
from textloom.plans.skew import join_sized
from textloom.plans.staging import spread, stage

#: A form has at least so many fields.
MIN_FIELDS = 4
#: Longer field names, in characters, make a text prose.
MAX_NAME = 80
#: Entries of the per-task memo of canonical values; it is emptied when full, which costs time and no result.
MEMO = 50_000
_SIGN = 1 << 63


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= _SIGN else x


def code(value: str) -> int:
    """The integer code of a canonical value."""
    return xxhash.xxh3_128_intdigest(value)


def canonical(value: str) -> str:
    """Letters and digits of a normal text, in order."""
    return "".join(words(value))


def _json_fields(text: str) -> list[tuple[str, str]] | None:
    try:
        pairs = json.loads(text, object_pairs_hook=list)
    except (ValueError, RecursionError):
        return None
    if not isinstance(pairs, list) or not all(isinstance(p, tuple) for p in pairs):
        return None
    return [(normal(str(k)), normal(v if isinstance(v, str) else json.dumps(v, ensure_ascii=False))) for k, v in pairs]


def _split_fields(text: str, mark: str) -> list[tuple[str, str]] | None:
    out = []
    for part in text.split(mark):
        part = part.strip()
        if not part:
            continue
        name, colon, value = part.partition(":")
        if not colon or len(name) > MAX_NAME or not words(name):
            return None
        out.append((name, value))
    return out


def form_fields(text: str, flat: str | None = None) -> list[tuple[str, str]] | None:
    """The ``name: value`` fields of a form text, normal but not yet canonical; None if the text is prose.

    Fields stand one a line, between ``|`` or ``;``, or in a JSON object; the first notation that explains the whole
    text in at least MIN_FIELDS fields counts.
    """
    stripped = text.strip("﻿​ \t\r\n")
    if stripped[:1] in "{｛" and stripped[-1:] in "}｝":
        for attempt in (stripped, normal(stripped)):
            fields = _json_fields(attempt)
            if fields is not None:
                return fields if len(fields) >= MIN_FIELDS else None
    flat = normal(text) if flat is None else flat
    if flat.count(":") < MIN_FIELDS:
        return None
    for mark in ("\n", "|", ";"):
        if mark != "\n" and mark not in flat:
            continue
        fields = _split_fields(flat, mark)
        if fields is not None and len(fields) >= MIN_FIELDS:
            return fields
    return None


class Encoder:
    """Canonicalises values through a memo and turns a text into its tuples' 128-bit keys."""

    def __init__(self) -> None:
        self.memo: dict[str, bytes] = {}

    def value(self, raw: str) -> bytes:
        got = self.memo.get(raw)
        if got is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            got = self.memo[raw] = code(canonical(raw)).to_bytes(16, "big")
        return got

    def keys(self, text: str | None, flat: str | None = None, letters: str | None = None) -> tuple[int | None, int | None]:
        """Keys of the text tuple and of the field tuple; None where there is none. ``flat`` and ``letters``: the normal and canonical text, where known."""
        if not text:
            return None, None
        flat = normal(text) if flat is None else flat
        letters = canonical(flat) if letters is None else letters
        if not letters:
            return None, None
        fields = form_fields(text, flat)
        if fields is None:
            return code(letters), None
        pairs = sorted(self.value(name) + self.value(value) for name, value in fields)
        return code(letters), xxhash.xxh3_128_intdigest(b"".join(pairs))


KEYS = pa.schema([("row_id", pa.int64()), ("t_hi", pa.int64()), ("t_lo", pa.int64()), ("f_hi", pa.int64()), ("f_lo", pa.int64())])
KEYS_DDL = "row_id bigint, t_hi bigint, t_lo bigint, f_hi bigint, f_lo bigint"


def halves(key: int | None) -> tuple[int | None, int | None]:
    """A 128-bit key as two signed 64-bit integers."""
    return (None, None) if key is None else (_signed(key >> 64), _signed(key & ((1 << 64) - 1)))


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enc = Encoder()
    for batch in batches:
        cols: list[list] = [[], [], [], [], []]
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            t, f = enc.keys(text)
            if t is None:
                continue
            for col, v in zip(cols, (row, *halves(t), *halves(f))):
                col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=KEYS)


def encoded(df: DataFrame, row: str = "row_id", text: str = "text") -> DataFrame:
    """(row_id, t_hi, t_lo, f_hi, f_lo) of each record with a letter or digit."""
    return spread(df.select(F.col(row).cast("bigint").alias("row_id"), F.col(text).alias("text"))).mapInArrow(_encode, KEYS_DDL)


def closed_keys(keys: DataFrame) -> DataFrame:
    """``keys`` (with t_hi, t_lo, f_hi, f_lo) with the closing key (k_hi, k_lo) of each record's class.

    The class of a form is named by its field tuple, of any other record by its text tuple, unless a record with the
    same letters is a form: then by that form's tuple. Where one text tuple meets several field tuples, smallest
    keys spread over the distinct (text tuple, field tuple) pairs of forms until nothing changes.
    """
    forms = keys.where(F.col("f_hi").isNotNull()).select("t_hi", "t_lo", "f_hi", "f_lo").distinct()
    forms = stage(forms, "forms")
    text_groups = forms.groupBy("t_hi", "t_lo").agg(F.min(F.struct("f_hi", "f_lo")).alias("m"), F.count(F.lit(1)).alias("n"))
    if text_groups.where("n > 1").isEmpty():
        names = text_groups.select("t_hi", "t_lo", F.col("m.f_hi").alias("c_hi"), F.col("m.f_lo").alias("c_lo"))
    else:
        names = _components(forms)
    out = keys.join(names, ["t_hi", "t_lo"], "left")
    return out.withColumn("k_hi", F.coalesce("c_hi", "t_hi")).withColumn("k_lo", F.coalesce("c_lo", "t_lo")).drop("c_hi", "c_lo")


def _components(forms: DataFrame) -> DataFrame:
    """Text tuple -> smallest field tuple reachable over shared text or field tuples."""
    at = forms.withColumn("c", F.struct("f_hi", "f_lo"))
    while True:
        by_text = at.groupBy("t_hi", "t_lo").agg(F.min("c").alias("ct"))
        step = at.join(by_text, ["t_hi", "t_lo"])
        by_form = step.groupBy("f_hi", "f_lo").agg(F.min("ct").alias("cf"))
        new = stage(step.join(by_form, ["f_hi", "f_lo"]).withColumn("changed", F.col("cf") != F.col("c")).select("t_hi", "t_lo", "f_hi", "f_lo", F.col("cf").alias("c"), "changed"), "components")
        at = new.drop("changed")
        if new.where("changed").isEmpty():
            return at.groupBy("t_hi", "t_lo").agg(F.min("c").alias("c")).select("t_hi", "t_lo", F.col("c.f_hi").alias("c_hi"), F.col("c.f_lo").alias("c_lo"))


def same_records(df: DataFrame, row: str = "row_id", text: str = "text") -> DataFrame:
    """(row_id, kept_row_id, copies) of every record whose text has a letter or digit.

    ``kept_row_id`` is the smallest row_id of the record's class and ``copies`` the class's number of rows, 1 for a
    record of its own. Null, empty and sign-only texts belong to no class and are left out; repeated row_ids count as
    rows; other columns, whatever their names, play no part; an empty table gives no rows.
    """
    keys = stage(encoded(df, row, text), "keys")
    classed = stage(closed_keys(keys).select("row_id", "k_hi", "k_lo"), "classed")
    groups = classed.groupBy("k_hi", "k_lo").agg(F.min("row_id").alias("kept_row_id"), F.count(F.lit(1)).alias("copies"))
    return join_sized(classed, groups, ["k_hi", "k_lo"], "copies", classed.count()).select("row_id", "kept_row_id", "copies")


def found(df: DataFrame) -> DataFrame:
    """(kept_row_id, row_id): the members of each class other than its smallest row_id."""
    keys = stage(encoded(df), "keys")
    classed = stage(closed_keys(keys).select("row_id", "k_hi", "k_lo"), "classed")
    groups = classed.groupBy("k_hi", "k_lo").agg(F.min("row_id").alias("kept_row_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    out = join_sized(classed, groups, ["k_hi", "k_lo"], "copies", classed.count())
    return out.where("row_id <> kept_row_id").select("kept_row_id", "row_id")


def collapsed(df: DataFrame) -> DataFrame:
    """(row_id, copies): one kept record per class with its number of copies."""
    keys = stage(encoded(df), "keys")
    classed = closed_keys(keys)
    return classed.groupBy("k_hi", "k_lo").agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("copies")).select("row_id", "copies")
