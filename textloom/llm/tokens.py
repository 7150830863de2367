"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.plans.staging import spread

#: Folder of the vocabulary files; a parameter, since they aren't part of this package.
FOLDER = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Splitting of texts into pieces before merging, as the vocabulary's publisher states it (a fixed value of the format).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoding(folder: str = FOLDER, vocabulary: str = VOCABULARY):
    """The tokenizer of a rank file."""
    import tiktoken

    with open(os.path.join(folder, vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _sizes(folder: str, vocabulary: str):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(folder, vocabulary)
        for batch in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], names=["doc_id", "source", "tokens"])

    return go


def sized(documents: DataFrame, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, tokens) of every document; null and empty texts have no tokens."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("source").cast("string").alias("source"))
    return spread(rows).mapInArrow(_sizes(folder, vocabulary), "doc_id bigint, source string, tokens bigint")
