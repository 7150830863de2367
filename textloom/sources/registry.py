"""Connectors: what a source spec needs, and a reader per type.

Remote types read what was staged in a local or shared folder (``spec['path']``); this engine makes no network calls.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.schema import map_fields
from textloom.sources import files
from textloom.sources.json_records import explode_records

# Fields of which each type needs one.
REQUIRED = {
    "hf_dataset": ("dataset_id", "name"),
    "kaggle": ("dataset_id", "name"),
    "github_dataset": ("repo_url",),
    "repository": ("repo_url",),
    "http_file": ("url",),
    "api": ("endpoint",),
    "scrape": ("url",),
    "file": ("path",),
}

Reader = Callable[[SparkSession, dict], DataFrame]


def validate(spec: dict) -> list[str]:
    """Problems of a spec; none if it can be read."""
    kind = spec.get("type")
    if kind not in REQUIRED:
        return [f"unknown source type: {kind}"]
    out = [] if any(spec.get(f) for f in REQUIRED[kind]) else [f"{kind} needs one of: {', '.join(REQUIRED[kind])}"]
    if kind == "scrape" and not (spec.get("selector") or spec.get("scraper_spec") or spec.get("content_mode") == "json"):
        out.append("scrape needs a selector, a scraper spec or JSON mode")
    return out


def can_execute(spec: dict) -> tuple[bool, str]:
    problems = validate(spec)
    if problems:
        return False, problems[0]
    if not spec.get("path"):
        return False, "nothing staged for this source: set path"
    return True, ""


def split_of(names: list[str], wanted: str | None) -> str:
    """The wanted split, else train, else the first."""
    if wanted:
        return wanted.split("[")[0]
    return "train" if "train" in names else names[0]


def _staged(spark: SparkSession, spec: dict) -> DataFrame:
    found = files.select(files.candidates(spec["path"]), spec.get("file_patterns"))
    return files.read_many(spark, [str(f) for f in found], spec.get("format"))


def _payloads(spark: SparkSession, spec: dict) -> DataFrame:
    pages = spark.read.text(spec["path"], wholetext=True)
    return explode_records(pages, "value", spec.get("response_path"), spec.get("fields") or {"id": "string", "text": "string"})


class Registry:
    """Readers by source type."""

    def __init__(self) -> None:
        self.readers: dict[str, Reader] = {k: _staged for k in REQUIRED} | {"api": _payloads}

    def register(self, kind: str, reader: Reader) -> None:
        self.readers[kind] = reader

    def get(self, kind: str) -> Reader:
        if kind not in self.readers:
            raise LookupError(f"no reader for {kind}; there are: {', '.join(sorted(self.readers))}")
        return self.readers[kind]

    def collect(self, spark: SparkSession, spec: dict) -> DataFrame:
        """The source's rows, fields mapped, at most sample_size of them."""
        ok, why = can_execute(spec)
        if not ok:
            raise ValueError(why)
        df = map_fields(self.get(spec["type"])(spark, spec), spec.get("field_map"), spec.get("label_map"))
        if df.isEmpty():
            raise ValueError("the source is empty")
        return df.limit(spec["sample_size"]) if spec.get("sample_size") else df


def staged_metadata(df: DataFrame) -> DataFrame:
    """Rows with the file they came from."""
    return df.select("*", F.col("_metadata.file_name").alias("__source_file__"))
