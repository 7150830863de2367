"""Sinks: tables, JSON objects, Markdown, review queues, models and the outputs of a collect run.

Tables go through Spark writers. JSON and Markdown are small driver-side objects and are written through the file system
of their path, so a shared folder of any kind works.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import math
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import eda, profile

#: Least sources of a finished collect run.
LEAST_SOURCES = 2


def json_safe(value: Any) -> Any:
    """A value as JSON can hold it: keys sorted as strings, dates in ISO form, NaN and infinities null, bytes as UTF-8."""
    if value is None or isinstance(value, (bool, int, str)):
        return value
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, decimal.Decimal):
        return float(value) if value.is_finite() else None
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).decode("utf-8", "replace")
    if isinstance(value, (dt.datetime, dt.date, dt.time)):
        return value.isoformat()
    if isinstance(value, dict):
        return {k: json_safe(v) for k, v in sorted(((str(k), v) for k, v in value.items()), key=lambda kv: kv[0])}
    if hasattr(value, "asDict"):
        return json_safe(value.asDict())
    if hasattr(value, "tolist"):
        return json_safe(value.tolist())
    if isinstance(value, (set, frozenset)):
        return sorted((json_safe(v) for v in value), key=str)
    if isinstance(value, Iterable):
        return [json_safe(v) for v in value]
    return str(value)


def cell(value: Any) -> str:
    """A value in a Markdown table: four places, JSON for nested ones, no line breaks or bars of its own."""
    value = json_safe(value)
    if value is None:
        return ""
    if isinstance(value, float):
        return f"{value:.4f}"
    out = json.dumps(value, ensure_ascii=False, sort_keys=True) if isinstance(value, (dict, list)) else str(value)
    return out.replace("|", "\\|").replace("\n", " ")


def markdown_table(head: list[str], rows: list[list]) -> str:
    lines = ["| " + " | ".join(map(cell, head)) + " |", "|" + " --- |" * len(head)]
    return "\n".join(lines + ["| " + " | ".join(map(cell, r)) + " |" for r in rows])


def write_text(text: str, path: str) -> str:
    """A small file, replaced in one step: written beside its place, then renamed."""
    spark = SparkSession.active()
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    beside = jvm.org.apache.hadoop.fs.Path(path + ".part")
    fs = target.getFileSystem(conf)
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(beside, target)
    return path


def write_json(value: Any, path: str) -> str:
    return write_text(json.dumps(json_safe(value), ensure_ascii=False, indent=2) + "\n", path)


def write_markdown(text: str, path: str) -> str:
    return write_text(text, path)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON and bytes as UTF-8, so that CSV can hold them."""
    nested = ("array", "map", "struct")
    return df.select(*[F.to_json(c).alias(c) if t.startswith(nested) else F.col(c).cast("string").alias(c) if t == "binary" else F.col(c) for c, t in df.dtypes])


def write_table(df: DataFrame, path: str) -> str:
    """CSV, JSON lines or Parquet, by the path's ending; Parquet for any other."""
    if path.endswith(".csv"):
        flat(df).write.mode("overwrite").csv(path, header=True, escape='"')
    elif path.endswith((".json", ".jsonl")):
        df.write.mode("overwrite").json(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return path


def harmonized(df: DataFrame, numbers: tuple[str, ...] = (), times: tuple[str, ...] = ()) -> DataFrame:
    """Mixed columns in one type: bytes as UTF-8, the named strings as numbers or times where they read as such, else null."""
    out = {c: F.col(c).cast("string") for c, t in df.dtypes if t == "binary"}
    out |= {c: T.number(F.col(c).cast("string")) for c in numbers if c in df.columns}
    out |= {c: F.try_to_timestamp(F.col(c).cast("string")) for c in times if c in df.columns}
    return df.withColumns(out) if out else df


def review_queue_file(df: DataFrame, iteration: int, path: str) -> str:
    """A queue to be labelled by hand: its round, and an empty human_label to fill in."""
    return write_table(df.withColumns({"iteration": F.lit(iteration), "human_label": F.lit("")}), path)


def write_model(model: Any, path: str) -> str:
    """A fitted pipeline in the format that Spark reads back anywhere."""
    model.write().overwrite().save(path)
    return path


def source_summary(df: DataFrame) -> DataFrame:
    """(source_id, source, source_type, rows, labelled, blank_texts) of a merged table."""
    by = ["source_id", "source", "source_type"]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(~T.missing("label")).alias("labelled"), F.count_if(T.missing("text")).alias("blank_texts"))


def finish_collect(df: DataFrame, folder: str, topic: dict | None = None) -> dict[str, str]:
    """Writes the merged table, its summary by source, exploration and a data card; a run of one source isn't finished."""
    if df.select("source_id").distinct().limit(LEAST_SOURCES).count() < LEAST_SOURCES:
        raise ValueError(f"a collect run needs at least {LEAST_SOURCES} sources")
    paths = {"merged": write_table(df, f"{folder}/merged.parquet"), "source_summary": write_table(source_summary(df), f"{folder}/source_summary.csv")}
    missing = [r.asDict() for r in profile.missing_profile(df).orderBy(F.desc("missing"), "column_name").collect()]
    top = [r.asDict() for r in eda.top_tokens(df, "text").collect()]
    lengths = eda.length_stats(df, "text").first().asDict()
    paths["exploration"] = write_json({"missing": missing, "top_tokens": top, "lengths": lengths}, f"{folder}/exploration.json")
    card = [f"# {(topic or {}).get('topic') or 'Dataset'}", "", markdown_table(["column", "missing", "percent"], [[m["column_name"], m["missing"], m["percent"]] for m in missing]), ""]
    paths["data_card"] = write_markdown("\n".join(card), f"{folder}/data_card.md")
    return paths
