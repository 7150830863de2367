"""Files as DataFrames: format detection, readers, selection of the main file, staged archives."""

from __future__ import annotations

import fnmatch
import re
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Suffixes, MIME types, and the words that tell data files from others.
SUFFIXES = {".csv": "csv", ".tsv": "tsv", ".json": "json", ".jsonl": "jsonl", ".ndjson": "jsonl", ".parquet": "parquet", ".xls": "excel", ".xlsx": "excel"}
MIME = {"text/csv": "csv", "application/json": "json", "application/x-ndjson": "jsonl", "application/jsonl": "jsonl", "text/tab-separated-values": "tsv", "application/vnd.apache.parquet": "parquet"}
FOLDERS = ("data", "dataset", "datasets", "raw", "processed")
SPLITS = ("train", "test", "sample")
NAMES = ("data", "dataset", "records", "matches", "samples", "train", "test")
BAD = ("readme", "license", "copying", "schema", "dictionary", "metadata", "changelog", "contributing", "notice", "sample_submission", "__macosx")
WEIGHTS = {".parquet": 16, ".csv": 14, ".jsonl": 13, ".tsv": 10, ".xlsx": 9, ".xls": 7, ".json": 5}
TINY, SMALL = 384, 2048


def detect_format(path: str, explicit: str | None = None, disposition: str | None = None, content_type: str | None = None) -> str | None:
    """Explicit format, else the suffix, else the name in a content disposition, else the MIME type."""
    if explicit:
        return {"ndjson": "jsonl"}.get(explicit.lower(), explicit.lower())
    got = SUFFIXES.get(Path(path).suffix.lower())
    if got:
        return got
    m = re.search(r'filename="?([^";]+)', disposition or "")
    if m and (got := SUFFIXES.get(Path(m.group(1)).suffix.lower())):
        return got
    return MIME.get((content_type or "").split(";")[0].strip().lower())


def looks_like_html(head: bytes) -> bool:
    """A doctype or html tag among the first bytes."""
    start = head[:1200].decode("utf-8", "replace").lstrip().lower()
    return start.startswith(("<!doctype html", "<html")) or "<html" in start


def score(path: Path, root: Path | None = None) -> tuple[int, int, int, int]:
    """Rank of a file as the main table: folder and name words, type, size; noise words and tiny files count against."""
    text = (path.relative_to(root) if root else path).as_posix().lower()
    name = path.name.lower()
    size = path.stat().st_size if path.exists() else 0
    s = 22 * sum(f"/{g}/" in f"/{text}" for g in FOLDERS) + 10 * sum(g in text for g in SPLITS) + 6 * sum(g in name for g in NAMES) + WEIGHTS.get(path.suffix.lower(), 0)
    s -= 120 * sum(b in text for b in BAD)
    s -= 90 if size < TINY else 25 if size < SMALL else 0
    return s + min(size // 512, 4000), size, -len(path.parts), -len(path.name)


def candidates(path: str | Path) -> list[Path]:
    """Readable files of a file, a folder or an archive that was unpacked beside it."""
    p = Path(path)
    if p.is_file() and p.suffix.lower() == ".zip":
        return candidates(unpack(p, p.with_suffix("")))
    if p.is_file():
        return [p]
    return sorted(x for x in p.rglob("*") if x.is_file() and x.suffix.lower() in SUFFIXES)


def unpack(archive: Path, target: Path) -> Path:
    """Archive members under the target; members that would leave it raise."""
    root = target.resolve()
    with zipfile.ZipFile(archive) as z:
        for m in z.namelist():
            if not (root / m).resolve().is_relative_to(root):
                raise ValueError(f"archive member outside the target: {m}")
        z.extractall(root)
    return target


def select(files: list[Path], patterns: list[str] | None = None) -> list[Path]:
    """Files that match a pattern, in order, or the one of the best score."""
    if patterns:
        return sorted(f for f in files if any(fnmatch.fnmatch(f.as_posix(), p) or fnmatch.fnmatch(f.name, p) for p in patterns))
    return [max(files, key=score)] if files else []


def read_one(spark: SparkSession, path: str, fmt: str | None = None, limit: int | None = None) -> DataFrame:
    """A file or folder of one format. CSV types are inferred from a first pass; JSON lines and arrays both work."""
    fmt = detect_format(path, fmt)
    if fmt in ("csv", "tsv"):
        df = spark.read.csv(path, header=True, sep="\t" if fmt == "tsv" else ",", multiLine=True, escape='"', inferSchema=True)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "json":
        df = spark.read.json(path, multiLine=True)
        lists = [c for c, t in df.dtypes if t.startswith("array<struct")]
        if len(lists) == 1 and len(df.columns) <= 4:
            df = df.select(F.inline(lists[0]))
    elif fmt == "jsonl":
        df = spark.read.json(path)
    elif fmt == "excel":
        import pandas as pd

        df = spark.createDataFrame(pd.read_excel(path).astype(object).where(lambda x: x.notna(), None))
    else:
        raise ValueError(f"unknown file format: {path}")
    return df.limit(limit) if limit is not None else df


def read_many(spark: SparkSession, paths: list[str], fmt: str | None = None, limit: int | None = None) -> DataFrame:
    """UNION ALL by name of several files, with their names where there are more than one."""
    if not paths:
        raise ValueError("no files")
    frames = [read_one(spark, p, fmt) for p in paths]
    if len(frames) > 1:
        frames = [f.withColumn("__source_file__", F.lit(Path(p).name)) for f, p in zip(frames, paths)]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.limit(limit) if limit is not None else out


def write(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Parquet, or CSV and JSON lines with nested values as JSON."""
    if fmt == "csv":
        df = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])
        df.write.mode("overwrite").csv(path, header=True, escape='"')
    elif fmt == "jsonl":
        df.write.mode("overwrite").json(path)
    else:
        df.write.mode("overwrite").parquet(path)
