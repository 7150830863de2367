"""The pN_ queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import bagminhash, boilerplate, fieldcodes, langid, mixing, overlap, packing, pii, readability, sql
from textloom.session import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(_table(spark, sf_dir, "merged_dataset"))


def p1_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redacted(_table(spark, sf_dir, "merged_dataset"))


def _language_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [_table(spark, sf_dir, t) for t in ("merged_dataset", "sources", "topic_profiles")]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.found(*_language_tables(spark, sf_dir))


def p2_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.labelled_segments(*_language_tables(spark, sf_dir))[0]


def p2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.by_record(*_language_tables(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.found(_table(spark, sf_dir, "merged_dataset"))


def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.linked(_table(spark, sf_dir, "merged_dataset"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.found(_table(spark, sf_dir, "merged_dataset"))


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.report(_table(spark, sf_dir, "merged_dataset"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.found(_table(spark, sf_dir, "merged_dataset"))


def p5_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.main_text(_table(spark, sf_dir, "merged_dataset"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fieldcodes.found(_table(spark, sf_dir, "merged_dataset"))


def p6_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fieldcodes.collapsed(_table(spark, sf_dir, "merged_dataset"))


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pack_capacities"))


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pack_capacities"))


def p8_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readability.found(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "reading_labels"))


def p9_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readability.grades(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "reading_labels"))


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readability.by_source(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "reading_labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[:1] == "p" and k[1:2].isdigit() and callable(v)}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
