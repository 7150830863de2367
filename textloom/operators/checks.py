"""Assertions on tables: counts of what is wrong, lists of issues, and guards that raise.

Each check is one aggregation over the table, however many conditions it tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.schema import CONTRACT

#: Least share of rows with a text that annotation accepts, and least rows and classes that training accepts.
LEAST_TEXTS, LEAST_ROWS, LEAST_LABELS = 0.05, 2, 2


def usable(c: str | Column) -> Column:
    """Neither null nor blank nor the word nan."""
    x = F.col(c) if isinstance(c, str) else c
    return ~T.missing(x) & (F.lower(T.strip(x)) != "nan")


def has_number(c: str | Column) -> Column:
    """Whether a string cell reads as a number; true and false don't."""
    return T.number(c).isNotNull()


def facts(df: DataFrame, row: str = "id", text: str = "text", label: str = "label") -> DataFrame:
    """(check, n): rows, repeated and null ids, null texts and labels, blank texts, usable labels, labels that occur.

    A column that the table lacks counts as null in every row.
    """
    have = set(df.columns)
    col = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
    d = df.select(col(row).alias("r"), col(text).alias("t"), col(label).alias("l"))
    one = d.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("r").isNull()).alias("null_ids"),
        F.count_if(F.col("t").isNull()).alias("null_texts"),
        F.count_if(T.blank("t")).alias("blank_texts"),
        F.count_if(F.col("l").isNull()).alias("null_labels"),
        F.count_if(usable("l")).alias("usable_labels"),
    )
    names = one.columns
    long = one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("n")) for n in names])).alias("x")).select("x.*")
    repeated = d.where("r is not null").groupBy("r").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
    labels = d.where(usable("l")).select(T.strip("l").alias("l")).distinct().agg(F.count(F.lit(1)).alias("n"))
    return long.unionByName(repeated.select(F.lit("repeated_ids").alias("check"), "n")).unionByName(labels.select(F.lit("labels").alias("check"), "n"))


def _all_null(df: DataFrame, columns: list[str]) -> dict[str, bool]:
    have = [c for c in columns if c in df.columns]
    if not have:
        return {}
    row = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in have]).first()
    return {c: not row[c] for c in have}


def canonical_issues(df: DataFrame, need_text: bool = True) -> list[str]:
    """What keeps a table from being a canonical sample: no rows, no text, no provenance."""
    if df.isEmpty():
        return ["no rows"]
    if "text" not in df.columns:
        return ["no text column"]
    issues = ["no text with content"] if need_text and df.where(~T.missing("text")).isEmpty() else []
    return issues + [f"{c} is null in all rows" for c, none in _all_null(df, ["source", "collected_at"]).items() if none]


def contract_issues(df: DataFrame, columns: tuple[str, ...] = CONTRACT) -> list[str]:
    """What a merged table lacks of the contract."""
    lacking = [c for c in columns if c not in df.columns]
    issues = ["missing columns: " + ", ".join(lacking)] if lacking else []
    if df.isEmpty():
        return [*issues, "no rows"]
    issues += [f"{c} is null in all rows" for c, none in _all_null(df, ["source", "source_type"]).items() if none]
    if "text" not in df.columns or df.where(~T.missing("text")).isEmpty():
        issues.append("no text with content")
    return issues


def schema_issues(df: DataFrame, expected: list[str], most_null: float = 0.5) -> list[str]:
    """Expected columns that are missing, or null in more than a share of the rows."""
    from textloom.operators.profile import null_shares

    out = []
    for r in null_shares(df, expected).collect():
        if not r["present"]:
            out.append(f"missing column: {r['column_name']}")
        elif r["null_share"] is not None and r["null_share"] > most_null:
            out.append(f"{r['column_name']} is null in {r['null_share']:.0%} of the rows")
    return out


def check_annotatable(df: DataFrame, text: str = "text", strict: bool = True) -> DataFrame:
    """``df``, or an error where it has no such column, no rows, or (strict) next to no texts."""
    if text not in df.columns:
        raise ValueError(f"there is no column {text!r}; there are {', '.join(df.columns)}")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(~T.missing(text)).alias("filled")).first()
    if not row["n"]:
        raise ValueError("there are no rows to annotate")
    if strict and row["filled"] < LEAST_TEXTS * row["n"]:
        raise ValueError(f"{text!r} has content in {row['filled']} of {row['n']} rows, which is too few to annotate")
    return df


def check_pool(df: DataFrame, row: str = "row_id", text: str = "text", label: str | None = None, name: str = "table") -> DataFrame:
    """``df``, or an error where ids repeat or are null, texts are null, or, with ``label``, labels are null or of one class."""
    for c in (row, text, *([label] if label else [])):
        if c not in df.columns:
            raise ValueError(f"{name} has no column {c!r}")
    got = {r["check"]: r["n"] for r in facts(df, row, text, label or "label").collect()}
    wrong = [f"{got[k]} {what}" for k, what in (("repeated_ids", "repeated ids"), ("null_ids", "null ids"), ("null_texts", "null texts"), *([("null_labels", "null labels")] if label else [])) if got[k]]
    if wrong:
        raise ValueError(f"{name} has " + ", ".join(wrong))
    if label and got["rows"] and got["labels"] < LEAST_LABELS:
        raise ValueError(f"{name} has fewer than two labels")
    return df


def trainable(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows with a label, stripped; fewer than two are an error."""
    rows = df.where(~T.missing(label)).withColumn(label, T.strip(label))
    if rows.limit(LEAST_ROWS).count() < LEAST_ROWS:
        raise ValueError("training needs two labelled rows at least")
    return rows
