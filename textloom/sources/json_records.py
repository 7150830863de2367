"""Records inside JSON payloads, reached by a dotted path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def records(payload: Column, path: str | None = None) -> Column:
    """array<variant> of the objects at the path: a list's objects, or a single object; null where the path is missing."""
    v = F.try_parse_json(payload)
    at = F.try_variant_get(v, "$" + "".join(f".{p}" for p in path.split(".")) if path else "$", "variant")
    as_list = F.try_variant_get(at, "$", "array<variant>")
    is_object = lambda x: F.startswith(F.schema_of_variant(x), F.lit("OBJECT"))
    return F.when(as_list.isNotNull(), F.filter(as_list, is_object)).when(is_object(at), F.array(at))


def explode_records(df: DataFrame, column: str, path: str | None, fields: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """One row per record with typed fields; payloads without the path give none."""
    x = df.select(*(keep or []), F.explode(records(F.col(column), path)).alias("__r"))
    return x.select(*(keep or []), *[F.try_variant_get("__r", f"$.{name}", kind).alias(name) for name, kind in fields.items()])
