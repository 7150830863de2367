"""Schema mapping of sources into the unified text contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T

# The contract and the names under which sources deliver its fields.
CONTRACT = ("id", "text", "target_text", "title", "body", "label", "source", "source_type", "source_url", "collected_at", "metadata")
CORE = (*CONTRACT, "audio", "image", "source_id", "record_hash")
TEXT_NAMES = ("prompt", "text", "content", "description", "sentence", "input", "utterance")
LABEL_NAMES = ("label", "y", "target", "labels", "winner_name", "human_label", "final_label", "auto_label", "class", "category")
AUDIO_NAMES = ("audio", "audio_path", "audio_url", "speech", "wav")
IMAGE_NAMES = ("image", "image_url", "img", "photo", "picture")
ID_NAMES = ("id", "_id", "uuid", "row_id", "pk", "record_id", "sample_id", "annotation_id", "thread_id")
INSTRUCTIONS = ("text", "instructions", "instruction", "prompt", "input", "question")
ANSWERS = ("target_text", "outputs", "output", "response", "answer", "completion")
USER_ROLES = ("user", "human", "question")
ASSISTANT_ROLES = ("assistant", "gpt", "model", "agent", "answer")
PROVENANCE = ("source", "source_type", "source_url", "source_id", "collected_at", "id", "record_hash", "metadata")


def map_fields(df: DataFrame, field_map: dict[str, str] | None = None, label_map: dict | None = None) -> DataFrame:
    """Unified columns copied from a source's columns; label values replaced, those without an entry kept."""
    for unified, source in (field_map or {}).items():
        if source in df.columns:
            df = df.withColumn(unified, F.col(source))
    if label_map and "label" in df.columns:
        pairs = [F.lit(str(x)) for kv in label_map.items() for x in kv]
        key = F.col("label").cast("string")
        df = df.withColumn("label", F.coalesce(F.try_element_at(F.create_map(*pairs), key), key))
    return df


def with_contract(df: DataFrame, columns: tuple[str, ...] = CONTRACT) -> DataFrame:
    """Missing contract columns added as null (metadata as an empty object), contract first, others after in order."""
    add = {c: F.lit("{}") if c == "metadata" else F.lit(None).cast("timestamp" if c == "collected_at" else "string") for c in columns if c not in df.columns}
    df = df.withColumns(add) if add else df
    return df.select(*columns, *[c for c in df.columns if c not in columns])


def first_named(columns: list[str], names: tuple[str, ...]) -> str | None:
    """The first column, in the table's order, whose name is one of ``names``."""
    return next((c for c in columns if c.strip().lower() in names), None)


def fill_aliases(df: DataFrame) -> DataFrame:
    """text, label, audio and image taken from their other names where the column is absent or has no value at all."""
    for target, names in (("text", TEXT_NAMES), ("label", LABEL_NAMES), ("audio", AUDIO_NAMES), ("image", IMAGE_NAMES)):
        other = first_named([c for c in df.columns if c != target], names)
        if other is None:
            continue
        if target not in df.columns or df.where(F.col(target).isNotNull()).isEmpty():
            df = df.withColumn(target, F.col(other).cast("string"))
    return df


def fill_from_title_body(df: DataFrame) -> DataFrame:
    """Blank texts become title and body, as far as they have content, with a blank line between."""
    joined = F.concat_ws("\n\n", T.empty_to_null("title"), T.empty_to_null("body"))
    return df.withColumn("text", F.when(T.missing("text"), joined).otherwise(F.col("text")))


def metadata_json(c: Column | str) -> Column:
    """A JSON object string: objects as they are, blanks as {}, other JSON under value, other text under raw."""
    x = F.col(c) if isinstance(c, str) else c
    parsed = F.try_parse_json(x)
    is_object = F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT"))
    return F.when(T.missing(x), "{}").when(parsed.isNull(), F.to_json(F.struct(x.alias("raw")))).when(is_object, x).otherwise(F.to_json(F.struct(x.alias("value"))))


MESSAGES = "array<struct<role string, from string, speaker string, content string, value string, text string>>"
PARTS = "array<string>"


def content_text(c: Column) -> Column:
    """The text of a turn's content: itself, or, for a list, its parts (strings, or objects with a text) joined by lines."""
    parts = F.from_json(c, PARTS)
    said = F.transform(parts, lambda p: F.coalesce(F.get_json_object(p, "$.text"), F.get_json_object(p, "$.content"), F.when(~p.startswith("{"), p)))
    whole = F.array_join(F.filter(F.transform(said, T.empty_to_null), lambda x: x.isNotNull()), "\n")
    return T.empty_to_null(F.when(T.strip(c).startswith("[") & parts.isNotNull(), whole).otherwise(c))


def literal_json(c: Column) -> Column:
    """JSON as it is; a chat written as a Python literal, with single quotes and None, as JSON where that makes it valid."""
    fixed = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
    quoted = F.regexp_replace(fixed, r"(?<=[\[{,:]\s{0,3})'((?:[^'\\\\]|\\\\.)*)'(?=\s{0,3}[\]},:])", '"$1"')
    return F.when(F.try_parse_json(c).isNotNull(), c).when(F.try_parse_json(quoted).isNotNull(), quoted).otherwise(c)


def chat_texts(messages: Column) -> Column:
    """struct(text, target_text, reason) of a chat: user turns and assistant turns, each joined by blank lines.

    ``messages`` is a JSON string of turns. Turns of other roles are read over but make the chat a known one.
    """
    messages = literal_json(messages)
    blank = T.missing(messages) | F.lower(T.strip(messages)).isin("null", "none", "[]", "{}")
    turns = F.from_json(messages, MESSAGES)
    role = lambda t: F.lower(T.strip(F.coalesce(t["role"], t["from"], t["speaker"])))
    body = lambda t: content_text(F.coalesce(t["content"], t["value"], t["text"]))
    said = lambda roles: F.array_join(F.transform(F.filter(turns, lambda t: role(t).isin(*roles) & body(t).isNotNull()), body), "\n\n")
    user, assistant = T.empty_to_null(said(USER_ROLES)), T.empty_to_null(said(ASSISTANT_ROLES))
    known = F.exists(turns, lambda t: role(t).isNotNull())
    reason = (
        F.when(blank, "missing_messages")
        .when(F.try_parse_json(messages).isNull(), "malformed_messages")
        .when(turns.isNull() | ~F.coalesce(known, F.lit(False)), "unsupported_message_schema")
        .when(user.isNull(), "empty_user_content")
    )
    return F.struct(F.when(reason.isNull(), user).alias("text"), F.when(reason.isNull(), assistant).alias("target_text"), reason.alias("reason"))


def route(df: DataFrame) -> DataFrame:
    """text, target_text and drop_reason of each row: its own text, else its chat, else its instruction and answer.

    Rows with neither keep a null text, which title and body may still fill, unless instruction columns exist
    (``empty_instruction``) or other payload does (``unsupported_record_schema``).
    """
    have = set(df.columns)
    none = F.lit(None).cast("string")
    own = T.empty_to_null("text") if "text" in have else none
    kept = F.col("text").cast("string") if "text" in have else none
    target = F.col("target_text").cast("string") if "target_text" in have else none
    asked_in = [c for c in INSTRUCTIONS if c in have]
    asked = F.coalesce(*[T.empty_to_null(F.col(c).cast("string")) for c in asked_in], none)
    answered = F.coalesce(*[T.empty_to_null(F.col(c).cast("string")) for c in ANSWERS if c in have], none)
    chat = chat_texts(F.col("messages")) if "messages" in have else F.struct(none.alias("text"), none.alias("target_text"), F.lit("missing_messages").alias("reason"))
    has_chat = (chat["reason"].isNull() | (chat["reason"] != "missing_messages")) if "messages" in have else F.lit(False)
    blank_instruction = F.lit(bool(set(asked_in) - {"text"}))
    out = (
        F.when(own.isNotNull(), F.struct(kept.alias("text"), target.alias("target_text"), none.alias("drop_reason")))
        .when(has_chat, F.struct(chat["text"].alias("text"), chat["target_text"].alias("target_text"), chat["reason"].alias("drop_reason")))
        .when(asked.isNotNull(), F.struct(asked.alias("text"), answered.alias("target_text"), none.alias("drop_reason")))
        .when(blank_instruction, F.struct(none.alias("text"), none.alias("target_text"), F.lit("empty_instruction").alias("drop_reason")))
        .when(answered.isNotNull(), F.struct(none.alias("text"), none.alias("target_text"), F.lit("unsupported_record_schema").alias("drop_reason")))
        .otherwise(F.struct(none.alias("text"), target.alias("target_text"), none.alias("drop_reason")))
    )
    return df.withColumn("__routed", out).withColumns({"text": F.col("__routed.text"), "target_text": F.col("__routed.target_text"), "drop_reason": F.col("__routed.drop_reason")}).drop("__routed")


def raw_metadata(df: DataFrame, fields: tuple[str, ...] = ("messages", *INSTRUCTIONS[1:], *ANSWERS[1:])) -> DataFrame:
    """Raw fields moved into metadata under ``raw_`` names, where they have a value; keys that metadata has already stay."""
    have = [c for c in fields if c in df.columns]
    if not have:
        return df
    types = dict(df.dtypes)
    values = [F.to_json(c) if types[c].startswith(("array", "map", "struct")) else T.empty_to_null(F.col(c).cast("string")) for c in have]
    patch = F.map_filter(F.map_from_arrays(F.array(*[F.lit(f"raw_{c}") for c in have]), F.array(*values)), lambda k, v: v.isNotNull())
    return df.withColumn("metadata", patched(F.col("metadata") if "metadata" in df.columns else F.lit("{}"), patch)).drop(*[c for c in have if c != "text"])


def patched(metadata: Column, patch: Column) -> Column:
    """A metadata object with the patch's entries added; what metadata holds that isn't empty stays."""
    base = metadata_json(metadata)
    new = F.map_filter(patch, lambda k, v: F.coalesce(F.call_function("get_json_object", base, F.concat(F.lit("$."), k)), F.lit("")) == "")
    body = F.regexp_replace(F.to_json(new), r"^\{|\}$", "")
    open_ = F.regexp_replace(T.strip(base), r"\s*\}$", "")
    return F.when(F.coalesce(F.size(new), F.lit(0)) <= 0, base).otherwise(F.concat(open_, F.when(T.strip(base).rlike(r"^\{\s*\}$"), "").otherwise(","), body, F.lit("}")))


def source_link(url: Column, repo: Column, endpoint: Column, kind: Column, dataset: Column) -> Column:
    """The address that names a source: its URL, repository or endpoint, else the page of its data set."""
    hub = F.when(kind == "hf_dataset", F.concat(F.lit("https://huggingface.co/datasets/"), dataset)).when(kind == "kaggle", F.concat(F.lit("https://www.kaggle.com/datasets/"), dataset))
    return F.coalesce(T.empty_to_null(url), T.empty_to_null(repo), T.empty_to_null(endpoint), hub)


def single(spark, record: dict) -> tuple[str | None, str | None]:
    """(text, target_text) of one record by the rules of ``route``."""
    import json

    row = {k: json.dumps(v) if isinstance(v, (list, dict)) else v for k, v in record.items()}
    schema = ", ".join(f"`{k}` string" for k in row) or "text string"
    got = route(spark.createDataFrame([tuple(None if v is None else str(v) for v in row.values()) or (None,)], schema)).first()
    return got["text"], got["target_text"]


def drop_counts(routed: DataFrame) -> DataFrame:
    """(reason, n): rows that routing or a blank text drops."""
    reason = F.coalesce("drop_reason", F.when(T.missing("text"), "missing_text"))
    return routed.select(reason.alias("reason")).where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def with_ids(df: DataFrame, prefix: str) -> DataFrame:
    """A string id: the source's own, else a hash of the row under the prefix."""
    own = "id" if "id" in df.columns else first_named(df.columns, ID_NAMES)
    made = F.concat(F.lit(f"{prefix}_"), F.hex(F.xxhash64(*[F.col(c).cast("string") for c in df.columns])))
    return df.withColumn("id", F.coalesce(F.col(own).cast("string"), made) if own else made)


def record_hash(df: DataFrame, columns: tuple[str, ...] = ("text", "target_text", "title", "body", "label", "audio", "image")) -> DataFrame:
    """record_hash over the content columns, in contract order."""
    types = dict(df.dtypes)
    return df.withColumn("record_hash", T.fingerprint([(c, types[c]) for c in columns if c in types]))


def normalize(df: DataFrame, spec: dict) -> DataFrame:
    """All steps for one source, in order: provenance, title and body, aliases, routing, fill, drop, ids, metadata, contract, hash."""
    add = {"source": F.lit(spec.get("name")), "source_type": F.lit(spec.get("type")), "source_url": F.lit(spec.get("url")), "source_id": F.lit(spec.get("id")), "collected_at": F.lit(spec.get("collected_at")).cast("timestamp")}
    df = map_fields(df, spec.get("field_map"), spec.get("label_map"))
    df = df.withColumns({k: v for k, v in add.items() if k not in df.columns})
    df = df.withColumns({c: F.lit(None).cast("string") for c in ("title", "body") if c not in df.columns})
    df = raw_metadata(route(fill_aliases(df)).where("drop_reason is null").drop("drop_reason"))
    df = fill_from_title_body(df).where(~T.missing("text"))
    df = with_ids(df, spec.get("id") or "row")
    if "metadata" in df.columns:
        df = df.withColumn("metadata", metadata_json("metadata"))
    return with_contract(record_hash(with_contract(df)), CORE)
