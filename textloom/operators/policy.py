"""Quality policy: configuration, column roles and cleaning strategies, all resolved on the driver from names and kinds.

Nothing here touches rows. ``Columns`` comes from one aggregation (``profile.infer_columns``), the rest are plain
functions of it and of a configuration of strings and dicts.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

from textloom.operators import profile

# Names that columns of a role usually have, in order of preference.
ID_NAMES = ("id", "row_id", "sample_id")
KEY_NAMES = ("record_hash", "source_id", "id", "row_id", "sample_id")
TEXT_NAMES = ("prompt", "text", "instruction", "question", "input", "output", "response", "content")
CONTENT_NAMES = ("text", "body", "content")
#: Short keys of a strategy that stand for parts of its text_quality section.
SHORT_KEYS = ("redact_basic_pii", "drop_empty_text", "drop_short_text", "drop_near_duplicates", "language_filter")
YES, NO = ("true", "1", "yes", "on"), ("false", "0", "no", "off")


def names(value: Any) -> list[str]:
    """A configured name or list of names as a list of stripped names; blanks and other types are left out."""
    items = [value] if isinstance(value, str) else value if isinstance(value, Iterable) and not isinstance(value, dict) else []
    return [x.strip() for x in items if isinstance(x, str) and x.strip()]


def name(value: Any) -> str | None:
    """The first configured name."""
    return next(iter(names(value)), None)


def language_code(value: Any) -> str | None:
    """The lower-case code of a configured language, without region; null for blanks, ``auto`` and ``any``."""
    code = (name(value) or "").lower().replace("_", "-").split("-")[0]
    return None if code in ("", "auto", "any", "none", "null") else code


def switch(value: Any, auto: bool) -> bool:
    """A setting that is on, off or decided by ``auto``."""
    if isinstance(value, bool):
        return value
    word = value.strip().lower() if isinstance(value, str) else ""
    return True if word in YES else False if word in NO else auto


def strategy(value: Any) -> dict:
    """A strategy's dict; a bare word is its name."""
    if isinstance(value, str):
        return {"strategy": value}
    if isinstance(value, dict):
        return value
    raise ValueError(f"a strategy is a word or a dict, not {type(value).__name__}")


@dataclass
class Columns:
    """Names of a table by kind: numeric (also strings that read as numbers), text, and text worth reading."""

    all: list[str]
    numeric: list[str]
    text: list[str]
    meaningful: list[str]
    types: dict[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, df: DataFrame) -> Columns:
        kinds = {r["column_name"]: r["kind"] for r in profile.infer_columns(df).collect()}
        types = dict(df.dtypes)
        text = [c for c in df.columns if types[c] == "string" and kinds[c] != "numeric"]
        return cls(df.columns, [c for c in df.columns if kinds[c] == "numeric"], text, [c for c in text if kinds[c] == "meaningful_text"], types)


def feature(column: str) -> tuple[str, str] | None:
    """('char_len' or 'word_len', column) of a derived feature's name."""
    kind, mark, source = column.partition("::")
    return (kind, source) if mark and kind in ("char_len", "word_len") else None


class Policy:
    """Settings with their defaults, and the choices that follow from them for a table."""

    def __init__(self, config: dict | None = None) -> None:
        self.config = config or {}
        self.mode = str(self.config.get("dataset_mode", "auto")).strip().lower()
        if self.mode not in ("auto", "text", "tabular"):
            self.mode = "auto"

    def text_checks(self) -> dict:
        """Settings of the text checks: nested ones first, then the older flat keys, then defaults."""
        c = self.config
        as_dict = lambda d, k: d.get(k) if isinstance(d.get(k), dict) else {}
        user, old_language, old_pii = as_dict(c, "text_checks"), as_dict(c, "language_filter"), as_dict(c, "pii_redaction")
        near, language, pii = (as_dict(user, k) for k in ("near_duplicates", "language", "pii"))

        def first(*choices):
            return next((x for x in choices if x is not None), None)

        return {
            "enabled": bool(user.get("enabled", True)),
            "min_text_chars": int(first(user.get("min_text_chars"), c.get("min_text_length"), 15)),
            "near_duplicates": {
                "enabled": bool(first(near.get("enabled"), c.get("drop_near_duplicates"), False)),
                "similarity_threshold": float(first(near.get("similarity_threshold"), c.get("near_duplicate_similarity"), 0.92)),
            },
            "language": {
                "enabled": bool(first(language.get("enabled"), old_language.get("enabled"), False)),
                "expected": language_code(first(language.get("expected"), name(old_language.get("allow_languages")))),
            },
            "pii": {
                "enabled": bool(first(pii.get("enabled"), old_pii.get("enabled"), True)),
                "emails": bool(first(pii.get("redact_emails"), old_pii.get("redact_emails"), True)),
                "phones": bool(first(pii.get("redact_phones"), old_pii.get("redact_phone_numbers"), True)),
                "handles": bool(first(pii.get("redact_handles"), old_pii.get("redact_user_handles"), True)),
            },
        }

    def label(self, cols: Columns) -> str | None:
        return profile.label_column(cols.all, name(self.config.get("label_column")))

    def identifier(self, cols: Columns) -> str | None:
        return next((c for c in (name(self.config.get("id_column")), *ID_NAMES) if c in cols.all), None)

    def readable(self, cols: Columns) -> list[str]:
        """Text columns that may key duplicates or be critical: all in text mode, else those worth reading."""
        return cols.text if self.mode == "text" else cols.meaningful

    def subset(self, cols: Columns) -> list[str]:
        """Columns that key duplicates: configured ones, an id-like one, or a text."""
        given = [c for c in names(self.config.get("duplicate_subset")) if c in cols.all]
        keys = [c for c in KEY_NAMES if c in cols.all][:1]
        pool = cols.all if self.mode == "text" else cols.meaningful
        return given or keys or [c for c in TEXT_NAMES if c in pool][:1]

    def normalized_subset(self, cols: Columns) -> list[str]:
        """``normalized_`` keys of texts: configured ones, the subset if it is all text, or the first usual text."""
        readable = self.readable(cols)
        given = [c for c in names(self.config.get("normalized_text_columns")) if c in readable]
        subset = self.subset(cols)
        usual = [c for c in TEXT_NAMES if c in readable][:1]
        chosen = given or (subset if subset and set(subset) <= set(readable) else usual)
        return [f"normalized_{c}" for c in chosen]

    def critical(self, cols: Columns) -> list[str]:
        """Texts without which a row is of no use."""
        given = [c for c in names(self.config.get("critical_text_columns")) if c in cols.all]
        readable = self.readable(cols)
        return given or [c for c in TEXT_NAMES if c in readable][:2] or readable[:1]

    def scanned(self, cols: Columns) -> list[str]:
        """Texts that the text checks read."""
        given = [c for c in names(self.config.get("critical_text_columns")) if c in cols.text]
        return given or cols.meaningful[:5] or cols.text[:3]

    def content(self, cols: Columns) -> str | None:
        """The column of the main text."""
        given = (name(self.config.get(k)) for k in ("text_column", "body_column"))
        return next((c for c in (*given, *CONTENT_NAMES, *cols.meaningful) if c in cols.text), None)

    def derived(self, cols: Columns) -> list[str]:
        """Features of text lengths that outliers are looked for in."""
        setting = self.config.get("include_text_derived_outliers", "auto")
        if not switch(setting, self.mode == "text" or self.mode == "auto" and bool(cols.meaningful)):
            return []
        texts = cols.text if self.mode == "text" or switch(setting, False) else cols.meaningful
        return [f"{kind}::{c}" for kind in ("char_len", "word_len") for c in texts]

    def features(self, cols: Columns) -> list[str]:
        return [*cols.numeric, *self.derived(cols)]

    def json_columns(self, cols: Columns) -> list[str]:
        """Nested columns, whose cells become JSON."""
        return [c for c in cols.all if cols.types.get(c, "").startswith(("array", "map", "struct", "binary"))]

    def previews(self, cols: Columns) -> dict[str, dict]:
        """The conservative and the strict strategy for a table."""
        checks = self.text_checks()
        lengths, keys = self.derived(cols), self.normalized_subset(cols)
        critical = {c: {"strategy": "drop_rows"} for c in self.critical(cols)}

        def outliers(numbers: str, texts: str) -> dict:
            per = {f: {"strategy": texts} for f in lengths}
            return {"default": {"strategy": numbers}, **({"per_column": per} if per else {})}

        near, language = checks["near_duplicates"], checks["language"]
        none = {"action": "none"}
        return {
            "conservative": {
                "missing": {"default_numeric": {"strategy": "median"}, "default_categorical": {"strategy": "mode"}, "per_column": critical},
                "duplicates": {"action": "drop", "subset": keys or None},
                "outliers": outliers("clip_iqr", "report_only_iqr"),
                "text_quality": {"pii": {"action": "redact", "columns": "auto", **{k: checks["pii"][k] for k in ("emails", "phones", "handles")}}, "empty_or_short": none, "near_duplicates": none, "language": none},
            },
            "strict": {
                "missing": {"default_numeric": {"strategy": "median"}, "default_categorical": {"strategy": "drop_rows"}, "per_column": critical},
                "duplicates": {"action": "drop", "subset": keys or self.subset(cols) or None},
                "outliers": outliers("remove_iqr", "remove_iqr"),
                "text_quality": {
                    "pii": {"action": "drop_rows", "columns": "auto"},
                    "empty_or_short": {"action": "drop_rows", "min_chars": checks["min_text_chars"], "columns": "auto"},
                    "near_duplicates": {"action": "drop_rows", "similarity_threshold": near["similarity_threshold"]} if near["enabled"] else none,
                    "language": {"action": "drop_rows", "expected": language["expected"]} if language["enabled"] and language["expected"] else none,
                },
            },
        }

    def expanded(self, plan: dict) -> dict:
        """A strategy whose short keys are spelled out under text_quality; what is given there stays."""
        out = {k: v for k, v in plan.items() if k not in SHORT_KEYS}
        given = out.get("text_quality")
        quality = {k: dict(v) if isinstance(v, dict) else v for k, v in given.items()} if isinstance(given, dict) else {}
        checks = self.text_checks()

        def add(section: str, **defaults) -> dict:
            now = quality.get(section)
            quality[section] = {**defaults, **now} if isinstance(now, dict) else defaults
            return quality[section]

        if plan.get("redact_basic_pii"):
            add("pii", action="redact", columns="auto", **{k: checks["pii"][k] for k in ("emails", "phones", "handles")})
        blank, short = bool(plan.get("drop_empty_text")), bool(plan.get("drop_short_text"))
        if blank or short:
            add("empty_or_short", action="drop_rows", min_chars=checks["min_text_chars"], columns="auto").update(drop_blank=blank, drop_short=short)
        if plan.get("drop_near_duplicates"):
            add("near_duplicates", action="drop_rows", similarity_threshold=checks["near_duplicates"]["similarity_threshold"])
        if language := plan.get("language_filter"):
            wanted = language.get("expected", language.get("allow_languages")) if isinstance(language, dict) else language
            add("language", action="drop_rows", expected=language_code(wanted) or checks["language"]["expected"])
        if quality:
            out["text_quality"] = quality
        return out

    def chosen(self, decision: dict, cols: Columns) -> dict:
        """The strategy of a review decision: its own, else the one it names among its offers and the previews."""
        own = decision.get("final_strategy")
        if isinstance(own, dict) and own:
            return dict(own)
        live = self.previews(cols)
        offers = {"recommended": live["conservative"], "alternative": live["strict"]}
        given = decision.get("available_strategies")
        offers |= {k: v for k, v in given.items() if isinstance(v, dict) and v} if isinstance(given, dict) else {}
        picked = decision.get("selected_strategy_name")
        if picked is None:
            preview = decision.get("selected_preview")
            picked = {"conservative": "recommended", "strict": "alternative"}.get(preview, preview)
        if picked is None or picked == "" or isinstance(picked, str) and not picked.strip():
            picked = "recommended"
        if not isinstance(picked, str):
            raise ValueError(f"a strategy's name is a string, not {type(picked).__name__}")
        if picked.strip() not in offers:
            raise ValueError(f"unknown strategy {picked.strip()!r}; known: {', '.join(sorted(offers))}")
        return dict(offers[picked.strip()])

    def recommendations(self, cols: Columns, metrics: dict[str, Any]) -> dict:
        """The two previews with the reasons that the report's metrics give for them."""
        live = self.previews(cols)
        counted = [f"{metrics[k]} {what}" for k, what in (("rows_with_any_missing", "rows with a missing cell"), ("subset_duplicates", "duplicates by key"), ("normalized_text_duplicates", "duplicates by normalised text"), ("outlier_rows_any_iqr", "rows with an outlier by quartiles"), ("text_pii_rows_flagged", "rows with personal data")) if metrics.get(k)]
        return {
            "recommended": live["conservative"],
            "alternative": live["strict"],
            "why": {
                "recommended": "Fills gaps by median and mode, drops duplicates, clips numbers, redacts personal data. Found: " + (", ".join(counted) or "nothing to repair") + ".",
                "alternative": "Drops rows instead of filling, clipping or redacting; for corpora that can spare them.",
                "class_imbalance": "Classes are imbalanced; this is reported and not repaired." if (metrics.get("class_max_min_ratio") or 0) >= 3 else "No strong imbalance of classes.",
            },
        }


def missing_plan(raw: Any) -> dict:
    """Missing-value settings in one form: default, default_numeric, default_categorical and per_column."""
    if raw is None:
        return {"per_column": {}}
    if isinstance(raw, str):
        return {"default": strategy(raw), "per_column": {}}
    if not isinstance(raw, dict):
        raise ValueError("missing-value settings are a word or a dict")
    general = ("default", "default_numeric", "default_categorical", "per_column", "strategy")
    if "strategy" in raw:
        # the other keys are the strategy's own, such as its value
        own = {k: v for k, v in raw.items() if k not in general or k == "strategy"}
        return {"default": own, "per_column": dict(raw.get("per_column", {}))} | {k: raw[k] for k in ("default_numeric", "default_categorical") if k in raw}
    columns = {k: v for k, v in raw.items() if k not in general}
    return {k: raw[k] for k in ("default", "default_numeric", "default_categorical") if k in raw} | {"per_column": {**raw.get("per_column", {}), **columns}}


def missing_for(plan: dict, column: str, numeric: bool) -> dict | None:
    """A column's strategy: its own, that of its kind, or the default."""
    choices = (plan["per_column"].get(column), plan.get("default_numeric" if numeric else "default_categorical"), plan.get("default"))
    got = next((c for c in choices if c), None)
    return strategy(got) if got is not None else None


def duplicate_plan(raw: Any) -> dict | None:
    """(keep, subset) of duplicate settings; ``drop`` keeps the first."""
    if raw is None:
        return None
    if not isinstance(raw, (str, dict)):
        raise ValueError("duplicate settings are a word or a dict")
    action = raw if isinstance(raw, str) else raw.get("action") or raw.get("strategy") or "drop"
    keep = {"drop": "first", "keep_first": "first", "keep_last": "last", "none": None}
    if action not in keep:
        raise ValueError(f"unknown way to treat duplicates: {action}")
    return {"keep": keep[action], "subset": None if isinstance(raw, str) else raw.get("subset")}


#: What outlier strategies do, and by which bounds.
OUTLIER_WAYS = {f"{act}_{by}": (act, by) for act in ("clip", "remove", "report_only") for by in ("iqr", "zscore")}


def outlier_plan(raw: Any, features: list[str]) -> dict[str, tuple[str, str]]:
    """(what to do, bounds) of each feature: its own strategy, or the default; ``columns`` limits the features.

    A column's name there stands for itself and for its derived features.
    """
    if raw is None:
        return {}
    if not isinstance(raw, (str, dict)):
        raise ValueError("outlier settings are a word or a dict")
    given = {"strategy": raw} if isinstance(raw, str) else raw
    default = strategy(given["strategy"]) if "strategy" in given else strategy(given["default"]) if given.get("default") else None
    own = given.get("per_column", {})
    wanted = names(given.get("columns"))
    use = [f for f in features if f in wanted or (feature(f) or ("", f))[1] in wanted] if wanted else features
    out = {}
    for f in sorted(set(use) | ({f for f in own if f in features} if not wanted else set())):
        got = strategy(own[f]) if f in own else default
        if got is None:
            continue
        if got.get("strategy") not in OUTLIER_WAYS:
            raise ValueError(f"unknown outlier strategy: {got.get('strategy')}")
        out[f] = OUTLIER_WAYS[got["strategy"]]
    return out
