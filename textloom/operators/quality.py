"""The quality stage: one report, one repair with a row audit, one comparison, and an approved, persisted run.

``Quality`` binds a policy to an id column that orders rows. All row work is expressed as DataFrame transforms; the
driver sees single rows of counts only. Statistics are taken once, before any repair of the same kind.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import neardup, policy, profile, repair
from textloom.operators.policy import Columns, Policy
from textloom.plans.staging import stage

#: Rows of an audit, per operation and in all; the caps are its feature, and the removed rows themselves are written whole.
PER_OPERATION, IN_ALL = 10_000, 50_000
#: The comparison's metrics, in order.
METRICS = (
    "rows", "total_missing_cells", "rows_with_any_missing", "full_duplicates", "subset_duplicates", "normalized_text_duplicates",
    "outlier_rows_any_iqr", "outlier_rows_any_zscore", "class_max_min_ratio", "text_empty_or_short_rows", "text_any_blank_rows", "text_any_short_rows",
    "text_pii_rows_flagged", "text_near_duplicate_rows_flagged", "text_language_mismatch_rows", "text_exact_duplicate_rows_droppable",
)
ACTIONS = "row_id string, action string, issue_type string, target string, strategy string"
#: Least characters of a text whose language is looked at.
LANGUAGE_CHARS = 20


def _or(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags, F.lit(False))


def feature_column(name: str) -> Column:
    """A numeric column, or a derived length of a text: characters or white-space separated words; null has length 0."""
    derived = policy.feature(name)
    if derived is None:
        return F.col(name).cast("double")
    kind, source = derived
    return (T.chars(source) if kind == "char_len" else T.words(source)).cast("double")


def number_features(df: DataFrame, features: list[str]) -> DataFrame:
    """``df`` with each feature as ``__f<i>``; strings that don't read as numbers are null."""
    types = dict(df.dtypes)
    return df.withColumns({f"__f{i}": T.number(f) if types.get(f) == "string" else feature_column(f) for i, f in enumerate(features)})


def coerce_numbers(df: DataFrame, share: float = 0.8, keep: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, float]]:
    """String columns of which at least ``share`` of the values read as numbers become doubles; also the shares."""
    strings = [c for c, t in df.dtypes if t == "string" and c not in keep]
    if not strings:
        return df, {}
    ratios = {r["column_name"]: r["ratio"] for r in profile.parse_ratio(df, strings).collect()}
    change = {c: r for c, r in ratios.items() if r >= share}
    return (df.withColumns({c: T.number(c) for c in change}) if change else df), {c: round(r, 4) for c, r in change.items()}


def json_cells(df: DataFrame) -> DataFrame:
    """Nested and binary cells as strings: JSON with null for an empty list, map or struct, UTF-8 for bytes."""
    out = {}
    for c, t in df.dtypes:
        if t.startswith(("array", "map")):
            out[c] = F.when(F.size(c) > 0, F.to_json(c))
        elif t.startswith("struct"):
            out[c] = F.nullif(F.to_json(c), F.lit("{}"))
        elif t == "binary":
            out[c] = F.col(c).cast("string")
    return df.withColumns(out) if out else df


class Quality:
    """Reports, repairs and comparisons under a policy.

    ``order`` names a column of distinct ids that decides what first and last mean and what names rows in audits.
    ``detector`` gives a text column's language code; without one, language checks are skipped and say so.
    """

    def __init__(self, config: dict | None = None, order: str = "row_id", detector: Callable[[Column], Column] | None = None) -> None:
        self.policy = Policy(config)
        self.order, self.detector = order, detector

    # ---- report

    def metrics(self, df: DataFrame, cols: Columns | None = None) -> dict[str, float | None]:
        """The comparison's metrics of a table."""
        cols = cols or Columns.of(df)
        p, checks = self.policy, self.policy.text_checks()
        types = dict(df.dtypes)
        scanned = p.scanned(cols) if checks["enabled"] else []
        least = max(1, checks["min_text_chars"])
        flags = {f"m{i}": T.missing(c, types[c]) for i, c in enumerate(cols.all)}
        lengths = {f"n{i}": F.length(T.strip(F.coalesce(F.col(c), F.lit("")))) for i, c in enumerate(scanned)}
        pii = _or([T.any_hit(c) for c in scanned]) if checks["pii"]["enabled"] else F.lit(False)
        marked = df.select(*[x.alias(k) for k, x in {**flags, **lengths}.items()], pii.alias("pii"))
        blank = _or([F.col(n) == 0 for n in lengths])
        short = _or([(F.col(n) > 0) & (F.col(n) < least) for n in lengths])
        row = marked.agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(sum((F.col(m).cast("int") for m in flags), F.lit(0))), F.lit(0)).alias("total_missing_cells"),
            F.count_if(_or([F.col(m) for m in flags])).alias("rows_with_any_missing"),
            F.count_if(blank | short).alias("text_empty_or_short_rows"),
            F.count_if(blank).alias("text_any_blank_rows"),
            F.count_if(short).alias("text_any_short_rows"),
            F.count_if("pii").alias("text_pii_rows_flagged"),
        ).first()
        out: dict[str, float | None] = {k: row[k] for k in row.__fields__}
        subset, normal, content = p.subset(cols), p.normalized_subset(cols), p.content(cols)
        keys = {"full_duplicates": self._key_columns(df, [c for c in df.columns if c != self.order])}
        keys |= {k: self._key_columns(df, v) for k, v in (("subset_duplicates", subset), ("normalized_text_duplicates", normal), ("text_exact_duplicate_rows_droppable", [content] if content and checks["enabled"] else [])) if v}
        dups = {r["kind"]: r["duplicates"] for r in profile.duplicate_counts(df, keys).collect()}
        out |= {k: dups.get(k, 0) for k in ("full_duplicates", "subset_duplicates", "normalized_text_duplicates", "text_exact_duplicate_rows_droppable")}
        features = p.features(cols)
        if features:
            f = stage(number_features(df, features).select(*[f"__f{i}" for i in range(len(features))]), "features")
            any_row = profile.outliers(f, f.columns).where("feature = '*'").first()
            out |= {"outlier_rows_any_iqr": any_row["iqr_rows"], "outlier_rows_any_zscore": any_row["z_rows"]}
        else:
            out |= {"outlier_rows_any_iqr": 0, "outlier_rows_any_zscore": 0}
        label = p.label(cols)
        first = profile.imbalance(df, label).select("ratio").first() if label else None
        out["class_max_min_ratio"] = first["ratio"] if first else None
        out["text_near_duplicate_rows_flagged"] = 0
        if checks["enabled"] and checks["near_duplicates"]["enabled"] and content:
            out["text_near_duplicate_rows_flagged"] = neardup.drop_near(df, content, self.order, checks["near_duplicates"]["similarity_threshold"]).count()
        out["text_language_mismatch_rows"] = 0
        wanted = checks["language"]["expected"]
        if checks["enabled"] and checks["language"]["enabled"] and wanted and content and self.detector:
            out["text_language_mismatch_rows"] = df.where(self._foreign(content, wanted)).count()
        return {k: out[k] for k in METRICS}

    def report(self, df: DataFrame) -> DataFrame:
        """(section, name, metric, value): the whole report in long form."""
        cols = Columns.of(df)
        spark = df.sparkSession
        m = self.metrics(df, cols)
        total = spark.createDataFrame([("total", "*", k, None if v is None else float(v)) for k, v in m.items()], "section string, name string, metric string, value double")
        missing = profile.missing_profile(df).select(F.lit("missing").alias("section"), F.col("column_name").alias("name"), F.explode(F.create_map(F.lit("count"), F.col("missing").cast("double"), F.lit("percent"), F.col("percent"))).alias("metric", "value"))
        parts = [total, missing]
        features = self.policy.features(cols)
        if features:
            f = stage(number_features(df, features).select(*[f"__f{i}" for i in range(len(features))]), "features")
            names = F.create_map(*[F.lit(x) for i, n in enumerate(features) for x in (f"__f{i}", n)])
            o = profile.outliers(f, f.columns)
            pairs = F.explode(F.create_map(F.lit("iqr_rows"), F.col("iqr_rows").cast("double"), F.lit("z_rows"), F.col("z_rows").cast("double"), F.lit("low"), F.col("low"), F.lit("high"), F.col("high"))).alias("metric", "value")
            parts.append(o.select(F.lit("outliers").alias("section"), F.coalesce(F.try_element_at(names, F.col("feature")), F.col("feature")).alias("name"), pairs))
        if label := self.policy.label(cols):
            pairs = F.explode(F.create_map(F.lit("count"), F.col("n").cast("double"), F.lit("share"), F.col("share"))).alias("metric", "value")
            parts.append(profile.imbalance(df, label).select(F.lit("classes").alias("section"), F.col("label").alias("name"), pairs))
        return reduce(DataFrame.unionByName, parts)

    # ---- repair

    def _key_columns(self, df: DataFrame, keys: list[str]) -> list[Column]:
        types = dict(df.dtypes)
        out = []
        for k in keys:
            if k.startswith("normalized_") and k not in types:
                out.append(T.normal_key(k.removeprefix("normalized_")))
            else:
                out.append(F.to_json(k) if types[k].startswith(("map", "variant")) else F.col(k))
        return out

    def _foreign(self, column: str, wanted: str) -> Column:
        text = T.strip(F.coalesce(F.col(column), F.lit("")))
        return (F.length(text) >= LANGUAGE_CHARS) & F.coalesce(self.detector(F.col(column)) != wanted, F.lit(False))

    def _acted(self, rows: DataFrame, action: str, issue: str, target: str, how: str) -> DataFrame:
        return rows.select(F.col(self.order).cast("string").alias("row_id"), F.lit(action).alias("action"), F.lit(issue).alias("issue_type"), F.lit(target).alias("target"), F.lit(how).alias("strategy")).limit(PER_OPERATION)

    def fix(self, df: DataFrame, plan: dict) -> tuple[DataFrame, DataFrame]:
        """The repaired table and its audit (row_id, action, issue_type, target, strategy).

        Steps in fixed order: blanks to null, missing values, duplicates, outliers, text quality. An empty table stays empty.
        """
        plan = self.policy.expanded(plan)
        cols = Columns.of(df)
        audit: list[DataFrame] = []
        for c in (c for c in cols.all if cols.types[c] == "string"):
            audit.append(self._acted(df.where(T.blank(c)), "changed", "blank_text", c, "null"))
        df = repair.blank_to_null(df)
        for step in (self._fix_missing, self._fix_duplicates, self._fix_outliers, self._fix_text):
            df = step(df, plan, cols, audit)
        empty = df.sparkSession.createDataFrame([], ACTIONS)
        return df, reduce(DataFrame.unionByName, audit, empty).limit(IN_ALL)

    def _fix_missing(self, df: DataFrame, plan: dict, cols: Columns, audit: list[DataFrame]) -> DataFrame:
        settings = policy.missing_plan(plan.get("missing"))
        ways: dict[str, object] = {}
        for c in cols.all:
            got = policy.missing_for(settings, c, c in cols.numeric)
            how = got.get("strategy") if got else None
            if how in (None, "none"):
                continue
            if how not in ("mean", "median", "mode", "constant", "drop_rows"):
                raise ValueError(f"unknown missing strategy: {how}")
            ways[c] = ("constant", got.get("value", got.get("constant"))) if how == "constant" else how
        for c, how in ways.items():
            rows = df.where(T.missing(c, cols.types[c]))
            audit.append(self._acted(rows, "removed" if how == "drop_rows" else "changed", "missing", c, how if isinstance(how, str) else how[0]))
        return repair.impute(df, ways) if ways else df

    def _fix_duplicates(self, df: DataFrame, plan: dict, cols: Columns, audit: list[DataFrame]) -> DataFrame:
        settings = policy.duplicate_plan(plan.get("duplicates"))
        if not settings or not settings["keep"]:
            return df
        keys = policy.names(settings["subset"]) or [c for c in df.columns if c != self.order]
        pick = F.min if settings["keep"] == "first" else F.max
        kept = df.groupBy(*T.key128(*self._key_columns(df, keys))).agg(pick(self.order).alias(self.order)).select(self.order)
        audit.append(self._acted(df.join(kept, self.order, "left_anti"), "removed", "duplicates", ",".join(keys), f"keep_{settings['keep']}"))
        return df.join(kept, self.order, "left_semi")

    def _fix_outliers(self, df: DataFrame, plan: dict, cols: Columns, audit: list[DataFrame]) -> DataFrame:
        ways = policy.outlier_plan(plan.get("outliers"), self.policy.features(cols))
        if not ways:
            return df
        names = list(ways)
        # bounds take several passes, which start here and not at the steps before
        wide = stage(number_features(df, names), "features")
        bounds: dict[str, tuple[float, float] | None] = {}
        for by, of in (("iqr", profile.iqr_bounds), ("zscore", profile.z_bounds)):
            wanted = [f"__f{i}" for i, f in enumerate(names) if ways[f][1] == by]
            bounds |= of(wide, wanted) if wanted else {}
        gone, clipped = [], {}
        for i, f in enumerate(names):
            act, by = ways[f]
            b = bounds[f"__f{i}"]
            out = profile.outside(f"__f{i}", b)
            # lengths can't be clipped, so that is a report only
            if act == "clip" and policy.feature(f):
                act = "report_only"
            if b is not None:
                audit.append(self._acted(wide.where(out), {"clip": "changed", "remove": "removed", "report_only": "reported"}[act], "outliers", f, f"{act}_{by}"))
            if act == "remove":
                gone.append(out)
            elif act == "clip" and b is not None:
                low, high = round(b[0], 4), round(b[1], 4)
                clipped[f] = F.when(F.col(f"__f{i}").isNotNull(), F.greatest(F.least(F.col(f"__f{i}"), F.lit(high)), F.lit(low)))
        wide = wide.where(~_or(gone)) if gone else wide
        return (wide.withColumns(clipped) if clipped else wide).drop(*[f"__f{i}" for i in range(len(names))])

    def _fix_text(self, df: DataFrame, plan: dict, cols: Columns, audit: list[DataFrame]) -> DataFrame:
        settings = plan.get("text_quality") or {}
        if not isinstance(settings, dict):
            raise ValueError("text quality settings are a dict")
        checks = self.policy.text_checks()

        def of(section: str) -> tuple[dict, list[str]]:
            s = settings.get(section)
            s = s if isinstance(s, dict) else {"action": s or "none"}
            wanted = s.get("columns", "auto")
            return s, self.policy.scanned(cols) if wanted == "auto" else [c for c in policy.names(wanted) if c in df.columns]

        s, on = of("pii")
        if on and s.get("action") == "redact":
            audit.append(self._acted(df.where(_or([T.any_hit(c) for c in on])), "changed", "pii", ",".join(on), "redact"))
            df = df.withColumns({c: T.redact(c, s.get("emails", True), s.get("phones", True), s.get("handles", True)) for c in on})
        elif on and s.get("action") == "drop_rows":
            df = self._dropped(df, _or([T.any_hit(c) for c in on]), "pii", ",".join(on), audit)
        s, on = of("empty_or_short")
        if on and s.get("action") == "drop_rows":
            least = max(1, int(s.get("min_chars", checks["min_text_chars"])))
            n = [F.length(T.strip(F.coalesce(F.col(c), F.lit("")))) for c in on]
            blank = _or([x == 0 for x in n]) if s.get("drop_blank", True) else F.lit(False)
            short = _or([(x > 0) & (x < least) for x in n]) if s.get("drop_short", True) else F.lit(False)
            df = self._dropped(df, blank | short, "empty_or_short", ",".join(on), audit)
        content = self.policy.content(cols)
        s, _ = of("near_duplicates")
        if content and s.get("action") == "drop_rows":
            drop = neardup.drop_near(df, content, self.order, float(s.get("similarity_threshold", checks["near_duplicates"]["similarity_threshold"])))
            drop = drop.select(F.col("row_id").alias(self.order))
            audit.append(self._acted(drop, "removed", "near_duplicates", content, "drop_rows"))
            df = df.join(drop, self.order, "left_anti")
        s, _ = of("language")
        wanted = policy.language_code(s.get("expected"))
        if content and s.get("action") == "drop_rows" and wanted and self.detector:
            df = self._dropped(df, self._foreign(content, wanted), "language", content, audit)
        return df

    def _dropped(self, df: DataFrame, flag: Column, issue: str, target: str, audit: list[DataFrame]) -> DataFrame:
        audit.append(self._acted(df.where(flag), "removed", issue, target, "drop_rows"))
        return df.where(~flag)

    # ---- comparison and the approved run

    def compare(self, before: DataFrame, after: DataFrame) -> DataFrame:
        """(metric, before, after, delta) of the 16 metrics; a ratio without classes is null, and so is its delta."""
        b, a = self.metrics(stage(before, "before")), self.metrics(stage(after, "after"))
        rows = []
        for k in METRICS:
            x, y = (None if v is None else float(v) for v in (b[k], a[k]))
            rows.append((k, x, y, None if x is None or y is None else round(y - x, 4)))
        return before.sparkSession.createDataFrame(rows, "metric string, before double, after double, delta double")

    def prepare(self, df: DataFrame) -> DataFrame:
        """Nested cells as JSON, and strings that are numbers as numbers; the id column stays."""
        share = float(self.policy.config.get("numeric_coercion_min_ratio", 0.8))
        return coerce_numbers(json_cells(df), share, (self.order,))[0]

    def apply(self, df: DataFrame, decision: dict, folder: str) -> DataFrame:
        """The cleaned table of an approved decision, with report, comparison, audit and removed rows written to ``folder``."""
        if not decision.get("approved"):
            raise ValueError("the decision isn't approved; set approved before cleaning")
        from textloom.sources import sinks

        before = stage(self.prepare(df), "prepared")
        plan = self.policy.chosen(decision, Columns.of(before))
        cleaned, actions = self.fix(before, plan)
        cleaned = stage(cleaned, "cleaned")
        comparison = self.compare(before, cleaned)
        sinks.write_table(cleaned, f"{folder}/cleaned.parquet")
        sinks.write_table(actions, f"{folder}/row_actions.parquet")
        sinks.write_table(repair.removed(before, cleaned, self.order), f"{folder}/removed_rows.parquet")
        rows = [r.asDict() for r in comparison.collect()]
        sinks.write_json({"strategy": plan, "comparison": rows, "decision": {k: v for k, v in decision.items() if k != "available_strategies"}}, f"{folder}/decision_applied.json")
        sinks.write_markdown("# Comparison\n\n" + sinks.markdown_table(list(rows[0]), [list(r.values()) for r in rows]) + "\n", f"{folder}/comparison.md")
        return cleaned
