"""Automatic labels, review queues, human labels, agreement, annotation-tool tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.quantiles import quantiles

# The safety task's labels, words and patterns.
SAFETY = ("safe", "borderline_safe", "unsafe")
SAFE_WORDS = ["summarize", "translate", "classify", "rewrite", "email", "essay", "recipe", "travel", "meeting", "python basics", "homework", "brainstorm"]
BENIGN = [
    r"\b(summarize|rewrite|translate|paraphrase|classify|extract|categorize)\b",
    r"\b(email|essay|blog post|lesson plan|meeting agenda|travel itinerary)\b",
    r"\b(explain|teach|help me understand)\b.{0,40}\b(math|history|grammar|biology|python)\b",
]
BORDERLINE = [
    r"\b(is this safe|does this violate|policy|moderation|review this prompt)\b",
    r"\b(for a novel|for fiction|for a screenplay|for a game)\b",
    r"\b(research|analysis|analyze|overview|high[- ]level)\b",
    r"\b(prevent|avoid|detect|defend against|warning signs)\b",
]
HARMFUL_WORDS = ["bomb", "explosive", "weapon", "kill", "murder", "poison", "malware", "ransomware", "ddos", "phishing", "exploit", "steal", "fraud", "counterfeit", "fake id", "credit card theft", "suicide", "self-harm"]
HARMFUL_INTENT = [
    r"\b(how to|steps to|step-by-step|guide to|instructions? to|teach me to|help me)\b.{0,80}\b(bomb|explosive|weapon|kill|poison|malware|ransomware|phishing|steal|fraud|exploit|ddos|fake id)\b",
    r"\b(write|generate|create|build|make)\b.{0,80}\b(phishing|malware|ransomware|exploit|bomb|fake id)\b",
    r"\b(bypass|evade|avoid)\b.{0,80}\b(detection|moderation|security|police|monitoring)\b",
]
SAFE_CONTEXT = [
    r"\b(history of|news about|policy on|moderation of|research on)\b",
    r"\b(prevent|avoid|detect|mitigate|defend against)\b",
    r"\b(why is .* dangerous|explain the risks|warning signs)\b",
]
REQUEST = r"\b(how do i|how to|give me|show me|write me|build me|make me|help me)\b"
REPEATED = r"^(.)\1{7,}$"


def warnings(x: Column) -> Column:
    """Sorted warnings about a collapsed text."""
    signs = F.length(F.regexp_replace(x, r"[^\p{L}\p{N}]", ""))
    noisy = x.rlike(r"^[^\p{L}\p{N}]+$") | x.rlike(r"(?i)" + REPEATED)
    marks = F.array_compact(
        F.array(
            F.when(signs < 0.35 * F.length(x), "low_signal_text"),
            F.when(noisy, "noisy_text"),
            F.when(~x.contains(" ") & (F.length(x) > 24), "single_token_text"),
            F.when(F.length(x) < 3, "very_short_text"),
        )
    )
    return F.when(x == "", F.array(F.lit("empty_text"))).otherwise(marks)


def rule_label(df: DataFrame, text: str = "text", threshold: float = 0.70, margin_threshold: float = 0.12) -> DataFrame:
    """auto_label, confidence, margin, entropy, class_scores, needs_review, review_reason by weighted words and patterns."""
    df = df.withColumn("__x", T.collapse(text)).withColumn("__l", F.lower("__x")).withColumn("__w", warnings(F.col("__x")))
    df = df.withColumns({"__kw": T.keyword_hits("__l", HARMFUL_WORDS), "__in": T.pattern_hits("__l", HARMFUL_INTENT), "__ctx": T.pattern_hits("__l", SAFE_CONTEXT)})
    kw, intent, ctx, warned = F.col("__kw"), F.col("__in"), F.col("__ctx"), F.size("__w") > 0
    unsafe = 1.0 + kw * 1.35 + intent * 2.40 + F.when(F.col("__l").rlike(REQUEST) & (kw > 0), 0.5).otherwise(0.0)
    unsafe = F.when(ctx > 0, F.greatest(F.lit(0.25), unsafe - ctx * 0.9)).otherwise(unsafe)
    middle = 1.0 + T.pattern_hits("__l", BORDERLINE) * 1.65 + ctx * 1.40 + F.when(ctx > 0, F.least(kw, F.lit(2)) * 0.55).otherwise(0.0) + F.when(F.col("__x").contains("?") & (kw > 0), 0.6).otherwise(0.0) + F.when(warned, 0.75).otherwise(0.0)
    safe = 1.0 + T.pattern_hits("__l", BENIGN) * 1.25 + T.keyword_hits("__l", SAFE_WORDS) * 0.70 + F.when((kw == 0) & (intent == 0), 1.05).otherwise(0.0)
    safe = F.when(warned, F.greatest(F.lit(0.25), safe - 0.3)).otherwise(safe)
    empty = F.col("__x") == ""
    df = df.withColumns({"__s": F.when(empty, 1.0).otherwise(safe), "__b": F.when(empty, 1.15).otherwise(middle), "__u": F.when(empty, 1.0).otherwise(unsafe)})
    total = F.col("__s") + F.col("__b") + F.col("__u")
    df = df.withColumns({c: F.round(F.col(c) / total, 6) for c in ("__s", "__b", "__u")})
    df = scored(df, {"safe": F.col("__s"), "borderline_safe": F.col("__b"), "unsafe": F.col("__u")})
    df = reviewed(df, F.col("__w"), threshold, margin_threshold, text)
    return df.drop("__x", "__l", "__w", "__kw", "__in", "__ctx", "__s", "__b", "__u")


def scored(df: DataFrame, scores: dict[str, Column]) -> DataFrame:
    """auto_label (the first on a tie), confidence, margin, entropy (0 to 1) and class_scores from scores that sum to 1."""
    ranked = F.sort_array(F.array(*[F.struct(s.alias("score"), F.lit(-i).alias("at"), F.lit(n).alias("name")) for i, (n, s) in enumerate(scores.items())]), asc=False)
    df = df.withColumn("__r", ranked)
    p = [F.greatest(s, F.lit(1e-12)) for s in scores.values()]
    entropy = sum((-x * F.log(x) for x in p), F.lit(0.0)) / F.log(F.lit(float(max(len(p), 2))))
    second = F.col("__r")[1]["score"] if len(scores) > 1 else F.lit(0.0)
    return df.withColumns(
        {
            "auto_label": F.col("__r")[0]["name"],
            "confidence": F.round(F.col("__r")[0]["score"], 6),
            "margin": F.round(F.col("__r")[0]["score"] - second, 6),
            "entropy": F.round(entropy, 6),
            "class_scores": F.create_map(*[x for n, s in scores.items() for x in (F.lit(n), s)]),
        }
    ).drop("__r")


def reviewed(df: DataFrame, warned: Column, threshold: float, margin_threshold: float, text: str = "text") -> DataFrame:
    """needs_review and review_reason (sorted, joined by '; ')."""
    reasons = F.array_compact(F.array(F.when(F.col("confidence") < threshold, "low_confidence"), F.when(F.col("margin") < margin_threshold, "small_margin"), F.when(T.missing(text), "empty_text")))
    every = F.array_sort(F.array_distinct(F.concat(reasons, warned)))
    return df.withColumns({"needs_review": F.size(every) > 0, "review_reason": F.array_join(every, "; ")})


def review_queue(df: DataFrame, most: int | None = None, row: str = "row_id") -> DataFrame:
    """Rows that need review, the least confident first, then the smallest margin; the cap is the feature."""
    q = df.where(F.coalesce("needs_review", F.lit(False))).orderBy(F.asc_nulls_last("confidence"), F.asc_nulls_last("margin"), row)
    return q.limit(most) if most is not None else q


def audit_sample(df: DataFrame, per_class: int = 25, label: str = "auto_label", row: str = "row_id", seed: int = 42) -> DataFrame:
    """Up to ``per_class`` rows of each label by a seeded hash; a null label is a class."""
    # the smallest hashes of each class: partial top lists per partition, then of the lists
    h = F.xxhash64(F.lit(seed), F.col(row))
    part = df.withColumns({"__h": h, "__p": F.spark_partition_id()})
    first = part.withColumn("__i", F.row_number().over(Window.partitionBy(label, "__p").orderBy("__h", row))).where(F.col("__i") <= per_class)
    return first.withColumn("__i", F.row_number().over(Window.partitionBy(label).orderBy("__h", row))).where(F.col("__i") <= per_class).drop("__h", "__p", "__i")


def merge_human(auto: DataFrame, human: DataFrame, key: str = "annotation_id") -> DataFrame:
    """Human labels joined from the left: repeated reviews repeat the row.

    final_label is a human label of any length over 0, else the automatic one; its source counts a blank one as auto.
    """
    extra = [c for c in human.columns if c not in auto.columns]
    clash = {c: f"{c}_human" for c in human.columns if c in auto.columns and c != key}
    j = auto.join(human.withColumnsRenamed(clash).select(key, *extra, *clash.values()), key, "left")
    given = F.coalesce("human_label", F.lit(""))
    return j.withColumns({"final_label": F.when(F.length(given) > 0, F.col("human_label")).otherwise(F.col("auto_label")), "final_label_source": F.when(T.strip(given) != "", "human").otherwise("auto")})


def paired(df: DataFrame, auto: str = "auto_label", human: str = "human_label") -> DataFrame:
    """(auto, human) of rows that have both, non-blank."""
    return df.where(~T.missing(auto) & ~T.missing(human)).select(F.col(auto).alias("auto"), F.col(human).alias("human"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """(value, n, share): counts of non-null values and their share to six places."""
    c = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = c.agg(F.sum("n").alias("t"))
    return c.join(F.broadcast(total), F.lit(True)).select("value", "n", F.round(F.col("n") / F.col("t"), 6).alias("share"))


def confusion(pairs: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """(human, auto, n) of all combinations of labels, zeros included. Label sets are small."""
    counts = pairs.groupBy("human", "auto").agg(F.count(F.lit(1)).alias("n"))
    names = pairs.select(F.explode(F.array("human", "auto")).alias("x")).distinct()
    if labels:
        extra = names.sparkSession.createDataFrame([(x,) for x in labels], "x string")
        names = names.union(extra).distinct()
    every = F.array_sort(F.collect_set("x"))
    grid = names.agg(every.alias("xs")).select(F.explode("xs").alias("human"), "xs").select("human", F.explode("xs").alias("auto"))
    return grid.join(counts, ["human", "auto"], "left").select("human", "auto", F.coalesce("n", F.lit(0)).alias("n"))


def agreement(pairs: DataFrame) -> DataFrame:
    """(pairs, agreement, kappa) in one row; where chance agreement is 1, kappa is 1 or 0."""
    cells = pairs.groupBy("human", "auto").agg(F.count(F.lit(1)).alias("n"))
    h = cells.groupBy(F.col("human").alias("x")).agg(F.sum("n").alias("nh"))
    a = cells.groupBy(F.col("auto").alias("x")).agg(F.sum("n").alias("na"))
    chance = h.join(a, "x").agg(F.coalesce(F.sum(F.col("nh").cast("double") * F.col("na")), F.lit(0.0)).alias("both"))
    same = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"), F.coalesce(F.sum(F.when(F.col("human") == F.col("auto"), F.col("n"))), F.lit(0)).alias("same"))
    row = same.join(F.broadcast(chance), F.lit(True)).withColumns({"po": F.try_divide(F.col("same"), F.col("pairs")), "pe": F.try_divide(F.col("both"), F.col("pairs").cast("double") * F.col("pairs"))})
    kappa = F.when(F.abs(1 - F.col("pe")) < 1e-12, F.when(F.col("po") == 1, 1.0).otherwise(0.0)).otherwise((F.col("po") - F.col("pe")) / (1 - F.col("pe")))
    return row.select("pairs", F.round("po", 6).alias("agreement"), F.round(kappa, 6).alias("kappa"))


def per_class(pairs: DataFrame) -> DataFrame:
    """(human, n, agreement) of each human label."""
    return pairs.groupBy("human").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("auto") == F.col("human")).cast("double")), 6).alias("agreement"))


def confidence_summary(df: DataFrame, threshold: float = 0.72) -> DataFrame:
    """(rows, mean_confidence, median_confidence, low_share, needs_review) in one row; null confidences don't count."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg("confidence"), 6).alias("mean_confidence"),
        F.round(F.lit(quantiles(df, ["confidence"], [0.5])["confidence"][0]).cast("double"), 6).alias("median_confidence"),
        F.round(F.avg(F.when(F.col("confidence").isNotNull(), (F.col("confidence") < threshold).cast("double"))), 6).alias("low_share"),
        F.count_if(F.coalesce("needs_review", F.lit(False))).alias("needs_review"),
    )


def latest_review(human: DataFrame) -> DataFrame:
    """One review per annotation: the last by tool id and completion, skipped ones left out."""
    done = human.where(~F.coalesce(F.lower("review_status"), F.lit("")).isin("skipped", "canceled", "cancelled"))
    last = F.max_by(F.struct("human_label", "ls_annotator_id", "ls_completed_at"), F.struct("ls_annotation_id", "ls_completed_at"))
    return done.groupBy("annotation_id").agg(last.alias("x")).select("annotation_id", "x.*")


def tool_tasks(df: DataFrame, text: str = "text", predictions: bool = True) -> DataFrame:
    """(annotation_id, task): a nested task object as JSON for an annotation tool, with the automatic label as prediction."""
    data = F.struct(F.col("annotation_id"), F.col(text).alias("text"))
    choice = F.struct(F.struct(F.array("auto_label").alias("choices")).alias("value"), F.lit("label").alias("from_name"), F.lit("text").alias("to_name"), F.lit("choices").alias("type"))
    guess = F.array(F.struct(F.col("confidence").alias("score"), F.array(choice).alias("result")))
    body = F.struct(data.alias("data"), guess.alias("predictions")) if predictions else F.struct(data.alias("data"))
    return df.select("annotation_id", F.to_json(body).alias("task"))


TASKS = "array<struct<id bigint, data struct<annotation_id string, source_id string>, annotations array<struct<id bigint, was_cancelled boolean, was_canceled boolean, created_at string, completed_by string, result array<struct<type string, value struct<choices array<string>>>>>>>>"


def read_tool_export(payload: Column) -> Column:
    """Rows (annotation_id, human_label, ls_annotation_id) of an export: the last annotation that isn't cancelled."""
    tasks = F.from_json(payload, TASKS)

    def one(t: Column) -> Column:
        live = F.filter(t["annotations"], lambda a: ~F.coalesce(a["was_cancelled"], a["was_canceled"], F.lit(False)))
        best = F.array_max(F.transform(live, lambda a: F.struct(a["id"].alias("id"), a["created_at"].alias("at"), F.element_at(F.filter(a["result"], lambda r: r["type"] == "choices"), 1)["value"]["choices"].alias("c"))))
        return F.struct(F.coalesce(t["data"]["annotation_id"], t["data"]["source_id"], t["id"].cast("string")).alias("annotation_id"), F.try_element_at(best["c"], F.lit(1)).alias("human_label"), best["id"].alias("ls_annotation_id"))

    return F.transform(tasks, one)
