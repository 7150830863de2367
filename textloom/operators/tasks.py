"""Annotation tasks: labels and their meaning, automatic labelling of a whole table, specs, reports, exports and imports."""

from __future__ import annotations

import html
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import annotate
from textloom.sources import sinks

# Where texts and ids usually are.
TEXT_NAMES = ("prompt", "text", "query", "content")
ID_NAMES = ("id", "record_id", "sample_id", "annotation_id")
#: Examples of a label, and of the boundary between labels, that a spec shows.
PER_LABEL, BOUNDARY = 3, 6


@dataclass
class Task:
    """What is to be labelled: the labels, what each means and an example or two, and where text and id are."""

    name: str = "safety_classification"
    labels: tuple[str, ...] = annotate.SAFETY
    meanings: dict[str, str] = field(default_factory=dict)
    examples: dict[str, list[str]] = field(default_factory=dict)
    text: str | None = None
    identifier: str | None = None
    version: str = "rules-1"
    threshold: float = 0.70
    margin: float = 0.12

    @classmethod
    def of(cls, config: dict | None, task: str = "safety_classification", modality: str = "text") -> Task:
        """The task of an annotation section: its own labels where it has any, else the safety task by name."""
        if modality.strip().lower() != "text":
            raise NotImplementedError("only texts can be labelled")
        c = config or {}
        labels = tuple(x.strip() for x in map(str, c.get("labels") or ()) if x.strip())
        common = {"text": c.get("text_column"), "identifier": c.get("id_column"), "threshold": float(c.get("confidence_threshold", 0.70)), "margin": float(c.get("margin_threshold", 0.12))}
        if labels:
            given = c.get("label_definitions") or {}
            meanings = {k: str(v.get("description", "")) if isinstance(v, dict) else str(v) for k, v in given.items()}
            examples = {k: list(v.get("canonical_examples") or v.get("examples") or []) for k, v in given.items() if isinstance(v, dict)}
            return cls(c.get("task_name") or task, labels, meanings, examples, **common)
        if task.strip().lower() != "safety_classification":
            raise ValueError(f"the task {task!r} needs labels")
        return cls(**common)

    def text_column(self, columns: list[str]) -> str:
        found = next((c for c in (self.text, *TEXT_NAMES) if c in columns), None)
        if found is None:
            raise ValueError(f"no text column among {', '.join(columns)}")
        return found

    def id_column(self, columns: list[str]) -> str | None:
        return next((c for c in (self.identifier, *ID_NAMES) if c in columns), None)


def auto_label(df: DataFrame, task: Task | None = None) -> DataFrame:
    """``df`` with annotation_id, the automatic label and its scores, and what made it.

    The safety task is labelled by rules. Other label sets have no rules: all labels score alike, the first is given, and
    every row goes to review. A table without an id gets one from a hash of its text, repeated texts by position.
    """
    task = task or Task()
    text, own = task.text_column(df.columns), task.id_column(df.columns)
    key = F.col(own).cast("string") if own else F.concat(F.lit("row_"), F.lower(F.hex(F.xxhash64(*[F.col(c).cast("string") for c in df.columns]))))
    df = df.withColumn("annotation_id", key)
    if set(task.labels) == set(annotate.SAFETY):
        out = annotate.rule_label(df, text, task.threshold, task.margin)
    else:
        marks = annotate.warnings(T.collapse(text))
        share = F.round(F.lit(1.0 / len(task.labels)), 6)
        out = annotate.scored(df, {label: share for label in task.labels})
        out = annotate.reviewed(out, marks, task.threshold, task.margin, text)
    return out.withColumns({"task": F.lit(task.name), "label_source": F.lit("auto:rule_based"), "annotator_version": F.lit(task.version)})


def examples(df: DataFrame, task: Task, text: str = "text", order: str = "annotation_id") -> DataFrame:
    """(auto_label, position, text): up to PER_LABEL distinct texts of each label, sure ones before those to review."""
    sure = (~F.coalesce("needs_review", F.lit(False))) & (F.coalesce("confidence", F.lit(0.0)) >= task.threshold)
    keyed = df.where(F.col("auto_label").isNotNull() & ~T.missing(text)).select("auto_label", F.col(text).alias("text"), F.struct((~sure).alias("u"), (-F.coalesce("confidence", F.lit(-1.0))).alias("c"), F.col(order).cast("string").alias("o")).alias("rank"))
    distinct = keyed.groupBy("auto_label", "text").agg(F.min("rank").alias("rank"))
    # the first few of each partition, then of those
    part = distinct.withColumn("p", F.spark_partition_id())
    few = part.withColumn("i", F.row_number().over(Window.partitionBy("auto_label", "p").orderBy("rank"))).where(F.col("i") <= PER_LABEL)
    top = few.withColumn("position", F.row_number().over(Window.partitionBy("auto_label").orderBy("rank"))).where(F.col("position") <= PER_LABEL)
    return top.select("auto_label", "position", "text")


def boundary(df: DataFrame, text: str = "text", order: str = "annotation_id", most: int = BOUNDARY) -> DataFrame:
    """The rows to review of the least confidence, then margin: where labels meet."""
    queue = df.where(F.coalesce("needs_review", F.lit(False)))
    return queue.orderBy(F.asc_nulls_last("confidence"), F.asc_nulls_last("margin"), order).limit(most).select(F.col(order), F.col(text).alias("text"), "auto_label", "confidence", "margin")


def example_line(text: Column, *meta: Column) -> Column:
    """An example on one line, with what is known about it in brackets."""
    line = T.truncate(text, 220)
    return F.concat(line, F.lit(" ["), F.concat_ws(", ", *meta), F.lit("]")) if meta else line


def spec(df: DataFrame, task: Task, order: str = "annotation_id") -> str:
    """Guidelines in Markdown: each label's meaning with examples from the data, filled up with its own, and boundary cases."""
    text = task.text_column(df.columns)
    shown: dict[str, list[str]] = {}
    for r in examples(df, task, text, order).orderBy("auto_label", "position").select("auto_label", example_line(F.col("text")).alias("line")).collect():
        shown.setdefault(r["auto_label"], []).append(r["line"])
    lines = [f"# Annotation: {task.name}", ""]
    for label in task.labels:
        own = [*shown.get(label, []), *task.examples.get(label, [])][:PER_LABEL]
        lines += [f"## {label}", "", task.meanings.get(label, ""), "", *[f"* {x}" for x in own], ""]
    meta = (F.col("auto_label"), F.format_string("confidence %.2f", F.coalesce("confidence", F.lit(0.0))))
    edge = [r[0] for r in boundary(df, text, order).select(example_line(F.col("text"), *meta)).collect()]
    return "\n".join([*lines, "## Boundary cases", "", *[f"* {x}" for x in edge], ""])


def quality(df: DataFrame, task: Task, human: str = "human_label") -> dict:
    """All figures of a labelled table, and of its agreement with reviewers where there are any."""
    row = annotate.confidence_summary(df).first().asDict()
    out: dict = {**row, "labels": {r["value"]: r["share"] for r in annotate.distribution(df, "auto_label").collect()}}
    if human in df.columns:
        pairs = annotate.paired(df, human=human)
        agreement = annotate.agreement(pairs).first().asDict()
        out |= agreement | {"per_class": {r["human"]: r["agreement"] for r in annotate.per_class(pairs).collect()}}
        seen = {r[0] for r in pairs.select(F.explode(F.array("human", "auto"))).distinct().collect()}
        out["order"] = [*task.labels, *sorted(seen - set(task.labels))]
        out["confusion"] = [(r["human"], r["auto"], r["n"]) for r in annotate.confusion(pairs, list(task.labels)).collect()]
    return out


def report(figures: dict, task: Task) -> str:
    """The figures in Markdown."""
    plain = [[k, v] for k, v in figures.items() if not isinstance(v, (dict, list))]
    parts = [f"# Annotation: {task.name}", "", sinks.markdown_table(["figure", "value"], plain), "", "## Labels", "", sinks.markdown_table(["label", "share"], sorted(figures["labels"].items()))]
    if "confusion" in figures:
        cells = {(h, a): n for h, a, n in figures["confusion"]}
        names = figures["order"]
        parts += ["", "## Reviewer by automatic label", "", sinks.markdown_table(["", *names], [[h, *[cells.get((h, a), 0) for a in names]] for h in names])]
    return "\n".join(parts) + "\n"


def interface(task: Task) -> str:
    """The labelling tool's configuration: the text and one choice among the labels (the format is the tool's)."""
    say = lambda x: html.escape(x, quote=True)
    choices = [f'    <Choice value="{say(label)}" />' for label in task.labels]
    head = say(task.name.replace("_", " ").strip() or "Text classification review")
    return "\n".join(["<View>", f'  <Header value="{head}" />', '  <Text name="text" value="$text" />', '  <Choices name="label" toName="text" choice="single-radio">', *choices, "  </Choices>", "</View>", ""])


def export(df: DataFrame, task: Task, folder: str, most: int | None = None, per_class: int = 25) -> dict[str, str]:
    """Queue, audit sample and all rows as tool tasks, with the tool's configuration; audit tasks hide the automatic label."""
    text = task.text_column(df.columns)
    queue, audit = annotate.review_queue(df, most, "annotation_id"), annotate.audit_sample(df, per_class, row="annotation_id")
    paths = {"interface": sinks.write_text(interface(task), f"{folder}/interface.xml"), "review_queue": sinks.write_table(queue, f"{folder}/review_queue.csv"), "audit_sample": sinks.write_table(audit, f"{folder}/audit_sample.csv")}
    for name, rows, guess in (("review_tasks", queue, True), ("audit_tasks", audit, False), ("all_tasks", df, True)):
        paths[name] = sinks.write_table(annotate.tool_tasks(rows, text, guess), f"{folder}/{name}.jsonl")
    return paths


def imported(payloads: DataFrame, column: str, labels: tuple[str, ...] | None = None, repeats: str = "error") -> DataFrame:
    """(annotation_id, human_label, review_status, ls_annotation_id) of tool exports, one JSON array a row.

    A label outside ``labels`` is an error, and so is an id of several tasks, unless ``repeats`` is ``last``: then the highest
    annotation counts.
    """
    if repeats not in ("error", "last"):
        raise ValueError("repeats is error or last")
    rows = payloads.select(F.explode(annotate.read_tool_export(F.col(column))).alias("x")).select("x.*").where("annotation_id is not null and coalesce(human_label, '') <> ''")
    if labels:
        odd = [r[0] for r in rows.where(~F.col("human_label").isin(*labels)).select("human_label").distinct().limit(5).collect()]
        if odd:
            raise ValueError(f"labels that the task doesn't know: {', '.join(odd)}")
    one = rows.groupBy("annotation_id").agg(F.max_by("human_label", "ls_annotation_id").alias("human_label"), F.max("ls_annotation_id").alias("ls_annotation_id"), F.count(F.lit(1)).alias("n"))
    if repeats == "error" and not one.where("n > 1").isEmpty():
        raise ValueError("an annotation_id has several tasks")
    return one.select("annotation_id", "human_label", F.lit("labeled").alias("review_status"), "ls_annotation_id")


def join_key(auto: list[str], human: list[str], wanted: str | None = None) -> str | None:
    """The column that both tables share to join on: the wanted one, else annotation_id."""
    return next((k for k in (wanted, "annotation_id") if k and k in auto and k in human), None)


def reviewed(auto: DataFrame, human: DataFrame, key: str | None = None) -> DataFrame:
    """The labelled table after review, its final label also as ``label``."""
    on = join_key(auto.columns, human.columns, key)
    if on is None:
        raise ValueError("the tables share no key")
    return annotate.merge_human(auto, human, on).withColumn("label", F.col("final_label"))
