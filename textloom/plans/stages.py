"""The stages of a run, composed of the operators: collect, quality, annotate, active learning, train, report.

Each stage reads the table that the stage before wrote, and writes its own under the run's folder. A stage that needs a
reviewer returns None, and goes on once its review is there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import active, checks, merge, planning, schema, tasks
from textloom.operators.discovery import TYPE_ORDER
from textloom.operators.quality import Quality
from textloom.plans.pipeline import RunState
from textloom.plans.staging import stage
from textloom.sources import registry, sinks


def collected(spark: SparkSession, specs: list[dict], most: int = 20_000, by: str = "source", readers: registry.Registry | None = None) -> tuple[DataFrame, list[dict]]:
    """The merged table of all sources that can be read, and what became of each source.

    Budgets share out the rows, each source is read, normalised and checked, then all are united in the order of source
    types, deduplicated and capped by stratum. A source that fails is reported and left out.
    """
    readers = readers or registry.Registry()
    rank = {t: i for i, t in enumerate(TYPE_ORDER)}
    use = sorted((s for s in specs if s.get("enabled", True)), key=lambda s: (rank.get(s.get("type"), len(rank)), s["id"]))
    budgets = merge.row_budgets(use, most, by)
    frames, log = [], []
    for i, s in enumerate(use):
        rows = merge.effective_sample(budgets[s["id"]], s.get("sample_size"))
        try:
            raw = readers.collect(spark, {**s, "sample_size": rows})
            df = schema.normalize(raw, s)
            issues = checks.canonical_issues(df)
            if "no rows" not in issues:
                frames.append(df.withColumn("__source", F.lit(i)))
            log.append({"id": s["id"], "budget": rows, "issues": issues, "error": None})
        except (ValueError, LookupError, OSError) as e:
            log.append({"id": s["id"], "budget": rows, "issues": [], "error": str(e)})
    if not frames:
        raise ValueError("no source could be read")
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    # rows in the order of their sources; within one by id, which is all that a set of rows has
    every = stage(every.withColumn("__at", F.struct("__source", F.coalesce("id", F.lit("")), F.xxhash64("text", "record_hash"))), "collected")
    merged = merge.keep_first(every.where(~T.missing("text")), "__at").drop("__source")
    strata = {"source": "source", "source_type": "source_type", "source_id": "source_id"}.get(by, "source")
    capped = merge.stratified_cap(merged.withColumn("__id", F.xxhash64("__at")), most, strata, "__id").drop("__id", "__at")
    return schema.with_contract(capped, schema.CORE), log


def report_text(state: RunState) -> str:
    """What each stage of a run came to, in Markdown."""
    rows = [[name, s.status, s.error or "", ", ".join(sorted(s.artifacts))] for name, s in state.stages.items()]
    return f"# Run {state.run_id}\n\nStatus: {state.status}\n\n" + sinks.markdown_table(["stage", "status", "error", "artifacts"], rows) + "\n"


def steps(spark: SparkSession, config: dict, folder: str) -> dict[str, Callable[[RunState], dict[str, str] | None]]:
    """The stages of a configuration, for ``pipeline.run``.

    Sections: ``sources`` and ``collection``, ``quality`` (with ``decision``), ``annotation``, ``active_learning``, ``training``.
    """

    def table(state: RunState, name: str) -> DataFrame:
        return spark.read.parquet(state.stages[name].artifacts["table"])

    def at(state: RunState, *parts: str) -> str:
        return "/".join([folder.rstrip("/"), state.run_id, *parts])

    def collect(state: RunState) -> dict[str, str]:
        c = config.get("collection") or {}
        df, log = collected(spark, config["sources"], int(c.get("max_rows", 20_000)), c.get("stratify_by", "source"))
        out = sinks.finish_collect(stage(df, "merged"), at(state, "collect"), config.get("topic_profile"))
        return {"table": out["merged"], "log": sinks.write_json({"sources": log, "issues": checks.contract_issues(df)}, at(state, "collect", "log.json")), **{k: v for k, v in out.items() if k != "merged"}}

    def quality(state: RunState) -> dict[str, str] | None:
        q = config.get("quality") or {}
        decision = q.get("decision")
        df = table(state, "collect").withColumn("row_no", F.xxhash64("source_id", "id", "record_hash"))
        stage_ = Quality(q, "row_no")
        if not decision:
            sinks.write_table(stage_.report(df), at(state, "quality", "report.csv"))
            return None
        stage_.apply(df, decision, at(state, "quality"))
        return {"table": at(state, "quality", "cleaned.parquet"), "comparison": at(state, "quality", "comparison.md")}

    def annotate(state: RunState) -> dict[str, str]:
        a = config.get("annotation") or {}
        task = tasks.Task.of(a, a.get("task_name", "safety_classification"))
        df = table(state, "quality")
        checks.check_annotatable(df, task.text_column(df.columns), bool((config.get("pipeline") or {}).get("fail_if_text_missing", True)))
        labelled = stage(tasks.auto_label(df, task), "labelled")
        out = tasks.export(labelled, task, at(state, "annotate"), a.get("review_queue_max_rows"))
        sinks.write_markdown(tasks.spec(labelled, task), at(state, "annotate", "spec.md"))
        sinks.write_markdown(tasks.report(tasks.quality(labelled, task), task), at(state, "annotate", "report.md"))
        return {"table": sinks.write_table(labelled, at(state, "annotate", "labelled.parquet")), **out}

    def learn(state: RunState) -> dict[str, str]:
        s = active.settings(config)
        labelled = table(state, "annotate")
        path = at(state, "active_learning", "labelled.parquet")
        if not s["enabled"]:
            return {"table": sinks.write_table(labelled, path)}
        have = next((c for c in ("final_label", "human_label", "label", "auto_label") if c in labelled.columns), None)
        rows = labelled.where(~T.missing("text") & F.col(have).isNotNull()).select(F.col("annotation_id").alias("row_id"), "text", F.col(have).cast("string").alias("label"))
        parts = stage(active.bucket_split(rows.dropDuplicates(["row_id"]), s["test"], s["seed_size"], seed=s["seed"], label="label", least_test=s["least_test"]), "parts")
        part = lambda name: parts.where(F.col("part") == name).drop("part")
        history = active.run_cycle(part("seed"), part("pool"), part("test"), s["strategy"], s["iterations"], s["batch"])
        return {"table": sinks.write_table(labelled, path), "history": sinks.write_json(history, at(state, "active_learning", "history.json"))}

    def train(state: RunState) -> dict[str, str]:
        t = config.get("training") or {}
        df = table(state, "active_learning")
        label = next((c for c in (t.get("label_column"), "final_label", "human_label", "label", "auto_label") if c and c in df.columns), None)
        text = next((c for c in (t.get("text_column"), "text", "prompt", "content", "body", "input") if c and c in df.columns), None)
        if not label or not text:
            raise ValueError("training needs a text and a label column")
        rows = df.where(~T.missing(text)).select(F.col("annotation_id").alias("row_id"), F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
        parts = stage(active.stratified_split(checks.trainable(rows), "label", float(t.get("test_size", 0.2)), seed=int(t.get("random_state", 42))), "train_parts")
        model = active.Classifier(features=int(t.get("max_features", 20_000)), iterations=int(t.get("max_iter", 2000)), c=float(t.get("C", 1.0))).fit(parts.where("part = 'train'"))
        pairs = model.predict(parts.where("part = 'test'")).select("label", F.col("model_pred").alias("pred"))
        out = {"metrics": sinks.write_json(active.metrics(pairs).first(), at(state, "train", "metrics.json")), "classes": sinks.write_table(active.class_report(pairs), at(state, "train", "classes.csv"))}
        if model.model is not None:
            out["model"] = sinks.write_model(model.model, at(state, "train", "model"))
        return out

    def report(state: RunState) -> dict[str, str]:
        return {"report": sinks.write_markdown(report_text(state), at(state, "report.md"))}

    return {"collect": collect, "quality": quality, "annotate": annotate, "active_learning": learn, "train": train, "report": report}


def planned_sources(found: DataFrame, plan: str = "balanced") -> list[dict]:
    """Source specs of one plan over discovered candidates, in the plan's order."""
    from textloom.operators import discovery

    best = discovery.dedupe(found)
    chosen = discovery.plans(best).where(F.col("plan") == plan)
    rows = planning.specs(best.join(F.broadcast(chosen), "candidate_id").orderBy("position")).collect()
    return [r.asDict() for r in rows if r["executable"]]
