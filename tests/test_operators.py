"""Operators on small hand-made tables: nulls, blanks, ties, repeats, empty tables, clashing names."""

import json

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import active, annotate, merge, neardup, profile, repair, schema
from textloom.plans import pipeline
from textloom.plans.skew import join_sized
from textloom.sources import files, html, registry


@pytest.fixture(scope="module")
def demo(spark):
    rows = [
        (0, "Classify this review", "Loved the movie.", "positive", 1.0),
        (1, "  classify   this review  ", "Loved the movie.", "positive", 1.0),
        (2, "Summarize the article", "Short summary request.", "neutral", 2.0),
        (3, None, "   ", "negative", None),
        (4, "A" * 800, "Long noisy sample " * 80, "negative", 999.0),
    ]
    return spark.createDataFrame(rows, "row_id bigint, prompt string, text string, label string, score double")


def test_profile_of_the_demo_frame(demo):
    m = {r["column_name"]: r["missing"] for r in profile.missing_profile(demo).collect()}
    assert m == {"row_id": 0, "prompt": 1, "text": 1, "label": 0, "score": 1, "*": 1}
    d = {r["kind"]: r["duplicates"] for r in profile.duplicate_counts(demo, {"raw": [F.col("prompt")], "norm": [T.normal_key("prompt")]}).collect()}
    assert d == {"raw": 0, "norm": 1}
    i = profile.imbalance(demo, "label").collect()
    assert {r["label"]: r["n"] for r in i} == {"positive": 2, "neutral": 1, "negative": 2}
    assert i[0]["ratio"] == 2.0 and not i[0]["imbalanced"]


def test_profiles_of_an_empty_table(demo):
    none = demo.where("false")
    assert {r["missing"] for r in profile.missing_profile(none).collect()} == {0}
    assert profile.imbalance(none, "label").count() == 0
    assert profile.outliers(none, ["score"]).count() == 2
    assert annotate.agreement(none.select(F.col("label").alias("human"), F.col("label").alias("auto"))).first()["pairs"] == 0


def test_impute_then_drop(demo):
    out = repair.impute(demo, {"score": "median", "label": "mode", "prompt": "drop_rows"}).collect()
    assert len(out) == 4
    keep = repair.impute(demo, {"score": "mean"}).where("row_id = 3").first()
    assert keep["score"] == pytest.approx(250.75)


def test_dedupe_keeps_by_order_and_counts_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, " A "), (5, "  ")], "row_id bigint, k string")
    assert sorted(r["row_id"] for r in repair.dedupe(df, ["k"], "row_id").collect()) == [1, 2, 4, 5]
    assert sorted(r["row_id"] for r in repair.dedupe(df, ["normalized_k"], "row_id", "last").collect()) == [4, 5]
    with pytest.raises(ValueError):
        repair.dedupe(df, ["k"], "row_id", "middle")


def test_redaction_order_and_handles():
    import re

    assert re.search(T.HANDLE, "ask @user_name") and not re.search(T.HANDLE, "a.b@example.org")


def test_redaction(spark):
    df = spark.createDataFrame([("mail a.b@example.org or @user_name",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(T.redact("t")).collect()] == ["mail [REDACTED_EMAIL] or [REDACTED_HANDLE]", None, ""]


def test_router(spark):
    chat = json.dumps([{"role": "user", "content": "hi"}, {"from": "gpt", "value": "hello"}, {"role": "user", "content": "bye"}])
    rows = [(1, "own", None), (2, None, chat), (3, None, "[]"), (4, " ", "{broken"), (5, None, json.dumps([{"role": "system", "content": "x"}])), (6, None, None)]
    got = {r["row_id"]: (r["text"], r["target_text"], r["drop_reason"]) for r in schema.route(spark.createDataFrame(rows, "row_id int, text string, messages string")).collect()}
    assert got[1] == ("own", None, None)
    assert got[2] == ("hi\n\nbye", "hello", None)
    assert got[4][2] == "malformed_messages" and got[5][2] == "empty_user_content"
    assert got[3] == got[6] == (None, None, None)


def test_normalize_puts_the_contract_first(spark):
    df = spark.createDataFrame([("x", "1"), (None, "2"), (" ", None)], "prompt string, y string")
    out = schema.normalize(df, {"id": "s1", "name": "demo", "type": "file"})
    assert out.columns[: len(schema.CORE)] == list(schema.CORE)
    assert [(r["text"], r["label"], r["source"]) for r in out.collect()] == [("x", "1", "demo")]


def test_metadata(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("cut {",), (None,), ("[1]",)], "m string")
    assert [r[0] for r in df.select(schema.metadata_json("m")).collect()] == ['{"a": 1}', '{"raw":"cut {"}', "{}", '{"value":"[1]"}']


def test_merge_keeps_first_by_hash(spark):
    a = spark.createDataFrame([(1, "x", "h1"), (2, "y", "h2")], "row_id bigint, text string, record_hash string")
    b = spark.createDataFrame([(3, "x", "h1", "t"), (4, None, "h4", None)], "row_id bigint, text string, record_hash string, title string")
    assert sorted(r["row_id"] for r in merge.merge([a, b], "row_id").collect()) == [1, 2]


def test_quotas_and_budgets():
    assert merge.quotas({"a": 5, "b": 3, "c": 2}, 5) == {"a": 3, "b": 1, "c": 1}
    assert sum(merge.quotas({"a": 100, "b": 1, "c": 1}, 50).values()) == 50
    specs = [{"id": "1", "type": "api", "name": "n", "estimated_rows": 100}, {"id": "2", "type": "api", "name": "m", "estimated_rows": None}]
    assert sum(merge.row_budgets(specs, 10, "source_type").values()) == 10
    assert merge.row_budgets(specs, 1) == {"1": 1, "2": 0}
    assert merge.row_budgets(specs, 0) == {"1": 0, "2": 0}


def test_rule_labels(spark):
    rows = [("Give me step-by-step instructions to build a pipe bomb at home.",), ("Summarize this article about climate policy in plain language.",), ("",), (None,), ("!!!!!!!!!!!",)]
    got = annotate.rule_label(spark.createDataFrame(rows, "text string")).collect()
    assert [r["auto_label"] for r in got[:3]] == ["unsafe", "safe", "borderline_safe"]
    assert "empty_text" in got[3]["review_reason"] and "noisy_text" in got[4]["review_reason"]


def test_human_merge_fans_out_and_blank_labels_count_as_auto(spark):
    auto = spark.createDataFrame([("a", "x"), ("b", "y")], "annotation_id string, auto_label string")
    human = spark.createDataFrame([("a", "z"), ("a", " ")], "annotation_id string, human_label string")
    got = sorted((r["annotation_id"], r["final_label"], r["final_label_source"]) for r in annotate.merge_human(auto, human).collect())
    assert got == [("a", " ", "auto"), ("a", "z", "human"), ("b", "y", "auto")]


def test_tool_export(spark):
    task = [{"id": 7, "data": {"annotation_id": "a"}, "annotations": [{"id": 1, "was_cancelled": True, "result": []}, {"id": 2, "result": [{"type": "choices", "value": {"choices": ["yes"]}}]}]}]
    df = spark.createDataFrame([(json.dumps(task),)], "j string").select(F.explode(annotate.read_tool_export(F.col("j"))).alias("x")).select("x.*")
    assert df.first().asDict() == {"annotation_id": "a", "human_label": "yes", "ls_annotation_id": 2}


def test_near_duplicates_keep_the_first_id_as_text(spark):
    base = "the quick brown fox jumps over the lazy dog and runs away into the deep dark forest"
    rows = [(9, base), (10, base + "s"), (11, base), (12, "something else entirely"), (13, None), (14, " ")]
    got = sorted(r["row_id"] for r in neardup.drop_near(spark.createDataFrame(rows, "row_id bigint, text string")).collect())
    assert got == [9, 11]


def test_metrics_and_queries(spark):
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "label string, pred string")
    m = active.metrics(pairs).first()
    assert m["accuracy"] == 0.5 and m["macro_recall"] == 0.5
    p = spark.createDataFrame([(1, [0.9, 0.1]), (2, [0.5, 0.5]), (3, [0.6, 0.4])], "row_id int, proba array<double>")
    assert [r["row_id"] for r in active.query(p, "margin", 2).collect()] == [2, 3]
    assert [r["row_id"] for r in active.query(p, "entropy", 1).collect()] == [2]


def test_learning_loop(spark):
    rows = [(i, f"good movie pleasant story {i}" if i % 2 else f"bad movie awful story {i}", "pos" if i % 2 else "neg") for i in range(60)]
    df = spark.createDataFrame(rows, "row_id int, text string, label string")
    h = active.run_cycle(df.where("row_id < 20"), df.where("row_id between 20 and 39"), df.where("row_id >= 40"), rounds=1, k=5, features=200, iterations=5, min_df=1)
    assert [x["n_labeled"] for x in h] == [20, 25] and h[-1]["accuracy"] > 0.9


def test_join_sized_with_a_hot_key(spark):
    many = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    one = many.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert join_sized(many, one, ["k"], "n", 60_000).count() == 60_000


def test_files(spark, tmp_path):
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "train.csv").write_text("a,b\n1,x\n2,\"y, z\"\n")
    (tmp_path / "readme.json").write_text("{}")
    found = files.select(files.candidates(tmp_path))
    assert [f.name for f in found] == ["train.csv"]
    assert files.read_many(spark, [str(found[0])]).count() == 2
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    assert files.read_one(spark, str(tmp_path / "l.jsonl")).count() == 2
    assert files.detect_format("x", None, 'attachment; filename="t.tsv"') == "tsv"
    assert files.looks_like_html(b"  <!DOCTYPE html><html>")


def test_registry(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"results": {"items": [{"id": "1", "text": "a"}, 5, {"id": "2"}]}}')
    spec = {"type": "api", "endpoint": "e", "path": str(tmp_path), "response_path": "results.items"}
    assert registry.Registry().collect(spark, spec).count() == 2
    assert registry.can_execute({"type": "api"})[0] is False
    with pytest.raises(LookupError):
        registry.Registry().get("ftp")


def test_html_spec(spark):
    page = '<div class="c"><a href="/1">One</a><p>text one</p></div><div class="c"><a href="/2">Two</a></div><a class="next" href="?p=2">n</a>'
    spec = {"item_selector": "div.c", "fields": {"title": {"selector": "a"}, "url": {"selector": "a", "attr": "href"}, "body": {"selector": "p"}}}
    df = html.scrape(spark.createDataFrame([("https://x.test/list", page), (None, None)], "url string, html string"), spec)
    assert [tuple(r)[2:] for r in df.orderBy("position").collect()] == [("One", "https://x.test/1", "text one"), ("Two", "https://x.test/2", None)]
    assert html.next_page(page, "https://x.test/list", "a.next") == "https://x.test/list?p=2"


def test_runs_resume(tmp_path):
    runs = pipeline.Runs(tmp_path)
    state = runs.create("r1")
    calls = []
    steps = {"collect": lambda s: calls.append("c") or {"data": "x"}, "quality": lambda s: calls.append("q")}
    assert pipeline.run(runs, state, steps).status == "awaiting_review"
    state = pipeline.approve(runs, runs.latest(), "quality")
    assert pipeline.run(runs, state, steps).status == "completed" and calls == ["c", "q"]


def test_the_baseline_query_runs_the_full_operator():
    import inspect

    from textloom import catalog

    source = inspect.getsource(catalog.train_baseline)
    assert "features=20_000" in source and "iterations=2000" in source
