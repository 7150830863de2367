"""Policy, quality stage, checks, planning, tasks, staged pages, sinks and composed runs on small tables."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom import cli
from textloom.operators import active, checks, discovery, merge, planning, policy, quality, schema, tasks
from textloom.operators.quantiles import modes, quantiles
from textloom.plans import stages
from textloom.sources import html, pages, sinks


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_are_exact(spark, seed):
    rng = random.Random(seed)
    xs = [rng.choice([None, float("nan"), rng.gauss(0, 10 ** rng.randrange(6)), float(rng.randrange(4))]) for _ in range(500)]
    df = spark.createDataFrame([(x, None) for x in xs], "x double, y int")
    known = np.array([x for x in xs if x is not None and x == x])
    shares = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    got = quantiles(df, ["x", "y"], shares)
    assert got["x"] == pytest.approx(np.quantile(known, shares).tolist()) and got["y"] == [None] * 6
    assert modes(spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,)], "k string"), ["k"]) == {"k": "a"}
    big = spark.createDataFrame([(float("-inf"),), (-1e308,), (1e308,), (float("inf"),)], "x double")
    assert quantiles(big, ["x"], [0.0, 1.0])["x"] == [float("-inf"), float("inf")]


def test_policy_settings():
    p = policy.Policy({"min_text_length": 30, "pii_redaction": {"redact_user_handles": False}, "language_filter": {"enabled": True, "allow_languages": ["EN-us"]}, "text_checks": {"near_duplicates": {"enabled": True}}})
    t = p.text_checks()
    assert t["min_text_chars"] == 30 and not t["pii"]["handles"] and t["pii"]["emails"] and t["language"] == {"enabled": True, "expected": "en"} and t["near_duplicates"]["enabled"]
    cols = policy.Columns(["id", "prompt", "text", "n"], ["n"], ["id", "prompt", "text"], ["prompt", "text"])
    assert p.subset(cols) == ["id"] and p.normalized_subset(cols) == ["normalized_prompt"] and p.critical(cols) == ["prompt", "text"] and p.content(cols) == "text"
    assert p.derived(cols) == ["char_len::prompt", "char_len::text", "word_len::prompt", "word_len::text"]
    assert policy.Policy({"include_text_derived_outliers": "off"}).derived(cols) == [] and policy.Policy({"dataset_mode": "tabular"}).derived(cols) == []
    live = p.previews(cols)
    assert live["strict"]["text_quality"]["language"] == {"action": "drop_rows", "expected": "en"} and live["conservative"]["outliers"]["per_column"]["char_len::text"] == {"strategy": "report_only_iqr"}
    assert p.chosen({"selected_preview": "strict"}, cols) == live["strict"] and p.chosen({"final_strategy": {"missing": "mode"}}, cols) == {"missing": "mode"}
    with pytest.raises(ValueError):
        p.chosen({"selected_strategy_name": "nope"}, cols)
    e = p.expanded({"drop_short_text": True, "language_filter": True, "text_quality": {"empty_or_short": {"min_chars": 3}}})
    assert e == {"text_quality": {"empty_or_short": {"action": "drop_rows", "min_chars": 3, "columns": "auto", "drop_blank": False, "drop_short": True}, "language": {"action": "drop_rows", "expected": "en"}}}


def test_strategies_of_columns():
    plan = policy.missing_plan({"default_numeric": "median", "default": "drop_rows", "text": "constant"})
    assert policy.missing_for(plan, "n", True) == {"strategy": "median"} and policy.missing_for(plan, "c", False) == {"strategy": "drop_rows"} and policy.missing_for(plan, "text", False) == {"strategy": "constant"}
    assert policy.missing_plan({"strategy": "constant", "value": 7})["default"] == {"strategy": "constant", "value": 7}
    assert policy.missing_for(policy.missing_plan(None), "x", True) is None
    features = ["n", "char_len::t", "word_len::t"]
    assert policy.outlier_plan({"strategy": "clip_iqr", "columns": ["t"]}, features) == {"char_len::t": ("clip", "iqr"), "word_len::t": ("clip", "iqr")}
    assert policy.outlier_plan({"default": "remove_zscore", "per_column": {"n": "report_only_iqr"}}, features)["n"] == ("report_only", "iqr")
    assert policy.duplicate_plan("keep_last") == {"keep": "last", "subset": None} and policy.duplicate_plan(None) is None
    for bad in (lambda: policy.duplicate_plan("merge"), lambda: policy.outlier_plan("cut", features), lambda: policy.missing_plan(3)):
        with pytest.raises(ValueError):
            bad()


@pytest.fixture(scope="module")
def posts(spark):
    rows = [
        (1, "First post about a sore knee and what to do", "a", 1.0, "7"),
        (2, "  first POST about a sore knee and what to do ", "a", 2.0, "8"),
        (3, "   ", "b", 3.0, "9"),
        (4, "Write to me at one@two.org about the sore back", None, 1000.0, "10"),
        (5, "short", "b", None, "x"),
        (6, None, " ", 4.0, None),
        (7, "A much longer post about nothing in particular " * 40, "a", 5.0, "12"),
    ]
    return spark.createDataFrame(rows, "row_id bigint, text string, label string, n double, code string")


def test_fix_steps_and_audit(posts):
    q = quality.Quality({"critical_text_columns": ["text"], "normalized_text_columns": ["text"]})
    out, actions = q.fix(posts, {"missing": {"text": "drop_rows", "default_numeric": "median", "default_categorical": "mode"}, "duplicates": {"subset": ["normalized_text"]}, "outliers": {"per_column": {"n": "clip_iqr", "char_len::text": "clip_iqr"}}, "redact_basic_pii": True, "drop_short_text": True})
    rows = {r["row_id"]: r for r in out.collect()}
    assert sorted(rows) == [1, 4, 7] and rows[4]["text"] == "Write to me at [REDACTED_EMAIL] about the sore back" and rows[4]["n"] < 1000 and len(rows[7]["text"]) > 1000
    counts = {(r["action"], r["issue_type"], r["target"]): r["count"] for r in actions.groupBy("action", "issue_type", "target").count().collect()}
    assert counts["removed", "missing", "text"] == 2 and counts["removed", "duplicates", "normalized_text"] == 1 and counts["changed", "outliers", "n"] == 1 and counts["reported", "outliers", "char_len::text"] == 1
    assert counts["changed", "pii", "text"] == 1 and counts["removed", "empty_or_short", "text"] == 1
    m = {r["metric"]: (r["before"], r["after"]) for r in q.compare(posts, out).collect()}
    assert list(m) == list(quality.METRICS) and m["rows"] == (7.0, 3.0) and m["text_pii_rows_flagged"] == (1.0, 0.0) and m["normalized_text_duplicates"] == (2.0, 0.0)
    assert q.report(posts).where("section = 'classes'").count() == 4


def test_quality_of_an_empty_table_and_languages(posts):
    q = quality.Quality({"text_checks": {"language": {"enabled": True, "expected": "en"}}}, detector=lambda c: F.when(c.contains("sore"), "en").otherwise("xx"))
    none = posts.where("false")
    out, actions = q.fix(none, q.policy.previews(policy.Columns.of(none))["strict"])
    assert out.count() == 0 and actions.count() == 0 and q.compare(none, none).count() == len(quality.METRICS)
    assert q.metrics(posts)["text_language_mismatch_rows"] == 1
    kept, _ = q.fix(posts, {"language_filter": {"expected": "en"}})
    assert 7 not in {r["row_id"] for r in kept.collect()} and quality.Quality().fix(posts, {"language_filter": {"expected": "en"}})[0].count() == 7


def test_numbers_and_nested_cells(spark):
    df = spark.createDataFrame([(1, "7", ["a"], {"k": 1}), (2, " 8 ", [], {}), (3, "x", None, None)], "row_id bigint, code string, l array<string>, m map<string,int>")
    got = {r["row_id"]: r for r in quality.Quality({"numeric_coercion_min_ratio": 0.6}).prepare(df).collect()}
    assert [got[k]["code"] for k in (1, 2, 3)] == [7.0, 8.0, None] and got[1]["l"] == '["a"]' and got[2]["l"] is None and got[2]["m"] is None


def test_approved_run_writes_everything(spark, posts, tmp_path):
    q = quality.Quality({"critical_text_columns": ["text"]})
    with pytest.raises(ValueError):
        q.apply(posts, {"approved": False}, str(tmp_path))
    out = q.apply(posts, {"approved": True}, f"file://{tmp_path}")
    removed = spark.read.parquet(f"{tmp_path}/removed_rows.parquet")
    assert out.count() + removed.count() == 7 and "rows" in (tmp_path / "comparison.md").read_text()
    assert json.loads((tmp_path / "decision_applied.json").read_text())["decision"] == {"approved": True}


def test_checks(spark, posts):
    assert checks.canonical_issues(posts.where("false")) == ["no rows"] and checks.canonical_issues(posts.drop("text")) == ["no text column"] and checks.canonical_issues(posts) == []
    assert checks.contract_issues(posts)[0].startswith("missing columns: id")
    assert checks.schema_issues(posts, ["text", "absent"], 0.1) == ["text is null in 14% of the rows", "missing column: absent"]
    with pytest.raises(ValueError):
        checks.check_annotatable(posts, "absent")
    with pytest.raises(ValueError):
        checks.check_annotatable(spark.createDataFrame([(None,), (" ",)], "text string"))
    with pytest.raises(ValueError, match="repeated ids"):
        checks.check_pool(posts.union(posts))
    with pytest.raises(ValueError, match="null texts"):
        checks.check_pool(posts)
    with pytest.raises(ValueError, match="fewer than two"):
        checks.check_pool(posts.where("row_id in (1, 2)"), label="label")
    with pytest.raises(ValueError):
        checks.trainable(posts.where("row_id = 1"))


def test_remainders_keep_the_order_of_ties():
    assert merge.largest_remainder({"a": 1, "b": 1, "c": 1}, 4) == {"a": 2, "b": 1, "c": 1}
    assert merge.effective_sample(5, 3) == 3 and merge.effective_sample(0, 3) == 0 and merge.effective_sample(None, 3) == 3 and merge.effective_sample(5, None) == 5


def test_exact_parts(spark):
    df = spark.range(1000).select(F.col("id").alias("row_id"), (F.col("id") % 3).cast("string").alias("label"))
    got = {r["part"]: r["count"] for r in active.bucket_split(df, label="label").groupBy("part").count().collect()}
    assert got == {"test": 200, "seed": 50, "pool": 750}
    assert active.split_sizes(6) == (1, 4) and active.split_sizes(7, test=0.9) == (4, 2)
    with pytest.raises(ValueError):
        active.bucket_split(df.limit(5))
    with pytest.raises(ValueError):
        active.bucket_split(df.withColumn("label", F.lit("a")), label="label")


def test_first_labels_and_kinds_of_f1(spark):
    base = spark.createDataFrame([(1, "x"), (2, "y")], "row_id bigint, final_label string")
    acc = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (2, None, 1)], "row_id bigint, label string, at int")
    assert {r["row_id"]: r["final_label"] for r in active.overlay_labels(base, acc, order="at").collect()} == {1: "b", 2: "y"}
    two = spark.createDataFrame([(1, "no", "no"), (2, "yes", "no"), (3, "yes", "yes")], "row_id bigint, label string, pred string")
    r = active.evaluate(two).first()
    assert r["f1_kind"] == "binary" and r["f1"] == pytest.approx(0.666667, abs=1e-6)
    assert active.evaluate(two.union(spark.createDataFrame([(4, "c", "c")], two.schema))).first()["f1_kind"] == "macro"
    assert active.oracle_column(["id", "label"]) == "label" and active.oracle_column(["true_label", "label"]) == "true_label"
    with pytest.raises(ValueError):
        active.settings({"active_learning": {"strategy": "best"}})
    with pytest.raises(ValueError):
        active.ingest(spark.createDataFrame([(1, "a"), (1, "b")], "row_id bigint, human_label string"))


def test_review_loop(spark, tmp_path):
    rows = [(i, f"{'sun and sea' if i % 2 else 'snow and ice'} trip {i % 7}", "warm" if i % 2 else "cold") for i in range(40)]
    df = spark.createDataFrame(rows, "row_id bigint, text string, label string")
    loop = active.Review(f"file://{tmp_path}", k=4, iterations=20)
    labelled, pool, test = df.where("row_id < 10"), df.where("row_id >= 20"), df.where("row_id between 10 and 19")
    queue = loop.step(labelled, pool, test, 0)
    assert queue.count() == 4 and set(queue.columns) >= {"iteration", "human_label", "selection_score"}
    reviewed = queue.drop("human_label").join(df.select("row_id", F.col("label").alias("human_label")), "row_id")
    more, rest = loop.advance(labelled, pool, reviewed)
    assert more.count() == 14 and rest.count() == 16 and loop.history(spark).count() == 1
    histories = active.compare_strategies(labelled, pool, test, ("random", "margin"), rounds=1, k=4, iterations=20)
    assert active.learning_curve(spark, histories).count() == 4


def test_hits_become_candidates_and_specs(spark):
    hits = [
        ("huggingface", "q", "Org/Knee-Text", "https://hub.example/d/1", "texts", json.dumps({"id": "Org/Knee-Text", "tags": ["text", "en", "text-classification"], "downloads": 12})),
        ("github", "q", "t", "https://code.example/o/r", None, json.dumps({"full_name": "o/r", "topics": ["csv"], "secret": "x"})),
        ("web_forum", "q", "Knee forum", "https://www.duckduckgo.com/l/?uddg=https%3A%2F%2Fb.example%2Fforum%2F1", "a discussion", "{}"),
        ("devtools_har", "q", "hint", "https://c.example/x", "", json.dumps({"json_url": "https://c.example/api/posts", "page_url": "https://c.example/x"})),
    ]
    df = spark.createDataFrame(hits, planning.HITS)
    got = {r["type"]: r for r in planning.candidates(df, "knee pain", "text", "classification", "english").collect()}
    assert set(got) == {"hf_dataset", "github_dataset", "scrape", "api"}
    assert got["hf_dataset"]["relevance"] == pytest.approx(0.5 + 0.2 + 0.1 * 4 / 6 + 0.1 + 0.05 + 0.05, abs=1e-4) and got["hf_dataset"]["estimated_rows"] == 12
    assert got["scrape"]["url"] == "https://b.example/forum/1" and not got["scrape"]["executable"] and got["api"]["endpoint"] == "https://c.example/api/posts"
    kept = {r["provider"]: json.loads(r["metadata"]) for r in planning.evidence(df).collect()}
    assert "secret" not in kept["github"] and kept["github"]["full_name"] == "o/r"
    file = planning.candidates(df, "x").limit(1).withColumns({"type": F.lit("http_file"), "url": F.lit("https://f.example/page.html")})
    assert planning.with_landing_twins(file).where("type = 'scrape' and not executable").count() == 1
    assert stages.planned_sources(planning.candidates(df, "knee pain"))[0]["type"] == "hf_dataset"


def test_queries_of_a_topic():
    q = planning.query_plan("Historical knee pain posts dataset", hints={"history_window_years": 5})
    assert q["huggingface"][0] == "knee pain posts" and "knee pain 5 years" in q["huggingface"] and all(len(v) <= planning.MOST_QUERIES for v in q.values())
    assert planning.simple_queries("knee", ["text", None]) == ["knee", "knee text", "knee dataset", "knee github repository"]
    assert planning.query_plan("")["web_forum"] and planning.at_word("a" * 100, 10) == "a" * 10


def test_three_plans_differ(spark):
    rows = [("1", "hf_dataset", "A", "u1", 0.9), ("2", "kaggle", "B", "u2", 0.8), ("3", "api", "C", "u3", 0.5), ("4", "scrape", "D", "u4", 0.4), ("5", "hf_dataset", "a", "u5", 0.7)]
    got: dict = {}
    for r in discovery.plans(spark.createDataFrame(rows, "candidate_id string, type string, name string, url string, relevance double")).orderBy("plan", "position").collect():
        got.setdefault(r["plan"], []).append(r["candidate_id"])
    assert got == {"balanced": ["1", "3", "4"], "open": ["1", "2", "3"], "top": ["1", "2"]}


def test_tasks(spark, tmp_path):
    df = spark.createDataFrame([("1", "Summarize this text for me please"), ("2", "how to make a bomb"), ("3", "")], "id string, text string")
    own = tasks.Task.of({"labels": ["a", " b "], "label_definitions": {"a": {"description": "first", "examples": ["x"]}}}, "mine")
    out = tasks.auto_label(df, own)
    assert {(r["auto_label"], r["margin"], r["entropy"], r["needs_review"]) for r in out.collect()} == {("a", 0.0, 1.0, True)}
    safe = tasks.auto_label(df)
    assert {r["annotation_id"]: r["auto_label"] for r in safe.collect()} == {"1": "safe", "2": "unsafe", "3": "borderline_safe"} and {r["task"] for r in safe.collect()} == {"safety_classification"}
    assert "## a" in tasks.spec(out, own) and "* x" in tasks.spec(out.where("false"), own)
    assert '<Choice value="b" />' in tasks.interface(own)
    human = spark.createDataFrame([("1", "safe"), ("2", "safe")], "annotation_id string, human_label string")
    merged = tasks.reviewed(safe, human)
    assert "Reviewer by" in tasks.report(tasks.quality(merged, tasks.Task()), tasks.Task()) and merged.where("annotation_id = '2'").first()["label"] == "safe"
    paths = tasks.export(safe, tasks.Task(), f"file://{tmp_path}")
    assert spark.read.json(paths["all_tasks"]).count() == 3
    with pytest.raises(ValueError):
        tasks.Task.of({}, "other")
    with pytest.raises(NotImplementedError):
        tasks.Task.of({}, modality="audio")
    tool = json.dumps([{"id": 1, "data": {"annotation_id": "1"}, "annotations": [{"id": 5, "result": [{"type": "choices", "value": {"choices": ["odd"]}}]}]}])
    files = spark.createDataFrame([(tool,)], "p string")
    assert tasks.imported(files, "p").first()["human_label"] == "odd"
    with pytest.raises(ValueError, match="doesn't know"):
        tasks.imported(files, "p", ("safe",))
    with pytest.raises(ValueError, match="several tasks"):
        tasks.imported(files.union(files), "p")
    assert tasks.imported(files.union(files), "p", repeats="last").count() == 1


def test_staged_pages(spark):
    paging = {"page_param": "p", "max_pages": 4, "page_size_param": "n", "page_size": 2}
    urls = pages.page_urls("https://a.example/api?x=1", {"y": 2}, paging)
    assert urls[0] == "https://a.example/api?x=1&y=2&p=1&n=2" and len(urls) == 4 and pages.page_urls("https://a.example/api") == ["https://a.example/api"]
    bodies = ['{"d": {"rows": [{"id": "1"}, {"id": "2"}]}}', '{"d": {"rows": [{"id": "3"}]}}', '{"d": {"rows": []}}', '{"d": {"rows": [{"id": "9"}]}}']
    staged = spark.createDataFrame([(u, 200, "application/json", None, b) for u, b in zip(urls, bodies)], "url string, status int, content_type string, disposition string, payload string")
    got = pages.paged_records(staged, "https://a.example/api?x=1", {"id": "string"}, "d.rows", {"y": 2}, paging)
    assert sorted((r["page"], r["id"]) for r in got.collect()) == [(1, "1"), (1, "2"), (2, "3")]
    with pytest.raises(ValueError, match="answer 500"):
        pages.paged_records(staged.withColumn("status", F.lit(500)), "https://a.example/api?x=1", {"id": "string"}, "d.rows", {"y": 2}, paging)
    other = spark.createDataFrame([("https://a.example/x.html", 200, "text/html; charset=utf-8", None, "<html>"), ("https://a.example/x.csv", 200, "text/csv", None, "a,b\n1,2"), ("https://a.example/y.csv", 404, None, None, "")], staged.schema)
    assert {r["url"][-6:]: r["reason"] for r in pages.refused(other).collect()} == {"x.html": "a landing page", "/y.csv": "answer 404"}
    assert pages.retry_after(429, "9999", 0) == 300 and pages.retry_after(503, "soon", 3) == 8 and pages.retry_after(404, None, 0) is None
    assert pages.payload_format("https://a.example/get", None, None, '{"a": 1}\n{"a": 2}') == "jsonl" and pages.payload_format("https://a.example/get", None, None, "a\tb") == "tsv" and pages.payload_format("u", None, None, "<html>") is None
    repo = spark.createDataFrame([("data/a.csv", 1), ("README.csv", 1), ("a/b/c/d/e/f.csv", 1), ("src/x.py", 1)], "path string, size int")
    assert [r["path"] for r in pages.listed(repo).collect()] == ["data/a.csv"] and pages.listed(repo, subpath="a/b").count() == 1
    assert pages.loader_options({"dataset_id": "x", "sample_size": 5})["split"] == "train[:5]"
    assert pages.flattened(spark.sql("select 1 as a, named_struct('b', named_struct('c', 2)) as s")).columns == ["a", "s_b_c"]


def test_probe_cascade(spark):
    item = "<li class='topic-post'><h2>T{0}</h2><a href='/t/{0}'>open</a><p>This is the body of post number {0}, long enough.</p><time datetime='2024-01-0{0}'></time></li>"
    listing = "<html><body><ul>" + "".join(item.format(i) for i in range(1, 5)) + "</ul><a class='next' href='/p2'>more</a></body></html>"
    p = html.probe(listing, "https://a.example/")
    assert p["mode"] == "repeated_items" and p["item_selector"] == "li.topic-post" and p["items"] == 4 and p["previews"][0]["link"] == "https://a.example/t/1" and p["previews"][0]["date"] == "2024-01-01"
    assert html.probe("<article>" + "word " * 30 + "</article>")["mode"] == "forum_first_post" and html.probe("<main>" + "word " * 100 + "</main>")["mode"] == "main_text" and html.probe("")["mode"] == "none" and html.probe(None)["mode"] == "none"
    spec = html.planned_spec("https://a.example/", p)
    assert html.readable_spec(spec) and not html.readable_spec(html.planned_spec("u", html.probe(""))) and html.spec_mode({"planner_notes": ["auto_probe: mode=main_text"]}) == "main_text"
    staged = spark.createDataFrame([("https://a.example/", listing), ("https://a.example/p2", listing.replace("T1", "U1").replace("class='next'", "")), ("https://b.example/", listing)], "url string, html string")
    rows = html.crawl(staged, {**spec, "next_selector": "a.next"}, hosts=("a.example",))
    assert [r["title"] for r in rows.collect()] == ["T1", "T2", "T3", "T4", "U1", "T2", "T3", "T4"] and html.crawl(staged, spec, hosts=("b.example",)).count() == 0
    assert html.crawl(staged, {**spec, "next_selector": "a.next"}, most_rows=5).count() == 5
    meta = json.loads(html.enriched(rows, "a").first()["metadata"])
    assert meta["thread_id"] == "1" and meta["created_at"] == "2024-01-01"
    assert {r["mode"] for r in html.probed(staged).collect()} == {"repeated_items"}


def test_sinks(spark, tmp_path):
    assert sinks.json_safe({"b": float("nan"), "a": {2, 1}, "c": b"x"}) == {"a": [1, 2], "b": None, "c": "x"}
    assert sinks.cell(1.5) == "1.5000" and sinks.cell({"k": None}) == '{"k": null}' and sinks.cell("a|b\nc") == "a\\|b c" and sinks.cell(None) == ""
    df = spark.createDataFrame([(1, ["x"], b"y", "3", "2020-01-01")], "a int, l array<string>, b binary, n string, t string")
    assert spark.read.csv(sinks.write_table(df, f"{tmp_path}/x.csv"), header=True, escape='"').first()["l"] == '["x"]'
    h = sinks.harmonized(df, ("n",), ("t",))
    assert dict(h.dtypes)["n"] == "double" and dict(h.dtypes)["t"] == "timestamp" and h.first()["b"] == "y"
    one = spark.createDataFrame([("s", "s", "t", "x", None)], "source_id string, source string, source_type string, text string, label string")
    with pytest.raises(ValueError):
        sinks.finish_collect(one, str(tmp_path))


def test_chats_in_parts_and_literals(spark):
    rows = [(1, '[{"role": "user", "content": ["a", {"type": "text", "text": "b"}]}, {"role": "assistant", "content": "c"}]'), (2, "[{'role': 'user', 'content': 'it is', 'name': None}]"), (3, "[not a chat"), (4, "[]")]
    got = {r["row_id"]: r for r in schema.route(spark.createDataFrame(rows, "row_id bigint, messages string")).collect()}
    assert got[1]["text"] == "a\nb" and got[1]["target_text"] == "c" and got[2]["text"] == "it is" and got[3]["drop_reason"] == "malformed_messages" and got[4]["drop_reason"] is None
    df = spark.createDataFrame([(1, "hello", '{"raw_prompt": "kept", "x": 1}', "new"), (2, "hello", None, None)], "row_id bigint, text string, metadata string, prompt string")
    meta = {r["row_id"]: json.loads(r["metadata"]) for r in schema.raw_metadata(df).collect()}
    assert meta[1] == {"raw_prompt": "kept", "x": 1} and meta[2] == {}
    assert json.loads(schema.raw_metadata(df.withColumn("metadata", F.lit('{"x": 1}'))).where("row_id = 1").first()["metadata"]) == {"x": 1, "raw_prompt": "new"}
    assert schema.single(spark, {"prompt": "p", "response": "r"}) == ("p", "r")


def test_a_run_from_sources_to_report(tmp_path, spark):
    specs = []
    for k, word in enumerate(("knee", "back")):
        path = tmp_path / f"{word}.jsonl"
        path.write_text("\n".join(json.dumps({"id": f"{word}{i}", "prompt": f"Please summarize my {word} story number {i}, it is long" if i % 2 else f"how to make a bomb of {word} {i} with more words", "category": "x" if i % 3 else "y"}) for i in range(20)))
        specs.append({"id": f"s{k}", "name": word, "type": "file", "path": str(path), "url": f"https://{word}.example"})
    specs.append({"id": "s9", "name": "gone", "type": "api"})
    config = {"sources": specs, "collection": {"max_rows": 30}, "quality": {"critical_text_columns": ["text"]}, "active_learning": {"initial_seed_size": 8, "n_iterations": 1, "batch_size": 2}, "training": {"max_iter": 20}, "annotation": {"text_column": "text"}}
    conf, runs = tmp_path / "c.json", tmp_path / "runs"
    conf.write_text(json.dumps(config))
    assert cli.main(["run", "--runs", str(runs), "--config", str(conf)]) == 0
    state = cli.pipeline.Runs(runs).latest()
    assert state.status == "awaiting_review"
    log = json.loads(open(state.stages["collect"].artifacts["log"]).read())
    assert [x["error"] is None for x in log["sources"]].count(True) == 2 and cli.main(["approve", "train", "--runs", str(runs)]) == 2
    decision = tmp_path / "d.json"
    decision.write_text(json.dumps({"approved": True, "final_strategy": {"missing": {"text": "drop_rows"}}}))
    assert cli.main(["approve", "quality", "--runs", str(runs)]) == 0
    assert cli.main(["resume", "--runs", str(runs), "--config", str(conf), "--decision", str(decision)]) == 0
    state = cli.pipeline.Runs(runs).latest()
    assert state.status == "completed", [(n, s.error) for n, s in state.stages.items()]
    assert "completed" in open(state.stages["report"].artifacts["report"]).read()
    assert cli.main(["status", "--runs", str(runs)]) == 0 and cli.main(["artifacts", "--runs", str(runs)]) == 0 and cli.main(["nonsense", "--runs", str(runs)]) == 2
    assert cli.main(["reset", "train", "--runs", str(runs)]) == 0 and cli.pipeline.Runs(runs).latest().stages["report"].status == "pending"
