import random
import time
from collections import Counter

from pyspark.sql import functions as F

from textloom.llm import boilerplate as bp
from textloom.llm import langid, pii


def merged(spark, rows):
    return spark.createDataFrame(rows, "row_id bigint, text string, body string, title string, source string, source_id string")


def test_pii_bootstraps_unseen_forms(spark):
    rows = []
    for i in range(40):
        name = ["Peter", "Anna", "Tom", "Grace"][i % 4] + " " + ["Zelmond", "Orvale", "Kessoux", "Marbury"][(i // 4) % 4]
        rows.append((i, f"It hurts a lot at night, {i} days now. My name is {name} and I am new. Call me any time on +44 7700 900 {100 + i}, please. I live at {i + 1} Mill {'Road' if i % 2 else 'Crescent'}, Wexcombe now.", None, None, "s", "s"))
    rows.append((100, "My name is Quorra Zyx and I am new. Call me any time on 0171 39200 08, please.", "write to x_y [at] mail (dot) example", None, "s", "s"))
    rows.append((101, "The order number 5502-41696 came. The reading was 163/71 on 2020-01-02. Ask @nurse_anon or tag mossy_77@home.", "", None, "s", "s"))
    rows.append((102, None, None, None, None, None))
    df = merged(spark, rows)
    got = {tuple(r) for r in pii.found(df).collect()}
    assert {(0, "text", t) for t in ("name", "phone", "address")} <= got
    assert (100, "text", "name") in got and (100, "text", "phone") in got and (100, "body", "email") in got
    assert not any(r in (101, 102) for r, _, _ in got)
    out = {r["row_id"]: r["text"] for r in pii.redacted(df).collect()}
    assert "[NAME]" in out[0] and "[PHONE]" in out[0] and "Peter" not in out[0] and "It hurts a lot at night" in out[0]
    assert out[102] is None


def test_fold_keeps_offsets():
    t = "Ｎａｍｅ é­x ß"
    at = pii.origins(t)
    assert len(at) == len(pii.fold(t)) + 1 and at[-1] == len(t)


def test_pii_of_an_empty_table(spark):
    assert pii.found(merged(spark, [])).count() == 0


EN = ["The pain moves from my neck to my arm and it is worse at night.", "I have been taking the tablets for three weeks and nothing has changed.", "Should I go to the doctor or just wait until it gets better?"]
DE = ["Der Schmerz zieht vom Nacken bis in den Arm und ist nachts schlimmer.", "Ich nehme seit drei Wochen die Tabletten und nichts hat sich verändert.", "Soll ich zum Arzt gehen oder einfach warten, bis es besser wird?"]


def test_languages(spark):
    rows = [(i, " ".join(EN[i % 3 :] + EN[: i % 3]) + f" {i}.", None, None, "a", "en1") for i in range(30)]
    rows += [(50 + i, " ".join(DE[i % 3 :] + DE[: i % 3]) + f" {i}.", None, None, "a", "de1") for i in range(30)]
    rows += [(90, " ".join(DE), None, None, "a", "en1"), (91, " ".join(EN) + " " + DE[1], None, None, "a", "en1"), (92, EN[0].upper(), None, None, "a", "none"), (93, None, None, None, "a", "en1"), (94, "  ", None, None, "a", "en1")]
    sources = spark.createDataFrame([("en1", "p1"), ("de1", "p2"), ("none", "p3")], "id string, profile_id string")
    profiles = spark.createDataFrame([("p1", "EN-us"), ("p2", " Deutsch "), ("p3", "unknown")], "profile_id string, language string")
    got = {tuple(r) for r in langid.found(merged(spark, rows), sources, profiles).collect()}
    assert got == {(90, "de"), (91, "en"), (91, "de"), (92, "en")}
    rec = {r["row_id"]: r for r in langid.by_record(merged(spark, rows), sources, profiles).collect()}
    assert rec[0]["lang"] == "en" and rec[0]["declared"] == "en" and 0 < rec[0]["confidence"] <= 1
    assert langid.found(merged(spark, []), sources, profiles).count() == 0


def test_renderer():
    html = "<html><head><title>t</title><style>x</style></head><body><nav style='display: none'>hidden</nav><h1>Title</h1><p>One<p>Two <b>bold</b><ul><li>a<li>b<ul><li>c</ul></ul><blockquote>said</blockquote><table><tr><th>Name<th>Age<tr><td>Al<td>5<tr><td>Barbara<td>61</table><script>x()</script><ol><li>x<li>y</ol><pre> a\n  b</pre>end<br>line</body></html>"
    got = bp.render(html).split("\n")
    assert [x for x in got if x] == ["Title", "One", "Two bold", "* a", "* b", "  * c", "> said", "Name     Age", "Al       5", "Barbara  61", "1. x", "2. y", " a", "  b", "end", "line"]
    assert bp.render("") == "" and bp.render("<p hidden>x</p>") == ""


def test_furniture(spark):
    rows = []
    word = lambda i, k: f"w{chr(97 + i % 26)}{chr(97 + (i * 7 + k) % 26)}{chr(97 + (i // 26 + k) % 26)}"
    for i in range(60):
        story = "This is the long story of a patient who has had pain for many years and whom nothing helped: " + " ".join(word(i, k) for k in range(20)) + "."
        text = "\n".join(["Home | Forums | Log in", f"Start » {word(i, 3)} » forum.demo.example", f"Posted by user{i % 3} on {i}/5/24 - {i} replies", f"Title of {word(i, 1)} {word(i, 2)}", story, "", f"* item {word(i, 4)} {word(i, 5)}", "Most read", f"Thread {word(i, 6)} {word(i, 9)}", f"Another {word(i, 7)} {word(i, 8)} ({i})", "© 2024 forum.demo.example. All rights reserved."])
        rows.append((i, text, None, None, "forum.demo.example", "s1"))
    rows += [(100, None, None, None, "x", "s"), (101, "", None, None, None, None), (102, "Age: 1\nSex: m\nSite: x\nMood: y", None, None, "forum.demo.example", "s1")]
    got: dict[int, set] = {}
    for r in bp.found(merged(spark, rows)).collect():
        got.setdefault(r["row_id"], set()).add(r["line_no"])
    assert set(got) == set(range(60))
    assert got[7] == {1, 2, 3, 8, 9, 10, 11}
    main = {r["row_id"]: r["text"] for r in bp.main_text(merged(spark, rows)).collect()}
    assert main[7].startswith("Title of") and "Most read" not in main[7] and main[100] is None
    assert bp.found(merged(spark, [])).count() == 0


def test_streets_known_by_context_alone():
    from textloom.llm import pii

    for ctx, text in (("| address", "Address Plaxa Quxhof 12"), ("living at the", "she was living at the Plaxa Quxhof 12 then")):
        model = pii.Model({k: {ctx: 0.9} if k == "address" else {} for k in pii.TYPES}, {k: {} for k in pii.TYPES}, set())
        assert [x[2] for x in pii.find(text, model)] == ["address"]


def test_the_model_keeps_all_contexts_and_instances(spark, monkeypatch):
    from textloom.llm import pii

    monkeypatch.setattr(pii, "MODEL", 1, raising=False)
    rows = [(f"My {w} is +49 30 {1000000 + 7 * i}{k}.",) for i, w in enumerate(("mobile", "phone", "telephone")) for k in range(4)]
    rows += [(f"My {w} is 0049-{i}{k}-12345{k}{k}.",) for i, w in enumerate(("mobile", "phone", "telephone")) for k in range(4)]
    model = pii.fit(spark.createDataFrame(rows, "text string"), body=None)
    assert len(model.ctx["phone"]) > 1 and len(model.inst["phone"]) > 1


def test_marked_up_pages_lose_their_frames_by_rendering(spark):
    page = "<html><body><nav><ul><li><a href=/>Start</a><li>Forum</ul></nav><div class='cookie-banner'><p>We use cookies.</p></div><article><h1>My knee</h1><p>It has hurt for {} days, and stairs are the worst of all.<ul><li>ice<li>rest</ul></article><aside>Related<p>Other knees</aside><footer>Imprint</footer><p style='display:none'>secret</p></body></html>"
    rows = [(1, page.format(3), None, "My knee", "a.example", "s"), (2, "<div>" * 3000 + "deep" + "</div>" * 3000, None, None, "b.example", "s")]
    got = {r["row_id"]: r["text"] for r in bp.main_text(merged(spark, rows)).collect()}
    assert [x for x in got[1].split("\n") if x] == ["My knee", "It has hurt for 3 days, and stairs are the worst of all.", "* ice", "* rest"]
    assert got[2].strip() == "deep" or "deep" in got[2]
    lines = bp.lines_of(page.format(3))
    found = {r["line_no"] for r in bp.found(merged(spark, rows)).collect() if r["row_id"] == 1}
    assert {lines[n - 1] for n in found} == {"* Start", "* Forum", "We use cookies.", "Related", "Other knees", "Imprint"}


def test_furniture_is_the_same_when_keys_are_joined(spark, monkeypatch):
    rows = [(i, f"Home | Forums | Log in\nPosted by user{i} on {i}/5/24\nThis is story number {chr(97 + i)} of a patient with long words and no end in sight", None, None, f"{'ab'[i % 2]}.example", "s") for i in range(20)]
    rows += [(100, None, None, None, None, None)]
    sent = sorted(map(tuple, bp.found(merged(spark, rows)).collect()))
    monkeypatch.setattr(bp, "SENT", 0)
    assert sent and sorted(map(tuple, bp.found(merged(spark, rows)).collect())) == sent


ES = ["El dolor pasa del cuello al brazo y por la noche es peor que nunca.", "Tomo las pastillas desde hace tres semanas y no ha cambiado nada.", "No sé si debo ir al médico o esperar a que se me pase con el tiempo."]
FR = ["La douleur passe du cou au bras et elle est pire pendant la nuit.", "Je prends les comprimés depuis trois semaines et rien ne change.", "Dois-je aller chez le médecin ou attendre que cela passe avec le temps ?"]


def test_languages_that_no_source_declares(spark):
    rows = [(i, " ".join(EN[i % 3 :] + EN[: i % 3]) + f" {i}.", None, None, "a", "en1") for i in range(30)]
    rows += [(50 + i, " ".join(FR[i % 3 :] + FR[: i % 3]) + f" {i}.", None, None, "a", "fr1") for i in range(30)]
    rows += [(100 + i, " ".join(ES[i % 3 :] + ES[: i % 3]) + f" {i}.", None, None, "a", "none") for i in range(30)]
    rows += [(200, "Zxq vrrk bnnt plmmk wqqz trrg hjjk vzzx qwwk plrr tnnk zzvq. Kkrw qqzt vbbn mmlk rrtq zzxw hhjk ppqz. " * 2, None, None, "a", "none")]
    sources = spark.createDataFrame([("en1", "p1"), ("fr1", "p2"), ("none", "p3")], "id string, profile_id string")
    profiles = spark.createDataFrame([("p1", "en"), ("p2", "fr"), ("p3", None)], "profile_id string, language string")
    rec = {r["row_id"]: r for r in langid.by_record(merged(spark, rows), sources, profiles).collect()}
    assert {rec[100 + i]["lang"] for i in range(30)} == {"es"}
    assert rec[0]["lang"] == "en" and rec[50]["lang"] == "fr"
    assert rec[200]["lang"] == "und" and rec[200]["confidence"] == 0.0


def test_pii_is_the_same_when_contexts_are_joined(spark, monkeypatch):
    rows = []
    for i in range(40):
        name = ["Peter", "Anna", "Tom", "Grace"][i % 4] + " " + ["Zelmond", "Orvale", "Kessoux", "Marbury"][(i // 4) % 4]
        rows.append((i, f"It hurts. My name is {name} and I am new. Call me any time on +44 7700 900 {100 + i}, please. I live at {i + 1} Mill {'Road' if i % 2 else 'Crescent'}, Wexcombe now.", f"Regards. My name is {name}" if i % 3 else None, None, "s", "s"))
    rows += [(100, "My name is Quorra Zyx and I am new. Call me any time on 0171 39200 08, please.", "x_y [at] mail (dot) example", None, "s", "s"), (101, None, "", None, None, None)]
    df = merged(spark, rows)
    sent = sorted(map(tuple, pii.found(df).collect()))
    clean = sorted((r["row_id"], r["text"] or "", r["body"] or "") for r in pii.redacted(df).collect())
    monkeypatch.setattr(pii, "SENT", 0)
    assert len(sent) > 100 and sorted(map(tuple, pii.found(df).collect())) == sent
    assert sorted((r["row_id"], r["text"] or "", r["body"] or "") for r in pii.redacted(df).collect()) == clean


def test_profiles_come_from_all_records(spark):
    rows = [(i, "The pain goes from the neck down to the arm and nothing helps it at night.", "en") for i in range(3000)]
    fitted = langid.train(spark.createDataFrame(rows, "row_id bigint, text string, declared string"))
    rare = spark.createDataFrame([*rows, (3000, "Qqqxq qqqxq qqqxq qqqxq qqqxq qqqxq. " * 200, "en")], "row_id bigint, text string, declared string")
    assert "qqx" not in fitted.ranked["en"]
    # whatever its row id, the one record that differs counts
    for k in range(4):
        got = langid.train(rare.withColumn("row_id", F.col("row_id") * 7 + k))
        assert "qqx" in got.ranked["en"]
    spanish = [(4000 + 500 * i, " ".join(ES), None) for i in range(20)] + [(10**6 + i, EN[i % 3], "en") for i in range(40_000)]
    assert "es" in langid.train(spark.createDataFrame(spanish, "row_id bigint, text string, declared string")).langs


def test_distances_take_few_times_the_cost_of_cutting_words():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 10))) for _ in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=14)) for _ in range(6000)]
    cut = [langid._TOKEN.findall(t) for t in texts]
    counts = Counter(g for ws in cut for w in ws for g in langid.grams(w))
    ranked = [g for g, _ in counts.most_common(langid.PROFILE)]
    profiles = langid.Profiles({lang: ranked[k:] + ranked[:k] for k, lang in enumerate(("de", "en", "es", "fr", "ru"))})

    def least(f):
        took = []
        for _ in range(5):
            began = time.thread_time()
            f()
            took.append(time.thread_time() - began)
        return min(took)

    ratio = least(lambda: profiles.distances(cut)) / least(lambda: [langid._TOKEN.findall(t) for t in texts])
    assert ratio < 3.6, ratio


def test_grams_of_any_count_are_ranked_by_it():
    profiles = langid.Profiles({"xx": ["bb", "bbb", "aa", "aaa"]})
    d, total = profiles.distances([["a" * 5000, "b" * 6000]])
    # bb, bbb, aa and aaa are where the profile has them, and six grams of the words' ends aren't in it
    assert total[0] == 4999 + 4998 + 5999 + 5998 + 8 and round(d[0, 0] * total[0]) == 8


def test_words_that_were_forgotten_are_counted(spark, monkeypatch):
    rows = [(i, " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + k)}word" for k in range(9)) + ".", "en") for i in range(400)]
    df = spark.createDataFrame(rows, "row_id bigint, text string, declared string").coalesce(1)
    want = langid.train(df)
    monkeypatch.setattr(langid, "WORDS_HELD", 20)
    got = langid.train(df)
    assert got.ranked == want.ranked and got.limits == want.limits
