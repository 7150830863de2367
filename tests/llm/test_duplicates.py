import random

import numpy as np
import pytest

from textloom.llm import bagminhash as bm
from textloom.llm import overlap
from textloom.llm.components import components
from textloom.llm.normal import normal, words


def bag(rng, n, shared, seed):
    return np.unique(rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64))


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    u = np.unique(rng.integers(0, 2**63, 300, dtype=np.int64).astype(np.uint64))
    a, b = u[:200], u[50:250]
    ca, cb = np.ones(200, int), np.ones(200, int)
    ca[100:120], cb[50:60] = 7, 3
    da, db = dict(zip(a.tolist(), ca)), dict(zip(b.tolist(), cb))
    keys = set(da) | set(db)
    true = sum(min(da.get(k, 0), db.get(k, 0)) for k in keys) / sum(max(da.get(k, 0), db.get(k, 0)) for k in keys)
    est = np.mean([(bm.signature(bm.mix(a + np.uint64(r)), ca, 256) == bm.signature(bm.mix(b + np.uint64(r)), cb, 256)).mean() for r in range(40)])
    assert est == pytest.approx(true, abs=0.02)


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    bags = [(np.unique(rng.integers(0, 2**63, k, dtype=np.int64).astype(np.uint64)),) for k in (1, 3, 80, 500, 3000)]
    bags = [(b[0], rng.integers(1, 9, len(b[0]))) for b in bags]
    together = bm.signatures(bags, 64)
    for i, b in enumerate(bags):
        assert (bm.signature(*b, 64) == together[i]).all()


def edited(rng, ws, share):
    out = []
    for w in ws:
        x = rng.random()
        if x < share / 2:
            out.append(f"new{rng.randrange(10**6)}")
        elif x > 1 - share / 4:
            continue
        else:
            out.append(w)
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.randrange(90, 200))]
        texts.append(" ".join(base))
        texts.append(" ".join(edited(rng, base, 0.06)))
        cut = rng.randrange(20, len(base) - 20)
        texts.append(" ".join(base[cut:] + base[:cut]))
    texts += [texts[0].upper(), texts[0].replace(" ", "  "), " ".join(texts[3].split()[:60]), "short", None, "", "!!!"]
    splits = ["train", "Train", "train[:80%]", "test", "valid", None]
    return [(i, t, splits[i % 6] if i % 7 else "dev", "src") for i, t in enumerate(texts)]


def brute(corpus):
    runs, letters = {}, {}
    for i, t, _, _ in corpus:
        ws = words(normal(t or ""))
        letters[i] = "".join(ws)
        if len(ws) >= 80:
            runs[i] = bm.word_runs(ws, 3)
    return {(a, b) for a in runs for b in runs if a < b and letters[a] != letters[b] and bm.jaccard(runs[a], runs[b]) >= 0.5}, letters


def frame(spark, corpus):
    return spark.createDataFrame(corpus, "row_id bigint, text string, split string, source string")


def test_near_duplicates_against_brute_force(spark, corpus):
    want, _ = brute(corpus)
    rows = [tuple(r) for r in bm.found(frame(spark, corpus)).collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) <= want and len(set(rows)) >= 0.97 * len(want)
    linked = {r["row_id"]: r for r in bm.linked(frame(spark, corpus)).collect()}
    assert linked[0]["copies"] == 3 and linked[0]["class_id"] == 0


def test_overlaps_against_brute_force(spark, corpus):
    near, letters = brute(corpus)
    side = {i: "t" if s and s.lower().startswith("train") else "e" if s else None for i, _, s, _ in corpus}
    same = {(a, b) for a in letters for b in letters if a < b and letters[a] and letters[a] == letters[b]}
    want = {p for p in near | same if {side[p[0]], side[p[1]]} == {"t", "e"}}
    rows = [tuple(r) for r in overlap.found(frame(spark, corpus)).collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) <= want and len(set(rows)) >= 0.95 * len(want)
    report = overlap.report(frame(spark, corpus)).collect()
    assert sum(r["records"] for r in report) == sum(v == "e" for v in side.values())


def test_short_and_reformatted_copies_overlap(spark):
    rows = [(1, "head-ache!", "train", "a"), (2, "HEADACHE", "test", "a"), (3, "Age: 1\nSex: m\nSite: x\nMood: y", "train", "a"), (4, "Mood: y | Site: x | Sex: M | Age: 1", "dev", "a"), (5, None, "test", "a"), (6, "headache", None, "a")]
    assert {tuple(r) for r in overlap.found(frame(spark, rows)).collect()} == {(1, 2), (3, 4)}


def test_empty_tables(spark):
    assert bm.found(frame(spark, [])).count() == 0
    assert overlap.found(frame(spark, [])).count() == 0


def variants(n, seed=5, words=90, at=(15, 45, 75)):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(3000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        ws = list(base)
        for k in at:
            ws[k + rng.randrange(3) - 1] = f"new{rng.randrange(10**9)}"
        out.append(" ".join(ws))
    return out


@pytest.mark.parametrize("n", [60, 200])
def test_edited_copies_in_a_hot_group_overlap(spark, n):
    rows = [(i, t, "test" if i % 2 else "train", "a") for i, t in enumerate(variants(2 * n))]
    assert len({tuple(r) for r in overlap.found(frame(spark, rows)).collect()}) == n * n
    (line,) = overlap.report(frame(spark, rows)).collect()
    assert (line["records"], line["overlapping"], line["near"], line["same"]) == (n, n, n, 0)


def test_report_agrees_with_pairs(spark, corpus):
    over = overlap.Overlaps(frame(spark, corpus))
    best = {}
    for r in over.class_pairs().collect():
        c, s = best.get(r["e_class"], (0.0, False))
        best[r["e_class"]] = (max(c, r["coverage"]), s or r["same"])
    assert {r["k"]: (r["coverage"], r["same"]) for r in over.best().collect()} == best


def test_automaton_finds_records_that_routing_did_not_name():
    shard = overlap._Shard()
    hashes = bm.WordHashes()
    ws = [f"w{i}" for i in range(100)]
    shard.add(1, " ".join(ws), hashes)
    shard.add(2, " ".join(ws[:50] + [f"x{i}" for i in range(50)]), hashes)
    shard.add(3, "short text", hashes)
    shard.freeze()
    got = {(shard.names[r], round(c, 2), s) for r, c, s in shard.overlaps(9, " ".join(ws[:94] + ["y"] * 6), hashes, False)}
    assert got == {(1, 0.94, False)} or got == {(1, 0.9, False)}
    assert [(shard.names[r], c, s) for r, c, s in shard.overlaps(3, "SHORT, text", hashes, False)] == [(3, 1.0, True)]


def test_hot_families_are_one_class_by_few_links(spark):
    texts = variants(300)
    other = variants(3, seed=6)
    far = " ".join(texts[0].split()[:60] + [f"z{i}" for i in range(30)])
    rows = [(i, t, "train", "a") for i, t in enumerate([*texts, *other, far])]
    near = bm.NearDuplicates(frame(spark, rows))
    assert near.links().count() < 300 * 40
    classes = {r["row_id"]: r["class_id"] for r in bm.linked(frame(spark, rows)).collect()}
    assert {classes[i] for i in range(300)} == {0} and {classes[i] for i in range(300, 303)} == {300}
    pairs = [tuple(r) for r in bm.found(frame(spark, rows)).collect()]
    assert all(classes[a] == classes[b] for a, b in pairs)


def test_repeated_runs_hide_no_pair(spark):
    (a,) = variants(1)
    sentence = "and this sentence comes again and again until the page is full of it"
    rows = [(1, f"{a} {sentence}", "train", "a"), (2, f"{a} " + " ".join([sentence] * 60), "test", "a")]
    assert [tuple(r) for r in bm.found(frame(spark, rows)).collect()] == [(1, 2)]
    assert [tuple(r) for r in overlap.found(frame(spark, rows)).collect()] == [(1, 2)]
    strict = bm.NearDuplicates(frame(spark, rows), multiset=True)
    assert strict.pairs().count() == 0


def test_plain_and_weighted_signatures_are_those_drawn_apart():
    rng = np.random.default_rng(4)
    bags = []
    for k in range(60):
        el = np.unique(rng.integers(0, 2**63, rng.integers(1, 250), dtype=np.int64).astype(np.uint64))
        counts = np.ones(len(el), int)
        counts[: k % 4] = 1 + k % 3
        bags.append((el, counts * (50 if k % 20 == 0 else 1)))
    plain, weighted = bm.plain_and_weighted(bags, 64)
    assert (weighted == bm.signatures(bags, 64)).all()
    assert (plain == bm.signatures([(el, np.ones(len(el), int)) for el, _ in bags], 64)).all()


def test_components_of_chains_stars_and_repeats(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (201, 200), (200, 201)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("every", [9, 10, 12, 15])
def test_evenly_edited_copies_overlap(spark, every):
    rng = random.Random(every)
    rows = []
    for k in range(20):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(100, 220))]
        new = [f"new{rng.randrange(10**9)}" if i % every == every - 1 else w for i, w in enumerate(base)]
        assert bm.jaccard(bm.word_runs(base, 3), bm.word_runs(new, 3)) >= 0.5
        rows += [(2 * k, " ".join(base), "train", "a"), (2 * k + 1, " ".join(new), "test", "a")]
    assert {tuple(r) for r in overlap.found(frame(spark, rows)).collect()} == {(2 * k, 2 * k + 1) for k in range(20)}


def test_pairs_are_the_same_in_larger_shuffles(spark, corpus, monkeypatch):
    from textloom.plans import staging

    near, over = (sorted(map(tuple, f(frame(spark, corpus)).collect())) for f in (bm.found, overlap.found))
    monkeypatch.setattr(staging, "PARTITION", 20_000)
    assert sorted(map(tuple, bm.found(frame(spark, corpus)).collect())) == near
    assert sorted(map(tuple, overlap.found(frame(spark, corpus)).collect())) == over


def test_no_pair_at_the_threshold_is_left_out(spark):
    rng = random.Random(11)
    rows, want = [], set()
    for k in range(1200):
        base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        # pieces of six words in another order, cut within all passages but one, or one piece of other words
        cut = [base[:9], *(base[i : i + 6] for i in range(9, 120, 6))]
        new = sum(cut[::-1], []) if k % 2 else [f"new{k}x{i}" if i < 39 else w for i, w in enumerate(base)]
        assert 0.5 <= bm.jaccard(bm.word_runs(base, 3), bm.word_runs(new, 3)) < 0.52
        want.add((2 * k, 2 * k + 1))
        rows += [(2 * k, " ".join(base), "train", "a"), (2 * k + 1, " ".join(new), "test", "a")]
    assert {tuple(r) for r in overlap.found(frame(spark, rows)).collect()} == want


def test_other_word_breaks_of_the_same_letters_have_pairs_of_their_own(spark):
    base = [f"w{i}x" for i in range(160)]
    joined = [a + b for a, b in zip(base[::2], base[1::2])]
    near = joined[:70] + [f"new{i}" for i in range(12)]
    rows = [(1, " ".join(base), "train", "a"), (2, " ".join(joined), "train", "a"), (3, " ".join(near), "test", "a")]
    assert {tuple(r) for r in overlap.found(frame(spark, rows)).collect()} == {(2, 3)}


def test_an_index_of_the_rarest_triples_names_all_homes():
    rng = np.random.default_rng(8)
    common = np.arange(-60, 60, dtype=np.int32)
    pool = rng.integers(-(2**31), 2**31, 4000).astype(np.int32)
    draw = lambda k: np.unique(np.concatenate([rng.choice(common, k), rng.choice(pool, rng.integers(1, 90))]))
    sets = [draw(int(rng.integers(1, 120))) for _ in range(300)]
    # copies that share from a third to all of a record's triples
    texts = [np.unique(np.concatenate([rng.choice(s, max(1, int(len(s) * rng.uniform(0.3, 1))), replace=False), rng.choice(pool, rng.integers(1, 40))])) for s in sets] + [common, sets[0], pool[:1]]
    homes = np.arange(300) % 7
    block = overlap._Block(np.concatenate(sets), np.array([len(s) for s in sets]), homes)
    text, home = block.homes(np.concatenate(texts), np.array([len(t) for t in texts]))
    jaccard = lambda a, b: (c := len(np.intersect1d(a, b))) / (len(a) + len(b) - c)
    want = {(i, int(homes[k])) for i, t in enumerate(texts) for k, s in enumerate(sets) if jaccard(t, s) >= bm.SIMILARITY}
    assert len(want) > 100 and sorted(zip(text.tolist(), home.tolist())) == sorted(want)
    # the lists of triples that most records have are short
    assert len(block.owner) < 0.75 * sum(map(len, sets))
