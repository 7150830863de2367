import random

import numpy as np
import pytest

from textloom.llm import mixing, packing
from textloom.llm import readability as rd

EASY = "I have a bad leg. My dog sat on it. It is red and hot. We go to bed now.".split(". ")
HARD = "Administration of pharmacological intervention precipitated statistically significant exacerbation of gastrointestinal manifestations; longitudinal biochemical surveillance necessitates interdisciplinary reassessment. ".split("; ")


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, tokens string")


@pytest.mark.parametrize("capacity", [7, 64, 300])
def test_packing_keeps_every_token(capacity):
    rng = random.Random(capacity)
    sizes = [rng.choice([1, 2, 3, rng.randrange(1, 200), capacity, capacity * 3 + 1]) for _ in range(500)]
    bins = packing.pack(sizes, capacity)
    assert all(0 < sum(n for _, _, n in b) <= capacity for b in bins)
    got: dict[int, list] = {}
    for b in bins:
        for i, at, n in b:
            got.setdefault(i, []).append((at, n))
    for i, n in enumerate(sizes):
        parts = sorted(got[i])
        assert sum(x for _, x in parts) == n and all(a + x == b for (a, x), (b, _) in zip(parts, parts[1:]))
        assert len(parts) == 1 or n > capacity
    least = -(-sum(sizes) // capacity)
    assert len(bins) <= least * 1.25 + 2
    assert packing.pack([], capacity) == []


def test_packed_table(spark):
    rows = [(i, "word " * (i % 40 + 1), "s", "x") for i in range(200)] + [(900, None, "s", "x"), (901, "", None, "x"), (902, "long " * 5000, "s", "x"), (3, "word", "s", "x")]
    caps = spark.createDataFrame([("tiny", 64), ("wide", 1000), ("none", None)], "container_kind string, capacity_tokens int")
    got = packing.packed(documents(spark, rows), caps).toPandas()
    assert set(got["container_kind"]) == {"tiny", "wide"} and not {900, 901} & set(got["doc_id"])
    total = got.groupby("container_kind")["tokens"].sum()
    assert total["tiny"] == total["wide"]
    full = got.groupby(["container_kind", "bin_group", "bin"])["tokens"].sum().reset_index()
    assert (full[full.container_kind == "tiny"]["tokens"] <= 64).all()
    assert packing.packed(documents(spark, []), caps).count() == 0


def test_water_filling():
    assert mixing.water_fill([1, 1], [10, 100], 100) == [10, 90]
    assert mixing.water_fill([1, 1], [10, 20], 100) == [10, 20]
    assert mixing.water_fill([0, 1], [10, 20], 10) == [0, 10]
    assert mixing.water_fill([], [], 5) == []
    assert mixing.water_fill([3, 1], [100, 100], 40) == [30, 10]


def test_mixture(spark):
    rng = random.Random(5)
    rows = [(i, "word " * rng.randrange(5, 60), "big" if i % 5 else "small", "x") for i in range(1000)] + [(5000, None, "big", "x"), (5001, "a b", None, "x")]
    targets = spark.createDataFrame([("m", "big", 0.5, 1), ("m", "small", 0.5, 2), ("m", "gone", 0.2, 3), ("n", "big", 1.0, None)], "mix_id string, source string, target_share double, max_repeats int")
    df = documents(spark, rows)
    rep = {(r["mix_id"], r["source"]): r for r in mixing.report(df, targets).collect()}
    assert rep["m", "gone"]["actual_tokens"] == 0
    assert rep["m", "small"]["actual_repeats"] == pytest.approx(2.0)
    assert rep["m", "big"]["actual_share"] == pytest.approx(rep["m", "big"]["planned_share"], abs=0.01)
    got = mixing.mixed(df, targets).toPandas()
    assert got[(got.mix_id == "m") & (got.source == "small")]["repeats"].max() == 2 and not got.duplicated(["mix_id", "doc_id"]).any()
    again = mixing.mixed(df, targets).toPandas()
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, again.values.tolist()))
    assert mixing.mixed(documents(spark, []), targets).count() == 0


def test_trees_learn_a_step():
    rng = np.random.default_rng(0)
    x = rng.random((600, 5))
    y = 1.0 + (x[:, 2] > 0.5) + 0.5 * (x[:, 0] > 0.3)
    model = rd.Trees().fit(x, y)
    assert np.abs(model.predict(x) - y).mean() < 0.1


def test_reading_bands_on_held_out_documents(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(160):
        hard = i % 2
        text = ". ".join(rng.choice(HARD if hard else EASY) for _ in range(12))
        rows.append((i, text, f"s{i % 8}", "x"))
        if i < 100:
            labels.append((i, 3 if hard else 1))
    labels += [(0, None), (1, 3), (9999, 2)]
    rows += [(500, None, None, "x"), (501, "too short", "s", "x")]
    lab = spark.createDataFrame(labels, "doc_id bigint, band int")
    df = documents(spark, rows)
    got = {r["doc_id"]: r["band"] for r in rd.found(df, lab).collect()}
    assert set(got) == set(range(160))
    assert sum(got[i] == (3 if i % 2 else 1) for i in range(100, 160)) >= 57
    all_ = {r["doc_id"]: r["band"] for r in rd.grades(df, lab).collect()}
    assert all_[500] is None and 501 in all_
    assert rd.found(documents(spark, []), lab).count() == 0
    assert {r["band"] for r in rd.found(df, lab.where("false")).collect()} == {2}
