import itertools
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm import fieldcodes as fc
from textloom.llm.normal import normal, words

FORM = "Age: 20\nSex: male\nMain complaint: a cough; at night\nSite: left hand"


def test_normal_text():
    assert normal("Ｔest­ing ﬁne") == "testing fine"
    assert words("a-b_c 1½") == ["a", "b", "c", "1½"]


def test_forms_in_all_notations():
    fields = {"age": "20", "sex": "male", "site": "left hand", "mood": "fed up"}
    texts = ["\n".join(f"{k.title()}:  {v}" for k, v in fields.items()), " | ".join(f"{k}: {v}" for k, v in reversed(fields.items())), "; ".join(f"{k}: {v}" for k, v in fields.items()) + ";", __import__("json").dumps(fields)]
    keys = {fc.Encoder().keys(t)[1] for t in texts}
    assert len(keys) == 1 and None not in keys
    assert fc.form_fields("Age: 20\nSex: male\nSite: x") is None
    assert fc.form_fields("I said: no.\nThen he left. And: so.\nNothing here\nA: b") is None
    assert fc.form_fields("{broken") is None


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_format_changes_keep_the_key(t):
    e = fc.Encoder()
    spaced = " ".join(normal(t))
    if all(unicodedata.combining(c) == 0 for c in normal(t)):
        assert e.keys(t)[0] == e.keys(spaced)[0] or not fc.canonical(normal(t))


def rows(spark, data):
    return spark.createDataFrame(data, "row_id bigint, text string, k_hi string")


def test_found_against_brute_force(spark):
    shuffled = "Site: left hand | Sex: Male | Age: 20 | Main complaint: a cough; at night"
    data = [(5, "Hello, World!"), (3, "hello world"), (9, "HELLO\nworld"), (1, None), (2, ""), (4, "!!!"), (6, "..."), (7, FORM), (8, shuffled), (10, "other"), (10, "other"), (11, "x " * 50_000)]
    got = {tuple(r) for r in fc.found(rows(spark, [(a, b, "clash") for a, b in data])).collect()}
    assert got == {(3, 5), (3, 9), (7, 8)}
    kept = {r["row_id"]: r["copies"] for r in fc.collapsed(rows(spark, [(a, b, "") for a, b in data])).collect()}
    assert kept == {3: 3, 7: 2, 10: 2, 11: 1}


def test_a_text_with_a_forms_letters_joins_its_class(spark):
    wrapped = FORM.replace("a cough", "a\ncough")
    other = "Sex: male\nAge: 20\nSite: left hand\nMain complaint: a cough; at night"
    got = {tuple(r) for r in fc.found(rows(spark, [(1, wrapped, ""), (2, FORM, ""), (3, other, "")])).collect()}
    assert got == {(1, 2), (1, 3)}


def test_field_tuples_that_share_letters_close(spark):
    # the same letters read as two different forms: both tuples' members are one class
    a, b = "ab: c\nd: e\nf: g\nh: i", "a: bc\nd: e\nf: g\nh: i"
    c = "d: e\na: bc\nf: g\nh: i"
    got = {tuple(r) for r in fc.found(rows(spark, [(1, a, ""), (2, b, ""), (3, c, "")])).collect()}
    assert got == {(1, 2), (1, 3)}


def test_hot_class(spark):
    data = [(i, "Same TEXT" if i % 3 == 0 else f"text {i}", "") for i in range(3000)]
    got = fc.found(rows(spark, data)).collect()
    assert len(got) == 999 and {r["kept_row_id"] for r in got} == {0}


def test_empty_table(spark):
    assert fc.found(rows(spark, [])).count() == 0
    assert fc.same_records(rows(spark, [])).count() == 0


@pytest.mark.parametrize("order", list(itertools.permutations(range(4)))[:6])
def test_field_order(order):
    parts = ["Age: 20", "Sex: male", "Site: hand", "Mood: ok"]
    assert fc.Encoder().keys("\n".join(parts[i] for i in order))[1] == fc.Encoder().keys("\n".join(parts))[1]
