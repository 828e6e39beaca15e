"""Search expressions against Python's own operators."""

import itertools
import random

import pytest

from gleanery import fixed_values as fv
from gleanery.functions import boolean
from gleanery.functions.boolean import ExpressionError, matches_expression, matches_stored_expression, parse

WORDS = ["a1", "b2", "c3", "d4"]
TEXTS = [" ".join(w for w, x in zip(WORDS, chosen) if x) for chosen in itertools.product([0, 1], repeat=4)]


def some_expression(r, depth=3):
    """An expression with all brackets, and the same for Python's eval."""
    if depth == 0 or r.random() < 0.25:
        w = r.choice(WORDS)
        return r.choice([w, f'"{w}"', f' "{w.upper()} " ']), f"('{w}' in t)"
    kind = r.choice(["AND", "OR", "NOT", "side"])
    a, x = some_expression(r, depth - 1)
    if kind == "NOT":
        return f"NOT({a})", f"(not {x})"
    b, y = some_expression(r, depth - 1)
    return (f"({a})({b})" if kind == "side" else f"({a}) {kind} ({b})"), f"({x} {'or' if kind == 'OR' else 'and'} {y})"


def test_random_expressions_in_both_forms(spark):
    r = random.Random(1)
    cases = [some_expression(r) for _ in range(12)]
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    columns = [matches_expression("t", e).alias(f"e{i}") for i, (e, _) in enumerate(cases)]
    got = {row.t: row for row in df.select("t", *columns).collect()}
    for t in TEXTS:
        assert [got[t][f"e{i}"] for i in range(len(cases))] == [eval(x) for _, x in cases]
    both = spark.createDataFrame([(i, t, e) for i, (e, _) in enumerate(cases) for t in TEXTS], "i int, t string, e string")
    for row in both.select("i", "t", matches_stored_expression("t", "e").alias("m")).collect():
        t = row.t
        assert row.m == eval(cases[row.i][1])


@pytest.mark.parametrize(
    "expression, rule",
    [
        ("a1 OR b2 AND c3", lambda t: "a1" in t or ("b2" in t and "c3" in t)),
        ("NOT a1 b2", lambda t: "a1 b2" not in t),
        ('NOT a1 "b2"', lambda t: "a1" not in t and "b2" in t),
        ("NOT NOT a1", lambda t: "a1" in t),
        ('"a1" "c3" OR d4', lambda t: ("a1" in t and "c3" in t) or "d4" in t),
        ("b2 c3", lambda t: "b2 c3" in t),
        ("  ", lambda t: True),
        ('""', lambda t: True),
    ],
)
def test_what_binds_first(spark, expression, rule):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    assert [r.t for r in df.where(matches_expression("t", expression)).collect()] == [t for t in TEXTS if rule(t)]


@pytest.mark.parametrize("bad", ["(a", "a)", "()", "a AND", "OR a", "a AND OR b", 'a "b', "NOT", "(NOT)", "a (", ") a (", "a NOT"])
def test_what_cannot_be_read(spark, bad):
    with pytest.raises(ExpressionError):
        parse(bad)
    df = spark.createDataFrame([("a b", bad), ("a b", None)], "t string, e string")
    assert [r[0] for r in df.select(matches_stored_expression("t", "e")).collect()] == [None, None]


def test_the_default_expression_is_any_of_its_phrases(spark):
    phrases = [text for kind, text in parse(fv.DEFAULT_TITLE_QUERY) if kind == "phrase"]
    assert len(phrases) == 7 and all(x == ("operator", "OR") for x in parse(fv.DEFAULT_TITLE_QUERY) if x[0] != "phrase")
    df = spark.createDataFrame([(f"x {p.upper()} y",) for p in phrases] + [("sales",), (None,)], "t string")
    assert df.where(matches_expression("t", fv.DEFAULT_TITLE_QUERY)).count() == 7


def test_deep_nesting():
    assert parse("(" * 5000 + "a" + ")" * 5000) == (("phrase", "a"),)
    assert boolean.parse("NOT " * 3001 + "a")[0] == ("phrase", "a")
