"""The verdict of the quality rules: what labels call junk by its words and lines, and a naive forest."""

import random

import numpy as np
import pytest

from tallyhouse.llm import rules

WORDS = [f"{a}{b}" for a in ("so", "mar", "ten", "lo", "vik", "pra") for b in ("dan", "er", "is", "um", "ola", "e")]


def prose(draw, n):
    return ". ".join(" ".join(draw.choices(WORDS, k=9)).capitalize() for _ in range(n // 9 + 2))


def listing(draw):
    """Every second line the same, each other one new."""
    lines = []
    for _ in range(60):
        lines += [" ".join(draw.choices(WORDS, k=7)).capitalize(), "Read more"]
    return "\n".join(lines)


def long_words(draw):
    return " ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=66)) for _ in range(60))


@pytest.fixture(scope="module")
def forests(spark):
    draw = random.Random(5)
    rows = [(prose(draw, draw.randint(30, 600)), 1) for _ in range(400)]
    rows += [(kind(draw), 0) for kind in (listing, long_words) for _ in range(15)]
    return rules.learn(spark.createDataFrame(rows, "text string, label int"))


def test_words_and_lines_reach_the_verdict(spark, forests):
    draw = random.Random(6)
    rows = [("junk", kind(draw)) for kind in (listing, long_words) for _ in range(5)]
    rows += [("clean", prose(draw, draw.randint(30, 600))) for _ in range(60)]
    found = rules.judge(spark.createDataFrame(rows, "kind string, text string"), forests).collect()
    assert not any(r["base_failed"] for r in found)
    assert [r["kept"] for r in found if r["kind"] == "junk"] == [False] * 10
    assert np.mean([r["kept"] for r in found if r["kind"] == "clean"]) > 0.9


def naive_path(forest, tree, row):
    node, row = 0, row[forest.columns]
    while forest.feature[tree, node] >= 0:
        node = 2 * node + (1 if row[forest.feature[tree, node]] < forest.cut[tree, node] else 2)
    return forest.path[tree, node]


def test_forest_against_naive_walks(forests):
    x = np.random.default_rng(2).normal(size=(40, 8))
    x[7] = x[6]
    for forest in forests:
        paths = [np.mean([naive_path(forest, t, row) for t in range(rules.TREES)]) for row in x]
        want = 2.0 ** -(np.array(paths) / rules._average_path(np.array([rules.TREE_ROWS]))[0])
        assert np.allclose(forest.anomaly(x), want)
        assert forest.anomaly(x)[6] == forest.anomaly(x)[7]


def test_threshold():
    good, bad = np.linspace(0.3, 0.5, 1000), np.array([0.2, 0.52, 0.6])
    assert 0.49 <= rules._threshold(good, bad) < 0.52
    # equal scores: nothing can be told apart, so nothing of label 1 is given up
    assert rules._threshold(np.full(10, 0.4), np.full(10, 0.4)) == 0.4
    assert rules._threshold(good, np.array([])) == np.inf


def test_one_label_only(spark):
    sample = spark.createDataFrame([("some words " * 9, 1)] * 3, "text string, label int")
    assert rules.learn(sample) == []
    judged = rules.judge(spark.createDataFrame([(None,), ("a " * 12,)], "text string"), [])
    assert [(r["base_failed"], r["kept"]) for r in judged.collect()] == [(True, False), (True, False)]
