"""Line dedup against brute force: nulls, hot lines, repeated rows, thresholds."""

import random
import re
from collections import defaultdict

from tallyhouse.llm import linededup

LONG = "\n".join(f"line number {i} of a long text" for i in range(20_000))
ROWS = [
    (4, "A shared line here\nown line of four\n\tA SHARED line here \n"),
    (2, "a shared line here\nshort\n\nshort"),
    (9, "short\na shared line here\nÄ shared line hêre"),
    (5, None),
    (6, ""),
    (7, "twice in one text\ntwice in one text"),
    (8, LONG),
    (3, f"{LONG}\nand more"),
    (8, LONG),
    (11, "two rows of one id\none"),
    (11, "two rows of one id\ntwo"),
    (None, "a shared line here\nheld by no id at all"),
    (None, "held by no id at all"),
    (12, "\r\n\x0b nine chars\x0c\n ten chars.\n"),
    (13, "nine chars\nten chars."),
]
SCHEMA = "doc_id bigint, text string, N_LINES string, _at string, _id string, source string"


def key_of(line):
    return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, min_docs=2):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 10:
                holders[key_of(line)].add((doc is None, doc))
    found = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if len(holders[key_of(line)]) < min_docs or min(holders[key_of(line)], key=lambda h: (h[0], h[1] or 0)) == (doc is None, doc)
        ]
        found.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(found, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["mine"] * 4) for r in rows], SCHEMA)


def found(df, **options):
    rows = linededup.drop_shared_lines(df, **options)
    assert [c for c in rows.columns if c.lower() == "n_lines"] == ["n_lines"]
    assert {r["source"] for r in rows.collect()} <= {"mine"}
    return sorted(map(tuple, rows.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=repr)


def test_against_brute_force(spark):
    df = frame(spark, ROWS)
    assert found(df) == brute(ROWS)
    assert found(df, min_docs=3) == brute(ROWS, 3)


def test_hot_lines(spark):
    """All lines broadcast, or none: the same result."""
    draw = random.Random(3)
    lines = [f"common line number {i}" for i in range(6)]
    rows = [(i, "\n".join(["the hottest line", *draw.choices(lines, k=4), f"own line of {i} here"])) for i in range(300)]
    for share in (1, 5, 10**9):
        assert found(frame(spark, rows), hot_share=share) == brute(rows)


def test_empty_table(spark):
    assert found(frame(spark, [])) == []


def test_native(spark):
    """No Python worker on the way."""
    plan = linededup.drop_shared_lines(frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
