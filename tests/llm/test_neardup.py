"""The search of near duplicates at other similarities than that of the query."""

import math
import re

import numpy as np
import pytest

from tallyhouse.llm import components, neardup


def missed(percent):
    p, k = percent / 100, neardup.max_distance(percent)
    return sum(math.comb(128, i) * (1 - p) ** i * p ** (128 - i) for i in range(k + 1, 129))


@pytest.mark.parametrize("percent", [60, 80, 85, 95])
def test_the_distance_follows_the_similarity(percent):
    assert missed(percent) <= neardup.MISSED
    cuts = neardup.chunk_cuts(percent)
    assert 2 * (len(cuts) - 1) > neardup.max_distance(percent)
    assert cuts[0] == 0 and cuts[-1] == neardup.POSITIONS and (np.diff(cuts) > 1).all()


def test_the_distance_of_the_query():
    assert neardup.max_distance(85) == 37 and len(neardup.chunk_cuts(85)) == 20
    assert neardup.max_distance(80) == 45 and len(neardup.chunk_cuts(80)) == 24


def test_links_at_lower_similarity(spark):
    rng, rows = np.random.default_rng(1), []
    # pairs that share about 62 % of their shingles: far beyond the distance of the query
    for pair in range(60):
        words = [f"p{pair}w{i}" for i in range(400)]
        other = list(words)
        for k, place in enumerate(rng.choice(80, 18, replace=False)):
            other[place * 5 + 2] = f"p{pair}changed{k}"
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["id"]: r["component_id"] for r in neardup.near_duplicates(docs, percent=60).collect()}
    assert found == {i: i - i % 2 for i in range(120)}


def naive_families(found, limit):
    label = list(range(len(found)))
    for i in range(len(found)):
        for j in range(i):
            if (found[i] != found[j]).sum() <= limit:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def test_close_pairs_connect_what_is_within_the_distance():
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 256, (12, 128)).astype(np.uint8)
    found = centres[rng.integers(0, 12, 200)]
    change = rng.random(found.shape) < rng.choice([0.02, 0.1, 0.16, 0.2], 200)[:, None]
    found = np.where(change, rng.integers(0, 256, found.shape), found).astype(np.uint8)
    group = np.sort(np.r_[rng.integers(0, 30, 120), np.full(80, 30)])  # short groups and a long one
    a, b = neardup.close_pairs(group, found, 37)
    assert (group[a] == group[b]).all()
    assert (neardup.distances(found[a], found[b]) == (found[a] != found[b]).sum(1)).all()
    label = neardup._forest(a, b, len(found))
    for number in np.unique(group):
        rows = np.flatnonzero(group == number)
        wanted = [int(rows[i]) for i in naive_families(found[rows], 37)]
        assert label[rows].tolist() == wanted
    none = neardup.close_pairs(np.zeros(0, np.int64), np.zeros((0, 128), np.uint8), 37)
    assert len(none[0]) == len(none[1]) == 0


def boilerplate(number):
    """Texts that share 45 % of their words as a block, about 0.29 of their shingles, and nothing else."""
    shared = " ".join(f"menu{i}" for i in range(180))
    return [(i, shared + " " + " ".join(f"d{i}w{k}" for k in range(220))) for i in range(number)]


def signed(spark, rows):
    docs = spark.createDataFrame(rows, "id bigint, text string").selectExpr("id", "xxhash64(text) AS row", "text AS _text")
    fields = "id bigint, row bigint, n_shingles bigint, cls binary, signature binary"
    neardup.ship(spark)
    return neardup.map_arrow(docs, neardup._describe("_text"), fields).select("cls", "signature").distinct()


def test_boilerplate_makes_no_family(spark):
    rows = boilerplate(400)
    copy = rows[7][1].replace("w100 ", "changed ")
    # what shares a key without being near is compared and left out
    family = neardup.families(signed(spark, rows + [(1000, copy)])).groupBy("root").count().collect()
    assert [r["count"] for r in family] == [2]


@pytest.mark.parametrize("setting", [("BUCKET_KEYS", 300), ("SIGNATURES", 5), ("SHORT", 2)])
def test_splits_and_blocks_lose_no_link(spark, monkeypatch, setting):
    rng, rows = np.random.default_rng(3), []
    for group in range(6):  # chains of near copies, exact copies among them
        words = [f"g{group}w{i}" for i in range(300)]
        for k in range(25):
            words = list(words)
            words[int(rng.integers(0, 300))] = f"g{group}c{k}"
            rows.append((len(rows), " ".join(words)))
        rows.append((len(rows), rows[-1][1]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(neardup, *setting)
    found = {r["id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()}
    assert found == {i: i - i % 26 for i in range(len(rows))}


def test_hot_nodes_of_components(spark, monkeypatch):
    monkeypatch.setattr(components, "HOT", 5)
    edges = [(1, i) for i in range(2, 60)] + [(59, 60), (60, 61), (100, 101), (7, 7)]
    rows = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components.components(rows).collect()}
    assert found == {i: 1 for i in range(1, 62)} | {100: 100, 101: 100}


@pytest.mark.parametrize("hot", [5, 1000])
def test_plans_of_components_stay_small(spark, monkeypatch, hot):
    from pyspark.sql.readwriter import DataFrameWriter

    joins, write = [], DataFrameWriter.parquet

    def counted(writer, *args, **more):
        plan = writer._df._jdf.queryExecution().optimizedPlan().toString()
        joins.append(len(re.findall(r"\bJoin\b", plan)))
        return write(writer, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", counted)
    monkeypatch.setattr(components, "HOT", hot)
    edges = [(1, i) for i in range(2, 60)] + [(i, i + 1) for i in range(59, 70)]
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["root"] for r in found} == {1}
    # a star held the star before it five times in its plan, so a round joined two dozen times
    assert max(joins) <= 4


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
