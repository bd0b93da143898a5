import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import ranking
from tallyhouse.operators.marts import product_performance, rfm_segments
from tallyhouse.operators.ranking import Ntile, with_ntiles, with_row_number


def expected_tiles(ordered_keys, buckets):
    size, larger = divmod(len(ordered_keys), buckets)
    tiles, position = {}, 0
    for bucket in range(1, buckets + 1):
        for _ in range(size + (bucket <= larger)):
            tiles[ordered_keys[position]] = bucket
            position += 1
    return tiles


@pytest.mark.parametrize("rows", [0, 1, 3, 5, 7, 10, 23, 1003])
def test_ntiles_against_brute_force(spark, rows):
    draw = random.Random(rows)
    # a third of all rows share one value
    data = [
        (f"k{i:05d}", 1.0 if i % 3 == 0 else round(draw.uniform(-5, 5), 2), draw.randint(0, 3))
        for i in range(rows)
    ]
    draw.shuffle(data)
    df = spark.createDataFrame(data, "key string, money double, visits bigint")
    got = with_ntiles(
        df,
        "key",
        {"up": Ntile("visits", 5), "down": Ntile("money", 10, descending=True)},
    ).collect()
    up = expected_tiles([k for k, m, v in sorted(data, key=lambda r: (r[2], r[0]))], 5)
    down = expected_tiles([k for k, m, v in sorted(data, key=lambda r: (-r[1], r[0]))], 10)
    assert {r.key: r.up for r in got} == up
    assert {r.key: r.down for r in got} == down


def test_null_sorts_last_both_ways(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("c", 2.0)], "key string, x double")
    got = with_ntiles(df, "key", {"up": Ntile("x", 3), "down": Ntile("x", 3, True)}).collect()
    assert {r.key: (r.up, r.down) for r in got} == {"a": (3, 3), "b": (1, 2), "c": (2, 1)}


@pytest.fixture
def narrow(monkeypatch):
    """Intervals are split down to two rows, eight cells a pass."""
    monkeypatch.setattr(ranking, "FEW", 2)
    monkeypatch.setattr(ranking, "CELLS", 8)


def ordered(rows):
    """Keys by value and key: NULL after NaN's place, NULL keys first."""

    def by(row):
        key, x = row
        last = x is None or x != x
        return (last, 0.0 if last else x, key is not None, key if key is not None else 0)

    return [key for key, _ in sorted(rows, key=by)]


@pytest.mark.parametrize("kind", ["string", "bigint", "date"])
def test_places_are_found_in_narrowing_intervals(spark, narrow, kind):
    """A hot value, NULL, NaN, infinities, huge and tiny numbers, keys that differ late."""
    import datetime

    draw = random.Random(kind)
    inf = float("inf")
    odd = [None, float("nan"), inf, -inf, 1e300, -1e300, 5e-324, -5e-324, 0.0, 1.0, 1.0 + 2**-52]
    keys = {
        "string": lambda i: "shared beginning " * (i % 3) + f"{i:04d}" + "é\0"[: i % 3],
        "bigint": lambda i: (i - 300) * 2**53,
        "date": lambda i: datetime.date(1960, 1, 1) + datetime.timedelta(days=37 * i),
    }[kind]
    rows = [(keys(i), 7.0 if i % 3 == 0 else draw.choice(odd + [draw.uniform(-50, 5000)])) for i in range(600)]
    rows.append((None, 7.0))
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, f"key {kind}, x double").repartition(3)
    got = with_ntiles(df, "key", {"tile": Ntile("x", 10)}).collect()
    assert {r.key: r.tile for r in got} == expected_tiles(ordered(rows), 10)


def test_equal_rows_share_a_bucket(spark, narrow):
    df = spark.createDataFrame([("a", 1.0)] * 50 + [("b", 1.0)] * 50, "key string, x double")
    got = with_ntiles(df, "key", {"tile": Ntile("x", 4)}).distinct().collect()
    assert {r.key: r.tile for r in got} == {"a": 2, "b": 4}


def test_keys_without_an_order_of_numbers_are_refused(spark):
    with pytest.raises(TypeError, match="key"):
        with_ntiles(spark.sql("SELECT 1.5D AS key, 1.0D AS x"), "key", {"tile": Ntile("x", 2)})


def test_ntiles_store_nothing(spark, small, monkeypatch):
    from tallyhouse.plans.registry import warehouse

    customers = warehouse(spark, small).read("dim_customers")
    monkeypatch.setattr(ranking, "store", lambda *_: pytest.fail("a stored copy"))
    text = plan(rfm_segments(customers))
    assert "Window" not in text and "rangepartitioning" not in text


def test_row_number_with_a_hot_value(spark):
    df = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("x")
    )
    got = with_row_number(df, [F.col("x").desc(), F.col("id")], "rn").collect()
    ordered = sorted(got, key=lambda r: (-r.x, r.id))
    assert [r.rn for r in ordered] == list(range(1, 3001))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def windows_over(text):
    """What each window of a plan sorts by."""
    return [line.split("Window [")[1][:40] for line in text.splitlines() if "Window [" in line]


def test_no_window_over_the_data(spark, small):
    from tallyhouse.plans.registry import warehouse

    store = warehouse(spark, small)
    # n-tiles have no window at all
    segments = plan(rfm_segments(store.read("dim_customers")))
    assert not windows_over(segments) and "CartesianProduct" not in segments
    products = plan(product_performance(store.read("dim_products")))
    # the only window adds up the row counts of the ranges
    assert windows_over(products) and all(w.startswith("sum(n") for w in windows_over(products))
    assert "CartesianProduct" not in products
