import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import quality
from tallyhouse.operators.quality import AcceptedRange, AcceptedValues, ForeignKey, NotNull, Unique
from tallyhouse.plans.registry import warehouse

D = dt.date.fromisoformat


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [("a", 1, "x"), ("a", 5, "x"), ("b", None, "y"), (None, 9, None), (None, 0, "z")],
        "key string, size int, label string",
    )


@pytest.mark.parametrize(
    "check, failing",
    [
        (NotNull("key"), 2),
        (AcceptedValues("label", ("x", "y")), 1),
        (AcceptedRange("size", 1, 5), 2),
        (AcceptedRange("size", 1), 1),
        (AcceptedRange("size", None, 9), 0),
    ],
)
def test_row_checks(table, check, failing):
    row = quality._row_check_results("t", table, [check]).first()
    assert (row.check_id, row.failures) == (f"t.{check.column}.{check.kind}", failing)


def test_unique_ignores_null(table):
    assert Unique("key").failures(table).first().failures == 1


def test_foreign_key(spark, table):
    parent = spark.createDataFrame([("b",)], "id string")
    assert ForeignKey("key", "p", "id").failures(table, parent).first().failures == 2
    scoped = ForeignKey("key", "p", "id", where="size > 1")
    assert scoped.failures(table, parent).first().failures == 1
    assert ForeignKey("key", "p", "key").failures(table, table).first().failures == 0


def test_cohort_invariant(spark):
    df = spark.createDataFrame([(1.0,), (1.01,), (None,)], "retention_rate double")
    assert quality.cohort_not_over_100(df).first().failures == 1


def test_future_dates(spark):
    tomorrow = dt.date.today() + dt.timedelta(days=2)
    df = spark.createDataFrame([(D("2011-01-01"),), (tomorrow,)], "invoice_date date")
    assert quality.no_future_dates(df).first().failures == 1
    assert quality.no_future_dates(df, D("2010-12-31")).first().failures == 2


def test_order_revenue(spark):
    lines = spark.createDataFrame(
        [("1", 1.0), ("1", 2.0), ("2", 5.0), ("3", 1.0)], "invoice_id string, line_revenue double"
    )
    orders = spark.createDataFrame(
        [("1", 3.0), ("2", 5.02), ("4", 9.0)], "invoice_id string, order_revenue double"
    )
    # an order without lines is not caught
    assert quality.order_revenue_reconciles(lines, orders).first().failures == 1


@pytest.mark.parametrize(
    "age, status",
    [(dt.timedelta(hours=35), "pass"), (dt.timedelta(hours=36), "pass"),
     (dt.timedelta(hours=37), "warn"), (dt.timedelta(days=8), "error")],
)
def test_freshness(spark, age, status):
    loaded = dt.datetime(2011, 1, 1, 6)
    df = spark.createDataFrame([(loaded,), (None,)], "_loaded_at timestamp_ntz")
    row = quality.freshness(df, loaded + age).first()
    assert (row.max_loaded_at, row.age_seconds, row.status) == (
        loaded, int(age.total_seconds()), status)


def test_a_source_without_rows_is_stale(spark):
    df = spark.createDataFrame([], "_loaded_at timestamp_ntz")
    assert quality.freshness(df, dt.datetime(2011, 1, 1)).first().status == "error"


def test_sixty_checks_pass_on_the_given_tables(spark, small):
    results = quality.all_checks(warehouse(spark, small).read).collect()
    assert len({r.check_id for r in results}) == 60 == len(results)
    assert {r.check_id for r in results if r.failures} == set()


def test_damaged_tables_fail_every_kind_of_check(spark, small):
    from tallyhouse.plans.registry import QUERIES

    found = {r.check_id: r.failures for r in QUERIES["dq_damaged"](spark, small).collect()}
    kinds = {check.rsplit(".", 1)[1] for check, failures in found.items() if failures > 0}
    assert kinds == {"unique", "not_null", "relationships", "accepted_range", "accepted_values"}


def exchanges(spark, df):
    """Exchanges of the plan that carry rows of their own, and scans below them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = [line.strip(" :+-*|") for line in text.splitlines()]
    return [line for line in lines if line.startswith("Exchange hashpartitioning")], text


def test_checks_of_a_table_share_one_pass(spark, small):
    """Three keys and two columns of the line fact: one scan and one shuffle of it."""
    read = warehouse(spark, small).read
    keyed, text = exchanges(spark, quality.check_table("fct_invoice_lines", read))
    # the line fact and its two parents, in the one exchange that counts their keys
    assert len(keyed) == 1 and text.count("FileScan") == 3 and "Join" not in text
    # staged and revenue lines together: one count of the line keys
    staged = [*quality._planned("stg_online_retail"),
              *quality._planned("int_invoice_lines_cleaned", quality.carries_revenue())]
    keyed, text = exchanges(spark, quality.run_checks(read("stg_online_retail"), staged, read))
    assert len(keyed) == 1 and text.count("FileScan") == 1


def test_scoped_checks(spark, table):
    """Checks over part of the rows of a shared pass, null keys among them."""
    parent = spark.createDataFrame([("b",)], "id string")
    big = quality.F.col("size") > 1
    planned = [
        quality.Planned("unique", Unique("key")),
        quality.Planned("unique of big", Unique("key"), big),
        quality.Planned("filled", NotNull("key"), big),
        quality.Planned("known", ForeignKey("label", "p", "id"), big),
        quality.Planned("known key", ForeignKey("key", "p", "id", where="size > 1")),
    ]
    found = {r.check_id: r.failures for r in quality.run_checks(table, planned, lambda _: parent).collect()}
    assert found == {"unique": 1, "unique of big": 0, "filled": 1, "known": 1, "known key": 1}


def test_packed_keys_are_short_and_tell_all_texts_apart(spark):
    hashes = ["0" * 32, "00" * 15 + "01", "ab" * 16]
    # texts that look like a packed hash, a hash and a line break, capitals
    texts = [*hashes, "\0" * 16, "\1" + "\0" * 16, hashes[2] + "\n", hashes[2].upper(), "", "a", None]
    rows = spark.createDataFrame([(text,) for text in texts], "key string")
    packed = [r[0] for r in rows.select(quality._packed(F.col("key"))).collect()]
    assert {len(p) for p in packed[:3]} == {17} and packed[-1] is None
    assert len({bytes(p) for p in packed[:-1]}) == len(texts) - 1
