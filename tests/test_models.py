import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import double_text, round_half_away
from tallyhouse.operators import dimensions, lines, marts, orders, quality, serving
from tallyhouse.schemas import RAW_SCHEMA
from tallyhouse.sources.seeds import country_region

T = dt.datetime.fromisoformat
D = dt.date.fromisoformat


def raw_line(**given):
    values = {
        "invoice": "5520",
        "stock_code": "tin9",
        "description": "tin box",
        "quantity": 4,
        "invoice_date": T("2012-04-27 16:40:00"),
        "price": 2.25,
        "customer_id": "77",
        "country": "Spain",
        "_source_sheet": "p",
        "_loaded_at": T("2012-05-02 00:00:00"),
    }
    return tuple({**values, **given}.values())


def staged(spark, *rows):
    return lines.stage_lines(spark.createDataFrame(list(rows), RAW_SCHEMA))


# functions ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    "value, places, expected",
    [
        (2.5, 0, 3.0),
        (-2.5, 0, -3.0),
        (0.49999999999999994, 0, 0.0),
        (1.005, 2, 1.0),
        (0.125, 2, 0.13),
        (-0.125, 2, -0.13),
        (-0.001, 2, 0.0),
        (1e17, 2, 1e17),
        (None, 2, None),
    ],
)
def test_rounding(spark, value, places, expected):
    df = spark.createDataFrame([(value,)], "x double")
    got = df.select(round_half_away(F.col("x"), places).alias("y")).first().y
    assert got == expected and str(got) == str(expected)


@pytest.mark.parametrize(
    "value, text",
    [(1e7, "10000000.0"), (12345678.25, "12345678.25"), (0.0001, "0.0001"), (2.55, "2.55"),
     (0.0, "0.0"), (-25000000.5, "-25000000.5")],
)
def test_text_of_doubles(spark, value, text):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(double_text(F.col("x")).alias("y")).first().y == text


# staging -----------------------------------------------------------------------------


def test_staging_cleans_and_flags(spark):
    row = staged(
        spark,
        raw_line(invoice=" C9 ", stock_code=" ab1 ", description="  ", quantity=-2,
                 customer_id=None, country=" "),
    ).first()
    assert (row.invoice_id, row.stock_code, row.description, row.country) == (
        "C9", "AB1", None, None)
    assert (row.is_cancellation, row.is_return, row.is_guest, row.is_non_revenue) == (
        True, True, True, False)
    assert row.line_revenue == -4.5
    key = "C9-AB1-2012-04-27 16:40:00--2-2.25-_dbt_utils_surrogate_key_null_"
    assert row.invoice_line_id == hashlib.md5(key.encode()).hexdigest()


def test_only_upper_case_c_cancels(spark):
    assert staged(spark, raw_line(invoice="c9")).first().is_cancellation is False


def test_staging_drops_lines_without_keys(spark):
    rows = [raw_line(), raw_line(invoice=None), raw_line(stock_code=None)]
    assert staged(spark, *rows).count() == 1


def test_free_return_has_no_negative_zero(spark):
    row = staged(spark, raw_line(quantity=-2, price=0.0)).first()
    assert str(row.line_revenue) == "0.0"


def test_lines_without_price_or_quantity_carry_no_revenue(spark):
    rows = [raw_line(), raw_line(price=None), raw_line(quantity=None), raw_line(price=0.0),
            raw_line(price=-1.0), raw_line(quantity=-1)]
    kept = lines.revenue_lines(staged(spark, *rows))
    assert sorted(r.quantity for r in kept.collect()) == [-1, 4]
    assert kept.first().invoice_month == D("2012-04-01")


def test_codes_that_differ_in_case_become_one_key(spark):
    df = staged(spark, raw_line(stock_code="abc"), raw_line(stock_code="ABC"))
    assert quality.Unique("invoice_line_id").failures(df).first().failures == 1


# orders and dimensions ---------------------------------------------------------------

LINE = (
    "invoice_id string, customer_id string, country string, invoiced_at timestamp_ntz,"
    " quantity int, line_revenue double, is_cancellation boolean, is_guest boolean"
)


def test_order_roll_up(spark):
    early, late = T("2019-07-31 23:50:00"), T("2019-08-01 00:10:00")
    rows = [
        ("n1", "41", "Chile", late, -3, -2.25, False, False),
        ("n1", "41", "Chile", early, 8, 6.0, False, False),
        ("n1", "41", "Chile", late, 1, 0.35, False, False),
        ("Cn2", None, "Peru", late, -5, -7.5, True, True),
    ]
    got = {r.invoice_id: r for r in orders.roll_up_orders(spark.createDataFrame(rows, LINE)).collect()}
    assert len(got) == 2
    first, second = got["n1"], got["Cn2"]
    # the order has the time of its first line, and the month of that
    assert (first.ordered_at, first.order_date, first.order_month) == (early, D("2019-07-31"), D("2019-07-01"))
    assert (first.n_lines, first.total_quantity, first.order_revenue) == (3, 6, 4.1)
    assert (first.customer_id, first.country, first.is_cancellation, first.is_guest) == ("41", "Chile", False, False)
    assert (second.customer_id, second.n_lines, second.order_revenue) == (None, 1, -7.5)
    assert second.is_cancellation and second.is_guest


def test_order_takes_a_value_that_is_there(spark):
    at, later = T("2011-01-15 10:00:00"), T("2011-01-16 10:00:00")
    df = spark.createDataFrame(
        [
            ("A", None, None, at, 1, 1.1, False, True),
            ("A", "7", "France", later, 1, 2.2, True, False),
        ],
        LINE,
    )
    row = orders.roll_up_orders(df).first()
    assert (row.customer_id, row.country, row.n_lines, row.order_revenue) == ("7", "France", 2, 3.3)
    assert (row.order_date, row.is_cancellation, row.is_guest) == (D("2011-01-15"), True, False)


ORDER = (
    "invoice_id string, customer_id string, country string, ordered_at timestamp_ntz,"
    " order_date date, order_month date, total_quantity bigint, order_revenue double,"
    " is_cancellation boolean"
)


def order(invoice, customer, day, revenue=10.0, units=1, country="UK", cancelled=False):
    date = D(day)
    return (invoice, customer, country, dt.datetime.combine(date, dt.time(12)), date,
            date.replace(day=1), units, revenue, cancelled)


def test_customer_dimension(spark):
    df = spark.createDataFrame(
        [
            order("1", "a", "2011-01-10", 1.01, 2, "UK"),
            order("2", "a", "2011-03-10", 1.0, 3, None),
            order("3", "a", "2011-02-10", 0.0, 1, "France"),
            order("4", "b", "2011-03-20", 5.0),
            order("5", "b", "2011-12-01", 9.0, cancelled=True),
            order("6", None, "2011-12-02", 9.0),
        ],
        ORDER,
    )
    a, b = dimensions.customers(df).orderBy("customer_id").collect()
    # the latest country that is known; the anchor is the latest kept order of a customer
    assert tuple(a) == ("a", "France", D("2011-01-10"), D("2011-03-10"), D("2011-01-01"), 3, 6,
                        2.01, 0.67, 10, 59)
    assert (b.recency_days, b.lifetime_orders) == (0, 1)


def test_average_is_rounded_from_the_binary_value(spark):
    df = spark.createDataFrame(
        [order("1", "a", "2011-01-10", 2.01), order("2", "a", "2011-01-10", 0.0)], ORDER
    )
    # 2.01 / 2 lies just below 1.005
    assert dimensions.customers(df).first().avg_order_value == 1.0


def test_product_dimension(spark):
    df = spark.createDataFrame(
        [
            ("x", "1", "old name", 5, 5.0, D("2011-01-01")),
            ("x", "1", "name b", 1, 1.0, D("2011-02-01")),
            ("x", "2", "name a", -3, -3.0, D("2011-02-01")),
            ("x", "3", None, 1, 1.0, D("2011-03-01")),
            ("y", "3", None, -1, -1.0, D("2011-03-01")),
        ],
        "stock_code string, invoice_id string, description string, quantity int,"
        " line_revenue double, invoice_date date",
    )
    x, y = dimensions.products(df).orderBy("stock_code").collect()
    assert tuple(x) == ("x", "name b", 3, 7, 3, 4.0, 0.4286)
    assert tuple(y) == ("y", None, 1, 0, 1, -1.0, None)


def test_date_dimension(spark):
    df = dimensions.dates(spark)
    assert df.count() == 761
    first = df.orderBy("date_key").first()
    assert tuple(first) == (D("2009-12-01"), 2009, 4, 12, 1, D("2009-12-01"), "2009-12", 2, False)
    sunday = df.filter("date_key = DATE '2010-01-03'").first()
    assert (sunday.day_of_week, sunday.is_weekend) == (0, True)
    assert dimensions.dates(spark, D("2010-01-02"), D("2010-01-02")).count() == 0


# marts -------------------------------------------------------------------------------


def first_orders(spark, **days):
    return spark.createDataFrame(
        [(name, D(day), D(day).replace(day=1)) for name, day in days.items()],
        "customer_id string, first_order_date date, cohort_month date",
    )


def test_daily_mart(spark):
    df = spark.createDataFrame(
        [
            order("n1", "P", "2019-07-30", 12.5, 5),
            order("n2", "Q", "2019-07-30", 7.5, 1),
            order("n3", "P", "2019-08-02", 4.0, 2),
            order("n4", "Q", "2019-08-02", 90.0, 9, cancelled=True),
        ],
        ORDER,
    )
    known = first_orders(spark, P="2019-07-30", Q="2019-07-29")
    days = dimensions.dates(spark, D("2019-07-28"), D("2019-09-01"))
    got = {r.order_date: tuple(r)[1:] for r in marts.revenue_daily(df, known, days).collect()}
    # only days between the first and the last order are there, empty ones included
    assert list(sorted(got)) == [D("2019-07-30"), D("2019-07-31"), D("2019-08-01"), D("2019-08-02")]
    assert got[D("2019-07-30")] == (2, 2, 1, 1, 6, 20.0, 10.0)
    assert got[D("2019-07-31")] == got[D("2019-08-01")] == (0, 0, 0, 0, 0, 0.0, None)
    assert got[D("2019-08-02")] == (1, 1, 0, 1, 2, 4.0, 4.0)


def test_daily_mart_counts_guests_in_revenue_only(spark):
    df = spark.createDataFrame(
        [order(str(i), None, "2011-03-01", 1.0) for i in range(5)]
        + [order("k", "C1", "2011-03-01", 2.0), order("l", "C1", "2011-03-01", 2.0)],
        ORDER,
    )
    days = dimensions.dates(spark, D("2011-03-01"), D("2011-03-02"))
    got = marts.revenue_daily(df, first_orders(spark, C1="2011-03-01"), days).collect()
    assert [tuple(r) for r in got] == [(D("2011-03-01"), 7, 1, 1, 0, 7, 9.0, 1.29)]


def test_monthly_growth_is_against_the_previous_month_present(spark):
    df = spark.createDataFrame(
        [
            order("1", "a", "2011-01-10", 100.0),
            order("2", "a", "2011-01-20", 100.0),
            order("3", "b", "2011-04-10", 150.0),
            order("4", None, "2011-04-10", 100.0),
        ],
        ORDER,
    )
    known = first_orders(spark, a="2011-01-10", b="2011-04-10")
    got = marts.revenue_monthly(df, known).orderBy("month").collect()
    assert [tuple(r) for r in got] == [
        (D("2011-01-01"), 2, 1, 1, 0, 200.0, 100.0, None, None),
        (D("2011-04-01"), 2, 1, 1, 0, 250.0, 125.0, 50.0, 25.0),
    ]


def test_cohorts(spark):
    df = spark.createDataFrame(
        [
            order("1", "a", "2010-12-10"),
            order("2", "b", "2010-12-11"),
            order("3", "a", "2011-02-01"),
            order("4", "a", "2011-02-02"),
            order("5", "b", "2011-02-02", cancelled=True),
            order("6", None, "2011-02-02"),
        ],
        ORDER,
    )
    known = first_orders(spark, a="2010-12-10", b="2010-12-11")
    got = marts.customer_cohorts(df, known).orderBy("activity_month").collect()
    assert [tuple(r) for r in got] == [
        (D("2010-12-01"), 2, 0, D("2010-12-01"), 2, 1.0),
        (D("2010-12-01"), 2, 2, D("2011-02-01"), 1, 0.5),
    ]
    matrix = serving.cohort_matrix(marts.customer_cohorts(df, known), max_age=2).first()
    assert tuple(matrix) == (D("2010-12-01"), 1.0, None, 0.5)


def test_cohorts_by_bits_over_many_years(spark):
    draw, first, rows, active = random.Random(4), {}, [], {}
    for i in range(40):
        name = f"c{i}"
        days = [D("2004-12-31")] * (i % 7 == 0)  # the last month of one span of bits
        for _ in range(30):
            days.append(D("2005-01-01") + dt.timedelta(draw.randrange(4200)))
        first[name] = str(min(days))
        for day in days:
            rows.append(order(f"{name}-{len(rows)}", name, str(day)))
            cohort = min(days).replace(day=1)
            active.setdefault((cohort, day.replace(day=1)), set()).add(name)
    df, known = spark.createDataFrame(rows, ORDER), first_orders(spark, **first)
    got = marts.customer_cohorts(df, known).collect()
    assert {(r.cohort_month, r.activity_month): r.n_active_customers for r in got} == {
        key: len(names) for key, names in active.items()
    }
    assert len(got) == len(active)
    # one row per customer and span of five years
    spans = {(name, month.year // 5) for (_, month), names in active.items() for name in names}
    assert marts.active_months(df).count() == len(spans)


def test_cohorts_keep_orders_without_a_date(spark):
    df = spark.createDataFrame([order("1", "a", "2010-12-10")], ORDER)
    df = df.unionByName(df.withColumn("order_date", F.lit(None).cast("date")))
    got = marts.customer_cohorts(df, first_orders(spark, a="2010-12-10")).collect()
    assert {(r.activity_month, r.n_active_customers) for r in got} == {(D("2010-12-01"), 1), (None, 1)}


def test_rfm_grid(spark):
    grid = spark.range(1, 6).select(F.col("id").alias("r")).crossJoin(
        spark.range(1, 6).select(F.col("id").alias("f"))
    )
    got = grid.select("r", "f", marts.rfm_segment(F.col("r"), F.col("f")).alias("s")).collect()
    by_recency = {r: [None] * 5 for r in range(1, 6)}
    for cell in got:
        by_recency[cell.r][cell.f - 1] = cell.s
    new, loyal, best = "New / Promising", "Loyal Customers", "Champions"
    lost = "Hibernating / Lost"
    assert by_recency == {
        5: [new, new, loyal, best, best],
        4: [new, new, loyal, best, best],
        3: ["Potential Loyalists"] * 2 + [loyal] * 3,
        2: [lost] * 2 + ["At Risk"] * 3,
        1: [lost, lost, "Needs Attention", "Cannot Lose Them", "Cannot Lose Them"],
    }


def test_blank_country_falls_to_other_and_is_reported(spark):
    df = spark.createDataFrame(
        [
            order("1", "a", "2011-01-10", 30.0, country=" united KINGDOM "),
            order("2", "b", "2011-01-10", 60.0, country=None),
            order("3", None, "2011-01-10", 10.0, country=None),
        ],
        ORDER,
    )
    mart = marts.country_performance(df, country_region(spark))
    got = {r.country: tuple(r)[1:] for r in mart.collect()}
    assert got == {
        " united KINGDOM ": ("UK & Ireland", 1, 1, 30.0, 30.0, 30.0),
        None: ("Other", 1, 2, 70.0, 35.0, 70.0),
    }
    checks = quality.check_table("mart_country_performance", lambda _: mart)
    failed = {r.check_id for r in checks.collect() if r.failures}
    assert failed == {"mart_country_performance.country.not_null"}


def test_share_of_nothing_is_null(spark):
    df = spark.createDataFrame(
        [order("1", "a", "2011-01-10", 5.0), order("2", "a", "2011-01-10", -5.0)], ORDER
    )
    row = marts.country_performance(df, country_region(spark)).first()
    assert (row.revenue, row.revenue_share_pct) == (0.0, None)


def test_profile_of_no_lines(spark):
    row = marts.data_quality(staged(spark).limit(0)).first()
    assert (row.n_rows, row.pct_guest_lines, row.source_lag_days) == (0, None, None)
