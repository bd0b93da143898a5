"""Customer, product and date dimensions (M6 to M8)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import cents, days_between_bounds, month_start, round_half_away

CALENDAR_START = dt.date(2009, 12, 1)
CALENDAR_END_EXCLUSIVE = dt.date(2012, 1, 1)


def customers(orders: DataFrame) -> DataFrame:
    """M6: one row per known customer over orders that were not cancelled.

    Recency counts back from the latest of these orders, not from today.
    """
    attributed = orders.filter(F.col("customer_id").isNotNull() & ~F.col("is_cancellation"))
    latest_day = attributed.agg(F.max("order_date")).scalar()

    # a customer has few countries: the pass over the orders hashes plain numbers only
    by_country = attributed.groupBy("customer_id", "country").agg(
        F.max("ordered_at").alias("last_ordered_at"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count("invoice_id").alias("n_orders"),
        F.sum("total_quantity").alias("units"),
        F.sum(cents(F.col("order_revenue"))).alias("revenue_cents"),
    )
    latest_first = F.struct("last_ordered_at", "country")
    named = F.when(F.col("country").isNotNull(), latest_first)
    lifetime = by_country.groupBy("customer_id").agg(
        F.max(named).getField("country").alias("country"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
        F.sum("n_orders").alias("lifetime_orders"),
        F.sum("units").alias("lifetime_units"),
        (F.sum("revenue_cents") / 100.0).alias("lifetime_revenue"),
    )
    average = F.try_divide("lifetime_revenue", "lifetime_orders")
    return lifetime.select(
        "customer_id",
        "country",
        "first_order_date",
        "last_order_date",
        month_start(F.col("first_order_date")).alias("cohort_month"),
        "lifetime_orders",
        "lifetime_units",
        "lifetime_revenue",
        round_half_away(average, 2).alias("avg_order_value"),
        F.date_diff(latest_day, F.col("last_order_date")).cast("bigint").alias("recency_days"),
        F.date_diff("last_order_date", "first_order_date").cast("bigint").alias("tenure_days"),
    )


def products(lines: DataFrame) -> DataFrame:
    """M7: one row per stock code; cancelled lines count as returned units.

    The measures need distinct invoices per code, the name needs text: two narrow
    passes, so that no text travels with every (code, invoice) pair.
    """
    sold = F.when(F.col("quantity") > 0, F.col("quantity")).otherwise(0)
    returned = F.when(F.col("quantity") < 0, -F.col("quantity")).otherwise(0)
    by_invoice = lines.groupBy("stock_code", "invoice_id").agg(
        F.sum(sold).alias("sold"),
        F.sum(returned).alias("returned"),
        F.sum(cents(F.col("line_revenue"))).alias("revenue_cents"),
    )
    measures = by_invoice.groupBy("stock_code").agg(
        F.count("invoice_id").alias("n_orders"),
        F.sum("sold").alias("units_sold"),
        F.sum("returned").alias("units_returned"),
        (F.sum("revenue_cents") / 100.0).alias("total_revenue"),
    )
    last_use = (
        lines.filter(F.col("description").isNotNull())
        .groupBy("stock_code", "description")
        .agg(F.max("invoice_date").alias("last_used"))
    )
    # among names last used on the same day the greatest is taken
    names = last_use.groupBy("stock_code").agg(
        F.max(F.struct("last_used", "description")).getField("description").alias("description")
    )
    rate = F.try_divide("units_returned", "units_sold")
    # staging leaves no line without a code, and both sides are partitioned by it
    return measures.join(names, "stock_code", "left").select(
        "stock_code",
        "description",
        "n_orders",
        "units_sold",
        "units_returned",
        "total_revenue",
        round_half_away(rate, 4).alias("return_rate"),
    )


def _date_attributes(days: DataFrame) -> DataFrame:
    key = F.col("date_key")
    day_of_week = F.dayofweek(key) - 1
    return days.select(
        "date_key",
        F.year(key).cast("bigint").alias("year"),
        F.quarter(key).cast("bigint").alias("quarter"),
        F.month(key).cast("bigint").alias("month"),
        F.dayofmonth(key).cast("bigint").alias("day_of_month"),
        month_start(key).alias("month_start"),
        F.date_format(key, "yyyy-MM").alias("year_month"),
        day_of_week.cast("bigint").alias("day_of_week"),
        day_of_week.isin(0, 6).alias("is_weekend"),
    )


def dates(
    spark: SparkSession,
    start: dt.date = CALENDAR_START,
    end_exclusive: dt.date = CALENDAR_END_EXCLUSIVE,
) -> DataFrame:
    """M8: one row per day from start up to, not including, the end. Sunday is 0."""
    bounds = spark.range(1).select(
        F.lit(start).alias("start_day"), F.lit(end_exclusive).alias("end_day")
    )
    return _date_attributes(days_between_bounds(bounds, "start_day", "end_day"))


def dates_covering(orders: DataFrame) -> DataFrame:
    """M8 over the whole calendar years in which orders fall."""
    first_year = F.trunc(F.min("order_date"), "year")
    last_year = F.trunc(F.max("order_date"), "year")
    bounds = orders.agg(
        first_year.alias("start_day"), F.add_months(last_year, 12).alias("end_day")
    )
    return _date_attributes(days_between_bounds(bounds, "start_day", "end_day"))
