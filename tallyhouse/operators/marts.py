"""Metric marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import cents, month_start, money_sum, percent_of, round_half_away
from tallyhouse.operators.ranking import Ntile, with_ntiles, with_row_number

#: Months in the bits of one row of ``active_months``.
SPAN = 60


def _kept(orders: DataFrame) -> DataFrame:
    return orders.filter(~F.col("is_cancellation"))


def _with_first_order(activity: DataFrame, customers: DataFrame) -> DataFrame:
    """Left join of the first order date; guests have no key and stay unmatched.

    ``activity`` holds at most one row per customer and day, guests included, so no
    customer is large enough to overload the task of its join key.
    """
    return activity.join(customers.select("customer_id", "first_order_date"), "customer_id", "left")


def _is_first_order() -> Column:
    return F.col("order_date") == F.col("first_order_date")


def revenue_daily(orders: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """M9: revenue and customers per day, days without orders filled in as zero."""
    kept = _kept(orders)
    by_customer = kept.groupBy("order_date", "customer_id").agg(
        F.count("invoice_id").alias("n_orders"),
        F.sum("total_quantity").alias("n_units"),
        F.sum(cents(F.col("order_revenue"))).alias("revenue_cents"),
    )
    # one row per day and customer: distinct customers are a plain count from here on
    daily = (
        _with_first_order(by_customer, customers)
        .groupBy("order_date")
        .agg(
            F.sum("n_orders").alias("n_orders"),
            F.count("customer_id").alias("n_active_customers"),
            F.count_if(_is_first_order()).alias("n_new_customers"),
            F.sum("n_units").alias("n_units"),
            (F.sum("revenue_cents") / 100.0).alias("revenue"),
        )
    )
    first_day = kept.agg(F.min("order_date")).scalar()
    last_day = kept.agg(F.max("order_date")).scalar()
    calendar = dates.filter(F.col("date_key").between(first_day, last_day)).select("date_key")
    zero = F.lit(0).cast("bigint")
    active = F.coalesce("n_active_customers", zero)
    new = F.coalesce("n_new_customers", zero)
    average = F.try_divide("revenue", "n_orders")
    return calendar.join(daily, F.col("date_key") == F.col("order_date"), "left").select(
        F.col("date_key").alias("order_date"),
        F.coalesce("n_orders", zero).alias("n_orders"),
        active.alias("n_active_customers"),
        new.alias("n_new_customers"),
        (active - new).alias("n_returning_customers"),
        F.coalesce("n_units", zero).alias("n_units"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
        round_half_away(average, 2).alias("avg_order_value"),
    )


def revenue_monthly(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue and customers per month, growth against the previous month present."""
    by_day = (
        _kept(orders)
        .groupBy("order_month", "order_date", "customer_id")
        .agg(
            F.count("invoice_id").alias("n_orders"),
            F.sum(cents(F.col("order_revenue"))).alias("revenue_cents"),
        )
    )
    # after a shuffled join on the customer this grouping needs no further shuffle
    by_customer = (
        _with_first_order(by_day, customers)
        .groupBy("order_month", "customer_id")
        .agg(
            F.sum("n_orders").alias("n_orders"),
            F.sum("revenue_cents").alias("revenue_cents"),
            F.bool_or(_is_first_order()).alias("is_new"),
        )
    )
    monthly = by_customer.groupBy(F.col("order_month").alias("month")).agg(
        F.sum("n_orders").alias("n_orders"),
        F.count("customer_id").alias("n_active_customers"),
        F.count_if("is_new").alias("n_new_customers"),
        (F.sum("revenue_cents") / 100.0).alias("revenue"),
    )
    # one row per month: the only window of a single partition, bounded by the calendar
    before = F.lag("revenue").over(Window.orderBy("month"))
    change = F.col("revenue") - F.col("revenue_before")
    average = F.try_divide("revenue", "n_orders")
    growth = F.try_divide(change, F.col("revenue_before")) * 100.0
    return monthly.withColumn("revenue_before", before).select(
        "month",
        "n_orders",
        "n_active_customers",
        "n_new_customers",
        (F.col("n_active_customers") - F.col("n_new_customers")).alias("n_returning_customers"),
        "revenue",
        round_half_away(average, 2).alias("avg_order_value"),
        round_half_away(change, 2).alias("revenue_mom_change"),
        round_half_away(growth, 1).alias("revenue_mom_pct"),
    )


def active_months(orders: DataFrame) -> DataFrame:
    """The months in which a customer orders, as one row per customer and ``SPAN`` months.

    ``span`` counts the spans since year 0, bit k of ``months`` is its month k. The bits of a
    customer are or-ed before the shuffle, which moves that row and not one for each month. Orders
    without a date have no span and no months.
    """
    month = F.year("order_date").cast("bigint") * 12 + F.month("order_date") - 1
    bit = F.expr(f"shiftleft(1L, CAST(pmod(_month, {SPAN}) AS int))")
    return (
        _kept(orders)
        .filter(F.col("customer_id").isNotNull())
        .select("customer_id", month.alias("_month"))
        .select("customer_id", F.floor(F.col("_month") / SPAN).alias("span"), bit.alias("_bit"))
        .groupBy("customer_id", "span")
        .agg(F.bit_or("_bit").alias("months"))
    )


def customer_cohorts(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Share of each monthly cohort that orders in the months after it."""
    cohort_of = customers.select("customer_id", "cohort_month")
    by_bits = (
        active_months(orders)
        .join(cohort_of, "customer_id")
        .groupBy("cohort_month", "span", "months")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # equal histories are one row by now; the months come out of the bits only here
    set_bits = F.expr(f"filter(sequence(0, {SPAN - 1}), k -> (shiftright(months, k) & 1L) = 1L)")
    undated = F.array(F.lit(None).cast("int"))
    number = F.col("span") * SPAN + F.col("_bit")
    activity_month = F.make_date(
        F.floor(number / 12).cast("int"), F.pmod(number, F.lit(12)).cast("int") + 1, F.lit(1)
    )
    activity = (
        by_bits.withColumn("_bit", F.explode(F.when(F.col("span").isNull(), undated).otherwise(set_bits)))
        .groupBy("cohort_month", activity_month.alias("activity_month"))
        .agg(F.sum("n").alias("n_active_customers"))
    )
    sizes = cohort_of.groupBy("cohort_month").agg(F.count("customer_id").alias("cohort_customers"))
    years = F.year("activity_month") - F.year("cohort_month")
    months = F.month("activity_month") - F.month("cohort_month")
    rate = F.try_divide("n_active_customers", "cohort_customers")
    return activity.join(sizes, "cohort_month").select(
        "cohort_month",
        "cohort_customers",
        (years * 12 + months).cast("bigint").alias("months_since_cohort"),
        "activity_month",
        "n_active_customers",
        round_half_away(rate, 4).alias("retention_rate"),
    )


def rfm_segment(recency: Column, frequency: Column) -> Column:
    """Segment by recency and frequency score; the monetary score does not matter.

    Stated per recency score: frequent customers first, then the rest.
    """
    fresh = (
        F.when(frequency >= 4, "Champions")
        .when(frequency == 3, "Loyal Customers")
        .otherwise("New / Promising")
    )
    middling = F.when(frequency >= 3, "Loyal Customers").otherwise("Potential Loyalists")
    fading = F.when(frequency >= 3, "At Risk").otherwise("Hibernating / Lost")
    gone = (
        F.when(frequency >= 4, "Cannot Lose Them")
        .when(frequency == 3, "Needs Attention")
        .otherwise("Hibernating / Lost")
    )
    return (
        F.when(recency >= 4, fresh)
        .when(recency == 3, middling)
        .when(recency == 2, fading)
        .otherwise(gone)
    )


def rfm_segments(customers: DataFrame) -> DataFrame:
    """Quintile scores for recency, frequency and money, and a segment."""
    base = customers.select(
        "customer_id",
        "country",
        "recency_days",
        F.col("lifetime_orders").alias("frequency"),
        F.col("lifetime_revenue").alias("monetary"),
    )
    scored = with_ntiles(
        base,
        "customer_id",
        {
            "recency_tile": Ntile("recency_days", 5),
            "f_score": Ntile("frequency", 5),
            "m_score": Ntile("monetary", 5),
        },
    ).withColumn("r_score", F.lit(6).cast("bigint") - F.col("recency_tile"))
    return scored.select(
        "customer_id",
        "country",
        "recency_days",
        "frequency",
        "monetary",
        "r_score",
        "f_score",
        "m_score",
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_total"),
        rfm_segment(F.col("r_score"), F.col("f_score")).alias("rfm_segment"),
    )


def country_performance(orders: DataFrame, country_region: DataFrame) -> DataFrame:
    """Customers, orders and revenue per country, with region and revenue share."""
    kept = _kept(orders)
    # the largest country is spread over its customers before it becomes one row
    by_customer = kept.groupBy("country", "customer_id").agg(
        F.count("invoice_id").alias("n_orders"),
        F.sum(cents(F.col("order_revenue"))).alias("revenue_cents"),
    )
    by_country = by_customer.groupBy("country").agg(
        F.count("customer_id").alias("n_customers"),
        F.sum("n_orders").alias("n_orders"),
        (F.sum("revenue_cents") / 100.0).alias("revenue"),
    )
    # sums of cents are exact, so the total of the orders is the total of the countries
    total = kept.agg(money_sum(F.col("order_revenue"))).scalar()
    regions = country_region.select(
        F.lower(F.trim("country")).alias("region_key"), F.col("region").alias("seed_region")
    )
    same_country = F.lower(F.trim("country")) == F.col("region_key")
    average = F.try_divide("revenue", "n_orders")
    return by_country.join(regions, same_country, "left").select(
        "country",
        F.coalesce("seed_region", F.lit("Other")).alias("region"),
        "n_customers",
        "n_orders",
        "revenue",
        round_half_away(average, 2).alias("avg_order_value"),
        percent_of(F.col("revenue"), total).alias("revenue_share_pct"),
    )


def product_performance(products: DataFrame) -> DataFrame:
    """Products with positive net revenue, ranked, with their share of the total."""
    selling = products.filter(F.col("total_revenue") > 0)
    total = selling.agg(money_sum(F.col("total_revenue"))).scalar()
    order = [F.col("total_revenue").desc(), F.col("stock_code").asc()]
    ranked = with_row_number(selling, order, "revenue_rank")
    return ranked.select(
        "stock_code",
        "description",
        "n_orders",
        "units_sold",
        "units_returned",
        "total_revenue",
        "return_rate",
        "revenue_rank",
        percent_of(F.col("total_revenue"), total).alias("revenue_share_pct"),
    )


def data_quality(staged: DataFrame) -> DataFrame:
    """One row that profiles the staged lines.

    Each distinct count is a narrow scan of its own column. In one aggregate Spark
    would multiply every line by the number of distinct counts.
    """
    rows = F.count(F.lit(1))

    def percent(flag: str) -> Column:
        return percent_of(F.count_if(flag), rows, scale_first=True)

    def distinct(column: str) -> Column:
        return staged.select(column).distinct().agg(F.count(column)).scalar()

    profile = staged.agg(
        rows.alias("n_rows"),
        percent("is_guest").alias("pct_guest_lines"),
        percent("is_cancellation").alias("pct_cancellation_lines"),
        percent("is_return").alias("pct_return_lines"),
        F.count_if("is_non_revenue").alias("n_non_revenue_lines"),
        F.min("invoice_date").alias("min_invoice_date"),
        F.max("invoice_date").alias("max_invoice_date"),
        F.max("_loaded_at").alias("last_loaded_at"),
    )
    lag = F.date_diff(F.col("last_loaded_at").cast("date"), "max_invoice_date")
    return profile.select(
        "n_rows",
        distinct("invoice_id").alias("n_invoices"),
        distinct("customer_id").alias("n_customers"),
        distinct("stock_code").alias("n_products"),
        "pct_guest_lines",
        "pct_cancellation_lines",
        "pct_return_lines",
        "n_non_revenue_lines",
        "min_invoice_date",
        "max_invoice_date",
        "last_loaded_at",
        lag.cast("bigint").alias("source_lag_days"),
    )
