"""Serving queries over the stored marts (S1 to S11). Results come out ordered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import cents, money_sum, percent_of, round_half_away
from tallyhouse.operators.ranking import Ntile, with_ntiles


def kpi_headline(daily: DataFrame) -> DataFrame:
    """One row of totals."""
    revenue = money_sum(F.col("revenue"))
    orders = F.sum("n_orders")
    return daily.agg(
        round_half_away(revenue).alias("total_net_revenue"),
        orders.alias("total_orders"),
        F.sum("n_new_customers").alias("total_new_customers"),
        round_half_away(F.try_divide(revenue, orders), 2).alias("avg_order_value"),
    )


def revenue_trend(monthly: DataFrame, with_customers: bool = True) -> DataFrame:
    """Monthly revenue and growth, with or without the customer mix."""
    customers = ["n_new_customers", "n_returning_customers", "avg_order_value"]
    return monthly.select(
        "month", "revenue", "revenue_mom_pct", *(customers if with_customers else [])
    ).orderBy("month")


def new_vs_returning(monthly: DataFrame) -> DataFrame:
    """S3: the customer mix in long form."""
    mix = monthly.select(
        "month",
        F.col("n_new_customers").alias("New"),
        F.col("n_returning_customers").alias("Returning"),
    )
    long = mix.unpivot("month", ["New", "Returning"], "type", "customers")
    return long.orderBy("month", "type")


def cohort_retention(cohorts: DataFrame, max_age: int = 18) -> DataFrame:
    """Retention up to an age in months."""
    return (
        cohorts.filter(F.col("months_since_cohort").between(0, max_age))
        .select(
            "cohort_month",
            "months_since_cohort",
            "cohort_customers",
            "n_active_customers",
            "retention_rate",
        )
        .orderBy("cohort_month", "months_since_cohort")
    )


def cohort_matrix(cohorts: DataFrame, max_age: int = 12) -> DataFrame:
    """One row per cohort, one column per age. The ages are given, so no job looks for them."""
    ages = list(range(max_age + 1))
    wide = (
        cohorts.filter(F.col("months_since_cohort").between(0, max_age))
        .groupBy("cohort_month")
        .pivot("months_since_cohort", ages)
        .agg(F.max("retention_rate"))
    )
    named = [F.col(f"`{age}`").alias(f"month_{age}") for age in ages]
    return wide.select("cohort_month", *named).orderBy("cohort_month")


def rfm_segment_rollup(rfm: DataFrame) -> DataFrame:
    """Size and averages of each segment, the most valuable first."""
    count = F.count(F.lit(1))
    money = F.sum(cents(F.col("monetary"))) / 100.0
    return (
        rfm.groupBy("rfm_segment")
        .agg(
            count.alias("n_customers"),
            round_half_away(money).alias("total_monetary"),
            round_half_away(money / F.count("monetary"), 2).alias("avg_monetary"),
            round_half_away(F.avg("frequency"), 2).alias("avg_frequency"),
            round_half_away(F.avg("recency_days"), 1).alias("avg_recency_days"),
        )
        .orderBy(F.desc("total_monetary"), "rfm_segment")
    )


def rfm_segment_sizes(rfm: DataFrame) -> DataFrame:
    """S6 in short: customers and revenue of each segment."""
    return (
        rfm.groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            round_half_away(money_sum(F.col("monetary"))).alias("revenue"),
        )
        .orderBy(F.desc("revenue"), "rfm_segment")
    )


def country_ranking(countries: DataFrame) -> DataFrame:
    """Countries by revenue."""
    return countries.select(
        "region",
        "country",
        "n_customers",
        "n_orders",
        "revenue",
        "avg_order_value",
        "revenue_share_pct",
    ).orderBy(F.desc("revenue"), "country")


def region_rollup(countries: DataFrame, rounded: bool = True) -> DataFrame:
    """Revenue per region, whole or with cents."""
    revenue = money_sum(F.col("revenue"))
    if rounded:
        revenue = round_half_away(revenue)
    return (
        countries.groupBy("region")
        .agg(revenue.alias("revenue"))
        .orderBy(F.desc("revenue"), "region")
    )


def top_products(ranking: DataFrame, n: int = 25, with_share: bool = True) -> DataFrame:
    """The first n products by revenue."""
    return (
        ranking.select(
            "revenue_rank",
            "stock_code",
            "description",
            "units_sold",
            "total_revenue",
            *(["revenue_share_pct"] if with_share else []),
            "return_rate",
        )
        .orderBy("revenue_rank")
        .limit(n)
    )


def revenue_concentration(customers: DataFrame) -> DataFrame:
    """Share of revenue per customer decile, the highest spenders in decile 1."""
    revenue = customers.select("customer_id", "lifetime_revenue")
    deciles = {"revenue_decile": Ntile("lifetime_revenue", 10, descending=True)}
    total = revenue.agg(money_sum(F.col("lifetime_revenue"))).scalar()
    money = money_sum(F.col("lifetime_revenue"))
    return (
        with_ntiles(revenue, "customer_id", deciles)
        .groupBy("revenue_decile")
        .agg(F.count(F.lit(1)).alias("n_customers"), money.alias("money"))
        .select(
            "revenue_decile",
            "n_customers",
            round_half_away(F.col("money")).alias("revenue"),
            percent_of(F.col("money"), total, scale_first=True).alias("pct_of_total_revenue"),
        )
        .orderBy("revenue_decile")
    )


def quality_snapshot(quality: DataFrame) -> DataFrame:
    """The stored quality profile as it is."""
    return quality
