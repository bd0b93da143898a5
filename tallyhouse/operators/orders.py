"""Orders: lines rolled up to one row per invoice (M3, M4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import cents, month_start


def roll_up_orders(lines: DataFrame) -> DataFrame:
    """M3: one row per invoice with its net revenue.

    An invoice names one customer and one country. Grouping by them first keeps text
    out of the aggregation buffers, so the pass over the lines is a hash aggregate
    that combines on the map side instead of a sort of all lines; the second pass
    only sees invoices. Should an invoice name several, the smallest is taken.
    """
    by_party = lines.groupBy("invoice_id", "customer_id", "country").agg(
        F.min("invoiced_at").alias("ordered_at"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("quantity").alias("units"),
        F.sum(cents(F.col("line_revenue"))).alias("revenue_cents"),
        F.bool_or("is_cancellation").alias("is_cancellation"),
        F.bool_and("is_guest").alias("is_guest"),
    )
    orders = by_party.groupBy("invoice_id").agg(
        F.min("customer_id").alias("customer_id"),
        F.min("country").alias("country"),
        F.min("ordered_at").alias("ordered_at"),
        F.sum("n_lines").alias("n_lines"),
        F.sum("units").alias("total_quantity"),
        (F.sum("revenue_cents") / 100.0).alias("order_revenue"),
        F.bool_or("is_cancellation").alias("is_cancellation"),
        F.bool_and("is_guest").alias("is_guest"),
    )
    day = F.col("ordered_at").cast("date")
    return order_fact(
        orders.withColumns({"order_date": day, "order_month": month_start(day)})
    )


def order_fact(orders: DataFrame) -> DataFrame:
    """M4: the columns of the order fact."""
    return orders.select(
        "invoice_id",
        "customer_id",
        "country",
        "ordered_at",
        "order_date",
        "order_month",
        "n_lines",
        "total_quantity",
        "order_revenue",
        "is_cancellation",
        "is_guest",
    )
