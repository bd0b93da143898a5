"""Invoice lines: staging, the revenue lines and the line fact (M1, M2, M5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import (
    blank_to_null,
    double_text,
    month_start,
    round_half_away,
    surrogate_key,
)


def stage_lines(raw: DataFrame) -> DataFrame:
    """M1: one typed row per landed line, with flags and a line key.

    Only lines without an invoice or a product code are left out.
    """
    kept = raw.filter(F.col("invoice").isNotNull() & F.col("stock_code").isNotNull())
    typed = kept.select(
        F.trim("invoice").alias("invoice_id"),
        F.upper(F.trim("stock_code")).alias("stock_code"),
        blank_to_null(F.col("description")).alias("description"),
        "customer_id",
        blank_to_null(F.col("country")).alias("country"),
        F.col("quantity").cast("int").alias("quantity"),
        F.col("price").cast("double").alias("unit_price"),
        F.col("invoice_date").cast("timestamp_ntz").alias("invoiced_at"),
        F.col("invoice_date").cast("date").alias("invoice_date"),
        "_source_sheet",
        "_loaded_at",
    )
    line_id = surrogate_key(
        F.col("invoice_id"),
        F.col("stock_code"),
        F.col("invoiced_at"),
        F.col("quantity"),
        double_text(F.col("unit_price")),
        F.col("customer_id"),
    )
    return typed.select(
        line_id.alias("invoice_line_id"),
        "invoice_id",
        "stock_code",
        "description",
        "customer_id",
        "country",
        "quantity",
        "unit_price",
        round_half_away(F.col("quantity") * F.col("unit_price"), 2).alias("line_revenue"),
        "invoiced_at",
        "invoice_date",
        F.col("invoice_id").startswith("C").alias("is_cancellation"),
        (F.col("quantity") < 0).alias("is_return"),
        F.col("customer_id").isNull().alias("is_guest"),
        (F.col("unit_price") <= 0).alias("is_non_revenue"),
        "_source_sheet",
        "_loaded_at",
    )


def carries_revenue() -> Column:
    """Staged lines that M2 keeps.

    A line without a price has no known revenue flag and drops out with the free ones.
    """
    return ~F.col("is_non_revenue") & F.col("quantity").isNotNull()


def revenue_lines(staged: DataFrame) -> DataFrame:
    """M2: lines that carry revenue; cancellations and returns stay in as negatives."""
    return staged.filter(carries_revenue()).select(
        "invoice_line_id",
        "invoice_id",
        "stock_code",
        "description",
        "customer_id",
        "country",
        "quantity",
        "unit_price",
        "line_revenue",
        "invoiced_at",
        "invoice_date",
        month_start(F.col("invoice_date")).alias("invoice_month"),
        "is_cancellation",
        "is_return",
        "is_guest",
    )


def line_fact(lines: DataFrame) -> DataFrame:
    """M5: keys, measures and flags only."""
    return lines.select(
        "invoice_line_id",
        "invoice_id",
        "customer_id",
        "stock_code",
        "invoice_date",
        "invoice_month",
        "quantity",
        "unit_price",
        "line_revenue",
        "is_cancellation",
        "is_return",
        "is_guest",
    )
