"""Constraint checks and freshness.

A check is a count of failing rows and passes at zero. NULL passes every check but
``NotNull``; range bounds are inclusive.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import cents, packed_key
from tallyhouse.operators.lines import carries_revenue


@dataclass(frozen=True)
class RowCheck:
    """A check that looks at one row at a time."""

    column: str

    kind = "row"

    def fails(self) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(RowCheck):
    kind = "not_null"

    def fails(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues(RowCheck):
    values: tuple

    kind = "accepted_values"

    def fails(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class AcceptedRange(RowCheck):
    low: float | None = None
    high: float | None = None

    kind = "accepted_range"

    def fails(self) -> Column:
        outside = F.lit(False)
        if self.low is not None:
            outside = outside | (F.col(self.column) < self.low)
        if self.high is not None:
            outside = outside | (F.col(self.column) > self.high)
        return outside


@dataclass(frozen=True)
class Unique:
    """Counts the values that occur more than once."""

    column: str

    kind = "unique"

    def failures(self, df: DataFrame) -> DataFrame:
        repeated = df.groupBy(self.column).count().filter(
            F.col(self.column).isNotNull() & (F.col("count") > 1)
        )
        return repeated.agg(F.count(F.lit(1)).alias("failures"))


@dataclass(frozen=True)
class ForeignKey:
    """Counts the rows whose key has no row in the parent table."""

    column: str
    parent: str
    parent_column: str
    where: str | None = None

    kind = "relationships"

    def failures(self, df: DataFrame, parent: DataFrame) -> DataFrame:
        child = df.filter(self.where) if self.where else df
        # a key that many rows share becomes one row before the join
        keys = child.filter(F.col(self.column).isNotNull()).groupBy(self.column).count()
        known = parent.select(F.col(self.parent_column).alias("parent_key"))
        orphans = keys.join(known, F.col(self.column) == F.col("parent_key"), "left_anti")
        total = F.coalesce(F.sum("count"), F.lit(0).cast("bigint"))
        return orphans.agg(total.alias("failures"))


Check = RowCheck | Unique | ForeignKey

RFM_SEGMENTS = (
    "Champions",
    "Loyal Customers",
    "New / Promising",
    "Potential Loyalists",
    "At Risk",
    "Cannot Lose Them",
    "Hibernating / Lost",
    "Needs Attention",
)


def _key(column: str) -> list[Check]:
    return [Unique(column), NotNull(column)]


CHECKS: dict[str, list[Check]] = {
    "stg_online_retail": [
        *_key("invoice_line_id"),
        NotNull("invoice_id"),
        NotNull("stock_code"),
        NotNull("quantity"),
        NotNull("unit_price"),
        NotNull("invoice_date"),
        AcceptedValues("is_cancellation", (True, False)),
        AcceptedValues("is_return", (True, False)),
    ],
    "int_invoice_lines_cleaned": [
        *_key("invoice_line_id"),
        AcceptedRange("line_revenue", -200000, 200000),
    ],
    "int_orders": [*_key("invoice_id"), NotNull("order_date")],
    "fct_invoice_lines": [
        *_key("invoice_line_id"),
        NotNull("invoice_id"),
        ForeignKey("invoice_id", "fct_orders", "invoice_id"),
        NotNull("stock_code"),
        ForeignKey("stock_code", "dim_products", "stock_code"),
    ],
    "fct_orders": [
        *_key("invoice_id"),
        ForeignKey(
            "customer_id",
            "dim_customers",
            "customer_id",
            where="customer_id IS NOT NULL AND NOT is_cancellation",
        ),
    ],
    "dim_customers": [
        *_key("customer_id"),
        NotNull("cohort_month"),
        AcceptedRange("recency_days", 0),
    ],
    "dim_products": _key("stock_code"),
    "dim_dates": _key("date_key"),
    "mart_revenue_daily": [*_key("order_date"), NotNull("revenue")],
    "mart_revenue_monthly": _key("month"),
    "mart_customer_cohorts": [
        NotNull("retention_rate"),
        AcceptedRange("retention_rate", 0, 1),
        AcceptedRange("months_since_cohort", 0),
    ],
    "mart_rfm_segments": [
        *_key("customer_id"),
        AcceptedRange("r_score", 1, 5),
        AcceptedValues("rfm_segment", RFM_SEGMENTS),
    ],
    "mart_country_performance": [*_key("country"), NotNull("region")],
    "mart_product_performance": [*_key("stock_code"), *_key("revenue_rank")],
    "mart_data_quality": [
        NotNull("n_rows"),
        AcceptedRange("n_rows", 1),
        AcceptedRange("pct_cancellation_lines", 0, 100),
    ],
    "country_region": [*_key("country"), NotNull("region")],
}


def check_id(table: str, check: Check) -> str:
    return f"{table}.{check.column}.{check.kind}"


def _row_check_results(table: str, df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """All row checks of a table in one pass without a shuffle of its rows."""
    counted = df.agg(*[F.count_if(c.fails()).alias(f"c{i}") for i, c in enumerate(checks)])
    results = [
        F.struct(F.lit(check_id(table, c)).alias("check_id"), F.col(f"c{i}").alias("failures"))
        for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*results)))


@dataclass(frozen=True)
class Planned:
    """A check under its name, over the rows of a table that ``scope`` holds for (or all)."""

    name: str
    check: Check
    scope: Column | None = None

    def counted(self) -> Column | None:
        """The rows that are counted: failing ones, or those whose key is looked at (None: all)."""
        if isinstance(self.check, RowCheck):
            return self.check.fails() if self.scope is None else self.scope & self.check.fails()
        if isinstance(self.check, ForeignKey) and self.check.where:
            where = F.expr(self.check.where)
            return where if self.scope is None else self.scope & where
        return self.scope


def _entries(df: DataFrame, keys: list[str], planned: Sequence[Planned], read: Callable[[str], DataFrame]) -> DataFrame:
    """What is grouped: each key of a row, as packed text under the key's number, and each failed row check under a number of its own.

    The keys of parents stand among them: children and parents meet in the grouping that counts
    them, so a foreign key takes no join.
    """

    def entry(number: int, value: Column) -> Column:
        return F.struct(F.lit(number).alias("_key"), packed_key(value).alias("_value"))

    flags = [p.counted().alias(f"_f{i}") for i, p in enumerate(planned) if _is_scoped(p)]
    always = [entry(k, F.col(key)) for k, key in enumerate(keys)]
    row_checks = [(len(keys) + i, p.counted()) for i, p in enumerate(planned) if isinstance(p.check, RowCheck)]
    found = F.array(*always)
    if row_checks:
        # few rows fail, so most carry their keys only
        failed = [F.when(fails, entry(number, F.lit(None))) for number, fails in row_checks]
        some = reduce(lambda a, b: a | b, [F.coalesce(fails, F.lit(False)) for _, fails in row_checks])
        found = F.when(some, F.array(*always, *failed)).otherwise(found)
    rows = df.select(*flags, F.lit(None).cast("int").alias("_parent_of"), F.inline(found)).filter("_key IS NOT NULL")
    for i, p in enumerate(planned):
        if isinstance(p.check, ForeignKey):
            none = [F.lit(False).alias(f"_f{n}") for n, other in enumerate(planned) if _is_scoped(other)]
            of = [F.lit(i).alias("_parent_of"), F.lit(keys.index(p.check.column)).alias("_key")]
            value = packed_key(F.col(p.check.parent_column)).alias("_value")
            rows = rows.unionByName(read(p.check.parent).select(*none, *of, value))
    return rows


def _is_scoped(p: Planned) -> bool:
    return not isinstance(p.check, RowCheck) and p.counted() is not None


def run_checks(df: DataFrame, planned: Sequence[Planned], read: Callable[[str], DataFrame]) -> DataFrame:
    """All checks of a table from one pass over it, and one shuffle of combined counts by key."""
    keys = list(dict.fromkeys(p.check.column for p in planned if not isinstance(p.check, RowCheck)))
    if not keys:
        counts = df.agg(*[F.count_if(p.counted()).alias(f"_m{i}") for i, p in enumerate(planned)])
        return _named(counts, planned)
    child = F.col("_parent_of").isNull()
    measures = [F.count_if(child).alias("_n")]
    measures += [F.count_if(child & F.col(f"_f{i}")).alias(f"_m{i}") for i, p in enumerate(planned) if _is_scoped(p)]
    measures += [
        F.bool_or(F.col("_parent_of") == i).alias(f"_known{i}") for i, p in enumerate(planned) if isinstance(p.check, ForeignKey)
    ]
    counts = _entries(df, keys, planned, read).groupBy("_key", "_value").agg(*measures)

    def failures(i: int, p: Planned) -> Column:
        rows = F.col(f"_m{i}" if _is_scoped(p) else "_n")
        if isinstance(p.check, RowCheck):
            failing = F.col("_key") == len(keys) + i
        else:
            failing = (F.col("_key") == keys.index(p.check.column)) & F.col("_value").isNotNull()
        if isinstance(p.check, Unique):
            return F.count_if(failing & (rows > 1))
        if isinstance(p.check, ForeignKey):
            failing &= ~F.coalesce(f"_known{i}", F.lit(False))
        return F.coalesce(F.sum(F.when(failing, rows)), F.lit(0).cast("bigint"))

    return _named(counts.agg(*[failures(i, p).alias(f"_m{i}") for i, p in enumerate(planned)]), planned)


def _named(row: DataFrame, planned: Sequence[Planned]) -> DataFrame:
    """One row of counts as rows of (check_id, failures)."""
    results = [
        F.struct(F.lit(p.name).alias("check_id"), F.col(f"_m{i}").alias("failures")) for i, p in enumerate(planned)
    ]
    return row.select(F.inline(F.array(*results)))


def _planned(table: str, scope: Column | None = None) -> list[Planned]:
    return [Planned(check_id(table, check), check, scope) for check in CHECKS[table]]


def check_table(table: str, read: Callable[[str], DataFrame]) -> DataFrame:
    """Run the checks of a table; ``read`` returns it and its parents by name."""
    return run_checks(read(table), _planned(table), read)


def _violations(name: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(name).alias("check_id"), "failures"
    )


def cohort_not_over_100(cohorts: DataFrame) -> DataFrame:
    """No cohort keeps more customers than it has."""
    return _violations("cohort_not_over_100", cohorts.filter(F.col("retention_rate") > 1.0))


def no_future_dates(lines: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """No line is dated after ``as_of``, by default today."""
    limit = F.current_date() if as_of is None else F.lit(as_of)
    return _violations("no_future_dates", lines.filter(F.col("invoice_date") > limit))


def order_revenue_reconciles(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Order revenue is the sum of its lines, give or take a cent."""
    by_invoice = lines.groupBy("invoice_id").agg(
        (F.sum(cents(F.col("line_revenue"))) / 100.0).alias("lines_revenue")
    )
    gap = F.abs(F.col("order_revenue") - F.col("lines_revenue"))
    joined = orders.select("invoice_id", "order_revenue").join(by_invoice, "invoice_id")
    return _violations("order_revenue_reconciles", joined.filter(gap > 0.01))


def all_checks(read: Callable[[str], DataFrame], as_of: dt.date | None = None) -> DataFrame:
    """All sixty checks as (check_id, failures).

    The revenue lines are staged lines that were not left out, so the checks of both
    share a pass over the landing, and one count of the line keys.
    """
    staged = [*_planned("stg_online_retail"), *_planned("int_invoice_lines_cleaned", carries_revenue())]
    results = [run_checks(read("stg_online_retail"), staged, read)]
    others = [table for table in CHECKS if table not in ("stg_online_retail", "int_invoice_lines_cleaned")]
    results += [check_table(table, read) for table in others]
    results.append(cohort_not_over_100(read("mart_customer_cohorts")))
    results.append(no_future_dates(read("fct_invoice_lines"), as_of))
    results.append(order_revenue_reconciles(read("fct_invoice_lines"), read("fct_orders")))
    return reduce(DataFrame.unionByName, results)


def freshness(
    raw: DataFrame,
    as_of: dt.datetime,
    warn: dt.timedelta = dt.timedelta(hours=36),
    error: dt.timedelta = dt.timedelta(days=7),
) -> DataFrame:
    """Q1: age of the newest load against the service level."""
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    age = F.col("age_seconds")
    status = (
        F.when(age.isNull() | (age > error.total_seconds()), "error")
        .when(age > warn.total_seconds(), "warn")
        .otherwise("pass")
    )
    newest = raw.agg(F.max("_loaded_at").alias("max_loaded_at"))
    aged = newest.withColumn("age_seconds", F.timestamp_diff("SECOND", "max_loaded_at", now))
    return aged.select("max_loaded_at", "age_seconds", status.alias("status"))
