"""The model graph: which operator makes which dataset out of which others.

Views are recomputed by their readers (column pruning makes that cheaper than storing
every line twice). Tables are Parquet in a folder named by a fingerprint of what they are made
from, so a table whose inputs did not change is found and read instead of built, also by
another session. After the checks a build is published: the tables of a catalog database are
pointed at its folders, and ``Warehouse.open`` serves them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.operators import dimensions, lines, marts, orders, quality
from tallyhouse.schemas import COUNTRY_REGION_SCHEMA, RAW_COLUMNS
from tallyhouse.session import check_session
from tallyhouse.sources import fingerprint
from tallyhouse.sources.ingest import LANDED_MONTH, LoadReport, coerce_types, deal_by_time, dedupe, load, read_landed, write_raw
from tallyhouse.sources.tables import ExportReport, export_marts, publish_table, read_stored, store
from tallyhouse.sources.upsert import LOAD, MONTH, read_line_fact, upsert_invoice_lines


@dataclass(frozen=True)
class Model:
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    stored: bool = True


MODELS: dict[str, Model] = {
    "stg_online_retail": Model(("raw_online_retail",), lines.stage_lines, stored=False),
    "int_invoice_lines_cleaned": Model(
        ("stg_online_retail",), lines.revenue_lines, stored=False
    ),
    "int_orders": Model(("int_invoice_lines_cleaned",), orders.roll_up_orders, stored=False),
    "fct_orders": Model(("int_orders",), orders.order_fact),
    "fct_invoice_lines": Model(("int_invoice_lines_cleaned",), lines.line_fact),
    # the order fact has the columns of the order roll-up and is already stored
    "dim_customers": Model(("fct_orders",), dimensions.customers),
    "dim_products": Model(("int_invoice_lines_cleaned",), dimensions.products),
    "dim_dates": Model(("fct_orders",), dimensions.dates_covering),
    "mart_revenue_daily": Model(
        ("fct_orders", "dim_customers", "dim_dates"), marts.revenue_daily
    ),
    "mart_revenue_monthly": Model(("fct_orders", "dim_customers"), marts.revenue_monthly),
    "mart_customer_cohorts": Model(("fct_orders", "dim_customers"), marts.customer_cohorts),
    "mart_rfm_segments": Model(("dim_customers",), marts.rfm_segments),
    "mart_country_performance": Model(
        ("fct_orders", "country_region"), marts.country_performance
    ),
    "mart_product_performance": Model(("dim_products",), marts.product_performance),
    "mart_data_quality": Model(("stg_online_retail",), marts.data_quality),
}

EXPORTED = [
    "mart_revenue_daily",
    "mart_revenue_monthly",
    "mart_customer_cohorts",
    "mart_rfm_segments",
    "mart_country_performance",
    "mart_product_performance",
    "mart_data_quality",
]


LANDED = "raw_online_retail"
SEED = "country_region"
LINES = "fct_invoice_lines"
#: what a build stores, and how the folders of a table are partitioned
STORED = [LANDED, SEED, *(name for name, model in MODELS.items() if model.stored)]
PARTITIONS = {LANDED: {LANDED_MONTH: "date"}, LINES: {LOAD: "bigint", MONTH: "date"}}


class Warehouse:
    """Datasets by name under one folder, each stored table built when first read.

    ``raw`` is the tagged raw lines, or the parts to load by name and path. ``calendar`` fixes
    the first day and the end (exclusive) of the date dimension; without it the
    dimension covers the calendar years of the orders. With ``incremental`` the line fact is one
    table that each build adds the new days to; late lines are left out of it.

    A table is built again when the files it comes from, the options or the code of this
    package changed since it was stored; ``loaded_at`` alone loads nothing again.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        raw: DataFrame | Mapping[str, str],
        country_region: DataFrame,
        loaded_at: dt.datetime,
        calendar: tuple[dt.date, dt.date] | None = None,
        incremental: bool = False,
    ):
        check_session(spark)
        self.spark = spark
        self.folder = folder
        self.loaded_at = loaded_at
        self.calendar = calendar
        self.incremental = incremental
        self.loaded: LoadReport | None = None
        #: stored tables that this object had to build
        self.built: list[str] = []
        self._raw = raw
        self._country_region = country_region
        self._prints: dict[str, str] = {}
        self._tables: dict[str, DataFrame] = {}

    @classmethod
    def open(cls, spark: SparkSession, database: str) -> Warehouse:
        """The published tables of a database; nothing is built."""
        opened = cls(spark, "", {}, None, None)
        opened._tables = {name: _published(spark, database, name) for name in STORED}
        return opened

    def fingerprint(self, name: str) -> str:
        """What the dataset is made from."""
        if name not in self._prints:
            self._prints[name] = self._made_from(name)
        return self._prints[name]

    def _made_from(self, name: str) -> str:
        if name == LANDED and isinstance(self._raw, Mapping):
            parts = [f"{tag} {fingerprint.of_files(self.spark, [path])}" for tag, path in self._raw.items()]
            return fingerprint.digest(fingerprint.code(), *parts)
        if name in (LANDED, SEED):
            source = self._raw if name == LANDED else self._country_region
            return fingerprint.digest(fingerprint.code(), fingerprint.of_source(source))
        options = [str(self.calendar)] if name == "dim_dates" else []
        if name == LINES and self.incremental:
            options.append("incremental")
        return fingerprint.digest(name, *options, *map(self.fingerprint, MODELS[name].inputs))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}/{self.fingerprint(name)}"

    def read(self, name: str) -> DataFrame:
        if name in MODELS and not MODELS[name].stored:
            return self.compute(name)
        if name not in self._tables:
            self._tables[name] = self._stored(name)
        return self._tables[name]

    def compute(self, name: str) -> DataFrame:
        """The plan of a model over its stored inputs, not stored itself."""
        if name == "dim_dates" and self.calendar:
            return dimensions.dates(self.spark, *self.calendar)
        model = MODELS[name]
        return model.build(*[self.read(source) for source in model.inputs])

    def _location(self, name: str) -> str:
        # the one table that outlives its fingerprints
        return f"{self.folder}/{name}/loads" if name == LINES and self.incremental else self.path(name)

    def _stored(self, name: str) -> DataFrame:
        path = self._location(name)
        if name == LINES and self.incremental:
            self.built.append(name)
            return upsert_invoice_lines(self.compute(name), path)
        if not fingerprint.is_complete(self.spark, path):
            self.built.append(name)
            self._build(name, path)
        if name == LANDED:
            return read_landed(self.spark, path)
        if name == LINES:
            return read_line_fact(self.spark, path)
        return read_stored(self.spark, path)

    def _build(self, name: str, path: str) -> None:
        if name == LANDED and isinstance(self._raw, Mapping):
            self.loaded = load(self.spark, self._raw, path, self.loaded_at)
        elif name == LANDED:
            write_raw(dedupe(deal_by_time(coerce_types(self._raw))), path, self.loaded_at)
        elif name == SEED:
            store(self._country_region.select(*[c.split()[0] for c in COUNTRY_REGION_SCHEMA.split(", ")]), path)
        elif name == LINES:
            upsert_invoice_lines(self.compute(name), path, full_refresh=True, by_month=True)
        else:
            store(self.compute(name), path)

    def build(self) -> None:
        """Store every table that is not there yet."""
        for name in STORED:
            self.read(name)

    def publish(self, database: str) -> None:
        """Point the tables of a catalog database at this build, one after the other."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for name in STORED:
            publish_table(self.read(name), f"`{database}`.`{name}`", self._location(name), PARTITIONS.get(name, {}))


def _published(spark: SparkSession, database: str, name: str) -> DataFrame:
    table = spark.table(f"`{database}`.`{name}`")
    # a catalog table has the columns of its folders at the end
    return table.select(*RAW_COLUMNS) if name == LANDED else lines.line_fact(table) if name == LINES else table


@dataclass
class PipelineReport:
    rows_landed: int
    #: what the load found; None where the landing was up to date or came from a DataFrame
    load: LoadReport | None = None
    failed_checks: dict[str, int] = field(default_factory=dict)
    freshness: str = ""
    export: ExportReport | None = None


class ChecksFailed(Exception):
    """At least one constraint check found failing rows."""


def run_pipeline(
    warehouse: Warehouse,
    export_dir: str,
    as_of: dt.datetime,
    fail_on_checks: bool = True,
    database: str | None = None,
) -> PipelineReport:
    """Land, build, check, publish to ``database`` and export; failing checks stop the run before the last two.

    What was published before stays as it was then.
    """
    warehouse.build()
    landed = warehouse.loaded
    report = PipelineReport(landed.landed if landed else warehouse.read(LANDED).count(), landed)
    checks = quality.all_checks(warehouse.read, as_of.date())
    # one row per check: sixty at most
    report.failed_checks = {
        row.check_id: row.failures for row in checks.filter("failures > 0").collect()
    }
    aged = quality.freshness(warehouse.read(LANDED), as_of)
    report.freshness = aged.first().status
    if fail_on_checks and report.failed_checks:
        raise ChecksFailed(report.failed_checks)
    if database:
        warehouse.publish(database)
    report.export = export_marts({m: warehouse.read(m) for m in EXPORTED}, export_dir)
    return report
