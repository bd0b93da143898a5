"""Stored tables and CSV export (operators L11 and L12)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def store(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write to a path of its own and read the table back with its known schema."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A table that :func:`store` wrote, perhaps in another session."""
    return spark.read.parquet(path)


def publish_table(df: DataFrame, table: str, path: str, partitions: Mapping[str, str]) -> None:
    """Point a catalog table at the folder a table is stored in.

    The folder's files are listed when the table is read, partitions included, so only the
    location is switched; a table whose columns changed is declared anew.
    """
    spark = df.sparkSession
    plain = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in partitions]
    split = [f"`{name}` {kind}" for name, kind in partitions.items()]
    columns = ", ".join([*plain, *split])
    if spark.catalog.tableExists(table):
        known = [f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(table).schema]
        if known == [*plain, *split]:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        # the table is external: its files stay
        spark.sql(f"DROP TABLE {table}")
    by = f" PARTITIONED BY ({', '.join(f'`{name}`' for name in partitions)})" if partitions else ""
    listed = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(listed)
    spark.conf.set(listed, "false")
    try:
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet{by} LOCATION '{path}'")
    finally:
        spark.conf.set(listed, before)


@dataclass
class ExportReport:
    """Row count per exported mart, and the reason for each one left out."""

    written: dict[str, int] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)


# marts whose grain bounds their size (a day, a month, a pair of months, one row):
# these become one ordered file each
SMALL_MARTS = {
    "mart_revenue_daily": ["order_date"],
    "mart_revenue_monthly": ["month"],
    "mart_customer_cohorts": ["cohort_month", "months_since_cohort"],
    "mart_data_quality": [],
}


def export_marts(marts: Mapping[str, DataFrame], out_dir: str) -> ExportReport:
    """One CSV folder per mart with a header; a mart that fails is reported and skipped."""
    report = ExportReport()
    for name, mart in marts.items():
        if name in SMALL_MARTS:
            mart = mart.repartition(1)
            if SMALL_MARTS[name]:
                mart = mart.sortWithinPartitions(*SMALL_MARTS[name])
        written = Observation()
        rows = mart.observe(written, F.count(F.lit(1)).alias("rows"))
        try:
            _csv_writer(rows, f"{out_dir}/{name}")
        except PySparkException as error:
            report.skipped[name] = str(error)
        else:
            report.written[name] = written.get["rows"]
    return report


def _csv_writer(df: DataFrame, path: str) -> None:
    # keep blanks inside values, double a quote instead of escaping it
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> str:
    _csv_writer(df, path)
    return path


def read_export(like: DataFrame, path: str) -> DataFrame:
    """An exported mart read back under the schema of the mart it came from."""
    reader = like.sparkSession.read.schema(like.schema).option("header", True)
    # a value may hold line breaks
    reader = reader.option("multiLine", True)
    return reader.option("escape", '"').csv(path)
