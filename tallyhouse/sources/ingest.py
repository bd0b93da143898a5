"""Landing of raw invoice lines: multi-part read, header and type clean-up, dedupe.

Operators L1 to L7 of the inventory.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import strip_whitespace
from tallyhouse.schemas import RAW_COLUMNS, RAW_SCHEMA
from tallyhouse.session import FREE_SHUFFLES, OPEN_FILES, settings

# fixed values: source headers, stripped and lower-cased, and the names they stand for
HEADER_NAMES = {
    "invoice": "invoice",
    "invoiceno": "invoice",
    "stockcode": "stock_code",
    "description": "description",
    "quantity": "quantity",
    "invoicedate": "invoice_date",
    "price": "price",
    "unitprice": "price",
    "customer id": "customer_id",
    "customerid": "customer_id",
    "country": "country",
}

SAMPLE_TAG = "sample"

# fixed values: the columns that make two lines exact copies of each other
COPY_KEY = ["invoice", "stock_code", "quantity", "price", "invoice_date", "customer_id"]


def normalize_columns(df: DataFrame) -> DataFrame:
    """L2: rename headers; a metadata change without a job."""
    headers = [name.strip().lower() for name in df.columns]
    return df.toDF(*[HEADER_NAMES.get(header, header) for header in headers])


def read_part(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One part under its own header: a Parquet file or folder by its name, else CSV as text.

    Quoted values may hold line breaks. That keeps a CSV file in one split; a part is
    read in parallel by its files. ``multi_line=False`` splits the files of a part that
    is known to have no such value.
    """
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    return reader.option("escape", '"').csv(path)


def union_parts(parts: Mapping[str, DataFrame]) -> DataFrame:
    """L1: tag the lines of every part with its name and put the parts together by column."""
    tagged = [
        normalize_columns(part).withColumn("_source_sheet", F.lit(tag))
        for tag, part in parts.items()
    ]
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), tagged
    )


def read_raw(spark: SparkSession, paths: Mapping[str, str], multi_line: bool = True) -> DataFrame:
    """L1 over files: ``paths`` maps a part name to its file or folder."""
    return union_parts({tag: read_part(spark, path, multi_line) for tag, path in paths.items()})


NUMBERS = ["quantity", "price", "customer_id"]


def _parsed_number(df: DataFrame, name: str) -> Column:
    """A typed number as it is; the double in a text, NULL if there is none."""
    column = F.col(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        return column
    # Java reads a trailing d or f as part of a number (a search for a pattern in every value took
    # longer than the cast)
    last = F.rtrim(column, F.lit(" \t\n\x0b\f\r")).substr(-1, 1)
    return F.when(~last.isin("d", "D", "f", "F"), column.try_cast("double"))


def _whole_number(df: DataFrame, name: str) -> Column:
    """Bigint out of a parsed number; a fraction or NaN becomes NULL."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return column.cast("bigint")
    return F.when(column == F.rint(column), column.try_cast("bigint"))


def _timestamp(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if not isinstance(df.schema[name].dataType, T.StringType):
        return column.cast("timestamp_ntz")
    # a wall-clock time: no zone is passed through, so none of its gaps moves it. A month or
    # day out of range stays as it is, which no cast reads
    month, day = r"(0?[1-9]|1[0-2])", r"(0?[1-9]|[12]\d|3[01])"
    month_first = rf"^\s*{month}/{day}/(\d{{4}}) (\d{{1,2}}):(\d{{2}})(:\d{{2}})?\s*$(?s:.*)"
    iso = F.regexp_replace(column, month_first, "$3-$1-$2 $4:$5$6")
    return F.when(column.contains("/"), iso).otherwise(column).try_cast("timestamp_ntz")


def coerce_types(df: DataFrame) -> DataFrame:
    """L3: strip text, turn numbers and timestamps into their types, bad values into NULL.

    A price that is no finite number is a bad value.

    A customer id such as ``17850.0`` becomes ``17850``; a fractional one has no
    meaning as an id and becomes NULL.
    """
    stripped = ["invoice", "stock_code", "description", "country"]
    # numbers are parsed in a projection of their own, once per value
    parsed = df.withColumns({name: _parsed_number(df, name) for name in NUMBERS})
    return parsed.withColumns(
        {
            **{name: strip_whitespace(F.col(name).cast("string")) for name in stripped},
            "quantity": _whole_number(parsed, "quantity"),
            # comparisons put NaN above infinity
            "price": F.when(
                F.abs(F.col("price").cast("double")) < float("inf"), F.col("price").cast("double")
            ),
            "invoice_date": _timestamp(df, "invoice_date"),
            "customer_id": _whole_number(parsed, "customer_id").cast("string"),
        }
    )


def dedupe(df: DataFrame) -> DataFrame:
    """L4: keep one of several exact copies; NULLs in the key count as equal.

    The survivor is the smallest by the remaining columns, so the result does not
    depend on the order of rows. ``min`` combines copies before the shuffle: a group
    of copies of any size reaches its reducer as one row per map task. Lines that
    ``deal_by_time`` dealt are not shuffled again.
    """
    key = COPY_KEY
    others = [name for name in df.columns if name not in (*key, LANDED_MONTH)]
    first = [name for name in ("_source_sheet", "description", "country") if name in others]
    order = first + [name for name in others if name not in first]
    if LANDED_MONTH in df.columns:
        # sorted once, in the order they are written in; a grouping would sort them before and after it combines copies
        copies = Window.partitionBy(*LANDED_ORDER, "price").orderBy(*order)
        kept = df.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") == 1).drop("_copy")
        # as in a grouping, a zero loses its sign
        return kept.withColumn("price", F.col("price") + F.lit(0.0))
    survivor = F.min(F.struct(*order)).alias("survivor")
    kept = df.groupBy(*key).agg(survivor)
    return kept.select(
        *[
            F.col(name) if name in key else F.col(f"survivor.{name}").alias(name)
            for name in df.columns
        ]
    )


def stamp_lineage(df: DataFrame, loaded_at: dt.datetime, *more: str) -> DataFrame:
    """L5 without the write: default part tag, one load time, the fixed ten columns and ``more``."""
    if "_source_sheet" not in df.columns:
        df = df.withColumn("_source_sheet", F.lit(SAMPLE_TAG))
    stamp = F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz")
    return df.withColumn("_loaded_at", stamp).select(*RAW_COLUMNS, *more)


LANDED_MONTH = "_landed_month"
# the order of the landing, which is also that of its months; a price takes no part, as copies can differ in the sign of a zero
LANDED_ORDER = ["invoice_date", "invoice", *(c for c in COPY_KEY if c not in ("invoice_date", "invoice", "price"))]


def deal_by_time(df: DataFrame) -> DataFrame:
    """The lines with their month, dealt to tasks by ranges of the landing's order.

    Copies of a line are in the same task and the lines of a month in few, so this one
    shuffle serves the dedupe and the folders of the landing. A large month or invoice is split;
    copies of one line are not. The child is run once more, for a sample of its rows: what is
    observed belongs behind this step.
    """
    month = F.date_trunc("month", F.col("invoice_date").cast("timestamp_ntz")).cast("date")
    # the month need not be shuffled
    return df.repartitionByRange(*LANDED_ORDER).withColumn(LANDED_MONTH, month)


def write_raw(df: DataFrame, path: str, loaded_at: dt.datetime) -> int:
    """Replace the landing table; returns its row count, taken in the same job.

    The lines of a month lie together, in the order of their time, so that readers of new
    days open the folders of their months only, and those of an invoice stand side by side.
    Lines without a date have a folder of their own; a large month is split. Lines that
    ``deal_by_time`` dealt stay where they are.
    """
    loaded = Observation()
    if LANDED_MONTH not in df.columns:
        df = deal_by_time(df)
    stamped = stamp_lineage(df, loaded_at, LANDED_MONTH)
    rows = stamped.observe(loaded, F.count(F.lit(1)).alias("rows"))
    # an overwrite of the landing table replaces all of it, whatever the session says
    with settings(df.sparkSession, {**FREE_SHUFFLES, **OPEN_FILES}):
        (
            rows.sortWithinPartitions(*LANDED_ORDER[:2])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", "zstd")
            .partitionBy(LANDED_MONTH)
            .parquet(path)
        )
    return loaded.get["rows"]


def read_landed(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """The landed lines; with ``since`` those of its month and later ones only.

    The months before it are folders that are not opened. (Times without a zone are not
    compared with the statistics of row groups, so the folders do what a filter on the
    time cannot.)
    """
    table = spark.read.schema(f"{RAW_SCHEMA}, {LANDED_MONTH} date").parquet(path)
    if since is not None:
        table = table.filter(F.col(LANDED_MONTH) >= F.lit(since.replace(day=1)))
    return table.select(*RAW_COLUMNS)


@dataclass(frozen=True)
class LoadReport:
    """What a load found and did: lines per part, copies dropped, values turned into NULL."""

    lines: dict[str, int]
    rejected: dict[str, int]
    landed: int

    @property
    def dropped(self) -> int:
        return sum(self.lines.values()) - self.landed


def land(raw: DataFrame, tags: list[str], path: str, loaded_at: dt.datetime) -> LoadReport:
    """L3 to L5 over tagged lines; the counts are observed on the way, in the job that writes."""
    seen = Observation()
    dealt = deal_by_time(_with_rejections(raw))
    counted = dealt.observe(
        seen,
        *[F.count_if(F.col("_source_sheet") == tag).alias(f"part {i}") for i, tag in enumerate(tags)],
        *[F.count_if(F.col(f"rejected_{name}")).alias(name) for name in CHECKED],
    )
    typed = counted.drop(*[f"rejected_{name}" for name in CHECKED])
    landed = write_raw(dedupe(typed), path, loaded_at)
    got = seen.get
    return LoadReport(
        {tag: got[f"part {i}"] for i, tag in enumerate(tags)}, {name: got[name] for name in CHECKED}, landed
    )


def load(
    spark: SparkSession,
    paths: Mapping[str, str],
    path: str,
    loaded_at: dt.datetime,
    multi_line: bool = True,
) -> LoadReport:
    """L1 to L5 in one job."""
    return land(read_raw(spark, paths, multi_line), list(paths), path, loaded_at)


def load_sample(spark: SparkSession, csv_path: str, path: str, loaded_at: dt.datetime) -> int:
    """A CSV that already has the final headers; copies stay in."""
    return write_raw(coerce_types(read_part(spark, csv_path)), path, loaded_at)


CHECKED = ["quantity", "price", "invoice_date", "customer_id"]


def _with_rejections(before: DataFrame) -> DataFrame:
    """L3, with a flag for each checked column whose value it turned into NULL."""
    given = {f"rejected_{name}": F.col(name).isNotNull() for name in CHECKED}
    after = coerce_types(before.withColumns(given))
    lost = {f"rejected_{name}": F.col(f"rejected_{name}") & F.col(name).isNull() for name in CHECKED}
    return after.withColumns(lost)


def rejected_values(before: DataFrame) -> DataFrame:
    """Report for a load: values per column that L3 turns into NULL, in one pass."""
    after = _with_rejections(before)
    return after.agg(*[F.count_if(F.col(f"rejected_{name}")).alias(name) for name in CHECKED])
