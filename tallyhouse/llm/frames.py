"""Running Arrow functions over DataFrames, and the tables of a folder."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .text import slices


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, through Spark's own file server."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def give_back() -> None:
    """Hand freed memory back to the system: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with functions of this package."""
    ship(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(task, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """The frame without columns of these names (in any case)."""
    taken = {name.lower() for name in names}
    return df.select([df[c] for c in df.columns if c.lower() not in taken])


def enrich(
    docs: DataFrame,
    fields: str,
    rows: Callable[[pa.RecordBatch], dict[str, object]],
    column: str | None = "text",
    step: int = 1000,
) -> DataFrame:
    """Add columns that ``rows`` computes from each slice of an Arrow batch.

    One narrow pass: no shuffle, and memory follows a slice of about a megabyte of ``column``
    (of ``step`` rows where it is None). A column of the input whose name is among ``fields`` is replaced.
    """
    added = T._parse_datatype_string(fields)
    names = without(docs, added.names).columns
    schema = T.StructType([*(docs.schema[n] for n in names), *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column) if column else _rows(batch, step):
                out = rows(part)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), *(as_array(out[n]) for n in added.names)],
                    names=[*names, *added.names],
                )

    return map_arrow(docs, run, schema)


def _rows(batch: pa.RecordBatch, step: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def as_array(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)
