"""Running totals within keys of any size.

A window over a key puts all its rows into one task. Here rows are sorted by range on the key and
the order, so a key with a third of all rows lies in many ranges; each range adds up its own rows
while they stream through, the sums are stored, and a range that goes on with the key of the range
before it adds what came before: one row per range, worked out on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .frames import map_arrow


def _same_as_before(batch: pa.RecordBatch, keys: list[str], last: tuple | None) -> np.ndarray:
    """Whether each row has the key of the row before it."""
    same = np.ones(batch.num_rows, bool)
    for name in keys:
        codes = batch.column(name).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        same[1:] &= codes[1:] == codes[:-1]
    same[0] = last is not None and last == tuple(batch.column(name)[0].as_py() for name in keys)
    return same


def _within(values: np.ndarray, starts: np.ndarray, combine: np.ufunc) -> np.ndarray:
    """Totals up to and with each row, begun anew at ``starts``."""
    totals = combine.accumulate(values)
    if combine is np.add:
        base = np.where(starts > 0, totals[starts - 1], 0)
        return totals - np.repeat(base, np.diff(np.append(starts, len(values))))
    base = np.where(starts > 0, totals[starts - 1], 0)
    return totals ^ np.repeat(base, np.diff(np.append(starts, len(values))))


def with_running(
    df: DataFrame, keys: list[str], order: list[str], totals: dict[str, str], xor: tuple[str, ...] = ()
) -> DataFrame:
    """Add to each row the total of a bigint column over the rows of its key before it.

    ``totals`` gives the new column of each summed one; those named in ``xor`` are combined
    by exclusive or. ``keys`` and ``order`` together sort the rows; rows equal in both may
    take any order among themselves. Nulls of a key are one key and come first.
    """
    spark = df.sparkSession
    schema = T.StructType(
        [*df.schema.fields, *(T.StructField(n, T.LongType()) for n in totals.values()), T.StructField("_range", T.IntegerType())]
    )
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, carried = None, {name: np.int64(0) for name in totals}
        for batch in batches:
            if not batch.num_rows:
                continue
            same = _same_as_before(batch, keys, last)
            begins = ~same
            begins[0] = True
            starts = np.flatnonzero(begins)
            goes_on = (starts[1] if len(starts) > 1 else batch.num_rows) if same[0] else 0
            out = [batch.column(c) for c in columns]
            for name in totals:
                values = batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
                combine = np.bitwise_xor if name in xor else np.add
                upto = _within(values, starts, combine)
                upto[:goes_on] = combine(upto[:goes_on], carried[name])
                carried[name] = upto[-1]
                # without the row itself
                out.append(pa.array(upto ^ values if name in xor else upto - values))
            last = tuple(batch.column(name)[-1].as_py() for name in keys)
            out.append(pa.array(np.full(batch.num_rows, part, np.int32)))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    by = [*keys, *order]
    path = scratch_path(spark, "running")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # by columns alone: nulls first, as in the streaming pass
    map_arrow(df.repartitionByRange(ranges, *by).sortWithinPartitions(*by), run, schema).write.parquet(path)
    stored = spark.read.parquet(path)

    # what each range ends with: one row per range
    where = F.struct(*(F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("value")) for c in by))
    upto = [
        (F.col(new).bitwiseXOR(F.col(old)) if old in xor else F.col(new) + F.col(old)).alias(new) for old, new in totals.items()
    ]
    key = F.struct(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)))
    ends = (
        stored.select("_range", where.alias("_where"), key.alias("_key"), *upto)
        .groupBy("_range")
        .agg(F.min("_where").alias("_low"), F.max(F.struct("_where", "_key", *totals.values())).alias("_high"))
        .orderBy("_range")
        .collect()
    )
    return _add_carried(spark, stored, ends, keys, totals, xor)


def _add_carried(spark, stored: DataFrame, ends: list, keys: list[str], totals: dict[str, str], xor) -> DataFrame:
    rows, before, sums = [], None, {}
    for end in ends:
        first = tuple(end["_low"][i]["value"] for i in range(len(keys)))
        final = tuple(end["_high"]["_key"])
        if before is not None and first == before:
            rows.append((end["_range"], *first, *(sums[n] for n in totals.values())))
        else:
            sums = dict.fromkeys(totals.values(), 0)
        own = {n: end["_high"][n] for n in totals.values()}
        if final == first:
            sums = {n: (own[n] ^ sums[n]) if old in xor else own[n] + sums[n] for old, n in totals.items()}
        else:
            sums = own
        before = final
    fields = [T.StructField("_part", T.IntegerType())]
    fields += [T.StructField(f"_key{i}", stored.schema[k].dataType) for i, k in enumerate(keys)]
    fields += [T.StructField(f"_carried_{n}", T.LongType()) for n in totals.values()]
    carried = spark.createDataFrame(rows, T.StructType(fields))
    goes_on = stored["_range"] == carried["_part"]
    for i, k in enumerate(keys):
        goes_on &= stored[k].eqNullSafe(carried[f"_key{i}"])
    found = stored.join(F.broadcast(carried), goes_on, "left")
    out = []
    for old, n in totals.items():
        more = F.coalesce(F.col(f"_carried_{n}"), F.lit(0))
        out.append((F.col(n).bitwiseXOR(more) if old in xor else F.col(n) + more).alias(n))
    names = [c for c in stored.columns if c not in totals.values() and c != "_range"]
    return found.select(*names, *out)


def with_place(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Number the rows of each key from 0 in the given order."""
    found = with_running(df.withColumn("_one", F.lit(1).cast("long")), keys, order, {"_one": name})
    return found.drop("_one")
