"""Row numbers and n-tiles over a whole table without a single-partition window.

A window without PARTITION BY moves the table into one task. Row numbers are taken
from rows sorted by range instead, which stays distributed; a hot value is split by
the rest of the sort key. Each row takes its position within its range, the ranges
take an offset from a table with one row per range. The sorted rows are written to
the shared folder once, so a lost executor cannot re-draw the range bounds between
the two reads.

N-tiles only need the few rows that open a bucket. These are found by counting: a
pass counts the rows in equal cells between the smallest and the largest value, the
cells that hold a wanted place are split again by the next pass. A value that many rows share
is split by the key. Nothing is sorted or stored, and a pass moves one row per cell and task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.session import scratch_path
from tallyhouse.sources.tables import store

# monotonically_increasing_id(): partition above bit 33, row in the partition below
ROW_BITS = 33

#: cells into which a pass splits an interval, and rows of an interval that are no longer split
CELLS = 4096
FEW = 10_000
#: bytes of a text key that are compared as one number
PIECE = 6


def with_row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number all rows from 1 by ``order``, which must be a total order."""
    placed = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    kept = store(placed, scratch_path(df.sparkSession, "ranked"))

    range_id = F.shiftrightunsigned("_place", ROW_BITS)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        kept.groupBy(range_id.alias("_range"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("_range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_offset"))
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # one row per range of the sort, so its size is a setting and not the data's
    return (
        kept.withColumn("_range", range_id)
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_offset") + position + 1)
        .select(*df.columns, name)
    )


@dataclass(frozen=True)
class Ntile:
    """Equal-sized buckets of a numeric column; NULL sorts last."""

    column: str
    buckets: int
    descending: bool = False

    def sort_value(self) -> Column:
        value = F.col(self.column).cast("double")
        # zero has one sign, and NaN sorts after every number
        signed = (-value if self.descending else value) + F.lit(0.0)
        return F.coalesce(signed, F.lit(float("nan")))


@dataclass(frozen=True)
class Interval:
    """Rows of one ordering, from ``low`` to ``high``, that hold the rows at ``places``.

    A place is a bucket and the number of rows of the interval before the one that opens it. Once all
    rows have one value, ``bounds`` is what the next piece of their keys lies between,
    after the pieces in ``fixed``. ``same``: the keys are equal too.
    """

    tile: int
    low: float
    high: float
    rows: int
    places: tuple[tuple[int, int], ...]
    bounds: tuple[int, int] | None = None
    fixed: tuple[int, ...] = ()
    same: bool = False


@dataclass(frozen=True)
class Key:
    """A key column as numbers in the order of the key: one for integers and times, one per piece of a text."""

    column: str
    kind: T.DataType

    def __post_init__(self) -> None:
        if not isinstance(self.kind, (T.StringType, T.IntegralType, T.DateType, T.TimestampType)):
            raise TypeError(f"{self.column}: a key is a text, an integer, a date or a time")

    @property
    def text(self) -> bool:
        return isinstance(self.kind, T.StringType)

    def piece(self, number: int) -> Column:
        """The bytes of a piece, then how many there are; NULL comes first."""
        if isinstance(self.kind, T.DateType):
            return F.coalesce(F.unix_date(self.column).cast("bigint"), F.lit(-(2**63)))
        if isinstance(self.kind, T.TimestampType):
            return F.coalesce(F.unix_micros(self.column), F.lit(-(2**63)))
        if not self.text:
            return F.coalesce(F.col(self.column).cast("bigint"), F.lit(-(2**63)))
        own = F.substring(F.encode(F.col(self.column), "UTF-8"), number * PIECE + 1, PIECE)
        digits = F.conv(F.rpad(F.hex(own), 2 * PIECE, "0"), 16, 10).cast("bigint")
        return F.coalesce(digits * 8 + F.length(own), F.lit(-1).cast("bigint"))

    def ends(self, piece: int) -> bool:
        """Whether keys that agree up to this piece are equal."""
        return not self.text or piece == -1 or piece % 8 < PIECE


def _settled(interval: Interval, key: Key, first: tuple[int, int]) -> Interval:
    """The interval with what follows from equal bounds: the next column or piece decides."""
    one_value = interval.low == interval.high or math.isnan(interval.low)
    if one_value and interval.bounds is None:
        interval = replace(interval, bounds=first)
    while interval.bounds and interval.bounds[0] == interval.bounds[1] and not interval.same:
        piece = interval.bounds[0]
        if key.ends(piece):
            interval = replace(interval, same=True)
        else:
            span = (0, (1 << (8 * PIECE + 3)) - 1)
            interval = replace(interval, fixed=(*interval.fixed, piece), bounds=span)
    return interval


def _within(interval: Interval, value: Column, key: Key) -> Column:
    if interval.bounds is None:
        return (value >= interval.low) & (value <= interval.high)
    inside = value == interval.low
    for number, piece in enumerate(interval.fixed):
        inside = inside & (key.piece(number) == piece)
    return inside & key.piece(len(interval.fixed)).between(*interval.bounds)


def _cell(interval: Interval, value: Column, key: Key) -> Column:
    """The cell of a row, which never falls as the row rises; the ends of an interval differ."""
    if interval.bounds is not None:
        low, high = interval.bounds
        shift = 0
        while (high >> shift) - (low >> shift) >= CELLS:
            shift += 1
        return F.shiftright(key.piece(len(interval.fixed)), shift) - F.lit(low >> shift)
    low, high = interval.low, interval.high
    small, large = sorted((abs(low), abs(high)))
    # wide intervals are split by magnitude, so one huge value does not make a cell of all others
    if low < 0 < high or small == 0:
        curved = large > 64
        bent, scale = F.signum(value) * F.log1p(F.abs(value)), lambda x: math.copysign(math.log1p(abs(x)), x)
    else:
        curved = large / 64 > small
        sign = 1.0 if low > 0 else -1.0
        bent, scale = F.ln(F.abs(value)) * sign, lambda x: math.log(abs(x)) * sign
    if curved:
        value, low, high = bent, scale(low), scale(high)
    share = (value - F.lit(low)) / F.lit(high - low)
    return F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), F.floor(share * CELLS))).cast("bigint")


def _members(df: DataFrame, specs: list[Ntile], intervals: list[Interval], key: Key, columns) -> DataFrame:
    """``interval`` (its number) and the columns of each row in each interval that it is in."""
    of_tile = []
    for i, spec in enumerate(specs):
        value, found = spec.sort_value(), None
        for number, interval in enumerate(intervals):
            if interval.tile != i:
                continue
            row = F.struct(F.lit(number).alias("interval"), *columns(interval, value))
            found = (F if found is None else found).when(_within(interval, value, key), row)
        if found is not None:
            of_tile.append(found)
    return df.select(F.inline(F.array(*of_tile))).filter(F.col("interval").isNotNull())


def _split(df: DataFrame, specs: list[Ntile], intervals: list[Interval], key: Key, first) -> list[Interval]:
    """One pass: the cells of the intervals that hold a place."""

    def columns(interval: Interval, value: Column) -> list[Column]:
        by_key = interval.bounds is not None
        piece = key.piece(len(interval.fixed)) if by_key else F.lit(None).cast("bigint")
        return [_cell(interval, value, key).alias("cell"), value.alias("value"), piece.alias("piece")]

    counted = (
        _members(df, specs, intervals, key, columns)
        .groupBy("interval", "cell")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.min("piece").alias("least"),
            F.max("piece").alias("most"),
        )
    )
    before = [0] * len(intervals)
    cells = []
    # at most CELLS rows for each place that is asked for
    for cell in sorted(counted.collect(), key=lambda c: (c["interval"], c["cell"])):
        interval, start = intervals[cell["interval"]], before[cell["interval"]]
        before[cell["interval"]] += cell["n"]
        places = tuple((b, at - start) for b, at in interval.places if start <= at < start + cell["n"])
        if places:
            bounds = None if interval.bounds is None else (cell["least"], cell["most"])
            part = replace(
                interval, low=cell["low"], high=cell["high"], rows=cell["n"], places=places, bounds=bounds
            )
            cells.append(_settled(part, key, first))
    return cells


def _start(df: DataFrame, specs: list[Ntile], key: Key) -> tuple[list[Interval], tuple[int, int]]:
    """One interval per ordering and kind of number, and what the first piece of all keys lies between."""
    infinite = float("inf")
    sums = [F.count(F.lit(1)).alias("rows"), F.min(key.piece(0)).alias("least"), F.max(key.piece(0)).alias("most")]
    for i, spec in enumerate(specs):
        value = spec.sort_value()
        finite = F.when((value > -infinite) & (value < infinite), value)
        sums += [
            F.count_if(value == -infinite).alias(f"_under_{i}"),
            F.count(finite).alias(f"_finite_{i}"),
            F.count_if(value == infinite).alias(f"_over_{i}"),
            F.min(finite).alias(f"_low_{i}"),
            F.max(finite).alias(f"_high_{i}"),
        ]
    found = df.agg(*sums).first()
    rows, first = found["rows"], (found["least"], found["most"])
    intervals = []
    for i, spec in enumerate(specs):
        # the first buckets are one row larger when the rows do not divide evenly
        size, larger = divmod(rows, spec.buckets)
        opens = [(b, b * size + min(b, larger)) for b in range(1, spec.buckets) if b < rows]
        kinds = [
            (-infinite, -infinite, found[f"_under_{i}"]),
            (found[f"_low_{i}"], found[f"_high_{i}"], found[f"_finite_{i}"]),
            (infinite, infinite, found[f"_over_{i}"]),
        ]
        kinds.append((math.nan, math.nan, rows - sum(n for _, _, n in kinds)))
        start = 0
        for low, high, n in kinds:
            places = tuple((b, at - start) for b, at in opens if start <= at < start + n)
            start += n
            if places:
                intervals.append(_settled(Interval(i, low, high, n, places), key, first))
    return intervals, first


def opening_rows(df: DataFrame, key: str, specs: list[Ntile]) -> tuple[DataFrame | None, list[tuple[int, int]]]:
    """The rows that open the buckets, as one row of columns ``_edge_<ordering>_<bucket>``, and which there are.

    Counts the rows in narrowing intervals, one pass over ``df`` each, until an interval has
    FEW rows or equal ones. Every pass takes the ends of an interval apart.
    """
    column = Key(key, df.schema[key].dataType)
    todo, first = _start(df, specs, column)
    done = []
    while todo:
        done += [x for x in todo if x.same or x.rows <= FEW]
        todo = [x for x in todo if not (x.same or x.rows <= FEW)]
        if todo:
            todo = _split(df, specs, todo, column, first)
    if not done:
        return None, []

    members = _members(
        df, specs, done, column, lambda interval, value: [value.alias("value"), F.col(key).alias("id")]
    )
    # equal rows are counted, so what an interval collects is FEW rows at most
    rows = members.groupBy("interval", "value", "id").agg(F.least(F.count(F.lit(1)), F.lit(FEW)).alias("n"))
    listed = rows.groupBy("interval").agg(F.sort_array(F.collect_list(F.struct("value", "id", "n"))).alias("rows"))

    def copies(row: Column) -> Column:
        return F.array_repeat(F.struct(row["value"].alias("value"), row["id"].alias("id")), row["n"].cast("int"))

    listed = listed.select("interval", F.flatten(F.transform("rows", copies)).alias("rows"))
    edges, names = [], []
    for number, interval in enumerate(done):
        for bucket, at in interval.places:
            edge = F.when(F.col("interval") == number, F.get("rows", F.lit(0 if interval.same else at)))
            edges.append(F.max(edge).alias(f"_edge_{interval.tile}_{bucket}"))
            names.append((interval.tile, bucket))
    return listed.agg(*edges), names


def with_ntiles(df: DataFrame, key: str, tiles: Mapping[str, Ntile]) -> DataFrame:
    """Add an n-tile column per entry; ties fall in the order of ``key``.

    Only the rows that open a bucket are looked for, buckets - 1 of them per ordering, and
    every row of ``df`` is then compared with these edges: ``df`` itself never moves. ``df`` is read
    once for each counting pass, so it should be a stored table. NULL keys come first among ties;
    rows that agree in value and key get the same bucket, the last that one of them opens.
    """
    specs = list(tiles.values())
    edge_row, edges = opening_rows(df, key, specs)

    def tile(i: int, spec: Ntile) -> Column:
        mine = F.struct(spec.sort_value().alias("value"), F.col(key).alias("id"))
        result = F.lit(1)
        for bucket in range(1, spec.buckets):
            if (i, bucket) in edges:
                reached = mine >= F.col(f"_edge_{i}_{bucket}")
                result = result + F.when(reached, 1).otherwise(0)
        return result.cast("bigint")

    columns = [tile(i, spec).alias(name) for i, (name, spec) in enumerate(tiles.items())]
    # one row of fixed width
    wide = df.crossJoin(F.broadcast(edge_row)) if edges else df
    return wide.select(*df.columns, *columns)
