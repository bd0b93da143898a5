"""A bounded sample of labelled documents for the operators that learn from labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Most labelled rows that a model is fitted on. Labels beyond it are not needed for a fit.
SAMPLE_ROWS = 20_000


def held_out(id_col: str) -> F.col:
    """Rows that are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``text`` and ``label`` of at most ``rows`` documents that are not held out, stored.

    The rows with the smallest hash of the id are taken. Of an id with several labels the
    largest counts; null labels and null ids do not. The labels taken are few enough to be
    broadcast, so the documents are not shuffled.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(id_col).agg(F.max(label).cast("int").alias("label"))
    taken = known.orderBy(F.xxhash64(id_col), id_col).limit(rows)
    found = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    path = scratch_path(spark, "labelled")
    found.join(F.broadcast(taken), id_col).select("text", "label").write.parquet(path)
    return spark.read.parquet(path)
