"""Line dedup in DataFrame functions only: lines that several documents share stay in one of them.

Lines are exploded with their position, brought to a key (white space at both ends off, A-Z in
lower case) and hashed to 128 bits; the documents of each hash are counted. Lines of a hash that
at least ``min_docs`` documents hold go from all documents but the one with the smallest id, and a
document is put together again from the positions that are left.

* Whole texts stay where they are: what moves is hashes, positions and, for documents that lose a
  line, the list of lost positions, which is never longer than the document.
* The count takes two steps (hash and document, then hash), so a line that a third of all
  documents hold is spread over many tasks. Lines meet the counts in a join on the hash; the
  few hashes that hold more than a thousandth of all lines each (a thousand at most) are
  broadcast instead, so no task receives a hot line.
* The exploded lines and the counts are stored in the shared folder, so that a lost executor costs
  a part of one step.

A null or empty text is one empty line. Rows of one id are one document, told apart by their
text when they are put together; equal rows get equal results. A row without an id is a document
that comes after all others, and all such rows are one. Very long texts are a row like any
other. An empty table gives no rows. Columns of the input called like an added one are replaced,
other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .frames import without

MIN_CHARS = 10
MIN_DOCS = 2
#: a line is broadcast when it makes up more than one of so many lines
HOT_SHARE = 1000

FIELDS = ["n_lines", "n_dropped", "kept_text"]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: the characters of [\x20\x09-\x0D]
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return F.btrim(F.translate(line, UPPER, UPPER.lower()), F.lit(BLANKS))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _row_mark(text: Column) -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``_id``, ``_row``, ``_at`` and the 128-bit hash ``_a``, ``_b`` of each line with a long enough key."""
    plain = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    each = plain.select("_id", _row_mark(F.col("_text")).alias("_row"), F.posexplode(_lines(F.col("_text"))).alias("_at", "_line"))
    keyed = each.select("_id", "_row", "_at", line_key(F.col("_line")).alias("_key")).where(F.length("_key") >= min_chars)
    return keyed.select("_id", "_row", "_at", F.xxhash64("_key").alias("_a"), F.xxhash64(F.lit("second"), "_key").alias("_b"))


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Hashes that enough documents hold: the document that keeps its lines, and how many lines there are."""
    documents = lines.groupBy("_a", "_b", "_id").agg(F.count(F.lit(1)).alias("_n"))
    counted = documents.groupBy("_a", "_b").agg(
        F.count(F.lit(1)).alias("_docs"), F.min("_id").alias("_first"), F.sum("_n").alias("_n")
    )
    return counted.where(F.col("_docs") >= min_docs).drop("_docs")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def dropped_positions(lines: DataFrame, min_docs: int, hot_share: int) -> DataFrame:
    """``_id``, ``_row`` and the positions of the lines that go, for rows that lose a line."""
    shared = _stored(shared_lines(lines, min_docs), "shared-lines")
    bound = max(lines.count() // hot_share, 1)
    hot, others = (shared.where(c).select("_a", "_b", "_first") for c in (F.col("_n") > bound, F.col("_n") <= bound))
    kept_here = F.col("_id").eqNullSafe(F.col("_first"))
    # at most hot_share hashes are hot, however many lines there are
    marked = lines.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), ["_a", "_b"], "left")
    gone = marked.where(F.col("_hot") & ~kept_here).select("_id", "_row", "_at")
    cold = marked.where(F.col("_hot").isNull()).drop("_first", "_hot").join(others, ["_a", "_b"])
    gone = gone.unionByName(cold.where(~kept_here).select("_id", "_row", "_at"))
    return gone.groupBy("_id", "_row").agg(F.collect_set("_at").alias("_gone"))


def drop_shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """The documents with ``n_lines`` (before dropping), ``n_dropped`` and ``kept_text``."""
    lines = _stored(hashed_lines(docs, id_col, text_col, min_chars), "lines")
    gone = dropped_positions(lines, min_docs, hot_share)
    plain = without(docs, FIELDS) if text_col.lower() not in FIELDS and id_col.lower() not in FIELDS else docs
    columns = plain.columns
    aside = plain.select(*(plain[c].alias(f"_column{i}") for i, c in enumerate(columns)))
    place = {c: f"_column{i}" for i, c in enumerate(columns)}
    text = F.coalesce(F.col(place[text_col]), F.lit(""))
    same = F.col(place[id_col]).eqNullSafe(F.col("_id")) & (_row_mark(F.col(place[text_col])) == F.col("_row"))
    found = aside.join(gone, same, "left")
    split = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("_gone"))
    kept = F.array_join(F.transform(left, lambda at: F.get(split, at)), "\n")
    return found.select(
        *(F.col(place[c]).alias(c) for c in columns),
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_gone").isNull(), text).otherwise(kept).alias("kept_text"),
    )
