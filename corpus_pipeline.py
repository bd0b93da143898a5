"""Training-data pipeline over documents: each stage is stored and reread by the next.

Toxic documents go; of near duplicates the one with the smallest id stays; words of passages
that repeat across documents go from their texts; contaminated documents go; the rest is
encoded. A stage carries all columns of documents, whatever they are called.

A null text is an empty one, is never toxic, linked or contaminated, and gets no ids. A text
of which nothing is left stays as an empty text. Of rows that agree in id and text one
stays. Empty tables pass every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontaminate, neardup, pieces, repeats, toxicity
from tallyhouse.llm.frames import table
from tallyhouse.llm.labelled import labelled_sample
from tallyhouse.llm.queries import piece_model
from tallyhouse.session import scratch_path

#: the learned first stage has no SQL
ORACLE_SQL = None


def _set_aside(docs: DataFrame) -> tuple[DataFrame, list]:
    """The documents with other columns than id and text under names that clash with nothing."""
    plain = [F.col("doc_id"), F.col("text")]
    others = [docs[c].alias(f"_column{i}") for i, c in enumerate(docs.columns)]
    back = [F.col(c if c in ("doc_id", "text") else f"_column{i}").alias(c) for i, c in enumerate(docs.columns)]
    hidden = [o for o, c in zip(others, docs.columns) if c not in ("doc_id", "text")]
    return docs.select(*plain, *hidden), back


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    aside, back = _set_aside(docs)
    lexicon = toxicity.learn(labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic"))
    scored = toxicity.score(aside, lexicon)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select(*back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    aside, back = _set_aside(docs)
    found = neardup.near_duplicates(docs).where("kept").select(F.col("id").alias("_id"), F.col("row").alias("_row"))
    aside = aside.withColumn("_row", F.xxhash64("text"))
    same = (aside["_row"] == found["_row"]) & aside["doc_id"].eqNullSafe(found["_id"])
    return aside.join(found.distinct(), same, "left_semi").dropDuplicates(["_row", "doc_id"]).select(*back)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    aside, back = _set_aside(docs)
    found = repeats.remove_repeats(aside)
    changed = F.col("n_removed") > 0
    found = found.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        name = f"_column{docs.columns.index('n_chars')}"
        found = found.withColumn(name, F.when(changed, F.length("text").cast(kind)).otherwise(F.col(name)))
    return found.select(*back)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    aside, back = _set_aside(docs)
    found = decontaminate.find_items(aside, table(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.contaminated()).select(*back)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_ids`` and ``ids`` of every document."""
    found = pieces.encode(docs.select("doc_id", "text"), pieces.Vocabulary.of(piece_model()))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


pipeline = run
