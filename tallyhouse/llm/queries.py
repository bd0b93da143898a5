"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    decontaminate,
    licenses,
    linededup,
    merkle,
    neardup,
    pieces,
    quality,
    repeats,
    rules,
    tokenfile,
    toxicity,
    trie,
    webpages,
)
from .frames import table
from .labelled import held_out, labelled_sample


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        spec = file.read()
    path = scratch_path(spark, "tokens")
    tokenfile.write(table(spark, sf_dir, "documents"), path, spec, end_id=1)
    return tokenfile.read(spark, path).select(
        F.col("id").alias("doc_id"),
        "start",
        (F.length("tokens") / 4).cast("long").alias("n_tokens"),
        F.crc32("tokens").alias("ids_crc32"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn(labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic"))
    return toxicity.score(docs, lexicon).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select("doc_id", *licenses.FIELDS)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(labelled_sample(docs, table(spark, sf_dir, "labels"), "quality"), docs)
    return quality.score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = rules.learn(labelled_sample(docs, table(spark, sf_dir, "labels"), "quality"))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rules.judge(docs, forest).select("doc_id", *columns)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return webpages.extract_pages(pages).select("page_id", "url", "text", "n_chars")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = pieces.Vocabulary.of(piece_model())
    # the digest of a text is carried instead of the text beside its ids
    docs = docs.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    encoded = pieces.encode(docs, vocabulary).select("doc_id", "digest", "ids")
    decoded = pieces.decode(encoded, vocabulary)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        (F.sha2("text", 256) == F.col("digest")).alias("round_trip"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.numbered(table(spark, sf_dir, "conversations"))
    return trie.prefix_trie(trie.with_shared_heads(turns))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.drop_shared_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_files": op3_token_files,
    "op4_toxicity": op4_toxicity,
    "op5_license_scan": op5_license_scan,
    "op6_quality": op6_quality,
    "op7_minhash_neardup": op7_minhash_neardup,
    "op8_quality_rules": op8_quality_rules,
    "op9_html_extraction": op9_html_extraction,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_line_dedup": op12_line_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}
