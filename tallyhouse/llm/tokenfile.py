"""Token ids in files of Huffman-coded blocks, in ascending order of the document id.

One pass encodes all texts, stores their ids and counts them, which fixes the code; a sort by range
of the stored ids writes the files. Between them only the code lengths (one byte an id of the
vocabulary) go through the driver. Files are tables of blocks in the shared store: ids and lengths of
the documents of a block, its bits, and a bit offset for every ``huffman.CHECKPOINT`` ids; the code
lengths lie beside them.

A null text is an empty one and holds the end id alone. Null ids come first; rows with equal ids are
ordered by a hash of their token ids, then by these. Very long texts are blocks of their own. A table
without rows gives files without blocks. Other columns, whatever they are called, are not read.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import map_arrow
from .huffman import Code, code_lengths
from .text import SOLID, Words, slices
from .wordcache import WordCache, ragged

BLOCK_IDS = 1 << 16
#: a control character, an id of its own between words that are encoded together
_MARK = "\x01"
_caches: dict[str, WordCache] = {}


#: words of letters that have one form only: normalising and splitting leave them whole
_PLAIN = re.compile("[A-Za-z\u00df-\u00f6\u00f8-\u00ff]+")


def _plain_tokenizer(spec: str):
    """A tokenizer with the same model and less to do before it, for _PLAIN words, or None.

    It is the same for a tokenizer that composes, lower-cases and keeps runs of letters.
    """
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    def kinds(part: dict | None, inner: str) -> list[str]:
        return [x["type"] for x in (part or {}).get(inner, [])]

    parts = json.loads(spec)
    if kinds(parts["normalizer"], "normalizers") != ["NFC", "Replace", "Lowercase"]:
        return None
    if kinds(parts["pre_tokenizer"], "pretokenizers") != ["Split", "ByteLevel"]:
        return None
    if r"[\p{L}]+" not in parts["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex", ""):
        return None
    tokenizer = Tokenizer.from_str(spec)
    tokenizer.normalizer = normalizers.Lowercase()
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return tokenizer


def _together(tokenizer, mark: int, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words that are encoded many at a time, with marks between them."""
    ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for i in range(0, len(texts), 1000):
        found = np.array(tokenizer.encode(f" {_MARK} ".join(texts[i : i + 1000]), add_special_tokens=False).ids, np.int32)
        ends = np.r_[np.flatnonzero(found == mark), len(found)]
        sizes.append(np.diff(np.r_[-1, ends]) - 1)
        ids.append(found[found != mark])
    return np.concatenate(ids), np.concatenate(sizes)


def word_cache(spec: str) -> WordCache:
    """The worker's cache for a tokenizer that drops white space, given as JSON."""
    name = hashlib.sha256(spec.encode()).hexdigest()
    if name not in _caches:
        from tokenizers import Tokenizer

        tokenizer, plain = Tokenizer.from_str(spec), _plain_tokenizer(spec)
        mark = tokenizer.encode(_MARK, add_special_tokens=False).ids

        def alone(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            found = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
            return np.array([i for f in found for i in f], np.int32), np.array([len(f) for f in found], np.int64)

        def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            texts = [w.decode() for w in words]
            if len(mark) != 1:
                return alone(texts)
            way = [0 if _MARK in t else 1 if plain is None or not _PLAIN.fullmatch(t) else 2 for t in texts]
            ways = (alone, lambda x: _together(tokenizer, mark[0], x), lambda x: _together(plain, mark[0], x))
            way = np.array(way)
            sizes, parts, starts = np.zeros(len(texts), np.int64), [], np.zeros(len(texts), np.int64)
            done = 0
            for k, run in enumerate(ways):
                own = np.flatnonzero(way == k)
                ids, sizes[own] = run([texts[i] for i in own.tolist()])
                starts[own] = done + np.cumsum(sizes[own]) - sizes[own]
                parts.append(ids)
                done += len(ids)
            return np.concatenate(parts)[ragged(starts, sizes)], sizes

        _caches[name] = WordCache(encode, tokenizer.get_vocab_size(with_added_tokens=True))
    return _caches[name]


def encoded(part: pa.RecordBatch, text_col: str, cache: WordCache, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a slice with the end id after each, and their number per text."""
    words = Words(part.column(text_col), SOLID, lower=False)
    ids, sizes = cache(words)
    places = np.r_[0, np.cumsum(sizes)][words.first]
    return np.insert(ids, places[1:], end_id), np.diff(places) + 1


def _id_kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def encode_texts(docs: DataFrame, path: str, spec: str, vocabulary: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Store ``id``, ``tokens`` (the ids of a text, in as few bytes as the vocabulary allows) and ``mark``, a hash of them.

    The only pass over the texts. Each task ends with a row that counts its ids (``tally``), so that the counts
    come out of the same pass.
    """
    kind = np.dtype(_id_kind(vocabulary))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        total, id_arrow = np.zeros(vocabulary, np.int64), None
        for batch in batches:
            id_arrow = batch.schema.field("id").type
            for part in slices(batch, "text"):
                ids, sizes = encoded(part, "text", word_cache(spec), end_id)
                total += np.bincount(ids, minlength=vocabulary)
                ends = np.r_[0, np.cumsum(sizes) * kind.itemsize]
                data = pa.py_buffer(ids.astype(kind).tobytes())
                tokens = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype("<i8").tobytes()), data])
                nothing = pa.nulls(len(sizes), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("id"), tokens.cast(pa.binary()), nothing], ["id", "tokens", "tally"])
        if id_arrow is not None:
            used = np.flatnonzero(total)
            tally = np.stack([used, total[used]]).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_arrow), pa.nulls(1, pa.binary()), pa.array([tally], pa.binary())], ["id", "tokens", "tally"]
            )

    plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    rows = map_arrow(plain, run, f"id {id_type}, tokens binary, tally binary")
    rows = rows.withColumn("mark", F.xxhash64("tokens"))
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def count_ids(stored: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs, from one tally for each task that encoded texts."""

    def run(batches):
        for batch in batches:
            for tally in batch.column("tally").to_pylist():
                used, n = np.frombuffer(tally, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n)], ["id", "n"])

    counted = map_arrow(stored.select("tally").where("tally is not null"), run, "id bigint, n bigint")
    out = np.zeros(vocabulary, np.int64)
    for row in counted.groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most the vocabulary
        out[row["id"]] = row["n"]
    return out


def _tokens(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows in one array, and their number per row."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return np.frombuffer(raw.tobytes(), kind).astype(np.int32), np.diff(at) // kind.itemsize


def write(docs: DataFrame, path: str, tokenizer_json: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all documents as files below ``path``."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    vocabulary = max(Tokenizer.from_str(tokenizer_json).get_vocab_size(with_added_tokens=True), end_id + 1)
    stored = encode_texts(docs, f"{path}/encoded", tokenizer_json, vocabulary, end_id, id_col, text_col)
    lengths = code_lengths(count_ids(stored, vocabulary), max(16, int(vocabulary - 1).bit_length()))
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast(lengths)
    kind = np.dtype(_id_kind(vocabulary))

    def run(batches):
        code, task = Code(shared.value), TaskContext.get().partitionId()
        before = 0
        for batch in batches:
            for part in slices(batch, "tokens"):
                ids, sizes = _tokens(part.column("tokens"), kind)
                ends = np.cumsum(sizes)
                start = 0
                while start < len(ends):
                    first = int(ends[start - 1]) if start else 0
                    stop = max(start + 1, int(np.searchsorted(ends, first + BLOCK_IDS, "right")))
                    own = ids[first : int(ends[stop - 1])]
                    bits, marks = code.encode(own)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([task], pa.int32()),
                            pa.array([before], pa.int64()),
                            pa.array([len(own)], pa.int64()),
                            pa.array([part.column("id").slice(start, stop - start).to_pylist()], pa.list_(part.schema.field("id").type)),
                            pa.array([sizes[start:stop].tolist()], pa.list_(pa.int32())),
                            pa.array([marks.tobytes()], pa.binary()),
                            pa.array([bits], pa.binary()),
                        ],
                        ["part", "before", "n", "ids", "sizes", "checkpoints", "bits"],
                    )
                    before += len(own)
                    start = stop

    id_type = docs.schema[id_col].dataType.simpleString()
    # rows of one id by the hash of their ids, and by these where that is the same: one order, also over several ranges
    texts = stored.where("tally is null").select("id", "mark", "tokens")
    ordered = texts.repartitionByRange("id", "mark").sortWithinPartitions("id", "mark", "tokens")
    fields = f"part int, before bigint, n bigint, ids array<{id_type}>, sizes array<int>, checkpoints binary, bits binary"
    map_arrow(ordered.select("id", "tokens"), run, fields).write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: ``id``, ``start`` (ids before it), ``tokens`` (the ids, little-endian 32 bit)."""
    blocks = spark.read.parquet(f"{path}/blocks")
    lengths = spark.read.parquet(f"{path}/code").first()["lengths"]  # a byte for each id
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    # one row per file: where its ids begin
    parts = blocks.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    based = blocks.join(F.broadcast(parts), "part").withColumn("first", F.col("base") + F.col("before"))

    def run(batches):
        code = Code(np.frombuffer(lengths, np.uint8))
        for batch in batches:
            for i in range(0, batch.num_rows, 32):
                part = batch.slice(i, 32)
                rows = part.to_pylist()
                ids = code.decode([(r["bits"], np.frombuffer(r["checkpoints"], "<u4"), r["n"]) for r in rows])
                for row, own in zip(rows, ids):
                    sizes = np.array(row["sizes"], np.int64)
                    ends = np.cumsum(sizes)
                    flat = own.astype("<u4")
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(row["ids"], part.schema.field("ids").type.value_type),
                            pa.array(row["first"] + ends - sizes),
                            pa.array([flat[b - s : b].tobytes() for b, s in zip(ends.tolist(), sizes.tolist())], pa.binary()),
                        ],
                        ["id", "start", "tokens"],
                    )

    columns = ["first", "n", "ids", "sizes", "checkpoints", "bits"]
    return map_arrow(based.select(columns), run, f"id {kind}, start bigint, tokens binary")

