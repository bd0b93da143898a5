"""SentencePiece encoding and decoding with a streaming Viterbi search.

The pieces and scores of a given model are taken as they are. A text is read character by
character; for each end the best sum of scores is found over the pieces that end there, so
only the last ``longest`` positions matter. Whenever the best paths of all of them run
through one boundary, the ids up to it are committed and forgotten, so memory does not follow
the length of a text. No piece reaches over the start of white space, so such a boundary lies
before every one; a worker keeps the ids of the distinct stretches between them.

Of paths with equal scores the one whose last piece is longer wins. A character that no piece
has becomes its UTF-8 bytes, at a score below that of every piece. As in the model's own
normalisation a space is put before a text. Decoding gives back every text exactly; a
character that the vocabulary uses for spaces is written as bytes where a text holds it.

Null and empty texts have no ids, and decode to an empty text. Names that clash are replaced.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .frames import enrich
from .text import utf8
from .wordcache import WordCache, ragged
from .text import _BASES, _BYTE, range_hash

_SPACE = "▁"
_CONTROL = np.zeros(256, bool)
_CONTROL[[9, 10]] = True  # tabs and line breaks: in no piece beside other characters
UNKNOWN_PENALTY = 10
#: characters between two looks for a boundary that all paths share
COMMIT_EVERY = 64
#: distinct stretches that a worker keeps, and rows that are decoded at once
MOST_STRETCHES = 1_000_000
DECODE_ROWS = 500


@dataclass
class Vocabulary:
    """Pieces by text (a space where the model has its mark), and the bytes of every id."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    spelled: list[bytes]

    @classmethod
    def of(cls, model_file: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces, byte_ids, spelled = {}, [-1] * 256, []
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(text[3:5], 16)
                byte_ids[value] = i
                spelled.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                spelled.append(b"")
            else:
                text = text.replace(_SPACE, " ")
                pieces[text] = (i, model.get_score(i))
                spelled.append(text.encode())
        if min(byte_ids) < 0:
            raise ValueError("the model has no pieces for single bytes")
        if any(" " in p.lstrip(" ") or (len(p) > 1 and ("\t" in p or "\n" in p)) for p in pieces):
            raise ValueError("the model has pieces that reach over white space")
        return cls(pieces, byte_ids, spelled)

    @property
    def name(self) -> str:
        return hashlib.sha256(repr((self.pieces, self.byte_ids)).encode()).hexdigest()


class Viterbi:
    def __init__(self, vocabulary: Vocabulary):
        self.pieces = vocabulary.pieces
        self.byte_ids = vocabulary.byte_ids
        self.longest = max(map(len, self.pieces), default=1)
        self.unknown = min((s for _, s in self.pieces.values()), default=0.0) - UNKNOWN_PENALTY

    def encode(self, chars: str) -> list[int]:
        """Ids of the best segmentation."""
        get, longest, out = self.pieces.get, self.longest, []
        done = 0  # everything before it is committed
        best, back = [0.0], [(0, -1)]  # of the positions from done on
        for end in range(1, len(chars) + 1):
            top, step = None, None
            for start in range(max(done, end - longest), end):
                piece = get(chars[start:end])
                if piece is not None:
                    score = best[start - done] + piece[1]
                    if top is None or score > top:
                        top, step = score, (start, piece[0])
            if top is None or (step[0] != end - 1 and get(chars[end - 1]) is None):
                score = best[end - 1 - done] + self.unknown
                if top is None or score > top:
                    top, step = score, (end - 1, -1)
            best.append(top)
            back.append(step)
            if end - done >= COMMIT_EVERY and end % longest == 0:
                shared = self._shared(back, done, max(done, end - longest + 1), end)
                if shared > done:
                    self._emit(chars, back, done, shared, out)
                    best, back, done = best[shared - done :], back[shared - done :], shared
        self._emit(chars, back, done, len(chars), out)
        return out

    @staticmethod
    def _shared(back: list, done: int, low: int, high: int) -> int:
        """The last boundary that the best paths of all positions low to high run through."""
        open_ = set(range(low, high + 1))
        while len(open_) > 1:
            last = max(open_)
            open_.remove(last)
            open_.add(back[last - done][0])
        return open_.pop()

    def _emit(self, chars: str, back: list, done: int, end: int, out: list[int]) -> None:
        path = []
        while end > done:
            start, piece = back[end - done]
            path.append([piece] if piece >= 0 else [self.byte_ids[b] for b in chars[start:end].encode()])
            end = start
        for ids in reversed(path):
            out.extend(ids)


class Stretches:
    """Texts with a space before each, cut where no piece reaches over (looks like ``Words``)."""

    def __init__(self, texts: pa.Array):
        raw, offsets = utf8(texts)
        full = np.diff(offsets) > 0
        self.raw = np.insert(raw, offsets[:-1][full], 0x20)
        self.offsets = offsets + np.r_[0, np.cumsum(full)]
        space, control = self.raw == 0x20, _CONTROL[self.raw]
        begin = np.ones(len(self.raw), bool)
        begin[1:] = (space[1:] & ~space[:-1]) | control[1:] | control[:-1]
        begin[self.offsets[:-1][full]] = True
        self.starts = np.flatnonzero(begin)
        self.ends = np.r_[self.starts[1:], len(self.raw)] if len(self.starts) else self.starts
        self.first = np.searchsorted(self.starts, self.offsets)

    def hashes(self) -> np.ndarray:
        return range_hash(_BYTE[self.raw], self.starts, self.ends, _BASES[0])

    def word(self, i: int) -> bytes:
        return self.raw[self.starts[i] : self.ends[i]].tobytes()


_caches: dict[str, WordCache] = {}


def _cache(name: str, vocabulary: Vocabulary) -> WordCache:
    if name not in _caches:
        search = Viterbi(vocabulary)

        def ids_of(stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            found = [search.encode(s.decode()) for s in stretches]
            return np.array([i for f in found for i in f], np.int32), np.array([len(f) for f in found], np.int64)

        _caches[name] = WordCache(ids_of, len(vocabulary.spelled), MOST_STRETCHES)
    return _caches[name]


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", column: str = "ids") -> DataFrame:
    """The documents with their ids, array<int>. One narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.name, vocabulary))  # a model's size

    def rows(part: pa.RecordBatch) -> dict:
        cut = Stretches(part.column(text_col))
        ids, sizes = _cache(*shared.value)(cut)
        places = np.r_[0, np.cumsum(sizes)][cut.first]
        return {column: pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(ids, pa.int32()))}

    return enrich(docs, f"{column} array<int>", rows, text_col)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", column: str = "text") -> DataFrame:
    """The rows with the text of their ids. Null ids give an empty text."""
    spelled = vocabulary.spelled
    shared = encoded.sparkSession.sparkContext.broadcast(
        (np.frombuffer(b"".join(spelled), np.uint8), np.array([len(s) for s in spelled], np.int64))
    )

    def rows(part: pa.RecordBatch) -> dict:
        flat, sizes = shared.value
        starts = np.cumsum(sizes) - sizes
        lists = part.column(ids_col)
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        raw = flat[ragged(starts[ids], sizes[ids])].tobytes()
        ends = np.r_[0, np.cumsum(sizes[ids])][np.r_[0, np.cumsum(counts)]].tolist()
        texts = [raw[a + 1 : b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
        return {column: pa.array(texts, pa.string())}

    return enrich(encoded, f"{column} string", rows, None, DECODE_ROWS)
