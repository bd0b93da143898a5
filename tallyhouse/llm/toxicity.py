"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

*Folding.* Lower case, homoglyphs of Latin letters, and digits and signs that stand for
letters become the letters, one character for one; i, l and the signs for either are one letter.
A term matches at the start of a folded word and covers any ending; a word shorter than
``SHORTEST`` is a term as a whole word only. ``!`` and ``|`` inside a word are read as letters
and as gaps, and 6 as g and as b.

*Lexicon.* Word beginnings of labelled documents that are significantly more frequent in
toxic ones; near copies of one document support a term once. A term weighs the logarithm of its odds
ratio. Phrases of a term and the word before or after it that are found in clean documents
only are exceptions, beside a short fixed list; matches inside them do not count.

*Score.* The matched weight and the weight per length go through a logistic curve fitted on
the same rows. Without labels of both classes a fixed lexicon and curve take their place.

Null texts are empty ones and score as documents without a match. Rows are scored one by
one, so repeated rows score alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import enrich, map_arrow
from .text import slices

# fixed values: letters that look like Latin ones, and signs used in their place
HOMOGLYPHS = dict(zip("аеорсухіјѕԁһкмтвнαοερτυνικ", "aeopcyxijsdhkmtbhaoeptuvik"))
SIGNS = dict(zip("013456789@$!|l", "oieasgtbgasiii"))
#: fixed values: terms where no labels are given
SEED_TERMS = ("idiot", "moron", "stupid", "scum", "pathetic", "worthless", "disgusting", "loser")
#: fixed values: phrases that hold a harmless use of a term
PHRASES = ("trash can", "trash bin", "class clown", "clown fish", "sore loser")
SHORTEST, LONGEST = 4, 10
WHOLE = "."  # ends a term that is a whole word
SIGNIFICANT = 30.0
THRESHOLD = 0.7

_WIDE = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}
_LETTERS = {a: SIGNS.get(b, b) for a, b in HOMOGLYPHS.items()}
_FOLD = {**_WIDE, **{ord(a): ord(b) for a, b in {**_LETTERS, **SIGNS}.items()}}
_WORD = re.compile(r"[^\W_]+")
_SIX = re.compile(r"(?<=[^\W\d_])[6\uff16]|[6\uff16](?=[^\W\d_])")
_GAP = re.compile(r"(?<=\w)[!|\uff01\uff5c]+(?=\w)")


def fold(text: str) -> str:
    return text.translate(_WIDE).lower().translate(_FOLD)


def readings(text: str) -> list[str]:
    """The folded text, and readings with gaps for signs inside words and with b for 6; places agree."""
    out = [text]
    if _GAP.search(text):
        out.append(_GAP.sub(lambda m: " " * len(m.group()), text))
    if _SIX.search(text):
        out += [_SIX.sub("b", one) for one in out]
    return [fold(one) for one in out]


def stems(text: str) -> set[str]:
    """Beginnings of the folded words of a text, and its shorter words whole."""
    words = {w for one in readings(text) for w in _WORD.findall(one)}
    out = {w[:n] for w in words for n in range(SHORTEST, min(LONGEST, len(w)) + 1)}
    return out | {w + WHOLE for w in words if 1 < len(w) < SHORTEST}


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=lambda: [fold(p) for p in PHRASES])
    #: logistic curve over (1, log weight, log weight per thousand words)
    curve: tuple[float, float, float] = (-4.0, 2.0, 0.5)

    def matcher(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None, True))
        for term, weight in self.weights.items():
            word = term.removesuffix(WHOLE)
            found.add_word(word, (len(word), weight, word != term))
        if len(found):
            found.make_automaton()
        return found

    def matches(self, matcher, folded: str) -> list[tuple[int, float]]:
        """(start, weight) of the longest term at each word start, outside exceptions."""
        best: dict[int, tuple[int, float]] = {}
        allowed: list[tuple[int, int]] = []
        for end, (size, weight, whole) in matcher.iter(folded) if len(matcher) else ():
            start = end - size + 1
            if start and folded[start - 1].isalnum():
                continue
            if whole and end + 1 < len(folded) and folded[end + 1].isalnum():
                continue
            if weight is None:
                allowed.append((start, end))
            elif start not in best or best[start][0] < size:
                best[start] = (size, weight)
        return [(s, w) for s, (_, w) in best.items() if not any(a <= s <= b for a, b in allowed)]

    def features(self, matcher, text: str) -> tuple[float, float, float]:
        total = sum({s: w for one in readings(text) for s, w in self.matches(matcher, one)}.values())
        words = text.count(" ") + text.count("\n") + 1
        return 1.0, math.log1p(total), math.log1p(1000 * total / words)


def likeness(text: str) -> int:
    """The smallest hash of the folded three-word shingles of a text, which near copies share and other texts do not."""
    words = _WORD.findall(fold(text))
    return min(hash_of(" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2)))


def _counted(sample: DataFrame, wanted: set[str] | None) -> DataFrame:
    """(stem, label, number of documents; near copies once) for the stems of toxic documents,
    or for the wanted stems in all documents. The empty stem counts all documents in the same way."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                rows = []
                for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
                    own, like = stems(text), likeness(text)
                    rows += [(s, label, like) for s in (own & wanted if wanted is not None else own) | {""}]
                if rows:
                    stem, label, like = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(stem), pa.array(label, pa.int32()), pa.array(like, pa.int64())],
                        ["stem", "label", "likeness"],
                    )

    rows = map_arrow(sample, run, "stem string, label int, likeness bigint").distinct()
    return rows.groupBy("stem", "label").agg(F.count("*").alias("n"))


def hash_of(stem: str) -> int:
    import zlib

    return (zlib.crc32(stem.encode()) * 2654435761) % (1 << 32)


def significance(toxic: float, clean: float, n_toxic: float, n_clean: float) -> float:
    """Log-likelihood ratio of a term that is more frequent in toxic documents, else 0."""
    share = n_toxic / (n_toxic + n_clean)
    both = toxic + clean
    if toxic <= share * both:
        return 0.0
    rest = clean * math.log(clean / both / (1 - share)) if clean else 0.0
    return 2 * (toxic * math.log(toxic / both / share) + rest)


def learn(sample: DataFrame) -> Lexicon:
    """The lexicon of a bounded sample (``text``, ``label``)."""
    present = {r["label"] for r in sample.select("label").distinct().collect()}
    if not {0, 1} <= present:
        return Lexicon(dict.fromkeys(map(fold, SEED_TERMS), 3.0))
    counted = _counted(sample.where("label = 1"), None).persist()
    n_toxic = counted.where("stem = ''").first()["n"]
    least = max(3, math.ceil(0.005 * n_toxic))
    # of a bounded sample; a term in 0.5 % of its toxic documents
    frequent = counted.where((F.col("n") >= least) & (F.col("stem") != ""))
    toxic = {r["stem"]: r["n"] for r in frequent.collect()}
    counted.unpersist()
    clean = {r["stem"]: r["n"] for r in _counted(sample.where("label = 0"), set(toxic)).collect()}
    n_clean = clean[""]
    taken: dict[str, float] = {}
    longer: dict[str, str] = {}
    for stem in sorted(toxic, key=lambda x: (len(x), x)):
        t, c = toxic[stem], clean.get(stem, 0)
        root = next((stem[:n] for n in range(SHORTEST, len(stem)) if stem[:n] in taken), None)
        if root is not None:
            if t >= 0.95 * toxic[root] and stem.startswith(longer[root]):
                longer[root] = stem  # hardly ever anything else follows in toxic documents
            continue
        odds = (t + 0.5) / (n_toxic + 1) / ((c + 0.5) / (n_clean + 1))
        if odds >= 20 and significance(t, c, n_toxic, n_clean) >= SIGNIFICANT:
            taken[stem], longer[stem] = math.log(odds), stem
    weights = {longer[stem]: weight for stem, weight in taken.items()}
    lexicon = Lexicon(weights or dict.fromkeys(map(fold, SEED_TERMS), 3.0))
    lexicon.exceptions += _exceptions(sample, lexicon)
    lexicon.curve = _fit(sample, lexicon)
    return lexicon


def around(folded: str, start: int, word: str) -> set[str]:
    """The word at a place with the whole word before it, and with the one after it."""
    phrases, first, end = set(), start - 1, start + len(word)
    while first > 0 and folded[first - 1].isalnum():
        first -= 1
    if first < start - 1 and folded[start - 1] == " ":
        phrases.add(f"{folded[first : start - 1]} {word}")
    after = _WORD.match(folded, end + 1) if folded[end : end + 1] == " " else None
    return phrases | ({f"{word} {after.group()}"} if after else set())


def _exceptions(sample: DataFrame, lexicon: Lexicon) -> list[str]:
    """Phrases around terms that at least three clean documents have and no toxic one."""

    def run(batches):
        matcher = lexicon.matcher()
        for batch in batches:
            found: Counter = Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                folded = fold(text)
                for start, _ in lexicon.matches(matcher, folded):
                    word = _WORD.match(folded, start).group()
                    found.update((phrase, label) for phrase in around(folded, start, word))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in found], pa.string()),
                    pa.array([k[1] for k in found], pa.int32()),
                    pa.array(list(found.values()), pa.int64()),
                ],
                ["phrase", "label", "n"],
            )

    rows = map_arrow(sample, run, "phrase string, label int, n bigint").groupBy("phrase")
    rows = rows.agg(F.sum(F.when(F.col("label") == 0, F.col("n"))).alias("clean"), F.max("label").alias("toxic"))
    return [r["phrase"] for r in rows.where("clean >= 3 AND toxic = 0").orderBy("phrase").collect()]


def _fit(sample: DataFrame, lexicon: Lexicon) -> tuple[float, float, float]:
    """Logistic regression on the features of the sample, with a small ridge."""

    def run(batches):
        matcher = lexicon.matcher()
        for batch in batches:
            rows = [lexicon.features(matcher, t)[1:] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.float64()), batch.column("label")],
                ["a", "b", "label"],
            )

    rows = map_arrow(sample, run, "a double, b double, label int").toPandas()  # bounded by the sample
    x = np.column_stack([np.ones(len(rows)), rows["a"], rows["b"]])
    y = rows["label"].to_numpy(float)
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3)
        w += np.linalg.solve(hessian, x.T @ (y - p) - 0.01 * w)
    return tuple(float(v) for v in w)


def score(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", column: str = "score") -> DataFrame:
    """The documents with ``score``, 0 to 1: higher, likelier toxic. One narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # bounded by the sample

    def rows(part: pa.RecordBatch) -> dict:
        own = shared.value
        matcher = _matcher(own)
        x = np.array([own.features(matcher, t or "") for t in part.column(text_col).to_pylist()]).reshape(-1, 3)
        return {column: 1 / (1 + np.exp(-np.clip(x @ np.array(own.curve), -30, 30)))}

    return enrich(docs, f"{column} double", rows, text_col)


_built: list = [None, None]


def _matcher(lexicon: Lexicon):
    """The automaton of the lexicon that the worker uses at present."""
    if _built[0] is not lexicon:
        _built[:] = lexicon, lexicon.matcher()
    return _built[1]
