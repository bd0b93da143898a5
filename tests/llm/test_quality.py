"""Random-indexing vectors over all documents, against sums made word by word."""

import numpy as np

from tallyhouse.llm import quality
from tallyhouse.llm.text import SOLID, Words

TEXTS = ["a b c a", None, "", "one", "b a 12 x-y é a b", "a b", "long " * 5000]


def naive(texts):
    import pyarrow as pa

    out = []
    for k, size in enumerate((quality.WORD_ROWS, quality.SHAPE_ROWS)):
        places, entries = quality._index_vectors(size, 6 + k)
        table = np.zeros((size, quality.DIM))
        for text in texts:
            rows = quality._rows_of(Words(pa.array([text], pa.string()), SOLID, lower=False))[k]
            for i, own in enumerate(rows):
                for j in range(max(0, i - 2), min(len(rows), i + 3)):
                    if i != j:
                        np.add.at(table[own], places[:, rows[j]], entries[:, rows[j]])
        out.append(quality._unit(table))
    return out


def test_vectors_of_all_texts(spark):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(4)
    model = quality._tables(docs)
    words, shapes = naive(TEXTS)
    assert np.allclose(model.word_table, words) and np.allclose(model.shape_table, shapes)
    # the tables do not depend on how the rows lie
    again = quality._tables(docs.coalesce(1))
    assert (again.word_table == model.word_table).all()


def test_words_outside_the_sample_have_vectors(spark):
    sample = spark.createDataFrame([("good words here", 1), ("bad words there", 0)] * 30, "text string, label int")
    texts = spark.createDataFrame([("unseen terms stand together",), ("good words here",)], "text string")
    model = quality.learn(sample, texts)
    import pyarrow as pa

    rows = quality._rows_of(Words(pa.array(["unseen terms"]), SOLID, lower=False))[0]
    assert np.allclose(np.linalg.norm(model.word_table[rows], axis=1), 1)
    found = {r["score"] for r in quality.score(spark.createDataFrame([(None,), ("",)], "text string"), model).collect()}
    assert len(found) == 1 and quality._tables(texts.where("false")).word_table.any() == False  # noqa: E712
