"""Nulls, empty and long texts, repeated rows, empty tables and clashing names."""

import corpus_pipeline
import pyarrow as pa
import pytest

from tallyhouse.llm import (
    decontaminate,
    licenses,
    neardup,
    pieces,
    quality,
    repeats,
    rules,
    tokenfile,
    toxicity,
    webpages,
)
from tallyhouse.llm.labelled import labelled_sample
from tallyhouse.llm.queries import piece_model
from tallyhouse.llm.text import ALNUM, SOLID, Words, slices
from tallyhouse.session import scratch_path

LONG = " ".join(f"w{i}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(40))
ITEM = " ".join(f"item{i}" for i in range(20))
ROWS = [
    (0, "", "a"),
    (1, None, "a"),
    (2, " \n\t ", None),
    (3, LONG, "b"),
    (4, f"before {PASSAGE} after", "b"),
    (5, f"{PASSAGE} Ünïcode 漢字 end", "b"),
    (6, "four words are here", "c"),
    (6, "four words are here", "c"),
    (7, "Four words are here", "c"),
    (None, "no id but words of a text", "d"),
    (8, f"a text that holds {ITEM} and goes on", "d"),
    (9, "Released under the MIT License. CC BY-NC 4.0, cc by nc", "d"),
    (10, "x" * 100_000, "e"),
]
CLASHES = "n_words string, items string, kept string, KEPT_TEXT string, score string, ids string, labels string, root string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, s, *["mine"] * 8) for i, t, s in ROWS]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, source string, {CLASHES}")


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, ITEM), (5, "four words")], "item_id bigint, text string")


def by_id(df, column="doc_id"):
    return {row[column]: row for row in df.collect()}


def test_words_of_slices():
    batch = pa.record_batch([pa.array(["Ab  c1", None, "", "é!x"])], ["text"])
    words = Words(batch.column("text"), ALNUM)
    assert [words.word(i).decode() for i in range(4)] == ["ab", "c1", "é", "x"]
    assert words.counts.tolist() == [2, 0, 0, 2]
    assert [p.num_rows for p in slices(batch, limit=6)] == [3, 1]
    assert Words(batch.column("text"), SOLID, lower=False).counts.tolist() == [2, 0, 0, 1]
    assert Words(pa.array([], pa.string()), SOLID).counts.tolist() == []


def test_decontaminate(docs, none, items):
    found = by_id(decontaminate.find_items(docs, items))
    assert found[8]["items"] == ["1", "4"] and found[8]["n_hit"] == 20 and found[8]["n_words"] == 27
    assert found[6]["items"] == ["5"] and found[6]["n_hit"] == 2
    assert (found[1]["n_words"], found[1]["n_hit"], found[1]["items"]) == (0, 0, [])
    assert decontaminate.find_items(none, items).count() == 0
    unhit = by_id(decontaminate.find_items(docs, items.where("false")))
    assert unhit[8]["n_hit"] == 0 and unhit[8]["n_words"] == 27
    assert found[8]["source"] == "d" and found[8]["kept"] == "mine"


def test_decontaminate_in_blocks(docs, items, monkeypatch):
    whole = decontaminate.find_items(docs, items).select("doc_id", "n_words", "n_hit", "items").collect()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)
    assert len(decontaminate.item_blocks(items, "item_id", "text")) > 3
    parts = decontaminate.find_items(docs, items).select("doc_id", "n_words", "n_hit", "items").collect()
    assert sorted(parts, key=repr) == sorted(whole, key=repr)


@pytest.mark.parametrize("part_bytes", [1 << 20, 200])
def test_repeats(docs, none, part_bytes):
    found = by_id(repeats.remove_repeats(docs, part_bytes=part_bytes))
    assert found[4]["kept_text"] == "before after" and found[4]["n_removed"] == 40
    assert found[5]["kept_text"] == "Ünïcode 漢字 end"
    assert found[3]["kept_text"] == LONG and found[3]["n_removed"] == 0
    assert (found[1]["n_words"], found[1]["kept_text"]) == (0, "")
    assert found[6]["n_removed"] == 0 and found[6]["text"] == "four words are here"
    assert repeats.remove_repeats(none).count() == 0


def test_repeats_in_one_text_and_in_equal_rows(spark):
    rows = [(1, f"{PASSAGE} x {PASSAGE}"), (2, LONG), (2, LONG)]
    found = by_id(repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert found[1]["kept_text"] == "x"
    assert found[2]["kept_text"] == "" and found[2]["n_removed"] == 30_000


def test_near_duplicates(docs, none):
    rows = neardup.near_duplicates(docs).collect()
    found = {r["id"]: r for r in rows}
    assert len(rows) == len(ROWS)
    assert found[7]["component_id"] == 6 and not found[7]["kept"] and found[6]["kept"]
    assert found[6]["n_shingles"] == 1 and found[1]["n_shingles"] == 0
    assert found[1]["component_id"] == 1 and found[0]["component_id"] == 0
    assert neardup.near_duplicates(none).count() == 0


def test_near_duplicates_chain_and_threshold(spark, monkeypatch):
    words = [f"w{i}" for i in range(400)]

    def edited(*places):
        return " ".join("changed%d" % p if p in places else w for p, w in enumerate(words))

    # one edit leaves 391 of 396 + 5 shingles; twenty spread edits fall below 0.85
    far = edited(*range(0, 400, 20))
    rows = [(1, edited()), (2, edited(100)), (3, edited(100, 200, 300)), (4, far)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for block in (1000, 1):
        monkeypatch.setattr(neardup, "BLOCK", block)
        found = {r["id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()}
        assert found == {1: 1, 2: 1, 3: 1, 4: 4}


def test_token_files(spark, docs, none):
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        spec = file.read()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    odd = [(20, "it's <|endoftext|> \x01 a\x01b"), (21, "ÀÉ ﬁ İstanbul é ß Σας"), (22, "a b　c\x85d")]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"))
    for table in (more, none):
        path = scratch_path(spark, "tokens")
        tokenfile.write(table, path, spec, end_id=1)
        rows = tokenfile.read(spark, path).collect()
        expected = sorted(table.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0))
        ids = [[*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in expected]
        rows.sort(key=lambda r: r["start"])
        assert [r["id"] for r in rows] == [r["doc_id"] for r in expected]
        got = [[int.from_bytes(r["tokens"][i : i + 4], "little") for i in range(0, len(r["tokens"]), 4)] for r in rows]
        assert got == ids


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int, quality int")
    lexicon = toxicity.learn(labelled_sample(docs, labels, "toxic"))
    scored = by_id(toxicity.score(docs, lexicon))
    assert scored[1]["score"] == scored[0]["score"] < 0.1
    assert toxicity.score(none, lexicon).count() == 0
    said = [(1, "you 1d10t and m0r0n"), (2, "уоu pаthеtic l0ser"), (3, "put it in the trash can"), (4, "kidiotic")]
    found = by_id(toxicity.score(spark.createDataFrame(said, "doc_id bigint, text string"), lexicon))
    assert found[1]["score"] > 0.7 and found[2]["score"] > 0.7
    assert found[3]["score"] < 0.1 and found[4]["score"] < 0.1


def test_quality_and_rules(spark, docs, none):
    labels = spark.createDataFrame([(0, 1, 1), (0, 1, 0), (None, 1, 1), (3, None, None)], "doc_id bigint, toxic int, quality int")
    sample = labelled_sample(docs, labels, "quality")
    model = quality.learn(sample)
    assert {r["score"] for r in quality.score(docs, model).collect()} == {0.5}
    assert quality.score(none, model).count() == 0
    forest = rules.learn(sample)
    judged = by_id(rules.judge(docs, forest))
    assert judged[1]["base_failed"] and not judged[1]["kept"] and judged[3]["kept"]
    assert rules.judge(none, forest).count() == 0


def test_licenses(docs, none):
    found = by_id(licenses.scan(docs))
    assert found[9]["base_labels"] == "cc-by-nc,mit" and found[9]["n_base"] == 3
    assert (found[9]["first_word"], found[9]["last_word"], found[9]["score"]) == (1, 10, 1.0)
    assert found[1]["n_words"] == 0 and found[1]["first_word"] is None and found[1]["labels"] == ""
    assert licenses.scan(none).count() == 0


def test_pages(spark):
    noisy = (
        "<html><body class='has-sidebar'><div id='cookie-notice'>We use cookies</div><header>Site</header>"
        "<main><article><h2>Title</h2><p>One &amp; two<br>three<p>Four <b>fi</b>ve</p><aside>Ad</aside>"
        "<form>Name</form><section class='comments'><p>First!</p></section></article></main>"
        "<footer>Imprint</footer></body></html>"
    )
    rows = [(1, "http://a.example/1", noisy), (2, None, None), (3, "x", ""), (4, "http://a.example/2", "<p>open"), (1, "http://a.example/1", noisy)]
    rows.append((5, "http://b.example", "1 < 2 <div" + " x" * 50_000))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'mine' AS text")
    found = by_id(webpages.extract_pages(pages), "page_id")
    assert found[1]["text"] == "Title One & two three Four five"
    assert found[2]["text"] == found[3]["text"] == "" and found[2]["n_chars"] == 0
    assert found[4]["text"] == "open" and found[5]["text"].startswith("1 < 2")
    assert webpages.extract_pages(pages.where("false")).count() == 0


def test_pieces(spark, docs, none):
    vocabulary = pieces.Vocabulary.of(piece_model())
    back = pieces.decode(pieces.encode(docs, vocabulary), vocabulary, column="decoded")
    assert all(r["decoded"] == (r["text"] or "") for r in back.collect())
    assert pieces.decode(pieces.encode(none, vocabulary), vocabulary).count() == 0


def best_segmentation(vocabulary, unknown, text):
    best = [(0.0, 0, [])]
    for end in range(1, len(text) + 1):
        options = []
        for start in range(end):
            piece = vocabulary.pieces.get(text[start:end])
            if piece:
                options.append((best[start][0] + piece[1], -start, [piece[0]]))
        if text[end - 1] not in vocabulary.pieces:
            raw = [vocabulary.byte_ids[b] for b in text[end - 1].encode()]
            options.append((best[end - 1][0] + unknown, -(end - 1), raw))
        score, start, ids = max(options)
        best.append((score, -start, ids))
    out, end = [], len(text)
    while end:
        out = best[end][2] + out
        end = best[end][1]
    return out


def test_streaming_search_is_the_best_segmentation(texts):
    vocabulary = pieces.Vocabulary.of(piece_model())
    search = pieces.Viterbi(vocabulary)
    samples = [t[:400] for t in list(texts.values())[:25] if t]
    samples += ["", " ", "  a", "a\n\n b\t", "▁x ▁", "漢字😀é" * 30, "x" * 300, "ab" * 200 + " " * 40]
    for text in samples:
        whole = search.encode(" " + text) if text else []
        assert whole == (best_segmentation(vocabulary, search.unknown, " " + text) if text else [])
        cut = pieces.Stretches(pa.array([text]))
        assert [i for k in range(len(cut.starts)) for i in search.encode(cut.word(k).decode())] == whole


def test_pipeline_stages(spark, docs, none, tmp_path, items):
    folder = str(tmp_path / "in")
    items.write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    insult = spark.createDataFrame([(30, "you idiot and moron", "z", *["mine"] * 8)], docs.schema)
    for start in (docs.unionByName(insult), none):
        rows = start
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, rows, folder)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
            path = str(tmp_path / f"{name}-{start is none}")
            out.write.parquet(path)
            rows = spark.read.parquet(path)
        if start is none:
            assert rows.count() == 0
        else:
            # 30 is toxic, 5, 7 and one row of 6 are copies, 6 and 8 are contaminated
            left = [r["doc_id"] for r in rows.collect()]
            assert sorted(left, key=str) == sorted([None, 0, 1, 2, 3, 4, 9, 10], key=str)


def test_tables_of_powers_are_shared_and_bounded(monkeypatch):
    from tallyhouse.llm import text

    monkeypatch.setattr(text, "_tables", {})
    monkeypatch.setattr(text, "MOST_POWERS", 1 << 12)
    for size in (1 << 12, 3, 1025, 2000, 5000):  # a table for every size was kept before, of any length
        for inverse in (False, True):
            base = pow(7, -1, 1 << 64) if inverse else 7
            assert text.powers(7, size, inverse).tolist() == [pow(base, i, 1 << 64) for i in range(size)]
    assert [len(t) for t in text._tables.values()] == [1 << 12, 1 << 12]
    assert len(text.powers(7, 0)) == 0
