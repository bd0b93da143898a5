"""The registered queries over whole tables: against SQL, brute force or held-out labels."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from compare import connect, differences

from tallyhouse.llm.oracle import ORACLE
from tallyhouse.llm.queries import QUERIES


def rows_of(spark, name, folder, key="doc_id"):
    return {row[key]: row for row in QUERIES[name](spark, folder).collect()}


@pytest.mark.parametrize("name", list(ORACLE))
def test_against_sql(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLE[name]) == []


def test_token_files(spark, sf, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found, start = rows_of(spark, "op3_token_files", sf), 0
    assert set(found) == set(texts)
    for doc in sorted(texts):
        ids = [*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 1]
        row = found[doc]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_quality_rules(spark, sf, texts, labels):
    found = rows_of(spark, "op8_quality_rules", sf)
    for doc, text in texts.items():
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen, again = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        hit = {i + k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(5)}
        row = found[doc]
        assert row["n_words"] == len(words)
        assert row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert (row["n_dup_lines"], row["n_repeat_words"]) == (again, len(hit))
        assert row["base_failed"] == (len(words) < 10 or 100 * len(hit) > 20 * len(words))
        assert not (row["base_failed"] and row["kept"])
    clean = [found[d] for d, row in labels.items() if row["quality"] == 1 and not found[d]["base_failed"]]
    junk = [found[d] for d, row in labels.items() if row["quality"] == 0]
    assert np.mean([r["kept"] for r in clean]) > 0.97
    assert np.mean([r["kept"] for r in junk]) < 0.1


def held_out_rows(found, labels, label):
    for doc, row in found.items():
        assert row["held_out"] == (zlib.crc32(str(doc).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1
    return [(row[label], found[doc]) for doc, row in labels.items() if found[doc]["held_out"]]


def test_toxicity_on_held_out_rows(spark, sf, texts, labels):
    found = rows_of(spark, "op4_toxicity", sf)
    rows = held_out_rows(found, labels, "toxic")
    assert all(row["predicted"] == (row["score"] >= 0.7) for row in found.values())
    assert np.mean([row["predicted"] for truth, row in rows if truth]) > 0.7
    assert np.mean([row["predicted"] for truth, row in rows if not truth]) < 0.01


def test_quality_on_held_out_rows(spark, sf, labels):
    rows = held_out_rows(rows_of(spark, "op6_quality", sf), labels, "quality")
    assert np.mean([row["predicted"] == truth for truth, row in rows]) > 0.95


def test_pages(spark, sf, texts):
    from html import unescape

    pages = pq.read_table(f"{sf}/pages.parquet").to_pylist()
    found = rows_of(spark, "op9_html_extraction", sf, "page_id")
    assert set(found) == {p["page_id"] for p in pages}
    compared = 0
    for page in pages:
        source = re.search(r"/(\d+)/?(?:\.html)?(?:[?#].*)?$", page["url"])
        if source and int(source.group(1)) in texts:
            title = re.search("<h1>(.*?)</h1>", page["html"], re.S).group(1)
            words = [*unescape(title).split(), *texts[int(source.group(1))].split()]
            assert found[page["page_id"]]["text"] == " ".join(words)
            compared += 1
        assert found[page["page_id"]]["n_chars"] == len(found[page["page_id"]]["text"])
    assert compared > 200


def test_pieces_round_trip(spark, sf, texts):
    found = rows_of(spark, "op10_sentencepiece", sf)
    assert set(found) == set(texts)
    assert all(row["round_trip"] for row in found.values())
