"""The Merkle manifest against one built in memory, with groups of all sizes around powers of 16."""

import hashlib
import zlib

from tallyhouse.llm import merkle

SIZES = {None: 1, "": 15, "a": 16, "é": 17, "hot": 256, "z": 273, "漢": 2}
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, grp string, leaf string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def rows():
    found, doc = [], 1000
    for source, n in SIZES.items():
        for i in range(n):
            doc -= 1
            text = [None, "", "ABC Äb", f"Text {i}", "x" * 70_000][i % 5] if i < 20 else f"T{i}"
            found.append((doc, source, [None, "de"][i % 2], None if i % 7 == 0 else i, text))
    found += [(None, "a", None, None, None), found[40], found[40]]
    return found


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def steps(levels, at):
    found = []
    for level in levels[:-1]:
        run = level[at // 16 * 16 : at // 16 * 16 + 16]
        found.append((run[: at % 16], run[at % 16 + 1 :]))
        at //= 16
    return found


def manifest(found):
    groups = {}
    if not found:
        return
    for row in found:
        leaf = h(*map(field, row))
        doc, text = row[0], row[4]
        if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 5 == 0:
            text = "".join(c.lower() if c.isascii() else c for c in text)
        groups.setdefault(row[1], []).append((doc is not None, doc or 0, leaf, h(*map(field, (*row[:4], text))), doc))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([r[2] for r in sorted(groups[s])]) for s in names}
    upper = levels_of([trees[s][-1][0] for s in names])
    root = upper[-1][0]
    for g, s in enumerate(names):
        for at, (_, _, leaf, altered, doc) in enumerate(sorted(groups[s])):
            path = [*steps(trees[s], at), *steps(upper, g)]
            current = altered
            for before, after in path:
                current = h(*before, current, *after)
            proof = h(*(d for before, after in path for d in (*before, *after)))
            yield doc, leaf, trees[s][-1][0], root, proof, current, current == root


def frame(spark, found):
    return spark.createDataFrame([(*r, "mine", "mine") for r in found], SCHEMA)


def test_against_brute_force(spark):
    want = sorted(manifest(rows()), key=repr)
    found = merkle.manifest(frame(spark, rows()).repartition(7))
    assert sorted(map(tuple, found.collect()), key=repr) == want
    assert {r[-1] for r in want} == {True, False}


def test_small_tables(spark):
    for n in (0, 1, 2):
        found = merkle.manifest(frame(spark, rows()[:n]))
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(manifest(rows()[:n]), key=repr)
