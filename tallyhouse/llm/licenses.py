"""Licence scans with a positional rare-token index, in DataFrame functions only.

Of the licence words that a text holds, those of the highest inverse document frequency are looked up
(each template is posted under its rarest word, with the place of the word in it); a posting
gives the one place where the template would start, all its words are compared there by
relative position, and the mandatory key phrase has to stand in full. The look-up is a small
literal, so a scan is one narrow pass; the document frequencies take one pass with a few rows
for each licence word.

Templates of the base rule are their own key phrase. Templates of the method may miss a fifth of
their words outside the key phrase. Null texts have no words. A table without documents has no
frequencies, and every word counts as rare.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import without

FIELDS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
LEAST_SHARE = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    base: bool


def template(label: str, text: str, key: str | None = None, base: bool = False) -> Template:
    words = tuple(text.split())
    return Template(label, words, tuple((key or text).split()), base)


#: fixed values: phrases and labels of the base rule
BASE = (
    template("mit", "under the mit license", base=True),
    template("apache-2", "apache license version 2", base=True),
    template("cc-by-nc", "cc by nc", base=True),
)
#: fixed values: what the method finds beyond them
MORE = (
    template("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted"),
    template("mit", "spdx license identifier mit"),
    template("apache-2", "spdx license identifier apache 2"),
    template("apache-2", "you may not use this file except in compliance with the license", "in compliance with the license"),
    template("gpl-2", "under the gnu general public license version 2", "general public license version 2"),
    template("gpl-3", "under the gnu general public license version 3", "general public license version 3"),
    template("lgpl", "gnu lesser general public license"),
    template("agpl", "gnu affero general public license"),
    template("bsd", "redistribution and use in source and binary forms with or without modification", "source and binary forms"),
    template("mpl-2", "mozilla public license version 2"),
    template("cc-by-sa", "cc by sa"),
    template("cc0", "cc0 1 0 universal"),
    template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def words_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def inverse_frequencies(words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """log(documents / documents with the word) of each licence word, over all documents."""
    own = F.array_intersect("_words", F.array(*map(F.lit, vocabulary)))
    # the null counts the documents; at most one row more than the vocabulary has words
    each = words.select(F.explode(F.concat(own, F.array(F.lit(None).cast("string")))).alias("word"))
    seen = {r["word"]: r["n"] for r in each.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = seen.get(None, 0)
    return {w: math.log((total + 1) / (seen.get(w, 0) + 1)) for w in vocabulary}


def postings(templates: tuple[Template, ...], idf: dict[str, float]) -> Column:
    """The index: each template under its rarest key word, and where that stands in it."""
    rows = []
    for t in templates:
        at = next(i for i in range(len(t.words)) if t.words[i : i + len(t.key)] == t.key)
        rare = max(range(at, at + len(t.key)), key=lambda i: (idf[t.words[i]], -i))
        rows.append(
            F.struct(
                F.lit(t.words[rare]).alias("word"),
                F.lit(rare).alias("offset"),
                F.lit(t.label).alias("label"),
                F.lit(t.base).alias("base"),
                F.array(*map(F.lit, t.words)).alias("words"),
                F.array(*map(F.lit, t.key)).alias("key"),
                F.lit(at).alias("key_at"),
            )
        )
    return F.array(*rows)


def scan(docs: DataFrame, text_col: str = "text", templates: tuple[Template, ...] = BASE + MORE) -> DataFrame:
    """The documents with the columns of FIELDS; names of the input that clash are replaced."""
    kept = without(docs, FIELDS).columns
    tokens = docs.select(*(docs[c] for c in kept), words_of(docs[text_col]).alias("_words"))
    vocabulary = sorted({w for t in templates for w in t.words})
    idf = inverse_frequencies(docs.select(words_of(docs[text_col]).alias("_words")), vocabulary)
    index = postings(templates, idf)
    rare = F.array(*map(F.lit, sorted({max(t.key, key=lambda w: (idf[w], -t.key.index(w))) for t in templates})))

    places = F.filter(
        F.transform("_words", lambda w, i: F.when(F.array_contains(rare, w), F.struct(w.alias("w"), i.alias("i")))),
        lambda x: x.isNotNull(),
    )
    places = F.when(F.arrays_overlap("_words", rare), places)

    def fits(place: Column):
        return lambda t: (
            (t["word"] == place["w"])
            & (place["i"] >= t["offset"] + 0)
            & (place["i"] - t["offset"] + F.size(t["words"]) <= F.size("_words"))
        )

    def candidate(place: Column):
        def of(t: Column) -> Column:
            start = place["i"] - t["offset"]
            own = F.slice("_words", start + 1, F.size(t["words"]))
            same = F.size(F.filter(F.zip_with(own, t["words"], lambda a, b: a == b), lambda x: x))
            return F.struct(
                t["label"].alias("label"),
                t["base"].alias("base"),
                start.alias("start"),
                (F.slice(own, t["key_at"] + 1, F.size(t["key"])) == t["key"]).alias("key"),
                (same / F.size(t["words"])).alias("share"),
            )

        return of

    found = F.flatten(F.transform(places, lambda p: F.transform(F.filter(index, fits(p)), candidate(p))))
    found = F.filter(found, lambda c: c["key"] & (c["share"] >= LEAST_SHARE))
    found = F.coalesce(found, F.array().cast("array<struct<label:string,base:boolean,start:int,key:boolean,share:double>>"))
    located = tokens.select(*kept, F.size("_words").cast("long").alias("n_words"), found.alias("_found"))
    base = F.filter("_found", lambda c: c["base"])
    starts = F.transform("_base", lambda c: c["start"])

    def names(column: str) -> Column:
        return F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(column, lambda c: c["label"]))))

    return located.select("*", base.alias("_base")).select(
        *kept,
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        names("_base").alias("base_labels"),
        names("_found").alias("labels"),
        F.coalesce(F.array_max(F.transform("_found", lambda c: c["share"])), F.lit(0.0)).alias("score"),
    )
