"""Licence notices by a positional index of rare words, in DataFrame functions only.

Texts are words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the A-Z lower-cased text.

1. Every text is read once: its number of words, the licence words in it, and its words
   where it holds the anchor of a template's key phrase (no label without one). The result
   is written; its document counts give the words their IDF.
2. The ``RAREST`` words of highest IDF of each template's key phrase are looked up. Each place
   votes for all (template, offset) in the word's postings; offsets with two votes stay. Where a
   key phrase stands its own words give the votes, whatever other notices the text holds.
3. At these offsets the key phrase must stand word for word, and at least ``LEAST_SHARE`` of the
   template's words. The score of a text is its best share.

Beside that the base phrases are counted as they are. Votes are rows summed by key, so a
long text full of licence words is no burden to one task beyond its own words.

Defined cases: a NULL text is empty and has no words. Rows keep their number, also with
equal or NULL doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.session import staged

RAREST = 2
LEAST_SHARE = 0.6

# Phrases that are counted as they are, with their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Label, key phrase, notice. The key phrase is part of the notice.
NOTICES = (
    ("mit", "mit license", "released under the mit license"),
    ("mit", "mit license", "this software is licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge",
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "apache license version 2", "licensed under the apache license version 2 0"),
    ("apache-2", "apache license version 2",
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "attribution noncommercial", "creative commons attribution noncommercial 4 0 international license"),
    ("gpl-3", "gnu general public license version 3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "gnu general public license",
     "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("bsd", "redistribution and use in source and binary forms",
     "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "mozilla public license v 2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

# Words too common to be looked up.
COMMON = frozenset("the of to and or in is a it this you not as by with that any from use under at are for".split())

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
GAP = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def anchors() -> str:
    """A pattern that every text with a key phrase or a base phrase matches."""
    phrases = sorted({key for _, key, _ in NOTICES} | {p for p, _ in BASE})
    return "(?i)" + "|".join(GAP.join(p.split()) for p in phrases)


def starts_of(words: Column, phrase: list[str]) -> Column:
    """All places where the words of a phrase stand one after another."""
    places = F.sequence(F.lit(0), F.size(words) - 1)
    return F.filter(places, lambda i: together([F.get(words, i + k) == F.lit(w) for k, w in enumerate(phrase)]))


def together(tests: list[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return F.coalesce(out, F.lit(False))


def read_once(docs: DataFrame) -> DataFrame:
    """One row for each text: its key, words counted, licence words in it; its words if it is a candidate."""
    vocabulary = sorted({w for _, _, notice in NOTICES for w in notice.split()} - COMMON)
    read = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).rlike(anchors()).alias("candidate"), words_of(F.col("text")).alias("words"))
    return read.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"),
        F.array_intersect("words", F.array(*map(F.lit, vocabulary))).alias("present"),
        F.when(F.col("candidate"), F.col("words")).alias("words"))


def word_weights(read: DataFrame) -> dict[str, float]:
    """IDF of every licence word in the texts; it holds no more words than the notices."""
    total = read.count()
    counts = read.select(F.explode("present").alias("word")).groupBy("word").agg(F.log((F.lit(total) + 1.0) / (F.count("*") + 1.0)).alias("idf"))
    return {r["word"]: float(r["idf"]) for r in counts.collect()}


def looked_up(weights: dict[str, float]) -> list[str]:
    """The rarest words of each key phrase. A phrase with a word that no text holds stands nowhere."""
    out: set[str] = set()
    for _, key, _ in NOTICES:
        words = sorted({w for w in key.split() if w not in COMMON}, key=lambda w: (-weights.get(w, 0.0), w))
        if all(w in weights for w in words):
            out.update(words[:RAREST])
    return sorted(out)


def postings() -> Column:
    """Licence word to the (template, place) pairs where it stands."""
    where: dict[str, list[tuple[int, int]]] = {}
    for number, (_, _, notice) in enumerate(NOTICES):
        for place, word in enumerate(notice.split()):
            if word not in COMMON:
                where.setdefault(word, []).append((number, place))
    lists = [x for word, held in sorted(where.items()) for x in (F.lit(word), F.array(*(F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in held)))]
    return F.create_map(*lists)


def alignments(candidates: DataFrame, chosen: list[str]) -> DataFrame:
    """(row, t, offset) with at least two of the chosen words in the same relative place."""
    places = candidates.select("row", F.posexplode("words").alias("at", "word")).filter(F.col("word").isin(chosen))
    votes = places.select("row", "at", F.explode(F.element_at(postings(), F.col("word"))).alias("q"))
    keyed = votes.select("row", F.col("q.t").alias("t"), (F.col("at") - F.col("q.p")).alias("offset"))
    return keyed.groupBy("row", "t", "offset").agg(F.count("*").alias("votes")).filter("votes >= 2")


def notices() -> Column:
    """Template number to its label, words, key phrase and the place of that in the words."""
    out = []
    for number, (label, key, notice) in enumerate(NOTICES):
        body, phrase = notice.split(), key.split()
        at = next(i for i in range(len(body)) if body[i : i + len(phrase)] == phrase)
        held = F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, body)).alias("body"), F.array(*map(F.lit, phrase)).alias("key"), F.lit(at).alias("at"))
        out += [F.lit(number), held]
    return F.create_map(*out)


def verified(candidates: DataFrame, found: DataFrame) -> DataFrame:
    """(row, label, share) of the alignments where the key phrase stands and enough of the notice."""
    joined = found.join(candidates.select("row", "words"), "row").withColumn("n", F.element_at(notices(), F.col("t")))
    here = lambda i: F.when(F.col("offset") + i >= 0, F.get("words", F.col("offset") + i))
    places = lambda words: F.sequence(F.lit(0), F.size(words) - 1)
    same = F.filter(places("n.body"), lambda i: F.coalesce(here(i) == F.get("n.body", i), F.lit(False)))
    stands = F.forall(places("n.key"), lambda i: F.coalesce(here(i + F.col("n.at")) == F.get("n.key", i), F.lit(False)))
    judged = joined.select("row", F.col("n.label").alias("label"), (F.size(same) / F.size("n.body")).alias("share"), stands.alias("stands"))
    return judged.filter(F.col("stands") & (F.col("share") >= LEAST_SHARE)).select("row", "label", "share")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    read = staged(read_once(docs), "licence-words")
    candidates = read.filter(F.col("words").isNotNull())
    found = verified(candidates, alignments(candidates, looked_up(word_weights(read))))
    best = found.groupBy("row").agg(F.collect_set("label").alias("_method"), F.max("share").alias("_share"))
    words = F.coalesce("words", F.array().cast("array<string>"))
    places = [F.when(F.size(words) > 0, starts_of(words, p.split())).otherwise(F.array().cast("array<int>")) for p, _ in BASE]
    out = candidates.select("row", *(p.alias(f"_{k}") for k, p in enumerate(places)))
    every = F.concat(*(F.col(f"_{k}") for k in range(len(BASE))))
    labels = F.array_compact(F.array(*(F.when(F.size(f"_{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE))))
    base = out.select("row", F.size(every).cast("long").alias("_n"), F.array_min(every).cast("long").alias("first_word"),
                      F.array_max(every).cast("long").alias("last_word"), labels.alias("_base"))
    none = F.array().cast("array<string>")
    joined = read.select("row", "doc_id", "n_words").join(base, "row", "left").join(best, "row", "left")
    names = lambda *lists: F.array_join(F.array_sort(F.array_distinct(F.concat(*(F.coalesce(x, none) for x in lists)))), ",")
    return joined.select(
        "doc_id", "n_words", F.coalesce("_n", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        names(F.col("_base")).alias("base_labels"), names(F.col("_base"), F.col("_method")).alias("labels"),
        F.coalesce(F.greatest(F.when(F.size("_base") > 0, F.lit(1.0)), F.col("_share")), F.lit(0.0)).alias("score"))
