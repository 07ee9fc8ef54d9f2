import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglake.llm import licences, token_shards, topk
from loglake.session import fresh_path

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def licence_brute(text):
    w = words(text)
    places, base, labels, score = [], set(), set(), 0.0
    for phrase, label in licences.BASE:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    for label, key, notice in licences.NOTICES:
        body, k = notice.split(), key.split()
        start = next(i for i in range(len(body)) if body[i : i + len(k)] == k)
        for shift in range(-len(body), len(w)):
            share = sum(0 <= shift + i < len(w) and w[shift + i] == b for i, b in enumerate(body)) / len(body)
            if share >= licences.LEAST_SHARE and shift + start >= 0 and w[shift + start : shift + start + len(k)] == k:
                labels.add(label)
                score = max(score, share)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), round(1.0 if base else score, 9))


def test_licences_against_brute_force(spark, odd_docs, no_docs):
    texts = [n for _, _, n in licences.NOTICES] + ["x " + n.upper() + " y" for _, _, n in licences.NOTICES]
    texts += ["under the MIT, License under\nthe mit license", "cc by nc", "licence of the mİt", "mit", "Licensed under Kelvin MIT license now",
              "this work is free under the gnu general public license version 3", "released to them under the mit license", "é under the mit license",
              "redistribution and use in source and binary forms with any change are permitted provided that the following conditions hold"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(r.doc_id, r.text) for r in odd_docs.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit(1))
    got = [(str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in licences.scan(df).collect()]
    assert sorted(got, key=str) == sorted([(str(i), *licence_brute(t)) for i, t in rows], key=str)
    assert licences.scan(no_docs).count() == 0


def test_several_notices_in_one_text_against_brute_force(spark):
    from itertools import combinations

    bodies = [n for _, _, n in licences.NOTICES]
    texts = [" and also ".join(c) for k in (2, 3) for c in combinations(bodies, k)] + [" then ".join(bodies), " then ".join(bodies[::-1])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in licences.scan(df).collect()}
    assert got == {k: licence_brute(t)[5:] for k, t in enumerate(texts)}


def top_brute(rows, k):
    good = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v in good:
        if i % 50 == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in good if j != i and len(w) == len(v))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(near)]
    return sorted(out)


def test_top_k_against_brute_force(spark):
    draw = random.Random(4)
    rows = [(k, [draw.gauss(0, 0.2) for _ in range(8)]) for k in range(700)]
    rows += [(1000 + k, [0.5] * 8) for k in range(60)]  # ties
    rows += [(2000, None), (2001, []), (2050, [None] * 8), (2100, [float("nan")] * 8), (None, [0.1] * 8), (2150, [0.1, 0.2]), (2151, [0.3, 0.2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("mine"))
    plain = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    size, topk.BLOCK = topk.BLOCK, 128
    try:
        got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect())
    finally:
        topk.BLOCK = size
    assert got == top_brute(plain, 5)
    assert topk.top_k(df.filter("false"), F.lit(True)).count() == 0


def test_lists_are_not_read_to_the_end_where_bounds_allow():
    draw = np.random.default_rng(0)
    c = draw.integers(-3, 4, (4000, 4))
    c[:40] += 200
    q = np.array([[5, 4, 3, 6]])
    found, read = topk.search_block(np.array([-1]), q, np.arange(4000), c, 5)
    order = sorted(range(4000), key=lambda i: (-int(c[i] @ q[0]), i))[:5]
    assert [f[1] for f in found] == order and read < 4000
    far = topk.search_block(np.array([-1]), q << 40, np.arange(4000), c, 5)[0]
    assert [f[2] for f in far] == [int(c[i].astype(object) @ (q[0].astype(object) << 40)) for i in order]


def test_permutation_is_one():
    for n in (1, 2, 3, 10, 1000, 4097):
        assert sorted(token_shards.feistel(np.arange(n), n, 7).tolist()) == list(range(n))
    assert token_shards.feistel(np.arange(1000), 1000, 7).tolist() != token_shards.feistel(np.arange(1000), 1000, 8).tolist()
    assert token_shards.feistel(np.array([5]), 1000, 7)[0] == token_shards.feistel(np.arange(1000), 1000, 7)[5]


def test_shards_hold_every_sequence_once(spark, odd_docs, no_docs, tmp_path):
    root = fresh_path(spark, "shards")
    docs = odd_docs.coalesce(1)
    rows = token_shards.write_shards(docs, root, length=64, per_shard=16).orderBy("seq_no").collect()
    encode = token_shards.bpe_encoder()()
    stream = []
    for r in docs.collect():
        stream += encode(r.text or "") + [token_shards.END_MARK]
    n = -(-len(stream) // 64)
    stream += [token_shards.END_MARK] * (n * 64 - len(stream))
    slots = token_shards.feistel(np.arange(n), n, 1)
    assert [(r.seq_no, r.slot) for r in rows] == list(enumerate(slots.tolist()))
    assert [r.byte_offset for r in rows] == [s % 16 * 128 for s in slots.tolist()]
    back = {r.slot: r.ids for r in token_shards.read_slots(spark, root, 0, n).collect()}
    assert len(back) == n and all(back[s] == stream[k * 64 : k * 64 + 64] for k, s in enumerate(slots.tolist()))
    part = token_shards.read_slots(spark, root, 20, 37).collect()
    assert sorted(r.slot for r in part) == list(range(20, 37)) and all(back[r.slot] == r.ids for r in part)
    assert token_shards.write_shards(no_docs, fresh_path(spark, "shards")).count() == 0


def test_a_lost_run_leaves_no_layout(spark, odd_docs):
    root = fresh_path(spark, "lost-shards")

    def broken():
        encode = token_shards.bpe_encoder()()

        def read(text):
            if text.startswith("one"):
                raise RuntimeError("lost")
            return encode(text)

        return read

    with pytest.raises(Exception, match="lost"):
        token_shards.write_shards(odd_docs, root, make_encoder=lambda: broken())
    with pytest.raises(FileNotFoundError):
        token_shards.read_slots(spark, root, 0, 10)


def test_shards_are_written_once(spark, odd_docs):
    root = fresh_path(spark, "shards-once")
    rows = token_shards.write_shards(odd_docs, root, length=64, per_shard=16)
    before = {f: os.stat(f"{root}/{f}").st_mtime_ns for f in os.listdir(root)}
    assert rows.count() == len(rows.collect())
    assert {f: os.stat(f"{root}/{f}").st_mtime_ns for f in os.listdir(root)} == before
