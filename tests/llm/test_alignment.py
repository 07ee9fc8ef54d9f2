import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loglake.llm import alignment

TEXTS = [
    None, "", "a", " a  b\n\n", "the then ▁ there", "naïve café 12345 don't", "<|endoftext|> <s> [INST]", "日本語のテキスト 🙂🙃", "\x00\t\r\n x",
    "the cat " * 3, "the cat " * 3, "word" * 900 + " the end of it, again and again, " * 200,
]


def plain(texts):
    """Every text alone: two pointers, a dictionary of counts."""
    a_coder = Tokenizer.from_file(alignment.A_PATH)
    a_coder.encode_special_tokens = True
    b_coder = sentencepiece.SentencePieceProcessor(model_file=alignment.B_PATH)
    byte = alignment.byte_of_char()
    found, counts = [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = [(i, bytes(byte[c] for c in a_coder.id_to_token(i))) for i in a_coder.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = []
        for i in b_coder.encode(text) if text else []:
            piece = b_coder.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if b_coder.is_byte(i) else piece.replace("▁", " ").encode()))
        if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
            a, b = [], []
        sides = []
        for side in (a, b):
            at, spans = 0, []
            for i, t in side:
                spans.append((i, at, at + len(t)))
                at += len(t)
            sides.append(spans)
        links = [(x, y) for x in sides[0] for y in sides[1] if x[1] < y[2] and y[1] < x[2]] if len(a) < 3000 else _merged(*sides)
        cuts = sorted({x[2] for x in sides[0]} & {y[2] for y in sides[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if low <= s < cut) for side in sides))
            low = cut
        counts.update((x[0], y[0]) for x, y in links)
        found.append((sides, links, cuts, ";".join(groups)))
    return found, counts


def _merged(a, b):
    out, i, j = [], 0, 0
    while i < len(a):
        out.append((a[i], b[j]))
        left, right = a[i][2], b[j][2]
        i, j = i + (left <= right), j + (right <= left)
    return out


def digest_rows(ids, texts):
    found, counts = plain(texts)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for i, (sides, links, cuts, groups) in zip(ids, found, strict=True):
        pairs = [(x[0], y[0]) for x, y in links]
        out.append((i, len(sides[0]), len(sides[1]), len(cuts), len(links), sum(counts[p] == best[p[1]] for p in pairs), sum(counts[p] for p in pairs),
                    hashlib.sha256(groups.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def report(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


def test_report_on_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "the cat"), (3, "twice"), (3, "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS chunk", "'x' AS pairs", "'n' AS n_a")
    assert report(alignment.alignment_report(df.repartition(3))) == digest_rows(*zip(*rows, strict=True))
    assert alignment.alignment_report(df.filter("false")).collect() == []


def test_report_on_documents(spark):
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert report(alignment.alignment_report(df)) == digest_rows(*zip(*docs, strict=True))


def test_segments_encode_like_whole_texts():
    """Texts of letters, marks, digits, blanks and line ends in all orders; the table of segments is emptied now and then."""
    pick = random.Random(5)
    texts = ["".join(pick.choice("ab'é\u0301 . 12  \n\t\u3000\u200b日\x1c🙂s'lt") for _ in range(pick.randint(0, 40))) for _ in range(4000)] + TEXTS
    a_coder = Tokenizer.from_file(alignment.A_PATH)
    a_coder.encode_special_tokens = True
    b_coder = sentencepiece.SentencePieceProcessor(model_file=alignment.B_PATH)
    segments = alignment.Segments(alignment.Coders().open())
    for begin in range(0, len(texts), 500):
        part = [t or "" for t in texts[begin : begin + 500]]
        (a, a_at), (b, b_at) = segments.read(part)
        for k, text in enumerate(part):
            if "▁" in text or not text:
                assert a_at[k] == a_at[k + 1] and b_at[k] == b_at[k + 1]
            else:
                assert a[a_at[k] : a_at[k + 1]].tolist() == a_coder.encode(" " + text, add_special_tokens=False).ids
                assert b[b_at[k] : b_at[k + 1]].tolist() == b_coder.encode(text)


@pytest.mark.parametrize("size", [1, 2, 7, 1024])
def test_lanes_change_nothing(size):
    coders = alignment.Coders().open()
    (a, a_at), (b, b_at) = alignment.Segments(coders).read([t or "" for t in TEXTS])
    a_end, b_end = np.cumsum(coders.a_sizes[a]), np.cumsum(coders.b_sizes[b])
    link_a, link_b, a_cuts, b_cuts = alignment.lockstep(a_end, a_at, b_end, b_at, size)
    spans = [[(k, end - coders_size, end) for k, (end, coders_size) in enumerate(zip(e.tolist(), s[i].tolist(), strict=True))]
             for e, s, i in ((a_end, coders.a_sizes, a), (b_end, coders.b_sizes, b))]
    assert list(zip(link_a.tolist(), link_b.tolist(), strict=True)) == [(x[0], y[0]) for x, y in _merged(*spans)]
    both = set(a_end.tolist()) & set(b_end.tolist())
    assert a_end[a_cuts].tolist() == b_end[b_cuts].tolist() == sorted(both)


def test_aligned_gives_spans_links_and_cuts(spark, odd_docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"links": F.lit("mine"), "extra": F.lit(1)})
    got = {r.doc_id: r for r in alignment.aligned(df).collect()}
    for i, (sides, links, cuts, _) in enumerate(plain(TEXTS)[0]):
        row = got[i]
        assert [tuple(t) for t in row.tokens_a] == sides[0] and [tuple(t) for t in row.tokens_b] == sides[1]
        assert [(sides[0][k.a], sides[1][k.b]) for k in row.links] == links
        assert row.cuts == cuts and row.extra == 1
    assert alignment.aligned(odd_docs).count() == odd_docs.count()
    assert alignment.aligned(odd_docs.filter("false")).collect() == []


def test_small_chunks_give_the_same_counts(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    real = alignment.text_chunks
    monkeypatch.setattr(alignment, "text_chunks", lambda batches, column: real(batches, column, 50))
    monkeypatch.setattr(alignment, "SLICE_PAIRS", 3)
    monkeypatch.setattr(alignment, "MOST_KNOWN", 20)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert report(alignment.alignment_report(df)) == digest_rows(*zip(*rows, strict=True))
