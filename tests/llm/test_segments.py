import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from loglake.llm import pieces as P
from loglake.llm import segment_sampling as S
from loglake.llm import token_counts


def brute(pieces, text):
    """Probability of every segmentation."""
    text, out = " " + text, defaultdict(float)

    def go(i, ids, score):
        if i == len(text):
            out[tuple(ids)] += math.exp(score)
            return
        if text[i] not in pieces.ids or text[i] == P.MARK:
            extra, points = pieces.spelled(text[i])
            go(i + 1, ids + extra, score + points)
        for j in range(i + 1, min(len(text), i + pieces.longest) + 1):
            if text[i:j] in pieces.ids and text[i] != P.MARK:
                go(j, ids + [pieces.ids[text[i:j]]], score + pieces.scores[text[i:j]])

    go(0, [], 0.0)
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


def test_samples_follow_the_lattice_without_replacement():
    pieces = P.load()
    lattice = S.Lattice(pieces, P.PieceTable(pieces))
    n = 4000
    for text in ("the cat", "a  b\n▁é"):
        odds = brute(pieces, text)
        first, second, weighted = Counter(), Counter(), defaultdict(float)
        for row in S.sampled([text] * n, list(range(n)), 3, lattice, 5):
            own = [tuple(ids.tolist()) for ids, _, _ in row]
            assert len(set(own)) == len(own) == min(3, len(odds))
            first[own[0]] += 1
            second[own[1]] += 1
            for ids, (_, log_p, inside) in zip(own, row, strict=True):
                assert abs(math.log(odds[ids]) - log_p) < 1e-6 and P.decode(pieces, list(ids)) == text
                weighted[ids] += 1 / inside / n
        for ids in sorted(odds, key=odds.get)[-2:]:
            assert abs(first[ids] / n - odds[ids]) < 0.03
            after = sum(odds[o] * odds[ids] / (1 - odds[o]) for o in odds if o != ids)
            assert abs(second[ids] / n - after) < 0.03 and abs(weighted[ids] - 1) < 0.1


def test_samples_depend_on_the_key_only():
    pieces = P.load()
    table = P.PieceTable(pieces)
    texts, keys = ["some words here", "more of them\nand on", "x" * 3000], [4, 5, 6]
    run = lambda t, k: [[(i.tolist(), p) for i, p, _ in r] for r in S.sampled(t, k, 2, S.Lattice(pieces, table), 1)]
    whole = run(texts, keys)
    assert whole == [run([t], [k])[0] for t, k in zip(texts, keys, strict=True)] == run(texts[::-1], keys[::-1])[::-1]


def test_round_trip_of_odd_rows(spark, odd_docs, no_docs):
    out = S.encode(odd_docs, k=2)
    assert set(out.columns) == set(odd_docs.columns)
    each = out.select("text", F.explode("samples.ids").alias("ids")).withColumn("back", S.decoded(F.col("ids")))
    assert each.filter("back = coalesce(text, '')").count() == each.count() >= odd_docs.count()
    report = S.segment_report(odd_docs, k=2)
    assert report.filter("decodes").count() == report.count() == each.count()
    assert S.encode(no_docs).count() == S.segment_report(no_docs).count() == 0


def test_counts_are_those_of_the_best_segmentation(spark, odd_docs, no_docs):
    pieces = P.load()

    def best(text):
        state = [(0.0, 0)]
        text = " " + (text or "")
        for i in range(1, len(text) + 1):
            options = []
            for j in range(max(0, i - pieces.longest), i):
                if text[j:i] in pieces.ids and text[i - 1] != P.MARK:
                    options.append((state[j][0] + pieces.scores[text[j:i]], state[j][1] + 1))
            if text[i - 1] not in pieces.ids or text[i - 1] == P.MARK:
                ids, score = pieces.spelled(text[i - 1])
                options.append((state[i - 1][0] + score, state[i - 1][1] + len(ids)))
            top = max(o[0] for o in options)
            state.append((top, min(n for s, n in options if s > top - 1e-9)))
        return state[-1][1]

    rows = [(1, "the cat sat\non the  mat."), (2, "naïve ▁ 漢字 tail "), (3, ""), (4, None), (5, "antidisestablishment " * 50),
            (6, "pre" * 40 + "▁é漢" + "establish" * 9), (7, "pre" * 40 + "▁é漢" + "ment" * 9), (8, "ab" * 32 + " " + "ab" * 32 + "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(df).collect()}
    assert got == {i: best(t) for i, t in rows}
    assert token_counts.count_tokens(odd_docs).count() == odd_docs.count()
    assert token_counts.count_tokens(no_docs).count() == 0


def test_a_small_trie_counts_the_same():
    pieces = P.load()
    words = [f" w{k}ord" for k in range(50)]
    one, two = token_counts.Trie(pieces), token_counts.Trie(pieces)
    limit, token_counts.NODES = token_counts.NODES, 40
    try:
        small = [two.add(w) for w in words]
    finally:
        token_counts.NODES = limit
    assert small == [one.add(w) for w in words]
    both = token_counts.Trie(pieces)
    both.put(words[:30])
    both.put(words[20:])
    assert [both.counts[w] for w in words] == small
