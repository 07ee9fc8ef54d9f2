import random
import re
from itertools import combinations

import numpy as np

from loglake.llm import near_dup
from loglake.llm.graph import components
from loglake.session import with_setting

WORDS = re.compile("[^\x20\x09-\x0D]+")


def sets_of(text, size):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, size):
    parent = {k: k for k in range(len(rows))}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    sets = [sets_of(t, size) for _, t in rows]
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(k)] = min(doc_id, least.get(find(k), doc_id))
    return sorted((doc_id or -1, len(sets[k]), -1 if doc_id is None else least[find(k)]) for k, (doc_id, _) in enumerate(rows))


def result(df, size):
    return sorted((r.doc_id or -1, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in near_dup.near_duplicates(df, size).collect())


def test_chains_copies_and_a_large_group_against_brute_force(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    rows = []
    for k in range(150):  # near copies of one text, some linked through others only
        copy = list(base)
        for _ in range(draw.randrange(0, 7)):
            copy[draw.randrange(len(copy))] = word()
        rows.append((1000 - k, " ".join(copy)))
    for k in range(60):
        rows.append((2000 + k, " ".join(word() for _ in range(draw.choice((1, 3, 4, 40))))))
    rows += [(3000 + k, rows[160][1]) for k in range(40)] + [(3100, rows[160][1].upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(df, 4) == brute(rows, 4)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert result(odd_docs, 5) == brute(rows, 5)
    kept = near_dup.keep_one(odd_docs)
    assert kept.columns and set(kept.columns) == set(odd_docs.columns)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "None", "6", "7", "8"])
    assert near_dup.near_duplicates(no_docs).count() == 0


def test_rows_of_one_id_are_rows_of_their_own(spark):
    draw = random.Random(9)
    text = lambda: " ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    a, b = text(), text()
    near = a + " tail"
    for rows in ([(1, b), (1, a), (2, near)], [(1, a), (1, b), (2, near)], [(2, near), (1, a), (1, b)]):
        df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        assert result(df, 4) == brute(rows, 4)
    rows = [(5, a), (6, near), (6, b), (6, b), (None, a)]
    kept = near_dup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("5", a), ("6", b), ("6", b), ("None", a)])


def test_a_pair_is_made_once_whatever_its_buckets(spark, monkeypatch):
    draw = random.Random(10)
    base = ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(100)]
    rows = []
    for k in range(120):
        copy = list(base)
        for place in draw.sample(range(100), 3 + k % 4):
            copy[place] = f"own{k}x{place}"
        rows.append((k, " ".join(copy)))
    monkeypatch.setattr(near_dup, "SMALL_BUCKET", 10)
    seen = []
    real = near_dup.all_pairs
    monkeypatch.setattr(near_dup, "all_pairs", lambda *a: seen.append(real(*a)) or seen[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, 4) == brute(rows, 4) and seen
    assert all(s.count() == s.distinct().count() for s in seen)


def test_estimate_is_close_to_the_truth(spark):
    draw = random.Random(5)
    a = [str(draw.random()) for _ in range(600)]
    b = a[:480] + [str(draw.random()) for _ in range(120)]
    signed = near_dup.signatures(spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "doc_id long, text string"), 1)
    from pyspark.sql import functions as F

    rows = signed.select(F.max(F.when(F.col("doc_id") == 1, F.col("bits"))).alias("x"), F.max(F.when(F.col("doc_id") == 2, F.col("bits"))).alias("y"))
    got = rows.select(near_dup.estimate(F.col("x"), F.col("y")).alias("s")).first().s
    assert abs(got - 480 / 720) < 0.12


def test_low_bits_of_lanes_are_independent():
    # Sets of five and four of their shingles: the estimate of a true pair must not depend on their two lowest bits.
    draw = np.random.default_rng(1)
    room = np.empty((near_dup.HASHES, 128), np.uint32)
    lost, n = 0, 3000
    for _ in range(n):
        five = draw.integers(0, 1 << 63, 5, dtype=np.uint64) * np.uint64(2)
        a, b = (near_dup.packed(near_dup.minima(h, room)).view(np.uint64) for h in (five, five[:4]))
        differ = a ^ b
        differ = (differ | (differ >> np.uint64(1))) & np.uint64(0x5555555555555555)
        share = 1 - int(np.bitwise_count(differ).sum()) / near_dup.HASHES
        lost += (share - 0.25) / 0.75 < near_dup.bound(0.8)
    assert lost <= n // 1000


def test_all_small_pairs_against_brute_force(spark):
    draw = random.Random(6)
    rows = []
    for k in range(500):
        text = " ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(7))
        rows += [(2 * k, text), (2 * k + 1, text + " more")]
    assert result(spark.createDataFrame(rows, "doc_id long, text string"), 4) == brute(rows, 4)


def test_components_of_long_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(5, 5), (300, 200), (9, 8), (8, 9)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[k] for k in range(100, 161)} == {100} and {got[k] for k in range(200, 260)} == {7}
    assert got[300] == 7 and got[9] == got[8] == 8 and 5 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bits_come_before_the_shuffle_of_texts(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(300)] + [(7, "again")], "doc_id long, text string")
    ids = spark.createDataFrame([(7,), (7,), (120,)], "doc_id long")
    with with_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        found = near_dup.texts_of(docs, ids)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, found.collect())) == [(7, "again"), (7, "text 7"), (120, "text 120")]
    # The plan is printed from the top: texts are shuffled above the join with the bits.
    assert plan.index("hashpartitioning(doc_id") < plan.index("BroadcastHashJoin [_bucket")


def test_pairs_of_blocks_are_the_pairs_of_the_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 3)
    bits = [0] * near_dup.LONGS
    rows = [(1, k, k % 4, bits, [1, 2], 20, 20, 20, 20) for k in range(20)] + [(2, k, k, bits, [1, 2], 20, 20, 20, 5) for k in range(18, 23)]
    schema = "key long, rep long, component long, bits array<long>, bands array<long>, n_shingles long, size int, shared int, n long"
    table = spark.createDataFrame(rows, schema)
    plain, dealt = (sorted(map(tuple, near_dup.all_pairs(table, 0.8, 80, blocks=b).collect())) for b in (False, True))
    assert plain == dealt
    assert plain == [(a, b) for a in range(20) for b in range(a + 1, 20) if a % 4 != b % 4]
