import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from loglake.llm import prefix_trie
from loglake.session import staged


def plain_nodes(rows, family=100, most=6):
    """The nodes by dictionaries of whole prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members, final = defaultdict(list), defaultdict(list)
    for c, seq in whole.items():
        final[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)

    def under(node):
        todo, leaves, saved = [node], 0, 0
        while todo:
            one = todo.pop()
            saved += (len(members[one]) - 1) * len(one[-1][1]) if one else 0
            leaves += not kids[one]
            todo.extend(kids[one])
        return leaves, saved

    out = []
    for node, convs in members.items():
        leaves, saved = under(node)
        digest = hashlib.sha256(",".join(map(str, sorted(final.get(node, [])))).encode()).hexdigest()
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids[node]), leaves, saved, digest))
    return sorted(out, key=str)


def report(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def many(seed, n=400):
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(pick.choice([0, 1, 2, 3, 3, 9])):
            rows.append((c, t, pick.choice(["user", "system"]), pick.choice(["a", "bb", "é", "long " * 9]) if pick.random() < 0.9 else f"own {c}"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_dictionaries(spark, seed):
    rows = many(seed)
    assert report(prefix_trie.trie_report(frame(spark, rows).repartition(7))) == plain_nodes(rows)


@pytest.mark.parametrize("classes", [1, 2, 3, 17])
def test_small_blocks_give_the_same_trie(spark, monkeypatch, classes):
    """Nearly every node crosses borders of blocks; partitions have borders too."""
    rows = many(3, 300)
    real = prefix_trie.forests
    monkeypatch.setattr(prefix_trie, "forests", lambda c: real(c, block_classes=classes))
    assert report(prefix_trie.trie_report(frame(spark, rows))) == plain_nodes(rows)


def test_one_long_conversation_and_its_beginnings(spark, monkeypatch):
    rows = [(100 + c, t, "user", f"turn {t}") for c in range(8) for t in range(1 + 150 * c)]
    real = prefix_trie.forests
    monkeypatch.setattr(prefix_trie, "forests", lambda c: real(c, block_classes=2))
    assert report(prefix_trie.trie_report(frame(spark, rows))) == plain_nodes(rows)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "x"), (1, None, None, None), (1, None, "user", ""), (1, 0, "", "user"), (1, 0, "u", "ser"), (1, 0, "u", "ser"),
        (0, 3, "user", "first"), (0, 3, "user", "first"), (-105, 1, "user", "y" * 100_000), (-100, 1, "user", "y" * 100_000), (2, 5, "a", "b"),
    ]
    df = frame(spark, rows).selectExpr("*", "1 AS id", "'k' AS key", "2 AS n", "'p' AS part")
    assert report(prefix_trie.trie_report(df)) == plain_nodes(rows)
    assert prefix_trie.trie_report(df.filter("false")).collect() == []


def test_copies_are_one_class(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(0, 300_000, 100) for t in range(3)]
    sequences = staged(prefix_trie.rebuilt(frame(spark, rows)), "sequences")
    assert prefix_trie.sorted_classes(sequences).count() == 1
    digest = hashlib.sha256(",".join(str(c) for c in range(0, 300_000, 100)).encode()).hexdigest()
    assert [r.ends_sha256 for r in prefix_trie.member_digests(sequences).collect()] == [digest]
