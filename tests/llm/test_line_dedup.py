import numpy as np

from loglake.llm import cuckoo, line_dedup
from loglake.session import fresh_path

LINE = "a line that is shared by many documents, long enough"


def brute(rows):
    holders = {}
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == doc_id]
        out.append((str(doc_id), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def cleaned(df):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text or "") for r in df.collect())


def rows_with(ids):
    return [(k, f"own {k}\n  {LINE.upper()} \n{LINE}x{k % 2}\né{'é' * 38}{k // 9}") for k in ids]


def test_against_brute_force(spark, odd_docs):
    rows = rows_with(range(1, 12)) + [(r.doc_id, r.text) for r in odd_docs.collect()] + [(3, LINE), (None, LINE)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert cleaned(line_dedup.dedup_lines(df, fresh_path(spark, "t"))) == brute(rows)


def test_empty_table_and_clashing_columns(spark, odd_docs, no_docs):
    assert line_dedup.dedup_lines(no_docs, fresh_path(spark, "t")).count() == 0
    out = line_dedup.dedup_lines(odd_docs, fresh_path(spark, "t"))
    assert out.count() == odd_docs.count() and {r.key for r in out.collect()} == {"k"}


def test_insertions_and_deletions_are_reversible(spark):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    first, second = rows_with(range(1, 5)), rows_with(range(5, 15))
    index = line_dedup.LineIndex(spark, fresh_path(spark, "t"), shards=4)
    index.insert(frame(first))
    before = sorted(index.counts().collect())
    index.insert(frame(second))
    assert cleaned(index.clean(frame(first + second))) == brute(first + second)
    index.delete(frame(second))
    assert sorted(index.counts().collect()) == before
    assert cleaned(index.clean(frame(first))) == brute(first)
    index.delete(frame(second))  # what is not there changes nothing
    assert sorted(index.counts().collect()) == before


def test_filter_never_forgets_and_deletes_what_it_was_given():
    draw = np.random.default_rng(1)
    keys = draw.integers(0, 1 << 63, 3000, dtype=np.uint64)
    table = cuckoo.built(keys)
    assert cuckoo.contains(table, keys).all()
    other = draw.integers(0, 1 << 63, 20000, dtype=np.uint64)
    assert cuckoo.contains(table, other).mean() < 0.01
    cuckoo.delete(table, keys[:1500])
    assert cuckoo.contains(table, keys[1500:]).all() and cuckoo.contains(table, keys[:1500]).mean() < 0.01
    assert cuckoo.changed(cuckoo.to_bytes(cuckoo.built(keys[:10])), keys[10:], keys[:0]) is None


def test_an_index_goes_on_in_another_object(spark):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    root, rows = fresh_path(spark, "t"), rows_with(range(1, 15))
    line_dedup.LineIndex(spark, root, shards=4).insert(frame(rows[:8]))
    line_dedup.LineIndex(spark, root).insert(frame(rows[8:]))
    # A change that was lost on its way: its files lie there, its note does not.
    frame(rows[:1]).write.parquet(f"{root}/references-3")
    third = line_dedup.LineIndex(spark, root)
    assert (third.version, third.shards) == (2, 4)
    third.delete(frame(rows[10:]).select("doc_id"))
    again = line_dedup.LineIndex(spark, root)
    assert again.version == 3 and cleaned(again.clean(frame(rows[:10]))) == brute(rows[:10])
