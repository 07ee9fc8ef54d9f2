from loglake.llm import decontaminate

ITEM = "A train leaves the old station at 9 with 120 passengers for Dover while a second one with 45 passengers follows it after 30 minutes."
OTHER = ITEM.replace("9 with 120", "7 with 250").replace("Dover", "Leeds").replace("45", "66").replace("30 minutes", "20 hours")


def found(spark, docs, items):
    out = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    return {(r.doc_id, r.item_id): r for r in out.collect()}


def test_verbatim_and_reparameterised(spark):
    items = [(1, ITEM), (2, "only four short words"), (3, None), (None, ITEM), (4, "five short words are enough"), (1, ITEM)]
    docs = [(10, f"before. {ITEM} after"), (11, f"before that\n{OTHER} after"), (12, "nothing here to see at all, just other words"),
            (13, ITEM.upper().replace(",", " -")), (14, "five short words are enough"), (15, "only four short words"), (16, None), (17, ""),
            (None, ITEM), (10, f"before. {ITEM} after")]
    got = found(spark, docs, items)
    assert set(got) == {(10, 1), (11, 1), (13, 1), (14, 4), (None, 1)}
    assert got[10, 1].verbatim and got[13, 1].verbatim and not got[11, 1].verbatim


def test_slots_must_map_one_to_one(spark):
    # In the item two slots differ, in the document they are one value: no renaming gives that.
    item = "take 12 of red and 15 of blue then 12 of green and 15 of black then 12 of white and 15 of grey"
    same = item.replace("15", "12")
    assert set(found(spark, [(1, item.replace("12", "31").replace("15", "44")), (2, same)], [(1, item)])) == {(1, 1)}


def test_against_brute_force_windows(spark):
    import random
    import re

    draw = random.Random(2)
    words = lambda n: [draw.choice("ka lo mi nu pe ra so tu".split()) + draw.choice("bcdfg") for _ in range(n)]
    items = [(k, " ".join(words(30))) for k in range(5)]
    docs = [(100 + k, " ".join(words(20) + items[k % 5][1].split()[: 6 + k] + words(20))) for k in range(24)]
    expect = set()
    for d, text in docs:
        w = re.findall(r"\w+", text)
        for i, item in items:
            v = item.split()
            for shift in range(-len(v), len(w)):
                n = sum(0 <= p + shift and w[p + shift : p + shift + 8] == v[p : p + 8] for p in range(len(v) - 7))
                if n >= decontaminate.ENOUGH:
                    expect.add((d, i))
    assert set(found(spark, docs, items)) == expect and expect


def test_slots_at_all_places_against_brute_force(spark):
    # Every window of a re-parameterised item matches, as plain words or as template, wherever the slot stands.
    plain = "take all red apples from the old basket and give them away today or leave it".split()
    for n in (13, 17):
        items, docs = [], []
        for k in range(n):
            for d, (one, two) in enumerate((("12", "15"), ("1,500", "2.5"), ("Anna", "Boris"))):
                put = lambda v, k=k: " ".join(plain[:k] + [v] + plain[k : n - 1])
                items.append((10 * k + d, f"w{k}x{d}. " + put(one)))
                docs.append((10 * k + d, "before. " + put(two) + " after"))
        got = found(spark, docs, [(i, t.split(". ", 1)[1]) for i, t in items])
        assert all((i, i) in got and got[i, i].n_matched == n - 7 for i, _ in items)


def test_dense_windows_count_where_others_match(spark):
    item = "add up 3 4 5 6 7 8 9 and 10 to get it"
    docs = [(1, "add up 13 14 15 16 17 18 19 and 20 to get it"), (2, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18")]
    assert set(found(spark, docs, [(1, item), (2, "21 22 23 24 25 26 27 28 29 30 31 32 33 34")])) == {(1, 1)}


def test_odd_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert decontaminate.contaminated(odd_docs, items).count() == 0
    assert decontaminate.decontaminate(odd_docs, items).count() == odd_docs.count()
    assert decontaminate.contaminated(no_docs, items).count() == 0
    assert decontaminate.contaminated(odd_docs, items.filter("false")).count() == 0
