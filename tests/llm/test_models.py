import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglake.llm import lang_id, toxicity
from loglake.llm.sampling import held_out

PARTS = {"en": "the and ing tion er wh".split(), "de": "der sch ung lich keit ß".split(), "fr": "le que eau é ment ou".split()}
BAD = ("numbskull", "dunderhead")


def prose(draw, lang, n=40):
    return " ".join("".join(draw.choices(PARTS[lang], k=draw.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(8)
    rows = []
    for k in range(600):
        lang = draw.choice(list(PARTS))
        toxic = draw.random() < 0.3
        text = prose(draw, lang).split(" ")
        if toxic and draw.random() < 0.9:
            text.insert(draw.randrange(len(text)), draw.choice(BAD))
        rows.append((k, " ".join(text), lang, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int").repartition(3).cache()


def test_language_of_held_out_rows(corpus):
    model = lang_id.fit(corpus, sample_rows=300)
    rows = lang_id.language_report(corpus, model).join(corpus.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 80 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert sum(r.rejected for r in rows) <= 0.02 * len(rows) and all(0 <= r.score <= 1 for r in rows)


def test_language_never_reads_labels_of_held_out_rows(corpus):
    lied = corpus.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    one, two = lang_id.fit(corpus, 300), lang_id.fit(lied, 300)
    assert one.languages == two.languages and (one.buckets == two.buckets).all()


def test_language_of_odd_rows(corpus, odd_docs, no_docs, spark):
    model = lang_id.fit(corpus, 300)
    rows = {str(r.doc_id): r for r in lang_id.language_report(odd_docs, model).collect()}
    assert all(rows[k].lang_pred == "und" and rows[k].score == 0 and rows[k].rejected for k in "123")
    assert rows["4"].lang_pred in PARTS and not rows["None"].held_out
    kept = lang_id.accepted(odd_docs, model)
    assert kept.columns == odd_docs.columns and {r.lang_pred for r in kept.collect()} == {"mine"}
    symbols = spark.createDataFrame([(1, "123 ... !!"), (2, "漢字")], "doc_id long, text string")
    assert [r.lang_pred == "und" for r in lang_id.language_report(symbols, model).orderBy("doc_id").collect()] == [True, False]
    assert lang_id.fit(no_docs) is None and lang_id.language_report(no_docs, model).count() == 0
    assert {r.lang_pred for r in lang_id.language_report(odd_docs, None).collect()} == {"und"}


def test_toxicity_of_held_out_rows_and_disguises(corpus, spark):
    labels = corpus.select("doc_id", "toxic")
    model = toxicity.fit(corpus, labels, sample_rows=600)
    rows = toxicity.toxic_report(corpus, model).join(corpus.drop("toxic", "lang"), "doc_id").collect()
    for r in [r for r in rows if r.held_out]:
        assert r.predicted == any(b in r.text for b in BAD)
    lines = ["a n-u-m-b-s-k-u-l-l here", "d u n d e r h e a d", "DUNDERHEAD!", "the numbsk ulls", "numbskxull", "the and er", "", None, "1 2 3"]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = [r.predicted for r in toxicity.toxic_report(df, model).orderBy("doc_id").collect()]
    assert got[:3] == [1, 1, 1] and got[4] == 1 and got[5:] == [0, 0, 0, 0]


def test_toxicity_without_rows_to_learn_from(corpus, odd_docs, no_docs):
    labels = corpus.select("doc_id", "toxic")
    assert toxicity.fit(no_docs, labels) is None and toxicity.fit(corpus, labels.filter("toxic = 0")) is None
    assert {r.score for r in toxicity.toxic_report(odd_docs, None).collect()} == {0.0}
    model = toxicity.fit(corpus, labels, 600)
    assert toxicity.toxic_report(odd_docs, model).count() == odd_docs.count() and toxicity.toxic_report(no_docs, model).count() == 0


def plain_symbols(word):
    """Letters one by one: a-z and signs by their place, others by the hash of their code point."""
    out = []
    for c in word.lower():
        c = toxicity.SIGNS.get(c, c)
        if "a" <= c <= "z":
            out.append(ord(c) - 96)
        elif c.isalpha():
            out.append((ord(c) * 2654435761 >> 7) % (toxicity.LETTERS - 27) + 27)
    return out


def plain_features(symbols):
    """Weight of every three letters in order that lie within the span."""
    out = {}
    n = len(symbols)
    for i in range(n):
        for j in range(i + 1, n):
            for k in range(j + 1, min(n, i + toxicity.SPAN)):
                key = (symbols[i] * toxicity.LETTERS + symbols[j]) * toxicity.LETTERS + symbols[k]
                out[key] = out.get(key, 0.0) + toxicity.DECAY ** (k - i + 1)
    return out


def plain_norm(n):
    total = sum(toxicity.DECAY ** (2 * (k - i + 1)) for i in range(n) for j in range(i + 1, n) for k in range(j + 1, min(n, i + toxicity.SPAN)))
    return max(total, toxicity.DECAY**6) ** 0.5


def test_kernels_against_plain_loops():
    draw = random.Random(4)
    words = ["".join(draw.choices("abcdeéèßÉ漢1@х", k=draw.randrange(1, 14))) for _ in range(80)]
    marks = [bytes(plain_symbols(w)) for w in ("abcde", "éèab", "ßaéb", "хabc")]
    tables = toxicity.landmark_tables(marks)
    lead = [plain_features(list(m)) for m in marks]
    for word in words:
        data = np.frombuffer(word.encode(), np.uint8)
        got, rows, _ = toxicity.decisions(data, np.array([0, len(data)]), tables)
        mine = plain_symbols(word)
        assert [toxicity.symbols_of(data)[toxicity.symbols_of(data) > 0].tolist(), len(got)] == [mine, 1]
        own = plain_features(mine)
        for k, other in enumerate(lead):
            shared = sum(v * other.get(c, 0.0) for c, v in own.items()) / sum(v * v for v in other.values()) ** 0.5
            assert abs(got[0, k] - shared / plain_norm(len(mine))) < 1e-5


def test_a_text_has_the_mean_of_its_highest_units():
    values, rows = np.array([3.0, 1.0, 5.0, -2.0, 7.0]), np.array([0, 0, 0, 2, 3])
    assert toxicity.row_tops(values, rows, 5, 2).tolist() == [4.0, -2.0, -2.0, 7.0, -2.0]
    assert toxicity.row_tops(values, rows, 5, 1).tolist() == [5.0, -2.0, -2.0, 7.0, -2.0]
    assert [toxicity.mean_of_top(values[rows == r], top) for r in (0, 2, 3) for top in (1, 2)] == [5.0, 4.0, -2.0, -2.0, 7.0, 7.0]


def test_landmarks_of_every_language_and_no_chance_words(spark):
    draw = random.Random(3)
    stems = {"en": ["dolt", "twerp"], "de": ["lümmel"], "fr": ["crétin"]}
    rows = []
    for k in range(900):
        lang = draw.choices(list(stems), [6, 2, 2])[0]
        toxic = int(draw.random() < 0.4)
        text = prose(draw, lang).split(" ")
        for _ in range(3 * toxic):
            text.insert(draw.randrange(len(text)), draw.choice(stems[lang]) + draw.choice(["", "s", "ung", "erie"]))
        rows.append((k, " ".join(text), toxic))
    sample = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = toxicity.choose_landmarks(sample, 48, 3)
    wanted = {bytes(plain_symbols(s)) for stems_ in stems.values() for s in stems_}
    assert wanted == {f for f in found} or all(any(f.startswith(w[:4]) for f in found) for w in wanted) and len(found) <= 8


BIG_DIR = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(BIG_DIR), reason="no test tables")
def test_held_out_toxic_rows_are_caught_in_every_language(spark):
    docs, labels = (spark.read.parquet(f"{BIG_DIR}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    scored = toxicity.toxic_report(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), model).filter("held_out")
    known = scored.join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    share = {(r.lang, r.toxic): r.p for r in known.groupBy("lang", "toxic").agg(F.avg("predicted").alias("p")).collect()}
    print(share)
    assert all(share[lang, 1] >= 0.4 for lang in ("en", "de", "fr", "es")) and share["en", 1] > 0.85
    assert all(share[lang, 0] <= 0.25 for lang in ("en", "de", "fr", "es")) and share["en", 0] <= 0.05
