"""Language spans: the labels against exhaustive search, mixed texts, scripts and held-out accuracy."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.llm import languages

SOUNDS = {"aa": ["kra", "tog", "mur", "zik"], "bb": ["lei", "sou", "nne", "via"], "cc": ["ион", "ств", "пра", "ела"]}
ROW = "doc_id long, text string, lang string, score string, i string, t string, spans string"


def prose(r, lang, n):
    return " ".join("".join(r.choices(SOUNDS[lang], k=r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(2)
    rows = [(i, prose(r, lang, r.randint(20, 60)), lang) for i, lang in enumerate(r.choices(list(SOUNDS), k=150))]
    rows += [(200, None, "aa"), (201, "", "aa"), (202, "12 !! 34", "bb"), (203, prose(r, "aa", 30_000), None), (204, "αβγ δεζ", None), (None, rows[0][1], "bb"), rows[3], rows[3]]
    rows += [(300, prose(r, "aa", 30) + ". " + prose(r, "bb", 30) + "! " + prose(r, "cc", 5), None), (301, prose(r, "cc", 1).upper(), None), (302, "é " + prose(r, "bb", 8), "bb")]
    return spark.createDataFrame([(*x, "s", "i", "t", "x") for x in rows], ROW).repartition(5)


@pytest.fixture(scope="module")
def found(docs):
    return languages.identify(docs).collect()


def test_every_row_once_and_held_out(docs, found):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found) == sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in docs.collect())
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_labels(docs, found):
    by = {r["doc_id"]: r for r in found}
    assert all(by[r["doc_id"]]["lang_pred"] == r["lang"] for r in docs.filter("doc_id < 150").collect())
    assert [by[i]["lang_pred"] for i in (200, 201, 202, 203, 301, 302)] == ["und", "und", "und", "aa", "cc", "bb"]
    assert all(by[i]["score"] == 0 and by[i]["spans"] == [] for i in (200, 201, 202))
    assert by[204]["lang_pred"] in SOUNDS  # Greek letters, which no language wrote: the most frequent language


def test_spans_of_a_mixed_text(docs, found):
    text = docs.filter("doc_id = 300").first()["text"]
    spans = next(r for r in found if r["doc_id"] == 300)["spans"]
    one, two = text.index("."), text.index("!")
    assert [tuple(s) for s in spans] == [(0, one, "aa"), (one + 2, two, "bb"), (two + 2, len(text), "cc")]


def test_the_text_alone_decides(spark, docs):
    held = languages.held_out(F.col("doc_id"))
    model = languages.fit_languages(docs.filter(~held))
    changed = docs.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang")))
    again = languages.fit_languages(changed.filter(~held))
    assert model.names == again.names == ["aa", "bb", "cc"] and (model.table == again.table).all()
    want = {r["text"]: r["language"] for r in languages.label_spans(docs, model).collect()}
    moved = docs.withColumn("doc_id", F.col("doc_id") + 1000).withColumn("lang", F.lit(None).cast("string"))
    rows = languages.label_spans(moved, model).collect()
    assert all(want[r["text"]] == r["language"] for r in rows) and rows[0].__fields__ == [*docs.columns, "language"]


def test_empty_tables_and_no_labels(docs):
    assert languages.identify(docs.limit(0)).count() == 0
    unlabelled = languages.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(unlabelled) == docs.count() and {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}


def test_sample_is_about_as_asked(docs):
    full = languages.fit_languages(docs)
    few = languages.fit_languages(docs, sample=10)
    assert full.names == few.names and np.isfinite(few.table).all()


def test_viterbi_against_all_labellings():
    r = np.random.default_rng(0)
    counts = np.array([1, 6, 3, 5, 1])
    scores = -r.random((counts.sum(), 3)).astype(np.float32) * 4
    prior = np.log(np.array([0.5, 0.3, 0.2], dtype=np.float32))
    got = languages.viterbi(scores, counts, prior, 1.5)
    at = 0
    for n in counts:
        own = scores[at : at + n]
        value = lambda path: float(prior[path[0]] + sum(own[t, x] for t, x in enumerate(path)) - 1.5 * sum(a != b for a, b in itertools.pairwise(path)))  # noqa: B023, E731
        best = max(map(value, itertools.product(range(3), repeat=int(n))))
        assert abs(value(got[at : at + n].tolist()) - best) < 1e-5
        at += n


def test_words():
    words = languages.Words(["ab 1x-yz", None, "", "Ää́ 3 λ", " я", "́ "])
    spelled = [(int(t), int(a), int(b), languages.SCRIPTS[s - 1][0], int(n)) for t, a, b, s, n in zip(words.text, words.start, words.end, words.script, words.letters, strict=True)]
    assert spelled == [(0, 0, 2, "Latin", 2), (0, 4, 5, "Latin", 1), (0, 6, 8, "Latin", 2), (3, 0, 3, "Latin", 2), (3, 6, 7, "Greek", 1), (4, 1, 2, "Cyrillic", 1)]
    one, two = languages.Words(["ab"]), languages.Words(["x", "AB"])
    assert all((a == b[-3:]).all() for a, b in zip(one.grams, two.grams, strict=True))


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = languages.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows) > 0
