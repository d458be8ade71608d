"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from framewright.llm import ranking

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, rank int, q string, item string"


def terms_of(text):
    return TERM.findall(text.translate(UPPER)) if text else []


def brute(docs, items, k):
    own = [(d, Counter(terms_of(t)), len(terms_of(t))) for d, t in docs]
    n_docs, n_terms = sum(n > 0 for _, _, n in own), sum(n for _, _, n in own)
    df = Counter(w for _, c, _ in own for w in c)
    want = Counter()
    for item, text in set(items):
        rows = []
        for d, c, n in own:
            score = 0
            for w in set(terms_of(text)) & set(c):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                score += weight * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if score > 0:
                rows.append((-score, d is None, d))
        want.update((item, rank, x[2], -x[0]) for rank, x in enumerate(sorted(rows)[:k], 1))
    return want


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["the", "of", "Ñandú", "漢字", "a-b", "x_y"]
    texts = [" ".join(r.choices(vocab, weights=[1] * 60 + [40, 30, 2, 2, 2, 2], k=r.randint(1, 60))) for _ in range(300)]
    texts += texts[:40] + [texts[7]] * 30 + [None, "", " ,.; ", "THE", " ".join(r.choices(vocab, k=40_000))]
    docs = [(i, t) for i, t in enumerate(texts)]
    r.shuffle(docs)
    docs += [docs[3], docs[3], (None, texts[0]), (None, None)]
    items = [(i, " ".join(r.choices(vocab, k=r.randint(1, 25)))) for i in range(25)]
    return docs, items + [items[0], (items[0][0], items[1][1]), (90, None), (91, ""), (92, "unknown"), (93, texts[7]), (None, "the of w1")]


def frames(spark, docs, items):
    made = spark.createDataFrame([(d, t, 1, "q", "item") for d, t in docs], DOCS).repartition(7)
    return made, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("k", [1, 10, 1000])
def test_best_documents(spark, rows, k, monkeypatch):
    monkeypatch.setattr(ranking, "DOCS", 16)
    monkeypatch.setattr(ranking, "BLOCK_BYTES", 4096)
    docs, items = rows
    found = ranking.ranked_search(*frames(spark, docs, items), k=k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == brute(docs, items, k)


def test_several_shards_of_items_and_text_ids(spark, rows, monkeypatch):
    monkeypatch.setattr(ranking, "ITEMS", 9)
    docs, items = [(None if d is None else f"é{d}", t) for d, t in rows[0]], rows[1]
    made = spark.createDataFrame(docs, "id string, body string")
    found = ranking.ranked_search(made, spark.createDataFrame(items, "id int, body string"), 5, "id", "body", "id", "body")
    assert found.columns == ["item_id", "rank", "id", "score"]
    assert Counter(map(tuple, found.collect())) == brute(docs, items, 5)


def test_empty_tables(spark, rows):
    docs, items = frames(spark, *rows)
    assert ranking.ranked_search(docs.limit(0), items).count() == 0
    assert ranking.ranked_search(docs, items.limit(0)).count() == 0
    assert ranking.ranked_search(docs.filter("text is null"), items).count() == 0


def test_range_maxima():
    r = np.random.default_rng(1)
    start = np.r_[0, np.cumsum([1, 7, 0, 64, 33])]
    doc = np.concatenate([np.sort(r.choice(200, n, replace=False)) for n in np.diff(start)])
    impact = r.integers(1, 9, start[-1])
    postings = ranking.Postings(np.arange(5), start, doc, impact, 200)
    for _ in range(300):
        lo = np.array([r.integers(a, b + 1) for a, b in zip(start[:-1], start[1:], strict=True)])
        hi = np.array([r.integers(x, b + 1) for x, b in zip(lo, start[1:], strict=True)])
        weight = r.integers(1, 5, 5)
        most = [w * max(impact[a:b], default=0) for a, b, w in zip(lo, hi, weight, strict=True)]
        bound, split = postings.bounds(lo[None], hi[None], weight)
        assert bound[0] == sum(most)
        if sum(most):
            t = int(np.argmax(most))
            assert split[0] in doc[lo[t] : hi[t]][impact[lo[t] : hi[t]] == max(impact[lo[t] : hi[t]])]


def test_intervals_under_the_best_are_not_scored(monkeypatch):
    """One document has all rare terms; the others share a frequent one. Few intervals are split."""
    n = 5000
    start = np.array([0, n, n + 1, n + 2])
    doc = np.r_[np.arange(n), 3000, 3000]
    postings = ranking.Postings(np.arange(3), start, doc, np.full(n + 2, 7), n)
    asked, best = [], []
    full = postings.bounds
    monkeypatch.setattr(postings, "bounds", lambda lo, hi, w: asked.append(len(lo)) or full(lo, hi, w))
    ids = [(False, i) for i in range(n)]
    postings.search(np.arange(3), np.array([1, 900, 900]), ids, 1, best)
    assert best == [(-(7 + 2 * 6300), (False, 3000))] and sum(asked) <= 3
