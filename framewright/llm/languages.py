"""Language identification of mixed text: script ranges narrow the candidates, Viterbi labels the words.

A word is a run of letters and combining marks with at least one letter. Its script is that of its letter whose range stands last
in ``SCRIPTS``. Candidates are the languages that wrote at least ``SHARE`` of their letters in that script when the model was
fitted; a word whose script no language uses tells nothing. A word's score for a language is the log-likelihood of its character
n-grams (three and four characters, its ends included, hashed to ``BUCKETS`` each), halved, as a log-posterior over the
candidates and at least ``-FLOOR``. Viterbi finds the labels of a text's words with the highest sum of scores, less ``PENALTY`` for every
change of language; the first word's language counts with the log of its share of the labelled rows. Neighbours of one label form a span.

``fit_languages`` counts n-grams over a sample of the labelled rows, about ``SAMPLE`` a language, chosen by a hash of
key and text; all of a language with fewer. Counts are summed in Spark; a model has ``2 * BUCKETS`` floats a language, whatever
the corpus's size, and is broadcast. Every text is labelled whole, by numpy over blocks of texts, so long and short ones run together.

A null text, or one without a letter, is ``und`` with a score of 0, and so is any text if nothing is labelled. Equal sums go to the
language that is first by name. Repeated rows are labelled alike. Empty tables give empty results.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import chunks

#: Scripts and ranges of Unicode's blocks with their letters.
SCRIPTS = (
    ("Latin", ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A))),
    ("Greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("Cyrillic", ((0x400, 0x52F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("Armenian", ((0x530, 0x58F),)),
    ("Hebrew", ((0x590, 0x5FF),)),
    ("Arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("Devanagari", ((0x900, 0x97F), (0xA8E0, 0xA8FF))),
    ("Bengali", ((0x980, 0x9FF),)),
    ("Tamil", ((0xB80, 0xBFF),)),
    ("Telugu", ((0xC00, 0xC7F),)),
    ("Thai", ((0xE00, 0xE7F),)),
    ("Georgian", ((0x10A0, 0x10FF), (0x1C90, 0x1CBF))),
    ("Ethiopic", ((0x1200, 0x139F),)),
    ("Han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))),
    ("Kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D))),
    ("Hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
)
N_SCRIPTS = len(SCRIPTS) + 1
SAMPLE = 4_000
BUCKETS = 1 << 16
SHARE = 0.01
FLOOR, PENALTY = 4.0, 9.0
#: Scores (words times languages) and characters that a task holds at once, about, or one text's.
SCORES, SLICE = 12_000_000, 1_000_000
UND = "und"
SPANS = "lang string, score double, spans array<struct<start:int,end:int,lang:string>>"


@lru_cache(1)
def alphabet() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its kind, 0 no word's, 1 a mark, 2 a letter of no listed script, 3 and on the listed ones; and its lower-case form."""
    kind, lower = np.zeros(0x110000, dtype=np.uint8), np.arange(0x110000, dtype=np.uint32)
    for c in range(0x40000):
        sign = chr(c)
        if sign.isalpha():
            kind[c] = 2
            if len(low := sign.lower()) == 1:
                lower[c] = ord(low)
        elif unicodedata.category(sign)[0] == "M":
            kind[c] = 1
    for k, (_, ranges) in enumerate(SCRIPTS, 3):
        for first, last in ranges:
            own = kind[first : last + 1]
            own[own == 2] = k
    return kind, lower


class Words:
    """The words of some texts, laid end to end: their texts, places, letters, scripts and hashed n-grams."""

    def __init__(self, texts: list[str | None]):
        kind, lower = alphabet()
        sizes = np.array([len(t) if t else 0 for t in texts], dtype=np.int64)
        # a blank parts texts, and stands before the first and after the last
        signs = np.frombuffer(("  " + "\n".join(t or "" for t in texts) + "  ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kinds = kind[signs]
        edge = np.flatnonzero(np.diff((kinds > 0).astype(np.int8)))
        first, last = edge[::2] + 1, edge[1::2] + 1
        if len(first):
            both = np.stack([first, last], 1).ravel()
            spelled = np.maximum.reduceat(kinds, both)[::2] > 1
            first, last = first[spelled], last[spelled]
        base = np.r_[0, np.cumsum(sizes + 1)][:-1] + 2
        self.text = np.searchsorted(base, first, "right") - 1
        self.start, self.end = first - base[self.text], last - base[self.text]
        self.script = np.zeros(len(first), dtype=np.int64)
        self.letters = np.zeros(len(first), dtype=np.int64)
        code = np.where(kinds > 0, lower[signs], 0).astype(np.uint64)
        # a word's n-grams end at each of its signs, and at the blank after it
        long = last - first + 1
        self.gram_start = np.r_[0, np.cumsum(long)]
        at = np.arange(self.gram_start[-1]) + np.repeat(first - self.gram_start[:-1], long)
        if len(first):
            own = kinds[at]
            self.script = np.maximum.reduceat(own, self.gram_start[:-1]).astype(np.int64) - 2
            self.letters = np.add.reduceat((own > 1).astype(np.int64), self.gram_start[:-1])
        after, here, before = code[at], code[at - 1], code[at - 2]
        before = np.where(here > 0, before, 0)
        far = np.where(before > 0, code[np.maximum(at - 3, 0)], 0)
        three = (before << np.uint64(42)) ^ (here << np.uint64(21)) ^ after
        self.grams = (_bucket(three), BUCKETS + _bucket(_mixed(three) ^ far))

    def likelihoods(self, table: np.ndarray) -> np.ndarray:
        """Sums of ``table`` (language, bucket) over each word's n-grams, halved: a row a word."""
        out = np.zeros((len(self.start), len(table)), dtype=np.float32)
        if len(self.start):
            for k, row in enumerate(table):
                out[:, k] = np.add.reduceat(row[self.grams[0]] + row[self.grams[1]], self.gram_start[:-1]) / 2
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _bucket(x: np.ndarray) -> np.ndarray:
    return (_mixed(x) >> np.uint64(48)).astype(np.int32)


class Model:
    """Log-likelihoods by language and n-gram, scripts by language, and log-priors. ``counts`` are n-grams, then scripts; ``rows`` are labelled rows."""

    def __init__(self, names: list[str], rows: list[int], counts: np.ndarray):
        self.names = names
        grams = counts[:, : 2 * BUCKETS].astype(np.float64)
        self.table = np.concatenate([np.log((x + 0.5) / (x.sum(1, keepdims=True) + 0.5 * BUCKETS)) for x in (grams[:, :BUCKETS], grams[:, BUCKETS:])], axis=1).astype(np.float32)
        letters = counts[:, 2 * BUCKETS :]
        self.written = (letters >= np.maximum(1, SHARE * letters.sum(1, keepdims=True))).T
        self.prior = np.log(np.array(rows, dtype=np.float64) / max(1, sum(rows))).astype(np.float32)

    def scores(self, words: Words) -> np.ndarray:
        allowed = self.written[words.script]
        known = allowed.any(1, keepdims=True)
        s = np.where(allowed, words.likelihoods(self.table), -np.inf) if len(self.names) else np.zeros((len(words.start), 0), dtype=np.float32)
        s = np.where(known, s, 0)
        top = s.max(1, keepdims=True, initial=-np.inf)
        s = s - top - np.log(np.exp(s - top).sum(1, keepdims=True))
        return np.where(known, np.maximum(s, -FLOOR), 0).astype(np.float32)


def viterbi(scores: np.ndarray, counts: np.ndarray, prior: np.ndarray, penalty: float) -> np.ndarray:
    """The labels of the words of texts, ``counts`` words each, one after the other: the best sum of scores less ``penalty`` a change.

    All texts take their k-th step together.
    """
    n = scores.shape[1]
    if not len(scores):
        return np.zeros(0, dtype=np.int64)
    start = (np.cumsum(counts) - counts)[order := np.argsort(-counts, kind="stable")]
    counts = counts[order]
    came = np.zeros(scores.shape, dtype=np.int16 if n > 127 else np.int8)
    own = np.arange(n)
    live = np.searchsorted(-counts, -np.arange(counts[0]), "left")  # texts with over t words
    value = scores[start[: live[0]]] + prior
    final = np.zeros(len(counts), dtype=np.int64)
    for t in range(1, int(counts[0])):
        m = live[t]
        if m < len(value):
            final[m : len(value)] = value[m:].argmax(1)
            value = value[:m]
        best = value.argmax(1)
        changed = value[np.arange(m), best] - penalty
        stays = value >= changed[:, None]
        came[start[:m] + t] = np.where(stays, own, best[:, None])
        value = np.where(stays, value, changed[:, None]) + scores[start[:m] + t]
    final[: len(value)] = value.argmax(1)
    label = np.zeros(len(scores), dtype=np.int64)
    for t in range(int(counts[0]) - 1, -1, -1):
        at = start[: live[t]] + t
        label[at] = final[: live[t]]
        final[: live[t]] = came[at, final[: live[t]]]
    return label


def label_texts(texts: list[str | None], model: Model) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, its share of the letters, spans as (start, end, language) in code points) of each text."""
    out: list[tuple] = []
    n = max(1, len(model.names))
    # two signs a word at least
    for lo, hi in chunks([(len(t or "") // 4 + 1) * n for t in texts], SCORES):
        parts, own = [], texts[lo:hi]
        for a, b in chunks([len(t or "") for t in own], SLICE):
            words = Words(own[a:b])
            parts.append((words.text + a, words.start, words.end, words.letters, model.scores(words)))
        text, start, end, letters, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
        counts = np.bincount(text, minlength=len(own))
        if not model.names:
            counts[:] = 0
        label = viterbi(scores, counts[counts > 0], model.prior, PENALTY) if counts.any() else np.zeros(0, dtype=np.int64)
        base = np.r_[0, np.cumsum(counts)]
        for a, b in pairwise(base.tolist()):
            if a == b:
                out.append((UND, 0.0, []))
                continue
            by = np.bincount(label[a:b], letters[a:b], len(model.names))
            best = int(by.argmax())
            cut = np.r_[a, np.flatnonzero(np.diff(label[a:b])) + a + 1, b]
            spans = [(int(start[x]), int(end[y - 1]), model.names[label[x]]) for x, y in pairwise(cut.tolist())]
            out.append((model.names[best], float(by[best] / by.sum()), spans))
    return out


def fit_languages(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """A model of the languages of ``labelled``; rows with a null text or language don't count."""
    rows = labelled.select(F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("l"), F.col(key).cast("string").alias("k")).filter("t is not null and l is not null")
    sizes = sorted(rows.groupBy("l").count().collect())
    names = [r["l"] for r in sizes]
    if not names:
        return Model([], [], np.zeros((0, 2 * BUCKETS + N_SCRIPTS)))
    share = F.create_map(*(F.lit(x) for r in sizes for x in (r["l"], sample / r["count"])))
    drawn = F.pmod(F.xxhash64("k", "t"), F.lit(1 << 30)) < share[F.col("l")] * (1 << 30)
    place = {name: k for k, name in enumerate(names)}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array([place[x] for x in batch.column(1).to_pylist()], dtype=np.int64)
            for lo, hi in chunks([len(t) for t in texts], SLICE):
                words = Words(texts[lo:hi])
                of_word = langs[lo:hi][words.text]
                of_gram = np.repeat(of_word, np.diff(words.gram_start))
                for k in np.unique(of_word).tolist():
                    own = total.setdefault(k, np.zeros(2 * BUCKETS + N_SCRIPTS, dtype=np.int64))
                    for grams in words.grams:
                        own[: 2 * BUCKETS] += np.bincount(grams[of_gram == k], minlength=2 * BUCKETS)
                    own[2 * BUCKETS :] += np.bincount(words.script[of_word == k], words.letters[of_word == k], N_SCRIPTS).astype(np.int64)
        for k, own in sorted(total.items()):
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k), pa.int32()), pa.array(at, pa.int32()), pa.array(own[at])], names=["l", "b", "n"])

    counts = rows.filter(drawn).select("t", "l").mapInArrow(counted, "l int, b int, n bigint").groupBy("l", "b").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((len(names), 2 * BUCKETS + N_SCRIPTS))
    table[counts["l"], counts["b"]] = counts["n"]
    return Model(names, [r["count"] for r in sizes], table)


def label_spans(df: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """Adds the struct column ``out`` with the fields of ``SPANS``; every row stays. Only the text is looked at."""
    import pandas as pd

    shared = df.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(label_texts([t if isinstance(t, str) else None for t in texts], shared.value), columns=["lang", "score", "spans"])

    label.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return df.withColumn(out, F.pandas_udf(label, SPANS).asNondeterministic()(F.col(text).cast("string")))


def held_out(key: Column, folds: int = 5) -> Column:
    """Rows of the fold that is kept from learning, by CRC-32 of the key as text; a null key is in no fold."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(folds)) == 0


def identify(df: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Returns ``id_col, held_out, lang_pred, score, spans`` for every row, by a model of the labelled rows that aren't held out.

    Rows with a null id are neither held out nor learned from.
    """
    model = fit_languages(df.filter(~held_out(F.col(id_col))), text, lang, id_col)
    rows = label_spans(df.select(F.col(id_col).alias("i"), F.col(text).alias("t")), model, "t", "language")
    kept_out = F.coalesce(held_out(F.col("i")), F.lit(False))
    return rows.select(F.col("i").alias(id_col), kept_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score", "language.spans")
