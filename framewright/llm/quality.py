"""Quality rules: repetition within a text, found with a suffix array over its words.

Each text gets simple counts and the spans of its maximal repeated passages. The texts with
a repeated five-word window go on to the suffix array: prefix doubling ranks all suffixes of
a block of texts at once, neighbours in suffix order give the longest common prefixes, and
the maximal repeats among them are united into spans.

Texts without white space are covered too: a word of over ``LONG_WORD`` code points counts
as one token per code point, and a repeat must also be ``min_chars`` long. For the limit on the longest
repeat, ``WORD_CHARS`` such tokens count as a word. A run of over ``LONG_WORD`` times the same code
point (a ruler line) is one token, so it does not repeat itself.

Nulls and empty texts have no words, fail the base rule and have no spans. Other columns of
the input stay as they are; one named like the result column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import WORD, chunks, mix

SYMBOLS = "#*$%&|<>"
LONG_WORD = 40
WORD_CHARS = 6
RUN = re.compile(r"(.)\1{%d,}|." % LONG_WORD, re.S)
WINDOW = 5
#: Words of texts that are treated together, which bounds the memory of a task.
BLOCK_WORDS = 200_000
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_repeats long, longest_repeat long, longest_words double, covered_chars long, spans array<struct<start:int,end:int>>"
)


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _numbered(words: list[str]) -> np.ndarray:
    return pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)


def _repeat_words(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Marks the words in five-word windows that their text has twice or more."""
    n = len(codes) - WINDOW + 1
    marked = np.zeros(len(codes), dtype=bool)
    if n <= 0:
        return marked
    key = mix(doc[:n].astype(np.uint64))
    for k in range(WINDOW):
        key = mix(key + codes[k : k + n].astype(np.uint64))
    whole = np.flatnonzero(doc[:n] == doc[WINDOW - 1 :])
    order = whole[np.argsort(key[whole], kind="stable")]
    same = key[order][1:] == key[order][:-1]
    twice = order[np.r_[same, False] | np.r_[False, same]] if len(order) else order
    for k in range(WINDOW):
        marked[twice + k] = True
    return marked


def suffix_lcp(codes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the texts' suffixes, text by text, and the common prefix of each with the next.

    ``doc`` numbers the texts in ascending order. Prefixes are counted in tokens and stay
    within a text. Memory: four bytes a token for each doubling up to the longest text, next to
    some 60 a token, for one block of ``BLOCK_WORDS`` or one longer text at a time.
    """
    n = len(codes)
    small = np.int32 if n < (1 << 31) - 2 else np.int64
    rank = np.unique(doc * (codes.max() + 1) + codes, return_inverse=True)[1].astype(np.int64) + 1
    levels, length, longest = [rank.astype(small)], 1, np.bincount(doc).max()
    while rank.max() < n and length < longest:
        after = np.zeros(n, dtype=np.int64)
        inside = np.flatnonzero(doc[: n - length] == doc[length:]) if length < n else np.zeros(0, dtype=np.int64)
        after[inside] = rank[inside + length]
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        levels.append(rank.astype(small))
        length *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank - 1] = np.arange(n)
    i, j = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(n - 1, dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        padded = np.append(levels.pop(), small(0))
        step = (padded[i] == padded[j]) * np.int64(1 << k)
        lcp += step
        i += step
        j += step
    return order, lcp


def _maximal(codes: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray, min_words: int, min_chars: int):
    """First tokens and token counts of the maximal repeats, each occurrence once."""
    n = len(codes)
    if n < 2:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    order, lcp = suffix_lcp(codes, doc)
    most = np.zeros(n, dtype=np.int64)
    most[order[1:]] = lcp
    most[order[:-1]] = np.maximum(most[order[:-1]], lcp)
    last = np.arange(n) + most
    chars = np.where(most > 0, end[np.maximum(last, 1) - 1] - start, 0)
    fits = (most >= min_words) & (chars >= min_chars)
    # what starts a token later and ends no later is part of the repeat before it
    inner = np.zeros(n, dtype=bool)
    inner[1:] = fits[:-1] & (last[:-1] >= last[1:])
    at = np.flatnonzero(fits & ~inner)
    return at, most[at]


def _tokens(text: str) -> tuple[list[str], list[int], list[int]]:
    words, starts, ends = [], [], []
    for m in WORD.finditer(text):
        word, at = m.group(), m.start()
        if len(word) <= LONG_WORD:
            words.append(word), starts.append(at), ends.append(m.end())
        else:
            for x in RUN.finditer(word):
                words.append(x.group()), starts.append(at + x.start()), ends.append(at + x.end())
    return words, starts, ends


def analyse(texts: list[str | None], min_words: int, min_chars: int) -> pd.DataFrame:
    """The columns of ``SCHEMA`` for each text."""
    words = [WORD.findall(t) if t else [] for t in texts]
    n = np.array([len(w) for w in words], dtype=np.int64)
    out = {
        "n_words": n,
        "word_chars": [sum(map(len, w)) for w in words],
        "n_symbols": [sum(map(t.count, SYMBOLS)) if t else 0 for t in texts],
        "n_dup_lines": [duplicate_lines(t) if t else 0 for t in texts],
    }
    flat = [x for w in words for x in w]
    doc = np.repeat(np.arange(len(texts)), n)
    repeated = np.bincount(doc, _repeat_words(_numbered(flat), doc), len(texts)).astype(np.int64)
    out["n_repeat_words"] = repeated
    repeats, longest, covered = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
    longest_words = np.zeros(len(texts))
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    # a repeat of min_words >= WINDOW words has a repeated window; long words are split, so look at all of those
    look = [i for i, w in enumerate(words) if repeated[i] or any(len(x) > LONG_WORD for x in w)]
    own = [_tokens(texts[i]) for i in look]
    for lo, hi in chunks([len(x[0]) for x in own], BLOCK_WORDS):
        part = own[lo:hi]
        sizes = [len(x[0]) for x in part]
        at_doc = np.repeat(np.arange(hi - lo), sizes)
        start, end = (np.array([y for x in part for y in x[k]], dtype=np.int64) for k in (1, 2))
        codes = _numbered([y for x in part for y in x[0]])
        at, size = _maximal(codes, at_doc, start, end, min_words, min_chars)
        cover = np.zeros(len(codes) + 1, dtype=np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + size, -1)
        cover = np.cumsum(cover[:-1]) > 0
        these = np.array(look[lo:hi])
        repeats[these] = np.bincount(at_doc[at], minlength=hi - lo)
        np.maximum.at(longest, these[at_doc[at]], size)
        # only the tokens of a split word touch each other
        touch = (end[:-1] == start[1:]) & (at_doc[:-1] == at_doc[1:])
        weight = np.where(np.r_[touch, False] | np.r_[False, touch], 1, WORD_CHARS)[: len(codes)]
        before = np.r_[0, np.cumsum(weight)]
        np.maximum.at(longest_words, these[at_doc[at]], (before[at + size] - before[at]) / WORD_CHARS)
        covered[these] = np.bincount(at_doc, np.where(cover, end - start, 0), hi - lo)
        edge = np.flatnonzero(np.diff(at_doc)) + 1
        first = cover & ~np.r_[False, cover[:-1]]
        first[edge] |= cover[edge]
        final = cover & ~np.r_[cover[1:], False]
        final[edge - 1] |= cover[edge - 1]
        for d, a, b in zip(at_doc[first], start[first], end[final], strict=True):
            spans[look[lo + d]].append((int(a), int(b)))
    out |= {"n_repeats": repeats, "longest_repeat": longest, "longest_words": longest_words, "covered_chars": covered, "spans": spans}
    return pd.DataFrame(out)


def repetition(df: DataFrame, text: str = "text", min_words: int = 10, min_chars: int = 40, out: str = "repetition") -> DataFrame:
    """Adds the struct column ``out`` with the fields of ``SCHEMA``; every row stays."""
    if min_words < WINDOW:
        raise ValueError(f"min_words must be {WINDOW} or more")

    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.tolist()
            parts = [analyse(texts[a:b], min_words, min_chars) for a, b in chunks([len(t or "") // 6 + 1 for t in texts], BLOCK_WORDS)]
            yield pd.concat(parts) if parts else analyse([], min_words, min_chars)

    measure.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    udf = F.pandas_udf(measure, SCHEMA).asNondeterministic()
    return df.withColumn(out, udf(F.col(text).cast("string")))


def quality_rules(
    df: DataFrame,
    text: str = "text",
    min_words: int = 10,
    max_fraction: float = 0.2,
    max_longest: int = 64,
    out: str = "repetition",
    failed: str = "base_failed",
    kept: str = "kept",
) -> DataFrame:
    """Adds ``out``, ``base_failed`` and ``kept``, or columns named by ``failed`` and ``kept``.

    ``base_failed``: under ten words, or over a fifth of the words in repeated five-word
    windows. ``kept``: not failed, repeats of ``min_words`` words cover at most
    ``max_fraction`` of the characters in words, and none is over ``max_longest`` words long
    (``longest_words``; ``longest_repeat`` counts tokens).
    """
    q = lambda name: F.col(f"`{out}`.{name}")
    fails = (q("n_words") < 10) | (100 * q("n_repeat_words") > 20 * q("n_words"))
    sound = (q("covered_chars") <= max_fraction * q("word_chars")) & (q("longest_words") <= max_longest)
    return repetition(df, text, min_words, out=out).withColumn(failed, fails).withColumn(kept, ~fails & sound)


def keep_sound(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without the rows that ``quality_rules`` rejects; its columns stay, whatever their names."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    judged = quality_rules(df, text, out=f"{prefix}repetition", failed=f"{prefix}failed", kept=f"{prefix}kept")
    return judged.filter(F.col(f"{prefix}kept")).select(*(F.col(f"`{c}`") for c in df.columns))
