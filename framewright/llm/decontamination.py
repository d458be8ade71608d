"""Benchmark decontamination: a BM25 index of the test items, queried with every passage.

The index holds the test items, not the corpus. Item count, mean length and term frequencies
are those of the whole benchmark. An item's impacts are divided by its score against itself, so one
threshold in 0 to 1 holds for items of any length. Passages are windows of two halves; items of
about the same length (up to the next power of two) have windows of their own, whose halves are
at least as long as the item, so every occurrence lies whole in a window of at most four times
its length, whatever other items there are.

Retrieval is block-max WAND. For a batch of passages at once, sums of block maxima (with one
bound a block for all its frequent terms together) tell which passages may have any item
at the threshold. Each of those is queried by cursors: the pivot is the first item that the terms'
bounds let reach the threshold, its block's maxima are tested next, and cursors skip to the pivot or
past the blocks. Nothing that could reach the threshold is left out. Each retrieved pair is then
verified: the item is split into a question and an answer, and enough of their word trigrams must
occur in the passage; a part of one or two words counts as one run of words.

An item's answer is its last sentence if it has over one, else its last third of the words.

The index is broadcast in shards of about ``ITEMS / 2`` items and ``CHARS`` characters, one pass over
the corpus each, so its size is bounded whatever the benchmark's, and the results are the same.
Null and empty texts or items match nothing. Equal rows of the benchmark count once.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import chunks, staged

TOKEN = re.compile(r"[^\W_]+")
K1, B = 1.2, 0.75
BLOCK = 8
#: Items of an index shard, and characters in them.
ITEMS, CHARS = 20_000, 10_000_000
#: Words of texts treated together.
BLOCK_WORDS = 100_000
FREQUENT_SHARE = 0.35


def terms(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of the item before its last sentence, and of that sentence."""
    parts = [p for p in (terms(x) for x in re.split(r"(?<=[.!?])\s+|\n", text)) if p]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = max(1, len(words) - max(1, len(words) // 3))
    return words[:cut], words[cut:]


def grams(words: list[str], n: int = 3) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def part_grams(words: list[str]) -> tuple[int, set[tuple[str, ...]]]:
    """Trigrams of a part and their length, 3; a shorter part is one run of its own length."""
    n = min(3, len(words))
    return n, grams(words, n) if n else set()


def half_of(n_words: int) -> int:
    """Half a window's words for items of ``n_words``."""
    return max(8, 1 << (n_words - 1).bit_length())


class Postings:
    """Inverted index with block maxima over some items, given as impacts by term."""

    def __init__(self, items: list[int], impacts: list[dict[int, float]], n_terms: int):
        self.items = items
        own = [impacts[i] for i in items]
        lists: list[list[tuple[int, float]]] = [[] for _ in range(n_terms)]
        for k, x in enumerate(own):
            for t, v in x.items():
                lists[t].append((k, v))
        self.known = np.array([bool(x) for x in lists], dtype=bool)
        self.cursors = {t: ([k for k, _ in x], [v for _, v in x], max(v for _, v in x)) for t, x in enumerate(lists) if x}
        # the most frequent terms, as many as no item gets over FREQUENT_SHARE of its score from
        given, frequent = np.zeros(len(own)), []
        for t in sorted(self.cursors, key=lambda t: (-len(lists[t]), t)):
            at, more = map(np.array, self.cursors[t][:2])
            if len(at) < 3 or (given[at] + more > FREQUENT_SHARE).any():
                break
            given[at] += more
            frequent.append(t)
        self.rare = self.known.copy()
        self.rare[frequent] = False
        blocks = -(-len(own) // BLOCK)
        self.block_bound = np.array([given[b * BLOCK : (b + 1) * BLOCK].max() for b in range(blocks)])
        self.maxima: list[dict[int, float]] = [{} for _ in range(n_terms)]
        for t, x in enumerate(lists):
            for k, v in x:
                self.maxima[t][k // BLOCK] = max(self.maxima[t].get(k // BLOCK, 0.0), v)
        rare = [m if self.rare[t] else {} for t, m in enumerate(self.maxima)]
        self.begin = np.r_[0, np.cumsum([len(m) for m in rare])].astype(np.int64)
        self.block = np.array([b for m in rare for b in m], dtype=np.int64)
        self.maximum = np.array([x for m in rare for x in m.values()])

    def hopeful(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> np.ndarray:
        """The passages with a block whose bound reaches ``threshold``, ascending."""
        rare = self.rare[term]
        p, t = passage[rare], term[rare]
        sizes = self.begin[t + 1] - self.begin[t]
        if not sizes.sum():
            return p[:0]
        at = np.repeat(self.begin[t] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        n_blocks = len(self.block_bound)
        pairs, inverse = np.unique(np.repeat(p, sizes) * n_blocks + self.block[at], return_inverse=True)
        bound = np.bincount(inverse, self.maximum[at], len(pairs)) + self.block_bound[pairs % n_blocks]
        return np.unique(pairs[bound >= threshold - 1e-9] // n_blocks)

    def wand(self, terms: list[int], threshold: float) -> Iterator[tuple[int, float]]:
        """(item, score) of all items at or above ``threshold`` for a passage with these terms, by block-max WAND."""
        reach = threshold - 1e-9
        # next item, term, place in its postings
        now = sorted((self.cursors[t][0][0], t, 0) for t in terms if t in self.cursors)
        while now:
            bound, pivot = 0.0, -1
            for k, (_, t, _) in enumerate(now):
                bound += self.cursors[t][2]
                if bound >= reach:
                    pivot = now[k][0]
                    break
            else:
                return
            n = next((k for k, x in enumerate(now) if x[0] > pivot), len(now))
            block = pivot // BLOCK
            if sum(self.maxima[t].get(block, 0.0) for _, t, _ in now[:n]) < reach:
                # nothing in the rest of the block that the cursors before it could add up to
                to = min((block + 1) * BLOCK, now[n][0] if n < len(now) else len(self.items))
            else:
                to = pivot
                if now[0][0] == pivot:
                    score = sum(self.cursors[t][1][at] for _, t, at in now[:n])
                    if score >= threshold:
                        yield self.items[pivot], score
                    to = pivot + 1
            moved = []
            for item, t, at in now[:n]:
                if item < to:
                    own = self.cursors[t][0]
                    at = bisect_left(own, to, at)
                    if at == len(own):
                        continue
                    item = own[at]
                moved.append((item, t, at))
            now = sorted(moved + now[n:])


class Index:
    """Index of a bounded number of items, (id, text), by their length.

    ``n``, ``mean`` and ``frequency`` are the benchmark's item count, mean length in words and items by
    term; without them the items are the benchmark.
    """

    def __init__(self, items: list[tuple[object, str]], n: int | None = None, mean: float | None = None, frequency: dict[str, int] | None = None):
        kept = [(i, t, w) for i, t in items if (w := terms(t))]
        self.ids = [i for i, _, _ in kept]
        self.parts = [tuple(map(part_grams, question_answer(t))) for _, t, _ in kept]
        count = frequency if frequency is not None else Counter(w for _, _, words in kept for w in set(words))
        n = n if n is not None else len(kept)
        mean = mean if mean is not None else sum(len(w) for _, _, w in kept) / max(1, n)
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for _, _, words in kept for w in words}))}
        self.impacts: list[dict[int, float]] = []
        for _, _, words in kept:
            norm = K1 * (1 - B + B * len(words) / mean)
            own = {self.vocabulary[w]: math.log(1 + (n - count[w] + 0.5) / (count[w] + 0.5)) * f * (K1 + 1) / (f + norm) for w, f in Counter(words).items()}
            total = sum(own.values())
            self.impacts.append({t: x / total for t, x in own.items()})
        classes: dict[int, list[int]] = {}
        for i, (_, _, words) in enumerate(kept):
            classes.setdefault(half_of(len(words)), []).append(i)
        self.postings = {half: Postings(own, self.impacts, len(self.vocabulary)) for half, own in sorted(classes.items())}


def find_leaks(index: Index, texts: list[list[str]], threshold: float, q_overlap: float, a_overlap: float):
    """(text, item, score, question overlap, answer overlap) of the verified pairs, the best passage of each."""
    get, n_terms = index.vocabulary.get, len(index.vocabulary)
    for lo, hi in chunks([len(x) for x in texts], BLOCK_WORDS):
        part = texts[lo:hi]
        sizes = np.array([len(x) for x in part], dtype=np.int64)
        all_codes = np.array([get(w, -1) for x in part for w in x], dtype=np.int64)
        start = np.r_[0, np.cumsum(sizes)]
        found: dict[tuple[int, int], tuple[float, float, float]] = {}
        for half, postings in index.postings.items():
            at = np.flatnonzero((all_codes >= 0) & postings.known[all_codes])
            base = np.r_[0, np.cumsum(-(-sizes // half))]
            own = np.searchsorted(start, at, "right") - 1
            piece, code = base[own] + (at - start[own]) // half, all_codes[at]
            # a half belongs to the window that starts with it and to the one before it
            later = piece > base[own]
            keys = np.unique(np.r_[piece, piece[later] - 1] * n_terms + np.r_[code, code[later]])
            passage, term = keys // n_terms, keys % n_terms
            for window in postings.hopeful(passage, term, threshold).tolist():
                d, near = int(np.searchsorted(base, window, "right")) - 1, {}
                first, last = np.searchsorted(passage, [window, window + 1])
                at_word = (window - int(base[d])) * half
                for i, score in postings.wand(term[first:last].tolist(), threshold):
                    for n, x in index.parts[i]:
                        if x and n not in near:
                            near[n] = grams(part[d][at_word : at_word + 2 * half], n)
                    here = [len(x & near[n]) / len(x) if x else 1.0 for n, x in index.parts[i]]
                    if here[0] >= q_overlap and here[1] >= a_overlap and (score, *here) > found.get((d, i), (0.0,)):
                        found[d, i] = (score, *here)
        for (d, i), x in sorted(found.items()):
            yield lo + d, i, *x


def _number(benchmark: DataFrame, item_col: str) -> str:
    return "bigint" if dict(benchmark.dtypes)[item_col] in ("tinyint", "smallint", "int", "bigint") else "string"


def _shards(benchmark: DataFrame, item_col: str, item_text: str) -> Iterator[tuple[Broadcast[Index], bool]]:
    """Broadcast indexes of a bounded number of items, one, maybe empty, at least; and whether others follow."""
    items = benchmark.select(F.col(item_col).cast(_number(benchmark, item_col)).alias("i"), F.col(item_text).cast("string").alias("t")).filter("t is not null").distinct()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [terms(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(map(len, lists), pa.int64()), pa.array([sorted(set(x)) for x in lists], pa.list_(pa.string()))], names=["k", "n", "words"]
            )

    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("t")).alias("chars")).first()
    n_shards = max(1, -(-size["n"] // (ITEMS // 2)), -(-(size["chars"] or 0) // CHARS))
    items = staged(items.withColumn("k", F.pmod(F.xxhash64("i", "t"), F.lit(n_shards))), "items")
    described = items.mapInArrow(words, "k bigint, n bigint, words array<string>").filter("n > 0")
    total = described.agg(F.count(F.lit(1)).alias("n"), F.avg("n").alias("mean")).first()
    by_term = described.select("k", F.explode("words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.collect_set("k").alias("k"))
    by_term = staged(by_term, "item-terms")
    for k in range(n_shards):
        own = sorted(((r["i"], r["t"]) for r in items.filter(F.col("k") == k).collect()), key=str)
        frequency = {r["w"]: r["n"] for r in by_term.filter(F.array_contains("k", F.lit(k).cast("bigint"))).select("w", "n").collect()}
        yield benchmark.sparkSession.sparkContext.broadcast(Index(own, total["n"], total["mean"], frequency)), k + 1 < n_shards


def _in_blocks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[list[str]]]]:
    """Slices of batches, of about ``BLOCK_WORDS`` words in column ``at``, with the terms of each text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
        for lo, hi in chunks([n // 6 + 1 for n in sizes], BLOCK_WORDS):
            part = batch.slice(lo, hi - lo)
            yield part, [terms(t) for t in part.column(at).to_pylist()]


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    threshold: float = 0.5,
    q_overlap: float = 0.6,
    a_overlap: float = 0.5,
) -> DataFrame:
    """Returns a row for each pair of a document and a test item that it holds.

    Columns: ``id_col, item_col, bm25`` (share of the item's score with itself),
    ``question_overlap, answer_overlap`` (share of its trigrams found near the passage).
    Repeated rows of ``df`` are reported once each. If the item column has the id column's name, it
    is returned as ``item_`` and that name.
    """
    kind = dict(benchmark.dtypes)[item_col]
    number, item_out = _number(benchmark, item_col), f"item_{item_col}" if item_col == id_col else item_col
    schema = f"`{id_col}` {dict(df.dtypes)[id_col]}, `{item_out}` {number}, bm25 double, question_overlap double, answer_overlap double"
    docs = df.select(F.col(id_col).alias("d"), F.col(text).cast("string").alias("t"))
    result = None
    for index, more in _shards(benchmark, item_col, item_text):

        def query(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch, texts in _in_blocks(batches, 1):
                ids = batch.column(0)
                rows = list(find_leaks(index.value, texts, threshold, q_overlap, a_overlap))
                if rows:
                    d, i, *rest = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(d)), pa.array([index.value.ids[x] for x in i], pa.int64() if number == "bigint" else pa.string()), *map(pa.array, rest)],
                        names=[id_col, item_out, "bm25", "question_overlap", "answer_overlap"],
                    )

        found = docs.mapInArrow(query, schema)
        if more:
            found = staged(found, "leaks")
            index.destroy()
        result = found if result is None else result.unionByName(found)
    return result.withColumn(item_out, F.col(item_out).cast(kind))


def drop_contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    threshold: float = 0.5,
    q_overlap: float = 0.6,
    a_overlap: float = 0.5,
) -> DataFrame:
    """``df`` without the rows whose text holds a test item, whatever their ids.

    Every row is judged where it is, so no text is shuffled.
    """
    kept, at = df, df.columns.index(text)
    for index, more in _shards(benchmark, item_col, item_text):

        def keep(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch, texts in _in_blocks(batches, at):
                leaks = {d for d, *_ in find_leaks(index.value, texts, threshold, q_overlap, a_overlap)}
                yield batch.filter(pa.array([d not in leaks for d in range(len(texts))], pa.bool_()))

        kept = kept.mapInArrow(keep, df.schema)
        if more:
            kept = staged(kept, "clean")
            index.destroy()
    return kept
