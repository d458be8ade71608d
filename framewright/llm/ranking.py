"""Ranked lexical search: best-first document intervals under sums of range maxima.

Documents are indexed in blocks. In a block every posting list has a sparse table over its impacts, so the
largest impact in any run of the list is two look-ups. The search for an item keeps intervals of a block's
documents, which are in the order of their ids. An interval's bound is the sum, over the item's terms, of the range maximum
of the term's postings inside it, so no document in it can score more. The intervals of the highest bounds
come first; each is split at the document that holds the largest of its maxima, which is scored exactly, and the two
parts beside it go back. An interval is given up only when its bound is under the worst score among the best so far (or equal, with
only later ids). So the answer is exact, whatever the data.

1. ``_index``: every task writes its texts' postings of the items' terms, a row a block, to the shared folder, with the counts
   of documents and terms. Texts are read once; no posting is shuffled.
2. Document frequencies are sums over the blocks' rows.
3. ``_search``: every task runs all items over its blocks and carries each item's best from block to block, so that later blocks
   are mostly given up at once. It returns at most ``k`` rows an item.
4. The best of those are ranked: within 32 parts of each item first, then within the item, so no item is one large task.

Items are dealt to shards of about ``ITEMS`` items and ``CHARS`` characters, one pass each, so what is broadcast is bounded.

A term is a maximal run of ASCII letters and digits and of all other characters over U+007F; only A to Z are lower-cased. Null and empty texts
have no terms; documents without terms count for nothing. Repeated rows are documents of their own; equal rows of the items
count once, and rows that share an item's id but not its text are items of their own. Null ids come last among equal scores. No items, or no documents,
give no rows. Other columns are not returned.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.common import chunks, staged

#: Items of a shard, and characters in them, about.
ITEMS, CHARS = 5_000, 2_000_000
#: Documents of a block, and bytes in them (or one text).
DOCS, BLOCK_BYTES = 8_192, 12_000_000
#: Blocks that one task searches, about.
BLOCKS = 4
#: Intervals that are split in one step.
STEP = 64
_KEPT = bytes(b for b in range(128) if chr(b).isalnum())
#: Bytes that are in no term become spaces; A to Z become a to z.
_TABLE = bytes(b if b >= 128 else ord(chr(b).lower()) if b in _KEPT else 32 for b in range(256))
INDEX = "ids array<{id}>, lengths array<bigint>, terms array<int>, counts array<int>, docs array<int>, tfs array<int>, n_docs bigint, n_terms bigint"


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Postings:
    """Posting lists of a block with sparse tables of range maxima.

    ``impact`` has the lists one after the other, each in the order of documents; list t is at ``start[t]`` to ``start[t + 1]``.
    """

    def __init__(self, term: np.ndarray, start: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int):
        self.start, self.doc, self.impact, self.n_docs = start, doc, impact, n_docs
        self.lists = {int(t): i for i, t in enumerate(term)}
        self.key = np.repeat(np.arange(len(term), dtype=np.int64), np.diff(start)) * n_docs + doc
        longest = int(np.diff(start).max(initial=1))
        # level j: where the largest of 2 ** j postings is, the first of equals
        self.most = [np.arange(len(doc), dtype=np.int32)]
        while 2 << (len(self.most) - 1) <= longest:
            half, last = 1 << (len(self.most) - 1), self.most[-1]
            level, right = last.copy(), last[half:]
            level[:-half] = np.where(impact[last[:-half]] >= impact[right], last[:-half], right)
            self.most.append(level)
        self.most = np.array(self.most)
        self.log = np.frexp(np.arange(longest + 1, dtype=np.float64))[1] - 1

    def bounds(self, lo: np.ndarray, hi: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of postings ``lo`` to ``hi`` of the terms: the sum of the terms' range maxima, and the document of the largest."""
        some = hi > lo
        level = self.log[np.where(some, hi - lo, 1)]
        a = self.most[level, np.where(some, lo, 0)]
        b = self.most[level, np.where(some, hi - (1 << level), 0)]
        at = np.where(self.impact[a] >= self.impact[b], a, b)
        most = np.where(some, self.impact[at] * weight, 0)
        rows = np.arange(len(lo))
        # a weight of 0 has no largest; any posting will do
        first = np.where(some, most, -1).argmax(axis=1)
        return most.sum(axis=1), self.doc[at[rows, first]]

    def search(self, codes: np.ndarray, weights: np.ndarray, ids: list[tuple], k: int, best: list[tuple]) -> None:
        """Puts the block's documents that are among the ``k`` best for these terms into ``best``, (-score, id) ascending."""
        own = [(self.lists[c], w) for c, w in zip(codes.tolist(), weights.tolist(), strict=True) if c in self.lists and w > 0]
        if not own:
            return
        at, weight = (np.array(x, dtype=np.int64) for x in zip(*own, strict=True))
        lo, hi = self.start[at][None, :], self.start[at + 1][None, :]
        first = np.zeros(1, dtype=np.int64)
        bound, split = self.bounds(lo, hi, weight)
        while True:
            if len(best) == k:
                worst = -best[-1][0]
                hope = (bound > worst) | ((bound == worst) & (first < bisect_left(ids, best[-1][1])))
            else:
                hope = bound > 0
            if not hope.any():
                return
            if not hope.all():
                lo, hi, first, bound, split = (x[hope] for x in (lo, hi, first, bound, split))
            if len(bound) > STEP:
                order = np.argpartition(-bound, STEP)
                now, later = order[:STEP], order[STEP:]
            else:
                now, later = np.arange(len(bound)), np.zeros(0, dtype=np.int64)
            doc, b = split[now], hi[now]
            place = np.searchsorted(self.key, at[None, :] * self.n_docs + doc[:, None])
            inside = place < b
            hit = inside & (self.doc[np.where(inside, place, 0)] == doc[:, None])
            score = (np.where(hit, self.impact[np.where(hit, place, 0)], 0) * weight).sum(axis=1)
            least = -best[-1][0] if len(best) == k else 1
            for s, d in sorted(zip(score.tolist(), doc.tolist(), strict=True), reverse=True):
                if s < least:
                    break
                insort(best, (-s, ids[d]))
                del best[k:]
            parts = (np.concatenate([lo[now], place + hit]), np.concatenate([place, b]), np.concatenate([first[now], doc + 1]))
            new_bound, new_split = self.bounds(parts[0], parts[1], weight)
            lo, hi, first = (np.concatenate([x[later], y]) for x, y in zip((lo, hi, first), parts, strict=True))
            bound, split = np.concatenate([bound[later], new_bound]), np.concatenate([split[later], new_split])


def impacts(tf: np.ndarray, doc: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The postings' parts of a score before their terms' weights, in whole numbers; ``lengths`` are the documents'."""
    m = np.array([10 + 90 * n * n_docs // n_terms for n in lengths.tolist()], dtype=np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _index(docs: DataFrame, vocabulary) -> DataFrame:
    """The blocks of ``docs`` (``i, t``) with their postings of the terms of ``vocabulary``, a broadcast dictionary."""
    schema = docs.sparkSession.createDataFrame([], INDEX.format(id=dict(docs.dtypes)["i"])).schema

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, kind = vocabulary.value.get, None
        for batch in batches:
            kind = batch.schema.field(0).type
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for lo, hi in chunks([max(len(t or b""), BLOCK_BYTES // DOCS) for t in texts], BLOCK_BYTES):
                yield block(batch.column(0).slice(lo, hi - lo), texts[lo:hi], get, kind)

    def block(ids: pa.Array, texts: list[bytes | None], get, kind: pa.DataType) -> pa.RecordBatch:
        order = pc.sort_indices(ids).to_pylist()
        lengths, codes = [], []
        for d in order:
            words = terms(texts[d])
            lengths.append(len(words))
            codes.append(np.fromiter(map(get, words, repeat(-1)), dtype=np.int64, count=len(words)))
        size, sizes = len(texts), np.array(lengths, dtype=np.int64)
        code = np.concatenate(codes)
        doc = np.repeat(np.arange(size, dtype=np.int64), sizes)
        key, tf = np.unique((code * size + doc)[code >= 0], return_counts=True)
        held, at = np.unique(key % size, return_inverse=True)
        term, count = np.unique(key // size, return_counts=True)
        kept = [ids.take(pa.array(order, pa.int64())).take(pa.array(held)), sizes[held], term, count, at, tf]
        lists = [pa.array([x.to_pylist() if isinstance(x, pa.Array) else x], pa.list_(t)) for x, t in zip(kept, (kind, pa.int64(), *[pa.int32()] * 4), strict=True)]
        return pa.RecordBatch.from_arrays([*lists, pa.array([int((sizes > 0).sum())], pa.int64()), pa.array([int(sizes.sum())], pa.int64())], names=schema.names)

    return docs.mapInArrow(blocks, schema)


def _search(index: DataFrame, asked, k: int) -> DataFrame:
    """``q, i, score``: of each task's blocks, the ``k`` best documents of each item. ``asked`` is broadcast: items' codes and weights, counts."""
    id_type = index.schema["ids"].dataType.elementType.simpleString()

    def best_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, n_docs, n_terms = asked.value
        best: list[list[tuple]] = [[] for _ in items]
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type.value_type
            for r in range(batch.num_rows):
                ids = [(x is None, x) for x in batch.column(0)[r].as_py()]
                lengths, term, count, doc, tf = (np.asarray(batch.column(c)[r].values, dtype=np.int64) for c in range(1, 6))
                if not len(doc):
                    continue
                postings = Postings(term, np.r_[0, np.cumsum(count)], doc, impacts(tf, doc, lengths, n_docs, n_terms), len(ids))
                for q, (codes, weights) in enumerate(items):
                    postings.search(codes, weights, ids, k, best[q])
        rows = [(q, x[1][1], -x[0]) for q, own in enumerate(best) for x in own]
        if rows:
            q, i, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(i, kind), pa.array(score, pa.int64())], names=["q", "i", "score"])

    columns = ["ids", "lengths", "terms", "counts", "docs", "tfs"]
    return index.select(*columns).mapInArrow(best_of, f"q int, i {id_type}, score bigint")


def ranked_search(
    df: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Returns ``item_col, rank, id_col, score``: the ``k`` documents of highest score above 0 for each item, equal scores by id.

    A term's score is its weight, ``floor(1000 ln((2 N + 2) / (2 df + 1)))``, times its impact, ``10^9 tf div (1000 tf + 8 m)``, where ``m`` is
    ``10 + 90 n N div L`` for a document of ``n`` terms among ``N`` documents with ``L`` terms. If both ids have one name, the item's
    is returned as ``item_`` and that name.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).alias("i"), F.col(text).cast("string").alias("t"))
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text).cast("string").alias("t")).filter("t is not null").distinct()
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("t")).alias("chars")).first()
    n_shards = max(1, -(-size["n"] // ITEMS), -(-(size["chars"] or 0) // CHARS))
    asked = staged(asked.withColumn("k", F.pmod(F.xxhash64("item", "t"), F.lit(n_shards))), "items")
    item_out, item_type = f"item_{item_col}" if item_col == id_col else item_col, dict(items.dtypes)[item_col]
    result = None
    for shard in range(n_shards):
        own = [(r["item"], sorted(set(terms(r["t"].encode())))) for r in asked.filter(F.col("k") == shard).orderBy("item", "t").collect()]
        vocabulary = {w: c for c, w in enumerate(sorted({w for _, words in own for w in words}))}
        index = staged(_index(docs, spark.sparkContext.broadcast(vocabulary)), "postings")
        total = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms"), F.count(F.lit(1)).alias("blocks")).first()
        each = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("df"))
        n_docs, frequency = total["docs"] or 0, dict(each.collect())
        queries = []
        for _, words in own:
            codes = [c for w in words if (c := vocabulary[w]) in frequency]
            queries.append((np.array(codes, dtype=np.int64), np.array([weight(frequency[c], n_docs) for c in codes], dtype=np.int64)))
        # a block is small on disk and much work
        spread = index.repartition(max(1, total["blocks"] // BLOCKS))
        found = _search(spread, spark.sparkContext.broadcast((queries, n_docs, total["terms"])), k)
        last = Window.orderBy(F.desc("score"), F.col("i").asc_nulls_last())
        for keys in (["q", F.pmod(F.xxhash64("i"), F.lit(32))], ["q"]):
            found = found.withColumn("rank", F.row_number().over(last.partitionBy(*keys))).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(own)], f"q int, item {item_type}")
        named = found.join(F.broadcast(names), "q").select(F.col("item").alias(item_out), "rank", F.col("i").alias(id_col), "score")
        result = named if result is None else result.unionByName(named)
    return result
