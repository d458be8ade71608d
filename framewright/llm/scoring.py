"""Stupid-backoff language-model scores, computed relationally.

The score of a word is the log of its trigram's count over its context's, else 0.4 times the
same for the bigram, else 0.16 times its unigram's share. Counts cover the whole corpus less
the scored document itself (leave one out), so no text vouches for itself. A document's score is
the mean over its words; a word that no other document has counts as seen half a time.

``backoff_scores_by_rows`` is the plain form: a row for each n-gram of each text, a count table
partitioned by hash, joins and sums. Its shuffles take over ten times the input's disk, so
``backoff_scores`` does the same join on packed rows, each a block of texts by a part of the hashes:

1. Texts are packed into blocks of neighbouring rows. A block lists its distinct n-grams once
   each, as 64-bit hashes with counts, split by hash into ``parts``.
2. Each part adds up its n-grams over all blocks: the count table, partitioned by hash. It
   sends every block the totals of the n-grams that it asked for, in the same order.
3. Each block joins the totals to its documents' n-grams and sums the scores.

So a frequent n-gram has one entry a block, whatever its count, and no key is hot. Blocks and
parts grow in number with the corpus, not in size; there are never more packed rows than distinct n-grams of
blocks. Both sides list a block's n-grams in ascending order; a digest of each list is sent along and checked.
A block is a run of rows, whatever they hold, so repeated rows and nulls fill as many blocks as others.
Ascending hashes are sent whole: the low five bytes as they are, the rest as differences, deflated.

Null and empty texts have no words and a null score. Repeated rows count as documents of their
own. Other columns are not returned.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.common import WORD, WORD_SQL, ascii_lower, chunks, lower_ascii, mix, staged, word_count

ORDER = 3
ALPHA = 0.4
#: Characters of a block and of a part's n-grams, about.
BLOCK_CHARS, PART_CHARS = 5_000_000, 3_000_000
#: What a row adds to a block's characters, so that empty texts fill blocks too.
ROW_CHARS = 16
#: Bytes of a hash that are sent as they are.
LOW = 5


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The document of each word, and hashes of the n-grams that end there: a row an order, 0 where the document has fewer words before."""
    words = [WORD.findall(lower_ascii(t)) if t else [] for t in texts]
    doc = np.repeat(np.arange(len(words)), [len(w) for w in words])
    codes, kinds = pd.factorize(np.array([x for w in words for x in w], dtype=object))
    table = np.array([xxhash.xxh3_64_intdigest(k.encode()) for k in kinds], dtype=np.uint64)
    one = mix(table[codes]) if len(codes) else np.zeros(0, dtype=np.uint64)
    keys = np.zeros((ORDER, len(one)), dtype=np.uint64)
    for k in range(ORDER):
        if k < len(one):
            own = one[: len(one) - k].copy()
            for i in range(1, k + 1):
                own = mix(own) + one[i : len(one) - k + i]
            own = np.maximum(mix(own + np.uint64(k)), np.uint64(1))
            keys[k, k:] = np.where(doc[: len(one) - k] == doc[k:], own, 0)
    return doc, keys


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def pack_numbers(numbers: np.ndarray, strategy: int = zlib.Z_DEFAULT_STRATEGY) -> bytes:
    """A byte for each number, then four for each of those over 254, deflated; most are small."""
    deflate = zlib.compressobj(1, strategy=strategy)
    small, large = np.minimum(numbers, 255).astype(np.uint8), numbers[numbers >= 255].astype("<u4")
    return deflate.compress(small.tobytes() + large.tobytes()) + deflate.flush()


def unpack_numbers(raw, n: int) -> np.ndarray:
    raw = zlib.decompress(raw)
    out = np.frombuffer(raw, dtype=np.uint8, count=n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, dtype="<u4", offset=n)
    return out


def pack_keys(keys: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending hashes as their low bytes, and the differences of what is above those."""
    low = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :LOW].tobytes()
    # the differences are near one another and in no pattern, so only their frequencies help
    return low, pack_numbers(np.diff((keys >> np.uint64(8 * LOW)).astype(np.int64), prepend=0), zlib.Z_HUFFMAN_ONLY)


def unpack_keys(low, high) -> np.ndarray:
    rows = np.frombuffer(low, dtype=np.uint8).reshape(-1, LOW)
    out = np.zeros((len(rows), 8), dtype=np.uint8)
    out[:, :LOW] = rows
    return out.view("<u8").reshape(-1) | (np.cumsum(unpack_numbers(high, len(rows))).astype(np.uint64) << np.uint64(8 * LOW))


def digest(keys: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(keys.astype("<u8").tobytes()) >> 1


def listed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct n-grams in ascending order, so by part; and the place of each n-gram in that list."""
    flat = keys.reshape(-1)
    order, inverse = np.unique(flat[flat > 0], return_inverse=True)
    at = np.full(len(flat), -1, dtype=np.int64)
    at[flat > 0] = inverse
    return order, at.reshape(keys.shape)


def packed(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """``block, rows``: runs of the rows ``id_at, t`` of about ``limit`` characters, numbered within the partition."""
    first = TaskContext.get().partitionId() << 33
    held: list[pa.RecordBatch] = []
    chars, block = 0, 0

    def written() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as out:
            out.write_table(pa.Table.from_batches(held).combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array([first + block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "rows"])

    for batch in batches:
        sizes = (pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_CHARS).tolist()
        for lo, hi in chunks(sizes, limit // 8):
            own = sum(sizes[lo:hi])
            if held and chars + own > limit:
                yield written()
                held, chars, block = [], 0, block + 1
            held.append(batch.slice(lo, hi - lo))
            chars += own
    if held:
        yield written()


def unpacked(raw) -> pa.Table:
    return pa.ipc.open_stream(raw.as_buffer()).read_all()


def scores(doc: np.ndarray, keys: np.ndarray, at: np.ndarray, totals: np.ndarray, n_corpus: int, n_docs: int) -> pd.DataFrame:
    """Sums and counts for each document of a block. ``totals``: corpus counts in the block's order."""
    size = np.bincount(doc, minlength=n_docs)
    other = np.zeros(keys.shape, dtype=np.int64)
    for k in range(ORDER):
        has = keys[k] > 0
        # less what the document itself has
        pair = doc[has] * np.int64(len(totals) or 1) + at[k][has]
        own = np.unique(pair, return_inverse=True, return_counts=True)
        other[k, has] = totals[at[k][has]] - own[2][own[1]]
    rest = np.maximum(n_corpus - size[doc], 1)
    value = np.log(ALPHA ** (ORDER - 1) * np.maximum(other[0], 0.5) / rest)
    used = np.zeros(len(doc), dtype=np.int64)
    for k in range(1, ORDER):
        seen = np.zeros(len(doc), dtype=bool)
        seen[1:] = (other[k][1:] > 0) & (other[k - 1][:-1] > 0)
        i = np.flatnonzero(seen)
        value[i] = np.log(ALPHA ** (ORDER - 1 - k) * other[k][i] / other[k - 1][i - 1])
        used[i] = k
    out = {"n_words": size, "score": np.bincount(doc, value, n_docs)}
    return pd.DataFrame(out | {f"n_order{k + 1}": np.bincount(doc, used == k, n_docs).astype(np.int64) for k in range(ORDER)})


def backoff_scores_by_rows(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``backoff_scores``, with a row for each n-gram and 64-bit hashes, for corpora that leave the disk for it."""
    docs = df.select(F.col(id_col).alias("id_at"), F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(WORD_SQL), 0).alias("w"))
    docs = staged(docs.withColumn("row", F.monotonically_increasing_id()), "lm-docs")
    n_corpus = docs.agg(F.sum(F.size("w"))).first()[0] or 0
    gram = lambda w, i, k: F.xxhash64(*(F.get(w, i - j) for j in reversed(range(k))))
    grams = F.transform("w", lambda _, i: F.array(*(F.when(i >= k - 1, F.struct(F.lit(k).alias("k"), gram(F.col("w"), i, k).alias("h"))) for k in range(1, ORDER + 1))))
    each = docs.select("row", F.posexplode(grams).alias("pos", "own")).select("row", "pos", F.explode("own").alias("g")).filter("g is not null").select("row", "pos", "g.k", "g.h")
    own = each.groupBy("row", "k", "h").agg(F.count(F.lit(1)).alias("m"))
    table = own.groupBy("k", "h").agg(F.sum("m").alias("n"))
    other = own.join(table, ["k", "h"]).select("row", "k", "h", (F.col("n") - F.col("m")).alias("c"))
    at = each.join(other, ["row", "k", "h"]).groupBy("row", "pos").agg(*(F.max(F.when(F.col("k") == k, F.col("c"))).alias(f"c{k}") for k in range(1, ORDER + 1)))
    words = Window.partitionBy("row").orderBy("pos")
    at = at.join(docs.select("row", F.size("w").alias("size")), "row")
    value, used = F.log(ALPHA ** (ORDER - 1) * F.greatest("c1", F.lit(0.5)) / F.greatest(F.lit(n_corpus) - F.col("size"), F.lit(1))), F.lit(1)
    for k in range(2, ORDER + 1):
        context = F.lag(f"c{k - 1}").over(words)
        seen = (F.col(f"c{k}") > 0) & (context > 0)
        value = F.when(seen, F.log(ALPHA ** (ORDER - k) * F.col(f"c{k}") / context)).otherwise(value)
        used = F.when(seen, k).otherwise(used)
    scored = at.withColumn("value", value).withColumn("used", used).groupBy("row").agg(F.avg("value").alias("score"), *(F.count_if(F.col("used") == k).alias(f"n_order{k}") for k in range(1, ORDER + 1)))
    counts = [F.coalesce(f"n_order{k}", F.lit(0)).alias(f"n_order{k}") for k in range(1, ORDER + 1)]
    return docs.join(scored, "row", "left").select(F.col("id_at").alias(id_col), F.size("w").cast("long").alias("n_words"), *counts, "score")


def backoff_scores(df: DataFrame, id_col: str = "doc_id", text: str = "text", stable: bool = False) -> DataFrame:
    """Returns ``id_col, n_words, n_order1, n_order2, n_order3, score`` for every row of ``df``.

    ``n_orderK``: words scored by their n-gram of K words. ``score``: mean log score of a word. ``stable``: ``df`` gives
    the same rows in the same partitions and order each time, as files do, so the packed texts are not written first;
    where it doesn't, the job fails.
    """
    docs = df.select(F.col(id_col).alias("id_at"), F.col(text).cast("string").alias("t"))
    chars, n_corpus = (x or 0 for x in docs.agg(F.sum(F.length("t")), F.sum(word_count(F.col("t")))).first())
    limit, blocks, parts = BLOCK_CHARS, chars // BLOCK_CHARS + 1, chars // PART_CHARS + 1
    # many small partitions would make many small blocks
    docs = docs.coalesce(min(blocks, 1 << 30))
    texts = docs.mapInArrow(lambda batches: packed(batches, limit), "block long, rows binary")
    texts = texts if stable else staged(texts, "lm-texts")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                _, keys = ngrams(unpacked(raw).column("t").to_pylist())
                order, counts = np.unique(keys[keys > 0], return_counts=True)
                edge = np.searchsorted(part_of(order, parts), np.arange(parts + 1))
                rows = [(k, *pack_keys(order[a:b]), pack_numbers(counts[a:b])) for k, (a, b) in enumerate(zip(edge, edge[1:])) if b > a]
                columns = [pa.array([x[i] for x in rows], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(rows), pa.int64()), *columns], names=["block", "part", "low", "high", "counts"])

    def add(key, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        lists = [unpack_keys(x.as_buffer(), y.as_buffer()) for x, y in zip(table.column("low"), table.column("high"), strict=True)]
        counts = [unpack_numbers(x.as_buffer(), len(y)) for x, y in zip(table.column("counts"), lists, strict=True)]
        kinds, inverse = np.unique(np.concatenate(lists), return_inverse=True)
        totals = np.bincount(inverse, np.concatenate(counts), len(kinds)).astype(np.int64)[inverse]
        edge = np.r_[0, np.cumsum([len(x) for x in lists])]
        for i, block in enumerate(table.column("block").to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([key[0].as_py()], pa.int32()), pa.array([pack_numbers(totals[edge[i] : edge[i + 1]])], pa.binary()), pa.array([digest(lists[i])], pa.int64())],
                names=["block", "part", "totals", "digest"],
            )

    def judge(table: pa.Table, answers: pa.Table) -> pa.Table:
        changed = RuntimeError("the input changed between two reads")
        if table.num_rows != 1:
            raise changed
        rows = unpacked(table.column("rows")[0])
        texts = rows.column("t").to_pylist()
        doc, keys = ngrams(texts)
        order, at = listed(keys)
        totals = np.zeros(len(order), dtype=np.int64)
        part = part_of(order, parts)
        for k, raw, own in zip(answers.column("part").to_pylist(), answers.column("totals"), answers.column("digest").to_pylist(), strict=True):
            a, b = np.searchsorted(part, [k, k + 1])
            if digest(order[a:b]) != own:
                raise changed
            totals[a:b] = unpack_numbers(raw.as_buffer(), b - a)
        if not totals.all():
            raise changed
        out = scores(doc, keys, at, totals, n_corpus, len(texts))
        mean = np.where(out["n_words"] > 0, out["score"] / np.maximum(out["n_words"], 1), np.nan)
        columns = [pa.array(out[c].to_numpy(), pa.int64()) for c in ("n_words", "n_order1", "n_order2", "n_order3")]
        return pa.table([rows.column("id_at"), *columns, pa.array(mean, pa.float64(), from_pandas=True)], names=["id_at", "n_words", "n_order1", "n_order2", "n_order3", "score"])

    add.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    # one function for both, as two would be two workers a task
    grams = "block long, part int, low binary, high binary, counts binary"
    asked = docs.mapInArrow(lambda batches: ask(packed(batches, limit)), grams) if stable else texts.mapInArrow(ask, grams)
    answers = asked.groupBy("part").applyInArrow(add, "block long, part int, totals binary, digest long")
    schema = f"id_at {dict(df.dtypes)[id_col]}, n_words long, n_order1 long, n_order2 long, n_order3 long, score double"
    found = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(judge, schema)
    return found.withColumnRenamed("id_at", id_col)
