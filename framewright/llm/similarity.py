"""N-gram Jaccard join with adaptive multi-match prefixes, and near-duplicate groups.

A document is the set of its distinct word n-grams (shingles), kept as 64-bit hashes.
Documents with equal sets form one node. Two nodes link when their Jaccard similarity is at
least ``num / den``. The steps:

1. A sketch counts all shingles in buckets and so gives each shingle a class of frequency. It grows
   with the corpus from 2 ** 22 to 2 ** 24 buckets, a byte each, and only sets an order: classes ascending, then hashes.
2. Two similar nodes of n and m shingles share ``need = ceil((n + m) * num / (num + den))`` of them, so at
   least l of the first ``n - need + l`` and ``m - need + l`` in that order: their prefixes at level l. Each
   node picks the level with the least estimated cost: postings to read, and candidates to
   verify, which get fewer as more matches are asked for.
3. Nodes that share a MinHash value are verified against one leader and joined to it first.
   So large groups of near copies become one component with a number of pairs that is
   linear in their size.
4. Prefixes are joined on the shingle and a band of set sizes, for nodes in different components
   only, and for pairs that pass a bitmap bound on the symmetric difference. The smaller
   node of a pair probes, and the pair needs as many matches as its level. A match counts only
   where its places leave room for the overlap that the pair's two sizes require: own shingles
   come first, so what two copies of a third text share comes too late in both to pair them.
5. Pairs left after a finer bitmap bound are verified on the whole sets.
6. Links give components; each row gets the smallest id that its node reaches.

No posting, candidate or partner is capped. Pairs inside a component need not be verified, as
they can't change it. Hashes of shingles are 64 bits wide, so a false match of two
shingles of one pair has a chance of about 1e-13. Sets are told apart by 128 bits: a 64-bit name
and a check, and sets that share a name but not the check are renamed.

Null and empty texts, and texts without a word, have an empty set and link with nothing. Rows
with a null id keep their set size and have a null component. Repeated ids and rows stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm.common import WORD, chunks, lower_ascii, mix, staged
from framewright.llm.components import components

#: Bits of the sketch, least and most; shingles a bucket up to which it is not made larger; counters sent in a piece.
BITS, FILL, SEGMENT = (22, 24), 64, 1024
MINHASHES = 3
LEVELS = 4
#: Cost of a verification in postings read, and how much rarer candidates get with each match asked for.
VERIFY_COST, SELECTIVITY = 50.0, 8.0
BLOCK_WORDS = 200_000
#: Up to so many ids of candidates are broadcast; more are joined by a shuffle of the texts.
BROADCAST_IDS = 1_000_000
#: A bit for each of 512 classes of hashes: whether the set has an odd number of that class. Folded: of 256 classes.
_BITMAP, _FOLDED = [f"b{k}" for k in range(8)], [f"c{k}" for k in range(4)]


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Ascending hashes of the distinct shingles of each text; whole shorter texts are one shingle."""
    words = [WORD.findall(lower_ascii(t)) if t else [] for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    codes, kinds = pd.factorize(np.array([x for w in words for x in w], dtype=object))
    table = np.array([xxhash.xxh3_64_intdigest(k.encode()) for k in kinds], dtype=np.uint64)
    flat = table[codes] if len(codes) else np.zeros(0, dtype=np.uint64)
    key = flat.copy()
    for k in range(1, n):
        last = max(0, len(key) - k)
        key[:last] = mix(key[:last]) + flat[k:]
    start, sets = 0, []
    for size in sizes.tolist():
        if size >= n:
            sets.append(np.unique(mix(key[start : start + size - n + 1])))
        elif size:
            whole = flat[start : start + 1]
            for k in range(1, size):
                whole = mix(whole) + flat[start + k : start + k + 1]
            sets.append(mix(mix(whole) + np.uint64(size)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
        start += size
    return sets


def node_of(own: np.ndarray) -> tuple[int, int]:
    """A 64-bit name of the set and a 64-bit check, the same for equal sets."""
    once = mix(own)
    sums = np.array([own.sum(dtype=np.uint64) ^ np.uint64(len(own)) ^ np.bitwise_xor.reduce(once), once.sum(dtype=np.uint64)], dtype=np.uint64)
    name, check = mix(sums).view(np.int64).tolist()
    return name, check


def renamed(name: int, check: int) -> int:
    """Another name for one of the sets that share theirs."""
    return int(mix(mix(np.array([name], dtype=np.int64).view(np.uint64)) + np.array([check], dtype=np.int64).view(np.uint64)).view(np.int64)[0])


def _in_blocks(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for lo, hi in chunks([len(t or "") // 6 + 1 for t in texts], BLOCK_WORDS):
            yield batch.slice(lo, hi - lo), shingle_sets(texts[lo:hi], n)


def frequency_classes(docs: DataFrame, n: int) -> np.ndarray:
    """A class for each bucket of the sketch: 0 up to what chance brings there, then one more for each doubling."""
    words = (docs.agg(F.sum(F.length("text_at"))).first()[0] or 0) / 6
    bits = next((b for b in range(*BITS) if words <= FILL * 2**b), BITS[1])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int32)
        for _, sets in _in_blocks(batches, n):
            at, times = np.unique(np.concatenate(sets) >> np.uint64(64 - bits), return_counts=True)
            total[at.astype(np.int64)] += times.astype(np.int32)
        while len(at := np.flatnonzero(total.reshape(-1, SEGMENT).any(axis=1))):
            # a byte for each counter; what is over 255 follows in another piece
            piece = np.minimum(total, 255).astype(np.uint8).reshape(-1, SEGMENT)
            total -= piece.reshape(-1)
            for part in np.array_split(at, max(1, len(at) // 512)):
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([piece[i].tobytes() for i in part], pa.binary())], names=["segment", "counts"])

    def add(key, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SEGMENT, dtype=np.int64)
        for batch in batches:
            for x in batch.column("counts").to_pylist():
                total += np.frombuffer(x, dtype=np.uint8)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary()), pa.array([int(total.sum())], pa.int64())], names=["segment", "counts", "n"]
        )

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(1).to_pylist():
                above = (np.frombuffer(x, dtype=np.int64) - mean) / max(2.0 * math.sqrt(mean), 2.0)
                out.append(np.ceil(np.log2(np.maximum(above, 1.0))).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["segment", "classes"])

    add.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    pieces = docs.mapInArrow(count, "segment int, counts binary")
    counts = staged(pieces.groupBy("segment").applyInArrow(add, "segment int, counts binary, n bigint"), "sketch")
    mean = (counts.agg(F.sum("n")).first()[0] or 0) / (1 << bits)
    classes = np.zeros((1 << bits) // SEGMENT * SEGMENT, dtype=np.uint8).reshape(-1, SEGMENT)
    for r in counts.select("segment", "counts").mapInArrow(classify, "segment int, classes binary").collect():
        classes[r["segment"]] = np.frombuffer(r["classes"], dtype=np.uint8)
    return classes.reshape(-1)


def required(n: int, num: int, den: int) -> int:
    """The least overlap of a set of ``n`` with any similar set."""
    return -(-num * n // den)


def _level(classes: np.ndarray, first: int, most: int) -> int:
    """The level whose prefix costs least. ``classes`` of the prefix at the highest level; class c stands for 4 * 2 ** c expected partners, class 0 for few."""
    partners = np.where(classes > 0, 4.0 * 2.0 ** classes.astype(np.float64), 0.1)
    read = np.cumsum(partners)
    cost = [read[min(first + k, len(read)) - 1] * (1 + VERIFY_COST / SELECTIVITY**k) for k in range(most)]
    return int(np.argmin(cost)) + 1


SKETCH = "id_at bigint, n bigint, node bigint, check bigint, rare bigint, prefix array<bigint>, level int, hashes array<bigint>, " + ", ".join(f"{b} bigint" for b in _BITMAP)


def _described(docs: DataFrame, n: int, num: int, den: int, id_type: str) -> DataFrame:
    found = frequency_classes(docs, n)
    classes, width = docs.sparkSession.sparkContext.broadcast(found), len(found).bit_length() - 1
    seeds = mix(np.arange(1, MINHASHES + 1, dtype=np.uint64))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _in_blocks(batches, n):
            prefixes, levels, hashes, names, rare, bitmaps = [], [], [], [], [], np.zeros((len(sets), 512), dtype=np.uint8)
            for i, own in enumerate(sets):
                if not len(own):
                    prefixes.append([]), levels.append(0), hashes.append([]), names.append((None, None)), rare.append(0)
                    continue
                need = required(len(own), num, den)
                most = min(LEVELS, need)
                kind = classes.value[(own >> np.uint64(64 - width)).astype(np.int64)]
                # ``own`` ascends, so a stable sort by class orders by class, then hash
                order = np.argsort(kind, kind="stable")[: len(own) - need + LEVELS]
                first = len(own) - required(len(own), 2 * num, num + den) + 1
                prefixes.append(own[order].view(np.int64)), levels.append(_level(kind[order], first, most))
                hashes.append(np.array([mix(own ^ s).min() for s in seeds], dtype=np.uint64).view(np.int64))
                names.append(node_of(own)), rare.append(int((kind == 0).sum()))
                bitmaps[i] = np.bincount((own & np.uint64(511)).astype(np.int64), minlength=512) & 1
            bits = np.packbits(bitmaps, axis=1).view(np.int64)
            arrays = [pa.array(x, pa.list_(pa.int64())) for x in (prefixes, hashes)]
            node, check = (pa.array([x[k] for x in names], pa.int64()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in sets], pa.int64()), node, check, pa.array(rare, pa.int64()), arrays[0], pa.array(levels, pa.int32()), arrays[1]]
                + [pa.array(bits[:, k], pa.int64()) for k in range(8)],
                names=["id_at", "n", "node", "check", "rare", "prefix", "level", "hashes", *_BITMAP],
            )

    return docs.mapInArrow(describe, SKETCH.replace("id_at bigint", f"id_at {id_type}"))


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, num: int, den: int, names: dict[tuple[int, int], int]) -> DataFrame:
    """The links among the candidates ``pairs`` (``u, v``), as ``u, v``; ``names`` are those of renamed sets."""
    about = nodes.select("node", "n", *_BITMAP)
    one = about.toDF("u", "un", *(f"u{b}" for b in _BITMAP))
    two = about.toDF("v", "vn", *(f"v{b}" for b in _BITMAP))
    apart = sum((F.bit_count(F.col(f"u{b}").bitwiseXOR(F.col(f"v{b}"))) for b in _BITMAP), F.lit(0))
    # similar sets differ in at most (un + vn) * (den - num) / (den + num) members, and each bit that differs shows one
    near = (apart * (den + num) <= (F.col("un") + F.col("vn")) * (den - num)) & (F.least("un", "vn") * den >= F.greatest("un", "vn") * num)
    pairs = staged(pairs.join(one, "u").join(two, "v").filter(near).select("u", "v"), "pairs")
    wanted = pairs.select(F.col("u").alias("node")).union(pairs.select(F.col("v").alias("node"))).distinct()
    ids = nodes.join(wanted, "node", "left_semi").select(F.col("rep").alias("id_at"))
    if wanted.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _in_blocks(batches, n):
            sets = [x for x in sets if len(x)]
            own = [names.get(x, x[0]) for x in map(node_of, sets)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["node", "members"])

    sets = docs.join(ids, "id_at", "left_semi").mapInArrow(sets_of, "node bigint, members binary").dropDuplicates(["node"])
    sets = staged(sets, "sets")
    both = pairs.join(sets.toDF("u", "a"), "u").join(sets.toDF("v", "b"), "v")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (a, b))
                common = len(a) + len(b) - len(np.union1d(a, b))
                keep.append(common * den >= (len(a) + len(b) - common) * num)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("u", "v", "a", "b").mapInArrow(similar, "u bigint, v bigint")


def similar_components(df: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """Returns ``id_col, n_shingles, component_id`` for every row of ``df``."""
    if not 0 < num <= den:
        raise ValueError("the similarity must lie in (0, 1]")
    id_type = dict(df.dtypes)[id_col]
    docs = df.select(F.col(id_col).alias("id_at"), F.col(text).cast("string").alias("text_at"))
    rows = staged(_described(docs, n, num, den, id_type), "described")
    first = ("n", "rare", "level", "hashes", *_BITMAP)

    def by_name(rows: DataFrame) -> DataFrame:
        own = rows.filter("node is not null and id_at is not null").groupBy("node")
        return staged(own.agg(F.min("id_at").alias("rep"), F.min("check").alias("lo"), F.max("check").alias("hi"), *(F.first(c).alias(c) for c in first)), "nodes")

    nodes, names = by_name(rows), {}
    # some three in 10 ** 10 sets share a name by chance
    same = nodes.filter("lo <> hi").select("node")
    if not same.isEmpty():
        clash = rows.join(same, "node", "left_semi").select("node", "check").distinct().collect()
        names = {(r["node"], r["check"]): renamed(r["node"], r["check"]) for r in clash}
        other = docs.sparkSession.createDataFrame([(*k, v) for k, v in names.items()], "node bigint, check bigint, other bigint")
        columns = rows.columns
        rows = rows.join(F.broadcast(other), ["node", "check"], "left").withColumn("node", F.coalesce("other", "node")).select(columns)
        nodes = by_name(rows)
    nodes = nodes.drop("lo", "hi")

    # near copies of a leader: of the nodes that share a MinHash value, the one with the fewest rare shingles, so with
    # the fewest changes of its own
    keys = nodes.select("node", "rare", F.posexplode("hashes").alias("k", "h"))
    least = F.min(F.struct("rare", "node"))
    leaders = keys.groupBy("k", "h").agg(least.alias("u"), F.count(F.lit(1)).alias("m")).filter("m > 1").select("k", "h", F.col("u.node").alias("u"))
    # written, so that the join shuffles both sides and Spark can split a value that many nodes share
    leaders = staged(leaders, "leaders")
    starts = keys.join(leaders, ["k", "h"]).filter("node <> u").select("u", F.col("node").alias("v")).distinct()
    early = staged(_verified(starts, nodes, docs, n, num, den, names), "links")
    roots = components(early)

    # all other pairs, of nodes in different components
    width = math.log(den / num) if num < den else 1.0
    band = F.floor(F.log(F.col("n").cast("double")) / width + 1e-9).cast("int")
    # the level at which a node's shingle comes into the prefix of a probe, whose partners have its size or more
    came = F.col("pos") + 1 - (F.col("n") - F.ceil(F.col("n") * 2 * num / (num + den)))
    folded = [F.col(f"b{k}").bitwiseXOR(F.col(f"b{k + 4}")).alias(f"c{k}") for k in range(4)]
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    prefixes = rows.filter("node is not null and id_at is not null").groupBy("node").agg(F.first("prefix").alias("prefix"))
    # what goes to the shuffle on all shingles of prefixes is narrow; the rest is added to what is shared between components
    tokens = prefixes.join(placed.select("node", "root", "rare"), "node").select("node", "root", "rare", F.posexplode("prefix").alias("pos", "token"))
    # a prefix begins with its rare shingles. A window sorts and spills their rows, and needs no second shuffle; frequent
    # ones, whose rows may be many, are summed before the shuffle and joined back
    same = Window.partitionBy("token")
    rare = tokens.filter("pos < rare").withColumn("lo", F.min("root").over(same)).withColumn("hi", F.max("root").over(same)).filter("lo <> hi")
    frequent = tokens.filter("pos >= rare")
    several = frequent.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("token")
    shared = rare.select("node", "pos", "token").union(frequent.join(several, "token", "left_semi").select("node", "pos", "token"))
    postings = shared.join(placed.select("node", "n", "root", band.alias("band"), "level", *folded), "node")
    postings = staged(postings, "postings")
    probe = postings.filter(came <= F.col("level")).select("token", F.explode(F.array("band", F.col("band") + 1)).alias("band"), *(F.col(c).alias(f"u_{c}") for c in ("node", "n", "pos", "root", "level", *_FOLDED)))
    apart = sum((F.bit_count(F.col(f"u_{c}").bitwiseXOR(F.col(c))) for c in _FOLDED), F.lit(0))
    # the overlap that the pair needs, less what may follow a match that is the level's last
    before = F.ceil((F.col("u_n") + F.col("n")) * num / (num + den)) - F.col("u_level")
    found = probe.join(postings.drop("level"), ["token", "band"]).filter(
        (F.col("u_n") - F.col("u_pos") - 1 >= before)
        & (F.col("n") - F.col("pos") - 1 >= before)
        & (F.col("u_root") != F.col("root"))
        & ((F.col("u_n") < F.col("n")) | ((F.col("u_n") == F.col("n")) & (F.col("u_node") < F.col("node"))))
        & (F.col("n") * num <= F.col("u_n") * den)
        & (apart * (den + num) <= (F.col("u_n") + F.col("n")) * (den - num))
    )
    matches = found.groupBy(F.col("u_node").alias("u"), F.col("node").alias("v")).agg(F.count(F.lit(1)).alias("m"), F.first("u_level").alias("level"))
    late = _verified(matches.filter("m >= level").select("u", "v"), nodes, docs, n, num, den, names)
    roots = components(early.unionByName(late))

    named = nodes.select("node", "rep").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # written, so that the join can be split where a component has very many nodes
    least = staged(named.groupBy("root").agg(F.min("rep").alias("component_id")), "least")
    named = named.join(least, "root").select("node", "component_id")
    labelled = rows.select("id_at", "n", "node").join(named, "node", "left")
    component = F.when(F.col("n") == 0, F.col("id_at")).when(F.col("id_at").isNotNull(), F.col("component_id"))
    return labelled.select(F.col("id_at").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``df`` with one row of each component: the one with the smallest id.

    Rows with a null id, and texts without a word, stay. Of rows that repeat both the id and
    the text, one stays. Rows that share an id but not the text go only if all of them do, so that no
    text is lost: a copy among them may stay.

    Up to ``BROADCAST_IDS`` ids to drop are broadcast, so texts stay where they are; for more,
    texts are shuffled once.
    """
    found = staged(similar_components(df, id_col, text, n, num, den), "components")
    by_id = found.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id_at")).agg(F.min(F.col(id_col) != F.col("component_id")).alias("goes"), F.count(F.lit(1)).alias("times"))
    marks = staged(by_id.filter("goes or times > 1").select("id_at", F.when(F.col("goes"), "drop").otherwise("again").alias("mark_at")), "marks")
    counts = {r["mark_at"]: r["count"] for r in marks.groupBy("mark_at").count().collect()}
    few = sum(counts.values()) <= BROADCAST_IDS
    rows, mark = df.join(F.broadcast(marks) if few else marks, df[id_col] == marks["id_at"], "left"), marks["mark_at"]
    own = [df[c] for c in df.columns]
    kept = rows.filter(mark.isNull()).select(own)
    if not counts.get("again"):
        return kept
    return kept.unionByName(rows.filter(mark == "again").select(own).dropDuplicates([id_col, text]))
