"""The pipeline on a small table, each stage against brute force over what the stage before kept."""

import itertools
import re
from collections import Counter

import corpus_pipeline
import duckdb
from pyspark.sql import functions as F

from framewright.llm import queries
from framewright.llm.decontamination import Index, half_of, question_answer, terms

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def sound(docs):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    return {d for d, kept in con.execute(f"SELECT doc_id, kept FROM ({queries.OP3_SQL})").fetchall() if kept}


def unlike(rows):
    """One row of each component of texts of similarity 0.8 over five-word shingles, and texts without a word."""
    sets = []
    for _, text in rows:
        words = WORD.findall(text.encode().lower().decode() if text else "")
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    least = list(range(len(rows)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
            least[max(root(i), root(j))] = min(root(i), root(j))
    return {d for i, (d, _) in enumerate(rows) if root(i) == i}


def clean(rows, items):
    index, out = Index(items), set()
    for d, text in rows:
        words, leak = terms(text), False
        for i, (_, item) in enumerate(items):
            half = half_of(len(terms(item)))
            for at in range(0, len(words), half):
                window = words[at : at + 2 * half]
                own = {index.vocabulary[w] for w in window if w in index.vocabulary}
                if sum(index.impacts[i].get(t, 0) for t in own) >= 0.5:
                    share = []
                    for part in question_answer(item):
                        n = min(3, len(part))
                        grams = {tuple(part[k : k + n]) for k in range(len(part) - n + 1)} if n else set()
                        near = {tuple(window[k : k + n]) for k in range(len(window) - n + 1)}
                        share.append(len(grams & near) / len(grams) if grams else 1.0)
                    leak |= share[0] >= 0.6 and share[1] >= 0.5
        if not leak:
            out.add(d)
    return out


def masked(text):
    found = [(m.start(), m.end()) for m in re.finditer(ASSIGN, text) if len(m.group(1)) >= 8]
    found += [(m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]{12,}", text)] + [(m.start(), m.end()) for m in re.finditer("(?<![0-9a-f])[0-9a-f]{32,}", text)]
    for k, (a, b) in enumerate(sorted(found)):
        found[k] = (a, b)
    out, at = [], 0
    for a, b in sorted(found):
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def test_stages_are_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    stages, pairs = dict(corpus_pipeline.STAGES), lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())
    before, shrunk = docs, []
    for name, want in (("quality", lambda rows: sound(before)), ("near_duplicates", unlike), ("decontamination", lambda rows: clean(rows, items))):
        rows = pairs(before)
        stages[name](spark, before, sf_dir).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        kept = want(rows)
        assert after.columns == docs.columns and pairs(after) == [x for x in rows if x[0] in kept], name
        shrunk.append(len(rows) - after.count())
        before = after
    assert all(shrunk)
    out = stages["secrets"](spark, before, sf_dir)
    assert pairs(out) == [(d, masked(t)) for d, t in pairs(before)] and out.columns == docs.columns
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
    packed = stages["packing"](spark, out, sf_dir)
    length = Counter()
    for r in packed.collect():
        length[r["doc_id"]] += r["length"]
    assert length == {d: len(WORD.findall(t)) for d, t in pairs(out)}
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == Counter(map(tuple, packed.collect()))


def test_empty_null_and_clashing_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], docs.schema)
    odd = odd.withColumns({c: F.lit("own") for c in ("kept", "base_failed", "repetition", "id_at", "mark_at", "d", "t", "node")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name
        out = stage(spark, odd, sf_dir)
        assert out.columns == odd.columns and out.count() == {"quality": 0, "near_duplicates": 2}.get(name, 3), name
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf_dir).count() == 3
