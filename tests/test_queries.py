"""Every query gives its SQL's rows."""

import os

import duckdb
import pytest

from framewright.plans import registry


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages conversations".split():
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def plain(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    number = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted(repr([None if v is None or str(v) in ("nan", "<NA>") else number(v) for v in row]) for row in frame.values.tolist())


@pytest.mark.parametrize("name", registry.queries())
def test_query(spark, sf_dir, con, name):
    found = registry.queries()[name](spark, sf_dir).toPandas()
    assert plain(found) == plain(con.execute(registry.oracle_sql()[name]).df())


def test_equal_vectors_go_with_the_first(spark):
    from framewright.operators import dedup
    from framewright.plans.session import with_checkpoints

    with_checkpoints(spark)
    vecs = {0: (1.0, 0.0), 1: (0.0, 0.0), 2: (1.0, 0.0), 3: (0.0, 1.0), 4: (0.0, 0.0), 5: (1.0, 0.1), 6: (0.0, 1.0), 7: (0.1, 1.0), 8: (1.0, 1.0)}
    emb = spark.createDataFrame([(i, 1, list(v)) for i, v in vecs.items()] + [(9, 2, [1.0, 0.0])], "id long, grp int, vec array<float>")
    got = {r["id"]: (r["status"], r["has_duplicates"]) for r in dedup.near_duplicates(emb, 0.9).collect()}
    gone = {2, 5, 6, 7}
    assert got == {i: ("delete", False) if i in gone else ("keep", i in (0, 3)) for i in range(10)}


def test_greedy_keeps_no_similar_pair(spark, sf_dir):
    from framewright.operators import dedup

    emb = registry.fx(spark, sf_dir, "emb_fx")
    status = {r["id"]: r["status"] for r in registry.queries()["d1_near_duplicates"](spark, sf_dir).collect()}
    pairs = [(r["a"], r["b"]) for r in dedup.similar_pairs(emb, 0.25).collect()]
    want = {}
    for i in sorted(status):
        want[i] = "delete" if any(b == i and want[a] == "keep" for a, b in pairs if b == i) else "keep"
    assert status == want
