"""Queries of the corpus operators against their SQL."""

import os

import duckdb
import pytest

from framewright.llm import queries

TABLES = "documents pages benchmark labels conversations".split()


def plain(frame):
    number = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted(repr([None if v is None or str(v) in ("nan", "<NA>") else number(v) for v in row]) for row in frame[sorted(frame.columns)].astype(object).values.tolist())


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    assert plain(queries.queries()[name](spark, sf_dir).toPandas()) == plain(con.execute(queries.oracle_sql()[name]).df())


def test_every_query_has_sql_or_a_brute_force_test():
    assert set(queries.queries()) - set(queries.oracle_sql()) == {"op4_vector_shards", "op6_length_buckets", "op7_stupid_backoff", "op10_url_filter", "op12_language_spans"}
