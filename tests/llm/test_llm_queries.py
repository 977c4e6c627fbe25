"""The registered queries: against SQL where it can express them, and each row for row with its table."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from ctrprep.llm.queries import ORACLES, QUERIES

TABLES = {"op7_warc": "pages", "op10_embedding_dedup": "embeddings"}
#: Queries whose rows are not those of a table, with what tells them.
OWN_ROWS = {
    "op12_hard_negatives": f"SELECT count(*) FROM ({ORACLES['op12_hard_negatives']})",
    "op13_conversation_repair": "SELECT count(DISTINCT conv_id) FROM conversations",
}


@pytest.fixture(scope="module")
def oracle(small):
    connection = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, small, name):
    got = QUERIES[name](spark, small)
    rows = got.collect()
    counted = OWN_ROWS.get(name, f"SELECT count(*) FROM {TABLES.get(name, 'documents')}")
    assert len(rows) == oracle.execute(counted).fetchall()[0][0]
    if name in ORACLES:
        expected = oracle.execute(ORACLES[name])
        names = [d[0] for d in expected.description]
        assert sorted(names) == sorted(got.columns)
        assert Counter(tuple(r[n] for n in names) for r in rows) == Counter(expected.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
