"""Registered queries against DuckDB, where they have SQL."""

import glob
import os

import duckdb
import pytest

from wordloom.llm.queries import QUERIES
from wordloom.llm.sql import ORACLE

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "array<bigint>": "BIGINT[]"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, real_sf, name):
    con = duckdb.connect()
    for path in glob.glob(f"{real_sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df, result = QUERIES[name](spark, real_sf), con.sql(ORACLE[name])
    assert {c: TYPES[t] for c, t in df.dtypes} == {
        c: str(t) for c, t in zip(result.columns, result.types)
    }
    columns = sorted(df.columns)
    order = [result.columns.index(c) for c in columns]
    found = sorted(str(tuple(r[c] for c in columns)) for r in df.collect())
    wanted = sorted(str(tuple(r[i] for i in order)) for r in result.fetchall())
    assert found == wanted and found


def test_all_operators_are_registered():
    assert [int(n[2:].partition("_")[0]) for n in QUERIES] == list(range(1, 14))


def test_awkward_conversations_match_duckdb(spark, tmp_path):
    """Null ids, turns and texts, long conversations of short rows, repeated rows."""
    import random

    rng = random.Random(12)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "User", None]
    texts = ["Fine.", "Cut off", " ", "", "Again!", "What?", "x.\n", None]
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, *range(9)]), rng.choice(roles),
             rng.choice(texts)) for _ in range(900)]
    rows += [(1000, k, "user" if k % 2 == 0 else "assistant", f"Turn {k}.") for k in range(300)]
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(
        1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    name = "op12_checkpointed_repair"
    df = QUERIES[name](spark, str(tmp_path))
    found = sorted(str(tuple(r)) for r in df.collect())
    result = con.sql(ORACLE[name]).select(*[duckdb.ColumnExpression(c) for c in df.columns])
    assert found == sorted(str(r) for r in result.fetchall()) and len(found) == 62
