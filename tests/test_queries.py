"""Every registered query against DuckDB on the same tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from oracle_queries import ORACLE
from spark_queries import QUERIES

# Queries whose rows come in an order of their own.
ORDERED = {
    "lengths_sorted", "first_letters_sorted", "first_letters_a_to_e", "top_lines_text",
    "top_words_csv",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


def sort_key(row):
    return tuple((v is not None, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    result = duck.sql(entry.oracle_sql()[name])
    spark_types = {c: TYPES[t] for c, t in df.dtypes}
    assert spark_types == {c: str(t) for c, t in zip(result.columns, result.types)}
    columns = sorted(df.columns)
    order = [result.columns.index(c) for c in columns]
    found = [tuple(r[c] for c in columns) for r in df.collect()]
    expected = [tuple(r[i] for i in order) for r in result.fetchall()]
    if name not in ORDERED:
        found, expected = sorted(found, key=sort_key), sorted(expected, key=sort_key)
    assert len(found) == len(expected) > 0
    for row, wanted in zip(found, expected):
        for a, b in zip(row, wanted):
            same = math.isclose(a, b, rel_tol=1e-12) if isinstance(a, float) else a == b
            assert same, (row, wanted)


def test_every_query_is_checked():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "cnt", "length", "category", "top_n"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["top_n_words", "top_20_words", "top_100_words", "report_top_10"])
def test_top_lists_come_in_rank_order(spark, sf_dir, name):
    ranks = [r["rank"] for r in entry.queries()[name](spark, sf_dir).collect()]
    assert ranks == list(range(1, len(ranks) + 1))
