"""The physical plans that matter at scale."""

import re

import pytest

import __spark_entry__ as entry
from spark_queries import QUERIES

SINGLE_TASK_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "MapInArrow")


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def plan_of(spark, sf_dir):
    return lambda name: final_plan(entry.queries()[name](spark, sf_dir))


# Queries that write files first; what is left of their plans reads them back.
OF_FILES = {"all_ranks", "all_stages", "file_length_stats", "file_line_counts", "input_inventory",
            "manifest_lines", "part_order", "total_order"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OF_FILES))
def test_no_python_no_cross_join_and_no_text_dealt_out(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in SINGLE_TASK_JOINS + PYTHON)
    assert "RoundRobinPartitioning" not in plan


@pytest.mark.parametrize(
    "name", ["final_ranking", "final_summary", "letters_with_total", "report_top_100_share"]
)
def test_the_corpus_is_read_and_shuffled_once(plan_of, name):
    plan = plan_of(name)
    assert plan.count("FileScan") == 1
    assert len(re.findall(r"\+- Exchange hashpartitioning\(word#", plan)) == 1
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("name", ["word_count", "length_stats", "letter_distribution"])
def test_only_used_columns_are_read_and_counts_are_partial(plan_of, name):
    plan = plan_of(name)
    columns = "text:string,source:string" if name == "length_stats" else "text:string"
    assert f"ReadSchema: struct<{columns}>" in plan
    assert "partial_count(1)" in plan


def test_top_words_are_merged_not_sorted_in_one_task(plan_of):
    plan = plan_of("top_n_words")
    assert "TakeOrderedAndProject(limit=1000" in plan
    assert "Exchange SinglePartition" not in plan


def test_each_cleaning_step_runs_once_per_line(plan_of):
    plan = plan_of("word_count")
    for piece in ("regexp_extract_all(", "Contains(line", "RLIKE(", "explode(split("):
        expected = 4 if piece.startswith("Contains") else 1
        assert plan.count(piece) == expected, piece


def test_a_large_top_list_is_not_broadcast(spark):
    from wordloom import final_ranking

    counts = spark.range(2_000_000).selectExpr("cast(id as string) as word", "id as cnt")
    plan = final_ranking(counts, counts)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_ranks_of_all_words_bring_only_sizes_together(spark, tmp_path):
    """No task has the words of all others: what is numbered in one place are the ranges."""
    from wordloom.operators.ranking import ranked_words

    counts = spark.range(300_000).selectExpr(
        "cast(id as string) as word", "if(id < 5, 100 - id, 1) as cnt")
    ranked = ranked_words(counts, str(tmp_path / "ranks"))
    plan = final_plan(ranked)
    words = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    assert len(words) == 1 and "n#" in plan and "CartesianProduct" not in plan
    from pyspark.sql import functions as F

    # One count for nearly all words, and still every range has its share of them.
    placed = spark.read.parquet(str(tmp_path / "ranks"))
    sizes = [r["count"] for r in placed.groupBy(F.shiftright("place", 33)).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 300_000 / 8
    wanted = sorted(((-c, w) for w, c in counts.collect()))
    found = sorted((r["rank"], -r["cnt"], r["word"]) for r in ranked.collect())
    assert found == [(k, c, w) for k, (c, w) in enumerate(wanted, 1)]
