import random
from collections import Counter

import model
import pytest
from pyspark.sql import functions as F

import wordloom as w
from wordloom.operators import letters as letter_ops
from wordloom.operators import reports

ALPHABET = "abcdefghij" + "éüµ" + "中文" + "\U00020000"


def random_counts(seed, n=400):
    pick = random.Random(seed)
    counts = Counter()
    for _ in range(n):
        word = "".join(pick.choices(ALPHABET, k=pick.randrange(1, 16)))
        if model.units(word) >= 2:
            counts[word] += pick.choice([1, 1, 2, 9, 10, 11, 50])
    counts.update({"the": 500, "hot": 10_000, "jab": 10, "cab": 10})
    return counts


@pytest.fixture(params=range(2))
def known(request, spark):
    counts = random_counts(request.param)
    return counts, spark.createDataFrame(list(counts.items()), "word string, cnt bigint")


def test_letters_match_the_model(known):
    counts, df = known
    found = {(r["kind"], r["letter"]): r["cnt"] for r in w.letter_counts(df).collect()}
    assert found == model.letters(counts)


def test_characters_that_are_no_letters_are_skipped(spark):
    df = spark.createDataFrame([("1-Ab", 2), ("\U00020000x", 1), ("", 5)], "word string, cnt bigint")
    found = {(r["kind"], r["letter"]): r["cnt"] for r in w.letter_counts(df).collect()}
    assert found == {("CHAR", "a"): 2, ("CHAR", "b"): 2, ("CHAR", "x"): 1}


def test_letter_shares_and_total(known):
    counts, df = known
    letters = w.letter_counts(df)
    expected = model.letters(counts)
    assert w.letter_total(letters).first()[0] == sum(expected.values())
    with_total = w.letters_with_total(letters)
    assert with_total.where("kind = 'TOTAL_CHARS'").first()["cnt"] == sum(expected.values())
    shares = w.letter_percentages(letters).groupBy("kind").agg(F.sum("pct").alias("s"))
    assert [round(r["s"], 6) for r in shares.collect()] == [100.0, 100.0]


def test_most_frequent_letter_prefers_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("ba", 3), ("ab", 3)], "word string, cnt bigint")
    rows = letter_ops.most_frequent_letters(w.letter_counts(df)).collect()
    assert {r["kind"]: (r["letter"], r["cnt"]) for r in rows} == {
        "FIRST": ("a", 3), "CHAR": ("a", 6),
    }


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_top_words_match_the_model(known, n):
    counts, df = known
    rows = w.top_words(df, n).orderBy("rank").collect()
    assert [(r["word"], r["cnt"]) for r in rows] == model.top(counts, n)
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))


@pytest.mark.parametrize("n", [0, 5, 1000])
def test_ranking_and_summary_match_the_model(known, n):
    counts, df = known
    ranking = w.final_ranking(df, w.top_words(df, n))
    found = {r["word"]: (r["cnt"], r["top_n"]) for r in ranking.collect()}
    expected = model.final(counts, n)
    assert found == expected
    assert tuple(w.corpus_summary(ranking).first()) == model.summary(expected)


def test_lengths_and_categories(spark):
    words = ["ab", "abc", "abcd", "a" * 7, "a" * 8, "a" * 12, "a" * 13, "\U00020000\U00020000"]
    df = spark.createDataFrame([(x, 1) for x in words], "word string, cnt bigint")
    rows = {r["word"]: (r["length"], r["category"]) for r in w.with_categories(df).collect()}
    short, medium, long = "SHORT", "MEDIUM", "LONG"
    expected = [(2, short), (3, short), (4, medium), (7, medium), (8, long), (12, long),
                (13, "VERY_LONG"), (4, medium)]
    assert [rows[x] for x in words] == expected


def test_average_per_logical_partition_ignores_spark_partitions(spark):
    rows = [("x", "aa")] * 5 + [("y", "bb")] + [("y", "ccc")] * 2
    bag = spark.createDataFrame(rows, "part string, word string")
    expected = [(2, 6, 3.0), (3, 2, 2.0)]
    for n in (1, 7):
        stats = w.lengths_ascending(w.length_stats(bag.repartition(n), "part"))
        assert [tuple(r) for r in stats.collect()] == expected


def test_stop_words_as_a_list_or_a_table(spark):
    df = spark.createDataFrame([("The", 3), ("cat", 2), ("a", 1)], "word string, cnt bigint")
    table = spark.createDataFrame([("THE",), ("a",), ("a",)], "w string")
    top = w.top_words(df)
    for stops in (["the", "A"], table):
        assert [r["word"] for r in w.without_stop_words(df, stops).collect()] == ["cat"]
        assert [r["word"] for r in w.final_ranking(df, top, stops).collect()] == ["cat"]
    assert w.final_ranking(df, top, []).count() == 3


def test_words_only_in_the_top_list_and_repeated_marks(spark):
    counts = spark.createDataFrame([("cat", 2), ("dog", 0), ("cow", -4)], "word string, cnt bigint")
    top = spark.createDataFrame([("cat",), ("cat",), ("emu",), ("dog",), ("cow",)], "word string")
    assert [tuple(r) for r in w.final_ranking(counts, top).collect()] == [
        ("cat", 2, 3, "SHORT", True)
    ]


def test_mode_of_lengths_prefers_the_smallest(spark):
    df = spark.createDataFrame([("aaaa", 1), ("bb", 1), ("cc", 1), ("dddd", 9)], "word string, cnt bigint")
    assert w.corpus_summary(w.final_ranking(df, w.top_words(df))).first()[3] == 2


def test_counts_beyond_32_bits(spark):
    df = spark.createDataFrame([("big", 3_000_000_000), ("huge", 2**40)], "word string, cnt bigint")
    letters = w.letter_counts(df)
    assert w.letter_total(letters).first()[0] == 4 * 3_000_000_000 + 5 * 2**40
    assert w.corpus_summary(w.final_ranking(df, w.top_words(df))).first()[0] == 3_000_000_000 + 2**40


def test_a_hot_word_in_a_hot_partition(spark):
    bag = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 1000)).alias("word"),
        F.when(F.col("id") % 3 == 0, "big").otherwise((F.col("id") % 50).cast("string")).alias("part"),
    )
    counts = w.word_counts(bag)
    assert tuple(w.top_words(counts, 1).first()) == (1, "hot", 100_000)
    stats = w.length_stats(bag, "part")
    assert stats.agg(F.sum("cnt")).first()[0] == 300_000


def test_empty_input(lines_of):
    bag = w.clean_words(lines_of([]).withColumn("p", F.lit("x")))
    counts = w.word_counts(bag)
    letters = w.letter_counts(counts)
    top = w.top_words(counts)
    for empty in (bag, counts, w.length_stats(bag, "p"), letters, top):
        assert empty.count() == 0
    assert [r["total_chars"] for r in w.letter_total(letters).collect()] == [0]
    assert w.letters_with_total(letters).count() == 1
    summary = w.corpus_summary(w.final_ranking(counts, top)).collect()
    assert [tuple(r) for r in summary] == [(0, 0, None, 0)]
    assert tuple(reports.vocabulary_report(counts).first()) == (0, 0, 0, None, None)
    assert tuple(reports.top_share(counts).first()) == (0, 0, None)


def test_reports(known):
    counts, df = known
    total = sum(counts.values())
    report = reports.vocabulary_report(df).first()
    assert report["words_once"] == sum(1 for c in counts.values() if c == 1)
    assert report["avg_word_length"] == sum(model.units(x) * c for x, c in counts.items()) / total
    assert report["richness_pct"] == 100.0 * len(counts) / total
    share = reports.top_share(df, 10).first()
    assert share["pct"] == 100.0 * sum(c for _, c in model.top(counts, 10)) / total
    table = {r["length"]: r["cnt"] for r in reports.length_table(df).collect()}
    lengths = model.lengths(counts)
    assert table.pop("9+") == sum(n for k, n in lengths.items() if k >= 9)
    assert table == {str(k): n for k, n in lengths.items() if k < 9}


def test_known_results_on_the_documents(spark, sf_dir):
    import spark_queries as q

    words = w.clean_words(q.document_lines(spark, sf_dir))
    counts = w.word_counts(words).cache()
    assert counts.agg(F.sum("cnt"), F.count("*")).first()[:] == (379_291, 68_703)
    top = w.top_words(counts)
    assert [tuple(r)[1:] for r in top.orderBy("rank").limit(5).collect()] == [
        ("the", 15304), ("of", 8409), ("de", 6112), ("and", 6018), ("to", 4682),
    ]
    assert top.where("rank = 1000").first()["cnt"] == 36
    letters = w.letter_counts(counts)
    assert w.letters_with_total(letters).count() == 74
    assert w.letter_total(letters).first()[0] == 2_280_548
    ranking = w.final_ranking(counts, top)
    summary = w.corpus_summary(ranking).first()
    assert summary[:2] == (194_017, 4_031) and summary[3] == 6
    assert abs(summary[2] - 48.13123) < 1e-5
    counts.unpersist()


def test_known_results_on_the_pages(spark, sf_dir):
    from wordloom.sources.lines import split_lines

    page_id = F.col("page_id").cast("string")
    record = F.concat_ws(
        "\n", F.lit("WARC/1.0"), F.lit("WARC-Type: conversion"),
        F.concat(F.lit("WARC-Target-URI: "), "url"), F.lit("Content-Type: text/plain"),
        F.concat(F.lit("see "), "url", F.lit(" or mail user"), page_id, F.lit("@example.com now")),
        F.col("html"),
    )
    lines = split_lines(spark.read.parquet(f"{sf_dir}/pages.parquet").select(record.alias("text")))
    assert lines.count() == 1_588
    counts = w.word_counts(w.clean_words(lines))
    assert counts.agg(F.sum("cnt"), F.count("*")).first()[:] == (118_998, 26_867)
