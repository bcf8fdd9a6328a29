import random
from collections import Counter

import model
import pytest
from pyspark.sql import functions as F

import wordloom as w
from wordloom import fixed_values as fixed
from wordloom.functions import text

# One line per rule, with the words it leaves.
EDGE = [
    ("WARC/1.0", ""),
    (" \tWARC-Type: conversion", ""),
    ("warc-foo: x", ""),
    ("content-type: text/html", ""),
    ("content-language: eng", "content language eng"),
    ("Content-rich pages lose this line", ""),
    ("Content-Length: 12", ""),
    ("ROBOTS: classic", ""),
    ("isPartOf: CC", ""),
    ("Description: dropped", ""),
    ("a description: kept", "description kept"),
    ("Software-x", ""),
    ("software-y kept", "software kept"),
    ("Extracted-z", ""),
    ("warcinfo:nospace kept", "warcinfo nospace kept"),
    ("warcinfo: dropped", ""),
    (
        "see http://a.b/c?d=e and HTTP://Upper.Case/x www.foo.org awww.bar z",
        "see and http upper case",
    ),
    (
        "mail Joe.Bloggs+tag@ex-ample.co.uk now joe@localhost end",
        "mail now joe localhost end",
    ),
    ("a&nbsp;b x&#160;y p&#x27;q r&frac12;s AT&T;", "ab xy frac at"),
    (
        "don't stop-word na\xefve café İstanbul ΟΔΟΣ",
        "don stop word na\xefve cafe stanbul οδος",
    ),
    (
        "日本語 中 テキスト \U00020000 \U00020000a мир",
        "日本語 テキスト \U00020000 \U00020000a мир",
    ),
    ("   ", ""),
    ("\xa0nbsp\xa0joined", "nbsp joined"),
    ("tab\tsep\x0bvt", "tab sep vt"),
    ("I a be", "be"),
]
EDGE_LINES = [line for line, _ in EDGE]


def counted(words):
    return {r["word"]: r["cnt"] for r in w.word_counts(words).collect()}


def test_words_of_each_edge_line(spark):
    rows = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(EDGE)], "i int, line string")
    found = {}
    for row in w.clean_words(rows).collect():
        found.setdefault(row["i"], []).append(row["word"])
    for i, (line, expected) in enumerate(EDGE):
        assert Counter(found.get(i, [])) == Counter(expected.split()), line


def test_edge_totals(lines_of):
    counts = w.word_counts(w.clean_words(lines_of(EDGE_LINES)))
    found = {r["word"]: r["cnt"] for r in counts.collect()}
    assert (sum(found.values()), len(found), found["kept"]) == (42, 40, 3)
    bag = w.clean_words(lines_of(EDGE_LINES).withColumn("p", F.lit(1)))
    lengths = {r["length"]: r["cnt"] for r in w.length_stats(bag, "p").collect()}
    assert lengths == {2: 6, 3: 12, 4: 13, 5: 2, 6: 1, 7: 3, 8: 3, 9: 1, 11: 1}
    letters = w.letter_counts(counts)
    sums = {r["kind"]: r["n"] for r in letters.groupBy("kind").agg(F.sum("cnt").alias("n")).collect()}
    assert sums == {"FIRST": 40, "CHAR": 177}
    assert w.letter_total(letters).first()[0] == 217
    ranking = w.final_ranking(counts, w.top_words(counts))
    assert ranking.count() == 37
    s = w.corpus_summary(ranking).first()
    assert (s[0], s[1], round(s[2], 2), s[3]) == (39, 37, 1.05, 3)


def test_min_length_counts_utf16_units(lines_of):
    lines = lines_of(["a bb ccc \U00020000 中"])
    assert set(counted(w.clean_words(lines, 0))) == {"a", "bb", "ccc", "\U00020000", "中"}
    assert set(counted(w.clean_words(lines, 2))) == {"bb", "ccc", "\U00020000"}
    assert set(counted(w.clean_words(lines, 3))) == {"ccc"}


def test_a_null_line_has_no_words(spark):
    lines = spark.createDataFrame([(None,), ("word",)], "line string")
    assert counted(w.clean_words(lines)) == {"word": 1}


def test_other_columns_pass_through(spark):
    lines = spark.createDataFrame([("s", 1, "two words")], "source string, id int, line string")
    assert w.clean_words(lines).columns == ["source", "id", "word"]


def test_normalized_line_splits_into_the_same_words(lines_of):
    split = lines_of(EDGE_LINES).select(
        F.explode(F.split(text.normalize_letters("line"), r"\s+")).alias("word")
    )
    runs = lines_of(EDGE_LINES).select(F.explode(text.letter_runs("line")).alias("word"))
    key = lambda df: Counter(r["word"] for r in df.where("word <> ''").collect())
    assert key(split) == key(runs)


def test_input_order_and_partitioning_do_not_matter(lines_of):
    lines = lines_of(EDGE_LINES * 3)
    expected = counted(w.clean_words(lines))
    assert counted(w.clean_words(lines.repartition(5))) == expected
    assert counted(w.clean_words(lines.orderBy("line").coalesce(1))) == expected


PIECES = (
    list("aZ9._%+-@@..:/&;# \t\x0b\xa0\x85\u2028'é")
    + ["http://", "https://", "www.", "b.co", "\u2029", "\u0130", "\u0301", "中"]
    + ["\U00020000", "WARC-", "warc", "&amp;", "Content-", "content-type", "robots:"]
    + ["\x00", "\x1f", "Description:", ": "]
)


def random_lines(n, seed):
    pick = random.Random(seed)
    return ["".join(pick.choices(PIECES, k=pick.randrange(14))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_random_lines_match_the_model(spark, seed):
    lines = random_lines(5000, seed)
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    out = rows.select(
        "i",
        text.is_content_line("line").alias("content"),
        text.strip_urls("line").alias("s0"),
        text.strip_emails("line").alias("s1"),
        text.strip_entities("line").alias("s2"),
        F.regexp_replace("line", fixed.EMAIL, "").alias("plain_emails"),
    )
    for row in out.collect():
        line = lines[row["i"]]
        assert row["content"] == (not model.is_header(line)), repr(line)
        for step in range(3):
            assert row[f"s{step}"] == model.without(line, step), repr(line)
        assert row["s1"] == row["plain_emails"]
    found = counted(w.clean_words(rows.select("line")))
    assert Counter(found) == model.words(lines)


@pytest.mark.parametrize("piece", ["x", " ", "a@", "a@b.", "&a", "www", "é", "1."])
def test_a_very_long_line_is_cleaned_in_linear_time(lines_of, piece):
    lines = lines_of(["begin @ & " + piece * 2_000_000 + " end"])
    words = w.clean_words(lines).where(F.col("word").isin("begin", "end"))
    assert words.count() == 2


def test_cleaning_accepts_a_stream_of_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("WARC/1.0\nhello streaming world\n")
    stream = spark.readStream.text(str(tmp_path)).withColumnRenamed("value", "line")
    query = (
        w.clean_words(stream).writeStream.format("memory").queryName("streamed").start()
    )
    query.processAllAvailable()
    query.stop()
    assert spark.table("streamed").count() == 3
