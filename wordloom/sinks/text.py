"""Results as ``key<TAB>value`` text, and as CSV.

The ``*_lines`` functions render a result as ``key, value``; ``write_lines``
writes such rows. Existing output is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom import fixed_values as fixed

REPEATS = 1000


def _lines(df: DataFrame, key, value, kept: Sequence[str] = ()) -> DataFrame:
    return df.select(key.cast("string").alias("key"), value.cast("string").alias("value"), *kept)


def word_lines(
    words: DataFrame, ordered: bool = False, kept: Sequence[str] = ()
) -> DataFrame:
    """Word occurrences; the value is empty, so a line ends with a TAB.

    If ``ordered``, sorted by word within each part file. ``kept`` names columns
    that stay, for folders.

    Without folders a task counts its words first, so that distinct words are
    sorted, not occurrences. Counted by task, a frequent word is no hot key.
    """
    if ordered and not kept:
        words = _repeated(words.groupBy(F.spark_partition_id().alias("task"), "word")
                          .agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions("word"))
    elif ordered:
        words = words.sortWithinPartitions(*kept, "word")
    return _lines(words, F.col("word"), F.lit(""), kept)


def _repeated(counts: DataFrame) -> DataFrame:
    """``word`` as often as ``n`` says, in the order of the rows; at most REPEATS in one array."""
    rest = F.explode(F.sequence("n", F.lit(1), F.lit(-REPEATS))).alias("rest")
    some = F.least("rest", F.lit(REPEATS)).cast("int")
    return counts.select("word", rest).select(F.explode(F.array_repeat("word", some)).alias("word"))


def count_lines(counts: DataFrame) -> DataFrame:
    """Word counts sorted by word within each part file."""
    return _lines(counts.sortWithinPartitions("word"), F.col("word"), F.col("cnt"))


def ranked_lines(counts: DataFrame) -> DataFrame:
    """Word counts, most frequent first, ties by word, in order from part file to part file.

    A sort by range: no task has the words of all others.
    """
    return _lines(counts.orderBy(F.desc("cnt"), F.asc("word")), F.col("word"), F.col("cnt"))


def length_lines(stats: DataFrame) -> DataFrame:
    """Length statistics by ascending length."""
    value = F.format_string(fixed.LENGTH_STATS_FORMAT, "cnt", "avg_per_partition")
    return _lines(stats.orderBy("length"), F.col("length"), value)


def letter_lines(letters: DataFrame) -> DataFrame:
    """Letter counts by key, the total last; see ``letters_with_total``."""
    key = F.concat_ws("_", "kind", "letter")
    ordered = letters.orderBy(F.col("letter").isNull(), "kind", "letter")
    return _lines(ordered, key, F.col("cnt"))


def top_lines(top: DataFrame) -> DataFrame:
    """Top words in rank order, in one part file."""
    ordered = top.coalesce(1).sortWithinPartitions("rank")
    return _lines(ordered, F.col("word"), F.col("cnt"))


def ranking_lines(ranking: DataFrame) -> DataFrame:
    """Final rows sorted by word within each part file."""
    value = F.format_string(
        fixed.FINAL_ROW_FORMAT, "cnt", "length", "category", F.col("top_n").cast("string")
    )
    return _lines(ranking.sortWithinPartitions("word"), F.col("word"), value)


def summary_lines(summary: DataFrame) -> DataFrame:
    """The summary row; the average is left out if there are no words."""
    average = F.when(
        F.col("unique_words") > 0,
        F.format_string(fixed.SUMMARY_AVERAGE_FORMAT, "avg_frequency"),
    )
    value = F.concat_ws(
        ", ",
        F.format_string(fixed.SUMMARY_TOTAL_FORMAT, "total_word_occurrences"),
        F.format_string(fixed.SUMMARY_UNIQUE_FORMAT, "unique_words"),
        average,
        F.format_string(fixed.SUMMARY_LENGTH_FORMAT, "most_common_length"),
    )
    return _lines(summary, F.lit(fixed.SUMMARY_KEY), value)


def final_lines(ranking: DataFrame, summary: DataFrame) -> DataFrame:
    """Final rows and, in a part file after them, the summary."""
    return ranking_lines(ranking).unionByName(summary_lines(summary))


def write_lines(
    lines: DataFrame, path: str, compression: str = "none", folders: Sequence[str] | None = None
) -> None:
    """Write ``key<TAB>value`` lines, in a folder for each value of the columns ``folders``."""
    folders = list(folders or ())
    joined = lines.select(F.concat_ws("\t", "key", "value").alias("value"), *folders)
    write = joined.write.mode("overwrite").option("compression", compression)
    if folders:
        write = write.partitionBy(*folders)
    write.text(path)


def word_count_rows(counts: DataFrame) -> DataFrame:
    """``word, count``, sorted by word within each part file."""
    return counts.sortWithinPartitions("word").select("word", F.col("cnt").alias("count"))


def top_rows(top: DataFrame) -> DataFrame:
    """``rank, word, count`` in rank order, in one part file."""
    rows = top.coalesce(1).sortWithinPartitions("rank")
    return rows.select("rank", "word", F.col("cnt").alias("count"))


def csv_lines(rows: DataFrame) -> DataFrame:
    """``line``: each row as the CSV writer writes it."""
    return rows.select(F.to_csv(F.struct(*rows.columns)).alias("line"))


def write_word_count_csv(counts: DataFrame, path: str, header: bool = False) -> None:
    """``word,count`` rows."""
    word_count_rows(counts).write.mode("overwrite").option("header", header).csv(path)


def write_top_csv(top: DataFrame, path: str, header: bool = False) -> None:
    """``rank,word,count`` rows in one file, in rank order."""
    top_rows(top).write.mode("overwrite").option("header", header).csv(path)
