"""Filtered ranking of words and the one-row corpus summary."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom import fixed_values as fixed
from wordloom.functions import text


def _stop_word_table(
    like: DataFrame, stop_words: Iterable[str] | DataFrame
) -> DataFrame:
    """One row per stop word, column ``stop_word``, lower case."""
    if isinstance(stop_words, DataFrame):
        listed = stop_words.select(F.lower(stop_words.columns[0]).alias("stop_word"))
        return listed.distinct()
    words = sorted({w.lower() for w in stop_words})
    literals = F.array(*map(F.lit, words)).cast("array<string>")
    return like.sparkSession.range(1).select(F.explode(literals).alias("stop_word"))


def without_stop_words(
    counts: DataFrame, stop_words: Iterable[str] | DataFrame = fixed.STOP_WORDS
) -> DataFrame:
    """Drop stop words, compared in lower case.

    ``stop_words`` is a list, or a one-column DataFrame for a long list, whose
    join strategy Catalyst picks by size.
    """
    if isinstance(stop_words, DataFrame):
        listed = _stop_word_table(counts, stop_words)
        same = F.lower(counts["word"]) == listed["stop_word"]
        return counts.join(listed, same, "left_anti")
    return counts.where(~F.lower("word").isin([w.lower() for w in stop_words]))


def with_categories(counts: DataFrame) -> DataFrame:
    """Adds ``length`` and ``category`` to rows that have a ``word``."""
    return counts.withColumn("length", text.utf16_length("word")).withColumn(
        "category", text.word_category("length")
    )


def one_row_per_word(counts: DataFrame) -> DataFrame:
    """``word, cnt``: the largest of a word's counts, for counts that were stored.

    Summed up per task before the shuffle, so a repeated word is no hot key.
    """
    return counts.groupBy("word").agg(F.max("cnt").alias("cnt"))


def final_ranking(
    counts: DataFrame,
    top: DataFrame,
    stop_words: Iterable[str] | DataFrame = fixed.STOP_WORDS,
    min_count: int = fixed.MIN_COUNT,
) -> DataFrame:
    """``word, cnt, length, category, top_n``.

    Keeps words that are no stop words and are in ``top`` or occur at least
    ``min_count`` times. ``counts`` has one row per word; ``one_row_per_word``
    sees to that for counts that were read from elsewhere.

    No broadcast is forced: a ``top`` that comes from ``top_words`` has a size
    bound Catalyst knows, and is broadcast because of it; a bigger one is
    joined by a shuffle.

    Stop words are joined and then tested, not filtered by value. Such a filter
    would be pushed below the word-count aggregate on this side only; ``top``
    could no longer share that aggregate's shuffle, and the corpus would be
    read and cleaned twice.
    """
    stops = _stop_word_table(counts, stop_words)
    marked = top.select("word").distinct().withColumn("in_top", F.lit(True))
    top_n = F.coalesce(F.col("in_top"), F.lit(False))
    kept = (
        counts.join(stops, F.lower(counts["word"]) == stops["stop_word"], "left")
        .join(marked, "word", "left")
        .withColumn("top_n", top_n)
        .where(F.col("stop_word").isNull())
        .where(F.col("cnt") > 0)
        .where(F.col("top_n") | (F.col("cnt") >= min_count))
    )
    return with_categories(kept).select("word", "cnt", "length", "category", "top_n")


def corpus_summary(ranking: DataFrame) -> DataFrame:
    """Always one row over the rows of ``final_ranking``.

    ``total_word_occurrences, unique_words, avg_frequency`` (null if there are
    no words) and ``most_common_length`` (most distinct words, the smallest
    length on a tie, 0 if there are no words).

    Summed per length first, so the last step sees one row per length.
    """
    per_length = ranking.groupBy("length").agg(
        F.sum("cnt").alias("occurrences"), F.count(F.lit(1)).alias("n")
    )
    total = F.coalesce(F.sum("occurrences"), F.lit(0))
    unique = F.coalesce(F.sum("n"), F.lit(0))
    most_common = F.max_by("length", F.struct(F.col("n"), -F.col("length")))
    return per_length.agg(
        total.alias("total_word_occurrences"),
        unique.alias("unique_words"),
        F.when(unique > 0, total.cast("double") / unique).alias("avg_frequency"),
        F.coalesce(most_common, F.lit(0)).alias("most_common_length"),
    )
