"""Word frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_counts(words: DataFrame) -> DataFrame:
    """``word, cnt`` from one row per occurrence.

    Counts are summed per task before the shuffle, so a task sends one row per
    distinct word however often the word occurs in it.
    """
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
