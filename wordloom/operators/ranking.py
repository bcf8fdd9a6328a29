"""Global top-N, and the rank of every word."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom import fixed_values as fixed
from wordloom.sinks.tables import write_table


def top_words(counts: DataFrame, n: int = fixed.TOP_N) -> DataFrame:
    """``rank, word, cnt`` of the ``n`` most frequent words; ties by word.

    Every task keeps its best ``n`` rows and only those are merged. The rank is
    numbered over the ``n`` rows that are left.
    """
    best_first = [F.desc("cnt"), F.asc("word")]
    best = counts.select("word", "cnt").orderBy(*best_first).limit(n)
    rank = F.row_number().over(Window.orderBy(*best_first))
    return best.select(rank.alias("rank"), "word", "cnt")


_TASK_BITS = 33  # of monotonically_increasing_id: the rest is the number of the task


def ranked_words(counts: DataFrame, folder: str) -> DataFrame:
    """``rank, word, cnt`` of every word, most frequent first; ties by word.

    The words are sorted by range: many words of one count are spread over tasks,
    since the word is part of the range. Each task numbers its own words, and a
    rank is that number after the sizes of all ranges before. The numbered words
    are written to ``folder``, because ranges drawn again could differ. Only one
    number for each range is brought together.
    """
    best_first = [F.desc("cnt"), F.asc("word")]
    ranges = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = counts.select("word", "cnt").repartitionByRange(ranges, *best_first)
    place = F.monotonically_increasing_id().alias("place")
    placed = write_table(ordered.sortWithinPartitions(*best_first).select("word", "cnt", place), folder)
    task = F.shiftright("place", _TASK_BITS)
    sizes = placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("task"))
    starts = sizes.select("task", (upto - F.col("n")).alias("start"))
    number = F.col("place").bitwiseAND(F.lit((1 << _TASK_BITS) - 1)) + 1
    numbered = placed.select("word", "cnt", task.alias("task"), number.alias("number"))
    return numbered.join(starts, "task").select(
        (F.col("start") + F.col("number")).alias("rank"), "word", "cnt"
    )
