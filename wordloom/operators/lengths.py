"""Word-length statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions import text


def length_stats(words: DataFrame, partition_by: str) -> DataFrame:
    """``length, cnt, avg_per_partition`` from one row per word occurrence.

    ``avg_per_partition`` is the mean count of a length over the logical
    partitions that contain it; ``partition_by`` names the column holding the
    partition (the input file, or a source). It does not depend on how Spark
    happens to split the input.

    Two small aggregates: the first leaves one row per partition and length,
    whatever the number of words, and sums per task before it shuffles.
    """
    per_partition = words.groupBy(
        F.col(partition_by), text.utf16_length("word").alias("length")
    ).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    return per_partition.groupBy("length").agg(
        total.alias("cnt"),
        (total.cast("double") / F.count(F.lit(1))).alias("avg_per_partition"),
    )


def lengths_ascending(stats: DataFrame) -> DataFrame:
    return stats.orderBy("length")
