"""Report queries over word counts and length statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions import text
from wordloom.operators.ranking import top_words


def length_table(
    counts: DataFrame, last_bucket: int = 9
) -> DataFrame:
    """``length, cnt, pct``: occurrences per length, long words in one bucket.

    ``length`` is a label: "2", "3", ... and "9+". The window for the share
    runs over the labels only.
    """
    length = text.utf16_length("word")
    label = F.when(length >= last_bucket, F.lit(f"{last_bucket}+")).otherwise(
        length.cast("string")
    )
    table = counts.groupBy(label.alias("length")).agg(F.sum("cnt").alias("cnt"))
    total = F.sum("cnt").over(Window.partitionBy())
    return table.withColumn("pct", F.lit(100.0) * F.col("cnt") / total)


def top_share(counts: DataFrame, n: int = 100) -> DataFrame:
    """One row: the share in percent of all occurrences held by the top ``n`` words.

    The two sums meet in a union of n + 1 rows; both read the same shuffle.
    """
    top = top_words(counts, n).select(
        F.col("cnt").alias("top_cnt"), F.lit(0).cast("bigint").alias("all_cnt")
    )
    everything = counts.agg(F.sum("cnt").alias("all_cnt")).select(
        F.lit(0).cast("bigint").alias("top_cnt"), "all_cnt"
    )
    return (
        top.unionByName(everything)
        .agg(
            F.coalesce(F.sum("top_cnt"), F.lit(0)).alias("top_cnt"),
            F.coalesce(F.sum("all_cnt"), F.lit(0)).alias("all_cnt"),
        )
        .select(
            "top_cnt",
            "all_cnt",
            F.when(
                F.col("all_cnt") > 0,
                F.lit(100.0) * F.col("top_cnt") / F.col("all_cnt"),
            ).alias("pct"),
        )
    )


def vocabulary_report(counts: DataFrame) -> DataFrame:
    """One row about the vocabulary, in one pass over the counts.

    ``words_once`` occur exactly once; ``avg_word_length`` is per occurrence;
    ``richness_pct`` is unique words per hundred occurrences. The two ratios
    are null without words.
    """
    length = text.utf16_length("word").cast("bigint")
    sums = counts.agg(
        F.count(F.when(F.col("cnt") == 1, 1)).alias("words_once"),
        F.count(F.lit(1)).alias("unique_words"),
        F.coalesce(F.sum("cnt"), F.lit(0)).alias("total_words"),
        F.coalesce(F.sum(length * F.col("cnt")), F.lit(0)).alias("total_length"),
    )
    some = F.col("total_words") > 0
    total = F.col("total_words")
    return sums.select(
        "words_once",
        "unique_words",
        "total_words",
        F.when(some, F.col("total_length").cast("double") / total).alias(
            "avg_word_length"
        ),
        F.when(some, F.lit(100.0) * F.col("unique_words") / total).alias(
            "richness_pct"
        ),
    )
