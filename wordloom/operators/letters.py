"""First letters and letter frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom import fixed_values as fixed
from wordloom.functions import text


def letter_counts(counts: DataFrame) -> DataFrame:
    """``kind, letter, cnt`` with kind FIRST (initials) and CHAR (all letters).

    Works on ``word, cnt``: the characters of a word are looked at once and
    weighted with its count. Both kinds come from the same aggregate, so there
    is one pass and one shuffle of at most one row per character and task.

    Whether a character is a letter is asked once per distinct character: as
    part of ``cnt``, for a filter on ``letter`` would move below the aggregate.
    """
    characters = counts.select(
        "cnt", F.posexplode(F.split(F.lower("word"), "")).alias("pos", "letter")
    )
    per_character = characters.groupBy("letter").agg(
        F.sum(F.when(F.col("pos") == 0, F.col("cnt"))).alias("FIRST"),
        F.sum("cnt").alias("CHAR"),
    )
    cnt = F.when(text.is_bmp_letter("letter"), F.col("cnt"))
    return (
        per_character.unpivot("letter", ["FIRST", "CHAR"], "kind", "cnt")
        .select("kind", "letter", cnt.alias("cnt"))
        .where(F.col("cnt").isNotNull())
    )


def letter_total(letters: DataFrame) -> DataFrame:
    """One row, ``total_chars``: the sum of all FIRST and CHAR counts, 0 if none."""
    return letters.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("total_chars"))


def letters_with_total(letters: DataFrame) -> DataFrame:
    """The rows of ``letter_counts`` and one TOTAL_CHARS row with a null letter."""
    total = letter_total(letters).select(
        F.lit(fixed.TOTAL_CHARS_KEY).alias("kind"),
        F.lit(None).cast("string").alias("letter"),
        F.col("total_chars").alias("cnt"),
    )
    return letters.unionByName(total)


def letter_percentages(letters: DataFrame) -> DataFrame:
    """Adds ``pct``, the share of a letter within its kind, in percent.

    The window holds at most one row per letter of the Basic Multilingual Plane.
    """
    total = F.sum("cnt").over(Window.partitionBy("kind"))
    return letters.withColumn("pct", F.lit(100.0) * F.col("cnt") / total)


def first_letters(letters: DataFrame) -> DataFrame:
    """FIRST rows, most frequent first."""
    return (
        letters.where(F.col("kind") == "FIRST")
        .orderBy(F.desc("cnt"), "letter")
        .select("letter", "cnt")
    )


def first_letters_between(letters: DataFrame, low: str, high: str) -> DataFrame:
    """FIRST rows of the letters from ``low`` to ``high``, by letter."""
    return (
        letters.where(F.col("kind") == "FIRST")
        .where(F.col("letter").between(low, high))
        .orderBy("letter")
        .select("letter", "cnt")
    )


def most_frequent_letters(letters: DataFrame) -> DataFrame:
    """The most frequent letter of each kind; the smallest letter on a tie."""
    return letters.groupBy("kind").agg(
        F.min_by("letter", F.struct(-F.col("cnt"), F.col("letter"))).alias("letter"),
        F.max("cnt").alias("cnt"),
    )
