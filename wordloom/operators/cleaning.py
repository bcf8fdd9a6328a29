"""Raw lines to words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom import fixed_values as fixed
from wordloom.functions import text


def drop_header_lines(lines: DataFrame) -> DataFrame:
    """Drop blank lines and crawl headers; the test looks at the raw line."""
    return lines.where(text.is_content_line("line"))


def strip_noise(lines: DataFrame) -> DataFrame:
    """Remove URLs, then mail addresses, then entities, leaving no blank behind.

    One projection per step: each result is used twice by the next step, and
    Catalyst does not inline an expensive expression that is used twice.
    """
    for strip in (text.strip_urls, text.strip_emails, text.strip_entities):
        lines = lines.withColumn("line", strip("line"))
    return lines


def clean_words(
    lines: DataFrame, min_length: int = fixed.MIN_WORD_LENGTH
) -> DataFrame:
    """One row per word occurrence, duplicates kept.

    ``lines`` has a string column ``line``; ``word`` replaces it and all other
    columns are passed through. ``min_length`` counts UTF-16 units.

    Narrow: no shuffle. The words of a line are exploded straight into
    whatever aggregate follows, never collected.
    """
    cleaned = strip_noise(drop_header_lines(lines))
    others = [c for c in lines.columns if c != "line"]
    words = cleaned.select(*others, F.explode(text.letter_runs("line")).alias("word"))
    return words.where(text.has_min_length("word", max(min_length, 1)))
