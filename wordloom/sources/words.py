"""Readers for results stored as text: word lists and ``word<TAB>count`` lines.

Each takes the lines (a DataFrame with ``line``, see ``read_lines``), so the
same parsing serves files and tables.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions import text

_WHOLE_NUMBER = r"\A[+-]?[0-9]+\z"


def first_words(lines: DataFrame) -> DataFrame:
    """``word``: the first white-space token of each line that is not blank.

    Other columns of ``lines`` are passed through. Exploded, since a filter on the
    word would find it a second time.
    """
    others = [c for c in lines.columns if c != "line"]
    return lines.select(*others, F.explode(text.first_tokens("line")).alias("word"))


def _fields(lines: DataFrame) -> DataFrame:
    trimmed = lines.select(text.trim_blanks("line").alias("line"))
    return trimmed.where(F.col("line") != "").select(
        F.split("line", "\t", 2).alias("fields")
    )


def _count_type(bits: int) -> str:
    return {32: "int", 64: "bigint"}[bits]


def _word() -> Column:
    return F.col("fields")[0].alias("word")


def lenient_counts(lines: DataFrame, bits: int = 64) -> DataFrame:
    """``word, cnt``; lines without a TAB or without a whole number are skipped.

    The number is not trimmed: a blank before it makes the line malformed. It
    must fit into ``bits``. 64 reads back whatever the word count wrote; 32
    skips counts beyond 2147483647.
    """
    number = F.get(F.col("fields"), F.lit(1))
    cnt = F.when(
        number.rlike(_WHOLE_NUMBER), number.try_cast(_count_type(bits))
    )
    return (
        _fields(lines)
        .select(_word(), cnt.cast("bigint").alias("cnt"))
        .where(F.col("cnt").isNotNull())
    )


def strict_counts(
    lines: DataFrame, bits: int = 64, skip: Iterable[str] = ()
) -> DataFrame:
    """``word, cnt``; the number is trimmed, and one that is none fails the job.

    Lines without a TAB are skipped, and so are the words in ``skip``, compared
    in lower case, whatever their number. The failure does not depend on the
    ANSI setting of the session.
    """
    skipped = F.lower(F.col("fields")[0]).isin([w.lower() for w in skip])
    number = text.trim_blanks(F.col("fields")[1])
    parsed = F.when(
        number.rlike(_WHOLE_NUMBER), number.try_cast(_count_type(bits))
    )
    cnt = F.coalesce(
        parsed.cast("bigint"),
        F.raise_error(F.concat(F.lit("not a count: "), number)).cast("bigint"),
    )
    # The test is also part of the value: filters may be reordered, a CASE is not.
    guarded = F.when(~skipped, cnt)
    return (
        _fields(lines)
        .where((F.size("fields") >= 2) & ~skipped)
        .select(_word(), guarded.alias("cnt"))
    )


def marked_words(lines: DataFrame) -> DataFrame:
    """``word, top_n``: the first TAB field of each line, flagged true."""
    return _fields(lines).select(_word(), F.lit(True).alias("top_n"))
