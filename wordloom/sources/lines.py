"""Raw text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``line, file, part`` for every line of every file of a directory.

    ``file`` is the path and ``part`` a 64-bit hash of it: two of a million files
    share a hash with a probability of some 3e-8, and would count as one.

    Lines end at LF, CR or CRLF. Plain files are split between tasks;
    compressed files (.gz and so on) are read directly, one task per file.
    Names starting with "_" or "." and subdirectories are skipped.
    """
    file = F.col("_metadata.file_path")
    return spark.read.text(path).select(
        F.col("value").alias("line"),
        file.alias("file"),
        F.xxhash64(file).alias("part"),
    )


def split_lines(texts: DataFrame, column: str = "text") -> DataFrame:
    """One row per line of a text column, as ``line``; other columns stay.

    Lines end at LF, CR or CRLF. All breaks are made LF first: splitting at one
    plain character needs no regex.
    """
    others = [c for c in texts.columns if c != column]
    lf, cr = F.lit("\n"), F.lit("\r")
    text = F.replace(F.replace(column, F.lit("\r\n"), lf), cr, lf)
    return texts.select(*others, F.explode(F.split(text, "\n")).alias("line"))


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal the rows over ``partitions`` tasks; None leaves them where they are.

    A shuffle of the raw text, for the caller to ask for: it pays off for a few
    files that cannot be split (gzip, or Parquet with one row group), which would
    leave most cores idle.
    """
    return df if partitions is None else df.repartition(partitions)
