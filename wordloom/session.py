"""Session settings."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT_BYTES = 1 << 30
WORDS_PER_SHUFFLE_PARTITION = 600_000_000
LINE_BYTES_PER_WORD = 7  # of text; names of compressed files count for more
COMPRESSED = (".gz", ".bz2", ".zst", ".deflate", ".lz4", ".snappy")
COMPRESSION = 4
_SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
_CASE_MAPPINGS = "spark.sql.icu.caseMappings.enabled"


def builder(app_name: str = "wordloom") -> SparkSession.Builder:
    """Settings for text corpora; master and memory are left to the caller.

    Lower-casing follows the Java runtime instead of the newer ICU tables.
    Scans take splits of up to 1 GB: a task sends each of its words once, so
    bigger splits mean less shuffle and fewer shuffle blocks. Small inputs are
    still split between all cores.
    """
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config(_CASE_MAPPINGS, "false")
        .config("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    )


def shuffle_partitions(words: int, at_least: int) -> int:
    """Partitions for the word-count shuffle of this many word occurrences.

    Counted in words, so that compression of the input plays no part. Partial
    counts are a tenth of the text or less, so 600 million words (some 4 GB of
    text) give a partition of some hundred MB: 25,000 partitions for 100 TB.
    Adaptive execution joins partitions that turn out small; it cannot split an
    aggregate's partition that is too big.
    """
    return max(at_least, -(-words // WORDS_PER_SHUFFLE_PARTITION))


def own_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster whose settings begin as those of ``spark``.

    A run that changes settings does so in a session of its own, so runs and
    queries of one application do not disturb each other.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def words_in_files(files: DataFrame) -> int:
    """About how many words the files of ``list_files`` hold, from names and sizes alone.

    For the size of a shuffle only: a guess that is too high costs nothing much,
    since adaptive execution joins small partitions.
    """
    packed = F.lower("file").rlike("(" + "|".join(map(re.escape, COMPRESSED)) + r")\z")
    size = F.col("bytes") * F.when(packed, COMPRESSION).otherwise(1)
    return files.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] // LINE_BYTES_PER_WORD


@contextmanager
def settings_for(spark: SparkSession, words: int | None = None) -> Iterator[None]:
    """Java's lower-casing and, if ``words`` is given, shuffles that fit, for one run.

    The settings are the session's; they are put back at the end.
    """
    wanted = {_CASE_MAPPINGS: "false"}
    if words is not None:
        now = int(spark.conf.get(_SHUFFLE_PARTITIONS))
        wanted[_SHUFFLE_PARTITIONS] = str(shuffle_partitions(words, now))
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
