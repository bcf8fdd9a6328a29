"""Path manifests and input inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom import fixed_values as fixed
from wordloom.functions import text


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``file_id, path``: the non-blank lines of a file, numbered from 0.

    Lines are numbered within each split of the file, and a split starts where
    the ones before it end; only the number of lines per split is brought
    together.
    """
    lines = (
        spark.read.text(path)
        .select(
            text.trim_blanks("value").alias("path"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
        )
        .where(F.col("path") != "")
    )
    in_split = F.row_number().over(Window.partitionBy("file", "block").orderBy("pos"))
    per_split = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("file", "block"))
    starts = per_split.select("file", "block", (upto - F.col("n")).alias("start"))
    return (
        lines.withColumn("in_split", in_split)
        .join(starts, ["file", "block"])
        .select((F.col("start") + F.col("in_split") - 1).alias("file_id"), "path")
    )


def sample_manifest(
    manifest: DataFrame,
    n: int = fixed.SAMPLE_SIZE,
    seed: int = fixed.SAMPLE_SEED,
) -> DataFrame:
    """Exactly ``min(n, all)`` rows, picked by a seeded hash of ``path``.

    The same rows on every run and for every partitioning. Needs ``file_id``
    and ``path``; both are returned.
    """
    key = F.md5(F.concat(F.col("path"), F.lit(str(seed))))
    return (
        manifest.select("file_id", "path").orderBy(key, "path", "file_id").limit(n)
    )


def _ids_by_name(manifest: DataFrame) -> DataFrame:
    return (
        manifest.groupBy(text.base_name("path").alias("name"))
        .agg(F.max("file_id").alias("file_id"))
        .where(F.col("name") != "")
    )


def _by_name(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``files`` with ``name``: rows that have one, and rows whose path ends in a slash.

    The latter match nothing. They share a key, however many there are, so they
    stay out of the join.
    """
    named = files.select("*", text.base_name("file").alias("name")).select(
        "name", *files.columns
    )
    return named.where(F.col("name") != ""), named.where(
        F.coalesce(F.col("name"), F.lit("")) == ""
    )


def with_file_ids(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Adds ``name`` (base name), ``file_id`` and ``data_name`` to ``files``.

    ``files`` has a column ``file`` (a path). If the manifest has a base name
    twice, its last index counts. Both new columns are null without a match.
    """
    named, unnamed = _by_name(files)
    found = named.join(_ids_by_name(manifest), "name", "left")
    nameless = unnamed.withColumn("file_id", F.lit(None).cast("bigint"))
    return found.unionByName(nameless).withColumn(
        "data_name",
        F.concat(F.lit(fixed.DATA_FILE_PREFIX), F.col("file_id").cast("string")),
    )


def unmatched_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """The rows of ``files`` whose base name is not in the manifest."""
    named, unnamed = _by_name(files)
    return named.join(_ids_by_name(manifest), "name", "left_anti").unionByName(unnamed)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, bytes`` of the files of a directory; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    )


def input_inventory(files: DataFrame) -> DataFrame:
    """One row: ``files, bytes, mb, gb`` over the rows of ``list_files``."""
    total = F.coalesce(F.sum("bytes"), F.lit(0))
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        total.alias("bytes"),
        (total / F.lit(1024.0**2)).alias("mb"),
        (total / F.lit(1024.0**3)).alias("gb"),
    )


def require_input(spark: SparkSession, path: str) -> int:
    """Size in bytes of the files of a directory; without files, an error."""
    found = input_inventory(list_files(spark, path)).first()
    if found["files"] == 0:
        raise ValueError(f"no input files in {path}")
    return found["bytes"]
