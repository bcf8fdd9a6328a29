"""Parquet tables, and the folders that results and work lie in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet, replacing ``path``, and return the table read back.

    Later stages read the table. They neither repeat the work behind it nor
    depend on executors that held its shuffle files. Zstandard makes a table of
    words a third smaller than the default codec, in the same time.
    """
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return read_table(df.sparkSession, df.schema, path)


def read_table(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def work_path(spark: SparkSession, output: str) -> str:
    """A new folder for the tables of one run.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``;
    where that is not set, beside ``output``.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    base = f"{shared.rstrip('/')}/" if shared else f"{output.rstrip('/')}_"
    return f"{base}wordloom-{uuid.uuid4().hex}"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors reach, for results without a place.

    It lies in ``spark.checkpoint.dir``. Where that is unset it lies in the
    warehouse, unless that is a folder of one machine of a cluster, which is an
    error. Left to the cluster's own clean-up.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        of_one_machine = "://" not in shared or shared.startswith("file:")
        if of_one_machine and not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                "set spark.checkpoint.dir to a folder that all executors reach: "
                f"{shared} lies on one machine"
            )
    return f"{shared.rstrip('/')}/wordloom/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    # Only Hadoop's own classes know what a path without a scheme means on a cluster.
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the cluster's file system."""
    target, files = _file_system(spark, path)
    files.delete(target, True)


def replace_path(spark: SparkSession, new: str, old: str) -> None:
    """Put the finished folder ``new`` in the place of ``old``, on the same file system."""
    source, files = _file_system(spark, new)
    target, _ = _file_system(spark, old)
    files.delete(target, True)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"cannot move {new} to {old}")
