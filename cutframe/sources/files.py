"""Files in folders that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, /tmp/checkpoints in a local session, and an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir isn't set: kept tables need a folder that all executors share")
        root = "file:///tmp/checkpoints"
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/cutframe-{name}-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Whether path is at `to` now; an existing `to` stays as it is."""
    fs, at = _fs(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    return not fs.exists(target) and fs.rename(at, target)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files, be it a folder or one file."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    fs, at = _fs(spark, path)
    return reader.parquet(path) if fs.getFileStatus(at).isDirectory() else reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def fingerprint(spark: SparkSession, path: str) -> str:
    """Changes when a file under path comes, goes, or gets another size or time; contents aren't read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    r = files.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("h")).first()
    return f"{r.n}-{(r.h or 0) & 0xFFFFFFFFFFFFFFFF:016x}"


def overwrite_partitions(rows: DataFrame, path: str, *by: str, compression: str | None = None) -> None:
    """Only partitions that rows touch are replaced; rows may come from the same path."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path, compression=compression)
