"""Helpers that several operators of this folder share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: An odd multiplier and a mixer's constants for 64-bit hashing (fixed values).
PRIME = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


#: Rows in one Arrow batch at most: texts are long, and a batch is held by the JVM and by Python at once.
BATCH_ROWS = 1000


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver found it, once per application; and bound Arrow batches of the session."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows, "10000")) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    sc = spark.sparkContext
    if getattr(sc, "_cutframe_shipped", None) != sc.applicationId:
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / "cutframe.zip"  # read by the driver's file server only
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(archive))
        sc._cutframe_shipped = sc.applicationId


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables: spark.checkpoint.dir where it is set.

    Unset, as in tests, a local session uses /tmp/checkpoints; a cluster uses the shared warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        root = "file:///tmp/checkpoints" if local else spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/cutframe-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by `written` that no later step reads."""
    for df in tables:
        if path := getattr(df, "_written_path", None):
            jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def text_key(column: str | Column = "text") -> Column:
    """16 bytes that stand for a whole text; null for a null text."""
    return F.unhex(F.md5(F.col(column) if isinstance(column, str) else column))


def words_of(text: bytes | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`: bytes.split() without arguments parts at exactly these six bytes."""
    return text.split() if text else []


class WordHashes(dict):
    """64-bit hashes of words; a bounded cache, as most words of a text come again and again."""

    limit = 1_000_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words."""
    total = words[: len(words) - n + 1].copy()
    for j in range(1, n):
        total *= PRIME
        total += words[j : len(words) - n + 1 + j]
    return mixed(total)


def attach(columns: Iterable[str], made: Iterable[str]) -> list[str]:
    """Input columns that stay beside the made ones: a clashing name is replaced, not doubled."""
    lower = {m.lower() for m in made}
    return [c for c in columns if c.lower() not in lower]


def binary_column(batch, name: str) -> list[bytes | None]:
    """A string column as bytes, without decoding."""
    import pyarrow as pa

    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()
