"""A catalogue on disk that takes every batch and every content hash once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .catalog import upsert_catalog
from .files import overwrite_partitions


@dataclass(frozen=True)
class Catalogue:
    """Files by path, with a table of the content hashes that are in, and a ledger of the batches that are done.

    columns: name and type of what is kept beside path and sha, as in a schema. Rows lie in `slots` partitions by path, hashes by hash: a batch
    reads and replaces only those that it touches. A batch writes rows, then hashes, then its ledger entry; one that broke off in between
    can be given again, and ends in the same state, as rows whose hash is in are skipped and equal rows replaced by equal ones.
    """

    spark: SparkSession
    path: str
    columns: str = "size bigint, mtime double, tags string, notes string"
    slots: int = 64

    def _slot(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.slots)).cast("int")

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def create(self) -> Catalogue:
        """Empty tables where there are none."""
        for name, schema, by in (("files", f"path string, sha string, {self.columns}, slot int", "slot"), ("hashes", "sha string, path string, slot int", "slot"), ("ledger", "added bigint, skipped bigint, batch bigint", "batch")):
            self.spark.createDataFrame([], schema).write.mode("ignore").partitionBy(by).parquet(f"{self.path}/{name}")
        return self

    def files(self) -> DataFrame:
        return self._table("files", f"path string, sha string, {self.columns}, slot int").drop("slot")

    def ledger(self) -> DataFrame:
        """batch, added, skipped."""
        return self._table("ledger", "added bigint, skipped bigint, batch bigint").select("batch", "added", "skipped")

    def _touched(self, rows: DataFrame, column: str) -> list[int]:
        return [r.slot for r in rows.select(self._slot(column).alias("slot")).distinct().collect()]  # at most `slots`

    def ingest(self, batch: DataFrame, number: int) -> bool:
        """Take in a batch(path, sha, and any of the columns); whether it was new.

        Of files with one hash the first by path comes in, and none whose hash is in under another path; a path that is in gets the batch's columns,
        but keeps its tags and notes. Rows without a path or hash are skipped.
        """
        if self.ledger().filter(F.col("batch") == number).limit(1).count():
            return False
        batch = batch.persist()
        try:
            one = lambda rows, by, order: rows.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(order))).filter("_n = 1").drop("_n")
            first = one(one(batch.filter("path is not null and sha is not null"), "sha", "path"), "path", "sha").persist()
            files = self._table("files", f"path string, sha string, {self.columns}, slot int").filter(F.col("slot").isin(self._touched(first, "path"))).drop("slot")
            old = files.join(first.select("path"), "path", "left_semi").select("sha")  # hashes that may give way to new contents
            slots = self._touched(first.select("sha").unionAll(old), "sha")
            known = self._table("hashes", "sha string, path string, slot int").filter(F.col("slot").isin(slots) & F.col("sha").isNotNull()).drop("slot")
            new = first.join(known.select("sha", F.col("path").alias("_at")), "sha", "left").filter(F.col("_at").isNull() | (F.col("_at") == F.col("path"))).drop("_at").persist()
            names = [c for c in self.files().columns if c in new.columns]
            added, every = new.count(), batch.count()
            if added:
                overwrite_partitions(upsert_catalog(files, new.select(*names)).withColumn("slot", self._slot("path")), f"{self.path}/files", "slot")
                rest = known.join(new.select("path", F.col("sha").alias("_new")), "path", "left").filter("_new is null or _new = sha").drop("_new")
                rest = rest.unionByName(new.select("sha", "path")).distinct().withColumn("slot", self._slot("sha"))
                none = self.spark.createDataFrame([(None, None, s) for s in slots], "sha string, path string, slot int")  # clears a slot that is empty now
                overwrite_partitions(rest.unionByName(none), f"{self.path}/hashes", "slot")
            overwrite_partitions(self.spark.createDataFrame([(added, every - added, number)], "added bigint, skipped bigint, batch bigint"), f"{self.path}/ledger", "batch")
            new.unpersist()
            first.unpersist()
            return True
        finally:
            batch.unpersist()
