"""Token counts from flat token files: separator scan.

A token file is nothing but little-endian ids, each document followed by the end-of-document id; there is no index.
Each file's bytes are cut into blocks; a block's vectorised search gives the places of the end id, and a prefix
scan over the blocks (running ids and running last end) stitches documents that cross block boundaries.

Files are written by Spark's text writer with the end id's bytes as line separator, so they reach any file system and
obey its commit protocol. Null and empty texts are documents of no token. A text that spells the end token out is encoded as ordinary text, so it forges
no boundary and none of its ids is lost. Ids after the last end id, if any, form an unterminated document. Empty tables give files without a document.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path, written
from .packing import encoder

#: Documents in one file at most, so that a file stays small enough to be read whole.
FILE_DOCUMENTS = 10_000
BLOCK_IDS = 1 << 18


def write_token_files(docs: DataFrame, tokenizer: str, path: str, *, text: str = "text", end: int = 50256, width: int = 2) -> str:
    """Tokenise docs into flat files of `width`-byte ids under path. An end id among a text's own ids is an error (a wrong `end`), never dropped."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            raw = [np.array(encode(t, ordinary=True) if t else (), dtype=f"<u{width}") for t in batch.column(0).to_pylist()]
            if any((x == end).any() for x in raw):
                raise ValueError(f"id {end} ends a document, but the tokenizer also gives it within a text")
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in raw], pa.binary())], names=["raw"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(work, "raw binary").select(F.col("raw").cast("string").alias("value"))
    separator = int(end).to_bytes(width, "little").decode("latin-1")
    rows.write.option("encoding", "ISO-8859-1").option("lineSep", separator).option("maxRecordsPerFile", FILE_DOCUMENTS).text(path)
    return path


def _blocks(end: int, width: int, block: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, file in enumerate(batch.column("file").to_pylist()):
                ids = np.frombuffer(batch.column("content")[i].as_buffer(), dtype=f"<u{width}")
                for k, at in enumerate(range(0, max(1, len(ids)), block)):
                    part = ids[at : at + block]
                    ends = np.flatnonzero(part == end) + at
                    yield pa.RecordBatch.from_pydict(
                        {
                            "file": pa.array([file], pa.string()),
                            "block": pa.array([k], pa.int64()),
                            "ids": pa.array([len(part)], pa.int64()),
                            "last": pa.array([int(ends[-1]) + 1 if len(ends) else None], pa.int64()),
                            "ends": pa.array([ends.tolist()], pa.list_(pa.int64())),
                        }
                    )

    return work


def token_counts(spark: SparkSession, path: str, *, end: int = 50256, width: int = 2, block: int = BLOCK_IDS) -> DataFrame:
    """One row per document of the token files under path: file, document (from 0 in its file), start, n_tokens, terminated."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    found = written(files.mapInArrow(_blocks(end, width, block), "file string, block bigint, ids bigint, last bigint, ends array<bigint>"), "token-blocks")
    slim = found.select("file", "block", "ids", "last", F.size("ends").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scanned = slim.select("file", "block", F.coalesce(F.max("last").over(earlier), F.lit(0)).alias("open"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    at = found.join(scanned, ["file", "block"]).select("file", "open", "before", "ends", F.posexplode("ends").alias("i", "stop"))
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.element_at("ends", F.col("i")) + 1)  # element_at counts from 1
    whole = at.select("file", (F.col("before") + F.col("i")).alias("document"), start.alias("start"), (F.col("stop") - start).alias("n_tokens"), F.lit(True).alias("terminated"))
    sums = slim.groupBy("file").agg(F.sum("ids").alias("ids"), F.coalesce(F.max("last"), F.lit(0)).alias("start"), F.sum("n").alias("document"))
    return whole.unionByName(sums.filter("ids > start").select("file", "document", "start", (F.col("ids") - F.col("start")).alias("n_tokens"), F.lit(False).alias("terminated")))


def count_tokens(docs: DataFrame, tokenizer: str, *, text: str = "text", keep: Sequence[str] = (), end: int = 50256, width: int = 2, path: str | None = None) -> DataFrame:
    """Write docs as token files and count them back; the columns `keep` of docs stand beside each count (and hide a result's column of their name).

    The files hold no names: a document's row in its partition tells its place (writers number their files by partition, and each
    takes FILE_DOCUMENTS rows). With `keep`, docs is therefore read twice and must give the same rows in the same order both times, as a
    table does; write anything else first. A count without a document, or the other way round, is an error.
    """
    path = path or new_path(docs.sparkSession, "tokens")
    counts = token_counts(docs.sparkSession, write_token_files(docs, tokenizer, path, text=text, end=end, width=width), end=end, width=width)
    if not keep:
        return counts
    number = F.monotonically_increasing_id()  # the partition above 33 bits, below them the row
    row = F.col("_number").bitwiseAND((1 << 33) - 1)
    places = docs.select(F.struct(*keep).alias("_kept"), number.alias("_number"))
    places = places.select("_kept", F.shiftright("_number", 33).alias("_part"), F.floor(row / FILE_DOCUMENTS).alias("_piece"), (row % FILE_DOCUMENTS).alias("_row"))
    part, piece = (F.regexp_extract("file", p, 1).cast("bigint") for p in (r"^part-(\d+)", r"-c(\d+)\."))
    rows = counts.withColumns({"_part": part, "_piece": piece, "_row": F.col("document")}).join(places, ["_part", "_piece", "_row"], "full")
    lost = F.raise_error(F.lit("docs gave other rows when read again: write them to a table first"))
    kept = F.when(F.col("_kept").isNull() | F.col("file").isNull(), lost.cast(places.schema["_kept"].dataType)).otherwise(F.col("_kept"))
    clear = [c for c in counts.columns if c not in keep]
    return rows.withColumn("_kept", kept).select("_kept.*", *clear)
