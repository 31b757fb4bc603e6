"""WARC archives: written with Spark's text writer, read back with boundary-chain verification.

Writing. A row of text followed by the separator CR LF CR LF is a WARC record: header block, empty line,
payload, two line ends. Of equal payloads of at least `least` bytes the one with the smallest page id
is a response; the others become revisit records without a payload.

Reading. The archives are split at every occurrence of the magic line, in as many tasks as the file
system has blocks. A magic line inside a payload makes a false candidate. So each task emits, for each candidate, the offset of
its successor (its own offset plus header plus Content-Length); it also resolves chains inside its block. Sums of
the blocks' bytes give absolute offsets, and pointer jumping from the start of each file
over the blocks' exits finds the one true entry of each block. Only candidates on the chain are records. Payloads that hold magic lines are
put together again from their pieces.

A null html is an empty payload; null ids and urls leave their header out. Rows with the group's smallest id are all
responses, repeated rows too; a group without any id has only responses. Files that don't start with a record have none; a file
whose chain of records stops before its end is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path, written

#: Fixed values of the format.
MAGIC, LINE, END = "WARC/1.1\r\n", "\r\n", "\r\n\r\n"
#: Groups of equal payloads that are sent to every task at most; beyond, a shuffle joins them.
BROADCAST_GROUPS = 100_000


def write_warc(pages: DataFrame, path: str, *, least: int = 100, date: str = "1970-01-01T00:00:00Z") -> str:
    """Write one record for each row of pages(page_id, url, html) into archives under path."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("_html")).withColumns({"_digest": F.sha2("_html", 256), "_bytes": F.octet_length("_html")})
    groups = rows.filter(F.col("_bytes") >= least).groupBy("_digest").agg(F.count("*").alias("_n"), F.min("page_id").alias("_first")).filter("_n > 1").drop("_n")
    groups = written(groups, "equal-payloads")
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    rows = rows.join(groups, "_digest", "left").withColumn("_revisit", F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")))

    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(LINE))).otherwise("")

    url = F.regexp_replace("url", r"[\r\n]+", " ")  # a space after it, which readers strip, keeps its end from being a magic line
    text = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(F.col("_revisit"), "revisit").otherwise("response")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.when(url.endswith(MAGIC.strip()), F.concat(url, F.lit(" "))).otherwise(url)),
        line("WARC-Page-ID", F.col("page_id").cast("string")),
        line("WARC-Refers-To-Page-ID", F.when(F.col("_revisit"), F.col("_first").cast("string"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("_digest"))),
        line("WARC-Payload-Length", F.col("_bytes").cast("string")),
        F.concat(F.lit("Content-Length: "), F.when(F.col("_revisit"), 0).otherwise(F.col("_bytes")).cast("string")),
        F.lit(END),
        F.when(F.col("_revisit"), "").otherwise(F.col("_html")),
    )
    rows.select(text.alias("value")).write.option("lineSep", END).text(path)
    return path


def _header(row: bytes) -> tuple[dict[str, str], int] | None:
    """Fields by lower-case name and the payload's place in the row; None where no header stands."""
    end = row.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in row[:end].decode("utf-8", "replace").split(LINE):
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return (fields, end + 4) if fields.get("content-length", "").isdecimal() else None


_FIELDS = {"record_type": "warc-type", "page_id": "warc-page-id", "url": "warc-target-uri", "refers_to": "warc-refers-to-page-id", "digest": "warc-payload-digest", "full_length": "warc-payload-length"}
_CANDIDATE = "file string, block bigint, at bigint, successor bigint, exit bigint, tin bigint, size bigint, whole boolean, body_at bigint, body_bytes bigint, record_type string, page_id string, url string, refers_to string, digest string, full_length string, sha256 string, payload binary, total bigint"


def _chains(at: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each candidate's chain leaves the block, and an interval (tin, size) that holds the tin of each candidate leading to it."""
    n = len(at)
    k = np.searchsorted(at, successor)
    inside = (k < n) & (at[np.minimum(k, n - 1)] == successor)
    parent = np.where(inside, k, n)
    leave, size, free, tin = successor.copy(), np.ones(n + 1, np.int64), np.zeros(n + 1, np.int64), np.zeros(n, np.int64)
    for i in range(n - 1, -1, -1):
        if parent[i] < n:
            leave[i] = leave[parent[i]]
    for i in range(n):
        size[parent[i]] += size[i]
    for i in range(n - 1, -1, -1):
        tin[i] = free[parent[i]]
        free[parent[i]] += size[i]
        free[i] = tin[i] + 1
    return leave, tin, size[:n]


def _block(file: str, block: int, rows: list[dict], total: int) -> pa.RecordBatch:
    """Offsets are relative to the first row of the block."""
    if rows:
        leave, tin, size = _chains(np.array([r["at"] for r in rows]), np.array([r["successor"] for r in rows]))
        for r, x, t, s in zip(rows, leave, tin, size, strict=True):
            r |= {"exit": int(x), "tin": int(t), "size": int(s), "total": None}
    rows = [*rows, {"at": None, "total": total}]
    names = [x.strip().split(" ") for x in _CANDIDATE.split(",")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([{"file": file, "block": block}.get(n, r.get(n)) for r in rows], kinds[k]) for n, k in names], names=[n for n, _ in names])


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    for batch in batches:
        yield from zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("value").cast(pa.binary()).to_pylist(), strict=True)


def _candidates(with_payload: bool):
    step = len(MAGIC)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, position = None, [], 0
        for file, block, value in _rows_of(batches):
            if now != (file, block):
                if now:
                    yield _block(*now, rows, position)
                now, rows, position = (file, block), [], 0
            if (block or position) and (header := _header(value)):
                fields, body = header
                length = int(fields["content-length"])
                whole = len(value) == body + length + len(END) and value.endswith(END.encode()) or len(value) == body + length
                payload = value[body : body + length] if whole else None
                rows.append(
                    {"at": position - step, "successor": position + body + length + len(END), "whole": whole, "body_at": position + body, "body_bytes": length}
                    | {k: fields.get(v) for k, v in _FIELDS.items()}
                    | {"sha256": hashlib.sha256(payload).hexdigest() if whole else None, "payload": payload if with_payload else None}
                )
            position += len(value) + step
        if now:
            yield _block(*now, rows, position)

    return work


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every piece between magic lines, with its offset from the first row of its block; the magic line that follows belongs to it."""
    now, position = None, 0
    for file, block, value in _rows_of(batches):
        if now != (file, block):
            now, position = (file, block), 0
        yield pa.RecordBatch.from_pydict({"file": pa.array([file], pa.string()), "block": pa.array([block], pa.int64()), "at": pa.array([position], pa.int64()), "raw": pa.array([value + MAGIC.encode()], pa.binary())})
        position += len(value) + len(MAGIC)


def _joined(table: pa.Table) -> pa.Table:
    """The payload of one record from its pieces."""
    rows = table.sort_by([("piece_at", "ascending")])
    start, length, first = (rows.column(c)[0].as_py() for c in ("body_at", "body_bytes", "piece_at"))
    payload = b"".join(rows.column("raw").to_pylist())[start - first : start - first + length]
    return pa.table({"file": rows.column("file")[:1], "at": rows.column("at")[:1], "sha256": pa.array([hashlib.sha256(payload).hexdigest()]), "payload": pa.array([payload], pa.binary())})


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _entries(candidates: DataFrame) -> DataFrame:
    """(file, block, entry, exit): for each block that the chain from the file's start enters, the interval number of the candidate where it does, and where the chain leaves."""
    exits = candidates.select("file", F.col("exit").alias("at")).distinct()
    nodes = candidates.join(exits, ["file", "at"], "left_semi").unionByName(candidates.filter("at = 0")).select("file", "at", "exit", "block", "tin").distinct()
    nodes = written(nodes, "chain-nodes")
    reached, jump = nodes.filter("at = 0").select("file", "at"), nodes.select("file", "at", "exit")
    count = reached.count()
    while True:
        further = reached.join(jump, ["file", "at"]).select("file", F.col("exit").alias("at")).join(nodes.select("file", "at"), ["file", "at"], "left_semi")
        reached = written(reached.unionByName(further).distinct(), "chain-reached")
        grown = reached.count()
        if grown == count:
            return reached.join(nodes, ["file", "at"]).select("file", "block", F.col("tin").alias("entry"), "exit")
        count = grown
        jump = written(jump.join(jump.select("file", F.col("at").alias("exit"), F.col("exit").alias("further")), ["file", "exit"], "left").select("file", "at", F.coalesce("further", "exit").alias("exit")), "chain-jump")


def _ends_reached(entries: DataFrame, blocks: DataFrame) -> None:
    """Raises where the chain from a file's start stops before the file's end: the records after it would be missing."""
    ends = entries.groupBy("file").agg(F.max("exit").alias("end"))
    sizes = blocks.groupBy("file").agg((F.sum("total") - len(MAGIC)).alias("size"))  # no magic line follows the last piece
    short = ends.join(sizes, "file").filter("end < size").orderBy("file").limit(5).collect()
    if short:
        raise ValueError("no record at " + ", ".join(f"byte {r.end} of {r.size} in {r.file}" for r in short))


def read_warc(spark: SparkSession, path: str, *, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives under path: file, at (offset), record_type, page_id, url, refers_to,
    payload_bytes and payload_digest of the full payload (a revisit's from its header), intact (the digest of what was
    read agrees with the header), and payload.
    """
    found = written(_pieces(spark, path).mapInArrow(_candidates(with_payload), _CANDIDATE), "candidates")
    blocks = found.filter("total is not null").select("file", "block", "total")
    before = F.sum("total").over(_by_file())
    starts = blocks.select("file", "block", (before - F.col("total")).alias("first"))
    placed = found.filter("total is null").drop("total").join(starts, ["file", "block"])
    moved = placed.withColumns({c: F.col(c) + F.col("first") for c in ("at", "successor", "exit", "body_at")}).drop("first")
    entries = written(_entries(moved.select("file", "block", "at", "exit", "tin")), "chain-entries")
    _ends_reached(entries, blocks)
    records = moved.join(entries.drop("exit"), ["file", "block"]).filter("tin <= entry and entry < tin + size")
    broken = written(records.filter("not whole").select("file", "at", "body_at", "body_bytes", "successor"), "split-records")
    if broken.limit(1).count():
        grain = 1 << 20
        pieces = _pieces(spark, path).mapInArrow(_fragments, "file string, block bigint, at bigint, raw binary").join(starts, ["file", "block"]).select("file", (F.col("at") + F.col("first")).alias("piece_at"), "raw")
        pieces = pieces.withColumn("cell", F.expr(f"piece_at div {grain}"))
        wanted = broken.withColumn("cell", F.explode(F.expr(f"sequence(body_at div {grain} - 1, successor div {grain})")))
        inside = pieces.join(wanted, ["file", "cell"]).filter("piece_at + length(raw) > body_at and piece_at < successor")
        whole = inside.select("file", "at", "body_at", "body_bytes", "piece_at", "raw").groupBy("file", "at").applyInArrow(_joined, "file string, at bigint, sha256 string, payload binary")
        records = _with_whole(records, whole)
    revisit = F.col("record_type") == "revisit"
    told = F.regexp_replace("digest", "^sha256:", "")
    return records.select(
        "file",
        "at",
        "record_type",
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        F.col("refers_to").cast("bigint").alias("refers_to"),
        F.when(revisit, F.col("full_length").cast("bigint")).otherwise(F.col("body_bytes")).alias("payload_bytes"),
        F.when(revisit, told).otherwise(F.col("sha256")).alias("payload_digest"),
        (revisit | (told == F.col("sha256"))).alias("intact"),
        *(["payload"] if with_payload else []),
    )


def _with_whole(records: DataFrame, whole: DataFrame) -> DataFrame:
    named = whole.select("file", "at", F.col("sha256").alias("_sha"), F.col("payload").alias("_pay"))
    return records.join(named, ["file", "at"], "left").withColumns({"sha256": F.coalesce("sha256", "_sha"), "payload": F.coalesce("payload", "_pay")}).drop("_sha", "_pay")


def _by_file():
    return Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def archive(pages: DataFrame, *, path: str | None = None, with_payload: bool = False, **how) -> DataFrame:
    """Write pages as WARC archives and read them back."""
    path = path or new_path(pages.sparkSession, "warc")
    return read_warc(pages.sparkSession, write_warc(pages, path, **how), with_payload=with_payload)
