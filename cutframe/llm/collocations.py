"""Phrase collocations: phrases of two and three words counted without loss in quotient filters.

Texts have A-Z lower-cased, are split into pieces at `[.,;:!?\\x0A-\\x0D]` and pieces into words `[^\\x20\\x09]+`; a phrase lies within a
piece. Everything is counted per group (a language; null: `und`).

1. A task numbers a group's words as it meets them and packs the numbers of two or three words into one integer. When it holds a bounded
   number of words it closes its largest shard: the words with their counts, and a counting quotient filter of its bigrams and
   one of its trigrams.
2. The shards' words are summed up. Words of `least` occurrences or more get a number for the whole corpus; a phrase with a rarer
   word can't be a candidate.
3. A filter loses nothing, so each shard's is read back, its words renumbered, and filters of the whole corpus's numbers are dealt by the leading bits of
   the quotient. The permutation spreads phrases evenly whatever their frequency, and a frequent one is a single entry of a shard.
4. The sorted filters of one range are merged, and what occurs often enough is turned back into words.
5. Joins give each candidate its parts' counts; scores are exact integer quotients.

A filter: the integer goes through a Feistel permutation, which can be undone. Its leading bits, the quotient, are told by a
run of ones for each quotient's entries, all other bits, the remainder, are kept whole, and a counter takes one bit if it is 1,
a byte more below 255 and eight more beyond.

Empty texts and tables give no phrase; null texts count as empty. Rows that repeat count each time. Other columns play no part. A very long
text is read in blocks; only a piece that is longer than a shard makes that shard longer. Counts of 10^16 or more raise an error, as do more than 2^42 different frequent words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import binary_column, discard, mixed, new_path, written

#: Words that a task holds at most before it closes its largest shard, and bytes of text handled at once.
HELD_WORDS, BLOCK_BYTES = 1 << 21, 1 << 20
#: Entries that a task gathers before it hands over filters, and those meant for one range of quotients, from and to.
HELD_ENTRIES, RANGE_ENTRIES, MOST_RANGE_ENTRIES = 1 << 19, 1 << 18, 1 << 22
ROUNDS = 4
END = b"\n"
ONE_END = bytes.maketrans(b".,;:!?\x0b\x0c\r", END * 9)
#: Groups are cut into so many parts before their best phrases meet.
SALTS = (4096, 64, 1)

Halves = tuple[np.ndarray, np.ndarray]


def permuted(left: np.ndarray, right: np.ndarray, half: int, back: bool = False) -> Halves:
    """A Feistel network over two halves of `half` bits each; back undoes it."""
    mask = np.uint64((1 << half) - 1)
    keys = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for key in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (mixed(left + key) & mask), left
        else:
            left, right = right, left ^ (mixed(right + key) & mask)
    return left, right


def packed(words: list[np.ndarray], bits: int) -> tuple[Halves, int]:
    """Numbers of `bits` bits each, two or three, as two halves, and a half's bits."""
    w = [x.astype(np.uint64) for x in words]
    if len(w) == 2:
        return (w[0], w[1]), bits
    half = (3 * bits + 1) // 2
    low, cut = np.uint64((1 << half) - 1), np.uint64(half - bits)
    return (w[0] << np.uint64(2 * bits - half) | w[1] >> cut, (w[1] << np.uint64(bits) | w[2]) & low), half


def unpacked(left: np.ndarray, right: np.ndarray, words: int, bits: int) -> list[np.ndarray]:
    if words == 2:
        return [left, right]
    half = (3 * bits + 1) // 2
    over, cut, mask = np.uint64(2 * bits - half), np.uint64(half - bits), np.uint64((1 << bits) - 1)
    return [left >> over, (left << cut | right >> np.uint64(bits)) & mask, right & mask]


def summed(left: np.ndarray, right: np.ndarray, counts: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal entries as one, in order; sorted runs are merged."""
    if 2 * half <= 64:
        order = np.argsort(left << np.uint64(half) | right, kind="stable")
    else:
        order = np.lexsort((right, left))
    left, right, counts = left[order], right[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])))) if len(left) else np.zeros(0, np.int64)
    return left[first], right[first], np.add.reduceat(counts, first) if len(first) else counts


def _low_bytes(x: np.ndarray, n: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def _from_low_bytes(data: np.ndarray, n: int) -> np.ndarray:
    wide = np.zeros((len(data) // n if n else 0, 8), np.uint8)
    if n:
        wide[:, :n] = data.reshape(-1, n)
    return wide.view("<u8").ravel().astype(np.uint64)


def filter_bytes(left: np.ndarray, right: np.ndarray, counts: np.ndarray, half: int) -> bytes:
    """A counting quotient filter of sorted, different permuted entries."""
    n = len(left)
    q = min(half, max(0, n.bit_length() - 1))
    rest = half - q
    quotient = (left >> np.uint64(rest)).astype(np.int64)
    runs = np.zeros(n + (1 << q), np.uint8)  # a one for each entry of a quotient, then a zero
    runs[np.arange(n) + quotient] = 1
    many = counts > 1
    more = counts[many]
    large = more[more >= 255]
    head = np.array([n, len(more), len(large), half, q], "<u8").tobytes()
    return b"".join([
        head,
        np.packbits(runs).tobytes(),
        _low_bytes(left & np.uint64((1 << rest) - 1), (rest + 7) // 8),
        _low_bytes(right, (half + 7) // 8),
        np.packbits(many).tobytes(),
        np.minimum(more, 255).astype(np.uint8).tobytes(),
        large.astype("<u8").tobytes(),
    ])


def filter_entries(data: bytes | memoryview) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(left, right, counts, half) of a filter: everything that went in, in order."""
    raw = np.frombuffer(data, np.uint8)
    n, n_more, n_large, half, q = (int(v) for v in raw[:40].view("<u8"))
    rest, at = half - q, 40

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return raw[at - size : at]

    runs = np.unpackbits(take((n + (1 << q) + 7) // 8), count=n + (1 << q))
    quotient = np.flatnonzero(runs) - np.arange(n)
    low = (rest + 7) // 8
    remainder = _from_low_bytes(take(n * low), low) if low else np.zeros(n, np.uint64)
    right = _from_low_bytes(take(n * ((half + 7) // 8)), (half + 7) // 8)
    counts = np.ones(n, np.int64)
    many = np.flatnonzero(np.unpackbits(take((n + 7) // 8), count=n))
    more = take(n_more).astype(np.int64)
    more[more == 255] = take(8 * n_large).view("<u8").astype(np.int64)
    counts[many] = more
    return quotient.astype(np.uint64) << np.uint64(rest) | remainder, right, counts, half


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """A text's words with END after each piece, a bounded number of bytes at a time unless a word is longer."""
    text = text.lower().translate(ONE_END)
    at = 0
    while at < len(text):
        to = at + BLOCK_BYTES
        if to < len(text):
            cut = max(text.rfind(gap, at, to) for gap in (END, b" ", b"\t"))
            while cut < at and to < len(text):
                cut = min((c for c in (text.find(gap, to, to + BLOCK_BYTES) for gap in (END, b" ", b"\t")) if c >= 0), default=-1)
                to += BLOCK_BYTES
            to = cut + 1 if cut >= at else len(text)
        *closed, last = text[at:to].split(END)
        words: list[bytes] = []
        for piece in closed:
            words += piece.split()
            words.append(END)
        yield words + last.split()
        at = to
    yield [END]


class _Shard:
    """Words of one group, numbered from 1 as they come; 0 ends a piece."""

    def __init__(self):
        self.number: dict[bytes, int] = {END: 0}
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        number = self.number
        for w in set(words).difference(number):
            number[w] = len(number)
        self.held.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
        self.size += len(words)

    def closed(self) -> tuple[int, list[bytes], np.ndarray, bytes, bytes]:
        """Occurrences, words, their counts, and the filters of two and three words."""
        ids = np.concatenate(self.held)
        bits = max(1, (len(self.number) - 1).bit_length())
        counts = np.bincount(ids, minlength=len(self.number))[1:]
        full = ids > 0
        two = full[:-1] & full[1:]
        filters = []
        for n, fits in ((2, two), (3, two[:-1] & full[2:] if len(ids) > 2 else two[:0])):
            at = np.flatnonzero(fits)
            (left, right), half = packed([ids[at + j] for j in range(n)], bits)
            left, right = permuted(left, right, half)
            filters.append(filter_bytes(*summed(left, right, np.ones(len(at), np.int64), half), half))
        return int(counts.sum()), list(self.number)[1:], counts, *filters


SHARD = "shard string, grp string, n bigint, entries bigint, words binary, counts binary, two binary, three binary"


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, closed, held = TaskContext.get().partitionId(), 0, 0
    shards: dict[str, _Shard] = {}

    def close(group: str) -> Iterator[pa.RecordBatch]:
        nonlocal closed, held
        shard = shards.pop(group)
        held -= shard.size
        n, words, counts, two, three = shard.closed()
        if n:
            closed += 1
            entries = int(np.frombuffer(two, "<u8", 1)[0] + np.frombuffer(three, "<u8", 1)[0])
            row = [f"{part}-{closed}", group, n, entries, b" ".join(words), counts.astype("<i8").tobytes(), two, three]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=[c.split()[0] for c in SHARD.split(", ")])

    for batch in batches:
        for group, text in zip(batch.column("grp").to_pylist(), binary_column(batch, "text"), strict=True):
            for words in word_blocks(text):
                shards.setdefault(group, _Shard()).add(words)
                held += len(words)
                while words[-1:] == [END] and held >= HELD_WORDS:
                    yield from close(max(shards, key=lambda g: shards[g].size))
    for group in list(shards):
        yield from close(group)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each word of a shard, with its number there."""
    for batch in batches:
        for shard, group, words, counts in zip(*(batch.column(c).to_pylist() for c in ("shard", "grp", "words", "counts")), strict=True):
            every, f = words.split(b" "), np.frombuffer(counts, "<i8")
            for at in range(0, len(every), 1 << 16):
                some = every[at : at + (1 << 16)]
                k = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * k, pa.string()), pa.array([group] * k, pa.string()), pa.array(np.arange(at + 1, at + k + 1, dtype=np.int32)), pa.array(some, pa.binary()), pa.array(f[at : at + k].astype(np.int64))],
                    names=["shard", "grp", "i", "word", "f"],
                )


def _renumbered(bits: int, range_bits: int):
    """Shards' filters by the corpus's word numbers, a part for each range of quotients."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {2: [], 3: []}

        def handed(n: int) -> Iterator[pa.RecordBatch]:
            if not held[n]:
                return
            half = held[n][0][3]
            left, right, counts = summed(*(np.concatenate([h[j] for h in held[n]]) for j in range(3)), half)
            held[n].clear()
            top = min(range_bits, half)
            span = left >> np.uint64(half - top)
            edges = np.flatnonzero(np.concatenate(([True], span[1:] != span[:-1]))) if len(left) else []
            ends = [*edges[1:], len(left)]
            made = [filter_bytes(left[a:b], right[a:b], counts[a:b], half) for a, b in zip(edges, ends, strict=True)] if len(left) else []
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(made), pa.int32()), pa.array([int(span[a]) for a in edges], pa.int64()), pa.array(made, pa.binary())], names=["size", "span", "entries"])

        for batch in batches:
            for i, told in enumerate(batch.column("told")):
                pairs = told.values
                own, ids = pairs.field("i").to_numpy(), pairs.field("id").to_numpy()
                number = np.zeros(int(own.max()) + 1, np.uint64)
                number[own] = ids.astype(np.uint64)
                local_bits = max(1, batch.column("size")[i].as_py().bit_length())
                for n, column in ((2, "two"), (3, "three")):
                    left, right, counts, half = filter_entries(batch.column(column)[i].as_buffer())
                    words = unpacked(*permuted(left, right, half, back=True), n, local_bits)
                    words = [w.astype(np.int64) for w in words]
                    fits = np.logical_and.reduce([w < len(number) for w in words])
                    words = [number[w[fits]] for w in words]
                    known = np.logical_and.reduce([w > 0 for w in words])
                    (left, right), half = packed([w[known] for w in words], bits)
                    if len(left):
                        held[n].append((*permuted(left, right, half), counts[fits][known], half))
                    if sum(len(h[0]) for h in held[n]) >= HELD_ENTRIES:
                        yield from handed(n)
        for n in held:
            yield from handed(n)

    return work


def _merged(bits: int, least: int):
    def work(table: pa.Table) -> pa.Table:
        n = table.column("size")[0].as_py()
        parts = [filter_entries(x.as_buffer()) for x in table.column("entries")]
        half = parts[0][3]
        left, right, counts = summed(*(np.concatenate([p[j] for p in parts]) for j in range(3)), half)
        often = counts >= least
        words = unpacked(*permuted(left[often], right[often], half, back=True), n, bits)
        ids = [pa.array(w.astype(np.int64)) for w in words] + [pa.nulls(int(often.sum()), pa.int64())] * (3 - n)
        return pa.table([*ids, pa.array(counts[often])], names=["w1", "w2", "w3", "f"])

    return work


@contextmanager
def _small_batches(spark: SparkSession):
    """A shard's row holds megabytes: few of them at a time go to Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(8 << 20))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def numbered(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame, int]:
    """rows with `id` from 1 without gaps, the table behind it, and how many there are. The driver gets a count for each partition."""
    held = written(rows.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    counts = sorted((r.p, r.n) for r in held.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    start = rows.sparkSession.createDataFrame(starts or [(0, 0)], "p bigint, start bigint")
    out = held.join(F.broadcast(start), part == F.col("p")).withColumn("id", F.col("start") + F.col("_at") - F.shiftleft(F.col("p"), 33) + 1)
    return out.select(*rows.columns, "id"), held, total


@contextmanager
def _in_buckets(rows: DataFrame, column: str):
    """rows as a table in buckets by the column, while it is needed: a join on it shuffles only the other side."""
    spark, name, path = rows.sparkSession, f"cutframe_{uuid.uuid4().hex}", new_path(rows.sparkSession, "buckets")
    rows.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).option("path", path).saveAsTable(name)
    table = spark.table(name)
    table._written_path = path
    try:
        yield table
    finally:
        spark.sql(f"DROP TABLE {name}")
        discard(table)


def phrase_counts(docs: DataFrame, *, text: str = "text", group: str = "lang", least: int = 10) -> tuple[DataFrame, DataFrame, DataFrame, list[DataFrame]]:
    """(totals(grp, n), words(grp, word, f, id), phrases(w1, w2, w3, f)) with f of `least` or more, and the tables they stand on."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("grp"), F.col(text).cast("string").alias("text")).filter("text is not null")
    with _small_batches(spark), _in_buckets(rows.mapInArrow(_shards, SHARD), "shard") as shards:
        totals = written(shards.groupBy("grp").agg(F.sum("n").alias("n")), "totals")
        each = shards.select("shard", "grp", "words", "counts").mapInArrow(_words, "shard string, grp string, i int, word binary, f bigint").withColumn("word", F.col("word").cast("string"))
        words, held, many = numbered(each.groupBy("grp", "word").agg(F.sum("f").alias("f")).filter(F.col("f") >= least), "words")
        bits = max(1, many.bit_length())
        if bits > 42:
            raise ValueError(f"{many} different words of {least} occurrences or more are too many")
        told = each.select("shard", "grp", "i", "word").join(words.select("grp", "word", "id"), ["grp", "word"]).groupBy("shard").agg(F.collect_list(F.struct("i", "id")).alias("told"))
        entries = shards.agg(F.sum("entries")).first()[0] or 0
        span = min(MOST_RANGE_ENTRIES, max(RANGE_ENTRIES, entries >> 12))
        range_bits = max(0, (entries // span).bit_length())
        size = (F.length("counts") / 8).cast("int").alias("size")
        parts = shards.select("shard", size, "two", "three").join(told, "shard").mapInArrow(_renumbered(bits, range_bits), "size int, span bigint, entries binary")
        phrases = written(parts.groupBy("size", "span").applyInArrow(_merged(bits, least), "w1 bigint, w2 bigint, w3 bigint, f bigint"), "phrases")
    return totals, words, phrases, [totals, held, phrases]


def _score(a: str, left: str, right: str):
    """floor(10^6 a^2 / (l r)), exactly: decimals hold 38 digits."""
    d = "cast({} as decimal(16,0))".format
    return F.expr(f"(cast(1000000 as decimal(7,0)) * ({d(a)} * {d(a)})) div ({d(left)} * {d(right)})")


def collocations(docs: DataFrame, *, text: str = "text", group: str = "lang", least: int = 10, absorb: int = 50, top: int = 2000) -> DataFrame:
    """Each group's `top` phrases: group (named as the column), rank, phrase, a, l, r, n, score; in order of score, a (both falling) and phrase.

    Cutting a phrase after its first k words gives l and r, the counts of both parts; the cut of least score counts, ties go to the smallest k.
    A phrase goes if a longer candidate around it has `absorb` per cent of its occurrences or more."""
    totals, words, phrases, tables = phrase_counts(docs, text=text, group=group, least=least)
    first, second = (words.select(F.col("id").alias(w), *(F.col(c).alias(f"{c}{i}") for c in ("grp", "word", "f"))) for i, w in ((1, "w1"), (2, "w2")))
    pairs = phrases.filter("w3 is null").select("w1", "w2", F.col("f").alias("a")).join(first, "w1").join(second.drop("grp2"), "w2")
    pairs = written(pairs.select("w1", "w2", F.col("grp1").alias("grp"), "word1", "word2", "a", F.col("f1").alias("l"), F.col("f2").alias("r")), "pairs")
    head = pairs.select("w1", "w2", "grp", "word1", "word2", F.col("a").alias("r1"), F.col("l").alias("l1"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("word2").alias("word3"), F.col("a").alias("r2"), F.col("r").alias("f3"))
    triples = phrases.filter("w3 is not null").select("w1", "w2", "w3", F.col("f").alias("a"))
    around = triples.select("w1", "w2", "a").unionAll(triples.select("w2", "w3", "a")).groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    two = pairs.join(around, ["w1", "w2"], "left").filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * absorb))
    two = two.select("grp", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    cut = triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"])
    cut = cut.withColumns({"s1": _score("a", "l1", "r2"), "s2": _score("a", "r1", "f3")})
    at1 = F.col("s1") <= F.col("s2")
    three = cut.select(
        "grp",
        F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"),
        "a",
        F.when(at1, F.col("l1")).otherwise(F.col("r1")).alias("l"),
        F.when(at1, F.col("r2")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    best = two.unionAll(three)
    for salts in SALTS:  # a group's best are the best of its parts' best
        part = Window.partitionBy("grp", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
        best = best.withColumn("rank", F.row_number().over(part.orderBy(F.desc("score"), F.desc("a"), "phrase"))).filter(F.col("rank") <= top)
    out = written(best.join(totals, "grp").select(F.col("grp").alias(group), F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "collocations")
    discard(*tables, pairs)
    return out
