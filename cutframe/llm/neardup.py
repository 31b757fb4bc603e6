"""MinHash near-dedup with DartMinHash signatures.

Each text is a weighted set of 5-word shingles; a shingle's weight is how often it occurs. Every unit of an element's weight
is a strip of the plane into which a Poisson process throws darts at increasing rank; hashes of (element, unit,
number) decide rank, place within the unit and coordinate, so two sets that share a weighted region
share its darts. A signature keeps the earliest dart of each coordinate; about K (ln K + 2) darts fill
K coordinates, however many elements there are, and sets with empty coordinates go on throwing.

The signature is cut into bands; texts that agree on a band meet in a bucket. Similarity is the weighted Jaccard similarity of two
texts, checked exactly on their elements (shingle, unit). Texts with equal elements are one node from the start. No bucket emits all its pairs:

1. Every member is checked against the bucket's first member, its centre.
2. Buckets of up to SMALL members that still hold several components have their remaining pairs checked; members of larger ones are
   checked against a few more centres.
3. What is left of a large bucket is decided by differences from its centre. If a and b differ from c by the element sets A and B, they
   differ from each other by the symmetric difference of A and B, so a similar pair must share a known number of differences. The rarest
   differences of each member, as many as that number allows to be missed, are joined within the centre's members: an exact
   prefix filter. In a cloud of independent copies most differences are a member's own, and next to no pair meets.

So each link between different texts inside a bucket is found or already implied by others. Classes are the connected components.

Null texts, and texts without a word, are each their own class. A text of fewer than five words has one
shingle, all its words. Repeated rows are exact copies. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MIX, PRIME, WordHashes, attach, binary_column, discard, gram_hashes, mixed, text_key, words_of, written
from .graphs import components, extended

BANDS, ROWS = 40, 6
#: Buckets of up to SMALL members have their open pairs checked directly; larger ones get CENTRES centres more.
SMALL, CENTRES = 16, 3
#: Keys of texts that are sent to every task at most (16 bytes each); beyond, a shuffle joins them.
BROADCAST_KEYS = 500_000


def shingles(words: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a word hash array, and how often each occurs."""
    return np.unique(gram_hashes(words, min(size, len(words))), return_counts=True)


def units(elements: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each element n times, and which of its units each one is."""
    return np.repeat(elements, n), (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64)


def dart_signature(elements: np.ndarray, weights: np.ndarray | None, coordinates: int) -> np.ndarray:
    """The earliest dart of each coordinate for a weighted set; weights None: one each."""
    unit = np.zeros(len(elements), np.uint64)
    top = None
    if weights is not None:
        n = np.ceil(weights).astype(np.int64)
        if (n > weights).any():
            top = np.repeat(weights, n)
        elements, unit = units(elements, n)
        if top is not None:
            top = top - unit  # how much of the unit is in the set
    total = float(weights.sum()) if weights is not None else float(len(elements))
    seed = mixed(elements + unit * MIX)
    rank, thrown, active = np.zeros(len(seed)), np.zeros(len(seed), np.uint64), np.arange(len(seed))
    out, best = np.zeros(coordinates, np.uint64), np.full(coordinates, np.inf)
    limit = coordinates * (math.log(coordinates) + 2) / total
    while True:
        block = max(1, int(limit / 2) + 1)
        live = active
        while len(live):
            number = thrown[live][:, None] + np.arange(1, block + 1, dtype=np.uint64)
            dart = mixed(seed[live][:, None] + number * PRIME)
            when = np.log(((dart >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53)
            np.cumsum(when, axis=1, out=when)
            np.subtract(rank[live][:, None], when, out=when)
            early = when < limit
            inside = early
            if top is not None:
                inside = early & ((mixed(dart ^ MIX) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < top[live][:, None])
            d, t = dart[inside], when[inside]
            place = (mixed(d) % np.uint64(coordinates)).astype(np.int64)
            np.minimum.at(best, place, t)
            won = t == best[place]
            out[place[won]] = d[won]
            kept = early.sum(axis=1)
            moved = kept > 0
            rank[live[moved]] = when[moved, kept[moved] - 1]
            thrown[live] += kept.astype(np.uint64)
            live = live[kept == block]
        if np.isfinite(best).all():
            return out
        limit *= 2


def _elements(words: np.ndarray, size: int, counted: bool) -> np.ndarray:
    """Sorted hashes of a text's (shingle, unit) pairs."""
    found, n = shingles(words, size)
    if counted and n.max() > 1:
        each, unit = units(found, n)
        return np.sort(mixed(each + unit * MIX))
    return np.sort(mixed(found))


def _signatures(size: int, bands: int, rows: int, counted: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, salt = WordHashes(), np.arange(1, bands + 1, dtype=np.uint64) * MIX
        for batch in batches:
            keys, sets, found, done = [], [], [], set()
            for tk, text in zip(batch.column("tk").to_pylist(), binary_column(batch, "text"), strict=True):
                words = words_of(text)
                if not words or tk in done:
                    continue
                done.add(tk)
                h = hashes.of(words)
                elements, n = shingles(h, size)
                signature = dart_signature(elements, n.astype(np.float64) if counted else None, bands * rows).reshape(bands, rows)
                band = salt.copy()
                for j in range(rows):
                    band = mixed(band * PRIME + signature[:, j])
                keys.append(tk)
                sets.append(xxhash.xxh128_digest(elements.tobytes() + n.tobytes() if counted else elements.tobytes()))
                found.append(band.view(np.int64))
            if keys:
                flat = pa.array(np.concatenate(found))
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * bands), flat)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary()), listed], names=["tk", "sk", "bands"])

    return work


def _sets(size: int, counted: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [_elements(hashes.of(words_of(t)), size, counted).tobytes() for t in binary_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("id")), pa.array(found, pa.binary())], names=["id", "grams"])

    return work


def _similar(threshold: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                n, m = len(x) // 8, len(y) // 8
                if min(n, m) < threshold * max(n, m):
                    keep.append(False)
                    continue
                both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(common >= threshold * (n + m - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())], names=["a", "b", "same"])

    return work


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs with the elements x of a and y of b. Many pairs can share their a, few share their b, so the last join is on b: it deals the work after it evenly."""
    return pairs.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("grams").alias("y")), "b")


def _checked(pairs: DataFrame, sets: DataFrame, threshold: float, name: str) -> DataFrame:
    """pairs(a, b) with same: whether the Jaccard similarity of their elements reaches the threshold."""
    return written(_with_sets(pairs, sets).mapInArrow(_similar(threshold), "a bigint, b bigint, same boolean"), name)


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For member b of centre a: sizes of both, and the elements that only one of them has, the last bit telling which."""
    for batch in batches:
        n, m, found = [], [], []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
            centre, member = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            new, lost = np.setdiff1d(member, centre, True) | np.uint64(1), np.setdiff1d(centre, member, True) & ~np.uint64(1)
            n.append(len(member))
            m.append(len(centre))
            found.append(np.unique(np.concatenate([new, lost])).view(np.int64))
        made = [pa.array(n, pa.int32()), pa.array(m, pa.int32()), pa.array(found, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), batch.column("comp"), *made], names=["c", "id", "comp", "n", "m", "diff"])


def _pairs_by_differences(stars: DataFrame, comps: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of different components among the members b of one centre a that can be similar by their differences from it.

    With r = (1 - threshold) / (1 + threshold), two sets are similar where their symmetric difference is at most r times the sum of their
    sizes. Members x and y with D(x), D(y) differences from a centre of size m thus share at least o = (D(x) + D(y) - r (n(x) + n(y))) / 2
    of them. A pair has one member at least that isn't similar to the centre, else both are in its component. Facing such a y,
    o > (D(x) + r (m - n(x))) / 2; that is what the `tight` positions of x stand for. Facing a member that is similar to the centre, an
    x that isn't has o >= (D(x) - r (n(x) + m)) / (1 + r). Positions count from the member's rarest difference within the centre.
    """
    r = (1 - threshold) / (1 + threshold)
    placed = stars.join(comps.withColumnRenamed("id", "b"), "b", "left").withColumn("comp", F.coalesce("comp", "b"))
    several = placed.groupBy("a").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1").select("a")
    full = _with_sets(placed.join(several, "a", "left_semi"), sets)
    diffs = full.mapInArrow(_differences, "c bigint, id bigint, comp bigint, n int, m int, diff array<bigint>").repartition("c", "id")
    each = diffs.select("c", "id", "comp", "n", "m", F.size("diff").alias("d"), F.explode("diff").alias("e"))
    alike, member = Window.partitionBy("c", "e"), Window.partitionBy("c", "id")
    shared = each.withColumns({"k": F.count("*").over(alike), "c0": F.min("comp").over(alike), "c1": F.max("comp").over(alike)}).filter("k > 1")
    placed = shared.withColumn("p", F.col("d") - F.count("*").over(member) + F.row_number().over(member.orderBy("k", "e")) - 1)
    linked = F.col("d") <= r * (F.col("n") + F.col("m")) + 1e-9
    tight = F.col("p") <= F.col("d") - F.floor((F.col("d") + r * (F.col("m") - F.col("n"))) / 2 - 1e-9) - 1
    loose = ~linked & (F.col("p") <= F.col("d") - F.ceil((F.col("d") - r * (F.col("n") + F.col("m"))) / (1 + r) - 1e-9))
    kept = placed.withColumns({"linked": linked, "tight": tight}).filter((F.col("c0") != F.col("c1")) & (tight | loose))
    kept = written(kept.select("c", "e", "id", "comp", "n", "d", "p", "linked", "tight"), "prefixes")
    x, y = kept.filter("tight").alias("x"), kept.filter("not linked").alias("y")
    least = F.ceil((F.col("x.d") + F.col("y.d") - r * (F.col("x.n") + F.col("y.n"))) / 2 - 1e-9)
    on = (F.col("x.c") == F.col("y.c")) & (F.col("x.e") == F.col("y.e")) & (F.col("x.comp") != F.col("y.comp")) & (F.col("x.linked") | (F.col("y.tight") & (F.col("x.id") < F.col("y.id"))))
    on &= (F.col("x.p") <= F.col("x.d") - least) & (F.col("y.p") <= F.col("y.d") - least)
    return x.join(y, on).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))


def _texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, text) for each id of wanted(id, tk), copies of a text read once. Up to BROADCAST_KEYS keys go to every task, so that the texts needn't be shuffled."""
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted
    return texts.join(wanted, "tk").dropDuplicates(["id"]).select("id", "text")


def near_duplicates(docs: DataFrame, *, text: str = "text", size: int = 5, threshold: float = 0.8, bands: int = BANDS, rows: int = ROWS, counted: bool = True) -> DataFrame:
    """(tk, comp) for each distinct text with a word: comp is equal for texts of one class; tk is text_key.

    counted: a shingle weighs as much as it occurs, for signatures and similarity alike; otherwise sets of shingles are compared.
    """
    texts = docs.select(text_key(text).alias("tk"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    raw = written(texts.mapInArrow(_signatures(size, bands, rows, counted), "tk binary, sk binary, bands array<bigint>"), "all-signatures")
    signed = written(raw.dropDuplicates(["sk"]).select(F.monotonically_increasing_id().alias("id"), "tk", "sk", "bands"), "signatures")
    rows_by_band = signed.select("id", F.explode("bands").alias("bucket"))
    buckets = written(rows_by_band.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).filter("n > 1"), "buckets")
    members = written(rows_by_band.join(buckets.filter("n > 2"), "bucket").select("bucket", "id", "n", "lo"), "members")
    stars = members.filter("id <> lo").select(F.col("lo").alias("a"), F.col("id").alias("b"), "n")
    pairs = written(buckets.filter("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b")).unionByName(stars.select("a", "b")).distinct(), "pairs")
    involved = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(signed.select("id", "tk"), "id"), "involved")
    sets = written(_texts_of(texts, involved).mapInArrow(_sets(size, counted), "id bigint, grams binary"), "shingle-sets")
    tested = _checked(pairs, sets, threshold, "tested")
    comps = components(tested.filter("same"))
    rounds = [tested]
    for step in ("centres", "differences"):
        if step == "centres":
            labelled = members.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
            open_ = labelled.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 <> c1").select("bucket")
            left = written(labelled.join(open_, "bucket", "left_semi").select("bucket", "id", "n", "comp"), "open-buckets")
            small, big = left.filter(F.col("n") <= SMALL), left.filter(F.col("n") > SMALL)
            other = small.select("bucket", F.col("id").alias("b"), F.col("comp").alias("cb"))
            more = small.select("bucket", F.col("id").alias("a"), F.col("comp").alias("ca")).join(other, "bucket").filter("a < b and ca <> cb").select("a", "b")
            slot = big.groupBy("bucket", F.pmod(F.xxhash64("id"), F.lit(CENTRES)).alias("slot")).agg(F.min(F.struct("id", "comp")).alias("m"))
            chosen = slot.select("bucket", F.col("m.id").alias("cid"), F.col("m.comp").alias("cc"))
            more = more.unionByName(big.join(chosen, "bucket").filter("comp <> cc").select(F.least("id", "cid").alias("a"), F.greatest("id", "cid").alias("b")))
        else:
            more = _pairs_by_differences(stars.filter(F.col("n") > SMALL).select("a", "b").distinct(), comps, sets, threshold)
        again = _checked(more.distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti"), sets, threshold, "tested")
        rounds.append(again)
        tested = tested.unionByName(again)
        if again.filter("same").limit(1).count():
            comps = extended(comps, again.filter("same"))
    out = written(raw.select("tk", "sk").join(signed.select("sk", "id"), "sk").join(comps, "id", "left").select("tk", F.coalesce("comp", "id").alias("comp")).dropDuplicates(["tk"]), "text-classes")
    discard(raw, signed, buckets, members, pairs, involved, sets, left, *rounds)
    return out


def near_duplicate_classes(docs: DataFrame, *, text: str = "text", id_column: str = "doc_id", **how) -> DataFrame:
    """One row per document: its id column, class_id (the smallest id of its class) and class_size.

    Documents without a word, and null texts, form classes of their own (class_id: their own id).
    """
    comps = near_duplicates(docs, text=text, **how)
    rows = docs.select(F.col(id_column).alias("_id"), text_key(text).alias("tk"))
    placed = rows.join(comps, "tk", "left")
    sizes = placed.filter("comp is not null").groupBy("comp").agg(F.min("_id").alias("class_id"), F.count("*").alias("class_size"))
    return placed.join(sizes, "comp", "left").select(F.col("_id").alias(id_column), F.when(F.col("comp").isNull(), F.col("_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"))


def keep_one_of_each(docs: DataFrame, *, text: str = "text", id_column: str = "doc_id", **how) -> DataFrame:
    """docs with one document of each class: that with the smallest id (nulls last), then the smallest text key.

    Rows that repeat both id and text are copies: one stays. Null and wordless texts all stay.
    """
    comps = near_duplicates(docs, text=text, **how)
    slim = docs.select(F.col(id_column).alias("_id"), text_key(text).alias("_tk"))
    chosen = slim.join(comps.select(F.col("tk").alias("_tk"), "comp"), "_tk").groupBy("comp").agg(F.min(F.struct(F.col("_id").isNull().alias("last"), "_id", "_tk")).alias("m"))
    counts = slim.groupBy("_id", "_tk").agg(F.count("*").alias("copies"))
    chosen = written(chosen.select(F.col("m._id").alias("_id"), F.col("m._tk").alias("_tk")).join(counts.select(F.col("_id").alias("_i"), F.col("_tk").alias("_t"), "copies"), F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_tk") == F.col("_t"))).select("_id", "_tk", "copies"), "chosen")
    marked = docs.withColumn("_k", text_key(text))
    on = (F.col(id_column).eqNullSafe(F.col("_id"))) & (F.col("_k") == F.col("_tk"))
    single = marked.join(chosen.filter("copies = 1"), on, "left_semi")
    if chosen.filter("copies > 1").limit(1).count():
        single = single.unionByName(marked.join(chosen.filter("copies > 1"), on, "left_semi").dropDuplicates([id_column, "_k"]))
    wordless = marked.filter(F.col(text).isNull() | ~F.col(text).rlike(r"[^\x20\x09-\x0D]"))
    return single.unionByName(wordless).select(*docs.columns)
