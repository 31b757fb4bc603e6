"""Substring dedup: suffix automata of reference shards, documents streamed for matching statistics.

A window is `min_words` consecutive words. The job finds every window whose word sequence starts at
two places or more of the corpus and removes each word that such a window covers.

1. Each window is keyed by the least hash of its 8-word grams (its anchor). Equal windows have equal
   anchors, so only windows under one anchor need comparing. Consecutive windows with one anchor
   form a run; a document of n words has about n/14 runs.
2. Runs whose anchor occurs once in the corpus go. Equal runs (same anchor, same words) collapse to
   one representative with a count; a count of two or more settles all windows of the run.
3. Anchors with several different runs, or that a run holds twice, form reference shards. Each shard's task builds the suffix
   automaton of its representatives and streams them through it: the matching statistic of every
   position, cut at the threshold, names the state whose weight is the window's number of places.
   A shard is dealt by anchor instead of sending every automaton to every task, since a
   broadcast automaton is bounded but a corpus of them is not.
4. Anchors with more than `hot` different runs are counted window by window with a plain
   aggregation, which combines before the shuffle and so has no hot task.

Nulls and empty texts have no words and stay as they are; texts shorter than a window too. Repeated
rows are repeats like any others. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PRIME, WordHashes, attach, binary_column, discard, gram_hashes, mixed, text_key, words_of, written

GRAM = 8
_INVERSE = np.uint64(pow(int(PRIME), -1, 2**64))
_RUN = "tk binary, m bigint, c bigint, s int, e int, inner boolean"


class _Powers:
    """Powers of PRIME and of its inverse, as far as a text is long."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up), 4096)
            step = np.full(size, PRIME, np.uint64)
            back = np.full(size, _INVERSE, np.uint64)
            step[0] = back[0] = 1
            cls.up, cls.down = np.cumprod(step, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
        return cls.up, cls.down


def _spans_hash(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of words[start:end] for each span, wherever it stands."""
    up, down = _Powers.to(len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    at = 1
    while 2 * at <= width:
        x = np.minimum(x[:-at], x[at:])
        at *= 2
    return np.minimum(x[: len(x) - (width - at)], x[width - at :]) if width > at else x


def _again(grams: np.ndarray, anchor: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether a run holds its anchor more than once: only then can two of its own windows be equal."""
    out = np.zeros(len(start), bool)
    value, count = np.unique(grams, return_counts=True)
    if len(value) < len(grams):
        for i in np.flatnonzero(np.isin(anchor, value[count > 1])):
            out[i] = np.count_nonzero(grams[start[i] : end[i]] == anchor[i]) > 1
    return out


def _runs(window: int):
    gram = min(GRAM, window)
    width = window - gram + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            row, m, c, s, e, inner = [], [], [], [], [], []
            for i, text in enumerate(binary_column(batch, "text")):
                words = words_of(text)
                if len(words) < window:
                    continue
                h = hashes.of(words)
                grams = gram_hashes(h, gram)
                least = _least(grams, width)
                start = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
                end = np.r_[start[1:], len(least)] - 1
                inner.append(_again(grams, least[start], start, end + width))
                row.append(np.full(len(start), i))
                m.append(least[start])
                c.append(_spans_hash(h, start, end + window))
                s.append(start)
                e.append(end)
            if row:
                s, e = np.concatenate(s), np.concatenate(e)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(batch.schema.get_field_index("tk")).take(pa.array(np.concatenate(row))),
                        pa.array(np.concatenate(m).view(np.int64)),
                        pa.array(np.concatenate(c).view(np.int64)),
                        pa.array(s.astype(np.int32)),
                        pa.array(e.astype(np.int32)),
                        pa.array(np.concatenate(inner)),
                    ],
                    names=["tk", "m", "c", "s", "e", "inner"],
                )

    return work


def _cut_out(window: int):
    """The word hashes of the runs that a text is asked for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for text, tk, wanted in zip(binary_column(batch, "text"), batch.column("tk").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                h = (hashes.of(words_of(text)) >> np.uint64(32)).astype(np.uint32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([w["shard"] for w in wanted], pa.int32()),
                        "tk": pa.array([tk] * len(wanted), pa.binary()),
                        "s": pa.array([w["s"] for w in wanted], pa.int32()),
                        "e": pa.array([w["e"] for w in wanted], pa.int32()),
                        "n": pa.array([w["n"] for w in wanted], pa.int64()),
                        "words": pa.array([h[w["s"] : w["e"] + window].tobytes() for w in wanted], pa.binary()),
                    }
                )

    return work


class SuffixAutomaton:
    """A generalised suffix automaton over integers; `weight` counts marked end positions of a state's strings."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.weight = [-1], [0], [0]

    def _state(self, length: int, arcs: dict[int, int], link: int) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.weight.append(0)
        return len(self.link) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        """The state for the strings of q that end an arc from p: q itself, or its copy."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = copy
            p = self.link[p]
        return copy

    def extend(self, last: int, symbol: int) -> int:
        """Add last's string followed by symbol; returns its state."""
        if (q := self.next[last].get(symbol)) is not None:
            return self._split(last, symbol, q)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, symbol, self.next[p][symbol])
        return new

    def settle(self) -> None:
        """Carry weights to suffixes."""
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[v] > 0:
                self.weight[self.link[v]] += self.weight[v]

    def places(self, symbols: list[int], size: int) -> Iterator[int]:
        """For each position, the weight of the last `size` symbols, 0 where fewer are matched."""
        v = matched = 0
        for symbol in symbols:
            while v and symbol not in self.next[v]:
                v = self.link[v]
                matched = self.length[v]
            if symbol in self.next[v]:
                v = self.next[v][symbol]
                matched += 1
            while v and self.length[self.link[v]] >= size:
                v = self.link[v]
                matched = min(matched, self.length[v])
            yield self.weight[v] if matched >= size else 0


def _covered(flags: np.ndarray, first: int, window: int) -> list[tuple[int, int]]:
    """Word intervals that the flagged windows cover; window i starts at word first + i."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    parts = np.split(at, np.flatnonzero(np.diff(at) > window) + 1)
    return [(first + int(p[0]), first + int(p[-1]) + window) for p in parts]


def _shard(window: int):
    """Builds a shard's automaton and streams the shard's word stretches through it."""

    def work(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("tk", "s", "e", "n", "words")), strict=True))
        stretches: list[tuple[bytes, int, list[int], dict[int, int]]] = []  # text, first word, words, places by start
        for tk, s, e, n, raw in rows:
            words = np.frombuffer(raw, np.uint32).tolist()
            if not stretches or stretches[-1][0] != tk or s > stretches[-1][1] + len(stretches[-1][2]):
                stretches.append((tk, s, [], {}))
            _, first, so_far, places = stretches[-1]
            so_far += words[first + len(so_far) - s :]
            places.update(dict.fromkeys(range(s, e + 1), n))
        automaton = SuffixAutomaton()
        for _, first, words, places in stretches:
            last = 0
            for i, symbol in enumerate(words):
                last = automaton.extend(last, symbol)
                automaton.weight[last] += places.get(first + i - window + 1, 0)
        automaton.settle()
        out = []
        for tk, first, words, places in stretches:
            if min(places.values()) > 1:
                continue
            found = np.fromiter(automaton.places(words, window), np.int64, len(words))[window - 1 :] > 1
            found &= np.fromiter((places.get(first + i) == 1 for i in range(len(found))), bool, len(found))
            out += [(tk, a, b) for a, b in _covered(found, first, window)]
        return pa.table({"tk": pa.array([x[0] for x in out], pa.binary()), "a": pa.array([x[1] for x in out], pa.int32()), "b": pa.array([x[2] for x in out], pa.int32())})

    return work


def _single_windows(window: int):
    """One row for each window of a hot anchor's runs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tk, s, e, n, raw in zip(*(batch.column(c).to_pylist() for c in ("tk", "s", "e", "n", "words")), strict=True):
                h, at = np.frombuffer(raw, np.uint32).astype(np.uint64), np.arange(e - s + 1)
                w1, w2 = _spans_hash(h, at, at + window), _spans_hash(mixed(h), at, at + window)
                yield pa.RecordBatch.from_pydict(
                    {"w1": pa.array(w1.view(np.int64)), "w2": pa.array(w2.view(np.int64)), "n": pa.array(np.full(len(at), n)), "tk": pa.array([tk] * len(at), pa.binary()), "a": pa.array((at + s).astype(np.int32))}
                )

    return work


def repeated_spans(docs: DataFrame, *, text: str = "text", min_words: int = 35, shard_words: int = 200_000, hot: int = 4000) -> DataFrame:
    """Word intervals [a, b) to remove, for each text that has any: (tk binary, spans array<struct<a,b>>); tk is text_key."""
    spark, width = docs.sparkSession, min_words - min(GRAM, min_words) + 1
    texts = docs.select(text_key(text).alias("tk"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    runs = written(texts.mapInArrow(_runs(min_words), _RUN), "runs")
    anchors = runs.groupBy("m").agg(F.count("*").alias("k"), F.max("inner").alias("inner")).filter("k > 1 or inner").select("m")
    kept = written(runs.join(anchors, "m", "left_semi"), "kept-runs")
    discard(runs)
    groups = written(kept.groupBy("m", "c").agg(F.count("*").alias("n"), F.min(F.struct("tk", "s", "e")).alias("rep"), F.max("inner").alias("inner")), "run-groups")
    several = groups.groupBy("m").agg(F.count("*").alias("kinds"), F.max("inner").alias("inner")).filter("kinds > 1 or inner").select("m", "kinds")
    wanted = written(groups.select("m", "n", "rep.*").join(several, "m"), "wanted-runs")
    total = wanted.agg(F.sum(F.col("e") - F.col("s") + min_words), F.max("kinds")).first()
    shards = max(1, -(-(total[0] or 0) // shard_words))
    whole = kept.join(groups.filter("n > 1").select("m", "c"), ["m", "c"], "left_semi").select("tk", F.col("s").alias("a"), (F.col("e") + min_words).alias("b"))
    asked = wanted.withColumn("shard", F.when(F.col("kinds") > hot, -1).otherwise(F.pmod("m", F.lit(shards)))).groupBy("tk").agg(F.collect_list(F.struct(F.col("shard").cast("int").alias("shard"), "s", "e", "n")).alias("wanted"))
    pieces = written(texts.dropDuplicates(["tk"]).join(asked, "tk").mapInArrow(_cut_out(min_words), "shard int, tk binary, s int, e int, n bigint, words binary"), "run-words")
    parts = whole.unionByName(pieces.filter("shard >= 0").groupBy("shard").applyInArrow(_shard(min_words), "tk binary, a int, b int"))
    if (total[1] or 0) > hot:
        single = pieces.filter("shard < 0").mapInArrow(_single_windows(min_words), "w1 bigint, w2 bigint, n bigint, tk binary, a int")
        often = single.groupBy("w1", "w2").agg(F.sum("n").alias("places")).filter("places > 1")
        parts = parts.unionByName(single.join(often, ["w1", "w2"], "left_semi").select("tk", "a", (F.col("a") + min_words).alias("b")))
    return parts.groupBy("tk").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def _remove(with_text: bool):
    return lambda batches: _removed(batches, with_text)


def _removed(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept, digest = [], [], [], []
        for text, spans in zip(binary_column(batch, "_text"), batch.column("_spans").to_pylist(), strict=True):
            words = words_of(text)
            n_words.append(len(words))
            if spans:
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, [x["a"] for x in spans], 1)
                np.add.at(edge, [x["b"] for x in spans], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
            n_removed.append(n_words[-1] - len(words))
            joined = b" ".join(words)
            kept.append(joined if with_text else None)
            digest.append(hashlib.sha256(joined).hexdigest())
        rest = [(batch.schema.field(i), batch.column(i)) for i in range(batch.num_columns) if batch.schema.field(i).name not in ("_text", "_spans")]
        made = {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(kept, pa.binary()).cast(pa.string()), "kept_sha256": pa.array(digest, pa.string())}
        yield pa.RecordBatch.from_arrays([*(c for _, c in rest), *made.values()], names=[*(f.name for f, _ in rest), *made])


def remove_repeated_spans(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, with_text: bool = True, **how) -> DataFrame:
    """The rows of docs (columns `keep`, by default all) with n_words, n_removed, kept_text (kept words joined by one space) and kept_sha256.

    An input column with one of these names is replaced. Without with_text, kept_text is null and only the digest is made.
    """
    made = ["n_words", "n_removed", "kept_text", "kept_sha256"]
    names = attach(docs.columns if keep is None else keep, made)
    spans = repeated_spans(docs, text=text, **how)
    rows = docs.select(*names, F.col(text).alias("_text"), text_key(text).alias("_tk")).join(spans.select(F.col("tk").alias("_tk"), F.col("spans").alias("_spans")), "_tk", "left").drop("_tk")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema] + ["n_words bigint", "n_removed bigint", "kept_text string", "kept_sha256 string"])
    return rows.mapInArrow(_remove(with_text), schema)
