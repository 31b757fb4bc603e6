"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over the whole corpus give the idf.
2. Passages of 64 words are rows of a TF-IDF matrix A. One pass sums A'A.Omega for a fixed random Omega:
   each task multiplies its passages, Spark adds the products. From these the Nystrom form of a
   randomised SVD gives the leading right singular vectors and values; the latent space is whitened by the values.
3. Each benchmark item is folded into the space. Windows of twice the power of two nearest to the item's length (`size`), a
   quarter of `size` apart, slide over every document, so each stretch of 1.75 `size` words, over 1.2 times the item, lies whole in one.
   A window that shares m of the item's n words holds k of any n - m + k of them, so one that `strong` accepts
   holds k of the item's n - m + k rarest words (hashed ids); one that `weak` accepts does so with a smaller m, and holds the answer's
   rarest word. Either test makes candidates, each in its cheapest form by the corpus' word counts. No window that the rules accept is
   lost by this; it costs a lookup a word, and work for the few words that are rare in some item.
4. A candidate is checked on ids, then on words: longest common subsequence of item and window, over the item's length, and
   whether the item's answer (its last sentence, or last quarter where it is one sentence) stands there in order. A document leaks an
   item if the ratio is at least `strong`, or at least `weak` with the answer there.
5. Retrieval in the latent space makes candidates of its own beside these: stretches of `size` words, half a `size` apart, whose cosine with an item of
   that size is at least `near`. Such a window leaks the item from the ratio `faint` on, with the answer there: a passage in another order shares
   its words but no long subsequence. The cosine doesn't prune the others: at their edges it is lost in the noise of the space. It ranks windows of
   equal ratio and is reported, as the greatest of the window's stretches.

Words are lower-cased, stripped of punctuation at their ends. Null and empty texts leak nothing; items without
a word are left out; items repeated by id and text count once. Items shorter than `least_words` words must occur whole, word after word.
Windows belong to one document, so results don't depend on how documents are dealt. Empty tables give empty results. Benchmarks
larger than `block` items or BLOCK_CHARACTERS characters are searched block by block, each over the whole corpus.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "¿¡«»“”„’…"
#: Hashed ids of words, and those that the latent space tells apart (a divisor); its rank; words of a passage; passages of a matrix block.
DIMENSIONS, LATENT, RANK, PASSAGE, BLOCK_ROWS = 1 << 16, 2048, 64, 64, 256
#: Characters of items that are sent to every task at once at most, but for a single longer item.
BLOCK_CHARACTERS = 8_000_000


class WordIds(dict):
    """Hashed ids of words as they stand: case and punctuation at the ends don't count; -1 for nothing left."""

    limit = 500_000

    def __init__(self, dimensions: int) -> None:
        self.dimensions = dimensions

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        bare = plain(word)
        self[word] = value = zlib.crc32(bare.encode("utf-8", "surrogatepass")) % self.dimensions if bare else -1
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def plain(word: str) -> str:
    return word.lower().strip(STRIP)


def plain_words(text: str | None) -> list[str]:
    return [p for p in map(plain, text.split()) if p] if text else []


def _tokenise(dimensions: int, keep: int):
    """Adds the hashed ids of a text's words, two bytes each; words without a letter or digit left have none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds(dimensions)
        for batch in batches:
            raw = []
            for text in batch.column(keep).to_pylist():
                found = ids.of(text.split()) if text else np.zeros(0, np.int64)
                raw.append(found[found >= 0].astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[*batch.schema.names, "_ids"])

    return work


def tokenised(docs: DataFrame, columns: list[str], *, text: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    """The columns, _text and _ids of docs as a written table: every later pass reads ids instead of splitting texts again."""
    rows = docs.select(*columns, F.col(text).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", _ids binary"
    return written(rows.mapInArrow(_tokenise(dimensions, len(columns)), schema), "tokenised")


def _ids(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for raw in batch.column(batch.schema.get_field_index("_ids")).to_pylist():
        yield np.frombuffer(raw, "<u2").astype(np.int64)


def _frequencies(latent: int, dimensions: int):
    """Documents by latent id; under -1 their number; and under latent + id how often each id occurs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        within, times, n = np.zeros(latent, np.int64), np.zeros(dimensions, np.int64), 0
        for batch in batches:
            for found in _ids(batch):
                seen = np.zeros(latent, bool)
                seen[found % latent] = True
                within += seen
                n += 1
                if len(found) > 5_000:
                    times += np.bincount(found, minlength=dimensions)
                else:
                    np.add.at(times, found, 1)
        at = np.flatnonzero(times)
        yield pa.RecordBatch.from_pydict({"word": pa.array(np.r_[np.arange(latent), -1, at + latent].astype(np.int32)), "n": pa.array(np.r_[within, n, times[at]])})

    return work


def _sketch(idf: np.ndarray, omega: np.ndarray):
    """Rows of A'A.Omega, summed over the task's passages."""
    d = len(idf)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(omega.shape)
        waiting: list[np.ndarray] = []

        def add() -> None:
            n = np.array([len(x) for x in waiting])
            words = np.concatenate(waiting) % d
            cell = np.repeat(np.arange(len(waiting)), n) * d + words
            a = np.bincount(cell, weights=idf[words], minlength=len(waiting) * d).astype(np.float32).reshape(len(waiting), d)
            a /= np.maximum(np.sqrt(np.einsum("ij,ij->i", a, a)), 1e-9)[:, None]
            total[:] += a.T @ (a @ omega)
            waiting.clear()

        for batch in batches:
            for found in _ids(batch):
                for at in range(0, len(found), PASSAGE):
                    waiting.append(found[at : at + PASSAGE])
                    if len(waiting) == BLOCK_ROWS:
                        add()
        if waiting:
            add()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["word", "row"])

    return work


@dataclass
class LatentSpace:
    """The vector of each latent id: idf times its row of the whitened right singular vectors; and each word id's share of all words."""

    words: np.ndarray
    share: np.ndarray | None = None

    def of(self, ids: np.ndarray) -> np.ndarray:
        return self.words[ids % len(self.words)]


def latent_space(table: DataFrame, *, dimensions: int = DIMENSIONS, latent: int = LATENT, rank: int = RANK, seed: int = 7) -> LatentSpace:
    """Fitted on every passage of a tokenised table; word counts and sums of latent x rank numbers are all that reaches the driver."""
    texts = table.select("_ids")
    rows = texts.mapInArrow(_frequencies(latent, dimensions), "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(latent + dimensions + 1)
    counts[rows["word"].to_numpy()] = rows["n"].to_numpy()  # the last cell, -1, is the number of documents
    idf = np.log((1 + counts[-1]) / (1 + counts[:latent])) + 0.1
    times = counts[latent:-1]
    omega = np.random.default_rng(seed).standard_normal((latent, rank + 8)).astype(np.float32)
    sums = texts.mapInArrow(_sketch(idf, omega), "word int, row array<double>")
    cells = [F.sum(F.col("row")[j]).alias(f"c{j}") for j in range(rank + 8)]
    y = np.zeros((latent, rank + 8))
    for r in sums.groupBy("word").agg(*cells).collect():
        y[r.word] = r[1:]
    # Nystrom: G = A'A is about Y (Omega'Y)^-1 Y'; with Omega'Y + shift = C C', the SVD of Y C^-T has the eigenvectors of G
    core = omega.astype(np.float64).T @ y
    core = (core + core.T) / 2
    shift = 1e-8 * max(np.trace(core), 1e-12)
    lower = np.linalg.cholesky(core + (shift + max(0.0, -2 * np.linalg.eigvalsh(core)[0])) * np.eye(len(core)))
    left, sizes, _ = np.linalg.svd(np.linalg.solve(lower, y.T).T, full_matrices=False)
    left, sizes = left[:, :rank], sizes[:rank]
    return LatentSpace((idf[:, None] * left / np.maximum(sizes, 1e-6 * max(sizes[0], 1e-12))).astype(np.float32), times / max(1.0, times.sum()))


@dataclass
class Item:
    item_id: int | None
    words: list[str]
    answer: list[str]


def items_of(rows: list) -> list[Item]:
    out = []
    for item_id, text in rows:
        if words := plain_words(text):
            sentences = [s for s in (plain_words(x) for x in re.split(r"(?<=[.?!])\s+", text)) if s]
            out.append(Item(item_id, words, sentences[-1] if len(sentences) > 1 else words[-max(1, len(words) // 4) :]))
    return out


def _places(a: list) -> dict:
    """The places of each element, as bits."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    return where


def _common(where: dict, n: int, b: list) -> int:
    row = full = (1 << n) - 1
    for y in b:
        if hit := row & where.get(y, 0):
            row = (row + hit | row - hit) & full
    return n - row.bit_count()


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, with the rows of the table as bits of one integer."""
    return _common(_places(a), len(a), b)


@dataclass
class Rules:
    strong: float = 0.7
    weak: float = 0.5
    least_words: int = 8
    near: float = 0.8
    faint: float = 0.3


class _Search:
    """Searches documents for a block of items. Window sizes are powers of two, each item has the nearest."""

    slab_words, clustered, check_cost, tile_words = 1 << 17, 2, 40, 1 << 14

    def __init__(self, space: LatentSpace, items: list[Item], rules: Rules) -> None:
        self.items, self.rules, self.space = items, rules, space
        ids = WordIds(DIMENSIONS)
        own = [ids.of(i.words) for i in items]
        self.own = [(_places(x.tolist()), len(x)) for x in own]
        self.answers = [(_places(ids.of(i.answer).tolist()), len(i.answer)) for i in items]
        self.vectors = [space.of(x).sum(axis=0) for x in own]
        self.size = np.array([max(4, 2 ** round(np.log2(len(x)))) for x in own], np.int64)
        self.longest = int(self.size.max(initial=4))
        long = np.array([len(x) >= rules.least_words for x in own], bool)
        self.by_size = {}
        for s in np.unique(self.size[long]).tolist():
            at = np.flatnonzero(long & (self.size == s))
            v = np.stack([self.vectors[j] for j in at]).astype(np.float32)
            self.by_size[s] = at, (v / np.maximum(np.linalg.norm(v, axis=1), 1e-12)[:, None]).T
        self.padded = np.vstack([space.words, np.zeros((1, space.words.shape[1]), np.float32)])
        share = space.share if space.share is not None else np.full(DIMENSIONS, 1 / DIMENSIONS)
        marks, self.item, self.hits = [], [], []  # a mark: an item, ids, and how many of them a candidate holds
        self.least, self.answer_ids = [], []
        for j, x in enumerate(own):
            n, short = len(x), len(x) < rules.least_words
            of = lambda ratio, n=n, short=short: n if short else max(1, math.ceil(ratio * n - 1e-9))
            rarest = x[np.lexsort((x, share[x]))]
            answer = np.unique(ids.of(items[j].answer))
            self.least.append(of(min(rules.weak, rules.strong)))
            self.answer_ids.append(frozenset(answer.tolist()))
            made = [self._mark(rarest, share, of(rules.strong), int(self.size[j]))]
            if rules.weak < rules.strong and not short:
                anchor = answer[np.argmin(share[answer])][None]
                made.append(min(self._mark(rarest, share, of(rules.weak), int(self.size[j])), self._mark(anchor, share, 1, int(self.size[j])), key=lambda m: m[0]))
            for _, k, rare in made:
                marks.append(np.stack([rare, np.full(len(rare), len(self.hits))]))
                self.hits.append(k)
                self.item.append(j)
        self.item, self.hits = np.array(self.item, np.int64), np.array(self.hits, np.int64)
        rare, mark = np.concatenate(marks, axis=1) if marks else np.zeros((2, 0), np.int64)
        order = np.argsort(rare, kind="stable")
        self.mark_of = mark[order]
        self.first = np.searchsorted(rare[order], np.arange(DIMENSIONS + 1))
        self.many = np.diff(self.first)

    def _mark(self, rarest: np.ndarray, share: np.ndarray, m: int, size: int) -> tuple[float, int, np.ndarray]:
        """(cost a word, k, ids): k of the n - m + k rarest words, with the k that costs least: each hit is sorted, each window that k words hit by
        chance is checked. Words come in clusters (one language or subject), hence the factor."""
        n, best = len(rarest), None
        for k in range(1, m + 1):
            rare = np.unique(rarest[: n - m + k])
            hits = float(share[rare].sum())
            mean = 2 * size * hits * self.clustered + 1e-12
            chance = 1.0 if k <= mean else math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
            cost = hits + self.check_cost * (4 / size) * min(1.0, 2 * chance)
            if best is None or cost < best[0]:
                best = (cost, k, rare)
        return best

    def batch(self, ids: list[np.ndarray], texts) -> dict[int, list[tuple[int, float, float, bool, int, int]]]:
        """For each document with a leak: (item number, cosine, ratio, answer there, first word, end word) of each leaked item's best window.

        texts(i) gives the text of document i, read only where a candidate passes on ids.
        """
        out: dict[int, dict[int, tuple]] = {}
        waiting, size = [], 0
        step = max(self.slab_words, 4 * self.longest)
        for i, x in enumerate(ids):
            for at in range(0, len(x), step):  # a very long document goes in overlapping parts
                part = x[max(0, at - 2 * self.longest) : at + step]
                waiting.append((i, max(0, at - 2 * self.longest), part))
                size += len(part)
                if size >= step:
                    self._slab(waiting, ids, texts, out)
                    waiting, size = [], 0
        if waiting:
            self._slab(waiting, ids, texts, out)
        return {i: [(k, *v) for k, v in sorted(best.items())] for i, best in out.items()}

    def _slab(self, parts: list[tuple[int, int, np.ndarray]], ids: list[np.ndarray], texts, out: dict) -> None:
        held: dict[int, list[str]] = {}

        def read(i: int) -> list[str]:
            if i not in held:
                held[i] = plain_words(texts(i))
            return held[i]

        words = np.concatenate([x for _, _, x in parts])
        n = np.array([len(x) for _, _, x in parts])
        begin = np.cumsum(n) - n
        many = self.many[words]
        hit = np.flatnonzero(many)
        many = many[hit]
        mark = self.mark_of[np.repeat(self.first[words[hit]] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        order = np.argsort(mark, kind="stable")
        mark, place = mark[order], np.repeat(hit, many)[order]
        part, item = np.searchsorted(begin, place, "right") - 1, self.item[mark]
        chunk = (place - begin[part]) // (self.size[item] // 4)  # parts begin at multiples of every stride
        found = []
        for k in np.unique(self.hits[mark]):
            at = np.flatnonzero(self.hits[mark] == k)
            a, b = at[: max(0, len(at) - k + 1)], at[k - 1 :]
            near = (mark[a] == mark[b]) & (part[a] == part[b]) & (chunk[b] - chunk[a] < 8)
            a, b = a[near], b[near]
            low = np.maximum(chunk[b] - 7, 0)
            wide = chunk[a] - low + 1
            window = np.repeat(low - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())
            found.append(np.stack([np.repeat(part[a], wide), np.repeat(item[a], wide), window]))
        for p, k, start in self._retrieved(words, n, begin):
            i, offset, x = parts[p]
            size = int(self.size[k])
            start = max(0, start - size // 2)
            self._check(k, i, x[start : start + 2 * size], offset + start, size, lambda i=i: read(i), out, close=True)
        if not found:
            return
        p, k, window = np.concatenate(found, axis=1)
        for key in np.unique((p * len(self.items) + k) << 32 | window).tolist():  # a document is shorter than 2 ** 32 strides
            (p, k), window = divmod(key >> 32, len(self.items)), key & 0xFFFFFFFF
            i, offset, x = parts[p]
            size = int(self.size[k])
            start = window * (size // 4)
            self._check(k, i, x[start : start + 2 * size], offset + start, size, lambda i=i: read(i), out)

    def _retrieved(self, words: np.ndarray, n: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(part, item, first word) of each stretch that lies near an item in the latent space."""
        part = np.repeat(np.arange(len(n)), n)
        within = np.arange(len(words)) - begin[part]
        for size, (items, vectors) in self.by_size.items():
            half = size // 2
            chunks = -(-n // half)
            first = np.cumsum(chunks) - chunks
            cells = np.full(int(chunks.sum()) * half, len(self.padded) - 1)
            cells[first[part] * half + within] = words % (len(self.padded) - 1)
            tile = max(1, self.tile_words // half) * half
            sums = [self.padded[cells[at : at + tile]].reshape(-1, half, self.padded.shape[1]).sum(axis=1) for at in range(0, len(cells), tile)]
            if not sums:
                continue
            v = np.concatenate(sums)
            owner = np.repeat(np.arange(len(n)), chunks)
            v[:-1] += v[1:] * (owner[1:] == owner[:-1])[:, None]
            v /= np.maximum(np.linalg.norm(v, axis=1), 1e-12)[:, None]
            for at in range(0, len(v), self.tile_words):
                for c, k in np.argwhere(v[at : at + self.tile_words] @ vectors >= self.rules.near).tolist():
                    p = int(owner[at + c])
                    yield p, int(items[k]), (at + c - int(first[p])) * half

    def _check(self, k: int, i: int, ids: np.ndarray, start: int, size: int, text, out: dict, close: bool = False) -> None:
        rules, n, listed = self.rules, self.own[k][1], ids.tolist()
        weak = min(rules.faint, rules.weak) if close else rules.weak

        def leaked(ratio: float, answer) -> bool:
            return ratio >= rules.strong or ratio >= weak and answer()

        if n < rules.least_words:
            self._whole(k, i, ids, start, size, text, out)
            return
        # equal words have equal ids, so what fails on ids fails on words
        shared = sum(map(self.own[k][0].__contains__, listed))
        if shared < (min(weak, rules.strong) * n - 1e-9 if close else self.least[k]) or shared < rules.strong * n - 1e-9 and not self.answer_ids[k].issubset(listed):
            return
        if not leaked(_common(*self.own[k], listed) / n, lambda: _common(*self.answers[k], listed) == self.answers[k][1]):
            return
        item, words = self.items[k], text()[start : start + len(ids)]
        ratio = common_subsequence(item.words, words) / n
        answer = common_subsequence(item.answer, words) == len(item.answer)
        if not leaked(ratio, lambda: answer):
            return
        best = out.setdefault(i, {})
        cosine = self._cosine(k, ids, size)
        if k not in best or (ratio, cosine) > best[k][1::-1]:
            best[k] = (cosine, ratio, answer, start, start + len(ids))

    def _whole(self, k: int, i: int, ids: np.ndarray, start: int, size: int, text, out: dict) -> None:
        """A short item: its words stand in the window, one after another."""
        words = self.items[k].words
        there = text()[start : start + len(ids)]
        if i in out and k in out[i] or not any(there[j : j + len(words)] == words for j in range(len(there) - len(words) + 1)):
            return
        out.setdefault(i, {})[k] = (self._cosine(k, ids, size), 1.0, True, start, start + len(ids))

    def _cosine(self, k: int, ids: np.ndarray, size: int) -> float:
        """The greatest cosine of the item and a stretch of `size` words."""
        vectors = self.space.of(ids)
        total = np.zeros((len(ids) + 1, vectors.shape[1]))
        np.cumsum(vectors, axis=0, out=total[1:])
        at = np.arange(0, max(1, len(ids) - size + 1), size // 4)
        v = total[np.minimum(at + size, len(ids))] - total[at]
        norms = np.linalg.norm(v, axis=1) * np.linalg.norm(self.vectors[k])
        return float((v @ self.vectors[k] / np.maximum(norms, 1e-12)).max())


def _blocks(benchmark: DataFrame, block: int) -> Iterator[list[Item]]:
    """The items, a bounded number at a time."""
    rows = benchmark.select(F.col("item_id").cast("bigint"), "text").filter("text is not null").distinct().orderBy("item_id", "text")
    held, characters = [], 0
    for r in rows.toLocalIterator():
        held.append((r[0], r[1]))
        characters += len(r[1])
        if len(held) == block or characters >= BLOCK_CHARACTERS:
            yield items_of(held)
            held, characters = [], 0
    if held:
        yield items_of(held)


def leaks(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", id_column: str = "doc_id", rules: Rules | None = None, block: int = 20_000) -> DataFrame:
    """One row per document and leaked item: the id column, item_id, cosine, ratio, answer, first_word, end_word (of the words that are left after stripping)."""
    spark, rules = docs.sparkSession, rules or Rules()
    table = tokenised(docs, [id_column], text=text)
    space = latent_space(table)
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, item_id bigint, cosine double, ratio double, answer boolean, first_word bigint, end_word bigint"
    out = spark.createDataFrame([], schema)
    for items in _blocks(benchmark, block):
        shared = spark.sparkContext.broadcast((space, items))  # latent x rank numbers, word counts, and items of bounded number and size

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = _Search(*shared.value, rules)
            for batch in batches:
                hits = search.batch(list(_ids(batch)), lambda i, batch=batch: batch.column(1)[i].as_py())
                rows = [(i, search.items[x[0]].item_id, *x[1:]) for i, found in sorted(hits.items()) for x in found]
                if rows:
                    kinds = (pa.int64(), pa.float64(), pa.float64(), pa.bool_(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([r[0] for r in rows])), *(pa.array([r[j + 1] for r in rows], k) for j, k in enumerate(kinds))], names=[batch.schema.names[0], "item_id", "cosine", "ratio", "answer", "first_word", "end_word"])

        out = out.unionByName(table.mapInArrow(work, schema))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", rules: Rules | None = None, block: int = 20_000) -> DataFrame:
    """The rows of docs that leak no item, in their own columns; decided row by row, without a join on ids."""
    spark, rules, names, order = docs.sparkSession, rules or Rules(), [c for c in docs.columns if c != text], docs.columns
    table = tokenised(docs, names, text=text)
    space = latent_space(table)
    for items in _blocks(benchmark, block):
        shared = spark.sparkContext.broadcast((space, items))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = _Search(*shared.value, rules)
            for batch in batches:
                hits = search.batch(list(_ids(batch)), lambda i, batch=batch: batch.column(len(names))[i].as_py())
                yield batch.filter(pa.array([i not in hits for i in range(batch.num_rows)], pa.bool_()))

        table = table.mapInArrow(work, table.schema)
    return table.select(*(F.col("_text").alias(text) if c == text else F.col(c) for c in order))
