"""Language identification with error-correcting output codes.

Every language gets a codeword; one binary classifier per bit, over hashed byte n-grams, tells the
languages whose bit is 1 from those whose bit is 0. The classifiers are log-odds of n-gram counts
that one Spark aggregation gathers from all labelled documents; their tables have a fixed size.
A text's margins are decoded with a logistic loss, each bit weighted by how well it separates the
labelled n-gram mass: the codeword with the least loss wins. A text is flagged ambiguous where its two best codewords are nearly as near,
or where its n-grams are by `strange` nats rarer on average, over all learned languages, than those of the rarest-spoken language itself:
text of no learned language. Neither rule knows the text's length.

Null texts and texts without a letter get `und`, score 0. Rows with a null label teach nothing.
With no labelled row everything is `und`; with one label, every text with a letter gets it. Columns
other than the text and, for learning, the label are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, binary_column, discard, written

DIMENSIONS = 1 << 14
STRANGE = 2.25
LETTER = regex.compile(r"\p{L}")
#: Bytes of an n-gram that are taken at most at once, so that a very long text needs bounded memory.
STEP = 1 << 20


def ngram_counts(text: bytes, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Counts of hashed byte bigrams, trigrams and 4-grams of the whole lower-cased text."""
    total = np.zeros(dimensions)
    shift = np.uint32(32 - int(dimensions).bit_length() + 1)
    whole = b" " + text.lower() + b" "
    for at in range(0, len(whole), STEP):
        b = np.frombuffer(whole[at : at + STEP + 3], np.uint8).astype(np.uint32)
        if len(b) < 2:
            continue
        two = b[:-1] | b[1:] << np.uint32(8)
        three = two[:-1] | b[2:] << np.uint32(16)
        four = three[:-1] | b[3:] << np.uint32(24)
        for salt, gram in ((0x9E3779B1, two), (0x85EBCA77, three), (0xC2B2AE3D, four)):
            total += np.bincount((gram[:STEP] * np.uint32(salt)) >> shift, minlength=dimensions)  # those that begin in this part
    return total


def codewords(languages: int, bits: int = 15, apart: int = 3, candidates: int = 512) -> np.ndarray:
    """A +-1 codeword for each language, no two equal, and from five languages on at least `apart` bits between any two.

    Up to 10 languages a bit may be any way to part them, beyond that one of `candidates` random even partings. Bits are added one by one, each time the one that parts
    the pairs that are nearest so far, until there are `bits` (more for many languages) and the distance is reached.
    """
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= 10:  # the last language's bit is 1, else a column would come back with its signs changed
        pool = np.array([[-1 if i >> j & 1 else 1 for j in range(languages)] for i in range(1, 2 ** (languages - 1))]).T
    else:
        rng = np.random.default_rng(languages)
        pool = np.array([rng.permutation(np.where(np.arange(languages) % 2, 1, -1)) for _ in range(candidates)]).T
    pool = pool[:, np.argsort(np.abs(pool.sum(axis=0)), kind="stable")]
    wanted, apart = max(bits, 2 * (languages - 1).bit_length()), apart if languages > 4 else 1
    distance, chosen = np.zeros((languages, languages)), []
    np.fill_diagonal(distance, np.inf)
    while len(chosen) < pool.shape[1] and (len(chosen) < wanted or distance.min() < apart):
        near = 0.25 ** (distance - distance.min())
        parts = -np.einsum("ik,ij,jk->k", pool, near, pool, optimize=True)
        parts[chosen] = -np.inf
        chosen.append(int(np.argmax(np.round(parts, 9))))
        distance += pool[:, chosen[-1], None] != pool[None, :, chosen[-1]]
    if distance.min() < apart:
        raise ValueError(f"{languages} languages can't be told apart by {pool.shape[1]} bits")
    return pool[:, chosen]


@dataclass
class LanguageModel:
    """languages, their codewords, for each bit the n-gram weights and trust; the log share of each n-gram, and its mean over n-grams of a language."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    trust: np.ndarray
    common: np.ndarray
    typical: float
    dimensions: int
    gap: float
    strange: float

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether two codewords are about as near."""
        if not text or not self.languages or not LETTER.search(text.decode("utf-8", "replace")):
            return "und", 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        counts = ngram_counts(text, self.dimensions)
        n = float(counts.sum()) or 1.0
        margin = np.clip(counts @ self.weights / np.sqrt(n), -30, 30)  # grows with the evidence, not as fast as the length
        loss = (np.logaddexp(0, -self.codes * margin) * self.trust).sum(axis=1)
        near = np.exp(-(loss - loss.min()))
        best = int(np.argmin(loss))
        score = float(near[best] / near.sum())
        second = float(np.sort(near)[-2] / near.sum())
        surprise = self.typical - float(counts @ self.common) / n
        return self.languages[best], min(1.0, max(0.0, score)), score - second < self.gap or surprise > self.strange


def _gather(dimensions: int):
    """The task's n-gram counts by language."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), binary_column(batch, "text"), strict=True):
                if lang not in total:
                    total[lang] = np.zeros(dimensions, np.float64)
                # a very long text counts as one document's worth of evidence beside others: relative frequencies, by the square root of its length
                counts = ngram_counts(text or b"", dimensions)
                total[lang] += counts / max(1.0, np.sqrt(float(counts.sum())))
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "gram": pa.array(at.astype(np.int32)), "n": pa.array(counts[at])})

    return work


def fit(labelled: DataFrame, *, text: str = "text", label: str = "lang", dimensions: int = DIMENSIONS, bits: int = 15, gap: float = 0.02, strange: float = STRANGE, most_languages: int = 500) -> LanguageModel:
    """Learn from all rows with a text and a label. Only dimensions x languages sums reach the driver; more than `most_languages` labels are an error."""
    rows = labelled.select(F.col(label).cast("string").alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    sums = written(rows.mapInArrow(_gather(dimensions), "lang string, gram int, n double").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-sums")
    found = sums.groupBy("lang").agg(F.count("*").alias("k")).orderBy("lang").limit(most_languages + 1).collect()
    if len(found) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    languages = [r.lang for r in found]
    if not languages:
        return LanguageModel([], np.zeros((0, 1)), np.zeros((dimensions, 1)), np.ones(1), np.zeros(dimensions), 0.0, dimensions, gap, strange)
    counts = np.zeros((len(languages), dimensions))
    for row in sums.groupBy("lang").agg(F.collect_list(F.struct("gram", "n")).alias("grams")).toLocalIterator():
        grams = np.array([(g.gram, g.n) for g in row.grams])
        counts[languages.index(row.lang), grams[:, 0].astype(int)] = grams[:, 1]
    share = (counts + 0.01) / (counts + 0.01).sum(axis=1, keepdims=True)
    codes = codewords(len(languages), bits)
    discard(sums)
    weights, trust = np.zeros((dimensions, codes.shape[1])), np.zeros(codes.shape[1])
    for bit in range(codes.shape[1]):
        ones, zeros = share[codes[:, bit] > 0], share[codes[:, bit] < 0]
        if not len(ones) or not len(zeros):
            continue
        weights[:, bit] = np.log(ones.mean(axis=0)) - np.log(zeros.mean(axis=0))
        drift = (share @ weights[:, bit]) * codes[:, bit]
        trust[bit] = max(0.05, np.tanh(drift.min()))  # the language that this bit tells least well
    common = np.log(share.mean(axis=0))
    return LanguageModel(languages, codes, weights, trust / max(trust.sum(), 1e-9) * len(trust), common, float((share @ common).min()), dimensions, gap, strange)


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text", keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """Rows of docs (columns `keep`, by default all) with lang_pred, score and ambiguous, their names behind the prefix; inputs of these names are replaced."""
    made = [prefix + n for n in ("lang_pred", "score", "ambiguous")]
    names = attach(docs.columns if keep is None else keep, made)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: dimensions x bits
    rows = docs.select(*names) if text in names else docs.select(*names, F.col(text).alias("_text"))
    source = text if text in names else "_text"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [shared.value.predict(t) for t in binary_column(batch, source)]
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x[0] for x in told], pa.string()), pa.array([x[1] for x in told], pa.float64()), pa.array([x[2] for x in told], pa.bool_())], names=[*names, *made])

    kinds = ("string", "double", "boolean")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema] + [f"`{n}` {k}" for n, k in zip(made, kinds, strict=True)])
    return rows.mapInArrow(work, schema)
