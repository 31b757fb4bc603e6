"""Embedding whitening: leading principal components by Chebyshev-filtered subspace iteration.

A component c of a vector becomes the integer x = floor(scale * c); a constant added to x would cancel in all that follows.
The fit list holds each distinct x vector once: n vectors with sums S by dimension. It is written as blocks of
vectors, and all work on it is passes of one kind: every task adds up its blocks' part of a small matrix, Spark adds the
tasks' parts cell by cell, and the driver gets one matrix of (vector length) x (block width). A vector is centred exactly, as the integers n x - S over n,
before it is multiplied.

A block Q of directions, wider than asked, starts at random. Each round applies a Chebyshev polynomial of the
covariance V to Q: the recurrence needs one pass XᵀXQ a degree, is small on [low, cut], where low bounds the spectrum
from below (a short Lanczos run) and cut is the block's smallest Ritz value, and grows fast beyond. QR and a Rayleigh-Ritz step follow, and the step's own pass is the next
round's first. Rounds end when the residuals |Vq - eq| of all asked directions are certified: at most `tight` of the
largest eigenvalue, or as small as rounding lets them get and at most `loose` of it; else an error is raised. A block as wide as V has the answer after one step.

Rows whose vector is null, empty, of another length than most (ties: the shorter), or holds a null or non-finite entry or
one whose x doesn't fit a long take no part. Equal vectors count once in the fit and come out once a row; ids may be null or repeat. Directions without
variance (eigenvalue at most 1e-12 of the largest) have no whitened value and are left out, so one distinct vector,
or an empty table, gives no row. A deviation beyond a long is null. Eigenvalues that tie have any orthonormal basis of their space.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

BLOCK_ROWS = 4096
LONG = 1 << 63


def integer_vectors(vectors: DataFrame, id_column: str, column: str, scale: int) -> tuple[DataFrame, int]:
    """(id, x): usable vectors as integers, and their length (0: none is usable)."""
    scaled = F.transform(F.col(column).cast("array<double>"), lambda c: c * float(scale))
    rows = vectors.select(F.col(id_column).alias("id"), scaled.alias("s")).filter("s is not null and size(s) > 0")
    rows = rows.filter(~F.coalesce(F.exists("s", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= 2.0**62)), F.lit(True)))
    size = rows.groupBy(F.size("s").alias("d")).count().orderBy(F.desc("count"), "d").first()
    width = size.d if size else 0
    return rows.filter(F.size("s") == width).select("id", F.transform("s", lambda c: F.floor(c)).alias("x")), width


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Fit:
    """The fit list as blocks, with what centres a vector exactly."""

    def __init__(self, x: DataFrame, width: int):
        self.width = width
        self.blocks = written(x.select("x").distinct().mapInArrow(_blocks(width), "n int, largest bigint, sums array<decimal(38,0)>, block binary"), "fit-blocks")
        told = self.blocks.agg(F.sum("n").alias("n"), F.max("largest").alias("largest")).first()
        sums = self.blocks.select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").cast("string").alias("s")).collect()
        self.n = int(told.n or 0)
        self.sums = [int(s) for _, s in sorted((r.pos, r.s) for r in sums)]
        self.reach = 2 * self.n * int(told.largest or 0)  # no |n x - S| is larger

    def centring(self) -> Callable[[np.ndarray], np.ndarray]:
        """From x to the exact n x - S: in longs where they can't overflow, else in Python's integers."""
        n, kind = self.n, np.int64 if self.reach < LONG // 2 else object
        sums = np.array(self.sums, dtype=kind)
        return lambda x: x.astype(kind) * n - sums

    def summed(self, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """One pass: the sum over blocks of part(centred block), a matrix whose shape doesn't depend on the block."""
        width, n, centring = self.width, self.n, self.centring()

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for block in batch.column("block"):
                    x = np.frombuffer(block.as_buffer(), np.int64).reshape(-1, width)
                    more = part(centring(x).astype(np.float64) / n)
                    total = more if total is None else total + more
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "y"])

        got = self.blocks.select("block").mapInArrow(work, "cell bigint, y double").groupBy("cell").agg(F.sum("y").alias("y")).toArrow()
        cells = np.zeros(part(np.zeros((1, width))).shape)
        cells.ravel()[got.column("cell").to_numpy()] = got.column("y").to_numpy()
        return cells


def _blocks(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(x: np.ndarray) -> pa.RecordBatch:
            largest = max(abs(int(x.max())), abs(int(x.min())))
            sums = x.sum(axis=0, dtype=np.int64 if largest * len(x) < LONG else object)
            kind = pa.list_(pa.decimal128(38, 0))
            return pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), pa.array([min(largest, LONG - 1)], pa.int64()), pa.array([[int(s) for s in sums]], kind), pa.array([x.tobytes()], pa.binary())], names=["n", "largest", "sums", "block"])

        held: list[np.ndarray] = []
        for batch in batches:
            held.append(_matrix(batch.column("x"), width))
            if sum(map(len, held)) >= BLOCK_ROWS:
                yield packed(np.concatenate(held))
                held.clear()
        if held and (x := np.concatenate(held)).size:
            yield packed(x)

    return work


def least_eigenvalue(apply: Callable[[np.ndarray], np.ndarray], d: int, steps: int, seed: int) -> float:
    """A lower bound for V's spectrum: the least Ritz value of a Lanczos run less its residual, and 0 at least.

    A bound that is a little too high makes the filter weaker, never the result wrong: the residuals are certified in any case."""
    basis = [np.random.default_rng(seed).standard_normal(d)]
    basis[0] /= np.linalg.norm(basis[0])
    alpha, beta = [], []
    for _ in range(min(steps, d)):
        v = np.array(basis)
        w = apply(basis[-1][:, None])[:, 0]
        alpha.append(float(w @ basis[-1]))
        for _ in range(2):
            w = w - v.T @ (v @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(map(abs, alpha)):
            break
        basis.append(w / beta[-1])
    inner = beta[: len(alpha) - 1]
    return max(0.0, float(np.linalg.eigvalsh(np.diag(alpha) + np.diag(inner, 1) + np.diag(inner, -1))[0]) - beta[-1])


def filtered(apply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, first: np.ndarray, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V that stays in [-1, 1] on [low, cut], times q, scaled to 1 at top; first is V q.

    The degree is lowered where top would outgrow the rest by over 12 digits."""
    centre, half = (low + cut) / 2, (cut - low) / 2
    degree = max(2, min(degree, int(np.log(2e12) / np.arccosh(max((top - centre) / half, 1.001)))))
    sigma = sigma1 = half / (top - centre)
    before, now = q, (first - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        nxt = 1 / (2 / sigma1 - sigma)
        before, now = now, (apply(now) - centre * now) * (2 * nxt / half) - sigma * nxt * before
        sigma = nxt
    return now


def leading_components(fit: Fit, wanted: int, *, guard: int = 24, degree: int = 10, bound_steps: int = 10, rounds: int = 200, tight: float = 1e-14, loose: float = 1e-11, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of the fit list's covariance, up to `wanted`, those without variance left out."""
    d = fit.width
    width = min(d, wanted + guard)

    def apply(q: np.ndarray) -> np.ndarray:
        return fit.summed(lambda c: c.T @ (c @ q)) / fit.n

    low = least_eigenvalue(apply, d, bound_steps, seed) if width < d else 0.0
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    worst = np.inf
    for _ in range(rounds):
        vq = apply(q)
        h = q.T @ vq
        e, u = np.linalg.eigh((h + h.T) / 2)
        e, u = e[::-1], u[:, ::-1]
        q, vq = q @ u, vq @ u
        if e[0] <= 0:
            return np.zeros(0), np.zeros((d, 0))
        kept = int((e[:wanted] > 1e-12 * e[0]).sum())
        residual = np.linalg.norm(vq[:, :kept] - q[:, :kept] * e[:kept], axis=0).max() / e[0]
        if width == d or residual <= tight or residual <= loose and residual > worst / 4:
            sign = np.sign(q[np.abs(q).argmax(axis=0), np.arange(width)])
            return e[:kept], (q * sign)[:, :kept]
        worst = min(worst, residual)
        cut = max(e[-1], 1e-12 * e[0])
        q = np.linalg.qr(filtered(apply, q, vq, min(low, cut * (1 - 1e-6)), cut, e[0], degree))[0]
    raise RuntimeError(f"the components aren't certified after {rounds} rounds: residual {residual:.3g} of the largest eigenvalue")


def whiten(vectors: DataFrame, *, id_column: str = "vec_id", column: str = "embedding", components: int = 16, scale: int = 64) -> DataFrame:
    """A row for each usable vector and component: the id (named id_column), component (from 1), n, deviation (exact sum of (n x - S)^2),
    whitened ((x - S/n) on the component over sqrt(e)), explained (e over the trace) and identity_error (of whitened's covariance over the fit list)."""
    spark = vectors.sparkSession
    x, width = integer_vectors(vectors, id_column, column, scale)
    kind = x.schema["id"].dataType.simpleString()
    empty = spark.createDataFrame([], f"`{id_column}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    if not width:
        return empty
    fit = Fit(x, width)
    e, q = leading_components(fit, components)
    if not len(e):
        discard(fit.blocks)
        return empty
    onto = q / np.sqrt(e)

    def checked(c: np.ndarray) -> np.ndarray:
        """The components' moments, and the trace's part in a row of its own."""
        w = c @ onto
        return np.vstack([w.T @ w, np.full(len(e), (c * c).sum())])

    told = fit.summed(checked) / fit.n
    error = float(np.abs(told[:-1] - np.eye(len(e))).max())
    explained = (e / told[-1][0]).tolist()
    n, centring, wide = fit.n, fit.centring(), width * fit.reach**2 >= LONG
    discard(fit.blocks)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = centring(_matrix(batch.column("x"), width))
            deviation = (c.astype(object) ** 2).sum(axis=1) if wide else (c * c).sum(axis=1)
            w = (c.astype(np.float64) / n) @ onto
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([int(v) if v < LONG else None for v in deviation], pa.int64()), pa.array(list(w), pa.list_(pa.float64()))], names=["id", "deviation", "w"])

    rows = x.mapInArrow(projected, f"id {kind}, deviation bigint, w array<double>").select("id", "deviation", F.posexplode("w").alias("i", "whitened"))
    share = F.array(*(F.lit(v) for v in explained))
    return rows.select(
        F.col("id").alias(id_column),
        (F.col("i") + 1).cast("int").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        share[F.col("i")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
