"""Approximate nearest neighbours: NN-descent builds the graph, greedy search answers queries.

Rows with equal vectors are one node; a node keeps its smallest ids, as many as an answer can need, so copies
neither crowd the graph nor lose the tie order. The graph starts from leaves of random partition trees:
in each leaf every vector meets every other. Then each round joins neighbours of neighbours: a node's
own and reverse neighbours meet at the node, and pairs nearer than a member's worst neighbour are
offered to that member. Rounds work on rows (node, member, vector) dealt by node; no graph reaches the driver.
Vectors travel centred, as 16-bit numbers with a scale; answers are scored in double precision on the original vectors.

A query starts from its own node's neighbours and expands the `hold` nearest nodes seen, until hardly anything nearer turns up. How wide that must be
depends on the rows: some sampled queries are answered by brute force as well, and while the search holds fewer than `least` of their true neighbours, it
goes on twice as wide, from further entry nodes too. The sample is a yardstick only, its answers come from the search like all others.
Rows whose vector is null, zero, of another length than most, or holds a null or non-finite component take no part. Rows that repeat an id keep the first
vector in order. With `k` candidates or fewer all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

LEAF, DEGREE = 2048, 48
#: Rows of a group that are compared with the whole group at once.
BLOCK = 512
#: Vectors of the sample that places centre, unit and tree cuts; queries of the yardstick.
PROBE, YARDSTICK = 4000, 48


@dataclass
class Frame:
    """Packed vectors are (v - centre) / unit. Inner products with a fixed row are, but for a term of that row alone, those of
    the centred rows plus the other row's with the centre: a far centre costs no digits, and no size of numbers overflows."""

    centre: np.ndarray
    unit: float

    def lift(self, x: np.ndarray) -> np.ndarray:
        """What each centred row adds to its inner product with any row."""
        return x @ (self.centre / self.unit).astype(np.float32)


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """(id, v): finite, non-zero vectors of the commonest length, one per id."""
    v = F.col("v")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(column).cast("array<double>").alias("v")).filter("id is not null and v is not null")
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.filter(F.coalesce(fine, F.lit(False)))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (size.n if size else 0)).groupBy("id").agg(F.min("v").alias("v"))


def _packed(frame: Frame):
    """Centred vectors as 16-bit numbers with a scale, so that a member of a join costs little."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = (np.array(batch.column("v").to_pylist()) - frame.centre) / frame.unit
            scale = np.maximum(np.abs(v).max(axis=1), 1e-30) / 32767
            q = np.rint(v / scale[:, None]).astype("<i2")
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(scale.astype(np.float32)), pa.array([x.tobytes() for x in q], pa.binary())], names=["node", "scale", "q"])

    return work


def _matrix(q: list[bytes], scale: list[float]) -> np.ndarray:
    return np.frombuffer(b"".join(q), "<i2").reshape(len(q), -1).astype(np.float32) * np.array(scale, np.float32)[:, None]


def _meet(keep: int, frame: Frame):
    """Rows of one group meet: each member is offered its `keep` nearest others that beat its worst neighbour."""

    def one(node: np.ndarray, worst: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        k, lift, parts = min(keep, len(node) - 1), frame.lift(x), []
        for i in range(0, len(node), BLOCK):
            s = x[i : i + BLOCK] @ x.T + lift[None, :]
            s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
            top = np.argpartition(-s, k - 1, axis=1)[:, :k] if k < len(node) - 1 else np.argsort(-s, axis=1)[:, :k]
            score = np.take_along_axis(s, top, axis=1)
            good = (score > worst[i : i + BLOCK, None]) & np.isfinite(score)
            parts.append((np.repeat(node[i : i + BLOCK], k)[good.ravel()], node[top][good], score[good]))
        a, b, s = (np.concatenate(c) for c in zip(*parts, strict=True))
        return a, b, s

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None

        def flush() -> pa.RecordBatch | None:
            if len(held) < 2:
                return None
            node = np.array([h[1] for h in held])
            _, first = np.unique(node, return_index=True)
            a, b, s = one(node[first], np.array([held[i][2] for i in first], np.float32), _matrix([held[i][4] for i in first], [held[i][3] for i in first])) if len(first) > 1 else ([], [], [])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float32())], names=["a", "b", "s"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("grp", "node", "worst", "scale", "q")), strict=True):
                if row[0] != now:
                    if (out := flush()) is not None:
                        yield out
                    held.clear()
                    now = row[0]
                held.append(row)
        if (out := flush()) is not None:
            yield out

    return work


def _met(rows: DataFrame, keep: int, frame: Frame) -> DataFrame:
    """Groups lie together in a partition, in order, so a task handles many groups in one pass."""
    return rows.repartition("grp").sortWithinPartitions("grp").mapInArrow(_meet(keep, frame), "a bigint, b bigint, s float")


def _best(offers: DataFrame, k: int) -> DataFrame:
    """The k nearest different neighbours of each node, with the worst score."""
    distinct = offers.groupBy("a", "b").agg(F.max("s").alias("s"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))
    return distinct.withColumn("r", rank).filter(F.col("r") <= k).select("a", "b", "s", "r")


def neighbour_graph(nodes: DataFrame, *, degree: int = DEGREE, trees: int = 8, leaf: int = LEAF, rounds: int = 8, sample: int = 24, settled: float = 0.04, seed: int = 11) -> tuple[DataFrame, DataFrame, Frame]:
    """NN-descent over nodes(node, v): the graph (a, b, s, r), the packed vectors (node, scale, q) and their frame.

    Each round draws anew who joins at a node: about `sample` of its own neighbours and at most `sample` reverse ones, as is usual for this method
    (hubs are reached through their own lists in any case). Rounds end early when fewer than `settled` of the entries change.
    The leaves are large and the lists long so that the graph stays near the true one on rows without clusters: how wide a search
    has to be depends on that. On check_l, 51,282 such rows, 0.44 of the 20 nearest were in a row's list with leaves of 256 and lists of 24.
    """
    probe = np.array([r.v for r in nodes.orderBy(F.xxhash64("node")).limit(PROBE).select("v").collect()])  # places centre and cuts, nothing else
    width, centre = probe.shape[1], (probe / len(probe)).sum(axis=0)
    frame = Frame(centre, float(np.abs(probe - centre).max()) or 1.0)
    packed = written(nodes.mapInArrow(_packed(frame), "node bigint, scale float, q binary"), "vectors")
    n = packed.count()
    bits = max(0, int(np.ceil(np.log2(max(1, n / (leaf / 2))))))
    planes = np.random.default_rng(seed).standard_normal((width, trees * max(1, bits))).astype(np.float32)
    cuts = np.median(((probe - frame.centre) / frame.unit).astype(np.float32) @ planes, axis=0)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            side = (_matrix(batch.column("q").to_pylist(), batch.column("scale").to_pylist()) @ planes > cuts).reshape(batch.num_rows, trees, -1)
            code = (side[:, :, : max(1, bits)] * (1 << np.arange(max(1, bits)))).sum(axis=2) if bits else np.zeros((batch.num_rows, trees), int)
            code = code + (np.arange(trees, dtype=np.int64) << 48)
            at = pa.array(np.repeat(np.arange(batch.num_rows), trees))
            yield pa.RecordBatch.from_arrays([pa.array(code.ravel()), *(batch.column(c).take(at) for c in ("node", "scale", "q"))], names=["grp", "node", "scale", "q"])

    leaves = written(packed.mapInArrow(place, "grp bigint, node bigint, scale float, q binary"), "leaves")
    full = leaves.groupBy("grp").count().filter(F.col("count") > 2 * leaf).withColumn("parts", F.ceil(F.col("count") / leaf))
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("node"), F.col("parts")))
    leaves_cut = leaves.join(full, "grp", "left").select(F.xxhash64("grp", part).alias("grp"), "node", F.lit(float("-inf")).cast("float").alias("worst"), "scale", "q")
    graph = written(_best(_met(leaves_cut, -(-degree // 2), frame), degree), "graph")
    discard(leaves)
    for turn in range(rounds):
        worst = graph.groupBy("a").agg(F.when(F.count("*") < degree, float("-inf")).otherwise(F.min("s")).cast("float").alias("worst"))
        turned = graph.select(F.col("b").alias("grp"), F.col("a").alias("node"), F.xxhash64("a", "b", F.lit(turn)).alias("h"))
        turned = turned.withColumn("k", F.row_number().over(Window.partitionBy("grp").orderBy("h"))).filter(F.col("k") <= sample)
        near = graph.filter(F.pmod(F.xxhash64("b", "a", F.lit(turn)), F.lit(degree)) < sample)
        pairs = near.select(F.col("a").alias("grp"), F.col("b").alias("node")).unionByName(turned.select("grp", "node")).unionByName(packed.select(F.col("node").alias("grp"), "node")).distinct()
        rows = pairs.join(packed.join(worst.withColumnRenamed("a", "node"), "node", "left").withColumn("worst", F.coalesce("worst", F.lit(float("-inf")).cast("float"))), "node").select("grp", "node", "worst", "scale", "q")
        offers = _met(rows, 8, frame)
        step = written(_best(graph.select("a", "b", "s").unionByName(offers), degree), "graph")
        moved = step.join(graph.select("a", "b"), ["a", "b"], "left_anti").count()
        discard(graph)
        graph = step
        if moved < settled * degree * n:
            break
    return graph, packed, frame


def _pieces(column: pa.ListArray) -> tuple[np.ndarray, pa.StructArray]:
    """Where each row's list begins and ends among all its batch's entries; null lists are empty."""
    return np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64), column.flatten()


def _lists(sizes: list[int], **columns: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.StructArray.from_arrays(list(columns.values()), list(columns)))


def _expand(frame: Frame):
    """A row with `edges` (node, scale, q) opens a group; its queries are offered those of the edges that beat their bar."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, edges, near = None, None, None  # near: the group's edges as numbers, once a query asks for them
        for batch in batches:
            if not batch.num_rows:
                continue
            grp, query, bar, q = (batch.column(c).to_pylist() for c in ("grp", "query", "bar", "q"))
            opens = batch.column("edges").is_valid().to_pylist()
            asks = np.array([x is not None for x in q])
            place = np.cumsum(asks) - 1
            y = _matrix([x for x in q if x is not None], batch.column("scale").drop_null().to_pylist()) if asks.any() else None
            begin = [i for i in range(len(grp)) if opens[i] or i == 0 or grp[i] != grp[i - 1]]
            who, sizes, nodes, scores = [], [], [], []
            for i, j in zip(begin, [*begin[1:], len(grp)], strict=True):
                if opens[i] or grp[i] != now:
                    now, edges, near = grp[i], batch.column("edges")[i].values if opens[i] else None, None
                first = i if asks[i] else i + 1
                if first == j or edges is None or not len(edges):
                    continue
                if near is None:
                    x = _matrix(edges.field("q").to_pylist(), edges.field("scale").to_pylist())
                    near = edges.field("node").to_numpy(), x, frame.lift(x)
                s = y[place[first] : place[first] + j - first] @ near[1].T + near[2][None, :]
                asking = np.array(query[first:j])
                row, at = np.nonzero((s > np.array(bar[first:j], np.float32)[:, None]) & (near[0][None, :] != asking[:, None]))
                count = np.bincount(row, minlength=j - first)
                who.append(asking[count > 0])
                sizes.append(count[count > 0])
                nodes.append(near[0][at])
                scores.append(s[row, at])
            if who and sum(map(len, who)):
                offers = _lists(np.concatenate(sizes), node=pa.array(np.concatenate(nodes)), s=pa.array(np.concatenate(scores), pa.float32()))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(who)), offers], names=["query", "offers"])

    return work


def _merge(hold: int, hop: bool, most: int = 64):
    """A query's state row, then its offers: the 2 * hold nearest of both. After a hop, what it expanded is done."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now: tuple | None = None
        parts: list[tuple] = []

        def close() -> None:
            node, s, done = (np.concatenate(c) for c in zip(*parts, strict=True))
            node, first = np.unique(node, return_index=True)  # the state comes first, and with it what is done
            s, done = s[first], done[first]
            best = np.lexsort((node, -s))[: 2 * hold]
            out.append((*now, node[best], s[best], done[best]))

        def told() -> pa.RecordBatch:
            query, scale, q, node, s, done = zip(*out, strict=True)
            out.clear()
            seen = _lists([len(x) for x in node], node=pa.array(np.concatenate(node)), s=pa.array(np.concatenate(s), pa.float32()), done=pa.array(np.concatenate(done)))
            return pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(scale, pa.float32()), pa.array(q, pa.binary()), seen], names=["query", "scale", "q", "seen"])

        for batch in batches:
            if not batch.num_rows:
                continue
            query, scale, q = (batch.column(c).to_pylist() for c in ("query", "scale", "q"))
            (held, seen), (upto, offers) = _pieces(batch.column("seen")), _pieces(batch.column("offers"))
            begin = [i for i in range(len(query)) if i == 0 or query[i] != query[i - 1]]
            for i, j in zip(begin, [*begin[1:], len(query)], strict=True):
                if now is None or query[i] != now[0]:
                    if now is not None:
                        close()
                        if len(out) == most:
                            yield told()
                    now = query[i], scale[i], q[i]
                    mine = seen.slice(held[i], held[i + 1] - held[i])
                    done = mine.field("done").to_numpy(zero_copy_only=False).astype(bool)
                    parts = [(mine.field("node").to_numpy(), mine.field("s").to_numpy(), done | (np.arange(len(done)) < hold) if hop else done)]
                if more := upto[j] - upto[i]:
                    some = offers.slice(upto[i], more)
                    parts.append((some.field("node").to_numpy(), some.field("s").to_numpy(), np.zeros(more, bool)))
        if now is not None:
            close()
            yield told()

    return work


def yardstick(nodes: DataFrame, queries: DataFrame, k: int, size: int = YARDSTICK) -> DataFrame:
    """(query, node): the k truly nearest other nodes of some query nodes, by brute force over every node."""
    asked = queries.orderBy(F.xxhash64("query")).limit(size).join(nodes.withColumnRenamed("node", "query"), "query").select("query", "v").collect()
    number, q = np.array([r.query for r in asked], np.int64), np.array([r.v for r in asked])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                node = np.array(batch.column("node"))
                s = np.array(batch.column("v").to_pylist()) @ q.T
                s[node[:, None] == number[None, :]] = -np.inf
                top = np.argsort(-s, axis=0, kind="stable")[:k]
                at = np.repeat(np.arange(len(number))[None, :], len(top), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(number[at.ravel()]), pa.array(node[top.ravel()]), pa.array(s[top, at].ravel())], names=["query", "node", "s"])

    top = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("s"), "node"))
    found = nodes.mapInArrow(work, "query bigint, node bigint, s double").filter("query <> node").withColumn("r", top)
    return written(found.filter(F.col("r") <= k).select("query", "node"), "yardstick")


def greedy_search(graph: DataFrame, packed: DataFrame, frame: Frame, queries: DataFrame, truth: DataFrame, *, hold: int = 128, keep: int = 64, least: float = 0.96, rest: float = 0.02) -> DataFrame:
    """(query, node) candidates, each query node itself, for its copies, and the `keep` nearest found of it. Every hop expands those of the `hold` nearest
    that are not expanded yet, until few are left (`rest` of the hold); this goes on with twice the `hold`, until `least` of truth(query, node) are held, or every node.
    Twice as many nodes as are expanded stay in a query's state, so that widening goes on from them. A query's vector travels to the nodes it expands,
    whose edges lie there in one row; only what beats the last of its state comes back. `hold` entry nodes are offered to every query at first and at each widening."""
    edge, none = "array<struct<node:bigint,scale:float,q:binary>>", F.lit(float("-inf")).cast("float")
    n, wanted, asked = packed.count(), truth.count(), queries.count()
    own = packed.join(queries.withColumnRenamed("query", "node"), "node", "left_semi").withColumnRenamed("node", "query")
    near = graph.join(packed.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("grp")).agg(F.collect_list(F.struct(F.col("b").alias("node"), "scale", "q")).alias("edges"))
    near = written(near.select("grp", F.lit(None).cast("bigint").alias("query"), none.alias("bar"), F.lit(None).cast("float").alias("scale"), F.lit(None).cast("binary").alias("q"), "edges"), "edges")
    start = graph.groupBy(F.col("a").alias("query")).agg(F.sort_array(F.collect_list(F.struct("s", F.col("b").alias("node"))), asc=False).alias("own"))
    seen = F.transform(F.coalesce("own", F.array().cast("array<struct<s:float,node:bigint>>")), lambda e: F.struct(e["node"].alias("node"), e["s"].alias("s"), F.lit(False).alias("done")))
    state = written(own.join(start, "query", "left").select("query", "scale", "q", seen.alias("seen")), "search")

    def merged(state: DataFrame, offers: DataFrame, hold: int, hop: bool) -> DataFrame:
        rows = state.withColumn("offers", F.lit(None).cast("array<struct<node:bigint,s:float>>")).unionByName(offers, allowMissingColumns=True).withColumn("turn", F.col("seen").isNull())
        rows = rows.repartition("query").sortWithinPartitions("query", "turn").mapInArrow(_merge(hold, hop), "query bigint, scale float, q binary, seen array<struct<node:bigint,s:float,done:boolean>>")
        step = written(rows, "search")
        discard(state)
        return step

    def entered(state: DataFrame, hold: int) -> DataFrame:
        part = F.pmod(F.xxhash64("node"), F.lit(-(-hold // 64))).alias("grp")
        entries = packed.orderBy(F.xxhash64("node", F.lit(hold))).limit(hold).groupBy(part).agg(F.collect_list(F.struct("node", "scale", "q")).cast(edge).alias("edges"))
        met = state.select("query", none.alias("bar"), "scale", "q").crossJoin(entries).select("grp", "query", "bar", "scale", "q", "edges")
        return merged(state, met.mapInArrow(_expand(frame), "query bigint, offers array<struct<node:bigint,s:float>>"), hold, False)

    while True:
        state = entered(state, hold)
        fresh = F.filter(F.slice("seen", 1, hold), lambda e: ~e["done"])
        bar = F.when(F.size("seen") == 2 * hold, F.element_at("seen", -1)["s"]).otherwise(none)
        left = state.agg(F.sum(F.size(fresh))).first()[0]
        while left:
            front = state.select("query", bar.alias("bar"), "scale", "q", F.explode(fresh).alias("e")).select(F.col("e.node").alias("grp"), "query", "bar", "scale", "q", F.lit(None).cast(edge).alias("edges"))
            met = near.unionByName(front).withColumn("turn", F.col("edges").isNull()).repartition("grp").sortWithinPartitions("grp", "turn").drop("turn")
            state = merged(state, met.mapInArrow(_expand(frame), "query bigint, offers array<struct<node:bigint,s:float>>"), hold, True)
            if left <= rest * hold * asked:
                break
            left = state.agg(F.sum(F.size(fresh))).first()[0]
        sampled = state.join(truth.select("query").distinct(), "query", "left_semi").select("query", F.explode("seen.node").alias("node"))
        if sampled.join(truth, ["query", "node"], "left_semi").count() >= least * wanted or hold >= n:
            break
        hold = 2 * hold
    discard(near)
    return state.select("query", F.explode(F.slice("seen.node", 1, keep)).alias("node")).unionByName(queries.select("query", F.col("query").alias("node")))


def _inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x, y = np.array(batch.column("v").to_pylist()), np.array(batch.column("w").to_pylist())
            keep = [batch.column(c) for c in ("query", "node")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array((x * y).sum(axis=1))], names=["query", "node", "score"])


def nearest(vectors: DataFrame, *, k: int = 20, every: int = 20, id_column: str = "vec_id", column: str = "embedding", **how) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found, by inner product, for rows whose id is divisible by `every`."""
    rows = written(usable(vectors, id_column, column), "usable")
    nodes = rows.groupBy("v").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    nodes = written(nodes, "nodes")
    member = rows.join(nodes.select("v", "node"), "v").select("id", "node")
    first = F.row_number().over(Window.partitionBy("node").orderBy("id"))
    if nodes.filter("copies > 1").limit(1).count():
        shown = member.withColumn("r", first).filter(F.col("r") <= k + 1)
    else:
        shown = member.withColumn("r", F.lit(1))
    shown = written(shown.select("node", "id"), "shown")
    asked = written(member.filter(F.pmod("id", F.lit(every)) == 0).select(F.col("id").alias("query_id"), F.col("node").alias("query")), "asked")
    if nodes.limit(2).count() < 2:
        found = asked.select("query", F.col("query").alias("node")).distinct()
    else:
        graph, packed, frame = neighbour_graph(nodes.select("node", "v"), **how)
        queries = written(asked.select("query").distinct(), "queries")
        truth = yardstick(nodes.select("node", "v"), queries, k)
        found = written(greedy_search(graph, packed, frame, queries, truth, keep=max(64, 2 * k + 2)), "found")
        discard(graph, packed, queries, truth)
    exact = found.join(nodes.select("node", "v"), "node").join(nodes.select(F.col("node").alias("query"), F.col("v").alias("w")), "query").select("query", "node", "v", "w")
    scored = exact.mapInArrow(_inner, "query bigint, node bigint, score double")
    top = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "node"))
    scored = scored.withColumn("t", top).filter(F.col("t") <= k + 1)
    pairs = scored.join(shown, "node").join(asked, "query").filter("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
