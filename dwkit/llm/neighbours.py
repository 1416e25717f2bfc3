"""Approximate nearest neighbours by robust-pruned directed graphs.

The distinct vectors are dealt to shards of ``shard_size`` vectors or so (fewer long ones) of one length by
the hash of their values.  Each shard's graph is built in numpy by one task.  Its points are
put in, in random order and in batches that grow with the graph: a greedy beam search from
the first ``STARTS`` points (one start may lie in a dense group that no edge leaves) proposes
candidates for a new point, and of these, nearest first, those stay that are not ``alpha`` times nearer to one kept before (robust pruning), ``degree``
at most; the kept ones get an edge back, and are pruned in the same way when full.  A second
pass repeats this for every point on the whole graph.  A point that cannot be reached from
the starts after that gets an edge from its nearest point that can, so a beam as large as a
shard finds all of it.

Queries are distinct vectors, in blocks; each block meets each shard once (a row of
the shard's arrays and one of the block's, joined by their numbers), and all queries of a
block are walked at a time through the graph by beam search.  The nearest of a
shard are measured again with the original vectors in double precision, and the nearest of
all shards are ranked.  Recall is that of the shards' searches: a true neighbour is missed
only if the beam in its shard ends before it; README has figures.

Equal vectors are one point with the ``k + 1`` smallest ids that have it, which is all that a
row needs to name its ``k`` nearest others.

Edge cases: vectors that are null, empty or zero, or that hold null or non-finite
components, take no part, as query or as neighbour; vectors of different lengths are not
neighbours; a null id is the largest in ties; rows with equal ids are rows of their own, as queries
and as neighbours; other columns are ignored; an empty table, or one without a query, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwkit.llm.common import staged

SHARD, QUERY_BLOCK = 8_192, 1_024    # distinct vectors of a shard, queries of a block
SHARD_BYTES = 1 << 25                # most bytes of a shard's vectors
DEGREE, ALPHA = 48, 1.2              # edges of a point, relaxation of pruning
BUILD_BEAM, BEAM = 64, 96            # places of a search for a point's edges, of a query
STARTS = 48                          # points where searches begin
_STEP = 256                          # most points put in, or queries walked, at a time
_WIDE = 4                            # points opened at a step of a search


@dataclass
class Graph:
    points: np.ndarray               # float32, n x d, scaled to 1
    edges: np.ndarray                # int32, n x degree or more; -1 is none
    starts: np.ndarray               # int32, points where searches begin

    @property
    def sizes(self) -> np.ndarray:
        return np.einsum("nd,nd->n", self.points, self.points)


def scale(points: np.ndarray) -> float:
    """The largest component, so that squares of scaled ones stay within single precision."""
    return float(np.abs(points).max(initial=0)) or 1.0


def walk(g: Graph, sizes: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of all queries side by side: the places' points (-1: none) and squared distances, nearest first."""
    m, n = len(queries), len(g.points)
    queries = np.clip(queries, -1e9, 1e9).astype(np.float32)
    own = np.einsum("qd,qd->q", queries, queries)
    far = np.float32(np.inf)
    ids, dist = np.full((m, beam), -1, dtype=np.int32), np.full((m, beam), far, dtype=np.float32)
    opened, seen = np.ones((m, beam), dtype=bool), np.zeros((m, n), dtype=bool)
    first = sizes[g.starts] - 2 * queries @ g.points[g.starts].T + own[:, None]
    near = np.argsort(first, axis=1, kind="stable")[:, :beam]
    k = near.shape[1]
    ids[:, :k], dist[:, :k], opened[:, :k], seen[:, g.starts] = g.starts[near], np.maximum(np.take_along_axis(first, near, axis=1), 0), False, True
    live = np.arange(m)
    while len(live):
        # The nearest places that are not opened yet, of every query that has some.
        waiting = np.where(opened[live], far, dist[live])
        best = np.argpartition(waiting, min(_WIDE, beam) - 1, axis=1)[:, :_WIDE] if beam > _WIDE else np.argsort(waiting, axis=1)
        ok = np.take_along_axis(waiting, best, axis=1) < far
        some = ok.any(axis=1)
        live, best, ok = live[some], best[some], ok[some]
        if not len(live):
            break
        opened[live[:, None], best] = True
        near = np.where(ok[:, :, None], g.edges[np.where(ok, ids[live[:, None], best], 0)], -1).reshape(len(live), -1)
        # Points met before, or twice in this step, do not count.
        near = np.sort(near, axis=1)
        fresh = (near >= 0) & ~seen[live[:, None], near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        row, col = np.nonzero(fresh)
        to = near[row, col]
        seen[live[row], to] = True
        d = np.full(near.shape, far, dtype=np.float32)
        d[row, col] = np.maximum(sizes[to] - 2 * np.einsum("ed,ed->e", queries[live[row]], g.points[to]) + own[live[row]], 0)
        every = np.concatenate((dist[live], d), axis=1)
        pick = np.argpartition(every, beam - 1, axis=1)[:, :beam]
        dist[live] = np.take_along_axis(every, pick, axis=1)
        ids[live] = np.take_along_axis(np.concatenate((ids[live], np.where(fresh, near, -1)), axis=1), pick, axis=1)
        opened[live] = np.take_along_axis(np.concatenate((opened[live], ~fresh), axis=1), pick, axis=1)
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(dist, order, axis=1)


def prune(points: np.ndarray, of: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Edges of the points ``of`` among their candidates (-1: none): nearest first, each unless a
    kept one is ``alpha`` times nearer to it than the point itself."""
    candidates = np.sort(np.where(candidates == of[:, None], -1, candidates), axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    x = points[candidates]
    dist = np.where(candidates < 0, np.inf, np.square(x - points[of][:, None]).sum(axis=2))
    order = np.argsort(dist, axis=1, kind="stable")
    candidates, dist = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(dist, order, axis=1)
    x = np.take_along_axis(x, order[:, :, None], axis=1)
    size = np.square(x).sum(axis=2)
    between = alpha * alpha * np.maximum(size[:, :, None] + size[:, None, :] - 2 * (x @ x.transpose(0, 2, 1)), 0)
    alive, out = candidates >= 0, np.full((len(of), degree), -1, dtype=np.int32)
    every = np.arange(len(of))
    for k in range(degree):
        first = alive.argmax(axis=1)
        some = alive[every, first]
        if not some.any():
            break
        out[some, k] = candidates[some, first[some]]
        alive &= between[every, first] > dist
        alive[every, first] = False
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, passes: int = 2, seed: int = 5) -> Graph:
    """The graph of a shard's points."""
    n = len(points)
    points = np.ascontiguousarray(points / scale(points), dtype=np.float32)
    order = np.random.default_rng(seed).permutation(n).astype(np.int32)
    g = Graph(points, np.full((n, degree), -1, dtype=np.int32), order[:STARTS])
    sizes = g.sizes
    for turn in range(passes):
        done, tight = 0, 1.0 if turn + 1 < passes else alpha
        while done < n:
            # A batch is no larger than what the graph holds already, since its points do not see each other.
            step = order[done:done + (min(max(done, STARTS), _STEP) if turn == 0 else _STEP)]
            done += len(step)
            met, _ = walk(g, sizes, points[step], beam)
            g.edges[step] = prune(points, step, np.concatenate((met, g.edges[step]), axis=1), degree, tight)
            _back(g, step, degree, tight)
    _connect(g, sizes, beam)
    return g


def _connect(g: Graph, sizes: np.ndarray, beam: int) -> None:
    """An edge to every point that cannot be reached from the start."""
    reached, front = np.zeros(len(g.points), dtype=bool), g.starts
    while len(front):
        reached[front] = True
        near = np.unique(g.edges[front])
        front = near[(near >= 0) & ~reached[near]]
    lost = np.flatnonzero(~reached)
    for lo in range(0, len(lost), _STEP):
        some = lost[lo:lo + _STEP]
        near = walk(g, sizes, g.points[some], beam)[0][:, 0]
        for p, q in zip(some.tolist(), near.tolist(), strict=True):
            free = np.flatnonzero(g.edges[q] < 0)
            if not len(free):
                g.edges = np.concatenate((g.edges, np.full((len(g.edges), 1), -1, dtype=np.int32)), axis=1)
                free = [g.edges.shape[1] - 1]
            g.edges[q, free[0]] = p


def _back(g: Graph, step: np.ndarray, degree: int, alpha: float) -> None:
    """Edges from the new points' neighbours to them."""
    to, frm = g.edges[step].ravel(), np.repeat(step, degree).astype(np.int32)
    frm, to = frm[to >= 0], to[to >= 0]
    order = np.argsort(to, kind="stable")
    frm, to = frm[order], to[order]
    at, begin, n = np.unique(to, return_index=True, return_counts=True)
    new = np.full((len(at), int(n.max(initial=0))), -1, dtype=np.int32)
    new[np.repeat(np.arange(len(at)), n), np.arange(len(to)) - np.repeat(begin, n)] = frm
    for lo in range(0, len(at), _STEP):
        some, more = at[lo:lo + _STEP], new[lo:lo + _STEP]
        more = more[:, (more >= 0).any(axis=0)]
        every = np.concatenate((g.edges[some], more), axis=1)
        every = np.sort(every, axis=1)[:, ::-1]
        every[:, 1:][every[:, 1:] == every[:, :-1]] = -1
        full = (every >= 0).sum(axis=1) > degree
        room = np.sort(every[~full], axis=1)[:, ::-1][:, :degree]
        g.edges[some[~full]] = room
        if full.any():
            g.edges[some[full]] = prune(g.points, some[full], every[full], degree, alpha)


def _shards(it: Iterator[pa.RecordBatch], options: dict) -> Iterator[pa.RecordBatch]:
    """Rows ``(length, shard, point, vec)`` in order, as one row per shard: its points' numbers and vectors, and the graph."""
    key, numbers, vectors = None, [], []

    def row() -> pa.RecordBatch:
        x = np.concatenate(vectors).reshape(-1, key[0])
        g = build(x, **options)
        cell = lambda a: pa.array([a.tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays([
            pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), cell(np.concatenate(numbers)), cell(x), cell(g.edges),
            cell(g.starts)], names=["length", "shard", "points", "vectors", "edges", "starts"])

    for batch in it:
        keys = np.stack([batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64), batch.column("shard").to_numpy(zero_copy_only=False)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if lo == hi:
                continue
            if (own := tuple(keys[:, lo].tolist())) != key:
                if numbers:
                    yield row()
                key, numbers, vectors = own, [], []
            part = batch.slice(lo, hi - lo)
            numbers.append(part.column("point").to_numpy(zero_copy_only=False))
            vectors.append(part.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if numbers:
        yield row()


def _searched(it: Iterator[pa.RecordBatch], beam: int, top: int) -> Iterator[pa.RecordBatch]:
    """Of each query the ``top`` nearest points of a shard, by exact distance."""
    for batch in it:
        for at in range(batch.num_rows):
            r, = batch.slice(at, 1).to_pylist()
            d = r["length"]
            x, g_edges = np.frombuffer(r["vectors"]).reshape(-1, d), np.frombuffer(r["edges"], dtype=np.int32)
            q = np.frombuffer(r["queries"]).reshape(-1, d)
            points, asked = np.frombuffer(r["points"], dtype=np.int64), np.frombuffer(r["asked"], dtype=np.int64)
            unit = scale(x)
            g = Graph((x / unit).astype(np.float32), g_edges.reshape(len(x), -1), np.frombuffer(r["starts"], dtype=np.int32))
            sizes = g.sizes
            for lo in range(0, len(q), _STEP):
                some = q[lo:lo + _STEP]
                met, _ = walk(g, sizes, some / unit, beam)
                score = np.sqrt(np.square(x[met] - some[:, None]).sum(axis=2))
                score[met < 0] = np.inf
                # Ties go by id in the end, so all at the distance of the last place go on.
                last = np.partition(score, min(top, score.shape[1]) - 1, axis=1)[:, min(top, score.shape[1]) - 1]
                row, col = np.nonzero((score <= last[:, None]) & (met >= 0))
                yield pa.RecordBatch.from_arrays([pa.array(asked[lo + row]), pa.array(points[met[row, col]]), pa.array(score[row, col])],
                                                 names=["asked", "point", "score"])


def _blocks(it: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Queries ``(length, point, vec)``, ordered by length, as rows of ``size`` of them."""
    key, numbers, vectors = None, [], []

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([np.array(numbers, dtype=np.int64).tobytes()], pa.binary()),
                                           pa.array([np.array(vectors, dtype=np.float64).tobytes()], pa.binary())], names=["length", "asked", "queries"])

    for batch in it:
        for d, point, vec in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if numbers and (d != key or len(numbers) == size):
                yield row()
                numbers, vectors = [], []
            key = d
            numbers.append(point)
            vectors.append(vec)
    if numbers:
        yield row()


def search(vectors: DataFrame, query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", shard_size: int = SHARD,
           query_block: int = QUERY_BLOCK, degree: int = DEGREE, beam: int = BEAM, build_beam: int = BUILD_BEAM, alpha: float = ALPHA) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` nearest rows found (all, if there are fewer others) of every
    row for which ``query``, a condition on the id column, holds; the row itself is none of them."""
    v = F.col("vec")
    usable = (v.isNotNull() & (F.size(v) > 0) & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
              & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))
    rows = (vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(query, F.lit(False)).alias("asks"))
            .where(usable).withColumn("digest", F.xxhash64("vec")).withColumn("rid", F.monotonically_increasing_id()))
    ready = staged(rows, "vectors")
    # Of equal vectors the smallest ids; each row that asks is kept beside them.
    place = F.row_number().over(Window.partitionBy("vec").orderBy(F.asc_nulls_last("id"), "rid"))
    named = ready.withColumn("place", place).where(F.col("place") <= k + 1)
    points = staged(named.groupBy("vec", "digest").agg(F.array_sort(F.collect_list(F.struct("place", "id", "rid"))).alias("rows"))
                    .withColumn("point", F.monotonically_increasing_id()), "points")
    sizes = points.groupBy(F.size("vec").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    most = F.greatest(F.lit(1), F.least(F.lit(shard_size), F.floor(SHARD_BYTES / (8 * F.col("length")))))
    of = staged(sizes.select("length", F.ceil(F.col("n") / most).cast("long").alias("shards")), "shards")
    options = {"degree": degree, "beam": build_beam, "alpha": alpha}
    dealt = (points.select(F.size("vec").alias("length"), "point", "vec", "digest").join(of, "length")
             .select("length", F.pmod("digest", "shards").alias("shard"), "point", "vec"))
    tasks = 2 * (of.agg(F.sum("shards")).first()[0] or 1)      # a given number: a few shards in one task are slow, however small
    graphs = staged(dealt.repartition(tasks, "length", "shard").sortWithinPartitions("length", "shard", "point").mapInArrow(
        partial(_shards, options=options), "length int, shard long, points binary, vectors binary, edges binary, starts binary"), "graphs")

    asking = ready.where("asks").select("id", "rid", "vec")
    who = staged(asking.join(points.select("vec", "point"), "vec").select("id", "rid", "point"), "asking")
    distinct = points.join(who.select("point").distinct(), "point", "left_semi").select(F.size("vec").alias("length"), "point", "vec")
    blocks = staged(distinct.repartitionByRange("length", "point").sortWithinPartitions("length", "point").mapInArrow(
        partial(_blocks, size=query_block), "length int, asked binary, queries binary").withColumn("block", F.monotonically_increasing_id()), "blocks")
    # Every block meets every shard of its length: the stated queries against all rows.
    sent = blocks.join(of, "length").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))).drop("shards")
    held = graphs.join(blocks.select("length", "block"), "length")
    met = sent.join(held, ["length", "shard", "block"]).select("length", "points", "vectors", "edges", "starts", "asked", "queries")
    near = met.mapInArrow(partial(_searched, beam=beam, top=k + 1), "asked long, point long, score double")

    # The nearest points of all shards hold the nearest rows, as each comes with its smallest ids.
    rid = F.transform("rows", lambda r: F.struct(r["id"].alias("id"), r["rid"].alias("rid")))
    first = points.select("point", rid.alias("rows"), F.col("rows")[0]["id"].alias("least"))
    close = Window.partitionBy("asked").orderBy("score", F.asc_nulls_last("least"), "point")
    nearest = near.join(first.select("point", "least"), "point").withColumn("r", F.row_number().over(close)).where(F.col("r") <= k + 1)
    them = (nearest.join(first.select("point", "rows"), "point").select("asked", "score", F.inline("rows")))
    rank = Window.partitionBy("query").orderBy("score", F.asc_nulls_last("id"), "rid")
    found = (who.select(F.col("id").alias("query_id"), F.col("rid").alias("query"), F.col("point").alias("asked")).join(them, "asked")
             .where("rid != query").withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
