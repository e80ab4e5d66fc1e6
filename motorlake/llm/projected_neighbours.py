"""Nearest neighbours by inner product from a kd-tree over a low-dimensional stable projection.

Vectors are projected by a Gaussian (2-stable) matrix, so a projected squared distance is the true one
times a chi-square variable of ``DIMS`` degrees. A kd-tree over the projections gives each query its
projected neighbours in ascending distance, leaf by leaf; they are verified on the original vectors until a
chi-square test says that a vector better than the ones found would have been met with ``CONFIDENCE``.

Inner products become distances by norm bands: with |x| <= M, (x, sqrt(M² - |x|²)) and (q M / |q|, 0) have
the squared distance 2 M² - 2 (M / |q|) q·x.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from motorlake.llm.common import saved

DIMS = 8                  # of the projection; even, so that the chi-square distribution has a closed form
CONFIDENCE = 0.95         # of the stopping test
SEED = 11
SAMPLE = 20_000           # projections that the cells are fitted on; every vector is indexed
CELL_POINTS = 8192        # vectors of one shard; a fuller cell is dealt over several shards
MOST_CELLS = 4096         # bounds what is sent to the tasks; beyond it cells have more shards
LEAF = 128
QUERY_BATCH = 512


def chi_square(x: float, dims: int = DIMS) -> float:
    """The distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, dims // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, dims: int = DIMS) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, dims) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dims) < p else (low, mid)
    return high


class Projection:
    """The stable projection of vectors of one length, by norm band."""

    def __init__(self, length: int, dims: int = DIMS, seed: int = SEED):
        g = np.random.RandomState(seed).standard_normal((length + 1, dims))
        self.own, self.rest = g[:length], g[length]

    @staticmethod
    def norms(x: np.ndarray) -> np.ndarray:
        most = np.abs(x).max(axis=1)
        return most * np.sqrt(((x / most[:, None]) ** 2).sum(axis=1))

    @staticmethod
    def bands(norms: np.ndarray) -> np.ndarray:
        """Band b holds norms up to 2 ** b, a millionth above the power included, so unit vectors share one."""
        return np.ceil(np.log2(norms) - 1e-6).astype(np.int32)

    @staticmethod
    def top(band):
        return np.ldexp(1.0 + 1e-6, band)

    def points(self, x: np.ndarray, bands: np.ndarray) -> np.ndarray:
        m, n = self.top(bands), self.norms(x)
        return x @ self.own + (m * np.sqrt(np.maximum(0.0, 1.0 - (n / m) ** 2)))[:, None] * self.rest

    def queries(self, q: np.ndarray, band: int) -> np.ndarray:
        return (q * (self.top(band) / self.norms(q))[:, None]) @ self.own


# ---------------------------------------------------------------- kd-trees

def kd_splits(x: np.ndarray, leaves: int) -> list:
    """Median splits of the widest dimension: a leaf number, or [dimension, value, left, right]."""
    numbers = iter(range(leaves))

    def split(rows: np.ndarray, n: int):
        wide = np.ptp(rows, axis=0) if len(rows) > 1 else np.zeros(x.shape[1])
        if n < 2 or not wide.max(initial=0.0) > 0:
            return next(numbers)
        d = int(wide.argmax())
        left = n // 2
        at = float(np.quantile(rows[:, d], left / n))
        low = rows[:, d] <= at
        if low.all():
            low = rows[:, d] < at
            at = float(np.nextafter(at, -np.inf))
        return [d, at, split(rows[low], left), split(rows[~low], n - left)]

    return split(x, leaves)


def kd_place(x: np.ndarray, tree) -> np.ndarray:
    """The leaf number of every row."""
    out = np.zeros(len(x), dtype=np.int32)
    todo = [(np.arange(len(x)), tree)]
    while todo:
        rows, node = todo.pop()
        if isinstance(node, int):
            out[rows] = node
        elif len(rows):
            low = x[rows, node[0]] <= node[1]
            todo += [(rows[low], node[2]), (rows[~low], node[3])]
    return out


def box_distances(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of projected queries to boxes: (queries, boxes)."""
    out = np.zeros((len(q), len(low)))
    for d in range(q.shape[1]):
        out += np.maximum(np.maximum(low[None, :, d] - q[:, None, d], q[:, None, d] - high[None, :, d]), 0.0) ** 2
    return out


class Shard:
    """The vectors of one shard under a kd-tree of their projections, in leaf order."""

    def __init__(self, band: int, first: np.ndarray, vectors: np.ndarray, projected: np.ndarray):
        self.band = band
        leaf = kd_place(projected, kd_splits(projected, max(1, -(-len(vectors) // LEAF))))
        order = np.argsort(leaf, kind="stable")
        self.order, self.first, self.vectors = order, first[order], vectors[order]
        starts = np.flatnonzero(np.diff(leaf[order], prepend=-1))
        self.starts, self.stops = starts, np.append(starts[1:], len(order))
        p = projected[order]
        self.low, self.high = np.minimum.reduceat(p, starts), np.maximum.reduceat(p, starts)

    def search(self, projection: Projection, q: np.ndarray, bound: np.ndarray, k: int, limit: float) -> tuple[np.ndarray, np.ndarray]:
        """(query number, place in leaf order) of each query's up to ``k`` best; ``bound`` are scores already reached.

        Leaves come in ascending distance of their projected box, one, then twice as many a round.
        A query stops once its next leaf is farther than ``limit`` (the chi-square quantile) times the squared
        distance of its k-th best.
        """
        m, norms = Projection.top(self.band), Projection.norms(q)
        away = box_distances(projection.queries(q, self.band), self.low, self.high)
        order = np.argsort(away, axis=1, kind="stable")
        kth = bound.copy()
        who, place, score = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        at, step, leaves = 0, 1, away.shape[1]
        while at < leaves:
            reach = limit * np.maximum(0.0, 2 * m * m - 2 * (m / norms) * kth)      # unbounded where kth is -inf
            here = order[:, at:at + step]
            open_ = np.take_along_axis(away, here, axis=1) <= reach[:, None]
            rows, cols = np.nonzero(open_)
            if not len(rows):
                break
            leaf = here[rows, cols]
            by = np.argsort(leaf, kind="stable")
            rows, leaf = rows[by], leaf[by]
            cuts = np.flatnonzero(np.diff(leaf, prepend=-1))
            found = [(who, place, score)]
            for i, j in zip(cuts, np.append(cuts[1:], len(leaf))):
                mine, start = rows[i:j], self.starts[leaf[i]]
                s = q[mine] @ self.vectors[start:self.stops[leaf[i]]].T
                a, b = np.nonzero(s >= kth[mine][:, None])
                found.append((mine[a], start + b, s[a, b]))
            who, place, score = (np.concatenate(x) for x in zip(*found))
            by = np.lexsort((self.first[place], -score, who))
            who, place, score = who[by], place[by], score[by]
            rank = np.arange(len(who)) - np.searchsorted(who, who)
            kept = rank < k
            last = rank == k - 1
            kth[who[last]] = np.maximum(kth[who[last]], score[last])
            who, place, score = who[kept], place[kept], score[kept]
            at, step = at + step, step * 2
        return who, place


# ---------------------------------------------------------------- tables

def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding in doubles), one row a vec_id: without NULL ids, NULL or zero vectors and those
    with a NULL or non-finite component; of repeated ids the least vector, of lengths the commonest."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col("vec_id"), v.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    common = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("embedding") == (common["n"] if common else 0)).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _lists(x: np.ndarray) -> pa.Array:
    n, d = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(np.ascontiguousarray(x).reshape(-1)))


def projected(rows: DataFrame, length: int) -> DataFrame:
    """(vec_id, key, band, embedding, projection); equal vectors have one ``key``, a 128-bit digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projection = Projection(length)
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1)) + 0.0
                bands = projection.bands(projection.norms(x))
                key = [hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in x]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(key, pa.binary()), pa.array(bands), _lists(x), _lists(projection.points(x, bands))],
                                                 names=["vec_id", "key", "band", "embedding", "projection"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, key binary, band int, embedding array<double>, projection array<double>")


class Cells:
    """Top of the kd-tree: a fitted cell for each part of a norm band, with the exact box and size of all its vectors."""

    def __init__(self, points: DataFrame):
        sizes = {r["band"]: r["n"] for r in points.groupBy("band").agg(F.count("*").alias("n")).collect()}
        total = sum(sizes.values())
        sample = points.orderBy(F.xxhash64("key")).limit(SAMPLE).select("band", "projection").collect()
        self.trees, self.first, n = {}, {}, 0
        for band in sorted(sizes):
            x = np.array([r["projection"] for r in sample if r["band"] == band]).reshape(-1, DIMS)
            leaves = max(1, min(-(-sizes[band] // CELL_POINTS), MOST_CELLS * sizes[band] // total, len(x)))
            self.trees[band], self.first[band] = kd_splits(x, leaves), n
            n += leaves

    def place(self, bands: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=np.int32)
        for band in np.unique(bands):
            rows = bands == band
            out[rows] = self.first[band] + kd_place(x[rows], self.trees[band])
        return out

    def measure(self, placed: DataFrame) -> None:
        """Boxes, sizes and shards of the cells from the written points; one row a cell goes through the driver."""
        p = F.col("projection")
        ends = [f(p[d]).alias(f"{name}{d}") for d in range(DIMS) for name, f in (("low", F.min), ("high", F.max))]
        rows = sorted(placed.groupBy("cell", "band").agg(F.count("*").alias("n"), *ends).collect(), key=lambda r: r["cell"])
        self.cell = np.array([r["cell"] for r in rows], dtype=np.int32)
        self.band = np.array([r["band"] for r in rows], dtype=np.int32)
        self.low, self.high = (np.array([[r[f"{e}{d}"] for d in range(DIMS)] for r in rows]).reshape(-1, DIMS) for e in ("low", "high"))
        self.shards = {r["cell"]: -(-r["n"] // CELL_POINTS) for r in rows}

    def near(self, projection: Projection, q: np.ndarray) -> np.ndarray:
        """Squared projected distances of queries to all cells, each in its band's scale."""
        out = np.zeros((len(q), len(self.cell)))
        for band in np.unique(self.band):
            at = self.band == band
            out[:, at] = box_distances(projection.queries(q, band), self.low[at], self.high[at])
        return out

    def home(self, projection: Projection, q: np.ndarray) -> np.ndarray:
        """Number of the cell with the greatest inner product expected at its nearest place."""
        m = Projection.top(self.band)
        return (m - self.near(projection, q) / (2 * DIMS * m)).argmax(axis=1)


def _routed(queries: DataFrame, cells: Cells, length: int, limit: float, first: bool) -> DataFrame:
    """Query rows (cell, shard, key, embedding, bound): for the first round each query's home cell, then every
    other cell that the stopping test leaves open at the bound found there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projection = Projection(length)
        for whole in batches:
            for i in range(0, whole.num_rows, QUERY_BATCH):
                b = whole.slice(i, QUERY_BATCH)
                q, bound = _matrix(b.column(1)), b.column(2).to_numpy(zero_copy_only=False)
                home = cells.home(projection, q)
                if first:
                    chosen = np.zeros((len(q), len(cells.cell)), dtype=bool)
                    chosen[np.arange(len(q)), home] = True
                else:
                    m, n = Projection.top(cells.band)[None, :], Projection.norms(q)[:, None]
                    reach = limit * np.maximum(0.0, 2 * m * m - 2 * (m / n) * bound[:, None])
                    chosen = (cells.near(projection, q) <= reach) & (n * m >= bound[:, None])
                    chosen[np.arange(len(q)), home] = False
                for c in np.flatnonzero(chosen.any(axis=0)):
                    rows = pa.array(np.flatnonzero(chosen[:, c]))
                    for shard in range(cells.shards[int(cells.cell[c])]):
                        n_rows = len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n_rows, cells.cell[c])), pa.array(np.full(n_rows, shard, dtype=np.int32)), *(col.take(rows) for col in b.columns)],
                            names=["cell", "shard", "key", "embedding", "bound"])

    return queries.select("key", "embedding", "bound").mapInArrow(run, "cell int, shard int, key binary, embedding array<double>, bound double")


HITS = "key binary, score double, ids array<bigint>"


def _searched(points: DataFrame, queries: DataFrame, length: int, k: int, limit: float) -> DataFrame:
    """(key, score, ids): each routed query's best vectors of its shard.

    Shards come sorted, their vectors before their queries: a task holds one shard's vectors (at most about
    ``CELL_POINTS``) and streams any number of queries past them.
    """
    cols = ["cell", "shard", "kind", "key", "embedding", "bound", "band", "projection", "ids"]
    both = points.withColumns({"kind": F.lit(0), "bound": F.lit(None).cast(DoubleType())}).select(*cols).unionByName(
        queries.withColumns({"kind": F.lit(1), "band": F.lit(None).cast("int"), "projection": F.lit(None).cast("array<double>"),
                             "ids": F.lit(None).cast("array<bigint>")}).select(*cols))
    dealt = both.repartition("cell", "shard").sortWithinPartitions("cell", "shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projection, current, held, shard, ids = Projection(length), None, [], None, None
        for whole in batches:
            place = np.stack([whole.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            cuts = np.flatnonzero(np.any(np.diff(place, axis=1, prepend=-1) != 0, axis=0))
            for i, j in zip(cuts, np.append(cuts[1:], whole.num_rows)):
                b, at = whole.slice(i, j - i), tuple(place[:2, i].tolist())
                if at != current:
                    current, held, shard = at, [], None
                if place[2, i] == 0:
                    held.append(b)
                    continue
                if shard is None:
                    if not held:
                        continue
                    mine = pa.Table.from_batches(held).combine_chunks()
                    col = {n: mine.column(n).combine_chunks() for n in ("embedding", "projection", "ids", "band")}
                    first = np.array([x[0].as_py() for x in col["ids"]], dtype=np.int64)
                    shard, ids, held = Shard(col["band"][0].as_py(), first, _matrix(col["embedding"]), _matrix(col["projection"])), col["ids"], []
                for n in range(0, b.num_rows, QUERY_BATCH):
                    part = b.slice(n, QUERY_BATCH)
                    q = _matrix(part.column(4))
                    who, found = shard.search(projection, q, part.column(5).to_numpy(zero_copy_only=False), k, limit)
                    score = (q[who] * shard.vectors[found]).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([part.column(3).take(pa.array(who)), pa.array(score), ids.take(pa.array(shard.order[found]))],
                                                     names=["key", "score", "ids"])

    return dealt.mapInArrow(run, HITS)


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best vectors of each query; cut before the shuffle too (a group limit)."""
    w = Window.partitionBy("key").orderBy(F.desc("score"), F.col("ids")[0])
    return hits.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


def nearest(rows: DataFrame, every: int = 20, k: int = 20, confidence: float = CONFIDENCE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row whose vec_id is divisible by ``every``.

    Nearest is the largest inner product, ties to the smaller vec_id; a query's own vec_id is no candidate.
    Rows that take no part, repeated ids and other lengths: see ``usable``. Fewer candidates than ``k`` give
    fewer rows, an empty table none. Columns besides vec_id and embedding are ignored.

    Equal vectors are one point with its ``k`` + 1 least ids (more cannot be among the ``k`` nearest) and one query, so
    a vector that a third of the rows share costs no more than another. Two rounds: each query's home cell
    gives a bound, then it goes to the cells that the chi-square test leaves open. The driver holds the
    sample, and one row a cell.
    """
    valid = usable(rows)
    any_row = valid.select(F.size("embedding").alias("n")).first()
    length = any_row["n"] if any_row else 1
    limit = chi_square_quantile(confidence)
    vectors = saved(projected(valid, length), "vectors")

    least = Window.partitionBy("key").orderBy("vec_id")
    ids = vectors.select("key", "vec_id").withColumn("_r", F.row_number().over(least)).filter(F.col("_r") <= k + 1)
    ids = ids.groupBy("key").agg(F.sort_array(F.collect_list(F.col("vec_id").cast("long"))).alias("ids"))
    points = vectors.drop("key").join(ids.withColumn("vec_id", F.col("ids")[0].cast(vectors.schema["vec_id"].dataType)), "vec_id").drop("vec_id")
    points = saved(points, "points")
    cells = Cells(points)
    points = saved(_placed(points, cells), "cells")
    cells.measure(points)
    shards = rows.sparkSession.createDataFrame(list(cells.shards.items()), "cell int, shards int")
    points = points.join(F.broadcast(shards), "cell").withColumn("shard", F.pmod(F.xxhash64("key"), F.col("shards")).cast("int")).drop("shards")

    asked = vectors.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").cast("long").alias("query_id"), "key")
    queries = points.select("key", "embedding").join(asked.select("key").distinct(), "key", "left_semi").withColumn("bound", F.lit(float("-inf")))
    queries = saved(queries, "queries")
    near = saved(_best(_searched(points, _routed(queries, cells, length, limit, True), length, k + 1, limit), k + 1), "home-hits")
    reached = near.groupBy("key").agg(F.count("*").alias("n"), F.min("score").alias("least")).select(
        "key", F.when(F.col("n") > k, F.col("least")).otherwise(F.lit(float("-inf"))).alias("bound"))
    second = queries.drop("bound").join(reached, "key", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    far = _searched(points, _routed(second, cells, length, limit, False), length, k + 1, limit)
    hits = _best(near.unionByName(far), k + 1).groupBy("key").agg(F.collect_list(F.struct("score", "ids")).alias("hits"))
    hits = saved(hits, "hits")

    pairs = F.flatten(F.transform("hits", lambda h: F.transform(h["ids"], lambda i: F.struct((-h["score"]).alias("s"), i.alias("vec_id")))))
    best = F.slice(F.array_sort(F.filter(pairs, lambda p: p["vec_id"] != F.col("query_id"))), 1, k)
    out = asked.join(hits, "key").select("query_id", F.posexplode(best).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score"))


def _placed(points: DataFrame, cells: Cells) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                at = cells.place(b.column("band").to_numpy(), _matrix(b.column("projection")))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], names=[*b.schema.names, "cell"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    return points.mapInArrow(run, f"{kinds}, cell int")
