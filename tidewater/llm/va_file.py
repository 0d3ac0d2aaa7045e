"""Centroid clustering over a VA-file: cells first, full vectors where they decide."""

from __future__ import annotations

import hashlib
import statistics

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import table, written

DIMS = 64
SCALE = 256
BITS = 4                    # of a cell; two cells make a byte
CELLS = 1 << BITS
CENTROIDS = 40
ROUNDS = 5
LARGEST = 189_812_531       # components up to this have squared distances below 2^63
ROWS = 1024                 # vectors that are looked at together

#: edges of CELLS equally likely ranges of a normal distribution, in standard deviations
Z = [statistics.NormalDist().inv_cdf(i / CELLS) for i in range(1, CELLS)]


def kept(vectors, dims=DIMS, scale=SCALE):
    """(vec_id, vec): the vectors that have dims components, all of them finite, as
    integers floor(scale * x). The distances of integers beyond LARGEST do not fit 64
    bits; such a vector is left out as one that is not finite."""
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale <= LARGEST)
    good = vectors.where((F.size("embedding") == dims) & F.forall("embedding", fits))
    # the filter and the conversion are one expression, so no bad value is converted
    whole = F.transform("embedding", lambda x: F.when(fits(x), F.floor(x.cast("double") * scale)).cast("int"))
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vec"))


def matrix(column, dims):
    """A list column as a matrix; nothing is copied until rows are taken from it."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def summed(df, columns, dims, width, start):
    """Arrays added up over all rows: start() is called once a task and gives add(codes,
    vectors) and the array (rows x width of integers) that it adds to. The tasks' rows
    meet in Spark; the driver gets one array."""
    def run(batches):
        add, total = start()
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                add(*(part.column(c) for c in columns))
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                          pa.array(total[i, j], pa.int64())], names=["i", "j", "s"])

    got = df.select(*columns).mapInArrow(run, "i int, j int, s long").groupBy("i", "j").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    return {(r.i, r.j): int(r.s) for r in got.collect()}


def cell_edges(vectors, dims):
    """For each dimension, CELLS + 1 integers: cell c holds edges[c] to edges[c + 1] - 1.
    The inner ones follow the mean and deviation of all vectors, the outer ones the
    range; None without vectors."""
    rows = vectors.select(F.posexplode("vec").alias("d", "x")).groupBy("d").agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.avg("x").alias("mean"),
        F.stddev_pop("x").alias("std")).collect()
    edges = np.zeros((dims, CELLS + 1), np.int64)
    for r in rows:
        inner = np.clip(np.floor([r["mean"] + r["std"] * z for z in Z]), r["lo"], r["hi"] + 1)
        edges[r["d"]] = [r["lo"], *inner.astype(np.int64).tolist(), r["hi"] + 1]
    return edges if rows else None


def encode(vec, edges):
    """Cells of the vectors, two to a byte."""
    cells = np.empty(vec.shape, np.uint8)
    for d in range(vec.shape[1]):
        cells[:, d] = np.searchsorted(edges[d, 1:-1], vec[:, d], side="right")
    if vec.shape[1] % 2:
        cells = np.pad(cells, ((0, 0), (0, 1)))
    return cells[:, ::2] << BITS | cells[:, 1::2]


def va_file(vectors, edges, dims):
    """(vec_id, code, vec): code holds the cells of vec, dims / 2 bytes."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                codes = encode(matrix(part.column("vec"), dims), edges)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array([c.tobytes() for c in codes], pa.binary()), part.column("vec")],
                    names=["vec_id", "code", "vec"])
    return vectors.mapInArrow(run, "vec_id long, code binary, vec array<int>")


def lookup(centroids, edges):
    """For each byte of a code and each of its values, the least and the largest share
    of the squared distance to every centroid: (bytes, 256, 2 * centroids)."""
    lo, hi = edges[:, :-1, None], edges[:, 1:, None] - 1            # dimension, cell, 1
    c = centroids.T[:, None, :]
    under, over = lo - c, c - hi
    least = np.maximum(np.maximum(under, over), 0) ** 2
    most = np.maximum(np.abs(under), np.abs(over)) ** 2
    both = np.concatenate([least, most], axis=2)
    if len(both) % 2:
        both = np.concatenate([both, np.zeros_like(both[:1])])
    return (both[::2, :, None, :] + both[1::2, None, :, :]).reshape(len(both) // 2, CELLS * CELLS, -1)


class Nearest:
    """Assigns vectors to centroids; fetched counts the full vectors it looked at."""

    def __init__(self, centroids, edges):
        self.centroids = np.array(centroids, np.int64).reshape(-1, len(edges))
        self.tables, self.fetched = lookup(self.centroids, edges), 0

    def __call__(self, codes, vec):
        """The number of the nearest centroid of each vector (ties: the smaller one).
        Where one centroid's interval lies below all others, the cells decide."""
        k = len(self.centroids)
        bound = np.zeros((len(codes), 2 * k), np.int64)
        for p, t in enumerate(self.tables):
            bound += t[codes[:, p]]
        may = bound[:, :k] <= bound[:, k:].min(axis=1)[:, None]
        out = may.argmax(axis=1)
        open_ = np.flatnonzero(may.sum(axis=1) > 1)
        for at in range(0, len(open_), 128):
            rows = open_[at:at + 128]
            i, j = np.nonzero(may[rows])
            d = np.full((len(rows), k), np.iinfo(np.int64).max)
            d[i, j] = ((vec[rows[i]].astype(np.int64) - self.centroids[j]) ** 2).sum(axis=1)
            out[rows] = d.argmin(axis=1)
        self.fetched += len(open_)
        return out


def codes_of(column):
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def cluster(vectors, centroids=CENTROIDS, rounds=ROUNDS, dims=DIMS, scale=SCALE, salt="2"):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row
    for each kept vector.

    Centroids start as the vectors with the smallest sha256 of salt:vec_id (ties, as
    of repeated rows: by components; all vectors if there are fewer). A vector
    without vec_id is clustered but starts no centroid unless no others are left.
    No kept vector, as in an empty table: no rows. Null vectors, vectors of another
    length or with a component that is null or not finite are left out; so are those
    that kept() names. Other columns are not read.

    A round reads the cells of all vectors. The first also adds up all vectors;
    later ones keep these sums and correct them by the vectors that change
    clusters, so a full vector is fetched only where intervals overlap or it moves.
    Its old cluster comes from the centroids before, not from a stored state, so a
    lost task is simply run again. The driver holds the centroids and their sums.
    """
    spark = vectors.sparkSession
    vectors = written(spark, kept(vectors.select("vec_id", "embedding"), dims, scale), "vectors")
    edges = cell_edges(vectors, dims)
    out = "vec_id long, cluster int, distance long"
    if edges is None:
        return spark.createDataFrame([], out + ", cluster_inertia long, inertia long, centroid_sha256 string")
    first = vectors.select(F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256).alias("h"), "vec") \
        .orderBy(F.col("h").asc_nulls_last(), "vec").limit(centroids).collect()
    now = [list(r.vec) for r in first]
    rows = written(spark, va_file(vectors, edges, dims), "va")
    sums, before = {}, None
    for _ in range(rounds):
        def start(now=now, before=before):
            total = np.zeros((len(now), dims + 1), np.int64)        # the last column counts
            near, old = Nearest(now, edges), before and Nearest(before, edges)

            def add(codes, vec):
                codes, vec = codes_of(codes), matrix(vec, dims)
                to = near(codes, vec)
                moved, frm = np.arange(len(to)), None
                if old is not None:
                    frm = old(codes, vec)
                    moved = np.flatnonzero(frm != to)
                full = np.column_stack([vec[moved].astype(np.int64), np.ones(len(moved), np.int64)])
                np.add.at(total, to[moved], full)
                if old is not None:
                    np.subtract.at(total, frm[moved], full)
            return add, total

        for at, s in summed(rows, ["code", "vec"], dims, dims + 1, start).items():
            sums[at] = sums.get(at, 0) + s
        before, now = now, [[sums.get((k, d), 0) // n for d in range(dims)] if (n := sums.get((k, dims), 0)) else c
                            for k, c in enumerate(now)]

    def last(batches):
        near = Nearest(now, edges)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                vec = matrix(part.column("vec"), dims)
                to = near(codes_of(part.column("code")), vec)
                d = ((vec.astype(np.int64) - near.centroids[to]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(to, pa.int32()), pa.array(d)],
                                                 names=["vec_id", "cluster", "distance"])

    found = written(spark, rows.mapInArrow(last, out), "assigned")
    held = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    named = spark.createDataFrame(      # a row for each centroid, so small enough to broadcast
        [(k, held.get(k, 0), sum(held.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
         for k, c in enumerate(now)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12(spark, sf_dir):
    return cluster(table(spark, sf_dir, "embeddings"))
