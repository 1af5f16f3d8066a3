"""Operator 8, approximate nearest neighbours by shifted space-filling curves.

Equal vectors are one class with its ``k + 1`` smallest ids.  Each of ``CURVES``
Hilbert curves orders the classes by a shifted projection to ``DIMS``
dimensions; Spark ranks the keys (buckets between quantiles, running counts, a
rank within each bucket) and cuts every curve into blocks of ``BLOCK`` ranks.  A
query looks, on each curve, at the ranks within a window around its own place:
it is sent to the blocks that the window meets, and each block returns its best
``k + 1`` by exact inner product.  The curves' hits are merged and reranked.

The window is measured, not guessed: for a bounded sample of queries the true
neighbours are found by a scan of all vectors, and the window is the distance in
ranks, on the best curve, within which ``RECALL`` of them lie.  Data that has
structure gets narrow windows; data without any needs wide ones.

For the largest inner product, candidates get one more dimension
sqrt(M^2 - |x|^2), M the largest norm, and queries are scaled to norm M with 0
there, which turns it into nearness; scores use the original vectors.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, rows without an id, and vectors of another length than most, take no
part; with fewer candidates than ``k``, all that are found are returned; equal
scores go to the smaller id; repeated rows of an id count once; an empty table
gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .frames import ship_package

CURVES, DIMS, BITS = 16, 4, 10
BLOCK = 4096
#: A curve's keys are ranked in up to so many buckets of equal size.
MOST_BUCKETS = 1000
#: Queries whose true neighbours set the window, and vectors that set the projections' scale.
SAMPLE_QUERIES, SAMPLE_VECTORS = 96, 2000
RECALL = 0.97
HIT = "q bigint, c bigint, score double"


def clean(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part; components of integers or decimals as double."""
    v = F.col(vec_col)
    kind = rows.schema[vec_col].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    r = rows.where(F.col(id_col).isNotNull() & v.isNotNull() & fine) \
        .select(F.col(id_col).cast("bigint").alias("id"), F.transform(v, lambda x: x.cast(kind) + F.lit(0.0).cast(kind)).alias("vec"))
    sizes = r.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return r.where(F.size("vec") == (sizes[0].d if sizes else 0))


def classes(r: DataFrame, is_query, k: int) -> DataFrame:
    """(cls: smallest id, vec, ids: the k + 1 smallest, asks: has a query, norm2)."""
    r = r.withColumn("same", F.xxhash64("vec"))
    few = r.select("same", "id").distinct() \
        .withColumn("n", F.row_number().over(Window.partitionBy("same").orderBy("id"))).where(F.col("n") <= k + 1) \
        .groupBy("same").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    one = r.groupBy("same").agg(F.min("id").alias("cls"), F.max(is_query).alias("asks"))
    vec = r.join(one.select(F.col("same"), F.col("cls").alias("id"), "asks"), ["same", "id"]).dropDuplicates(["same"])
    norm2 = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return vec.join(few, "same").select(F.col("id").alias("cls"), "vec", "ids", "asks", norm2.alias("norm2"))


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer cells [n, dims] (Skilling, 2004)."""
    x = cells.T.astype(np.uint64)
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint64(q - 1)
        for i in range(len(x)):
            hit = (x[i] & np.uint64(q)) > 0
            t = np.where(hit, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(hit, p, t)
            x[i] ^= t
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & np.uint64(q)) > 0, t ^ np.uint64(q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(len(x)):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key.astype(np.int64)


class Curves:
    """Projections, scales and shifts of all curves, from a sample of vectors."""

    def __init__(self, sample: np.ndarray, top: float, curves: int = CURVES, dims: int = DIMS, seed: int = 17):
        r, d = np.random.default_rng(seed), sample.shape[1] + 1
        self.top, self.dims, axes = top, dims, []
        while sum(a.shape[1] for a in axes) < curves * dims:
            a = np.linalg.qr(r.normal(size=(d, d)))[0]
            axes.append(a[:, : max(dims, d // dims * dims)] if d >= dims else r.normal(size=(d, dims)))
        self.axes = np.concatenate(axes, 1)[:, : curves * dims]
        y = self.lift(sample, False) @ self.axes
        self.mean, self.scale = y.mean(0), 1.7 / (y.std(0) + 1e-12)
        self.shift = r.random(curves * dims)

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        norm2 = (x * x).sum(1, keepdims=True)
        if query:
            return np.hstack([x * (self.top / np.sqrt(norm2)), np.zeros_like(norm2)])
        return np.hstack([x, np.sqrt(np.maximum(0, self.top ** 2 - norm2))])

    def keys(self, x: np.ndarray, query: bool) -> np.ndarray:
        """[vectors, curves]"""
        u = 1 / (1 + np.exp(-np.clip((self.lift(x, query) @ self.axes - self.mean) * self.scale, -30, 30)))
        cells = np.minimum(((u + self.shift) / 2 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
        return np.stack([hilbert(cells[:, a: a + self.dims], BITS) for a in range(0, cells.shape[1], self.dims)], 1)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def ranked(cls: DataFrame, curves: Curves) -> DataFrame:
    """(curve, cls, place, query): candidates by rank; queries by the number of
    candidates before them."""
    held = cls.sparkSession.sparkContext.broadcast(curves)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x, asks = batch.column(0).to_numpy(), _matrix(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False)
            for query in (False, True):
                some = asks if query else np.ones(len(ids), bool)
                if some.any():
                    keys = held.value.keys(x[some], query)
                    n, m = keys.shape
                    yield pa.RecordBatch.from_pydict({"curve": np.tile(np.arange(m, dtype=np.int32), n), "key": keys.ravel(),
                                                      "cls": np.repeat(ids[some], m), "query": np.full(n * m, query)})

    keys = reliable_checkpoint(cls.select("cls", "vec", "asks").mapInArrow(task, "curve int, key bigint, cls bigint, query boolean"))
    n = cls.count()
    buckets = min(MOST_BUCKETS, max(1, n // BLOCK))
    cuts = [i / buckets for i in range(1, buckets)]
    bounds = keys.where(~F.col("query")).groupBy("curve").agg(F.percentile_approx("key", cuts or [0.5], 10000).alias("bounds"))
    placed = keys.join(F.broadcast(bounds), "curve").withColumn("bucket", F.size(F.filter("bounds", lambda b: b < F.col("key")))).drop("bounds")
    mine = (~F.col("query")).cast("bigint")
    before = placed.groupBy("curve", "bucket").agg(F.sum(mine).alias("own")) \
        .withColumn("start", F.sum("own").over(Window.partitionBy("curve").orderBy("bucket")) - F.col("own")).select("curve", "bucket", "start")
    within = Window.partitionBy("curve", "bucket").orderBy("key", "cls", "query").rowsBetween(Window.unboundedPreceding, 0)
    r = placed.withColumn("upto", F.sum(mine).over(within)).join(F.broadcast(before), ["curve", "bucket"])
    return reliable_checkpoint(r.select("curve", "cls", "query", (F.col("start") + F.col("upto") - mine).alias("place")))


def best(q_ids, q, c_ids, c, k: int, seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best of ``c`` by inner product (``seen``: which count),
    equal scores to the smaller id; scores summed in one fixed way."""
    dots = q @ c.T
    if seen is not None:
        dots = np.where(seen, dots, -np.inf)
    out_q, out_c, out_s = [], [], []
    for i in range(len(q)):
        row = dots[i]
        if len(row) > k:
            kth = np.partition(row, len(row) - k)[len(row) - k]
            at = np.flatnonzero(row >= kth - 1e-9 * (1 + abs(kth))) if np.isfinite(kth) else np.flatnonzero(np.isfinite(row))
        else:
            at = np.flatnonzero(np.isfinite(row))
        s = (q[i] * c[at]).sum(1)
        top = np.lexsort((c_ids[at], -s))[:k]
        out_q.append(np.full(len(top), q_ids[i]))
        out_c.append(c_ids[at][top])
        out_s.append(s[top])
    return tuple(np.concatenate(x) if x else np.empty(0) for x in (out_q, out_c, out_s))


def _hits(found) -> pa.Table:
    q, c, s = found
    return pa.table({"q": pa.array(q.astype(np.int64)), "c": pa.array(c.astype(np.int64)), "score": pa.array(s.astype(float))})


def brute_force(cls: DataFrame, queries: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    """(q, c, score): the k best classes of a bounded set of queries, by a scan
    of all of them; each batch sends its own k best."""
    held = cls.sparkSession.sparkContext.broadcast((np.array([i for i, _ in queries]), np.stack([x for _, x in queries])))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = held.value
        for batch in batches:
            yield from _hits(best(ids, q, batch.column(0).to_numpy(), _matrix(batch.column(1)), k)).to_batches()

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "c"))
    return cls.select("cls", "vec").mapInArrow(task, HIT).withColumn("n", rank).where(F.col("n") <= k).drop("n")


def measured_window(cls: DataFrame, places: DataFrame, k: int, recall: float) -> int:
    """Ranks to each side within which, on the best curve, ``recall`` of the
    sample's true neighbours lie."""
    n = cls.where("asks").count()
    share = F.pmod(F.xxhash64(F.lit(5), "cls"), F.lit(1_000_003)) / 1_000_003.0 < min(1.0, SAMPLE_QUERIES / max(1, n))
    picked = cls.where(F.col("asks") & share).select("cls", "vec").orderBy("cls").limit(2 * SAMPLE_QUERIES).collect()
    if not picked:
        picked = cls.where("asks").select("cls", "vec").orderBy("cls").limit(SAMPLE_QUERIES).collect()
    true = brute_force(cls, [(r.cls, np.array(r.vec, float)) for r in picked], k + 1).where(F.col("q") != F.col("c"))
    true = reliable_checkpoint(true)
    q = places.where("query").select("curve", F.col("cls").alias("q"), F.col("place").alias("q_place"))
    c = places.where(~F.col("query")).select("curve", F.col("cls").alias("c"), F.col("place").alias("c_place"))
    near = q.join(F.broadcast(true), "q").join(c, ["curve", "c"]).groupBy("q", "c").agg(F.min(F.abs(F.col("q_place") - F.col("c_place"))).alias("far"))
    got = near.agg(F.expr(f"percentile(far, {recall})").alias("w")).first().w
    return int(got or 0) + 2 * (k + 1)


def search(rows: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, curves: int = CURVES,
           dims: int = DIMS, recall: float = RECALL, window: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the rows where ``is_query`` (a function of
    the id column) holds, against all other rows."""
    ship_package(rows.sparkSession)
    r = clean(rows, id_col, vec_col)
    cls = reliable_checkpoint(classes(r, is_query(F.col("id")), k))
    top = cls.agg(F.max("norm2")).first()[0]
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if top is None:
        return rows.sparkSession.createDataFrame([], schema)
    sample = cls.orderBy(F.xxhash64(F.lit(9), "cls")).limit(SAMPLE_VECTORS).select("vec").collect()
    index = Curves(np.array([x.vec for x in sample], float), float(np.sqrt(top)), curves, dims)
    places = ranked(cls, index)
    w = measured_window(cls, places, k, recall) if window is None else window

    vec = cls.select("cls", "vec")
    own = places.where(~F.col("query")).withColumn("block", F.floor(F.col("place") / BLOCK)).join(vec, "cls") \
        .select("curve", "block", "place", "cls", "vec")
    last = places.where(~F.col("query")).groupBy("curve").agg(F.floor(F.max("place") / BLOCK).alias("last"))
    asks = places.where("query").join(F.broadcast(last), "curve") \
        .withColumn("block", F.explode(F.sequence(F.greatest(F.floor((F.col("place") - w) / BLOCK), F.lit(0).cast("bigint")),
                                                  F.least(F.floor((F.col("place") + w) / BLOCK), F.col("last"))))) \
        .join(vec, "cls").select(*[F.col(x).alias(f"q_{x}") for x in ("curve", "block", "place", "cls", "vec")])

    def block(queries: pa.Table, cands: pa.Table) -> pa.Table:
        if not queries.num_rows or not cands.num_rows:
            return _hits((np.empty(0),) * 3)
        c, c_ids, c_at = _matrix(cands.column("vec")), cands.column("cls").to_numpy(), cands.column("place").to_numpy()
        parts = []
        for a in range(0, queries.num_rows, 512):
            part = queries.slice(a, 512)
            seen = np.abs(part.column("q_place").to_numpy()[:, None] - c_at) <= w
            parts.append(_hits(best(part.column("q_cls").to_numpy(), _matrix(part.column("q_vec")), c_ids, c, k + 1, seen)))
        return pa.concat_tables(parts)

    hits = asks.groupBy("q_curve", "q_block").cogroup(own.groupBy("curve", "block")).applyInArrow(block, HIT)
    self_hits = cls.where("asks").select(F.col("cls").alias("q"), F.col("cls").alias("c"), F.aggregate(
        "vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")).alias("score"))
    merged = hits.unionByName(self_hits).groupBy("q", "c").agg(F.max("score").alias("score"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    merged = merged.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n")
    one = merged.join(cls.select(F.col("cls").alias("c"), "ids"), "c").select("q", "score", F.explode("ids").alias("vec_id"))
    one = one.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("n") <= k + 1)
    asked = r.where(is_query(F.col("id"))).withColumn("same", F.xxhash64("vec")).select("same", F.col("id").alias("query_id")).distinct()
    key = cls.where("asks").select(F.xxhash64("vec").alias("same"), F.col("cls").alias("q"))
    done = asked.join(key, "same").join(one, "q").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return done.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, lambda i: F.pmod(i, F.lit(20)) == 0)
