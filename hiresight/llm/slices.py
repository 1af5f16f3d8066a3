"""Operator 11, exact top-k search by largest integer inner product over a
bit-sliced index.

Every component is quantised to an integer, floor(scale * x).  Candidates are
dealt into blocks of about ``BLOCK`` rows by a hash; a block keeps, for each
dimension and each bit, one bitmap over its rows (an attribute's slices).  The
index is written once to the shared folder.

A query's score of all rows of a block comes from bitmap arithmetic alone: each
query component is a sum of signed powers of two, so the score is a sum of
shifted slices (complemented ones where the sign is minus), added column by column
with carry-save adders; a constant per query and block makes up for offsets and
complements.  The sum is itself bit-sliced.  The best rows are then chosen from
its most significant slice downward: rows that are surely in, rows still equal
to the boundary.  Boundary rows that remain after the last slice have exactly
the same score and go by smaller id.

A task takes one block and at most about ``GROUP`` queries; the blocks' hits are
merged by rank.  The work is queries times rows, as the search is exact and the
query set is a share of the table; nothing else grows with it.

Defined cases: rows without an id, vectors that are null, empty, hold null or
non-finite components, or have another length than most, take no part, nor do
vectors with a scaled component so large that a score could leave 64 bits (for 64
dimensions: 2^26).  Zero vectors do.  Equal rows (id and quantised vector) count
once; an id with several vectors keeps all: each is a candidate, and each a query
against all rows of other ids.  Fewer candidates than ``k`` are all returned; ties go to the smaller id.
An empty table or one without queries gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import ship_package, written

BLOCK, GROUP = 12_288, 512
INDEX = "block int, dim int, low bigint, data binary"
HIT = "q bigint, v bigint, c bigint, score bigint"
RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"


def quantised(rows: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, x: array<int>) of the rows that take part, each once."""
    v = F.col(vec_col)
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    r = rows.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine) \
        .select(F.col(id_col).cast("bigint").alias("id"), F.transform(v, lambda c: c.cast("double") * F.lit(float(scale))).alias("v"))
    sizes = r.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = sizes[0].d if sizes else 1
    most = float(1 << (59 - (d - 1).bit_length()) // 2)
    r = r.where((F.size("v") == d) & F.forall("v", lambda c: F.abs(c) < most))
    return r.select("id", F.transform("v", lambda c: F.floor(c).cast("int")).alias("x")).dropDuplicates(["id", "x"])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def sliced(ids: np.ndarray, x: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(dim, least value, its slices from bit 0 up) of a block, rows by id; dim -1
    has the ids."""
    order = np.argsort(ids, kind="stable")
    x, out = x[order], [(-1, len(ids), ids[order].astype("<i8").tobytes())]
    pad = -len(ids) % 64
    for d in range(x.shape[1]):
        u = x[:, d] - x[:, d].min()
        bits = np.arange(int(u.max()).bit_length(), dtype=np.int64)[:, None]
        planes = np.pad(((u >> bits) & 1).astype(np.uint8), ((0, 0), (0, pad)))
        out.append((d, int(x[:, d].min()), np.packbits(planes, axis=1, bitorder="little").tobytes()))
    return out


def add_slices(table: np.ndarray, at: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Slices of the sum of ``table[at] << weight``: carry-save adders take three
    bitmaps of a weight to one, and one of the next."""
    order, counts = np.argsort(weight, kind="stable"), np.bincount(weight) if len(weight) else np.zeros(0, int)
    ends, at, out, carries = np.cumsum(counts), at[order], [], []
    while len(out) < len(counts) or carries:
        w, stack = len(out), carries
        if w < len(counts) and counts[w]:
            stack = [*stack, table[at[ends[w] - counts[w]: ends[w]]]]
        now = np.concatenate(stack) if stack else np.zeros((1, table.shape[1]), table.dtype)
        carries = []
        while len(now) > 2:
            t = len(now) // 3
            a, b, c = now[:t], now[t: 2 * t], now[2 * t: 3 * t]
            ab = a ^ b
            carries.append((a & b) | (ab & c))
            now = np.concatenate([ab ^ c, now[3 * t:]])
        if len(now) == 2:
            carries.append(now[:1] & now[1:])
            now = now[:1] ^ now[1:]
        out.append(now[0])
    return out


def top_rows(slices: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest of ``rows`` (a bitmap), equal ones by place."""
    places = lambda m: np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little"))
    size = lambda m: int(np.bitwise_count(m).sum())
    sure, even, n = np.zeros_like(rows), rows, 0
    if size(rows) <= k:
        return places(rows)
    for s in reversed(slices):
        ones = even & s
        m = size(ones)
        if n + m > k:
            even = ones
        else:
            sure, even, n = sure | ones, even & ~s, n + m
            if n == k:
                return places(sure)
    return np.concatenate([places(sure), places(even)[: k - n]])


class Block:
    """A block's slices in memory, and their complements."""

    def __init__(self, index: pa.Table):
        parts = sorted(zip(index.column("dim").to_pylist(), index.column("low").to_pylist(), index.column("data").to_pylist()))
        self.ids = np.frombuffer(parts[0][2], "<i8")
        words = -(-len(self.ids) // 64)
        planes = [np.frombuffer(data, "<u8").reshape(-1, words) for _, _, data in parts[1:]]
        self.low, self.bits = np.array([p[1] for p in parts[1:]]), np.array([len(p) for p in planes])
        self.first, own = np.cumsum(self.bits) - self.bits, np.concatenate(planes)
        self.count, self.table = len(own), np.concatenate([own, ~own])
        self.all = np.packbits(np.arange(words * 64) < len(self.ids), bitorder="little").view("<u8")

    def scores(self, q: np.ndarray) -> tuple[list[np.ndarray], int]:
        """The slices of all rows' scores, and what is to be added to each."""
        a = np.abs(q)
        plus, minus = (a + (a >> 1)) & ~(a >> 1), (a >> 1) & ~(a + (a >> 1))      # signed digits, no two neighbours
        plus, minus = np.where(q < 0, minus, plus), np.where(q < 0, plus, minus)
        shift = np.arange(int(max(plus.max(), minus.max())).bit_length())
        dims, js, neg = [], [], []
        for sign, digits in ((0, plus), (1, minus)):
            d, j = np.nonzero((digits[:, None] >> shift) & 1)
            dims.append(d), js.append(j), neg.append(np.full(len(d), sign))
        d, j, neg = np.concatenate(dims), np.concatenate(js), np.concatenate(neg)
        reps = self.bits[d]
        bit = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        at = np.repeat(self.first[d] + neg * self.count, reps) + bit
        rest = int((q * self.low).sum()) - int((neg * ((1 << self.bits[d]) - 1) << j).sum())
        return add_slices(self.table, at, np.repeat(j, reps) + bit), rest

    def best(self, query: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows but the query's own."""
        slices, rest = self.scores(q)
        rows = self.all
        for p in range(*np.searchsorted(self.ids, [query, query + 1])):
            rows = rows.copy() if rows is self.all else rows
            rows[p >> 6] &= ~np.uint64(1 << (p & 63))
        at = top_rows(slices, rows, k)
        score = np.full(len(at), rest)
        for i, s in enumerate(slices):
            score += ((s[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << i
        return self.ids[at], score


def search(rows: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, scale: int = 64,
           block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id, score of the rows where ``is_query`` (a function of
    the id column) holds, against all other rows."""
    spark = rows.sparkSession
    ship_package(spark)
    r = written(quantised(rows, id_col, vec_col, scale), "slices-rows")
    asks: Column = is_query(F.col("id"))
    n, n_asks = r.agg(F.count("*"), F.count(F.when(asks, 1))).first()
    if not n_asks:
        return spark.createDataFrame([], RESULT)
    blocks, groups = -(-n // block), -(-n_asks // group)
    dealt = F.xxhash64(F.lit(3), "id", "x")

    def build(t: pa.Table) -> pa.Table:
        parts = sliced(t.column("id").to_numpy(), _matrix(t.column("x")))
        number = t.column("block")[0].as_py()
        return pa.table([pa.array([number] * len(parts), pa.int32()), pa.array([p[0] for p in parts], pa.int32()),
                         pa.array([p[1] for p in parts], pa.int64()), pa.array([p[2] for p in parts], pa.binary())],
                        names=["block", "dim", "low", "data"])

    index = written(r.withColumn("block", F.pmod(dealt, F.lit(blocks)).cast("int")).groupBy("block").applyInArrow(build, INDEX), "slices-index")
    each_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    queries = r.where(asks).withColumn("v", F.xxhash64(F.lit(4), "id", "x")) \
        .withColumn("q_group", F.pmod("v", F.lit(groups)).cast("int")).withColumn("q_block", each_block)

    def answer(ask: pa.Table, held: pa.Table) -> pa.Table:
        out = [(np.empty(0, np.int64),) * 4]
        if ask.num_rows and held.num_rows:
            b = Block(held)
            for query, v, q in zip(ask.column("id").to_pylist(), ask.column("v").to_pylist(), _matrix(ask.column("x"))):
                ids, score = b.best(query, q, k)
                out.append((np.full(len(ids), query), np.full(len(ids), v), ids, score))
        return pa.table(dict(zip(("q", "v", "c", "score"), (np.concatenate(x) for x in zip(*out)))))

    hits = queries.groupBy("q_block", "q_group").cogroup(index.withColumn("group", each_group).groupBy("block", "group")).applyInArrow(answer, HIT)
    rank = F.row_number().over(Window.partitionBy("q", "v").orderBy(F.desc("score"), "c"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k) \
        .select(F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("c").alias("vec_id"), "score")


def top_scores(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, lambda i: F.pmod(i, F.lit(20)) == 0)
