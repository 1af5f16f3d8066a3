"""Operator 13, a Merkle manifest of a dataset with incremental witnesses.

Every row is a leaf: the SHA-256 of its encoded columns.  Per source, leaves
ascend by id and form a tree in which runs of ``FAN`` nodes have one parent (a
shorter last run, even of one node, too); the roots of the sources' trees, by
source, are the leaves of one more tree.

Leaves are hashed natively in one pass over the table and numbered within their
source: a range shuffle, then counts per range and running sums, so a source
of any size is spread over tasks.  Aligned blocks of ``FAN ** LEVELS``
consecutive leaves are appended one leaf after the other by ``Appender``: a leaf
gets an empty witness; when a run is complete, the siblings are added to the
witnesses of all leaves below it, and the run's digest is an append to the level
above.  A block's root is an append to the next stage's blocks, and so on until
each tree is one node.  Going down again, each block's leaves are appended a
second time, with witnesses, and the block's own witness follows theirs; so no
proof is kept or shuffled but those of block roots.

A proof is an array of (place in the run, digests of the run's other nodes), from the
leaf's level up to the root.  ``folded`` recomputes the root from a leaf and a proof.

Defined cases: nulls are encoded as ``-`` in every column; rows without an id come
first in their source; rows of one id are ordered by leaf, and equal rows are
leaves of their own; the null source comes first; a source of one row has its leaf as
root; one source alone has its root as the root of all; an empty table gives an
empty result; empty and very long texts need nothing special; further columns
are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import ship_package, written

FAN, LEVELS = 16, 3
BLOCK = FAN ** LEVELS
#: Witnesses sent to Spark at once.
BATCH = 512
PROOF = "array<struct<at: int, rest: string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(c: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(*columns: Column) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in columns]).cast("binary"), 256)


def folded(proof: Column, start: Column) -> Column:
    """The root that ``proof`` leads to from the leaf ``start``."""
    def step(h: Column, p: Column) -> Column:
        cut = p["at"] * 64
        return F.sha2(F.concat(F.substr(p["rest"], F.lit(1), cut), h, F.substr(p["rest"], cut + 1)).cast("binary"), 256)
    return F.aggregate(proof, start, step)


def witness_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda p: p["rest"]), "").cast("binary"), 256)


class Appender:
    """Appends to one aligned block.  ``open`` has the unfinished run of each level:
    its nodes' digests, each with the witnesses of the leaves below it."""

    def __init__(self, levels: int):
        self.levels, self.open = levels, [[] for _ in range(levels + 1)]

    def append(self, digest: bytes, witness: list | None = None) -> None:
        self._put(0, digest, [] if witness is None else [witness])

    def _put(self, level: int, digest: bytes, witnesses: list) -> None:
        self.open[level].append((digest, witnesses))
        if level < self.levels and len(self.open[level]) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        joined = b"".join(d for d, _ in run)
        for i, (_, witnesses) in enumerate(run):
            if witnesses:
                piece = {"at": i, "rest": joined[: 64 * i] + joined[64 * i + 64:]}
                for w in witnesses:
                    w.append(piece)
        self._put(level + 1, hashlib.sha256(joined).hexdigest().encode(), [w for _, ws in run for w in ws])

    def root(self) -> bytes:
        """Completes the short runs at the end and gives the block's root."""
        for level in range(self.levels):
            if self.open[level]:
                self._complete(level)
        return self.open[self.levels][0][0]


def levels_of(n: int) -> int:
    """Levels of a block of a tree that has ``n`` nodes in this stage."""
    levels = 0
    while levels < LEVELS and FAN ** levels < n:
        levels += 1
    return levels


def numbered(df: DataFrame, by: str, order: list[str]) -> DataFrame:
    """Adds ``pos``, the place of a row among those with its ``by``, from 0, and ``n``,
    their number.  Equal rows are told apart by a salt, so they spread too."""
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    ranged = written(salted.repartitionByRange(by, *order, "_salt").withColumn("_part", F.spark_partition_id()), "merkle-ranges")
    counts = ranged.groupBy(by, "_part").agg(F.count("*").alias("_own"))
    upto = Window.partitionBy(by).orderBy("_part")
    start = counts.select(by, "_part", (F.sum("_own").over(upto) - F.col("_own")).alias("_start"), F.sum("_own").over(Window.partitionBy(by)).alias("n"))
    within = F.row_number().over(Window.partitionBy(by, "_part").orderBy(*order, "_salt"))
    return ranged.withColumn("_row", within).join(start, [by, "_part"]) \
        .withColumn("pos", F.col("_start") + F.col("_row") - 1).drop("_salt", "_part", "_row", "_start", "_own")


def block_roots(nodes: DataFrame) -> DataFrame:
    """The nodes (tree, pos, n, node) of the next stage."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block, out = None, None, []

        def put(until: int) -> Iterator[pa.RecordBatch]:
            if len(out) > until:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out.clear()

        schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("node", pa.string())])
        for batch in batches:
            for tree, pos, n, node in zip(*(batch.column(c).to_pylist() for c in ("tree", "pos", "n", "node"))):
                if (tree, pos // BLOCK) != now:
                    if block:
                        out.append({"tree": now[0], "pos": now[1], "n": size, "node": block.root().decode()})
                        yield from put(4096)
                    now, block, size = (tree, pos // BLOCK), Appender(levels_of(n)), -(-n // BLOCK)
                block.append(node.encode())
        if block:
            out.append({"tree": now[0], "pos": now[1], "n": size, "node": block.root().decode()})
        yield from put(0)

    rows = nodes.select("tree", "pos", "n", "node", F.floor(F.col("pos") / BLOCK).alias("block"))
    rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    return rows.mapInArrow(task, "tree string, pos bigint, n bigint, node string")


def with_proofs(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``nodes`` (tree, pos, n, node and more), each with its ``proof`` and its block's
    ``subroot`` and ``root``; ``above``: (tree, pos, proof, subroot, root) of the blocks."""
    kept = [c for c in nodes.columns if c not in ("n",)]
    fields = [*[(c, nodes.schema[c].dataType.simpleString()) for c in kept], ("proof", PROOF), ("subroot", "string"), ("root", "string")]
    out_type = pa.struct([("at", pa.int32()), ("rest", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block, upper, held = None, None, None, []   # held: (batch, row, witness) of the open block

        def flush() -> Iterator[pa.RecordBatch]:
            if block and held:
                block.root()
            for a in range(0, len(held), BATCH):
                part = held[a: a + BATCH]
                cols = {c: [h[0][c][h[1]] for h in part] for c in kept}
                proofs = [[{"at": p["at"], "rest": p["rest"].decode()} for p in h[2]] + upper["proof"] for h in part]
                arrays = [pa.array(cols[c], types[c]) for c in kept]
                arrays += [pa.array(proofs, pa.list_(out_type))]
                arrays += [pa.array([upper[c]] * len(part), pa.string()) for c in ("subroot", "root")]
                yield pa.RecordBatch.from_arrays(arrays, names=[f for f, _ in fields])
            held.clear()

        for batch in batches:
            types = {c: batch.schema.field(c).type for c in kept}
            rows = {c: batch.column(c).to_pylist() for c in (*kept, "n", "block", "_first")}
            for i in range(batch.num_rows):
                if rows["_first"][i]:
                    yield from flush()
                    upper = {c: batch.column(c)[i].as_py() for c in ("proof", "subroot", "root")}
                    now, block = None, None
                    continue
                if now is None:
                    now, block = (rows["tree"][i], rows["block"][i]), Appender(levels_of(rows["n"][i]))
                witness: list = []
                block.append(rows["node"][i].encode(), witness)
                held.append((rows, i, witness))
        yield from flush()

    leaves = nodes.select(*kept, "n", F.floor(F.col("pos") / BLOCK).alias("block"), F.lit(False).alias("_first"),
                          *[F.lit(None).cast(t).alias(c) for c, t in fields[len(kept):]])
    tops = above.select(*[(F.lit(-1).cast("bigint") if c == "pos" else F.col(c) if c == "tree" else F.lit(None).cast(t)).alias(c) for c, t in fields[: len(kept)]],
                        F.lit(None).cast("bigint").alias("n"), F.col("pos").alias("block"), F.lit(True).alias("_first"), "proof", "subroot", "root")
    both = leaves.unionByName(tops).repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    return both.mapInArrow(task, ", ".join(f"`{c}` {t}" for c, t in fields))


def climbed(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of every stage, from the leaves (given) to one node a tree."""
    stages, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        stages.append(written(block_roots(stages[-1]), "merkle-roots"))
        most = -(-most // BLOCK)
    return stages


def descended(stages: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves with their proofs; ``above``: (tree, pos 0, proof, subroot, root) of the trees."""
    for nodes in reversed(stages[1:]):
        above = written(with_proofs(nodes, above).select("tree", "pos", "proof", "subroot", "root"), "merkle-witnesses")
    return with_proofs(stages[0], above)


def manifest(leaves: DataFrame, id_col: str, source_col: str, leaf_col: str = "leaf") -> DataFrame:
    """``leaves`` with ``proof``, ``subroot`` and ``root``.  The source's column
    becomes ``tree``: ``=`` and the source, or nothing for the null source."""
    ship_package(leaves.sparkSession)
    tree = F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit(""))
    rest = [c for c in leaves.columns if c not in (source_col, leaf_col)]
    rows = leaves.select(tree.alias("tree"), F.col(leaf_col).alias("node"), *rest)
    stages = climbed(written(numbered(rows, "tree", [id_col, "node"]), "merkle-leaves"))
    sources = stages[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "node")
    tops = climbed(written(numbered(sources, "tree", ["source"]), "merkle-sources"))
    top = tops[-1].select("tree", "pos", F.array().cast(PROOF).alias("proof"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    above = descended(tops, top).select(F.col("source").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "proof", F.col("node").alias("subroot"), "root")
    return descended(stages, written(above, "merkle-witnesses"))


def documents_manifest(docs: DataFrame, tampered: Column | None = None, text: Column | None = None) -> DataFrame:
    """doc_id, tree, pos, node (the leaf), changed (the leaf after tampering with the
    text, where ``tampered``), proof, subroot, root."""
    columns = [F.col(c) for c in FIELDS]
    changed = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf(*columns[:-1], text))
    leaves = docs.select("doc_id", "source", leaf(*columns).alias("leaf"), changed.alias("changed"))
    return manifest(written(leaves, "merkle-hashes"), "doc_id", "source")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def verification(docs: DataFrame) -> DataFrame:
    """The query's columns: a fifth of the documents is tampered with and must fail
    if their leaf differs."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    m = documents_manifest(docs, hit, F.translate("text", UPPER, LOWER))
    m = m.withColumn("folded_root", folded(F.col("proof"), F.coalesce("changed", "node")))
    return m.select("doc_id", F.col("node").alias("leaf"), "subroot", "root", witness_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified"))
