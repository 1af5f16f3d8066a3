"""Operator 7, n-gram Jaccard join: which texts share so many word shingles that
100 * intersection >= percent * union, and the components of those links.

1.  Each text becomes its sorted array of distinct shingle hashes; texts with
    equal arrays are one class, represented by a fingerprint of the array.
2.  Tiles of candidates.  Sizes fall into bands; within a band's reach two linked
    arrays differ in at most D hashes, so of D + 1 partitions of the hash range
    at least one is equal in both.  Every class puts down one key per partition
    that isn't empty (more partitions make up for the empty ones);
    classes that share a key are chained through the key's least class (one edge
    per class, never all pairs).  The components of that chain hold every link.
3.  Below ``PARTITIONS_FROM`` percent, keys chain many texts that only share a line
    or common shingles: most of a large table would be one component, to be met by
    all pairs.  There keys are the shingles of the rarest words, and only the classes
    that share a key meet, with bitmap signatures alone (a twentieth of their arrays),
    each different set of such classes once: pairs whose bound allows a link are
    chained, and the components hold every link still; classes without such a partner go.
4.  Inside such a component, classes go into blocks by size band and hash, of
    bounded bytes, and pairs of blocks of equal or neighbouring bands are tiles.
    In a tile, hashed bitmap signatures bound each overlap from above: every bit
    that differs stands for an element that differs.  Pairs that pass are
    settled by the exact intersection of the sorted arrays, unless already
    connected.  A tile returns a spanning forest of its links, not the links.
5.  The components of the forests are the result.

Nothing grows with the square of a group of copies, no group is held whole in a
task, and no link between different arrays is lost.

Defined cases: a null or wordless text has no shingles and links with nothing;
fewer than ``k`` words are one shingle; rows with one id are one document, so
that its texts are linked; rows without an id take no part and have no component; an empty table gives an empty
result; texts may be of any length; 64-bit hashes stand for shingles and sets.
"""
from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .frames import hash_share, ship_package, written
from .graph import components
from .textkit import as_long, each_text, mix64, set_fingerprint, shingle_hashes, word_hashes, words

K = 3
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 90
#: From this threshold on, candidates come from equal partitions, below from rare
#: prefixes (partitions would hold too few hashes to tell classes apart).
PARTITIONS_FROM = 88
#: Whole texts whose repeated shingles count as common ones; this orders the
#: prefixes and can't change a result.
SAMPLE_DOCS, COMMON_SHINGLES = 8000, 200_000
#: A block's arrays take at most about this many bytes, and so many arrays.
BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 4096
#: Candidate ids (16 bytes each) and tile places are broadcast up to this many rows.
BROADCAST_ROWS = 500_000
#: Keys leave a task in batches of about this many rows.
KEY_ROWS = 100_000


def shingle_set(text: bytes | None, k: int = K) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    return np.unique(shingle_hashes(words(text), k))


def least_overlap(x, y, percent: int = PERCENT):
    """Smallest intersection that links sets of sizes x and y (any integers or arrays)."""
    return -(-percent * (x + y) // (100 + percent))


@functools.lru_cache
def _size_bands(percent: int, top: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """Lower ends of the size bands up to ``top``, and their numbers of partitions."""
    low = [1]
    while low[-1] <= top:
        low.append(low[-1] * 1000 // 729 + 1)
    low = np.array(low, np.int64)
    high = np.append(low[1:] - 1, low[-1] * 2)
    return low, (100 - percent) * (high + high * 100 // percent) // (100 + percent) + 1


def prefix_keys(h: np.ndarray, percent: int, common: np.ndarray, score: np.ndarray | None = None) -> np.ndarray:
    """The first hashes of a sorted array, rare ones before common ones: linked
    arrays have one of them in common.  ``score``: of each hash, the same wherever
    it occurs; hashes of low scores come first among rare and among common ones."""
    if not len(h):
        return np.empty(0, np.int64)
    if score is not None:
        h = h[np.argsort(score, kind="stable")]
    at = np.minimum(np.searchsorted(common, h), max(0, len(common) - 1))
    often = common[at] == h if len(common) else np.zeros(len(h), bool)
    return as_long(np.concatenate([h[~often], h[often]])[: len(h) - (-(-percent * len(h) // 100)) + 1])


def scored_shingles(text: bytes | None, k: int, seen: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of a text's shingles, and of each the sum of its words'
    weights (``seen``: sorted hashes of the words that have any)."""
    ws = words(text)
    h, first = np.unique(shingle_hashes(ws, k), return_index=True)
    if not len(seen) or len(ws) <= k:
        return h, np.zeros(len(h), np.int64)
    w = word_hashes(ws)
    at = np.minimum(np.searchsorted(seen, w), len(seen) - 1)
    run = np.zeros(len(w) + 1, np.int64)
    np.cumsum(np.where(seen[at] == w, weights[at], 0), out=run[1:])
    return h, (run[k:] - run[:-k])[first]


#: Partitions beyond the least number, tried in turn.
SPARE_PARTITIONS = (0, *(4 ** i for i in range(1, 12)))


def partition_keys(h: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of a sorted array, for its own size band and for that of its smallest
    possible partner.  Empty partitions give no key, since they are equal in
    unrelated arrays too: an array goes on to divisions with more spare partitions
    until it has no more empty ones than spare ones.  Where the first of two linked
    arrays stops, both have keys, and D differing and the empty partitions are fewer
    than all: an equal one remains that isn't empty."""
    low, many = _size_bands(percent)
    n = len(h)
    if n < 2:
        return np.empty(0, np.int64)
    own = int(np.searchsorted(low, n, "right")) - 1
    least = int(np.searchsorted(low, -(-percent * n // 100), "right")) - 1
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(mix64(h), out=run[1:])
        out = []
        for band in range(least, own + 1):
            if many[band] == 1:
                continue  # linked arrays would be equal, that is one class
            for spare in SPARE_PARTITIONS:
                parts = int(many[band]) + spare
                part = ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                cut = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
                full = np.flatnonzero(cut[1:] > cut[:-1])
                tag = mix64(full.astype(np.uint64) + np.uint64((band << 48) + (spare << 24)))
                out.append(mix64((run[cut[full + 1]] - run[cut[full]]) ^ tag))
                if parts - len(full) <= spare:
                    break
            else:  # never met by hashes; the first division with its empty partitions loses nothing
                out.append(mix64(np.arange(int(many[band]), dtype=np.uint64) + np.uint64((band << 48) + (1 << 47))))
    return as_long(np.concatenate(out)) if out else np.empty(0, np.int64)


def with_sets(docs: DataFrame, id_col: str, text_col: str, k: int, signed: bool = False) -> DataFrame:
    """doc_id, n (set size), fp (fingerprint of the set), and if ``signed`` its signature as set."""
    fields = [("n", pa.int64()), ("fp", pa.int64()), *[("set", pa.binary())] * signed]

    @F.arrow_udf(f"struct<n:bigint,fp:bigint{',set:binary' * signed}>")
    def sets(texts: pa.Array) -> pa.Array:
        found = (shingle_set(t, k) for t in each_text(texts))
        return pa.array([(len(h), set_fingerprint(h), *[signature(h)] * signed) for h in found], pa.struct(fields))

    return docs.select(F.col(id_col).alias("doc_id"), sets(F.col(text_col)).alias("s")).select("doc_id", *[f"s.{f}" for f, _ in fields])


def common_shingles(docs: DataFrame, text_col: str, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of shingles that several texts of a bounded sample hold; sorted
    hashes of its repeated words, and the logarithms of their counts."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            none = np.empty(0, np.uint64)
            found = [words(t) for t in each_text(batch.column(0))]
            for word, hashes in ((False, [np.unique(shingle_hashes(ws, k)) for ws in found]), (True, [word_hashes(ws) for ws in found])):
                u, n = np.unique(np.concatenate([none, *hashes]), return_counts=True)
                yield pa.RecordBatch.from_pydict({"word": np.full(len(u), word), "h": as_long(u), "n": n.astype(np.int64)})

    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    got = reliable_checkpoint(docs.where(hash_share([F.col(text_col)], share, seed=4)).select(text_col).mapInArrow(task, "word boolean, h bigint, n bigint")
                              .groupBy("word", "h").agg(F.sum("n").alias("n")).where("n >= 2"))
    top = lambda which: got.where(which).orderBy(F.desc("n"), "h").limit(COMMON_SHINGLES).select("h", "n").toPandas()
    often, seen = top("not word and n >= 3"), top("word")
    w = seen["h"].to_numpy(np.int64).view(np.uint64)
    weights = np.rint(16 * np.log2(seen["n"].to_numpy(np.float64))).astype(np.int64)
    return np.sort(often["h"].to_numpy(np.int64).view(np.uint64)), np.sort(w), weights[np.argsort(w)]


def tile_keys(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, common: Broadcast | None) -> DataFrame:
    """(key, fp, n) for every class; copies within a batch put theirs down once."""
    def batch_of(found: list[tuple[np.ndarray, int, int]]) -> pa.RecordBatch:
        each = [len(keys) for keys, _, _ in found]
        return pa.RecordBatch.from_pydict({"key": np.concatenate([keys for keys, _, _ in found]), **{
            c: np.repeat(np.array([x[i] for x in found], np.int64), each) for i, c in ((1, "fp"), (2, "n"))}})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, seen, rows = [], set(), 0
            for text in each_text(batch.column(0)):
                h, score = (shingle_set(text, k), None) if common is None else scored_shingles(text, k, *common.value[1:])
                fp = set_fingerprint(h)
                if len(h) and fp not in seen:
                    seen.add(fp)
                    found.append((partition_keys(h, percent) if common is None else prefix_keys(h, percent, common.value[0], score), fp, len(h)))
                    rows += len(found[-1][0])
                    if rows > KEY_ROWS:
                        yield batch_of(found)
                        found, rows = [], 0
            if found:
                yield batch_of(found)

    return docs.where(F.col(id_col).isNotNull()).select(text_col).mapInArrow(task, "key bigint, fp bigint, n bigint")


def candidate_chains(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """(u, v): each class that shares a key, with the least class of that key."""
    keys = lambda: tile_keys(docs, id_col, text_col, k, percent, None)
    shared = keys().groupBy("key").agg(F.min("fp").alias("hub"), F.max("fp").alias("last")) \
        .where(F.col("hub") < F.col("last")).select("key", "hub")
    return keys().join(shared, "key").where(F.col("fp") != F.col("hub")) \
        .select(F.col("fp").alias("u"), F.col("hub").alias("v")).distinct()


def key_groups(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """(label, fp): the classes that share prefix keys and may be linked by their sizes.
    A key's classes, by size, are cut where the next one is too large for a link; those
    of all runs with the same least class are together, under that class."""
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, text_col, k))
    by_size, run = Window.partitionBy("key").orderBy("n", "fp"), Window.partitionBy("key", "run")
    apart = F.coalesce(F.lag("n").over(by_size) * 100 < F.col("n") * percent, F.lit(False)).cast("int")
    return tile_keys(docs, id_col, text_col, k, percent, common) \
        .withColumn("apart", apart).withColumn("run", F.sum("apart").over(by_size)) \
        .select("fp", F.min("fp").over(run).alias("label"), F.max("fp").over(run).alias("last")) \
        .where(F.col("label") < F.col("last")).select("label", "fp").distinct()


def _blocks(nodes: DataFrame, percent: int, bytes_each: float = 8.0, rows_each: int = BLOCK_ROWS) -> DataFrame:
    """nodes (fp, label, n, doc_id) with their tiles: one row per tile.  Bands are
    a little wider than linked sizes can lie apart.  ``bytes_each``: of one shingle."""
    placed = nodes.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / -math.log(percent / 100 - 0.01)).cast("int"))
    count = placed.groupBy("label", "band").agg(F.count("*").alias("rows"), F.sum("n").alias("hashes")) \
        .withColumn("k", F.greatest(F.ceil(F.col("rows") / rows_each), F.ceil(F.col("hashes") * bytes_each / BLOCK_BYTES)).cast("int"))
    count = reliable_checkpoint(count)
    up = count.select("label", (F.col("band") - 1).alias("band"), F.col("k").alias("k_up"))
    down = count.select("label", (F.col("band") + 1).alias("band"), F.col("k").alias("k_down"))
    count = count.join(up, ["label", "band"], "left").join(down, ["label", "band"], "left")
    p = placed.join(count, ["label", "band"]).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))

    def tile(kind: str, band, i, j, side):
        return F.struct(F.lit(kind).alias("kind"), band.alias("at"), i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))

    def each(n, make):
        return F.transform(F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), make)

    b, own = F.col("band"), F.col("own")
    same = each(F.when(F.col("rows") > 1, F.col("k")).otherwise(F.lit(0)), lambda x: tile("same", b, F.least(own, x), F.greatest(own, x), 0))
    low = each(F.col("k_up"), lambda x: tile("next", b, own, x, 0))
    high = each(F.col("k_down"), lambda x: tile("next", b - 1, x, own, 1))
    return p.select("doc_id", "fp", "label", "n", F.explode(F.concat(same, low, high)).alias("t")).select("doc_id", "fp", "label", "n", "t.*")


def bitmaps(arrays: list[np.ndarray]) -> np.ndarray:
    """Hashed bitmap signatures, a row of 64-bit words per array."""
    bits = 256
    while bits < 4096 and bits < 3 * max(map(len, arrays)):
        bits *= 2
    out = np.zeros((len(arrays), bits), np.uint8)
    for i, h in enumerate(arrays):
        out[i, (h & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out, axis=1).view(np.uint64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def link_tile(arrays: list[np.ndarray], side: np.ndarray, across: bool, percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``arrays`` (``across``: only between
    the two sides)."""
    order = np.argsort([len(a) for a in arrays], kind="stable")
    arrays = [arrays[i] for i in order]
    side, n = side[order], np.array([len(a) for a in arrays])
    maps, group, out = bitmaps(arrays), np.arange(len(arrays)), []
    first = np.searchsorted(n, -(-percent * n // 100))
    for i in range(1, len(arrays)):
        lo = first[i]
        open_ = group[lo:i] != group[i]
        if across:
            open_ &= side[lo:i] != side[i]
        js = np.flatnonzero(open_) + lo
        if not len(js):
            continue
        differ = np.bitwise_count(maps[js] ^ maps[i]).sum(1, dtype=np.int64)
        js = js[(n[js] + n[i] - differ) // 2 >= least_overlap(n[js], n[i], percent)]
        while len(js):
            j = js[0]
            if overlap(arrays[j], arrays[i]) >= least_overlap(int(n[j]), int(n[i]), percent):
                out.append((int(order[j]), int(order[i])))
                group[group == group[j]] = group[i]
                js = js[group[js] != group[i]]
            else:
                js = js[1:]
    return out


def _tile_links(table: pa.Table, percent: int) -> pa.Table:
    fps = table.column("fp").to_numpy()
    _, keep = np.unique(fps, return_index=True)
    arrays = [np.frombuffer(x, np.uint64) for x in table.column("set").take(pa.array(keep)).to_pylist()]
    side, kind = table.column("side").to_numpy()[keep], table.column("kind")[0].as_py()
    found = link_tile(arrays, side, kind == "next", percent) if len(keep) > 1 else []
    own = fps[keep]
    return pa.table({"u": pa.array([own[a] for a, _ in found], pa.int64()), "v": pa.array([own[b] for _, b in found], pa.int64())})


#: A signature has up to four bits a shingle; so many of them meet in a block.
SIGNATURE_BYTES, SIGNATURE_ROWS = 0.5, 8192
#: Tiles of signatures are dealt out in parts of about so many bytes, and so many rows.
PART_BYTES, PART_ROWS = 1 << 20, 2048


def signature(h: np.ndarray) -> bytes:
    """A set's hashed bitmap of at least two bits a shingle; ``folded`` makes it narrower."""
    bits = 256
    while bits < 2 * len(h):
        bits *= 2
    out = np.zeros(bits, np.uint8)
    out[(h & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out).tobytes()


def folded(maps: list[bytes]) -> np.ndarray:
    """Signatures at the width of the narrowest, a row of 64-bit words each."""
    width = min(map(len, maps))
    return np.stack([np.bitwise_or.reduce(np.frombuffer(m, np.uint64).reshape(-1, width // 8), axis=0) for m in maps])


def possible_tile(maps: list[bytes], n: np.ndarray, side: np.ndarray, across: bool, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose signatures allow a link."""
    order = np.argsort(n, kind="stable")
    n, side, words_, group, out = n[order], side[order], folded([maps[i] for i in order]), np.arange(len(n)), []
    first = np.searchsorted(n, -(-percent * n // 100))
    for i in range(1, len(n)):
        open_ = group[first[i]:i] != group[i]
        if across:
            open_ &= side[first[i]:i] != side[i]
        js = np.flatnonzero(open_) + first[i]
        if not len(js):
            continue
        differ = np.bitwise_count(words_[js] ^ words_[i]).sum(1, dtype=np.int64)
        js = js[(n[js] + n[i] - differ) // 2 >= least_overlap(n[js], n[i], percent)]
        if len(js):
            _, at = np.unique(group[js], return_index=True)
            out += [(int(order[j]), int(order[i])) for j in js[at]]
            group[np.isin(group, group[js])] = group[i]
    return out


def _possible(table: pa.Table, percent: int) -> pa.Table:
    """The forests of all tiles in ``table``."""
    at = {c: table.column(c).to_numpy() for c in ("label", "at", "i", "j", "side", "fp", "n")}
    across, u, v = table.column("kind").to_numpy(zero_copy_only=False) == "next", [], []
    tile = (at["label"], at["at"], at["i"], at["j"], across)
    order = np.lexsort((at["fp"], *tile))
    new = np.zeros(len(order), bool)
    for c in tile:
        new[1:] |= c[order][1:] != c[order][:-1]
    again = np.append(False, ~new[1:] & (at["fp"][order][1:] == at["fp"][order][:-1]))
    order, starts = order[~again], np.flatnonzero(np.append(True, new[1:])[~again])
    for rows in np.split(order, starts[1:]):
        if len(rows) > 1:
            own = at["fp"][rows]
            found = possible_tile(table.column("set").take(pa.array(rows)).to_pylist(), at["n"][rows], at["side"][rows], bool(across[rows[0]]), percent)
            u += [own[a] for a, _ in found]
            v += [own[b] for _, b in found]
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def possible_links(signed: DataFrame, tiles: DataFrame, percent: int) -> DataFrame:
    """(u, v): forests of the pairs in each of ``tiles`` whose signatures allow a link.
    Tiles are dealt out several at a time."""
    rows, hashes = tiles.agg(F.count("*"), F.sum("n")).first()
    parts = max(1, math.ceil((hashes or 0) * SIGNATURE_BYTES / PART_BYTES), math.ceil(rows / PART_ROWS))
    places = tiles.withColumn("part", F.pmod(F.xxhash64("label", "kind", "at", "i", "j"), F.lit(parts)))
    met = signed.select("doc_id", "fp", "set").join(F.broadcast(places) if rows <= BROADCAST_ROWS else places, ["doc_id", "fp"])
    return met.groupBy("part").applyInArrow(lambda t: _possible(t, percent), "u bigint, v bigint")


def in_tiles(docs: DataFrame, tiles: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """The rows of ``tiles`` with each class's set; a class's text is read once."""
    wanted = reliable_checkpoint(tiles.select("doc_id", "fp").distinct())
    few = wanted.count() <= BROADCAST_ROWS
    ids = wanted.select(F.col("doc_id").alias("wanted_id"), F.col("fp").alias("wanted_fp"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sets that are wanted, a few at a time."""
        for batch in batches:
            fps, packs, held = [], [], 0
            for text, fp in zip(each_text(batch.column(0)), batch.column(1).to_pylist()):
                h = shingle_set(text, k)
                if set_fingerprint(h) == fp:
                    fps.append(fp)
                    packs.append(h.tobytes())
                    held += len(packs[-1])
                if held > BLOCK_BYTES // 2:
                    yield pa.RecordBatch.from_pydict({"fp": fps, "set": pa.array(packs, pa.binary())})
                    fps, packs, held = [], [], 0
            if fps:
                yield pa.RecordBatch.from_pydict({"fp": fps, "set": pa.array(packs, pa.binary())})

    arrays = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(ids) if few else ids, F.col("id") == F.col("wanted_id")).select("text", "wanted_fp") \
        .mapInArrow(packed, "fp bigint, set binary")
    places = tiles.select("fp", "label", "n", "kind", "at", "i", "j", "side")
    return arrays.join(F.broadcast(places) if places.count() <= BROADCAST_ROWS else places, "fp")  # broadcast: sets are dealt out once, not twice


def links(docs: DataFrame, sets: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """(u, v) fingerprints: enough links to connect all classes that links connect."""
    first = sets.where(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"))
    if percent < PARTITIONS_FROM:
        nodes = reliable_checkpoint(key_groups(docs, id_col, text_col, k, percent).join(first, "fp"))
        tiles = reliable_checkpoint(_blocks(nodes, percent, SIGNATURE_BYTES, SIGNATURE_ROWS))
        chains = possible_links(sets, tiles, percent)
    else:
        chains = candidate_chains(docs, id_col, text_col, k, percent)
    label = components(chains).withColumnRenamed("node", "fp")
    nodes = reliable_checkpoint(label.join(first, "fp"))
    tiles = reliable_checkpoint(_blocks(nodes, percent))
    members = in_tiles(docs, tiles, id_col, text_col, k)
    return members.groupBy("label", "kind", "at", "i", "j").applyInArrow(lambda t: _tile_links(t, percent), "u bigint, v bigint")


def same_document(sets: DataFrame) -> DataFrame:
    """(u, v): links between different classes that rows of one id hold."""
    worded = sets.where(F.col("doc_id").isNotNull() & (F.col("n") > 0)).select("doc_id", "fp")
    hubs = worded.groupBy("doc_id").agg(F.min("fp").alias("hub"), F.max("fp").alias("last")).where(F.col("hub") < F.col("last"))
    return worded.join(hubs.select("doc_id", "hub"), "doc_id").where(F.col("fp") != F.col("hub")).select(F.col("fp").alias("u"), F.col("hub").alias("v")).distinct()


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    ship_package(docs.sparkSession)
    sets = reliable_checkpoint(with_sets(docs, id_col, text_col, k)) if percent >= PARTITIONS_FROM else written(with_sets(docs, id_col, text_col, k, signed=True), "near-sets")
    label = components(links(docs, sets, id_col, text_col, k, percent).unionByName(same_document(sets))).withColumnRenamed("node", "fp")
    whole = sets.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = whole.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")) \
        .join(label, "fp", "left").where((F.col("rows") > 1) | F.col("label").isNotNull())
    classes = reliable_checkpoint(classes)
    least = classes.where("label is not null").groupBy("label").agg(F.min("first").alias("least"))
    to = classes.join(least, "label", "left").select("fp", F.coalesce("least", "first").alias("component"))
    found = sets.join(to, "fp", "left")
    mine = F.when(F.col("n") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    rows = found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), mine).alias("component_id"))
    # A wordless row goes with the other rows of its id.
    least = rows.groupBy("doc_id").agg(F.min("component_id").alias("least"), F.max("component_id").alias("most")) \
        .where(F.col("least") < F.col("most")).select("doc_id", "least")
    return rows.join(least, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("least", "component_id").alias("component_id"))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, percent: int = PERCENT) -> DataFrame:
    """The document of the smallest id of each component, columns as they were;
    of rows that repeat an id, one stays.  Rows without an id all stay."""
    found = reliable_checkpoint(near_components(docs, id_col, text_col, k, percent))
    drop = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("drop_id")).distinct()
    kept = docs.join(drop, F.col(id_col) == F.col("drop_id"), "left_anti")
    twice = found.where(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("twice_id"))
    if twice.isEmpty():
        return kept
    return kept.join(twice, F.col(id_col) == F.col("twice_id"), "left_anti") \
        .unionByName(kept.join(twice, F.col(id_col) == F.col("twice_id"), "left_semi").dropDuplicates([id_col]))
