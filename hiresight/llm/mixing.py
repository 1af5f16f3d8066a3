"""Operator 2, mixing sources to target weights; DataFrame functions only.

Sizes are words.  Sources weigh 5, 2, 1, repeating in code point order, and
share ``growth`` times all words; no source gives more than ``most`` times its
words, the excess is shared again by weight (water filling in closed form).

Documents fall into blocks by a hash of their id, which is the random
permutation of a source's documents.  A source draws whole epochs first, then
blocks in order; the block at the edge is drawn in part: by sub-blocks, then
greedily by document, largest first.  The exact block quotas go through a
splitting tree: each node's blocks are halved and every source's part of the
left half is a multivariate hypergeometric draw (inverse CDF, one hashed
uniform per node and source), down to the output shards.  Shards take disjoint
runs of a source's permuted blocks and are shuffled within themselves.

No window holds more than a source's ``MAX_BLOCKS`` blocks; only one row per
source goes into a join (broadcast when their number is checked to be small).

Defined cases: a null text has size 0; a null source is a source, last; a null
id is an id of its own; rows that repeat an id in a source are drawn together;
sources of size 0 have target 0; an empty table gives an empty mix.  Documents
are drawn whole, at most ``most`` times; all other columns pass through.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .frames import fresh

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
DOCS_PER_BLOCK = 64
MAX_BLOCKS = 1 << 16
SHARDS = 16
#: One row per source is broadcast up to this many sources.
BROADCAST_SOURCES = 100_000


def words_in(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def _digits(id_key: Column, first: int) -> Column:
    """60 bits of the id's MD5 as a number."""
    return F.conv(F.substring(F.md5(id_key.cast("binary")), first, 15), 16, 10).cast("bigint")


def _key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def water_fill(sources: DataFrame, weights: tuple[int, ...], growth: float, most: int) -> DataFrame:
    """Adds number, weight and target to (source, source_size, docs).

    With sources in order of cap / weight, the level of those not at their cap
    is the largest of (total - caps before) / (weights from here on)."""
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    s = sources.withColumn("number", number - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heavy = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    s = s.withColumn("level", (F.lit(growth) * total - before) / heavy)
    level = F.max("level").over(Window.partitionBy())
    return s.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * level)).drop("level", "cap")


def _edge(parts: DataFrame, left: str, order: str, name: str) -> DataFrame:
    """Per source, the part at which the running size passes ``left``."""
    run = F.sum("part_size").over(Window.partitionBy("number").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return parts.withColumn("run", run) \
        .where((F.col("run") > F.col(left)) & (F.col("run") - F.col("part_size") <= F.col(left))) \
        .select("number", F.col(order).alias(name), (F.col(left) - (F.col("run") - F.col("part_size"))).alias(f"{name}_left"),
                F.col("part_docs").alias(f"{name}_docs"))


def _with_sources(rows: DataFrame, plan: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """Join on the source (null equals null)."""
    plan = F.broadcast(plan) if few else plan
    return rows.join(plan, rows["source"].eqNullSafe(plan["plan_source"]), how).drop("plan_source")


def mixing_plan(docs: DataFrame, id_col: str, source_col: str, text_col: str, weights=WEIGHTS, growth: float = 1.5,
                most: int = 2, shards: int = SHARDS) -> tuple[DataFrame, bool]:
    """One row per source (all that decides what is drawn, and where it goes),
    and whether there are few sources."""
    sized = reliable_checkpoint(docs.select(
        F.col(source_col).alias("source"), _key(id_col).alias("id_key"), words_in(F.col(text_col)).alias("size")))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    s = water_fill(totals, weights, growth, most)
    s = s.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint"))
    s = s.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    s = s.withColumn("blocks", F.least(F.lit(MAX_BLOCKS), F.greatest(F.lit(1), F.ceil(F.col("docs") / DOCS_PER_BLOCK))).cast("bigint"))
    s = reliable_checkpoint(s.withColumnRenamed("source", "plan_source"))
    few = s.count() <= BROADCAST_SOURCES

    placed = _with_sources(sized, s.select("plan_source", "number", "rest", "blocks", "epochs"), few) \
        .withColumns({"block": _digits(F.col("id_key"), 1) % F.col("blocks"), "spread": _digits(F.col("id_key"), 17)})
    totals = [F.sum("size").alias("part_size"), F.count("*").alias("part_docs")]
    edge = _edge(placed.groupBy("number", "rest", "block").agg(*totals), "rest", "block", "edge")
    edge = reliable_checkpoint(edge.withColumn("subs", F.ceil(F.col("edge_docs") / DOCS_PER_BLOCK).cast("bigint")))
    at_edge = placed.join(F.broadcast(edge) if few else edge, "number").where(F.col("block") == F.col("edge")) \
        .withColumn("sub", F.col("spread") % F.col("subs"))
    sub = _edge(at_edge.groupBy("number", "edge_left", "sub").agg(*totals), "edge_left", "sub", "sub_edge")
    leaf = at_edge.join(F.broadcast(sub) if few else sub, "number").where(F.col("sub") == F.col("sub_edge")) \
        .groupBy("number", "sub_edge_left", "id_key").agg(F.sum("size").alias("unit")) \
        .groupBy("number", "sub_edge_left") \
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("unit")).alias("minus"), "id_key"))).alias("units"))
    start = F.struct(F.col("sub_edge_left").alias("left"), F.array().cast("array<string>").alias("ids"))
    greedy = F.aggregate("units", start, lambda a, x: F.when(
        -x["minus"] <= a["left"],
        F.struct((a["left"] + x["minus"]).alias("left"), F.concat(a["ids"], F.array(x["id_key"])).alias("ids"))).otherwise(a))
    leaf = leaf.select("number", greedy["ids"].alias("edge_ids"))

    plan = s.join(edge.select("number", "edge", "subs"), "number", "left").join(sub.select("number", "sub_edge"), "number", "left") \
        .join(leaf, "number", "left")
    quota = F.col("epochs") * F.col("blocks") + F.coalesce(F.col("edge") + 1, F.lit(0))
    plan = reliable_checkpoint(plan.withColumn("quota", quota))
    ends = shard_ends(plan, shards)
    return reliable_checkpoint(plan.join(ends, "number", "left")), few


def _log_factorial(n: Column) -> Column:
    """ln n! (table up to 9, Stirling's series beyond)."""
    x = F.greatest(n, F.lit(1)).cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    table = F.array(*[F.lit(math.lgamma(k + 1)) for k in range(10)])
    return F.when(n < 10, F.element_at(table, (n + 1).cast("int"))).otherwise(series)


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Inverse CDF at ``u`` of the marked among ``drawn`` of ``total`` things;
    the support is cut 12 standard deviations from the mean, below 1e-30."""
    t = F.greatest(total, F.lit(1)).cast("double")
    mean = drawn * marked / t
    sd = F.sqrt(F.greatest(F.lit(0.0), mean * (1 - marked / t) * (total - drawn) / F.greatest(t - 1, F.lit(1.0))))
    lo = F.greatest(F.lit(0).cast("bigint"), drawn - (total - marked), F.floor(mean - 12 * sd - 2).cast("bigint"))
    hi = F.least(drawn, marked, F.ceil(mean + 12 * sd + 2).cast("bigint"))
    lf = _log_factorial

    def step(a: Column, k: Column) -> Column:
        log_p = lf(marked) - lf(k) - lf(marked - k) + lf(total - marked) - lf(drawn - k) - lf(total - marked - drawn + k) \
            - lf(total) + lf(drawn) + lf(total - drawn)
        done = a["done"] + F.exp(log_p)
        return F.struct(done.alias("done"), F.when(done < u, k + 1).otherwise(a["k"]).alias("k"))

    return F.least(hi, F.aggregate(F.sequence(lo, hi), F.struct(F.lit(0.0).alias("done"), lo.alias("k")), step)["k"])


def split_node(seed: int) -> Column:
    """Left half's quotas of a node (columns node, quotas)."""
    total = F.aggregate("quotas", F.lit(0).cast("bigint"), lambda s, q: s + q)
    start = F.struct(total.alias("total"), F.ceil(total / 2).cast("bigint").alias("drawn"), F.array().cast("array<bigint>").alias("left"))

    def step(a: Column, q: Column) -> Column:
        u = F.pmod(F.xxhash64(F.lit(seed), F.col("node"), F.size(a["left"])), F.lit(1 << 52)) / F.lit(float(1 << 52))
        k = hypergeometric(a["total"], q, a["drawn"], u)
        return F.struct((a["total"] - q).alias("total"), (a["drawn"] - k).alias("drawn"), F.concat(a["left"], F.array(k)).alias("left"))

    return F.aggregate("quotas", start, step)["left"]


def shard_ends(plan: DataFrame, shards: int, seed: int = 7) -> DataFrame:
    """Per source, the ends of the shards' runs in its order of block draws."""
    if shards < 1 or shards & (shards - 1):
        raise ValueError("the number of shards must be a power of two")
    nodes = plan.agg(F.sort_array(F.collect_list(F.struct("number", "quota"))).alias("all")) \
        .select(F.lit(1).cast("bigint").alias("node"), F.col("all")["quota"].alias("quotas"))
    for _ in range(shards.bit_length() - 1):
        halves = nodes.withColumn("left", split_node(seed)) \
            .withColumn("right", F.zip_with("quotas", "left", lambda q, x: q - x))
        nodes = halves.select("node", F.posexplode(F.array("left", "right")).alias("side", "quotas")) \
            .select((F.col("node") * 2 + F.col("side")).alias("node"), "quotas")
    flat = nodes.select((F.col("node") - shards).alias("shard"), F.posexplode("quotas").alias("number", "quota"))
    run = F.sum("quota").over(Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
    return flat.withColumn("end", run).groupBy("number") \
        .agg(F.sort_array(F.collect_list(F.struct("shard", "end"))).alias("e")).select("number", F.col("e")["end"].alias("ends"))


def with_draws(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
               **options) -> tuple[DataFrame, str]:
    """``docs`` with one struct column (size, source_size, target, draws: epoch
    and shard of each time the document is taken), and its name."""
    plan, few = mixing_plan(docs, id_col, source_col, text_col, **options)
    out = fresh(docs.columns, "mix")
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(source_col).alias("source"),
                       _key(id_col).alias("id_key"), words_in(F.col(text_col)).alias("size"))
    w = _with_sources(wide, plan, few)
    block, sub = _digits(F.col("id_key"), 1) % F.col("blocks"), _digits(F.col("id_key"), 17) % F.col("subs")
    partial = F.coalesce((block < F.col("edge")) | ((block == F.col("edge")) & (
        (sub < F.col("sub_edge")) | ((sub == F.col("sub_edge")) & F.array_contains("edge_ids", F.col("id_key"))))), F.lit(False))
    times = (F.col("epochs") + partial.cast("int")).cast("int")
    shard = lambda e: F.size(F.filter("ends", lambda end: end <= e * F.col("blocks") + block))
    epochs = F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))
    draws = F.transform(epochs, lambda e: F.struct(e.alias("epoch"), shard(e).cast("int").alias("shard")))
    return w.select("row.*", F.struct("size", "source_size", "target", draws.alias("draws")).alias(out)), out


def mix(docs: DataFrame, id_col: str = "doc_id", seed: int = 11, **options) -> DataFrame:
    """The mix itself: a row for each draw, with its epoch, shard and place in
    the shard (``place`` orders a shard's rows at random, the same on reruns)."""
    found, out = with_draws(docs, id_col, **options)
    names = []
    for n in ("epoch", "shard", "place"):
        names.append(fresh([*docs.columns, *names], n))
    d = fresh([*docs.columns, *names], "draw")
    rows = found.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.col(out)["draws"]).alias(d))
    place = F.xxhash64(F.lit(seed), F.col(d)["shard"], F.col(d)["epoch"], F.col(id_col))
    return rows.withColumns({names[0]: F.col(d)["epoch"], names[1]: F.col(d)["shard"], names[2]: place}).drop(d)


def write_shards(mixed: DataFrame, path: str, shard: str = "shard", place: str = "place") -> None:
    """A folder per shard, rows in the shard's random order."""
    mixed.repartitionByRange(shard, place).sortWithinPartitions(shard, place).write.partitionBy(shard).parquet(path)


def report(docs: DataFrame) -> DataFrame:
    found, out = with_draws(docs.select("doc_id", "source", "text"))
    m = F.col(out)
    return found.select("doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"),
                        (m["size"] * F.size(m["draws"])).cast("bigint").alias("taken"))
