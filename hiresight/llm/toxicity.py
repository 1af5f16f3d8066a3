"""Operator 4, toxicity by nearest labelled examples.

Texts are TF-IDF vectors (1 + log tf, idf over all documents) over the terms
(words, their first 3 to 8 bytes, as insults are inflected and compounded, and
either of them again where it occurs ``LEVELS`` times, as the cosine itself
doesn't see how often a lone term occurs) that tell the labelled classes apart; a block-max inverted index over a bounded
set of labelled examples gives, exactly, the ``k`` examples of largest cosine.
Blocks of examples are visited in the order of their upper bounds (query weight
times the block's largest weight, summed over terms) until no bound can reach
the k-th best.  Votes are weighted by distance and pulled to the base rate; a
logistic fit to the examples' own leave-one-out votes calibrates them, and the
neighbours are returned as evidence.

Bounds: ``sample`` labelled whole texts per class, ``max_terms`` terms.
Document frequencies cover all documents.

Defined cases: a null or empty text, or one without a chosen term, has no
neighbours and gets the calibrated base rate of such examples; labels without
an id or label don't train; a document with several labels is toxic if one is;
without two classes every score is the base rate; ties go to the example that
comes first in the index; texts may be of any length.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .frames import crc_remainder, hash_share, ship_package
from .textkit import ALNUM_LOWER, as_long, each_text, mix64, pieces, words

#: Labelled whole texts per class that choose terms and serve as examples.
SAMPLE = 4000
MAX_TERMS = 4096
#: Bytes of the beginnings that are terms.
PREFIXES = range(3, 9)
#: Occurrences from which a word or beginning is a term, and a further one.
LEVELS = (1, 2, 4)
K = 15
BLOCK = 64
THRESHOLD = 0.7
#: A term counts if its log likelihood ratio and its ratio of rates reach these.
MIN_G, MIN_LIFT = 16.0, 3.0
#: Weight of the base rate against the neighbours' votes.
PULL = 0.5
EVIDENCE = "array<struct<doc_id:bigint,similarity:double,label:int>>"
RESULT = f"struct<score:double,evidence:{EVIDENCE}>"
_TYPE = pa.struct([("score", pa.float64()), ("evidence", pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("label", pa.int32())])))])


def occurrences(text: bytes | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of a text's words and of their beginnings, with counts; a hash may
    come several times."""
    for spans, start, end in pieces(words(text, ALNUM_LOWER)):
        h, at, n = np.unique(spans.hashes(start, end), return_index=True, return_counts=True)
        yield h, n
        start, length = start[at], (end - start)[at]
        for size in PREFIXES:
            long = length > size
            yield mix64(spans.hashes(start[long], start[long] + size) + np.uint64(size)), n[long]


def term_counts(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of a text, and how often each occurs."""
    found = list(occurrences(text))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h, back = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
    return h, np.bincount(back, np.concatenate([n for _, n in found]), len(h)).astype(np.int64)


@dataclass
class Terms:
    """Sorted hashes of the chosen terms' words or beginnings; for each, the
    numbers of its terms by level (-1: not chosen); the terms' idf."""
    keys: np.ndarray
    number: np.ndarray
    idf: np.ndarray

    @classmethod
    def of(cls, chosen: list[tuple[int, int]]) -> "Terms":
        """From (hash, level) pairs."""
        keys = np.unique(np.array([h for h, _ in chosen], np.int64).view(np.uint64))
        number = np.full((len(keys), len(LEVELS)), -1)
        for i, (h, level) in enumerate(sorted(chosen)):
            number[np.searchsorted(keys, np.uint64(h & 0xFFFFFFFFFFFFFFFF)), LEVELS.index(level)] = i
        return cls(keys, number, np.ones(len(chosen)))

    def counts(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the terms that a text has, and how often."""
        tf = None
        for h, n in occurrences(text) if len(self.keys) else ():
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = self.keys[at] == h
            if hit.any():
                tf = np.zeros(len(self.keys), np.int64) if tf is None else tf
                np.add.at(tf, at[hit], n[hit])
        if tf is None:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        has = (tf[:, None] >= np.array(LEVELS)) & (self.number >= 0)
        found, often = self.number[has], np.repeat(tf, has.sum(1))
        order = np.argsort(found)
        return found[order], often[order]

    def vector(self, found: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of a text's terms, to unit length."""
        w = (1 + np.log(tf)) * self.idf[found]
        norm = np.sqrt((w * w).sum())
        return (found, w / norm) if norm > 0 else (np.empty(0, np.int64), np.empty(0))


class BlockMaxIndex:
    """Postings by term in blocks of ``BLOCK`` examples, with each block's
    largest weight."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.size, self.blocks = len(vectors), -(-len(vectors) // BLOCK)
        term = np.concatenate([t for t, _ in vectors]) if vectors else np.empty(0, np.int64)
        doc = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.empty(0)
        cell = term * self.blocks + doc // BLOCK
        order = np.lexsort((doc, cell))
        self.doc, self.weight = doc[order], weight[order]
        self.start = np.searchsorted(cell[order], np.arange(n_terms * self.blocks + 1))
        self.top = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.top, cell, weight)
        self.top = self.top.reshape(n_terms, self.blocks)

    def dots(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Cosines of the query with the examples of some blocks [block, place]."""
        cell = (terms[:, None] * self.blocks + blocks).ravel()
        lo, n = self.start[cell], self.start[cell + 1] - self.start[cell]
        at = np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)
        row = np.repeat(np.tile(np.arange(len(blocks)), len(terms)), n)
        w = np.repeat(np.repeat(weights, len(blocks)), n) * self.weight[at]
        return np.bincount(row * BLOCK + self.doc[at] % BLOCK, w, len(blocks) * BLOCK).reshape(-1, BLOCK)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine (those above 0), best first."""
        ids, sims, kth = np.empty(0, np.int64), np.empty(0), 0.0
        if not len(terms) or not self.size:
            return ids, sims
        bound = weights @ self.top[terms]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        for a in range(0, len(order), 8):
            blocks = order[a: a + 8]
            if len(ids) >= k:
                blocks = blocks[bound[blocks] + 1e-12 >= kth]
                if not len(blocks):
                    break
            dots = self.dots(terms, weights, blocks)
            i, j = np.nonzero(dots > 0)
            found = blocks[i] * BLOCK + j
            some = found != skip
            ids, sims = np.concatenate([ids, found[some]]), np.concatenate([sims, dots[i, j][some]])
            best = np.lexsort((ids, -np.round(sims, 12)))[:k]
            ids, sims = ids[best], sims[best]
            kth = sims[-1] if len(ids) == k else 0.0
        return ids, sims


@dataclass
class Neighbours:
    terms: Terms
    index: BlockMaxIndex
    ids: np.ndarray
    label: np.ndarray
    prior: float
    slope: tuple[float, float]
    blank: float
    k: int

    def vote(self, sims: np.ndarray, labels: np.ndarray) -> float:
        w = 1 / (1.05 - np.minimum(sims, 1.0)) * sims
        return float((w @ labels + PULL * self.prior) / (w.sum() + PULL))

    def calibrated(self, vote: float) -> float:
        a, b = self.slope
        return float(1 / (1 + np.exp(-np.clip(a * vote + b, -40, 40))))

    def score(self, found: np.ndarray, tf: np.ndarray, cache: dict) -> tuple[float, np.ndarray, np.ndarray]:
        if not len(found):
            return self.blank, np.empty(0, np.int64), np.empty(0)
        key = (found.tobytes(), tf.tobytes())
        if key not in cache:
            if len(cache) > 20_000:
                cache.clear()
            terms, weights = self.terms.vector(found, tf)
            ids, sims = self.index.nearest(terms, weights, self.k)
            cache[key] = (self.calibrated(self.vote(sims, self.label[ids])) if len(ids) else self.blank, ids, sims)
        return cache[key]


def platt(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit, with smoothed targets."""
    n1, n0 = (weights * labels).sum(), (weights * (1 - labels)).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 4.0, -2.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * votes + b, -40, 40)))
        g, h = weights * (p - target), weights * np.maximum(p * (1 - p), 1e-9)
        ga, gb = (g * votes).sum() + 1e-3 * a, g.sum()
        haa, hab, hbb = (h * votes * votes).sum() + 1e-3, (h * votes).sum(), h.sum() + 1e-9
        det = haa * hbb - hab * hab
        if det < 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 5 / (abs(da) + abs(db) + 1e-9))
        a, b = a - step * da, b - step * db
        if abs(da) + abs(db) < 1e-8:
            break
    return (a, b) if a > 0 else (4.0, -2.0)


def telling_terms(found: DataFrame, n0: int, n1: int, max_terms: int) -> DataFrame:
    """Of (term, level, n0, n1: texts with the term, by class), those that tell the
    classes apart: Dunning's log likelihood ratio, and the ratio of the rates."""
    a, b, both = F.col("n1").cast("double"), F.col("n0").cast("double"), (F.col("n0") + F.col("n1")) / float(n0 + n1)
    part = lambda x, n: F.when(x > 0, x * F.log(x / (both * n))).otherwise(0.0)
    lift = ((a + 0.5) / n1) / ((b + 0.5) / n0)
    return found.withColumn("g", 2 * (part(a, n1) + part(b, n0))) \
        .where((F.col("g") >= MIN_G) & ((lift >= MIN_LIFT) | (lift <= 1 / MIN_LIFT))).orderBy(F.desc("g"), "term", "level").limit(max_terms)


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
           usable: Column | None = None, sample: int = SAMPLE, max_terms: int = MAX_TERMS, k: int = K) -> DataFrame:
    """doc_id, score and evidence (the neighbours) of every row of ``docs``."""
    ship_package(docs.sparkSession)
    usable = usable_rows(id_col) if usable is None else usable
    terms = choose_terms(docs, labels, id_col, text_col, label_col, usable, sample, max_terms)
    if isinstance(terms, float):
        return docs.select(F.col(id_col).alias("doc_id"), F.lit(terms).alias("score"), F.array().cast(EVIDENCE).alias("evidence"))
    terms, told, rates = terms
    counts = reliable_checkpoint(term_table(docs, id_col, text_col, terms))
    terms.idf = document_idf(counts, len(terms.idf))
    model = fit(terms, counts.join(F.broadcast(told), F.col("doc_id") == F.col("label_id")), rates, k)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def found(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        m, cache = held.value, {}
        for ts, ns in batches:
            rows = []
            for t, n in zip(ts.to_pylist(), ns.to_pylist()):
                score, ids, sims = m.score(np.array(t, np.int64), np.array(n, np.int64), cache)
                rows.append({"score": score, "evidence": [
                    {"doc_id": d, "similarity": s, "label": x} for d, s, x in zip(m.ids[ids].tolist(), sims.tolist(), m.label[ids].astype(int).tolist())]})
            yield pa.array(rows, _TYPE)

    return counts.select("doc_id", found("t", "n").alias("f")).select("doc_id", "f.score", "f.evidence")


def term_table(docs: DataFrame, id_col: str, text_col: str, terms: Terms) -> DataFrame:
    """doc_id, t (numbers of the terms a text has) and n (how often), per row."""
    held = docs.sparkSession.sparkContext.broadcast(terms)

    @F.arrow_udf("struct<t:array<int>,n:array<bigint>>")
    def counted(texts: pa.Array) -> pa.Array:
        got = (held.value.counts(x) for x in each_text(texts))
        return pa.array([{"t": t, "n": n} for t, n in got], pa.struct([("t", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))]))

    return docs.select(F.col(id_col).alias("doc_id"), counted(F.col(text_col)).alias("c")).select("doc_id", "c.t", "c.n")


def document_idf(counts: DataFrame, n_terms: int) -> np.ndarray:
    """Smoothed idf of the chosen terms over all documents."""
    total, df = counts.count(), np.zeros(n_terms)
    for r in counts.select(F.explode("t").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect():
        df[r.t] = r.n
    return np.log((1 + total) / (1 + df)) + 1


def fit(terms: Terms, examples: DataFrame, rates: tuple[float, float], k: int) -> Neighbours:
    """Index and calibration from the labelled examples (doc_id, t, n, label);
    ``rates``: labelled rows that an example of each class stands for."""
    rows = examples.select("doc_id", "label", "t", "n").toPandas().sort_values("doc_id")
    label, blank = rows["label"].to_numpy(float), rows["t"].map(len).to_numpy() == 0
    weight = np.where(label == 1, rates[1], rates[0])
    rate = float((weight * label).sum() / weight.sum())
    at_blank = float(((weight * label)[blank].sum() + rate) / (weight[blank].sum() + 1))
    vecs = [terms.vector(np.asarray(t, np.int64), np.asarray(n, np.int64)) for t, n, b in zip(rows["t"], rows["n"], blank) if not b]
    y, w, ids = label[~blank], weight[~blank], rows["doc_id"].to_numpy(np.int64)[~blank]
    order = sorted(range(len(vecs)), key=lambda i: (vecs[i][0][int(np.argmax(vecs[i][1]))], -vecs[i][1].max(), ids[i]))
    vecs, y, w, ids = [vecs[i] for i in order], y[order], w[order], ids[order]
    model = Neighbours(terms, BlockMaxIndex(vecs, len(terms.idf)), ids, y, rate, (4.0, -2.0), at_blank, k)
    votes = []
    for i, (t, v) in enumerate(vecs):
        near, sims = model.index.nearest(t, v, k, skip=i)
        votes.append(model.vote(sims, y[near]) if len(near) else rate)
    if votes:
        model.slope = platt(np.array(votes), y, w)
    return model


def choose_terms(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, usable: Column, sample: int,
                 max_terms: int) -> tuple[Terms, DataFrame, tuple[float, float]] | float:
    """Terms, the bounded labelled sample (label_id, label) and how many labelled
    rows one of each class stands for; or the base rate, without two classes."""
    told = labels.where(usable & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("label_id")).agg(F.max((F.col(label_col) == 1).cast("int")).alias("label"))
    n = {r.label: r.n for r in told.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return 0.5 if not n else float(next(iter(n)))
    share = F.when(F.col("label") == 1, min(1.0, sample / n[1])).otherwise(min(1.0, sample / n[0]))
    told = told.where(hash_share([F.col("label_id")], share))

    def texts_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [term_counts(t) for t in each_text(batch.column(0))]
            toxic = np.repeat(batch.column(1).to_numpy(), [len(h) for h, _ in every])
            h, n = np.concatenate([h for h, _ in every]), np.concatenate([n for _, n in every])
            for level in LEVELS:
                term, at = np.unique(h[n >= level], return_inverse=True)
                n1 = np.bincount(at, toxic[n >= level], len(term)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"term": as_long(term), "level": np.full(len(term), level, np.int32),
                                                  "n0": np.bincount(at, minlength=len(term)) - n1, "n1": n1})

    picked = docs.where(usable).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(told), F.col("id") == F.col("label_id")).select("id", "text", "label")
    sizes = {r.label: r.n for r in picked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return float(n[1] / sum(n.values()))
    found = picked.select("text", "label").mapInArrow(texts_with, "term bigint, level int, n0 bigint, n1 bigint") \
        .groupBy("term", "level").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(F.col("n0") + F.col("n1") >= 3)
    chosen = [(r.term, r.level) for r in telling_terms(found, sizes[0], sizes[1], max_terms).select("term", "level").collect()]
    return Terms.of(chosen), told, (n[0] / sizes[0], n[1] / sizes[1])


def usable_rows(id_col: str = "doc_id") -> Column:
    """Rows that may train: crc32 of the id as text, modulo 3, is not 1."""
    return F.coalesce(crc_remainder(id_col, 3) != 1, F.lit(False))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, labels).select(
        "doc_id", F.coalesce(crc_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.col("evidence")["doc_id"].alias("evidence"))
