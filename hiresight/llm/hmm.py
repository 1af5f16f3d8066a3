"""Operator 10, language model scoring with a hidden Markov model.

Tokens are lower-cased words and one end.  Words are counted over the whole
training part.  The ``symbols`` most frequent are symbols of the model; the
others fall into ``CLASSES`` classes by their last bytes, and a class gives a
word the probability (c + 0.5) / (class tokens + 0.5 * (class words + 1)), so a
word not seen in training is one more word of its class.

Texts become lists of symbols once.  Training: a mixture of unigram models on
a bounded sample sets the first parameters; then each Baum-Welch round runs the
scaled forward and backward recursions over the whole training part and sums
the expected counts across partitions.  The score is the exact log10 probability of the token sequence by
the scaled forward recursion.

Counts of the ``head`` most frequent words are broadcast (bounded); a text's
other words are joined with the count table by hash.

Defined cases: a null or empty text is the end alone; rows without an id are
scored but don't train; without training rows every word is unknown and the
model is uniform; repeated rows are scored each; texts may be of any length.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .frames import crc_remainder, hash_share, ship_package, written
from .textkit import as_long, each_text, pieces, words

STATES = 8
SYMBOLS = 1 << 16
HEAD = 1 << 18
CLASS_BITS = 10
CLASSES = 1 << CLASS_BITS
ROUNDS = 2
#: Whole training texts that set the first parameters.
SAMPLE = 1000
#: Tokens that go through the recursions together, about.
SLICE = 1 << 18
END = np.uint64(0x5EED0E0D)
#: Weight of the overall symbol shares in each state's emissions.
SMOOTH = 20.0


def tokens(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's tokens in order, the end last, and the classes of the
    words' last three bytes."""
    hashes, classes = [], []
    for spans, start, end in pieces(words(text)):
        a, n = spans.bytes, end - start
        tail = a[end - 1].astype(np.uint32)
        for k in (1, 2):
            tail |= np.where(n > k, a[np.maximum(end - 1 - k, 0)], np.uint8(0)).astype(np.uint32) << np.uint32(8 * k)
        hashes.append(spans.hashes(start, end))
        classes.append((tail * np.uint32(2654435769)) >> np.uint32(32 - CLASS_BITS))
    return np.concatenate([*hashes, [END]]), np.concatenate([*classes, [0]]).astype(np.int64)


@dataclass
class Vocabulary:
    """Symbols and counts.  Symbol numbers: frequent words, then classes."""
    tokens: int
    distinct: int
    top: np.ndarray          # sorted hashes of the symbols
    top_count: np.ndarray
    head: np.ndarray         # sorted hashes of the next frequent words
    head_count: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray

    def shares(self) -> np.ndarray:
        c = np.concatenate([self.top_count, self.class_tokens]) + 0.5
        return c / c.sum()

    def __post_init__(self):
        self.log_top, self.log_head = np.log10(self.top_count + 0.5), np.log10(self.head_count + 0.5)
        self.log_class = np.log10(self.class_tokens + 0.5 * (self.class_words + 1))
        self.log_total = float(np.log10(self.tokens + 0.5 * (self.distinct + 1)))


def _look(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return at, keys[at] == h


@dataclass
class Hmm:
    start: np.ndarray     # [state]
    move: np.ndarray      # [state, next state]
    emit: np.ndarray      # [symbol, state]

    def forward(self, layout: "Layout") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled forward variables, scales and emissions, in layout order."""
        e = self.emit[layout.symbols]
        alpha, scale = np.empty_like(e), np.empty(len(e))
        prev = None
        for t in range(len(layout.active)):
            lo, n = layout.offset[t], layout.active[t]
            a = (np.broadcast_to(self.start, (n, len(self.start))) if prev is None else prev[:n] @ self.move) * e[lo: lo + n]
            s = a.sum(1)
            prev = a / s[:, None]
            alpha[lo: lo + n], scale[lo: lo + n] = prev, s
        return alpha, scale, e

    def log_probs(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each symbol sequence."""
        layout = Layout(sequences)
        _, scale, _ = self.forward(layout)
        return np.bincount(layout.owner, np.log(scale), len(sequences))

    def expected(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions of the sequences."""
        layout = Layout(sequences)
        alpha, scale, e = self.forward(layout)
        beta = np.ones_like(alpha)
        for t in range(len(layout.active) - 2, -1, -1):
            lo, nxt, n = layout.offset[t], layout.offset[t + 1], layout.active[t + 1]
            ahead = slice(nxt, nxt + n)
            e[ahead] *= beta[ahead] / scale[ahead, None]
            beta[lo: lo + n] = e[ahead] @ self.move.T
        gamma = alpha * beta
        first = layout.active[0]
        moves = self.move * (alpha[layout.before].T @ e[first:])
        used, at = np.unique(layout.symbols, return_inverse=True)
        counts = np.zeros_like(self.emit)
        counts[used] = np.stack([np.bincount(at, gamma[:, k], len(used)) for k in range(gamma.shape[1])], 1)
        return gamma[:first].sum(0), moves, counts

    @classmethod
    def from_counts(cls, start, move, emit, shares) -> "Hmm":
        """Smoothed maximum likelihood parameters."""
        k = len(start)
        emit = emit + SMOOTH * shares[:, None]
        return cls((start + 0.1) / (start + 0.1).sum(), (move + 0.1 + 0.9 * np.eye(k)) / (move.sum(1, keepdims=True) + 0.1 * k + 0.9),
                   emit / emit.sum(0))


class Layout:
    """Sequences laid out by step, longest first, so that each step of a
    recursion is one slice of those still running."""

    def __init__(self, sequences: list[np.ndarray]):
        n = np.array([len(s) for s in sequences])
        order = np.argsort(-n, kind="stable")
        n = n[order]
        self.active = np.searchsorted(-n, -np.arange(n[0]), "left")
        self.offset = np.concatenate([[0], np.cumsum(self.active)[:-1]])
        step = np.concatenate([np.arange(x) for x in n])
        row = np.repeat(np.arange(len(n)), n)
        at = self.offset[step] + row
        self.symbols, self.owner = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        self.symbols[at] = np.concatenate([sequences[i] for i in order])
        self.owner[at] = order[row]
        later = step > 0
        self.before = np.empty(int(later.sum()), np.int64)
        self.before[at[later] - self.active[0]] = self.offset[step[later] - 1] + row[later]


def count_words(docs: DataFrame, text_col: str) -> DataFrame:
    """(h, cls, n): every token's count, summed first within a batch."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hs, cs, held = [], [], 0
            for text in chain(each_text(batch.column(0)), [False]):
                if text is not False:
                    h, c = tokens(text)
                    hs.append(h)
                    cs.append(c)
                    held += len(h)
                if hs and (text is False or held > 8 * SLICE):
                    u, at, n = np.unique(np.concatenate(hs), return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_pydict({"h": as_long(u), "cls": np.concatenate(cs)[at].astype(np.int32), "n": n.astype(np.int64)})
                    hs, cs, held = [], [], 0

    return docs.select(text_col).mapInArrow(task, "h bigint, cls int, n bigint").groupBy("h", "cls").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words of the highest counts, as many whole ranks of equal count as
    come to at most ``most`` words, and the end."""
    capped = F.least(F.col("n"), F.lit(1 << 16))
    have, least = 0, 1 << 16
    for r in sorted(counts.groupBy(capped.alias("n")).agg(F.count("*").alias("w")).collect(), reverse=True):
        have += r.w
        if have > most - 1:
            break
        least = r.n
    end = F.col("h") == int(END.view(np.int64))
    return counts.where((F.col("n") >= least) | end).withColumn("end", end)


def vocabulary(counts: DataFrame, symbols: int = SYMBOLS, head: int = HEAD) -> Vocabulary:
    total = counts.agg(F.sum("n"), F.count("*")).first()
    first = frequent(counts, symbols + head).toPandas().sort_values(["end", "n", "h"], ascending=[False, False, True])
    h, n, cls = (first[c].to_numpy(np.int64) for c in ("h", "n", "cls"))
    symbols = min(symbols, len(h))
    by_class = counts.groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("w")).toPandas()
    class_n, class_w = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    class_n[by_class["cls"]], class_w[by_class["cls"]] = by_class["n"], by_class["w"]
    class_n -= np.bincount(cls[:symbols], n[:symbols], CLASSES).astype(np.int64)
    class_w -= np.bincount(cls[:symbols], minlength=CLASSES)
    parts = []
    for part in (slice(0, symbols), slice(symbols, None)):
        key = h[part].view(np.uint64)
        order = np.argsort(key)
        parts += [key[order], n[part][order]]
    return Vocabulary(int(total[0] or 0), int(total[1]), *parts, class_n, class_w)


def first_model(sequences: list[np.ndarray], shares: np.ndarray, states: int, seed: int = 3, rounds: int = 12) -> Hmm:
    """A mixture of unigram models by EM, as states that rarely change, then a
    few Baum-Welch rounds, all on the sample."""
    r = np.random.default_rng(seed)
    stay = np.full((states, states), 0.02) + np.eye(states) * (0.98 - 0.02 * (states - 1))
    stay /= stay.sum(1, keepdims=True)
    if not sequences:
        return Hmm(np.full(states, 1 / states), stay, np.repeat(shares[:, None], states, 1))
    groups = [[sequences[i] for i in part] for part in slices(sequences)]
    parts = [r.dirichlet(np.full(states, 0.3), len(x)) for x in groups]
    for _ in range(rounds):
        emit = SMOOTH * np.repeat(shares[:, None], states, 1)
        for part, x in zip(parts, groups):
            flat, each = np.concatenate(x), np.repeat(part, [len(s) for s in x], 0)
            for k in range(states):
                emit[:, k] += np.bincount(flat, each[:, k], len(shares))
        emit /= emit.sum(0)
        log_emit, mean = np.log(emit), np.concatenate(parts).mean(0)
        for i, x in enumerate(groups):
            starts = np.cumsum([0, *[len(s) for s in x[:-1]]])
            like = np.add.reduceat(log_emit[np.concatenate(x)], starts, 0) + np.log(mean + 1e-6)
            part = np.exp(like - like.max(1, keepdims=True))
            parts[i] = part / part.sum(1, keepdims=True)
    start = np.concatenate(parts).mean(0) + 1e-3
    model = Hmm(start / start.sum(), stay, emit)
    for _ in range(3):
        sums = [model.expected(x) for x in groups]
        model = Hmm.from_counts(*[sum(s[i] for s in sums) for i in range(3)], shares)
    return model


def slices(sequences: list[np.ndarray], size: int = SLICE) -> Iterator[list[int]]:
    """Numbers of sequences that go through the recursions together: those of
    like length, about ``size`` tokens."""
    held, n = [], 0
    for i in sorted(range(len(sequences)), key=lambda i: -len(sequences[i])):
        held.append(i)
        n += len(sequences[i])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def symbol_lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The values of a list<int> array as numpy arrays."""
    column = column.cast(pa.large_list(pa.int32()))
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for a, b in zip(ends[:-1], ends[1:]):
        yield flat[a:b]


def baum_welch(rows: DataFrame, model: Hmm, shares: np.ndarray) -> Hmm:
    """One round over the symbol lists of all ``rows``; tasks send their summed
    counts, a row per symbol (and per state, below 0, for starts and moves)."""
    k = len(model.start)
    held = rows.sparkSession.sparkContext.broadcast(model)
    names = [f"s{i}" for i in range(k)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros_like(m.emit)
        for batch in batches:
            own = list(symbol_lists(batch.column(0)))
            for part in slices(own):
                a, b, c = m.expected([own[i] for i in part])
                start += a
                move += b
                emit += c
        used = np.flatnonzero(emit.any(1))
        sums = np.concatenate([emit[used], move, start[None]])
        sym = np.concatenate([used, -1 - np.arange(k), [-1 - k]])
        yield pa.RecordBatch.from_pydict({"sym": sym.astype(np.int32), **{x: sums[:, i].astype(np.float32) for i, x in enumerate(names)}})

    got = rows.select("symbols").mapInArrow(task, "sym int, " + ", ".join(f"{x} float" for x in names)) \
        .groupBy("sym").agg(*[F.sum(x).alias(x) for x in names]).toPandas().sort_values("sym")
    sym, sums = got["sym"].to_numpy(), got[names].to_numpy(float)
    table = {int(s): row for s, row in zip(sym[sym < 0], sums[sym < 0])}
    if not table:
        return model
    emit = np.zeros_like(model.emit)
    emit[sym[sym >= 0]] = sums[sym >= 0]
    return Hmm.from_counts(table[-1 - k], np.stack([table[-1 - i] for i in range(k)]), emit, shares)


PARTIAL = "struct<n_tokens:bigint,n_known:bigint,base:double,in_class:double,rare:array<struct<h:bigint,m:bigint>>,symbols:array<int>>"


def partial(v: Vocabulary, h: np.ndarray, cls: np.ndarray) -> dict:
    """A text's symbols, and its sums without log10(c + 0.5) of rare words."""
    at, hit = _look(v.top, h)
    miss = np.flatnonzero(~hit)
    rest, own = h[miss], cls[miss]
    symbols = at.astype(np.int32)
    symbols[miss] = len(v.top) + own
    there, mid = _look(v.head, rest)
    mid_sum = float(v.log_head[there[mid]].sum()) if len(v.head) else 0.0
    u, m = np.unique(rest[~mid], return_counts=True)
    top_sum = float(v.log_top[at[hit]].sum()) if len(v.top) else 0.0
    return {"n_tokens": len(h), "n_known": int(hit.sum() + mid.sum()), "base": top_sum + mid_sum - len(h) * v.log_total,
            "in_class": mid_sum - float(v.log_class[own].sum()), "rare": (as_long(u), m), "symbols": symbols}


def prepared(docs: DataFrame, v: Vocabulary, usable: Column, id_col: str, text_col: str) -> DataFrame:
    """A row per document (``row`` numbers them): the results of ``partial``, and
    whether it trains; written to the shared folder."""
    held = docs.sparkSession.sparkContext.broadcast(v)

    @F.arrow_udf(PARTIAL)
    def parts(texts: pa.Array) -> pa.Array:
        rows = [partial(held.value, *tokens(t)) for t in each_text(texts)]
        h, m, symbols = ([np.empty(0, x), *y] for x, y in ((np.int64, [r["rare"][0] for r in rows]), (np.int64, [r["rare"][1] for r in rows]),
                                                           (np.int32, [r["symbols"] for r in rows])))
        rare = pa.StructArray.from_arrays([pa.array(np.concatenate(h)), pa.array(np.concatenate(m))], ["h", "m"])
        ends = lambda xs: pa.array(np.cumsum([len(x) for x in xs]), pa.int32())
        plain = [pa.array([r[c] for r in rows], t) for c, t in (("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("in_class", pa.float64()))]
        return pa.StructArray.from_arrays([*plain, pa.ListArray.from_arrays(ends(h), rare),
                                           pa.ListArray.from_arrays(ends(symbols), pa.array(np.concatenate(symbols)))],
                                          ["n_tokens", "n_known", "base", "in_class", "rare", "symbols"])

    return written(docs.select(F.col(id_col).alias("doc_id"), usable.alias("trains"), parts(text_col).alias("p"))
                   .select("doc_id", "trains", F.monotonically_increasing_id().alias("row"), "p.*"), "lm")


def train(rows: DataFrame, v: Vocabulary, states: int = STATES, rounds: int = ROUNDS, sample: int = SAMPLE) -> Hmm:
    """The model, from the symbol lists of the rows that train."""
    own, shares = rows.where("trains"), v.shares()
    share = min(1.0, sample / max(1, own.count()))
    picked = own.where(hash_share([F.col("row")], share)).select("row", "symbols").toPandas().sort_values("row")
    model = first_model([np.asarray(s, np.int64) for s in picked["symbols"]], shares, states)
    for _ in range(rounds):
        model = baum_welch(own, model, shares)
    return model


def score(rows: DataFrame, model: Hmm, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of prepared rows."""
    held = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def sequence(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            own, done = list(symbol_lists(batch)), np.zeros(len(batch))
            for part in slices(own):
                done[part] = held.value.log_probs([own[i] for i in part]) / np.log(10)
            yield pa.array(done, pa.float64())

    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.h", "r.m").join(counts.select("h", "n"), "h", "left") \
        .groupBy("row").agg(F.sum(F.col("m") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("logs"),
                            F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("known"))
    logs = F.coalesce("logs", F.lit(0.0))
    return rows.select("row", "doc_id", "n_tokens", "n_known", "base", "in_class", sequence("symbols").alias("sequence")) \
        .join(rare, "row", "left").select(
            "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
            (F.col("base") + logs).alias("base_score"), (F.col("sequence") + F.col("in_class") + logs).alias("score"))


def fitted_scores(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", symbols: int = SYMBOLS,
                  head: int = HEAD, **options) -> tuple[DataFrame, Vocabulary, Hmm]:
    """Scores of all rows under the model of those that are ``usable``."""
    ship_package(docs.sparkSession)
    counts = reliable_checkpoint(count_words(docs.where(usable), text_col))
    v = vocabulary(counts, symbols, head)
    rows = prepared(docs, v, usable, id_col, text_col)
    model = train(rows, v, **options)
    return score(rows, model, counts), v, model


def usable_rows(id_col: str = "doc_id") -> Column:
    """Rows that train: crc32 of the id as text, modulo 5, is not 1."""
    return F.coalesce(crc_remainder(id_col, 5) != 1, F.lit(False))


def scores(docs: DataFrame) -> DataFrame:
    found, v, _ = fitted_scores(docs, usable_rows())
    return found.select(
        "doc_id", F.coalesce(crc_remainder("doc_id", 5) == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(v.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
