"""Operator 9, language identification.

One interpolated Kneser-Ney character model (order 4) per language.  The
n-grams of all languages are kept in one sorted hash array per order, with a
column of log probabilities per language; backoff weights likewise.  A text is
given the language of the lowest cross-entropy per character; it is marked
``rejected`` where even that lies far outside what training texts of its length
show.

Characters: lower-cased letters; each run of anything else is one blank.

Training reads a bounded sample of whole labelled texts (``sample_docs`` per
language, chosen by a hash); n-gram counts are aggregated by Spark.

Defined cases: a null text, or one without a letter, is ``und`` with score 0
and rejected; rows with a null language or id don't train; without any training
row every text is ``und``; ties go to the language first in code point order;
texts may be of any length; other columns pass through.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import crc_remainder, fresh, hash_share, ship_package
from .textkit import mix64

ORDER = 4
#: Whole training texts per language.
SAMPLE_DOCS = 1500
#: Rejection: beyond so many times the largest deviation of any training text,
#: and so many times the usual cross-entropy of the language.
REJECT_FACTOR, REJECT_RATIO = 2.0, 2.0
RESULT = "struct<lang:string,score:double,cross_entropy:double,n_chars:bigint,rejected:boolean>"
_TYPE = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()), ("n_chars", pa.int64()), ("rejected", pa.bool_())])
_LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
_A = np.uint64(0x2545F4914F6CDD1D)


def characters(text: str | None) -> np.ndarray:
    """Code points: three blanks, lower-cased letters with single blanks, a blank.
    Empty if there is no letter."""
    if not text:
        return np.empty(0, np.uint32)
    x = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    x = np.where(_LETTER[x], x, np.uint32(0))
    keep = x != 0
    keep[1:] |= x[:-1] != 0
    x = x[keep]
    if not x.any():
        return np.empty(0, np.uint32)
    x = x[1:] if x[0] == 0 else x
    x = x if x[-1] == 0 else np.append(x, np.uint32(0))
    return np.concatenate([np.zeros(ORDER - 1, np.uint32), x])


def gram_hash(*chars: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = np.full(len(chars[0]), np.uint64(len(chars)))
        for c in chars:
            h = (h ^ c.astype(np.uint64)) * _A
            h ^= h >> np.uint64(29)
    return mix64(h)


def distinct_grams(x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct n-grams of a text (characters by place) and their counts."""
    places = [x[k: len(x) - ORDER + 1 + k] for k in range(ORDER)]
    _, at, n = np.unique(gram_hash(*places), return_index=True, return_counts=True)
    return [p[at] for p in places], n


def _look(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``h`` in a sorted array, and which of them hit."""
    if not len(keys):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return at, keys[at] == h


class _One:
    """Interpolated Kneser-Ney of one language from its distinct n-grams."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, alphabet: int):
        self.alphabet, self.orders = alphabet, {}
        chars, c = [grams[:, k] for k in range(ORDER)], counts.astype(float)
        for n in range(ORDER, 0, -1):
            n1, n2 = float((c == 1).sum()), float((c == 2).sum())
            discount = min(0.95, n1 / (n1 + 2 * n2)) if n1 and n2 else 0.5
            ctx, back = np.unique(gram_hash(*chars[:-1]), return_inverse=True) if n > 1 else (np.zeros(1, np.uint64), np.zeros(len(c), np.int64))
            total = np.bincount(back, c)
            weight = discount * np.bincount(back) / total
            key = gram_hash(*chars)
            order = np.argsort(key)
            self.orders[n] = (key[order], ((c - discount) / total[back])[order], ctx, weight)
            if n > 1:  # below: in how many contexts each shorter n-gram continues
                _, at, types = np.unique(gram_hash(*chars[1:]), return_index=True, return_counts=True)
                chars, c = [x[at] for x in chars[1:]], types.astype(float)

    def backoff(self, chars: list[np.ndarray], n: int) -> np.ndarray:
        """Weight of the lower order after the context of each n-gram."""
        _, _, ctx, weight = self.orders[n]
        if n == 1:
            return np.full(len(chars[0]), weight[0])
        at, hit = _look(ctx, gram_hash(*chars[:-1]))
        return np.where(hit, weight[at], 1.0)

    def prob(self, chars: list[np.ndarray]) -> np.ndarray:
        n = len(chars)
        keys, p, _, _ = self.orders[n]
        at, hit = _look(keys, gram_hash(*chars))
        lower = self.prob(chars[1:]) if n > 1 else np.full(len(chars[0]), 1.0 / self.alphabet)
        return np.where(hit, p[at], 0.0) + self.backoff(chars, n) * lower


@dataclass
class KneserNey:
    """Sorted hash arrays: per order, n-grams with log probabilities [n, language],
    and contexts with log backoff weights."""
    langs: list[str]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    contexts: dict[int, tuple[np.ndarray, np.ndarray]]
    floor: np.ndarray
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None

    @classmethod
    def train(cls, rows: dict[str, tuple[np.ndarray, np.ndarray]]) -> "KneserNey":
        langs = sorted(rows)
        if not langs:
            return cls([], {}, {}, np.empty(0, np.float32))
        alphabet = len({int(c) for g, _ in rows.values() for c in np.unique(g)}) + 1
        models = [_One(*rows[x], alphabet) for x in langs]
        every = np.concatenate([g for g, _ in rows.values()]) if rows else np.zeros((0, ORDER), np.uint32)
        grams, contexts = {}, {}
        for n in range(ORDER, 0, -1):
            chars = [every[:, k] for k in range(ORDER - n, ORDER)]
            key, at = np.unique(gram_hash(*chars), return_index=True)
            own = [c[at] for c in chars]
            grams[n] = (key, np.stack([np.log(m.prob(own)) for m in models], 1).astype(np.float32))
            if n > 1:
                key, at = np.unique(gram_hash(*chars[:-1]), return_index=True)
                own = [c[at] for c in chars]
                contexts[n] = (key, np.stack([np.log(m.backoff(own, n)) for m in models], 1).astype(np.float32))
        floor = np.array([np.log(m.orders[1][3][0] / alphabet) for m in models], np.float32)
        return cls(langs, grams, contexts, floor)

    def log_probs(self, chars: list[np.ndarray]) -> np.ndarray:
        n = len(chars)
        keys, p = self.grams[n]
        at, hit = _look(keys, gram_hash(*chars))
        out = p[at]
        miss = np.flatnonzero(~hit)
        if len(miss):
            rest = [c[miss] for c in chars]
            if n == 1:
                out[miss] = self.floor
            else:
                ctx, w = self.contexts[n]
                at, hit = _look(ctx, gram_hash(*rest[:-1]))
                out[miss] = self.log_probs(rest[1:]) + np.where(hit[:, None], w[at], np.float32(0))
        return out

    def cross_entropies(self, text: str | None) -> tuple[int, np.ndarray | None]:
        """Characters, and nats per character under each language."""
        x = characters(text)
        if not len(x) or not self.langs:
            return 0, None
        chars, n = distinct_grams(x)
        return int(n.sum()), -(n @ self.log_probs(chars).astype(np.float64)) / n.sum()

    def calibrate(self, told: list[tuple[str, int, float]]) -> None:
        """Centre and spread of the cross-entropy of each language's own texts."""
        self.centre, self.spread = np.zeros(len(self.langs)), np.ones(len(self.langs))
        for k, lang in enumerate(self.langs):
            own = np.array([(n, h) for x, n, h in told if x == lang and n], float).reshape(-1, 2)
            if len(own):
                self.centre[k] = np.median(own[:, 1])
                self.spread[k] = max(0.5, float(np.max(np.abs(own[:, 1] - self.centre[k]) * np.minimum(np.sqrt(own[:, 0]), 30.0))))

    def predict(self, text: str | None) -> tuple[str, float, float | None, int, bool]:
        n, h = self.cross_entropies(text)
        if h is None:
            return "und", 0.0, None, 0, True
        best = int(np.argmin(h))
        p = 1.0 / float(np.exp((h[best] - h) * min(n, 50)).sum())
        far = self.centre is not None and h[best] > REJECT_RATIO * self.centre[best] \
            and (h[best] - self.centre[best]) * min(np.sqrt(n), 30.0) > REJECT_FACTOR * self.spread[best]
        return self.langs[best], p, float(h[best]), n, bool(far)


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_docs: int = SAMPLE_DOCS) -> KneserNey:
    """Train on rows where ``usable`` holds; n-gram counts are summed by Spark,
    and what reaches the driver is bounded by the sample."""
    ship_package(docs.sparkSession)
    spark = docs.sparkSession
    rows = docs.where(usable & F.col(lang_col).isNotNull())
    counts = {r.lang: r.n for r in rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return KneserNey.train({})
    shares = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, sample_docs / n))])
    sample = rows.where(hash_share([F.col(id_col)], shares[F.col(lang_col)])).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = characters(text)
                if len(x):
                    held.setdefault(lang, []).append(x)
            for lang, xs in held.items():
                parts = [distinct_grams(x) for x in xs]
                chars = [np.concatenate([p[0][k] for p in parts]) for k in range(ORDER)]
                n = np.concatenate([p[1] for p in parts])
                _, at, back = np.unique(gram_hash(*chars), return_index=True, return_inverse=True)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), **{f"c{k}": chars[k][at].astype(np.int32) for k in range(ORDER)},
                                                  "n": np.bincount(back, n).astype(np.int64)})

    keys = ["lang", *[f"c{k}" for k in range(ORDER)]]
    table = sample.mapInArrow(grams, "lang string, " + ", ".join(f"c{k} int" for k in range(ORDER)) + ", n bigint") \
        .groupBy(*keys).agg(F.sum("n").alias("n")).toPandas().sort_values(keys)
    model = KneserNey.train({lang: (g[keys[1:]].to_numpy(np.uint32), g["n"].to_numpy()) for lang, g in table.groupby("lang")})
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<n:bigint,h:double>")
    def entropy(langs: pa.Array, texts: pa.Array) -> pa.Array:
        m, out = held.value, []
        for lang, text in zip(langs.to_pylist(), texts.to_pylist()):
            n, h = m.cross_entropies(text)
            out.append({"n": n, "h": float(h[m.langs.index(lang)]) if h is not None and lang in m.langs else 0.0})
        return pa.array(out, pa.struct([("n", pa.int64()), ("h", pa.float64())]))

    told = sample.select("lang", entropy("lang", "text").alias("e")).select("lang", "e.n", "e.h").collect()
    model.calibrate([(r.lang, r.n, r.h) for r in told])
    return model


def identify(docs: DataFrame, model: KneserNey, text_col: str = "text", out: str = "language") -> tuple[DataFrame, str]:
    """``docs`` with one struct column of findings, and its name."""
    ship_package(docs.sparkSession)
    out = fresh(docs.columns, out)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def told(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = held.value
        for batch in batches:
            yield pa.array([dict(zip(("lang", "score", "cross_entropy", "n_chars", "rejected"), m.predict(t))) for t in batch.to_pylist()], _TYPE)

    return docs.withColumn(out, told(F.col(text_col))), out


def usable_rows(id_col: str = "doc_id") -> Column:
    """Rows that may train: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(crc_remainder(id_col, 4) != 2, F.lit(False))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows whose language isn't rejected, columns as they were."""
    found, out = identify(docs, train(docs, usable_rows()))
    return found.where(~F.col(out)["rejected"]).drop(out)


def predictions(docs: DataFrame) -> DataFrame:
    model = train(docs, usable_rows())
    found, out = identify(docs.select("doc_id", "text"), model)
    f = F.col(out)
    return found.select("doc_id", F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                        f["lang"].alias("lang_pred"), f["score"].alias("score"), f["rejected"].alias("rejected"))
