"""Operator 3, quality classifier by positive-unlabelled learning.

Trusted positives (``quality = 1``) and unlabelled texts of the corpus train an
additive model over per-text statistics by minimising the non-negative
unbiased risk

    prior * E_pos[l(z)] + max(0, E_unl[l(-z)] - prior * E_pos[l(-z)])

with logistic loss, full batches and Adam.  The class prior is estimated: the
smallest ratio, over score thresholds of a positive-against-unlabelled model,
of unlabelled to positive texts above it, on the half not used to fit it.

Labelled negatives take no part.  Training reads bounded samples (``sample``
whole positives and as many unlabelled texts, chosen by a hash).

Defined cases: null and empty texts have the statistics of an empty text and
are scored like any other; labels without an id or quality don't train; a
document with several labels is positive if one is; without positives every
score is the prior 0.5; texts may be of any length; other columns pass through.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import crc_remainder, fresh, hash_share, ship_package
from .textkit import each_text, shingle_hashes, word_hashes

#: Whole positive texts, and whole unlabelled texts, that train.
SAMPLE = 8000
THRESHOLD = 0.7

_OTHER, _LOWER, _UPPER, _DIGIT, _BLANK, _LINE, _STOP, _BANG, _PIPE, _SYMBOL, _WIDE = range(11)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[np.arange(97, 123)], _CLASS[np.arange(65, 91)], _CLASS[np.arange(48, 58)] = _LOWER, _UPPER, _DIGIT
_CLASS[[32, 9, 11, 12, 13]], _CLASS[10], _CLASS[np.arange(128, 256)] = _BLANK, _LINE, _WIDE
for _c in "#$%&*+/<=>@[\\]^_`{}~":
    _CLASS[ord(_c)] = _SYMBOL
for _c in ".,;:?'\"-()":
    _CLASS[ord(_c)] = _STOP
_CLASS[ord("!")], _CLASS[ord("|")] = _BANG, _PIPE
N_FEATURES = 28


def features(text: bytes | None) -> np.ndarray:
    """Statistics of a whole text."""
    out = np.zeros(N_FEATURES, np.float32)
    ws = text.split() if text else []
    if not ws:
        return out
    raw = _CLASS[np.frombuffer(text, np.uint8)]
    out[:11] = np.log1p(200 * np.bincount(raw, minlength=11)[:11] / len(raw))
    n, lengths = len(ws), np.fromiter(map(len, ws), np.int64, len(ws))
    kind = _CLASS[np.frombuffer(b" ".join(ws), np.uint8)]
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    run = lambda hit: np.concatenate([[0], np.cumsum(hit)])
    upper, letters, marks = (run(x) for x in (kind == _UPPER, (kind == _LOWER) | (kind == _UPPER) | (kind == _WIDE), (kind == _SYMBOL) | (kind == _BANG) | (kind == _PIPE)))
    word_upper, word_letters, word_marks = (x[ends] - x[starts] for x in (upper, letters, marks))
    h = word_hashes(ws)
    _, each = np.unique(h, return_counts=True)
    same = h[1:] == h[:-1]
    breaks = np.flatnonzero(np.concatenate([[True], ~same, [True]]))
    pairs = shingle_hashes(ws, 2)
    lines = [x.strip() for x in text.split(b"\n")]
    filled = [x for x in lines if x]
    share = lambda hit: np.log1p(200 * float(np.mean(hit))) if len(hit) else 0.0
    out[11:] = [np.log1p(n), lengths.mean(), lengths.std(), share(lengths == 1), share(lengths > 24),
                share((word_letters > 1) & (word_upper == word_letters)), share(word_letters == 0), share(word_marks > 0),
                share(word_marks > 2), share(same), share(h[2:] == h[:-2]), len(each) / n, each.max() / n, np.log1p(np.diff(breaks).max()),
                len(np.unique(pairs)) / len(pairs), np.log1p(n / max(1, len(filled))), share(np.array([1 - len(set(filled)) / max(1, len(filled))]))]
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass
class PuModel:
    centre: np.ndarray
    scale: np.ndarray
    cuts: list[np.ndarray]
    weights: np.ndarray
    prior: float

    def basis(self, x: np.ndarray) -> np.ndarray:
        """Standardised statistics, a step at each cut, and a constant."""
        steps = [(x[:, [k]] > c).astype(np.float32) for k, c in enumerate(self.cuts) if len(c)]
        return np.hstack([np.clip((x - self.centre) / self.scale, -5, 5), *steps, np.ones((len(x), 1))]).astype(np.float32)

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.basis(x) @ self.weights).astype(float)


def fit_risk(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-3,
             non_negative: bool = True) -> np.ndarray:
    """Weights that minimise the non-negative risk (or, without ``non_negative``,
    plain logistic risk of positives against unlabelled)."""
    w = np.zeros(pos.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        zp, zu = pos @ w, unl @ w
        up = pos.T @ (_sigmoid(zp) - 1) / len(pos)          # gradient of E_pos[l(z)]
        down_p = pos.T @ _sigmoid(zp) / len(pos)            # of E_pos[l(-z)]
        down_u = unl.T @ _sigmoid(zu) / len(unl)            # of E_unl[l(-z)]
        if not non_negative:
            g = prior * up + (1 - prior) * down_u
        elif np.logaddexp(0, zu).mean() >= prior * np.logaddexp(0, zp).mean():
            g = prior * up + down_u - prior * down_p
        else:
            g = prior * down_p - down_u
        g = g + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Largest share of positives that the unlabelled texts allow."""
    w = fit_risk(pos[::2], unl[::2], 0.5, steps=200, non_negative=False)
    p, u = np.sort(pos[1::2] @ w), np.sort(unl[1::2] @ w)
    if len(p) < 20 or len(u) < 20:
        return 0.5
    cuts = np.quantile(p, np.linspace(0, 0.7, 36))
    above_p = 1 - np.searchsorted(p, cuts) / len(p)
    above_u = 1 - np.searchsorted(u, cuts) / len(u)
    error = np.sqrt(above_u * (1 - above_u) / len(u)) + np.sqrt(above_p * (1 - above_p) / len(p))
    return float(np.clip(np.min((above_u + error) / np.maximum(above_p, 1e-9)), 0.05, 0.98))


def fit(pos: np.ndarray, unl: np.ndarray) -> PuModel:
    centre, scale = unl.mean(0), unl.std(0) + 1e-6
    cuts = []
    for k in range(unl.shape[1]):
        low, each = unl[:, k].min(), np.unique(unl[:, k])
        inner = unl[unl[:, k] > low, k]
        found = np.quantile(inner, [0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98]) if len(inner) else np.empty(0)
        cuts.append(np.unique(np.concatenate([[low], found])).astype(np.float32) if len(each) > 1 else np.empty(0, np.float32))
    model = PuModel(centre.astype(np.float32), scale.astype(np.float32), cuts, np.zeros(0), 0.5)
    bp, bu = model.basis(pos).astype(float), model.basis(unl).astype(float)
    model.prior = estimate_prior(bp, bu)
    model.weights = fit_risk(bp, bu, model.prior)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          usable: Column | None = None, sample: int = SAMPLE) -> PuModel | None:
    """Train on rows where ``usable`` holds; at most about twice ``sample`` rows
    of ``N_FEATURES`` numbers reach the driver."""
    ship_package(docs.sparkSession)
    usable = usable_rows(id_col) if usable is None else usable
    ids = labels.where(usable & (F.col(label_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("positive_id")).distinct()
    n_pos = ids.count()
    if not n_pos:
        return None
    ids = ids.where(hash_share([F.col("positive_id")], min(1.0, sample / n_pos)))
    rows = docs.where(usable)
    share = min(1.0, sample / max(1, rows.count()))

    @F.arrow_udf("array<float>")
    def stats(texts: pa.Array) -> pa.Array:
        return pa.array([features(t).tolist() for t in each_text(texts)], pa.list_(pa.float32()))

    picked = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), hash_share([F.col(id_col)], share, seed=2).alias("web")) \
        .join(F.broadcast(ids), F.col("id") == F.col("positive_id"), "left").where(F.col("web") | F.col("positive_id").isNotNull())
    got = picked.select("id", "web", F.col("positive_id").isNotNull().alias("pos"), stats("text").alias("x")).toPandas().sort_values("id")
    x = np.array(got["x"].tolist(), np.float32).reshape(-1, N_FEATURES)
    pos, web = x[got["pos"].to_numpy(bool)], x[got["web"].to_numpy(bool)]
    return fit(pos, web) if len(pos) and len(web) else None


def usable_rows(id_col: str = "doc_id") -> Column:
    """Rows that may train: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(crc_remainder(id_col, 4) != 2, F.lit(False))


def with_scores(docs: DataFrame, model: PuModel | None, text_col: str = "text", out: str = "quality_score") -> tuple[DataFrame, str]:
    """``docs`` with a score column, and its name."""
    ship_package(docs.sparkSession)
    out = fresh(docs.columns, out)
    if model is None:
        return docs.withColumn(out, F.lit(0.5)), out
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            x = [features(t) for t in each_text(texts)]
            yield pa.array(held.value.score(np.stack(x)) if x else [], pa.float64())

    return docs.withColumn(out, score(F.col(text_col))), out


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the classifier accepts, columns as they were."""
    found, out = with_scores(docs, train(docs, labels))
    return found.where(F.col(out) >= THRESHOLD).drop(out)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found, out = with_scores(docs.select("doc_id", "text"), train(docs, labels))
    return found.select("doc_id", F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                        F.col(out).alias("score"), (F.col(out) >= THRESHOLD).cast("int").alias("predicted"))
