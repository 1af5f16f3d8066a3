"""Top-k over bit slices, spectrum slicing and the Merkle manifest, against brute force."""
import binascii
import hashlib
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hiresight.llm import merkle, slices, whitening
from hiresight.llm.queries import SQL

VECTORS = "vec_id bigint, embedding array<float>, label int"


# ------------------------------------------------------------ op11 --------
@pytest.fixture(scope="module")
def vectors():
    """90 vectors of 6 entries: a third of them equal, ties, zeros, odd rows."""
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=6).round(3).tolist()) for i in range(60)] + [(100 + i, [0.5, -0.25, 0.0, 1.0, -1.0, 0.125]) for i in range(30)]
    rows += [(200, [0.0] * 6), (201, None), (202, [1.0, None] * 3), (203, [math.nan] + [0.0] * 5), (204, [math.inf] + [0.0] * 5), (205, []),
             (220, [1.0, 2.0]), (None, [1.0] * 6), (3, rows[3][1]), (20, rows[20][1])]
    return rows


def whole(rows, scale, d=6):
    fine = [(i, v) for i, v in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, tuple(math.floor(scale * float(np.float32(c))) for c in v)) for i, v in fine]


def test_top_scores(spark, vectors):
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], VECTORS).withColumns({"Rank": F.lit("x"), "id": F.lit(0), "x": F.lit(1)})
    held = sorted(set(x for x in whole(vectors, 64) if x[0] is not None))
    want = []
    for q, x in held:
        if q % 20 == 0:
            top = sorted((-sum(a * b for a, b in zip(x, y)), c) for c, y in held if c != q)[:20]
            want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(top)]
    for sizes in ({}, {"block": 7, "group": 2}):
        got = slices.search(df, lambda i: F.pmod(i, F.lit(20)) == 0, **sizes)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert {q for q, _, _, _ in want} == {0, 20, 40, 100, 120, 200}
    few = df.where("vec_id in (0, 1, 2)")
    assert [r.rank for r in slices.top_scores(few).orderBy("rank").collect()] == [1, 2]
    assert slices.top_scores(df.limit(0)).collect() == [] and slices.top_scores(df.where("vec_id = 1")).collect() == []
    two = spark.createDataFrame([(0, [1.0], 1), (0, [-1.0], 1), (1, [2.0], 1), (2, [float(1 << 40)], 1)], VECTORS)
    assert sorted(map(tuple, slices.top_scores(two).collect())) == [(0, 1, 1, -8192), (0, 1, 1, 8192)]


def test_slices_of_any_integers():
    r = np.random.default_rng(8)
    for n, d, most in ((1, 1, 1), (63, 3, 2), (64, 5, 1000), (200, 9, 1 << 24), (500, 40, 50)):
        x, ids = r.integers(-most, most + 1, (n, d)), r.permutation(n) * 3
        parts = slices.sliced(ids, x)
        block = slices.Block(pa.table({"dim": [p[0] for p in parts], "low": [p[1] for p in parts], "data": [p[2] for p in parts]}))
        for q in (*x[:3], np.zeros(d, np.int64), r.integers(-most, most + 1, d)):
            got_ids, got = block.best(int(ids[0]), q, 7)
            order = [i for i in np.lexsort((ids, -(x @ q))) if i != 0][:7]
            assert set(zip(got_ids.tolist(), got.tolist())) == set(zip(ids[order].tolist(), (x @ q)[order].tolist()))


# ------------------------------------------------------------ op12 --------
def test_leading_eigenpairs():
    r = np.random.default_rng(0)
    for d in (1, 2, 5, 33):
        u = np.linalg.qr(r.normal(size=(d, d)))[0]
        spectra = [r.random(d), np.full(d, 3.0), np.r_[np.full(min(3, d), 5.0), r.random(max(0, d - 3))], 10.0 ** -np.arange(d), 1 + 1e-9 * r.random(d),
                   np.r_[np.ones(1), np.zeros(d - 1)]]
        for w in spectra:
            v = u @ np.diag(w) @ u.T
            v = (v + v.T) / 2
            e, q = whitening.leading(v, 4)
            true = np.linalg.eigvalsh(v)[::-1]
            assert np.allclose(e, true[:4], rtol=0, atol=1e-13 * d) and np.abs(q @ q.T - np.eye(len(q))).max() < 1e-12
            assert np.abs(v @ q.T - q.T * e).max() < 1e-12 * d
            assert all(whitening.below(v, s) == (true < s).sum() for s in (-1.0, 0.37, 2.0, 7.0))
    assert whitening.leading(np.zeros((3, 3)), 4)[0].tolist() == [0.0] * 3


def brute_whitening(x):
    u = np.array(sorted(set(map(tuple, x))), dtype=np.int64)
    n, s = len(u), u.sum(0)
    z = u - s / n
    w, q = np.linalg.eigh(z.T @ z / n)
    w, q = w[::-1][:4], q[:, ::-1][:, :4]
    return n, [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x], (np.array(x) - s / n) @ q / np.sqrt(w), w / np.trace(z.T @ z / n)


def test_whitening(spark, vectors):
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], VECTORS).withColumns({"Component": F.lit("x"), "_x": F.lit(0), "n": F.lit(1)})
    rows = whole(vectors, 256)
    n, deviation, y, share = brute_whitening([x for _, x in rows])
    got = sorted(whitening.whitened(df).collect(), key=lambda t: (t.component, t.vec_id is None, t.vec_id, t.deviation))
    key = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0], deviation[i]))
    assert len(got) == 4 * len(rows)
    for j in range(4):
        part = got[j * len(rows): (j + 1) * len(rows)]
        assert [t.vec_id for t in part] == [rows[i][0] for i in key] and [t.deviation for t in part] == [deviation[i] for i in key]
        values, want = np.array([t.whitened for t in part]), y[key, j]
        assert np.abs(values - np.sign(values @ want) * want).max() < 1e-9
        assert {t.n for t in part} == {n} and all(abs(t.explained - share[j]) < 1e-12 and t.identity_error < 1e-9 for t in part)
    assert whitening.whitened(df.limit(0)).collect() == []
    assert whitening.whitened(df.where("vec_id in (201, 205)")).collect() == []


def test_whitening_without_variance(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0], 1) for i in range(3)], VECTORS)
    assert {(t.component, t.n, t.deviation, t.whitened, t.explained, t.identity_error) for t in whitening.whitened(same).collect()} == \
        {(c, 1, 0, None, None, None) for c in (1, 2, 3)}
    two = spark.createDataFrame([(1, [0.0, 1.0], 1), (2, [1.0, 1.0], 1), (3, [1.0, 1.0], 1)], VECTORS)
    got = {(t.vec_id, t.component): (t.deviation, t.whitened, t.explained) for t in whitening.whitened(two).collect()}
    assert {k: v[1] for k, v in got.items() if k[1] == 2} == {(i, 2): None for i in (1, 2, 3)} and got[1, 2][2] == 0.0
    assert got[1, 1][0] == 256 * 256 and abs(abs(got[1, 1][1]) - 1) < 1e-12 and got[1, 1][1] == -got[3, 1][1] and got[1, 1][2] == 1.0
    large = spark.createDataFrame([(1, [1e13]), (2, [1e13 + 1]), (3, [-1e13]), (4, [1e300])], "vec_id bigint, embedding array<double>")
    x = [int(256 * c) for c in (1e13, 1e13 + 1, -1e13)]
    want = [sum([(3 * c - sum(x)) ** 2]) for c in x]
    assert {t.vec_id: t.deviation for t in whitening.whitened(large).collect()} == {i + 1: (w if w < 1 << 63 else None) for i, w in enumerate(want)}


# ------------------------------------------------------------ op13 --------
def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """Root, and each leaf's list of (place, siblings)."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, i in zip(proofs, at):
            run = nodes[i // 16 * 16: i // 16 * 16 + 16]
            p.append((i % 16, "".join(run[: i % 16] + run[i % 16 + 1:])))
        nodes, at = [sha(*nodes[a: a + 16]) for a in range(0, len(nodes), 16)], [i // 16 for i in at]
    return nodes[0], proofs


def brute_manifest(rows):
    by = {}
    for x in rows:
        by.setdefault(x[3], []).append((x[0] is not None, x[0] or 0, sha(*map(encoded, (x[0], x[3], x[2], x[4], x[1]))), x))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([t[2] for t in sorted(by[s], key=lambda t: t[:3])]) for s in sources]
    root, tops = tree([t[0] for t in trees])
    out = []
    for s, (sub, proofs), top in zip(sources, trees, tops):
        for (_, _, leaf, x), proof in zip(sorted(by[s], key=lambda t: t[:3]), proofs):
            h = leaf
            if x[0] is not None and binascii.crc32(str(x[0]).encode()) % 5 == 0:
                h = sha(*map(encoded, (x[0], x[3], x[2], x[4], None if x[1] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in x[1]))))
            for i, rest in proof + top:
                h = sha(rest[: 64 * i], h, rest[64 * i:])
            out.append((x[0], leaf, sub, root, sha(*(r for _, r in proof + top)), h, h == root))
    return out


def odd_documents(n):
    r = random.Random(4)
    rows = [(i, f"Text Ä {i} " * r.randrange(3), "en", f"s{i % 3}" if i % 7 else None, i) for i in range(n)]
    rows += [(n + i, f"Q{i}", None, f"t{i:03d}é", None) for i in range(20)]                # more than 16 sources
    return rows + [(5000 + n, None, None, None, None), (None, "A", "de", "s1", 1), (None, "A", "de", "s1", 1), (3, "Other", "en", "s0", 3), rows[1],
                   (9000, "ÀZ" * 40_000, "en", "s2", 80_000), (9001, "", "", "", 0)]


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_manifest(spark, monkeypatch):
    key = lambda t: tuple((v is None, str(v)) for v in t)
    rows = odd_documents(700)
    df = spark.createDataFrame(rows, DOCS).withColumns({"Leaf": F.lit("x"), "pos": F.lit(1), "tree": F.lit(2), "_salt": F.lit(3)})
    assert sorted(map(tuple, merkle.verification(df).collect()), key=key) == sorted(((a, b, c, d, e, f, g) for a, b, c, d, e, f, g in brute_manifest(rows)), key=key)
    one = rows[:1]
    got = merkle.verification(spark.createDataFrame(one, DOCS)).first()
    assert got.leaf == got.subroot == got.root and got.proof_sha256 == sha("")
    assert merkle.verification(df.limit(0)).collect() == []


def test_appender_attaches_and_extends_witnesses():
    for n, levels in ((1, 0), (2, 1), (16, 1), (17, 2), (256, 2), (300, 3), (4096, 3), (1, 3)):
        nodes = [sha(str(i)) for i in range(n)]
        block, witnesses = merkle.Appender(levels), [[] for _ in nodes]
        for i, (h, w) in enumerate(zip(nodes, witnesses)):
            block.append(h.encode(), w)
            assert len(w) == (1 if levels and i % 16 == 15 else 0) + (1 if levels > 1 and i % 256 == 255 else 0) + (1 if levels > 2 and i == 4095 else 0)
        root = block.root().decode()
        if n > 1:
            want, proofs = tree(nodes)
            assert root == want and [[(p["at"], p["rest"].decode()) for p in w] for w in witnesses] == proofs
        else:                                                        # a last block of one node goes up alone
            want = nodes[0]
            for _ in range(levels):
                want = sha(want)
            assert root == want


def test_proofs_across_blocks(spark):
    """A source of several blocks: 4096 + 4096 + 3 leaves."""
    rows = [(i, f"T{i}", "en", "a" if i < 8195 else "b", i) for i in range(8200)]
    df = spark.createDataFrame(rows, DOCS).repartition(8)
    assert sorted(map(tuple, merkle.verification(df).collect())) == sorted(brute_manifest(rows))


def test_sql_of_exact_operators(spark, tmp_path, vectors):
    rows = [x for x in odd_documents(300) if x[0] is not None]
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, v, 1) for i, v in vectors if v is None or len(v) == 6], VECTORS).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    for name, op, t in (("op13_merkle", merkle.verification, "documents"), ("op11_topk", slices.top_scores, "embeddings")):
        got = op(spark.read.parquet(f"{tmp_path}/{t}.parquet"))
        res = con.execute(SQL[name])
        cols = [d[0] for d in res.description]
        assert sorted(cols) == sorted(got.columns)
        assert sorted(map(str, map(tuple, got.select(*cols).collect()))) == sorted(map(str, map(tuple, res.fetchall())))


# ---------------------------------------------- signatures of the Jaccard join --
def test_signatures_lose_no_link():
    from hiresight.llm import nearjoin as NJ
    r = np.random.default_rng(6)
    base = [np.unique(r.integers(0, 1 << 63, m, dtype=np.uint64)) for m in (5, 40, 90, 100, 300, 3000)]
    arrays = [np.unique(np.concatenate([r.permutation(b)[: max(1, int(len(b) * (1 - cut)))], r.integers(0, 1 << 63, int(len(b) * add), dtype=np.uint64)]))
              for b in base for cut, add in ((0, 0), (0.05, 0.02), (0.1, 0.1), (0.3, 0), (0.02, 0.2))]
    n = np.array([len(a) for a in arrays])
    assert all(NJ.folded([NJ.signature(arrays[-1]), NJ.signature(a)])[0].tobytes() == np.bitwise_or.reduce(
        np.frombuffer(NJ.signature(arrays[-1]), np.uint64).reshape(-1, len(NJ.signature(a)) // 8), axis=0).tobytes() for a in arrays[:3])
    for percent in (80, 60):
        for across in (False, True):
            side = r.integers(0, 2, len(arrays))
            edges = NJ.possible_tile([NJ.signature(a) for a in arrays], n, side, across, percent)
            group = list(range(len(arrays)))

            def root(i):
                while group[i] != i:
                    i = group[i]
                return i
            for u, v in edges:
                assert root(u) != root(v)                                       # a forest
                group[root(u)] = root(v)
            for i in range(len(arrays)):
                for j in range(i):
                    if (not across or side[i] != side[j]) and NJ.overlap(arrays[i], arrays[j]) >= NJ.least_overlap(int(n[i]), int(n[j]), percent):
                        assert root(i) == root(j)
