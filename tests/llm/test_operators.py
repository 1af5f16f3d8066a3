"""The corpus operators on small tables with odd rows, against brute force."""
import binascii
import hashlib
import itertools
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hiresight.llm import ann, decontam, graph, hmm, htmltext, langid, mixing, nearjoin, quality, toxicity, warc
from hiresight.llm.frames import fresh

from .test_parts import brute_scan, lower, roots

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"


def crc(i, mod):
    return binascii.crc32(str(i).encode()) % mod


@pytest.fixture(scope="module")
def corpus():
    """120 documents: two languages, near copies, copies, junk, toxic words, odd rows."""
    r = random.Random(5)
    say = {"en": "the of and river stone house light water green walk table window".split(),
           "de": "der und nicht fluß stein haus licht wasser grün gehen tisch fenster".split()}
    rows = []
    for i in range(100):
        lang = "en" if i % 3 else "de"
        text = " ".join(r.choice(say[lang]) + (". " if r.random() < 0.1 else "") for _ in range(r.randrange(40, 90)))
        rows.append([i, text, lang, f"s{i % 4}" if i % 5 else None, len(text)])
    for i in range(8):                                   # near copies of 0, copies of 1
        ws = rows[0][1].split()
        rows.append([100 + i, " ".join(ws[: len(ws) - i // 4] + ["End"] * (i % 2)), "de", "s1", 1])
        rows.append([200 + i, rows[1][1], "en", "s9", 1])
    for i in range(10):                                  # junk and toxic texts
        rows.append([300 + i, "$$$ %%% BUY!! NOW!! | | " * (20 + i), "en", "s2", 1])
        rows.append([400 + i, rows[i][1] + " you idiot loser idiot", "en", "s2", 1])
    rows += [[500, None, None, None, None], [501, "", "en", "s1", 0], [502, " \t\n", None, "s1", 3], [None, "der und nicht", "de", "s1", 1],
             [503, "word", "en", "s1", 4], [503, "word", "en", "s1", 4], [504, "river " * 60_000, "en", "s3", 1]]
    return rows


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame([tuple(x) for x in corpus], DOCS).withColumns({"Score": F.lit("x"), "mix": F.lit(1), "contamination": F.lit(2), "predicted": F.lit(0)})


@pytest.fixture(scope="module")
def labels(spark, corpus):
    rows = [(x[0], 0 if 300 <= (x[0] or 0) < 400 else 1, 1 if 400 <= (x[0] or 0) < 500 else 0) for x in corpus if x[0] is not None and x[0] < 450]
    return spark.createDataFrame([*rows, (None, 1, 1), (7, None, None), rows[0]], LABELS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_decontamination(spark, docs, corpus, empty):
    items = [(1, " ".join(corpus[3][1].split()[5:30])), (2, "word"), (3, None), (4, "..."), (None, "river"), (2, "word"), (10, corpus[4][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    told = [(str(i), t) for i, t in items if i is not None and t]
    want = []
    for x in corpus:
        n, hit, found = brute_scan(told, x[1] or "", 10)
        want.append((x[0], n, len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    key = lambda t: (t[0] is None, t)
    assert sorted(map(tuple, decontam.digest(docs, bench).collect()), key=key) == sorted(want, key=key)
    found, out = decontam.find_contamination(docs, bench, block_bytes=60)
    assert out == "contamination_" and found.columns[:-1] == docs.columns
    assert {r.doc_id: sorted(r[out].item_ids) for r in found.where("doc_id < 60").collect()} == \
        {x[0]: sorted(brute_scan(told, x[1] or "", 10)[2]) for x in corpus if x[0] is not None and x[0] < 60}
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not w[5] for w in want)
    assert decontam.digest(empty, bench).count() == 0
    assert not decontam.digest(docs, bench.limit(0)).where("contaminated").count()


def test_mixing(spark, docs, corpus, empty):
    got = mixing.report(docs).collect()
    size = lambda t: len(re.findall("[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.size) for r in got) == Counter((x[0], size(x[1])) for x in corpus)
    totals = Counter()
    for x in corpus:
        totals[x[3]] += size(x[1])
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    lo, hi = 0.0, 1e9
    for _ in range(200):
        level = (lo + hi) / 2
        lo, hi = (level, hi) if sum(min(2 * totals[s], weight[s] * level) for s in order) < 1.5 * sum(totals.values()) else (lo, level)
    source = {x[0]: x[3] for x in corpus}
    taken, by_row = Counter(), {}
    for r in got:
        s = source[r.doc_id]
        assert abs(r.target - min(2 * totals[s], weight[s] * level)) < 1e-3 and r.source_size == totals[s]
        assert 0 <= r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
        taken[s] += r.taken
        by_row[r.doc_id] = r.target
    largest = max(size(x[1]) for x in corpus if x[0] != 504)
    for s in order:
        if s != "s3":  # holds a text longer than all others together
            assert abs(taken[s] - min(2 * totals[s], weight[s] * level)) <= largest
    again = mixing.report(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    rows = mixing.mix(docs)
    assert rows.columns == [*docs.columns, "epoch", "shard", "place"]
    assert Counter(r.doc_id for r in rows.collect()) == Counter({d: sum(r.taken // r.size for r in got if r.doc_id == d and r.size) for d in {r.doc_id for r in got if r.size and r.taken}}) \
        + Counter(r.doc_id for r in rows.where("trim(coalesce(text, '')) in ('', '\t\n')").collect())
    assert mixing.report(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_splitting_tree(spark):
    plan = spark.createDataFrame([(0, 1000), (1, 37), (2, 0), (3, 5)], "number bigint, quota bigint")
    ends = {r.number: r.ends for r in mixing.shard_ends(plan, 8).collect()}
    parts = {s: np.diff([0, *e]) for s, e in ends.items()}
    assert {s: int(p.sum()) for s, p in parts.items()} == {0: 1000, 1: 37, 2: 0, 3: 5}
    assert all((p >= 0).all() for p in parts.values())
    assert set(sum(p for p in parts.values())) <= {130, 131}    # every shard gets as many blocks
    assert (abs(parts[0] - 125) < 25).all()
    with pytest.raises(ValueError):
        mixing.shard_ends(plan, 3)


def test_hypergeometric_is_exact(spark):
    n = 20_000
    d = spark.range(n).select(mixing.hypergeometric(F.lit(30).cast("bigint"), F.lit(12).cast("bigint"), F.lit(10).cast("bigint"), (F.col("id") + 0.5) / n).alias("k"))
    got = {r.k: r["count"] / n for r in d.groupBy("k").count().collect()}
    from math import comb
    for k in range(11):
        assert abs(got.get(k, 0) - comb(12, k) * comb(18, 10 - k) / comb(30, 10)) < 2e-4


def test_quality(docs, labels, empty, corpus):
    got = quality.scores(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(x[0] for x in corpus)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) and r.held_out == (r.doc_id is not None and crc(r.doc_id, 4) == 2)
        if r.doc_id is not None and r.doc_id < 100:
            assert r.predicted == 1
        if r.doc_id is not None and 300 <= r.doc_id < 310:
            assert r.predicted == 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert quality.scores(empty, labels).count() == 0
    assert {r.score for r in quality.scores(docs, labels.limit(0)).collect()} == {0.5}


def test_toxicity(docs, labels, empty, corpus):
    got = toxicity.scores(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(x[0] for x in corpus)
    toxic = [r for r in got if r.doc_id is not None and 400 <= r.doc_id < 500]
    assert np.mean([r.score for r in toxic]) > 0.6 and all(r.evidence for r in toxic)
    clean = [r.score for r in got if r.doc_id is not None and r.doc_id < 100]
    assert max(clean) < min(r.score for r in toxic) and max(clean) < 0.7
    assert all(r.held_out == (r.doc_id is not None and crc(r.doc_id, 3) == 1) and r.predicted == int(r.score >= 0.7) for r in got)
    assert toxicity.scores(empty, labels).count() == 0
    one = toxicity.scores(docs, labels.where("toxic = 0")).collect()
    assert {r.score for r in one} == {0.0} and len(one) == len(got)


def test_warc(spark):
    same = "<p>" + "é" * 60
    rows = [(3, "http://a", same), (1, "http://b ", same), (9, None, same), (None, "u", same), (2, "x", None), (4, "y", ""), (5, "z", "short"), (6, "z", "short"),
            (7, "w", "q" * 200_000), (8, "v", "\r\n\r\nWARC/1.0\r\n" * 40), (1, "http://b ", same)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("payload", F.lit(1))
    got = Counter(tuple(r) for r in warc.round_trip(pages).collect())
    first = {"<p>" + "é" * 60: 1}
    want = Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        f = first.get(h)
        later = f is not None and i != f
        want[(i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if later else "response", f if later else None)] += 1
    assert got == want
    back = warc.read_archives(warc.archive(pages, file_bytes=500), split_bytes=64)
    assert Counter(r.payload.decode() for r in back.where("record_type = 'response'").collect()) == \
        Counter(h or "" for i, _, h in rows if h != same or i == 1)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_html(spark):
    page = "<nav><a href=/>Menu</a></nav><article><h1>T</h1><p>One  two &lt;3.<p>Three.</article><aside><p>Related.</p></aside><footer>&copy;</footer>"
    pages = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "v", ""), (None, "w", "no tags at all, just a sentence."), (1, "u", page)],
                                  "page_id bigint, url string, html string").withColumn("text", F.lit("kept"))
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in htmltext.extract(pages).collect()}
    assert got[(1, "u")] == ("T\n\nOne two <3.\n\nThree.", 22) and got[(2, None)] == ("", 0) and got[(3, "v")] == ("", 0)
    found, out = htmltext.with_text(pages)
    assert out == "text_" and found.count() == 5 and {r.text for r in found.collect()} == {"kept"}
    assert htmltext.extract(pages.limit(0)).count() == 0


def brute_components(rows, k=3, percent=90):
    def shingles(t):
        ws = re.findall("[^\x20\x09-\x0D]+", lower(t or ""))
        return {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)} or ({tuple(ws)} if ws else set())
    sets = [shingles(x[1]) for x in rows]
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if rows[i][0] is not None and rows[j][0] is not None and (
        rows[i][0] == rows[j][0] or sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]))]
    at = roots(len(rows), links)
    return Counter((x[0], len(sets[i]), None if x[0] is None else min(rows[j][0] for j in range(len(rows)) if at[j] == at[i])) for i, x in enumerate(rows))


def test_jaccard_join(spark, docs, corpus, empty, monkeypatch):
    r = random.Random(8)
    rows = [list(x) for x in corpus]
    for chain in range(3):                      # chains: each links with the next, the ends don't link
        ws = [f"w{chain}x{i}" for i in range(40)]
        for step in range(9):
            rows.append([600 + 10 * chain + step, " ".join(ws), "en", "s", 1])
            ws = ws[1:] + [f"n{chain}x{step}"]
    base = [f"b{i}" for i in range(60)]         # a large group of near copies that don't all link
    for i in range(60):
        ws = list(base)
        for _ in range(i % 3):
            ws[r.randrange(60)] = f"e{i}"
        rows.append([700 + i, " ".join(ws), "en", "s", 1])
    d = spark.createDataFrame([tuple(x) for x in rows], DOCS).withColumn("n_shingles", F.lit(-1))
    want = brute_components(rows)
    assert Counter(tuple(x) for x in nearjoin.near_components(d).collect()) == want
    kept = nearjoin.keep_one_each(d)
    assert kept.columns == d.columns
    assert Counter(x.doc_id for x in kept.collect()) == Counter({c: 1 for i, _, c in want if c is not None} | {None: 1})
    assert Counter(tuple(x) for x in nearjoin.near_components(d, k=5, percent=80).collect()) == brute_components(rows, 5, 80)
    monkeypatch.setattr(nearjoin, "BLOCK_ROWS", 7)    # several blocks in a band
    assert Counter(tuple(x) for x in nearjoin.near_components(d).collect()) == want
    assert nearjoin.near_components(empty).count() == 0


def test_jaccard_join_of_repeated_ids(spark):
    x, y = (" ".join(f"{c}{i}" for i in range(30)) for c in "xy")
    rows = [(5, x), (5, y), (2, y), (9, x), (9, ""), (7, None), (7, ""), (None, x), (8, y + " z"), (1, "a b c")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(tuple(r) for r in nearjoin.near_components(d).collect()) == brute_components(rows)


def test_texts_that_share_lines_do_not_all_meet(spark, monkeypatch):
    r, rows = random.Random(3), []
    line = [" ".join(f"l{i}x{j}" for j in range(6)) for i in range(150)]
    for i in range(150):                        # each shares a line with the text before and one with the text after
        own = [f"o{i}x{j}" for j in range(6 + i % 5)]
        rows.append((i, " ".join([line[i], *own, line[(i + 1) % 150]])))
    for i in range(0, 150, 10):                 # near copies, at and under 80 percent
        ws = rows[i][1].split()
        rows += [(200 + i, " ".join([*ws, "more"])), (400 + i, " ".join(ws[:-3])), (600 + i, " ".join([*ws, *(f"t{i}x{j}" for j in range(r.randrange(2, 7)))]))]
    rows += [(900 + n, " ".join(f"s{j}" for j in range(n))) for n in (1, 4, 5, 8, 9, 10, 12, 14, 17, 20, 24)]     # one in the other, at all sizes
    d, most, blocks = spark.createDataFrame(rows, "doc_id bigint, text string"), [], nearjoin._blocks

    def noted(nodes, *args):
        most.append(nodes.groupBy("label").count().agg(F.max("count")).first()[0])
        return blocks(nodes, *args)

    monkeypatch.setattr(nearjoin, "_blocks", noted)
    want = brute_components(rows, 5, 80)
    assert Counter(tuple(x) for x in nearjoin.near_components(d, k=5, percent=80).collect()) == want
    assert max(most) < 30                       # not all that lines chain, over 150
    for name, least in (("SIGNATURE_ROWS", 2), ("PART_ROWS", 3), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(nearjoin, name, least)
    assert Counter(tuple(x) for x in nearjoin.near_components(d, k=5, percent=80).collect()) == want


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (200, 150)]
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 150: 150, 200: 150}
    assert graph.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_nearest(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(400, 8)) * r.uniform(0.5, 2, (400, 1))
    rows = [(i, [float(np.float32(v)) for v in x[i]]) for i in range(400)]
    rows += [(1000 + i, rows[20][1]) for i in range(60)] + [rows[5]]
    rows += [(900, None), (901, []), (902, [0.0] * 8), (903, [float("nan")] * 8), (904, [1.0, None] * 4), (905, [1.0]), (None, rows[0][1]), (920, [float("inf")] * 8)]
    d = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("x"))
    fine = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and (i < 900 or i >= 1000)}
    ids = np.array(sorted(fine))
    m = np.stack([fine[i] for i in ids])
    want = {}
    for q in ids[ids % 20 == 0]:
        s = (m * fine[q]).sum(1)
        s[ids == q] = -np.inf
        want[int(q)] = [int(ids[j]) for j in np.lexsort((ids, -s))[:20]]
    got = {}
    for row in ann.nearest(d).collect():
        got.setdefault(row.query_id, {})[row.rank] = (row.vec_id, row.score)
    assert set(got) == set(want)
    hit = 0
    for q, w in want.items():
        assert sorted(got[q]) == list(range(1, 21))
        listed = [got[q][k] for k in range(1, 21)]
        assert listed == sorted(listed, key=lambda t: (-t[1], t[0]))
        assert all(abs(s - float((fine[q] * fine[i]).sum())) < 1e-12 and i != q for i, s in listed)
        hit += len({i for i, _ in listed} & set(w))
    assert hit / (20 * len(want)) >= 0.9
    few = ann.search(d.where("vec_id < 5"), lambda i: i == 0)
    assert few.count() == 4
    assert ann.nearest(d.where("vec_id is null")).count() == 0


def test_language_id(docs, corpus, empty):
    got = langid.predictions(docs).collect()
    lang = {x[0]: x[2] for x in corpus}
    assert len(got) == len(corpus)
    for r in got:
        assert r.held_out == (r.doc_id is not None and crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1
        if r.doc_id in (500, 501, 502):
            assert r.lang_pred == "und" and r.rejected
        elif r.doc_id is not None and r.doc_id < 100:
            assert r.lang_pred == lang[r.doc_id] and not r.rejected
    assert langid.keep_identified(docs).columns == docs.columns
    assert langid.predictions(empty).count() == 0
    assert {r.lang_pred for r in langid.predictions(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_lm_score(docs, corpus, empty):
    got = hmm.scores(docs).collect()
    token = lambda t: [*re.findall("[^\x20\x09-\x0D]+", lower(t or "")), None]
    counts = Counter(w for x in corpus if x[0] is not None and crc(x[0], 5) != 1 for w in token(x[1]))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for x in corpus:
        ts = token(x[1])
        base = sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ts)
        want[(x[0], x[0] is not None and crc(x[0], 5) == 1, len(ts), sum(counts[w] > 0 for w in ts), n, round(base, 4))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    held = [r for r in got if r.held_out and r.doc_id < 100]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    small, _, model = hmm.fitted_scores(docs, hmm.usable_rows(), symbols=6, head=3, rounds=1)
    assert np.isfinite([r.score for r in small.collect()]).all() and np.allclose(model.emit.sum(0), 1) and np.allclose(model.move.sum(1), 1)
    assert hmm.scores(empty).count() == 0
    assert hmm.fitted_scores(docs, F.lit(False))[0].count() == len(corpus)


def test_fresh_names():
    assert fresh(["A", "a_"], "a") == "a__" and fresh([], "x") == "x"


def test_pipeline(spark, docs, labels, corpus, tmp_path, empty):
    import corpus_pipeline as P
    plain = spark.createDataFrame([tuple(x) for x in corpus], DOCS)
    plain.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    items = [(1, " ".join(corpus[3][1].split()[5:30]))]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "language_id", "near_copies", "benchmark_decontamination", "source_mix"]
    now, seen = plain, []
    for i, (name, stage) in enumerate(P.STAGES):
        after = stage(spark, now, str(tmp_path))
        if i < 4:
            assert after.columns == plain.columns
        after.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        seen.append(now.collect())
    ids = [Counter(r.doc_id for r in rows) for rows in seen]
    good = {r.doc_id for r in quality.scores(plain, labels).where("predicted = 1").collect()}
    assert set(ids[0]) == good and not any(300 <= (i or 0) < 310 for i in good)
    assert set(range(100)) <= set(ids[1])
    parts = brute_components([tuple(r) for r in seen[1]], 5, 80)
    assert ids[2] == Counter({c for _, _, c in parts if c is not None}) + Counter({None: ids[1][None]} if ids[1][None] else {})
    clean = [r.doc_id for r in seen[2] if not brute_scan([("1", items[0][1])], r.text or "", 10)[1]]
    assert ids[3] == Counter(clean) and 3 not in ids[3]
    size = {r.doc_id: len((r.text or "").split()) for r in seen[3]}
    mixed = {r.doc_id: r.taken // max(1, r.size) for r in mixing.report(spark.read.parquet(str(tmp_path / P.STAGES[3][0]))).collect()}
    assert {i: n for i, n in ids[4].items() if size[i]} == {i: n for i, n in mixed.items() if n}
    whole = P.run(spark, str(tmp_path))
    assert Counter(r.doc_id for r in whole.collect()) == ids[4]
    for name, stage in P.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
    assert os.path.exists(P.__file__)


def test_pipeline_near_copies_take_five_words_and_80_percent(spark, tmp_path):
    import corpus_pipeline as P
    ws = [f"w{i}" for i in range(400)]
    near, far = list(ws), list(ws)
    for i in range(8):
        near[25 + 45 * i] = f"x{i}"         # five words: 356 of 436; three words: 374 of 422, under 0.9
    for i in range(10):
        far[20 + 38 * i] = f"y{i}"          # five words: 346 of 446, under 0.8
    d = spark.createDataFrame([(i, " ".join(x), "en", "s", 1) for i, x in enumerate((ws, near, far))], DOCS)
    assert {r.doc_id for r in P.near_copies(spark, d, str(tmp_path)).collect()} == {0, 2}
