"""Parts of the corpus operators that need no session, against brute force."""
import io
import itertools
import random
import re
import time

import numpy as np
import pytest

from hiresight.llm import ann, decontam, hmm, htmltext, langid, nearjoin, quality, textkit, toxicity, warc

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_word_rules():
    text = "Ab-Ç1 \x0bÉé x\t\x1fZ"
    assert textkit.words(text.encode()) == [w.encode() for w in re.findall("[^\x20\x09-\x0D]+", lower(text))]
    assert textkit.words(text.encode(), textkit.ALNUM_LOWER) == [w.encode() for w in WORD.findall(lower(text))]
    assert textkit.words(None) == [] and textkit.words(b"") == []


def test_shingle_hashes_tell_runs_apart_and_pieces_agree(monkeypatch):
    ws = [random.Random(i).choice([b"a", b"bb", b"ccc"]) for i in range(400)]
    whole = textkit.shingle_hashes(ws, 3)
    runs = [b" ".join(ws[i:i + 3]) for i in range(398)]
    assert len(set(whole.tolist())) == len(set(runs))
    assert [runs[i] == runs[0] for i in range(398)] == (whole == whole[0]).tolist()
    monkeypatch.setattr(textkit, "_PIECE", 50)
    assert (textkit.shingle_hashes(ws, 3) == whole).all()
    assert (np.concatenate([s.hashes(a, b) for s, a, b in textkit.pieces(ws)]) == textkit.word_hashes(ws)).all()
    assert len(textkit.shingle_hashes([b"one", b"two"], 3)) == 1 and len(textkit.shingle_hashes([], 3)) == 0


def brute_scan(items, text, width):
    ws = WORD.findall(lower(text))
    hit, found = set(), set()
    for item, t in items:
        iw = WORD.findall(lower(t))
        n = min(width, len(iw))
        windows = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(ws) - n + 1 if n else 0):
            if tuple(ws[i:i + n]) in windows:
                found.add(item)
                hit.update(range(i, i + n))
    return len(ws), hit, found


def test_scan_against_brute_force():
    r = random.Random(1)
    words = ["a", "Bé", "c9", "ß", "d"]
    items = [(str(i), " ".join(r.choice(words) for _ in range(r.choice([0, 2, 3, 6])))) for i in range(12)]
    automaton = decontam.build([(i, t.encode()) for i, t in items], 4)
    for _ in range(200):
        text = r.choice([" ", "-", ", "]).join(r.choice(words) for _ in range(r.randrange(0, 25)))
        n, hit, found = brute_scan(items, text, 4)
        got_n, runs, got = decontam.scan(automaton, text.encode())
        assert (got_n, got) == (n, found)
        assert {w for a, b in runs for w in range(a, b + 1)} == hit
        for (a, b), (start, end) in zip(runs, decontam.char_spans(text, runs)):
            assert WORD.findall(lower(text[start:end])) == WORD.findall(lower(text))[a:b + 1]
    assert decontam.scan(automaton, None) == (0, [], set())


def sets_at(similarity, n, seed):
    r = np.random.default_rng(seed)
    a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
    swap = max(1, int(round(len(a) * (1 - similarity) / (1 + similarity))))
    b = np.unique(np.concatenate([a[r.permutation(len(a))[swap:]], r.integers(0, 1 << 63, swap, dtype=np.uint64)]))
    return a, b


def linked(a, b):
    both = len(np.intersect1d(a, b))
    return 100 * both >= 90 * (len(a) + len(b) - both)


def test_linked_sets_share_a_partition_key():
    n_linked = 0
    for seed in range(600):
        a, b = sets_at([0.9, 0.92, 0.95][seed % 3], [9, 10, 12, 19, 20, 31, 60, 200, 700][seed % 9], seed)
        b = b[: len(b) - seed % 2]
        if linked(a, b) and len(a) and textkit.set_fingerprint(a) != textkit.set_fingerprint(b):
            n_linked += 1
            assert set(nearjoin.partition_keys(a)) & set(nearjoin.partition_keys(b))
    assert n_linked > 100


def test_linked_sets_share_a_prefix():
    r, n_linked = np.random.default_rng(0), 0
    for seed in range(400):
        a, b = sets_at([0.8, 0.85, 0.9][seed % 3], [2, 4, 5, 9, 10, 31, 200][seed % 7], seed)
        common = np.sort(r.permutation(np.union1d(a, b))[: len(a) * (seed % 4) // 3])
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            n_linked += 1
            assert set(nearjoin.prefix_keys(a, 80, common)) & set(nearjoin.prefix_keys(b, 80, common))
    assert n_linked > 100 and len(nearjoin.prefix_keys(a[:0], 80, a)) == 0


def test_linked_sets_share_a_prefix_of_rare_words():
    r, n_linked = np.random.default_rng(1), 0
    names = [f"w{i}".encode() for i in range(300)]
    seen = np.sort(textkit.word_hashes(names[:200]))
    weights = r.integers(0, 100, 200)
    for seed in range(300):
        x = [names[i] for i in r.zipf(1.3, int(r.integers(1, 120))) % 300]
        y = [w for i, w in enumerate(x) if seed % 5 or i != len(x) // 2] + [names[j] for j in range(seed % 4)]
        (a, sa), (b, sb) = (nearjoin.scored_shingles(b" ".join(ws), 3, seen, weights) for ws in (x, y))
        assert np.array_equal(a, nearjoin.shingle_set(b" ".join(x), 3)) and len(a) == len(sa)
        _, i, j = np.intersect1d(a, b, return_indices=True)
        if min(len(x), len(y)) > 3:
            assert np.array_equal(sa[i], sb[j])
        if 100 * len(i) >= 80 * len(np.union1d(a, b)):
            n_linked += 1
            assert set(nearjoin.prefix_keys(a, 80, a[::7], sa)) & set(nearjoin.prefix_keys(b, 80, a[::7], sb))
    assert n_linked > 100
    assert [len(x) for x in nearjoin.scored_shingles(None, 3, seen, weights)] == [0, 0]
    assert not nearjoin.scored_shingles(b"a b c d", 3, seen[:0], weights[:0])[1].any()


def roots(n, pairs):
    at = list(range(n))
    for a, b in pairs:
        old, new = at[a], at[b]
        at = [new if x == old else x for x in at]
    return [at.index(x) for x in at]


@pytest.mark.parametrize("across", [False, True])
def test_tile_links_connect_what_brute_force_connects(across):
    arrays = []
    for seed in range(30):
        arrays += sets_at(0.9 + 0.02 * (seed % 3), 15 + 4 * (seed % 5), seed // 2)
    arrays += [arrays[0][:-1], arrays[0][1:]]
    side = np.arange(len(arrays)) % 2
    every = [(i, j) for i, j in itertools.combinations(range(len(arrays)), 2) if linked(arrays[i], arrays[j]) and (not across or side[i] != side[j])]
    found = nearjoin.link_tile(arrays, side, across)
    assert set(map(frozenset, found)) <= set(map(frozenset, every))
    assert roots(len(arrays), found) == roots(len(arrays), every)


def small_hmm():
    r = np.random.default_rng(2)
    emit = r.dirichlet(np.ones(4), 2).T
    return hmm.Hmm(r.dirichlet(np.ones(2)), r.dirichlet(np.ones(2), 2), emit)


def test_forward_and_expected_counts_against_enumeration():
    m, sequences = small_hmm(), [np.array([0, 3, 1, 2]), np.array([2]), np.array([1, 1, 0]), np.array([3, 2, 1, 0, 0])]
    start, move, emit, logs = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2)), []
    for s in sequences:
        paths = {}
        for path in itertools.product(range(2), repeat=len(s)):
            p = m.start[path[0]] * np.prod([m.move[a, b] for a, b in zip(path, path[1:])]) * np.prod([m.emit[o, k] for o, k in zip(s, path)])
            paths[path] = p
        total = sum(paths.values())
        logs.append(np.log(total))
        for path, p in paths.items():
            start[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                move[a, b] += p / total
            for o, k in zip(s, path):
                emit[o, k] += p / total
    assert np.allclose(m.log_probs(sequences), logs)
    got = m.expected(sequences)
    assert np.allclose(got[0], start) and np.allclose(got[1], move) and np.allclose(got[2], emit)
    assert sorted(i for part in hmm.slices(sequences, 4) for i in part) == [0, 1, 2, 3]


def test_tokens_end_and_classes():
    h, cls = hmm.tokens("Ab ab cab".encode())
    assert len(h) == 4 and h[0] == h[1] and h[-1] == hmm.END and cls[0] == cls[1] != cls[2]
    assert hmm.tokens(None)[0].tolist() == [int(hmm.END)]
    assert hmm.tokens(b"x b")[1][1] == hmm.tokens(b"yyyy b")[1][1]


def trained_languages():
    rows = {}
    for lang, texts in {"a": ["abab abba baab"] * 3 + ["ba ab"], "c": ["cdcd cd dcc", "cc dd dcdc"]}.items():
        parts = [langid.distinct_grams(langid.characters(t)) for t in texts]
        chars = np.concatenate([np.stack(p[0], 1) for p in parts])
        g, at = np.unique(chars, axis=0, return_inverse=True)
        rows[lang] = (g.astype(np.uint32), np.bincount(at, np.concatenate([p[1] for p in parts])))
    return rows, langid.KneserNey.train(rows)


def test_kneser_ney_is_a_distribution_and_tables_agree():
    rows, model = trained_languages()
    one = langid._One(*rows["a"], 6)
    letters = np.array([0] + [ord(c) for c in "abcd"] + [9999], np.uint32)
    for ctx in ("\0\0\0", "aba", "zzz", "\0ab"):
        chars = [np.full(len(letters), ord(c), np.uint32) for c in ctx] + [letters]
        assert abs(one.prob(chars).sum() - 1) < 1e-9
    again = [np.array([x], np.uint32) for x in map(ord, "abab")]
    alphabet = len({int(c) for g, _ in rows.values() for c in np.unique(g)}) + 1
    assert np.isclose(model.log_probs(again)[0, 0], np.log(langid._One(*rows["a"], alphabet).prob(again)[0]), atol=1e-5)


def test_language_prediction_cases():
    _, model = trained_languages()
    assert model.predict("ABAB ba")[0] == "a" and model.predict("dcdc!")[0] == "c"
    for nothing in (None, "", " 12 ,.", "́"):
        assert model.predict(nothing)[0] == "und" and model.predict(nothing)[1] == 0
    assert 0 <= model.predict("abcd")[1] <= 1
    assert langid.KneserNey.train({}).predict("abc")[0] == "und"


def test_block_max_index_is_exact():
    r = np.random.default_rng(3)
    vecs = []
    for _ in range(300):
        t = np.sort(r.choice(40, r.integers(1, 6), replace=False))
        w = r.integers(1, 4, len(t)).astype(float)
        vecs.append((t, w / np.linalg.norm(w)))
    dense = np.zeros((300, 40))
    for i, (t, w) in enumerate(vecs):
        dense[i, t] = w
    index = toxicity.BlockMaxIndex(vecs, 40)
    for i in range(0, 300, 7):
        sims = np.round(dense @ dense[i], 12)
        sims[i] = -1
        want = [j for j in np.lexsort((np.arange(300), -sims))[:9] if sims[j] > 0]
        got, s = index.nearest(*vecs[i], 9, skip=i)
        assert got.tolist() == want and np.allclose(s, sims[want])
    assert len(index.nearest(np.empty(0, int), np.empty(0), 9)[0]) == 0


def test_pu_learning_finds_the_prior_and_the_classes():
    r = np.random.default_rng(4)
    draw = lambda y: np.column_stack([r.normal(np.where(y, 1.5, -1.5)[:, None], 1, (len(y), 2)), r.normal(size=(len(y), 1))])
    y = r.random(3000) < 0.7
    model = quality.fit(draw(np.ones(2000, bool)).astype(np.float32), draw(y).astype(np.float32))
    assert abs(model.prior - 0.7) < 0.12
    test = r.random(2000) < 0.7
    assert ((model.score(draw(test).astype(np.float32)) >= 0.5) == test).mean() > 0.93


def test_quality_features_of_odd_texts():
    for text in (None, b"", b" \n ", b"x", "é".encode() * 9, b"| a |\n" * 50, b"a " * 200_000):
        f = quality.features(text)
        assert f.shape == (quality.N_FEATURES,) and np.isfinite(f).all()


def test_hilbert_curve_visits_neighbours():
    bits, dims = 3, 3
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    key = ann.hilbert(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_best_breaks_ties_by_id():
    c = np.array([[1.0, 0], [0, 1], [1, 0], [1, 0], [-1, 0]])
    q, ids, s = ann.best(np.array([7]), np.array([[2.0, 1]]), np.array([9, 8, 3, 5, 1]), c, 3)
    assert ids.tolist() == [3, 5, 9] and s.tolist() == [2, 2, 2]


def test_archive_is_readable_from_any_byte():
    payloads = [b"", b"x" * 500, b"\x1f\x8b\x08 not a member \x1f\x8b\x08", bytes(range(256)) * 20, "é".encode()]
    raw = [warc.encode_record(i, "http://a/\r\nb", p, len(p), "d", None if i != 3 else 1) for i, p in enumerate(payloads)]
    data = b"".join(raw)
    starts = np.cumsum([0, *map(len, raw)])[:-1].tolist()
    for split in (1, 7, 50, 333, len(data)):
        got = [(at, rec) for a in range(0, len(data), split) for at, rec in warc.members(io.BytesIO(data), len(data), a, min(len(data), a + split))]
        assert [at for at, _ in got] == starts
        assert [rec["payload"] for _, rec in got] == [p if i != 3 else b"" for i, p in enumerate(payloads)]
    assert got[0][1]["fields"]["warc-target-uri"] == "http://a/%0D%0Ab"
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(b"junk" + data), len(data) + 4, 0, 9))


def test_html_blocks():
    page = "<title>t</title><p>a &amp; b<b> c<br>d<p class='x y'>e<script>var t='</p>';</script><!-- <p>no</p> --><li>f<li><a href='>'>g</a></ul>h < i"
    got = htmltext.blocks(page)
    assert [b[0] for b in got] == ["a & b c d", "e", "f", "g", "h < i"]
    assert ".x" in got[1][1] and got[3][2] == 1.0 and got[0][2] == 0.0
    assert htmltext.blocks("") == [] and htmltext.blocks("<p 'unclosed") != None  # noqa: E711


@pytest.mark.parametrize("page, want", [
    ('<p><svg class="i"/>Hello</p><p>World</p>', ["Hello", "World"]),
    ('<p><svg-icon name="x"></svg-icon>Hello</p><script-x>a</script-x>', ["Hello", "a"]),
    ("<svg/><article><p>One</p></article><svg><title>t</title></svg><p>Two</p>", ["One", "Two"]),
    ("<p>a <math><mi>x</mi></math> b</p><object data=f>No plug-in</object><canvas>c</canvas>", ["a x b", "No plug-inc"]),
    ("<p>a<svg><path d=z><p>b", ["a", "b"]),
    ("<p>a<svg><svg><text>n</text></svg><text>m</text></svg>b</p>", ["ab"]),
    ("<p>a<iframe src=x/>b<iframe>no</iframe><template>t", ["abt"]),
    ("<p>a</p><script>'<p>no</p>'</script x><p>b</p><style>p{}", ["a", "b"]),
])
def test_html_raw_elements_keep_page_text(page, want):
    assert [b[0] for b in htmltext.blocks(page)] == want


def test_html_buttons():
    assert [b[0] for b in htmltext.blocks("<p>text here.<button>Share <svg><b>x</b></svg>this</button>More</p>")] == ["text here. More"]
    assert [b[0] for b in htmltext.blocks("<h2><button>Question?</button></h2><p>a<button>b</p>")] == ["Question?", "ab"]


@pytest.mark.parametrize("part", ["<a ", "<div x='", "<a '>'", "<a", "<svg>", "<div>", "<p>x<b>"])
def test_html_scan_is_linear(part):
    begun = time.process_time()
    htmltext.blocks(part * (150_000 // len(part)) + "</b></i>" * 9)
    assert time.process_time() - begun < 4


def test_html_ends_of_tags():
    for page in ('a<b c=">" d>e</b>', "<a '>x<b y='>'>z", "<i '><i '><u '>'>k", "<p x='a>b", '<q "\'">w<q \'">v>'):
        ends, table = htmltext._TagEnds(page), htmltext._TagEnds(page)
        table.table = table._ends()
        assert [ends.after(i) for i in range(len(page))] == [table.after(i) for i in range(len(page))]
    assert [b[0] for b in htmltext.blocks("<i '><i '><p '>'>k")] == ["k"]


def test_labeller_gradient():
    model = htmltext.BlockLabeller(1)
    for k in model.p:
        model.p[k] = model.p[k].astype(np.float64)
    batch = [htmltext.encode(htmltext.blocks(f"<nav><a>m{i}</a></nav><p>Some text here.</p>" + "<div>x</div>" * i)) for i in (1, 3)]
    target = np.zeros((2, 5))
    target[:, 1] = 1
    grads, loss = model.gradient(batch, target)
    for k in ("recf", "inb", "out", "bias"):
        at = np.unravel_index(np.argmax(np.abs(grads[k])), grads[k].shape)
        old, model.p[k][at] = model.p[k][at], model.p[k][at] + 1e-3
        up = model.gradient(batch, target)[1]
        model.p[k][at] = old - 1e-3
        down = model.gradient(batch, target)[1]
        model.p[k][at] = old
        assert abs((up - down) / 2e-3 - grads[k][at]) < 0.02 * abs(grads[k][at]) + 1e-4


def test_labeller_reads_all_words():
    def dense(text, attrs=""):
        return htmltext.encode(htmltext.blocks(f"<p{attrs}>{text}</p>"))[2][0]
    one, two = (dense(f"river stone house {w} light water green") for w in ("cookies", "walk"))
    assert not np.array_equal(one[: htmltext.WORD_DIM], two[: htmltext.WORD_DIM])
    assert dense("a " * 300 + "1 " * 300)[htmltext.WORD_DIM + 8] > 0.2
    assert ".h" in htmltext.blocks("<p class='a b c d e f g h'>x")[0][1]


def test_labeller_carries_its_state_over_the_whole_page():
    model, h = htmltext.BlockLabeller(1), htmltext.HIDDEN
    for k in model.p:
        model.p[k] = np.zeros_like(model.p[k])
    every, head = model.p["pathf"][htmltext.PATH_DIM], model.p["pathf"][htmltext._path_bucket("<h1")]
    every[0], every[h], every[2 * h] = -20, 20, 20      # without a heading, the first unit keeps what it holds
    head[0], head[3 * h] = 40, 10                       # a heading sets it
    model.p["out"][0], model.p["bias"][0] = 1, -0.3
    pages = [htmltext.blocks("<p>x" * 3 + "<h1>t</h1>" + "<p>x" * n) for n in (5, 2000)]
    assert [y.tolist() for y in model.label([*pages, []])] == [[False] * 3 + [True] * 6, [False] * 3 + [True] * 2001, []]


def test_labeller_on_pages_it_has_not_seen():
    model, grammar = htmltext.trained(), htmltext._Grammar(77)
    pages = [grammar.page() for _ in range(60)]
    y = np.concatenate([p[1] for p in pages]) > 0
    assert (np.concatenate(model.label([p[0] for p in pages])) == y).mean() > 0.97
    page = ("<body><nav><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></nav><div class='cookie-notice'>We use cookies.</div><article><h1>A title</h1>"
            + "<p>First paragraph, with words.</p>" * 800 + "</article><div id=comments><p>Nice one, thanks.</p></div><footer>&copy; me</footer>")
    assert htmltext.main_texts(model, [page, None, ""]) == ["\n\n".join(["A title"] + ["First paragraph, with words."] * 800), "", ""]


def test_labeller_at_any_depth_and_with_foreign_names():
    model = htmltext.trained()
    said = "<h1>A title</h1>" + "<p>First paragraph, with words and more of them.</p>" * 5
    menu, foot = "<body><nav><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></nav>", "<footer>&copy; me</footer>"
    want = "\n\n".join(["A title"] + ["First paragraph, with words and more of them."] * 5)
    for depth in (0, 20, 120, 1000):
        down, up = "<div>" * depth, "</div>" * depth
        for page in (f"{menu}{down}<article>{said}</article>{up}{foot}", f"{menu}<article>{down}{said}{up}</article>{foot}",
                     f"{menu}{'<font>' * depth}<article>{said}</article>{foot}"):
            assert htmltext.main_texts(model, [page]) == [want]
    grammar, right, every = htmltext._Grammar(78), 0, 0
    for _ in range(150):
        found, y = grammar.page()
        if found and grammar.style != "named":
            right, every = right + int((model.label([found])[0] == (y > 0)).sum()), every + len(y)
    assert right / every > 0.95


def test_partition_keys_of_unrelated_and_linked_sets():
    r = np.random.default_rng(3)

    def hashes(n):
        return np.unique(r.integers(0, 1 << 64, n, dtype=np.uint64))
    for n in (40, 300, 951):
        keys = np.concatenate([np.unique(nearjoin.partition_keys(hashes(n))) for _ in range(1500)])
        assert len(np.unique(keys)) == len(keys)
    for n in (11, 20, 100, 951, 1300):
        for _ in range(60):
            x, away = hashes(n), int(r.integers(0, n // 10 + 1))
            more = int((len(x) - away) * 100 // 90) - len(x)
            y = np.unique(np.concatenate([r.choice(x, len(x) - away, replace=False), hashes(int(r.integers(0, more + 1)))]))
            assert 100 * nearjoin.overlap(x, y) >= 90 * len(np.union1d(x, y))
            assert np.array_equal(x, y) or len(np.intersect1d(nearjoin.partition_keys(x), nearjoin.partition_keys(y)))
