"""Operator 6, main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks (runs of text between block-level tags, scripts,
styles and comments left out).  A numpy bidirectional LSTM reads, block by block
in page order, the hashed tag path (element names with words of class, id and
role), hashed words and a few counts, and says of every block whether it belongs
to the article, in the light of the whole page.  It is trained here, on pages
made from a random grammar of layouts, with the blocks' places known.

Defined cases: a null or empty page, and one without article blocks, gives the
empty text; unclosed and stray tags, comments, quotes and scripts are read as
browsers do, roughly; character references are decoded; white space inside a
block is one blank; blocks are joined by a blank line.  Pages may be of any
length: all words of a block are read, and both recursions run over all blocks of
a page; repeated rows are treated alike; other columns pass through.
"""
from __future__ import annotations

import bisect
import functools
import html as html_lib
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import fresh, ship_package

# Element names by kind.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Text up to the end tag, or else to the end of the page, is none of the page's.
RAW_TAGS = "script|style|textarea"
#: What is inside isn't shown; without an end tag, or ending in "/>", they hold nothing.
HIDDEN_TAGS = frozenset("svg template iframe noembed noframes button".split())
#: A button that is a heading's text is read.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 summary dt".split())
#: Opening tags of page text, which end an svg.
BREAKOUT_TAGS = BLOCK_TAGS - {"title"}
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
             "option": ("option",), "body": ("head",)}

MARKUP = re.compile(r"<!--(?:.*?-->|.*+)|<![^>]*+>?|<\?[^>]*+>?|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)", re.I | re.S)
#: The rest of a tag whose quotes are closed.
TAG_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
TAG_SIGNS = re.compile(r"[>\"']")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>?", re.I) for t in RAW_TAGS.split("|")}
HIDDEN_OPEN = re.compile(rf"<(?:{'|'.join(sorted(HIDDEN_TAGS))})[\s/>]", re.I)
ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+|\d+")
PATH_DIM, WORD_DIM, COUNTS = 8192, 32, 12
#: A block's path: the distinct tokens of its ancestors, the latest so many of
#: them, so that mere depth of nesting changes nothing.
PATH_TOKENS = 64
#: Pages are labelled together up to so many, and so many blocks with padding (a
#: longer page goes alone).
PAGES, CELLS = 64, 32768
#: Blocks whose path weights are gathered at once.
GATHER = 4096
HIDDEN = 20


@functools.lru_cache(65536)
def _path_bucket(token: str) -> int:
    return zlib.crc32(token.encode()) % PATH_DIM


@functools.lru_cache(65536)
def _word_bucket(word: str) -> int:
    """Place of a word, in the second half if it counts negative."""
    h = zlib.crc32(word.lower().encode())
    return h % WORD_DIM + (0 if h & 1024 else WORD_DIM)


@functools.lru_cache(4096)
def _tokens(tag: str, attrs: str) -> tuple[str, ...]:
    out = [f"<{tag}"]
    for name, a, b, c in ATTR.findall(attrs) if "=" in attrs else ():
        out += [f"{'role' if name.lower() == 'role' else ''}.{w}" for w in WORDS.findall((a or b or c).lower())]
    return tuple(out) if len(out) == 1 else (f"<{tag}[", *out)


class _TagEnds:
    """Ends of tags in time linear in the page: the first tag whose quotes stay
    open makes a table of all ends, from the last sign to the first."""

    def __init__(self, page: str):
        self.page, self.last, self.table = page, page.rfind(">"), None

    def after(self, at: int) -> int:
        """Where the tag ends whose name ends at ``at``: after the first ">" outside
        quotes, or else after the first one; -1 if there is none."""
        if at > self.last:
            return -1
        if self.table is None:
            m = TAG_REST.match(self.page, at)
            if m:
                return m.end()
            self.table = self._ends()
        places, outside, plain = self.table
        k = bisect.bisect_left(places, at)
        return outside[k] if outside[k] >= 0 else plain[k]

    def _ends(self) -> tuple[list[int], list[int], list[int]]:
        places = [m.start() for m in TAG_SIGNS.finditer(self.page)]
        outside, plain = [-1] * (len(places) + 1), [-1] * (len(places) + 1)
        later = {'"': -1, "'": -1}  # where a tag ends that goes on after the next such quote
        for k in range(len(places) - 1, -1, -1):
            sign = self.page[places[k]]
            if sign == ">":
                outside[k] = plain[k] = places[k] + 1
            else:
                outside[k], plain[k] = later[sign], plain[k + 1]
                later[sign] = outside[k + 1]
        return places, outside, plain


def markup(page: str) -> list[tuple[str, str, str]]:
    """Tokens (kind, tag or text, attributes): "text", "open" and "close"."""
    out: list[tuple[str, str, str]] = []
    ends, at = _TagEnds(page), 0
    while at < len(page):
        if page[at] != "<":
            to = page.find("<", at)
            to = len(page) if to < 0 else to
            out.append(("text", page[at:to], ""))
            at = to
            continue
        m = MARKUP.match(page, at) if at <= ends.last or page.startswith(("<!", "<?"), at) else None
        if m and not m["tag"]:
            at = m.end()
            continue
        to = ends.after(m.end()) if m else -1
        tag = m["tag"].lower() if m else ""
        if tag in RAW_END and not m["end"]:
            close = RAW_END[tag].search(page, max(to, m.end()))
            at = close.end() if close else len(page)
        elif to < 0:
            out.append(("text", "<", ""))
            at += 1
        else:
            out.append(("close" if m["end"] else "open", tag, page[m.end():to - 1]))
            at = to
    return out


def _hidden_runs(tokens: list[tuple[str, str, str]]) -> dict[int, int]:
    """For each token that opens a hidden element, the last token of that element."""
    last: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    held: Counter[str] = Counter()

    def leave() -> tuple[str, int]:
        held[stack[-1][0]] -= 1
        return stack.pop()

    for i, (kind, tag, attrs) in enumerate(tokens):
        if kind == "text":
            continue
        if tag in HIDDEN_TAGS:
            if kind == "open":
                if not attrs.endswith("/"):
                    stack.append((tag, i))
                    held[tag] += 1
            elif held[tag]:
                while stack[-1][0] != tag:
                    leave()
                last[leave()[1]] = i
        elif tag in BREAKOUT_TAGS and kind == "open":
            while stack and stack[-1][0] == "svg":
                last[leave()[1]] = i - 1
    return last


class _Path:
    """The open elements of a page."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.names: Counter[str] = Counter()
        self.tokens: dict[str, int] = {}  # of open elements, in the order of their latest opening

    def enter(self, tag: str, tokens: tuple[str, ...]) -> None:
        self.stack.append((tag, tokens))
        self.names[tag] += 1
        for t in tokens:
            self.tokens[t] = self.tokens.pop(t, 0) + 1

    def cut(self, at: int) -> None:
        while len(self.stack) > at:
            tag, tokens = self.stack.pop()
            self.names[tag] -= 1
            for t in tokens:
                self.tokens[t] -= 1
                if not self.tokens[t]:
                    del self.tokens[t]

    def leave(self, tag: str) -> None:
        if self.names[tag]:
            while self.stack[-1][0] != tag:
                self.cut(len(self.stack) - 1)
            self.cut(len(self.stack) - 1)

    def close(self, names: tuple[str, ...], within: int) -> None:
        for at in range(len(self.stack) - 1, max(-1, len(self.stack) - 1 - within), -1):
            if self.stack[at][0] in names:
                self.cut(at)
                return
            if self.stack[at][0] in ("table", "ul", "ol", "article", "section", "div", "main", "body") and names != ("p",):
                return

    def near(self, *names: str, within: int) -> bool:
        return any(name in names for name, _ in self.stack[-within:])

    def features(self) -> list[str]:
        nearest = [t for _, tokens in self.stack[-3:] for t in tokens][-3:]
        return list(itertools.islice(reversed(self.tokens), PATH_TOKENS)) + ["^" + t for t in nearest]


def blocks(page: str) -> list[tuple[str, list[str], float]]:
    """Leaf blocks in page order: text, path tokens, share of text in links."""
    out: list[tuple[str, list[str], float]] = []
    path = _Path()
    held: list[str] = []
    linked = total = 0

    def flush() -> None:
        nonlocal linked, total
        if held:
            text = " ".join(html_lib.unescape("".join(held)).split())
            if text and not path.names["title"]:
                out.append((text, path.features(), linked / max(1, total)))
            held.clear()
        linked = total = 0

    tokens, until = markup(page), -1
    hidden = _hidden_runs(tokens) if HIDDEN_OPEN.search(page) else {}
    for i, (kind, tag, attrs) in enumerate(tokens):
        if i <= until:
            continue
        if kind == "text":
            held.append(tag)
            n = len(tag.strip())
            total += n
            if path.near("a", within=4):
                linked += n
            continue
        if tag == "button" and i in hidden and not path.near(*HEADINGS, within=2):
            held.append(" ")
            until = hidden[i]
            continue
        if tag in HIDDEN_TAGS and tag != "button":
            until = hidden.get(i, i)
            continue
        if tag in BLOCK_TAGS:
            flush()
        elif tag == "br":
            held.append("\n")
        if kind == "close":
            path.leave(tag)
            continue
        if tag in BLOCK_TAGS:
            path.close(("p",), 4)
            if tag in CLOSED_BY:
                path.close(CLOSED_BY[tag], 6)
        if tag not in VOID_TAGS:
            path.enter(tag, _tokens(tag, attrs))
    flush()
    return out


def encode(bs: list[tuple[str, list[str], float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Path buckets (flat), their starts per block, and the dense features."""
    flat, starts, dense = [], [], np.zeros((len(bs), WORD_DIM + COUNTS), np.float32)
    for i, (text, path, links) in enumerate(bs):
        starts.append(len(flat))
        flat += [_path_bucket(t) for t in path] + [PATH_DIM]
        ws = text.split()
        n = len(ws)
        often = np.bincount([_word_bucket(w) for w in ws], minlength=2 * WORD_DIM)
        dense[i, :WORD_DIM] = (often[:WORD_DIM] - often[WORD_DIM:]) / np.sqrt(often @ often)
        stops = text.count(".") + text.count("!") + text.count("?")
        dense[i, WORD_DIM:] = (np.log1p(n) / 4, np.log1p(len(text)) / 6, links, float(n <= 2), float(n >= 12), min(3.0, stops / 3),
                               float(text[-1] in ".!?…\"'»”"), len(text) / n / 8, sum(map(str.isdigit, text)) / len(text),
                               i / len(bs), float("©" in text), float("|" in text or "»" in text or "›" in text))
    return np.array(flat, np.int64), np.array(starts, np.int64), dense


class BlockLabeller:
    """Bidirectional LSTM over a sequence of blocks; parameters in ``p``."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        d = WORD_DIM + COUNTS
        self.p = {"out": r.normal(0, 0.1, (2 * HIDDEN, 1)).astype(np.float32), "bias": np.zeros(1, np.float32)}
        for side in "fb":
            self.p[f"path{side}"] = r.normal(0, 0.01, (PATH_DIM + 1, 4 * HIDDEN)).astype(np.float32)
            self.p[f"in{side}"] = r.normal(0, 0.1, (d, 4 * HIDDEN)).astype(np.float32)
            self.p[f"rec{side}"] = r.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)).astype(np.float32)

    def gates_in(self, enc, side: str) -> np.ndarray:
        flat, starts, dense = enc
        out = dense @ self.p[f"in{side}"]
        for a in range(0, len(starts), GATHER):  # a long page's paths a part at a time
            part = starts[a: a + GATHER]
            to = starts[a + GATHER] if a + GATHER < len(starts) else len(flat)
            out[a: a + GATHER] += np.add.reduceat(self.p[f"path{side}"][flat[part[0]: to]], part - part[0], 0)
        return out

    def run(self, batch: list, keep: bool = False):
        """Logits [batch, steps] of encoded sequences, padded; and what the
        backward pass needs."""
        steps, n = max(len(e[1]) for e in batch), len(batch)
        mask = np.zeros((steps, n, 1), np.float32)
        for i, e in enumerate(batch):
            mask[: len(e[1]), i] = 1
        hs, saved = {}, {"mask": mask}
        for side in "fb":
            x = np.zeros((steps, n, 4 * HIDDEN), np.float32)
            for i, e in enumerate(batch):
                x[: len(e[1]), i] = self.gates_in(e, side)
            h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            out, trail = np.zeros((steps, n, HIDDEN), np.float32), []
            for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
                z = x[t] + h @ self.p[f"rec{side}"]
                g = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
                a = np.tanh(z[:, 3 * HIDDEN:])
                i_, f_, o_ = g[:, :HIDDEN], g[:, HIDDEN: 2 * HIDDEN], g[:, 2 * HIDDEN:]
                c2 = f_ * c + i_ * a
                h2 = o_ * np.tanh(c2)
                if keep:
                    trail.append((t, h, c, i_, f_, o_, a, c2))
                c, h = np.where(mask[t] > 0, c2, c), np.where(mask[t] > 0, h2, h)
                out[t] = h
            hs[side], saved[side] = out, trail
        both = np.concatenate([hs["f"], hs["b"]], 2)
        saved["both"] = both
        return (both @ self.p["out"] + self.p["bias"])[:, :, 0].T, saved

    def gradient(self, batch: list, target: np.ndarray) -> tuple[dict, float]:
        logits, s = self.run(batch, keep=True)
        mask, n = s["mask"], float(s["mask"].sum())
        p = 1 / (1 + np.exp(-logits))
        d = ((p - target) * mask[:, :, 0].T / n).T[:, :, None].astype(np.float32)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["out"], grads["bias"] = np.einsum("tnh,tno->ho", s["both"], d), d.sum((0, 1))
        back = d @ self.p["out"].T
        for at, side in ((slice(0, HIDDEN), "f"), (slice(HIDDEN, 2 * HIDDEN), "b")):
            rec, dh, dc = self.p[f"rec{side}"], 0, 0
            dx = np.zeros((mask.shape[0], mask.shape[1], 4 * HIDDEN), np.float32)
            for t, h, c, i_, f_, o_, a, c2 in reversed(s[side]):
                m = mask[t]
                dht = (back[t, :, at] + dh) * m
                th = np.tanh(c2)
                dct = dht * o_ * (1 - th * th) + dc * m
                dz = np.concatenate([dct * a * i_ * (1 - i_), dct * c * f_ * (1 - f_), dht * th * o_ * (1 - o_), dct * i_ * (1 - a * a)], 1)
                dx[t] = dz
                grads[f"rec{side}"] += h.T @ dz
                dh, dc = dz @ rec.T + dh * (1 - m), dct * f_ + dc * (1 - m)
            for i, (flat, starts, dense) in enumerate(batch):
                g = dx[: len(starts), i]
                grads[f"in{side}"] += dense.T @ g
                np.add.at(grads[f"path{side}"], flat, np.repeat(g, np.diff(np.append(starts, len(flat))), 0))
        y = np.clip(p, 1e-7, 1 - 1e-7)
        loss = -float(((target * np.log(y) + (1 - target) * np.log(1 - y)) * mask[:, :, 0].T).sum() / n)
        return grads, loss

    def label(self, pages: list[list]) -> list[np.ndarray]:
        """For each page's blocks, which belong to the article."""
        out = [np.zeros(len(bs), bool) for bs in pages]
        groups: list[list[int]] = []
        for k in sorted((k for k, bs in enumerate(pages) if bs), key=lambda k: len(pages[k])):
            if groups and len(groups[-1]) < PAGES and len(pages[k]) * (len(groups[-1]) + 1) <= CELLS:
                groups[-1].append(k)
            else:
                groups.append([k])
        for group in groups:
            logits, _ = self.run([encode(pages[k]) for k in group])
            for k, z in zip(group, logits):
                out[k] = z[: len(pages[k])] > 0
        return out


class _Grammar:
    """Random pages whose article blocks are known."""

    ARTICLE = "article post entry content story text body main single page news blog item"
    SIDE = "sidebar side widget related rail secondary complementary popular trending recommended"
    ADS = "ad ads advert advertisement banner sponsor sponsored promo promoted"
    NOTICE = "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe paywall"
    COMMENT = "comment comments commentlist discussion responses replies respond disqus reader feedback thread"
    MENU = "nav navbar menu navigation breadcrumb breadcrumbs pagination pager topbar links tabs toc share social skip"
    HEAD = "header masthead site branding logo top tagline"
    FOOT = "footer colophon bottom copyright legal credits"
    PLAIN = "row col container wrapper inner block box section grid left right wide area module"

    def __init__(self, seed: int):
        self.r = np.random.default_rng(seed)
        self.style, self.alias, self.tone, self.last = "named", {}, "plain", []
        self.sounds = [a + b for a in "b c d f g h j k l m n p r s t v w z th sh ch st tr".split() for b in "a e i o u ea ou an en on".split()]

    def pick(self, xs):
        xs = xs.split() if isinstance(xs, str) else xs
        return xs[self.r.integers(len(xs))]

    def word(self) -> str:
        return "".join(self.pick(self.sounds) for _ in range(self.r.integers(1, 4)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.integers(lo, hi + 1))).capitalize()

    def prose(self) -> str:
        said = [self.words(2, 14) + self.pick(". . . . , ! ?".split()) for _ in range(self.r.integers(1, 7))]
        if self.tone == "loud":
            return "!! ".join(" ".join(said).upper().split()) + self.pick(["", ".", "!!"])
        if self.tone == "stutter":
            return " ".join([said[0].split()[0]] * int(self.r.integers(2, 60)) + said)
        if self.tone == "echo":
            self.last = said if self.r.random() < 0.3 or not self.last else self.last
            return " ".join(self.last)
        return " ".join(said)

    def new_style(self) -> None:
        """How the next page's elements are named: tellingly, in words of no known
        language (one to each known word), or not at all; and how its prose sounds."""
        self.style, self.alias = self.pick("named named named named foreign foreign foreign foreign bare bare"), {}
        self.tone, self.last = self.pick("plain plain plain plain plain plain plain plain plain plain plain plain loud stutter echo"), []

    def attribute(self, name: str, value: str) -> str:
        if self.style == "bare":
            return ""
        if self.style == "foreign" and name != "role":
            value = re.sub("[a-z]+", lambda m: self.alias.setdefault(m[0], self.word() + self.word()), value)
        return f' {name}="{value}"'

    def named(self, kinds: str) -> str:
        """Attributes: mostly telling, sometimes plain or none."""
        u = self.r.random()
        name = self.pick(kinds) if u < 0.75 else self.pick(self.PLAIN)
        if u > 0.9:
            return ""
        joint = self.pick(["-", "_", " "])
        extra = joint + self.pick(self.PLAIN + " list items " + kinds) if self.r.random() < 0.4 else ""
        return self.attribute(self.pick("class class class id"), name + extra)

    def links(self, n: int) -> list[tuple[str, str, int]]:
        return [(f'<li><a href="/{self.word()}">', self.words(1, 3), 0) for _ in range(n)]

    def boiler(self, kind: str) -> list:
        r, out = self.r, []
        if kind == "menu":
            t = self.pick("nav nav div ul")
            own = self.named(self.MENU) if t != "nav" or r.random() < 0.4 else ""
            out = [(f"<{t}{own}><ul>", None, 0), *self.links(r.integers(1, 12)), (f"</ul></{t}>", None, 0)]
        elif kind == "head":
            t = self.pick("header header div")
            out = [(f"<{t}{self.named(self.HEAD)}>", None, 0), (self.pick(["<p>", "<h1>", "<div>", "<a href='/'>"]), self.words(1, 6), 0)]
            out += self.boiler("menu") if r.random() < 0.4 else []
            out += [(f"</{t}>", None, 0)]
        elif kind == "foot":
            t = self.pick("footer footer div")
            out = [(f"<{t}{self.named(self.FOOT) if t == 'div' or r.random() < 0.3 else ''}>", None, 0)]
            out += [(self.pick(["", "<p>", "<small>", "<div>"]), self.pick(["&copy; ", "© 2020 ", ""]) + self.pick([self.prose(), self.words(2, 9)]), 0) for _ in range(r.integers(1, 3))]
            out += self.links(r.integers(0, 5)) + [(f"</{t}>", None, 0)]
        elif kind == "side":
            t = self.pick("aside aside div section")
            out = [(f"<{t}{self.named(self.SIDE) if t != 'aside' else self.pick(['', self.named(self.SIDE)])}>", None, 0)]
            out += [("<h3>", self.words(1, 4), 0)] * int(r.random() < 0.6)
            out += self.links(r.integers(0, 6)) + [("<p>", self.prose(), 0) for _ in range(r.integers(0, 3))] + [(f"</{t}>", None, 0)]
        elif kind in ("ads", "notice"):
            t = self.pick("div div div aside section p" if self.style == "named" else "div div div aside section")
            kinds = self.ADS if kind == "ads" else self.NOTICE
            role = self.attribute("role", self.pick(["alert", "dialog"])) if kind == "notice" and self.r.random() < 0.5 else ""
            name = self.attribute(self.pick("class class id"), self.pick(kinds) + self.pick(["", "", "-" + self.pick(self.PLAIN + " " + kinds)]))
            out = [(f"<{t}{name}{role}>", None, 0), (self.pick(["", "", "<p>" if t != "p" else "", "<span>"]), self.pick([self.prose(), self.words(2, 8)]), 0)]
            out += [("<button>", self.words(1, 2), 0)] * int(r.random() < 0.3) + [(f"</{t}>", None, 0)]
        elif kind == "form":
            out = [(f"<form{self.pick(['', self.named('search login signup contact subscribe newsletter')])}>", None, 0)]
            out += [(self.pick(["<label>", "<p>", "<legend>", "<div>"]), self.words(1, 7), 0) for _ in range(r.integers(1, 4))]
            out += [("<input><button>", self.words(1, 2), 0), ("</form>", None, 0)]
        elif kind == "comment":
            t = self.pick("section div div ol ul")
            out = [(f"<{t}{self.attribute(self.pick('class id'), self.pick(self.COMMENT) + self.pick(['', '-list', 's', '-area']))}>", None, 0)]
            out += [("<h3>", self.words(1, 3), 0)] * int(r.random() < 0.6)
            for _ in range(r.integers(1, 6)):
                own = self.attribute("class", self.pick(self.COMMENT) + self.pick(["", "-body", "-text"])) if r.random() < 0.7 else ""
                inner = self.pick("li") if t in ("ol", "ul") else self.pick("div article p")
                out += [(f"<{inner}{own}>", None, 0)] + [("<b>", self.words(1, 2), 0)] * int(r.random() < 0.4)
                out += [("<p>" if inner != "p" else "", self.prose(), 0), (f"</{inner}>", None, 0)]
            out += [(f"</{t}>", None, 0)]
        return out

    def article(self) -> list:
        r = self.r
        t = self.pick("article article article main div div section td")
        own = self.named(self.ARTICLE) if t in ("div", "section", "td") else self.pick(["", "", self.named(self.ARTICLE)])
        out = [(f"<{t}{own}>", None, 0)]
        if r.random() < 0.85:
            out += [(self.pick(["<h1>", "<h1>", "<h2>", "<header><h1>"]), self.words(1, 12), 1), (self.pick(["</h1>", "</h1></header>", "</h2>"]), None, 0)]
        for _ in range(r.integers(0, 80 if self.tone == "echo" else 25)):
            u = r.random()
            if u < 0.72:
                lead = self.pick(["<p>", "<p>", "<p>", "<p>", "<p><b>", "<p><em>", "<br><p>", '<p><a href="/x">', "<div>"])
                out += [(lead, self.prose() if r.random() < 0.85 else self.words(1, 8), 1)]
                out += [(self.pick(["</p>", "</p>", "</p>", "", "<br>", "</b></p>"]), None, 0)]
            elif u < 0.8:
                out += [("<h2>" if r.random() < 0.6 else "<h3>", self.words(1, 8), 1)]
            elif u < 0.88:
                out += [("<ul>", None, 0)] + [("<li>", self.words(1, 14) + self.pick([".", ""]), 1) for _ in range(r.integers(1, 6))] + [("</ul>", None, 0)]
            elif u < 0.92:
                out += [(self.pick(["<blockquote>", "<pre>", "<figure><figcaption>"]), self.prose(), 1), ("</blockquote></pre></figcaption></figure>", None, 0)]
            elif u < 0.95:
                out += [("<table><tr>", None, 0)] + [("<td>", self.words(1, 4), 1) for _ in range(r.integers(2, 7))] + [("</table>", None, 0)]
            else:
                out += self.boiler(self.pick("ads ads notice side menu form"))
        return out + [(f"</{t}>", None, 0)]

    def page(self) -> tuple[list, np.ndarray]:
        r, parts = self.r, []
        self.new_style()
        before = ["menu", "head", "ads", "notice", "form", "side"]
        after = ["foot", "side", "comment", "ads", "form", "menu", "notice"]
        for k in before:
            if r.random() < (0.7 if k in ("menu", "head") else 0.3):
                parts.append(self.boiler(k))
        r.shuffle(before)
        parts = [parts[i] for i in r.permutation(len(parts))]
        wrap = self.pick(["", "", f"<div{self.named(self.PLAIN)}>", "<main>"])
        parts.append([(wrap, None, 0)] + (self.article() if r.random() < 0.95 else []))
        often = 0.4 if self.style == "named" else 0.6
        tail = [self.boiler(k) for k in after if r.random() < (0.75 if k == "foot" else often if k == "comment" else 0.25)]
        parts += tail
        body = [("<html><body>", None, 0)] + [x for p in parts for x in p]
        # A mark word at the end of each text tells which block it came to.
        html, marks = [], {}
        for i, (tag, text, y) in enumerate(body):
            html.append(tag if text is None else f"{tag}{text} q{i}q")
            if text is not None:
                marks[i] = y
        found = blocks("".join(html))
        ys = np.array([max(marks[int(k)] for k in re.findall(r"q(\d+)q", b[0])) for b in found], np.float32)
        return [(re.sub(r" q\d+q", "", t) or "x", p, s) for t, p, s in found], ys


@functools.lru_cache(1)
def trained(pages: int = 2000, epochs: int = 6, seed: int = 5) -> BlockLabeller:
    """The labeller, trained on ``pages`` made pages with Adam."""
    grammar, model = _Grammar(seed), BlockLabeller(seed)
    data = [(encode(bs), ys) for bs, ys in (grammar.page() for _ in range(pages)) if bs]
    data.sort(key=lambda x: len(x[1]))
    groups = [data[a: a + 32] for a in range(0, len(data), 32)]
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(x) for k, x in model.p.items()}
    t, r = 0, np.random.default_rng(seed)
    for epoch in range(epochs):
        for g in r.permutation(len(groups)):
            batch = groups[g]
            target = np.zeros((len(batch), max(len(y) for _, y in batch)), np.float32)
            for i, (_, y) in enumerate(batch):
                target[i, : len(y)] = y
            grads, _ = model.gradient([e for e, _ in batch], target)
            t += 1
            rate = 0.01 * (1.0 if epoch < epochs - 2 else 0.5 if epoch < epochs - 1 else 0.15)
            for k, gr in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * gr
                v[k] = 0.999 * v[k] + 0.001 * gr * gr
                model.p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return model


def main_texts(model: BlockLabeller, pages: list[str | None]) -> list[str]:
    cut = [blocks(p) if p else [] for p in pages]
    return ["\n\n".join(b[0] for b, y in zip(bs, ys) if y) for bs, ys in zip(cut, model.label(cut))]


def with_text(pages: DataFrame, html_col: str = "html", out: str = "text") -> tuple[DataFrame, str]:
    """``pages`` with a column of main texts, and its name."""
    ship_package(pages.sparkSession)
    out = fresh(pages.columns, out)
    held = pages.sparkSession.sparkContext.broadcast(trained().p)

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = BlockLabeller()
        model.p = held.value
        for batch in batches:
            done: list[str] = []
            for at in range(0, len(batch), 256):
                done += main_texts(model, batch.slice(at, 256).to_pylist())
            yield pa.array(done, pa.string())

    return pages.withColumn(out, extract(F.col(html_col))), out


def extract(pages: DataFrame) -> DataFrame:
    found, out = with_text(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col(out).alias("text"), F.char_length(F.col(out)).cast("bigint").alias("n_chars"))
