"""Operator 1, benchmark decontamination.

One Aho-Corasick automaton holds every window of ``width`` consecutive words of
the normalised benchmark items; each text is normalised and scanned once, and
the hits are mapped back to word numbers and to character offsets of the
original text.

Defined cases: a null or wordless text has no words, no hits and no items; an
item without words has no window; an item of fewer than ``width`` words is one
window; items that share a window are all reported; items repeated under one id
count once; items without an id are left out; an empty benchmark hits nothing.
Texts may be of any length (work and memory are linear in one text), repeated
rows are scanned like any others, and all other columns pass through.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .frames import fresh, ship_package
from .textkit import ALNUM_LOWER, each_text, words

WORD = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Benchmark bytes that go into one automaton; a larger benchmark is scanned in
#: blocks of at most this size, one pass over the texts each.
BLOCK_BYTES = 32 << 20
RESULT = "struct<n_words:bigint,hit_words:array<struct<first:int,last:int>>,spans:array<struct<start:int,end:int>>,item_ids:array<string>>"
_TYPE = pa.struct([("n_words", pa.int64()),
                   ("hit_words", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                   ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                   ("item_ids", pa.list_(pa.string()))])


def item_windows(items: list[tuple[str, bytes]], width: int) -> dict[bytes, tuple[int, list[str]]]:
    """window -> (its number of words, ids of the items that hold it)."""
    out: dict[bytes, tuple[int, list[str]]] = {}
    for item, text in items:
        ws = words(text, ALNUM_LOWER)
        if not ws:
            continue
        n = min(width, len(ws))
        for at in range(len(ws) - n + 1):
            ids = out.setdefault(b" ".join(ws[at: at + n]), (n, []))[1]
            if item not in ids:
                ids.append(item)
    return out


def build(items: list[tuple[str, bytes]], width: int):
    """The automaton over the bytes (one latin-1 character each) of all windows,
    blanks at both ends so that only whole words match."""
    automaton = ahocorasick.Automaton()
    for window, found in item_windows(items, width).items():
        automaton.add_word(" " + window.decode("latin-1") + " ", found)
    if len(automaton):
        automaton.make_automaton()
    return automaton


def scan(automaton, text: bytes | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Words of the text, merged runs (first, last) of hit words, ids of items hit."""
    ws = words(text, ALNUM_LOWER)
    if not ws or not len(automaton):
        return len(ws), [], set()
    line = " " + b" ".join(ws).decode("latin-1") + " "
    ends, sizes, items = [], [], set()
    for end, (n, ids) in automaton.iter(line):
        ends.append(end)
        sizes.append(n)
        items.update(ids)
    if not ends:
        return len(ws), [], items
    blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    last = np.searchsorted(blanks, ends) - 1
    return len(ws), merge_runs(sorted(zip((last - np.array(sizes) + 1).tolist(), last.tolist()))), items


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in runs:
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def char_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets [start, end) in the original text of runs of words."""
    at = [m.span() for m in WORD.finditer(text)]
    return [(at[a][0], at[b][1]) for a, b in runs]


def scan_texts(docs: DataFrame, items: list[tuple[str, bytes]], text_col: str, out: str, width: int) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(items)

    @F.arrow_udf(RESULT)
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = build(held.value, width)
        for batch in batches:
            rows = []
            for text in each_text(batch):
                n, runs, ids = scan(automaton, text)
                rows.append({"n_words": n, "hit_words": [{"first": a, "last": b} for a, b in runs],
                             "spans": [{"start": a, "end": b} for a, b in char_spans(text.decode(), runs)] if runs else [],
                             "item_ids": sorted(ids)})
            yield pa.array(rows, _TYPE)

    return docs.withColumn(out, scanned(F.col(text_col)))


def benchmark_blocks(bench: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks of about ``block_bytes``, split by a hash of the id."""
    rows = bench.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text")) \
        .where(F.col("item").isNotNull() & F.col("text").isNotNull())
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + size // block_bytes
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
        yield [(r.item, bytes(r.text)) for r in part.distinct().collect()]


def find_contamination(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", out: str = "contamination", width: int = 10,
                       block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """``docs`` with one struct column of findings, and that column's name
    (``out``, with underscores if taken).  The benchmark is a stated, bounded
    set: at most ``block_bytes`` of it are in a task at once."""
    ship_package(docs.sparkSession)
    if width < 1:
        raise ValueError("width must be at least one word")
    out = fresh(docs.columns, out)
    result = None
    for items in benchmark_blocks(bench, item_col, item_text_col, block_bytes):
        if result is None:
            result = scan_texts(docs, items, text_col, out, width)
            continue
        more = fresh(result.columns, "_more")
        both = scan_texts(reliable_checkpoint(result), items, text_col, more, width)
        result = both.withColumn(out, _merged(out, more)).drop(more)
    return result, out


def _merged(a: str, b: str):
    """Findings of two blocks in one: overlapping runs are joined."""
    def joined(field: str, lo: str, hi: str, touch: int):
        runs = F.array_sort(F.concat(f"{a}.{field}", f"{b}.{field}"))
        step = lambda acc, x: F.when(
            (F.size(acc) > 0) & (x[lo] <= F.element_at(acc, -1)[hi] + touch),
            F.concat(F.slice(acc, 1, F.size(acc) - 1),
                     F.array(F.struct(F.element_at(acc, -1)[lo].alias(lo), F.greatest(F.element_at(acc, -1)[hi], x[hi]).alias(hi))))
        ).otherwise(F.concat(acc, F.array(x)))
        return F.aggregate(runs, F.slice(runs, 1, 0), step)

    return F.struct(F.col(f"{a}.n_words").alias("n_words"), joined("hit_words", "first", "last", 1).alias("hit_words"),
                    joined("spans", "start", "end", 0).alias("spans"),
                    F.array_sort(F.array_union(f"{a}.item_ids", f"{b}.item_ids")).alias("item_ids"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """The rows without any benchmark window, columns as they were."""
    found, out = find_contamination(docs, bench, **options)
    return found.where(F.size(F.col(out)["item_ids"]) == 0).drop(out)


def digest(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: counts of words, hit words and items, and the items' digest."""
    found, out = find_contamination(docs.select(id_col, "text"), bench)
    f = F.col(out)
    n_hit = F.aggregate(f["hit_words"], F.lit(0).cast("bigint"), lambda s, r: s + (r["last"] - r["first"] + 1))
    return found.select(id_col, f["n_words"].alias("n_words"), n_hit.alias("n_hit"),
                        F.size(f["item_ids"]).cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(f["item_ids"], ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))
