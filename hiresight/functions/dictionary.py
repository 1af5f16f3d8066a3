"""Dictionaries of patterns looked up in one pass over each text.

All patterns of all keys (flags or labels) are one automaton; a text is read once,
however many patterns there are, and gives the array of the keys that occur in it, by
their place in the dictionary.  Flags and first labels are then array lookups.  The pass is an
Arrow-batched function, as the column functions have only one scan per pattern; where
``ahocorasick`` isn't installed, those scans are used instead.

Regular expressions are found by an anchor, their longest run of plain letters: only
where it occurs is the expression itself tried, around the place if its length is
bounded, else over the text.  Expressions without an anchor are tried on every text.
Python's expressions know Unicode letters, so ``\\b`` works for every script.
"""
from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

try:
    import ahocorasick
except ImportError:
    ahocorasick = None

#: What in an expression isn't plain text: escapes, classes, groups, repeated characters.
_TIMES = r"(?:\{[^}]*\}|[?*+])*"
_SPECIAL = re.compile(rf"(?:\\.|\[[^\]]*\]|\((?:[^()]|\([^()]*\))*\)|[.^$]){_TIMES}|.(?:\{{[^}}]*\}}|[?*+])+")


def anchor_of(pattern: str) -> str:
    """The longest run of plain text that every match of ``pattern`` holds; "" if none is sure."""
    outside = re.sub(r"\\.|\[[^\]]*\]|\((?:[^()]|\([^()]*\))*\)", "", pattern)
    return "" if "|" in outside or "(?" in pattern else max(_SPECIAL.split(pattern), key=len)


def is_bounded(pattern: str) -> bool:
    return not re.search(r"[*+{]", re.sub(r"\\.|\[[^\]]*\](?![*+{])", "x", pattern))


def hits(text: Column, dictionary: Mapping[str, Sequence[str]], regex: bool = False) -> Column:
    """Sorted places (from 0) of the dictionary's keys that have a pattern in ``text``
    (which should already be lower-case, as the patterns); null text: none."""
    if ahocorasick is None:
        found = [F.when(_scan(text, list(p), regex), F.lit(i)) for i, p in enumerate(dictionary.values())]
        return F.filter(F.array(*found), lambda i: i.isNotNull()) if found else F.array().cast("array<int>")
    plain: dict[str, set[int]] = {}
    tried: dict[str, list[tuple[int, str, int]]] = {}           # anchor -> (key, expression, reach; 0: the whole text)
    for i, patterns in enumerate(dictionary.values()):
        for p in patterns:
            if not regex:
                plain.setdefault(p, set()).add(i)
            else:
                tried.setdefault(anchor_of(p), []).append((i, p, 2 * len(p) if is_bounded(p) else 0))
    always = plain.pop("", set())
    unanchored = tried.pop("", [])

    @F.pandas_udf("array<int>")
    def lookup(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick as ac
        automaton = ac.Automaton()
        for word in {*plain, *tried}:
            automaton.add_word(word, (word, frozenset(plain.get(word, ())), [(i, re.compile(p), reach) for i, p, reach in tried.get(word, [])]))
        if len(automaton):
            automaton.make_automaton()
        rest = [(i, re.compile(p)) for i, p, _ in unanchored]

        def keys(t: str | None) -> list[int]:
            if t is None:
                return []
            got = set(always)
            settled = set()
            for end, (word, own, expressions) in automaton.iter(t) if len(automaton) else ():
                got |= own
                for i, expression, reach in expressions:
                    if i in got or (i, expression) in settled:
                        continue
                    if not reach:
                        settled.add((i, expression))
                    stop = end + 1 + reach if reach else len(t)
                    m = expression.search(t, max(0, end - reach - len(word)) if reach else 0, stop)
                    if m and (m.end() < stop or stop >= len(t)):     # at a cut, \b would hold inside a word
                        got.add(i)
            got |= {i for i, expression in rest if i not in got and expression.search(t)}
            return sorted(got)

        for batch in batches:
            yield batch.map(keys)

    return lookup(text)


def _scan(text: Column, patterns: list[str], regex: bool) -> Column:
    if not patterns:
        return F.lit(False)
    if regex:
        return text.rlike("(?U)" + "|".join(f"(?:{p})" for p in patterns))
    out = text.contains(patterns[0])
    for p in patterns[1:]:
        out = out | text.contains(p)
    return out


def with_flags(df: DataFrame, text: Column, *dictionaries: Mapping[str, Sequence[str]]) -> DataFrame:
    """A boolean column for each key of the dictionaries: one of its patterns
    (lower-cased) occurs in the lower-cased text."""
    every: dict[str, list[str]] = {}
    for d in dictionaries:
        for k, patterns in d.items():
            every.setdefault(k, []).extend(p.lower() for p in patterns)
    found = df.withColumn("_hits", hits(F.lower(F.coalesce(text, F.lit(""))), every))
    return found.withColumns({k: F.array_contains("_hits", i) for i, k in enumerate(every)}).drop("_hits")


def with_label(df: DataFrame, text: Column, labels: Mapping[str, Sequence[str]], out: str, stopwords: Sequence[str] = (), default: str = "unknown") -> DataFrame:
    """Stop phrases removed from the lower-cased text, then the first label that has a
    matching expression."""
    t = F.lower(F.coalesce(text, F.lit("")))
    for s in stopwords:
        t = F.replace(t, F.lit(s), F.lit(""))
    names = F.array(*[F.lit(k) for k in labels])
    found = df.withColumn("_hits", hits(t, labels, regex=True))
    return found.withColumn(out, F.coalesce(F.get(names, F.get("_hits", F.lit(0))), F.lit(default))).drop("_hits")
