"""Elements of HTML pages as column expressions: tokens, spans, strings.

A page becomes an array of tokens (tags, comments, raw elements, text).  One
fold over it keeps the stack of open elements and notes where each wanted element
begins and ends: at its own end tag, counted over inner elements of the same
name, or where an element around it is closed, or at the end of the page.  An end tag
without an open element is ignored; void and self-closed elements are empty.
Nothing here runs Python per row.  An element's text is its strings (character
references decoded, trimmed, empty ones dropped) joined by a separator.

Defined cases: a null page is an empty one; an element that isn't there has a null
span, text "" and no strings; unclosed comments and raw elements reach to the end.
"""
from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
#: Possessive, so that long pages need no deep recursion and an unended tag costs one scan.
TOKEN = (r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)(?=[\s/>])[^>]*+>.*?(?:</\1[\s/]*>|\z)"
         r"|</?[a-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|</?[a-z][^>]*+(?:>|\z)|<[!?/][^>]*+(?:>|\z)|(?:[^<]++|<(?![a-z/!?]))++")
#: What is trimmed off strings.
BLANKS = " \t\n\r\x0b\x0c\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Named character references that are decoded, besides all numeric ones.
NAMED = {"nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "laquo": "«", "raquo": "»", "mdash": "—", "ndash": "–", "hellip": "…",
         "bull": "•", "middot": "·", "copy": "©", "reg": "®", "euro": "€", "minus": "−", "thinsp": " ", "ensp": " ", "emsp": " ",
         "amp": "&"}


def tokens(html: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(TOKEN), 0)


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a start tag as written; "" if it has none."""
    pattern = rf"(?is)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])


def decoded(text: Column) -> Column:
    """Character references to characters; most texts have none and are left alone."""
    number = lambda ref: F.when(F.lower(F.substr(ref, F.lit(1), F.lit(1))) == "x", F.conv(F.substr(ref, F.lit(2)), 16, 10)) \
        .otherwise(ref).try_cast("bigint")
    refs = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"), 1))

    def put(t: Column, ref: Column) -> Column:
        n = number(ref)
        char = F.when((n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
        return F.replace(t, F.concat(F.lit("&#"), ref, F.lit(";")), F.coalesce(char, F.lit("\ufffd")))

    out = F.when(text.contains("&#"), F.aggregate(refs, text, put)).otherwise(text)
    for name, char in NAMED.items():
        out = F.replace(out, F.lit(f"&{name};"), F.lit(char))
    return F.when(text.contains("&"), out).otherwise(text)


def spans(toks: Column, wanted: Callable[[Column, Column], Column]) -> Column:
    """array<struct<mark, tag, first, last>> of the wanted elements, in page order:
    their mark, start tag and the 0-based places of start and end token.
    ``wanted`` gives an element's mark from its name and start tag, or null."""
    parts = F.transform(toks, lambda t: F.struct(F.lower(F.regexp_extract(t, r"^</?([a-zA-Z][^\s/>]*)", 1)).alias("name"), t.alias("tag")))
    # of raw elements and text nothing is needed; a start tag keeps its mark
    parts = F.transform(parts, lambda p, i: F.struct(
        F.when(p["name"].isin("", "script", "style", "template"), 0).when(p["tag"].startswith("</"), -1)
         .when(p["name"].isin(*VOID) | p["tag"].endswith("/>"), 2).otherwise(1).alias("kind"), p["name"].alias("name"), i.alias("at"),
        F.when((p["name"] != "") & ~p["tag"].startswith("</"), wanted(p["name"], p["tag"])).alias("mark"), p["tag"].alias("tag")))
    parts = F.filter(parts, lambda p: p["kind"] != 0)
    empty = F.struct(F.array().cast("array<struct<name: string, span: int>>").alias("open"),
                     F.array().cast("array<struct<mark: string, tag: string, first: int, last: int>>").alias("found"))

    def step(acc: Column, p: Column) -> Column:
        opened, found = acc["open"], acc["found"]
        number = F.when(p["mark"].isNotNull(), F.size(found)).otherwise(-1)
        new = F.struct(p["mark"].alias("mark"), p["tag"].alias("tag"), p["at"].cast("int").alias("first"),
                       F.when(p["kind"] == 2, p["at"].cast("int")).alias("last"))
        more = F.when(p["mark"].isNotNull(), F.concat(found, F.array(new))).otherwise(found)
        names = F.reverse(F.transform(opened, lambda x: x["name"]))
        from_top = F.when(F.element_at(names, 1) == p["name"], 1).otherwise(F.array_position(names, p["name"])).cast("int")
        gone = F.slice(opened, F.size(opened) - from_top + 1, from_top)
        ended = F.when(F.exists(gone, lambda x: x["span"] >= 0), F.transform(found, lambda s, k: F.when(
            F.exists(gone, lambda x: x["span"] == k),
            F.struct(s["mark"].alias("mark"), s["tag"].alias("tag"), s["first"].alias("first"), p["at"].cast("int").alias("last"))).otherwise(s))).otherwise(found)
        start = F.struct(F.concat(opened, F.array(F.struct(p["name"].alias("name"), number.alias("span")))).alias("open"), more.alias("found"))
        return F.when(p["kind"] == 1, start).when(p["kind"] == 2, F.struct(opened.alias("open"), more.alias("found"))) \
            .when((F.size(opened) == 0) | (F.coalesce(from_top, F.lit(0)) == 0), acc) \
            .otherwise(F.struct(F.slice(opened, 1, F.size(opened) - from_top).alias("open"), ended.alias("found")))

    n = F.size(toks)
    return F.transform(F.aggregate(parts, empty, step)["found"], lambda s: F.struct(
        s["mark"].alias("mark"), s["tag"].alias("tag"), s["first"].alias("first"), F.coalesce(s["last"], n).alias("last")))


def by_attribute(name: str, *values: str) -> Callable[[Column, Column], Column]:
    """For ``spans``: elements whose attribute ``name`` is one of the values, marked
    with it (any value if none is given)."""
    def wanted(_: Column, tag: Column) -> Column:
        value = F.when(F.lower(tag).contains(name), F.nullif(attribute(tag, name), F.lit("")))
        return F.when(value.isin(*values), value) if values else value
    return wanted


def by_name(*names: str) -> Callable[[Column, Column], Column]:
    return lambda name, _: F.when(name.isin(*names), name)


def texts(toks: Column) -> Column:
    """Every token's string, decoded and trimmed; null for tags and empty strings."""
    return F.transform(toks, lambda t: F.when(~t.rlike("^<[a-zA-Z/!?]"), F.nullif(F.btrim(decoded(t), F.lit(BLANKS)), F.lit(""))))


def strings(texts: Column, span: Column | None = None) -> Column:
    """The strings inside a span, or of the whole page."""
    part = texts if span is None else F.when(span["last"] > span["first"], F.slice(texts, span["first"] + 2, span["last"] - span["first"] - 1))
    return F.array_compact(F.coalesce(part, F.array().cast("array<string>")))


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once a row, however often they are used
    later: filters and projections aren't merged into a generated column."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_elements(df: DataFrame, html: str, wanted: Callable[[Column, Column], Column], texts_col: str = "_texts", found_col: str = "_found") -> DataFrame:
    """``df`` with the page's texts and its wanted elements: array<struct<mark, tag,
    strings>>."""
    df = computed(df, _tokens=tokens(F.col(html)))
    df = computed(df, **{texts_col: texts(F.col("_tokens")), "_spans": spans(F.col("_tokens"), wanted)})
    found = F.transform("_spans", lambda s: F.struct(s["mark"].alias("mark"), s["tag"].alias("tag"), strings(F.col(texts_col), s).alias("strings")))
    return computed(df, **{found_col: found}).drop("_tokens", "_spans")


def first(found: Column, mark: str) -> Column:
    """The first element with a mark; null if there is none."""
    return F.get(F.filter(found, lambda s: s["mark"] == mark), F.lit(0))


def text_of(element: Column, separator: str = "") -> Column:
    """An element's whole text; "" without the element."""
    return F.coalesce(F.array_join(element["strings"], separator), F.lit(""))
