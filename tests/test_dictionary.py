"""One pass over a text finds what a scan per pattern finds."""
import re

import pytest
from pyspark.sql import functions as F

from hiresight import config as C
from hiresight.functions import dictionary as D
from hiresight.functions import text as TX

TEXTS = ["Senior+ Python разработчик, lead generation", "стажёр / junior data-аналитик (SQL, Excel)", "Team  Lead, tech lead, тим-лид", "ведущая роль, мидл", None, "",
         "internship; preseniors", "architect's team", "ios android swift " * 500, "middle+", "Java JavaScript c++ .NET", "ТИМЛИД. ТИМ ЛИД. technical lead"]


def test_flags_equal_scans(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    every = {**C.ROLE_KEYWORDS, **C.TECH_KEYWORDS, **C.DATA_SKILL_KEYWORDS}
    one = D.with_flags(df, F.col("t"), C.ROLE_KEYWORDS, C.TECH_KEYWORDS, C.DATA_SKILL_KEYWORDS)
    each = df.select("i", "t", *[c.alias(k) for k, c in TX.keyword_flags(F.col("t"), every).items()])
    assert one.columns == each.columns
    assert sorted(one.collect(), key=lambda r: r.i) == sorted(each.collect(), key=lambda r: r.i)
    assert any(r.has_cpp and r.has_javascript for r in one.collect())


def test_labels_equal_scans(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = {r.i: r.g for r in D.with_label(df, F.col("t"), C.GRADE_KEYWORDS, "g", C.LEAD_STOPWORDS).collect()}
    for i, t in enumerate(TEXTS):
        low = (t or "").lower()
        for s in C.LEAD_STOPWORDS:
            low = low.replace(s, "")
        assert got[i] == next((g for g, ps in C.GRADE_KEYWORDS.items() if any(re.search(p, low) for p in ps)), "unknown"), t
    assert set(got.values()) == {"senior", "intern", "lead", "middle", "unknown", "architect"}


@pytest.mark.parametrize("pattern, anchor, bounded", [
    (r"\bintern\b", "intern", True), (r"\bстаж[её]р\b", "стаж", True), (r"\bmiddle\+?\b", "middle", True), (r"\bel\s*ción", "ción", False),
    (r"\btech(nical)?\s*lead\b", "tech", False), (r"a|bcd", "", True), (r"(ab|c)d?e{2,3}f", "f", False), (r"x+", "", False), (r"\d{2}ab*c", "a", False)])
def test_anchors(pattern, anchor, bounded):
    assert D.anchor_of(pattern) == anchor and D.is_bounded(pattern) is bounded


def test_expressions_end_at_word_edges(spark):
    """Near one occurrence stands another inside a word, at every distance."""
    texts = [" que" * 0 + "xque" + "-" * n + "quelle" + "." * 40 for n in range(40)] + ["a que b", "xque " + "y" * 9 + " que"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.h for r in df.select(D.hits(F.col("t"), {"q": [r"\bque\b"]}, regex=True).alias("h")).collect()]
    assert got == [[0] if re.search(r"\bque\b", t) else [] for t in texts] and [0] in got and [] in got


def test_odd_dictionaries(spark):
    df = spark.createDataFrame([("xaab 12",), (None,)], "t string")
    flags = D.hits(F.col("t"), {"none": [], "empty": [""], "nested": ["aa", "a", "aab"], "b": ["b"]})
    exprs = D.hits(F.col("t"), {"digits": [r"\d+"], "either": ["q|aab"], "anchored": [r"x(a+)b"], "no": [r"z\b"]}, regex=True)
    rows = df.select(flags.alias("f"), exprs.alias("e")).collect()
    assert (rows[0].f, rows[0].e) == ([1, 2, 3], [0, 1, 2]) and (rows[1].f, rows[1].e) == ([], [])
