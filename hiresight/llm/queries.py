"""Queries of the operators in this subpackage, with DuckDB SQL where SQL can
express them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ann, decontam, hmm, htmltext, langid, merkle, mixing, nearjoin, quality, slices, toxicity, warc, whitening
from .frames import table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearjoin.near_components(table(spark, sf_dir, "documents"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.scores(table(spark, sf_dir, "documents"))


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slices.top_scores(table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verification(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_mixing, op3_quality, op4_toxicity, op5_warc, op6_html_text, op7_jaccard_join, op8_nearest,
    op9_language_id, op10_lm_score, op11_topk, op12_whitening, op13_merkle)}

#: Levels of the trees in the SQL of op13: 16 ** 6 rows a source, 16 ** 6 sources.
_LEVELS = range(6)


def _leaf(text: str) -> str:
    value = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    return "sha256(" + " || ".join(value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, nodes: str) -> str:
    """CTEs name0, name1, ... of the levels above ``nodes`` (t, i, h): n nodes in the
    tree, k the nodes' hashes of a run, r the run's hash (a lone node: its own)."""
    out = []
    for level in _LEVELS:
        below = nodes if level == 0 else f"(SELECT t, i // 16 AS i, any_value(r) AS h FROM {name}{level - 1} GROUP BY t, i // 16)"
        out.append(f"""{name}{level} AS (SELECT t, i, h, n, k, CASE WHEN n > 1 THEN sha256(array_to_string(k, '')) ELSE h END AS r FROM (
  SELECT t, i, h, count(*) OVER (PARTITION BY t) AS n, list(h) OVER (PARTITION BY t, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS k
  FROM {below} AS b) AS q)""")
    return ",\n".join(out)


def _witness(name: str, tree: str, place: str) -> tuple[str, str]:
    """Joins of a node's levels, and the list of (place, siblings) of its proof."""
    joins = " ".join(f"JOIN {name}{x} AS {name}_{x} ON {name}_{x}.t = {tree} AND {name}_{x}.i = {place} // {16 ** x}" for x in _LEVELS)
    steps = [f"""{{'at': {place} // {16 ** x} % 16, 'has': {name}_{x}.n > 1, 'k': CASE WHEN {name}_{x}.n > 1 THEN {name}_{x}.k ELSE []::VARCHAR[] END}}""" for x in _LEVELS]
    return joins, ", ".join(steps)


_LEAF_JOINS, _LEAF_STEPS = _witness("a", "d.t", "d.i")
_TOP_JOINS, _TOP_STEPS = _witness("b", "0", "u.i")
_CRC = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT),
  lambda s, c: list_reduce([xor(s, c)] || range(8), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

SQL = {
    "op1_decontamination": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE item_id IS NOT NULL),
w AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(ws[p : p + least(len(ws), 10) - 1], ' ') AS g
  FROM i, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS t(p) WHERE len(ws) > 0),
g AS (
  SELECT rid, p, n, array_to_string(ws[p : p + n - 1], ' ') AS g
  FROM d, (SELECT DISTINCT n FROM w) AS sizes, unnest(range(1, len(ws) - n + 2)) AS t(p) WHERE len(ws) >= n),
m AS (SELECT rid, p, n, item FROM g JOIN w USING (n, g)),
h AS (SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT DISTINCT rid, p, n FROM m) AS q, unnest(range(p, p + n)) AS t(x) GROUP BY rid),
s AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN s USING (rid)""",

    "op2_mixing": r"""
WITH RECURSIVE d AS (
  SELECT source, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number, source_size * 2 AS cap FROM s0),
s2 AS (SELECT *, [5, 2, 1][number % 3 + 1] AS weight, sum(source_size) OVER () AS total FROM s1),
s3 AS (SELECT *, (1.5::DOUBLE * total::BIGINT - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
                 / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
       FROM s2 WINDOW o AS (ORDER BY cap::DOUBLE / weight, number)),
s4 AS (SELECT *, least(cap::DOUBLE, weight * max(level) OVER ()) AS target FROM s3),
s5 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs,
              greatest(1, ceil(docs / 64.0))::BIGINT AS blocks FROM s4),
s AS (SELECT *, target - epochs * source_size AS rest FROM s5),
p AS (SELECT d.*, s.number, s.source_size, s.target, s.epochs, s.rest, ('0x' || substr(md5(k), 1, 15))::BIGINT % s.blocks AS block,
             ('0x' || substr(md5(k), 17, 15))::BIGINT AS spread
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
b AS (SELECT number, rest, block, sum(size) AS w, count(*) AS n FROM p GROUP BY ALL),
br AS (SELECT *, sum(w) OVER (PARTITION BY number ORDER BY block) AS run FROM b),
e AS (SELECT number, block AS edge, rest - (run - w) AS edge_left, ceil(n / 64.0)::BIGINT AS subs FROM br WHERE run > rest AND run - w <= rest),
q AS (SELECT p.*, e.edge_left, spread % subs AS sub FROM p JOIN e ON p.number = e.number AND p.block = e.edge),
qb AS (SELECT number, edge_left, sub, sum(size) AS w FROM q GROUP BY ALL),
qr AS (SELECT *, sum(w) OVER (PARTITION BY number ORDER BY sub) AS run FROM qb),
f AS (SELECT number, sub AS sub_edge, edge_left - (run - w) AS sub_left FROM qr WHERE run > edge_left AND run - w <= edge_left),
u AS (SELECT q.number, f.sub_left, k, sum(size) AS unit FROM q JOIN f ON q.number = f.number AND q.sub = f.sub_edge GROUP BY ALL),
ur AS (SELECT *, row_number() OVER (PARTITION BY number ORDER BY unit DESC, k) AS rn FROM u),
g(number, rn, room, k, took) AS (
  SELECT number, rn, CASE WHEN unit <= sub_left THEN sub_left - unit ELSE sub_left END, k, unit <= sub_left FROM ur WHERE rn = 1
  UNION ALL
  SELECT ur.number, ur.rn, CASE WHEN unit <= room THEN room - unit ELSE room END, ur.k, unit <= room
  FROM g JOIN ur ON ur.number = g.number AND ur.rn = g.rn + 1)
SELECT p.doc_id, p.size, p.source_size, p.target,
       (p.size * (p.epochs + CASE WHEN p.block < e.edge OR p.block = e.edge AND (p.spread % e.subs < f.sub_edge OR p.spread % e.subs = f.sub_edge AND coalesce(g.took, FALSE))
                                  THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p LEFT JOIN e USING (number) LEFT JOIN f USING (number)
LEFT JOIN g ON g.number = p.number AND g.k = p.k AND p.block = e.edge AND p.spread % e.subs = f.sub_edge""",
    "op5_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY d HAVING count(*) > 1)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (d)""",
    "op7_jaccard_join": rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT rid, array_to_string(ws[p : p + 2], ' ') AS s
  FROM d, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS t(p) WHERE len(ws) > 0),
n AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
two AS (SELECT a.rid AS x, b.rid AS y, count(*) AS common FROM sh a JOIN sh b USING (s) WHERE a.rid < b.rid GROUP BY ALL),
l AS (SELECT x, y FROM two JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * common >= 90 * (a.n + b.n - common)),
e AS (SELECT a.doc_id AS u, b.doc_id AS v FROM l JOIN d a ON a.rid = x JOIN d b ON b.rid = y),
r(u, v) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.u, w.v FROM r JOIN (SELECT u, v FROM e UNION SELECT v, u FROM e) w ON r.v = w.u)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least_id AS component_id
FROM d LEFT JOIN n USING (rid) LEFT JOIN (SELECT u, min(v) AS least_id FROM r GROUP BY u) c ON c.u = doc_id""",
    "op11_topk": """
WITH r AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score FROM r q JOIN r c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM t WHERE rank <= 20""",
    "op13_merkle": f"""
WITH l AS (
  SELECT doc_id, source, {_leaf("text")} AS h,
         CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS changed FROM documents),
o AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS t FROM (SELECT DISTINCT source FROM l) AS q),
d AS (SELECT l.*, o.t, row_number() OVER (PARTITION BY o.t ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM l JOIN o ON l.source IS NOT DISTINCT FROM o.source),
{_tree("a", "d")},
u AS (SELECT 0 AS t, t AS i, any_value(r) AS h FROM a{_LEVELS[-1]} GROUP BY t),
{_tree("b", "u")},
p AS (
  SELECT doc_id, d.h AS leaf, u.h AS subroot, b_{_LEVELS[-1]}.r AS root, coalesce(changed, d.h) AS start,
         list_filter([{_LEAF_STEPS}, {_TOP_STEPS}], lambda s: s.has) AS steps
  FROM d JOIN u ON u.i = d.t {_LEAF_JOINS} {_TOP_JOINS}),
f AS (
  SELECT *, list_reduce([start] || list_transform(steps, lambda s: s.at || ':' || array_to_string(s.k, '')), lambda h, s: sha256(
           substr(split_part(s, ':', 2), 1, 64 * split_part(s, ':', 1)::INTEGER) || h || substr(split_part(s, ':', 2), 64 * split_part(s, ':', 1)::INTEGER + 65))) AS folded_root
  FROM p)
SELECT doc_id, leaf, subroot, root, folded_root, folded_root = root AS verified,
       sha256(array_to_string(list_transform(steps, lambda s: array_to_string(s.k[:s.at], '') || array_to_string(s.k[s.at + 2:], '')), '')) AS proof_sha256
FROM f""",
}
