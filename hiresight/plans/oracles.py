"""DuckDB oracle SQL for the registered queries (same names, same columns).

Pandas semantics spelled out in SQL: NULL group keys are dropped, ``n`` counts
non-NULL measures, quantiles are ``quantile_cont``, std is ``stddev_samp``.
"""
from __future__ import annotations

from .binding import vacancy_cte

M = "salary_mid_rub_capped"
ORACLES: dict[str, str] = {}


def r(x: str, d: int = 6) -> str:
    return f"round({x}, {d})"


def summary_sql(src: str, keys: list[str], measure: str, stats: list[str], where: str = "") -> str:
    exprs = {
        "n": f"count({measure})", "count": f"count({measure})", "vacancy_count": f"count({measure})",
        "rows": "count(*)", "n_rows": "count(*)",
        "mean": r(f"avg({measure})"), "min": r(f"min({measure})"), "max": r(f"max({measure})"),
        "std": r(f"stddev_samp({measure})"),
        "median": r(f"quantile_cont({measure}, 0.5)"), "salary_median": r(f"quantile_cont({measure}, 0.5)"),
        "q25": r(f"quantile_cont({measure}, 0.25)"), "q1": r(f"quantile_cont({measure}, 0.25)"),
        "salary_q25": r(f"quantile_cont({measure}, 0.25)"),
        "q75": r(f"quantile_cont({measure}, 0.75)"), "q3": r(f"quantile_cont({measure}, 0.75)"),
        "salary_q75": r(f"quantile_cont({measure}, 0.75)"),
    }
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    cond = " AND ".join(x for x in [nn, where] if x)
    sel = ", ".join(keys + [f"{exprs[s]} AS {s}" for s in stats])
    return f"SELECT {sel} FROM {src}{' WHERE ' + cond if cond else ''} GROUP BY {', '.join(keys)}"


V = vacancy_cte("v")

ORACLES["salary_by_company"] = V + summary_sql("v", ["company"], M, ["n", "median", "mean", "min", "max"])
ORACLES["salary_top_companies"] = V + f"""
SELECT * FROM ({summary_sql('v', ['company'], M, ['n', 'median', 'mean', 'min', 'max'])}) t
ORDER BY median DESC NULLS LAST, company LIMIT 10"""
ORACLES["salary_by_grade"] = V + summary_sql("v", ["grade"], M, ["n", "median", "mean", "std"])
ORACLES["salary_by_city_tier"] = V + summary_sql("v", ["city_tier"], M, ["n", "median", "mean", "std"])
ORACLES["salary_by_primary_role"] = V + summary_sql("v", ["primary_role"], M, ["n", "median", "mean", "std"])
ORACLES["salary_by_experience_bucket"] = V + f""", b AS (
  SELECT *, CASE WHEN coalesce(exp_min_years, exp_max_years, -1) <= 1 THEN '0-1'
                 WHEN coalesce(exp_min_years, exp_max_years, -1) <= 3 THEN '1-3'
                 WHEN coalesce(exp_min_years, exp_max_years, -1) <= 6 THEN '3-6'
                 WHEN coalesce(exp_min_years, exp_max_years, -1) <= 100 THEN '6+' END AS exp_bucket FROM v)
{summary_sql('b', ['exp_bucket'], M, ['n', 'median', 'mean', 'std'])}"""
ORACLES["salary_by_stack_size"] = V + f""", b AS (
  SELECT *, CASE WHEN tech_stack_size >= 0 AND tech_stack_size < 3 THEN '0-3'
                 WHEN tech_stack_size >= 3 AND tech_stack_size < 6 THEN '3-6'
                 WHEN tech_stack_size >= 6 AND tech_stack_size < 10 THEN '6-10'
                 WHEN tech_stack_size >= 10 AND tech_stack_size < 100 THEN '>=10' END AS tech_stack_bin FROM v)
{summary_sql('b', ['tech_stack_bin'], M, ['n', 'median', 'mean', 'std'])}"""

_DOMAIN_ALPHA = ("CASE WHEN domain_age THEN 'age' WHEN domain_color THEN 'color' WHEN domain_size THEN 'size' "
                 "WHEN domain_temperature THEN 'temperature' ELSE 'unknown' END")


def requirement_sql(src: str, level_expr: str, level_name: str, measure: str) -> str:
    return f""", lv AS (SELECT {level_expr} AS {level_name}, {measure} FROM {src}),
tot AS (SELECT count(*) AS total FROM lv),
g AS ({summary_sql('lv', [level_name], measure, ['vacancy_count', 'salary_median', 'salary_q25', 'salary_q75'])})
SELECT g.*, round(coalesce(g.vacancy_count / nullif(tot.total, 0), 0.0), 6) AS share FROM g, tot"""


ORACLES["salary_by_domain"] = V + requirement_sql("v", _DOMAIN_ALPHA, "domain", M)
ORACLES["grade_city_quartiles"] = V + summary_sql("v", ["grade", "city_tier"], M, ["count", "median", "q1", "q3"])
ORACLES["role_work_mode_median"] = V + summary_sql("v", ["primary_role", "work_mode"], M, ["salary_median"])
ORACLES["lineitem_flag_status_quartiles"] = summary_sql("lineitem", ["l_returnflag", "l_linestatus"],
                                                        "l_extendedprice", ["count", "median", "q1", "q3"])
ORACLES["orders_priority_summary"] = summary_sql("orders", ["o_orderpriority"], "o_totalprice",
                                                 ["n", "median", "mean", "std"])
ORACLES["grade_city_median_pivot"] = V + f"""
SELECT grade,
  {', '.join(f"round(max(m) FILTER (WHERE city_tier = '{t}'), 6) AS \"{t}\"" for t in ['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'])}
FROM (SELECT grade, city_tier, quantile_cont({M}, 0.5) AS m FROM v
      WHERE grade IS NOT NULL AND city_tier IS NOT NULL GROUP BY ALL) GROUP BY grade"""

# ------------------------------------------------------------ flag shares --
SKILLS = ["has_bulk", "has_discount", "has_tax", "skill_blue", "skill_cold", "skill_hot", "skill_large", "skill_new",
          "skill_old", "skill_red", "skill_small"]
SKILLS_COLUMN_ORDER = ["has_discount", "has_tax", "has_bulk", "skill_small", "skill_hot", "skill_red", "skill_blue",
                       "skill_large", "skill_old", "skill_cold", "skill_new"]
BENEFITS = ["benefit_low_tax", "benefit_big_discount", "benefit_small_order"]
SOFT = ["soft_rich", "soft_debt", "soft_even"]


def share(c: str, null_as_false: bool = True) -> str:
    return r(f"avg(CAST(coalesce({c}, false) AS INTEGER))") if null_as_false else r(f"avg(CAST({c} AS INTEGER))")


ORACLES["remote_share_by_role"] = V + f"""
SELECT primary_role, {share('is_remote', False)} AS remote_share FROM v WHERE primary_role IS NOT NULL GROUP BY 1"""
ORACLES["junior_friendly_share"] = V + f"""
SELECT primary_role, {share('is_junior_friendly')} AS is_junior_friendly, {share('battle_experience')} AS battle_experience
FROM v WHERE primary_role IS NOT NULL GROUP BY 1"""
_JF = ["is_for_juniors", "allows_students", "has_mentoring", "has_test_task"]
ORACLES["junior_flags_by_segment"] = V + f"""
, w AS (SELECT primary_role, grade, {', '.join(f"{share(c, False)} AS {c}" for c in _JF)}
        FROM v WHERE primary_role IS NOT NULL AND grade IS NOT NULL GROUP BY ALL)
SELECT primary_role, grade, flag, share FROM w UNPIVOT INCLUDE NULLS (share FOR flag IN ({', '.join(_JF)}))"""
ORACLES["skill_frequency"] = V + f"""
, w AS (SELECT {', '.join(f"{share(c, False)} AS {c}" for c in SKILLS)} FROM v)
SELECT skill, share FROM w UNPIVOT INCLUDE NULLS (share FOR skill IN ({', '.join(SKILLS)}))
ORDER BY share DESC NULLS LAST, skill LIMIT 15"""
ORACLES["skill_share_by_grade"] = V + f"""
, w AS (SELECT grade, {', '.join(f"{share(c)} AS {c}" for c in SKILLS)} FROM v WHERE grade IS NOT NULL GROUP BY 1)
SELECT skill, grade, share FROM w UNPIVOT INCLUDE NULLS (share FOR skill IN ({', '.join(SKILLS)}))"""


def top_sql(src: str, key: str, n: int) -> str:
    return (f"(SELECT {key} FROM {src} WHERE {key} IS NOT NULL GROUP BY 1 "
            f"ORDER BY count(*) DESC, {key} LIMIT {n})")


def per_vacancy(flags) -> str:
    return r("avg(" + " + ".join(f"CAST(coalesce({c}, false) AS INTEGER)" for c in flags) + ")")


ORACLES["benefits_by_company"] = V + f"""
SELECT company, {', '.join(f"{share(c)} AS {c}" for c in BENEFITS)}, {per_vacancy(BENEFITS)} AS benefits_per_vacancy,
       count(*) AS n_vacancies
FROM v WHERE company IN {top_sql('v', 'company', 10)} GROUP BY 1"""
ORACLES["benefits_by_grade"] = V + f"""
SELECT grade, {', '.join(f"{share(c)} AS {c}" for c in BENEFITS)}, {per_vacancy(BENEFITS)} AS benefits_per_vacancy,
       count(*) AS n_vacancies
FROM v WHERE grade IS NOT NULL GROUP BY 1"""
ORACLES["benefits_by_employer"] = V + f"""
SELECT company, {', '.join(f"{share(c)} AS {c}" for c in BENEFITS)}, count(*) AS n_vacancies
FROM v WHERE company IN {top_sql('v', 'company', 10)} GROUP BY 1"""
ORACLES["soft_skill_totals"] = V + " UNION ALL ".join(
    f"SELECT '{c}' AS soft_skill, CAST(sum(CAST(coalesce({c}, false) AS INTEGER)) AS BIGINT) AS count, "
    f"{share(c)} AS share FROM v" for c in SOFT)
ORACLES["soft_skills_by_employer"] = V + f"""
SELECT company, {', '.join(f"{share(c)} AS {c}" for c in SOFT)}, count(*) AS n_vacancies
FROM v WHERE company IN {top_sql('v', 'company', 10)} GROUP BY 1"""
ORACLES["top_employers"] = V + f"""
, tot AS (SELECT count(*) AS total FROM v)
SELECT company, {r(f'quantile_cont({M}, 0.5)')} AS salary_median, count(*) AS vacancy_count,
       {r('avg(employer_rating)')} AS rating_mean, {r('count(*) / max(tot.total)')} AS share
FROM v, tot WHERE company IN {top_sql('v', 'company', 15)} GROUP BY 1"""


def corr_sql(src: str, cols: list[str], cast=lambda c: c) -> str:
    parts = []
    for a in cols:
        for b in cols:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(f'corr({cast(b)}, {cast(a)})')} AS corr FROM {src}")
    return " UNION ALL ".join(parts)


ORACLES["lineitem_correlation"] = corr_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
ORACLES["soft_skills_correlation"] = V + corr_sql("v", SOFT, lambda c: f"CAST(coalesce({c}, false) AS DOUBLE)")
ORACLES["order_priority_counts"] = """
SELECT o_orderpriority, count(*) AS count, round(count(*) / (SELECT count(*) FROM orders WHERE o_orderpriority IS NOT NULL), 6) AS share
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""
ORACLES["skill_premium"] = V + " UNION ALL ".join(f"""
SELECT * FROM (SELECT '{c}' AS skill,
  {r(f'quantile_cont({M}, 0.5) FILTER (WHERE coalesce({c}, false))')} AS median_with,
  {r(f'quantile_cont({M}, 0.5) FILTER (WHERE NOT coalesce({c}, false))')} AS median_without,
  {r(f'quantile_cont({M}, 0.5) FILTER (WHERE coalesce({c}, false)) - quantile_cont({M}, 0.5) FILTER (WHERE NOT coalesce({c}, false))')} AS premium_abs,
  {r(f'(quantile_cont({M}, 0.5) FILTER (WHERE coalesce({c}, false)) - quantile_cont({M}, 0.5) FILTER (WHERE NOT coalesce({c}, false))) / nullif(quantile_cont({M}, 0.5) FILTER (WHERE NOT coalesce({c}, false)), 0)')} AS premium_pct,
  CAST(sum(CAST(coalesce({c}, false) AS INTEGER)) AS BIGINT) AS count_with_skill FROM v) WHERE count_with_skill >= 30"""
                                                   for c in SKILLS)

# --------------------------------------------------------------- orders --
ORDERS_REQ = """WITH o AS (
  SELECT o_orderkey, o_totalprice,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'advanced' WHEN '2-HIGH' THEN 'Upper-Intermediate'
         WHEN '3-MEDIUM' THEN ' b1 ' WHEN '5-LOW' THEN 'basic' END AS lang_english_level,
    o_orderstatus <> 'F' AS lang_english_required,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'master_or_higher' WHEN '2-HIGH' THEN 'bachelor_or_higher'
         WHEN '3-MEDIUM' THEN 'partial_higher' WHEN '5-LOW' THEN 'none' END AS edu_level,
    o_orderstatus = 'O' AS edu_required,
    CASE WHEN o_orderstatus = 'P' THEN true END AS edu_technical
  FROM orders)"""
_ENG_MAP = ("CASE WHEN lang_english_required = false THEN 'no_english' ELSE CASE lower(trim(lang_english_level)) "
            "WHEN 'none' THEN 'no_english' WHEN 'basic' THEN 'A2' WHEN 'a2' THEN 'A2' WHEN 'elementary' THEN 'A2' "
            "WHEN 'pre-intermediate' THEN 'A2' WHEN 'intermediate' THEN 'B1' WHEN 'b1' THEN 'B1' "
            "WHEN 'upper_intermediate' THEN 'B2' WHEN 'upper-intermediate' THEN 'B2' WHEN 'b2' THEN 'B2' "
            "WHEN 'advanced' THEN 'C1_plus' WHEN 'fluent' THEN 'C1_plus' WHEN 'c1' THEN 'C1_plus' "
            "WHEN 'c2' THEN 'C1_plus' WHEN 'native' THEN 'C1_plus' WHEN 'proficient' THEN 'C1_plus' "
            "ELSE 'no_english' END END")
_EDU_MAP = ("CASE WHEN lower(trim(edu_level)) = 'master_or_higher' THEN 'master_phd' "
            "WHEN coalesce(edu_technical, false) THEN 'technical_only' "
            "WHEN coalesce(edu_required, false) OR coalesce(lower(trim(edu_level)) IN ('any_he', 'bachelor_or_higher', "
            "'partial_higher'), false) THEN 'any_degree' ELSE 'no_degree_required' END")
ORACLES["english_requirement_stats"] = ORDERS_REQ + requirement_sql("o", _ENG_MAP, "english_level", "o_totalprice")
ORACLES["education_requirement_stats"] = ORDERS_REQ + requirement_sql("o", _EDU_MAP, "education_level", "o_totalprice")

# ------------------------------------------------------------ market view --
_MV_KEYS = "primary_role, grade, city_tier, domain"


def market_sql(keys: str, skills=SKILLS_COLUMN_ORDER) -> str:
    nn = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return f"""
, t AS (SELECT * FROM v WHERE {nn}),
g AS (SELECT {keys}, count({M}) AS vacancy_count, {r(f'quantile_cont({M}, 0.5)')} AS salary_median,
        {r(f'quantile_cont({M}, 0.25)')} AS salary_q25, {r(f'quantile_cont({M}, 0.75)')} AS salary_q75,
        {share('is_junior_friendly')} AS junior_friendly_share, {share('is_remote')} AS remote_share,
        {r('quantile_cont(tech_stack_size, 0.5)')} AS median_tech_stack_size
      FROM t GROUP BY ALL),
w AS (SELECT {keys}, {', '.join(f"avg(CAST(coalesce({c}, false) AS INTEGER)) AS {c}" for c in skills)} FROM t GROUP BY ALL),
u AS (SELECT {keys}, regexp_replace(skill, '^(skill_|has_)', '') AS name, share
      FROM (UNPIVOT w ON {', '.join(skills)} INTO NAME skill VALUE share) WHERE share > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY share DESC, name) AS rn FROM u),
ts AS (SELECT {keys}, string_agg(name || ' (' || printf('%.0f', share * 100) || '%)', ', ' ORDER BY rn) AS top_skills
       FROM ranked WHERE rn <= 5 GROUP BY ALL)
"""


ORACLES["market_view"] = V + market_sql(_MV_KEYS) + f"""
SELECT g.*, coalesce(ts.top_skills, '') AS top_skills FROM g LEFT JOIN ts USING ({_MV_KEYS})"""
_GK = "primary_role, grade, city_tier"
ORACLES["market_view_grid"] = V + market_sql(_GK) + f"""
, grid AS (SELECT * FROM (SELECT DISTINCT primary_role FROM t) CROSS JOIN (SELECT DISTINCT grade FROM t)
           CROSS JOIN (SELECT DISTINCT city_tier FROM t))
SELECT grid.*, coalesce(g.vacancy_count, 0) AS vacancy_count, g.salary_median, g.salary_q25, g.salary_q75,
       g.junior_friendly_share, g.remote_share, g.median_tech_stack_size,
       CASE WHEN g.vacancy_count IS NULL THEN NULL ELSE coalesce(ts.top_skills, '') END AS top_skills
FROM grid LEFT JOIN g USING ({_GK}) LEFT JOIN ts USING ({_GK})"""

# --------------------------------------------------------------- cleaning --
_MK = "('unknown', 'не указано', 'неизвестно', '', 'n/a', 'nan', '-', '—', '4-not specified')"


def unmark(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) IN {_MK} THEN NULL ELSE {c} END"


ORACLES["orders_unknown_markers"] = f"""
SELECT o_orderkey, o_custkey, {unmark('o_orderstatus')} AS o_orderstatus, o_totalprice, o_orderdate,
       {unmark('o_orderpriority')} AS o_orderpriority FROM orders"""
ORACLES["orders_missingness"] = f"""
WITH r AS (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 'Yes' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'n/a'
                          ELSE 'no' END AS is_urgent,
       CASE WHEN o_orderstatus = 'O' THEN 'junior' WHEN o_orderstatus = 'F' THEN ' - ' END AS grade,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 5 END AS rush_count,
       CASE WHEN o_orderkey % 3 = 0 THEN 'true' WHEN o_orderkey % 3 = 1 THEN 'FALSE' ELSE 'maybe' END AS has_gift
  FROM orders)
SELECT o_orderkey, o_custkey, {unmark('o_orderstatus')} AS o_orderstatus, o_totalprice, o_orderdate,
       {unmark('o_orderpriority')} AS o_orderpriority,
       CASE lower(trim(is_urgent)) WHEN 'yes' THEN true WHEN 'no' THEN false END AS is_urgent,
       coalesce({unmark('grade')}, 'unknown') AS grade,
       coalesce(rush_count, 0) AS rush_count,
       CASE lower(trim(has_gift)) WHEN 'true' THEN true WHEN 'false' THEN false END AS has_gift
FROM r"""
ORACLES["order_ship_age_days"] = """
SELECT l_orderkey, l_linenumber,
       CAST(floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0) AS BIGINT) AS vacancy_age_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
ORACLES["salary_prepare"] = V + f"""
SELECT vacancy_id, {r('salary_mid_rub')} AS salary_mid_rub, salary_known, {r(M)} AS {M} FROM v"""
ORACLES["events_latest_per_user"] = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events)
WHERE rn = 1"""
ORACLES["vacancy_feature_columns"] = V + """
SELECT vacancy_id, work_mode, primary_role, grade_from_experience, grade_final, is_junior_friendly, battle_experience,
       tech_stack_size, benefits_count, soft_skills_count, hard_stack_count, skills_count, role_count, domain FROM v"""
ORACLES["salary_bucket"] = V + f"""
, e AS (SELECT quantile_cont({M}, 1/3) AS e1, quantile_cont({M}, 2/3) AS e2, count({M}) AS nv FROM v)
SELECT vacancy_id, CASE WHEN nv < 3 OR {M} IS NULL THEN NULL WHEN {M} <= e1 THEN 'low' WHEN {M} <= e2 THEN 'mid'
                        ELSE 'high' END AS salary_bucket FROM v, e"""
ORACLES["event_time_features"] = """
SELECT event_id, CAST(isodow(ts) - 1 AS INTEGER) AS published_weekday, CAST(month(ts) AS INTEGER) AS published_month,
       isodow(ts) IN (6, 7) AS is_weekend_post FROM events"""
_MP = ", ".join(f"'{c}'" for c in __import__("hiresight.config", fromlist=["x"]).CITY_MILLION_PLUS)
ORACLES["customer_city_tier"] = f"""
WITH c AS (SELECT c_custkey, CASE n_name WHEN 'JAPAN' THEN NULL WHEN 'RUSSIA' THEN 'Москва' WHEN 'CHINA' THEN 'Moscow Region'
  WHEN 'FRANCE' THEN 'Санкт-Петербург' WHEN 'GERMANY' THEN 'Казань' WHEN 'INDIA' THEN 'Novosibirsk' WHEN 'IRAN' THEN 'Алматы'
  WHEN 'IRAQ' THEN 'Kazakhstan' ELSE n_name END AS city FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, city,
  CASE WHEN city IS NULL THEN 'unknown'
       WHEN contains(lower(city), 'moscow') OR contains(lower(city), 'моск') THEN 'Moscow'
       WHEN contains(lower(city), 'spb') OR contains(lower(city), 'петербург') OR contains(lower(city), 'санкт') THEN 'SPb'
       WHEN lower(city) IN ({_MP}) THEN 'Million+'
       WHEN contains(lower(city), 'kazakhstan') OR contains(lower(city), 'kazakh') OR contains(lower(city), 'kz')
         OR contains(lower(city), 'алматы') OR contains(lower(city), 'нур-султан') OR contains(lower(city), 'астана') THEN 'KZ/Other'
       ELSE 'Other RU' END AS city_tier
FROM c"""
ORACLES["part_experience_grade"] = """
SELECT p_partkey, CASE WHEN p_size < 3 THEN 'intern'
  WHEN p_size % 10 = 0 THEN 'unknown' WHEN p_size % 10 < 1 THEN 'intern' WHEN p_size % 10 < 3 THEN 'junior'
  WHEN p_size % 10 < 5 THEN 'middle' WHEN p_size % 10 < 8 THEN 'senior' ELSE 'lead' END AS grade_from_experience
FROM part"""

# ------------------------------------------------------------------- text --
from .. import config as _C  # noqa: E402

_DOC_DICTS = {**_C.ROLE_KEYWORDS, **_C.SOFT_SKILL_KEYWORDS, **_C.DOMAIN_KEYWORDS,
              "hint_english": [" the ", " and "], "hint_german": [" und ", " der "],
              "hint_french": [" le ", " la "], "hint_spanish": [" el ", " los "]}


def _sq(s: str) -> str:
    return s.replace("'", "''")


_DOC_FLAGS = {**_DOC_DICTS}
for _k, _extra in {"role_backend": ["thing"], "role_qa": ["ierch", "lich"], "soft_teamwork": ["blees", " und d"], "domain_finance": ["ciónes", "onre"]}.items():
    _DOC_FLAGS[_k] = [*_DOC_FLAGS[_k], *_extra]
ORACLES["document_keyword_flags"] = "SELECT doc_id, " + ", ".join(
    "(" + " OR ".join(f"contains(lower(coalesce(text, '')), '{_sq(p.lower())}')" for p in pats) + f") AS {flag}"
    for flag, pats in _DOC_FLAGS.items()) + " FROM documents"

# RE2's \b knows ASCII letters alone, so word edges are spelled out.
_EDGE_L, _EDGE_R = r"(?:^|[^\pL\pN_])", r"(?:$|[^\pL\pN_])"


def _label_sql(labels: dict, stopwords: list, name: str) -> str:
    t = "lower(coalesce(text, ''))"
    for s in stopwords:
        t = f"replace({t}, '{s}', '')"

    def spelled(p: str) -> str:
        left, right = p.startswith(r"\b"), p.endswith(r"\b")
        return (_EDGE_L if left else "") + "(?:" + p[2 * left: len(p) - 2 * right] + ")" + (_EDGE_R if right else "")
    cases = " ".join(f"WHEN regexp_matches({t}, '{'|'.join(spelled(p) for p in pats)}') THEN '{g}'" for g, pats in labels.items())
    return f"CASE {cases} ELSE 'unknown' END AS {name}"


_DOC_GRADES = {"intern": [r"\bthing(s|ing)?\b", r"\beauou\b"], "junior": [r"\bund\s+sch\b", r"\bel\s*ción"], "middle": [r"\best[,.]? le\b"],
               "senior": [r"\b(und|oder) der\b"], "lead": [r"\bsa\b", r"\bque\b"]}
ORACLES["document_grade_labels"] = "SELECT doc_id, " + _label_sql(_C.GRADE_KEYWORDS, _C.LEAD_STOPWORDS, "grade") + ", " + \
    _label_sql(_DOC_GRADES, ["que el", "que la"], "language_grade") + " FROM documents"
ORACLES["document_text_stats"] = r"""
SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS description_len_chars,
  CAST(CASE WHEN trim(coalesce(text, '')) = '' THEN 0
       ELSE len(regexp_split_to_array(regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g'), '\s+')) END AS BIGINT)
    AS description_len_words,
  CAST(len(list_filter(string_split(coalesce(text, ''), chr(10)),
       lambda l: regexp_matches(regexp_replace(l, '^\s+', ''), '^[-*•]'))) AS BIGINT) AS description_bullets_count,
  CAST(greatest(len(list_filter(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1),
       lambda i: trim(string_split(coalesce(text, ''), chr(10))[i]) <> '' AND
            (i = 1 OR trim(string_split(coalesce(text, ''), chr(10))[i - 1]) = ''))),
       CASE WHEN coalesce(text, '') <> '' THEN 1 ELSE 0 END) AS BIGINT) AS description_paragraphs_count
FROM (SELECT doc_id, replace(replace(text, '. ', chr(10) || '- '), ', ', ',' || chr(10) || chr(10)) AS text FROM documents)"""
ORACLES["page_links"] = r"""
SELECT page_id, CAST(pos AS INTEGER) AS pos,
  split_part(CASE WHEN starts_with(href, '/') THEN 'https://example.com' || href ELSE href END, '?', 1) AS link
FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]*)"', 1)) AS href,
             generate_subscripts(regexp_extract_all(html, '(?i)<a\s[^>]*href="([^"]*)"', 1), 1) - 1 AS pos
      FROM pages) WHERE href <> ''"""
ORACLES["page_titles"] = r"""
SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title,
       regexp_extract(url, '/(\d+)', 1) AS url_id FROM pages"""

_ELEMENTS = ["nav", "article", "h1", "p", "b", "div", "footer", "title"]
# An element ends where the end tags of some name, counted from its start, are one more than the start tags.
ORACLES["page_element_texts"] = r"""
WITH a AS (SELECT page_id, regexp_extract_all(html, '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<[^>]*>|[^<]+') AS toks FROM pages),
t AS (SELECT page_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i FROM a),
n AS (SELECT *, lower(regexp_extract(tok, '^</?([a-zA-Z][^\s/>]*)', 1)) AS name, starts_with(tok, '</') AS ends FROM t),
s AS (SELECT page_id, name AS wanted, min(i) AS first FROM n WHERE NOT ends AND name IN ('""" + "', '".join(_ELEMENTS) + r"""') GROUP BY ALL),
d AS (SELECT s.*, i, sum(CASE WHEN ends THEN -1 ELSE 1 END) OVER (PARTITION BY s.page_id, wanted, name ORDER BY i) AS depth
      FROM s JOIN n ON n.page_id = s.page_id AND n.i > first WHERE name NOT IN ('', 'script', 'style', 'br', 'meta', 'link', 'img', 'hr', 'input')),
e AS (SELECT page_id, wanted, min(i) AS last FROM d WHERE depth = -1 GROUP BY ALL),
x AS (SELECT s.page_id, wanted, string_agg(trim(replace(replace(replace(replace(replace(replace(replace(tok, '&nbsp;', chr(160)), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
        '&middot;', '·'), '&copy;', '©'), '&amp;', '&'), ' ' || chr(9) || chr(10) || chr(13) || chr(160)), chr(10) ORDER BY i) AS text
      FROM s LEFT JOIN e USING (page_id, wanted) JOIN n ON n.page_id = s.page_id AND n.i > first AND n.i < coalesce(last, 1000000000)
      WHERE NOT starts_with(tok, '<') AND trim(tok, ' ' || chr(9) || chr(10) || chr(13)) <> '' GROUP BY ALL)
SELECT page_id, """ + ", ".join(f"coalesce(max(text) FILTER (WHERE wanted = '{e}'), '') AS {e}" for e in _ELEMENTS) + """
FROM pages LEFT JOIN x USING (page_id) GROUP BY page_id"""


# --------------------------------------------------------------- personas --
# Each persona's filters in the order in which they are given up: first the constraints, then work mode,
# city tier, grade (the final one) and role.
_LADDERS = {
    "gear_junior": ["company = 'Brand#1'", "work_mode = 'remote'", "city_tier = 'EUROPE'", "grade_final = 'junior'", "primary_role = 'gear'"],
    "bolt_switcher": ["grade_final = 'senior'", "primary_role = 'bolt'"],
    "ring_mid": ["work_mode = 'hybrid'", "grade_final = 'middle'", "primary_role = 'ring'"],
    "data_student": ["grade_final = 'junior'", "primary_role = 'gear'"],
    "switcher_bi": ["grade_final = 'junior'", "primary_role = 'bolt'"],
    "mid_data_analyst": ["grade_final = 'middle'", "primary_role = 'gear'"],
    "narrow": ["company = 'Brand#13'", "vacancy_id = 7", "work_mode = 'hybrid'", "city_tier = 'ASIA'", "grade_final = 'lead'", "primary_role = 'gear'"],
    "absent": ["work_mode = 'field'", "city_tier = 'ASIA'", "grade_final = 'architect'", "primary_role = 'gear'"],
    "either": ["city_tier IN ('ASIA', 'EUROPE')", "is_hybrid", "grade_final = 'junior'", "primary_role = 'bolt'"],
}


def _persona_sql_parts(persona, thr=80):
    filters = _LADDERS[persona if isinstance(persona, str) else persona.name]
    conds = ["coalesce(" + " AND ".join(filters[i:]) + ", false)" if filters[i:] else "true" for i in range(len(filters) + 1)]
    counts = ", ".join(f"count(*) FILTER (WHERE {c}) AS n{i}" for i, c in enumerate(conds))
    pick = ("CASE WHEN total < {t} OR n0 >= {t} THEN 0 ".format(t=thr)
            + " ".join(f"WHEN n{i} >= {thr} THEN {i}" for i in range(1, len(conds)))
            + f" ELSE {len(conds) - 1} END")
    seg = " OR ".join(f"(lvl = {i} AND {c})" for i, c in enumerate(conds))
    return counts, pick, seg


def _personas():
    from .catalog import binding_personas
    return binding_personas()


PERSONA_SKILLS = SKILLS


def persona_gap_sql(persona, min_share=0.1, top_n=20, tag=False, round_share=True):
    counts, pick, seg = _persona_sql_parts(persona)
    has = ", ".join(f"'{s}'" for s in persona.current_skills) or "NULL"
    pname = f"'{persona.name}' AS persona, " if tag else ""
    return f"""(WITH lv AS (SELECT count(*) AS total, {counts} FROM v),
pick AS (SELECT {pick} AS lvl FROM lv),
seg AS (SELECT v.* FROM v, pick WHERE {seg}),
w AS (SELECT {', '.join(f"avg(CAST(coalesce({c}, false) AS INTEGER)) AS {c}" for c in PERSONA_SKILLS)} FROM seg),
u AS (SELECT skill, share FROM w UNPIVOT INCLUDE NULLS (share FOR skill IN ({', '.join(PERSONA_SKILLS)})))
SELECT {pname}skill AS skill_name, {'round(share, 6)' if round_share else 'share'} AS market_share, skill IN ({has}) AS persona_has,
       (NOT skill IN ({has})) AND share >= {min_share} AS gap
FROM u WHERE share >= {min_share}
ORDER BY gap DESC, share DESC, skill LIMIT {top_n})"""


ORACLES["persona_skill_gap"] = V + "SELECT * FROM " + persona_gap_sql(_personas()[0])
_p0_counts, _p0_pick, _p0_seg = _persona_sql_parts("gear_junior")
ORACLES["persona_market_summary"] = V + f"""
, lv AS (SELECT count(*) AS total, {_p0_counts} FROM v), pick AS (SELECT {_p0_pick} AS lvl FROM lv),
seg AS (SELECT v.* FROM v, pick WHERE {_p0_seg})
SELECT count(*) AS vacancy_count, {share('is_remote')} AS remote_share, {share('is_junior_friendly')} AS junior_friendly_share,
       {r(f'quantile_cont({M}, 0.5)')} AS salary_median, {r(f'quantile_cont({M}, 0.25)')} AS salary_q25,
       {r(f'quantile_cont({M}, 0.75)')} AS salary_q75 FROM seg"""
ORACLES["persona_batch_gaps"] = V + " UNION ALL ".join(
    "SELECT * FROM " + persona_gap_sql(p, tag=True) for p in _personas())

_PRESET_SKILLS = {"skill_red": "skill_sql", "skill_blue": "skill_excel", "skill_small": "skill_powerbi", "has_tax": "has_python"}


def _preset_sql(name: str, own: list[str]) -> str:
    counts, pick, seg = _persona_sql_parts(name)
    skills = [(c, _PRESET_SKILLS.get(c, c)) for c in PERSONA_SKILLS]
    has = ", ".join(f"'{s}'" for s in own)
    return f"""SELECT * FROM (WITH lv AS (SELECT count(*) AS total, {counts} FROM v), pick AS (SELECT {pick} AS lvl FROM lv),
seg AS (SELECT v.* FROM v, pick WHERE {seg}),
u AS ({' UNION ALL '.join(f"SELECT '{new}' AS skill_name, avg(CAST(coalesce({old}, false) AS INTEGER)) AS share FROM seg" for old, new in skills)})
SELECT '{name}' AS persona, skill_name, round(share, 6) AS market_share, skill_name IN ({has}) AS persona_has, NOT skill_name IN ({has}) AS gap
FROM u WHERE share >= 0.1 ORDER BY gap DESC, share DESC, skill_name LIMIT 20)"""


ORACLES["persona_presets"] = V + " UNION ALL ".join([
    _preset_sql("data_student", ["skill_sql", "skill_excel", "has_python"]), _preset_sql("switcher_bi", ["skill_excel", "skill_powerbi"]),
    _preset_sql("mid_data_analyst", ["skill_sql", "skill_excel", "skill_powerbi"])])


def _level_sql(name: str) -> str:
    counts, pick, _ = _persona_sql_parts(name)
    filters = _LADDERS[name]
    names = "[" + ", ".join("'" + f.split(" ")[0] + "'" for f in filters) + "]"
    n = "CASE lvl " + " ".join(f"WHEN {i} THEN n{i}" for i in range(len(filters) + 1)) + " END"
    return f"""SELECT '{name}' AS persona, lvl::INTEGER AS level, array_to_string({names}[:lvl], ',') AS relaxed, {n} AS market_n
FROM (SELECT *, {pick} AS lvl FROM (SELECT count(*) AS total, {counts} FROM v) AS a) AS b"""


ORACLES["persona_levels"] = V + " UNION ALL ".join(_level_sql(n) for n in (
    "data_student", "switcher_bi", "mid_data_analyst", "narrow", "absent", "either"))

# ---------------------------------------------------------------- quality --
ORDERS_RAW = """WITH r AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
   CASE WHEN o_orderpriority = '1-URGENT' THEN 'Yes' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'n/a'
        ELSE 'no' END AS is_urgent,
   CASE WHEN o_orderstatus = 'O' THEN 'junior' WHEN o_orderstatus = 'F' THEN ' - ' END AS grade,
   CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 5 END AS rush_count,
   CASE WHEN o_orderkey % 50 = 0 THEN 'vip' END AS note,
   CASE WHEN o_orderkey % 3 = 0 THEN 'true' WHEN o_orderkey % 3 = 1 THEN 'FALSE' ELSE 'maybe' END AS has_gift
 FROM orders)
"""
_RAW_COLS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
             ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"), ("is_urgent", "string"),
             ("grade", "string"), ("rush_count", "bigint"), ("note", "string"), ("has_gift", "string")]
ORACLES["orders_missing_share"] = ORDERS_RAW + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg(CAST({c} IS NULL AS DOUBLE)), 6) AS share FROM r" for c, _ in _RAW_COLS) + \
    ") ORDER BY share DESC, \"column\" LIMIT 20"


def _health_row(c: str, t: str) -> str:
    from .. import config as C
    base = C.KEY_COLUMN_COMMENTS.get(c)
    mk = f"avg(CAST(coalesce(lower(trim({c})) IN {_MK}, false) AS DOUBLE))" if t == "string" else "0.0"
    nan = f"avg(CAST({c} IS NULL AS DOUBLE))"
    base_sql = f"'{_sq(base)}'" if base else "NULL"
    return f"""SELECT '{c}' AS "column", '{t}' AS dtype, round({nan}, 6) AS share_nan, round({mk}, 6) AS share_unknown_marker,
  coalesce(nullif(concat_ws('; ', {base_sql},
    CASE WHEN {nan} > 0 THEN 'NaN ' || printf('%.1f', {nan} * 100) || '%' END,
    CASE WHEN {mk} > 0 THEN 'text marker ' || printf('%.1f', {mk} * 100) || '%' END), ''), 'clean') AS comment FROM r"""


ORACLES["orders_data_health"] = ORDERS_RAW + " UNION ALL ".join(_health_row(c, t) for c, t in _RAW_COLS)
ORACLES["customer_key_uniqueness"] = """
SELECT (count(*) - count(DISTINCT o_custkey) - max(CAST(o_custkey IS NULL AS BIGINT))) = 0 AS is_unique,
       CAST(count(*) - count(DISTINCT o_custkey) - max(CAST(o_custkey IS NULL AS BIGINT)) AS BIGINT) AS duplicate_count
FROM orders"""
ORACLES["lineitem_duplicate_rows"] = """
SELECT CAST(sum(c) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(c) - count(*) AS BIGINT) AS duplicate_rows
FROM (SELECT *, count(*) AS c FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1) GROUP BY ALL)"""
ORACLES["lineitem_describe"] = " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std,
  {r(f'min({c})')} AS min, {r(f'quantile_cont({c}, 0.25)')} AS q25, {r(f'quantile_cont({c}, 0.5)')} AS median,
  {r(f'quantile_cont({c}, 0.75)')} AS q75, {r(f'max({c})')} AS max FROM lineitem"""
                                                  for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


_MARKET_KEYS = "primary_role, grade, city_tier, domain"
ORACLES["stage_summary"] = V + ", raw0 AS (" + __import__("hiresight.plans.binding", fromlist=["x"]).VACANCY_RAW_SQL + f"""),
m AS (SELECT {_MARKET_KEYS}, count({M}) AS vacancy_count, avg(CAST(coalesce(is_remote, false) AS DOUBLE)) AS remote_share FROM v
      WHERE primary_role IS NOT NULL AND grade IS NOT NULL AND city_tier IS NOT NULL AND domain IS NOT NULL GROUP BY ALL)
SELECT 'raw' AS stage, count(*) AS rows, (SELECT count(*) FROM (DESCRIBE raw0))::INTEGER AS columns, {r('avg(CAST(salary_mid IS NOT NULL AS DOUBLE))')} AS salary_share,
  {r("avg(CAST(currency IS DISTINCT FROM 'RUB' AS DOUBLE))")} AS non_rub_share, {share('is_remote')} AS remote_share, NULL::DOUBLE AS unknown_share FROM raw0
UNION ALL
SELECT 'features', count(*), (SELECT count(*) FROM (DESCRIBE v))::INTEGER, {r(f'avg(CAST({M} IS NOT NULL OR salary_mid IS NOT NULL AS DOUBLE))')},
  {r("avg(CAST(currency IS DISTINCT FROM 'RUB' AS DOUBLE))")}, {r("avg(CAST(work_mode IN ('remote', 'hybrid') AS DOUBLE))")},
  {r("avg(CAST(work_mode = 'unknown' AS DOUBLE))")} FROM v
UNION ALL
SELECT 'market', count(*), 12, NULL, NULL, {r('sum(remote_share * vacancy_count) / sum(vacancy_count)')}, NULL FROM m"""
ORACLES["clean_validation"] = V + """
SELECT count(*) AS rows, CAST(sum(""" + " + ".join(
    f"CAST(coalesce(lower(trim({c})) IN ('unknown', 'не указано', 'неизвестно', '', 'n/a', 'nan', '-', '—'), false) AS BIGINT)"
    for c in ["title", "company", "city", "city_tier", "currency", "grade", "work_mode", "grade_from_experience",
              "grade_final", "primary_role", "domain"]) + """) AS BIGINT) AS markers_left,
  count(*) FILTER (WHERE exp_max_years > 2 AND published_at_iso IS NOT NULL) > 0 AS age_present, 1 AS dropped_left, """ + r("avg(CAST(coalesce(currency, '') <> 'RUB' AS DOUBLE))") + """ AS non_rub_share,
  CAST(count(*) - count(DISTINCT vacancy_id) AS BIGINT) AS duplicate_ids, true AS booleans_ok FROM v"""

# ----------------------------------------------------------------- charts --
ORACLES["grade_box_stats"] = V + f"""
, q AS (SELECT grade, quantile_cont({M}, 0.25) AS q1, quantile_cont({M}, 0.5) AS median, quantile_cont({M}, 0.75) AS q3
        FROM v WHERE grade IS NOT NULL GROUP BY 1)
SELECT q.grade, round(q.q1, 6) AS q1, round(q.median, 6) AS median, round(q.q3, 6) AS q3,
  round(min({M}) FILTER (WHERE {M} BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1)), 6) AS whisker_low,
  round(max({M}) FILTER (WHERE {M} BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1)), 6) AS whisker_high,
  count(*) FILTER (WHERE NOT ({M} BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1))) AS outliers,
  count(*) AS n
FROM v JOIN q USING (grade) WHERE {M} IS NOT NULL GROUP BY q.grade, q.q1, q.median, q.q3"""
ORACLES["city_work_mode_shares"] = V + """
SELECT city_tier, work_mode, round(n / sum(n) OVER (PARTITION BY city_tier), 6) AS share
FROM (SELECT city_tier, work_mode, count(*) AS n FROM v WHERE city_tier IS NOT NULL AND work_mode IS NOT NULL GROUP BY ALL)"""
ORACLES["top_skills_for_role"] = V + f"""
, sub AS (SELECT * FROM v WHERE coalesce(contains(lower(primary_role), 'g'), false))
SELECT skill, count, round(count / (SELECT count(*) FROM sub), 6) AS share FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS skill, CAST(sum(CAST(coalesce({c}, false) AS INTEGER)) AS BIGINT) AS count FROM sub" for c in SKILLS) + \
    ") ORDER BY count DESC, skill LIMIT 15"
ORACLES["skill_heatmap_by_grade"] = V + f"""
, m AS (SELECT skill, share AS m FROM (SELECT {', '.join(f"avg(CAST({c} AS INTEGER)) AS {c}" for c in SKILLS)} FROM v)
        UNPIVOT INCLUDE NULLS (share FOR skill IN ({', '.join(SKILLS)})) ORDER BY m DESC NULLS LAST, skill LIMIT 5),
w AS (SELECT grade, {', '.join(f"avg(CAST({c} AS INTEGER)) AS {c}" for c in SKILLS)} FROM v WHERE grade IS NOT NULL GROUP BY 1),
u AS (SELECT grade, skill, share FROM w UNPIVOT INCLUDE NULLS (share FOR skill IN ({', '.join(SKILLS)})))
SELECT grade, skill, round(coalesce(share, 0.0), 6) AS share FROM u WHERE skill IN (SELECT skill FROM m)"""
ORACLES["benefit_employer_heatmap"] = V + f"""
, w AS (SELECT company, {', '.join(f"avg(CAST(coalesce({c}, false) AS INTEGER)) AS {c}" for c in BENEFITS)}
        FROM v WHERE company IN {top_sql('v', 'company', 10)} GROUP BY 1),
u AS (SELECT company, flag, share FROM w UNPIVOT INCLUDE NULLS (share FOR flag IN ({', '.join(BENEFITS)}))),
rk AS (SELECT flag FROM u GROUP BY flag ORDER BY avg(share) DESC, flag LIMIT 2)
SELECT company, flag, round(share, 6) AS share FROM u WHERE flag IN (SELECT flag FROM rk)"""
ORACLES["grade_mean_and_count"] = V + f"""
SELECT * FROM ({summary_sql('v', ['grade'], M, ['median', 'mean', 'count'])}) ORDER BY count DESC, grade LIMIT 10"""
ORACLES["stack_bucket_chart"] = V + f"""
, b AS (SELECT *, CASE WHEN coalesce(tech_stack_size, 0) <= 2.5 THEN '0-2' WHEN coalesce(tech_stack_size, 0) <= 5.5 THEN '3-5'
                       WHEN coalesce(tech_stack_size, 0) <= 10.5 THEN '6-10' ELSE '10+' END AS stack_bucket FROM v)
SELECT * FROM ({summary_sql('b', ['stack_bucket'], M, ['median', 'mean', 'count'])}) ORDER BY count DESC, stack_bucket LIMIT 10"""
ORACLES["price_histogram"] = """
WITH t AS (SELECT CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem WHERE l_extendedprice IS NOT NULL),
rg AS (SELECT min(x) AS lo, max(x) AS hi FROM t)
SELECT CAST(CASE WHEN hi - lo = 0 THEN 0 ELSE least(floor((x - lo) / (hi - lo) * 30), 29) END AS INTEGER) AS bin,
       count(*) AS count, round(min(lo), 6) AS range_min, round(max(hi), 6) AS range_max
FROM t, rg GROUP BY 1"""


def _humanize_sql(c: str) -> str:
    return (f"array_to_string(list_transform(string_split(regexp_replace({c}, '^(skill_|has_)', ''), '_'), "
            "lambda w: CASE lower(w) WHEN 'sql' THEN 'SQL' WHEN 'python' THEN 'Python' WHEN 'excel' THEN 'Excel' "
            "WHEN 'powerbi' THEN 'Power BI' WHEN 'ml' THEN 'ML' WHEN 'ai' THEN 'AI' WHEN 'qa' THEN 'QA' "
            "ELSE CASE WHEN length(w) > 3 THEN upper(w[1]) || lower(w[2:]) ELSE upper(w) END END), ' ')")


ORACLES["persona_gap_chart"] = V + f"""
SELECT {_humanize_sql('skill_name')} AS label, skill_name, round(market_share * 100, 6) AS share_pct
FROM {persona_gap_sql(_personas()[2], min_share=0.05, round_share=False)} WHERE gap"""

ORACLES["events_stream_latest"] = ORACLES["events_latest_per_user"]
ORACLES["events_stream_first_seen"] = "SELECT DISTINCT user_id, 1::BIGINT AS first_rows FROM events"

ORACLES["document_salary_text"] = r"""
WITH w AS (SELECT doc_id, replace(replace(replace(replace(text, ' the ', ' до вычета '), ' und ', ' на руки '), ' of ', ' от '), ' la ', ' до ') AS text FROM documents),
t AS (SELECT doc_id, replace(replace(coalesce(text, ''), chr(160), ' '), chr(8239), ' ') AS c FROM w),
n AS (SELECT doc_id, c, list_transform(regexp_extract_all(c, '\d[\d ]*'),
                                       lambda s: TRY_CAST(regexp_replace(s, '\D', '', 'g') AS BIGINT)) AS nums FROM t)
SELECT doc_id,
  CASE WHEN len(nums) = 0 THEN NULL
       WHEN contains(c, 'от') AND contains(c, 'до') AND len(nums) >= 2 THEN nums[1]
       WHEN contains(c, 'от') THEN nums[1] WHEN contains(c, 'до') THEN NULL
       WHEN len(nums) = 2 THEN nums[1] WHEN len(nums) = 1 THEN nums[1] END AS salary_from,
  CASE WHEN len(nums) = 0 THEN NULL
       WHEN contains(c, 'от') AND contains(c, 'до') AND len(nums) >= 2 THEN nums[2]
       WHEN contains(c, 'от') THEN NULL WHEN contains(c, 'до') THEN nums[1]
       WHEN len(nums) = 2 THEN nums[2] END AS salary_to,
  CASE WHEN contains(c, 'руб') THEN 'RUB' WHEN contains(c, '₽') THEN 'RUB' WHEN contains(c, 'USD') THEN 'USD'
       WHEN contains(c, 'EUR') THEN 'EUR' WHEN contains(c, '$') THEN 'USD' WHEN contains(c, '€') THEN 'EUR'
       WHEN contains(c, 'KZT') THEN 'KZT' END AS currency,
  CASE WHEN contains(lower(c), 'на руки') THEN false WHEN contains(lower(c), 'до вычета') THEN true END AS salary_gross
FROM n"""

ORACLES["employer_enrichment"] = """
SELECT l_orderkey, l_linenumber, l_suppkey AS employer_url, round(s_acctbal / 2000, 2) AS employer_rating,
  s_suppkey AS employer_reviews_count, coalesce(s_nationkey < 10, false) AS employer_has_remote,
  coalesce(s_nationkey > 5 AND s_acctbal > 5000, false) AS employer_has_education,
  CASE WHEN s_nationkey % 2 = 0 THEN 'direct' WHEN s_nationkey % 3 = 0 THEN 'agency' END AS employer_type
FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey"""
ORACLES["document_skill_counts"] = """
WITH t AS (SELECT doc_id, lower(coalesce(text, '')) AS x FROM documents),
f AS (SELECT doc_id, x, contains(x, 'thing') AS q, contains(x, 'blees') AS e, contains(x, 'ciónes') AS b, contains(x, 'lich') AS ta,
        contains(x, ' r ') AS r, contains(x, 'eauou') AS sa, contains(x, 'hein') AS py, contains(x, 'eren') AS ta2, contains(x, 'ungen') AS sk,
        contains(x, 'leoi') AS pt, contains(x, 'mente') AS tf, contains(x, 'wher') AS sp, contains(x, 'sterea') AS ka FROM t)
SELECT doc_id, (q::BIGINT + e::BIGINT + (b OR ta)::BIGINT + (py OR r)::BIGINT) AS core_data_skills_count,
  (sk::BIGINT + pt::BIGINT + tf::BIGINT + sp::BIGINT + ka::BIGINT + (ta2 OR sa)::BIGINT) AS ml_stack_count,
  (q::BIGINT + e::BIGINT + b::BIGINT + ta::BIGINT + r::BIGINT + sa::BIGINT + py::BIGINT + ta2::BIGINT + sk::BIGINT + pt::BIGINT + tf::BIGINT
   + sp::BIGINT + ka::BIGINT) AS tech_stack_size,
  ((q AND contains(x, 'sql'))::BIGINT + (e AND contains(x, 'excel'))::BIGINT + (b AND contains(x, 'powerbi'))::BIGINT
   + (ta AND contains(x, 'tableau'))::BIGINT + (r AND contains(x, 'r'))::BIGINT + (sa AND contains(x, 'airflow'))::BIGINT
   + (py AND contains(x, 'python'))::BIGINT + (ta2 AND contains(x, 'airflow'))::BIGINT + (sk AND contains(x, 'sklearn'))::BIGINT
   + (pt AND contains(x, 'pytorch'))::BIGINT + (tf AND contains(x, 'tensorflow'))::BIGINT + (sp AND contains(x, 'spark'))::BIGINT
   + (ka AND contains(x, 'kafka'))::BIGINT) AS hits
FROM f"""

# ------------------------------------------------- frequencies, cells, fills --
_BY_COUNT = {"color": ["red", "blue"], "temperature": ["hot", "cold"], "size": ["small", "large"], "age": ["old", "new"]}
ORACLES["salary_by_frequent_domain"] = V + """
, f AS (SELECT name, row_number() OVER (ORDER BY n DESC, name) AS place FROM (""" + " UNION ALL ".join(
    f"SELECT '{d}' AS name, count(*) FILTER (WHERE domain_{d}) AS n FROM v" for d in _BY_COUNT) + """)),
w AS (SELECT v.* EXCLUDE (domain), coalesce((SELECT arg_min(name, place) FROM f WHERE CASE name """ + " ".join(
    f"WHEN '{d}' THEN v.domain_{d}" for d in _BY_COUNT) + """ END), 'unknown') AS dom FROM v)
""" + requirement_sql("w", "dom", "domain", M)
ORACLES["salary_by_english_level"] = ORDERS_REQ + summary_sql("o", ["lang_english_level"], "o_totalprice", ["n", "median", "mean", "std"])
ORACLES["english_stats_filled"] = ORDERS_REQ + """, filled AS (SELECT * REPLACE (coalesce(CASE WHEN o_orderkey % 3 > 0 THEN lang_english_required END, false) AS lang_english_required) FROM o)
""" + requirement_sql("filled", _ENG_MAP, "english_level", "o_totalprice")
ORACLES["soft_employer_heatmap"] = V + f"""
, w AS (SELECT company, {', '.join(f"avg(CAST(coalesce({c}, false) AS INTEGER)) AS {c}" for c in SOFT)}
        FROM v WHERE company IN {top_sql('v', 'company', 10)} GROUP BY 1),
u AS (SELECT company, flag, share FROM w UNPIVOT INCLUDE NULLS (share FOR flag IN ({', '.join(SOFT)}))),
rk AS (SELECT flag FROM u GROUP BY flag ORDER BY avg(share) DESC, flag LIMIT 2)
SELECT company, flag, round(share, 6) AS share FROM u WHERE flag IN (SELECT flag FROM rk)"""
ORACLES["salary_cells"] = V + f"""
, q AS (SELECT n_nationkey, ['intern', 'senior', NULL, 'architect', 'lead'][n_nationkey % 5 + 1] AS grade,
          CASE WHEN n_nationkey % 7 > 0 THEN r_name ELSE 'NOWHERE' END AS city_tier FROM nation JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT grade, city_tier, count({M}) AS count, {r(f'quantile_cont({M}, 0.5)')} AS median FROM v GROUP BY ALL)
SELECT q.*, count, median FROM q LEFT JOIN c USING (grade, city_tier)"""

# ------------------------------------------------------ profile, stacks, matrix --
_RAW_TYPES = {t: sum(x == t for _, x in _RAW_COLS) for t in dict(_RAW_COLS).values()}
ORACLES["orders_profile"] = ORDERS_RAW + "SELECT 'shape' AS section, 'rows' AS name, count(*)::DOUBLE AS value FROM r UNION ALL " + \
    f"SELECT 'shape', 'columns', {len(_RAW_COLS)} UNION ALL " + " UNION ALL ".join(f"SELECT 'type', '{t}', {n}" for t, n in _RAW_TYPES.items()) + \
    " UNION ALL SELECT * FROM (SELECT 'missing', name, round(value, 6) FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS name, avg(CAST({c} IS NULL AS DOUBLE)) AS value FROM r" for c, _ in _RAW_COLS) + ") AS q ORDER BY value DESC, name LIMIT 5) AS p"
ORACLES["stack_counts"] = V + """
SELECT vacancy_id, (skill_red::INT + skill_blue::INT + skill_small::INT + has_tax::INT) AS core_data_skills_count, (has_bulk::INT + has_discount::INT) AS ml_stack_count,
  (""" + " + ".join(f"coalesce({c}, false)::INT" for c in ["has_mentoring", "has_test_task", *SKILLS]) + """) AS tech_stack_size FROM v"""
ORACLES["role_work_mode_matrix"] = V + f"""
SELECT primary_role, """ + ", ".join(f"{r(f'quantile_cont({M}, 0.5) FILTER (WHERE work_mode = {chr(39)}{m}{chr(39)})')} AS {m}" for m in ("remote", "hybrid", "unknown")) + """
FROM v WHERE primary_role IS NOT NULL GROUP BY 1"""
