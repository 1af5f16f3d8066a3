"""Branch and quirk cases (one per decision) for the column operators."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from hiresight.functions import text as TX
from hiresight.operators import charts, cleaning, features, personas, quantiles, segments


def test_grade_from_experience(spark):
    df = spark.createDataFrame([(0.0, False, None), (1.0, False, None), (2.9, False, None), (3.0, False, None),
                                (5.0, False, None), (8.0, False, None), (None, True, None), (None, False, "1–3 года"),
                                (None, False, None)], "exp_min_years double, exp_is_no_experience boolean, experience string")
    out = [r.grade_from_experience for r in features.add_grade_from_experience(df).collect()]
    assert out == ["intern", "junior", "junior", "middle", "senior", "lead", "intern", "junior", "unknown"]


def test_work_mode_and_grade_final(spark):
    df = spark.createDataFrame([("office", True, False, "unknown", "junior"), (None, True, True, "senior", "junior"),
                                (None, False, True, None, "junior"), ("unknown", False, False, "unknown", "junior")],
                               "work_format string, is_remote boolean, is_hybrid boolean, grade string, "
                               "grade_from_experience string")
    rows = features.add_grade_final(features.add_work_mode(df)).collect()
    assert [r.work_mode for r in rows] == ["office", "remote", "hybrid", "unknown"]
    assert [r.grade_final for r in rows] == ["junior", "senior", None, "junior"]


def test_buckets(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1.0,), (3.0,), (6.0,), (7.0,)], "y double")
    assert [r.b for r in df.select(segments.experience_bucket(F.col("y")).alias("b")).collect()] == \
        ["0-1", "0-1", "0-1", "1-3", "3-6", "6+"]
    s = spark.createDataFrame([(0,), (3,), (10,), (100,)], "s int")
    assert [r.b for r in s.select(segments.stack_bucket(F.col("s")).alias("b")).collect()] == ["0-3", "3-6", ">=10", None]


def test_salary_bucket_tertiles(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 7)], "m double")
    out = features.add_salary_bucket(df, "m").orderBy("m").collect()
    assert [r.salary_bucket for r in out] == ["low", "low", "mid", "mid", "high", "high"]


def test_english_and_education_levels(spark):
    df = spark.createDataFrame([("B2", None), ("native", True), ("b1", False), (None, True), ("xx", True)],
                               "lvl string, req boolean")
    assert [r.e for r in df.select(segments.english_level_expr(F.col("lvl"), F.col("req")).alias("e")).collect()] == \
        ["B2", "C1_plus", "no_english", "no_english", "no_english"]
    ed = spark.createDataFrame([("master_or_higher", False, True), (None, False, True), ("any_he", False, False),
                                (None, False, False)], "lvl string, req boolean, tech boolean")
    assert [r.e for r in ed.select(segments.education_level_expr(F.col("lvl"), F.col("req"), F.col("tech")).alias("e"))
            .collect()] == ["master_phd", "technical_only", "any_degree", "no_degree_required"]


def test_salary_text(spark):
    df = spark.createDataFrame([("от 100 000 до 200 000 ₽ на руки",), ("до 3 000 $",), ("150000 руб. до вычета",)], "t string")
    rows = df.select(TX.parse_salary(F.col("t")).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in rows] == [(100000, 200000, "RUB", False), (None, 3000, "USD", None),
                                        (None, 150000, "RUB", True)]
    fixed = df.select(TX.parse_salary(F.col("t"), strip_tax_phrase=True).alias("s")).select("s.*").collect()
    assert tuple(fixed[2]) == (150000, None, "RUB", True)
    sf = spark.createDataFrame([(100, 200), (100, None), (None, None)], "a bigint, b bigint")
    feats = sf.select(TX.salary_features(F.col("a"), F.col("b")).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in feats] == [(150.0, 100, False), (100.0, 0, True), (None, None, False)]


def test_experience_text_and_grade_text(spark):
    df = spark.createDataFrame([("не требуется",), ("1–3 года",), ("более 6 лет",), ("?",)], "t string")
    rows = df.select(TX.experience_range(F.col("t")).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in rows] == [(0, 0, True), (1, 3, False), (6, None, False), (None, None, False)]
    g = spark.createDataFrame([("Senior Python",), ("ведущий инженер",), ("lead generation",)], "t string")
    assert [r.g for r in g.select(TX.first_regex_label(F.col("t")).alias("g")).collect()] == ["senior", "lead", "unknown"]


def test_published_date(spark):
    now = dt.datetime(2025, 11, 30, 12, 0, 0)
    df = spark.createDataFrame([("сегодня",), ("вчера",), ("3 дня назад",), ("26.11.2025",), ("26 ноября 2025",), ("",)],
                               "t string")
    rows = df.select(TX.published_date(F.col("t"), F.lit(now)).alias("s")).select("s.*").collect()
    d = dt.date
    assert [tuple(r) for r in rows] == [(d(2025, 11, 30), 0), (d(2025, 11, 29), 1), (d(2025, 11, 27), 3),
                                        (d(2025, 11, 26), 4), (d(2025, 11, 26), 4), (None, None)]


def test_text_stats_and_sections(spark):
    text = "Обязанности:\n- писать код\n* ревью\n\nТребования:\n- SQL\n- Python\nУсловия:\nофис"
    df = spark.createDataFrame([(text,), ("",)], "t string")
    st = df.select(TX.description_stats(F.col("t")).alias("s")).select("s.*").collect()
    assert st[0].description_bullets_count == 4 and st[0].description_paragraphs_count == 2
    assert tuple(st[1]) == (0, 0, 0, 0)
    sec = df.select(TX.split_sections(F.col("t")).alias("s")).select("s.*").first()
    assert sec.duties == "- писать код\n* ревью\n" and sec.requirements == "- SQL\n- Python\n"
    assert sec.conditions == "офис\n"


def test_dedup_keeps_latest(spark):
    t1, t2, t3 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 3)
    df = spark.createDataFrame([(1, t1, "a"), (1, t2, "b"), (2, t3, "c"), (None, None, "d"), (None, t1, "e")],
                               "vacancy_id bigint, scraped_at_utc timestamp, v string")
    out = sorted(tuple(r) for r in cleaning.deduplicate(df).collect() if r.vacancy_id is not None)
    assert out == [(1, t2, "b"), (2, t3, "c")]
    assert cleaning.deduplicate(df).count() == 3


def test_salary_prepare(spark):
    df = spark.createDataFrame([("RUB", 100.0), ("USD", 200.0), ("RUB", None)], "currency string, salary_mid double")
    rows = cleaning.salary_prepare(df).collect()
    assert [r.salary_mid_rub for r in rows] == [100.0, None, None]
    assert [r.salary_known for r in rows] == [True, False, False]
    assert abs(df.agg(cleaning.non_currency_share(df)).first()[0] - 1 / 3) < 1e-12


def test_zero_variance_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 1.0)], "a double, b double")
    res = {(r.col_a, r.col_b): r.corr for r in segments.correlation_matrix(df, ["a", "b"]).collect()}
    assert res[("a", "b")] is None and abs(res[("a", "a")] - 1.0) < 1e-12


def test_quantiles_match_pandas_on_skewed_groups(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    rows = [("hot", float(x)) for x in rng.normal(size=3000)] + [("cold", float(x)) for x in rng.normal(size=7)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.q25, r.q50) for r in quantiles.grouped_quantiles(df, "v", [0.25, 0.5], ["k"], ["q25", "q50"]).collect()}
    for k in ("hot", "cold"):
        vals = np.array([v for kk, v in rows if kk == k])
        assert abs(got[k][0] - np.quantile(vals, 0.25)) < 1e-9 and abs(got[k][1] - np.quantile(vals, 0.5)) < 1e-9


def test_relaxation_one_pass(spark):
    rows = [("data", "junior" if i < 10 else "senior", "Moscow" if i < 5 else "SPb") for i in range(100)]
    df = spark.createDataFrame(rows, "primary_role string, grade string, city_tier string")
    p = personas.Persona("p", "", [], "data", "junior", "Moscow")
    res = personas.filter_by_target(df, p, 80)
    assert res.relaxed_filters == ["city_tier", "grade"] and res.sample_size == 100
    assert any("relaxed" in w for w in res.warnings)


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x double")
    h = {r.bin: r["count"] for r in charts.histogram(df, "x", 10).collect()}
    assert h == {0: 1, 5: 1, 9: 1}


def test_humanize_and_top_skills_text(spark):
    df = spark.createDataFrame([("skill_sql",), ("has_python",), ("skill_ab_testing",)], "n string")
    assert [r.h for r in df.select(TX.humanize_flag(F.col("n")).alias("h")).collect()] == ["SQL", "Python", "AB Testing"]
    from hiresight.operators.market import top_skills_text
    one = spark.range(1).select(top_skills_text([("skill_sql", F.lit(0.8)), ("has_python", F.lit(0.125)),
                                                  ("skill_r", F.lit(0.0))]).alias("t")).first().t
    assert one == "sql (80%), python (12%)"


def test_raw_csv_multiline_and_schema(spark, tmp_path):
    from hiresight.sources.raw import load_raw, raw_schema
    assert len(raw_schema().fields) == 151
    p = tmp_path / "raw.csv"
    p.write_text('vacancy_id,title,description,salary_from,salary_gross\n'
                 '1,A,"line one\nline ""two""",100000,yes\n2,B,plain,abc,unknown\n', encoding="utf-8")
    df = load_raw(spark, str(p))
    rows = df.select("vacancy_id", "description", "salary_from", "salary_gross").orderBy("vacancy_id").collect()
    assert len(rows) == 2
    assert rows[0].description == 'line one\nline "two"' and rows[0].salary_from == 100000 and rows[0].salary_gross is True
    assert rows[1].salary_from is None and rows[1].salary_gross is None


def test_stage_chain_end_to_end(spark, tmp_path):
    from hiresight.plans.stages import run_stages
    rows = []
    for i in range(40):
        rows.append((str(i % 30), f"Junior Python developer {i}", "Acme" if i % 2 else "Beta", "RUB" if i % 5 else "USD",
                     float(100000 + 1000 * i), "Москва" if i % 3 else "Казань", "true" if i % 4 == 0 else "false",
                     "yes" if i % 7 == 0 else "no", "2025-11-2%dT10:00:00+03:00" % (i % 9),
                     "2025-11-30T12:00:00+00:00", "junior" if i % 2 else "unknown", "Не указано"))
    raw = spark.createDataFrame(rows, "vacancy_id string, title string, company string, currency string, salary_mid double, "
                                      "city string, has_python string, skill_sql string, published_at_iso string, "
                                      "scraped_at_utc string, grade string, schedule string")
    res = run_stages(raw, str(tmp_path / "out"))
    assert res.clean.count() == 30
    assert "schedule" not in res.clean.columns  # all markers → NULL → dropped
    f = res.features.select("city_tier", "grade_final", "tech_stack_size", "salary_bucket").collect()
    assert {r.city_tier for r in f} == {"Moscow", "Million+"}
    mv = res.market.collect()
    assert sum(r.vacancy_count for r in mv) == res.clean.where("salary_mid_rub_capped is not null").count()
    assert all(isinstance(r.top_skills, str) for r in mv)


def test_page_to_vacancy_row(spark):
    from hiresight.sources.pages import employer_rows, vacancy_rows
    html = ('<html><body><h1 data-qa="vacancy-title">Senior Python разработчик</h1>'
            '<div data-qa="vacancy-salary">от 200 000 до 300 000 ₽ на руки</div>'
            '<a data-qa="vacancy-company-name" href="/employer/1">Acme</a>'
            '<span data-qa="vacancy-view-raw-address">Москва, м. Арбатская, район Арбат</span>'
            '<span data-qa="vacancy-experience">3–6 лет</span><p>Полная занятость</p>'
            '<div data-qa="vacancy-description"><p>Требования:</p><ul><li>Python</li></ul></div>'
            '<p>Код вакансии 12345-a</p></body></html>')
    none = '<html><body><h1 data-qa="vacancy-title">No salary</h1></body></html>'
    pages = spark.createDataFrame([("https://x/vacancy/777?from=s", html), ("https://x/vacancy/1", none)],
                                  "url string, html string")
    rows = vacancy_rows(pages).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.vacancy_id, r.salary_from, r.salary_to, r.currency, r.salary_gross) == ("777", 200000, 300000, "RUB", False)
    assert (r.salary_mid, r.city, r.exp_min_years, r.exp_max_years) == (250000.0, "Москва", 3, 6)
    assert (r.employment_type, r.grade, r.vacancy_code) == ("Полная занятость", "senior", "12345-a")
    emp = spark.createDataFrame([("u", '<div data-qa="employer-rating">4,3</div> 120 отзывов ДМС Прямой работодатель')],
                                "url string, html string")
    e = employer_rows(emp).first()
    assert (e.employer_rating, e.employer_reviews_count, e.employer_has_med_insurance, e.employer_type) == \
        (4.3, 120, True, "direct")


def test_text_blocks(spark):
    df = spark.createDataFrame([("Москва, м. Арбатская, м. Смоленская; район Арбат",
                                 "Высшее техническое образование, бакалавр. English B2, немецкий",
                                 "Формат работы: удалённо\nГрафик работы: 5/2",
                                 '<span data-qa="bloko-tag__text">SQL</span><span data-qa="bloko-tag__text">sql</span>'
                                 '<span data-qa="bloko-tag__text">Python</span>')], "a string, t string, f string, h string")
    r = TX.skill_list(df, "h", "s").select(TX.address_features(F.col("a")).alias("x"), TX.education_block(F.col("t")).alias("e"),
                  TX.language_requirements(F.col("t")).alias("l"), TX.work_format(F.col("f"), F.lit("")).alias("w"),
                  "s", TX.junior_signals(F.lit("Стажёр, ментор"), F.lit(False)).alias("j")
                  ).first()
    assert tuple(r.x) == (True, "Арбатская", 2, True)
    assert tuple(r.e) == (True, "bachelor_or_higher", True, None)
    assert tuple(r.l) == (True, "upper_intermediate", 1)
    assert (r.w.work_format, r.w.is_remote, r.w.schedule) == ("remote", True, "5/2")
    assert r.s == "SQL, Python"
    assert (r.j.is_for_juniors, r.j.has_mentoring) == (True, True)


def test_quantiles_of_hot_values_move_no_rows(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    vals = np.concatenate([np.full(5000, 2.0), rng.normal(size=4000), np.full(1000, -1.0), [np.nan]])
    rows = [("a" if i % 10 else None if i % 20 else "few" if i < 3000 else "mid", float(v)) for i, v in enumerate(rng.permutation(vals))]
    df = spark.createDataFrame([*rows, ("none", None)], "k string, v double")
    probs = [0.0, 0.01, 1 / 3, 0.5, 0.99, 1.0]
    got = quantiles.grouped_quantiles(df, "v", probs, ["k"], [f"p{i}" for i in range(6)])
    for r in got.collect():
        own = np.array([v for k, v in rows if k == r.k and v == v])
        assert np.allclose([r[f"p{i}"] for i in range(6)], np.quantile(own, probs))
    assert got.count() == 4
    plan = got._jdf.queryExecution().toString()
    assert "RDDScan" not in plan and "rangepartitioning" not in plan
    assert quantiles.global_quantiles(df.where("v is null"), "v", [0.5]).count() == 0


def test_key_grid_has_every_combination(spark):
    from hiresight.operators.market import complete_key_grid
    src = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "k string, l string")
    res = spark.createDataFrame([("a", "x", 3)], "k string, l string, n int")
    assert {(r.k, r.l): r.n for r in complete_key_grid(res, src, ["k", "l"], {"n": 0}).collect()} == \
        {(k, l): 3 * (k + l == "ax") for k in "ab" for l in "xyz"}


VACANCY_PAGE = """<html><body><h1 data-qa="vacancy-title">Junior data analyst</h1>
<div data-qa="vacancy-salary"><span>до 150 000 ₽</span></div>
<a class="x" data-qa="vacancy-company-name" href="/employer/9?a=1"><span>Банк Ромашка</span></a>
<span data-qa="vacancy-view-location">Казань, метро Кремлёвская</span><p>Формат работы: гибрид</p><p>График работы: 5/2</p>
<span data-qa="bloko-tag__text">SQL</span><span data-qa="bloko-tag__text">Tableau</span><span data-qa="bloko-tag__text">sql</span>
<div data-qa="vacancy-description"><p>Требования:</p><ul><li>- знание python и sql</li><li>- английский B2</li></ul>
<p>Будет плюсом:</p><ul><li>- tableau, airflow</li></ul><p>Условия:</p><ul><li>ДМС, обучение</li></ul></div>
<p>Вакансия опубликована 5 марта 2024 в Казани</p></body></html>"""


def test_vacancy_rows_fill_the_raw_schema(spark):
    from hiresight.sources import pages as P
    from hiresight.sources.raw import raw_schema
    d = spark.createDataFrame([("https://x/vacancy/5?q", VACANCY_PAGE), (None, None), ("u", "<div data-qa='vacancy-salary'>0</div>")], "url string, html string")
    rows = P.vacancy_rows(d, scraped_at=F.lit("2024-03-08 10:00:00").cast("timestamp"), search_area_id=88)
    employers = spark.createDataFrame([("/employer/9?a=1", 4.5, True), ("/employer/9?a=1", None, None)], "employer_url string, employer_rating double, employer_has_remote boolean")
    full = P.enrich_with_employers(rows, employers)
    assert set(rows.columns) | set(P.EMPLOYER_COLUMNS) == {f.name for f in raw_schema().fields}
    (r,) = full.collect()
    assert (r.vacancy_id, r.salary_from, r.salary_to, r.company, r.employer_url, r.city, r.metro_primary) == \
        ("5", None, 150000, "Банк Ромашка", "/employer/9?a=1", "Казань", "Кремлёвская")
    assert (r.skills, r.skills_count, r.grade, r.work_format, r.schedule, r.vacancy_age_days) == ("SQL, Tableau", 2, "junior", "hybrid", "5/2", 3)
    assert (r.has_python, r.skill_sql, r.skill_tableau, r.skill_airflow, r.has_airflow, r.benefit_dms, r.domain_finance) == (True,) * 6 + (False,)
    assert (r.core_data_skills_count, r.ml_stack_count, r.must_have_skills_count, r.optional_skills_count, r.requirements_count) == (3, 1, 2, 3, 2)
    assert (r.lang_english_level, r.is_for_juniors, r.search_area_id, r.employer_rating, r.employer_has_remote) == ("upper_intermediate", True, 88, 4.5, True)


@pytest.mark.parametrize("html, want", [
    ('<script>{"employerReviews": {"totalRating": "4,7", "reviewsCount": "1 200"}}</script>', (4.7, 1200, False, None)),
    ("{&quot;employerReviews&quot;:{&quot;rating&quot;:{&quot;value&quot;:3.9}}}", (3.9, None, False, None)),
    ('totalRating: 9 <div data-qa="employer-rating">4.1</div>', (4.1, None, False, None)),
    ('<meta itemprop="ratingValue" content="2,5">Агентство, гибкий график, 1 024 отзыва', (2.5, 1024, True, "agency")),
    ('<script type="application/ld+json">{"aggregateRating":{"ratingValue":"4.0","ratingCount":"12"}}</script>', (4.0, 12, False, None)),
    ('"advantages": ["ДМС"] гибкий график <b data-qa="employer-type">Прямой работодатель</b> кадровый', (None, None, False, "direct")),
])
def test_employer_candidates_in_order(spark, html, want):
    from hiresight.sources.pages import employer_rows
    e = employer_rows(spark.createDataFrame([("u", html)], "url string, html string")).first()
    assert (e.employer_rating, e.employer_reviews_count, e.employer_has_flexible_schedule, e.employer_type) == want
    assert e.employer_accredited_it is None


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([(1,)], "a int")
    for call in (lambda: segments.two_key_quartiles(df), lambda: segments.summary_by_category(df, "x", "a"),
                 lambda: segments.english_requirement_stats(df, "a"), lambda: segments.skill_share_by_grade(df)):
        with pytest.raises(ValueError, match="needs"):
            call()


def test_paragraphs(spark):
    from hiresight.functions import text as TX
    texts = ["", "a", "a\nb\n\nc", "\n \n", "x\n\n\n\ny\r\nz"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(TX.paragraph_count(F.col("t"))).collect()
    assert [r[0] for r in got] == [0, 1, 2, 1, 2]
