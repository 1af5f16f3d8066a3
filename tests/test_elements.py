"""Marked elements of pages: nested tags of one name, unclosed and odd markup."""
from pyspark.sql import functions as F

from hiresight.functions import elements as EL
from hiresight.sources import pages as P

MARKED = {
    '<span data-qa="vacancy-salary">от <span>100&nbsp;000</span> &#1088;уб.&#x20BD;</span> tail': "от100 000руб.₽",
    "<div data-qa='vacancy-salary'>a<div>b<div>c</div>d</div>e<br>f</div>g": "abcdef",
    '<p><span data-qa="vacancy-salary">x < y<b>z</p>out': "x < yz",                      # ended by the element around it
    "": "",
    '<p data-qa="vacancy-salary"/>q': "",                                                  # self-closed
    '<i data-qa=vacancy-salary>open <!-- </i> --><script>"</i>"</script>end': "openend",  # to the end of the page
    '<b data-qa="vacancy-salary">x</u></i>y</b>z': "xy",                                  # end tags without a start
    "<a " * 20_000: "",
    "<div>" * 300 + '<p data-qa="vacancy-salary">deep</p>' + "</div>" * 300: "deep",
    '<b data-qa="vacancy-salary"></b><b data-qa="vacancy-salary">second</b>': "",
    '<b data-qa="other">x</b><DIV Data-QA="vacancy-salary">UP</Div>': "UP",
    '<b data-qa="vacancy-salary" title="a > b">v</b>': "v",
}


def test_marked_elements(spark):
    df = spark.createDataFrame([*((k,) for k in MARKED), (None,)], "h string")
    got = EL.with_elements(df, "h", EL.by_attribute("data-qa", "vacancy-salary", "other")).select("h", P.marked_text(F.col("_found"), "vacancy-salary").alias("t"))
    assert {r.h: r.t for r in got.collect()} == {**MARKED, None: ""}


def test_decoded_references(spark):
    texts = ["a &amp;lt; b", "&laquo;x&raquo; &#1071;&#x44F; &#0; &#99999999; &#xD800; &nope;", "plain", "&#8381;&euro;&#128512;"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(EL.decoded(F.col("t"))).collect()
    assert [r[0] for r in got] == ["a &lt; b", "«x» Яя � &#99999999; � &nope;", "plain", "₽€😀"]


RUSSIAN = """<html><body><div class="main"><h1 data-qa="vacancy-title">Старший <b>аналитик</b> <i>данных</i></h1>
<div data-qa="vacancy-salary"><span>от <span class="n">120&nbsp;000</span></span> <span>до <span>180&#160;000</span></span> <span>&#8381;</span> до вычета налогов</div>
<a data-qa="vacancy-company-name" href='/employer/7?x=1&amp;y=2'><span><span>Банк</span> «Север»</span></a>
<span data-qa="vacancy-view-raw-address">Казань, <span>метро <span>Кремлёвская</span></span></span>
<span data-qa="vacancy-experience">3–6 <span>лет</span></span>
<div data-qa="skills-element"><div><div>Power BI</div></div></div><span class="x bloko-tag__text"><b>SQL</b> Server</span>
<div data-qa="vacancy-description"><div><div>Обязанности:</div><ul><li>- отчёты</li><li>- витрины</li></ul></div>
<div><p>Требования:</p><div>- SQL <div>- Excel</div></div></div></div>
<p>Формат работы: удалённо</p></div></body></html>"""


def test_nested_russian_page(spark):
    r = P.vacancy_rows(spark.createDataFrame([("https://x/vacancy/9", RUSSIAN)], "url string, html string")).first()
    assert (r.title, r.company, r.employer_url) == ("Старшийаналитикданных", "Банк«Север»", "/employer/7?x=1&y=2")
    assert (r.salary_from, r.salary_to, r.currency, r.salary_gross) == (120000, 180000, "RUB", True)
    assert (r.address, r.city, r.experience, r.exp_min_years) == ("Казань,метроКремлёвская", "Казань", "3–6лет", 3)
    assert (r.skills, r.work_format) == ("Power BI, SQLServer", "remote")
    assert r.description == "Обязанности:\n\n- отчёты\n\n- витрины\n\nТребования:\n\n- SQL\n\n- Excel"
    assert (r.responsibilities_count, r.requirements_count, r.description_bullets_count) == (2, 2, 4)
