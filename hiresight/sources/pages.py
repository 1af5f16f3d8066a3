"""Page tables → rows (re-aimed from the per-page HTML parser).

The input is a table of downloaded pages ``(page_id, url, html)``; extraction
is a Spark job of native column expressions (``functions/elements.py`` for nested
elements), partitioned like the page table, with no Python per row.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import elements as EL
from ..functions import text as TX
from ..functions.dictionary import with_flags, with_label
from ..functions.exprs import contains_any


def result_links(pages: DataFrame, html_col: str = "html", host: str = "", id_col: str = "page_id") -> DataFrame:
    """One row per anchor link; links starting with "/" get ``host``
    prepended; the query string is cut at "?"."""
    links = pages.select(id_col, F.posexplode(TX.html_links(F.col(html_col))).alias("pos", "href"))
    href = F.when(F.col("href").startswith("/"), F.concat(F.lit(host), F.col("href"))).otherwise(F.col("href"))
    return links.where(F.col("href") != "").select(id_col, "pos", F.substring_index(href, "?", 1).alias("link"))


def page_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Title and visible text of each page."""
    return pages.withColumns({"title": TX.html_title(F.col(html_col)), "text": TX.html_to_text(F.col(html_col))})


def marked_text(found: Column, *marks: str) -> Column:
    """Whole text of the first element that has one of the ``data-qa`` marks and is not
    empty, in the marks' order; "" if there is none."""
    return F.coalesce(*[F.nullif(EL.text_of(EL.first(found, m)), F.lit("")) for m in marks], F.lit(""))


def element_texts(pages: DataFrame, names: list[str], html_col: str = "html", id_col: str = "page_id", separator: str = "\n") -> DataFrame:
    """The text of the first element of each name on a page: ``id_col`` and a column for
    each name, "" where there is none."""
    parts = EL.with_elements(pages.select(id_col, html_col), html_col, EL.by_name(*names))
    return parts.select(id_col, *[EL.text_of(EL.first(F.col("_found"), n), separator).alias(n) for n in names])


VACANCY_MARKS = ["vacancy-title", "vacancy-salary", "vacancy-company-name", "vacancy-view-raw-address", "vacancy-view-location",
                 "vacancy-experience", "vacancy-description", "vacancy-view-creation-time", "vacancy-view-employment-mode",
                 "vacancy-view-emp-mode", "vacancy-view-schedule"]


def vacancy_rows(pages: DataFrame, url_col: str = "url", html_col: str = "html", scraped_at=None,
                 default_city: str | None = C.DEFAULT_CITY, search_area_id: int | None = None) -> DataFrame:
    """Page -> vacancy row, all columns that a page itself gives (the employer's
    columns come from ``enrich_with_employers``).  Fields are found by their
    ``data-qa`` marks; rows without any salary are dropped."""
    h = F.coalesce(F.col(html_col), F.lit(""))
    now = scraped_at if scraped_at is not None else F.current_timestamp()
    found = F.col("_found")
    raw = pages.select(F.coalesce(F.col(url_col), F.lit("")).alias("vacancy_url"), h.alias("_html"), now.alias("scraped_at_utc"))

    def wanted(name: Column, tag: Column) -> Column:
        return F.coalesce(EL.by_attribute("data-qa", *VACANCY_MARKS)(name, tag), TX.skill_mark(name, tag))

    raw = EL.with_elements(raw, "_html", wanted)
    raw = EL.computed(raw, _salary=TX.parse_salary(marked_text(found, "vacancy-salary")))
    raw = raw.where(F.coalesce(F.nullif(F.col("_salary.salary_from"), F.lit(0)), F.nullif(F.col("_salary.salary_to"), F.lit(0))).isNotNull())
    raw = EL.computed(
        raw, _full=F.array_join(EL.strings(F.col("_texts")), "\n"), _body=EL.first(found, "vacancy-description")["strings"],
        title=marked_text(found, "vacancy-title"), company=marked_text(found, "vacancy-company-name"),
        employer_url=F.coalesce(EL.decoded(EL.attribute(EL.first(found, "vacancy-company-name")["tag"], "href")), F.lit("")),
        address=marked_text(found, "vacancy-view-raw-address", "vacancy-view-location"), experience=marked_text(found, "vacancy-experience"),
        skills=TX.joined_skills(found, F.col("_html")), _posted=marked_text(found, "vacancy-view-creation-time"),
        _employment=marked_text(found, "vacancy-view-employment-mode"), _schedule=marked_text(found, "vacancy-view-emp-mode", "vacancy-view-schedule"))
    full = F.col("_full")
    raw = raw.withColumn("description", F.coalesce(F.array_join("_body", "\n\n"), F.lit("")))
    raw = raw.withColumns({
        "_combined": F.lower(F.concat_ws("\n", "title", "description", "skills")),
        "_described": F.concat_ws("\n", "title", "description"),
        "_skill_text": F.lower(F.concat_ws("\n", "title", "description", F.replace("skills", F.lit(", "), F.lit(" ")))),
        "_sections": TX.split_sections(F.array_join("_body", "\n")), "_exp": TX.experience_range(F.col("experience")),
        "_format": TX.work_format(full, F.col("description")),
        "published_at_raw": F.coalesce(F.nullif(TX.publication_phrase(full), F.lit("")), F.col("_posted"))})
    text = F.col("_combined")
    flagged = [C.ROLE_KEYWORDS, C.TECH_KEYWORDS, C.BENEFIT_KEYWORDS, C.SOFT_SKILL_KEYWORDS, C.DOMAIN_KEYWORDS]
    raw = with_flags(with_flags(raw, text, *flagged), F.col("_skill_text"), C.DATA_SKILL_KEYWORDS)
    raw = with_label(raw, text, C.GRADE_KEYWORDS, "grade", C.LEAD_STOPWORDS)
    flags, data = [k for m in flagged for k in m], list(C.DATA_SKILL_KEYWORDS)
    tech, skill = {k: F.col(k) for k in C.TECH_KEYWORDS}, {k: F.col(k) for k in C.DATA_SKILL_KEYWORDS}
    raw = raw.withColumns({
        **TX.data_skill_counts(skill, tech),
        "must_have_skills_count": TX.skill_hits(F.col("_sections.requirements"), {**tech, **skill}),
        "optional_skills_count": TX.skill_hits(F.col("_sections.nice_to_have"), {**tech, **skill}),
        "_features": TX.salary_features(F.col("_salary.salary_from"), F.col("_salary.salary_to")),
        "_address": TX.address_features(F.col("address")), "_stats": TX.description_stats(F.col("description")),
        "_date": TX.published_date(F.col("published_at_raw"), F.col("scraped_at_utc")),
        "_edu": TX.education_block(F.col("_described")), "_lang": TX.language_requirements(F.col("_described")),
        "_junior": TX.junior_signals(text, F.col("_exp.exp_is_no_experience"))})
    out = raw.withColumns({
        "vacancy_id": TX.id_from_url(F.col("vacancy_url")), "city": TX.city_from_address(F.col("address"), default_city),
        "search_area_id": F.lit(search_area_id).cast("long"),
        "employment_type": F.coalesce(F.nullif(TX.employment_type(full), F.lit("")), F.col("_employment")),
        "schedule": F.coalesce(F.nullif(F.col("_format.schedule"), F.lit("")), F.col("_schedule")),
        "requirements_count": TX.count_bullets(F.col("_sections.requirements")),
        "responsibilities_count": TX.count_bullets(F.col("_sections.duties")),
        "skills_count": F.when(F.col("skills") == "", 0).otherwise(F.size(F.split("skills", ", "))).cast("long"),
        "vacancy_code": TX.vacancy_code(full),
        "is_remote": F.col("_format.is_remote") | F.col("benefit_remote_compensation"),
        "skill_airflow": F.col("skill_airflow") | F.col("has_airflow")})
    kept = ["vacancy_url", "scraped_at_utc", "title", "company", "employer_url", "address", "experience", "skills", "description",
            "published_at_raw", "must_have_skills_count", "optional_skills_count", "core_data_skills_count", "ml_stack_count", "tech_stack_size",
            "vacancy_id", "city", "search_area_id", "employment_type", "schedule", "requirements_count", "responsibilities_count",
            "skills_count", "vacancy_code", "grade", "is_remote", *flags, *data]
    return out.select(*kept, "_salary.*", "_features.*", "_address.*", "_exp.*", F.col("_format.work_format_raw"), F.col("_format.work_format"),
                      F.col("_format.is_hybrid"), "_stats.*", "_date.*", "_edu.*", "_lang.*", "_junior.*")


EMPLOYER_FLAGS = ["employer_has_remote", "employer_has_flexible_schedule", "employer_has_med_insurance", "employer_has_education"]
EMPLOYER_COLUMNS = ["employer_rating", "employer_reviews_count", *EMPLOYER_FLAGS, "employer_accredited_it", "employer_type"]


def _rating(text: Column) -> Column:
    value = F.replace(text, F.lit(","), F.lit(".")).try_cast("double")
    return F.when((value >= 0) & (value <= 5), value)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "").try_cast("long")


def employer_rows(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Page -> employer.  The rating is the first candidate within 0..5: the
    reviews object, any ``totalRating``, marked elements, linked data, any
    ``ratingValue``; the review count is the first of the marked link, the
    reviews object, the text (digits of one line), linked data.  Perks are looked for in the
    advantages list if there is one, else in the page's text."""
    h = F.coalesce(F.col(html_col), F.lit(""))
    src = pages.select(F.col(url_col).alias("employer_url"), h.alias("_html"), F.lower(TX.html_to_text(h)).alias("_text"),
                       F.replace(F.replace(F.replace(h, F.lit("&quot;"), F.lit('"')), F.lit('\\"'), F.lit('"')), F.lit("\\/"), F.lit("/")).alias("_plain"))
    src = EL.with_elements(src, "_html", EL.by_attribute("data-qa", "employer-reviews-link", "employer-type"))
    found = F.col("_found")
    plain, html, text = F.col("_plain"), F.col("_html"), F.col("_text")
    number = r"['\"]?([0-9]+(?:[.,][0-9]+)?)"
    reviews = F.regexp_extract(plain, r'(?is)"employerReviews"\s*:\s*(\{(?:[^{}]|\{[^{}]*\})*\})', 1)
    linked = F.regexp_extract(html, r'(?is)"(?:aggregateRating|rating)"\s*:\s*(\{[^{}]*\})', 1)
    marks = "employer-rating-value|employer-review-rating-value|employer-header-rating-value|employer-rating|employer-review-rating|rating-score"
    element = F.regexp_extract(html, rf'(?is)<[a-z0-9]+[^>]*(?:data-qa="(?:{marks})"|(?:itemprop|name)="ratingValue")[^>]*>[^<]*', 0)
    shown = F.coalesce(F.nullif(F.regexp_extract(element, r'(?i)(?:content|value)="([^"]*)"', 1), F.lit("")), F.regexp_extract(element, r">\s*([^<]*?)\s*$", 1))
    rating = F.coalesce(
        *[_rating(F.get_json_object(reviews, p)) for p in ("$.totalRating", "$.rating", "$.ratingInfo.value", "$.rating.value")],
        _rating(F.regexp_extract(plain, rf'(?is)totalRating"?\s*[:=]\s*(?:\{{[^}}]*?"value"\s*:\s*)?{number}', 1)), _rating(shown),
        *[_rating(F.get_json_object(linked, p)) for p in ("$.ratingValue", "$.rating", "$.value")],
        _rating(F.regexp_extract(plain, rf'(?is)ratingValue"?\s*[:=]\s*{number}', 1)))
    count = F.coalesce(
        _digits(marked_text(found, "employer-reviews-link")),
        *[_digits(F.get_json_object(reviews, p)) for p in ("$.reviewsCount", "$.ratingInfo.reviewsCount", "$.rating.reviewsCount")],
        _digits(F.regexp_extract(text, r"([0-9][0-9 \t\x{a0}\x{202f}]*?)\s+отзыв", 1)),
        *[_digits(F.get_json_object(linked, p)) for p in ("$.ratingCount", "$.reviewCount")],
        _digits(F.regexp_extract(plain, r'"reviewsCount"\s*:\s*([0-9\s\u00a0\u202f]+)', 1)))
    listed = F.regexp_extract(html, r'(?s)"advantages"\s*:\s*(\[[^\]]+\])', 1)
    perks = F.when(listed != "", F.lower(F.coalesce(F.array_join(F.from_json(listed, "array<string>"), " "), listed))).otherwise(text)
    kind = F.coalesce(F.nullif(F.lower(marked_text(found, "employer-type")), F.lit("")), text)
    return src.select(
        "employer_url", rating.alias("employer_rating"), count.alias("employer_reviews_count"),
        *[contains_any(perks, tokens).alias(name) for name, tokens in zip(EMPLOYER_FLAGS, C.EMPLOYER_PERKS)],
        F.when(text.contains("аккредитован"), F.lit(True)).alias("employer_accredited_it"),
        F.when(kind.contains("прямой работодатель"), "direct").when(contains_any(kind, C.EMPLOYER_AGENCY_TOKENS), "agency").alias("employer_type"))


def enrich_with_employers(vacancies: DataFrame, employers: DataFrame, key: str = "employer_url") -> DataFrame:
    """The employer's columns for each vacancy (left join on the employer's
    key).  Without a match, or where unknown, the four perk flags are false and
    the rest is NULL; an employer listed twice counts once (its greatest row)."""
    cols = [c for c in EMPLOYER_COLUMNS if c in employers.columns]
    one = employers.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*cols)).alias("_employer"))
    j = vacancies.drop(*cols).join(one, key, "left")
    return j.withColumns({c: F.coalesce(F.col(f"_employer.{c}"), F.lit(False)) if c in EMPLOYER_FLAGS else F.col(f"_employer.{c}") for c in cols}) \
        .drop("_employer")
