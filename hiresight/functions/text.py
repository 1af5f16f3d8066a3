"""Text → column expressions (keyword flags, labels, salary text, dates, ...).

All builders return native Spark ``Column`` expressions (``contains``,
``rlike``, ``regexp_extract*``, higher-order array functions), so text work
runs vectorised inside the JVM, row by row in whatever partitioning the caller
has.  Java regexes are ASCII by default: ``(?U)``/``(?iu)`` make ``\\b``, ``\\s``
and case folding Unicode-aware (Cyrillic).
"""
from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from . import elements as EL
from .exprs import col, contains_any


def lower_text(*cols) -> Column:
    """``"\\n".join(cols).lower()`` with NULL as empty."""
    parts = [F.coalesce(col(c), F.lit("")) for c in cols]
    return F.lower(parts[0] if len(parts) == 1 else F.concat_ws("\n", *parts))


def _word_regex(token: str) -> str:
    import re
    return r"(?U)(?<!\w)" + re.escape(token.strip()) + r"(?!\w)"


def keyword_flags(text: Column, mapping: Mapping[str, Sequence[str]], word_boundary: bool = False) -> dict:
    """{flag: any pattern (lower-cased) occurs in lower(text)}.

    Literal substring mode over-matches like the original (" java" in
    " javascript"); ``word_boundary=True`` requires whole words instead."""
    t = F.lower(F.coalesce(text, F.lit("")))
    out = {}
    for flag, pats in mapping.items():
        if word_boundary:
            rx = "|".join(f"(?:{_word_regex(p.lower())})" for p in pats if p.strip())
            out[flag] = t.rlike(rx) if rx else F.lit(False)
        else:
            out[flag] = contains_any(t, [p.lower() for p in pats])
    return out


def first_regex_label(text: Column, labels: Mapping[str, Sequence[str]] = C.GRADE_KEYWORDS,
                      stopwords: Sequence[str] = C.LEAD_STOPWORDS, default: str = "unknown") -> Column:
    """Stop phrases removed, then the first label whose regex matches."""
    t = F.lower(F.coalesce(text, F.lit("")))
    for s in stopwords:
        t = F.replace(t, F.lit(s), F.lit(""))
    expr = None
    for label, pats in labels.items():
        cond = t.rlike("(?U)" + "|".join(f"(?:{p})" for p in pats))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default) if expr is not None else F.lit(default)


def parse_salary(text: Column, strip_tax_phrase: bool = False) -> Column:
    """struct(salary_from, salary_to, currency, salary_gross) from salary text.

    Numbers are digit runs that may contain spaces; "от"/"до" decide the bounds.
    With ``strip_tax_phrase`` the "до вычета" phrase is removed before looking
    for "до" (the original reads a lone amount before tax as an upper bound)."""
    cleaned = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), " ", " "), " ", " ")
    low = F.lower(cleaned)
    gross = F.when(low.contains("на руки"), F.lit(False)).when(low.contains("до вычета"), F.lit(True))
    cur = None
    for hint, code in C.CURRENCY_HINTS:
        cond = cleaned.contains(hint)
        cur = F.when(cond, code) if cur is None else cur.when(cond, code)
    nums = F.transform(F.regexp_extract_all(cleaned, F.lit(r"\d[\d ]*"), 0),
                       lambda s: F.regexp_replace(s, r"\D", "").try_cast("long"))
    bounds = F.regexp_replace(cleaned, "до вычета", "") if strip_tax_phrase else cleaned
    has_from, has_to = bounds.contains("от"), bounds.contains("до")
    n = F.size(nums)
    first, second = F.get(nums, 0), F.get(nums, 1)
    null = F.lit(None).cast("long")
    s_from = (F.when(n == 0, null).when(has_from & has_to & (n >= 2), first).when(has_from, first)
               .when(has_to, null).when(n == 2, first).when(n == 1, first).otherwise(null))
    s_to = (F.when(n == 0, null).when(has_from & has_to & (n >= 2), second).when(has_from, null)
             .when(has_to, first).when(n == 2, second).otherwise(null))
    return F.struct(s_from.alias("salary_from"), s_to.alias("salary_to"), cur.alias("currency"),
                    gross.alias("salary_gross"))


def salary_features(s_from: Column, s_to: Column) -> Column:
    """struct(salary_mid, salary_range_width, salary_is_exact)."""
    f, t = s_from.cast("double"), s_to.cast("double")
    both = f.isNotNull() & t.isNotNull()
    mid = F.when(both, (f + t) / 2).when(f.isNotNull(), f).when(t.isNotNull(), t)
    width = F.when(both, (s_to - s_from).cast("long")).when(f.isNotNull() | t.isNotNull(), F.lit(0).cast("long"))
    exact = F.when(both, F.lit(False)).when(f.isNotNull() | t.isNotNull(), F.lit(True)).otherwise(F.lit(False))
    return F.struct(mid.alias("salary_mid"), width.alias("salary_range_width"), exact.alias("salary_is_exact"))


def address_features(address: Column, metro_dot_fix: bool = True) -> Column:
    """struct(has_metro, metro_primary, metro_count, address_has_district)."""
    a = F.coalesce(address, F.lit(""))
    rx = r"(?iu)(?:м\.|метро)\s*([^,;]+)" if metro_dot_fix else r"(?iu)(?:м\\\.|метро)\s*([^,;]+)"
    hits = F.transform(F.regexp_extract_all(a, F.lit(rx), 1), lambda s: F.trim(s))
    return F.struct((F.size(hits) > 0).alias("has_metro"),
                    F.coalesce(F.get(hits, 0), F.lit("")).alias("metro_primary"),
                    F.size(hits).cast("long").alias("metro_count"),
                    a.rlike(r"(?iu)(р-н|район|АО)").alias("address_has_district"))


def experience_range(text: Column) -> Column:
    """struct(exp_min_years, exp_max_years, exp_is_no_experience)."""
    t = F.lower(F.coalesce(text, F.lit("")))
    mn = mx = ne = None
    for toks, lo, hi, none in C.EXPERIENCE_RULES:
        cond = contains_any(t, toks)
        lo_c, hi_c = F.lit(lo).cast("long"), F.lit(hi).cast("long")
        mn = F.when(cond, lo_c) if mn is None else mn.when(cond, lo_c)
        mx = F.when(cond, hi_c) if mx is None else mx.when(cond, hi_c)
        ne = F.when(cond, F.lit(none)) if ne is None else ne.when(cond, F.lit(none))
    return F.struct(mn.alias("exp_min_years"), mx.alias("exp_max_years"),
                    ne.otherwise(F.lit(False)).alias("exp_is_no_experience"))


def education_block(text: Column) -> Column:
    """struct(edu_required, edu_level, edu_technical, edu_math_or_cs)."""
    t = F.lower(F.coalesce(text, F.lit("")))
    required = (F.when(contains_any(t, C.EDU_REQUIRED_TOKENS), F.lit(True))
                 .when(t.contains("образование"), F.lit(True))
                 .when(t.contains("без образования") | t.contains("можно без"), F.lit(False)))
    level = (F.when(t.contains("неполное высшее"), "partial_higher").when(t.contains("бакалавр"), "bachelor_or_higher")
              .when(t.contains("магистр"), "master_or_higher").when(t.contains("высшее"), "any_he")
              .when(required == F.lit(False), "none"))
    technical = F.when(t.contains("техническое"), F.lit(True))
    math = F.when(contains_any(t, C.EDU_MATH_TOKENS), F.lit(True))
    return F.struct(required.alias("edu_required"), level.alias("edu_level"),
                    technical.alias("edu_technical"), math.alias("edu_math_or_cs"))


def language_requirements(text: Column) -> Column:
    """struct(lang_english_required, lang_english_level, lang_other_count)."""
    t = F.lower(F.coalesce(text, F.lit("")))
    present = t.contains("англий") | t.contains("english")
    level = (F.when(~present, "none")
              .when(t.rlike("upper[- ]?intermediate|upper intermediate|b2"), "upper_intermediate")
              .when(t.rlike("intermediate|b1"), "intermediate")
              .when(t.rlike("advanced|fluent|свободн"), "advanced")
              .when(t.contains("документац"), "basic"))
    other = sum((t.contains(k).cast("long") for k in C.OTHER_LANGUAGE_TOKENS), F.lit(0).cast("long"))
    return F.struct(present.alias("lang_english_required"), level.alias("lang_english_level"),
                    other.alias("lang_other_count"))


def junior_signals(text: Column, no_experience: Column | None = None) -> Column:
    """struct(is_for_juniors, allows_students, has_mentoring, has_test_task)."""
    t = F.lower(F.coalesce(text, F.lit("")))
    jr = contains_any(t, C.JUNIOR_TOKENS)
    if no_experience is not None:
        jr = jr | F.coalesce(no_experience.cast("boolean"), F.lit(False))
    return F.struct(jr.alias("is_for_juniors"), contains_any(t, C.STUDENT_TOKENS).alias("allows_students"),
                    contains_any(t, C.MENTOR_TOKENS).alias("has_mentoring"),
                    contains_any(t, C.TEST_TASK_TOKENS).alias("has_test_task"))


def work_format(full_text: Column, description: Column) -> Column:
    """struct(work_format_raw, work_format, is_remote, is_hybrid, schedule)."""
    ft = F.coalesce(full_text, F.lit(""))
    raw = F.trim(F.regexp_extract(ft, r"Формат работы:\s*([^\n]+)", 1))
    raw_l = F.lower(raw)
    comb = F.lower(F.concat_ws("\n", ft, F.coalesce(description, F.lit(""))))
    remote = raw_l.contains("удал") | comb.contains("удал")
    hybrid = raw_l.contains("гибрид") | comb.contains("hybrid")
    fmt = (F.when(remote, "remote").when(hybrid, "hybrid")
            .when(raw_l.contains("офис") | comb.contains("в офисе"), "office")
            .when(comb.contains("разъезд") | comb.contains("field"), "field").otherwise("unknown"))
    sched = F.trim(F.regexp_extract(ft, r"(?iu)график работы:\s*([^\n]+)", 1))
    return F.struct(raw.alias("work_format_raw"), fmt.alias("work_format"), remote.alias("is_remote"),
                    hybrid.alias("is_hybrid"), sched.alias("schedule"))


def count_bullets(text: Column) -> Column:
    """X11: lines whose stripped text starts with -, * or •."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r?\n|\r")
    return F.size(F.filter(lines, lambda l: F.trim(l).rlike(r"^[-*•]"))).cast("long")


def word_count(text: Column) -> Column:
    """F16: ``len(str.split())`` — Unicode whitespace runs; 0 for blank text."""
    plain = F.translate(F.coalesce(text, F.lit("")), EL.BLANKS + "\x1c\x1d\x1e\x1f", " " * (len(EL.BLANKS) + 4))
    return F.size(F.filter(F.split(plain, " "), lambda w: w != "")).cast("long")


def paragraph_count(text: Column) -> Column:
    """Runs of non-blank lines; at least 1 for non-empty text."""
    t = F.coalesce(text, F.lit(""))
    lines = F.split(t, r"\r?\n|\r")
    start = F.struct(F.lit(False).alias("inside"), F.lit(0).cast("long").alias("n"))

    def step(acc, line):
        filled = F.trim(line) != ""
        return F.struct(filled.alias("inside"), (acc["n"] + (filled & ~acc["inside"]).cast("long")).alias("n"))

    n = F.aggregate(lines, start, step)["n"]
    return F.when((n == 0) & (t != ""), F.lit(1).cast("long")).otherwise(n)


def description_stats(text: Column) -> Column:
    """struct(len_chars, len_words, bullets, paragraphs)."""
    t = F.coalesce(text, F.lit(""))
    return F.struct(F.length(t).cast("long").alias("description_len_chars"),
                    word_count(t).alias("description_len_words"),
                    count_bullets(t).alias("description_bullets_count"),
                    paragraph_count(t).alias("description_paragraphs_count"))


def split_sections(text: Column) -> Column:
    """struct(duties, requirements, conditions, nice_to_have): lines after a
    header line belong to that section until the next header (headers dropped,
    lines stripped, each followed by a newline)."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r?\n|\r")
    lines = F.filter(F.transform(lines, lambda l: F.trim(l)), lambda l: l != "")

    def header(l):
        low = F.lower(l)
        e = None
        for name, toks in C.SECTION_HEADERS:
            cond = contains_any(low, toks)
            e = F.when(cond, F.lit(name)) if e is None else e.when(cond, F.lit(name))
        return e

    init = F.struct(F.lit(None).cast("string").alias("cur"),
                    *[F.lit("").alias(n) for n, _ in C.SECTION_HEADERS])

    def step(acc, l):
        h = header(l)
        fields = []
        for n, _ in C.SECTION_HEADERS:
            fields.append(F.when(h.isNull() & (acc["cur"] == n), F.concat(acc[n], l, F.lit("\n")))
                          .otherwise(acc[n]).alias(n))
        return F.struct(F.coalesce(h, acc["cur"]).alias("cur"), *fields)

    folded = F.aggregate(lines, init, step)
    return F.struct(*[folded[n].alias(n) for n, _ in C.SECTION_HEADERS])


def skill_hits(section: Column, flags: Mapping[str, Column]) -> Column:
    """Number of true flags whose name (prefix stripped) occurs in the section."""
    low = F.lower(F.coalesce(section, F.lit("")))
    total = F.lit(0).cast("long")
    for name, flag in flags.items():
        pat = name.replace("has_", "").replace("skill_", "")
        total = total + (F.coalesce(flag, F.lit(False)) & low.contains(pat)).cast("long")
    return total


def data_skill_counts(skill: Mapping[str, Column], tech: Mapping[str, Column]) -> dict:
    """Counts over the data-skill flags and the technology flags: the core of
    data work (SQL, Excel, a BI tool, Python or R), the ML stack, and all of them."""
    def n(*conds: Column) -> Column:
        return sum((F.coalesce(c, F.lit(False)).cast("long") for c in conds), F.lit(0).cast("long"))

    return {
        "core_data_skills_count": n(skill["skill_sql"], skill["skill_excel"], skill["skill_powerbi"] | skill["skill_tableau"],
                                    tech["has_python"] | skill["skill_r"]),
        "ml_stack_count": n(*[tech[f"has_{x}"] for x in ("sklearn", "pytorch", "tensorflow", "spark", "kafka")],
                            tech["has_airflow"] | skill["skill_airflow"]),
        "tech_stack_size": n(*tech.values(), *skill.values()),
    }


def published_date(raw: Column, now: Column, roll_back_future: bool = False) -> Column:
    """struct(published_at_iso DATE, vacancy_age_days) from Russian date text."""
    r = F.coalesce(raw, F.lit(""))
    low = F.lower(r)
    today = F.to_date(now)
    ago = F.regexp_extract(low, r"(\d+)\s+дн", 1)
    dm = [F.regexp_extract(r, r"(\d{1,2})\.(\d{1,2})\.(\d{4})", i) for i in (1, 2, 3)]
    mm = [F.regexp_extract(low, r"(\d{1,2})\s+([а-яA-Я]+)(?:\s+(\d{4}))?", i) for i in (1, 2, 3)]
    month = None
    for stem, num in C.MONTH_STEMS:
        cond = mm[1].contains(stem)
        month = F.when(cond, F.lit(num)) if month is None else month.when(cond, F.lit(num))
    year = F.when(mm[2] != "", mm[2].cast("int")).otherwise(F.year(today))
    named = F.try_make_timestamp(year, month, mm[0].cast("int"), F.lit(0), F.lit(0), F.lit(0))
    if roll_back_future:
        named = F.when((mm[2] == "") & (F.to_date(named) > today), F.add_months(F.to_date(named), -12)).otherwise(named)
    numeric = F.try_make_timestamp(dm[2].cast("int"), dm[1].cast("int"), dm[0].cast("int"),
                                   F.lit(0), F.lit(0), F.lit(0))
    d = (F.when(r == "", F.lit(None).cast("date"))
          .when(low.contains("сегодня"), today)
          .when(low.contains("вчера"), F.date_sub(today, 1))
          .when(ago != "", F.date_sub(today, ago.cast("int")))
          .when(dm[0] != "", F.to_date(numeric))
          .when((mm[0] != "") & month.isNotNull(), F.to_date(named)))
    return F.struct(d.alias("published_at_iso"), F.datediff(today, d).cast("long").alias("vacancy_age_days"))


def regex_group(text: Column, pattern: str, group: int = 1) -> Column:
    """First match group or "" (e.g. vacancy code, id from URL)."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), pattern, group)


def publication_phrase(full_text: Column) -> Column:
    return F.trim(regex_group(full_text, r"Вакансия опубликована\s+(.+?)\s+в\s+.+", 1))


def vacancy_code(full_text: Column) -> Column:
    return regex_group(full_text, r"(?U)Код вакансии\s+([\w-]+)", 1)


def id_from_url(url: Column) -> Column:
    return regex_group(url, r"vacancy/(\d+)", 1)


def employment_type(full_text: Column) -> Column:
    """X19."""
    return regex_group(full_text, "(" + "|".join(C.EMPLOYMENT_TYPES) + ")", 1)


def city_from_address(address: Column, default: str | None = None) -> Column:
    """Text before the first comma; ``default`` when the address is empty."""
    a = F.coalesce(address, F.lit(""))
    city = F.split_part(a, F.lit(","), F.lit(1))
    return F.when(a == "", F.lit(default).cast("string")).otherwise(city)


def dedup_case_insensitive(arr: Column) -> Column:
    """X18 helper: keep the first spelling of each value, ignoring case, in order."""
    return F.aggregate(arr, F.array().cast("array<string>"),
                       lambda acc, s: F.when(F.exists(acc, lambda a: F.lower(a) == F.lower(s)), acc)
                                       .otherwise(F.concat(acc, F.array(s))))


def skill_mark(name: Column, tag: Column) -> Column:
    """Marks the elements that hold a skill, for ``elements.spans``."""
    marked = tag.contains("bloko-tag__text") | tag.contains("skills-element")
    return F.when(marked & (EL.attribute(tag, "data-qa").isin("bloko-tag__text", "skills-element")
                            | EL.attribute(tag, "class").contains("bloko-tag__text")), "skill")


def joined_skills(found: Column, html: Column) -> Column:
    """Skills from marked elements (whole text of each), else JSON ``keySkills`` /
    ``name`` entries; trimmed, non-empty, case-insensitively de-duplicated, joined by ", "."""
    h = F.coalesce(html, F.lit(""))
    tagged = F.transform(F.filter(found, lambda s: s["mark"] == "skill"), lambda s: EL.text_of(s))
    from_json = F.when(h.contains("keySkills"), F.regexp_extract_all(h, F.lit(r"\"name\"\s*:\s*\"([^\"]+)\""), 1)) \
                 .otherwise(F.array().cast("array<string>"))
    raw = F.when(F.size(tagged) > 0, tagged).otherwise(from_json)
    cleaned = F.filter(F.transform(raw, lambda s: F.trim(s)), lambda s: s != "")
    return F.array_join(dedup_case_insensitive(cleaned), ", ")


def skill_list(df: DataFrame, html: str, out: str = "skills") -> DataFrame:
    """X18 for a table of pages: ``df`` with the skills' names."""
    return EL.with_elements(df, html, skill_mark).withColumn(out, joined_skills(F.col("_found"), F.col(html))).drop("_found", "_texts")


def humanize_flag(name: Column) -> Column:
    """Strip one prefix, split on "_", map known words, else capitalise
    (longer than 3 chars) or upper-case, joined by spaces."""
    n = F.regexp_replace(name, r"^(skill_|has_)", "")
    m = F.create_map(*[x for k, v in C.HUMAN_NAME_MAP.items() for x in (F.lit(k), F.lit(v))])
    words = F.transform(F.split(n, "_"), lambda w: F.coalesce(
        m[F.lower(w)], F.when(F.length(w) > 3, F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2)))))
        .otherwise(F.upper(w))))
    return F.array_join(words, " ")


def html_to_text(html: Column) -> Column:
    """Drop script/style/comments, block tags → newline, strip tags, unescape
    common entities, collapse blank runs."""
    h = F.coalesce(html, F.lit(""))
    h = F.regexp_replace(h, r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    h = F.regexp_replace(h, r"(?s)<!--.*?-->", " ")
    h = F.regexp_replace(h, r"(?i)<\s*(br|/p|/div|/li|/h[1-6]|/tr|/title|/ul|/ol|/article|/nav)\b[^>]*>", "\n")
    h = F.regexp_replace(h, r"<[^>]+>", "")
    for ent, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        h = F.replace(h, F.lit(ent), F.lit(ch))
    h = F.regexp_replace(h, r"[ \t]*\n[\s]*", "\n")
    return F.trim(h)


def html_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1))


def html_links(html: Column) -> Column:
    """Href values of anchors."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?i)<a\s[^>]*href=\"([^\"]*)\""), 1)
