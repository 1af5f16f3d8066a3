"""Default configuration of the vacancy domain.

Operators never hard-code column names; they take them as parameters whose
defaults live here.  Everything in the FIXED VALUES block must equal the
values used by the original analysis for results to agree (marker sets,
keyword dictionaries, label maps, priority orders).  They are kept together,
in their natural order, as plain text.
"""
from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original analysis)
# ---------------------------------------------------------------------------

# Boolean column groups are recognised by these name prefixes.
PREFIX_GROUPS = ["is_", "has_", "skill_", "benefit_", "soft_", "domain_", "role_"]

# Only these categorical columns get "unknown" when missing.
CATEGORICAL_IMPUTE_MAP = {
    "grade": "unknown",
    "work_format": "unknown",
    "work_mode": "unknown",
    "employment_type": "unknown",
    "schedule": "unknown",
    "city_tier": "unknown",
    "lang_english_level": "unknown",
    "employer_type": "unknown",
}

# Only counters get 0 when missing (plus any numeric column ending in "_count").
NUMERIC_IMPUTE_RULES = {
    "employer_reviews_count": 0,
    "description_bullets_count": 0,
    "description_paragraphs_count": 0,
    "requirements_count": 0,
    "responsibilities_count": 0,
    "must_have_skills_count": 0,
    "optional_skills_count": 0,
    "role_count": 0,
    "skills_count": 0,
    "benefits_count": 0,
    "soft_skills_count": 0,
    "hard_stack_count": 0,
    "core_data_skills_count": 0,
    "ml_stack_count": 0,
    "tech_stack_size": 0,
    "metro_count": 0,
    "lang_other_count": 0,
}

# Per-column comments of the data-health report.
KEY_COLUMN_COMMENTS = {
    "salary_from": "зарплата отсутствует в исходной вакансии",
    "salary_to": "зарплата отсутствует в исходной вакансии",
    "employer_rating": "отзывов/рейтинга на hh нет",
    "salary_mid": "расчёт от исходной вилки; NaN если вилка не указана",
    "work_mode": '"unknown" = формат работы не распознан',
    "work_format": '"unknown" = формат работы не распознан',
    "grade": '"unknown" = грейд не удалось определить',
    "lang_english_level": '"unknown" = нет явного требования по английскому',
}

# Textual markers of an unknown value (compared after trim + lower-case).
UNKNOWN_MARKERS = [
    "unknown", "Unknown", "UNKNOWN", "не указано", "Не указано", "неизвестно",
    "", " ", "n/a", "N/A", "nan", "-", "—",
]
BOOL_TRUE_TOKENS = ["true", "1", "yes"]
BOOL_FALSE_TOKENS = ["false", "0", "no"]

# "Million plus" cities (lower-case, exact match).
CITY_MILLION_PLUS = [
    "novosibirsk", "yekaterinburg", "ekaterinburg", "nizhny novgorod", "нижний новгород", "nn",
    "kazan", "казань", "chelyabinsk", "челябинск", "samara", "самара", "omsk", "омск",
    "rostov-on-don", "rostov-na-donu", "ростов-на-дону", "ufa", "уфа", "krasnoyarsk", "красноярск",
    "perm", "пермь", "voronezh", "воронеж", "volgograd", "волгоград", "krasnodar", "краснодар",
]
CITY_MOSCOW_TOKENS = ["moscow", "моск"]
CITY_SPB_TOKENS = ["spb", "петербург", "санкт"]
CITY_KZ_TOKENS = ["kazakhstan", "kazakh", "kz", "алматы", "нур-султан", "астана"]

# Priority of role flags for the primary role.
PRIMARY_ROLE_PRIORITY = [
    "role_ml", "role_data", "role_devops", "role_backend", "role_frontend", "role_fullstack",
    "role_mobile", "role_qa", "role_product", "role_manager", "role_analyst",
]

CORE_DATA_SKILLS = [
    "skill_sql", "skill_excel", "skill_powerbi", "skill_tableau", "skill_r", "has_python",
    "skill_clickhouse", "skill_bigquery",
]
ML_STACK_SKILLS = ["has_sklearn", "has_pytorch", "has_tensorflow", "has_airflow", "has_spark", "has_kafka"]

# Flags under has_ that are not skills.
NON_SKILL_HAS = ["has_metro", "has_test_task", "has_mentoring"]

# Flags that must not dominate a persona's skill gap.
NOISY_SKILLS = [
    "has_test_task", "has_relocation", "has_metro", "has_mentoring", "skill_php",
    "skill_javascript", "skill_html", "skill_css", "skill_git",
]

# English level normalisation.
ENGLISH_LEVEL_MAP = {
    "none": "no_english", "basic": "A2", "a2": "A2", "elementary": "A2", "pre-intermediate": "A2",
    "intermediate": "B1", "b1": "B1", "upper_intermediate": "B2", "upper-intermediate": "B2", "b2": "B2",
    "advanced": "C1_plus", "fluent": "C1_plus", "c1": "C1_plus", "c2": "C1_plus", "native": "C1_plus",
    "proficient": "C1_plus",
}
EDUCATION_ANY_DEGREE = ["any_he", "bachelor_or_higher", "partial_higher"]

# Display orders of categories (unlisted values go last).
GRADE_ORDER = ["intern", "junior", "middle", "senior", "lead", "unknown"]
ENGLISH_ORDER = ["no_english", "A1", "A2", "B1", "B2", "C1_plus", "unknown"]
WORK_MODE_ORDER = ["office", "hybrid", "remote", "field", "unknown"]
WORK_MODES = ["remote", "hybrid", "office", "field"]

# Human-readable flag names.
HUMAN_NAME_MAP = {"sql": "SQL", "python": "Python", "excel": "Excel", "powerbi": "Power BI",
                  "ml": "ML", "ai": "AI", "qa": "QA"}

# Salary text: currency hints in order of precedence.
CURRENCY_HINTS = [("руб", "RUB"), ("₽", "RUB"), ("USD", "USD"), ("EUR", "EUR"), ("$", "USD"),
                  ("€", "EUR"), ("KZT", "KZT")]

# Grade keywords in order (first match wins), and phrases removed before matching.
GRADE_KEYWORDS = {
    "intern": [r"\bintern\b", r"\bстаж[её]р\b"],
    "junior": [r"\bjunior\b", r"\bмладший\b", r"\bджуниор\b", r"\bджун\b"],
    "middle": [r"\bmiddle\+?\b", r"\bмидл\b", r"\bmid\b"],
    "senior": [r"\bsenior\+?\b", r"\bсеньор\b", r"\bсиньор\b", r"\bстарший\b"],
    "lead": [r"\bteam\s*lead\b", r"\btech(nical)?\s*lead\b", r"\bтим[- ]?лид\b", r"\bведущ(ий|ая)\b"],
    "architect": [r"\barchitect\b", r"\bархитектор\b"],
}
LEAD_STOPWORDS = ["lead generation", "лидогенера"]

ROLE_KEYWORDS = {
    "role_backend": ["backend", "back-end", "бекенд", "бэкенд"],
    "role_frontend": ["frontend", "front-end", "фронтенд", "frontend-разработчик"],
    "role_fullstack": ["fullstack", "full-stack", "фуллстек", "фул-стек"],
    "role_mobile": ["android", "ios", "mobile", "мобиль", "swift", "kotlin"],
    "role_data": ["data engineer", "etl", "dwh", "bi-", "bi ", "dwh "],
    "role_ml": ["machine learning", "ml ", "ml-", "data scientist", "нейросет"],
    "role_devops": ["devops", "sre", "site reliability", "platform engineer"],
    "role_qa": ["qa", "тестир", "quality assurance", "тестиров"],
    "role_manager": ["project manager", "delivery", "scrum", "agile coach", "pm "],
    "role_product": ["product manager", "продакт", "product owner", "po "],
    "role_analyst": ["аналитик", "analyst", "bi", "системный аналитик", "бизнес-аналитик"],
}

TECH_KEYWORDS = {
    "has_python": ["python"],
    "has_java": [" java"],
    "has_kotlin": ["kotlin"],
    "has_csharp": ["c#", ".net", "dotnet"],
    "has_cpp": ["c++"],
    "has_go": [" golang", " go "],
    "has_php": ["php"],
    "has_javascript": ["javascript", " js"],
    "has_typescript": ["typescript", " ts"],
    "has_scala": ["scala"],
    "has_rust": ["rust"],
    "has_ruby": ["ruby", "rails"],
    "has_django": ["django"],
    "has_flask": ["flask"],
    "has_fastapi": ["fastapi"],
    "has_dotnet": [".net", "dotnet"],
    "has_spring": ["spring"],
    "has_nodejs": ["node.js", "nodejs", "node js"],
    "has_express": ["express"],
    "has_nestjs": ["nestjs"],
    "has_react": ["react"],
    "has_vue": ["vue"],
    "has_angular": ["angular"],
    "has_nextjs": ["next.js", "nextjs"],
    "has_nuxt": ["nuxt"],
    "has_svelte": ["svelte"],
    "has_pandas": ["pandas"],
    "has_numpy": ["numpy"],
    "has_sklearn": ["sklearn", "scikit"],
    "has_pytorch": ["pytorch"],
    "has_tensorflow": ["tensorflow"],
    "has_airflow": ["airflow"],
    "has_spark": ["spark"],
    "has_kafka": ["kafka"],
    "has_docker": ["docker"],
    "has_kubernetes": ["kubernetes", "k8s"],
    "has_terraform": ["terraform"],
    "has_ansible": ["ansible"],
    "has_jenkins": ["jenkins"],
    "has_gitlab_ci": ["gitlab ci", "gitlab-ci"],
    "has_cicd": ["ci/cd", "ci cd", "continuous integration", "continuous delivery"],
}

BENEFIT_KEYWORDS = {
    "benefit_dms": ["дмс", "медицинск", "медстрах"],
    "benefit_insurance": ["страховка", "страхование"],
    "benefit_sick_leave_paid": ["оплачиваемые больничные", "оплачиваемый больничный"],
    "benefit_vacation_paid": ["оплачиваемый отпуск", "оплачиваемые отпуска"],
    "benefit_relocation": ["релокац", "переезд"],
    "benefit_sport": ["спорт", "фитнес", "спортзал", "доступ в фитнес"],
    "benefit_education": ["обучени", "курсы", "конференц", "митап"],
    "benefit_remote_compensation": ["компенсац", "интернет", "электричества"],
    "benefit_stock": ["опционы", "rsu", "акци", "опцион"],
}

DATA_SKILL_KEYWORDS = {
    "skill_sql": [" sql", "postgres", "postgresql", "mysql", "mariadb", "mssql", "sql server", "oracle",
                  "clickhouse", "bigquery"],
    "skill_excel": ["excel", "ms excel"],
    "skill_powerbi": ["powerbi", "power bi"],
    "skill_tableau": ["tableau"],
    "skill_clickhouse": ["clickhouse"],
    "skill_bigquery": ["bigquery"],
    "skill_r": [" язык r", " r ", " r,", " r.", "rstudio"],
    "skill_airflow": ["airflow"],
    "skill_ab_testing": ["a/b", "ab test", "a/b тест", "a/b-тест"],
    "skill_product_metrics": ["продуктов", "метрик", "конверси", "воронк", "ltv", "retention", "unit-эконом"],
}

SOFT_SKILL_KEYWORDS = {
    "soft_communication": ["коммуникац", "общени"],
    "soft_teamwork": ["команд", "team"],
    "soft_leadership": ["лидер", "leadership", "руководств"],
    "soft_result_oriented": ["результат", "result oriented", "ориентаци"],
    "soft_structured_thinking": ["структур", "структурное мышление"],
    "soft_critical_thinking": ["критическ", "critical thinking"],
}

DOMAIN_KEYWORDS = {
    "domain_finance": ["банк", "финтех", "финансов"],
    "domain_ecommerce": ["ecommerce", "маркетплейс", "marketplace", "e-commerce"],
    "domain_telecom": ["телеком", "operator", "оператор связи"],
    "domain_state": ["госкомпания", "государствен"],
    "domain_retail": ["ритейл", "retail", "магазин"],
    "domain_it_product": ["saas", "продуктов", "it-продукт", "digital product"],
}

# Experience text → (min, max, no-experience), first match wins.
EXPERIENCE_RULES = [
    (["не требуется"], 0, 0, True),
    (["1–3", "1-3"], 1, 3, False),
    (["3–6", "3-6"], 3, 6, False),
    (["более 6", "6+"], 6, None, False),
]

# Education text.
EDU_REQUIRED_TOKENS = ["высшее образование", "бакалавр", "магистр", "степень"]
EDU_MATH_TOKENS = ["математ", "информат", "кибернет", "прикладная математика"]

# Language text.
OTHER_LANGUAGE_TOKENS = ["немец", "german", "китай", "chinese", "француз", "french", "испан", "spanish",
                         "итальян", "italian"]

# Junior-friendly signals.
JUNIOR_TOKENS = ["junior", "стаж", "intern", "младший", "джун"]
STUDENT_TOKENS = ["студент", "подходит для студентов", "без полного высшего"]
MENTOR_TOKENS = ["ментор", "наставнич"]
TEST_TASK_TOKENS = ["тестовое задание", "test task", "coding challenge"]

# Description section headers, in order of precedence.
SECTION_HEADERS = [
    ("duties", ["обязанности", "что делать", "responsibilit"]),
    ("requirements", ["требован", "requirements"]),
    ("conditions", ["услови", "conditions", "we offer"]),
    ("nice_to_have", ["будет плюсом", "nice to have", "желательно"]),
]

# Russian month stems for publication dates.
MONTH_STEMS = [("январ", 1), ("феврал", 2), ("март", 3), ("апрел", 4), ("мая", 5), ("май", 5),
               ("июн", 6), ("июл", 7), ("август", 8), ("сентябр", 9), ("октябр", 10), ("ноябр", 11),
               ("декабр", 12)]

EMPLOYMENT_TYPES = ["Полная занятость", "Частичная занятость", "Стажировка", "Проектная работа", "Волонтёрство"]

# Employer pages: perk words (remote, flexible schedule, medical insurance,
# education) and words of agencies; city of pages without an address.
EMPLOYER_PERKS = [["удал", "remote"], ["гибк", "flexible"], ["дмс", "мед", "insurance"], ["обуч", "education", "курсы"]]
EMPLOYER_AGENCY_TOKENS = ["кадров", "агентств"]
DEFAULT_CITY = "Москва"

# Ready-made personas: name, skills and target segment.
PERSONA_PRESETS = [
    {"name": "data_student", "description": "student of data, first junior job",
     "current_skills": ["skill_sql", "skill_excel", "has_python"], "target_role": "analyst", "target_grade": "junior"},
    {"name": "switcher_bi", "description": "from a neighbouring field to BI",
     "current_skills": ["skill_excel", "skill_powerbi"], "target_role": "product", "target_grade": "junior"},
    {"name": "mid_data_analyst", "description": "middle analyst, wants a wider stack",
     "current_skills": ["skill_sql", "skill_excel", "skill_powerbi"], "target_role": "analyst", "target_grade": "middle"},
]

# Experience buckets (right-closed) and stack-size buckets (left-closed).
EXPERIENCE_BUCKET_EDGES = [-1, 1, 3, 6, 100]
EXPERIENCE_BUCKET_LABELS = ["0-1", "1-3", "3-6", "6+"]
STACK_BUCKET_EDGES = [0, 3, 6, 10, 100]

# ---------------------------------------------------------------------------
# end of FIXED VALUES
# ---------------------------------------------------------------------------

DEFAULT_MEASURE = "salary_mid_rub_capped"
