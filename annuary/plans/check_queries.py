"""Queries of the quality rules, the review view and the text layer, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annuary import api
from annuary.functions.text import strip
from annuary.operators import checks, ocr, review
from annuary.plans import sql
from annuary.session import cut_lineage, read_table


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "scientist_profiles")


def _page_text(spark: SparkSession, d: str) -> DataFrame:
    return ocr.page_text(read_table(spark, d, "documents"))


def _first_text(spark: SparkSession, d: str) -> DataFrame:
    return ocr.first_text(read_table(spark, d, "documents"))


def profile_checks(spark, d):
    return checks.profile_findings(_profiles(spark, d))


def out_of_order(spark, d):
    return checks.out_of_order(_profiles(spark, d))


def page_overlap(spark, d):
    return checks.page_overlap(_profiles(spark, d))


def alpha_window(spark, d):
    return checks.alpha_window(_profiles(spark, d))


def duplicate_entities(spark, d):
    return checks.duplicate_entities(_profiles(spark, d))


def median_yield(spark, d):
    return checks.low_yield(_profiles(spark, d))


def median_yield_of_records(spark, d):
    """The same over the events of each page, with a share that many pages fall below."""
    events = read_table(spark, d, "career_events_1927").select(F.col("source_pdf_page").alias("source_page"))
    return checks.low_yield(events, 0.9)


def star_mismatch(spark, d):
    return checks.star_mismatch(_profiles(spark, d), _first_text(spark, d))


def star_mismatch_all_texts(spark, d):
    return checks.star_mismatch(_profiles(spark, d), _page_text(spark, d))


def findings_report(spark, d):
    return checks.findings_report(checks.all_findings(_profiles(spark, d)))


def suspect_pages(spark, d):
    return checks.suspect_pages(checks.all_findings(_profiles(spark, d)))


def top8_per_code(spark, d):
    return checks.top_per_code(checks.all_findings(_profiles(spark, d)))


def findings_flags(spark, d):
    p = _profiles(spark, d)
    return checks.flags_of_profiles(p, checks.all_findings(p))


def review_view(spark, d):
    p = _profiles(spark, d)
    return review.review_view(p, cut_lineage(checks.all_findings(p))).drop("pass_no", "pos")


def position_lines(spark, d):
    return _profiles(spark, d).select("profile_id", review.degree_lines().alias("degrees"), review.position_lines("employment").alias("career"), review.position_lines("minor_positions").alias("minor"))


def group_break(spark, d):
    rows = read_table(spark, d, "career_events_1927").select("event_id", "source_pdf_page", "scientist_name")
    return review.group_breaks(rows, ["source_pdf_page", "scientist_name"], "source_pdf_page", ["scientist_name", "event_id"])


def dedupe_first(spark, d):
    rows = read_table(spark, d, "career_events_1927").select("event_id", "profile_id", "record_type", "role_or_degree", "institution_organization", "start_year")
    keys = {"a": F.col("profile_id"), "b": F.col("record_type"), "c": strip(F.coalesce("role_or_degree", F.lit(""))), "d": strip(F.coalesce("institution_organization", F.lit(""))), "e": F.col("start_year")}
    return review.first_of_each(rows, keys, ["event_id"])


def printed_count(spark, d):
    return ocr.printed_counts(_profiles(spark, d), _first_text(spark, d))


def printed_count_all_texts(spark, d):
    return ocr.printed_counts(_profiles(spark, d), _page_text(spark, d))


def entry_candidates(spark, d):
    return ocr.entry_candidates(_first_text(spark, d))


def entry_candidates_all_texts(spark, d):
    return ocr.entry_candidates(_page_text(spark, d))


def printed_headings(spark, d):
    return ocr.printed_headings(_page_text(spark, d))


def text_layer_checks(spark, d):
    return ocr.text_findings(_profiles(spark, d), _page_text(spark, d), checks.alpha_window(_profiles(spark, d)))


def subtractive_repair(spark, d):
    return ocr.repair_birth_fields(_profiles(spark, d), _page_text(spark, d)).select("profile_id", "birth_place", "birth_date", "birth_year", "repair_note")


def omissions(spark, d):
    return ocr.page_omissions(_profiles(spark, d), _page_text(spark, d), checks.alpha_window(_profiles(spark, d)))


def quality_run(spark, d):
    """All rules with repair and text layer first, counted by code."""
    return checks.findings_report(api.run_checks(_profiles(spark, d), _page_text(spark, d)))


QUERIES = {
    f.__name__: f
    for f in (
        profile_checks, out_of_order, page_overlap, alpha_window, duplicate_entities, median_yield, median_yield_of_records, star_mismatch, star_mismatch_all_texts, findings_report, suspect_pages, top8_per_code,
        findings_flags, review_view, position_lines, group_break, dedupe_first, printed_count, printed_count_all_texts, entry_candidates, entry_candidates_all_texts, printed_headings, text_layer_checks, subtractive_repair, omissions, quality_run,
    )
}

_QUOTED = lambda x: f"case when contains({x}, '''') and not contains({x}, '\"') then '\"' || {x} || '\"' else '''' || replace({x}, '''', '\\''') || '''' end"
_BASE = f"""p as (select profile_id, source_page as page, coalesce(nullif(full_name, ''), '(unnamed)') as scientist, coalesce(birth_year, 0) as birth, birth_year, birth_place, department,
  list_filter(coalesce(education, []), lambda x: x is not null) as degrees, list_filter(coalesce(employment, []), lambda x: x is not null) as jobs from scientist_profiles),
d as (select profile_id, page, scientist, birth, unnest(degrees) as x from p), e as (select profile_id, page, scientist, birth, unnest(jobs) as x from p),
dd as (select *, {sql.strip("coalesce(x.degree_type, 'None') || ' ' || coalesce(x.institution, '')")} as label, coalesce(x.year, 0) as y, coalesce(x.degree_type, '') as kind, coalesce(x.institution, '') as inst from d),
ee as (select *, coalesce(x.start_year, 0) as s, coalesce(x.end_year, 0) as t, coalesce(x.position_title, '') as name from e),
cur as (select *, len(list_filter(jobs, lambda x: coalesce(x.is_current_position, false))) as n from p)"""
_R = "select profile_id, page, scientist, '{}' as severity, '{}' as code, {} as detail from {} where {}"
_PROFILE_RULES = " union all ".join(
    _R.format(*r)
    for r in (
        ("warn", "no_birth_year", "''", "p", "birth = 0"),
        ("error", "birth_year_implausible", "cast(birth as varchar)", "p", "birth <> 0 and birth not between 1800 and 1915"),
        ("error", "birth_place_looks_like_degree", f"'birth_place=' || {_QUOTED('birth_place')} || ' contains a degree abbreviation -- the birth fields were probably invented from the degree text'", "p", f"coalesce(birth_place, '') <> '' and regexp_matches(birth_place, {sql.q(checks.DEGREE)})"),
        ("warn", "no_department", "''", "p", "coalesce(department, '') = ''"),
        ("warn", "no_education", "''", "p", "len(degrees) = 0"),
        ("warn", "no_employment", "''", "p", "len(jobs) = 0"),
        ("warn", "no_current_position", "'no italic 1927 role: panel years to 1927 will be blank'", "cur", "n = 0"),
        ("warn", "many_current_positions", "printf('%d positions marked current', n)", "cur", "n > 4"),
        ("warn", "duplicate_degree_type", "printf('''%s'' listed %d times -- check whether one is a degreeless study spell', kind, n)", "(select profile_id, page, scientist, kind, count(*) as n from dd where kind <> '' group by all)", "n > 1"),
        ("error", "year_out_of_range", "'degree ' || label || ' in ' || y", "dd", "y <> 0 and y not between 1800 and 1927"),
        ("error", "milestone_before_adulthood", "'degree ' || label || ' in ' || y || ' but born ' || birth || ' -- check the birth year'", "dd", "y <> 0 and birth <> 0 and y < birth + 15"),
        ("error", "position_in_education", f"'degree_type=' || {_QUOTED('kind')} || ' looks like a job title'", "dd", f"regexp_matches(kind, {sql.q(checks.JOB_WORD)})"),
        ("warn", "degree_missing_institution_and_year", f"'degree ' || {_QUOTED('kind')} || ' has neither institution nor year -- it may share its neighbour''s printed ones'", "dd", "kind <> '' and inst = '' and y = 0"),
        ("warn", "degree_glued_into_institution", f"'institution ' || {_QUOTED('inst')} || ' starts with a degree abbreviation -- two printed degrees were probably fused into one'", "dd", f"regexp_matches(inst, {sql.q('^' + checks.DEGREE)})"),
        ("error", "year_out_of_range", "'employment ' || name || ' year=' || s", "ee", "s <> 0 and s not between 1800 and 1927"),
        ("error", "year_out_of_range", "'employment ' || name || ' year=' || t", "ee", "t <> 0 and t not between 1800 and 1927"),
        ("error", "end_before_start", "name || ' ' || s || '-' || t", "ee", "s <> 0 and t <> 0 and t < s"),
        ("error", "milestone_before_adulthood", "'position ''' || name || ''' in ' || s || ' but born ' || birth || ' -- check the birth year'", "ee", "s <> 0 and birth <> 0 and s < birth + 15"),
    )
)
_NAMED = f"""named as (select source_page as page, nullif({sql.surname('full_name')}, '') as surname, pass_no, pos, profile_id from scientist_profiles),
ordered as (select *, row_number() over (partition by page order by pass_no, pos, profile_id) as ord from named),
ends as (select page, arg_min(surname, ord) filter (surname is not null) as first, arg_max(surname, ord) filter (surname is not null) as last, min(lower(surname)) as low, max(lower(surname)) as high from ordered group by 1)"""
_OUT = f"""select 'warn' as severity, 'out_of_order' as code, page, surname as scientist, printf('''%s'' follows ''%s'' but sorts before it', surname, before) as detail
from (select *, lag(surname) over (partition by page order by ord) as before from ordered where surname is not null) where lower(surname) < lower(before)"""
_OVERLAP = """select 'error' as severity, 'empty_page' as code, page, '' as scientist, 'no profiles returned' as detail from ends where last is null
union all select 'error', 'page_overlap', page, first, printf('page starts at ''%s'', before page %d ended at ''%s'' -- possible duplicated entries', first, pp, pl)
from (select *, lag(last) over (order by page) as pl, lag(page) over (order by page) as pp from ends where last is not null) where lower(first) < lower(pl)"""
_DUPLICATE = f"""select 'error' as severity, 'duplicate_scientist' as code, max(source_page) as page, name as scientist, 'appears on pages [' || array_to_string(list(source_page order by source_page)[1:200], ', ') || case when count(*) > 200 then printf(' and %d more', count(*) - 200) else '' end || ']' as detail
from (select {sql.strip("coalesce(full_name, '')")} as name, source_page from scientist_profiles) group by name having count(*) > 1"""
_YIELD = """select 'warn' as severity, 'low_entry_count' as code, page, '' as scientist, printf('%d entries vs a median of %s across the run', n, cast(cast(round_even(m, 0) as bigint) as varchar)) as detail
from (select source_page as page, count(*) as n from scientist_profiles group by 1), (select median(n) as m, count(*) as c from (select count(*) as n from scientist_profiles group by source_page)) where c >= 5 and n < greatest(1.0, m * 0.6)"""
_ALL = f"""with {_BASE}, {_NAMED}, f as (select severity, code, page, scientist, detail from ({_PROFILE_RULES}) union all {_OUT} union all select * from ({_OVERLAP}) union all {_DUPLICATE} union all {_YIELD})"""
_PAGE = "(select page_no as page, arg_min(text, doc_id) as text from documents where kind = 'page_text' and page_no is not null and text is not null group by 1)"
_SQUASH = r"regexp_replace(regexp_replace(text, '\s+', '', 'g'), 'AMERICANMENOFSCIENCE', '', 'gi')"
_BREAK = f"'{ocr.TEXT_BREAK}'"
#: The different texts of a page, one row each; and all of them in one text.
_TEXTS = f"(select page_no as page, min(doc_id) as doc_id, arg_min(text, doc_id) as text from documents where kind = 'page_text' and page_no is not null and text is not null group by page_no, {_SQUASH})"
_ALL_PAGE = f"(select page, string_agg(text, {_BREAK} order by doc_id) as text from {_TEXTS} group by 1)"
_PLACES = lambda p: f"list_transform(range(1, len(regexp_extract_all(flat, {sql.q(p)})) + 1), lambda i: cast(list_sum(list_transform(string_split_regex(flat, {sql.q(p)})[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(regexp_extract_all(flat, {sql.q(p)})[1:i - 1], lambda x: length(x))), 0) as bigint))"
_HEADINGS = f"""with flat as (select page, doc_id, regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), {sql.q(ocr.SPACED_HEADER)}, '', 'g') as flat from {_TEXTS}),
places as (select page, doc_id, flat, unnest(list_distinct(list_concat({', '.join(_PLACES(p) for p in ocr.HEADINGS)}))) as spot from flat),
cut as (select page, doc_id, spot, array_to_string(string_split(flat[spot + 1:spot + 90], ',')[1:2], ',') as h from places)
select page, cast(row_number() over (partition by page order by doc_id, spot) - 1 as int) as ordinal, {sql.strip("regexp_replace(regexp_replace(h, ' ([,).])', '\\1', 'g'), '\\( ', '(', 'g')")} as heading from cut"""
_OFFSETS = "list_transform(range(1, len(string_split(t, key))), lambda i: cast(list_sum(list_transform(string_split(t, key)[1:i], lambda x: length(x))) as bigint) + (i - 1) * length(key))"
_AFTER = "t[p + length(key) + 1:p + length(key) + 14 + length(probe)]"
_NO_BRACKETS = lambda x: f"regexp_replace({x}, '[()]', '', 'g')"
_LITERAL = lambda x: f"regexp_replace({x}, '([^A-Za-z0-9])', '\\\\\\1', 'g')"
_REPAIR = f"""with n as (select *, regexp_replace(coalesce(full_name, ''), '\\s+', '', 'g') as name from scientist_profiles),
shaped as (select *, split_part(name, ',', 1) as sur, regexp_extract(name, '^[^,]*,(.*)$', 1) as rest from n),
probed as (select *, sur || ',' as key, coalesce(nullif(regexp_extract(rest, '^[^(),]*\\([^)]*\\)', 0), ''), split_part(rest, ',', 1))[1:14] as probe from shaped),
texts as (select page, doc_id, {_SQUASH} as t from {_TEXTS}),
slices as (select profile_id, doc_id, t[p + 1:p + 320] as part from (select profile_id, doc_id, t, list_filter({_OFFSETS}, lambda p: contains({_AFTER}, probe) or contains({_NO_BRACKETS(_AFTER)}, {_NO_BRACKETS('probe')}))[1] as p
  from probed join texts on page = source_page where sur <> '' and rest <> '' and probe <> '') where p is not null),
found as (select profile_id, string_agg(part, {_BREAK} order by doc_id) as part from slices group by 1),
d as (select s.profile_id, birth_place, birth_date, birth_year, part, {sql.strip("coalesce(birth_date, '')")} as bd, coalesce(birth_year, 0) <> 0 as has_year, coalesce(birth_place, '') <> '' and regexp_matches(birth_place, {sql.q(checks.DEGREE)}) as degree from scientist_profiles s left join found using (profile_id)),
e as (select *, regexp_extract(bd, {sql.q(ocr.BIRTH_DATE)}, 1) as m, regexp_replace(regexp_extract(bd, {sql.q(ocr.BIRTH_DATE)}, 2), '^0+(\\d)', '\\1') as dd, regexp_extract(bd, {sql.q(ocr.BIRTH_DATE)}, 3) as y from d),
f as (select *, y <> '' as dated, ',(?:' || right(y, 2) || '|' || y || ')' as years from e),
g as (select *, not degree and part is not null and dated and not (regexp_matches(part, '[A-Za-z]{{3,9}}\\.?' || dd || years) or regexp_matches(part, '(?i)' || m[1:3] || '[a-z]*\\.?\\d{{1,2}}' || years)) as no_date from f),
h as (select *, not degree and part is not null and has_year and not regexp_matches(part, ',' || right(cast(birth_year as varchar), 2) || '[.,;]') and (no_date or not dated) as no_year from g)
select profile_id, case when not degree then birth_place end as birth_place, case when not (degree or no_date) then birth_date end as birth_date, case when not (degree or no_year) then birth_year end as birth_year,
 case when degree then 'all birth fields cleared: birth_place ' || {_QUOTED('birth_place')} || ' was degree text' when no_date then 'birth_date ' || {_QUOTED("(m || ' ' || dd || ', ' || y)")} || ' stripped (no printed trace)' || case when no_year then '; birth_year stripped too' else '' end
 when no_year then 'birth_year ' || birth_year || ' stripped (no printed trace)' else '' end as repair_note from h"""
_SPAN = sql.span_text
_DEG_LINE = f"coalesce(nullif(x.degree_type, ''), 'study') || ', ' || coalesce(nullif(x.institution, ''), '?') || ', ' || {_SPAN('x.year', 'x.end_year', 'false')}"
_POS_LINE = f"coalesce(nullif(x.position_title, ''), '?') || case when coalesce(x.institution_org, '') <> '' then ', ' || x.institution_org else '' end || ', ' || {_SPAN('x.start_year', 'x.end_year', 'coalesce(x.is_current_position, false)')} || case when coalesce(x.is_current_position, false) then '  [current 1927]' else '' end"
_LINES = "array_to_string(list_transform(list_filter(coalesce({}, []), lambda x: x is not null), lambda x: {}), chr(10))"
_FLAG = "upper(severity) || ': ' || code || case when detail <> '' then ' -- ' || detail else '' end"
_FLAGS = f"""select profile_id, {_FLAG} as flag from (select profile_id, source_page as page, {sql.strip("coalesce(full_name, '')")} as name from scientist_profiles) s join f using (page)
where scientist <> '' and (name = scientist or {sql.strip("split_part(name, ',', 1)")} = scientist or starts_with(name, scientist))"""

ORACLE = {
    "profile_checks": f"with {_BASE} {_PROFILE_RULES}",
    "out_of_order": f"with {_NAMED} {_OUT}",
    "page_overlap": f"with {_NAMED} {_OVERLAP}",
    "alpha_window": f"with {_NAMED} select page, least(coalesce(low, ''), lower(lag(last) over (order by page))) as lo, greatest(coalesce(high, 'zzzz'), lower(lead(first) over (order by page))) as hi from ends",
    "duplicate_entities": _DUPLICATE,
    "median_yield": _YIELD,
    "median_yield_of_records": _YIELD.replace("from scientist_profiles", "from (select source_pdf_page as source_page from career_events_1927)").replace("m * 0.6", "m * 0.9"),
    "star_mismatch": f"""select page, printed, starred from (select source_page as page, cast(sum(coalesce(star_status, false)::int) as bigint) as starred from scientist_profiles group by 1)
join (select page, cast(length(text) - length(replace(text, '*', '')) as bigint) as printed from {_PAGE}) using (page) where printed <> starred""",
    "findings_report": f"{_ALL} select severity, code, count(*) as n, count(distinct page) as n_pages from f group by all",
    "suspect_pages": f"{_ALL} select distinct page from f where severity = 'error' and code in ('entry_possibly_missed', 'page_overlap', 'empty_page', 'duplicate_scientist')",
    "top8_per_code": f"{_ALL} select *, cast(row_number() over (partition by code order by page, scientist, detail) as int) as r from f qualify r <= 8",
    "findings_flags": f"{_ALL} {_FLAGS}",
    "review_view": f"""{_ALL}, g as (select profile_id, string_agg(flag, chr(10) order by flag) as flags, bool_or(starts_with(flag, 'ERROR')) as bad from ({_FLAGS}) group by 1)
select s.profile_id, source_page as page, full_name, case when star_status then '*' else '' end as star, titles, mailing_address, mailing_city, mailing_state, mailing_country, department, birth_place, birth_date, birth_year,
 {_LINES.format('education', _DEG_LINE)} as degrees, {_LINES.format('employment', _POS_LINE)} as career, {_LINES.format('minor_positions', _POS_LINE)} as minor,
 array_to_string(coalesce(societies, []), chr(10)) as societies, research_accomplished, research_in_progress, coalesce(flags, '') as flags, case when bad then 'error' when flags is not null then 'warn' else '' end as row_severity
from scientist_profiles s left join g using (profile_id)""",
    "position_lines": f"select profile_id, {_LINES.format('education', _DEG_LINE)} as degrees, {_LINES.format('employment', _POS_LINE)} as career, {_LINES.format('minor_positions', _POS_LINE)} as minor from scientist_profiles",
    "group_break": """select event_id, source_pdf_page, scientist_name, coalesce((source_pdf_page, scientist_name) is distinct from lag((source_pdf_page, scientist_name)) over (order by source_pdf_page nulls first, scientist_name nulls first, event_id), false)
 and row_number() over (order by source_pdf_page nulls first, scientist_name nulls first, event_id) > 1 as is_break from career_events_1927""",
    "dedupe_first": f"""select event_id, profile_id, record_type, role_or_degree, institution_organization, start_year from career_events_1927
qualify row_number() over (partition by profile_id, record_type, {sql.strip("coalesce(role_or_degree, '')")}, {sql.strip("coalesce(institution_organization, '')")}, start_year order by event_id) = 1""",
    "printed_count": f"""select profile_id, cast((length(squashed) - length(replace(squashed, surname || ',', ''))) // (length(surname) + 1) as bigint) as n_printed
from (select profile_id, source_page as page, {sql.surname('full_name')} as surname from scientist_profiles) join (select page, {_SQUASH} as squashed from {_PAGE}) using (page) where surname <> ''""",
    "entry_candidates": "select distinct page, unnest(list_concat(" + ", ".join(f"regexp_extract_all(squashed, {sql.q(p)}, 1)" for p in ocr.ENTRY_STARTS) + f")) as surname from (select page, {_SQUASH} as squashed from {_PAGE})",
}
ORACLE |= {f"{name}_all_texts": ORACLE[name].replace(_PAGE, _ALL_PAGE) for name in ("star_mismatch", "printed_count", "entry_candidates")}
ORACLE |= {"printed_headings": _HEADINGS, "subtractive_repair": _REPAIR}
