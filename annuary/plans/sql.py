"""SQL text for the expressions that several oracle queries share."""

from __future__ import annotations

from annuary.functions.people import ADDRESS_TAIL, CANADIAN, HONORIFIC, KEY_TITLE, MONTHS
from annuary.functions.text import OCR_REPAIRS


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def collapse(x: str) -> str:
    return strip(rf"regexp_replace({x}, '\s+', ' ', 'g')")


def undot(x: str) -> str:
    return rf"regexp_replace({x}, '\.+$', '')"


def repair_ocr(x: str) -> str:
    for pattern, replacement in OCR_REPAIRS:
        x = f"regexp_replace({x}, {q(pattern)}, {q(replacement)}, 'g')"
    return x


def pipe_join(x: str) -> str:
    """x: an expression that joins all chunks with semicolons."""
    return f"nullif(array_to_string(list_filter(list_transform(string_split({x}, ';'), lambda p: {strip('p')}), lambda p: p <> ''), ' | '), '')"


def strip_honorifics(x: str) -> str:
    pattern = rf"(?i)^(?:\s*{HONORIFIC}\.?\s+)+"
    return strip(f"regexp_replace({x}, {q(pattern)}, '')")


def clean_name(x: str) -> str:
    return collapse(f"coalesce({x}, '')")


def has_comma(x: str) -> str:
    return f"contains({x}, ',')"


def after_comma(x: str) -> str:
    return f"regexp_extract({x}, '^[^,]*,(.*)$', 1)"


def last_name(x: str) -> str:
    n = clean_name(x)
    return f"case when {has_comma(n)} then {strip(f'split_part({n}, {q(chr(44))}, 1)')} else '' end"


def first_name(x: str) -> str:
    n = clean_name(x)
    return f"case when {has_comma(n)} then {strip_honorifics(strip(after_comma(n)))} else {strip_honorifics(n)} end"


def display_name(x: str) -> str:
    a, b = last_name(x), first_name(x)
    return f"case when ({a}) <> '' and ({b}) <> '' then ({a}) || ', ' || ({b}) else coalesce(nullif({b}, ''), nullif({a}, ''), {strip(f'coalesce({x}, {q(chr(0)[:0])})')}) end"


def title(t: str, x: str) -> str:
    n = clean_name(x)
    given = f"case when {has_comma(n)} then {after_comma(n)} else {n} end"
    pattern = rf"(?i)^\s*{HONORIFIC}\.?\s+"
    return f"coalesce(nullif({t}, ''), nullif({strip(f'regexp_extract({given}, {q(pattern)}, 0)')}, ''))"


def surname(x: str) -> str:
    return strip(f"split_part(coalesce({x}, ''), ',', 1)")


def name_key(x: str) -> str:
    bare = rf"regexp_replace(coalesce({x}, ''), '\([^)]*\s[^)]*\)', '', 'g')"
    return f"regexp_replace(lower(regexp_replace({bare}, {q(KEY_TITLE)}, '', 'g')), '[^a-z]', '', 'g')"


def given_initials(x: str) -> str:
    given = f"case when {has_comma(x)} then {after_comma(x)} else '' end"
    bare = rf"regexp_replace(regexp_replace(coalesce({given}, ''), '\(.*?\)', '', 'g'), {q(KEY_TITLE)}, '', 'g')"
    return rf"lower(array_to_string(regexp_extract_all({bare}, '([A-Za-z])\w*', 1)[1:2], ''))"


def place_city(x: str) -> str:
    s = undot(strip(x))
    return f"nullif(case when {has_comma(s)} then {strip(f'regexp_extract({s}, {q('(?s)^(.*),[^,]*$')}, 1)')} else {s} end, '')"


def place_state(x: str) -> str:
    s = undot(strip(x))
    return f"case when {has_comma(s)} then nullif({strip(f'split_part({s}, {q(chr(44))}, -1)')}, '') end"


def address_tail(x: str) -> str:
    return f"coalesce(nullif(regexp_extract({strip(x)}, {q(ADDRESS_TAIL)}, 1), ''), {x})"


def infer_country(x: str) -> str:
    s = f"lower({undot(strip(x))})"
    names = ", ".join(map(q, CANADIAN))
    return f"case when coalesce({x}, '') = '' then null when {s} in ({names}) or contains({s}, 'can') then 'Canada' else 'USA' end"


def first_filled(*xs: str) -> str:
    return "coalesce(" + ", ".join(f"case when {strip(x)} <> '' then {x} end" for x in xs) + ")"


def birth_date(raw: str, year: str) -> str:
    t = strip(f"coalesce({raw}, '')")
    names = ", ".join(map(q, MONTHS))
    month = f"coalesce(list_position([{names}], lower(regexp_extract({t}, '([A-Za-z]{{3,9}})', 1)[1:3])), 0)"
    y = rf"coalesce(try_cast(regexp_extract({t}, '\b(\d{{4}})\b', 1) as int), {year})"
    day = rf"coalesce(try_cast(regexp_extract({t}, '\b(0?[1-9]|[12]\d|3[01])\b', 1) as int), 0)"
    return f"case when {y} is not null then printf('%02d.%02d.%04d', {day}, {month}, {y}) end"


def coerce_year(x: str) -> str:
    four = rf"try_cast(regexp_extract({x}, '(\d{{4}})', 1) as int)"
    two = rf"try_cast(regexp_extract({x}, '(\d{{1,2}})', 1) as int)"
    return f"coalesce({four}, case when {two} <= 27 then {two} + 1900 else {two} + 1800 end)"


def cap_spell(s: str, t: str, c: str, edition: int = 1927) -> tuple[str, str, str]:
    """(start, end, current) after the edition year is taken into account."""
    return (
        f"case when {s} <= {edition} then {s} end",
        f"case when {t} is null or {t} <= {edition} then {t} when {s} <= {edition} then {edition} end",
        f"(coalesce({c}, false) and not (({s} is null or {s} > {edition}) and ({t} is null or {t} > {edition}) and ({s} is not null or {t} is not null)))",
    )


def span_text(s: str, t: str, c: str) -> str:
    return f"""case when nullif({s}, 0) is not null and nullif({t}, 0) is not null and {s} <> {t} then printf('%d-%d', {s}, {t})
when nullif({s}, 0) is not null and nullif({t}, 0) is not null then cast({s} as varchar)
when nullif({s}, 0) is not null then cast({s} as varchar) || case when {c} then '-' else '' end
when nullif({t}, 0) is not null then cast({t} as varchar) else 'undated' end"""


INVARIANTS = f"""{last_name('full_name')} as last_name, {first_name('full_name')} as first_name, {display_name('full_name')} as scientist_name,
{title('titles', 'full_name')} as title, cast(coalesce(star_status, false) as int) as star_status,
{undot(strip("coalesce(department, '')"))} as primary_department, {pipe_join("concat_ws(';', research_accomplished, research_in_progress)")} as research,
birth_year, {birth_date('birth_date', 'birth_year')} as birth_date, {first_filled('birth_city', place_city('birth_place'))} as birth_city,
{first_filled('birth_state', place_state('birth_place'))} as birth_state,
{first_filled('birth_country', infer_country(first_filled('birth_state', place_state('birth_place'))))} as birth_country,
{first_filled('mailing_city', place_city(address_tail('mailing_address')))} as mailing_city,
{first_filled('mailing_state', place_state(address_tail('mailing_address')))} as mailing_state,
{first_filled('mailing_country', infer_country(first_filled('mailing_state', place_state(address_tail('mailing_address')))))} as mailing_country,
source_page as source_pdf_page"""

#: One row per record of a profile: profile_id, kind, pos, role, inst, s, t, c.
RECORDS = """
select profile_id, 'deg' as kind, i - 1 as pos, education[i].degree_type as role, education[i].institution as inst, education[i].year as s, education[i].end_year as t, false as c
from (select profile_id, education, unnest(range(1, len(education) + 1)) as i from scientist_profiles) where education[i] is not null
union all
select profile_id, 'prim', i - 1, employment[i].position_title, employment[i].institution_org, employment[i].start_year, employment[i].end_year, coalesce(employment[i].is_current_position, false)
from (select profile_id, employment, unnest(range(1, len(employment) + 1)) as i from scientist_profiles) where employment[i] is not null
union all
select profile_id, 'par', i - 1, minor_positions[i].position_title, minor_positions[i].institution_org, minor_positions[i].start_year, minor_positions[i].end_year, coalesce(minor_positions[i].is_current_position, false)
from (select profile_id, minor_positions, unnest(range(1, len(minor_positions) + 1)) as i from scientist_profiles) where minor_positions[i] is not null
"""
_S, _T, _C = cap_spell("s", "t", "c")
#: RECORDS with the confirmed years a..b of each (null if none), and roles and institutions as the panel shows them.
SPELLS = f"""
select *, case when s2 is not null and t2 is not null then least(s2, t2) else coalesce(s2, t2, case when c2 then 1927 end) end as a,
case when s2 is not null and t2 is not null then greatest(s2, t2) when s2 is not null and c2 then 1927 else coalesce(s2, t2, case when c2 then 1927 end) end as b
from (select profile_id, kind, pos, s, t, c, {_S} as s2, {_T} as t2, {_C} as c2,
  {repair_ocr("case when kind = 'deg' then coalesce(nullif(role, ''), 'study') else coalesce(role, '') end")} as role, {repair_ocr("coalesce(inst, '')")} as inst
  from ({RECORDS}))
"""
#: One row per record and year with its slot number: profile_id, kind, y, role, inst, c, slot.
SLOTS = f"""
select profile_id, kind, y, role, inst, c, row_number() over (partition by profile_id, kind, y order by
  case when kind = 'prim' and not c then 1 else 0 end, case when kind = 'deg' then 0 else coalesce(s, 0) end,
  case when kind = 'deg' then '' else inst end, case when kind = 'par' then role else '' end, pos) as slot
from (select *, row_number() over (partition by profile_id, kind, y, {strip('role')}, {strip('inst')} order by pos) as n
  from (select *, unnest(range(a, b + 1)) as y from ({SPELLS}) where a is not null)) where n = 1
"""
