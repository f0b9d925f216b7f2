"""Queries of the panel, the events, the summary and the functions on names, places, dates and years."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annuary.functions import people, spells, text
from annuary.operators import panel
from annuary.plans import sql
from annuary.session import numbered, read_table


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "scientist_profiles")


def _jobs(spark: SparkSession, d: str) -> DataFrame:
    return _profiles(spark, d).select("profile_id", F.posexplode("employment").alias("pos", "x")).where("x is not null").select("profile_id", "pos", "x.*")


def cap_spell(spark, d):
    j = _jobs(spark, d)
    c = spells.cap_spell(F.col("start_year"), F.col("end_year"), F.col("is_current_position"))
    return j.select("profile_id", "pos", c["start"].alias("start_year"), c["end"].alias("end_year"), c["current"].alias("is_current"))


def confirmed_years(spark, d):
    j = _jobs(spark, d)
    return j.select("profile_id", "pos", F.explode(spells.confirmed_years(F.col("start_year"), F.col("end_year"), F.col("is_current_position"))).alias("year"))


def span_text(spark, d):
    return _jobs(spark, d).select("profile_id", "pos", spells.span_text(F.col("start_year"), F.col("end_year"), F.coalesce("is_current_position", F.lit(False))).alias("span"))


def balanced_panel(spark, d):
    return panel.balanced_panel(_profiles(spark, d))


def panel_slots_wide(spark, d):
    return panel.panel_wide(_profiles(spark, d))


def panel_slots_long(spark, d):
    return panel.slots_long(_profiles(spark, d))


def panel_book_order(spark, d):
    """The place of every panel row in the order of the book."""
    rows = panel.panel_years(people.with_invariants(_profiles(spark, d))).select("profile_id", "pos", "year", "source_pdf_page", "last_name", "first_name")
    return numbered(rows, panel.book_keys(rows, "year")).select("profile_id", "year", "ordinal")


def max_concurrency(spark, d):
    return panel.max_concurrency(_profiles(spark, d))


def events_long(spark, d):
    return panel.events_long(_profiles(spark, d)).drop("pos", "kind_no")


def events_book_order(spark, d):
    """The place of every event in the order of the book."""
    rows = panel.events_long(_profiles(spark, d))
    return numbered(rows, panel.book_keys(rows, "start_year", "record_type")).select("profile_id", "record_type", "item_pos", "ordinal")


def summary_book_order(spark, d):
    rows = panel.summary(_profiles(spark, d))
    return numbered(rows, panel.book_keys(rows)).select("profile_id", "ordinal")


def profile_summary(spark, d):
    return panel.summary(_profiles(spark, d)).drop("pos")


def profile_invariants(spark, d):
    return people.with_invariants(_profiles(spark, d)).select("profile_id", *people.INVARIANTS)


def panel_confirmed_stats(spark, d):
    """Distinct names, distinct starred names, confirmed and all scientist-years."""
    p = _profiles(spark, d)
    names = p.agg(
        F.countDistinct(people.display_name(F.col("full_name"))).alias("n_names"),
        F.countDistinct(F.when(F.col("star_status"), people.display_name(F.col("full_name")))).alias("n_starred_names"),
        F.count("*").alias("n_profiles"),
    )
    years = panel.balanced_panel(p).agg(F.count("*").alias("n_rows"), F.sum("activity_confirmed").cast("bigint").alias("n_confirmed"))
    return names.join(F.broadcast(years))  # one row each


def name_split(spark, d):
    c = F.col("full_name")
    return _profiles(spark, d).select("profile_id", people.last_name(c).alias("last_name"), people.first_name(c).alias("first_name"), people.display_name(c).alias("scientist_name"))


def honorific_strip(spark, d):
    c = F.col("full_name")
    return _profiles(spark, d).select("profile_id", people.strip_honorifics(c).alias("bare"), people.title(F.col("titles"), c).alias("title"))


def name_keys(spark, d):
    c = F.col("full_name")
    return _profiles(spark, d).select("profile_id", people.surname(c).alias("surname"), people.name_key(c).alias("name_key"), people.given_initials(c).alias("initials"))


def split_place(spark, d):
    return _profiles(spark, d).select("profile_id", people.place_city(F.col("birth_place")).alias("city"), people.place_state(F.col("birth_place")).alias("state"))


def mailing_tail(spark, d):
    t = people.address_tail(F.col("mailing_address"))
    return _profiles(spark, d).select("profile_id", t.alias("tail"), people.place_city(t).alias("city"), people.place_state(t).alias("state"))


def infer_country(spark, d):
    return _profiles(spark, d).select("profile_id", people.infer_country(F.col("mailing_state")).alias("country"))


def birth_date_format(spark, d):
    return _profiles(spark, d).select("profile_id", people.birth_date(F.col("birth_date"), F.col("birth_year")).alias("birth_date"))


def coerce_year(spark, d):
    return read_table(spark, d, "documents").select("doc_id", people.coerce_year(F.col("text")).alias("year"))


def ocr_normalize(spark, d):
    return _profiles(spark, d).select("profile_id", text.repair_ocr(F.col("department")).alias("department"), text.repair_ocr(F.lower("department")).alias("lower_department"))


def pipe_join(spark, d):
    return _profiles(spark, d).select("profile_id", text.pipe_join(F.col("research_accomplished"), F.col("research_in_progress")).alias("research"))


def first_filled(spark, d):
    return _profiles(spark, d).select("profile_id", text.first_filled(F.col("birth_city"), F.col("birth_state"), F.col("birth_country")).alias("place"))


def age(spark, d):
    return read_table(spark, d, "career_events_1927").select("event_id", (F.col("start_year") - F.col("birth_year")).alias("age"))


QUERIES = {
    f.__name__: f
    for f in (
        cap_spell, confirmed_years, span_text, balanced_panel, panel_slots_wide, panel_slots_long, panel_book_order, max_concurrency, events_long, events_book_order, summary_book_order,
        profile_summary, profile_invariants, panel_confirmed_stats, name_split, honorific_strip, name_keys, split_place, mailing_tail, infer_country,
        birth_date_format, coerce_year, ocr_normalize, pipe_join, first_filled, age,
    )
}

_P = "from scientist_profiles"
_JOBS = f"(select profile_id, cast(pos as int) as pos, s, t, c from ({sql.RECORDS}) where kind = 'prim')"
_CS, _CT, _CC = sql.cap_spell("s", "t", "c")
_TAIL = sql.address_tail("mailing_address")
_JOINED = """string_agg(role || ' @ ' || inst, ' | ' order by slot) filter (kind = '{}')"""
_PANEL = f"""
with slots as materialized ({sql.SLOTS}), spells as materialized ({sql.SPELLS}),
firsts as (select profile_id, min(a) as a from spells group by 1),
spine as (
  select profile_id, birth_year, unnest(case when coalesce(birth_year, a) is null then [null] else range(coalesce(birth_year, a), 1928) end) as year
  from scientist_profiles left join firsts using (profile_id)
), filled as (
  select profile_id, y as year, {_JOINED.format('deg')} as degrees, {_JOINED.format('prim')} as positions, {_JOINED.format('par')} as parallel_positions,
    max(case when kind = 'prim' and c then 1 else 0 end) as cur
  from slots group by 1, 2
)
select profile_id, cast(year as int) as year, cast(year - birth_year as int) as age, case when f.profile_id is null then 0 else 1 end as activity_confirmed,
  coalesce(cur, 0) as is_current_1927_role, coalesce(degrees, '') as degrees, coalesce(positions, '') as positions, coalesce(parallel_positions, '') as parallel_positions
from spine left join filled f using (profile_id, year)"""
_ROLE = "case when kind = 'deg' then coalesce(nullif(role, ''), 'study') else role end"
_EVENT_COLUMNS = "profile_id, item_pos, last_name, first_name, scientist_name, title, star_status, primary_department, birth_year, birth_date, birth_city, birth_state, birth_country, mailing_city, mailing_state, mailing_country, source_pdf_page"

_KIND_NO = "case record_type when 'Education' then 0 when 'Employment' then 1 else 2 end"

ORACLE = {
    "cap_spell": f"select profile_id, pos, {_CS} as start_year, {_CT} as end_year, {_CC} as is_current from {_JOBS}",
    "confirmed_years": f"select profile_id, cast(pos as int) as pos, cast(unnest(range(a, b + 1)) as int) as year from ({sql.SPELLS}) where kind = 'prim' and a is not null",
    "span_text": f"select profile_id, pos, {sql.span_text('s', 't', 'c')} as span from {_JOBS}",
    "balanced_panel": _PANEL,
    "panel_slots_long": f"""with slots as materialized ({sql.SLOTS}), spells as materialized ({sql.SPELLS}), firsts as (select profile_id, min(a) as a from spells group by 1)
select profile_id, cast(y as int) as year, kind, cast(slot as int) as slot, role, inst as institution, c as is_current from slots join scientist_profiles using (profile_id) left join firsts using (profile_id) where y >= coalesce(birth_year, a)""",
    "panel_book_order": f"""with inv as (select profile_id, pos, {sql.INVARIANTS} {_P}), panel as ({_PANEL})
select profile_id, year, row_number() over (order by source_pdf_page nulls last, last_name nulls last, first_name nulls last, year nulls last, pos, profile_id) as ordinal from panel join inv using (profile_id)""",
    "summary_book_order": f"""with inv as (select profile_id, pos, {sql.INVARIANTS} {_P})
select profile_id, row_number() over (order by source_pdf_page nulls last, last_name nulls last, first_name nulls last, pos, profile_id) as ordinal from inv""",
    "max_concurrency": f"""with n as (select kind, count(*) as n from ({sql.SLOTS}) group by profile_id, kind, y)
select k.kind, cast(greatest(coalesce(max(n), 1), 1) as int) as slots from (values ('deg'), ('prim'), ('par')) k(kind) left join n on n.kind = k.kind group by k.kind""",
    "events_long": f"""with inv as (select profile_id, {sql.INVARIANTS} {_P})
select i.* exclude (research), cast(pos as int) as item_pos, case kind when 'deg' then 'Education' when 'prim' then 'Employment' else 'MinorPosition' end as record_type,
 {_CS} as start_year, case when kind = 'deg' then coalesce(nullif({_CT}, 0), {_CS}) else {_CT} end as end_year,
 {sql.repair_ocr('inst')} as institution_organization, {sql.repair_ocr(_ROLE)} as role_or_degree,
 cast({_CC} and kind <> 'deg' as int) as is_current_1927_role
from ({sql.RECORDS}) join inv i using (profile_id)""",
    "profile_summary": f"""select profile_id, {sql.INVARIANTS},
 cast(len(list_filter(coalesce(education, []), lambda e: coalesce(e.degree_type, '') <> '')) as int) as n_degrees,
 cast(len(list_filter(coalesce(education, []), lambda e: coalesce(e.degree_type, '') = '')) as int) as n_study_spells,
 cast(len(coalesce(employment, [])) as int) as n_positions, cast(len(coalesce(minor_positions, [])) as int) as n_parallel_positions,
 {sql.pipe_join("array_to_string(coalesce(societies, []), ';')")} as societies {_P}""",
    "profile_invariants": f"select profile_id, {sql.INVARIANTS} {_P}",
    "panel_confirmed_stats": f"""select * from (select count(distinct {sql.display_name('full_name')}) as n_names,
 count(distinct case when star_status then {sql.display_name('full_name')} end) as n_starred_names, count(*) as n_profiles {_P}),
 (select count(*) as n_rows, cast(sum(activity_confirmed) as bigint) as n_confirmed from ({_PANEL}))""",
    "name_split": f"select profile_id, {sql.last_name('full_name')} as last_name, {sql.first_name('full_name')} as first_name, {sql.display_name('full_name')} as scientist_name {_P}",
    "honorific_strip": f"select profile_id, {sql.strip_honorifics('full_name')} as bare, {sql.title('titles', 'full_name')} as title {_P}",
    "name_keys": f"select profile_id, {sql.surname('full_name')} as surname, {sql.name_key('full_name')} as name_key, {sql.given_initials('full_name')} as initials {_P}",
    "split_place": f"select profile_id, {sql.place_city('birth_place')} as city, {sql.place_state('birth_place')} as state {_P}",
    "mailing_tail": f"select profile_id, {_TAIL} as tail, {sql.place_city(_TAIL)} as city, {sql.place_state(_TAIL)} as state {_P}",
    "infer_country": f"select profile_id, {sql.infer_country('mailing_state')} as country {_P}",
    "birth_date_format": f"select profile_id, {sql.birth_date('birth_date', 'birth_year')} as birth_date {_P}",
    "coerce_year": f"select doc_id, {sql.coerce_year('text')} as year from documents",
    "ocr_normalize": f"select profile_id, {sql.repair_ocr('department')} as department, {sql.repair_ocr('lower(department)')} as lower_department {_P}",
    "pipe_join": "select profile_id, " + sql.pipe_join("concat_ws(';', research_accomplished, research_in_progress)") + f" as research {_P}",
    "first_filled": f"select profile_id, {sql.first_filled('birth_city', 'birth_state', 'birth_country')} as place {_P}",
    "age": "select event_id, start_year - birth_year as age from career_events_1927",
}
ORACLE["events_book_order"] = f"""select profile_id, record_type, item_pos, row_number() over (order by source_pdf_page nulls last, last_name nulls last, first_name nulls last, start_year nulls last, record_type nulls last, pos, profile_id, {_KIND_NO}, item_pos) as ordinal
from ({ORACLE['events_long']}) e join (select profile_id, pos {_P}) using (profile_id)"""
