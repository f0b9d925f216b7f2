"""Queries of the general data problems: key skew (3), nested records (6), intervals (7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annuary.functions.text import strip
from annuary.operators.career import career_timeline
from annuary.operators.dense_count import dense_counts
from annuary.operators.nested import LISTS, flat_list, flat_profile_list, list_items, merkle_tables, profile_labels, profile_tables, unread_records
from annuary.session import read_table


def event_counts(spark: SparkSession, d: str) -> DataFrame:
    events = read_table(spark, d, "career_events_1927").where("institution_organization is not null")
    return dense_counts(events, {"shard": F.col("shard"), "institution": strip(F.col("institution_organization"))}, "n_rows")


def p3_counts(spark: SparkSession, d: str) -> DataFrame:
    return event_counts(spark, d)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    bridge = read_table(spark, d, "institution_locations_1927").select("bridge_id", "shard", "institution", "n_events")
    joined = bridge.join(event_counts(spark, d), ["shard", "institution"], "left")
    wrong = F.col("n_events").isNull() | (F.col("n_events") != F.coalesce("n_rows", F.lit(0)))
    return joined.where(wrong).select(F.col("bridge_id").cast("bigint").alias("bridge_id"))


_POST = {"position_title": "position_title", "institution_org": "institution_org", "start_year": "start_year", "end_year": "end_year", "is_current_position": "is_current_position"}
#: Output columns of each flat table, and the column that takes an item given as a bare string.
FLAT = {
    "education": ({"degree_type": "degree_type", "institution": "institution", "year": "year", "end_year": "end_year"}, "degree_type"),
    "employment": (_POST, "position_title"),
    "minor_positions": (_POST, "position_title"),
    "societies": ({"name": "name", "since": "since"}, "name"),
}


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    records, _, edges = merkle_tables(read_table(spark, d, "page_records"))
    return list_items(records, edges).select("record_id", "scientist_pos", "list_name", "item_pos")


def p6_nodes(spark: SparkSession, d: str) -> DataFrame:
    """How many distinct objects each list holds, and how often they occur."""
    records, _, edges = merkle_tables(read_table(spark, d, "page_records"))
    items = list_items(records, edges)
    return items.groupBy("list_name").agg(F.count("*").alias("n_items"), F.countDistinct("item").alias("n_objects"))


def p6_unread(spark: SparkSession, d: str) -> DataFrame:
    """The page records that give no page object, each with the reason."""
    return unread_records(read_table(spark, d, "page_records"))


def _flat(list_name: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        records, nodes, edges = merkle_tables(read_table(spark, d, "page_records"))
        return flat_list(records, nodes, edges, list_name, *FLAT[list_name])

    return query


def p6_profile_lists(spark: SparkSession, d: str) -> DataFrame:
    """The lists of scientist_profiles as one flat table of (profile_id, list_name, item_pos, label, place)."""
    return profile_labels(*profile_tables(read_table(spark, d, "scientist_profiles")))


_POST_TYPES = {"position_title": "string", "institution_org": "string", "start_year": "int", "end_year": "int", "is_current_position": "boolean"}
#: All fields of each list of the profiles, and the column that takes a bare string.
PROFILE_FLAT = {
    "education": ({"degree_type": "string", "institution": "string", "year": "int", "end_year": "int"}, None),
    "employment": (_POST_TYPES, None),
    "minor_positions": (_POST_TYPES, None),
    "societies": ({"name": "string"}, "name"),
}


def _profile_flat(list_name: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        return flat_profile_list(*profile_tables(read_table(spark, d, "scientist_profiles")), list_name, *PROFILE_FLAT[list_name])

    return query


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return career_timeline(read_table(spark, d, "scientist_profiles"))


QUERIES = {
    "p3_found": p3_found,
    "p3_counts": p3_counts,
    "p6_found": p6_found,
    "p6_nodes": p6_nodes,
    "p6_unread": p6_unread,
    "p6_profile_lists": p6_profile_lists,
    **{f"p6_{name}": _flat(name) for name in LISTS},
    **{f"p6_profile_{name}": _profile_flat(name) for name in LISTS},
    "p7_found": p7_found,
}

_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_COUNTS = f"""select shard, {_STRIP.format('institution_organization')} as institution, count(*) as n_rows
from career_events_1927 where institution_organization is not null group by 1, 2"""

_CONFIRMED = """
with spells as (
  select profile_id, e.year as s, e.end_year as t, false as c from (select profile_id, unnest(education) as e from scientist_profiles)
  union all
  select profile_id, e.start_year, e.end_year, coalesce(e.is_current_position, false) from (select profile_id, unnest(employment) as e from scientist_profiles)
  union all
  select profile_id, e.start_year, e.end_year, coalesce(e.is_current_position, false) from (select profile_id, unnest(minor_positions) as e from scientist_profiles)
), capped as (
  select profile_id,
    case when s <= 1927 then s end as s,
    case when t is null or t <= 1927 then t when s <= 1927 then 1927 end as t,
    c and not ((s is null or s > 1927) and (t is null or t > 1927) and (s is not null or t is not null)) as c
  from spells
), ranges as (
  select profile_id,
    case when s is not null and t is not null then least(s, t) else coalesce(s, t, case when c then 1927 end) end as a,
    case when s is not null and t is not null then greatest(s, t) when s is not null and c then 1927 else coalesce(s, t, case when c then 1927 end) end as b
  from capped
), years as (
  select distinct profile_id, unnest(range(a, b + 1)) as y from ranges where a is not null
), runs as (
  select profile_id, min(y) as a, max(y) as b from (select *, y - row_number() over (partition by profile_id order by y) as g from years) group by profile_id, g
)
"""

# A page object as the operator sees it: a single scientist is a list of one, null fields and entries are nothing.
WHOLE = r"""
j as (select record_id, case when json_valid(raw_json) then cast(raw_json as json) end as j from page_records where status = 'ok'),
t as (select record_id, j, nullif(regexp_extract(array_to_string(list_transform(list_filter(json_extract(j, '$.response.body.output[*].content[*]'),
   lambda p: p->>'$.type' = 'output_text'), lambda p: coalesce(p->>'$.text', '')), ''), '(?s)\{.*\}', 0), '') as part from j),
pages as (select record_id, case when json_type(j, '$.response') is null then j when json_valid(part) then cast(part as json) end as page from t),
lists as (select record_id, case json_type(page, '$.scientists') when 'ARRAY' then json_extract(page, '$.scientists[*]') when 'OBJECT' then [json_extract(page, '$.scientists')] end as l from pages),
scientists as (select record_id, i - 1 as scientist_pos, l[i] as s from (select record_id, l, unnest(range(1, len(l) + 1)) as i from lists)),
named as (select record_id, scientist_pos, n as list_name, json_extract(s, '$.' || n) as v from scientists, (values ('education'), ('employment'), ('minor_positions'), ('societies')) x(n) where json_type(s) = 'OBJECT'),
boxed as (select record_id, scientist_pos, list_name, case json_type(v) when 'ARRAY' then json_extract(v, '$[*]') when 'NULL' then [] else [v] end as l from named where v is not null),
items as (select record_id, scientist_pos, list_name, i - 1 as item_pos, l[i] as item from (select *, unnest(range(1, len(l) + 1)) as i from boxed) where json_type(l[i]) <> 'NULL')"""

_ITEM = "select record_id, cast(scientist_pos as int) as scientist_pos, cast(item_pos as int) as item_pos"
_POST_SQL = (
    f"with {WHOLE} {_ITEM}, case when json_type(item) = 'OBJECT' then item->>'$.position_title' else item->>'$' end as position_title,"
    " item->>'$.institution_org' as institution_org, item->>'$.start_year' as start_year, item->>'$.end_year' as end_year, item->>'$.is_current_position' as is_current_position from items where list_name = '{}'"
)
#: What tells two items apart: their keys and values, whatever the order of the keys and however numbers are blanked.
_IDENTITY = """case when json_type(item) = 'OBJECT' then (select string_agg(k || '=' || cast(json_extract(item, '$.' || k) as varchar), chr(1) order by k) from (select unnest(json_keys(item)) as k)) else cast(item as varchar) end"""
_PROFILE_ITEMS = "(select profile_id, source_page, cast(i - 1 as int) as item_pos, {0}[i] as x from (select profile_id, source_page, {0}, unnest(range(1, len({0}) + 1)) as i from scientist_profiles) where {0}[i] is not null)"
_PROFILE_POST = "select profile_id, source_page, item_pos, x.position_title as position_title, x.institution_org as institution_org, x.start_year as start_year, x.end_year as end_year, x.is_current_position as is_current_position from "

ORACLE = {
    "p6_unread": f"""with {WHOLE} select record_id, case when coalesce(status, '') <> 'ok' then 'status ' || coalesce(status, '') else 'no text' end as reason from page_records where coalesce(status, '') <> 'ok' or raw_json is null
union all select record_id, 'damaged' from page_records p where status = 'ok' and raw_json is not null and not exists (select 1 from pages q where q.record_id = p.record_id and json_type(q.page) = 'OBJECT')""",
    "p6_nodes": f"with {WHOLE} select list_name, count(*) as n_items, count(distinct {_IDENTITY}) as n_objects from items group by 1",
    "p6_employment": _POST_SQL.replace("'{}'", "'employment'"),
    "p6_minor_positions": _POST_SQL.replace("'{}'", "'minor_positions'"),
    "p6_profile_education": f"select profile_id, source_page, item_pos, x.degree_type as degree_type, x.institution as institution, x.year as year, x.end_year as end_year from {_PROFILE_ITEMS.format('education')}",
    "p6_profile_employment": _PROFILE_POST + _PROFILE_ITEMS.format("employment"),
    "p6_profile_minor_positions": _PROFILE_POST + _PROFILE_ITEMS.format("minor_positions"),
    "p6_profile_societies": f"select profile_id, source_page, item_pos, x as name from {_PROFILE_ITEMS.format('societies')}",
    "p6_found": f"with {WHOLE} select record_id, cast(scientist_pos as int) as scientist_pos, list_name, cast(item_pos as int) as item_pos from items",
    "p6_education": f"""with {WHOLE} select record_id, cast(scientist_pos as int) as scientist_pos, cast(item_pos as int) as item_pos,
 case when json_type(item) = 'OBJECT' then item->>'$.degree_type' else item->>'$' end as degree_type, item->>'$.institution' as institution, item->>'$.year' as year, item->>'$.end_year' as end_year
from items where list_name = 'education'""",
    "p6_societies": f"""with {WHOLE} select record_id, cast(scientist_pos as int) as scientist_pos, cast(item_pos as int) as item_pos,
 case when json_type(item) = 'OBJECT' then item->>'$.name' else item->>'$' end as name, item->>'$.since' as since from items where list_name = 'societies'""",
    "p3_found": f"""select bridge_id from institution_locations_1927 b left join ({_COUNTS}) e using (shard, institution)
where b.n_events is null or b.n_events <> coalesce(e.n_rows, 0)""",
    "p3_counts": _COUNTS,
    "p6_profile_lists": """
select profile_id, 'education' as list_name, cast(i - 1 as int) as item_pos, education[i].degree_type as label, education[i].institution as place
from (select profile_id, education, unnest(range(1, len(education) + 1)) as i from scientist_profiles) where education[i] is not null
union all
select profile_id, 'employment', cast(i - 1 as int), employment[i].position_title, employment[i].institution_org
from (select profile_id, employment, unnest(range(1, len(employment) + 1)) as i from scientist_profiles) where employment[i] is not null
union all
select profile_id, 'minor_positions', cast(i - 1 as int), minor_positions[i].position_title, minor_positions[i].institution_org
from (select profile_id, minor_positions, unnest(range(1, len(minor_positions) + 1)) as i from scientist_profiles) where minor_positions[i] is not null
union all
select profile_id, 'societies', cast(i - 1 as int), societies[i], null
from (select profile_id, societies, unnest(range(1, len(societies) + 1)) as i from scientist_profiles) where societies[i] is not null""",
    "p7_found": _CONFIRMED
    + """select profile_id, 'period' as kind, cast(a as int) as from_year, cast(b as int) as to_year from runs
union all
select profile_id, 'gap', cast(b + 1 as int), cast(nxt - 1 as int) from (select *, lead(a) over (partition by profile_id order by a) as nxt from runs) where nxt is not null""",
}
