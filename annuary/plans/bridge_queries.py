"""Queries of the location bridge, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annuary.operators import bridge as b
from annuary.plans import sql
from annuary.session import read_table


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "scientist_profiles")


def _bridge(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "institution_locations_1927")


def _replies(spark: SparkSession, d: str) -> DataFrame:
    """Replies of a classifier, made from the bridge: the kinds in turn, every seventh one not confident."""
    kinds = F.array(*[F.lit(k) for k in [*b.LOCATABLE, *b.BLANK_KINDS]])
    return _bridge(spark, d).select(
        F.col("bridge_id").alias("reply_id"),
        F.when(F.col("bridge_id") % 3 == 0, F.upper("institution")).otherwise(F.col("institution")).alias("institution"),
        F.get(kinds, (F.col("bridge_id") % 10).cast("int")).alias("kind"),
        (F.col("bridge_id") % 7 != 0).alias("confident"),
        "city", "state_region", "country",
        F.when(F.col("bridge_id") % 2 == 0, F.col("institution")).alias("resolved_name"),
    )


def entity_counts(spark, d):
    return b.institution_counts(_profiles(spark, d))


def address_votes(spark, d):
    return b.address_votes(_profiles(spark, d))


def majority_vote(spark, d):
    e = b.address_evidence(_profiles(spark, d))
    return e.withColumn("note", b.vote_note(F.col("n_top"), F.col("n_total")))


def bridge_refresh(spark, d):
    return b.refresh_bridge(_bridge(spark, d), _profiles(spark, d))


def lookup_source(spark, d):
    return b.location_lookup(_bridge(spark, d))


def enrich_left(spark, d):
    return b.apply_locations(read_table(spark, d, "career_events_1927"), b.location_lookup(_bridge(spark, d))).select("event_id", "institution_organization", *b.ENRICHED)


def location_stats(spark, d):
    return b.location_stats(_bridge(spark, d))


def propose_targets(spark, d):
    return b.propose_targets(_bridge(spark, d), min_events=1)


def accept_proposals(spark, d):
    wanted = _bridge(spark, d).where("institution is not null").select("institution").distinct()
    return b.accept_proposals(_replies(spark, d), wanted)


def merge_proposals(spark, d):
    wanted = _bridge(spark, d).where("institution is not null").select("institution").distinct()
    return b.merge_proposals(_bridge(spark, d), b.accept_proposals(_replies(spark, d), wanted))


QUERIES = {
    f.__name__: f
    for f in (entity_counts, address_votes, majority_vote, bridge_refresh, lookup_source, enrich_left, location_stats, propose_targets, accept_proposals, merge_proposals)
}

_TOK = r"list_filter(string_split_regex(regexp_replace(lower({}), '[.,;:]', ' ', 'g'), '\s+'), lambda t: t <> '')"
_GENERIC = "[" + ", ".join(map(sql.q, b.GENERIC_WORDS)) + "]"
_S = lambda x: sql.strip(f"coalesce({x}, '')")
_COUNTS = f"select {sql.strip('inst')} as institution, count(*) as n_events from ({sql.RECORDS}) where {sql.strip('inst')} <> '' group by 1"
_VOTES = f"""
with names as (select institution, {_TOK.format('institution')} as name from ({_COUNTS})),
addr as (select {_S('mailing_city')} as city, {_S('mailing_state')} as state_region, {_S('mailing_country')} as country, {_S('mailing_address')} as address from scientist_profiles),
segs as (select city, state_region, country, {_TOK.format('part')} as seg, list_concat({_TOK.format('city')}, {_TOK.format('state_region')}, {_TOK.format('country')}) as geo
  from (select *, unnest(string_split(address, ',')) as part from addr where city <> '' and address <> '')),
kept as (select city, state_region, country, seg, count(*) as votes from segs where len(seg) > 0 and len(list_filter(seg, lambda t: not list_contains(geo, t))) > 0 group by 1, 2, 3, 4),
hits as (select n.institution, n.name, k.*, (list_filter(range(0, len(seg) - len(name) + 1), lambda o: len(list_filter(range(1, len(name) + 1), lambda j: starts_with(seg[o + j], name[j]))) = len(name)))[1] as off
  from names n join (select *, unnest(list_distinct(list_transform(seg, lambda t: t[1:4]))) as block from kept) k on n.name[1][1:4] = k.block
  where len(name) > 0 and list_sum(list_transform(name, lambda t: length(t))) >= 4 and len(seg) >= len(name))
select institution, city, state_region, country, cast(sum(votes) as bigint) as votes from hits
where off is not null and len(list_filter(seg[off + len(name) + 1:], lambda t: not list_contains({_GENERIC}, t))) = 0 group by 1, 2, 3, 4"""
_EVIDENCE = f"""select institution, city, state_region, country, cast(votes as bigint) as n_top, cast(total as bigint) as n_total,
 case when votes = total then printf('auto: %d mailing address(es), unanimous', cast(total as bigint)) else printf('auto: %d of %d mailing addresses', cast(votes as bigint), cast(total as bigint)) end as note
from (select *, sum(votes) over (partition by institution) as total, row_number() over (partition by institution order by votes desc) as r from ({_VOTES})) where r = 1 and votes / total >= 0.6"""
_B = lambda x: f"coalesce({x}, '')"
BLANK = "(coalesce(city, '') = '' and coalesce(state_region, '') = '' and coalesce(country, '') = '')"
_SOURCE = f"case when starts_with({_S('notes')}, 'auto:') then 'mailing address' when starts_with({_S('notes')}, 'ai:') then 'AI' else 'hand' end"
_LOOKUP = f"""select institution, city, state_region, country, source from (
 select *, row_number() over (partition by institution order by bridge_id) as r from (
  select bridge_id, {_S('institution')} as institution, nullif({_S('city')}, '') as city, nullif({_S('state_region')}, '') as state_region, nullif({_S('country')}, '') as country, {_SOURCE} as source
  from institution_locations_1927) where city is not null or state_region is not null or country is not null) where r = 1"""
_KINDS = "[" + ", ".join(map(sql.q, [*b.LOCATABLE, *b.BLANK_KINDS])) + "]"
_LOCATABLE = ", ".join(map(sql.q, b.LOCATABLE))
_ACCEPT = f"""
with replies as (select bridge_id as reply_id, {_S("case when bridge_id % 3 = 0 then upper(institution) else institution end")} as asked, {_KINDS}[bridge_id % 10 + 1] as kind,
  bridge_id % 7 <> 0 as confident, {_S('city')} as city, {_S('state_region')} as state_region, {_S('country')} as country, {_S("case when bridge_id % 2 = 0 then institution end")} as resolved from institution_locations_1927),
wanted as (select distinct institution from institution_locations_1927 where institution is not null),
low as (select lower(institution) as low, min(institution) as near from wanted group by 1),
hit as (select r.*, coalesce(w.institution, l.near) as institution, kind in ('not_a_place', 'ambiguous') or not confident as skip, kind not in ({_LOCATABLE}) or country = '' as fail
  from replies r left join wanted w on r.asked = w.institution left join low l on lower(r.asked) = l.low)
select reply_id, institution, case when skip or fail then '' else city end as city, case when skip or fail then '' else state_region end as state_region,
 case when skip or fail then '' else country end as country,
 'ai: ' || coalesce(nullif(resolved, ''), institution) || ' | ' || kind || case when skip then ' | not filled' when fail then ' | failed check (need country + locatable kind)' else '' end as notes
from hit where institution is not null"""

ORACLE = {
    "entity_counts": _COUNTS,
    "address_votes": _VOTES,
    "majority_vote": _EVIDENCE,
    "bridge_refresh": f"""with counts as ({_COUNTS}), ev as ({_EVIDENCE}),
old as (select institution, {_B('city')} as city, {_B('state_region')} as state_region, {_B('country')} as country, {_B('notes')} as notes, {_S('institution')} as key from institution_locations_1927),
r as (select * from old union all select institution, '', '', '', '', institution from counts where institution not in (select key from old))
select r.institution, coalesce(c.n_events, 0) as n_events, case when {BLANK.replace('(city', '(r.city').replace('(state_region', '(r.state_region').replace('(country', '(r.country')} and e.n_total is not null then e.city else r.city end as city,
 case when r.city = '' and r.state_region = '' and r.country = '' and e.n_total is not null then e.state_region else r.state_region end as state_region,
 case when r.city = '' and r.state_region = '' and r.country = '' and e.n_total is not null then e.country else r.country end as country,
 case when r.city = '' and r.state_region = '' and r.country = '' and e.n_total is not null then e.note else r.notes end as notes
from r left join counts c on r.key = c.institution left join ev e on r.key = e.institution""",
    "lookup_source": _LOOKUP,
    "enrich_left": f"""select event_id, institution_organization, l.city as institution_city, l.state_region as institution_state_region, l.country as institution_country, l.source as institution_location_source
from career_events_1927 e left join ({_LOOKUP}) l on e.institution_organization = l.institution""",
    "location_stats": f"""select count(*) as n_inst, cast(sum((not blank)::int) as bigint) as n_inst_coded, cast(sum(blank::int) as bigint) as n_blank,
 cast(sum((not blank and source = 'mailing address')::int) as bigint) as n_mail_rows, cast(sum(case when not blank and source = 'mailing address' then n else 0 end) as bigint) as n_mail_events,
 cast(sum((not blank and source = 'AI')::int) as bigint) as n_ai_rows, cast(sum(case when not blank and source = 'AI' then n else 0 end) as bigint) as n_ai_events,
 cast(sum((not blank and source = 'hand')::int) as bigint) as n_hand_rows, cast(sum(case when not blank and source = 'hand' then n else 0 end) as bigint) as n_hand_events,
 printf('%.1f%% of events', cast(100.0 * sum(case when not blank then n else 0 end) / greatest(sum(n), 1) as double)) as inst_coverage,
 cast(sum(case when not blank then n else 0 end) as bigint) as located_events, cast(sum(n) as bigint) as all_events
from (select coalesce(n_events, 0) as n, {BLANK} as blank, {_SOURCE} as source from institution_locations_1927)""",
    "propose_targets": f"""select bridge_id, institution, n_events, r as ordinal, (r - 1) // 25 as batch_no from (
 select *, row_number() over (order by n_events desc, institution, bridge_id) as r from institution_locations_1927
 where {BLANK} and coalesce(n_events, 0) >= 1 and not coalesce(starts_with(notes, 'ai:'), false))""",
    "accept_proposals": _ACCEPT,
    "merge_proposals": f"""with p as (select * from (select *, row_number() over (partition by institution order by reply_id) as r from ({_ACCEPT})) where r = 1)
select b.bridge_id, b.institution, case when t then p.city else b.city end as city, case when t then p.state_region else b.state_region end as state_region,
 case when t then p.country else b.country end as country, case when t then p.notes else b.notes end as notes
from (select *, {BLANK} as t0 from institution_locations_1927) b left join p on b.institution = p.institution, lateral (select b.t0 and p.institution is not null as t)""",
}
