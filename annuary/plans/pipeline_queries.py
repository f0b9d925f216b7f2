"""Queries of sources, passes, batches, releases and streams, and their SQL."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annuary import api
from annuary.operators import batch, checks, ocr, panel, publish, resolve, review
from annuary.plans import bridge_queries, check_queries, panel_queries, problems, sql
from annuary.session import numbered, read_table
from annuary.sources import files
from annuary.streaming import tables as streams


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "scientist_profiles")


def _records(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "page_records")


def completed_pages(spark, d):
    return files.completed_pages(_records(spark, d))


def anti_remaining(spark, d):
    pages = _profiles(spark, d).select(F.col("source_page").alias("page"))
    return files.remaining_pages(pages, files.completed_pages(_records(spark, d)))


def batch_outcomes(spark, d):
    return batch.decode(_records(spark, d).where("via = 'batch'")).drop("text")


def batch_texts(spark, d):
    decoded = batch.decode(_records(spark, d).where("via = 'batch'"))
    return decoded.select("record_id", F.length("text").cast("bigint").alias("n_chars"), F.md5(batch.json_part(F.col("text"))).alias("json_md5"))


def dead_letters(spark, d):
    return batch.dead_letters(batch.decode(_records(spark, d).where("via = 'batch'")))


def batch_progress(spark, d):
    return batch.progress(batch.decode(_records(spark, d).where("via = 'batch'")))


def request_ids(spark, d):
    r = _records(spark, d).select("record_id", batch.request_id(F.col("focus_page_number")).alias("custom_id"))
    return r.withColumn("page", batch.page_of_request(F.col("custom_id")))


def request_lines(spark, d):
    return batch.request_lines(_profiles(spark, d).select(F.col("source_page").alias("page")), "small", "low")


def ingest_profiles(spark, d):
    """The profiles of the raw page records, with their loose years, lists and texts read."""
    p = files.profiles_of(files.passes_of(_records(spark, d)))
    line = lambda c, *fields: F.array_join(F.transform(c, lambda x: F.concat_ws(":", *[F.coalesce(x[f].cast("string"), F.lit("-")) for f in fields])), "|")
    post = ("position_title", "start_year", "end_year", "is_current_position")
    return p.select(
        "record_id", "pos", "pass_no", "full_name", "department", "mailing_address", "star_status", "birth_date", "birth_year",
        line("education", "degree_type", "institution", "year", "end_year").alias("education"), line("employment", *post).alias("employment"),
        line("minor_positions", *post).alias("minor_positions"), F.array_join("societies", "|").alias("societies"),
    )


def ingest_panel(spark, d):
    """From the raw page records to the panel, every pass by itself."""
    return panel.balanced_panel(files.profiles_of(files.passes_of(_records(spark, d))))


def log_to_tables(spark, d):
    """From the raw page records to all tables, passes merged and repaired: rows and different pages of each."""
    tables = api.tables_from_log(files.passes_of(_records(spark, d)), ocr.page_text(read_table(spark, d, "documents")))
    page = {"profiles": "source_page", "findings": "page", "review": "page"}
    parts = [t.agg(F.count("*").alias("n_rows"), F.countDistinct(page.get(name, "source_pdf_page")).alias("n_pages")).select(F.lit(name).alias("table_name"), "n_rows", "n_pages") for name, t in tables.items()]
    return functools.reduce(DataFrame.unionByName, parts)


def page_progress(spark, d):
    return files.numbered_pages(_records(spark, d).select(F.col("focus_page_number").alias("page")))


def review_book_order(spark, d):
    view = review.review_view(_profiles(spark, d), checks.all_findings(_profiles(spark, d))).select("profile_id", "page", "pass_no", "pos", "row_severity")
    return numbered(view, [F.coalesce(review.page_of("page"), F.lit(0)).asc(), F.asc("pass_no"), F.asc("pos"), F.asc("profile_id")])


def release_sheets(spark, d):
    """The located and the blank institutions in their order."""
    tables = api.publish_release(_profiles(spark, d), read_table(spark, d, "institution_locations_1927"))
    order = [F.desc_nulls_last("n_events"), F.asc("institution"), F.asc("bridge_id")]
    return functools.reduce(DataFrame.unionByName, [numbered(tables[s], order).select(F.lit(s).alias("sheet"), "ordinal", "bridge_id", "institution", "n_events") for s in ("located", "blank")])


def merged_profiles(spark, d):
    """What the union of passes leaves, repaired: profile_id, place in print and birth fields."""
    out = api.merged_profiles(_profiles(spark, d), ocr.page_text(read_table(spark, d, "documents")))
    return out.select("profile_id", "source_page", "pos", "full_name", "birth_date", "birth_year", "repair_note")


def cost_rollup(spark, d):
    usage = F.from_json("raw_json", batch.ENVELOPE)["usage"]
    models = F.array(*[F.lit(m) for m in [*batch.RATES, "other"]])
    calls = _records(spark, d).select("record_id", "via", usage.alias("u")).where("u is not null and u.input_tokens is not null")
    calls = calls.select(
        F.get(models, (F.col("record_id") % 4).cast("int")).alias("model"),
        F.col("u.input_tokens").alias("input_tokens"), F.col("u.cached_input_tokens").alias("cached_tokens"), F.col("u.output_tokens").alias("output_tokens"),
        (F.col("record_id") % 2 == 0).alias("batch"),
    )
    return batch.cost_rollup(calls, 1110)


def shard_pack(spark, d):
    requests = _records(spark, d).select(F.col("record_id").alias("request_no"), F.octet_length("raw_json").cast("bigint").alias("bytes"))
    return batch.pack_requests(requests, max_bytes=100_000, max_requests=10)


def fuzzy_pass_merge(spark, d):
    return resolve.merge_passes(_profiles(spark, d))


def fuzzy_pass_merge_confirmed(spark, d):
    return resolve.merge_passes(_profiles(spark, d), ocr.page_text(read_table(spark, d, "documents")))


def richness(spark, d):
    p = _profiles(spark, d)
    return p.select("profile_id", resolve.richness(p).alias("richness"))


def close_match(spark, d):
    entries = [r["entry"] for r in read_table(spark, d, "canonical_list").where("list_name = 'department'").select("entry").collect()]  # a closed list of subjects
    return resolve.close_matches(_profiles(spark, d).select(F.col("department").alias("word")), entries)


def release_events(spark, d):
    events = publish.released_events(_profiles(spark, d), read_table(spark, d, "institution_locations_1927"))
    return events.drop("pos", "kind_no")


def release_book_order(spark, d):
    """The place of every released event in the order of the release."""
    events = publish.released_events(_profiles(spark, d), read_table(spark, d, "institution_locations_1927"))
    return numbered(events, publish.release_keys(events, "start_year", "record_type")).select("profile_id", "record_type", "item_pos", "institution_city", "ordinal")


def headline_stats(spark, d):
    return publish.headline(_profiles(spark, d), read_table(spark, d, "institution_locations_1927"))


def codebook(spark, d):
    return publish.codebook({"events": panel_queries.events_long(spark, d), "summary": panel_queries.profile_summary(spark, d)})


def stream_repage(spark, d):
    path = f"{d}/page_records.parquet"
    return streams.drain(streams.latest_passes(streams.stream_of(spark, path, spark.read.parquet(path).schema)), ["focus_page_number"])


def stream_event_windows(spark, d):
    path = f"{d}/events.parquet"
    return streams.drain(streams.windowed_counts(streams.stream_of(spark, path, spark.read.parquet(path).schema)), ["window_start", "event_type"])


QUERIES = {
    f.__name__: f
    for f in (
        ingest_profiles, ingest_panel, log_to_tables, page_progress, review_book_order, release_sheets, completed_pages, anti_remaining, batch_outcomes, batch_texts, dead_letters, batch_progress, request_ids, request_lines, merged_profiles, cost_rollup, shard_pack, fuzzy_pass_merge,
        fuzzy_pass_merge_confirmed, richness, close_match, release_events, release_book_order, headline_stats, codebook, stream_repage, stream_event_windows,
    )
}

_J = "(select *, case when json_valid(raw_json) then cast(raw_json as json) end as j from page_records where via = 'batch')"
_TEXT = "coalesce(array_to_string(list_transform(list_filter(json_extract(j, '$.response.body.output[*].content[*]'), lambda p: p->>'$.type' = 'output_text'), lambda p: coalesce(p->>'$.text', '')), ''), '')"
_PART = r"nullif(regexp_extract(text, '(?s)\{.*\}', 0), '')"
_USE = "coalesce(cast(j->>'$.response.body.usage.{}' as bigint), 0)"
_DECODED = f"""select record_id, coalesce(try_cast(split_part(j->>'$.custom_id', '-', -1) as int), try_cast(j->>'$.focus_page_number' as int)) as page,
 case when j is null then 'corrupt' when j->>'$.error' is not null or coalesce(j->>'$.response.status_code', '') <> '200' then 'error'
  when j->>'$.response.body.incomplete_details.reason' = 'max_output_tokens' then 'truncated' when trim(text) = '' then 'empty'
  when not coalesce(json_valid({_PART}), false) then 'unparseable' else 'ok' end as outcome, text,
 list_filter(json_extract(j, '$.response.body.output[*].content[*]'), lambda p: p->>'$.type' = 'refusal')[1]->>'$.refusal' as refusal,
 {_USE.format('input_tokens')} as input_tokens, {_USE.format('output_tokens')} as output_tokens, {_USE.format('input_tokens_details.cached_tokens')} as cached_tokens,
 {_USE.format('output_tokens_details.reasoning_tokens')} as reasoning_tokens
from (select *, {_TEXT} as text from {_J})"""
_MODELS = "['large', 'medium', 'small', 'other']"
_RATE = "case model " + " ".join(f"when '{m}' then ((input_tokens - cached_tokens) * {a} + cached_tokens * {b} + output_tokens * {c}) / 1e6" for m, (a, b, c) in batch.RATES.items()) + " else 0.0 end * case when batch then 0.5 else 1.0 end"
_RELEASED = f"""select e.*, l.city as institution_city, l.state_region as institution_state_region, l.country as institution_country, l.source as institution_location_source
from ({panel_queries.ORACLE['events_long']}) e left join ({bridge_queries.ORACLE['lookup_source']}) l on e.institution_organization = l.institution"""

_YEAR = lambda x: f"case when json_type({x}) = 'VARCHAR' then {sql.coerce_year(f"({x})->>'$'")} else try_cast(trunc(try_cast(({x})->>'$' as double)) as int) end"
_LIST = lambda f: f"list_filter(case json_type(s, '$.{f}') when 'ARRAY' then json_extract(s, '$.{f}[*]') when 'NULL' then null else [json_extract(s, '$.{f}')] end, lambda x: json_type(x) <> 'NULL')"
_BARE = lambda f: f"case when json_type(x) = 'OBJECT' then x->>'$.{f}' else x->>'$' end"
_DEGREES_OF = f"list_transform({_LIST('education')}, lambda x: struct_pack(degree_type := {_BARE('degree_type')}, institution := x->>'$.institution', year := {_YEAR("json_extract(x, '$.year')")}, end_year := {_YEAR("json_extract(x, '$.end_year')")}))"
_POSTS_OF = lambda f: f"list_transform({_LIST(f)}, lambda x: struct_pack(position_title := {_BARE('position_title')}, institution_org := x->>'$.institution_org', start_year := {_YEAR("json_extract(x, '$.start_year')")}, end_year := {_YEAR("json_extract(x, '$.end_year')")}, is_current_position := coalesce(try_cast(x->>'$.is_current_position' as boolean), false)))"
_SOCIETIES = f"list_transform({_LIST('societies')}, lambda x: case when json_type(x) = 'OBJECT' then array_to_string(list_filter(list_transform(list_sort(json_keys(x)), lambda k: json_extract_string(x, '$.' || k)), lambda v: v not in ('', '0', 'false')), '; ') else x->>'$' end)"
#: The profiles of page_records as a table like scientist_profiles.
_INGESTED = f"""{problems.WHOLE},
attempts as (select record_id, focus_page_number as page, row_number() over (partition by focus_page_number order by received_at, pass_no, record_id) as pass_no from page_records where status = 'ok' and focus_page_number is not null),
ingested as (select record_id, page * 4294967296 + pass_no * 65536 + scientist_pos as profile_id, page as source_page, cast(scientist_pos as int) as pos, cast(pass_no as int) as pass_no,
 s->>'$.full_name' as full_name, s->>'$.department' as department, s->>'$.mailing_address' as mailing_address, coalesce(try_cast(s->>'$.star_status' as boolean), false) as star_status, s->>'$.birth_date' as birth_date,
 {_YEAR("json_extract(s, '$.birth_year')")} as birth_year, {_DEGREES_OF} as education, {_POSTS_OF('employment')} as employment, nullif({_POSTS_OF('minor_positions')}, []) as minor_positions, {_SOCIETIES} as societies
 from scientists join attempts using (record_id) where json_type(s) = 'OBJECT')"""
_LINE = lambda c, *fs: f"array_to_string(list_transform({c}, lambda x: " + " || ':' || ".join(f"coalesce(cast(x.{f} as varchar), '-')" for f in fs) + "), '|')"
_POST_LINE = ("position_title", "start_year", "end_year", "is_current_position")

ORACLE = {
    "ingest_profiles": f"""with {_INGESTED} select record_id, pos, pass_no, full_name, department, mailing_address, star_status, birth_date, birth_year, {_LINE('education', 'degree_type', 'institution', 'year', 'end_year')} as education,
 {_LINE('employment', *_POST_LINE)} as employment, {_LINE('minor_positions', *_POST_LINE)} as minor_positions, array_to_string(societies, '|') as societies from ingested""",
    "ingest_panel": f"with {_INGESTED}, scientist_profiles as (select * from ingested), " + panel_queries.ORACLE["balanced_panel"].strip().removeprefix("with "),
    "page_progress": "select page, printf('[%d/%d]', row_number() over (order by page), count(*) over ()) as progress from (select distinct focus_page_number as page from page_records)",
    "review_book_order": f"""select profile_id, page, s.pass_no, s.pos, row_severity, row_number() over (order by coalesce(page, 0), s.pass_no, s.pos, profile_id) as ordinal
from ({check_queries.ORACLE['review_view']}) v join (select profile_id, pass_no, pos from scientist_profiles) s using (profile_id)""",
    "release_sheets": f"""select sheet, row_number() over (partition by sheet order by n_events desc nulls last, institution nulls first, bridge_id) as ordinal, bridge_id, institution, n_events
from (select *, case when {bridge_queries.BLANK} then 'blank' else 'located' end as sheet from institution_locations_1927)""",
    "completed_pages": "select distinct focus_page_number as page from page_records where status = 'ok'",
    "anti_remaining": "select distinct source_page as page from scientist_profiles s where not exists (select 1 from page_records p where p.status = 'ok' and p.focus_page_number = s.source_page)",
    "batch_outcomes": f"select * exclude (text) from ({_DECODED})",
    "batch_texts": f"select record_id, cast(length(text) as bigint) as n_chars, md5({_PART}) as json_md5 from ({_DECODED})",
    "dead_letters": f"select record_id, page, outcome, refusal from ({_DECODED}) where outcome <> 'ok'",
    "batch_progress": f"select printf('%d/%d done, %d failed', cast(sum((outcome = 'ok')::int) as bigint), count(*), count(*) - cast(sum((outcome = 'ok')::int) as bigint)) as progress from ({_DECODED})",
    "request_ids": "select record_id, printf('page-%05d', focus_page_number) as custom_id, focus_page_number as page from page_records",
    "request_lines": """with p as (select distinct source_page as page from scientist_profiles)
select a.page, '{"custom_id":"' || printf('page-%05d', a.page) || '","method":"POST","body":{"model":"small","effort":"low","pages":[' || a.page || case when b.page is not null then ',' || b.page else '' end || ']}}' as line
from p a left join p b on b.page = a.page + 1""",
    "cost_rollup": f"""select model, count(*) as n_calls, cast(sum(input_tokens) as bigint) as input_tokens, cast(sum(output_tokens) as bigint) as output_tokens, round(sum(usd), 4) as usd, round(avg(usd), 4) as usd_per_call, round(avg(usd) * 1110, 2) as usd_all
from (select *, cast({_RATE} as double) as usd from (select {_MODELS}[record_id % 4 + 1] as model, cast(j->>'$.usage.input_tokens' as bigint) as input_tokens, cast(j->>'$.usage.cached_input_tokens' as bigint) as cached_tokens,
 cast(j->>'$.usage.output_tokens' as bigint) as output_tokens, record_id % 2 = 0 as batch
 from (select record_id, case when json_valid(raw_json) then cast(raw_json as json) end as j from page_records)) where input_tokens is not null) group by 1""",
    "shard_pack": """with recursive r as (select record_id as request_no, octet_length(encode(raw_json)) as n, row_number() over (order by record_id) as i from page_records),
f(i, request_no, size, cnt, file_no) as (
 select i, request_no, n, 1, 1 from r where i = 1
 union all
 select r.i, r.request_no, case when f.size + r.n > 100000 or f.cnt >= 10 then r.n else f.size + r.n end, case when f.size + r.n > 100000 or f.cnt >= 10 then 1 else f.cnt + 1 end,
  case when f.size + r.n > 100000 or f.cnt >= 10 then f.file_no + 1 else f.file_no end from f join r on r.i = f.i + 1)
select request_no, cast(file_no as bigint) as file_no from f""",
    "richness": "select profile_id, cast(coalesce(star_status, false)::int + (coalesce(birth_year, 0) <> 0)::int + " + " + ".join(f"(coalesce({c}, '') <> '')::int" for c in resolve.SCALARS) + " + " + " + ".join(f"coalesce(len({c}), 0)" for c in resolve.LISTS) + " as int) as richness from scientist_profiles",
    "release_events": _RELEASED,
    "release_book_order": f"""select profile_id, record_type, item_pos, institution_city, row_number() over (order by source_pdf_page nulls last, nullif(last_name, '') nulls last, nullif(first_name, '') nulls last, start_year nulls last, record_type nulls last,
 pos, profile_id, case record_type when 'Education' then 0 when 'Employment' then 1 else 2 end, item_pos) as ordinal from ({_RELEASED}) r join (select profile_id, pos from scientist_profiles) using (profile_id)""",
    "headline_stats": f"""with e as ({_RELEASED}) select 'scientists' as measure, count(*) as value from scientist_profiles union all select 'starred', cast(sum(coalesce(star_status, false)::int) as bigint) from scientist_profiles
union all select 'events', count(*) from e union all select 'events_with_place', count(*) from e where coalesce(institution_city, institution_state_region, institution_country) is not null""",
    "stream_repage": "select focus_page_number, count(*) as n_passes, arg_max(record_id, (received_at, record_id)) as last_record from page_records where status = 'ok' group by 1",
    "stream_event_windows": "select cast(date_trunc('day', ts) as timestamp) as window_start, event_type, count(*) as n, round(sum(value), 2) as value from events group by 1, 2",
}
