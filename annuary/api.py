"""The functions a user calls, one for each command of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annuary.functions.spells import EDITION_YEAR
from annuary.operators import batch, bridge, checks, ocr, panel, publish, resolve, review
from annuary.session import cut_lineage
from annuary.sources import files

build_panel = panel.panel_wide
build_events = panel.events_long
build_summary = panel.summary
merge_passes = resolve.merge_passes
decode_batch_results = batch.decode
pack_shards = batch.pack_requests
address_evidence = bridge.address_evidence
refresh_bridge = bridge.refresh_bridge
accept_proposals = bridge.accept_proposals
apply_locations = bridge.apply_locations
review_view = review.review_view


def merged_profiles(profiles: DataFrame, page_text: DataFrame | None = None) -> DataFrame:
    """The rows that survive the union of passes, at their place in print, birth fields repaired if there is page text."""
    kept = resolve.merge_passes(profiles, page_text)
    rows = profiles.drop("pos", "source_page").join(kept.withColumnRenamed("ordinal", "pos"), "profile_id")
    return rows if page_text is None else ocr.repair_birth_fields(rows, page_text)


def profiles_from_log(passes: DataFrame, page_text: DataFrame | None = None) -> DataFrame:
    """The profiles of a pass log (files.read_passes or files.passes_of): typed, passes merged, repaired if there is page text."""
    return merged_profiles(cut_lineage(files.profiles_of(passes)), page_text)


def tables_from_log(passes: DataFrame, page_text: DataFrame | None = None, edition: int = EDITION_YEAR) -> dict[str, DataFrame]:
    """From a pass log to all tables in one call: profiles, panel, events, summary, findings and the review sheet."""
    profiles = cut_lineage(profiles_from_log(passes, page_text))  # all of them read it
    findings = cut_lineage(run_checks(profiles, page_text))
    return {
        "profiles": profiles.orderBy("source_page", "pos"),
        "panel": panel.in_book_order(panel.panel_wide(profiles, edition), "year"),
        "events": panel.in_book_order(panel.events_long(profiles, edition), "start_year", "record_type"),
        "summary": panel.in_book_order(panel.summary(profiles)),
        "findings": checks.ordered(findings),
        "review": review.review_order(review.review_view(profiles, findings)),
    }


def run_checks(profiles: DataFrame, page_text: DataFrame | None = None, first_page: int | None = None, last_page: int | None = None) -> DataFrame:
    """All findings. The pages are restricted before the checks of order and yield; repairs come first and are findings."""
    rows = profiles
    if first_page is not None:
        rows = rows.where(F.col("source_page") >= first_page)
    if last_page is not None:
        rows = rows.where(F.col("source_page") <= last_page)
    if page_text is None:
        return checks.all_findings(rows)
    fixed = cut_lineage(ocr.repair_birth_fields(rows, page_text))  # every rule reads it
    notes = fixed.where("repair_note <> ''").select(
        F.lit("warn").alias("severity"), F.lit("birth_field_repaired").alias("code"), F.col("source_page").alias("page"), F.coalesce("full_name", F.lit("")).alias("scientist"), F.col("repair_note").alias("detail")
    )
    text = ocr.text_findings(fixed, page_text, checks.alpha_window(fixed))
    return checks.all_findings(fixed).unionByName(notes).unionByName(text)


def publish_release(profiles: DataFrame, locations: DataFrame, edition: int = EDITION_YEAR) -> dict[str, DataFrame]:
    """The released tables by name, sorted, with their codebook and headline numbers.

    located and blank are the two sheets of the locations. locations may be a text table as it was read.
    """
    locations = files.typed_columns(locations, ["n_events"])
    tables = {
        "scientists": publish.release_order(panel.summary(profiles)),
        "panel": publish.release_order(panel.panel_wide(profiles, edition), "year"),
        "events": publish.release_order(publish.released_events(profiles, locations), "start_year", "record_type"),
        "locations": publish.bridge_order(locations),
        "located": publish.bridge_order(locations.where(~bridge.no_place())),
        "blank": publish.bridge_order(locations.where(bridge.no_place())),
    }
    return tables | {"codebook": publish.codebook(tables), "headline": publish.headline(profiles, locations)}
