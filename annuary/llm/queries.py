"""Queries of the training-data problems, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annuary.llm import addresses, canonical, language, leakage, names, packing, survivors
from annuary.session import read_table


def p1_survivors(spark: SparkSession, d: str) -> DataFrame:
    profiles = read_table(spark, d, "scientist_profiles")
    return survivors.survivors(profiles, survivors.entry_groups(profiles))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_survivors(spark, d).where("n_rows > 1").select("group_id", "name_from", "birth_from")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return addresses.same_location(read_table(spark, d, "scientist_profiles"))


def p2_places(spark: SparkSession, d: str) -> DataFrame:
    """One row per row whose address is located, with its class and its number of links."""
    return addresses.place_classes(read_table(spark, d, "scientist_profiles"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return names.linked_rows(read_table(spark, d, "institution_locations_1927"))


def p4_organisations(spark: SparkSession, d: str) -> DataFrame:
    """One row per bridge row that names an organisation, with its class and its number of links."""
    return names.organisation_classes(read_table(spark, d, "institution_locations_1927"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.mapped_values(
        spark, read_table(spark, d, "institution_locations_1927"), read_table(spark, d, "scientist_profiles"), read_table(spark, d, "canonical_list")
    )


def p8_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed_documents(read_table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_passages(spark, d).select("doc_id", "item_id")


def p9_passages(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return language.relabelled(read_table(spark, d, "documents")).select("doc_id", "stretch_no", "lang")


def p10_stretches(spark: SparkSession, d: str) -> DataFrame:
    return language.stretches(read_table(spark, d, "documents"))


QUERIES = {
    "p1_found": p1_found,
    "p1_survivors": p1_survivors,
    "p2_found": p2_found,
    "p2_places": p2_places,
    "p4_found": p4_found,
    "p4_organisations": p4_organisations,
    "p5_found": p5_found,
    "p8_packing": p8_packing,
    "p9_found": p9_found,
    "p9_passages": p9_passages,
    "p10_found": p10_found,
    "p10_stretches": p10_stretches,
}

ORACLE: dict[str, str] = {}
