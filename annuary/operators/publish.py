"""Release tables: final order, codebook and headline numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuary.operators import bridge as places
from annuary.operators.panel import events_long, summary


def release_keys(df: DataFrame, *more: str) -> list[Column]:
    """By page, last and first name and the further columns; blank names sort last here."""
    keys = [F.col("source_pdf_page"), F.nullif("last_name", F.lit("")), F.nullif("first_name", F.lit("")), *[F.col(c) for c in more]]
    ties = [F.col(c) for c in ("pos", "profile_id", "kind_no", "item_pos") if c in df.columns]
    return [k.asc_nulls_last() for k in keys + ties]


def release_order(df: DataFrame, *more: str) -> DataFrame:
    return df.orderBy(*release_keys(df, *more))


def bridge_order(locations: DataFrame) -> DataFrame:
    """The most frequent institutions first."""
    return locations.orderBy(F.desc_nulls_last("n_events"), "institution")


def columns_first(df: DataFrame, front: list[str]) -> DataFrame:
    """The named columns first if they exist, then the rest as they were."""
    return df.select(*[c for c in front if c in df.columns], *[c for c in df.columns if c not in front])


def released_events(profiles: DataFrame, bridge: DataFrame) -> DataFrame:
    enriched = places.apply_locations(events_long(profiles), places.location_lookup(bridge))
    return columns_first(enriched, ["source_pdf_page", "last_name", "first_name", "scientist_name"])


def headline(profiles: DataFrame, bridge: DataFrame) -> DataFrame:
    """Scientists, starred ones, events and located events, as rows of (measure, value)."""
    people = summary(profiles).agg(F.count("*").alias("scientists"), F.sum("star_status").cast("bigint").alias("starred"))
    events = released_events(profiles, bridge)
    has = F.coalesce(*[F.col(c) for c in places.ENRICHED[:3]]).isNotNull()
    located = events.agg(F.count("*").alias("events"), F.sum(has.cast("bigint")).alias("events_with_place"))
    one = people.join(F.broadcast(located))  # one row each
    measures = ["scientists", "starred", "events", "events_with_place"]
    return one.select(F.explode(F.create_map(*[x for m in measures for x in (F.lit(m), F.col(m))])).alias("measure", "value"))


#: What the columns of the released tables mean.
DESCRIPTIONS = {
    "year": "calendar year of the row",
    "age": "year less birth year",
    "activity_confirmed": "1 if a dated record covers the year",
    "is_current_1927_role": "1 if a role of the row is current at the edition",
    "scientist_name": "Last, First without honorifics",
    "record_type": "Education, Employment or MinorPosition",
    "institution_location_source": "how the place of the institution was found",
    "birth_date": "DD.MM.YYYY, 00 for a missing part",
    "source_pdf_page": "page of the entry",
}


def codebook(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, ordinal, column_name, type, description) of the given tables."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, i, c, kind, DESCRIPTIONS.get(c, c.replace("_", " "))) for t, df in tables.items() for i, (c, kind) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, type string, description string")
