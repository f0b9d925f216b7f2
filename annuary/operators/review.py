"""Views for checking by hand, group breaks and first-of-its-kind rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annuary.functions.spells import span_text
from annuary.operators.checks import flags_of_profiles


def _filled(c: Column, other: str) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(other))


def degree_lines(field: str = "education") -> Column:
    """One line per degree: kind, institution, years."""
    rows = F.filter(F.coalesce(F.col(field), F.array()), lambda x: x.isNotNull())
    return F.array_join(
        F.transform(rows, lambda x: F.concat(_filled(x["degree_type"], "study"), F.lit(", "), _filled(x["institution"], "?"), F.lit(", "), span_text(x["year"], x["end_year"], F.lit(False)))), "\n"
    )


def position_lines(field: str) -> Column:
    """One line per position: title, organisation if there is one, years, and a mark for a current one."""

    def line(x: Column) -> Column:
        now = F.coalesce(x["is_current_position"], F.lit(False))
        org = F.when(F.coalesce(x["institution_org"], F.lit("")) != "", F.concat(F.lit(", "), x["institution_org"])).otherwise("")
        return F.concat(_filled(x["position_title"], "?"), org, F.lit(", "), span_text(x["start_year"], x["end_year"], now), F.when(now, "  [current 1927]").otherwise(""))

    return F.array_join(F.transform(F.filter(F.coalesce(F.col(field), F.array()), lambda x: x.isNotNull()), line), "\n")


def review_view(profiles: DataFrame, findings: DataFrame) -> DataFrame:
    """The rows of the review sheet, with the flags of each profile and the tint of its worst one."""
    flags = flags_of_profiles(profiles, findings).groupBy("profile_id").agg(F.array_join(F.sort_array(F.collect_list("flag")), "\n").alias("flags"), F.max(F.col("flag").startswith("ERROR")).alias("bad"))
    rows = profiles.select(
        "profile_id",
        F.col("source_page").alias("page"),
        "pass_no", "pos",
        "full_name",
        F.when(F.col("star_status"), "*").otherwise("").alias("star"),
        "titles", "mailing_address", "mailing_city", "mailing_state", "mailing_country", "department", "birth_place", "birth_date", "birth_year",
        degree_lines().alias("degrees"),
        position_lines("employment").alias("career"),
        position_lines("minor_positions").alias("minor"),
        F.array_join(F.coalesce(F.col("societies"), F.array().cast("array<string>")), "\n").alias("societies"),
        "research_accomplished", "research_in_progress",
    )
    joined = rows.join(flags, "profile_id", "left")
    return joined.withColumn("row_severity", F.when(F.col("bad"), "error").when(F.col("flags").isNotNull(), "warn").otherwise("")).withColumn("flags", F.coalesce("flags", F.lit(""))).drop("bad")


def page_of(*columns: str) -> Column:
    """The first page number that is there; 0 counts as missing."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit(0)) for c in columns])


def review_order(view: DataFrame) -> DataFrame:
    """The sheet by page, rows without one first, in print order within it."""
    return view.orderBy(F.coalesce(page_of("page"), F.lit(0)), "pass_no", "pos", "profile_id")


def group_breaks(rows: DataFrame, group: list[str], within: str, order: list[str]) -> DataFrame:
    """Rows with a flag at each change of the group columns along the order, except at the very first row.

    Changes are looked for inside parts of the column `within`, which must come first in the order; the first
    row of each part but the smallest is a break too.
    """
    w = Window.partitionBy(within).orderBy(*order)
    smallest = rows.agg(F.min(within).alias("_first"))
    prev = F.lag(F.struct(*group)).over(w)
    flagged = rows.withColumn("_prev", prev).withColumn("_me", F.struct(*group)).join(F.broadcast(smallest))  # one row
    first_row = F.col("_prev").isNull()
    return flagged.withColumn("is_break", F.when(first_row, F.col(within) != F.col("_first")).otherwise(~F.col("_me").eqNullSafe(F.col("_prev")))).drop("_prev", "_me", "_first")


def first_of_each(rows: DataFrame, keys: dict[str, Column], order: list[str]) -> DataFrame:
    """The first row by the given order of every combination of keys, as one aggregation with map-side combining."""
    best = rows.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(F.min(F.struct(*order, F.struct(*rows.columns).alias("_row"))).alias("_m"))
    return best.select("_m._row.*")
