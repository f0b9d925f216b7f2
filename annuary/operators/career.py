"""Career time line of a profile row: confirmed periods and the gaps between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annuary.functions.spells import EDITION_YEAR, confirmed_range
from annuary.operators.intervals import periods_and_gaps


def confirmed_intervals(profiles: DataFrame, edition: int = EDITION_YEAR) -> DataFrame:
    """(profile_id, from_year, to_year) of every degree, job and minor position that confirms any year."""
    empty = F.array().cast("array<struct<from_year:int,to_year:int>>")
    no = F.lit(False)

    def ranges(field: str, start: str, end: str, current: str | None):
        return F.coalesce(
            F.transform(F.col(field), lambda x: confirmed_range(x[start], x[end], x[current] if current else no, edition)), empty
        )

    every = F.concat(
        ranges("education", "year", "end_year", None),
        ranges("employment", "start_year", "end_year", "is_current_position"),
        ranges("minor_positions", "start_year", "end_year", "is_current_position"),
    )
    kept = F.array_distinct(F.filter(every, lambda x: x.isNotNull()))
    return profiles.select("profile_id", F.explode(kept).alias("r")).select("profile_id", "r.from_year", "r.to_year")


def career_timeline(profiles: DataFrame, edition: int = EDITION_YEAR) -> DataFrame:
    """(profile_id, kind, from_year, to_year): 'period' rows and the 'gap' rows between successive periods.

    Null or empty lists, null items and undated records confirm nothing; a profile without any confirmed year
    has no rows.
    """
    out = periods_and_gaps(confirmed_intervals(profiles, edition), "profile_id", "from_year", "to_year")
    return out.select("profile_id", "kind", F.col("start").cast("int").alias("from_year"), F.col("stop").cast("int").alias("to_year"))
