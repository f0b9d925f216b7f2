"""Dated spells: inclusive year pairs, never interpolated and never past the edition year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EDITION_YEAR = 1927


def cap_spell(start: Column, end: Column, current: Column, edition: int = EDITION_YEAR) -> Column:
    """struct<start, end, current> that holds nothing dated after the edition.

    An end past the edition is clipped when the spell had begun by then and dropped otherwise; a spell that
    lies wholly in the future loses its current flag too. Null years stay null, a null flag counts as false.
    """
    current = F.coalesce(current, F.lit(False))
    begun = F.coalesce(start <= edition, F.lit(False))
    late_end = F.coalesce(end > edition, F.lit(False))
    future_only = (
        ~begun
        & (end.isNull() | late_end)
        & (start.isNotNull() | end.isNotNull())
    )
    return F.struct(
        F.when(begun, start).alias("start"),
        F.when(~late_end, end).when(begun, F.lit(edition)).alias("end"),
        (current & ~future_only).alias("current"),
    )


def confirmed_range(start: Column, end: Column, current: Column, edition: int = EDITION_YEAR) -> Column:
    """struct<from_year, to_year> of the years a spell vouches for, or null if it vouches for none.

    Both years: the inclusive range, swapped if reversed. Start only: that year, up to the edition if
    current. End only: that year. Undated: the edition year if current.
    """
    capped = cap_spell(start, end, current, edition)
    s, e, now = capped["start"], capped["end"], capped["current"]
    low = F.when(s.isNotNull() & e.isNotNull(), F.least(s, e)).otherwise(F.coalesce(s, e, F.when(now, F.lit(edition))))
    high = F.when(s.isNotNull() & e.isNotNull(), F.greatest(s, e)).otherwise(
        F.when(s.isNotNull() & now, F.lit(edition)).otherwise(low)
    )
    return F.when(low.isNotNull(), F.struct(low.alias("from_year"), high.alias("to_year")))


def confirmed_years(start: Column, end: Column, current: Column, edition: int = EDITION_YEAR) -> Column:
    """Array of the confirmed years, empty if there are none."""
    r = confirmed_range(start, end, current, edition)
    return F.when(r.isNotNull(), F.sequence(r["from_year"], r["to_year"])).otherwise(F.array().cast("array<int>"))


def span_text(start: Column, end: Column, current: Column) -> Column:
    """'a-b', 'a', 'a-' for a current spell, 'b' or 'undated'; year 0 counts as missing."""
    s = F.when(start != 0, start)
    e = F.when(end != 0, end)
    return (
        F.when(s.isNotNull() & e.isNotNull() & (s != e), F.format_string("%d-%d", s, e))
        .when(s.isNotNull() & e.isNotNull(), s.cast("string"))
        .when(s.isNotNull(), F.concat(s.cast("string"), F.when(current, "-").otherwise("")))
        .when(e.isNotNull(), e.cast("string"))
        .otherwise(F.lit("undated"))
    )
