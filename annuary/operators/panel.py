"""Balanced scientist-year panel, event table and summary.

Every table is a narrow transformation of the profile rows: the arrays of a row hold all that its panel rows
need, so a year is filled by filtering them and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuary.functions.people import INVARIANTS, with_invariants
from annuary.functions.spells import EDITION_YEAR, cap_spell, confirmed_range
from annuary.functions.text import pipe_join, repair_ocr, strip
from annuary.session import spread

KINDS = {
    "deg": ("education", "degree_type", "institution", "year", "end_year", None),
    "prim": ("employment", "position_title", "institution_org", "start_year", "end_year", "is_current_position"),
    "par": ("minor_positions", "position_title", "institution_org", "start_year", "end_year", "is_current_position"),
}


def spell_array(kind: str, edition: int = EDITION_YEAR) -> Column:
    """The spells of one kind that confirm any year, in the order of their slots.

    Array of struct<rank, start, inst, role, pos, key, ...>: the first five fields are the sort key of a slot
    (print order for degrees; current first, then raw start and institution for jobs; start, institution and
    role for minor positions), key tells repeated records, a..b are the years. Null items confirm nothing.
    """
    field, role, inst, start, end, current = KINDS[kind]

    def spell(x: Column, i: Column) -> Column:
        flag = F.coalesce(x[current], F.lit(False)) if current else F.lit(False)
        name = F.coalesce(F.nullif(x[role], F.lit("")), F.lit("study")) if kind == "deg" else F.coalesce(x[role], F.lit(""))
        years = confirmed_range(x[start], x[end], flag, edition)
        shown, place = repair_ocr(name), repair_ocr(F.coalesce(x[inst], F.lit("")))
        return F.when(
            x.isNotNull() & years.isNotNull(),
            F.named_struct(
                F.lit("rank"), F.when(flag, 0).otherwise(1) if kind == "prim" else F.lit(0),
                F.lit("start"), F.lit(0) if kind == "deg" else F.coalesce(x[start], F.lit(0)),
                F.lit("inst"), F.lit("") if kind == "deg" else place,
                F.lit("role"), shown if kind == "par" else F.lit(""),
                F.lit("pos"), i,
                F.lit("key"), F.concat(strip(shown), F.lit("\u0001"), strip(place)),
                F.lit("show_role"), shown,
                F.lit("show_inst"), place,
                F.lit("cur"), flag,
                F.lit("a"), years["from_year"],
                F.lit("b"), years["to_year"],
            ),
        )

    return F.array_sort(F.filter(F.transform(F.coalesce(F.col(field), F.array()), spell), lambda s: s.isNotNull()))


def has_repeats(spells: Column) -> Column:
    return F.size(F.array_distinct(F.transform(spells, lambda s: s["key"]))) < F.size(spells)


def slots_of_year(spells: Column, repeats: Column, year: Column) -> Column:
    """The records of one year in slot order, of repeated ones the first in print.

    The spells come sorted, so a year only filters them; repeats says whether there is anything to drop.
    """
    active = F.filter(spells, lambda s: (s["a"] <= year) & (s["b"] >= year))

    def is_first(s: Column) -> Column:
        return ~F.exists(spells, lambda t: (t["a"] <= year) & (t["b"] >= year) & (t["pos"] < s["pos"]) & (t["key"] == s["key"]))

    return F.when(repeats, F.filter(active, is_first)).otherwise(active)


def panel_years(profiles: DataFrame, edition: int = EDITION_YEAR) -> DataFrame:
    """One row per profile and year from birth (or the first dated year) to the edition, with its three slot arrays.

    A profile with neither has one row whose year is null. A birth after the edition gives no row.
    """
    known = [c for c in profiles.columns if c in {"profile_id", "pos", "birth_year", *INVARIANTS}]
    spells = spread(profiles).select(*known, *[spell_array(k, edition).alias(f"_{k}") for k in KINDS])
    spells = spells.select("*", *[has_repeats(F.col(f"_{k}")).alias(f"_{k}_repeats") for k in KINDS])
    firsts = F.array_min(F.concat(*[F.transform(F.col(f"_{k}"), lambda s: s["a"]) for k in KINDS]))
    start = F.coalesce(F.col("birth_year"), firsts)
    years = F.when(start.isNull(), F.array(F.lit(None).cast("int"))).when(start <= edition, F.sequence(start, F.lit(edition))).otherwise(F.array().cast("array<int>"))
    dated = spells.withColumn("year", F.explode(years))
    return dated.select("*", *[F.when(F.col("year").isNotNull(), slots_of_year(F.col(f"_{k}"), F.col(f"_{k}_repeats"), F.col("year"))).otherwise(F.array().cast(dated.schema[f"_{k}"].dataType)).alias(k) for k in KINDS]).drop(
        *[f"_{k}{x}" for k in KINDS for x in ("", "_repeats")]
    )


def _flags() -> list[Column]:
    return [
        (F.col("year") - F.col("birth_year")).alias("age"),
        (F.size("deg") + F.size("prim") + F.size("par") > 0).cast("int").alias("activity_confirmed"),
        F.exists("prim", lambda s: s["cur"]).cast("int").alias("is_current_1927_role"),
    ]


def joined_slots(kind: str) -> Column:
    return F.array_join(F.transform(F.col(kind), lambda s: F.concat(s["show_role"], F.lit(" @ "), s["show_inst"])), " | ")


def balanced_panel(profiles: DataFrame, edition: int = EDITION_YEAR) -> DataFrame:
    """The panel with all slots of a kind in one text, in slot order; any number of slots."""
    return panel_years(profiles, edition).select(
        "profile_id", "year", *_flags(), joined_slots("deg").alias("degrees"), joined_slots("prim").alias("positions"), joined_slots("par").alias("parallel_positions")
    )


def max_concurrency(profiles: DataFrame, edition: int = EDITION_YEAR) -> DataFrame:
    """(kind, slots): the most records of a kind in any one year, years before the panel included, 1 at least.

    All kinds are measured in one pass over the rows.
    """

    def top(kind: str) -> Column:
        years = F.array_distinct(F.flatten(F.transform(F.col(kind), lambda s: F.sequence(s["a"], s["b"]))))
        return F.array_max(F.transform(years, lambda y: F.size(slots_of_year(F.col(kind), F.col(f"{kind}_repeats"), y))))

    spells = spread(profiles).select(*[spell_array(k, edition).alias(k) for k in KINDS]).select("*", *[has_repeats(F.col(k)).alias(f"{k}_repeats") for k in KINDS])
    most = spells.agg(*[F.greatest(F.coalesce(F.max(top(k)), F.lit(1)), F.lit(1)).alias(k) for k in KINDS])
    return most.select(F.explode(F.create_map(*[x for k in KINDS for x in (F.lit(k), F.col(k))])).alias("kind", "slots"))


def panel_wide(profiles: DataFrame, edition: int = EDITION_YEAR, slots: dict[str, int] | None = None) -> DataFrame:
    """The panel in its printed columns, one numbered pair per slot; blanks are ''.

    slots gives the number of slots per kind; left out, it is measured first (one small result). A record beyond
    the given number has no column here; panel_years keeps the slots of a year as arrays of any length.
    """
    if slots is None:
        slots = {r["kind"]: r["slots"] for r in max_concurrency(profiles, edition).collect()}
    names = {"deg": ("degree_earned", "degree_institution"), "prim": ("position", "institution"), "par": ("parallel_position", "parallel_institution")}

    def pairs(kind: str) -> list[Column]:
        out = []
        for i in range(slots[kind]):
            record = F.get(F.col(kind), i)
            out += [F.coalesce(record[f], F.lit("")).alias(f"{n}_{i + 1}") for f, n in zip(("show_role", "show_inst"), names[kind], strict=True)]
        return out

    rows = panel_years(with_invariants(profiles), edition)
    flags = dict(zip(("age", "activity_confirmed", "is_current_1927_role"), _flags(), strict=True))
    order = ["first_name", "last_name", "scientist_name", "title"]
    tail = ["birth_year", "birth_date", "birth_city", "birth_state", "birth_country", "star_status", "primary_department", "mailing_city", "mailing_state", "mailing_country", "research", "source_pdf_page"]
    return rows.select(
        "profile_id", "pos", "year", *order, flags["age"], flags["activity_confirmed"], *pairs("deg"), *pairs("prim"), flags["is_current_1927_role"], *pairs("par"), *tail
    )


def slots_long(profiles: DataFrame, edition: int = EDITION_YEAR) -> DataFrame:
    """(profile_id, year, kind, slot, role, institution, is_current): the panel's slots as rows, as many as there are."""

    def tagged(kind: str) -> Column:
        parts = lambda s, i: F.struct(F.lit(kind).alias("kind"), (i + 1).alias("slot"), s["show_role"].alias("role"), s["show_inst"].alias("institution"), s["cur"].alias("is_current"))
        return F.transform(F.col(kind), parts)

    rows = panel_years(profiles, edition)
    return rows.select("profile_id", "year", F.explode(F.concat(*map(tagged, KINDS))).alias("s")).select("profile_id", "year", "s.*")


def book_keys(df: DataFrame, *more: str) -> list[Column]:
    """Page, name and the further columns, nulls last, print order breaking ties."""
    keys = ["source_pdf_page", "last_name", "first_name", *more, *[c for c in ("pos", "profile_id", "kind_no", "item_pos") if c in df.columns]]
    return [F.asc_nulls_last(k) for k in keys]


def in_book_order(df: DataFrame, *more: str) -> DataFrame:
    """Sorted by page, name and the further columns, nulls last, print order breaking ties."""
    return df.orderBy(*book_keys(df, *more))


def events_long(profiles: DataFrame, edition: int = EDITION_YEAR) -> DataFrame:
    """One row per dated or undated record, spans kept whole; reversed spans stay reversed."""
    base = with_invariants(profiles).select("profile_id", "pos", "education", "employment", "minor_positions", *INVARIANTS)
    parts = None
    for no, (kind, label) in enumerate((("deg", "Education"), ("prim", "Employment"), ("par", "MinorPosition"))):
        field, role, inst, start, end, current = KINDS[kind]
        rows = base.select("*", F.posexplode(field).alias("item_pos", "x")).where("x is not null").drop("education", "employment", "minor_positions")
        x = F.col("x")
        capped = cap_spell(x[start], x[end], x[current] if current else F.lit(False), edition)
        stop = F.coalesce(F.nullif(capped["end"], F.lit(0)), capped["start"]) if kind == "deg" else capped["end"]
        title = F.coalesce(F.nullif(x[role], F.lit("")), F.lit("study")) if kind == "deg" else x[role]
        one = rows.select(
            "*",
            F.lit(no).alias("kind_no"),
            F.lit(label).alias("record_type"),
            capped["start"].alias("start_year"),
            stop.alias("end_year"),
            repair_ocr(x[inst]).alias("institution_organization"),
            repair_ocr(title).alias("role_or_degree"),
            (capped["current"] & F.lit(kind != "deg")).cast("int").alias("is_current_1927_role"),
        ).drop("x", "research")
        parts = one if parts is None else parts.unionByName(one)
    return parts


def summary(profiles: DataFrame) -> DataFrame:
    """One row per profile: invariants, counts of records and the societies."""
    degrees = F.coalesce(F.col("education"), F.array())
    typed = F.size(F.filter(degrees, lambda d: F.coalesce(d["degree_type"], F.lit("")) != ""))
    societies = F.transform(F.coalesce(F.col("societies"), F.array().cast("array<string>")), lambda s: F.coalesce(s, F.lit("")))
    return with_invariants(profiles).select(
        "profile_id",
        "pos",
        *INVARIANTS,
        typed.alias("n_degrees"),
        (F.size(degrees) - typed).alias("n_study_spells"),
        F.size(F.coalesce(F.col("employment"), F.array())).alias("n_positions"),
        F.size(F.coalesce(F.col("minor_positions"), F.array())).alias("n_parallel_positions"),
        pipe_join(F.array_join(societies, ";")).alias("societies"),
    )
