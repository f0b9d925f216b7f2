"""Names, places, dates and years of printed entries, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annuary.functions.text import collapse, first_filled, pipe_join, strip

#: Honorifics that may stand before a given name.
HONORIFIC = r"(?:Dr|Prof|Gen|Col|Maj|Capt|Lieut|Lt|Rev|Hon|Sir|Mr|Mrs|Miss|Ms|Judge|Sen|Gov|Pres|Adm|Cmdr|Bp|Rt\.?\s*Rev)"
#: Titles dropped from comparison keys; without a right boundary, so the start of a name may go too.
KEY_TITLE = r"(?i)\b(?:Dr|Prof|Mr|Mrs|Miss|Dean|Rev|Gen|Col|Capt|Sir)\.?\s*"
#: Canadian regions that infer a country.
CANADIAN = ["que", "ont", "b.c", "bc", "man", "sask", "alta", "n.s", "n.b", "p.e.i"]
#: Months by their first three letters.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
#: The 'City, State' tail of an address.
ADDRESS_TAIL = r"([A-Za-z][A-Za-z .'&/-]*,\s*[A-Za-z][A-Za-z. ]*?)\.?\s*$"


def strip_honorifics(c: Column) -> Column:
    """Leading honorifics are removed, stacked ones too; each needs white space after it."""
    return strip(F.regexp_replace(c, rf"(?i)^(?:\s*{HONORIFIC}\.?\s+)+", ""))


def clean_name(full_name: Column) -> Column:
    return collapse(F.coalesce(full_name, F.lit("")))


def _last(name: Column) -> Column:
    return F.when(name.contains(","), strip(F.substring_index(name, ",", 1))).otherwise(F.lit(""))


def last_name(full_name: Column) -> Column:
    """What stands before the first comma; '' for a name without one."""
    return _last(clean_name(full_name))


def after_comma(name: Column) -> Column:
    return F.regexp_extract(name, r"^[^,]*,(.*)$", 1)


def _first(name: Column) -> Column:
    return strip_honorifics(F.when(name.contains(","), strip(after_comma(name))).otherwise(name))


def first_name(full_name: Column) -> Column:
    """What follows the first comma, or the whole of a name without one, honorifics removed."""
    return _first(clean_name(full_name))


def display_name(full_name: Column) -> Column:
    """'Last, First' without honorifics, or whichever there is."""
    return _display(last_name(full_name), first_name(full_name), full_name)


def _display(last: Column, first: Column, full_name: Column) -> Column:
    return F.when((last != "") & (first != ""), F.concat(last, F.lit(", "), first)).otherwise(
        F.coalesce(F.nullif(first, F.lit("")), F.nullif(last, F.lit("")), strip(F.coalesce(full_name, F.lit(""))))
    )


def title(titles: Column, full_name: Column) -> Column:
    """The recorded title, else the first honorific left inside the name, else null."""
    return _title(titles, clean_name(full_name))


def _title(titles: Column, name: Column) -> Column:
    given = F.when(name.contains(","), after_comma(name)).otherwise(name)
    found = strip(F.regexp_extract(given, rf"(?i)^\s*{HONORIFIC}\.?\s+", 0))
    return F.coalesce(F.nullif(titles, F.lit("")), F.nullif(found, F.lit("")))


def surname(full_name: Column) -> Column:
    return strip(F.substring_index(F.coalesce(full_name, F.lit("")), ",", 1))


def name_key(full_name: Column) -> Column:
    """Letters of the whole name in lower case, without annotations of several words and without titles."""
    bare = F.regexp_replace(F.coalesce(full_name, F.lit("")), r"\([^)]*\s[^)]*\)", "")
    return F.regexp_replace(F.lower(F.regexp_replace(bare, KEY_TITLE, "")), "[^a-z]", "")


def given_initials(full_name: Column) -> Column:
    """The first two initials of the given names."""
    given = F.when(full_name.contains(","), after_comma(F.regexp_replace(full_name, r"\n", " "))).otherwise(F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(given, F.lit("")), r"\(.*?\)", ""), KEY_TITLE, "")
    return F.lower(F.array_join(F.slice(F.regexp_extract_all(bare, F.lit(r"([A-Za-z])\w*"), 1), 1, 2), ""))


def _before_last_comma(s: Column) -> Column:
    return F.regexp_extract(s, r"(?s)^(.*),[^,]*$", 1)


def place_city(place: Column) -> Column:
    """The part before the last comma, or the whole; null if blank."""
    s = F.regexp_replace(strip(place), r"\.+$", "")
    return F.nullif(F.when(s.contains(","), strip(_before_last_comma(s))).otherwise(s), F.lit(""))


def place_state(place: Column) -> Column:
    """The part after the last comma; null if there is none."""
    s = F.regexp_replace(strip(place), r"\.+$", "")
    return F.when(s.contains(","), F.nullif(strip(F.substring_index(s, ",", -1)), F.lit("")))


def address_tail(address: Column) -> Column:
    """The trailing 'City, State' of an address, or the whole of it."""
    found = F.regexp_extract(strip(address), ADDRESS_TAIL, 1)
    return F.coalesce(F.nullif(found, F.lit("")), address)


def infer_country(state: Column) -> Column:
    """Canada for its regions and whatever contains 'can', USA for anything else, null for null or ''."""
    s = F.lower(F.regexp_replace(strip(state), r"\.+$", ""))
    return F.when(F.coalesce(state, F.lit("")) == "", F.lit(None).cast("string")).when(s.isin(CANADIAN) | s.contains("can"), F.lit("Canada")).otherwise(F.lit("USA"))


def birth_date(raw: Column, birth_year: Column) -> Column:
    """DD.MM.YYYY with 00 for a missing part; the year falls back to birth_year, null if there is none."""
    text = strip(F.coalesce(raw, F.lit("")))
    months = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, start=1) for x in (m, i)])
    month = F.try_element_at(months, F.lower(F.substring(F.regexp_extract(text, "([A-Za-z]{3,9})", 1), 1, 3)))
    year = F.coalesce(F.regexp_extract(text, r"\b(\d{4})\b", 1).try_cast("int"), birth_year)
    day = F.regexp_extract(text, r"\b(0?[1-9]|[12]\d|3[01])\b", 1).try_cast("int")
    return F.when(year.isNotNull(), F.format_string("%02d.%02d.%04d", F.coalesce(day, F.lit(0)), F.coalesce(month, F.lit(0)), year))


def coerce_year(text: Column) -> Column:
    """The first four digits, else the first one or two: up to 27 in the 1900s, later in the 1800s; else null."""
    four = F.regexp_extract(text, r"(\d{4})", 1).try_cast("int")
    two = F.regexp_extract(text, r"(\d{1,2})", 1).try_cast("int")
    return F.coalesce(four, F.when(two <= 27, two + 1900).otherwise(two + 1800))


#: The attributes of a person that do not change from year to year, in printed order.
INVARIANTS = [
    "last_name", "first_name", "scientist_name", "title", "star_status", "primary_department", "research", "birth_year", "birth_date",
    "birth_city", "birth_state", "birth_country", "mailing_city", "mailing_state", "mailing_country", "source_pdf_page",
]


def with_invariants(profiles: DataFrame) -> DataFrame:
    """The profile rows with the invariants under their final names, fallbacks applied.

    Done in stages, so that no expression is computed twice.
    """
    c = F.col
    first = profiles.withColumns(
        {
            "_name": clean_name(c("full_name")),
            "_tail": address_tail(c("mailing_address")),
            "birth_date": birth_date(c("birth_date"), c("birth_year")),
            "research": pipe_join(c("research_accomplished"), c("research_in_progress")),
            "star_status": F.coalesce(c("star_status"), F.lit(False)).cast("int"),
            "primary_department": F.regexp_replace(strip(F.coalesce(c("department"), F.lit(""))), r"\.+$", ""),
            "source_pdf_page": c("source_page"),
        }
    )
    second = first.withColumns(
        {
            "last_name": _last(c("_name")),
            "first_name": _first(c("_name")),
            "title": _title(c("titles"), c("_name")),
            "birth_city": first_filled(c("birth_city"), place_city(c("birth_place"))),
            "birth_state": first_filled(c("birth_state"), place_state(c("birth_place"))),
            "mailing_city": first_filled(c("mailing_city"), place_city(c("_tail"))),
            "mailing_state": first_filled(c("mailing_state"), place_state(c("_tail"))),
        }
    )
    third = second.withColumns(
        {
            "scientist_name": _display(c("last_name"), c("first_name"), c("full_name")),
            "birth_country": first_filled(c("birth_country"), infer_country(c("birth_state"))),
            "mailing_country": first_filled(c("mailing_country"), infer_country(c("mailing_state"))),
        }
    )
    return third.drop("_name", "_tail")
