"""Data-quality rules. Every rule yields findings: severity, code, page, scientist, detail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annuary.functions.people import surname
from annuary.functions.spells import EDITION_YEAR
from annuary.functions.text import strip

#: Degree abbreviations, and words that begin a job title.
DEGREE = (
    r"\b(?:A\.\s?B|B\.\s?A|B\.\s?S|S\.\s?B|A\.\s?M|M\.\s?A|M\.\s?S|Ph\.\s?[BDG]|M\.\s?D|LL\.\s?[BD]|Sc\.\s?D|D\.\s?Sc|C\.\s?E|E\.\s?E|E\.\s?M|M\.\s?E|Pharm\.\s?D|D\.\s?D\.?S)\b"
)
JOB_WORD = r"(?i)^(instr|prof|asst|assoc|dir|lect|fellow|res|dean|head|supt|chief|curator)\b"
FIRST_YEAR, LAST_BIRTH, ADULT = 1800, 1915, 15
MANY_CURRENT = 4
MIN_PAGES, LOW_SHARE = 5, 0.6
#: Pages that a finding about a repeated name spells out; the number of the others is added.
LISTED_PAGES = 200
#: Pages per bucket in the search for neighbouring pages.
BUCKET = 4096
#: The codes whose pages are worth another pass.
SUSPECT_CODES = ["entry_possibly_missed", "page_overlap", "empty_page", "duplicate_scientist"]
FINDING = ["severity", "code", "page", "scientist", "detail"]


def quoted(c: Column) -> Column:
    """Text in quotes the way it is shown in a finding: single ones, double ones if it holds only single ones."""
    both = c.contains("'") & ~c.contains('"')
    return F.when(both, F.concat(F.lit('"'), c, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("\\'")), F.lit("'")))


def _finding(when: Column, severity: str, code: str, detail: Column) -> Column:
    return F.when(when, F.named_struct(F.lit("severity"), F.lit(severity), F.lit("code"), F.lit(code), F.lit("detail"), detail))


def _filled(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def _year(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)) != 0


def _out_of_range(c: Column) -> Column:
    return _year(c) & ~c.between(FIRST_YEAR, EDITION_YEAR)


def _text(c: Column) -> Column:
    return c.cast("string")


def profile_findings(profiles: DataFrame) -> DataFrame:
    """The rules that look at one profile, in one pass over the rows. Null items of lists are no records."""
    birth, place = F.col("birth_year"), F.col("birth_place")
    none = F.lit("")
    education = F.filter(F.coalesce(F.col("education"), F.array()), lambda x: x.isNotNull())
    employment = F.filter(F.coalesce(F.col("employment"), F.array()), lambda x: x.isNotNull())
    n_current = F.size(F.filter("_jobs", lambda x: F.coalesce(x["is_current_position"], F.lit(False))))
    single = F.array(
        _finding(~_year(birth), "warn", "no_birth_year", none),
        _finding(_year(birth) & ~birth.between(FIRST_YEAR, LAST_BIRTH), "error", "birth_year_implausible", _text(birth)),
        _finding(
            _filled(place) & place.rlike(DEGREE), "error", "birth_place_looks_like_degree",
            F.concat(F.lit("birth_place="), quoted(place), F.lit(" contains a degree abbreviation -- the birth fields were probably invented from the degree text")),
        ),
        _finding(~_filled(F.col("department")), "warn", "no_department", none),
        _finding(F.size("_degrees") == 0, "warn", "no_education", none),
        _finding(F.size("_jobs") == 0, "warn", "no_employment", none),
        _finding(n_current == 0, "warn", "no_current_position", F.lit("no italic 1927 role: panel years to 1927 will be blank")),
        _finding(n_current > MANY_CURRENT, "warn", "many_current_positions", F.format_string("%d positions marked current", n_current)),
    )
    kinds = F.filter(F.transform("_degrees", lambda x: x["degree_type"]), lambda t: _filled(t))

    def repeated(t: Column) -> Column:
        n = F.size(F.filter(F.col("_kinds"), lambda o: o == t))
        return _finding(n > 1, "warn", "duplicate_degree_type", F.format_string("'%s' listed %d times -- check whether one is a degreeless study spell", t, n))

    def degree(x: Column) -> Column:
        label = strip(F.concat(F.coalesce(x["degree_type"], F.lit("None")), F.lit(" "), F.coalesce(x["institution"], F.lit(""))))
        y, kind, inst = x["year"], x["degree_type"], F.coalesce(x["institution"], F.lit(""))
        return F.array(
            _finding(_out_of_range(y), "error", "year_out_of_range", F.concat(F.lit("degree "), label, F.lit(" in "), _text(y))),
            _finding(_year(y) & _year(birth) & (y < birth + ADULT), "error", "milestone_before_adulthood", F.concat(F.lit("degree "), label, F.lit(" in "), _text(y), F.lit(" but born "), _text(birth), F.lit(" -- check the birth year"))),
            _finding(F.coalesce(kind, F.lit("")).rlike(JOB_WORD), "error", "position_in_education", F.concat(F.lit("degree_type="), quoted(kind), F.lit(" looks like a job title"))),
            _finding(_filled(kind) & (inst == "") & ~_year(y), "warn", "degree_missing_institution_and_year", F.concat(F.lit("degree "), quoted(kind), F.lit(" has neither institution nor year -- it may share its neighbour's printed ones"))),
            _finding(inst.rlike("^" + DEGREE), "warn", "degree_glued_into_institution", F.concat(F.lit("institution "), quoted(inst), F.lit(" starts with a degree abbreviation -- two printed degrees were probably fused into one"))),
        )

    def job(x: Column) -> Column:
        s, t, name = x["start_year"], x["end_year"], F.coalesce(x["position_title"], F.lit(""))
        wrong = lambda y: _finding(_out_of_range(y), "error", "year_out_of_range", F.concat(F.lit("employment "), name, F.lit(" year="), _text(y)))
        return F.array(
            wrong(s),
            wrong(t),
            _finding(_year(s) & _year(t) & (t < s), "error", "end_before_start", F.concat(name, F.lit(" "), _text(s), F.lit("-"), _text(t))),
            _finding(_year(s) & _year(birth) & (s < birth + ADULT), "error", "milestone_before_adulthood", F.concat(F.lit("position '"), name, F.lit("' in "), _text(s), F.lit(" but born "), _text(birth), F.lit(" -- check the birth year"))),
        )

    lists = profiles.select("profile_id", F.col("source_page").alias("page"), F.coalesce(F.nullif("full_name", F.lit("")), F.lit("(unnamed)")).alias("scientist"), "birth_year", "birth_place", "department", education.alias("_degrees"), employment.alias("_jobs"))
    found = lists.withColumn("_kinds", kinds).select(
        "profile_id", "page", "scientist",
        F.concat(single, F.transform(F.array_distinct("_kinds"), repeated), F.flatten(F.transform("_degrees", degree)), F.flatten(F.transform("_jobs", job))).alias("f"),
    )
    return found.select("profile_id", "page", "scientist", F.explode(F.filter("f", lambda x: x.isNotNull())).alias("f")).select("profile_id", "page", "scientist", "f.severity", "f.code", "f.detail")


def _place_in_page() -> Column:
    return F.struct("pass_no", "pos", "profile_id")


def named_rows(profiles: DataFrame) -> DataFrame:
    """page, surname (null if blank) and the place within the page."""
    return profiles.select(F.col("source_page").alias("page"), F.nullif(surname(F.col("full_name")), F.lit("")).alias("surname"), _place_in_page().alias("at"), "full_name", "star_status")


def out_of_order(profiles: DataFrame) -> DataFrame:
    """Entries whose surname sorts before that of the entry before them on the page."""
    w = Window.partitionBy("page").orderBy("at")
    rows = named_rows(profiles).where("surname is not null").withColumn("before", F.lag("surname").over(w))
    return rows.where(F.lower("surname") < F.lower("before")).select(
        F.lit("warn").alias("severity"), F.lit("out_of_order").alias("code"), "page", F.col("surname").alias("scientist"), F.format_string("'%s' follows '%s' but sorts before it", F.col("surname"), F.col("before")).alias("detail")
    )


def page_ends(profiles: DataFrame) -> DataFrame:
    """Per page: first and last surname in print order, smallest and largest in lower case (null if all are blank)."""
    rows = named_rows(profiles)
    low = F.lower("surname")
    at = F.when(F.col("surname").isNotNull(), F.col("at"))
    return rows.groupBy("page").agg(F.min_by("surname", at).alias("first"), F.max_by("surname", at).alias("last"), F.min(low).alias("low"), F.max(low).alias("high"), F.count("*").alias("n"))


def with_neighbours(pages: DataFrame, columns: list[str]) -> DataFrame:
    """Pages with prev_<c> and next_<c> of the nearest pages before and after, found bucket by bucket.

    Only the two ends of each bucket are compared across buckets, so no task sees all pages.
    """
    inside = Window.partitionBy("bucket").orderBy("page")
    rows = pages.withColumn("bucket", F.floor(F.col("page") / BUCKET)).withColumn("me", F.struct("page", *columns))
    rows = rows.withColumn("prev", F.lag("me").over(inside)).withColumn("next", F.lead("me").over(inside))
    ends = rows.groupBy("bucket").agg(F.min("me").alias("head"), F.max("me").alias("tail"))
    across = Window.orderBy("bucket")
    ends = ends.select("bucket", F.lag("tail").over(across).alias("bucket_prev"), F.lead("head").over(across).alias("bucket_next"))
    joined = rows.join(ends, "bucket")
    both = joined.withColumn("prev", F.coalesce("prev", "bucket_prev")).withColumn("next", F.coalesce("next", "bucket_next"))
    return both.select(*pages.columns, *[F.col(f"prev.{c}").alias(f"prev_{c}") for c in ["page", *columns]], *[F.col(f"next.{c}").alias(f"next_{c}") for c in ["page", *columns]])


def page_overlap(profiles: DataFrame) -> DataFrame:
    """Pages that start before the previous page with names ended, and pages without any name."""
    ends = page_ends(profiles)
    empty = ends.where("last is null").select(F.lit("error").alias("severity"), F.lit("empty_page").alias("code"), "page", F.lit("").alias("scientist"), F.lit("no profiles returned").alias("detail"))
    rows = with_neighbours(ends.where("last is not null").select("page", "first", "last"), ["last"])
    over = rows.where(F.lower("first") < F.lower("prev_last")).select(
        F.lit("error").alias("severity"), F.lit("page_overlap").alias("code"), "page", F.col("first").alias("scientist"),
        F.format_string("page starts at '%s', before page %d ended at '%s' -- possible duplicated entries", F.col("first"), F.col("prev_page"), F.col("prev_last")).alias("detail"),
    )
    return empty.unionByName(over)


def alpha_window(profiles: DataFrame) -> DataFrame:
    """(page, lo, hi): surnames an entry of the page may have, widened to the ends of the neighbouring pages."""
    rows = with_neighbours(page_ends(profiles).select("page", "first", "last", "low", "high"), ["first", "last"])
    lo, hi = F.coalesce("low", F.lit("")), F.coalesce("high", F.lit("zzzz"))
    return rows.select("page", F.least(lo, F.lower("prev_last")).alias("lo"), F.greatest(hi, F.lower("next_first")).alias("hi"))


def duplicate_entities(profiles: DataFrame) -> DataFrame:
    """Names on more than one entry, each with its pages; of more than LISTED_PAGES only so many are spelt out.

    The pages of a name are counted and ranked before they are listed, so even the nameless rows, which are one
    name, make a short row.
    """
    name = strip(F.coalesce("full_name", F.lit(""))).alias("scientist")
    pages = profiles.groupBy(name, F.col("source_page").alias("p")).agg(F.count("*").cast("int").alias("n"))
    totals = pages.groupBy("scientist").agg(F.max("p").alias("page"), F.sum("n").alias("hits")).where("hits > 1")
    first = pages.withColumn("r", F.row_number().over(Window.partitionBy("scientist").orderBy("p"))).where(F.col("r") <= LISTED_PAGES)
    at = first.groupBy("scientist").agg(F.sort_array(F.collect_list(F.struct("p", "n"))).alias("at"))
    every = F.flatten(F.transform("at", lambda x: F.array_repeat(x["p"].cast("string"), F.least(x["n"], F.lit(LISTED_PAGES)))))
    listed = F.array_join(F.slice(every, 1, LISTED_PAGES), ", ")
    more = F.when(F.col("hits") > LISTED_PAGES, F.format_string(" and %d more", F.col("hits") - LISTED_PAGES)).otherwise("")
    return totals.join(at, "scientist").select(
        F.lit("error").alias("severity"), F.lit("duplicate_scientist").alias("code"), "page", "scientist", F.concat(F.lit("appears on pages ["), listed, more, F.lit("]")).alias("detail")
    )


def low_yield(profiles: DataFrame, share: float = LOW_SHARE) -> DataFrame:
    """Pages with far fewer entries (less than share) than the median page; nothing for fewer than five pages."""
    pages = profiles.groupBy(F.col("source_page").alias("page")).agg(F.count("*").alias("n"))
    typical = pages.agg(F.percentile("n", F.lit(0.5)).alias("median"), F.count("*").alias("pages"))
    rows = pages.join(F.broadcast(typical))  # one row
    return rows.where((F.col("pages") >= MIN_PAGES) & (F.col("n") < F.greatest(F.lit(1.0), F.col("median") * share))).select(
        F.lit("warn").alias("severity"), F.lit("low_entry_count").alias("code"), "page", F.lit("").alias("scientist"),
        F.format_string("%d entries vs a median of %s across the run", F.col("n"), F.bround("median", 0).cast("bigint").cast("string")).alias("detail"),
    )


def star_mismatch(profiles: DataFrame, page_text: DataFrame) -> DataFrame:
    """Pages whose printed asterisks are not as many as their starred profiles: page, printed, starred."""
    starred = profiles.groupBy(F.col("source_page").alias("page")).agg(F.sum(F.coalesce("star_status", F.lit(False)).cast("bigint")).alias("starred"))
    printed = page_text.select("page", (F.length("text") - F.length(F.replace("text", F.lit("*")))).cast("bigint").alias("printed"))
    return starred.join(printed, "page").where("printed <> starred").select("page", "printed", "starred")


def all_findings(profiles: DataFrame) -> DataFrame:
    """The rules that need no text layer, as one stream."""
    out = profile_findings(profiles).select(*FINDING)
    for rule in (out_of_order, page_overlap, duplicate_entities, low_yield):
        out = out.unionByName(rule(profiles).select(*FINDING))
    return out


def findings_report(findings: DataFrame) -> DataFrame:
    """Codes with their number of findings and of pages, errors first, then the most frequent."""
    return findings.groupBy("severity", "code").agg(F.count("*").alias("n"), F.countDistinct("page").alias("n_pages")).orderBy(F.col("severity") != "error", F.desc("n"), "code")


def suspect_pages(findings: DataFrame) -> DataFrame:
    return findings.where((F.col("severity") == "error") & F.col("code").isin(SUSPECT_CODES)).select("page").distinct()


def top_per_code(findings: DataFrame, n: int = 8) -> DataFrame:
    """The first n findings of each code by page, name and detail.

    Spark keeps only n rows per code and task before it shuffles (window group limit), so a code that most
    rows fall under is no hot spot.
    """
    w = Window.partitionBy("code").orderBy("page", "scientist", "detail")
    return findings.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n)


def flags_of_profiles(profiles: DataFrame, findings: DataFrame) -> DataFrame:
    """(profile_id, flag): findings whose name is the profile's, its surname, or a beginning of its name.

    A finding without a name reaches no profile. Equal messages of a page and name are shown once each time.
    """
    p = profiles.select("profile_id", F.col("source_page").alias("page"), strip(F.coalesce("full_name", F.lit(""))).alias("name"))
    f = findings.where("scientist <> ''").select("page", "scientist", F.concat(F.upper("severity"), F.lit(": "), F.col("code"), F.when(F.col("detail") != "", F.concat(F.lit(" -- "), F.col("detail"))).otherwise("")).alias("flag"))
    # Both a full name and a surname begin with the same letters, which is the second key of the join.
    key = lambda c: F.substring(c, 1, 2)
    joined = p.withColumn("k", key(F.col("name"))).join(f.withColumn("k", key(F.col("scientist"))), ["page", "k"])
    hit = (F.col("name") == F.col("scientist")) | (strip(F.substring_index("name", ",", 1)) == F.col("scientist")) | F.col("name").startswith(F.col("scientist"))
    return joined.where(hit).select("profile_id", "flag")


def of_severity(findings: DataFrame, severity: str = "all") -> DataFrame:
    """The findings of one severity, or all."""
    return findings if severity == "all" else findings.where(F.col("severity") == severity)


def ordered(findings: DataFrame) -> DataFrame:
    return findings.orderBy("page", "code", "scientist", "detail")
