"""Files that come in: pass logs, page texts, bridge and findings tables; and files that go out."""

from __future__ import annotations

import csv
import json
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annuary.functions import loose
from annuary.operators.batch import json_part, output_text
from annuary.session import numbered

PASS = "focus_page_number int, status string, timestamp string, n_scientists int, pass int, via string, scientists variant, _corrupt_record string"
#: The text fields of a profile, in the order of its schema.
TEXT_FIELDS = ["full_name", "titles", "mailing_address", "mailing_city", "mailing_state", "mailing_country"]
MORE_TEXT = ["department", "birth_place", "birth_city", "birth_state", "birth_country", "birth_date"]
_DEGREE = {"degree_type": loose.text, "institution": loose.text, "year": loose.year, "end_year": loose.year}
_POST_ARRAY = "array<struct<position_title:string, institution_org:string, start_year:int, end_year:int, is_current_position:boolean>>"
_POST = {"position_title": loose.text, "institution_org": loose.text, "start_year": loose.year, "end_year": loose.year, "is_current_position": loose.flag}


def read_passes(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Lines of a pass log, the profiles as they were written. Damaged lines are kept as _corrupt_record, or fail the
    read if strict; a line whose shapes are only loose is not damaged."""
    reader = spark.read.schema(PASS).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def damaged_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line) of a pass log that are neither blank nor whole JSON, as they stand in it."""
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    return lines.where((F.trim("line") != "") & F.try_parse_json("line").isNull())


def passes_of(records: DataFrame) -> DataFrame:
    """The rows of page_records as passes: the page object of each, whether it came by itself or in a batch line.

    A record without whole JSON, or nested deeper than Spark's parser goes (1,000 levels), has null scientists.
    """
    whole = F.try_parse_json("raw_json")
    page = F.when(loose.field(whole, "response").isNull(), whole).otherwise(F.try_parse_json(json_part(output_text(F.col("raw_json")))))
    return records.select(
        "record_id", "focus_page_number", "status", F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("pass_no").alias("pass"), "via", loose.field(page, "scientists").alias("scientists"),
    )


def profiles_of(passes: DataFrame) -> DataFrame:
    """One row per profile of the passes with status ok, in the schema of scientist_profiles.

    Years written as text or with two digits are read, a single value in place of a list counts as one entry, a
    text in place of a record is its title. A missing list is empty, one written as null is null (minor_positions
    without entries are always null). Null entries keep their place and give no row. pass_no counts the
    completed passes of a page from 1 in the order of their time, those without one last; profile_id is made of
    page, pass and place, so it is the same in every run. Rows without a page are left out.
    """
    tie = F.col("record_id") if "record_id" in passes.columns else F.xxhash64(F.to_json(F.struct("scientists")))
    order = Window.partitionBy("focus_page_number").orderBy(F.asc_nulls_last("timestamp"), F.asc_nulls_last("pass"), tie.asc_nulls_last())
    ok = passes.where("status = 'ok' and focus_page_number is not null").withColumn("pass_no", F.row_number().over(order))
    every = F.when(loose.kind_of(F.col("scientists")) == "ARRAY", F.try_variant_get("scientists", "$", "array<variant>")).otherwise(F.array("scientists"))
    keep = [c for c in ("record_id",) if c in passes.columns]
    rows = ok.select(*keep, "focus_page_number", "pass_no", "via", "timestamp", F.posexplode(every).alias("pos", "p")).where(loose.kind_of(F.col("p")) == "OBJECT")
    fit = F.when((F.col("pos") < 1 << 16) & (F.col("pass_no") < 1 << 16), F.col("focus_page_number").cast("bigint") * (1 << 32) + F.col("pass_no") * (1 << 16) + F.col("pos"))
    part = lambda name: loose.field(F.col("p"), name)
    return rows.select(
        *keep,
        F.coalesce(fit, F.raise_error(F.lit("more than 65,535 passes or entries on one page"))).alias("profile_id"),
        F.col("focus_page_number").alias("source_page"), "pos", "pass_no", "via", F.col("timestamp").try_cast("timestamp_ntz").alias("extracted_at"),
        *[loose.text(part(c)).alias(c) for c in TEXT_FIELDS], loose.flag(part("star_status")).alias("star_status"), *[loose.text(part(c)).alias(c) for c in MORE_TEXT],
        loose.year(part("birth_year")).alias("birth_year"),
        loose.records(part("education"), "degree_type", _DEGREE).alias("education"),
        loose.records(part("employment"), "position_title", _POST).alias("employment"),
        F.nullif(loose.records(part("minor_positions"), "position_title", _POST), F.array().cast(_POST_ARRAY)).alias("minor_positions"),
        loose.texts(part("societies")).alias("societies"),
        *[loose.text(part(c)).alias(c) for c in ("research_accomplished", "research_in_progress")],
    )


def completed_pages(passes: DataFrame, page: str = "focus_page_number") -> DataFrame:
    return passes.where("status = 'ok'").select(F.col(page).alias("page")).distinct()


def remaining_pages(pages: DataFrame, completed: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """Pages of the range (both ends included) that no pass has completed."""
    wanted = pages.select("page").distinct()
    if first is not None:
        wanted = wanted.where(F.col("page") >= first)
    if last is not None:
        wanted = wanted.where(F.col("page") <= last)
    return wanted.join(completed, "page", "left_anti")


def numbered_pages(pages: DataFrame, first_only: int | None = None) -> DataFrame:
    """(page, progress): the pages in order, each with its place among them as '[i/n]'; or only the first so many."""
    placed = numbered(pages.select("page").distinct(), [F.asc("page")], "i")
    total = placed.agg(F.count("*").alias("n"))
    rows = placed.join(F.broadcast(total)).select("page", "i", F.format_string("[%d/%d]", "i", "n").alias("progress"))  # one row
    return (rows if first_only is None else rows.where(F.col("i") <= first_only)).drop("i")


def page_attempts(passes: DataFrame, page: int) -> DataFrame:
    """All completed passes over one page, in the order of their time."""
    return passes.where((F.col("status") == "ok") & (F.col("focus_page_number") == page)).orderBy(F.asc_nulls_last("timestamp"), F.asc_nulls_last("pass"))


def read_profiles_json(spark: SparkSession, path: str) -> DataFrame:
    """An archive that is one JSON array of profiles."""
    return spark.read.option("multiLine", True).json(path)


def read_text_table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A table whose columns are all text, with a header and doubled quotes."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("sep", sep).csv(path)


def typed_columns(df: DataFrame, integers: list[str], flags: list[str] = ()) -> DataFrame:
    """A text table with its numbers as numbers again: what is no number becomes null, in a flag 0."""
    number = lambda c: F.col(c).try_cast("double").cast("int")
    kinds = {c: number(c) for c in integers if c in df.columns} | {c: F.coalesce(number(c), F.lit(0)) for c in flags if c in df.columns}
    return df.withColumns(kinds) if kinds else df


def read_findings(spark: SparkSession, path: str) -> DataFrame:
    """Findings separated by semicolons, as (page, scientist, messages)."""
    rows = read_text_table(spark, path, ";")
    detail = F.when(F.coalesce("detail", F.lit("")) != "", F.concat(F.lit(" -- "), F.col("detail"))).otherwise("")
    message = F.concat(F.upper("severity"), F.lit(": "), F.col("code"), detail)
    return rows.groupBy(F.col("page").try_cast("int").alias("page"), "scientist").agg(F.sort_array(F.collect_list(message)).alias("messages"))


def append_passes(passes: DataFrame, path: str) -> None:
    """Add lines to a pass log; a commit shows all of them or none."""
    passes.write.mode("append").json(path)


def write_text_table(df: DataFrame, path: str, sep: str = ",") -> None:
    """The table as text files with a header each, written by all tasks."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"').csv(path)


def write_findings(findings: DataFrame, path: str) -> None:
    write_text_table(findings.orderBy("page", "code"), path, ";")


def export_single_file(df: DataFrame, path: str, sep: str = ",") -> int:
    """One file with a byte order mark for spreadsheets; rows stream through the driver one partition at a time."""
    n = 0
    with open(path, "w", encoding="utf-8-sig", newline="") as out:
        writer = csv.writer(out, delimiter=sep)
        writer.writerow(df.columns)
        for row in df.toLocalIterator():
            writer.writerow(["" if v is None else v for v in row])
            n += 1
    return n


def write_archive(profiles: DataFrame, path: str) -> None:
    """The profiles with all that is nested in them as lines of JSON, nulls kept, written by all tasks."""
    profiles.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_debug_texts(dead_letters: DataFrame, path: str) -> None:
    """What came back from the calls that failed (record_id, page, outcome, text), for looking at by hand."""
    dead_letters.select("record_id", "page", "outcome", "text").write.mode("append").partitionBy("outcome").json(path)


def write_failures(dead_letters: DataFrame, path: str) -> None:
    """Failed calls as lines of tab-separated text, added to those that are there."""
    dead_letters.write.mode("append").option("sep", "\t").csv(path)


def save_state(state: dict, path: str) -> None:
    """A small manifest of submitted and harvested batches; the old one stays until the new one is whole."""
    with open(path + ".new", "w", encoding="utf-8") as out:
        json.dump(state, out, indent=1)
    os.replace(path + ".new", path)


def load_state(path: str) -> dict:
    """The manifest; a missing one is an error, since nothing was submitted then."""
    if not os.path.exists(path):
        raise FileNotFoundError(f"no batch was submitted: {path} is missing")
    with open(path, encoding="utf-8") as lines:
        return json.load(lines)


def harvested(state: dict, batch: str) -> dict:
    """The state with one batch marked as read; marking it again changes nothing."""
    done = state.get("harvested", [])
    return state | {"harvested": done if batch in done else [*done, batch]}
