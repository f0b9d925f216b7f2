"""From a pass log to tables: loose shapes, damaged lines, order of passes."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from annuary import api
from annuary.functions import loose
from annuary.plans import catalog
from annuary.sources import files


def line(page, scientists, at="2026-01-01T00:00:00Z", status="ok", number=1):
    return json.dumps({"focus_page_number": page, "status": status, "timestamp": at, "pass": number, "scientists": scientists})


@pytest.fixture
def log(tmp_path):
    def write(*lines):
        at = tmp_path / "log.jsonl"
        at.write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(at)

    return write


def test_loose_shapes_are_read(spark, log):
    people = [
        {"full_name": "A, B", "minor_positions": "Dean", "birth_year": "'92"},
        {"minor_positions": ["Dean", None], "birth_year": 1898.0, "societies": "AAAS"},
        {"minor_positions": {"position_title": "t", "start_year": "1901"}, "societies": [{"name": "AAAS", "since": 1900, "gone": None}, None, "X", 7]},
        None,
        {"minor_positions": [], "education": [["x"], {"year": "ca. 1912"}, {"year": "27"}, {"year": 27}], "employment": "prof", "star_status": True},
        "no record",
        {},
    ]
    path = log(line(1, people), '{"focus_page_number": 2,', "", line(3, {"full_name": "Only, One"}), line(4, people, status="failed"), line(5, None))
    passes = files.read_passes(spark, path)
    rows = {(r["source_page"], r["pos"]): r for r in files.profiles_of(passes).collect()}
    assert set(rows) == {(1, 0), (1, 1), (1, 2), (1, 4), (1, 6), (3, 0)}
    minor = {k: None if r["minor_positions"] is None else [(m["position_title"], m["start_year"], m["is_current_position"]) for m in r["minor_positions"]] for k, r in rows.items()}
    assert minor == {(1, 0): [("Dean", None, False)], (1, 1): [("Dean", None, False)], (1, 2): [("t", 1901, False)], (1, 4): None, (1, 6): None, (3, 0): None}
    assert [rows[1, k]["birth_year"] for k in (0, 1, 2)] == [1892, 1898, None]
    assert rows[1, 1]["societies"] == ["AAAS"] and rows[1, 2]["societies"] == ["AAAS; 1900", "X", "7"]
    assert [d["year"] for d in rows[1, 4]["education"]] == [None, 1912, 1927, 27] and rows[1, 4]["education"][0]["degree_type"] == '["x"]'
    assert rows[1, 4]["employment"][0]["position_title"] == "prof" and rows[1, 4]["star_status"] and not rows[1, 6]["star_status"]
    assert len({r["profile_id"] for r in rows.values()}) == 6
    assert [r["line"] for r in files.damaged_lines(spark, path).collect()] == ['{"focus_page_number": 2,']
    assert files.completed_pages(passes).count() == 3
    with pytest.raises(Exception):  # noqa: B017
        files.read_passes(spark, path, strict=True).select("status", "focus_page_number").collect()
    files.read_passes(spark, log(line(1, people)), strict=True).select("status", "scientists").collect()


@pytest.mark.parametrize("value,expected", [("null", None), ("1898", 1898), ("1898.9", 1898), ('"1898"', 1898), ('"\'98"', 1898), ('"ca. 1912 or 1913"', 1912), ('"5"', 1905), ('""', None), ('"none"', None), ("98", 98), ("[1]", None), ("true", 1)])
def test_years(spark, value, expected):
    df = spark.createDataFrame([(value,)], "s string").select(F.parse_json("s").alias("v"))
    assert df.select(loose.year(F.col("v"))).first()[0] == expected


def test_passes_are_numbered_by_time_and_merged(spark, log):
    first = line(7, [{"full_name": "Cole, A(nn)", "birth_year": "80"}], "2026-01-02T00:00:00Z")
    late = line(7, [{"full_name": "Cole, A(nn)", "birth_year": 1880, "department": "Botany", "birth_date": "May 1, 1880"}, {"full_name": "Frake, B(en)"}], "2026-01-03T00:00:00Z")
    early = line(7, [{"full_name": "Frakc, B(en)", "department": "x"}], "2026-01-01T00:00:00Z", number=9)
    passes = files.read_passes(spark, log(late, first, early))
    assert {(r["pass_no"], r["pos"]): r["full_name"] for r in files.profiles_of(passes).collect()} == {(1, 0): "Frakc, B(en)", (2, 0): "Cole, A(nn)", (3, 0): "Cole, A(nn)", (3, 1): "Frake, B(en)"}
    assert [r["pass"] for r in files.page_attempts(passes, 7).collect()] == [9, 1, 1]
    pages = spark.createDataFrame([(7, "Cole,A(nn),x,y. Frake,B(en)Z(")], "page int, text string")
    tables = api.tables_from_log(passes, pages)
    kept = tables["profiles"].collect()
    assert [(r["pos"], r["full_name"], r["birth_year"], r["birth_date"]) for r in kept] == [(0, "Frake, B(en)", None, None), (1, "Cole, A(nn)", None, None)]
    assert {"panel", "events", "summary", "review"} <= set(tables) and tables["summary"].count() == 2
    assert [r["page"] for r in tables["findings"].where("code = 'birth_field_repaired'").collect()] == [7]
    empty = api.tables_from_log(passes.where("status = 'none'"))
    assert all(t.count() == 0 for t in empty.values())


def same_as_sql(spark, folder):
    """The rows of ingest_profiles, after they equal those of its SQL; null and '' are two values here."""
    duckdb = pytest.importorskip("duckdb")
    df = catalog.QUERIES["ingest_profiles"](spark, folder)
    at = os.path.join(folder, "page_records.parquet")
    database = duckdb.connect()
    database.execute(f"create view page_records as select * from '{os.path.join(at, '*.parquet') if os.path.isdir(at) else at}'")
    want = database.execute(f"select {', '.join(df.columns)} from ({catalog.ORACLE['ingest_profiles']})").fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return got


def test_missing_lists_are_empty_and_written_nulls_null_as_in_sql(spark, data):
    assert any(None in r[9:] for r in same_as_sql(spark, data))


def test_odd_records_are_read_as_in_sql(spark, tmp_path):
    lists = ("education", "employment", "minor_positions", "societies")
    flags = [True, "true", "no", 1, 0, 1898, 98.5, None, [1]]
    people = [{}, *[dict.fromkeys(lists, v) for v in (None, [], [None], "x", {"start_year": "'99"}, 7, [[]], [{}, ""])], *[{"star_status": v, "employment": [{"is_current_position": v}]} for v in flags], None, "no record"]
    day = lambda k: datetime.datetime(2026, 1, k)
    # One page, its passes at different times, two of them at none, or without a number.
    passes = [(1, people, 1, day(2)), (2, [{}], 1, None), (3, [{}], None, day(2)), (4, [{}], 2, day(1)), (5, {}, 2, day(2)), (6, [{}], None, None), (7, None, 3, day(3))]
    rows = [(k, 5, number, "ok", "live", at, json.dumps({"focus_page_number": 5, "scientists": s})) for k, s, number, at in passes]
    schema = "record_id bigint, focus_page_number int, pass_no int, status string, via string, received_at timestamp_ntz, raw_json string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "page_records.parquet"))
    got = same_as_sql(spark, str(tmp_path))
    assert {r[0]: r[2] for r in got} == {4: 1, 1: 2, 5: 3, 3: 4, 2: 6, 6: 7}
    assert {r[1]: r[9:] for r in got if r[0] == 1 and r[1] < 3} == {0: ("", "", None, ""), 1: (None, None, None, None), 2: ("", "", None, "")}
    assert [r[6] for r in sorted(got) if r[0] == 1][9:] == [True, True, False, True, False, False, False, False, False]


def test_text_tables_get_their_numbers_back(spark, tmp_path):
    df = spark.createDataFrame([("A, B", "20", "1"), ("C", "100", ""), ("D", "x", None)], "institution string, n_events string, star_status string")
    files.write_text_table(df, str(tmp_path / "t"))
    typed = files.typed_columns(files.read_text_table(spark, str(tmp_path / "t")), ["n_events", "missing"], ["star_status"])
    assert [tuple(r) for r in typed.orderBy("n_events").collect()] == [("D", None, 0), ("A, B", 20, 1), ("C", 100, 0)]


def test_archive_keeps_all_that_is_nested(spark, profiles, tmp_path):
    p = profiles({"full_name": "A, B", "education": [("A.B", None, 1900, None)], "societies": ["x"]}).drop("extracted_at")
    files.write_archive(p, str(tmp_path / "a"))
    back = spark.read.schema(p.schema).json(str(tmp_path / "a"))
    assert back.collect() == p.collect()
    dead = spark.createDataFrame([(1, 2, "truncated", "text"), (2, 3, "empty", "")], "record_id long, page int, outcome string, text string")
    files.write_debug_texts(dead, str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d")).count() == 2


def test_numbered_pages(spark):
    pages = spark.createDataFrame([(5,), (3,), (3,), (9,)], "page int")
    assert [tuple(r) for r in files.numbered_pages(pages).orderBy("page").collect()] == [(3, "[1/3]"), (5, "[2/3]"), (9, "[3/3]")]
    assert [r["page"] for r in files.numbered_pages(pages, 2).orderBy("page").collect()] == [3, 5]
