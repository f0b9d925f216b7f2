from annuary import api
from annuary.operators import checks, ocr
from annuary.sources import files

from .conftest import job


def test_checks_with_and_without_text(spark, profiles):
    p = profiles({"full_name": "Gone, C(arl)", "birth_date": "March 1, 1889", "birth_year": 1889}, {"full_name": "Beer, X", "source_page": 2})
    pages = spark.createDataFrame([(1, "Gone,C(arl),x,nothing")], "page int, text string")
    with_text = {(r["page"], r["code"]) for r in api.run_checks(p, pages).collect()}
    assert {(1, "birth_field_repaired"), (1, "no_birth_year"), (2, "no_text_layer")} <= with_text
    assert not [r for r in api.run_checks(p).where("code = 'no_text_layer'").collect()]
    only = api.run_checks(p, pages, first_page=2)
    assert {r["page"] for r in only.collect()} == {2}
    assert {r["severity"] for r in checks.of_severity(only, "warn").collect()} == {"warn"}
    assert [r["page"] for r in checks.ordered(api.run_checks(p)).collect()] == sorted(r["page"] for r in api.run_checks(p).collect())


def test_release(spark, profiles):
    p = profiles({"full_name": "Bell, A", "birth_year": 1900, "employment": [job("x", "A", 1920)]}, {"full_name": "Mononym"})
    b = spark.createDataFrame([(1, "A", 1, "Town", "", "", "")], "bridge_id bigint, institution string, n_events int, city string, state_region string, country string, notes string")
    tables = api.publish_release(p, b)
    assert set(tables) == {"scientists", "panel", "events", "locations", "located", "blank", "codebook", "headline"}
    assert tables["located"].count() == 1 and tables["blank"].count() == 0
    assert [r["last_name"] for r in tables["scientists"].collect()] == ["Bell", ""]
    assert tables["panel"].count() == 28 + 1


def test_merged_profiles(spark, profiles):
    p = profiles({"full_name": "Cole, A(nn)"}, {"full_name": "Cole, A(nn)", "pass_no": 2, "department": "Botany"}, {"full_name": "Drake, B(en)", "pass_no": 2})
    got = {r["profile_id"]: r["pos"] for r in api.merged_profiles(p).collect()}
    assert got == {2: 0, 3: 1}


def test_omissions(spark, profiles):
    pages = spark.createDataFrame([(1, "Beer, Dr.Xx,Beer,Dr.Yy, Behre,C(harles)"), (2, "Behre,C(harles)")], "page int, text string")
    window = spark.createDataFrame([(1, "a", "z"), (2, "beh", "z")], "page int, lo string, hi string")
    p = profiles({"full_name": "Beer, A"}, {"full_name": "Behr, B"}, {"full_name": None, "source_page": 2})
    assert {tuple(r) for r in ocr.page_omissions(p, pages, window).collect()} == {(1, "Beer", 2, 1), (2, "Behre", 1, 0)}


def test_state(tmp_path):
    at = str(tmp_path / "state.json")
    files.save_state({"batches": ["b1"]}, at)
    state = files.harvested(files.harvested(files.load_state(at), "b1"), "b1")
    assert state == {"batches": ["b1"], "harvested": ["b1"]}
