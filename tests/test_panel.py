from pyspark.sql import functions as F

from annuary.operators import panel

from .conftest import job


def years(df):
    return {r["year"]: r for r in df.collect()}


def test_concurrent_roles_take_slots_in_order(profiles):
    p = profiles({"birth_year": 1890, "employment": [job("asst", "Yale", 1919, 1919), job("instr", "Mass. Col", 1919, 1922)]})
    r = years(panel.balanced_panel(p))
    assert r[1919]["positions"] == "instr @ Mass. Col | asst @ Yale"
    assert r[1920]["positions"] == "instr @ Mass. Col"
    assert len(r) == 1927 - 1890 + 1 and r[1900]["activity_confirmed"] == 0 and r[1919]["age"] == 29


def test_current_role_first_and_gaps_blank(profiles):
    p = profiles({"birth_year": 1880, "employment": [job("B", "b", 1905, 1927), job("A", "a", 1910, None, True)]})
    r = years(panel.balanced_panel(p))
    assert r[1910]["positions"].startswith("A @ a") and r[1910]["is_current_1927_role"] == 1 and r[1909]["positions"] == "B @ b"
    q = years(panel.balanced_panel(profiles({"birth_year": 1880, "employment": [job("A", "a", 1910), job("B", "b", 1920)]})))
    assert all(q[y]["activity_confirmed"] == 0 for y in range(1911, 1920))


def test_spine_without_birth_and_undated(profiles):
    p = profiles({"employment": [job("A", "a", 1901)]}, {}, {"birth_year": 1930})
    rows = panel.balanced_panel(p).collect()
    first = [r for r in rows if r["profile_id"] == 1]
    assert min(r["year"] for r in first) == 1901 and all(r["age"] is None for r in first)
    second = [r for r in rows if r["profile_id"] == 2]
    assert len(second) == 1 and second[0]["year"] is None and second[0]["activity_confirmed"] == 0
    assert not [r for r in rows if r["profile_id"] == 3]


def test_records_before_birth_widen_the_slots(profiles):
    p = profiles({"birth_year": 1900, "education": [("A.B", "x", 1895, None), ("A.M", "y", 1895, None)]})
    assert {r["kind"]: r["slots"] for r in panel.max_concurrency(p).collect()} == {"deg": 2, "prim": 1, "par": 1}
    wide = panel.panel_wide(p)
    assert "degree_earned_2" in wide.columns and wide.where("year < 1900").count() == 0
    assert wide.agg(F.max("degree_earned_1")).first()[0] == ""


def test_repeated_job_keeps_the_first(profiles):
    p = profiles({"birth_year": 1890, "employment": [job("asst ", "Yale", 1919), job("asst", " Yale", 1919)]})
    assert years(panel.balanced_panel(p))[1919]["positions"] == "asst  @ Yale"


def test_events_and_summary(profiles):
    p = profiles({"full_name": "Behre, Dr. J(ohn)", "education": [(None, "X", 1888, 1890), ("A.B", "Y", 1892, None), None], "employment": [job("prof", "sool", 1925, 1920), job("dir", "Z", 1930, None, True)], "societies": ["a; b", None]})
    e = {(r["record_type"], r["item_pos"]): r for r in panel.events_long(p).collect()}
    assert len(e) == 4
    assert (e["Education", 0]["role_or_degree"], e["Education", 0]["end_year"]) == ("study", 1890)
    assert e["Education", 1]["end_year"] == 1892
    assert (e["Employment", 0]["start_year"], e["Employment", 0]["end_year"], e["Employment", 0]["institution_organization"]) == (1925, 1920, "zool")
    assert (e["Employment", 1]["start_year"], e["Employment", 1]["is_current_1927_role"]) == (None, 0)
    s = panel.summary(p).first()
    assert (s["n_degrees"], s["n_study_spells"], s["n_positions"], s["societies"], s["title"]) == (1, 2, 2, "a | b", "Dr.")


def test_empty_table(profiles):
    assert panel.balanced_panel(profiles()).count() == 0
    assert panel.events_long(profiles()).count() == 0
    assert {r["slots"] for r in panel.max_concurrency(profiles()).collect()} == {1}


def test_book_order(profiles):
    p = profiles({"full_name": "B, x", "source_page": 2}, {"full_name": "A, x", "source_page": 2}, {"full_name": "C, x", "source_page": 1})
    assert [r["last_name"] for r in panel.in_book_order(panel.summary(p)).collect()] == ["C", "A", "B"]
