"""Bridge, rules, text layer, passes, batches, files and streams on hand-made rows."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from annuary.operators import batch, bridge, checks, ocr, panel, publish, resolve, review
from annuary.sources import files

from .conftest import job

BRIDGE = "bridge_id bigint, institution string, n_events int, city string, state_region string, country string, notes string"


def mailed(n, city, *, org="Yale University", **more):
    return [{"mailing_address": f"{org}, New Place, Conn", "mailing_city": city, "mailing_state": "Conn", "mailing_country": "USA", "employment": [job("prof", "Yale", 1900)]} | more for _ in range(n)]


def test_majority_vote(profiles):
    p = profiles(*mailed(3, "New Haven"), *mailed(2, "Hartford"))
    e = bridge.address_evidence(p).first()
    assert (e["institution"], e["city"], e["n_top"], e["n_total"]) == ("Yale", "New Haven", 3, 5)
    assert bridge.address_evidence(p).select(bridge.vote_note(F.col("n_top"), F.col("n_total"))).first()[0] == "auto: 3 of 5 mailing addresses"
    assert bridge.address_evidence(profiles(*mailed(1, "New Haven"), *mailed(1, "Hartford"))).count() == 0
    only_home = profiles({"mailing_address": "Yale, Conn", "mailing_city": "Yale", "mailing_state": "Conn", "employment": [job("prof", "Yale", 1900)]})
    assert bridge.address_evidence(only_home).count() == 0


@pytest.mark.parametrize("name,seg,expected", [("Midwest Explor. Co", "Midwest Exploration Co", True), ("Hopkins", "Johns Hopkins University", True), ("Union", "Union Central Life Ins. Co", False), ("Yale", "", False)])
def test_segment_matches(spark, name, seg, expected):
    from annuary.functions.text import tokens

    df = spark.createDataFrame([(name, seg)], "n string, s string").select(tokens(F.col("n")).alias("n"), tokens(F.col("s")).alias("s"))
    assert df.select(bridge.segment_matches(F.col("n"), F.col("s"))).first()[0] is expected


def test_bridge_refresh_lookup_apply(spark, profiles):
    p = profiles(*mailed(2, "New Haven"), {"employment": [job("x", " Else ", 1900), job("x", None, 1900)]})
    old = spark.createDataFrame([(1, "Yale", 9, "", "", None, ""), (2, "Else", 9, "Town", "", "", "checked"), (3, "Gone", 9, "", "", "", "x")], BRIDGE)
    r = {x["institution"]: x for x in bridge.refresh_bridge(old, p).collect()}
    assert r["Yale"]["city"] == "New Haven" and r["Yale"]["notes"] == "auto: 2 mailing address(es), unanimous" and r["Yale"]["n_events"] == 2
    assert (r["Else"]["city"], r["Else"]["notes"], r["Else"]["n_events"], r["Gone"]["n_events"]) == ("Town", "checked", 1, 0)
    twice = spark.createDataFrame([(5, "A", 1, " ", "", "", ""), (6, "A", 1, "First", "", "", "ai: x"), (7, "A", 1, "Second", "", "", "")], BRIDGE)
    lookup = bridge.location_lookup(twice)
    assert [tuple(x) for x in lookup.collect()] == [("A", "First", None, None, "AI")]
    events = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "event_id int, institution_organization string")
    once = bridge.apply_locations(events, lookup)
    again = bridge.apply_locations(once, lookup)
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect())) and once.count() == 3


def test_proposals(spark):
    wanted = spark.createDataFrame([("Acme Co",), ("Beta",)], "institution string")
    rows = [(1, "ACME CO", "company", True, "X", "", "USA", None), (2, "Beta", "ambiguous", True, "X", "", "USA", "Beta Inc"), (3, "Beta", "company", True, "X", "", "", None), (4, "Nobody", "company", True, "", "", "USA", None), (5, "Beta", None, None, None, None, None, None)]
    replies = spark.createDataFrame(rows, "reply_id bigint, institution string, kind string, confident boolean, city string, state_region string, country string, resolved_name string")
    got = {r["reply_id"]: (r["institution"], r["city"], r["notes"]) for r in bridge.accept_proposals(replies, wanted).collect()}
    assert got == {1: ("Acme Co", "X", "ai: Acme Co | company"), 2: ("Beta", "", "ai: Beta Inc | ambiguous | not filled"), 3: ("Beta", "", "ai: Beta | company | failed check (need country + locatable kind)"), 5: ("Beta", "", "ai: Beta | unclassified | not filled")}


def codes(df):
    return sorted(r["code"] for r in df.collect())


def test_profile_rules(profiles):
    good = {"full_name": "Good, A", "birth_year": 1880, "department": "Botany", "education": [("A.B", "X", 1900, None)], "employment": [job("prof", "Y", 1901, None, True)]}
    assert checks.profile_findings(profiles(good)).count() == 0
    assert codes(checks.profile_findings(profiles({}))) == ["no_birth_year", "no_current_position", "no_department", "no_education", "no_employment"]
    bad = good | {
        "birth_year": 1790,
        "birth_place": "A.B. O'Stanford",
        "education": [("prof", "A.M. X", 1795, None), ("A.B", None, None, None), ("A.B", "Y", 1950, None), None],
        "employment": [job("a", "b", 1925, 1920, True)] + [job("c", "d", None, None, True)] * 4 + [None],
    }
    found = {r["code"]: r for r in checks.profile_findings(profiles(bad)).collect()}
    assert set(found) == {"birth_year_implausible", "birth_place_looks_like_degree", "year_out_of_range", "milestone_before_adulthood", "position_in_education", "degree_missing_institution_and_year", "degree_glued_into_institution", "duplicate_degree_type", "end_before_start", "many_current_positions"}
    assert found["birth_place_looks_like_degree"]["detail"].startswith('birth_place="A.B. O\'Stanford" contains')
    assert found["end_before_start"]["detail"] == "a 1925-1920"


def test_order_rules(profiles):
    names = ["Beal, A", "Adam, B", None, "Cole, C"]
    p = profiles(*[{"full_name": n} for n in names], *[{"full_name": n, "source_page": 9000} for n in ("Bell, A", "Cole, C")], {"full_name": " ", "source_page": 9001})
    assert [r["scientist"] for r in checks.out_of_order(p).collect()] == ["Adam"]
    over = {r["code"]: r for r in checks.page_overlap(p).collect()}
    assert over["page_overlap"]["page"] == 9000 and "before page 1 ended at 'Cole'" in over["page_overlap"]["detail"] and over["empty_page"]["page"] == 9001
    window = {r["page"]: (r["lo"], r["hi"]) for r in checks.alpha_window(p).collect()}
    assert window[1] == ("adam", "cole") and window[9000] == ("bell", "cole") and window[9001] == ("", "zzzz")
    twice = checks.duplicate_entities(p).where("scientist = 'Cole, C'").first()
    assert (twice["page"], twice["detail"]) == (9000, "appears on pages [1, 9000]")


def test_yield_report_and_flags(spark, profiles):
    rows = [{"full_name": f"N{i}, A", "source_page": page} for page in range(1, 6) for i in range(1 if page == 5 else 6)]
    low = checks.low_yield(profiles(*rows)).first()
    assert (low["page"], low["detail"]) == (5, "1 entries vs a median of 6 across the run")
    assert checks.low_yield(profiles(*rows[:24])).count() == 0
    f = spark.createDataFrame([("error", "x", 1, "Bell", "d"), ("warn", "y", 1, "", "e"), ("warn", "z", 2, "Bell, A", "")], "severity string, code string, page int, scientist string, detail string")
    p = profiles({"full_name": "Bell, A"}, {"full_name": "Bellamy, B"}, {"full_name": "Bell, A", "source_page": 2}, {"full_name": None})
    got = sorted((r["profile_id"], r["flag"]) for r in checks.flags_of_profiles(p, f).collect())
    assert got == [(1, "ERROR: x -- d"), (2, "ERROR: x -- d"), (3, "WARN: z")]
    assert {r["profile_id"]: r["row_severity"] for r in review.review_view(p, f).collect()} == {1: "error", 2: "error", 3: "warn", 4: ""}
    assert [r["code"] for r in checks.findings_report(f).collect()] == ["x", "y", "z"]
    many = spark.range(20).select(F.lit("c").alias("code"), F.col("id").cast("int").alias("page"), F.lit("s").alias("scientist"), F.lit("").alias("detail"))
    assert [r["page"] for r in checks.top_per_code(many).orderBy("r").collect()] == list(range(8))


def test_text_layer(spark, profiles):
    squashed = "Beer,Dr.Xx,Behre,C(harles)ANMENOFSCIENCEBechtel,Prof.Belknap,William)E("
    pages = spark.createDataFrame([(1, squashed)], "page int, text string")
    assert {r["surname"] for r in ocr.entry_candidates(pages).collect()} == {"Beer", "Behre", "Bechtel", "Belknap"}
    window = spark.createDataFrame([(1, "a", "zz")], "page int, lo string, hi string")
    p = profiles(*[{"full_name": n} for n in ("Behr, A", "Beer, B", "Zzz, C", "Beer, D", None)])
    found = {(r["code"], r["scientist"]): r["detail"] for r in ocr.text_findings(p, pages, window).collect()}
    assert set(found) == {("surname_misread", "Behre"), ("surname_not_printed", "Zzz"), ("entry_possibly_missed", "Bechtel"), ("entry_possibly_missed", "Belknap")}
    assert found["surname_misread", "Behre"] == "model returned 'Behr' but the page prints 'Behre'"
    assert found["entry_possibly_missed", "Bechtel"] == "the page prints an entry for 'Bechtel' (1x) but no profile with that surname came back"
    p = profiles(*[{"full_name": "A", "birth_date": "March 1, 1889", "source_page": k} for k in (1, 2, 3)], {"full_name": None, "birth_date": "soon"})
    dates = spark.createDataFrame([(1, "xMarch1,89."), (2, "1April1,89."), (3, "nothing")], "page int, text string")
    got = {r["page"]: (r["code"], r["detail"]) for r in ocr.birth_findings(p, dates).collect()}
    assert set(got) == {2, 3} and got[3][0] == "birth_date_not_on_page"
    assert got[2] == ("birth_month_ocr_mismatch", "extracted 'March 1, 1889' but the OCR text layer reads 'April1,89' -- verify the month on the page image")
    text = "AMERICAN MEN OF SCIENCE  Bear , Prof. F(irman) E(dward), Ohio. Bearce, Henry W(alter), x"
    heads = ocr.printed_headings(spark.createDataFrame([(1, text), (2, None), (3, "")], "page int, text string")).orderBy("ordinal").collect()
    assert [r["page"] for r in heads] == [1, 1] and heads[0]["heading"] == "Bear, Prof. F(irman) E(dward)" and heads[1]["heading"].startswith("Bearce, Henry W(alter)")
    p = profiles({"full_name": "Beer, X", "star_status": True}, {"full_name": "Behre, C(harles)"}, {"full_name": "Far, A", "source_page": 3})
    got = ocr.text_findings(p, pages, checks.alpha_window(p)).collect()
    assert {(r["page"], r["code"]) for r in got} >= {(1, "star_mismatch"), (3, "no_text_layer")}


def test_all_texts_of_a_page_count(spark, profiles):
    one, two = "*Beer, Dr. A(nn), x, May 2, 88. Far", ",Dr. Behre, C(arl) x. Gone, C(arl), x, March 1, 89. * Beer, Dr. B(en)"
    rows = [(2, one, "page_text", 1), (5, two, "page_text", 1), (9, one.replace(" ", "\n"), "page_text", 1), (7, two, "page_text", 1), (1, "Zzz, Dr. Z", "letter", 1), (3, None, "page_text", 1), (4, "Zzz, Dr.", "page_text", None)]
    pages = ocr.page_text(spark.createDataFrame(rows, "doc_id bigint, text string, kind string, page_no int"))
    assert [r["text"] for r in pages.collect()] == [one + ocr.TEXT_BREAK + two]
    # The end of one text and the start of the next are no entry.
    assert {r["surname"] for r in ocr.entry_candidates(pages).collect()} == {"Beer", "Behre", "Gone"}
    heads = [(r["ordinal"], r["heading"][:6]) for r in ocr.printed_headings(pages).orderBy("ordinal").collect()]
    assert heads == [(0, "Beer, "), (1, "Behre,"), (2, "Gone, "), (3, "Beer, ")]
    p = profiles({"full_name": "Beer, A(nn)", "birth_date": "May 2, 1888", "birth_year": 1888, "star_status": True}, {"full_name": "Gone, C(arl)", "birth_date": "March 1, 1889", "birth_year": 1889})
    assert [(r["profile_id"], r["n_printed"]) for r in ocr.printed_counts(p, pages).orderBy("profile_id").collect()] == [(1, 2), (2, 1)]
    assert [tuple(r) for r in checks.star_mismatch(p, pages).collect()] == [(1, 2, 1)]
    assert [r["repair_note"] for r in ocr.repair_birth_fields(p, pages).collect()] == ["", ""]
    codes = {(r["code"], r["scientist"]) for r in ocr.text_findings(p, pages, checks.alpha_window(p)).collect()}
    assert codes == {("surname_undercounted", "Beer"), ("entry_possibly_missed", "Behre"), ("star_mismatch", "")}


def test_repair_looks_at_every_text(spark, profiles):
    pages = spark.createDataFrame([(1, "Gone,C(arl),x,nothing" + ocr.TEXT_BREAK + "Gone,C(arl),x,March1,89.y")], "page int, text string")
    p = profiles({"full_name": "Gone, C(arl)", "birth_date": "March 1, 1889", "birth_year": 1889})
    assert ocr.repair_birth_fields(p, pages).first()["repair_note"] == ""


def test_repair_only_removes(spark, profiles):
    text = "Good,A(nna),x,March1,89.y" + "z" * 400 + "Month,B(en),x,April1,89.y" + "z" * 400 + "Gone,C(arl),x,nothing" + "z" * 400 + "Only,D(ora),x"
    pages = spark.createDataFrame([(1, text)], "page int, text string")
    base = {"birth_date": "March 1, 1889", "birth_year": 1889, "birth_place": "Ohio"}
    names = ["Good, A(nna)", "Month, B(en)", "Gone, C(arl)", "Missing, M(ax)", "Only, D(ora)", None]
    p = profiles(*[base | {"full_name": n} for n in names[:4]], {"full_name": names[4], "birth_year": 1889}, base | {"birth_place": "A.B. Stanford"}, base | {"source_page": 8})
    r = {x["profile_id"]: x for x in ocr.repair_birth_fields(p, pages).collect()}
    assert [(r[i]["birth_date"], r[i]["birth_year"]) for i in range(1, 8)] == [("March 1, 1889", 1889), ("March 1, 1889", 1889), (None, None), ("March 1, 1889", 1889), (None, None), (None, None), ("March 1, 1889", 1889)]
    assert r[6]["birth_place"] is None and r[3]["repair_note"].endswith("birth_year stripped too") and r[1]["repair_note"] == ""


@pytest.mark.parametrize("text,name,expected", [
    ("xxBell,A(nn)Bo.yy", "Bell, A(nn)", "Bell,A(nn)Bo.yy"),
    ("Bell,C." + "x" * 20 + "Bell,A(nn)z", "Bell, A(nn) B(o)", "Bell,A(nn)z"),
    ("Bell,Annz", "Bell, A(nn)", "Bell,Annz"),
    ("Bell,C.z", "Bell, A(nn)", None),
    ("St.John,A.z", "St. John, A.", "St.John,A.z"),
    ("Bell,A.z", "Bell", None),
    ("Bell,A.z", None, None),
    ("", "Bell, A", None),
])
def test_entry_slice(spark, text, name, expected):
    df = spark.createDataFrame([(text, name)], "t string, n string")
    assert df.select(ocr.entry_slice(F.col("t"), F.col("n"))).first()[0] == expected


def test_pairs_settled_in_rounds_are_those_of_the_greedy_order():
    rng = np.random.default_rng(3)
    for _ in range(300):
        score = rng.choice([0, 0, 0.85, 0.9, 0.95, 1.0], (rng.integers(0, 7), rng.integers(0, 7)))
        rows, columns, greedy = set(), set(), set()
        for _, i, j in sorted((-score[i, j], i, j) for i, j in zip(*np.nonzero(score), strict=True)):
            if i not in rows and j not in columns:
                rows.add(i)
                columns.add(j)
                greedy.add((i, j))
        assert set(resolve.settle(score)) == greedy


def test_pass_merge_keeps_what_the_page_prints_and_order_of_passes(spark, profiles):
    p = profiles(
        {"full_name": "Behre, J(ohn)"},
        {"full_name": "Behrc, J(ohn)", "pass_no": 2, "department": "Botany", "birth_place": "X"},
        {"full_name": "Behre, J(ohn)", "pass_no": 3, "department": "Botany"},
        {"full_name": None, "pass_no": None, "pos": None},
        {"full_name": None, "pass_no": 2, "pos": 5},
    )
    assert [r["profile_id"] for r in resolve.merge_passes(p).orderBy("ordinal").collect()] == [4, 2, 5]
    pages = spark.createDataFrame([(1, "Behre, J(ohn)")], "page int, text string")
    assert [r["profile_id"] for r in resolve.merge_passes(p, pages).orderBy("ordinal").collect()] == [4, 3, 5]


def test_pass_merge(profiles):
    p = profiles(
        {"full_name": "Behre, J(ohn)", "birth_year": 1880},
        {"full_name": "Cole, A(nn)"},
        {"full_name": "Bchre, J(ohn)", "birth_year": 1880, "department": "Botany", "pass_no": 2, "pos": 0},
        {"full_name": "Drake, B(en)", "pass_no": 2, "pos": 1},
        {"full_name": "Twin, A(nn) B(ee)", "source_page": 2},
        {"full_name": "Twin, A(nn) B(ea)", "source_page": 2},
    )
    got = {(r["source_page"], r["ordinal"]): r["profile_id"] for r in resolve.merge_passes(p).collect()}
    assert got == {(1, 0): 3, (1, 1): 2, (1, 2): 4, (2, 0): 5, (2, 1): 6}
    assert resolve.merge_passes(profiles()).count() == 0


def test_batch(spark):
    def line(text, **body):
        return json.dumps({"custom_id": "page-00075", "error": None, "response": {"status_code": 200, "body": {"output": [{"type": "message", "content": [{"type": "output_text", "text": text}, {"type": "refusal", "refusal": "no"}]}]} | body}})

    rows = [line('```json\n{"a": 1}\n```', usage={"input_tokens": 5, "input_tokens_details": {"cached_tokens": 2}}), line("{broken"), line(" "), line("{}", incomplete_details={"reason": "max_output_tokens"}), '{"custom_id": "page-00001", "error": {"m": 1}}', '{"custom', None]
    df = spark.createDataFrame(list(enumerate(rows)), "record_id int, raw_json string")
    got = {r["record_id"]: r for r in batch.decode(df).collect()}
    assert [got[i]["outcome"] for i in range(7)] == ["ok", "unparseable", "empty", "truncated", "error", "corrupt", "corrupt"]
    assert (got[0]["page"], got[0]["input_tokens"], got[0]["cached_tokens"], got[0]["output_tokens"], got[0]["refusal"]) == (75, 5, 2, 0, "no")
    assert batch.dead_letters(batch.decode(df)).count() == 6
    calls = spark.createDataFrame([("large", 1_000_000, 0, 100_000, False), ("large", 1_000_000, 0, 100_000, True), ("none", 9, 0, 9, False)], "model string, i bigint, c bigint, o bigint, b boolean")
    assert [r[0] for r in calls.select(batch.cost(*[F.col(c) for c in ("model", "i", "c", "o", "b")])).collect()] == [8.0, 4.0, 0.0]
    sizes = spark.createDataFrame([(i, n) for i, n in enumerate([5, 6, 20, 1, 1, 1, 1])], "request_no bigint, bytes bigint")
    assert [r["file_no"] for r in batch.pack_requests(sizes, 10, 3).orderBy("request_no").collect()] == [1, 2, 3, 4, 4, 4, 5]


def test_files(spark, tmp_path, profiles):
    log = tmp_path / "passes.jsonl"
    log.write_text('{"focus_page_number": 1, "status": "ok", "scientists": [{"full_name": "A", "birth_year": 1898.0}, {"full_name": "B"}]}\n\nbroken\n{"focus_page_number": 2, "status": "failed"}\n')
    passes = files.read_passes(spark, str(log)).cache()
    assert passes.where("_corrupt_record is not null").count() == 1
    assert [r["pos"] for r in files.profiles_of(passes).orderBy("pos").collect()] == [0, 1]
    done = files.completed_pages(passes)
    pages = spark.createDataFrame([(1,), (2,), (3,), (9,)], "page int")
    assert sorted(r[0] for r in files.remaining_pages(pages, done, 1, 5).collect()) == [2, 3]
    assert files.page_attempts(passes, 1).count() == 1
    with pytest.raises(Exception):
        files.read_passes(spark, str(log), strict=True).collect()
    table = spark.createDataFrame([("error", "c", 2, "A", 'say "x"; y'), ("warn", "b", 1, "", None)], "severity string, code string, page int, scientist string, detail string")
    files.write_findings(table, str(tmp_path / "f"))
    back = {(r["page"], r["scientist"]): r["messages"] for r in files.read_findings(spark, str(tmp_path / "f")).collect()}
    assert back == {(2, "A"): ['ERROR: c -- say "x"; y'], (1, None): ["WARN: b"]}
    assert files.export_single_file(table, str(tmp_path / "x.csv")) == 2
    assert (tmp_path / "x.csv").read_bytes().startswith(b"\xef\xbb\xbf")
    files.append_passes(passes.where("status = 'ok'").select("focus_page_number", "status"), str(tmp_path / "log"))
    files.append_passes(passes.where("status = 'ok'").select("focus_page_number", "status"), str(tmp_path / "log"))
    assert files.read_passes(spark, str(tmp_path / "log")).count() == 2


def test_release_and_codebook(spark, profiles):
    p = profiles({"full_name": "Zed"}, {"full_name": "Bell, A", "employment": [job("x", "A", 1900)]})
    b = spark.createDataFrame([(1, "A", 1, "Town", "", "", "")], BRIDGE)
    e = publish.release_order(publish.released_events(p, b)).collect()
    assert e[0]["institution_city"] == "Town" and e[0]["last_name"] == "Bell"
    assert {r["measure"]: r["value"] for r in publish.headline(p, b).collect()} == {"scientists": 2, "starred": 0, "events": 1, "events_with_place": 1}
    assert publish.codebook({"t": b}).count() == 7


def test_group_breaks_and_first_rows(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3), (2, "b", 4), (None, "a", 0)], "page int, name string, i int")
    got = {r["i"]: r["is_break"] for r in review.group_breaks(df.where("page is not null"), ["page", "name"], "page", ["name", "i"]).collect()}
    assert got == {1: False, 2: False, 3: True, 4: True}
    assert sorted(r["i"] for r in review.first_of_each(df, {"k": F.col("name")}, ["i"]).collect()) == [0, 3]


def naive_files(sizes, max_bytes, max_requests):
    number, held, count, out = 0, 0, 0, []
    for n in sizes:
        if number == 0 or held + n > max_bytes or count >= max_requests:
            number, held, count = number + 1, 0, 0
        held, count = held + n, count + 1
        out.append(number)
    return out


def test_packing_in_blocks_equals_one_by_one(spark, monkeypatch):
    rng = np.random.default_rng(5)
    for _ in range(200):
        sizes, limit, most = rng.integers(0, 12, rng.integers(0, 40)), int(rng.integers(1, 30)), int(rng.integers(1, 9))
        state, got = (0, 0, 0), []
        for part in np.array_split(sizes, 4):
            numbers, state = batch._files_of(part, state, limit, most)
            got += numbers.tolist()
        assert got == naive_files(sizes.tolist(), limit, most)
    monkeypatch.setattr(batch, "BLOCK", 7)
    sizes = rng.integers(1, 12, 100).tolist()
    df = spark.createDataFrame(list(enumerate(sizes)), "request_no bigint, bytes bigint").repartition(4)
    assert [r["file_no"] for r in batch.pack_requests(df, 20, 4).orderBy("request_no").collect()] == naive_files(sizes, 20, 4)
    assert batch.pack_requests(df.where("bytes < 0")).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_nested_loops_and_no_python_where_none_is_needed(spark, data):
    from annuary.plans import catalog

    for name in ("propose_targets", "address_votes", "bridge_refresh", "duplicate_entities", "findings_flags"):
        plan = plan_of(catalog.QUERIES[name](spark, data))
        assert "BroadcastNestedLoopJoin" not in plan.replace("BroadcastNestedLoopJoin BuildRight, Inner\n", "") or name == "x"
        assert "CartesianProduct" not in plan
    for name in ("subtractive_repair", "printed_headings", "printed_count", "ingest_panel", "balanced_panel"):
        plan = plan_of(catalog.QUERIES[name](spark, data))
        assert not [x for x in ("MapInPandas", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroups") if x in plan]
    for name in ("profile_checks", "events_long", "profile_summary"):
        assert "Exchange" not in plan_of(catalog.QUERIES[name](spark, data))


def test_votes_of_names_that_begin_alike(spark, profiles):
    p = profiles(
        {"mailing_address": "University of Ames, Ames Hall", "mailing_city": "Town", "employment": [job("x", "University of Ames"), job("x", "Univ. of Am")]},
        {"mailing_address": "Univ of Boone", "mailing_city": "Other", "employment": [job("x", "University of Boone"), job("x", "MIT Lab"), job("x", "No Such Place")]},
        {"mailing_address": "MIT Laboratory", "mailing_city": "Third"},
    )
    got = {(r["institution"], r["city"], r["votes"]) for r in bridge.address_votes(p).collect()}
    assert got == {("University of Ames", "Town", 1), ("Univ. of Am", "Town", 1), ("MIT Lab", "Third", 1)}


def test_very_common_names_are_listed_in_part(spark, monkeypatch, profiles):
    monkeypatch.setattr(checks, "LISTED_PAGES", 3)
    p = profiles(*[{"full_name": None, "source_page": k} for k in (1, 1, 2, 3, 4)], {"full_name": "A", "source_page": 9}, {"full_name": "A", "source_page": 9})
    assert {r["scientist"]: (r["page"], r["detail"]) for r in checks.duplicate_entities(p).collect()} == {"": (4, "appears on pages [1, 1, 2 and 2 more]"), "A": (9, "appears on pages [9, 9]")}


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    from annuary.streaming import tables

    schema = "focus_page_number int, status string, received_at timestamp, record_id long"
    rows = lambda *r: spark.createDataFrame([(p, "ok", None, i) for p, i in r], schema)
    at, name = str(tmp_path / "in"), f"test-{tmp_path.name}-{os.getpid()}"
    run = lambda: {r["focus_page_number"]: (r["n_passes"], r["last_record"]) for r in tables.drain(tables.latest_passes(tables.stream_of(spark, at + "/", schema)), ["focus_page_number"], name).collect()}
    rows((1, 1), (2, 2)).write.parquet(at)
    assert run() == {1: (1, 1), 2: (1, 2)}
    assert run() == {1: (1, 1), 2: (1, 2)}
    rows((2, 3), (3, 4)).write.mode("append").parquet(at)
    assert run() == {1: (1, 1), 2: (2, 3), 3: (1, 4)}


def test_late_events_are_left_out(spark, tmp_path):
    import datetime

    from annuary.streaming import tables

    schema = "ts timestamp, event_type string, value double"
    at, name = str(tmp_path / "in"), f"late-{tmp_path.name}-{os.getpid()}"
    day = lambda n: datetime.datetime(2026, 1, n)

    def run(*days):
        spark.createDataFrame([(day(d), "a", 1.0) for d in days], schema).coalesce(1).write.mode("append").parquet(at)
        out = tables.drain(tables.windowed_counts(tables.stream_of(spark, at + "/", schema)), ["window_start", "event_type"], name)
        return {r["window_start"].day: r["n"] for r in out.collect()}

    assert run(1, 1, 9) == {1: 2, 9: 1}
    assert run(9, 10) == {1: 2, 9: 2, 10: 1}
    assert run(1, 10) == {1: 2, 9: 2, 10: 2}


def test_wide_panel_shows_the_long_slots(spark, data):
    p = spark.read.parquet(f"{data}/scientist_profiles.parquet")
    wide = {(r["profile_id"], r["year"]): r for r in panel.panel_wide(p).collect()}
    n = 0
    for r in panel.slots_long(p).collect():
        role, place = {"deg": ("degree_earned", "degree_institution"), "prim": ("position", "institution"), "par": ("parallel_position", "parallel_institution")}[r["kind"]]
        row = wide[r["profile_id"], r["year"]]
        assert (row[f"{role}_{r['slot']}"], row[f"{place}_{r['slot']}"]) == (r["role"], r["institution"])
        n += 1
    filled = sum(row[f"{name}_{i}"] != "" for row in wide.values() for name in ("degree_earned", "position", "parallel_position") for i in range(1, 20) if f"{name}_{i}" in row.__fields__)
    assert n and filled <= n
