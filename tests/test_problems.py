"""Key skew, nested records and intervals: brute force and edge cases."""

import json
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annuary.operators import nested
from annuary.operators.career import career_timeline
from annuary.operators.dense_count import dense_counts
from annuary.operators.intervals import periods_and_gaps
from annuary.plans.problems import PROFILE_FLAT
from annuary.session import cut_lineage, numbered, salted_join

from .conftest import job


def test_dense_counts_equal_a_plain_count(spark):
    rows = [(i % 3, "hot") for i in range(500)] + [(1, f"k{i % 7}") for i in range(70)] + [(None, "hot"), (1, None), (1, ""), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "shard int, name string").withColumn("key", F.lit(1)).withColumn("n", F.lit(2)).withColumn("block", F.lit("x")).repartition(5)
    got = {(r["shard"], r["name"]): r["rows"] for r in dense_counts(df, {"shard": F.col("shard"), "name": F.col("name")}, "rows").collect()}
    assert got == Counter(rows)


def test_dense_counts_flush_and_empty(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") % 400).cast("string").alias("k"))
    import annuary.operators.dense_count as m

    monkeypatch.setattr(m, "FLUSH_KEYS", 50)
    assert {r["n"] for r in dense_counts(df, {"k": F.col("k")}).collect()} == {2, 3}
    assert dense_counts(df.where("k = 'none'"), {"k": F.col("k")}).count() == 0


def brute(intervals):
    out = []
    for e in {i[0] for i in intervals}:
        on = sorted({y for x, a, b in intervals if x == e and a is not None and b is not None for y in range(a, b + 1)})
        runs = []
        for y in on:
            if runs and runs[-1][1] == y - 1:
                runs[-1][1] = y
            else:
                runs.append([y, y])
        out += [(e, "period", a, b) for a, b in runs]
        out += [(e, "gap", runs[i][1] + 1, runs[i + 1][0] - 1) for i in range(len(runs) - 1)]
    return Counter(out)


def check_intervals(spark, rows):
    df = spark.createDataFrame(rows, "who string, lo int, hi int").withColumn("a", F.lit("x")).withColumn("e", F.lit("y")).withColumn("shard", F.lit(0))
    got = Counter((r["who"], r["kind"], r["start"], r["stop"]) for r in periods_and_gaps(df, "who", "lo", "hi").collect())
    assert got == brute(rows)


def test_intervals_fixed(spark):
    check_intervals(spark, [("a", 0, 59), ("a", 60, 60), ("a", 62, 500), ("b", -5, -1), ("b", 1, 1), ("b", 1, 1), ("c", 5, 3), ("d", None, 4), (None, 1, 2), (None, 4, 4), ("e", 0, 1000), ("e", 100, 200), ("f", 119, 120), ("f", 180, 239), ("g", 0, 119), ("g", 120, 179)])


def test_intervals_empty(spark):
    assert periods_and_gaps(spark.createDataFrame([], "who string, lo int, hi int"), "who", "lo", "hi").count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(-200, 700), st.integers(0, 400)), max_size=30))
def test_intervals_random(spark, rows):
    check_intervals(spark, [(w, a, a + n) for w, a, n in rows] or [("z", 1, 1)])


def test_career_timeline(profiles):
    p = profiles(
        {"education": [("A.B", "x", 1890, None), None, (None, "y", 1892, 1894)], "employment": [job("a", "b", 1895, 1900), job("c", "d", None, None, True)], "minor_positions": [job("m", None, 1929, 1931)]},
        {},
        {"education": [], "employment": [job("x", "y", 1905, 1900)], "societies": []},
    )
    got = {(r["profile_id"], r["kind"], r["from_year"], r["to_year"]) for r in career_timeline(p).collect()}
    assert got == {(1, "period", 1890, 1890), (1, "gap", 1891, 1891), (1, "period", 1892, 1900), (1, "gap", 1901, 1926), (1, "period", 1927, 1927), (3, "period", 1900, 1905)}


def page(*scientists, **more):
    return json.dumps({"focus_page_number": 1, "scientists": list(scientists)} | more)


def envelope(*texts):
    content = [{"type": "output_text", "text": t} for t in texts] + [{"type": "refusal", "refusal": "no"}]
    return json.dumps({"custom_id": "page-00001", "error": None, "response": {"status_code": 200, "body": {"output": [{"type": "reasoning", "content": []}, {"type": "message", "content": content}]}}})


PERSON = {"full_name": "A", "education": [{"degree_type": "A.B", "year": "1890"}, None, {"degree_type": "A.M"}], "minor_positions": "collab", "societies": {"name": "S"}, "employment": None}
OTHER = {"societies": ["x", None, "x", {"name": "y", "since": 3}], "education": {"degree_type": "Ph.D", "deep": {"list": [[1, {"z": 2}]]}}}


@pytest.fixture(scope="module")
def records(spark):
    whole = page(PERSON, None, OTHER)
    rows = [
        (1, "ok", whole),
        (2, "ok", whole),
        (3, "ok", envelope("```json\n" + whole[:20], whole[20:] + "\n```")),
        (4, "ok", whole[:-5]),
        (5, "ok", envelope(whole[:-9])),
        (6, "failed", whole),
        (7, "ok", None),
        (8, None, whole),
        (9, "ok", ""),
        (10, "ok", "[1]"),
        (11, "ok", json.dumps({"scientists": PERSON})),
        (12, "ok", "[" * 100_000),
        (13, "ok", page({"societies": ["s" * 200_000]})),
        (14, "ok", json.dumps({"scientists": None})),
    ]
    return spark.createDataFrame(rows, "record_id bigint, status string, raw_json string").withColumn("root", F.lit("clash")).withColumn("node", F.lit("clash"))


def expected_items(scientists):
    out = []
    for i, s in enumerate(scientists):
        for name in nested.LISTS if isinstance(s, dict) else ():
            v = s.get(name)
            out += [(i, name, k) for k, x in enumerate(v if isinstance(v, list) else [v]) if x is not None]
    return out


def test_list_items(records):
    roots, nodes, edges = nested.merkle_tables(records)
    got = Counter(tuple(r) for r in nested.list_items(roots, edges).select("record_id", "scientist_pos", "list_name", "item_pos").collect())
    want = Counter()
    for record, scientists in ((1, [PERSON, None, OTHER]), (2, [PERSON, None, OTHER]), (3, [PERSON, None, OTHER]), (11, [PERSON]), (13, [{"societies": ["s"]}])):
        want += Counter((record, *x) for x in expected_items(scientists))
    assert got == want
    # Copies of an object are one node, and a page stored twice has one root.
    assert roots.where("record_id in (1, 2)").select("root").distinct().count() == 1
    assert nodes.count() == nodes.select("node").distinct().count()
    assert edges.count() == edges.distinct().count()


def test_flat_lists(records):
    tables = nested.merkle_tables(records)
    s = {(r["record_id"], r["scientist_pos"], r["item_pos"]): (r["name"], r["since"]) for r in nested.flat_list(*tables, "societies", {"name": "name", "since": "since"}, "name").collect()}
    assert s[1, 0, 0] == ("S", None) and s[1, 2, 0] == ("x", None) and s[1, 2, 3] == ("y", "3") and len(s[13, 0, 0][0]) == 200_000
    m = nested.flat_list(*tables, "minor_positions", {"position_title": "position_title"}, "position_title").where("record_id = 11").collect()
    assert [r["position_title"] for r in m] == ["collab"]


def test_identity_ignores_field_order():
    a, b = {}, {}
    one = nested.shred({"x": 1, "l": [{"p": 1, "q": 2}]}, frozenset({"l"}), a, set())
    two = nested.shred({"l": [{"q": 2, "p": 1}], "x": 1}, frozenset({"l"}), b, set())
    assert one == two and a == b
    assert nested.shred({"l": [1, 2]}, frozenset({"l"}), {}, set()) != nested.shred({"l": [2, 1]}, frozenset({"l"}), {}, set())


def test_nested_empty(spark):
    roots, nodes, edges = nested.merkle_tables(spark.createDataFrame([], "record_id bigint, status string, raw_json string"))
    assert nested.list_items(roots, edges).count() == 0 and nodes.count() == 0


def test_profile_lists_keep_every_field(spark, profiles):
    schooling = [("A.B", "Yale", 1901, None), None, (None, None, None, None), ("Ph.D", 'a "b" \\ é\n', 1904, 1905)]
    jobs = [job("asst", "Iowa", 1900, 1902), job("prof", None, 1903, None, True), job("asst", "Iowa", 1900, 1902)]
    p = profiles(
        {"source_page": 7, "education": schooling, "employment": jobs, "minor_positions": [job("collab", "U.S", None, 1910)], "societies": ["A", None, "{x", "", "A"]},
        {"source_page": 9, "employment": jobs, "education": []},
        {"source_page": 9, "employment": jobs, "education": []},
    )
    tables = nested.profile_tables(p)
    flat = {name: Counter(tuple(r) for r in nested.flat_profile_list(*tables, name, *PROFILE_FLAT[name]).collect()) for name in nested.LISTS}
    assert flat["education"] == Counter((1, 7, i, *x) for i, x in enumerate(schooling) if x is not None)
    assert flat["employment"] == Counter((i, page, k, *x) for i, page in ((1, 7), (2, 9), (3, 9)) for k, x in enumerate(jobs))
    assert flat["minor_positions"] == Counter([(1, 7, 0, "collab", "U.S", None, 1910, False)])
    assert flat["societies"] == Counter([(1, 7, 0, "A"), (1, 7, 2, "{x"), (1, 7, 3, ""), (1, 7, 4, "A")])
    # Equal objects are one node, equal lists one root.
    assert tables[0].count() == 3 and tables[0].select("root").distinct().count() == 2
    assert tables[1].where("content like '%asst%'").count() == 1


DEEP = 20_000


def test_pages_nested_to_any_depth(spark):
    deep = '{"scientists": [{"education": [' + '{"x": [' * DEEP + '"end"' + "]}" * DEEP + ', "B.A"]}]}'
    rows = [
        (1, "ok", deep),
        (2, "ok", '{"scientists": {"societies": "AAAS", "education": [[{"year": 1900}], null, [[]]]}}'),
        (3, "ok", '{"scientists": [{"education": [' * 3_000),
        (4, "ok", "[]"),
        (5, "ok", None),
        (6, "failed", deep),
        (7, None, "{}"),
    ]
    df = spark.createDataFrame(rows, "record_id bigint, status string, raw_json string").withColumn("root", F.lit("clash"))
    records, nodes, edges = nested.merkle_tables(df)
    got = {tuple(r) for r in nested.list_items(records, edges).select("record_id", "scientist_pos", "list_name", "item_pos").collect()}
    assert got == {(1, 0, "education", 0), (1, 0, "education", 1), (2, 0, "societies", 0), (2, 0, "education", 0), (2, 0, "education", 2)}
    assert {tuple(r) for r in nested.unread_records(df).collect()} == {(3, "damaged"), (4, "damaged"), (5, "no text"), (6, "status failed"), (7, "status ")}
    # The object inside the inner list has an identity and an edge of its own.
    inner = nodes.where("content = '{\"year\": 1900}'").first()["node"]
    assert edges.where(F.col("child") == F.lit(inner)).first()["field"] == ""
    assert nodes.where("content = '\"end\"'").count() == 1


def test_parser_for_deep_texts_agrees_with_the_usual_one():
    whole = ['{"a": [1, -2.5e3, "x\\"\\u00e9", true, null, {}, []], "b": {"c": [[1], [2, {"d": "e"}]]}}', " [ ] ", '"s"', "12", '{"a":1,"a":2}']
    for text in whole:
        assert nested._parse_deep(text) == json.loads(text)
    for text in ["", "{", "[1,]", '{"a" 1}', '{"a":}', "[1 2]", '{"a":1,}', "tru", "[1]]", '"open', "{1:2}"]:
        with pytest.raises(ValueError):
            nested._parse_deep(text)


def test_salted_join_and_numbers(spark):
    left = spark.range(20_000).select(F.when(F.col("id") < 15_000, 1).otherwise(F.col("id")).alias("k"), "id")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (15_000, "c")], "k bigint, v string")
    got = salted_join(cut_lineage(left), right, ["k"], F.col("id"), 8)
    assert got.count() == got.distinct().count() == 30_001 and set(got.columns) == {"k", "id", "v"}
    placed = numbered(left.repartition(5), [F.desc("k"), F.asc("id")])
    want = left.orderBy(F.desc("k"), "id").toPandas()["id"].tolist()
    assert placed.orderBy("ordinal").toPandas()["id"].tolist() == want and tuple(placed.agg(F.min("ordinal"), F.max("ordinal")).first()) == (1, 20_000)
    assert numbered(left.where("id < 0"), [F.asc("id")]).count() == 0
