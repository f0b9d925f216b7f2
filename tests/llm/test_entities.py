"""Entries, addresses, names and canonical values: brute force, known cases and edge cases."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from annuary.llm import addresses, canonical, classes, names, orgnames, survivors
from annuary.llm.bktree import BKTree
from tests.conftest import job


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_edit_distance_and_tree():
    rng = random.Random(2)
    some = ["".join(rng.choice("abc") for _ in range(rng.randrange(9))) for _ in range(150)]
    for a, b in zip(some, reversed(some), strict=True):
        assert orgnames.edit_distance(a, b) == plain_distance(a, b)
    tree = BKTree((w, i) for i, w in enumerate(some))
    for q in some[:20]:
        want = sorted(i for i, w in enumerate(some) if plain_distance(q, w) <= 2)
        assert sorted(i for _, _, v in tree.within(q, 2) for i in v) == want
    assert BKTree().within("a", 3) == []


@pytest.mark.parametrize(
    "text,stem,kind",
    [
        ("Univ'y of Jombiaser", "jombiaser", "university"),
        ("Jombiaser, University of, Flaffiquist Falls", "jombiaser", "university"),
        ("Chem. Comp'y, Kedduiton", "kedduiton", "chemical company"),
        ("So. Glagnubel Agr Col", "south glagnubel", "agricultural college"),
        ("Techn. Hochsch. Kroffoastow.", "kroffoastow", "hochschule technische"),
        ("Universität Dombanar", "dombanar", "university"),
        ("Bur of Stds., Dodagar", "dodagar", "bureau standards"),
        ("Brediocombe Medical Col1ege", "brediocombe", "college medical"),
    ],
)
def test_organisation_parts(text, stem, kind):
    p = orgnames.parse(text)
    assert (p.stem, p.kind) == (stem, kind)


def test_no_organisation_and_initials():
    for text in (None, "", "  ", "abroad", "private practice", "various companies", "consulting work"):
        assert orgnames.parse(text) is None
    assert orgnames.parse("K.S.C.").initials == "ksc" and orgnames.parse("B. N. S").initials == "bns"
    assert orgnames.parse("Gabor. Chem. Co").cut and not orgnames.parse("Braleiworth University.").cut


BRIDGE = "bridge_id bigint, shard int, institution string, n_events int, city string"


def linked(spark, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], BRIDGE).withColumn("node", F.lit("clash")).withColumn("stem", F.lit("clash")).withColumn("root", F.lit(0))
    return {(r["bridge_id_a"], r["bridge_id_b"]) for r in names.linked_rows(df).collect()}


def test_variants_are_linked(spark):
    got = linked(
        spark,
        (0, "Dagnuilock College", 400, "Dorgastow"),
        (0, "Col., Dagnuilock", 2, None),
        (0, "DAGNUI. COLLEGE", 1, None),
        (0, "Dagniulock Coll.", 1, "several"),
        (0, "Dagnuilock", 3, "Dorgastow"),
        (1, "Dagnuilock College", 9, None),
        (0, "Dagnuilock Hospital", 9, "Elsewhere"),
        (0, "abroad", 5, None),
        (0, "abroad", 5, None),
        (0, None, 5, None),
        (0, "", None, None),
        (None, "Dagnuilock College", 5, None),
        (0, "Dagnuilock College", 400, "Dorgastow"),
        (0, "x" * 50_000, 1, None),
    )
    same = {0, 1, 2, 3, 4, 12}
    assert got == set(itertools.combinations(sorted(same), 2))


def test_directions_and_near_names_stay_apart(spark):
    got = linked(
        spark,
        (0, "South Keckionar Agricultural College", 50, "Aberby"),
        (0, "North Keckionar Agricultural College", 50, "Borby"),
        (0, "No. Keckionar Agr. Coll.", 1, None),
        (0, "Kebiomer Observatory", 30, "Aberby"),
        (0, "Kebiomer Observatory.", 30, "Aberby"),
        (0, "Kelbioser Observatory", 20, "Camby"),
        (0, "Kelbioser Obs", 20, "Camby"),
    )
    assert got == {(1, 2), (3, 4), (5, 6)}


def test_university_of_is_not_the_other_university(spark):
    got = linked(
        spark,
        (0, "University of Staldaeris", 40, "Coroaris"),
        (0, "Staldaeris, Univ. of", 3, None),
        (0, "Staldaeris University", 30, "Gelkoworth"),
        (0, "Univ., Staldaeris", 2, "unknown"),
        (0, "U. of Membefield", 9, "Boddaurose"),
        (0, "University Membefield", 1, None),
    )
    assert got == {(0, 1), (2, 3), (4, 5)}


def test_repeated_rows_do_not_decide_a_link(spark):
    once = [(0, "U. of Membefield", 9, "Boddaurose"), (0, "University Membefield", 1, None)]
    again = [*once, (0, "University Membefield", 1, None), (0, "UNIVERSITY, Membefield.", 1, None)]
    assert linked(spark, *once) == {(0, 1)}
    assert linked(spark, *again) == {(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)}


def test_segment_join_finds_all_within_k(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("aeioublmnrst") for _ in range(rng.randrange(5, 12))) for _ in range(25)]
    some = set(base)
    for w in base:
        for _ in range(4):
            c = list(w)
            for _ in range(rng.randrange(1, 3)):
                at = rng.randrange(len(c))
                c[at : at + 1] = rng.choice([[], ["x"], [c[at], "y"]])
            some.add("".join(c))
    some = sorted(some | {"a", "ab", "abc", "abd"})
    df = spark.createDataFrame([(i, 0, w, "", "college", False, "") for i, w in enumerate(some)], "node bigint, shard int, stem string, head string, kind string, cut boolean, initials string")
    twice = df.unionByName(df.withColumn("node", F.col("node") + 1000).withColumn("kind", F.lit("hospital")))
    got = {(r["x"], r["y"]): r["d"] for r in names.segment_pairs(twice).where("x < 1000").collect()}
    want = {(i, j): plain_distance(a, b) for i, a in enumerate(some) for j, b in enumerate(some) if i != j and plain_distance(a, b) <= names.limit_of(min(len(a), len(b)))}
    assert got == want


def test_segment_join_of_short_stems_and_bare_ones(spark):
    rows = [(1, "ab", "college"), (2, "ab", ""), (3, "abcdef", ""), (4, "abxdef", "college"), (5, "abxdef", "hospital")]
    df = spark.createDataFrame([(n, 0, s, "", k, False, "") for n, s, k in rows], "node bigint, shard int, stem string, head string, kind string, cut boolean, initials string")
    assert {(r["x"], r["y"]) for r in names.segment_pairs(df).collect()} == {(2, 1), (3, 4), (3, 5)}


def test_cut_stems_find_all_beginnings_within_one_edit(spark):
    rng = random.Random(4)
    full = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(150)})
    cut = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 8))) for _ in range(60)})
    rows = [(i, 0, w, "", "college", False, "") for i, w in enumerate(full)] + [(1000 + i, 0, w, "", "college", True, "") for i, w in enumerate(cut)]
    df = spark.createDataFrame(rows, "node bigint, shard int, stem string, head string, kind string, cut boolean, initials string")
    got = {(r["x"] - 1000, r["y"]): r["d"] for r in names.beginning_pairs(df).collect()}
    want = {}
    for i, a in enumerate(cut):
        for j, b in enumerate(full):
            d = plain_distance(a, b[: len(a)])
            if d <= (0 if len(a) <= 3 else 1):
                want[i, j] = d
    assert got == want


def test_names_cut_short_with_a_misprint_are_linked(spark):
    assert linked(spark, (0, "Gaborfeld Chemical Company", 9, None), (0, "Gaxorfe. Chem. Co", 1, None)) == {(0, 1)}


def test_two_edits_need_a_common_town(spark):
    far = [(0, "Hiniasall Medical College", 5, None), (0, "Hankiasall Medical College", 3, "Mombeford")]
    assert linked(spark, *far) == set()
    near = [(0, "Brediacombe Electric Company", 5, "Mombeford"), (0, "Bredioecombe Electric Co", 3, "Mombeford")]
    assert linked(spark, *near) == {(0, 1)}


def test_classes_of_organisations(spark):
    rows = [(7, 0, "Dagnuilock College", 4, None), (3, 0, "Coll., Dagnuilock", 2, None), (5, 1, "Dagnuilock College", 4, None), (6, 0, "abroad", 4, None)]
    got = {tuple(r) for r in names.organisation_classes(spark.createDataFrame(rows, BRIDGE)).collect()}
    assert got == {(7, 3, 1), (3, 3, 1), (5, 5, 0)}


def test_names_empty(spark):
    assert names.linked_rows(spark.createDataFrame([], BRIDGE)).count() == 0


@pytest.mark.parametrize(
    "text,city,expected",
    [
        ("Dept. of Physics, Joffiaulnd, 809 Mardagar, Baffaenar, Md.", "Baffaenar", ("809", "", "mardagar", "", "baffaenar")),
        ("No. 621 Daboafield Avnue, Chirbiomond, N. J", None, ("621", "", "daboafield", "avenue", "chirbiomond")),
        ("BAFFAENAR, MARYLAND, 1542 JANTEISALL STREET", None, ("1542", "", "janteisall", "street", "baffaenar")),
        ("So. Nabbeworth Road, no. 859, brarbeigan, Minn", None, ("859", "south", "nabbeworth", "road", "brarbeigan")),
        ("Raruton St 817, Bockaurell, NY", None, ("817", "", "raruton", "street", "bockaurell")),
        ("337 Fabbagar St, St. Glarbuham (near), Mich", "St. Glarbuham", ("337", "", "fabbagar", "street", "saint glarbuham")),
    ],
)
def test_address_parts(text, city, expected):
    a = addresses.parse(text, city)
    assert (a.number, a.direction, a.street, a.kind, a.town) == expected


def test_same_location(spark, profiles):
    rows = [
        ("621 Daboafield Avenue, Chirbiomond, N. J", "Chirbiomond"),
        ("No. 621 Daboafeild Ave., CHIRBIOMOND, New Jersey", None),
        ("Chirbiomond, N.J., 621 Daboafield", "Chirbiomond"),
        ("621 Daboafield Road, Chirbiomond", "Chirbiomond"),
        ("621 Daboafield Avenue, Otherton", "Otherton"),
        ("622 Daboafield Avenue, Chirbiomond", "Chirbiomond"),
        ("621 Daboafield Avenue, Chirbiomond, N. J", "Chirbiomond"),
        (None, "Chirbiomond"),
        ("  ", None),
        ("Chirbiomond, N. J", "Chirbiomond"),
        ("621 East Daboafield Avenue, Chirbiomond", "Chirbiomond"),
        ("621 West Daboafield Avenue, Chirbiomond", "Chirbiomond"),
        ("9 " + "x" * 100_000, None),
    ]
    p = profiles(*[{"mailing_address": a, "mailing_city": c} for a, c in rows])
    got = {(r["profile_id_a"], r["profile_id_b"]) for r in addresses.same_location(p).collect()}
    parsed = [addresses.parse(*r) for r in rows]
    want = {(i + 1, j + 1) for i, j in itertools.combinations(range(len(rows)), 2) if parsed[i] and parsed[j] and rows[i][0] != rows[j][0] and addresses.same_place(parsed[i], parsed[j])}
    assert got == want and {(1, 2), (1, 3), (2, 7), (3, 4)} <= got
    assert not {(1, 4), (1, 5), (1, 6), (1, 7), (11, 12)} & got
    assert addresses.same_location(profiles()).count() == 0


def test_columns_verify_like_the_plain_functions(spark):
    rng = random.Random(6)
    pick = lambda *x: rng.choice(x)
    some = [addresses.Address(pick("", "12", "13"), pick("", "north", "south"), pick("", "elm", "eln", "daboafield", "daboafeild"), pick("", "street", "road"), pick("", "ames", "amse", "chirbiomond", "otherton"), pick("", "mass", "md")) for _ in range(120)]
    fields = addresses._FIELDS
    rows = [(i, j, *[getattr(a, f) for f in fields], *[getattr(b, f) for f in fields]) for i, a in enumerate(some) for j, b in enumerate(some) if i < j]
    df = spark.createDataFrame(rows, ["a", "b", *[f"a_{f}" for f in fields], *[f"b_{f}" for f in fields]])
    got = {(r["a"], r["b"]) for r in df.where(addresses.is_same_place()).collect()}
    assert got == {(i, j) for i, j, *_ in rows if addresses.same_place(some[i], some[j])} and got
    assert addresses.contained(addresses.Address("12", "", "elm", "street", "", ""), addresses.Address("12", "", "elm", "", "ames", "")) == 17 / 19


def test_place_classes(spark, profiles):
    rows = ["621 Daboafield Avenue, Chirbiomond", "No. 621 Daboafeild Ave., CHIRBIOMOND", "621 Daboafield Avenue, Chirbiomond", "Chirbiomond", None, "7 Elm St, Ames"]
    got = {tuple(r) for r in addresses.place_classes(profiles(*[{"mailing_address": a} for a in rows])).collect()}
    assert got == {(1, 1, 1), (2, 1, 1), (3, 1, 1), (6, 6, 0)}
    assert addresses.place_classes(profiles()).count() == 0


def test_short_streets_without_a_town(spark, profiles):
    rows = ["12 Elm St", "12 Elm Street, Chirbiomond", "12 Eln St", "13 Elm St", "12 Oak Ave", "12 Oak Avenue", "12 Oaks Avenue, Daboaville"]
    p = profiles(*[{"mailing_address": a} for a in rows])
    got = {(r["profile_id_a"], r["profile_id_b"]) for r in addresses.same_location(p).collect()}
    assert got == {(1, 2), (1, 3), (2, 3), (5, 6), (5, 7), (6, 7)}


def test_canonical_values(spark):
    entries = [
        (1, "institution", "Dagnuilock College", "Mich", "USA"),
        (2, "institution", "South Perkuvin Agricultural College", "Ohio", "USA"),
        (3, "city", "Saint Haddaedale", "Kans", "USA"),
        (4, "country", "USA", None, None),
        (5, "country", "France", None, None),
        (6, "department", "Physical chemistry", None, None),
        (7, "department", "Plant physiology", None, None),
        (8, "department", "Physics", None, None),
        (9, "country", "China", None, None),
        (10, "city", None, None, None),
    ]
    listed = spark.createDataFrame(entries, "ref_id bigint, list_name string, entry string, state_region string, country string").withColumn("value", F.lit("clash"))
    bridge = spark.createDataFrame(
        [(1, "Dagnuilock College", "Saint Haddaedale", "Kans", "USA"), (2, "Coll., Dagnuilock", "ST. HADDAEDALE City", None, "Unites States"), (3, "So. Perkuvin Agr. Coll", "Haddaedale Junction", None, "Frnace"), (4, "Perkuvin", None, None, "Chile"), (5, "Dagnuilock Hospital", "  ", None, ""), (6, None, "various places", None, None), (6, None, "x" * 50_000, None, None)],
        "bridge_id bigint, institution string, city string, state_region string, country string",
    ).withColumn("distance", F.lit("clash"))
    people = spark.createDataFrame([(1, "Phys. chem"), (2, "Physiology of plants"), (3, "Phyiscs"), (4, "Insurance"), (5, None), (6, "Chemistry (physical)"), (6, "Chemistry (physical)")], "profile_id bigint, department string")
    got = sorted((r["field"], r["record_id"], r["ref_id"]) for r in canonical.mapped_values(spark, bridge, people, listed).collect())
    assert got == sorted(
        [("institution", 2, 1), ("institution", 3, 2), ("institution", 4, 2), ("institution", 5, 0), ("city", 2, 3), ("city", 3, 0), ("city", 6, 0), ("city", 6, 0), ("country", 2, 4), ("country", 3, 5), ("country", 4, 0)]
        + [("department", 1, 6), ("department", 2, 7), ("department", 3, 8), ("department", 4, 0), ("department", 6, 6), ("department", 6, 6)]
    )
    assert {r["ref_id"] for r in canonical.mapped_values(spark, bridge, people, listed.where("ref_id < 0")).collect()} == {0}
    assert canonical.mapped_values(spark, bridge.where("bridge_id < 0"), people.where("profile_id < 0"), listed).count() == 0


def test_reference_shards_give_the_same(spark, monkeypatch):
    listed = spark.createDataFrame([(i, "city", w, None, None) for i, w in enumerate(["Abcdefgh", "Abcdefgx", "Mnopqrst", "Abcdefgh"])], "ref_id bigint, list_name string, entry string, state_region string, country string")
    values = spark.createDataFrame([("Abcdefg", None, None), ("Mnopqrs", None, None), ("zzzzzz", None, None)], "value string, c1 string, c2 string")
    want = sorted(map(str, canonical.map_values(values, listed, "city").collect()))
    parts = canonical.shards
    monkeypatch.setattr(canonical, "shards", lambda c, n: parts(c, n, 9))
    assert sorted(map(str, canonical.map_values(values, listed, "city").collect())) == want


def day(n):
    return datetime.datetime(2026, 3, n)


def test_entries_and_survivors(profiles):
    career = {"education": [("A.B", "X", 1900, None), ("A.M", "X", 1902, None)], "employment": [job("prof", "Y", 1905)]}
    other = {"education": [("A.B", "Z", 1880, None)], "employment": [job("dir", "Q", 1890)]}
    rows = [
        career | {"full_name": "Balvomar, R(oland) M(artin)", "birth_year": 1870, "via": "live", "extracted_at": day(1)},
        career | {"full_name": "Balvomar, R. M.", "birth_year": 1890, "via": "hand", "extracted_at": day(1), "pass_no": 2},
        career | {"full_name": "Blvomar, Dr. R(oland) M(artin)", "via": "batch", "extracted_at": day(2), "pass_no": 3, "source_page": 2},
        other | {"full_name": "Balvomar, R(oland) M(artin)", "birth_year": 1850, "pass_no": 2},
        career | {"full_name": "Balvomar, R(oland) M(artin)", "pass_no": 2, "source_page": 9},
        {"full_name": "Kole, A(nn)", "mailing_address": "1 Main Street, Town", "birth_date": "May 1, 1880", "via": None},
        {"full_name": "Kole, A.", "mailing_address": "1 Main St., Town", "pass_no": 2, "via": "batch"},
        {},
        {"full_name": "x" * 50_000, "pass_no": 2},
        {"source_page": None, "pass_no": None, "full_name": "Kole, A(nn)"},
    ]
    p = profiles(*rows)
    groups = survivors.entry_groups(p)
    label = {r["profile_id"]: r["group_id"] for r in groups.collect()}
    assert label[1] == label[2] == label[3] == 1 and label[6] == label[7] == 6
    assert all(label[i] == i for i in (4, 5, 8, 9, 10))
    best = {r["group_id"]: r for r in survivors.survivors(p, groups).collect()}
    assert (best[1]["n_rows"], best[1]["name_from"], best[1]["birth_from"], best[1]["birth_year"]) == (3, 1, 2, 1890)
    assert (best[6]["name_from"], best[6]["birth_from"]) == (6, 0)
    assert (best[8]["name_from"], best[8]["full_name"]) == (0, None)


def test_misread_initial_missing_name_and_same_place(profiles):
    career = {"education": [("A.B", "X", 1900, None), ("A.M", "X", 1902, None)], "employment": [job("prof", "Y", 1905)]}
    rows = [
        career | {"full_name": "Balvomar, R(oland) M(artin)"},
        career | {"full_name": "Balvomar, K(oland) M(artin)", "pass_no": 2},
        career | {"full_name": None, "pass_no": 3, "pos": 7},
        career | {"full_name": "", "pass_no": 4, "source_page": 2},
        career | {"full_name": "Balvomar, R(oland)", "pass_no": 2, "pos": 1},
        {"full_name": None, "pass_no": 6},
        {"full_name": None, "pass_no": 7, "education": [("A.B", "X", 1900, None)]},
        career | {"full_name": "Balvomär, R(oland)", "pass_no": 8},
    ]
    label = {r["profile_id"]: r["group_id"] for r in survivors.entry_groups(profiles(*rows)).collect()}
    assert {label[i] for i in (1, 2, 3, 4, 5, 8)} == {1} and label[6] == 6 and label[7] == 7
    # Other surnames, and rows that one pass lists at two places, are other entries.
    apart = profiles(career | {"full_name": "Balvomar, R(oland)"}, career | {"full_name": "Zeta, Q(uin)", "pass_no": 2}, career | {"full_name": "Balvomar, R(oland)", "pos": 9, "birth_year": 1})
    assert {r["group_id"] for r in survivors.entry_groups(apart).collect()} == {1, 2, 3}


def test_crowded_pages_give_the_same_groups(profiles, monkeypatch):
    rng = random.Random(31)
    rows = []
    for k in range(60):
        edu = [("A.B", "X", rng.randrange(1890, 1893), None), ("A.M", "X", rng.randrange(1893, 1896), None), ("Ph.D", "X", rng.randrange(1896, 1899), None)][: rng.randrange(1, 4)]
        emp = [job(rng.choice(["prof", "dir"]), "Y", rng.randrange(1900, 1903)) for _ in range(rng.randrange(3))]
        name = f"{rng.choice(['Bell', 'Cole', 'Dragomir'])}, {rng.choice('ABC')}(x)"
        for number in range(1, rng.randrange(2, 4)):
            rows.append({"full_name": rng.choice([name, name, None, name.replace("A(", "B(")]), "pass_no": number, "pos": k, "education": edu[: rng.randrange(1, 4)], "employment": emp})
    groups = lambda: {r["profile_id"]: r["group_id"] for r in survivors.entry_groups(profiles(*rows)).collect()}
    plain = groups()
    monkeypatch.setattr(survivors, "CROWD", 3)
    assert groups() == plain and len(set(plain.values())) < len(plain)


def record_nodes(p):
    place = F.array(F.concat_ws(":", "pass_no", "pos")).alias("places")
    return survivors.with_name_parts(p.select(F.col("profile_id").alias("node"), "source_page", F.array("pass_no").alias("passes"), place, survivors._records().alias("records"), *survivors._DETAILS))


def same_entry(x, y):
    """The rule for rows with records, by brute force; x has fewer."""
    common = len(set(x["records"]) & set(y["records"]))
    share = common / len(x["records"])
    strong = share >= 0.8 and common >= 2
    if abs(x["source_page"] - y["source_page"]) > 1 or share < 0.5:
        return False
    if not x["sur"] or not y["sur"]:
        return strong
    agree = all(a[0] == b[0] and (len(a) == 1 or len(b) == 1 or plain_distance(a, b) <= 2) for a, b in zip(x["given"], y["given"], strict=False))
    edits = plain_distance(x["sur"], y["sur"])
    return (agree and edits <= (4 if strong else 2)) or (strong and edits <= 2)


def test_pairs_of_entries_whatever_the_size_of_a_page(profiles, monkeypatch):
    rng = random.Random(7)
    rows = []
    for k in range(240):
        sur = "".join(rng.choice("abc") for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 8])))
        given = rng.choice(["", "", ", J(ohn)", ", J. K.", ", M(ary)"])
        edu = [("A.B", "X", rng.randrange(1890, 1894), None), ("A.M", "X", rng.randrange(1894, 1897), None)][: rng.randrange(1, 3)]
        emp = [job("prof", "Y", year) for year in rng.sample(range(1900, 1906), rng.randrange(4))]
        rows.append({"full_name": (sur + given) or None, "pass_no": k, "pos": 0, "source_page": rng.randrange(1, 5), "education": edu, "employment": emp})
    nodes = record_nodes(profiles(*rows)).persist()
    by_fewer = sorted(nodes.collect(), key=lambda r: (len(r["records"]), r["node"]))
    want = sorted((x["node"], y["node"]) for x, y in itertools.combinations(by_fewer, 2) if same_entry(x, y))
    found = lambda: sorted((r["x"], r["y"]) for r in survivors.entry_pairs(nodes).collect())
    assert found() == want
    monkeypatch.setattr(survivors, "CROWD", 0)
    assert found() == want
    lone = sum((x["initial"] == "") != (y["initial"] == "") and len({*x["records"]} & {*y["records"]}) == 1 for x, y in itertools.combinations(by_fewer, 2) if same_entry(x, y))
    assert lone > 50 and len(want) > 4 * lone
    nodes.unpersist()


def test_a_row_without_given_name_is_found_on_a_page_of_many_rows(spark, profiles):
    degree = {"education": [("A.B", "X", 1900, None)]}
    few = profiles(degree | {"full_name": "Balvomar, R(oland)"}, degree | {"full_name": "Balvomar", "pass_no": 2}, degree | {"full_name": "Blvomar", "pass_no": 3}, degree | {"full_name": "Zeta", "pass_no": 4})
    # Other rows of the page, which alone decide whether it is crowded.
    other = few.where("profile_id = 1").crossJoin(spark.range(10, 10 + survivors.CROWD + 1).withColumnRenamed("id", "i"))
    other = other.withColumns({"profile_id": F.col("i"), "pos": F.col("i").cast("int"), "full_name": F.concat(F.lit("Name"), F.md5(F.col("i").cast("string")), F.lit(", Q."))}).drop("i")
    for p in (few, few.unionByName(other)):
        assert {r["profile_id"]: r["group_id"] for r in survivors.entry_groups(p).where("profile_id < 10").collect()} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_name_parts_agree_with_their_columns(spark):
    names_ = ["Balvomar, Dr. R(oland) M.K.", "R. M. Smith", "Müller, J(örg)", "O'Neil,  P", "Solo", "", None, "A, b, c", "Prof. Dr. Bell", "Ryan, Mrs. (Ann) B(ea)", "  x  "]
    df = survivors.with_name_parts(spark.createDataFrame([(i, n) for i, n in enumerate(names_)], "i int, full_name string"))
    for r in df.collect():
        assert (r["sur"], r["given"]) == survivors.name_parts(names_[r["i"]]), names_[r["i"]]


def test_copies_and_empty(profiles):
    row = {"full_name": "Same, A(nn)", "birth_year": 1880, "education": [("A.B", "X", 1900, None)]}
    p = profiles(*[row | {"pass_no": k % 3 + 1, "pos": 0} for k in range(30)])
    groups = survivors.entry_groups(p)
    assert {r["group_id"] for r in groups.collect()} == {1}
    assert survivors.survivors(p, groups).first()["n_rows"] == 30
    assert survivors.entry_groups(profiles()).count() == 0


def test_a_third_of_all_rows_are_copies(spark, profiles):
    career = {"education": [("A.B", "X", 1900, None), ("A.M", "X", 1902, None)]}
    few = profiles(career | {"full_name": "Same, A(nn)"}, career | {"full_name": "Same, A(nn)", "birth_year": 1880, "pass_no": 2}, {"full_name": "Other, B", "pos": 5})
    many = few.where("profile_id = 1").crossJoin(spark.range(10, 15_010).withColumnRenamed("id", "i")).withColumn("profile_id", F.col("i")).withColumn("pos", F.col("i").cast("int")).drop("i")
    label = survivors.entry_groups(few.unionByName(many)).groupBy("group_id").count().collect()
    assert {r["group_id"]: r["count"] for r in label} == {1: 15_002, 3: 1}


@pytest.mark.parametrize("name,n", [("Behre, Dr. J(ohn)", 9), ("Prof. Dr. Bell", 4), ("Dean, A(dean)", 9), (None, 0)])
def test_letters(spark, name, n):
    df = spark.createDataFrame([(name,)], "v string")
    assert df.select(survivors.letters(F.col("v"))).first()[0] == n


def test_labels_of_a_long_chain(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "x bigint, y bigint")
    got = {r["node"]: r["label"] for r in classes.components(pairs).collect()}
    assert {got[i] for i in range(41)} == {0} and got[101] == 100
