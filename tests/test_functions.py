import pytest
from pyspark.sql import functions as F

from annuary.functions import people, spells, text


def one(spark, expression, **values):
    schema = ", ".join(f"{k} {'int' if isinstance(v, int) and not isinstance(v, bool) else 'boolean' if isinstance(v, bool) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expression.alias("r")).first()["r"]


SPELLS = [
    (1921, 1923, False, (1921, 1923, False), list(range(1921, 1924))),
    (1921, 1921, False, (1921, 1921, False), [1921]),
    (1921, None, True, (1921, None, True), list(range(1921, 1928))),
    (1921, None, False, (1921, None, False), [1921]),
    (None, 1921, False, (None, 1921, False), [1921]),
    (None, None, True, (None, None, True), [1927]),
    (None, None, False, (None, None, False), []),
    (1920, 1928, False, (1920, 1927, False), list(range(1920, 1928))),
    (1928, None, True, (None, None, False), []),
    (1928, 1930, False, (None, None, False), []),
    (None, 1930, True, (None, None, False), []),
    (1930, 1925, True, (None, 1925, True), [1925]),
    (1925, 1920, False, (1925, 1920, False), list(range(1920, 1926))),
    (1921, None, None, (1921, None, False), [1921]),
]


def test_spells(spark):
    df = spark.createDataFrame([(i, s, t, c) for i, (s, t, c, *_) in enumerate(SPELLS)], "i int, s int, t int, c boolean")
    rows = df.select("i", spells.cap_spell(F.col("s"), F.col("t"), F.col("c")).alias("k"), spells.confirmed_years(F.col("s"), F.col("t"), F.col("c")).alias("y")).collect()
    for r in rows:
        assert tuple(r["k"]) == SPELLS[r["i"]][3]
        assert r["y"] == SPELLS[r["i"]][4]


@pytest.mark.parametrize(
    "s,t,c,expected",
    [(1921, 1923, False, "1921-1923"), (1921, 1921, False, "1921"), (1921, None, True, "1921-"), (1921, None, False, "1921"), (None, 1923, False, "1923"), (None, None, False, "undated"), (0, 0, False, "undated")],
)
def test_span_text(spark, s, t, c, expected):
    df = spark.createDataFrame([(s, t, c)], "s int, t int, c boolean")
    assert df.select(spells.span_text(F.col("s"), F.col("t"), F.col("c"))).first()[0] == expected


@pytest.mark.parametrize("raw,expected", [("1898", 1898), ("'98", 1898), ("ca. 1912", 1912), ("13", 1913), ("27", 1927), ("28", 1828), ("", None), ("19123", 1912), (None, None)])
def test_coerce_year(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "v string")
    assert df.select(people.coerce_year(F.col("v"))).first()[0] == expected


@pytest.mark.parametrize("place,city,state", [("Antrim, N.H.", "Antrim", "N.H"), ("Cairo", "Cairo", None), ("A, B, C", "A, B", "C"), (", N.H", None, "N.H"), ("", None, None), (None, None, None)])
def test_split_place(spark, place, city, state):
    df = spark.createDataFrame([(place,)], "v string")
    assert tuple(df.select(people.place_city(F.col("v")), people.place_state(F.col("v"))).first()) == (city, state)


@pytest.mark.parametrize("address,tail", [("1 Main St, Redlands, Calif.", "Redlands, Calif"), ("State Col, Ames, Iowa", "Ames, Iowa"), ("12 Rue X, Paris 5, France", "12 Rue X, Paris 5, France")])
def test_address_tail(spark, address, tail):
    assert one(spark, people.address_tail(F.col("v")), v=address) == tail


@pytest.mark.parametrize(
    "raw,year,expected",
    [("March 1, 1889", 1889, "01.03.1889"), ("Dec. 3, 1888", None, "03.12.1888"), ("1889", None, "00.00.1889"), (None, 1891, "00.00.1891"), ("March, 1889", None, "00.03.1889"), ("Sept 5, 90", 1890, "05.09.1890"), (None, None, None)],
)
def test_birth_date(spark, raw, year, expected):
    df = spark.createDataFrame([(raw, year)], "d string, y int")
    assert df.select(people.birth_date(F.col("d"), F.col("y"))).first()[0] == expected


@pytest.mark.parametrize("v,expected", [("Prof. Dr. C(harles)", "C(harles)"), ("Colin B(ruce)", "Colin B(ruce)"), ("Rt. Rev. J(ohn)", "J(ohn)"), ("Dr.", "Dr.")])
def test_strip_honorifics(spark, v, expected):
    assert one(spark, people.strip_honorifics(F.col("v")), v=v) == expected


@pytest.mark.parametrize("v,last,first", [("Behre, Dr. J(eanette) A(llen)", "Behre", "J(eanette) A(llen)"), ("Mononym", "", "Mononym"), (None, "", "")])
def test_names(spark, v, last, first):
    df = spark.createDataFrame([(v,)], "v string")
    assert tuple(df.select(people.last_name(F.col("v")), people.first_name(F.col("v"))).first()) == (last, first)


@pytest.mark.parametrize("v,expected", [("Ont", "Canada"), ("B.C.", "Canada"), ("Calif", "USA"), ("Eng", "USA"), (None, None)])
def test_infer_country(spark, v, expected):
    df = spark.createDataFrame([(v,)], "v string")
    assert df.select(people.infer_country(F.col("v"))).first()[0] == expected


@pytest.mark.parametrize("v,key", [("Behre, Dr. J(eanette) A(llen)", "behrejeanetteallen"), ("Coleman, A(nn)", "emanann"), ("Mack, P(auline) B(eery) (Mrs. Warren Mack)", "mackpaulinebeery")])
def test_name_key(spark, v, key):
    assert one(spark, people.name_key(F.col("v")), v=v) == key


def test_initials_ocr_and_pipes(spark):
    assert one(spark, people.given_initials(F.col("v")), v="Behre, Dr. J(eanette) A(llen)") == "ja"
    assert one(spark, text.repair_ocr(F.col("v")), v="instr. sool, soological") == "instr. zool, zoological"
    df = spark.createDataFrame([("a; b", None, "c"), (";", None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(text.pipe_join(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["a | b | c", None]


def test_strip_is_unicode(spark):
    assert one(spark, text.strip(F.col("v")), v=" \t a b \n") == "a b"
    assert one(spark, text.squash(F.col("v")), v="A  b American Men of Science c") == "Abc"
    assert one(spark, text.first_filled(F.col("a"), F.col("b")), a="  ", b=" x ") == " x "


def test_strict_schema():
    from pyspark.sql import types as T

    from annuary.functions.schema import strict_schema

    spell = T.StructType([T.StructField("title", T.StringType(), False), T.StructField("year", T.IntegerType())])
    kind = T.StructType([T.StructField("n", T.LongType(), False), T.StructField("jobs", T.ArrayType(spell, False), False), T.StructField("tags", T.ArrayType(T.StringType()))])
    got = strict_schema(kind)
    assert got["required"] == ["n", "jobs", "tags"] and got["additionalProperties"] is False
    assert got["properties"]["jobs"]["items"]["properties"] == {"title": {"type": "string"}, "year": {"anyOf": [{"type": "integer"}, {"type": "null"}]}}
    assert got["properties"]["tags"] == {"anyOf": [{"type": "array", "items": {"anyOf": [{"type": "string"}, {"type": "null"}]}}, {"type": "null"}]}
    with pytest.raises(TypeError):
        strict_schema(T.BinaryType())
