"""Every core query against its SQL on the small tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from annuary.plans import catalog  # noqa: E402


def canonical(df):
    def text(x):
        if x is None or x != x:
            return ""
        if hasattr(x, "item"):
            x = x.item()
        if isinstance(x, float):
            return str(int(x)) if x == int(x) else repr(round(x, 6))
        return str(x)

    df = df[sorted(df.columns)]
    return sorted(tuple(text(v) for v in r) for r in df.astype(object).where(df.notna(), None).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def database(data):
    c = duckdb.connect()
    for f in os.listdir(data):
        c.execute(f"create view {f[:-8]} as select * from '{data}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, data, database, name):
    got, want = catalog.QUERIES[name](spark, data).toPandas(), database.execute(catalog.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


#: Queries without SQL: what they need is not in it. Each has tests of its own; here are their rows, counted another way.
COUNTS = {
    "panel_slots_wide": ("balanced_panel", lambda rows: len(rows)),
    "merged_profiles": ("fuzzy_pass_merge_confirmed", lambda rows: len(rows)),
}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_query_without_sql_gives_whole_rows(spark, data, name):
    df = catalog.QUERIES[name](spark, data)
    rows = df.collect()
    assert rows, name
    if name in COUNTS:
        other, count = COUNTS[name]
        assert count(rows) == len(catalog.QUERIES[other](spark, data).collect())
    assert len(set(rows)) == len(rows)
