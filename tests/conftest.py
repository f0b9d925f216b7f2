import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))

DATA = os.environ.get("ANNUARY_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from annuary.session import get_spark

    session = get_spark("4", 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA


@pytest.fixture(scope="session")
def profile_schema():
    spell = "struct<position_title:string,institution_org:string,start_year:int,end_year:int,is_current_position:boolean>"
    return f"""profile_id bigint, source_page int, pos int, pass_no int, shard int, via string, extracted_at timestamp_ntz, full_name string, titles string,
mailing_address string, mailing_city string, mailing_state string, mailing_country string, star_status boolean, department string, birth_place string, birth_city string,
birth_state string, birth_country string, birth_date string, birth_year int, education array<struct<degree_type:string,institution:string,year:int,end_year:int>>,
employment array<{spell}>, minor_positions array<{spell}>, societies array<string>, research_accomplished string, research_in_progress string"""


@pytest.fixture(scope="session")
def profiles(spark, profile_schema):
    """Make profile rows from dicts; what a dict leaves out is null."""
    from pyspark.sql import types as T

    schema = T._parse_datatype_string(profile_schema)

    def make(*rows, **more):
        full = []
        for i, r in enumerate(rows):
            r = {"profile_id": i + 1, "source_page": 1, "pos": i, "pass_no": 1, "via": "batch"} | r
            full.append(tuple(r.get(f.name) for f in schema))
        df = spark.createDataFrame(full, schema)
        # Columns that no operator knows, some named like those it makes itself.
        from pyspark.sql import functions as F

        for name in ("key", "node", "label", "group_id", "a", "b", "e", "n", "place", "token", "block", "x", "page", "year", "kind"):
            df = df.withColumn(name, F.lit("clash"))
        return df

    return make


def job(title=None, org=None, start=None, end=None, now=False):
    return (title, org, start, end, now)
