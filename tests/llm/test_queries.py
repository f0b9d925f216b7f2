from annuary.llm import queries

COLUMNS = {
    "p1_found": ["group_id", "name_from", "birth_from"],
    "p2_found": ["profile_id_a", "profile_id_b"],
    "p4_found": ["bridge_id_a", "bridge_id_b"],
    "p5_found": ["field", "record_id", "ref_id"],
    "p9_found": ["doc_id", "item_id"],
    "p10_found": ["doc_id", "stretch_no", "lang"],
}


def test_found_queries_have_their_columns(spark, data):
    for name, columns in COLUMNS.items():
        df = queries.QUERIES[name](spark, data)
        assert df.columns == columns
        assert df.count() > 0 and df.count() == df.distinct().count()
