import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_names_and_sql_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
@pytest.mark.parametrize("name", ["w1_provision_diff", "a5_verify_effects", "p1_search_powers", "f1_list_documents", "b7_duties", "t12_comparison_text", "j15_unattached_effects", "e2_replayed_upsert", "s5_followed_pages", "s7_effect_refs", "s14_unzipped", "b9_dictionary", "b11_new_names", "b5_rerendered", "a12_coverage_counters", "p3_search_by_phrases"])
def test_query_equals_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for table in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got = entry.queries()[name](spark, SF)
    want = c.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    plain = lambda rows: sorted(tuple("" if v is None else str(v) for v in r) for r in rows)
    assert sorted(columns) == sorted(got.columns)
    assert plain(got.select(*columns).collect()) == plain(want.fetchall())
