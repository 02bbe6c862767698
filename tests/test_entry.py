import os

import pytest

import __spark_entry__ as E


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(E.QUERIES) <= set(o)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["user_id", "rank", "item", "score"]


FAST = ["word_count", "errors_per_minute", "log_errors_by_app", "sim_cosine", "sim_llr", "rec_weighted_sum",
        "kmeans_assign", "logistic_steps", "offset_ranges", "ppr_static", "upsert_add"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_matches_at_smallest_scale(spark, name):
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    import oracle_check as OC
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("test data not present")
    df = E.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    res = OC.duck(sf).execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert OC.close(OC.rows_of(df.columns, got), OC.rows_of(cols, res.fetchall()))
