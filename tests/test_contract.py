import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "match_type" in df.columns


def test_every_query_has_an_oracle_unless_no_sql_form():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert {n for n in set(q) - set(o) if not n.startswith("op") and n != "pipeline"} == set()


def test_queries_match_oracles(spark):
    import __spark_entry__ as E
    from check_oracles import compare
    res = compare(spark, SF, names=set(E.oracle_sql()), verbose=False)
    bad = {k: v for k, v in res.items() if not v.startswith("ok")}
    assert not bad, bad
