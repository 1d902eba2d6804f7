import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from tripmart.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert all(isinstance(sql, str) for sql in entry.oracle_sql().values())


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    report = compare(QUERIES[name](spark, SF), ORACLES[name], connect(SF))
    assert report["ok"], report
