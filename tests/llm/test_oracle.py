"""The SQL statements of this subpackage give the rows of their queries."""

import pytest

from ledgerline.llm.registry import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import canon


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck_small, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck_small.execute(ORACLE[key])
    names = [c[0] for c in res.description]
    assert canon(df.columns, rows) == canon(names, res.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
