"""Every registered query with SQL agrees with it; the others give rows."""

import pytest

from compare import compare
from lectern.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    result = compare(spark, SF_DIR, name)
    assert result.startswith("ok" if name in ORACLES else "rows"), result
    assert not result.startswith("rows 0"), result


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
