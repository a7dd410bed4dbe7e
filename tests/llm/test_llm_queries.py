"""The registered queries beside their SQL, and their contracts."""

from pathlib import Path

import pytest

from compare import compare
from lectern.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    result = compare(spark, SF_DIR, name)
    assert result.startswith("ok" if name in ORACLES else "rows"), result


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert (Path(__file__).parents[2] / "corpus_pipeline.py").exists()
