"""The registered queries that SQL can express, against DuckDB."""

import pytest
from oracle_compare import compare

from histdim.llm.queries import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    assert compare(spark, "/root/testdata/sf0.01", [name], verbose=True)[name][0] is True
