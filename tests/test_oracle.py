"""Every registered query against its DuckDB oracle (sf0.001, whole tables)."""

import pytest

from oracle_compare import compare

SF = "/root/testdata/sf0.001"


def own_queries():
    """All but the training-data queries, which have tests of their own."""
    import __spark_entry__ as E
    return [k for k in E.queries() if k not in E._llm_queries()[0]]


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    assert set(own_queries()) == set(E.oracle_sql()) - set(E._llm_queries()[1])


def test_queries_match_oracle(spark):
    res = compare(spark, SF, own_queries(), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] is not True}
    assert not bad, bad


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 365
    assert df.columns == ["actorid", "actor", "quality_class", "is_active", "start_year", "end_year",
                          "current_year"]


@pytest.mark.parametrize("name,expected", [("debut_load", 150), ("scd2_backfill", 365), ("fact", 5992),
                                           ("bail_rates", 62), ("apply_changes", 455)])
def test_expected_row_counts(spark, name, expected):
    import __spark_entry__ as E
    assert E.queries()[name](spark, SF).count() == expected
