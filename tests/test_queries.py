import pytest

from conftest import SMALL
from oracle_check import CASES, QUERIES, compare, connect


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


def test_every_sql_has_a_query():
    assert set(CASES) <= set(QUERIES)
    assert set(QUERIES) - set(CASES) == {"profile_quantiles", "merged_quantiles"}


@pytest.mark.parametrize("name", sorted(CASES))
def test_query_equals_sql(spark, db, name):
    assert compare(spark, db, name, SMALL) in (None, "no rows")


def test_quantiles_within_their_rank_error(spark, db):
    for row in QUERIES["profile_quantiles"](spark, SMALL).collect():
        for share, found in ((0.5, row["median_value"]), (0.95, row["p95_value"])):
            below, upto, n = db.execute(
                f"select count(*) filter (v < {found}), count(*) filter (v <= {found}), count(*) "
                f"from (select {row['column_name']} as v from lineitem)"
            ).fetchone()
            slack = n / 10_000 + 1
            assert below - slack <= share * n <= upto + slack


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() == 5
    assert set(oracle_sql()) <= set(queries())
