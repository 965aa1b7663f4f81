"""Every registered query against its SQL on the smallest data set, over a short range of days.

``python -m checks.compare DIR`` compares them with the published parameters.
"""

import pytest

from checks.compare import compare, database
from checks.oracle import oracle_statements
from demandspark.config import DemandConfig
from demandspark.plans.queries import END, REGISTRY, run

SHORT = DemandConfig(end=END, train_days=60, windows=(60, 30), lags=(1, 7, 28), max_last_days=60)
SQL = oracle_statements(SHORT)
ROWS_ONLY = {"train_gbt", "predict_gbt", "feature_importance"}


def test_every_query_has_sql_except_models():
    assert set(REGISTRY) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(REGISTRY)


@pytest.fixture(scope="module")
def con(smoke):
    c = database(smoke)
    yield c
    c.close()


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_sql(spark, con, smoke, key):
    res = compare(spark, con, smoke, key, SQL[key], SHORT)
    assert res["got"] == res["want"]
    assert not {"types", "only_got", "only_want", "got_minus_want", "want_minus_got"} & set(res), res


@pytest.mark.parametrize("key", sorted(ROWS_ONLY))
def test_model_queries_give_rows(spark, smoke, key):
    assert run(key, spark, smoke, SHORT).count() > 0
