"""t1/t2: the driver contract and agreement with the DuckDB oracle (sf0.001)."""

import decimal
import math

import pytest

import __spark_entry__ as E
from credtrail.plans import registry as _registry
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["match_status", "count", "percentage", "total_tax_difference",
                          "avg_tax_difference"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return None if v is None else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple("" if x is None else x for x in t))


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(_registry.ORACLE)))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, cur.fetchall())


def test_models_without_oracle(spark):
    """Fits have no SQL: their invariants are checked instead."""
    from pyspark.sql import functions as F
    q = E.queries()
    vendors = q["m1_vendor_features"](spark, SF_SMALL).count()
    scores = q["m2_risk_model_scores"](spark, SF_SMALL)
    assert scores.count() == vendors and scores.filter("vendor_risk_score not between 0 and 100").count() == 0
    assert 0 <= q["a18_risk_model_mse"](spark, SF_SMALL).first()["mse"] < 400
    flagged = q["m5_isolation_forest"](spark, SF_SMALL)
    low = flagged.filter("is_anomaly").agg(F.max("anomaly_score")).first()[0]
    assert low < 0 <= flagged.filter("not is_anomaly").agg(F.min("anomaly_score")).first()[0]
    seasonal = q["m8_forecast_seasonal_by_vendor"](spark, SF_SMALL)
    assert seasonal.filter("yhat_lower > yhat or yhat > yhat_upper").count() == 0
    trend = q["m8_forecast_trend_by_vendor"](spark, SF_SMALL)
    assert seasonal.select("vendor_id", "ds").exceptAll(trend.select("vendor_id", "ds")).count() == 0


def test_queries_without_oracle_are_only_the_models():
    from credtrail.plans.registry import ORACLE, QUERIES
    assert set(QUERIES) - set(ORACLE) == {"m2_risk_model_scores", "a18_risk_model_mse", "m5_isolation_forest",
                                          "m8_forecast_seasonal_by_vendor"}
