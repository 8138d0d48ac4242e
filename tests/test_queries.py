"""Registered queries: smoke on sf0.001 and DuckDB parity for a fast subset."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from kiln import plans
from kiln.sources.tables import TABLES
from tests.conftest import SMOKE

#: Fitted models have no SQL form; tests/test_models.py checks them.
FITTED = {"nb_pipeline", "cost_gbt", "cost_gbt_report", "load_forecast", "load_forecast_errors",
          "weather_regression", "forecast_model_verdict", "kernel_svc", "kernel_svc_report", "model_timings", "cosine_join_report"}
#: Reports over the experiment grid, which each of them computes; the grid itself and one report are compared here.
REPORTS = {"pivot_accuracy", "baseline_delta", "group_mean", "model_comparison", "best_trial", "early_stop", "pad_history"}
PARITY = sorted(set(plans.oracle_sql()) - REPORTS)
#: Queries whose result may be empty at the smallest scale.
MAY_BE_EMPTY = {"pair_filter"}


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 5) + 0.0) if not math.isnan(v) else "nan"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["label", "prediction", "n"]
    assert df.count() >= 1


def test_every_query_has_an_oracle_or_a_model():
    assert set(plans.queries()) == set(plans.oracle_sql()) | FITTED
    assert set(entry.queries()) >= set(plans.queries()) and set(entry.oracle_sql()) >= set(plans.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", PARITY)
def test_parity(spark, duck, name):
    df = plans.queries()[name](spark, SMOKE)
    res = duck.sql(plans.oracle_sql()[name])
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    want = canon(list(res.columns), res.fetchall())
    assert got == want and (want[1] or name in MAY_BE_EMPTY)
