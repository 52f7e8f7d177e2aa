import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wheelpace.functions.buckets import bucket
from wheelpace.operators import summary as S

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, x double, y double")


def expected(rows):
    """Summaries by pandas, keyed by (key, metric)."""
    pdf = pd.DataFrame(rows, columns=["k", "x", "y"]).astype({"x": float, "y": float})
    out = {}
    for metric in ("x", "y"):
        groups = [("all", pdf), *((k, g) for k, g in pdf.groupby("k"))]
        for key, g in groups:
            v = g[metric].dropna()
            out[key, metric] = (len(g), len(v), v.mean(), v.std(), v.min(), v.max(), *v.quantile(list(PROBS)))
    return out


def check(result, rows):
    want = expected(rows)
    got = {(r["level"], r["metric"]): r for r in result.collect()}
    assert set(got) == set(want)
    for key, values in want.items():
        row = got[key]
        names = ["n_rows", "n", "mean", "std", "min", "max", *map(S.quantile_name, PROBS)]
        for name, value in zip(names, values):
            if value is None or math.isnan(value):
                assert row[name] is None, (key, name)
            else:
                assert row[name] == pytest.approx(value, rel=1e-9, abs=1e-9), (key, name)


def random_rows(n=3000, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        x = r.choice([0.0, 1.0, -1.0, 1.0, r.gauss(0, 1), r.lognormvariate(0, 5), -r.lognormvariate(0, 5), None])
        y = r.uniform(14, 20) if i % 3 else 17.25  # a third of all rows holds one value
        rows.append(("hot" if i % 3 else r.choice("abc"), x, y))
    return rows + [("empty", None, None), ("empty", None, None), ("one", 5.0, None), (None, 3.0, 4.0)]


GROUPS = {"all": ["x", "y"], "k": ["x", "y"]}


def test_quantiles_of_a_tied_column_are_met_exactly(spark):
    df = frame(spark, [("a", 29.88, float(i % 3)) for i in range(1925)])
    assert [S.quantile_value(df, "x", p) for p in (0.1, 0.3, 0.9, 0.99)] == [29.88] * 4


def test_large_tables(spark):
    rows = random_rows()
    check(S.summarize(frame(spark, rows), GROUPS, PROBS), rows)


@pytest.mark.parametrize("sort_rows, broadcast_rows", [(0, 10**6), (0, 0), (10**6, 0)])
def test_ways_for_full_buckets_and_many_groups(spark, monkeypatch, sort_rows, broadcast_rows):
    """Fine buckets when a coarse one is full, a shuffled join when there are too many buckets to broadcast."""
    rows = random_rows(seed=2)
    refine = S._refine
    monkeypatch.setattr(S, "_refine", lambda r, p: refine(r, p, sort_rows, broadcast_rows))
    check(S.summarize(frame(spark, rows), GROUPS, PROBS), rows)


def test_fine_step_reuses_the_exchange(spark, monkeypatch):
    refine = S._refine
    monkeypatch.setattr(S, "_refine", lambda r, p: refine(r, p, 0, 10**6))
    result = S.summarize(frame(spark, random_rows()), GROUPS, (0.5,))
    result.collect()
    assert "ReusedExchange" in result._jdf.queryExecution().executedPlan().toString()


def test_values_closer_than_any_bucket(spark, monkeypatch):
    """All values in one fine bucket: neighbouring doubles."""
    x, values = 1.0, []
    for _ in range(200):
        values.append(x)
        x = np.nextafter(x, 2.0)
    rows = [("a", float(v), None) for v in values]
    refine = S._refine
    monkeypatch.setattr(S, "_refine", lambda r, p: refine(r, p, 0, 10**6))
    got = S.summarize(frame(spark, rows), {"all": ["x"]}, (0.5, 0.25)).first()
    assert got["p50"] in (values[99], values[100]) and values[49] <= got["p25"] <= values[50]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=2, max_size=60))
def test_buckets_keep_the_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for bits in (S.COARSE_BITS, S.FINE_BITS):
        got = [(r["x"], r["b"]) for r in df.select("x", bucket(F.col("x"), bits).alias("b")).collect()]
        got.sort()
        assert all(a[1] <= b[1] for a, b in zip(got, got[1:]))


def test_fine_buckets_hold_few_doubles(spark):
    df = spark.createDataFrame([(17.0,), (17.0 * (1 + 2.0 ** -31),)], "x double")
    a, b = (r["b"] for r in df.select(bucket(F.col("x"), 32).alias("b")).collect())
    assert a != b


def test_quantile_value(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "x double")
    assert S.quantile_value(df, "x", 0.25) == 1.5
    assert S.quantile_value(df, "x", 0.25) == 1.5


def test_no_group_sorts_in_one_task_plan(spark):
    """The histogram is partially aggregated before its shuffle, in the first of two scans."""
    df = spark.range(100).select((F.col("id") * 1.0).alias("x"))
    plan = S.summarize(df, {"all": ["x"]})._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "BroadcastHashJoin" in plan
