import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wheelpace.config import DEFAULT, HOUR, RUSH, SPEED, WEEKDAY, WEEKEND
from wheelpace.operators import charts, stats
from wheelpace.operators.facts import Facts, correlations, roll_up, speed_cube
from wheelpace.plans import runs

COLUMNS = "pickup_dayofweek short, pickup_hour short, is_weekend boolean, is_rush_hour boolean, average_speed_mph double"


@pytest.fixture(scope="module")
def pdf(prepared):
    return prepared.trips.toPandas()


@pytest.fixture(scope="module")
def facts(prepared):
    return Facts(prepared.trips, DEFAULT).settled()


def cells(spark, *rows):
    """Trips from (weekday, hour, speed)."""
    return spark.createDataFrame(
        [(d, h, d >= 5, h in DEFAULT.rush_hours, v) for d, h, v in rows], COLUMNS)


def speeds(trips):
    return Facts(trips, groupings={HOUR: [SPEED], RUSH: [SPEED]})


def test_profile_has_all_parts(facts):
    tables = runs.profile(facts)
    assert {"shape", "dtypes", "describe", "hourly_speed", "speed_by_rush", "speed_by_weekend", "speed_median",
            "extreme_hours", "null_split", "remaining_duplicates", "shares"} == set(tables)
    assert {"mean", "std", "p25", "p50", "p75"} <= set(tables["describe"].columns)
    runs.check_profile(tables)


def test_unexpected_nulls_and_duplicates_raise(spark, prepared):
    broken = prepared.trips.withColumn(SPEED, F.when(F.col("PULocationID") % 2 == 0, F.col(SPEED)))
    with pytest.raises(ValueError, match="does not expect"):
        runs.check_profile(runs.profile(Facts(broken)))
    doubled = prepared.trips.unionByName(prepared.trips.limit(3))
    with pytest.raises(ValueError, match="3 duplicates"):
        runs.check_profile(runs.profile(Facts(doubled)))
    with pytest.raises(ValueError, match="derived columns"):
        runs.check_contract(prepared.trips.drop(SPEED))


def test_describe_equals_pandas(facts, pdf):
    want = pdf[list(DEFAULT.numeric)].describe().T
    for r in stats.describe(facts, digits=6).collect():
        for mine, theirs in zip(("count", "mean", "std", "min", "p25", "p50", "p75", "max"), want.columns):
            assert r[mine] == pytest.approx(want.loc[r["metric"], theirs], abs=1e-5)


def test_hourly_profile_covers_all_hours(facts, pdf):
    rows = stats.hourly_profile(facts).collect()
    assert [r[HOUR] for r in rows] == sorted(pdf[HOUR].unique())
    assert sum(r["n"] for r in rows) == len(pdf)
    assert all(r["mean_speed"] is not None for r in rows)


@pytest.mark.parametrize("key", [RUSH, WEEKEND, "payment_type"])
def test_group_speed_equals_pandas(prepared, pdf, key):
    want = pdf.groupby(key)[SPEED].agg(["count", "mean", "std", "median", "min", "max"])
    for r in stats.compare_group_speed(prepared.trips, key, digits=6).collect():
        assert tuple(r)[1:] == pytest.approx(tuple(want.loc[r[key]]), abs=1e-5)


def test_rolled_up_variance_equals_direct(prepared, pdf):
    row = roll_up(speed_cube(prepared.trips)).first()
    assert (row["mean"], row["var"]) == pytest.approx((pdf[SPEED].mean(), pdf[SPEED].var()))


def test_variance_of_large_close_values(spark):
    """A sum of squares would lose all digits here."""
    values = [1e9 + i / 10 for i in range(100)]
    df = cells(spark, *((i % 7, i % 24, v) for i, v in enumerate(values)))
    assert roll_up(speed_cube(df), WEEKEND).agg(F.sum("n")).first()[0] == 100
    assert roll_up(speed_cube(df)).first()["var"] == pytest.approx(np.var(values, ddof=1), rel=1e-6)


def test_size_and_count_differ_on_nulls(spark):
    df = cells(spark, (0, 8, 10.0), (0, 8, None), (0, 9, None))
    hourly = {r[HOUR]: r for r in stats.hourly_profile(speeds(df)).collect()}
    assert (hourly[8]["n"], hourly[8]["mean_speed"]) == (2, 10.0)
    assert (hourly[9]["n"], hourly[9]["mean_speed"], hourly[9]["median_speed"]) == (1, None, None)
    groups = stats.compare_group_speed(df, HOUR).collect()
    assert [(r["n"], r["std"]) for r in groups] == [(1, None), (0, None)]


def test_correlation_skips_nulls_by_pair(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, 4, 7], "b": [2.0, 1, np.nan, 5, 9], "c": [np.nan, 3.0, 1, 2, 2]})
    rows = [tuple(None if math.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["variable"], r["with_variable"]): r["r"]
           for r in stats.compute_correlation_matrix(df, columns=["a", "b", "c"], digits=9).collect()}
    want = pdf.corr()
    assert len(got) == 9
    for (a, b), r in got.items():
        assert r == pytest.approx(want.loc[a, b], abs=1e-8)


def test_correlation_of_a_constant_or_empty_column(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 2.0, None), (4.0, 2.0, None)], "a double, b double, c double")
    got = {(r["variable"], r["with_variable"]): r["r"]
           for r in stats.compute_correlation_matrix(df, columns=["a", "b", "c"]).collect()}
    assert got.pop(("a", "a")) == 1.0
    assert len(got) == 8 and set(got.values()) == {None}


def test_nan_is_left_out(spark):
    df = cells(spark, (0, 8, 10.0), (0, 8, float("nan")), (0, 12, 20.0), (0, 12, 30.0))
    assert [(r["n"], r["mean"]) for r in stats.compare_group_speed(df, HOUR).collect()] == [(1, 10.0), (2, 25.0)]
    assert [(r["n"], r["mean"]) for r in roll_up(speed_cube(df), HOUR).orderBy(HOUR).collect()] == [(1, 10.0), (2, 25.0)]
    pairs = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (float("nan"), 9.0)], "a double, b double")
    assert {r["r"] for r in stats.compute_correlation_matrix(pairs, columns=["a", "b"]).collect()} == {1.0}


def test_welch_by_hand(spark):
    rush, other = [10.0, 12.0, 11.0, 15.0], [14.0, 18.0, 21.0, 16.0, 17.0]
    df = cells(spark, *((0, 8, v) for v in rush), *((0, 12, v) for v in other))
    a, b = np.var(rush, ddof=1) / 4, np.var(other, ddof=1) / 5
    row = stats.welch(speed_cube(df)).first()
    assert row["t"] == pytest.approx((12.0 - 17.2) / math.sqrt(a + b))
    assert row["dof"] == pytest.approx((a + b) ** 2 / (a * a / 3 + b * b / 4))
    result = stats.run_rush_hour_ttest(df)
    assert (result["n_rush_hour"], result["n_non_rush_hour"], result["is_significant"]) == (4, 5, True)
    assert 0.005 < result["p_value"] < 0.02


def test_welch_without_a_group(spark):
    result = stats.run_rush_hour_ttest(cells(spark, (0, 8, 1.0), (0, 8, 2.0)))
    assert result["p_value"] is None and result["is_significant"] is False


def test_heat_map_is_a_full_grid(spark):
    facts = speeds(cells(spark, (0, 3, 10.004), (6, 23, 20.0)))
    rows = charts.heatmap(facts).collect()
    assert [r[WEEKDAY] for r in rows] == list(range(7))
    assert (rows[0]["h3"], rows[6]["h23"], rows[0]["h4"], rows[3]["h3"]) == (10.0, 20.0, None, None)
    assert charts.heat_cells(facts).count() == 168


def test_heat_means_average_rounded_cells_without_weights(spark):
    facts = speeds(cells(spark, (0, 8, 10.006), (1, 8, 20.0), (1, 8, 20.0), (5, 8, 3.0)))
    row = charts.heat_row_means(facts).where(f"{HOUR} = 8").first()
    assert (row["weekday_mean"], row["weekend_mean"]) == (pytest.approx((10.01 + 20.0) / 2), 3.0)


def test_extreme_hours_ties_and_nulls(spark):
    facts = speeds(cells(spark, (0, 5, 10.0), (0, 3, 10.0), (0, 7, 20.0), (0, 6, 20.0), (0, 1, None)))
    row = stats.extreme_hours(stats.hourly_mean(facts), "mean").first()
    assert tuple(row) == (3, 10.0, 6, 20.0)
    rounded = stats.extreme_hours(stats.hourly_profile(speeds(cells(spark, (0, 5, 10.0001), (0, 6, 10.0))), digits=3), "mean_speed")
    assert rounded.first()["slowest_hour"] == 5  # equal after rounding


def test_findings_without_weekend(spark):
    facts = speeds(cells(spark, (0, 8, 10.0), (0, 12, 20.0)))
    row = charts.hourly_finding(facts).first()
    assert (row["slowest_hour"], row["fastest_hour"], row["weekday_slowest"], row["weekend_slowest"]) == (8, 12, 8, None)
    assert charts.rush_finding(facts).first()["rush_is_slower"]


def test_box_whiskers(spark):
    values = [1.0, 10.0, 11.0, 12.0, 13.0, 14.0, 15.0, 16.0, 60.0]
    facts = speeds(cells(spark, *((0, 8, v) for v in values), (0, 12, 5.0)))
    boxes = {r["label"]: r for r in charts.box_stats(facts).collect()}
    q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    inside = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    r = boxes["rush"]
    assert (r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"]) == (q1, q2, q3, min(inside), max(inside))
    assert boxes["non_rush"]["whisker_high"] == 5.0


def test_chart_tables(facts):
    tables = runs.chart_tables(facts)
    assert len(tables) == 7
    assert "slower" in tables["rush_finding"].first()["finding"]
    assert "lowest at" in tables["hourly_finding"].first()["finding"]


def test_settled_facts_are_small(facts):
    assert facts.cube.count() <= 168
    assert facts.summary.count() <= 7 + 24 + 2 + 2
    assert facts.pairs.count() == 28


def test_correlation_adds_rows_up_before_it_forms_pairs(spark):
    df = spark.range(1000).selectExpr("1e9 + id % 7 as a", "id * 0.5 as b", "if(id % 3 = 0, null, id % 5) as c")
    plan = correlations(df, ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.rindex("HashAggregate")  # the plan lists the last step first
    assert plan.count("Generate stack") == plan.count("Generate ")
    got = {r["pair"]: r["r"] for r in correlations(df, ["a", "b", "c"]).collect()}
    want = df.withColumn("a", F.col("a") - 1e9).toPandas().astype(float).corr().to_numpy()  # pandas loses digits at 1e9
    assert {p: pytest.approx(want[p // 3, p % 3], abs=1e-9) for p in (0, 1, 2, 4, 5, 8)} == got


def test_many_columns_keep_their_pairs_apart(spark):
    names = [f"c{i}" for i in range(12)]
    df = spark.range(50).selectExpr(*(f"double(id % {i + 2}) as {n}" for i, n in enumerate(names)))
    want = df.toPandas().corr()
    for r in stats.compute_correlation_matrix(df, columns=names, digits=9).collect():
        assert r["r"] == pytest.approx(want.loc[r["variable"], r["with_variable"]], abs=1e-8)
