import math

import pytest
from pyspark.sql import functions as F

from wheelpace.config import DEFAULT, DERIVED
from wheelpace.functions.features import (
    add_model_features, add_time_features, month_label, month_of, round_numbers, time_group,
)
from wheelpace.functions.student_t import regularized_beta, two_sided_p, with_two_sided_p


def test_derived_columns_and_types(trips):
    out = add_time_features(trips({}))
    assert [c for c in out.columns[-6:]] == list(DERIVED)
    assert dict(out.dtypes)["pickup_hour"] == "smallint"
    assert dict(out.dtypes)["is_rush_hour"] == "boolean"


def test_formulas(trips):
    r = add_time_features(trips({"tpep_dropoff_datetime": "2026-05-10 08:12:30.5", "trip_distance": 5.0})).first()
    assert r["duration_min"] == pytest.approx(12.5 + 0.5 / 60)
    assert r["average_speed_mph"] == pytest.approx(5.0 / (r["duration_min"] / 60))
    assert (r["pickup_hour"], r["pickup_dayofweek"], r["is_weekend"], r["is_rush_hour"]) == (8, 6, True, True)


def test_swapped_and_empty_times(trips):
    rows = add_time_features(trips({"tpep_dropoff_datetime": "2026-05-10 07:55:00"},
                                   {"tpep_dropoff_datetime": "2026-05-10 08:00:00"})).collect()
    assert {r["duration_min"] for r in rows} == {-5.0, 0.0}
    assert all(r["average_speed_mph"] is None for r in rows)


def test_durations_ignore_the_session_time_zone(spark, trips):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # Clocks skip 02:00 to 03:00 on this day.
        r = add_time_features(trips({"tpep_pickup_datetime": "2024-03-10 01:50:00",
                                     "tpep_dropoff_datetime": "2024-03-10 02:30:00"})).first()
        assert (r["duration_min"], r["pickup_hour"]) == (40.0, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("day, weekday", [("2026-05-11", 0), ("2026-05-15", 4), ("2026-05-16", 5), ("2026-05-17", 6)])
def test_weekday_starts_on_monday(trips, day, weekday):
    r = add_time_features(trips({"tpep_pickup_datetime": f"{day} 00:00:00"})).first()
    assert (r["pickup_dayofweek"], r["is_weekend"]) == (weekday, weekday >= 5)


def test_rush_hours(spark, trips):
    rows = add_time_features(trips(*({"tpep_pickup_datetime": f"2026-05-11 {h:02}:59:59"} for h in range(24))))
    assert {r["pickup_hour"] for r in rows.where("is_rush_hour").collect()} == set(DEFAULT.rush_hours)


def test_time_groups(spark):
    hours = spark.range(-1, 25).select(F.col("id").cast("short").alias("h"))
    got = {r["h"]: r["g"] for r in hours.select("h", time_group(F.col("h")).alias("g")).collect()}
    assert got[-1] is None and got[24] is None
    assert [got[h] for h in (0, 5, 6, 9, 10, 15, 16, 19, 20, 23)] == [
        "late_night", "late_night", "morning_rush", "morning_rush", "daytime", "daytime",
        "evening_rush", "evening_rush", "night", "night"]


def test_model_features(trips):
    rows = add_model_features(add_time_features(trips(
        {"PULocationID": None}, {"tpep_pickup_datetime": "2026-05-11 08:00:00"},
        {"tpep_pickup_datetime": "2026-05-15 21:00:00"}))).collect()
    assert [(r["route_id"], r["is_friday"], r["is_monday"], r["pickup_time_group"]) for r in rows] == [
        ("-1_200", 0, 0, "morning_rush"), ("100_200", 0, 1, "morning_rush"), ("100_200", 1, 0, "night")]


def test_month_key(trips):
    df = trips({"tpep_pickup_datetime": "2026-12-31 23:59:59.999999"})
    assert df.select(month_label(month_of(F.col("tpep_pickup_datetime")))).first()[0] == "2026-12"


def test_rounding_is_half_up_and_ignores_noise(spark):
    df = spark.createDataFrame([(1, 2.5), (2, 17.4645), (3, 17.464499999999997)], "i int, x double")
    assert [r["x"] for r in round_numbers(df, 0).orderBy("i").collect()][0] == 3.0
    assert [r["x"] for r in round_numbers(df, 3).orderBy("i").collect()][1:] == [17.465, 17.465]


@pytest.mark.parametrize("t, dof, p", [
    (2.2281388519649385, 10, 0.05), (12.706204736432095, 1, 0.05), (1.959963984540054, 1e9, 0.05),
    (2.5758293035489004, 1e8, 0.01), (0.0, 5, 1.0), (1.0, 1, 0.5), (-1.0, 1, 0.5)])
def test_p_value(t, dof, p):
    assert two_sided_p(t, dof) == pytest.approx(p, rel=1e-6)


@pytest.mark.parametrize("t", [0.1, 1.0, 5.0, 30.0])
def test_p_value_closed_form_for_two_degrees(t):
    assert two_sided_p(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-9)


def test_p_value_edges():
    assert two_sided_p(float("inf"), 5) == 0.0
    assert two_sided_p(None, 5) is None and two_sided_p(float("nan"), 5) is None
    assert two_sided_p(80.0, 90_000.0) == 0.0
    assert regularized_beta(0.5, 2, 3) == pytest.approx(11 / 16)
    # Both ways of computing meet at the change of method.
    assert two_sided_p(2.3, 1e6) == pytest.approx(two_sided_p(2.3, 1e6 + 1), rel=1e-6)


def test_p_values_as_a_column_equal_those_of_the_driver(spark):
    values = [(t, dof) for t in (-40.0, -2.5, -1e-9, 0.0, 0.3, 1.0, 1.96, 7.0, 300.0)
              for dof in (0.7, 1.0, 1.5, 2.0, 4.4, 30.0, 79.9, 80.1, 999.0, 12345.6, 400_000.0)]
    odd = [(None, 3.0), (1.0, None), (float("nan"), 3.0), (float("inf"), 3.0)]
    rows = with_two_sided_p(spark.createDataFrame(values + odd, "t double, dof double"), "t", "dof", "p")
    assert rows.columns == ["t", "dof", "p"]
    for r in rows.collect():
        want = two_sided_p(r["t"], r["dof"])
        assert r["p"] is None if want is None else r["p"] == pytest.approx(want, rel=1e-8, abs=1e-10), tuple(r)
