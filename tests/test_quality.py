import pytest
from pyspark.sql import functions as F

from wheelpace.config import DEFAULT, DERIVED
from wheelpace.functions.features import add_time_features
from wheelpace.operators import quality
from wheelpace.plans import runs


def test_no_nulls_in_critical_columns(raw):
    kept, info = quality.handle_missing(raw)
    assert all(kept.where(F.col(c).isNull()).isEmpty() for c in DEFAULT.critical)
    assert info["rows_before"] - info["rows_after"] == info["rows_removed"] == raw.count() - kept.count()
    assert info["missing_all"] and info["strategy"] and info["retained_missing"]["passenger_count"] > 0


def test_all_null_raises(trips):
    df = trips({}, {}).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in trips({}).schema))
    with pytest.raises(ValueError, match="no rows left"):
        quality.handle_missing(df)
    with pytest.raises(ValueError, match="no rows left"):
        quality.audit(df)


def test_passenger_nulls_survive(trips):
    df = trips({"passenger_count": None}, {"passenger_count": 2.0}, {"passenger_count": 99.0})
    kept, _ = quality.handle_missing(df)
    assert kept.count() == 3
    out, _ = quality.remove_outliers(add_time_features(kept))
    assert sorted([r["passenger_count"] for r in out.collect()], key=str) == [2.0, None]


def test_comissing_columns(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 2, 2), (None, None, 3), (None, None, None)], "a int, b int, c int")
    assert [r.asDict() for r in quality.comissing(df).collect()] == [{"n_null": 2, "columns": ["a", "b"]}]


def test_impossible_speed_is_removed(trips):
    df = add_time_features(trips(
        {"tpep_dropoff_datetime": "2026-05-10 08:30:00", "trip_distance": 5.0},
        {"tpep_dropoff_datetime": "2026-05-10 08:30:00", "trip_distance": 6.0},
        {"tpep_dropoff_datetime": "2026-05-10 08:01:00", "trip_distance": 90.0}))
    out, info = quality.remove_outliers(df)
    assert sorted(r["trip_distance"] for r in out.collect()) == [5.0, 6.0]
    assert {s["name"]: s["rows_removed"] for s in info["steps"]}["speed"] == 1


def test_empty_result_raises(trips):
    with pytest.raises(ValueError, match="no rows left after the fare test"):
        quality.remove_outliers(add_time_features(trips(*[{"fare_amount": -5.0}] * 3)))


@pytest.mark.parametrize("field, value, kept", [
    ("fare_amount", 2.5, True), ("fare_amount", 500.0, True), ("fare_amount", 2.49, False),
    ("trip_distance", 0.1, False),  # 0.3 mph
    ("total_amount", 0.0, False), ("total_amount", 0.01, True), ("passenger_count", 6.0, True),
    ("passenger_count", 0.0, False), ("passenger_count", None, True), ("total_amount", None, False),
    ("tpep_dropoff_datetime", "2026-05-10 14:00:00", False), ("tpep_dropoff_datetime", "2026-05-10 08:03:00", True)])
def test_range_ends(trips, field, value, kept):
    assert quality.keep_plausible(add_time_features(trips({field: value}))).isEmpty() is not kept


def test_first_failed_test_counts_once(trips):
    df = add_time_features(trips({}, {"fare_amount": -1.0, "trip_distance": 0.0, "total_amount": -1.0},
                                 {"trip_distance": 950.0, "total_amount": None}))
    steps = {r["name"]: (r["rows_before"], r["rows_removed"]) for r in quality.outlier_funnel(df).collect()}
    assert steps == {"fare": (3, 1), "distance": (2, 1), "duration": (1, 0), "speed": (1, 0),
                     "passengers": (1, 0), "total": (1, 0)}


def test_month_tie_takes_the_earliest(trips):
    def at(month):
        return {"tpep_pickup_datetime": f"2026-{month}-10 08:00:00", "tpep_dropoff_datetime": f"2026-{month}-10 08:20:00"}

    df = trips(at("06"), at("05"), at("07"), at("06"), at("05"))
    out, info = quality.filter_target_month(df)
    assert (info["target_period"], info["rows_after"], info["stray_periods"]) == ("2026-05", 2, ["2026-06", "2026-07"])
    assert out.count() == 2
    assert quality.keep_dominant_month(df, DEFAULT.pickup).exceptAll(out).isEmpty()
    assert str(quality.audit(df)["month"]["month"]) == "2026-05-01"
    assert [r["month"] for r in quality.stray_months(df, DEFAULT.pickup).collect()] == ["2026-06", "2026-07"]


def test_month_filter_is_a_pushed_range(spark, source_path):
    out, _ = quality.filter_target_month(spark.read.parquet(source_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan and "LessThan(tpep_pickup_datetime" in plan


def test_report_lists_twenty_stray_months_and_the_table_all(trips):
    df = trips(*({"tpep_pickup_datetime": f"{y}-05-10 08:00:00"} for y in range(1990, 2020)), {})
    df = df.unionByName(trips({}))
    _, info = quality.filter_target_month(df)
    assert info["target_period"] == "2026-05" and len(info["stray_periods"]) == 20
    assert info["stray_periods"][0] == "1990-05"
    assert quality.stray_months(df, DEFAULT.pickup).count() == 30


def test_duplicates(raw):
    some = raw.limit(50)
    doubled = some.unionByName(some)
    out, info = quality.drop_duplicates(doubled)
    assert out.count() == info["rows_after"] < 100
    assert info["duplicates_removed"] >= 50
    assert quality.duplicate_count(out).first()["n_duplicates"] == 0


def test_derived_columns_do_not_count_for_duplicates(trips):
    df = trips({}, {}).withColumn("duration_min", F.rand(1))
    assert quality.drop_exact_duplicates(df).count() == 1


def test_audit_equals_the_separate_stages(raw):
    audit = quality.audit(raw)
    kept, missing = quality.handle_missing(raw)
    month_rows, month = quality.filter_target_month(add_time_features(kept))
    _, outliers = quality.remove_outliers(month_rows)
    assert audit["missing"] == missing
    assert {k: v for k, v in audit["month"].items() if k != "month"} == month
    assert audit["outliers"] == outliers


def test_audit_needs_one_scan(raw, spark, source_path):
    trips = spark.read.parquet(source_path)
    plan = quality.clean(trips, "2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_cleaned_rows_follow_the_bounds(prepared):
    rows = prepared.trips
    cfg = DEFAULT
    inside = (F.col("fare_amount").between(*cfg.fare_range) & F.col("trip_distance").between(*cfg.distance_range)
              & F.col("duration_min").between(*cfg.duration_range) & F.col("average_speed_mph").between(*cfg.speed_range)
              & (F.col("passenger_count").isNull() | F.col("passenger_count").between(*cfg.passenger_range))
              & (F.col("total_amount") > 0))
    assert rows.count() == rows.where(inside).count() == prepared.rows
    assert quality.duplicate_count(rows).first()["n_duplicates"] == 0
    assert rows.select(F.trunc("tpep_pickup_datetime", "month")).distinct().count() == 1
    assert set(DERIVED) <= set(rows.columns)


def test_row_counts_add_up(spark, prepared):
    info = prepared.info
    assert info["original_rows"] - info["final_rows"] == info["removed_total"]
    table = {r["stage"]: r for r in runs.funnel_table(spark, info).collect()}
    order = ["missing", "month", "fare", "distance", "duration", "speed", "passengers", "total", "duplicates"]
    for a, b in zip(order, order[1:]):
        assert table[a]["rows_after"] == table[b]["rows_before"]
    assert all(r["rows_before"] - r["rows_after"] == r["rows_removed"] for r in table.values())
    assert (table["missing"]["rows_before"], table["duplicates"]["rows_after"]) == (1008, 986)


def test_nan_counts_as_null(spark, trips):
    df = trips({}, {"trip_distance": float("nan")}, {"total_amount": float("nan"), "PULocationID": 7},
               {"passenger_count": float("nan"), "PULocationID": 8})
    done = runs.prepare(df)
    assert sorted(r["PULocationID"] for r in done.trips.collect()) == [8, 100]
    assert done.info["missing"]["rows_removed"] == 1
    assert done.trips.where("PULocationID = 8").first()["passenger_count"] is None


def test_result_does_not_depend_on_partitions(spark, raw, prepared):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = runs.prepare(raw.repartition(7))
        assert one.rows == prepared.rows
        assert one.trips.exceptAll(prepared.trips.select(one.trips.columns)).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_hot_trip_collapses_before_the_shuffle(spark, trips):
    many = trips({}).crossJoin(spark.range(0, 3000, 1, 3)).drop("id").unionByName(trips({"PULocationID": 5}))
    plan = quality.drop_exact_duplicates(many)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2  # one of them on the map side
    assert quality.drop_exact_duplicates(many).count() == 2
