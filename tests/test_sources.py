import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, IntegerType, LongType, TimestampNTZType, TimestampType

from wheelpace.config import DEFAULT, SPEED
from wheelpace.plans import runs
from wheelpace.sources import schemas, versions
from wheelpace.sources.sinks import save_cleaned, save_csv, save_json
from wheelpace.sources.trips import (
    columns_to_read, nan_to_null, null_counts, read_cleaned, read_schema, read_trips, reconcile,
    require_same_load, scan_trips,
)


def test_schema_has_required_columns(spark, source_path):
    assert set(DEFAULT.required) <= set(read_schema(spark, source_path))


def test_missing_required_column_raises(spark, tmp_path):
    path = str(tmp_path / "broken")
    spark.createDataFrame([(1, 3), (2, 4)], "foo int, bar int").write.parquet(path)
    with pytest.raises(ValueError, match="required columns"):
        read_schema(spark, path)
    with pytest.raises(ValueError, match="required columns"):
        scan_trips(spark, path)


def test_columns_are_required_then_optional_without_unknown():
    names = ["store_and_fwd_flag", "VendorID", *reversed(DEFAULT.required), "airport_fee"]
    assert columns_to_read(names) == [*DEFAULT.required, "VendorID", "airport_fee"]


def test_scan_reads_only_chosen_columns(spark, tmp_path, raw):
    path = str(tmp_path / "trips")
    raw.withColumn("store_and_fwd_flag", F.lit("N")).write.parquet(path)
    trips = scan_trips(spark, path).select("fare_amount")
    assert "store_and_fwd_flag" not in scan_trips(spark, path).columns
    plan = trips._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<fare_amount:double>" in plan


def test_files_with_different_optional_columns_can_be_merged(spark, tmp_path, raw):
    folder = str(tmp_path / "months")
    raw.drop("airport_fee").write.parquet(f"{folder}/month=1")
    raw.withColumn("cbd_congestion_fee", F.lit(0.75)).write.parquet(f"{folder}/month=2")
    merged = scan_trips(spark, folder, merge_schema=True)
    assert {"airport_fee", "cbd_congestion_fee"} <= set(merged.columns)
    assert merged.count() == 2 * raw.count()


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_trips(spark, str(tmp_path / "absent"))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_cleaned(spark, str(tmp_path / "absent"))


def test_nan_becomes_null(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"), 1), (2.0, 2), (None, 3)], "x double, y int"))
    assert [r["x"] for r in df.orderBy("y").collect()] == [None, 2.0, None]
    assert df.dtypes == [("x", "double"), ("y", "int")]


def test_two_loads_agree(spark, source_path, raw):
    info = require_same_load(raw, scan_trips(spark, source_path).select(raw.columns))
    assert info["shape_match"] and info["missing_match"] and info["rows"] == raw.count()


def test_different_row_counts_raise(raw):
    with pytest.raises(ValueError, match="shape"):
        require_same_load(raw, raw.limit(3))


def test_different_columns_raise(raw):
    with pytest.raises(ValueError, match="shape"):
        require_same_load(raw, raw.drop("VendorID"))


def test_different_nulls_only_warn(spark, caplog):
    a = spark.createDataFrame([(1, None), (2, "x")], "i int, s string")
    info = require_same_load(a, a.fillna({"s": "y"}))
    assert info["shape_match"] and not info["missing_match"]
    assert "null counts differ" in caplog.text
    rows = {r["column"]: r for r in reconcile(a, a.fillna({"s": "y"})).collect()}
    assert (rows["s"]["nulls_left"], rows["s"]["nulls_right"]) == (1, 0)


def test_null_counts_handles_odd_names(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, `c d` string")
    assert {(r["column"], r["n_null"]) for r in null_counts(df).collect()} == {("a.b", 0), ("c d", 1)}


def test_saved_table_is_verified(spark, prepared, tmp_path):
    path = str(tmp_path / "cleaned")
    info = save_cleaned(prepared.trips, path)
    assert info["reload_verified"] and info["rows"] == prepared.rows
    again = spark.read.parquet(path)
    assert again.dtypes == prepared.trips.dtypes
    assert again.exceptAll(prepared.trips).isEmpty() and prepared.trips.exceptAll(again).isEmpty()
    assert any(".snappy." in f.name for f in (tmp_path / "cleaned").iterdir())


def test_csv_and_json_sinks(spark, tmp_path):
    table = spark.createDataFrame([("a", 1.5), ("b", None)], "k string, v double")
    paths = save_csv({"t": table}, str(tmp_path))
    assert sorted(spark.read.csv(paths["t"], header=True, schema=table.schema).collect()) == sorted(table.collect())
    path = save_json(spark.createDataFrame([{"p": 0.25, "ok": True}]), str(tmp_path / "j"))
    assert spark.read.json(path).first().asDict() == {"p": 0.25, "ok": True}


def test_columns_that_only_one_file_holds_are_kept(spark, raw, tmp_path):
    raw.write.parquet(f"{tmp_path}/trips")
    raw.withColumn("cbd_congestion_fee", F.lit(0.75)).write.mode("append").parquet(f"{tmp_path}/trips")
    both = runs.prepare_file(spark, f"{tmp_path}/trips", path=f"{tmp_path}/clean")
    one = runs.prepare(raw)
    assert both.rows == 2 * one.rows and both.trips.where("cbd_congestion_fee is null").count() == one.rows
    assert sorted(os.listdir(tmp_path)) == ["clean", "trips"]
    assert runs.facts_from(spark, f"{tmp_path}/clean").trips.count() == both.rows


def test_a_cleaned_table_is_checked(spark, prepared):
    for bad, message in ((prepared.trips.union(prepared.trips), "duplicates"),
                         (prepared.trips.withColumn(SPEED, F.lit(None).cast("double")), "nulls"),
                         (prepared.trips.drop(SPEED), "missing")):
        with pytest.raises(ValueError, match=message):
            runs.check_cleaned(bad)


def folder_of(path, *parts):
    """One folder of files with different schemas, one file each."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def test_files_of_different_types_are_one_table(spark, raw, tmp_path):
    kind = F.col("payment_type") % 3
    parts = [raw.where(kind == 0).withColumn("passenger_count", F.col("passenger_count").cast("long")),
             raw.where(kind == 1).withColumnRenamed("airport_fee", "Airport_fee").withColumn("cbd_congestion_fee", F.lit(0.75)),
             raw.where(kind == 2).drop("airport_fee").withColumn("payment_type", F.col("payment_type").cast("int"))]
    path = folder_of(str(tmp_path / "mixed"), *parts)
    rows = scan_trips(spark, path)
    names = read_schema(spark, path)
    assert columns_to_read(names) == rows.columns and "airport_fee" in names and "Airport_fee" not in names
    assert dict(rows.dtypes)["passenger_count"] == "double" and dict(rows.dtypes)["payment_type"] == "bigint"
    want = parts[0].unionByName(parts[1].withColumnRenamed("Airport_fee", "airport_fee"), allowMissingColumns=True).unionByName(
        parts[2], allowMissingColumns=True).select(rows.columns)
    assert rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()
    plan = rows.select("fare_amount")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 3 and "airport_fee" not in plan.split("ReadSchema")[1].splitlines()[0]
    pushed = rows.where("fare_amount > 400")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(fare_amount,400.0)" in pushed
    assert runs.prepare_file(spark, path).rows == runs.prepare(raw).rows


def test_files_of_one_schema_are_one_scan(spark, raw, tmp_path):
    one, other = raw.limit(20), raw.limit(20).withColumn("passenger_count", F.col("passenger_count").cast("long"))
    path = folder_of(str(tmp_path / "eras"), *[one] * 3, *[other] * 3, *[one] * 2)
    assert len(schemas.parts(spark, path)) == 2
    assert scan_trips(spark, path).count() == 160


def test_types_that_do_not_go_together_raise(spark, raw, tmp_path):
    path = folder_of(str(tmp_path / "odd"), raw.limit(5), raw.limit(5).withColumn("fare_amount", F.lit("much")))
    with pytest.raises(ValueError, match="fare_amount is double in some files and string in others|fare_amount is string"):
        read_schema(spark, path)


def test_wider_types():
    kinds = {n: t for n, t in (("i", IntegerType()), ("l", LongType()), ("f", FloatType()), ("d", DoubleType()),
                               ("t", TimestampType()), ("n", TimestampNTZType()), ("date", DateType()))}
    for a, b, want in (("i", "l", "l"), ("l", "d", "d"), ("f", "d", "d"), ("i", "i", "i"), ("t", "n", "n"), ("date", "t", "n")):
        assert schemas.wider("c", kinds[a], kinds[b]) == schemas.wider("c", kinds[b], kinds[a]) == kinds[want]
    with pytest.raises(ValueError, match="column c"):
        schemas.wider("c", kinds["d"], kinds["t"])


def small(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")


def test_versions_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 4):
        info = versions.publish(small(spark, *[float(n)] * n), path)
        assert info["rows"] == n and read_cleaned(spark, path).count() == n
    kept = [f for f in os.listdir(path) if f.startswith("version-")]
    assert len(kept) == 2 and versions.current(spark, path)["folder"] in kept


def test_a_run_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.publish(small(spark, 1.0, 2.0), path)

    def dies(*_):
        raise KeyboardInterrupt

    for step in ("verify", "write_entry"):
        with monkeypatch.context() as m:
            m.setattr(versions, step, dies)
            with pytest.raises(KeyboardInterrupt):
                versions.publish(small(spark, 9.0), path)
        assert [r["v"] for r in read_cleaned(spark, path).orderBy("i").collect()] == [1.0, 2.0]
    with open(f"{path}/{versions.LOG}/000000000002.json", "w") as f:  # an entry that was not written to its end
        f.write('{"folder": "vers')
    assert read_cleaned(spark, path).count() == 2
    with pytest.raises(ValueError, match="not good"):
        versions.publish(small(spark, 9.0), path, lambda _: (_ for _ in ()).throw(ValueError("not good")))
    assert read_cleaned(spark, path).count() == 2


def test_a_changed_value_is_found(spark, tmp_path):
    path = str(tmp_path / "t")
    entry = versions.publish(small(spark, 1.0, 2.0, 3.0), path)
    versions.verify(read_cleaned(spark, path), entry)
    versions.verify(read_cleaned(spark, path).orderBy(F.desc("i")).repartition(3), entry)
    for changed in (small(spark, 1.0, 2.0, 3.5), small(spark, 1.0, 2.0), small(spark, 1.0, 3.0, 2.0)):
        with pytest.raises(ValueError, match="differ"):
            versions.verify(changed, entry)


def test_every_file_has_its_own_month(spark, raw, tmp_path):
    later = {c: F.col(c) + F.expr("interval 31 days") for c in (DEFAULT.pickup, DEFAULT.dropoff)}
    source, path = folder_of(str(tmp_path / "files"), raw, raw.withColumns(later)), str(tmp_path / "months")
    files = runs.prepare_months(spark, source, path).collect()
    one = runs.prepare(raw)
    periods = {str(r["period"]): r["count"] for r in spark.read.parquet(path).groupBy("period").count().collect()}
    assert len(files) == 2 and len({r["month"] for r in files}) == 2
    assert periods[min(periods)] == one.rows and set(periods) == {str(r["month"]) for r in files}
    # A later file of one month replaces that month and leaves the other as it is.
    again = folder_of(str(tmp_path / "again"), raw.limit(600))
    runs.prepare_months(spark, again, path)
    now = {str(r["period"]): r["count"] for r in spark.read.parquet(path).groupBy("period").count().collect()}
    assert set(now) == set(periods) and now[max(now)] == periods[max(now)] and 0 < now[min(now)] < periods[min(now)]


def test_rows_of_a_large_file_are_dealt_to_many_tasks(spark, raw, tmp_path, monkeypatch):
    """One file of one row group is one task of the scan; copies are collapsed in more, the repeated trip in each of them."""
    monkeypatch.setattr(runs, "DEALT_ROWS", 100)
    one = raw.limit(1).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(900)))).drop("copy")
    rows = raw.unionByName(one).coalesce(1)
    sizes = [r["count"] for r in runs.dealt(rows, rows.count()).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 5 and max(sizes) < 200
    source = folder_of(str(tmp_path / "files"), rows)
    runs.prepare_months(spark, source, str(tmp_path / "months"))
    assert spark.read.parquet(str(tmp_path / "months")).count() == runs.prepare(raw).rows


def test_a_bad_file_is_named(spark, raw, tmp_path):
    source = folder_of(str(tmp_path / "files"), raw.limit(50), raw.limit(50).withColumn("fare_amount", F.lit(-1.0)))
    with pytest.raises(ValueError, match="1 files hold no plausible month: .*part-0"):
        runs.prepare_months(spark, source, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
