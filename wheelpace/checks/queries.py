"""One query per operator, over the whole given tables or over trips that Spark derives from them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wheelpace.checks.standin import cleaned, trips_from_events, trips_path
from wheelpace.config import (
    DEFAULT, DERIVED, DURATION, HOUR, ROUTE, RUSH, SLOW, SPEED, WEEKEND,
)
from wheelpace.functions import features
from wheelpace.operators import boosting, charts, facts, histogram, model, quality, stats
from wheelpace.operators.summary import summarize
from wheelpace.plans import runs
from wheelpace.session import fresh_path, once_per_session
from wheelpace.sources import sinks, trips as source

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.read_trips(spark, trips_path(spark, sf_dir))


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_time_features(quality.drop_incomplete(_raw(spark, sf_dir)))


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).trips


def _facts(spark: SparkSession, sf_dir: str, **groupings: list[str]) -> facts.Facts:
    done = cleaned(spark, sf_dir)
    return facts.Facts(done.trips, DEFAULT, groupings or None)


def _featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned trips with target and model features."""
    done = cleaned(spark, sf_dir)
    marked, _ = model.create_target(done.trips, DEFAULT)
    return features.add_model_features(marked)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return features.round_numbers(df, digits)


# --- sources and sinks ----------------------------------------------------------------------------

@query
def chosen_columns(spark, sf_dir):
    """Columns that are read, in order, with their rows and nulls."""
    path = trips_path(spark, sf_dir)
    order = {c: i for i, c in enumerate(source.columns_to_read(source.read_schema(spark, path)), 1)}
    position = F.create_map(*(x for c, i in order.items() for x in (F.lit(c), F.lit(i))))
    return source.null_counts(_raw(spark, sf_dir)).select(
        position[F.col("column")].alias("position"), "column", "n_rows", "n_null")


@query
def trip_scan(spark, sf_dir):
    return _doubles(_raw(spark, sf_dir))


@query
def load_reconciliation(spark, sf_dir):
    """The trips as computed against the trips as stored."""
    computed = trips_from_events(spark, sf_dir)
    return source.reconcile(computed, source.scan_trips(spark, trips_path(spark, sf_dir)))


@query
def mixed_files_prepared(spark, sf_dir):
    """Cleaned trips of one folder of three files that differ in types, optional columns and the case of names."""
    def write() -> str:
        path = fresh_path(spark, "mixed")
        rows = source.scan_trips(spark, trips_path(spark, sf_dir))
        kind = F.col("payment_type") % 3
        files = [rows.where(kind == 0).withColumn("passenger_count", F.col("passenger_count").cast("long")),
                 rows.where(kind == 1).withColumnRenamed("airport_fee", "Airport_fee").withColumn("cbd_congestion_fee", F.lit(0.75)),
                 rows.where(kind == 2).drop("airport_fee").withColumn("payment_type", F.col("payment_type").cast("int"))]
        for part in files:
            part.coalesce(1).write.mode("append").parquet(path)
        return path

    path = once_per_session(spark, f"mixed {sf_dir}", write)
    return _doubles(runs.prepare_file(spark, path).trips)


@query
def months_by_file(spark, sf_dir):
    """Rows by period of two monthly files that are cleaned into one table, the second 31 days after the first."""
    def write() -> str:
        path = fresh_path(spark, "months")
        rows = source.scan_trips(spark, trips_path(spark, sf_dir))
        later = {c: F.col(c) + F.expr("interval 31 days") for c in (DEFAULT.pickup, DEFAULT.dropoff)}
        for part in (rows, rows.withColumns(later)):
            part.coalesce(1).write.mode("append").parquet(path)
        return path

    path = fresh_path(spark, "by-month")
    files = runs.prepare_months(spark, once_per_session(spark, f"months {sf_dir}", write), path)
    kept = spark.read.parquet(path).groupBy(F.col("period").cast("date").alias("period")).agg(F.count("*").alias("n_cleaned"))
    return files.join(kept, files["month"] == kept["period"]).select(
        features.month_label(F.col("period")).alias("period"), "n_rows", "n_complete", "n_month", "n_plausible", "n_cleaned")


@query
def cleaned_sink(spark, sf_dir):
    """Clean, write, read back and verify."""
    done = runs.prepare_file(spark, trips_path(spark, sf_dir))
    return done.trips.agg(
        F.count("*").alias("n_rows"), F.lit(len(done.trips.columns)).alias("n_columns"),
        F.lit(done.info["save"]["reload_verified"]).alias("reload_verified"))


@query
def csv_sink(spark, sf_dir):
    paths = sinks.save_csv(
        {"describe": stats.describe(_facts(spark, sf_dir, all=list(DEFAULT.numeric)))}, fresh_path(spark, "csv"))
    return spark.read.csv(
        paths["describe"], header=True, schema="metric string, count long, mean double, std double, min double, "
                                               "p25 double, p50 double, p75 double, max double")


@query
def json_sink(spark, sf_dir):
    result = stats.run_rush_hour_ttest(_trips(spark, sf_dir))
    path = sinks.save_json(spark.createDataFrame([result]), fresh_path(spark, "json"))
    return spark.read.json(path).select(
        "n_rush_hour", "n_non_rush_hour", "mean_rush_hour", "mean_non_rush_hour",
        "t_statistic", "alpha", "is_significant")


# --- columns --------------------------------------------------------------------------------------

@query
def time_features(spark, sf_dir):
    return _doubles(_timed(spark, sf_dir).select("tpep_pickup_datetime", "tpep_dropoff_datetime", *DERIVED))


@query
def trip_months(spark, sf_dir):
    month = features.month_label(features.month_of(features.wall_clock("tpep_pickup_datetime")))
    return _raw(spark, sf_dir).groupBy(month.alias("month")).agg(F.count("*").alias("n")).orderBy("month")


@query
def model_features(spark, sf_dir):
    return features.add_model_features(_trips(spark, sf_dir)).select(
        "tpep_pickup_datetime", "PULocationID", "DOLocationID",
        "pickup_time_group", "route_id", "is_friday", "is_monday")


@query
def time_group_counts(spark, sf_dir):
    rows = features.add_model_features(_trips(spark, sf_dir))
    return rows.groupBy("pickup_time_group").agg(
        F.count("*").alias("n"), F.min(HOUR).alias("first_hour"), F.max(HOUR).alias("last_hour"))


@query
def rush_labels(spark, sf_dir):
    return _trips(spark, sf_dir).groupBy(features.rush_label(F.col(RUSH)).alias("label")).agg(
        F.count("*").alias("n"))


# --- quality --------------------------------------------------------------------------------------

@query
def null_profile(spark, sf_dir):
    return quality.null_profile(_raw(spark, sf_dir))


@query
def comissing_columns(spark, sf_dir):
    return quality.comissing(_raw(spark, sf_dir)).select(
        "n_null", F.array_join("columns", ",").alias("columns"))


@query
def complete_trips(spark, sf_dir):
    return _doubles(quality.drop_incomplete(_raw(spark, sf_dir)).select(*DEFAULT.critical))


@query
def missing_audit(spark, sf_dir):
    _, info = quality.handle_missing(_raw(spark, sf_dir))
    return spark.createDataFrame(
        [(info["rows_before"], info["rows_after"], info["rows_removed"], info["removed_ratio"])],
        "rows_before long, rows_after long, rows_removed long, removed_ratio double")


@query
def retained_nulls(spark, sf_dir):
    return quality.null_profile(quality.drop_incomplete(_raw(spark, sf_dir)))


@query
def dominant_month(spark, sf_dir):
    return quality.dominant_month(quality.drop_incomplete(_raw(spark, sf_dir)), DEFAULT.pickup).select(
        features.month_label(F.col("month")).alias("month"), "n")


@query
def dominant_month_rows(spark, sf_dir):
    kept, _ = quality.filter_target_month(quality.drop_incomplete(_raw(spark, sf_dir)))
    return kept.select("tpep_pickup_datetime", "PULocationID", "DOLocationID")


@query
def stray_months(spark, sf_dir):
    return quality.stray_months(quality.drop_incomplete(_raw(spark, sf_dir)), DEFAULT.pickup)


@query
def outlier_funnel(spark, sf_dir):
    kept, _ = quality.filter_target_month(_timed(spark, sf_dir))
    return quality.outlier_funnel(kept).drop("reason")


@query
def plausible_trips(spark, sf_dir):
    return _doubles(quality.keep_plausible(_timed(spark, sf_dir)).select(
        "tpep_pickup_datetime", "fare_amount", "trip_distance", "passenger_count", "total_amount", DURATION, SPEED))


@query
def distinct_trips(spark, sf_dir):
    return _doubles(quality.drop_exact_duplicates(_raw(spark, sf_dir)))


@query
def duplicate_audit(spark, sf_dir):
    _, info = quality.drop_duplicates(_raw(spark, sf_dir))
    return spark.createDataFrame(
        [(info["rows_before"], info["rows_after"], info["duplicates_removed"])],
        "rows_before long, rows_after long, duplicates_removed long")


@query
def duplicates_left(spark, sf_dir):
    return quality.duplicate_count(_trips(spark, sf_dir))


@query
def null_split(spark, sf_dir):
    return stats.null_split(_facts(spark, sf_dir, all=list(DEFAULT.numeric)))


@query
def contract_check(spark, sf_dir):
    """Derived columns that are present, and nulls in the speed column."""
    rows = _trips(spark, sf_dir)
    runs.check_contract(rows)
    return rows.agg(F.lit(sum(c in rows.columns for c in DERIVED)).alias("derived_columns"),
                    F.count_if(F.col(SPEED).isNull()).alias("null_speeds"))


@query
def preparation_funnel(spark, sf_dir):
    done = runs.prepare_file(spark, trips_path(spark, sf_dir))
    return runs.funnel_table(spark, done.info)


@query
def cleaned_trips(spark, sf_dir):
    return _doubles(_trips(spark, sf_dir))


@query
def rush_subset(spark, sf_dir):
    speed = F.col(SPEED)
    return _trips(spark, sf_dir).agg(
        F.count(F.when(F.col(RUSH), speed)).alias("n_rush"), F.count(F.when(~F.col(RUSH), speed)).alias("n_other"))


# --- statistics -----------------------------------------------------------------------------------

@query
def describe_trips(spark, sf_dir):
    return stats.describe(_facts(spark, sf_dir, all=list(DEFAULT.numeric)))


@query
def describe_trips_large(spark, sf_dir):
    """The same description on the way taken for tables of unknown size."""
    return stats.compute_descriptive_stats(_trips(spark, sf_dir))


@query
def hourly_profile(spark, sf_dir):
    return stats.hourly_profile(_facts(spark, sf_dir, pickup_hour=[SPEED]))


@query
def hourly_profile_large(spark, sf_dir):
    rows = _trips(spark, sf_dir)
    return stats.hourly_profile(facts.Facts(rows, groupings={HOUR: [SPEED]}))


@query
def speed_by_weekend(spark, sf_dir):
    return stats.speed_by(_facts(spark, sf_dir), WEEKEND)


@query
def speed_by_rush(spark, sf_dir):
    return stats.speed_by(_facts(spark, sf_dir), RUSH)


@query
def group_speed_rush(spark, sf_dir):
    done = cleaned(spark, sf_dir)
    return stats.compare_group_speed(done.trips, RUSH)


@query
def group_speed_weekend(spark, sf_dir):
    done = cleaned(spark, sf_dir)
    return stats.compare_group_speed(done.trips, WEEKEND)


@query
def group_speed_zone(spark, sf_dir):
    """Summary by a key whose number of values is not known beforehand."""
    return stats.compare_group_speed(_trips(spark, sf_dir), "PULocationID")


@query
def hourly_by_weekend(spark, sf_dir):
    return stats.compare_hourly_speed_by_weekend(_trips(spark, sf_dir))


@query
def hourly_mean(spark, sf_dir):
    return _doubles(stats.hourly_mean(_facts(spark, sf_dir)))


@query
def day_hour_cells(spark, sf_dir):
    return charts.heat_cells(_facts(spark, sf_dir))


@query
def day_hour_heatmap(spark, sf_dir):
    return charts.heatmap(_facts(spark, sf_dir))


@query
def heatmap_row_means(spark, sf_dir):
    return _doubles(charts.heat_row_means(_facts(spark, sf_dir)))


@query
def merged_histogram(spark, sf_dir):
    """Speed by hour from the stored histograms of two halves of the trips, merged."""
    rows = _trips(spark, sf_dir)
    halves = [histogram.count_values(rows.where(side), [SPEED, DURATION], [HOUR, WEEKEND]) for side in (
        F.col("payment_type") <= 2, F.col("payment_type") > 2)]
    stored = [histogram.load(spark, h.save(fresh_path(spark, "half"))) for h in halves]
    found = stored[0].merged(stored[1]).moments(SPEED, HOUR)
    return _doubles(found.select(HOUR, "n_rows", "n", (F.col("total") / F.col("n")).alias("mean"), F.sqrt("var").alias("std_pop"), "min", "max"))


@query
def extreme_hours_rounded(spark, sf_dir):
    return stats.extreme_hours(stats.hourly_profile(_facts(spark, sf_dir, pickup_hour=[SPEED])), "mean_speed")


@query
def extreme_hours(spark, sf_dir):
    return _doubles(stats.extreme_hours(stats.hourly_mean(_facts(spark, sf_dir)), "mean"))


@query
def speed_median(spark, sf_dir):
    done = cleaned(spark, sf_dir)
    found = summarize(done.trips, {"all": [SPEED]}, (0.5,))
    return found.select(features.rounded(F.col("p50"), 3).alias("speed_median"))


@query
def flag_shares(spark, sf_dir):
    return stats.flag_shares(_facts(spark, sf_dir))


@query
def correlation_matrix(spark, sf_dir):
    return stats.compute_correlation_matrix(_trips(spark, sf_dir))


@query
def welch_test(spark, sf_dir):
    row = stats.welch(facts.speed_cube(_trips(spark, sf_dir)))
    return _doubles(row.select("n_rush", "n_other", "mean_rush", "mean_other", "t", "dof"), 4)


@query
def welch_by_zone(spark, sf_dir):
    """The rush-hour test within every pickup zone."""
    found = stats.welch_by(_trips(spark, sf_dir), DEFAULT.pickup_zone)
    return found.select(DEFAULT.pickup_zone, "n_rush", "n_other", *(
        features.rounded(F.col(c), d).alias(c) for c, d in (("t", 6), ("dof", 6), ("p", 9))))


@query
def rush_box_plot(spark, sf_dir):
    return _doubles(charts.box_stats(_facts(spark, sf_dir, is_rush_hour=[SPEED])))


@query
def slow_threshold(spark, sf_dir):
    done = cleaned(spark, sf_dir)
    return _doubles(summarize(done.trips, {"all": [SPEED]}, (0.25,)).select(
        F.col("p25").alias("threshold")))


@query
def table_shape(spark, sf_dir):
    rows = _trips(spark, sf_dir)
    return rows.agg(F.count("*").alias("n_rows"), F.lit(len(rows.columns)).alias("n_cols"))


# --- findings -------------------------------------------------------------------------------------

@query
def hourly_finding(spark, sf_dir):
    return _doubles(charts.hourly_finding(_facts(spark, sf_dir)))


@query
def rush_finding(spark, sf_dir):
    return _doubles(charts.rush_finding(_facts(spark, sf_dir, is_rush_hour=[SPEED])))


@query
def heat_finding(spark, sf_dir):
    return charts.heat_finding(_facts(spark, sf_dir))


# --- model ----------------------------------------------------------------------------------------

@query
def slow_trip_target(spark, sf_dir):
    done = cleaned(spark, sf_dir)
    marked, _ = model.create_target(done.trips, DEFAULT)
    return _doubles(marked.select("tpep_pickup_datetime", "PULocationID", SPEED, SLOW))


@query
def class_shares(spark, sf_dir):
    return _doubles(model.class_shares(_featured(spark, sf_dir)))


@query
def class_weights(spark, sf_dir):
    return _doubles(model.class_weights(_featured(spark, sf_dir)))


@query
def split_check(spark, sf_dir):
    """Rows and test rows per class."""
    train, test = model.split(_featured(spark, sf_dir))
    both = train.select(SLOW, F.lit(0).alias("side")).unionByName(test.select(SLOW, F.lit(1).alias("side")))
    return both.groupBy(SLOW).agg(F.count("*").alias("n"), F.sum("side").alias("n_test"))


@query
def median_fills(spark, sf_dir):
    done = cleaned(spark, sf_dir)
    return model.medians(done.trips, ("passenger_count", "trip_distance", "tip_amount")).select(
        "column", features.rounded(F.col("fill"), 6).alias("fill"))


@query
def frequent_fills(spark, sf_dir):
    return model.most_frequent(model.category_counts(_featured(spark, sf_dir), DEFAULT.categorical_features))


@query
def category_codes(spark, sf_dir):
    counts = model.category_counts(_featured(spark, sf_dir), DEFAULT.categorical_features)
    return model.ordinal_codes(counts).drop("n")


@query
def rule_confusion(spark, sf_dir):
    """Confusion matrix of the rule that every rush-hour trip is slow."""
    return model.confusion(_featured(spark, sf_dir).withColumn("prediction", F.col(RUSH).cast("int")))


@query
def rule_metrics(spark, sf_dir):
    return _doubles(model.metrics(rule_confusion(spark, sf_dir)))


@query
def rule_report(spark, sf_dir):
    return _doubles(model.report(rule_confusion(spark, sf_dir)))


def _run(spark, sf_dir):
    """The whole run over the stored trips, once per session."""
    folder = fresh_path(spark, "run")
    return once_per_session(spark, f"run {sf_dir}", lambda: runs.run_file(spark, trips_path(spark, sf_dir), folder))


def _fitted(spark, sf_dir):
    """Model, metrics and report of the whole run."""
    done = _run(spark, sf_dir)
    return done["fitted"], *(spark.read.json(f"{done['folder']}/{name}") for name in ("metrics", "report")), done["folder"]


@query
def whole_run(spark, sf_dir):
    """Rows of all tables that a run over the stored trips leaves behind; computed by its first call only."""
    return runs.stored_tables(spark, _run(spark, sf_dir))


@query
def leaf_boosted_trees(spark, sf_dir):
    """The first tree of three leaves over all cleaned trips: column and cut of inner nodes, rows and value of leaves."""
    rows = _featured(spark, sf_dir)
    names = [HOUR, "pickup_dayofweek", DEFAULT.passengers, "payment_type"]
    weights = {r[SLOW]: r["weight"] for r in model.class_weights(rows).collect()}
    numbers = rows.select(SLOW, F.lit(False).alias("held_out"), *(F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in names))
    fitted, state = boosting.fit(numbers, names, SLOW, "held_out", weights, replace(model.tree_settings(), max_rounds=1, max_leaves=3))
    tree = fitted.trees[0]
    counted = state.cells.groupBy(boosting.node_of(tree, "bins").alias("node")).agg(F.sum("n").alias("n")).collect()  # three leaves
    sizes = {r["node"]: r["n"] for r in counted}
    for i in range(len(tree.left) - 1, -1, -1):
        if tree.left[i] >= 0:
            sizes[i] = sizes[tree.left[i]] + sizes[tree.right[i]]
    found = [(i, names[tree.feature[i]], fitted.cuts[tree.feature[i]][tree.cut[i]], sizes[i], None) if tree.left[i] >= 0
             else (i, None, None, sizes[i], tree.value[i]) for i in range(len(tree.left))]
    return _doubles(spark.createDataFrame(found, "node int, feature string, cut double, n long, value double"))


@query
def boosted_trees_metrics(spark, sf_dir):
    """What holds of the trained trees' metrics whatever the trees are, next to the threshold and the sizes."""
    right, wrong = F.col("tp") + F.col("tn"), F.col("fp") + F.col("fn")
    majority = F.greatest(F.col("tn") + F.col("fp"), F.col("tp") + F.col("fn"))
    return _fitted(spark, sf_dir)[1].select(
        features.rounded(F.col("speed_threshold_mph"), 6).alias("threshold"), "train_rows", "test_rows",
        (F.abs(F.col("accuracy") - right / (right + wrong)) < 1e-12).alias("accuracy_adds_up"),
        (F.abs(F.col("recall") * (F.col("tp") + F.col("fn")) - F.col("tp")) < 1e-6).alias("recall_adds_up"),
        (right > majority).alias("better_than_majority"))


@query
def boosted_trees_report(spark, sf_dir):
    """Lines of the class report with their support; whether every figure is a share."""
    shares = [F.col(c).between(0, 1) for c in ("precision", "recall", "f1_score")]
    return _fitted(spark, sf_dir)[2].select(
        "label", "support", (shares[0] & shares[1] & shares[2]).alias("figures_are_shares"))


@query
def model_reload(spark, sf_dir):
    """Rows whose prediction changes when the saved model is loaded again: none."""
    fitted, _, _, folder = _fitted(spark, sf_dir)
    _, test = model.split(_featured(spark, sf_dir))
    checked = model.verify_saved_model(fitted, f"{folder}/model", test)
    return spark.createDataFrame([(checked["rows"], checked["differ"])], "n_rows long, n_changed long")


@query
def unseen_codes(spark, sf_dir):
    """Codes of all routes, learned from the pickups of days 1 to 24; routes seen on later days only get -1."""
    rows = _featured(spark, sf_dir).withColumn("pickup_day", F.dayofmonth(DEFAULT.pickup))
    known = model.ordinal_codes(model.category_counts(rows.where("pickup_day <= 24"), (ROUTE,)))
    fitted = model.SlowTripModel(None, known, {}, (ROUTE,), (ROUTE,), 0.0, 0)
    return fitted.encode(rows).groupBy(ROUTE).agg(
        F.max(f"x_{ROUTE}").cast("int").alias("code"), F.count("*").alias("n"))


@query
def stored_stage(spark, sf_dir):
    """The statistics stage on the cleaned table as it is stored: speeds by rush hour."""
    path = cleaned(spark, sf_dir).info["save"]["path"]
    return stats.speed_by(facts.Facts(source.read_cleaned(spark, path), DEFAULT), RUSH)


@query
def tied_quantiles(spark, sf_dir):
    """Quantiles of a column with few values, where both neighbours of a position mostly are the same value."""
    found = summarize(_table(spark, sf_dir, "lineitem"), {"l_returnflag": ["l_quantity"]}, (0.1, 0.3, 0.9, 0.99))
    return found.select(F.col("level").alias("l_returnflag"), "n", "p10", "p30", "p90", "p99")


# --- the same operators on the given tables --------------------------------------------------------

_LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def describe_lineitem(spark, sf_dir):
    return stats.compute_descriptive_stats(
        _table(spark, sf_dir, "lineitem"), columns=_LINE_NUMBERS, digits=4)


@query
def correlate_lineitem(spark, sf_dir):
    return stats.compute_correlation_matrix(_table(spark, sf_dir, "lineitem"), columns=_LINE_NUMBERS, digits=6)


@query
def price_by_flag(spark, sf_dir):
    return stats.compare_group_speed(
        _table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice", digits=4)


@query
def value_by_event_type(spark, sf_dir):
    return stats.compare_group_speed(_table(spark, sf_dir, "events"), "event_type", "value", digits=4)


@query
def balance_by_segment(spark, sf_dir):
    return stats.compare_group_speed(_table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal", digits=4)


@query
def orders_dominant_month(spark, sf_dir):
    return quality.keep_dominant_month(_table(spark, sf_dir, "orders"), "o_orderdate").select(
        "o_orderkey", "o_orderdate")


@query
def orders_other_months(spark, sf_dir):
    return quality.stray_months(_table(spark, sf_dir, "orders"), "o_orderdate")


@query
def lineitem_duplicates(spark, sf_dir):
    """Rows that repeat a combination of order, part and supplier."""
    return quality.duplicate_count(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"])


@query
def customer_nulls(spark, sf_dir):
    return source.null_counts(_table(spark, sf_dir, "customer"))
