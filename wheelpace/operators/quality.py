"""Null policy, dominant month, plausible ranges and exact duplicates, with their row counts.

Every stage exists as a plain ``DataFrame -> DataFrame`` step and as a step that also returns its
counts. Counts come from one aggregation per stage, never from one job per condition.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelpace.config import DEFAULT, DURATION, SPEED, TripConfig
from wheelpace.functions.features import (
    add_time_features, miles_per_hour, minutes_between, month_label, month_of, wall_clock,
)
from wheelpace.sources.trips import null_counts

STRAY_MONTHS_SHOWN = 20


# --- nulls ---------------------------------------------------------------------------------------

def null_profile(df: DataFrame) -> DataFrame:
    """(column, n_null) of the columns that hold nulls."""
    return null_counts(df).where("n_null > 0").select("column", "n_null")


def comissing(df: DataFrame) -> DataFrame:
    """Groups of two or more columns with the same null count: the sign of fields left out together."""
    groups = null_profile(df).groupBy("n_null").agg(F.sort_array(F.collect_list("column")).alias("columns"))
    return groups.where(F.size("columns") >= 2)


def critical_columns(df: DataFrame, cfg: TripConfig = DEFAULT) -> list[str]:
    return [c for c in cfg.critical if c in df.columns]


def drop_incomplete(df: DataFrame, cfg: TripConfig = DEFAULT) -> DataFrame:
    """Listwise deletion on the critical columns; other nulls stay."""
    return df.dropna(subset=critical_columns(df, cfg))


def handle_missing(df: DataFrame, cfg: TripConfig = DEFAULT) -> tuple[DataFrame, dict[str, object]]:
    """:func:`drop_incomplete` with its audit; error when no row is left."""
    complete = _complete(df, cfg)
    row = df.agg(
        F.count("*").alias("before"),
        F.count_if(complete).alias("after"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns),
        *(F.count_if(F.col(c).isNull() & complete).alias(f"kept_{c}") for c in df.columns),
    ).first()
    if not row["after"]:
        raise ValueError("no rows left after removing rows with nulls in critical columns")
    return drop_incomplete(df, cfg), _missing_info(df.columns, row.asDict(), critical_columns(df, cfg))


def _complete(df: DataFrame, cfg: TripConfig) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in critical_columns(df, cfg)), F.lit(True))


# The keys of the audits that consumers rely on.
def _missing_info(columns: list[str], row: dict, critical: list[str]) -> dict[str, object]:
    nulls = {c: row[f"null_{c}"] for c in columns if row[f"null_{c}"]}
    same: dict[str, list[str]] = {}
    for c, n in nulls.items():
        same.setdefault(str(n), []).append(c)
    removed = row["before"] - row["after"]
    return {
        "rows_before": row["before"], "rows_after": row["after"], "rows_removed": removed,
        "removed_ratio": round(removed / row["before"], 5) if row["before"] else 0.0,
        "missing_all": nulls,
        "missing_critical": {c: n for c, n in nulls.items() if c in critical},
        "critical_columns": critical,
        "comissing_groups": {n: sorted(cs) for n, cs in same.items() if len(cs) > 1},
        "retained_missing": {c: row[f"kept_{c}"] for c in columns if row[f"kept_{c}"]},
        "strategy": "rows with a null in a critical column are removed, other nulls are kept",
    }


# --- month ---------------------------------------------------------------------------------------

def month_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per year-month; rows without a timestamp are left out."""
    ts = wall_clock(column)
    return df.where(ts.isNotNull()).groupBy(month_of(ts).alias("month")).agg(F.count("*").alias("n"))


def dominant_month(df: DataFrame, column: str) -> DataFrame:
    """The most frequent month as one row; the earliest one on a tie."""
    return month_counts(df, column).orderBy(F.desc("n"), "month").limit(1)


def stray_months(df: DataFrame, column: str) -> DataFrame:
    """All months but the dominant one, ascending. The text of a report lists the first 20 only."""
    counts = month_counts(df, column)
    strays = counts.join(F.broadcast(dominant_month(df, column).select("month")), "month", "left_anti")
    return strays.select(month_label(F.col("month")).alias("month"), "n").orderBy("month")


def in_month(column: str, month) -> Column:
    """Range test against literals, which reaches the parquet scan as a pushed filter."""
    start = F.lit(str(month)).cast("date")
    ts = wall_clock(column)
    return (ts >= start.cast("timestamp_ntz")) & (ts < F.add_months(start, 1).cast("timestamp_ntz"))


def keep_dominant_month(df: DataFrame, column: str) -> DataFrame:
    """Rows of the dominant month in one lazy plan: the month is a single broadcast row."""
    target = F.broadcast(dominant_month(df, column).select("month"))
    keyed = df.withColumn("month", month_of(wall_clock(column)))
    return keyed.join(target, "month", "left_semi").drop("month")


def _pick_month() -> list[Column]:
    """Aggregates over (month, n): the dominant month and the sorted months. At most 12 x 9999 months exist."""
    order = F.struct("n", -F.unix_date("month"))
    return [F.max_by("month", order).alias("target"), F.array_sort(F.collect_set("month")).alias("months")]


def filter_target_month(df: DataFrame, cfg: TripConfig = DEFAULT) -> tuple[DataFrame, dict[str, object]]:
    """Keep the dominant month, chosen first so that the filter is a plain timestamp range."""
    counts = month_counts(df, cfg.pickup)
    row = counts.agg(F.sum("n").alias("n"), F.max("n").alias("top"), *_pick_month()).first()
    if row["target"] is None:
        raise ValueError(f"{cfg.pickup} holds no timestamp")
    kept = df.where(in_month(cfg.pickup, row["target"]))
    return kept, _month_info(row["target"], row["months"], row["n"], row["top"])


def months_by_file(df: DataFrame, file: str, cfg: TripConfig = DEFAULT) -> DataFrame:
    """(file, month, n_rows, n_complete, n_month, n_plausible): the dominant month of each file, from one scan.

    ``n_month`` counts the complete rows of that month, ``n_plausible`` those of them that pass all tests. A file
    without a complete row that has a timestamp has no month.
    """
    pickup = wall_clock(cfg.pickup)
    timed = df.withColumn(DURATION, minutes_between(pickup, wall_clock(cfg.dropoff)))
    timed = timed.withColumn(SPEED, miles_per_hour(F.col(cfg.distance), F.col(DURATION)))
    passes = reduce(lambda a, b: a & b, (F.coalesce(t.passes, F.lit(False)) for t in range_tests(cfg)))
    complete = _complete(df, cfg)
    cells = timed.groupBy(file, month_of(pickup).alias("month")).agg(
        F.count("*").alias("n_rows"), F.count_if(complete).alias("n"), F.count_if(complete & passes).alias("good"))
    order = F.when(F.col("month").isNotNull() & (F.col("n") > 0), F.struct("n", -F.unix_date("month")))
    top = F.max_by(F.struct("month", "n", "good"), order)
    return cells.groupBy(file).agg(F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n_complete"), top.alias("top")).select(
        file, "top.month", "n_rows", "n_complete", F.coalesce("top.n", F.lit(0)).alias("n_month"),
        F.coalesce("top.good", F.lit(0)).alias("n_plausible"))


def _month_info(target, months, before: int, after: int) -> dict[str, object]:
    return {
        "target_period": f"{target:%Y-%m}",
        "rows_before": before, "rows_after": after, "rows_removed": before - after,
        "stray_periods": [f"{m:%Y-%m}" for m in months if m != target][:STRAY_MONTHS_SHOWN],
    }


# --- plausible ranges ----------------------------------------------------------------------------

@dataclass(frozen=True)
class RangeTest:
    name: str
    passes: Column
    reason: str


def range_tests(cfg: TripConfig = DEFAULT, minutes: Column | None = None, speed: Column | None = None) -> list[RangeTest]:
    """The six tests, in the order in which they are reported. A null fails, except for passengers."""
    minutes = F.col(DURATION) if minutes is None else minutes
    speed = F.col(SPEED) if speed is None else speed
    passengers = F.col(cfg.passengers)

    def test(name: str, value: Column, bounds: tuple, what: str) -> RangeTest:
        low, high = bounds
        return RangeTest(name, value.between(low, high), f"{what} outside {low} to {high}")

    riders = test("passengers", passengers, cfg.passenger_range, "passenger count present and")
    return [
        test("fare", F.col(cfg.fare), cfg.fare_range, "fare"),
        test("distance", F.col(cfg.distance), cfg.distance_range, "miles"),
        test("duration", minutes, cfg.duration_range, "minutes"),
        test("speed", speed, cfg.speed_range, "miles per hour"),
        RangeTest(riders.name, passengers.isNull() | riders.passes, riders.reason),
        RangeTest("total", F.col(cfg.total) > 0, "total amount of zero or less: a refund or a cancelled trip"),
    ]


def first_failed(tests: list[RangeTest]) -> Column:
    """Position (from 1) of the first test a row fails; null when it passes all."""
    return F.coalesce(*(
        F.when(~F.coalesce(t.passes, F.lit(False)), F.lit(i)) for i, t in enumerate(tests, 1)
    ))


def keep_plausible(df: DataFrame, cfg: TripConfig = DEFAULT) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, (t.passes for t in range_tests(cfg))))


def outlier_funnel(df: DataFrame, cfg: TripConfig = DEFAULT) -> DataFrame:
    """(step, name, rows_before, rows_after, rows_removed, reason) of the six tests, from one pass.

    Each row is counted once, at the first test it fails. The steps follow by subtraction.
    """
    tests = range_tests(cfg)
    counted = df.select(first_failed(tests).alias("at")).agg(
        F.count("*").alias("n"),
        *(F.count_if(F.col("at") == i).alias(f"f{i}") for i in range(1, len(tests) + 1)),
    )
    left, steps = F.col("n"), []
    for i, t in enumerate(tests, 1):
        removed = F.col(f"f{i}")
        steps.append(F.struct(
            F.lit(i).alias("step"), F.lit(t.name).alias("name"), left.alias("rows_before"),
            (left - removed).alias("rows_after"), removed.alias("rows_removed"), F.lit(t.reason).alias("reason"),
        ))
        left = left - removed
    return counted.select(F.inline(F.array(*steps)))


def remove_outliers(df: DataFrame, cfg: TripConfig = DEFAULT) -> tuple[DataFrame, dict[str, object]]:
    """:func:`keep_plausible` with its audit; error when a test empties the table."""
    steps = [r.asDict() for r in outlier_funnel(df, cfg).collect()]  # six rows
    return keep_plausible(df, cfg), _outlier_info(steps)


def _outlier_info(steps: list[dict]) -> dict[str, object]:
    steps = sorted(steps, key=lambda s: s["step"])
    for s in steps:
        if s["rows_after"] == 0:
            raise ValueError(f"no rows left after the {s['name']} test: check its bounds")
    before, after = steps[0]["rows_before"], steps[-1]["rows_after"]
    return {"steps": steps, "rows_before": before, "rows_after": after, "rows_removed": before - after}


# --- duplicates ----------------------------------------------------------------------------------

def raw_columns(df: DataFrame, cfg: TripConfig = DEFAULT) -> list[str]:
    return [c for c in df.columns if c in cfg.raw]


def drop_exact_duplicates(df: DataFrame, cfg: TripConfig = DEFAULT) -> DataFrame:
    """One row per combination of raw columns.

    Copies collapse inside each input task before the shuffle, so a trip that fills a third of the
    table sends at most one row per task.
    """
    return df.dropDuplicates(raw_columns(df, cfg))


def duplicate_count(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(n_rows, n_duplicates): rows, and rows beyond the first of each combination.

    Hashes are counted first; only rows that share one are compared by all columns. Where nothing is
    repeated, nothing but hashes is shuffled.
    """
    columns, mark = columns or df.columns, "row_hash"
    while mark in columns:
        mark = f"_{mark}"
    hashed = df.select(*columns, F.xxhash64(*columns).alias(mark))
    counts = hashed.groupBy(mark).agg(F.count("*").alias("n"))
    shared = hashed.join(counts.where("n > 1").select(mark), mark, "left_semi")
    copies = shared.groupBy(*columns).agg(F.count("*").alias("n")).agg(
        F.lit(0).alias("n"), F.sum(F.col("n") - 1).alias("more"))
    return counts.agg(F.sum("n").alias("n"), F.lit(0).alias("more")).union(copies).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("more"), F.lit(0)).alias("n_duplicates"))


def drop_duplicates(df: DataFrame, cfg: TripConfig = DEFAULT) -> tuple[DataFrame, dict[str, object]]:
    """:func:`drop_exact_duplicates` with its audit."""
    columns = raw_columns(df, cfg)
    row = duplicate_count(df, columns).first()
    return drop_exact_duplicates(df, cfg), _duplicate_info(row["n_rows"], row["n_duplicates"], columns)


def _duplicate_info(before: int, removed: int, columns: list[str]) -> dict[str, object]:
    return {"rows_before": before, "rows_after": before - removed,
            "duplicates_removed": removed, "subset_columns": columns}


# --- all stages in two scans ----------------------------------------------------------------------

def audit(df: DataFrame, cfg: TripConfig = DEFAULT) -> dict[str, dict[str, object]]:
    """Counts of the null, month and outlier stages of raw trips, from a single scan.

    Rows are counted per month and per first failed test, so the dominant month need not be known
    beforehand.
    """
    columns = df.columns
    pickup = wall_clock(cfg.pickup)
    # Two projections: an expensive column that is used several times is computed once per row.
    df = df.withColumn(DURATION, minutes_between(pickup, wall_clock(cfg.dropoff)))
    df = df.withColumn(SPEED, miles_per_hour(F.col(cfg.distance), F.col(DURATION)))
    tests = range_tests(cfg)
    # Stage 0: a critical null; 1 to 6: the first failed test; 7: passed.
    stage = F.when(~_complete(df, cfg), 0).otherwise(F.coalesce(first_failed(tests), F.lit(len(tests) + 1)))
    cells = df.groupBy(month_of(pickup).alias("month"), stage.alias("stage")).agg(
        F.count("*").alias("n"), *(F.count(c).alias(f"has_{c}") for c in columns))
    nulls = [f"sum(n - `has_{c}`) as `null_{c}`" for c in columns]
    kept = [f"sum(if(stage > 0, n - `has_{c}`, 0)) as `kept_{c}`" for c in columns]
    # One row; its list has at most 12 x 9999 months x 8 stages and as a rule some ten entries.
    row = cells.agg(*map(F.expr, [
        "coalesce(sum(n), 0) as before", "coalesce(sum(if(stage > 0, n, 0)), 0) as after",
        "collect_list(struct(month, stage, n)) as cells", *nulls, *kept])).first().asDict(recursive=True)
    if not row["after"]:
        raise ValueError("no rows left after removing rows with nulls in critical columns")

    months: dict[object, dict[int, int]] = {}
    for cell in row["cells"]:
        if cell["stage"]:
            months.setdefault(cell["month"], {})[cell["stage"]] = cell["n"]
    target = min(months, key=lambda m: (-sum(months[m].values()), m))
    failed, left = months[target], sum(months[target].values())
    month = _month_info(target, sorted(months), row["after"], left)
    funnel = []
    for i, t in enumerate(tests, 1):
        removed = failed.get(i, 0)
        funnel.append({"step": i, "name": t.name, "rows_before": left, "rows_after": left - removed,
                       "rows_removed": removed, "reason": t.reason})
        left -= removed
    return {
        "missing": _missing_info(columns, row, critical_columns(df, cfg)),
        "month": {**month, "month": target},
        "outliers": _outlier_info(funnel),
    }


def pushable(month, cfg: TripConfig = DEFAULT) -> Column:
    """Tests on stored columns that every cleaned row passes.

    They repeat what the stages test, in the form a parquet scan can use to skip row groups.
    """
    stored = [F.col(c).isNotNull() for c in cfg.critical]
    ranges = [F.col(cfg.fare).between(*cfg.fare_range), F.col(cfg.distance).between(*cfg.distance_range),
              F.col(cfg.total) > 0, in_month(cfg.pickup, month)]
    return reduce(lambda a, b: a & b, stored + ranges)


def clean(df: DataFrame, month, cfg: TripConfig = DEFAULT) -> DataFrame:
    """Raw trips of ``month`` to the cleaned table: narrow stages, then the one shuffle of the dedup."""
    return clean_rows(df.where(in_month(cfg.pickup, month)), cfg)


def clean_rows(df: DataFrame, cfg: TripConfig = DEFAULT, *kept: str) -> DataFrame:
    """Raw trips to cleaned ones, whatever their month; columns ``kept`` must follow from the raw ones.

    Only raw columns are shuffled; the derived ones follow from them and are added afterwards.
    """
    raw = raw_columns(df, cfg)
    complete = drop_incomplete(df, cfg).withColumns({c: wall_clock(c) for c in (cfg.pickup, cfg.dropoff)})
    minutes = minutes_between(F.col(cfg.pickup), F.col(cfg.dropoff))
    # Behind the duration test the speed needs no guard, which would compute the duration once more.
    speed = F.try_divide(F.col(cfg.distance), minutes / 60.0)
    plausible = complete.where(reduce(lambda a, b: a & b, (t.passes for t in range_tests(cfg, minutes, speed))))
    return add_time_features(drop_exact_duplicates(plausible.select(*raw, *kept), cfg), cfg)
