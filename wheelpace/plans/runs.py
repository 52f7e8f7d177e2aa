"""Preparation, profile, statistics, chart tables and the whole run."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wheelpace.config import DEFAULT, DERIVED, RUSH, SPEED, WEEKEND, TripConfig
from wheelpace.functions.features import month_of, rounded, wall_clock
from wheelpace.operators import charts, model, quality, stats
from wheelpace.operators.facts import Facts
from wheelpace.session import fresh_path, settle
from wheelpace.sources.sinks import place, save_counted, save_csv, save_json
from wheelpace.sources.trips import nan_to_null, read_cleaned, scan_trips
from wheelpace.sources.versions import current, entries, publish, verify, write_entry


#: Rows of monthly files that one task collapses, and the most tasks a scan is dealt to: up to so many Spark's shuffle
#: writes rows as they come and holds none.
DEALT_ROWS, DEALT_MOST = 250_000, 200
#: Names in the error about bad files.
BAD_FILES_SHOWN = 20


@dataclass(frozen=True)
class Prepared:
    """The cleaned table as written, its row count and the audit of every stage."""

    trips: DataFrame
    rows: int
    info: dict[str, object]
    cfg: TripConfig = DEFAULT

    @cached_property
    def facts(self) -> Facts:
        return Facts(self.trips, self.cfg).settled()

    @cached_property
    def profile(self) -> dict[str, object]:
        """The checked profile of the cleaned table, see :func:`profile`; computed when it is first asked for."""
        found = profile(self.facts)
        check_profile(found)
        return found


def cleaned_plan(raw: DataFrame, cfg: TripConfig = DEFAULT) -> tuple[DataFrame, dict[str, dict[str, object]]]:
    """Audit raw trips in one scan, then describe the cleaned table without running it."""
    audit = quality.audit(nan_to_null(raw), cfg)
    month = audit["month"]["month"]
    return quality.clean(nan_to_null(raw.where(quality.pushable(month, cfg))), month, cfg), audit


def prepare(raw: DataFrame, cfg: TripConfig = DEFAULT, path: str | None = None) -> Prepared:
    """Nulls, features, month, outliers, duplicates; written once, verified and read back.

    Two scans of the raw table and one shuffle. Without ``path`` the table goes to the shared folder
    of the session, so consumers never repeat the cleaning. A table that fails its checks is deleted
    and raises an error; what was at ``path`` before stays the current version until they passed.
    """
    started = time.perf_counter()
    plan, audit = cleaned_plan(raw, cfg)
    spark = raw.sparkSession
    saved = publish(plan, path or fresh_path(spark, "cleaned"), lambda written: check_cleaned(written, cfg))
    trips = spark.read.schema(plan.schema).parquet(f"{saved['path'].rstrip('/')}/{saved['folder']}")

    before, rows, original = audit["outliers"]["rows_after"], saved["rows"], audit["missing"]["rows_before"]
    duplicates = {"rows_before": before, "rows_after": rows, "duplicates_removed": before - rows,
                  "subset_columns": quality.raw_columns(raw, cfg)}
    return Prepared(trips, rows, {
        "original_rows": original, "final_rows": rows, "removed_total": original - rows,
        "removed_ratio": round((original - rows) / original, 5),
        "elapsed_seconds": round(time.perf_counter() - started, 2),
        **audit, "duplicates": duplicates, "save": saved, "derived_columns": list(DERIVED),
        "load": check_load(raw, original),
    }, cfg)


def prepare_months(spark: SparkSession, source: str, path: str, cfg: TripConfig = DEFAULT) -> DataFrame:
    """Clean a folder of monthly files into ``path``, one partition ``period`` per month; the files with their counts.

    Every file has a month of its own, the one most of its complete rows fall into; its other rows are strays.
    Months that the files do not cover stay as they are at ``path``, those they cover are replaced. A file
    without a month or without a plausible row is an error that names it, before anything is written.
    """
    raw = nan_to_null(scan_trips(spark, source, cfg, file="source_file"))
    files = settle(quality.months_by_file(raw, "source_file", cfg), "file-months")
    bad = files.where("month is null or n_plausible = 0")
    names = [r["source_file"] for r in bad.orderBy("source_file").limit(BAD_FILES_SHOWN).collect()]
    if names:
        raise ValueError(f"{bad.count()} files hold no plausible month: {names}")
    months = files.select("source_file", "month")
    rows = raw.join(months, "source_file").where(month_of(wall_clock(cfg.pickup)) == F.col("month"))
    rows = dealt(rows, files.agg(F.coalesce(F.sum("n_month"), F.lit(0))).first()[0])
    cleaned = quality.clean_rows(rows.withColumn("period", F.col("month")), cfg, "period")
    cleaned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)
    covered = months.select(F.col("month").alias("period")).distinct()
    written = spark.read.parquet(path).withColumn("period", F.col("period").cast("date")).join(F.broadcast(covered), "period", "left_semi")
    check_cleaned(written, cfg)
    return files


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """``rows``, about ``n``, dealt evenly to tasks. A file of a month can be one part of a scan however many rows it holds, and the
    task that reads it would keep all that differ to collapse copies; copies are dealt to many tasks as well."""
    parts = min(DEALT_MOST, max(1, -(-n // DEALT_ROWS)))
    return rows.withColumn("dealt", F.monotonically_increasing_id()).repartition(parts, "dealt").drop("dealt")


def check_load(raw: DataFrame, rows: int) -> dict[str, object]:
    """Error when the audit has seen other rows than the footers of the files count."""
    counted = raw.count()  # reads no column
    if counted != rows:
        raise ValueError(f"{rows} rows were audited, the table holds {counted}")
    return {"rows": counted, "columns": len(raw.columns), "shape_match": True}


def prepare_file(spark: SparkSession, source: str, cfg: TripConfig = DEFAULT, path: str | None = None) -> Prepared:
    return prepare(scan_trips(spark, source, cfg), cfg, path)


def check_contract(trips: DataFrame) -> None:
    absent = [c for c in DERIVED if c not in trips.columns]
    if absent:
        raise ValueError(f"derived columns are missing: {absent}")


def check_cleaned(trips: DataFrame, cfg: TripConfig = DEFAULT) -> None:
    """Errors of a cleaned table: missing derived columns, nulls that the policy does not expect, duplicates."""
    check_contract(trips)
    strict = [c for c in dict.fromkeys((*cfg.numeric, SPEED)) if c in trips.columns and c not in cfg.nullable]
    nulls = trips.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in strict)).first().asDict()
    if odd := {c: n for c, n in nulls.items() if n}:
        raise ValueError(f"nulls that the policy does not expect: {odd}")
    left = quality.duplicate_count(trips, quality.raw_columns(trips, cfg)).first()["n_duplicates"]
    if left:
        raise ValueError(f"{left} duplicates are left in the cleaned table")


def facts_from(spark: SparkSession, path: str, cfg: TripConfig = DEFAULT) -> Facts:
    """The facts of a stored cleaned table, for stages that start from it."""
    trips = read_cleaned(spark, path)
    check_contract(trips)
    return Facts(trips, cfg)


def funnel_table(spark: SparkSession, info: dict[str, object]) -> DataFrame:
    """(position, stage, rows_before, rows_after, rows_removed, removed_ratio) of a preparation."""
    stages = [("missing", info["missing"]), ("month", info["month"]),
              *((s["name"], s) for s in info["outliers"]["steps"]), ("duplicates", info["duplicates"]),
              ("all", {"rows_before": info["original_rows"], "rows_after": info["final_rows"]})]
    rows = [(i, name, s["rows_before"], s["rows_after"], s["rows_before"] - s["rows_after"],
             round((s["rows_before"] - s["rows_after"]) / s["rows_before"], 5) if s["rows_before"] else 0.0)
            for i, (name, s) in enumerate(stages, 1)]
    return spark.createDataFrame(rows, "position int, stage string, rows_before long, rows_after long, "
                                       "rows_removed long, removed_ratio double")


# --- consumers ------------------------------------------------------------------------------------

def profile(facts: Facts) -> dict[str, object]:
    """Profile of the cleaned table: the audit checks plus hourly, weekend and rush tables."""
    hourly = stats.hourly_profile(facts)
    return {
        "dtypes": dict(facts.trips.dtypes),
        "describe": stats.describe(facts),
        "null_split": stats.null_split(facts),
        "remaining_duplicates": quality.duplicate_count(facts.trips),
        "hourly_speed": hourly,
        "speed_by_weekend": stats.speed_by(facts, WEEKEND),
        "speed_by_rush": stats.speed_by(facts, RUSH),
        # The profile takes the extremes of the rounded means.
        "extreme_hours": stats.extreme_hours(hourly, "mean_speed"),
        "speed_median": facts.summary.where((F.col("grouping") == "all") & (F.col("metric") == SPEED)).select(
            rounded(F.col("p50"), 3).alias("speed_median")),
        "shares": stats.flag_shares(facts),
        "shape": facts.cube.agg(F.sum("n_rows").alias("n_rows"), F.lit(len(facts.trips.columns)).alias("n_cols")),
    }


def check_profile(tables: dict[str, object]) -> None:
    """Errors of the preparation's own checks: leftover duplicates, nulls that the policy does not expect."""
    left = tables["remaining_duplicates"].first()["n_duplicates"]
    if left:
        raise ValueError(f"{left} duplicates are left in the cleaned table")
    odd = {r["column"]: r["n_null"] for r in tables["null_split"].where("status = 'unexpected'").collect()}
    if odd:
        raise ValueError(f"nulls that the policy does not expect: {odd}")


def analyze(facts: Facts) -> dict[str, object]:
    """Statistics: description, correlations, group comparisons and the rush-hour test."""
    columns = [c for c in facts.cfg.numeric if c in facts.trips.columns]
    return {
        "descriptive_stats": stats.describe(facts),
        "correlation_matrix": stats.correlation_matrix(facts.pairs, columns),
        "rush_compare": stats.group_speed(facts.summary, RUSH, "boolean"),
        "weekend_compare": stats.group_speed(facts.summary, WEEKEND, "boolean"),
        "hourly_by_weekend": stats.hourly_by_weekend(facts),
        "ttest": stats.ttest_result(facts.cube, facts.cfg),
    }


def chart_tables(facts: Facts) -> dict[str, DataFrame]:
    """The tables behind the charts and the three findings."""
    return {
        "hourly_speed": stats.hourly_mean(facts),
        "hourly_by_weekend": stats.hourly_by_weekend(facts, digits=None),
        "rush_boxplot": charts.box_stats(facts),
        "day_hour_heatmap": charts.heatmap(facts),
        "hourly_finding": charts.hourly_finding(facts),
        "rush_finding": charts.rush_finding(facts),
        "heat_finding": charts.heat_finding(facts),
    }


def run_all(raw: DataFrame, cfg: TripConfig = DEFAULT, folder: str | None = None) -> dict[str, object]:
    """Preparation, profile, charts, statistics and model over one cleaned table, results under ``folder``."""
    spark = raw.sparkSession
    folder = (folder or fresh_path(spark, "run")).rstrip("/")
    prepared = prepare(raw, cfg, f"{folder}/cleaned")
    facts, profiled = prepared.facts, prepared.profile
    figures, statistics = chart_tables(facts), analyze(facts)
    tables = {f"chart_{n}": t for n, t in figures.items()}
    tables |= {f"stat_{n}": t for n, t in statistics.items() if n != "ttest"}
    paths = save_csv(tables, f"{folder}/tables")
    paths["ttest"] = save_json(spark.createDataFrame([statistics["ttest"]]), f"{folder}/ttest")
    fitted, measured, listed = model.train_and_evaluate(prepared.trips, cfg, folder)
    paths["metrics"] = save_json(measured, f"{folder}/metrics")
    return {"info": prepared.info, "profile": profiled, "charts": figures, "statistics": statistics,
            "metrics": measured, "report": listed, "model": fitted, "paths": paths}


# --- a run that can be taken up again --------------------------------------------------------------

def train_from(spark: SparkSession, path: str, cfg: TripConfig = DEFAULT, folder: str | None = None):
    """Model, metrics and report from a stored cleaned table, see :func:`model.train_and_evaluate`."""
    trips = read_cleaned(spark, path)
    check_contract(trips)
    return model.train_and_evaluate(trips, cfg, folder)


def source_state(spark: SparkSession, source: str) -> str:
    """A digest of the names, sizes and times of the files of a table; any rewritten file changes it."""
    digest = hashlib.sha256()
    for name in sorted(unquote(f) for f in spark.read.parquet(source).inputFiles()):
        target, files = place(spark, name)
        status = files.getFileStatus(target)
        digest.update(f"{name} {status.getLen()} {status.getModificationTime()}\n".encode())
    return digest.hexdigest()


@dataclass
class _Manifest:
    """What the stages of a run have stored: one entry per finished stage, valid for one input and one configuration."""

    spark: SparkSession
    folder: str
    settings: str
    computed: list[str] = field(default_factory=list)

    def stage(self, name: str, input_state: str, build: Callable[[], dict]) -> dict:
        """The result of a stage, from its entry if that is of this input and these settings, else from ``build``."""
        entry = self._entry(name, input_state)
        for found in entries(self.spark, f"{self.folder}/manifest"):
            if found["name"] == entry:
                return found["result"]
        self.computed.append(name)
        result = build()
        self.forget(name, input_state)  # one that a dying run left half written is in the way
        write_entry(self.spark, f"{self.folder}/manifest/{entry}", {
            "stage": name, "input": input_state, "settings": self.settings, "result": result})
        return result

    def forget(self, name: str, input_state: str) -> None:
        target, files = place(self.spark, f"{self.folder}/manifest/{self._entry(name, input_state)}")
        files.delete(target, False)

    def _entry(self, name: str, input_state: str) -> str:
        return f"{name}-{hashlib.sha256(f'{name} {input_state} {self.settings}'.encode()).hexdigest()[:16]}.json"


def run_file(spark: SparkSession, source: str, folder: str, cfg: TripConfig = DEFAULT) -> dict[str, object]:
    """The whole run over a stored table, stage by stage; a rerun starts after the last stage that is still valid.

    A stage is valid for the files it was computed from, by name, size and time, or for the rows of the cleaned
    table, by their checksum, and for the same configuration. Returns the result of every stage (paths and
    rows of its tables), the names of those that were computed this time, and the model if it was fitted this time.
    """
    folder = folder.rstrip("/")
    path = f"{folder}/cleaned"
    manifest = _Manifest(spark, folder, hashlib.sha256(repr(cfg).encode()).hexdigest())

    def clean() -> dict:
        done = prepare_file(spark, source, cfg, path)
        funnel = save_counted({"funnel": funnel_table(spark, done.info)}, f"{folder}/tables")
        return {"tables": {"cleaned": {"path": path, "rows": done.rows}, **funnel}, "checksum": done.info["save"]["checksum"]}

    files = source_state(spark, source)
    cleaned, entry = manifest.stage("cleaned", files, clean), current(spark, path)
    if entry is None or entry["checksum"] != cleaned["checksum"]:  # replaced or lost since: clean again
        manifest.forget("cleaned", files)
        cleaned = manifest.stage("cleaned", files, clean)
    state, kept, made = cleaned["checksum"], [], {}

    def facts() -> Facts:
        """The facts for all stages that are computed; the rows they start from are proved to be those stored."""
        if not kept:
            trips = read_cleaned(spark, path)
            verify(trips, current(spark, path))
            kept.append(Facts(trips, cfg).settled())
        return kept[0]

    def profiled() -> dict:
        found = profile(facts())
        check_profile(found)
        return {"tables": save_counted({k: v for k, v in found.items() if isinstance(v, DataFrame)}, f"{folder}/tables/profile")}

    def statistics() -> dict:
        found = analyze(facts())
        ttest = found.pop("ttest")
        save_json(spark.createDataFrame([ttest]), f"{folder}/ttest")
        return {"tables": save_counted(found, f"{folder}/tables/statistics"), "ttest": ttest}

    def trained() -> dict:
        made["model"], measured, listed = train_from(spark, path, cfg, folder)
        save_json(measured, f"{folder}/metrics")
        save_json(listed, f"{folder}/report")
        return {"tables": {"metrics": {"path": f"{folder}/metrics", "rows": 1}, "report": {"path": f"{folder}/report", "rows": 5}},
                "model": f"{folder}/model"}

    stages = {"cleaned": cleaned}
    for name, build in (("profile", profiled), ("charts", lambda: {"tables": save_counted(chart_tables(facts()), f"{folder}/tables/charts")}),
                        ("statistics", statistics), ("model", trained)):
        stages[name] = manifest.stage(name, state, build)
    return {"stages": stages, "computed": manifest.computed, "folder": folder, "fitted": made.get("model")}


def stored_tables(spark: SparkSession, done: dict[str, object]) -> DataFrame:
    """(stage, name, n_rows) of all tables that a run has stored."""
    rows = [(stage, name, table["rows"]) for stage, result in done["stages"].items() for name, table in result["tables"].items()]
    return spark.createDataFrame(rows, "stage string, name string, n_rows long")
