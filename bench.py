"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm the JVM up and is timed the second time. The trips and the cleaned table
are written before, except in ``prepare``, which times that work.
"""

from __future__ import annotations

import json
import os
import time
from dataclasses import replace

from wheelpace.checks.queries import queries
from wheelpace.checks.standin import cleaned, trips_path
from wheelpace.config import DEFAULT
from wheelpace.operators import model
from wheelpace.operators.facts import Facts
from wheelpace.plans import runs
from wheelpace.session import local_session

HEADLINE = [
    "trip_scan", "time_features", "missing_audit", "dominant_month_rows", "outlier_funnel", "distinct_trips",
    "cleaned_trips", "describe_trips", "describe_trips_large", "hourly_profile", "group_speed_rush",
    "group_speed_zone", "hourly_by_weekend", "day_hour_heatmap", "correlation_matrix", "welch_test",
    "rush_box_plot", "slow_trip_target", "category_codes", "rule_report", "describe_lineitem", "price_by_flag",
    "correlate_lineitem", "tied_quantiles", "lineitem_duplicates",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    source = trips_path(spark, sf_dir)
    done = cleaned(spark, sf_dir)

    def reports() -> None:
        """All profile, statistics and chart tables of the cleaned table, from one set of facts."""
        facts = Facts(done.trips, DEFAULT).settled()
        for tables in (runs.profile(facts), runs.analyze(facts), runs.chart_tables(facts)):
            for table in tables.values():
                if hasattr(table, "collect"):
                    table.collect()

    jobs = {"prepare": lambda: runs.prepare_file(spark, source), "all_reports": reports,
            "train_10_rounds": lambda: model.train_and_evaluate(done.trips, replace(DEFAULT, max_rounds=10))}
    jobs |= {name: lambda q=queries()[name]: drain(q(spark, sf_dir)) for name in HEADLINE}

    seconds = {}
    for name, job in jobs.items():
        job()
        started = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
