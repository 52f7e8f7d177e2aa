"""The tables behind the charts and the findings read from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wheelpace.config import HOUR, RUSH, SPEED, WEEKDAY
from wheelpace.functions.features import rounded, rush_label
from wheelpace.operators.facts import Facts, roll_up
from wheelpace.operators.stats import extremes, hourly_by_weekend, hourly_mean, slowest_hour
from wheelpace.operators.summary import levels

HOURS = list(range(24))
WHISKER = 1.5  # fixed value: whiskers end at the last values within this many quartile distances


def heat_cells(facts: Facts, digits: int = 2) -> DataFrame:
    """Mean speed of all 7 x 24 cells in long form; cells without trips are null."""
    spark = facts.cube.sparkSession
    days = spark.range(7).select(F.col("id").cast("short").alias(WEEKDAY))
    grid = days.select(WEEKDAY, F.explode(F.sequence(F.lit(0), F.lit(23))).alias(HOUR)).withColumn(
        HOUR, F.col(HOUR).cast("short"))
    means = roll_up(facts.cube, WEEKDAY, HOUR).select(WEEKDAY, HOUR, "mean")
    # At most 168 rows on either side.
    return grid.join(F.broadcast(means), [WEEKDAY, HOUR], "left").select(
        WEEKDAY, HOUR, rounded(F.col("mean"), digits).alias("mean_speed"))


def heatmap(facts: Facts, digits: int = 2) -> DataFrame:
    """Weekday by hour matrix with the columns h0 to h23."""
    cells = heat_cells(facts, digits)
    wide = cells.groupBy(WEEKDAY).pivot(HOUR, HOURS).agg(F.first("mean_speed"))
    return wide.withColumnsRenamed({str(h): f"h{h}" for h in HOURS}).orderBy(WEEKDAY)


def heat_row_means(facts: Facts, digits: int = 2) -> DataFrame:
    """Mean over weekday rows and over weekend rows of the rounded cells, unweighted, by hour."""
    weekend = F.col(WEEKDAY).isin(*facts.cfg.weekend_days)
    return heat_cells(facts, digits).groupBy(HOUR).agg(
        F.avg(F.when(~weekend, F.col("mean_speed"))).alias("weekday_mean"),
        F.avg(F.when(weekend, F.col("mean_speed"))).alias("weekend_mean")).orderBy(HOUR)


def box_stats(facts: Facts) -> DataFrame:
    """Quartiles and whiskers of speed for rush and other hours; values beyond the whiskers are not shown.

    A whisker ends at the extreme of the cells of the histogram inside the fences. Only the buckets that a fence
    falls into, at most two a group, are read again.
    """
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    fences = levels(facts.summary, RUSH, "boolean", SPEED).select(
        RUSH, F.col("n"), F.col("p25").alias("q1"), F.col("p50").alias("median"), F.col("p75").alias("q3")
    ).withColumns({"low": F.col("q1") - reach, "high": F.col("q3") + reach})
    # A boolean key has two groups, so two rows are broadcast.
    cells = facts.counted.cells.where((F.col("metric") == facts.counted.metrics.index(SPEED)) & (F.col("n") > 0)).groupBy(
        RUSH, "bucket").agg(F.min("low").alias("least"), F.max("high").alias("most"))
    cells = cells.join(F.broadcast(fences), RUSH)
    whole = (F.col("least") >= F.col("low")) & (F.col("most") <= F.col("high"))
    beyond = (F.col("most") < F.col("low")) | (F.col("least") > F.col("high"))
    at_fence = cells.where(~whole & ~beyond).select(RUSH, F.greatest("least", "low").alias("a"), F.least("most", "high").alias("b")).collect()
    ends = cells.where(whole).select(RUSH, "least", "most")
    for r in at_fence:
        near = facts.trips.where((F.col(RUSH) == r[RUSH]) & F.col(SPEED).between(r["a"], r["b"]))
        ends = ends.unionByName(near.groupBy(RUSH).agg(F.min(SPEED).alias("least"), F.max(SPEED).alias("most")))
    boxes = ends.groupBy(RUSH).agg(F.min("least").alias("least"), F.max("most").alias("most")).join(F.broadcast(fences), RUSH)
    return boxes.select(
        rush_label(F.col(RUSH)).alias("label"), "n", F.least("least", "q1").alias("whisker_low"),
        "q1", "median", "q3", F.greatest("most", "q3").alias("whisker_high"))


# --- findings: one row each ------------------------------------------------------------------------

def hourly_finding(facts: Facts) -> DataFrame:
    """Slowest and fastest hour overall, slowest hour on weekdays and on weekends."""
    hours = hourly_mean(facts).join(F.broadcast(hourly_by_weekend(facts, digits=None)), HOUR)  # 24 rows each
    row = hours.agg(
        *extremes("mean"), slowest_hour("weekday_mean_speed").alias("weekday_slowest"),
        slowest_hour("weekend_mean_speed").alias("weekend_slowest"))
    return row.withColumn("finding", F.format_string(
        "The mean speed is lowest at %d:00 (%.2f mph) and highest at %d:00 (%.2f mph). "
        "On weekdays it is lowest at %d:00, on weekends at %d:00.",
        *(F.col(c) for c in ("slowest_hour", "slowest_speed", "fastest_hour", "fastest_speed",
                             "weekday_slowest", "weekend_slowest"))))


def rush_finding(facts: Facts) -> DataFrame:
    """Median speed in rush and other hours, and whether rush hours are slower."""
    medians = levels(facts.summary, RUSH, "boolean", SPEED)
    row = medians.agg(F.max(F.when(F.col(RUSH), F.col("p50"))).alias("rush_median"),
                      F.max(F.when(~F.col(RUSH), F.col("p50"))).alias("other_median"))
    slower = F.coalesce(F.col("rush_median") < F.col("other_median"), F.lit(False))
    return row.withColumn("rush_is_slower", slower).withColumn("finding", F.format_string(
        "Rush hours are %s: their median is %.2f mph against %.2f mph.",
        F.when(slower, "slower").otherwise("not slower"), "rush_median", "other_median"))


def heat_finding(facts: Facts) -> DataFrame:
    """Slowest hour of the weekday rows and of the weekend rows of the heat map."""
    means = heat_row_means(facts)
    row = means.agg(slowest_hour("weekday_mean").alias("weekday_slow_hour"),
                    slowest_hour("weekend_mean").alias("weekend_slow_hour"))
    return row.withColumn("finding", F.format_string(
        "Traffic is slowest around %d:00 on weekdays and around %d:00 on weekends.",
        "weekday_slow_hour", "weekend_slow_hour"))
