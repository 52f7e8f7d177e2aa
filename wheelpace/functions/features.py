"""Trip features as plain column expressions (no UDF, all inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelpace.config import (
    DEFAULT, DURATION, FRIDAY, HOUR, MONDAY, ROUTE, RUSH, SPEED, TIME_GROUP, WEEKDAY, WEEKEND, TripConfig,
)


def wall_clock(col: str) -> Column:
    """Timestamp without a zone, so that hours and durations never shift with the session's time zone."""
    return F.col(col).cast("timestamp_ntz")


def number(col: str) -> Column:
    """A column as double with NaN as null, for statistics that leave out missing values."""
    return F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))


def minutes_between(start: Column, end: Column) -> Column:
    """Fractional minutes from ``start`` to ``end`` on the wall clock; negative when they are swapped."""
    # An interval keeps wall-clock arithmetic; timestampdiff would resolve gaps of the session's time zone.
    seconds = (end - start).cast("interval second").cast("decimal(18,6)").cast("double")
    return seconds / 60.0


def miles_per_hour(miles: Column, minutes: Column) -> Column:
    return F.when(minutes > 0, miles / (minutes / 60.0))


def month_of(ts: Column) -> Column:
    """First day of the month as a date: the year-month key."""
    return F.trunc(ts.cast("date"), "month")


def month_label(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def add_time_features(df: DataFrame, cfg: TripConfig = DEFAULT) -> DataFrame:
    """Add duration, speed, hour, weekday (Monday 0), weekend and rush-hour flags."""
    timed = df.withColumns({cfg.pickup: wall_clock(cfg.pickup), cfg.dropoff: wall_clock(cfg.dropoff)})
    pickup = F.col(cfg.pickup)
    minutes = minutes_between(pickup, F.col(cfg.dropoff))
    return timed.withColumns({
        DURATION: minutes,
        SPEED: miles_per_hour(F.col(cfg.distance), minutes),
        HOUR: F.hour(pickup).cast("short"),
        WEEKDAY: F.weekday(pickup).cast("short"),
        WEEKEND: F.weekday(pickup).isin(*cfg.weekend_days),
        # The rush-hour flag looks at the hour only, so it is also true on weekends.
        RUSH: F.hour(pickup).isin(*cfg.rush_hours),
    })


def time_group(hour: Column, cfg: TripConfig = DEFAULT) -> Column:
    """Name of the part of the day an hour falls in; null outside 0-23."""
    (name, last), *rest = cfg.time_groups
    group = F.when(hour.between(0, last), name)
    for name, last in rest:
        group = group.when(hour.between(0, last), name)
    return group


def route(pickup_zone: Column, dropoff_zone: Column) -> Column:
    """``pickup_dropoff`` zone pair, a missing zone written as -1."""
    return F.concat_ws("_", *(F.coalesce(zone.cast("int"), F.lit(-1)) for zone in (pickup_zone, dropoff_zone)))


def add_model_features(df: DataFrame, cfg: TripConfig = DEFAULT) -> DataFrame:
    """Add the part of the day, the route and the Friday and Monday flags."""
    weekday = F.col(WEEKDAY)
    return df.withColumns({
        TIME_GROUP: time_group(F.col(HOUR), cfg),
        ROUTE: route(F.col(cfg.pickup_zone), F.col(cfg.dropoff_zone)),
        FRIDAY: (weekday == 4).cast("int"),
        MONDAY: (weekday == 0).cast("int"),
    })


def rush_label(flag: Column) -> Column:
    return F.when(flag, "rush").when(~flag, "non_rush")


def rounded(value: Column, digits: int) -> Column:
    """Half-up rounding for result tables.

    The last digits of a sum depend on the order of its parts. Dropping them first makes ties round
    the same way under every partitioning.
    """
    return F.round(F.round(value, digits + 6), digits)


def round_numbers(df: DataFrame, digits: int, *skip: str) -> DataFrame:
    """Round every double column of a result table."""
    doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double" and f.name not in skip]
    return df.withColumns({c: rounded(F.col(c), digits) for c in doubles})
