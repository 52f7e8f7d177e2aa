"""Descriptive statistics, group comparisons, correlations and the rush-hour test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelpace.config import DEFAULT, HOUR, RUSH, SPEED, WEEKEND, TripConfig
from wheelpace.functions.features import number, round_numbers, rounded
from wheelpace.functions.student_t import two_sided_p, with_two_sided_p
from wheelpace.operators.facts import Facts, correlations, roll_up, speed_cube
from wheelpace.operators.summary import levels, summarize

DIGITS = 3


# --- tables that follow from the facts ------------------------------------------------------------

def describe(facts: Facts, digits: int = DIGITS) -> DataFrame:
    """count, mean, std, min, quartiles and max of every numeric column."""
    rows = facts.summary.where(F.col("grouping") == "all")
    return round_numbers(rows.select(
        "metric", F.col("n").alias("count"), "mean", "std", "min", "p25", "p50", "p75", "max"), digits)


def hourly_profile(facts: Facts, digits: int = DIGITS) -> DataFrame:
    """Trips (nulls counted), mean and median speed by hour, in hour order."""
    rows = levels(facts.summary, HOUR, "short", SPEED)
    return round_numbers(rows.select(
        HOUR, F.col("n_rows").alias("n"), F.col("mean").alias("mean_speed"), F.col("p50").alias("median_speed"),
    ), digits).orderBy(HOUR)


def speed_by(facts: Facts, key: str, digits: int = DIGITS) -> DataFrame:
    """Trips and mean speed by a column of the cube, in key order."""
    rows = roll_up(facts.cube, key).select(key, F.col("n_rows").alias("n"), F.col("mean").alias("mean_speed"))
    return round_numbers(rows, digits).orderBy(key)


def group_speed(summary: DataFrame, key: str, key_type, value: str = SPEED, digits: int = DIGITS) -> DataFrame:
    """n (nulls skipped), mean, std, median, min and max by key."""
    rows = levels(summary, key, key_type, value)
    return round_numbers(
        rows.select(key, "n", "mean", "std", F.col("p50").alias("median"), "min", "max"), digits, key).orderBy(key)


def hourly_by_weekend(facts: Facts, digits: int | None = DIGITS) -> DataFrame:
    """Mean speed by hour, weekdays and weekends side by side."""
    means = roll_up(facts.cube, HOUR, WEEKEND)
    wide = means.groupBy(HOUR).agg(
        F.max(F.when(~F.col(WEEKEND), F.col("mean"))).alias("weekday_mean_speed"),
        F.max(F.when(F.col(WEEKEND), F.col("mean"))).alias("weekend_mean_speed"))
    return (wide if digits is None else round_numbers(wide, digits)).orderBy(HOUR)


def hourly_mean(facts: Facts) -> DataFrame:
    return roll_up(facts.cube, HOUR).select(HOUR, "mean").orderBy(HOUR)


def slowest_hour(mean: str, sign: int = 1) -> Column:
    """Aggregate: the hour of the lowest mean, the lowest hour on a tie, hours without a mean left out."""
    return F.min_by(HOUR, F.when(F.col(mean).isNotNull(), F.struct(F.col(mean) * sign, F.col(HOUR))))


def extremes(mean: str) -> list[Column]:
    """Aggregates: slowest and fastest hour with their means."""
    return [slowest_hour(mean).alias("slowest_hour"), F.min(mean).alias("slowest_speed"),
            slowest_hour(mean, -1).alias("fastest_hour"), F.max(mean).alias("fastest_speed")]


def extreme_hours(hourly: DataFrame, mean: str) -> DataFrame:
    return hourly.agg(*extremes(mean))


def flag_shares(facts: Facts, digits: int = 4) -> DataFrame:
    """Share of rush-hour and weekend trips."""
    return facts.cube.agg(*(
        rounded(F.sum(F.when(F.col(c), F.col("n_rows")).otherwise(0)) / F.sum("n_rows"), digits).alias(name)
        for c, name in ((RUSH, "rush_share"), (WEEKEND, "weekend_share"))))


def correlation_matrix(pairs: DataFrame, columns: list[str], digits: int = DIGITS) -> DataFrame:
    """(variable, with_variable, r) for all pairs in both orders, from one correlation per pair."""
    found = pairs.agg(F.map_from_entries(F.collect_list(F.struct("pair", "r"))).alias("found"))
    size = len(columns)
    names = F.array(*map(F.lit, columns))
    cell = found.select("found", F.explode(F.sequence(F.lit(0), F.lit(size * size - 1))).alias("cell")).select(
        "found", F.expr(f"int(cell div {size})").alias("i"), (F.col("cell") % size).alias("j"))
    key = F.least("i", "j") * size + F.greatest("i", "j")
    return cell.select(names[F.col("i")].alias("variable"), names[F.col("j")].alias("with_variable"),
                       rounded(F.col("found")[key], digits).alias("r"))


def null_split(facts: Facts) -> DataFrame:
    """(column, n_null, status): nulls the policy keeps, and nulls it does not expect."""
    rows = facts.summary.where((F.col("grouping") == "all") & (F.col("n_rows") > F.col("n")))
    kept = F.col("metric").isin(*facts.cfg.nullable)
    return rows.select(F.col("metric").alias("column"), (F.col("n_rows") - F.col("n")).alias("n_null"),
                       F.when(kept, "retained").otherwise("unexpected").alias("status"))


def welch(cube: DataFrame, flag: str = RUSH) -> DataFrame:
    """One row: size, mean and variance of both groups, Welch's t and its degrees of freedom."""
    groups = roll_up(cube, flag)

    def of(side, column: str):
        return F.max(F.when(side, F.col(column)))

    on, off = F.col(flag), ~F.col(flag)
    row = groups.agg(*(of(side, c).alias(f"{c}_{name}")
                       for side, name in ((on, "rush"), (off, "other")) for c in ("n", "mean", "var")))
    a, b = F.col("var_rush") / F.col("n_rush"), F.col("var_other") / F.col("n_other")
    freedom = F.try_divide(
        F.pow(a + b, 2), F.pow(a, 2) / (F.col("n_rush") - 1) + F.pow(b, 2) / (F.col("n_other") - 1))
    return row.select(
        "*", F.try_divide(F.col("mean_rush") - F.col("mean_other"), F.sqrt(a + b)).alias("t"), freedom.alias("dof"))


def welch_by(trips: DataFrame, key: str, flag: str = RUSH, value: str = SPEED) -> DataFrame:
    """Welch's test within every group of ``key``: sizes, means, t, degrees of freedom and two-sided p, in one aggregation.

    Groups with fewer than two values on a side have no test (null); rows without key belong to no group.
    """
    rows = trips.where(F.col(key).isNotNull()).select(key, flag, number(value).alias("v"))

    def side(of: Column, name: str) -> list[Column]:
        own = F.when(of, F.col("v"))
        return [F.count(own).alias(f"n_{name}"), F.avg(own).alias(f"mean_{name}"), F.var_samp(own).alias(f"var_{name}")]

    found = rows.groupBy(key).agg(*side(F.col(flag), "rush"), *side(~F.col(flag), "other"))
    a, b = F.try_divide("var_rush", "n_rush"), F.try_divide("var_other", "n_other")
    spread = F.try_divide(F.pow(a, 2), F.col("n_rush") - 1) + F.try_divide(F.pow(b, 2), F.col("n_other") - 1)
    found = found.withColumns({"t": F.try_divide(F.col("mean_rush") - F.col("mean_other"), F.sqrt(a + b)),
                               "dof": F.try_divide(F.pow(a + b, 2), spread)})
    return with_two_sided_p(found, "t", "dof", "p").select(
        key, "n_rush", "n_other", "mean_rush", "mean_other", "t", "dof", "p")


# --- the same tables straight from a cleaned table -------------------------------------------------

def compute_descriptive_stats(trips: DataFrame, cfg: TripConfig = DEFAULT,
                              columns: list[str] | None = None, digits: int = DIGITS) -> DataFrame:
    columns = columns or [c for c in cfg.numeric if c in trips.columns]
    return describe(Facts(trips, cfg, {"all": columns}), digits)


def compute_correlation_matrix(trips: DataFrame, cfg: TripConfig = DEFAULT,
                               columns: list[str] | None = None, digits: int = DIGITS) -> DataFrame:
    columns = columns or [c for c in cfg.numeric if c in trips.columns]
    return correlation_matrix(correlations(trips, columns), columns, digits)


def compare_group_speed(trips: DataFrame, group_col: str, value: str = SPEED,
                        digits: int = DIGITS) -> DataFrame:
    """n, mean, std, median, min and max of ``value`` by any column."""
    summary = summarize(trips, {group_col: [value]})
    return group_speed(summary, group_col, trips.schema[group_col].dataType, value, digits)


def compare_hourly_speed_by_weekend(trips: DataFrame, digits: int = DIGITS) -> DataFrame:
    return hourly_by_weekend(Facts(trips), digits)


def run_rush_hour_ttest(trips: DataFrame, cfg: TripConfig = DEFAULT) -> dict[str, object]:
    """Welch's two-sided test of rush-hour speed against the rest."""
    return ttest_result(speed_cube(trips), cfg)


def ttest_result(cube: DataFrame, cfg: TripConfig = DEFAULT) -> dict[str, object]:
    row = welch(cube).first()
    p = two_sided_p(row["t"], row["dof"])
    significant = p is not None and p < cfg.alpha

    def short(x, digits: int):
        return None if x is None else round(x, digits)

    return {
        "hypothesis": "rush hours are slower than other hours",
        "n_rush_hour": row["n_rush"], "n_non_rush_hour": row["n_other"],
        "mean_rush_hour": short(row["mean_rush"], 3), "mean_non_rush_hour": short(row["mean_other"], 3),
        "t_statistic": short(row["t"], 4), "p_value": p, "alpha": cfg.alpha, "is_significant": significant,
        "interpretation": f"p = {p}: the mean speeds {'differ' if significant else 'do not differ'} "
                          f"at the {cfg.alpha} level",
    }
