"""Small shared tables from which all profile, statistics and chart tables follow.

A cleaned table of any size is reduced to at most 168 weekday-by-hour cells, one summary row per
group and one correlation per pair of columns. Every result table is then a small step on these.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wheelpace.config import DEFAULT, HOUR, RUSH, SPEED, WEEKDAY, WEEKEND, TripConfig
from wheelpace.functions.features import number
from wheelpace.operators import histogram
from wheelpace.operators.histogram import Histogram, count_values
from wheelpace.operators.summary import summarize, trip_groupings
from wheelpace.session import settle

# The flags follow from weekday and hour, so there are at most 7 x 24 combinations.
CUBE_KEYS = (WEEKDAY, HOUR, WEEKEND, RUSH)


@dataclass
class Facts:
    """The small tables of a cleaned table, each described when it is first asked for.

    Groupings by columns of the cube come from one stored histogram; the summary is computed as soon as it is
    asked for.
    """

    trips: DataFrame
    cfg: TripConfig = DEFAULT
    groupings: dict[str, list[str]] | None = None

    @cached_property
    def cube(self) -> DataFrame:
        """Moments of speed per weekday and hour."""
        return speed_cube(self.trips)

    @cached_property
    def counted(self) -> Histogram:
        """The histogram of all columns that are summarised, by the keys of the groupings."""
        groupings = self._groupings()
        keys = CUBE_KEYS if self.groupings is None else tuple(k for k in groupings if k != "all")
        metrics = dict.fromkeys(m for names in groupings.values() for m in names)
        return count_values(self.trips, metrics, keys)

    @cached_property
    def summary(self) -> DataFrame:
        """Moments and quantiles per group and metric, see ``summarize``."""
        groupings = self._groupings()
        if set(groupings) <= {"all", *CUBE_KEYS}:
            return histogram.summarize(self.counted, self.trips, groupings)
        return summarize(self.trips, groupings)

    @cached_property
    def pairs(self) -> DataFrame:
        """Correlation of every pair of numeric columns."""
        return correlations(self.trips, [c for c in self.cfg.numeric if c in self.trips.columns])

    def settled(self) -> Facts:
        """The same facts, computed once and kept in the shared folder, for several consumers.

        Tables whose size is bounded by their keys are read as one partition, so that the steps on
        them need no shuffle.
        """
        kept = replace(self)
        kept.counted = replace(self.counted, cells=settle(self.counted.cells, "histogram"))
        kept.summary = settle(kept.summary, "summary")
        if set(self._groupings()) <= {"all", *CUBE_KEYS}:
            kept.summary = kept.summary.coalesce(1)
        cube = self.cube
        if self.groupings is None:
            cube = kept.counted.moments(SPEED, *CUBE_KEYS)
            columns = [c for c in self.cfg.numeric if c in self.trips.columns]
            means = {r["metric"]: r["mean"] for r in kept.summary.where("grouping = 'all'").collect()}  # one row a column
            kept.pairs = correlations(self.trips, columns, [means[c] for c in columns])
        kept.cube = settle(cube, "cube").coalesce(1)
        kept.pairs = settle(kept.pairs, "pairs").coalesce(1)
        return kept

    def _groupings(self) -> dict[str, list[str]]:
        return trip_groupings(self.trips, self.cfg) if self.groupings is None else self.groupings


def speed_cube(trips: DataFrame, value: str = SPEED) -> DataFrame:
    """Moments per weekday and hour: at most 168 rows in one partition, so roll-ups need no further shuffle."""
    return trips.select(*CUBE_KEYS, number(value).alias(value)).groupBy(*CUBE_KEYS).agg(*moments(value)).repartition(1)


def moments(value: str) -> list[Column]:
    return [F.count("*").alias("n_rows"), F.count(value).alias("n"), F.sum(value).alias("total"),
            F.var_pop(value).alias("var"), F.min(value).alias("min"), F.max(value).alias("max")]


def roll_up(cube: DataFrame, *keys: str) -> DataFrame:
    """n_rows, n, mean, var and std (of the sample), min and max of coarser groups of the cube."""
    group = Window.partitionBy(*keys)
    mean = F.try_divide(F.sum("total").over(group), F.sum("n").over(group))
    # Spread inside the cells plus the spread of their means around the mean of the group.
    shift = F.coalesce(F.pow(F.try_divide(F.col("total"), F.col("n")) - F.col("mean"), 2), F.lit(0.0))
    spread = F.sum(F.col("n") * (F.col("var") + shift))
    return cube.withColumn("mean", mean).groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.first("mean").alias("mean"),
        F.when(F.sum("n") > 1, spread / (F.sum("n") - 1)).alias("var"),
        F.min("min").alias("min"), F.max("max").alias("max"),
    ).withColumn("std", F.sqrt("var"))


def correlations(trips: DataFrame, columns: list[str], means: list[float | None] | None = None) -> DataFrame:
    """(pair, r): Pearson correlation of every pair of columns, each over the rows where both are present.

    ``pair`` is first * len(columns) + second. Rows are added up per pattern of present columns, so that a
    pair needs one product and no condition of its own; the pairs are formed from these few sums. Values are
    taken relative to the mean of their column, which keeps the digits of large numbers; without ``means`` a scan
    finds it. A column that is constant where the other one is present has no correlation.
    """
    size = len(columns)
    pairs = list(combinations_with_replacement(range(size), 2))
    numbers = trips.select(*(number(c).alias(f"v{i}") for i, c in enumerate(columns)))
    if means is None:
        means = numbers.agg(*(F.avg(v).alias(v) for v in numbers.columns)).first()
    present = [F.col(v).isNotNull().alias(f"has_{v}") for v in numbers.columns]
    moved = [F.coalesce(F.col(v) - F.lit(mean), F.lit(0.0)).alias(v) for v, mean in zip(numbers.columns, means, strict=True)]
    sums = [F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"p{i}_{j}") for i, j in pairs]
    for i in range(size):
        sums += [F.sum(f"v{i}").alias(f"s{i}"), F.min(f"v{i}").alias(f"low{i}"), F.max(f"v{i}").alias(f"high{i}")]
    patterns = numbers.select(*present, *moved).groupBy(*(f"has_{v}" for v in numbers.columns)).agg(
        F.count("*").alias("n"), *sums)

    fields = [x for i, j in pairs for x in (
        F.lit(i * size + j), F.col(f"has_v{i}") & F.col(f"has_v{j}"), F.col(f"p{i}_{j}"),
        *(F.col(f"{name}{k}") for k in (i, j) for name in ("s", "low", "high")), F.col(f"p{i}_{i}"), F.col(f"p{j}_{j}"))]
    names = ("pair", "both", "xy", "x", "x_low", "x_high", "y", "y_low", "y_high", "xx", "yy")
    long = patterns.select("n", F.stack(F.lit(len(pairs)), *fields).alias(*names)).where("both")

    def spread(product: str, a: str, b: str) -> Column:
        return F.sum(product) - F.sum(a) * F.sum(b) / F.sum("n")

    varied = (F.min("x_low") < F.max("x_high")) & (F.min("y_low") < F.max("y_high"))
    scale = F.sqrt(spread("xx", "x", "x")) * F.sqrt(spread("yy", "y", "y"))
    return long.groupBy("pair").agg(F.when(varied, F.try_divide(spread("xy", "x", "y"), scale)).alias("r"))
