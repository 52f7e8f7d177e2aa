"""A stored histogram of a cleaned table: one scan, one row per cell, that rolls up and merges.

A cell is a combination of the key columns, a number column and a bucket of its values; it has counts, the
sum, the spread and the extremes. Moments of every coarser grouping follow from the cells alone, and the
histograms of two tables add up to that of both. Exact quantiles need the values of the few buckets that
hold the wanted ranks: the one thing that is read again, for all groupings at once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wheelpace.functions.buckets import bucket
from wheelpace.functions.features import number
from wheelpace.operators import summary

#: Buckets span a relative width of 2 ** -BITS, so a column falls into some hundred.
BITS = 8
_NULLS = -(2 ** 62)


@dataclass(frozen=True)
class Histogram:
    """(keys..., metric, bucket, n_rows, n, total, spread, low, high); ``metric`` is the place in ``metrics``.

    ``spread`` is the sum of squared distances from the cell's own mean.
    """

    cells: DataFrame
    keys: tuple[str, ...]
    metrics: tuple[str, ...]

    def merged(self, other: Histogram) -> Histogram:
        """The histogram of both tables, for example of two months."""
        if (self.keys, self.metrics) != (other.keys, other.metrics):
            raise ValueError("histograms of different keys or columns cannot be merged")
        return Histogram(_added(self.cells.unionByName(other.cells), [*self.keys, "metric", "bucket"]), self.keys, self.metrics)

    def moments(self, metric: str, *by: str) -> DataFrame:
        """(by..., n_rows, n, total, var, min, max) of a metric; ``var`` is that of the whole group."""
        own = self.cells.where(F.col("metric") == self.metrics.index(metric))
        return _added(own, list(by)).select(
            *by, "n_rows", "n", "total", F.try_divide("spread", "n").alias("var"), F.col("low").alias("min"), F.col("high").alias("max"))

    def save(self, path: str) -> str:
        self.cells.write.mode("overwrite").parquet(f"{path}/cells")
        spark = self.cells.sparkSession
        names = [("key", i, c) for i, c in enumerate(self.keys)] + [("metric", i, c) for i, c in enumerate(self.metrics)]
        spark.createDataFrame(names, "kind string, place int, name string").coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
        return path


def load(spark: SparkSession, path: str) -> Histogram:
    names = spark.read.parquet(f"{path}/columns").orderBy("place").collect()  # one row per column
    keys, metrics = (tuple(r["name"] for r in names if r["kind"] == kind) for kind in ("key", "metric"))
    return Histogram(spark.read.parquet(f"{path}/cells"), keys, metrics)


def _long(trips: DataFrame, metrics: Iterable[str], keys: Iterable[str]) -> DataFrame:
    """(keys..., metric, v, bucket): one row per metric for each row of ``trips``."""
    metrics = list(metrics)
    fields = [x for i, c in enumerate(metrics) for x in (F.lit(i), number(c))]
    rows = trips.select(*keys, F.stack(F.lit(len(metrics)), *fields).alias("metric", "v"))
    return rows.withColumn("bucket", F.coalesce(bucket(F.col("v"), BITS), F.lit(_NULLS)))


def count_values(trips: DataFrame, metrics: Iterable[str], keys: Iterable[str]) -> Histogram:
    """The histogram of the number columns ``metrics``, by all combinations of ``keys``."""
    metrics, keys = tuple(metrics), tuple(keys)
    cells = _long(trips, metrics, keys).groupBy(*keys, "metric", "bucket").agg(
        F.count("*").alias("n_rows"), F.count("v").alias("n"), F.sum("v").alias("total"),
        (F.var_pop("v") * F.count("v")).alias("spread"), F.min("v").alias("low"), F.max("v").alias("high"))
    return Histogram(cells, keys, metrics)


def _added(cells: DataFrame, by: list[str]) -> DataFrame:
    """Cells of the same ``by`` as one: the spreads add up, and so do the squared distances of their means."""
    group = Window.partitionBy(*by)
    mean = F.try_divide(F.sum("total").over(group), F.sum("n").over(group))
    moved = F.coalesce(F.col("n") * F.pow(F.try_divide("total", "n") - F.col("mean"), 2), F.lit(0.0))
    return cells.withColumn("mean", mean).groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.sum(F.coalesce("spread", F.lit(0.0)) + moved).alias("spread"), F.min("low").alias("low"), F.max("high").alias("high"))


def summarize(histogram: Histogram, trips: DataFrame, groupings: dict[str, list[str]],
              probs: tuple[float, ...] = summary.QUARTILES) -> DataFrame:
    """What ``summary.summarize`` gives for these groupings by the histogram's keys, without its first scan.

    ``trips`` are the rows that the histogram counts; only values in buckets that hold a wanted rank are read
    from it, once for all groupings.
    """
    pairs = [(key, metric) for key, metrics in groupings.items() for metric in metrics]
    places = {m: i for i, m in enumerate(histogram.metrics)}

    def under(cells: DataFrame, *carried: str) -> DataFrame:
        """(part, level, ...): each cell once for every grouping of its metric."""
        fields = F.array(*(F.struct(
            F.lit(i).alias("part"), (F.lit("all") if key == "all" else F.col(key).cast("string")).alias("level"),
            F.lit(places[metric]).alias("metric")) for i, (key, metric) in enumerate(pairs)))
        rows = cells.select("*", F.explode(F.filter(fields, lambda x: (x["metric"] == F.col("metric")) & x["level"].isNotNull())).alias("to"))
        return rows.select("to.part", "to.level", *carried)

    cells = under(histogram.cells, F.col("bucket").alias("coarse"), F.col("n_rows").alias("rows"), F.col("n").alias("c"),
                  F.col("total").alias("sum"), F.try_divide("spread", "n").alias("var"), "low", "high")
    wanted, size = summary.wanted_buckets(cells, probs)
    # The metrics and buckets to be read again: as many as groups times ranks.
    part_metric = F.array(*(F.lit(places[m]) for _, m in pairs))
    asked = wanted.select(part_metric[F.col("part")].alias("metric"), F.col("coarse").alias("bucket")).distinct()
    rows = _long(trips, histogram.metrics, histogram.keys)
    values = rows.join(F.broadcast(asked) if size["buckets"] <= summary.BROADCAST_ROWS else asked, ["metric", "bucket"]).groupBy(
        *histogram.keys, "metric", "bucket", "v").agg(F.count("v").alias("c"))
    values = under(values, F.col("bucket").alias("coarse"), "v", "c").groupBy("part", "level", "coarse", "v").agg(
        F.sum("c").alias("c"))
    result = summary.values_at_ranks(values, wanted, size, probs)
    return summary.named(result, pairs, probs)
