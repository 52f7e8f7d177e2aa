"""Exact group summaries with quantiles, without gathering a large group in one task.

Spark's ``percentile`` keeps every distinct value of a group in the memory of one task, so it is not
used, whatever the number of rows. The first scan counts values per coarse bucket, together with the moments; from that small histogram the buckets that hold the wanted
ranks are known. The second scan only looks at the values in them; a bucket with many rows is split
once more. Whatever the data, one task sorts at most the buckets of a group or the values of one
bucket, both bounded by the number format (see ``functions.buckets``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from wheelpace.config import DEFAULT, HOUR, RUSH, SPEED, WEEKEND, TripConfig
from wheelpace.functions.buckets import bucket
from wheelpace.functions.features import number
from wheelpace.session import settle

QUARTILES = (0.25, 0.5, 0.75)
COARSE_BITS, FINE_BITS = 12, 32
# Rows of the table of wanted buckets that may be broadcast; each takes about 100 bytes.
BROADCAST_ROWS = 200_000
# Up to this many wanted buckets become a list in the plan that sorts most rows out before the join.
LISTED_BUCKETS = 1_000
# Rows of a wanted bucket up to which one task sorts its distinct values.
SORT_ROWS = 1_000_000
# Bucket of nulls, below all others.
_NULLS = -(2 ** 62)

_KEYS = ["part", "level"]
_STATS = ["n_rows", "n", "mean", "std", "min", "max"]


def quantile_name(p: float) -> str:
    return f"p{p * 100:g}".replace(".", "_")


def melt(df: DataFrame, groupings: dict[str, list[str]]) -> DataFrame:
    """(part, level, v): one row per grouping and metric for each row of ``df``.

    ``groupings`` maps a key column, or ``all``, to the number columns to summarise under it; ``part``
    numbers these pairs. Rows without a key value belong to no group.
    """
    fields = []
    for i, (key, metric) in enumerate(_parts(groupings)):
        level = F.lit("all") if key == "all" else F.col(key).cast("string")
        fields += [F.lit(i), level, number(metric)]
    return df.select(F.stack(F.lit(len(fields) // 3), *fields).alias(*_KEYS, "v")).where(F.col("level").isNotNull())


def _parts(groupings: dict[str, list[str]]) -> list[tuple[str, str]]:
    return [(key, metric) for key, metrics in groupings.items() for metric in metrics]


def _holds_rank(probs: tuple[float, ...]) -> Column:
    """Whether the rows numbered ``first`` to ``first + c - 1`` hold the neighbours of some quantile."""
    return reduce(lambda a, b: a | b, (
        (rank >= F.col("first")) & (rank < F.col("first") + F.col("c"))
        for p in probs for rank in _ranks(p)
    ))


def _ranks(p: float) -> tuple[Column, Column]:
    """Ranks, from 0, of the values below and above the position of quantile ``p`` of ``n`` values."""
    position = (F.col("n") - 1) * F.lit(p)
    return F.floor(position), F.ceil(position)


def _number_rows(counts: DataFrame, keys: list[str], order: str, offset: Column) -> DataFrame:
    """Add ``first``, the rank of the first row of each entry of a histogram ``(keys, order, c)``."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first", offset + F.coalesce(F.sum("c").over(before), F.lit(0)))


def summarize(
    df: DataFrame, groupings: dict[str, list[str]], probs: tuple[float, ...] = QUARTILES,
) -> DataFrame:
    """Rows, count, mean, standard deviation, extremes and exact quantiles per group and metric.

    Result columns: grouping, level (text), metric, n_rows (with nulls), n (without), mean, std, min,
    max and one column per quantile, interpolated linearly. The histogram is computed at once.
    """
    return named(_refine(melt(df, groupings), probs), _parts(groupings), probs)


def named(result: DataFrame, pairs: list[tuple[str, str]], probs: tuple[float, ...]) -> DataFrame:
    """Replace ``part`` by the grouping and the metric it numbers."""
    names = F.array(*(F.struct(F.lit(k).alias("grouping"), F.lit(m).alias("metric")) for k, m in pairs))
    part = names[F.col("part")]
    return result.select(
        part["grouping"].alias("grouping"), "level", part["metric"].alias("metric"),
        *_STATS, *(quantile_name(p) for p in probs))


def wanted_buckets(cells: DataFrame, probs: tuple[float, ...]) -> tuple[DataFrame, Row]:
    """The buckets that hold the wanted ranks, written, and their number, the largest one's rows and a list if short.

    ``cells`` (part, level, coarse, rows, c, sum, var, low, high) may have several rows per bucket.
    """
    total = _add_moments(cells).groupBy(*_KEYS, "coarse").agg(
        F.sum("c").alias("c"), *(F.first(name).alias(name) for name in _STATS))
    wanted = _number_rows(total, _KEYS, "coarse", F.lit(0))
    wanted = wanted.where(_holds_rank(probs) | (F.col("n") == 0))
    wanted = settle(wanted.select(*_KEYS, "coarse", F.col("first").alias("offset"), "c", *_STATS), "buckets")
    few = F.count("*") <= LISTED_BUCKETS
    size = wanted.agg(F.count("*").alias("buckets"), F.max("c").alias("largest"),
                      F.when(few, F.collect_set("coarse")).alias("list")).first()
    return wanted.drop("c"), size


def _refine(rows: DataFrame, probs: tuple[float, ...], sort_rows: int = SORT_ROWS,
            broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    rows = rows.withColumn("coarse", F.coalesce(bucket(F.col("v"), COARSE_BITS), F.lit(_NULLS)))

    # First scan: a histogram that carries the moments of each bucket, reduced to the wanted buckets.
    histogram = rows.groupBy(*_KEYS, "coarse").agg(
        F.count("*").alias("rows"), F.count("v").alias("c"), F.sum("v").alias("sum"),
        F.var_pop("v").alias("var"), F.min("v").alias("low"), F.max("v").alias("high"))
    wanted, size = wanted_buckets(histogram, probs)

    # Second scan: the distinct values of the wanted buckets with their counts.
    if size["list"] is not None:
        rows = rows.where(F.col("coarse").isin(size["list"]))  # cheaper than the join for most rows
    if size["buckets"] <= broadcast_rows:
        rows = rows.join(F.broadcast(wanted.select(*_KEYS, "coarse")), [*_KEYS, "coarse"])
    # Copies of a value collapse before the join, so a frequent value is no hot key.
    distinct = rows.groupBy(*_KEYS, "coarse", "v").agg(F.count("v").alias("c"))
    return values_at_ranks(distinct, wanted, size, probs, sort_rows, broadcast_rows)


def values_at_ranks(distinct: DataFrame, wanted: DataFrame, size: Row, probs: tuple[float, ...],
                    sort_rows: int = SORT_ROWS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(part, level, statistics, quantiles) from the counted values (part, level, coarse, v, c) of wanted buckets."""
    key, carried = [*_KEYS, "coarse"], ["offset", *_STATS]
    distinct = distinct.join(F.broadcast(wanted) if size["buckets"] <= broadcast_rows else wanted, key)
    if (size["largest"] or 0) > sort_rows:
        distinct = _narrow(distinct, key, carried, probs)
        key = [*key, "fine"]
    ranked = _number_rows(distinct, key, "v", F.col("offset"))

    def value_at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("first")) & (rank < F.col("first") + F.col("c")), F.col("v")))

    def quantile(p: float) -> Column:
        low, high = (value_at(rank) for rank in _ranks(p))
        share = (F.first("n") - 1) * F.lit(p) % 1
        # Between equal values nothing is computed, so that a tie is met exactly.
        return F.when((share == 0) | (low == high), low).otherwise(low + (high - low) * share).alias(quantile_name(p))

    return ranked.groupBy(*_KEYS).agg(
        *(F.first(name).alias(name) for name in _STATS), *(quantile(p) for p in probs))


def _narrow(distinct: DataFrame, key: list[str], carried: list[str], probs: tuple[float, ...]) -> DataFrame:
    """Keep the values of the fine buckets that hold a wanted rank, with the rank of their first row.

    ``distinct`` is read twice with the same columns, so that Spark shuffles it once and reuses the
    exchange.
    """
    distinct = distinct.withColumn("fine", F.coalesce(bucket(F.col("v"), FINE_BITS), F.lit(_NULLS)))
    fine_key = [*key, "fine", *carried]
    fine = _number_rows(distinct.groupBy(*fine_key).agg(F.sum("c").alias("c")), key, "fine", F.col("offset"))
    fine = fine.where(_holds_rank(probs) | (F.col("n") == 0)).drop("c")
    same = reduce(lambda a, b: a & b, (F.col(f"d.{c}").eqNullSafe(F.col(f"f.{c}")) for c in fine_key))
    kept = distinct.alias("d").join(fine.alias("f"), same).select("d.*", "f.first")
    return kept.withColumn("offset", F.col("first")).drop("first")


def _add_moments(histogram: DataFrame) -> DataFrame:
    """Replace the moments of each bucket by those of its group."""
    group = Window.partitionBy(*_KEYS)
    total = histogram.withColumns({
        "n_rows": F.sum("rows").over(group), "n": F.sum("c").over(group),
        "mean": F.try_divide(F.sum("sum").over(group), F.sum("c").over(group)),
        "min": F.min("low").over(group), "max": F.max("high").over(group),
    })
    own_mean = F.try_divide(F.col("sum"), F.col("c"))
    spread = F.coalesce(F.col("c") * (F.col("var") + F.pow(own_mean - F.col("mean"), 2)), F.lit(0.0))
    std = F.when(F.col("n") > 1, F.sqrt(F.sum(spread).over(group) / (F.col("n") - 1)))
    return total.withColumn("std", std)


def levels(summary: DataFrame, key: str, key_type, metric: str) -> DataFrame:
    """The rows of one key and metric, with the key under its own name and type again."""
    rows = summary.where((F.col("grouping") == key) & (F.col("metric") == metric))
    return rows.withColumn(key, F.col("level").cast(key_type)).drop("grouping", "level", "metric")


def quantile_value(df: DataFrame, column: str, p: float) -> float | None:
    """One exact quantile of a column as a number, None when it has no values."""
    row = summarize(df, {"all": [column]}, (p,)).first()
    return row[quantile_name(p)] if row else None


def trip_groupings(df: DataFrame, cfg: TripConfig = DEFAULT) -> dict[str, list[str]]:
    """All groupings that the profile, the statistics and the charts of a cleaned table need."""
    return {"all": [c for c in cfg.numeric if c in df.columns], HOUR: [SPEED], RUSH: [SPEED], WEEKEND: [SPEED]}
