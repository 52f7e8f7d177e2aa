"""The slow-trip classifier: target, features, split, imputation, codes, boosted trees and metrics."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wheelpace.config import (
    DEFAULT, FRIDAY, HOUR, MONDAY, ROUTE, RUSH, SLOW, SPEED, TIME_GROUP, WEEKDAY, WEEKEND, TripConfig,
)
from wheelpace.functions.features import add_model_features, number
from wheelpace.operators import boosting
from wheelpace.operators.summary import quantile_name, quantile_value, summarize
from wheelpace.session import settle

# Hashes stay below this, so that a double also holds the middle between two of them.
_HASHES = 2 ** 51
_ROW, _HELD_OUT = "row_key", "held_out"
# Code tables up to this length are broadcast, about 100 bytes a row. All pairs of 265 zones are 70,225 routes.
BROADCAST_CODES = 200_000
# Columns that follow from one another have few combinations, which are counted before they are told apart.
_CLOCK = (HOUR, WEEKDAY, TIME_GROUP, WEEKEND, RUSH, FRIDAY, MONDAY)


# --- target and split -----------------------------------------------------------------------------

def create_target(trips: DataFrame, cfg: TripConfig = DEFAULT) -> tuple[DataFrame, float]:
    """Mark the slowest quarter of all trips; the threshold is taken before any split."""
    if SPEED not in trips.columns:
        raise ValueError(f"column {SPEED} is missing")
    threshold = quantile_value(trips, SPEED, cfg.slow_quantile)
    return with_target(trips, threshold), threshold


def with_target(trips: DataFrame, threshold: float) -> DataFrame:
    return trips.withColumn(SLOW, F.coalesce(F.col(SPEED) <= F.lit(threshold), F.lit(False)).cast("int"))


def class_shares(trips: DataFrame) -> DataFrame:
    """(slow_trip, n, share) in class order."""
    counts = trips.groupBy(SLOW).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over two rows
    return counts.select(SLOW, "n", (F.col("n") / total).alias("share")).orderBy(SLOW)


def row_hash(trips: DataFrame, cfg: TripConfig, salt: int) -> Column:
    """A number from the raw columns of a row: the same under any partitioning and after any retry.

    A table reduced to the model's columns carries their hash as ``row_key`` instead.
    """
    key = F.col(_ROW) if _ROW in trips.columns else F.xxhash64(*(F.col(c) for c in cfg.raw if c in trips.columns))
    return F.pmod(F.xxhash64(F.lit(salt), key), F.lit(_HASHES))


def wanted_test_rows(counts: dict[int, int], share: float) -> dict[int, int]:
    """Test rows per class: ``share`` of all rows, rounded up, in the ratio of the classes."""
    total = sum(counts.values())
    wanted = math.ceil(share * total)
    slow = math.floor(wanted * counts.get(1, 0) / total + 0.5) if total else 0
    return {0: wanted - slow, 1: slow}


def split(trips: DataFrame, cfg: TripConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Training and test rows: in each class the wanted number of rows with the smallest hashes are test rows.

    The hash that ends them is an exact order statistic per class, so the rows themselves are neither
    sorted nor shuffled. Rows that share that very hash are kept together.
    """
    hashed = trips.select(SLOW, row_hash(trips, cfg, cfg.seed).alias("hash"))
    counts = {r[SLOW]: r["n"] for r in class_shares(hashed).collect()}
    cuts = {}
    for label, k in wanted_test_rows(counts, cfg.test_share).items():
        n = counts.get(label, 0)
        if 0 < k < n:  # half-way between the last test row and the next one
            cuts[label] = quantile_value(hashed.where(F.col(SLOW) == label), "hash", (k - 0.5) / (n - 1))
        else:
            cuts[label] = float(_HASHES) if k else 0.0
    cut = reduce(lambda c, label: c.when(F.col(SLOW) == label, cuts[label]), cuts, F)
    is_test = row_hash(trips, cfg, cfg.seed) < cut
    return trips.where(~is_test), trips.where(is_test)


# --- imputation and codes -------------------------------------------------------------------------

def medians(train: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(column, fill): median of each numeric column."""
    found = summarize(train, {"all": list(columns)}, (0.5,))
    return found.select(F.col("metric").alias("column"), F.col(quantile_name(0.5)).alias("fill"))


def category_counts(train: DataFrame, columns: tuple[str, ...], cfg: TripConfig = DEFAULT) -> DataFrame:
    """(column, category, sort_key, n) of all columns.

    Columns that belong together are first counted as one, so a row is not repeated per column.
    ``sort_key`` brings numbers into numeric order; text sorts by itself.
    """
    related = [[c for c in columns if c in group] for group in (_CLOCK, (cfg.pickup_zone, cfg.dropoff_zone, ROUTE))]
    related += [[c] for c in columns if not any(c in group for group in related)]
    counts = []
    for group in filter(None, related):
        cells = []
        for c in group:
            kind = train.schema[c].dataType.simpleString()
            key = F.lit(0.0) if kind == "string" else F.col(c).cast("int" if kind == "boolean" else "double").cast("double")
            cells += [F.lit(c), F.col(c).cast("string"), key]
        cells = F.stack(F.lit(len(group)), *cells).alias("column", "category", "sort_key")
        counts.append(train.groupBy(*group).agg(F.count("*").alias("n")).select(cells, "n"))
    long = reduce(DataFrame.unionByName, counts)
    return long.where(F.col("category").isNotNull()).groupBy("column", "category", "sort_key").agg(
        F.sum("n").alias("n"))


def most_frequent(counts: DataFrame) -> DataFrame:
    """(column, fill): the most frequent category, the smallest on a tie."""
    order = F.struct(-F.col("n"), F.col("sort_key"), F.col("category"))
    return counts.groupBy("column").agg(F.min_by("category", order).alias("fill"))


def ordinal_codes(counts: DataFrame) -> DataFrame:
    """(column, category, code, n): position of each category in the sorted categories of its column, and its count.

    The categories are sorted in ranges, each numbered by itself from the size of the ranges before it, so
    that no task holds a whole column. The ranges are written first; the offsets then fit them for certain.
    """
    order = ["sort_key", "category"]
    ranges = settle(counts.repartitionByRange("column", *order).select(
        "column", *order, "n", F.spark_partition_id().alias("range")), "ranges")
    before = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per column and range: as many as there are partitions, and one more per column.
    offsets = ranges.groupBy("column", "range").agg(F.count("*").alias("n")).select(
        "column", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("column", "range").orderBy(*order))
    return ranges.join(F.broadcast(offsets), ["column", "range"]).select(
        "column", "category", (F.col("offset") + place - 1).cast("int").alias("code"), "n")


def frequent_from(codes: DataFrame, limit: int) -> dict[str, int | None]:
    """Per column of a code table the count from which its categories are frequent: at most ``limit`` of them are.

    It is a power of two, or 0 where the column has no more categories than that. More than ``limit`` categories
    have at least half of that count, so a rarer one has less than 2 / ``limit`` of all rows. None where no
    category is frequent.
    """
    size = F.floor(F.log2("n")).cast("int")
    found: dict[str, list[tuple[int, int]]] = {}
    for r in codes.groupBy("column", size.alias("size")).agg(F.count("*").alias("n")).collect():  # at most 64 a column
        found.setdefault(r["column"], []).append((r["size"], r["n"]))
    starts: dict[str, int | None] = {}
    for column, sizes in found.items():
        total, starts[column] = 0, None
        for power, n in sorted(sizes, reverse=True):
            total += n
            if total > limit:
                break
            starts[column] = 2 ** power
        else:
            starts[column] = 0
    return starts


def class_weights(train: DataFrame) -> DataFrame:
    """(slow_trip, n, weight) with the balanced weight rows / (2 * rows of the class)."""
    shares = class_shares(train)
    return shares.select(SLOW, "n", (1.0 / (2.0 * F.col("share"))).alias("weight"))


# --- model ----------------------------------------------------------------------------------------

@dataclass(frozen=True)
class SlowTripModel:
    """Fitted trees with what turns trips into their input."""

    trees: boosting.LeafTrees | None
    codes: DataFrame  # (column, category, code, n), stored
    fills: dict[str, float | str | None]
    features: tuple[str, ...]
    categorical: tuple[str, ...]
    threshold: float
    train_rows: int

    def encode(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the number ``x_<feature>`` per feature.

        Missing values get the fill, categories that training has not seen the code -1. A code table is broadcast
        where it was counted to be short. Of a longer one only the frequent categories are; rows of all others, of
        which none has a large share, are shuffled and united with the rest.
        """
        starts = frequent_from(self.codes, BROADCAST_CODES)
        known = {}
        for c in self.features:
            fill = self.fills.get(c)
            if c in self.categorical:
                known[f"k_{c}"] = F.coalesce(F.col(c).cast("string"), F.lit(fill))
            else:
                known[f"x_{c}"] = F.coalesce(number(c), F.lit(0.0 if fill is None else fill))
        out = rows.withColumns(known)
        # A long table reads its input twice, so those come last; without any training category there is nothing to look up.
        for c in sorted(self.categorical, key=lambda c: starts.get(c, 0) != 0):
            code = self.codes.where(F.col("column") == c).select(
                F.col("category").alias(f"k_{c}"), F.col("code").cast("double").alias(f"c_{c}"), "n")
            start = starts.get(c, 0)
            if start is None:
                out = out.join(code.drop("n"), f"k_{c}", "left")
                continue
            frequent = F.broadcast(code.where(F.col("n") >= start).drop("n"))
            out = out.join(frequent, f"k_{c}", "left")
            if start:
                others = out.where(F.col(f"c_{c}").isNull()).drop(f"c_{c}").join(
                    code.where(F.col("n") < start).drop("n"), f"k_{c}", "left")
                out = out.where(F.col(f"c_{c}").isNotNull()).unionByName(others)
        out = out.withColumns({f"x_{c}": F.coalesce(f"c_{c}", F.lit(-1.0)) for c in self.categorical})
        return out.select(*rows.columns, *(f"x_{c}" for c in self.features))

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the column ``prediction`` (0 or 1)."""
        scored = self.trees.transform(self.encode(rows))
        return scored.select(*rows.columns, F.col("prediction").cast("int").alias("prediction"))


def fit(train: DataFrame, threshold: float, cfg: TripConfig = DEFAULT) -> SlowTripModel:
    """Fit imputation, codes and boosted trees on training rows with a target."""
    features = (*cfg.numeric_features, *cfg.categorical_features)
    counts = settle(category_counts(train, cfg.categorical_features, cfg), "categories")
    codes = settle(ordinal_codes(counts), "codes")
    # One row per column.
    fills = {r["column"]: r["fill"] for found in (medians(train, cfg.numeric_features), most_frequent(counts))
             for r in found.collect()}
    weights = class_weights(train).collect()
    untrained = SlowTripModel(None, codes, fills, features, tuple(cfg.categorical_features), threshold,
                              sum(r["n"] for r in weights))
    # Fitting passes over its input several times, so the encoded rows are written once.
    held_out = row_hash(train, cfg, cfg.seed + 1) < int(cfg.validation_share * _HASHES)
    encoded = untrained.encode(train.withColumn(_HELD_OUT, held_out))
    numbers = [f"x_{c}" for c in features]
    encoded = settle(encoded.select(*numbers, SLOW, _HELD_OUT), "encoded")
    trees, _ = boosting.fit(encoded, numbers, SLOW, _HELD_OUT, {r[SLOW]: r["weight"] for r in weights}, tree_settings(cfg))
    return replace(untrained, trees=trees)


def tree_settings(cfg: TripConfig = DEFAULT) -> boosting.Settings:
    return boosting.Settings(cfg.learning_rate, cfg.max_rounds, cfg.max_leaves, cfg.min_leaf_rows, cfg.l2,
                             cfg.patience, cfg.early_stop_gain)


# --- metrics --------------------------------------------------------------------------------------

def confusion_cells(label: str = SLOW, prediction: str = "prediction") -> list[Column]:
    """Aggregates: tn, fp, fn, tp."""
    truth, guess = F.col(label) == 1, F.col(prediction) == 1
    return [F.count_if(~truth & ~guess).alias("tn"), F.count_if(~truth & guess).alias("fp"),
            F.count_if(truth & ~guess).alias("fn"), F.count_if(truth & guess).alias("tp")]


def confusion(scored: DataFrame, label: str = SLOW, prediction: str = "prediction") -> DataFrame:
    """One row: tn, fp, fn, tp."""
    return scored.agg(*confusion_cells(label, prediction))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _harmonic(p: Column, r: Column) -> Column:
    return _share(2 * p * r, p + r)


def metrics(confused: DataFrame) -> DataFrame:
    """Accuracy and precision, recall and F1 of class 1; a ratio without cases counts as 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    row = confused.select("*", _share(tp + tn, tn + fp + fn + tp).alias("accuracy"),
                          _share(tp, tp + fp).alias("precision"), _share(tp, tp + fn).alias("recall"))
    return row.withColumn("f1_score", _harmonic(F.col("precision"), F.col("recall")))


def report(confused: DataFrame) -> DataFrame:
    """(label, precision, recall, f1_score, support): both classes, accuracy, macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def line(label: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), precision.alias("precision"), recall.alias("recall"),
                        f1.alias("f1_score"), support.alias("support"))

    sides = []
    for hit, false_alarm, missed in ((tn, fn, fp), (tp, fp, fn)):
        p, r = _share(hit, hit + false_alarm), _share(hit, hit + missed)
        sides.append((p, r, _harmonic(p, r), hit + missed))
    (*zero, n0), (*one, n1) = sides
    total = n0 + n1
    accuracy = _share(tn + tp, total)
    return confused.select(F.inline(F.array(
        line("0", *zero, n0), line("1", *one, n1),
        line("accuracy", accuracy, accuracy, accuracy, total),
        line("macro avg", *((a + b) / 2 for a, b in zip(zero, one)), total),
        line("weighted avg", *(_share(a * n0 + b * n1, total) for a, b in zip(zero, one)), total),
    )))


# --- saving ---------------------------------------------------------------------------------------

def save_model(model: SlowTripModel, path: str) -> str:
    """Trees, code table and settings under one folder."""
    model.trees.save(model.codes.sparkSession, f"{path}/trees")
    model.codes.write.mode("overwrite").parquet(f"{path}/codes")
    fills = [(i, c, c in model.categorical, *_typed(model.fills.get(c)), model.threshold, model.train_rows)
             for i, c in enumerate(model.features)]
    model.codes.sparkSession.createDataFrame(fills, _SETTINGS).coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")
    return path


_SETTINGS = ("position int, feature string, categorical boolean, number double, text string, "
             "threshold double, train_rows long")


def _typed(fill: float | str | None) -> tuple[float | None, str | None]:
    return (None, fill) if isinstance(fill, str) else (fill, None)


def load_model(spark: SparkSession, path: str) -> SlowTripModel:
    settings = spark.read.schema(_SETTINGS).parquet(f"{path}/settings").orderBy("position").collect()  # one row per feature
    return SlowTripModel(
        boosting.LeafTrees.load(spark, f"{path}/trees"), spark.read.parquet(f"{path}/codes"),
        {r["feature"]: r["text"] if r["number"] is None else r["number"] for r in settings},
        tuple(r["feature"] for r in settings), tuple(r["feature"] for r in settings if r["categorical"]),
        settings[0]["threshold"], settings[0]["train_rows"])


def score_both(model: SlowTripModel, path: str, rows: DataFrame) -> dict[str, int]:
    """Rows, confusion matrix and changed predictions of a model and its reloaded copy, in one pass."""
    first = model.predict(rows).withColumnRenamed("prediction", "before")
    both = load_model(rows.sparkSession, path).predict(first)
    row = both.agg(F.count("*").alias("rows"), F.count_if(~F.col("before").eqNullSafe(F.col("prediction"))).alias("differ"),
                   *confusion_cells(SLOW, "before")).first()
    return row.asDict()


def verify_saved_model(model: SlowTripModel, path: str, rows: DataFrame) -> dict[str, int]:
    """Score every row with the model and its reloaded copy, in one pass; error on any difference."""
    found = score_both(model, path, rows)
    if found["differ"]:
        raise ValueError(f"{found['differ']} predictions changed after reloading the model from {path}")
    return found


# --- whole run ------------------------------------------------------------------------------------

def model_input(trips: DataFrame, cfg: TripConfig = DEFAULT) -> DataFrame:
    """Only what the model reads of trips with a target: features, target and the hash of the raw columns."""
    rows = add_model_features(trips)
    key = F.xxhash64(*(F.col(c) for c in cfg.raw if c in rows.columns))
    return rows.select(*dict.fromkeys((*cfg.numeric_features, *cfg.categorical_features)), SLOW, key.alias(_ROW))


def train_and_evaluate(trips: DataFrame, cfg: TripConfig = DEFAULT,
                       folder: str | None = None) -> tuple[SlowTripModel, DataFrame, DataFrame]:
    """Target, features, split, fit and evaluation; returns the model, its metrics and its report.

    With ``folder`` the model is saved there, reloaded and checked on all test rows. The test rows are
    scored once; metrics and report follow from the one row of counts.
    """
    spark = trips.sparkSession
    marked, threshold = create_target(trips, cfg)
    train, test = split(settle(model_input(marked, cfg), "model-input"), cfg)
    model = fit(train, threshold, cfg)
    if folder:
        counted = verify_saved_model(model, save_model(model, f"{folder.rstrip('/')}/model"), test)
    else:
        counted = confusion(model.predict(test)).first().asDict()
    cells = ("tn", "fp", "fn", "tp")
    confused = spark.createDataFrame([tuple(counted[c] for c in cells)], "tn long, fp long, fn long, tp long")
    rows = metrics(confused).select(
        F.lit("LeafTrees").alias("model"), F.lit(threshold).alias("speed_threshold_mph"),
        F.lit(model.train_rows).alias("train_rows"), (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("test_rows"),
        "accuracy", "precision", "recall", "f1_score", *cells)
    return model, rows, report(confused)
