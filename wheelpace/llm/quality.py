"""Quality scores: random Fourier features, ridge regression by normal equations, isotonic calibration.

Each whole text becomes a vector of statistics. Cosines of random projections of the standardised
vector approximate a Gaussian kernel. Every partition adds up its share of the normal equations; the
sums have a fixed size, whatever the number of rows. The ridge score is then mapped to a probability by
isotonic regression over a fixed grid of bins. The text is read once; statistics are kept as a table.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wheelpace.llm.common import added_up, pieces
from wheelpace.llm.langid import held_out
from wheelpace.session import settle

FEATURES = 192
SEED = 11
RIDGE = 0.003
BINS = 512
LOW, HIGH = -0.5, 1.5  # of the bins; scores beyond go to the outermost

STATISTICS = [
    "log_chars", "log_words", "upper", "lower", "digits", "spaces", "punctuation", "symbols", "other_letters",
    "word_length", "word_spread", "distinct_words", "short_words", "long_words", "top_word", "log_lines",
    "line_words", "distinct_lines", "short_lines", "sentence_words", "bangs", "bars", "marked_words", "non_ascii",
]


@functools.cache
def _kinds() -> np.ndarray:
    """0 other, 1 upper, 2 lower, 3 digit, 4 space, 5 punctuation, 6 symbol, 7 other letter, by code point."""
    groups = {"Lu": 1, "Lt": 1, "Ll": 2, "Nd": 3, "Zs": 4, "Zl": 4, "Zp": 4}
    first = {"P": 5, "S": 6, "L": 7}
    kinds = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))
        kinds[point] = groups.get(kind) or first.get(kind[0], 0)
    kinds[[9, 10, 11, 12, 13]] = 4
    return kinds


def statistics(text: str) -> list[float]:
    """The numbers named in ``STATISTICS``; zeros where nothing can be counted."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = max(1, len(points))
    kinds = np.bincount(_kinds()[points], minlength=8) / n
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    w, li = max(1, len(words)), max(1, len(lines))
    distinct: dict[str, int] = {}
    for word in words:
        distinct[word] = distinct.get(word, 0) + 1
    per_line = np.fromiter(map(len, lines), np.int64, len(lines))
    stops = text.count(".") + text.count("?") + text.count("!")
    marked = sum(1 for word in distinct if not word[-1].isalnum() and len(word) > 2 and not word[-2].isalnum())
    return [
        math.log1p(len(points)), math.log1p(len(words)), kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6],
        kinds[7], float(sizes.sum() / w), float(sizes.std()) if words else 0.0, len(distinct) / w,
        float((sizes <= 3).sum() / w), float((sizes >= 12).sum() / w), max(distinct.values(), default=0) / w,
        math.log1p(len(lines)), len(words) / li, len(set(lines)) / li, float((per_line < 20).sum() / li),
        math.log1p(len(words) / max(1, stops)), text.count("!") / w, text.count("|") / w,
        marked / max(1, len(distinct)), float((points > 127).sum() / n),
    ]


def _statistics(texts: pd.Series) -> pd.Series:
    return pd.Series([np.array(statistics(t)) for t in texts])


@dataclass(frozen=True)
class Model:
    """Centre and scale of the statistics, projection, ridge weights, calibration curve."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    curve: np.ndarray  # calibrated value of each bin


@functools.cache
def _projection() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    width = math.sqrt(2 * len(STATISTICS))
    return rng.normal(size=(len(STATISTICS), FEATURES)) / width, rng.uniform(0, 2 * math.pi, FEATURES)


def features(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of rows of statistics, the standardised statistics and a constant."""
    directions, phases = _projection()
    z = np.clip((x - centre) / scale, -5, 5)
    return np.hstack([np.cos(z @ directions + phases) * math.sqrt(2 / FEATURES), z * 0.1, np.ones((len(x), 1))])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, len(STATISTICS)))


def _raw(model: Model, x: np.ndarray) -> np.ndarray:
    return features(x, model.centre, model.scale) @ model.weights


def _bin(raw: np.ndarray) -> np.ndarray:
    return np.clip(((raw - LOW) / (HIGH - LOW) * BINS).astype(np.int64), 0, BINS - 1)


def increasing(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Isotonic regression of ``sums / counts`` in order: neighbours that fall are pooled. Empty bins are
    interpolated."""
    blocks: list[list[float]] = []  # sum, count, bins
    filled = np.flatnonzero(counts)
    for s, c in zip(sums[filled], counts[filled], strict=True):
        blocks.append([s, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, c2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + c2, blocks[-1][2] + n2]
    values = np.repeat([s / c for s, c, _ in blocks], [int(n) for _, _, n in blocks])
    return np.interp(np.arange(len(sums)), filled, values) if len(filled) else np.full(len(sums), 0.5)


def _normal_equations(rows: DataFrame, centre: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Sums over ``rows`` (x, y) of features' products, features times label, and rows.

    Tasks send one table of sums each, piece by piece, and the pieces are added up as they stream in.
    """
    width = FEATURES + len(STATISTICS) + 1

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((width, width + 1)), 0
        for batch in batches:
            f = features(_matrix(batch["x"]), centre, scale)
            total += f.T @ np.hstack([f, batch["y"].to_numpy(float)[:, None]])
            n += len(batch)
        if n:
            yield pieces(np.append(total.ravel(), n))

    found = added_up(rows.mapInPandas(add, "piece int, sums binary"))
    if not len(found):
        return np.zeros((width, width)), np.zeros(width), 0.0
    total = found[:-1].reshape(width, width + 1)
    return total[:, :-1], total[:, -1], float(found[-1])


def fit(rows: DataFrame) -> Model:
    """A model from ``rows`` (x: statistics, y: 0 to 1). Without rows every score is 0.5."""
    k = len(STATISTICS)
    moments = rows.agg(*(F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(k)),
                       *(F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(k))).first()
    centre = np.array([moments[f"m{i}"] or 0.0 for i in range(k)])
    scale = np.array([(moments[f"s{i}"] or 0.0) if (moments[f"s{i}"] or 0.0) > 1e-9 else 1.0 for i in range(k)])
    products, right, n = _normal_equations(rows, centre, scale)
    weights = np.linalg.solve(products + max(1.0, RIDGE * n) * np.diag([1.0] * (len(right) - 1) + [1e-6]), right)
    model = Model(centre, scale, weights, np.zeros(BINS))

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bins = _bin(_raw(model, _matrix(batch["x"])))
            yield pd.DataFrame({"bin": bins, "y": batch["y"].to_numpy(float)})

    sums, counts = np.zeros(BINS), np.zeros(BINS)
    for r in rows.mapInPandas(binned, "bin long, y double").groupBy("bin").agg(F.sum("y"), F.count("*")).collect():
        sums[r[0]], counts[r[0]] = r[1], r[2]
    return Model(centre, scale, weights, increasing(sums, counts))


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with ``score`` (0 to 1) from their statistics ``x``."""
    @F.pandas_udf("double")
    def scored(x: pd.Series) -> pd.Series:
        raw = _raw(model, _matrix(x))
        place = (raw - LOW) / (HIGH - LOW) * BINS - 0.5
        return pd.Series(np.clip(np.interp(place, np.arange(BINS), model.curve), 0.0, 1.0))

    return rows.withColumn("score", scored("x"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Labels (doc_id, quality) teach where the id is not held out; several labels of an id count as their
    mean, labels without id or value and documents without label teach nothing. Null and empty texts
    are scored by their statistics like others. Repeated rows get equal scores and count as often as they
    occur. Without any label every score is 0.5. Extra columns are ignored; no rows give no rows.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = settle(docs.select(docs["doc_id"], held_out(docs["doc_id"]).alias("held_out"), F.pandas_udf(_statistics, "array<double>")(text).alias("x")),
                  "statistics")
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.avg(F.col("quality").cast("double")).alias("y"))
    taught = settle(rows.where(~F.col("held_out")).join(marks, "doc_id").select("x", "y"), "taught")
    found = score(rows, fit(taught))
    return found.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
