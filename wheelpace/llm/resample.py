"""Importance resampling towards a target distribution: array-scored weights, a cutoff by bisection, ranks by ranges.

Features are runs of words, hashed into ``BUCKETS`` buckets. The corpus and the target are each one array of
counts; from both follows one array of whole gains, and the weight of a document is the sum of the gains of
its features. Weights with Gumbel noise of the document's id are scores, and the highest scores are a draw
without replacement. The place of the last document drawn is found by halving an interval of numbers: first
of the score, then of the ids that share the score, then of the rows that share both. Every step counts
exactly over the written scores; four halvings share one scan. Only drawn rows are sorted, in ranges.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wheelpace.session import settle

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Thresholds counted in one scan: all middles that four halvings can meet.
HALVINGS = 4
#: Features whose bucket a task remembers.
REMEMBERED = 300_000
#: Features turned into buckets at once, so that a very long text takes no more room than this.
TOGETHER = 1 << 20

#: Every byte as it counts: A-Z as a-z, other ASCII that is neither letter nor digit as a blank.
_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


class Features:
    """Buckets of the features of a text, ``TOGETHER`` at a time; buckets of frequent features are remembered."""

    def __init__(self, longest: int, buckets: int):
        self._longest, self._buckets, self._known = longest, buckets, {}

    def _bucket(self, feature: bytes) -> int:
        found = self._known.get(feature)
        if found is None:
            if len(self._known) >= REMEMBERED:
                self._known = {}
            found = zlib.crc32(feature) % self._buckets
            if len(feature) <= 64:
                self._known[feature] = found
        return found

    def pieces(self, text: bytes) -> tuple[int, Iterator[np.ndarray]]:
        """The number of words, and the buckets of all features in arrays of bounded length."""
        words = bytes(text).translate(_BYTES).split()

        def runs() -> Iterator[np.ndarray]:
            for length in range(1, self._longest + 1):
                last = len(words) - length + 1
                for at in range(0, last, TOGETHER):
                    stop = min(last, at + TOGETHER)
                    run = words[at:stop] if length == 1 else [b" ".join(words[i:i + length]) for i in range(at, stop)]
                    yield np.array([self._bucket(x) for x in run], np.int64)

        return len(words), runs()


def _as_bytes(rows: DataFrame) -> Column:
    """The UTF-8 bytes of a text, none for null."""
    return F.coalesce(rows["text"].cast("string"), F.lit("")).cast("binary").alias("text")


def bucket_counts(rows: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of all features of ``rows`` (text) by bucket.

    A task sends one number for each bucket it met, and Spark adds them up; the driver gets ``buckets`` numbers.
    """
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features, found = Features(longest, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"]:
                for piece in features.pieces(text)[1]:
                    found += np.bincount(piece, minlength=buckets)
        met = np.nonzero(found)[0]
        yield pd.DataFrame({"bucket": met, "n": found[met]})

    counts = np.zeros(buckets, np.int64)
    for row in rows.select(_as_bytes(rows)).mapInPandas(counted, "bucket long, n long").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of how much more frequent a bucket is in the target, rounded down."""
    buckets, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float((t + 1) * (s_all + buckets)) / float((s + 1) * (t_all + buckets))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, longest: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs``."""
    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        features = Features(longest, len(gain))
        for batch in batches:
            out = np.zeros((len(batch), 3), np.int64)
            for row, text in enumerate(batch):
                out[row, 0], pieces = features.pieces(text)
                for piece in pieces:
                    out[row, 1] += len(piece)
                    out[row, 2] += gain[piece].sum()
            yield pd.DataFrame(out, columns=["n_words", "n_features", "weight"])

    return docs.select(docs["doc_id"], weigh(_as_bytes(docs)).alias("w")).select("doc_id", "w.*")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A thousandfold Gumbel variable of the id, rounded down; rows without id share that of an empty id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def lowest(rows: DataFrame, value: Column, wanted: int) -> int:
    """The smallest number that at least ``wanted`` of the values of ``rows`` do not exceed, by bisection."""
    found = rows.agg(F.min(value).alias("low"), F.max(value).alias("high")).first()
    low, high = found["low"], found["high"]
    while low < high:
        step = (high - low) >> HALVINGS
        marks = sorted({low + step * i for i in range(1, 1 << HALVINGS)} if step else set(range(low, high)))
        counts = rows.agg(*(F.count_if(value <= m).alias(str(i)) for i, m in enumerate(marks))).first()
        enough = [m for m, n in zip(marks, counts, strict=True) if n >= wanted]
        low = max([low, *(m + 1 for m in marks if m not in enough)])
        high = min([high, *enough])
    return low


def drawn(scored: DataFrame, wanted: int) -> Column:
    """Whether a row of ``scored`` (score, doc_id, row) is among the ``wanted`` first by score from the top, doc_id
    with null first, and row number; ``row`` tells all rows apart, so exactly so many are.

    What reaches the driver are counts. ``scored`` should be a written table, it is read again and again.
    """
    if wanted <= 0:
        return F.lit(False)
    if wanted >= scored.count():
        return F.lit(True)
    # Numbers that grow in the order of the draw; a null id is below all others.
    keys = [-F.col("score"), F.col("doc_id").isNotNull().cast("int"), F.coalesce(F.col("doc_id"), F.lit(0)), F.col("row")]
    before, tied, left = F.lit(False), F.lit(True), wanted
    for key in keys:
        cut = lowest(scored.where(tied), key, left)
        before = before | (tied & (key < cut))
        left -= scored.where(tied & (key < cut)).count()
        tied = tied & (key == cut)
    return before | tied  # the last key ties one row


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (score, doc_id, row, ...) with ``rank`` from 1 on, sorted in ranges numbered one after the other."""
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("row")]
    placed = settle(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "place", F.monotonically_increasing_id()), "drawn")
    part, inside = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()  # one row per range
    before, total = {}, 0
    for size in sorted(sizes, key=lambda r: r["part"]):
        before[size["part"]], total = total, total + size["n"]
    offsets = placed.sparkSession.createDataFrame(list(before.items()), "part long, before long")
    return placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn(
        "rank", F.col("before") + inside + 1).drop("part", "before", "place")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             longest: int = 1, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text): a draw of ``percent``
    percent of the documents with at least ``least_words`` words, distributed as ``target`` (text).

    Features are all runs of 1 to ``longest`` words joined by a blank; words are runs of ASCII letters and
    digits, of which A-Z become small, and of characters beyond ASCII. ``rank`` counts from 1 in the order of
    score from the top, then doc_id; rows that were not drawn have none.

    Null and empty texts and those without words have no features, weight 0, and are not drawn. Ties of score
    go to the smaller doc_id, a missing one first; repeated rows are documents of their own, of which the one
    written first goes first. An empty ``target`` or ``docs`` counts as no features; empty ``docs`` give no
    rows. Other columns are ignored.
    """
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    rows = weighed(docs, gain, longest)
    scored = settle(rows.withColumn("doc_id", F.col("doc_id").cast("long")).select(
        "*", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"),
        F.monotonically_increasing_id().alias("row")), "scores")
    enough = F.col("n_words") >= least_words
    able = scored.where(enough)
    chosen = enough & drawn(able.select("score", "doc_id", "row"), able.count() * percent // 100)
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(~chosen).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked(scored.where(chosen)).select(*columns, "rank").unionByName(rest)
