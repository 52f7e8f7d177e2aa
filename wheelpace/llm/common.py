"""What the text operators share: the columns they take, word shingles, connected components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wheelpace.session import settle

#: Numbers of a table of sums that one row carries.
PIECE = 1024

#: Runs of letters and digits of any script.
WORD = r"[\p{L}\p{N}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rows_of_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text) with an empty text for null; other columns are left behind.

    Two rows of the same id and text are the same document; ``text_hash`` tells rows apart that share
    an id only.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(docs["doc_id"], F.xxhash64(text).alias("text_hash"), text.alias("text"))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def shingle(tokens: Column, at: Column, length: int) -> Column:
    """One hash of the ``length`` tokens from position ``at`` on, counted from 0."""
    return F.xxhash64(*(F.get(tokens, at + i) for i in range(length)))


def shingle_text(tokens: Column, at: Column, length: int) -> Column:
    return F.concat_ws(" ", *(F.get(tokens, at + i) for i in range(length)))


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equality of the named columns where null equals null."""
    return reduce(lambda a, b: a & b, (left[n].eqNullSafe(right[n]) for n in names))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the undirected ``edges`` (u, v): one label for all that hang together.

    Every round maps each node to the smallest of its neighbours and itself, then joins the edges of
    the smaller graph that is left, until none is left. Node numbers should be in random order; then
    the number of rounds grows with the logarithm of the nodes. Tables are written after each round.
    A hub is no hot key: minima are taken before the shuffle, and joins are between written tables,
    which Spark splits. Self loops and repeated edges are allowed; no edges give no rows.
    """
    edges = settle(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                   .where("u < v").distinct(), "edges")
    labels = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        step = settle(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v"))
                      .select("node", F.least("node", "v").alias("label")), "parents")
        if labels is None:
            labels = step
        else:
            moved = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = settle(labels.join(moved, "label", "left")
                            .select("node", F.coalesce("next", "label").alias("label")), "labels")
        ends = [step.select(F.col("node").alias(c), F.col("label").alias(f"{c}_to")) for c in ("u", "v")]
        first = settle(edges.join(ends[0], "u").select("v", "u_to"), "half-moved")
        edges = settle(first.join(ends[1], "v").where("u_to <> v_to")
                       .select(F.least("u_to", "v_to").alias("u"), F.greatest("u_to", "v_to").alias("v"))
                       .distinct(), "edges")
        if edges.isEmpty():
            return labels


def pieces(sums: np.ndarray) -> pd.DataFrame:
    """(piece, sums): a long row of numbers in pieces of ``PIECE``, as a task sends it."""
    return pd.DataFrame([(at // PIECE, sums[at:at + PIECE].tobytes()) for at in range(0, len(sums), PIECE)],
                        columns=["piece", "sums"])


def added_up(rows: DataFrame) -> np.ndarray:
    """The sum of all rows of numbers that tasks sent by ``pieces``; empty where none did.

    Every piece is added up in one task as it streams in, so no task holds more than a few pieces at a time,
    however many tasks there were.
    """
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, sums in zip(batch["piece"].tolist(), batch["sums"], strict=True):
                total[piece] = total.get(piece, 0.0) + np.frombuffer(sums)
        yield pd.DataFrame([(piece, sums.tobytes()) for piece, sums in total.items()], columns=["piece", "sums"])

    found = rows.repartition("piece").mapInPandas(add, "piece int, sums binary").collect()
    return np.concatenate([np.zeros(0), *(np.frombuffer(r["sums"]) for r in sorted(found, key=lambda r: r["piece"]))])
