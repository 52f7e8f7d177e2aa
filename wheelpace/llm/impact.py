"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors of whole numbers are cut into blocks of rows. In a block every component is quantised to an impact;
a posting segment holds the rows with one impact in one dimension. Segments are stored by descending size of
their impact. A search adds query component times impact to the accumulators of a segment's rows, segment
after segment. What the segments still to come and the rounding of impacts can change of a score is at most
the norm of the query times the norm of what is left of the row, which the index holds for every stage of the
order. A search of a block stops only when that bound proves that few rows can be among the best; those
rows, all of them, are scored again from their exact components.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wheelpace.session import settle

SCALE = 1024
TOP = 10
QUERY_STEP = 100
#: Components of a block of the index; its rows follow from the longest vector.
BLOCK_COMPONENTS = 1 << 19
#: Components of a block of queries.
QUERY_COMPONENTS = 1 << 14
#: Impacts on either side of zero.
IMPACTS = 24
#: Whole components from here on are refused: their products would not fit a long.
LARGEST = 1 << 28
#: After these shares of the impact range a search looks whether it can stop.
STAGES = (0.4, 0.25, 0.15, 0.08, 0.0)
#: Scores above this are no longer exact in a double; far beyond, bounds get a margin for rounding.
_EXACT = float(1 << 53)

_BLOCK = "block binary"


# --- rows and blocks ------------------------------------------------------------------------------

def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the components times ``scale``, rounded down, of all vectors that take part."""
    found = vectors["embedding"].cast("array<double>")
    bad = F.exists(found, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), found.alias("v")).where(
        F.col("v").isNotNull() & ~bad).withColumn("v", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))))


def _matrix(column: list[np.ndarray]) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros, which adds nothing to a product."""
    width = max(map(len, column))
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    if out.size and max(out.max(), -out.min()) >= LARGEST:
        raise ValueError(f"components must be under {LARGEST} in size after scaling")
    return out


def _cut(batches: Iterator[pd.DataFrame], components: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for batch in batches:
        at = 0
        while at < len(batch):
            rows = max(1, components // max(1, len(batch["v"].iloc[at])))
            part = batch.iloc[at:at + rows]
            longest = max(map(len, part["v"]))
            part = part.iloc[:max(1, components // max(1, longest))]  # a longer vector further on makes the block shorter
            yield part, _matrix(list(part["v"]))
            at += len(part)


def index_block(rows: np.ndarray, ids: np.ndarray, known: np.ndarray, v: np.ndarray) -> dict[str, np.ndarray]:
    """The index of one block: distinct vectors, the rows of each in order of their ids, and posting segments.

    ``order`` and ``starts`` list the rows of every distinct vector; ``posted`` and ``stops`` the distinct vectors
    of every segment, ``dims`` and ``impacts`` what a segment stands for; ``left`` the norms after each stage.
    """
    distinct, member = np.unique(v, axis=0, return_inverse=True)
    order = np.lexsort((rows, ids, ~known, member.ravel()))
    starts = np.searchsorted(member.ravel()[order], np.arange(len(distinct) + 1))
    largest = int(np.abs(distinct).max()) if distinct.size else 0
    step = max(1, -(-largest // IMPACTS))
    impact = (2 * distinct + step) // (2 * step)  # rounded to the nearest
    at, dim = np.nonzero(impact)
    value = impact[at, dim]
    by = np.lexsort((at, value, dim, -np.abs(value)))
    at, dim, value = at[by], dim[by], value[by]
    new = np.ones(len(at), bool)
    new[1:] = (dim[1:] != dim[:-1]) | (value[1:] != value[:-1])
    first = np.nonzero(new)[0]
    left = []
    highest = np.abs(impact).max() if impact.size else 0
    floors = np.array([max(1, int(np.ceil(highest * share))) for share in STAGES])
    for floor in floors:  # what the impacts from this floor on have not brought
        rest = distinct - np.where(np.abs(impact) >= floor, impact * step, 0)
        left.append(np.sqrt((rest.astype(np.float64) ** 2).sum(axis=1)))
    small = np.uint16 if len(distinct) <= 1 << 16 else np.uint32
    return {"rows": rows[order], "ids": ids[order], "known": known[order], "starts": starts, "v": distinct.astype(np.int32),
            "step": np.array(step), "posted": at.astype(small), "stops": np.append(first, len(at)), "dims": dim[first],
            "impacts": value[first], "floors": floors, "left": np.array(left).reshape(len(STAGES), len(distinct))}


def build_index(vectors: DataFrame) -> DataFrame:
    """(block): the index of all rows of ``vectors`` (row, vec_id, v), block by block, without a shuffle."""
    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, v in _cut(batches, BLOCK_COMPONENTS):
            known = part["vec_id"].notna().to_numpy()
            found = index_block(part["row"].to_numpy(np.int64), part["vec_id"].fillna(0).to_numpy(np.int64), known, v)
            yield pd.DataFrame({"block": [pickle.dumps(found, protocol=5)]})

    return vectors.select("row", "vec_id", "v").mapInPandas(blocks, _BLOCK)


def query_blocks(queries: DataFrame) -> DataFrame:
    """(number, queries): ``queries`` (row, vec_id, v) in blocks of bounded size."""
    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, v in _cut(batches, QUERY_COMPONENTS):
            packed = pickle.dumps((part["row"].to_numpy(np.int64), v), protocol=5)
            yield pd.DataFrame({"queries": [packed]})

    return queries.select("row", "vec_id", "v").mapInPandas(blocks, "queries binary").withColumn(
        "number", F.monotonically_increasing_id())


# --- search ---------------------------------------------------------------------------------------

def _fitted(v: np.ndarray, width: int) -> np.ndarray:
    """As many columns as the other side has: what is beyond meets zeros."""
    return v[:, :width] if v.shape[1] >= width else np.pad(v, ((0, 0), (0, width - v.shape[1])))


def possible(index: dict[str, np.ndarray], queries: np.ndarray, top: int, least: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(query, distinct vectors) of all vectors of a block that may be among the ``top`` best of each query.

    ``least`` holds a score for each query that its ``top``-th best is known to reach, or minus infinity.
    """
    n, width = index["v"].shape
    exact = _fitted(queries, width)
    q = exact.astype(np.float64)
    norms = np.sqrt((q ** 2).sum(axis=1))
    copies = np.diff(index["starts"])
    enough = n > 0 and int(copies.sum()) > top  # the query's own row may be one of them
    score = np.zeros((n, len(q)))
    open_queries, least = np.arange(len(q)), least.copy()
    stops, step = index["stops"], float(index["step"])
    sizes = np.abs(index["impacts"])
    done = 0
    for stage, floor in enumerate(index["floors"]):
        upto = int(np.searchsorted(-sizes, -floor, side="right"))
        for segment in range(done, upto):  # by descending impact
            rows = index["posted"][stops[segment]:stops[segment + 1]]
            score[rows] += (q[open_queries, index["dims"][segment]] * (index["impacts"][segment] * step))[None, :]
        done = max(done, upto)
        # The margin covers the rounding of very large products only; smaller ones are exact.
        slack = index["left"][stage][:, None] * norms[open_queries][None, :] * (1 + 1e-9) + 1.0
        if float(index["left"][stage].max(initial=0)) * float(norms.max(initial=0)) > _EXACT:
            slack = slack + 1e-9 * np.abs(score)
        if enough:  # the score that top vectors and one more, the query's own, reach for certain
            take = min(n, top + 1)
            low = np.partition(score - slack, n - take, axis=0)[n - take] if take > top else np.full(len(open_queries), -np.inf)
            least[open_queries] = np.maximum(least[open_queries], low)
        may = score + slack >= least[open_queries][None, :]
        last = stage == len(index["floors"]) - 1
        stop = np.ones(len(open_queries), bool) if last else may.sum(axis=0) <= 4 * top
        for column in np.nonzero(stop)[0]:
            yield int(open_queries[column]), np.nonzero(may[:, column])[0]
        if stop.all():
            return
        score, open_queries = np.ascontiguousarray(score[:, ~stop]), open_queries[~stop]


def _best(index: dict[str, np.ndarray], own: int, query: np.ndarray, members: np.ndarray, top: int) -> pd.DataFrame:
    """The exact ``top`` best rows among the rows of the given vectors, without the query's own row."""
    exact = index["v"][members].astype(np.int64) @ query
    starts, ends = index["starts"][members], index["starts"][members + 1]
    # Rows of one vector stand in the order of their ids: none after the first top, own row aside, can be in.
    ends = np.minimum(ends, starts + top + 1)
    counts = ends - starts
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    score = np.repeat(exact, counts)
    at, score = at[(keep := index["rows"][at] != own)], score[keep]
    order = np.lexsort((index["rows"][at], index["ids"][at], ~index["known"][at], -score))[:top]
    at = at[order]
    return pd.DataFrame({"score": score[order], "known": index["known"][at], "vec_id": index["ids"][at], "row": index["rows"][at]})


def search(index: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """(query_row, score, vec_id, row): the ``top`` best rows of each task's blocks for every query.

    ``index`` is what ``build_index`` and ``queries`` what ``query_blocks`` gave. All blocks of the stated queries meet all
    blocks of the index; Spark sends the queries to all tasks only if they are small. A task remembers the
    best of the blocks it has seen, so that later blocks are left sooner.
    """
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, pd.DataFrame] = {}  # by query row: bounded by the queries that were sent
        for batch in batches:
            for block, sent in zip(batch["block"], batch["queries"], strict=True):
                here = pickle.loads(block)
                rows, q = pickle.loads(sent)
                least = np.array([best[r]["score"].iloc[-1] if r in best and len(best[r]) == top else -np.inf
                                  for r in rows.tolist()])
                wide = _fitted(q, here["v"].shape[1])
                for i, members in possible(here, q, top, least):
                    own = int(rows[i])
                    new = _best(here, own, wide[i], members, top)
                    if own in best:
                        new = pd.concat([best[own], new], ignore_index=True)
                        order = np.lexsort((new["row"], new["vec_id"], ~new["known"], -new["score"]))[:top]
                        new = new.iloc[order].reset_index(drop=True)
                    best[own] = new
        for own, rows in best.items():
            rows = rows.assign(query_row=own, vec_id=rows["vec_id"].where(rows["known"]).astype("Int64"))
            yield rows[["query_row", "score", "vec_id", "row"]]

    pairs = index.select("block").crossJoin(queries.select("queries"))
    return pairs.mapInPandas(found, "query_row long, score long, vec_id long, row long")


def top_rows(vectors: DataFrame, top: int = TOP, every: int = QUERY_STEP, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` highest integer inner products of every row of ``vectors``
    (vec_id, embedding) whose id is divisible by ``every`` with every row but itself, ties to the smaller vec_id.

    Components count as the whole part, rounded down, of ``scale`` times themselves. Vectors that are null or hold
    null or non-finite components take no part; an empty vector has score 0 with all. Vectors of different
    length are compared over the shorter one. Fewer than ``top`` other rows give all of them. Rows without id are
    candidates, behind all others of the same score, but no queries. Repeated rows are rows of their own: each
    is a candidate of the other, and each query row has its own result rows; among rows of one id the one
    written first goes first. No rows give no rows; other columns are ignored. Scaled components of 2^28 or more
    are an error, as products of them would not fit a long.
    """
    rows = settle(whole_vectors(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "whole-vectors")
    asked = rows.where(F.col("vec_id") % every == 0)
    queries, index = settle(query_blocks(asked), "query-blocks"), settle(build_index(rows), "impact-index")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    best = search(index, queries, top).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = asked.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"))
    return best.join(names, "query_row").select("query_id", "rank", "vec_id", "score")
