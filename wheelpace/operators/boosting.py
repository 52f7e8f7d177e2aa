"""Gradient-boosted trees for two classes, grown leaf by leaf, with a state from which training goes on.

Every number column is cut into at most ``BINS`` bins. Rows with the same bins, class and side are one cell with
a count, so the cost of a round does not grow with copies. Cells are stored in blocks, a byte for each bin, so that
tasks work on arrays. A pass over the blocks sums gradient, Hessian and rows per open leaf, column and bin: every task
its own cells, one aggregation those of all tasks. Of two sibling leaves only the smaller one is
summed, the other is the rest of its parent. The next leaf to be split is always the one of highest gain, up
to a number of leaves and without a bound on depth. Leaves that can still become part of the tree are prepared
together, so a tree takes about as many passes as it has levels, not as it has leaves. A leaf that is down to
``TASK_CELLS`` cells is grown further by one task, all such leaves of a pass side by side, with the same sums
and the same rule.

Sums are of whole numbers that a double holds exactly, so a tree depends neither on the order of rows nor on
where its leaves were grown. What reaches the driver are the sums of one pass, at most open leaves x columns x
bins, and nodes.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wheelpace.session import discard, fresh_path, settle

BINS = 255
#: Fixed value: the smallest sum of Hessians of a leaf.
LEAST_HESSIAN = 1e-3
#: Cells up to which a leaf is grown further in one task, of about 50 bytes each.
TASK_CELLS = 500_000
#: Most cells of a block.
BLOCK_CELLS = 16_384
#: Whole numbers of a sum stay below two to this power, so that a double holds them.
_SUM_BITS = 53
#: Held-out losses are summed by this part, which leaves room for large ones.
_LOSS_PART = 64


@dataclass(frozen=True)
class Settings:
    """What shapes the trees; early stopping compares losses over ``patience`` rounds."""

    learning_rate: float = 0.08
    max_rounds: int = 250
    max_leaves: int = 31
    min_leaf_rows: int = 50
    l2: float = 1.0
    patience: int = 20
    gain: float = 1e-7


@dataclass(frozen=True)
class Tree:
    """Nodes by position, the root first. An inner node sends rows whose bin is at most ``cut`` to ``left``; a
    leaf has ``left`` = -1."""

    feature: tuple[int, ...]
    cut: tuple[int, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    value: tuple[float, ...]

    @property
    def depth(self) -> int:
        """Steps from the root to the farthest leaf; children stand behind their parents."""
        steps = [0] * len(self.left)
        for i, (a, b) in enumerate(zip(self.left, self.right, strict=True)):
            if a >= 0:
                steps[a] = steps[b] = steps[i] + 1
        return max(steps)


# --- bins and cells -------------------------------------------------------------------------------

def thresholds(rows: DataFrame, columns: list[str], bins: int = BINS) -> list[list[float]]:
    """Where each column is cut: between all its values if there are at most ``bins``, else at quantiles.

    Quantiles are approximate, to a ten-thousandth of the rows. Values must not be null.
    """
    fields = [x for i, c in enumerate(columns) for x in (F.lit(i), F.col(c).cast("double"))]
    values = settle(rows.select(F.stack(F.lit(len(columns)), *fields).alias("feature", "v")).distinct(), "feature-values")
    sizes = {r["feature"]: r["n"] for r in values.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    few = [i for i, n in sizes.items() if n <= bins]
    found: list[list[float]] = [[] for _ in columns]
    for r in values.where(F.col("feature").isin(few)).collect():  # at most ``bins`` values a column
        found[r["feature"]].append(r["v"])
    cuts = []
    for seen in map(sorted, found):
        cuts.append([a + (b - a) / 2 for a, b in zip(seen[:-1], seen[1:], strict=True)])
    if many := [i for i, n in sizes.items() if n > bins]:
        shares = [i / bins for i in range(1, bins)]
        row = rows.agg(*(F.percentile_approx(F.col(columns[i]).cast("double"), shares, 10_000).alias(str(i)) for i in many)).first()
        for i in many:
            cuts[i] = sorted(set(row[str(i)]))
    return cuts


def with_bins(rows: DataFrame, columns: list[str], cuts: list[list[float]], out: str = "bins") -> DataFrame:
    """``rows`` with the array ``out``: for each column the number of cuts that its value reaches."""
    cut = [i for i, c in enumerate(cuts) if c]
    named = {i: f"{out}_{i}" for i in cut}
    if cut:
        splits = [[-math.inf, *cuts[i], math.inf] for i in cut]
        rows = Bucketizer(splitsArray=splits, inputCols=[columns[i] for i in cut], outputCols=list(named.values())).transform(rows)
    each = [F.col(named[i]).cast("short") if i in named else F.lit(0).cast("short") for i in range(len(columns))]
    return rows.withColumn(out, F.array(*each)).drop(*named.values())


def cells(binned: DataFrame, label: str, held_out: str) -> DataFrame:
    """(bins, label, held_out, n): rows that training cannot tell apart, counted."""
    return binned.groupBy("bins", F.col(label).cast("int").alias("label"), F.col(held_out).alias("held_out")).agg(
        F.count("*").alias("n"))


# --- trees as columns -----------------------------------------------------------------------------

def walk(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The leaf of ``tree`` that each cell falls into; ``bins`` is (columns, cells)."""
    feature, cut, left, right = (np.array(x, np.int32) for x in (tree.feature, tree.cut, tree.left, tree.right))
    node = np.zeros(bins.shape[1], np.int32)
    rows = np.arange(bins.shape[1])
    if left[0] < 0:
        return node
    while len(rows):
        at = node[rows]
        node[rows] = at = np.where(bins[feature[at], rows] <= cut[at], left[at], right[at])
        rows = rows[left[at] >= 0]
    return node


def margins(trees: list[Tree], bins: np.ndarray) -> np.ndarray:
    """The sum of the leaf values of ``trees`` for each cell, added up in their order."""
    total = np.zeros(bins.shape[1])
    for tree in trees:
        total += np.array(tree.value)[walk(tree, bins)]
    return total


def _numbers(values, kind: str = "int") -> str:
    """An array literal as text: a call to Spark for each number takes longer than the pass that uses it."""
    return f"cast(split('{','.join(map(repr, values))}', ',') as array<{kind}>)"


def node_of(tree: Tree, bins: str) -> Column:
    """The leaf of ``tree`` that a row with the array ``bins`` falls into."""
    if tree.depth == 0:
        return F.lit(0)
    feature, cut, left, right = map(_numbers, (
        tree.feature, tree.cut, *([c if c >= 0 else i for i, c in enumerate(of)] for of in (tree.left, tree.right))))
    return F.expr(f"aggregate(sequence(1, {tree.depth}), 0, (node, level) -> if(get({bins}, get({feature}, node)) <= "
                  f"get({cut}, node), get({left}, node), get({right}, node)))")


def margin_of(trees: list[Tree], bins: str) -> Column:
    """The sum of the leaf values of ``trees`` for a row with the array ``bins``, in tasks over batches of rows."""
    if not trees:
        return F.lit(0.0)
    trees = list(trees)

    def total(rows: pa.Array) -> pa.Array:
        if not len(rows):
            return pa.array([], pa.float64())
        return pa.array(margins(trees, rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1).T))

    return F.arrow_udf(total, "double")(bins)


# --- growing one tree -----------------------------------------------------------------------------

@dataclass
class _Node:
    """Sums of a leaf (gradient, Hessian, rows, cells), by column and bin as far as needed, and its best split."""

    sums: np.ndarray
    histogram: np.ndarray | None = None  # (columns, bins, 4)
    gain: float = 0.0
    feature: int = 0
    cut: int = 0
    halves: tuple[np.ndarray, np.ndarray] | None = None
    children: tuple[int, int] | None = None

    def look(self, s: Settings) -> None:
        """Find the best split; ties go to the first column, then to the lowest cut."""
        left = np.cumsum(self.histogram, axis=1)[:, :-1]
        right = self.sums - left
        able = ((left[..., 2] >= s.min_leaf_rows) & (right[..., 2] >= s.min_leaf_rows)
                & (left[..., 1] >= LEAST_HESSIAN) & (right[..., 1] >= LEAST_HESSIAN))
        if not able.any():
            return
        gains = np.where(able, _quality(left, s) + _quality(right, s) - _quality(self.sums, s), -np.inf)
        at = int(np.argmax(gains))
        self.feature, self.cut = divmod(at, gains.shape[1])
        self.gain = float(gains[self.feature, self.cut])
        self.halves = (left[self.feature, self.cut], right[self.feature, self.cut])


def _quality(sums: np.ndarray, s: Settings) -> np.ndarray:
    return sums[..., 0] ** 2 / (sums[..., 1] + s.l2)


def _best_first(nodes: list[_Node], s: Settings, eager: bool = False) -> tuple[list[int], list[int]]:
    """Split nodes in the order of their gain: the nodes split, and those whose halves have to be known first.

    Without the latter the tree is complete. Else the walk goes on as if they were split into leaves, so that all
    that may still be asked for is asked for at once. With ``eager`` the halves of the last split are asked for, too.
    """
    split: list[int] = []
    unknown: list[int] = []
    queue = [(-nodes[0].gain, 0)]
    while queue and len(split) + len(unknown) + 1 < s.max_leaves and -queue[0][0] > 0:
        _, i = heapq.heappop(queue)
        if nodes[i].children is None:
            if eager or unknown or len(split) + 2 < s.max_leaves:
                unknown.append(i)
                continue
            nodes[i].children = (len(nodes), len(nodes) + 1)  # the last split: nothing is asked of its halves
            nodes += [_Node(half) for half in nodes[i].halves]
        split.append(i)
        for child in nodes[i].children:
            heapq.heappush(queue, (-nodes[child].gain, child))
    return split, unknown


def _as_tree(nodes: list[_Node], split: list[int], s: Settings) -> Tree:
    inner = set(split)
    order, at = [0], 0
    while at < len(order):
        if order[at] in inner:
            order += nodes[order[at]].children
        at += 1
    place = {node: i for i, node in enumerate(order)}
    rows = []
    for i in order:
        node = nodes[i]
        if i in inner:
            rows.append((node.feature, node.cut, place[node.children[0]], place[node.children[1]], 0.0))
        else:
            rows.append((0, 0, -1, -1, float(-s.learning_rate * node.sums[0] / (node.sums[1] + s.l2))))
    return Tree(*zip(*rows, strict=True))


@dataclass
class Boosting:
    """Where training stands: blocks of cells with their margin, gradient and Hessian, the trees and the held-out losses.

    ``losses`` has the loss before the first tree and after each one; it is empty if nothing is held out.
    """

    blocks: DataFrame  # cells of one side each, see ``_PACKED``
    weights: dict[int, float]
    total: float  # weighted rows
    columns: int
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)
    root: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)  # sums of all cells that are learned from
    path: str | None = None  # of the blocks, if this state has written them

    @property
    def grain(self) -> float:
        """Sums count whole parts of one of this size."""
        return 2.0 ** (_SUM_BITS - 6 - math.ceil(math.log2(max(2.0, self.total))))

    @property
    def cells(self) -> DataFrame:
        """(bins, label, held_out, n, margin, g, h), one row a cell."""
        columns = self.columns

        def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                bins, label, n, margin, g, h = _arrays(block, columns)
                size = len(label)
                lists = pa.ListArray.from_arrays(np.arange(0, size * columns + 1, max(1, columns), dtype=np.int32)[:size + 1],
                                                 pa.array(bins.T.astype(np.int16).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [lists, pa.array(label.astype(np.int32)), pa.array(np.full(size, block["held_out"])), *map(pa.array, (n, margin, g, h))],
                    names=["bins", "label", "held_out", "n", "margin", "g", "h"])

        return self.blocks.select(*_PACKED_NAMES).mapInArrow(
            unpacked, "bins array<short>, label int, held_out boolean, n long, margin double, g long, h long")

    def write(self, trees: list[Tree]) -> None:
        """Write the blocks with margins raised by ``trees`` and with the gradient and the Hessian of each cell.

        Of held-out cells these are the loss and the weight. The sums of the root and the loss are taken while
        writing. The table takes the place of the one before.
        """
        spark, old = self.blocks.sparkSession, self.path
        columns, grain = self.columns, self.grain
        weights = np.array([self.weights.get(label, np.nan) for label in (0, 1)])

        def raised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                bins, label, n, margin, *_ = _arrays(block, columns)
                margin = margin + margins(trees, bins)
                w, p = weights[label] * n, 1 / (1 + np.exp(-margin))
                if block["held_out"]:  # the loss of the true class, without overflow
                    away = np.where(label == 1, -margin, margin)
                    g, h = (np.maximum(away, 0) + np.log1p(np.exp(-np.abs(margin)))) / _LOSS_PART, np.full(len(w), 1.0 / _LOSS_PART)
                else:
                    g, h = p - label, p * (1 - p)
                g, h = (np.rint(x * w * grain).astype(np.int64) for x in (g, h))
                block |= {"margin": margin.tobytes(), "g": g.tobytes(), "h": h.tobytes(), "sum_g": int(g.sum()),
                          "sum_h": int(h.sum())}
                yield pa.RecordBatch.from_pylist([block], _WRITTEN)

        seen = Observation("sums")
        path = fresh_path(spark, "margins")
        rows = self.blocks.select(*(c for c in _PACKED_NAMES if c in self.blocks.columns)).mapInArrow(raised, _PACKED)
        rows.observe(seen, *(F.expr(f"coalesce(sum(if({'' if held else 'not '}held_out, {value}, 0L)), 0L) as {name}") for name, value, held in (
            ("g", "sum_g", False), ("h", "sum_h", False), ("n", "sum_n", False), ("cells", "size", False), ("loss", "sum_g", True),
            ("weight", "sum_h", True)))).write.parquet(path)
        found = seen.get
        self.root = (found["g"] / self.grain, found["h"] / self.grain, float(found["n"]), float(found["cells"]))
        if found["weight"]:
            self.losses.append(found["loss"] / found["weight"])
        self.blocks, self.path = _one_if_one(spark.read.schema(_PACKED).parquet(path)), path
        if old:
            discard(spark, old)

    def add(self, tree: Tree) -> None:
        self.trees.append(tree)
        self.write([tree])


#: Blocks as they are stored: arrays of one byte a bin, column by column, one a label, and eight a number.
_PACKED = ("held_out boolean, size long, sum_n long, bins binary, label binary, n binary, margin binary, g binary, h binary, "
           "sum_g long, sum_h long")
_PACKED_NAMES = [f.split()[0] for f in _PACKED.split(", ")]
_WRITTEN = pa.schema([(name, {"boolean": pa.bool_(), "long": pa.int64(), "binary": pa.binary()}[kind])
                      for name, kind in (f.split() for f in _PACKED.split(", "))])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One block after the other, so that no more than one is a Python object."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _arrays(block: dict, columns: int) -> tuple[np.ndarray, ...]:
    """Bins (columns, cells), label, n, margin, gradient and Hessian of a block, as far as it has them."""
    kinds = {"label": np.uint8, "n": np.int64, "margin": np.float64, "g": np.int64, "h": np.int64}
    found = [np.frombuffer(block[name], kind) if block.get(name) is not None else np.zeros(block["size"], kind)
             for name, kind in kinds.items()]
    return np.frombuffer(block["bins"], np.uint8).reshape(columns, block["size"]), *found


def packed(counted: DataFrame) -> DataFrame:
    """Blocks of cells (bins, label, held_out, n) of one side each, without margins, and how many rows of class 1 each has."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[bool, list[tuple[np.ndarray, ...]]] = {False: [], True: []}

        def block(held: bool) -> pa.RecordBatch:
            bins, label, n = (np.concatenate(parts) for parts in zip(*waiting[held], strict=True))
            waiting[held] = []
            return pa.RecordBatch.from_pydict({
                "held_out": [held], "size": [len(n)], "sum_n": [int(n.sum())], "bins": [bins.T.tobytes()], "label": [label.tobytes()],
                "n": [n.tobytes()], "ones": [int(n[label == 1].sum())]})

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_CELLS):
                part = batch.slice(at, BLOCK_CELLS)
                sides = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                bins = part.column("bins").flatten().to_numpy(zero_copy_only=False).astype(np.uint8).reshape(len(sides), -1)
                label, n = (part.column(c).to_numpy(zero_copy_only=False) for c in ("label", "n"))
                for held in (False, True):
                    of_side = sides == held
                    if not of_side.any():
                        continue
                    if sum(len(x[2]) for x in waiting[held]) + of_side.sum() > BLOCK_CELLS:
                        yield block(held)
                    waiting[held].append((bins[of_side], label[of_side].astype(np.uint8), n[of_side].astype(np.int64)))
        for held, parts in waiting.items():
            if parts:
                yield block(held)

    return counted.select("bins", "label", "held_out", "n").mapInArrow(
        pack, "held_out boolean, size long, sum_n long, bins binary, label binary, n binary, ones long")


def _one_if_one(df: DataFrame) -> DataFrame:
    """One partition needs no exchange; Spark knows that only if it is told."""
    return df.coalesce(1) if df.rdd.getNumPartitions() == 1 else df


def begin(counted: DataFrame, columns: int, weights: dict[int, float]) -> Boosting:
    """The state before the first tree: every margin is 0, the balanced classes' common start."""
    blocks = settle(packed(counted), "cells")
    ones, rows = blocks.agg(F.expr("coalesce(sum(ones), 0L)"), F.expr("coalesce(sum(sum_n), 0L)")).first()
    state = Boosting(blocks, weights, sum(n * weights[label] for label, n in ((0, rows - ones), (1, ones)) if n), columns)
    state.write([])
    return state


def _prepared(nodes: list[_Node]) -> Tree:
    """All prepared splits, whether or not they end up in the tree; node i stands at place i."""
    return Tree(*zip(*((n.feature, n.cut, *(n.children or (-1, -1)), 0.0) for n in nodes), strict=True))


def _slots(nodes: list[_Node], wanted: list[int]) -> np.ndarray:
    """For each node its place among the ``wanted`` ones, or -1."""
    slots = np.full(len(nodes), -1, np.int32)
    slots[wanted] = np.arange(len(wanted))
    return slots


def _learned(state: Boosting) -> DataFrame:
    return state.blocks.where("not held_out").select("size", "bins", "n", "g", "h")


def _histograms(state: Boosting, nodes: list[_Node], wanted: list[int]) -> np.ndarray:
    """(wanted, columns, bins, 4) sums of cells: every task sums its own, one aggregation those of the tasks."""
    width, columns = BINS + 1, state.columns
    tree, slots, count = _prepared(nodes), _slots(nodes, wanted), len(wanted)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, columns, count * width))
        for block in _blocks(batches):
            bins, _, n, _, g, h = _arrays(block, columns)
            slot = slots[walk(tree, bins)]
            rows = np.flatnonzero(slot >= 0)
            start, values = slot[rows] * width, [x[rows].astype(float) for x in (g, h, n)]
            for feature in range(columns):
                at = start + bins[feature, rows]
                for total, value in zip(sums[:, feature], (*values, None), strict=True):
                    total += np.bincount(at, value, count * width)
        feature, at = np.nonzero(sums[3])
        yield pa.RecordBatch.from_arrays(
            [pa.array((at // width * columns + feature) * width + at % width),
             *(pa.array(x[feature, at].astype(np.int64)) for x in sums)], names=["at", "g", "h", "n", "cells"])

    found = _learned(state).mapInArrow(summed, "at long, g long, h long, n long, cells long").groupBy("at").agg(
        F.expr("sum(g) as g"), F.expr("sum(h) as h"), F.expr("sum(n) as n"), F.expr("sum(cells) as cells")).toArrow()
    at, g, h, n, cells_ = (found[c].to_numpy() for c in ("at", "g", "h", "n", "cells"))
    out = np.zeros((count * columns * width, 4))
    out[at] = np.stack([g / state.grain, h / state.grain, n, cells_], axis=1)
    return out.reshape(count, columns, width, 4)


_SUBTREE = ("slot int, place int, g double, h double, n double, cells double, gain double, feature int, cut int, "
            "left int, right int")


def _subtrees(state: Boosting, nodes: list[_Node], wanted: list[int], s: Settings) -> dict[int, list[_Node]]:
    """For each wanted leaf, of at most ``TASK_CELLS`` cells, the nodes it can become, grown by one task."""
    grain, columns = state.grain, state.columns
    tree, slots = _prepared(nodes), _slots(nodes, wanted)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            bins, _, n, _, g, h = _arrays(block, columns)
            slot = slots[walk(tree, bins)]
            order = np.argsort(slot, kind="stable")
            found, first = np.unique(slot[order], return_index=True)
            parts = [(k, rows) for k, rows in zip(found.tolist(), np.split(order, first[1:]), strict=True) if k >= 0]
            yield pa.RecordBatch.from_pydict({
                "slot": pa.array([k for k, _ in parts], pa.int32()), "size": pa.array([len(rows) for _, rows in parts], pa.int64()),
                **{name: pa.array([x[..., rows].tobytes() for _, rows in parts], pa.binary())
                   for name, x in (("bins", bins), ("n", n), ("g", g), ("h", h))}})

    def grow(parts: pd.DataFrame) -> pd.DataFrame:
        cells_ = [_arrays(block, columns) for block in parts.to_dict("records")]
        bins, _, n, _, g, h = (np.concatenate(x, axis=-1) for x in zip(*cells_, strict=True))
        values = np.stack([g / grain, h / grain, n.astype(float), np.ones(len(n))])
        grown = grow_in_task(bins, values, columns, s)
        return pd.DataFrame([(parts["slot"].iloc[0], i, *node.sums, node.gain, node.feature, node.cut, *(node.children or (-1, -1)))
                             for i, node in enumerate(grown)], columns=[f.split()[0] for f in _SUBTREE.split(", ")])

    out: dict[int, list[_Node]] = {i: [] for i in wanted}
    leaves = _learned(state).mapInArrow(chosen, "slot int, size long, bins binary, n binary, g binary, h binary")
    for r in sorted(leaves.groupBy("slot").applyInPandas(grow, _SUBTREE).collect(), key=lambda r: (r["slot"], r["place"])):
        children = (r["left"], r["right"]) if r["left"] >= 0 else None
        out[wanted[r["slot"]]].append(_Node(np.array([r["g"], r["h"], r["n"], r["cells"]]), gain=r["gain"], feature=r["feature"],
                                            cut=r["cut"], children=children))
    return out


def grow_in_task(bins: np.ndarray, values: np.ndarray, columns: int, s: Settings) -> list[_Node]:
    """Nodes of a leaf's best splits, up to all leaves of a tree. ``bins`` is (columns, cells); ``values`` has gradient,
    Hessian, rows and cells of each."""
    def histogram(rows: np.ndarray) -> np.ndarray:
        out, of_rows = np.empty((columns, BINS + 1, 4)), values[:, rows]
        for feature in range(columns):
            at = bins[feature, rows]
            for k in range(4):
                out[feature, :, k] = np.bincount(at, of_rows[k], BINS + 1)
        return out

    nodes, members = [_Node(values.sum(axis=1))], [np.arange(bins.shape[1])]
    nodes[0].histogram = histogram(members[0])
    nodes[0].look(s)
    while True:
        _, unknown = _best_first(nodes, s, eager=True)
        if not unknown:
            return nodes
        i = unknown[0]
        node, rows = nodes[i], members[i]
        low = bins[node.feature, rows] <= node.cut
        node.children = (len(nodes), len(nodes) + 1)
        nodes += [_Node(half) for half in node.halves]
        members += [rows[low], rows[~low]]
        small, large = sorted(node.children, key=lambda c: len(members[c]))
        nodes[small].histogram = histogram(members[small])
        nodes[large].histogram = node.histogram - nodes[small].histogram
        node.histogram = None
        for child in node.children:
            nodes[child].look(s)


def grow_tree(state: Boosting, s: Settings) -> Tree:
    """One more tree for the margins of ``state``."""
    nodes = [_Node(np.array(state.root))]
    if nodes[0].sums[3] > TASK_CELLS:
        nodes[0].histogram = _histograms(state, nodes, [0])[0]
        nodes[0].look(s)
    elif nodes[0].sums[3]:
        _graft(nodes, _subtrees(state, nodes, [0], s))
    while True:
        split, unknown = _best_first(nodes, s)
        if not unknown:
            return _as_tree(nodes, split, s)
        pairs = []
        for i in unknown:
            nodes[i].children = (len(nodes), len(nodes) + 1)
            nodes += [_Node(half) for half in nodes[i].halves]
            pairs.append((i, *sorted(nodes[i].children, key=lambda c: nodes[c].sums[3])))
        summed = [(i, small, large) for i, small, large in pairs if nodes[large].sums[3] > TASK_CELLS]
        in_tasks = [c for _, *halves in pairs for c in halves if nodes[c].sums[3] <= TASK_CELLS]
        with ThreadPoolExecutor(1) as beside:  # both jobs read the same blocks and wait for nothing of each other
            growing = beside.submit(_subtrees, state, nodes, in_tasks, s) if in_tasks else None
            found = _histograms(state, nodes, [small for _, small, _ in summed]) if summed else []
            grown = growing.result() if growing else {}
        for (i, small, large), histogram in zip(summed, found, strict=True):
            nodes[large].histogram = nodes[i].histogram - histogram
            nodes[large].look(s)
            if nodes[small].sums[3] > TASK_CELLS:
                nodes[small].histogram = histogram
                nodes[small].look(s)
        for i, *_ in pairs:
            nodes[i].histogram = None
        _graft(nodes, grown)


def _graft(nodes: list[_Node], grown: dict[int, list[_Node]]) -> None:
    """Put each subtree in the place of its leaf."""
    for leaf, (top, *rest) in grown.items():
        moved = len(nodes) - 1  # node k > 0 of the subtree comes to stand at moved + k
        for node in (top, *rest):
            if node.children:
                node.children = (node.children[0] + moved, node.children[1] + moved)
        nodes[leaf] = top
        nodes += rest


# --- boosting -------------------------------------------------------------------------------------

def ended(losses: list[float], patience: int, gain: float) -> bool:
    """Whether none of the last ``patience`` losses is better by ``gain`` than the one before them."""
    return len(losses) > patience and min(losses[-patience:]) >= losses[-patience - 1] - gain


def boost(state: Boosting, s: Settings) -> Boosting:
    """Add trees up to ``max_rounds`` or until the held-out loss has stopped falling. Every tree is grown once;
    a state that was saved and loaded goes on where it was."""
    while len(state.trees) < s.max_rounds and not ended(state.losses, s.patience, s.gain):
        tree = grow_tree(state, s)
        if len(tree.left) == 1:  # nothing can be split any more
            break
        state.add(tree)
    return state


# --- stored trees ---------------------------------------------------------------------------------

_TREES = "tree int, node int, feature int, cut int, left int, right int, value double"
_CUTS = "position int, feature string, cuts array<double>"
_STATE = "weights map<int,double>, total double, columns int, losses array<double>, root array<double>"


def save_trees(spark: SparkSession, trees: list[Tree], path: str) -> None:
    rows = [(t, i, *node) for t, tree in enumerate(trees) for i, node in enumerate(
        zip(tree.feature, tree.cut, tree.left, tree.right, tree.value, strict=True))]
    spark.createDataFrame(rows, _TREES).coalesce(1).write.mode("overwrite").parquet(path)


def load_trees(spark: SparkSession, path: str) -> list[Tree]:
    nodes: dict[int, list] = {}
    for r in spark.read.schema(_TREES).parquet(path).orderBy("tree", "node").collect():  # rounds x leaves
        nodes.setdefault(r["tree"], []).append(tuple(r)[2:])
    return [Tree(*zip(*nodes[t], strict=True)) for t in sorted(nodes)]


def save_state(state: Boosting, path: str) -> str:
    """Margins, trees and losses under one folder: what :func:`boost` needs to go on."""
    spark = state.blocks.sparkSession
    state.blocks.write.mode("overwrite").parquet(f"{path}/blocks")
    save_trees(spark, state.trees, f"{path}/trees")
    row = (state.weights, state.total, state.columns, state.losses, list(state.root))
    spark.createDataFrame([row], _STATE).coalesce(1).write.mode("overwrite").parquet(f"{path}/state")
    return path


def load_state(spark: SparkSession, path: str) -> Boosting:
    row = spark.read.schema(_STATE).parquet(f"{path}/state").first()
    stored = _one_if_one(spark.read.schema(_PACKED).parquet(f"{path}/blocks"))
    return Boosting(stored, dict(row["weights"]), row["total"], row["columns"], load_trees(spark, f"{path}/trees"),
                    list(row["losses"]), tuple(row["root"]))


@dataclass(frozen=True)
class LeafTrees:
    """Trees with the cuts of the number columns they read."""

    columns: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    trees: tuple[Tree, ...]

    @property
    def getNumTrees(self) -> int:  # noqa: N802  the name Spark's own models use
        return len(self.trees)

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``prediction``, 1.0 where the sum of the leaf values is above zero."""
        binned = with_bins(rows, list(self.columns), [list(c) for c in self.cuts], "x_bins")
        margin = margin_of(list(self.trees), "x_bins")
        return binned.withColumn("prediction", (margin > 0).cast("double")).drop("x_bins")

    def save(self, spark: SparkSession, path: str) -> None:
        save_trees(spark, list(self.trees), f"{path}/nodes")
        rows = [(i, c, list(cuts)) for i, (c, cuts) in enumerate(zip(self.columns, self.cuts, strict=True))]
        spark.createDataFrame(rows, _CUTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/cuts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LeafTrees:
        cuts = spark.read.schema(_CUTS).parquet(f"{path}/cuts").orderBy("position").collect()  # one row a column
        return LeafTrees(tuple(r["feature"] for r in cuts), tuple(tuple(r["cuts"]) for r in cuts),
                         tuple(load_trees(spark, f"{path}/nodes")))


def fit(encoded: DataFrame, columns: list[str], label: str, held_out: str, weights: dict[int, float],
        settings: Settings = Settings()) -> tuple[LeafTrees, Boosting]:
    """Trees over the number ``columns`` of ``encoded``; rows with ``held_out`` only decide when to stop."""
    learned = encoded.where(~F.col(held_out))
    cuts = thresholds(learned, columns)
    counted = cells(with_bins(encoded, columns, cuts), label, held_out)
    state = boost(begin(counted, len(columns), weights), settings)
    return LeafTrees(tuple(columns), tuple(map(tuple, cuts)), tuple(state.trees)), state
