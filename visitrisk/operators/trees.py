"""Regression trees on binned rows: one pass over the rows for each level of a tree.

Columns are cut into bins once, whatever the number of trees. The rows then travel as blocks of NumPy arrays, a byte or
two for each feature. A level's pass adds up the residuals of every open node by column and bin; the sums of a node meet
in one task, which chooses the node's split, so the driver gets one row per node.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Of the sum of squares of a node's residuals, a split must take away more than rounding does.
LEAST_GAIN = 1e-12
# Ranks of quantiles are exact to this part of the rows.
QUANTILE_ACCURACY = 10_000


@dataclass(frozen=True)
class Block:
    """Some rows: the bin of each column (columns by rows), whether the row is for training, what is left of its label."""

    bins: np.ndarray
    training: np.ndarray
    residual: np.ndarray


@dataclass(frozen=True)
class Draw:
    """The share of training rows that a tree sees. A row is drawn by its place, alike in each pass."""

    share: float
    seed: tuple[int, ...]

    def rows(self, block: Block, *place: int) -> np.ndarray:
        if self.share >= 1:
            return block.training
        return block.training & (np.random.default_rng((*self.seed, *place)).random(len(block.training)) < self.share)


@dataclass
class Tree:
    """Nodes by number, from the root 0. A node without a column is a leaf; of another's children, rows beyond ``cut``
    go to ``child + 1``, all others to ``child``."""

    depth: int = 0
    column: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    child: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    # Number, sum and sum of squares of the residuals of each node's rows.
    stats: list[np.ndarray] = field(default_factory=lambda: [np.zeros(3)])

    def split(self, node: int, column: int, cut: int, gain: float, left: np.ndarray) -> list[int]:
        first = len(self.column)
        self.column[node], self.cut[node], self.child[node], self.gain[node] = column, cut, first, gain
        for stats in (left, self.stats[node] - left):
            self.column.append(-1)
            self.cut.append(0)
            self.child.append(0)
            self.gain.append(0.0)
            self.stats.append(stats)
        return [first, first + 1]

    def values(self, penalty: float) -> np.ndarray:
        """The value of each node as a leaf: its sum over its number of rows plus ``penalty``."""
        n, total = np.array(self.stats)[:, :2].T
        return np.divide(total, n + penalty, out=np.zeros(len(n)), where=n + penalty > 0)

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf, or open node, of each row."""
        column, cut, child = np.array(self.column), np.array(self.cut), np.array(self.child)
        at, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        for _ in range(self.depth):
            split = column[at]
            at = np.where(split < 0, at, child[at] + (bins[split, rows] > cut[at]))
        return at


def _numbers(names: Sequence[str]) -> list[Column]:
    return [F.col(c).cast("double") for c in names]


def cut_points(training: DataFrame, names: Sequence[str], bins: int) -> list[np.ndarray]:
    """The thresholds of each column, ascending: a value belongs to the first that is no less.

    Between all neighbouring values where there are about ``bins`` or fewer, else at quantiles of all rows. NaN and NULL,
    which lie beyond every threshold, take no part. Two passes.
    """
    known = [F.when(~F.isnan(x), x) for x in _numbers(names)]
    sizes = training.agg(*[F.approx_count_distinct(x).alias(f"n{i}") for i, x in enumerate(known)]).first()
    few = [sizes[f"n{i}"] <= bins for i in range(len(names))]
    shares = [k / bins for k in range(1, bins)]
    found = training.agg(
        *[
            (F.collect_set(x) if few[i] else F.percentile_approx(x, shares, QUANTILE_ACCURACY)).alias(f"c{i}")
            for i, x in enumerate(known)
        ]
    ).first()
    points = [np.unique(np.array(found[f"c{i}"] or [], np.float64)) for i in range(len(names))]
    return [_between(p) if few[i] else p for i, p in enumerate(points)]


def _between(values: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore"):
        middle = values[:-1] / 2 + values[1:] / 2
    # The middle of two neighbours that are infinite or next to each other may not lie between them.
    return np.where((middle >= values[:-1]) & (middle < values[1:]), middle, values[:-1])


def blocks(rows: DataFrame, names: Sequence[str], label: str, training: Column, points: Sequence[np.ndarray]) -> RDD:
    """The rows as an RDD of :class:`Block`, their labels as residuals; a block is an Arrow batch."""
    kind = np.min_scalar_type(max(map(len, points)))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            *features, labels, sides = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            # Not a number is greater than every threshold.
            bins = np.stack([np.searchsorted(p, x) for p, x in zip(points, features)]).astype(kind)
            parts = (bins, sides.astype(bool), labels.astype(np.float64))
            yield pa.record_batch([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["bins", "training", "label"])

    def unpack(row) -> Block:
        training = np.frombuffer(row["training"], bool)
        return Block(np.frombuffer(row["bins"], kind).reshape(-1, len(training)), training, np.frombuffer(row["label"]))

    numbers = [x.alias(f"f{i}") for i, x in enumerate(_numbers(names))]
    flat = rows.select(*numbers, F.col(label).alias("label"), training.alias("training"))
    return flat.mapInArrow(cut, "bins binary, training binary, label binary").rdd.map(unpack)


def _best_split(sums: np.ndarray) -> tuple[np.ndarray, float, int, int, np.ndarray]:
    """A node's statistics; the variance its best split takes away, times its rows; that split's column and bin, and
    the statistics left of it. ``sums``: columns by bins by (number, sum, sum of squares)."""
    total = sums[0].sum(axis=0)
    left = np.cumsum(sums, axis=1)
    right = total - left
    both = (left[..., 0] > 0) & (right[..., 0] > 0)
    n_left, n_right = np.where(both, left[..., 0], 1), np.where(both, right[..., 0], 1)
    explained = left[..., 1] ** 2 / n_left + right[..., 1] ** 2 / n_right - total[1] ** 2 / max(total[0], 1)
    column, bin_ = np.unravel_index(np.argmax(np.where(both, explained, -np.inf)), both.shape)
    gain = explained[column, bin_] if both[column, bin_] else 0.0
    return total, float(gain), int(column), int(bin_), left[column, bin_]


def fit_tree(
    rows: RDD, columns: Sequence[int], n_bins: int, max_depth: int, draw: Draw, histogram_bytes: int
) -> Tree:
    """A tree on the residuals of the drawn rows that splits on ``columns`` only, by variance.

    The sums of all open nodes of a level are taken in one pass, or in as many as ``histogram_bytes`` in a task asks for.
    """
    tree, open_ = Tree(), [0]
    at_once = max(1, histogram_bytes // (len(columns) * n_bins * 3 * 8))
    for depth in range(max(1, max_depth)):
        found = {}
        for start in range(0, len(open_), at_once):
            found.update(_splits(rows, tree, open_[start : start + at_once], columns, n_bins, draw))
        if depth == 0 and found:
            tree.stats[0] = found[0][0]
        children = []
        for node in open_ if max_depth else []:
            stats, gain, column, cut, left = found.get(node, (np.zeros(3), 0.0, 0, 0, None))
            if gain > LEAST_GAIN * stats[2]:
                children += tree.split(node, columns[column], cut, gain / stats[0], left)
        if not children:
            break
        tree.depth, open_ = depth + 1, children
    return tree


def _splits(rows: RDD, tree: Tree, nodes: Sequence[int], columns: Sequence[int], n_bins: int, draw: Draw) -> list[tuple]:
    """``(node, its best split)`` for each of ``nodes`` that has rows."""
    slots = np.full(len(tree.column), -1)
    slots[list(nodes)] = np.arange(len(nodes))

    def add_up(part: int, found: Iterable[Block]) -> Iterator[tuple[int, np.ndarray]]:
        sums, seen = np.zeros((3, len(columns), len(nodes) * n_bins)), np.zeros(len(nodes), bool)
        for k, block in enumerate(found):
            slot = slots[tree.nodes_of(block.bins)]
            taken = np.flatnonzero(draw.rows(block, part, k) & (slot >= 0))
            slot, residual = slot[taken], block.residual[taken]
            seen[slot] = True
            squares = residual * residual
            for i, column in enumerate(columns):
                key = slot * n_bins + block.bins[column, taken]
                for channel, weights in enumerate((None, residual, squares)):
                    sums[channel, i] += np.bincount(key, weights, sums.shape[2])
        by_node = sums.reshape(3, len(columns), len(nodes), n_bins).transpose(2, 1, 3, 0)
        for s in np.flatnonzero(seen):
            yield int(nodes[s]), by_node[s]

    tasks = min(len(nodes), rows.getNumPartitions())
    return rows.mapPartitionsWithIndex(add_up).reduceByKey(np.add, tasks).mapValues(_best_split).collect()


def boosted(rows: RDD, tree: Tree, values: np.ndarray) -> RDD:
    """The rows with each one's value, by its leaf, taken off its residual."""
    return rows.map(lambda b: Block(b.bins, b.training, b.residual - values[tree.nodes_of(b.bins)]))


def mean_squares(rows: RDD) -> tuple[float, float]:
    """The mean squared residual of the training rows and of the others; infinite where there are none."""

    def of(block: Block) -> np.ndarray:
        squares = block.residual * block.residual
        return np.array([[squares[side].sum(), side.sum()] for side in (block.training, ~block.training)])

    found = rows.map(of).fold(np.zeros((2, 2)), np.add)
    return tuple(float(total / n) if n else float("inf") for total, n in found)
