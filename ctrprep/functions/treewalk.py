"""Boosted trees as flat arrays, walked for many rows at once inside a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

NODE_COLUMNS = ("tree", "node", "left", "right", "feature", "threshold", "leaf_id")


@dataclass(frozen=True)
class Trees:
    """Some trees in flat arrays; a leaf leads to itself."""

    roots: np.ndarray
    depths: np.ndarray
    left: np.ndarray
    right: np.ndarray
    slot: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    features: np.ndarray

    @staticmethod
    def from_table(table: pa.Table) -> Trees:
        rows = {name: table.column(name).to_numpy() for name in NODE_COLUMNS if name != "leaf_id"}
        is_leaf = (rows["left"] == -1) & (rows["right"] == -1)
        if np.any(is_leaf & table.column("leaf_id").is_null().to_numpy()):
            raise ValueError("a leaf of the model has no id")
        leaf = table.column("leaf_id").fill_null(-1).to_numpy()
        order = np.lexsort((rows["node"], rows["tree"]))
        rows = {name: values[order] for name, values in rows.items()}
        leaf = leaf[order].astype(np.int64)
        if leaf.max(initial=0) >= 1 << 31:
            raise ValueError("leaf ids exceed 32 bits")
        tree, node = rows["tree"].astype(np.int64), rows["node"].astype(np.int64)
        place = (tree << 32) | node
        if np.any(place[1:] == place[:-1]):
            raise ValueError("the model repeats a node")
        ends = (rows["left"] == -1) & (rows["right"] == -1)
        here = np.arange(len(place))

        def child(side: str) -> np.ndarray:
            target = (tree << 32) | rows[side].astype(np.int64)
            found = np.minimum(np.searchsorted(place, target), len(place) - 1)
            if np.any(place[found[~ends]] != target[~ends]):
                raise ValueError("the model points to a missing node")
            if np.any(found[~ends] == here[~ends]):
                raise ValueError("the model has a cycle")
            return np.where(ends, here, found)

        roots = np.searchsorted(place, np.unique(tree) << 32)
        if np.any(node[roots] != 0):
            raise ValueError("a tree has no node 0")
        left, right = child("left"), child("right")
        features, slot = np.unique(np.where(ends, 0, rows["feature"]), return_inverse=True)
        threshold = rows["threshold"].astype(np.float32)
        return Trees(roots, _depths(roots, left, right), left, right, slot, threshold, leaf, features)

    def walk_vectors(self, numbers: pa.Array, values: pa.Array) -> np.ndarray:
        """Leaf ids of rows that each have lists of feature numbers and of their values."""
        row = np.repeat(np.arange(len(values)), values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        number, value = numbers.flatten().to_numpy(zero_copy_only=False), values.flatten()
        place = np.minimum(np.searchsorted(self.features, number), len(self.features) - 1)
        hit = np.flatnonzero(value.is_valid().to_numpy(zero_copy_only=False) & (self.features[place] == number))
        dense = np.zeros((len(self.features), len(values)), dtype=np.float32)
        dense[place[hit], row[hit]] = value.fill_null(0).to_numpy(zero_copy_only=False)[hit]
        return self.walk(dense)

    def walk(self, values: np.ndarray) -> np.ndarray:
        """Leaf ids, rows by trees, for a features-by-rows matrix."""
        count = values.shape[1]
        flat, row = values.ravel(), np.arange(count)
        offset = self.slot * count
        # The children of a node side by side, the right one first: one look-up a step.
        child = np.stack([self.right, self.left], axis=1).ravel()
        out = np.empty((count, len(self.roots)), dtype=np.int32)
        for k, (root, depth) in enumerate(zip(self.roots, self.depths)):
            at = np.full(count, root)
            for _ in range(depth):
                place = offset.take(at)
                place += row
                smaller = flat.take(place) < self.threshold.take(at)
                at *= 2
                at += smaller
                at = child.take(at)
            out[:, k] = self.leaf.take(at)
        return out


def matrix(trees: Trees, plan: Sequence[tuple[int | None, float | None]], columns: Sequence[pa.Array]) -> np.ndarray:
    """Features by rows from the columns of a plan: (feature, None) where a column holds the feature's value, (None, value) where it
    holds the number of a feature of that value."""
    values = np.zeros((len(trees.features), len(columns[0])), dtype=np.float32)
    for (feature, constant), column in zip(plan, columns):
        if feature is None:
            numbers = column.fill_null(-1).to_numpy(zero_copy_only=False)
            place = np.minimum(np.searchsorted(trees.features, numbers), len(trees.features) - 1)
            hit = np.flatnonzero(trees.features[place] == numbers)
            values[place[hit], hit] = constant
        else:
            place = np.searchsorted(trees.features, feature)
            if place < len(trees.features) and trees.features[place] == feature:
                given = column.fill_null(0).to_numpy(zero_copy_only=False)
                present = column.is_valid().to_numpy(zero_copy_only=False)
                values[place] = np.where(present, given, values[place])
    return values


def as_lists(leaves: np.ndarray) -> pa.ListArray:
    ends = np.arange(0, leaves.size + 1, leaves.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(leaves.ravel()))


def walk_cells(
    plan: Sequence[tuple[int | None, float | None]], kept: Sequence[str], most: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The ``kept`` columns of a cell's rows with their leaves.  The rows come before the nodes of the groups of trees, and wait, or
    after the nodes of a single group.  Besides the leaves of waiting rows at most ``most`` values are laid out at once."""

    def walked(trees: Trees, part: pa.RecordBatch) -> np.ndarray:
        at_once = max(1, most // len(trees.features))
        slices = [part.slice(at, at_once) for at in range(0, part.num_rows, at_once)]
        return np.concatenate([trees.walk(matrix(trees, plan, [x[f"__input{k}"] for k in range(len(plan))])) for x in slices])

    def finished(trees: Trees, part: pa.RecordBatch, found: Sequence[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """The rows with the leaves ``found`` before, and those in their last group."""
        at_once = max(1, most // (len(trees.roots) + sum(x.shape[1] for x in found)))
        for at in range(0, part.num_rows, at_once):
            some = part.slice(at, at_once)
            leaves = np.concatenate([*[x[at : at + at_once] for x in found], walked(trees, some)], axis=1)
            yield pa.RecordBatch.from_arrays([*some.select(list(kept)).columns, as_lists(leaves)], names=[*kept, "__leaves"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, leaves, held, now, trees = [], [], [], None, None
        for batch in batches:
            groups = batch["__node"].flatten()[0].fill_null(-1).to_numpy()
            cuts = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), len(groups)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                part, group = batch.slice(lo, hi - lo), groups[lo]
                if group == -1 and now is None:
                    rows.append(part.drop_columns(["__node"]))
                    leaves.append([])
                elif group == -1:
                    trees = trees or Trees.from_table(pa.Table.from_batches(held))
                    yield from finished(trees, part, [])
                else:
                    if rows and held and group != now:
                        trees, held = Trees.from_table(pa.Table.from_batches(held)), []
                        for given, found in zip(rows, leaves):
                            found.append(walked(trees, given))
                    now = group
                    held.append(pa.RecordBatch.from_struct_array(part["__node"]))
        if rows:
            trees = Trees.from_table(pa.Table.from_batches(held))
        while rows:
            yield from finished(trees, rows.pop(), leaves.pop())

    return run


def _depths(roots: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    depths = np.zeros(len(roots), dtype=np.int64)
    for k, root in enumerate(roots):
        level, depth = np.array([root]), 0
        while True:
            level = level[left[level] != level]
            if not len(level):
                break
            depth += 1
            level = np.concatenate([left[level], right[level]])
            if depth > len(left):
                raise ValueError("the model has a cycle")
        depths[k] = depth
    return depths
