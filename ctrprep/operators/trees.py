"""Boosted-tree leaf encoding: which leaf of every tree a row ends in."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrprep.functions import treewalk
from ctrprep.functions.treewalk import NODE_COLUMNS, Trees, as_lists, matrix, walk_cells
from ctrprep.operators.ranking import store_ranked, with_row_index
from ctrprep.sources.scratch import store

# Trees are shipped to the executors in groups of about this many nodes, some
# tens of megabytes; a larger model takes several groups.
GROUP_NODES = 1_000_000
# A model of more nodes than this stays a table, whose groups the rows meet by an exchange.
SHIPPED_NODES = 20_000_000
# Cells of the features-by-rows matrix that a walk over vectors lays out at once.
DENSE_CELLS = 4_000_000
# Bytes of rows and leaves that a task of the exchange holds at once.
CELL_BYTES = 64_000_000
# Runs of neighbours among the rows of such a task.
CELL_RUNS = 256
# Columns that go to the Python workers and back unchanged.
_FLAT = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

# The walk travels to the Python workers as code, so that they need not have
# this package on their path.
cloudpickle.register_pickle_by_value(treewalk)


@dataclass(frozen=True)
class TreeInput:
    """One feature of the rows: a fixed ``feature`` whose value is ``column``, or
    a ``column`` that holds the feature number, with the constant ``value``."""

    column: str
    feature: int | None = None
    value: float | None = None


def parse_inputs(text: str, columns: Sequence[str]) -> list[TreeInput]:
    """``"f1:1,9:g1"``: column ``f1`` names a feature of value 1, feature 9 has
    the value of column ``g1``."""
    inputs = []
    for item in text.split(","):
        left, _, right = (piece.strip() for piece in item.partition(":"))
        if left in columns:
            inputs.append(TreeInput(left, value=float(right)))
        elif right in columns:
            inputs.append(TreeInput(right, feature=int(left)))
        else:
            raise ValueError(f"tree input {item!r} names no column of {list(columns)}")
    return inputs


def number_leaves(nodes: DataFrame, offset: int = 0) -> DataFrame:
    """Add ``leaf_id`` to the nodes of a model: leaves count up from ``offset`` in
    file order, inner nodes have none.

    The nodes are stored first.  What tells them apart may depend on how the file
    is split when it is read, so they must not be read once for the numbers and
    again for the rest."""
    nodes = store(nodes, "model")
    is_leaf = (F.col("left") == -1) & (F.col("right") == -1)
    leaves = nodes.where(is_leaf).select("section", "line")
    numbered = with_row_index(store_ranked(leaves, ["section", "line"], "leaves"), "leaf_id", offset)
    return nodes.join(numbered, ["section", "line"], "left")


def node_table(nodes: DataFrame) -> DataFrame:
    """The columns a walk needs."""
    return nodes.select(*NODE_COLUMNS)


def encode_leaves(
    df: DataFrame, nodes: DataFrame, inputs: Sequence[TreeInput], to: str = "leaves", outputs: int | None = None
) -> DataFrame:
    """Add ``to``: the leaf ids of a row as an array, in tree order.

    From node 0 a feature below the threshold (in single precision) leads left,
    any other right; absent and NULL features count as 0.  ``outputs`` is the
    number of trees the caller has room for.  The model is sent to the tasks,
    unless it has more than ``SHIPPED_NODES`` nodes.
    """
    sizes = _tree_sizes(nodes)
    if sum(n for _, n in sizes) > SHIPPED_NODES:
        return exchange_leaves(df, nodes, inputs, to, outputs)
    return df.withColumn(to, _all_leaves(list(_tree_groups(nodes, sizes)), inputs, outputs))


def exchange_leaves(
    df: DataFrame,
    nodes: DataFrame,
    inputs: Sequence[TreeInput],
    to: str = "leaves",
    outputs: int | None = None,
    group_nodes: int | None = None,
    cells: int | None = None,
) -> DataFrame:
    """The same for a model of any size, which neither the driver nor a task holds whole.

    Rows are stored and dealt out once, whole, to cells, where they wait for the groups of trees, which come one after another.
    A task holds one group, and the rows of a cell with their leaves unless there is only one group.  Where the model has more
    than ``GROUP_NODES`` nodes, or rows hold nested columns, the rows' numbers and inputs are dealt out instead, once for each
    group, and the leaves come back by row number in the order of the groups.  ``cells`` is the number of tasks that share the
    rows; without it see :func:`_cell_count`, or all groups together take the configured shuffle partitions.
    """
    sizes = _tree_sizes(nodes)
    if not sizes:
        raise ValueError("the model has no trees")
    if outputs is not None and outputs != len(sizes):
        raise ValueError(f"{outputs} outputs for {len(sizes)} trees")
    groups = _tree_ranges(sizes, group_nodes)
    given = [column.alias(f"__input{k}") for k, column in enumerate(_cast_inputs(inputs))]
    small = len(groups) == 1 or sum(n for _, n in sizes) <= GROUP_NODES
    if whole := small and all(isinstance(field.dataType, _FLAT) for field in df.schema):
        # The inputs are among the columns, so that they come on top only for the walk.
        asking = rows = store(df, "tree-rows")
        band, number = F.lit(0), F.monotonically_increasing_id()
        kept, named = df.columns, given
    else:
        rows = store(df.withColumn("__row", F.monotonically_increasing_id()), "tree-rows")
        asking = rows.select("__row", F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1))).alias("__band"), *given)
        band, number = F.col("__band"), F.col("__row")
        kept, named = ["__row", "__band"], [f"__input{k}" for k in range(len(given))]
    # A band is what a row meets in one place.
    bands = [0] * len(groups) if whole else list(range(len(groups)))
    waiting = whole and len(groups) > 1
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Texts are the columns of a whole row whose width is not known.
    texts = [c for c in kept if waiting and isinstance(asking.schema[c].dataType, (T.StringType, T.BinaryType))]
    count, *lengths = rows.agg(F.count(F.lit(1)), *[F.sum(F.octet_length(c)) for c in texts]).first()
    if not cells and waiting:
        width = 8 * len(kept) + sum(n or 0 for n in lengths) // max(1, count)
        cells = _cell_count(count, width, sizes, partitions)
    cells = cells or max(1, partitions // (bands[-1] + 1))

    # Neighbours are dealt out in short runs, which compress better than single rows.
    run = F.floor(number / max(1, count // cells // CELL_RUNS))
    asking = asking.withColumn("__cell", (band * cells + F.pmod(F.xxhash64(run), F.lit(cells))).cast("int"))
    both = asking.unionByName(_dealt_nodes(nodes, groups, bands, cells, min(cells, partitions)), allowMissingColumns=True)
    group = F.col("__node.group")
    dealt = both.repartitionById((bands[-1] + 1) * cells, F.col("__cell"))
    dealt = dealt.sortWithinPartitions(group.asc_nulls_first() if waiting else group.asc_nulls_last())
    schema = T.StructType([asking.schema[name] for name in kept]).add("__leaves", T.ArrayType(T.IntegerType()))
    walk = walk_cells([(i.feature, i.value) for i in inputs], kept, DENSE_CELLS)
    walked = dealt.select("__node", *kept, *named).mapInArrow(walk, schema)
    if whole:
        return walked.select(*df.columns, F.col("__leaves").alias(to))
    gathered = walked.groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("__band", "__leaves"))).alias("__parts"))
    leaves = F.flatten(F.transform("__parts", lambda part: part["__leaves"]))
    return rows.join(gathered, "__row").select(*df.columns, leaves.alias(to))


def encode_vector(df: DataFrame, nodes: DataFrame, vector: str, to: str = "leaves") -> DataFrame:
    """The same for features in one column: an array indexed by feature number, or
    a map from it."""
    groups = list(_tree_groups(nodes))
    if not groups:
        raise ValueError("the model has no trees")
    is_map = isinstance(df.schema[vector].dataType, T.MapType)
    leaves = [_leaves_of_vector(trees, vector, is_map) for trees in groups]
    return df.withColumn(to, leaves[0] if len(leaves) == 1 else F.concat(*leaves))


def leaf_columns(df: DataFrame, outputs: Sequence[str], leaves: str = "leaves") -> DataFrame:
    """One column per tree from the array ``leaves``."""
    return df.withColumns({name: F.get(leaves, F.lit(k)) for k, name in enumerate(outputs)}).drop(leaves)


def output_names(pattern: str, count: int | None = None) -> list[str]:
    """``"leaf%d"`` and a count, or a plain comma list."""
    if "%d" in pattern:
        if count is None:
            raise ValueError(f"outputs {pattern!r} need output_num")
        return [pattern.replace("%d", str(k)) for k in range(count)]
    return [name.strip() for name in pattern.split(",")]


def _tree_sizes(nodes: DataFrame) -> list[tuple[int, int]]:
    """The trees, in order, with their numbers of nodes."""
    return sorted((r["tree"], r["n"]) for r in nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).collect())


def _tree_ranges(sizes: Sequence[tuple[int, int]], group_nodes: int | None = None) -> list[tuple[int, int]]:
    """First and last tree of groups of about ``group_nodes`` nodes, by default ``GROUP_NODES``."""
    ranges, first, held = [], 0, 0
    for at, (tree, n) in enumerate(sizes):
        held += n
        if held >= (group_nodes or GROUP_NODES) or at == len(sizes) - 1:
            ranges.append((sizes[first][0], tree))
            first, held = at + 1, 0
    return ranges


def _cell_count(rows: int, width: int, sizes: Sequence[tuple[int, int]], partitions: int) -> int:
    """How many cells share rows of about ``width`` bytes that wait for all groups: so many that a cell's rows and leaves take about
    ``CELL_BYTES``.  Beyond that they are as many as ``partitions``, unless a cell would have fewer rows than nodes come to it."""
    needed = -(-rows * (width + 4 * len(sizes)) // CELL_BYTES)
    return max(1, needed, min(partitions, rows // sum(n for _, n in sizes)))


def _dealt_nodes(nodes: DataFrame, groups: Sequence[tuple[int, int]], bands: Sequence[int], cells: int, tasks: int) -> DataFrame:
    """The nodes with their group, once for each cell of its band; that many ``tasks`` make the copies."""
    ranges = [(k, band, *group) for k, (band, group) in enumerate(zip(bands, groups))]
    ranges = F.broadcast(nodes.sparkSession.createDataFrame(ranges, "group int, band int, first int, last int"))
    placed = node_table(nodes).join(ranges, F.col("tree").between(F.col("first"), F.col("last"))).repartition(tasks, "tree", "node")
    cell = F.explode(F.sequence(F.col("band") * cells, F.col("band") * cells + F.lit(cells - 1)))
    return placed.select(F.struct("group", *NODE_COLUMNS).alias("__node"), cell.alias("__cell"))


def _tree_groups(nodes: DataFrame, sizes: Sequence[tuple[int, int]] | None = None) -> Iterator[Trees]:
    """The model as arrays, a group at a time."""
    for first, last in _tree_ranges(_tree_sizes(nodes) if sizes is None else sizes):
        yield Trees.from_table(node_table(nodes.where(F.col("tree").between(first, last))).toArrow())


def _all_leaves(groups: Sequence[Trees], inputs: Sequence[TreeInput], outputs: int | None = None) -> Column:
    if not groups:
        raise ValueError("the model has no trees")
    count = sum(len(trees.roots) for trees in groups)
    if outputs is not None and outputs != count:
        raise ValueError(f"{outputs} outputs for {count} trees")
    leaves = [_leaves_of(trees, inputs) for trees in groups]
    return leaves[0] if len(leaves) == 1 else F.concat(*leaves)


def _leaves_of_vector(trees: Trees, vector: str, is_map: bool) -> Column:
    """The walk over whole vectors: their numbers are searched among the model's features,
    some rows at a time, so that a wide model takes no more memory than a narrow one."""
    rows_at_once = max(1, DENSE_CELLS // len(trees.features))

    @F.arrow_udf("array<int>")
    def walk(numbers: pa.Array, values: pa.Array) -> pa.Array:
        parts = [
            trees.walk_vectors(numbers.slice(at, rows_at_once), values.slice(at, rows_at_once))
            for at in range(0, len(values), rows_at_once)
        ]
        return as_lists(np.concatenate([np.empty((0, len(trees.roots)), np.int32), *parts]))

    # The vector is used twice, so that the expression that makes it stays out of the call.
    values = F.map_values(vector) if is_map else F.col(vector)
    numbers = F.map_keys(vector) if is_map else F.sequence(F.lit(0), F.size(vector) - F.lit(1), F.lit(1))
    numbers = numbers if is_map else F.when(F.size(vector) > 0, numbers).otherwise(F.array())
    return walk(numbers.cast("array<bigint>"), values.cast("array<float>"))


def _leaves_of(trees: Trees, inputs: Sequence[TreeInput]) -> Column:
    """The walk as an Arrow UDF: lambda expressions would interpret every step of
    every row, and the same trees as nested ``IF`` outgrow the code generator."""
    plan = [(i.feature, i.value) for i in inputs]

    @F.arrow_udf("array<int>")
    def walk(*columns: pa.Array) -> pa.Array:
        return as_lists(trees.walk(matrix(trees, plan, columns)))

    return walk(*_cast_inputs(inputs))


def _cast_inputs(inputs: Sequence[TreeInput]) -> list[Column]:
    return [F.col(i.column).try_cast("float" if i.feature is not None else "bigint") for i in inputs]
