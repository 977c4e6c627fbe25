"""Typed extraction of impression columns from a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrprep.functions.columns import fixed_point, require_columns
from ctrprep.sources.scratch import store

TEXT_TYPE = "s"
FIXED_POINT_TYPE = "f"


def extract(
    df: DataFrame,
    columns: Sequence[str],
    types: Sequence[str] | None = None,
    factor: float = 100000,
    precision: str = "float",
) -> DataFrame:
    """Project ``columns``: type ``s`` passes through, ``f`` becomes a scaled bigint."""
    columns = [c.strip() for c in columns]
    types = list(types) if types else [TEXT_TYPE] * len(columns)
    if len(types) != len(columns):
        raise ValueError(f"{len(columns)} columns but {len(types)} types")
    require_columns(df, columns)
    projected = []
    for name, kind in zip(columns, types):
        if kind == TEXT_TYPE:
            projected.append(F.col(name))
        elif kind == FIXED_POINT_TYPE:
            projected.append(fixed_point(F.col(name), factor, precision).alias(name))
        else:
            raise ValueError(f"type {kind!r} of column {name} is neither 's' nor 'f'")
    return df.select(*projected)


def since(df: DataFrame, bound, column: str = "dt") -> DataFrame:
    """Keep partitions from ``bound`` on.  Apply it before :func:`extract`, so
    that the filter prunes partitions and row groups."""
    require_columns(df, [column])
    return df.where(F.col(column) >= F.lit(bound).cast(df.schema[column].dataType))


def on(df: DataFrame, value, column: str = "dt") -> DataFrame:
    """Keep one partition."""
    require_columns(df, [column])
    return df.where(F.col(column) == F.lit(value).cast(df.schema[column].dataType))


def open_table(spark: SparkSession, table: str, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A frame given by name, a catalog table, or a parquet path."""
    if tables and table in tables:
        return tables[table]
    if "/" in table:
        return spark.read.parquet(table)
    return spark.table(table)


def column_union(parts: Sequence[Sequence[str]]) -> list[str]:
    """All columns of all parts, each once, in order of first appearance."""
    return list(dict.fromkeys(c.strip() for part in parts for c in part))


# A key is frequent if at least one in so many rows of a table has it, and no fewer than so many rows.
_HOT_KEYS, _HOT_ROWS = 500, 5_000
# Items that a table's sketch of frequent keys tracks.
_SKETCH_ITEMS = 10_000
# Parts that the rows of such a key are dealt into.
_CELLS = 64
JOIN_TYPES = ("left", "inner", "right", "full")
# Types whose equal values have equal hashes on both sides of a join.
_HASHED_TYPES = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.DecimalType, T.BooleanType, T.BinaryType)


@dataclass(frozen=True)
class Part:
    """A further part of the rows: how it is joined, and the values of its columns where it has none."""

    df: DataFrame
    keys: Sequence[str]
    how: str = "left"
    defaults: Mapping[str, object] = field(default_factory=dict)


def attach_part(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Join a further part on ``keys``.  Columns the left side already has win;
    misses take the value in ``defaults``."""
    return attach_parts(left, [Part(right, keys, how, defaults or {})])


def attach_parts(first: DataFrame, parts: Sequence[Part]) -> DataFrame:
    """Join further parts one after the other, as :func:`attach_part` does, with frequent keys of either side spread.

    One job reads the key columns of every table once and sketches its frequent keys; where there are any, a second one
    tells which of them each table really has.  The joins themselves are planned from these and read every table once; what is
    joined so far is never evaluated on its own, but for a right or full join that meets a frequent key of it, before which it is
    stored.  A frequent key is dealt into ``_CELLS`` parts: each row of the side with more of them gets one, the other side's
    rows are copied to all, and copies that found nothing are dropped again.  Rows whose key is NULL or only frequent
    on their own side are dealt out the same way.
    """
    for part in parts:
        if part.how not in JOIN_TYPES:
            raise ValueError(f"join type {part.how!r} is not one of {JOIN_TYPES}")
    # The columns of what is joined so far, and of which tables its keys may come.
    columns, tables = list(first.columns), [first]
    plans = []
    for part in parts:
        keys = list(part.keys)
        for names in (columns, part.df.columns):
            missing = [k for k in keys if k not in names]
            if missing:
                raise ValueError(f"unknown column(s) {missing}; have {names}")
        owners = [t for t in tables if all(k in t.columns for k in keys)]
        plans.append((part, keys, owners))
        tables.append(part.df)
        columns = column_union([columns, part.df.columns])
    hot = _frequent(plans)

    joined = first
    for k, (part, keys, _) in enumerate(plans):
        fresh = [c for c in part.df.columns if c not in joined.columns]
        layout = column_union([joined.columns, fresh])
        right = part.df.select(*keys, *fresh)
        if hot[k]:
            joined, right, dealt = _with_cells(joined, right, keys, part.how, hot[k], single=k == 0)
            joined = joined.join(right, [*keys, _CELL], part.how)
            for mark, other in ((_LEFT_COPY, _RIGHT_HERE), (_RIGHT_COPY, _LEFT_HERE)):
                if dealt and part.how != "inner":
                    joined = joined.where(~(F.coalesce(F.col(mark), F.lit(False)) & F.col(other).isNull()))
        else:
            joined = joined.join(right, keys, part.how)
        joined = joined.select(*layout)
        if part.defaults:
            joined = joined.fillna({c: v for c, v in part.defaults.items() if c in fresh})
    return joined


_CELL, _LEFT_COPY, _RIGHT_COPY, _LEFT_HERE, _RIGHT_HERE = "__cell", "__left_copy", "__right_copy", "__left_here", "__right_here"


def _key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """One number for the key, NULL if any of it is."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return F.when(known, F.xxhash64(*[F.col(k) for k in keys]))


def _comparable(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> bool:
    kinds = [(left.schema[k].dataType, right.schema[k].dataType) for k in keys]
    return all(a == b and isinstance(a, _HASHED_TYPES) for a, b in kinds)


def _frequent(plans: Sequence[tuple[Part, list[str], list[DataFrame]]]) -> list[dict[int, tuple[int, int]]]:
    """For each join the hashes of frequent keys, with their number of rows on the left, as far as the tables tell, and on the right;
    0 for a key that a single table really lacks."""
    hot: list[dict[int, list[int]]] = [{} for _ in plans]
    # Every table with the keys that are asked of it, and for each of these the joins and sides that want to know.
    asked: dict[int, tuple[DataFrame, dict[tuple[str, ...], int]]] = {}
    wanted: list[list[tuple[int, int]]] = []
    for k, (part, keys, owners) in enumerate(plans):
        if not owners or not all(_comparable(t, part.df, keys) for t in owners):
            continue
        for place, table in [*((0, t) for t in owners), (1, part.df)]:
            numbers = asked.setdefault(id(table), (table, {}))[1]
            if tuple(keys) not in numbers:
                numbers[tuple(keys)] = len(wanted)
                wanted.append([])
            wanted[numbers[tuple(keys)]].append((k, place))
    if not wanted:
        return hot

    def each(table: DataFrame, numbers: Mapping[tuple[str, ...], int]) -> DataFrame:
        pairs = [F.struct(F.lit(n).alias("side"), _key_hash(table, keys).alias("key")) for keys, n in numbers.items()]
        return table.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.side", "pair.key")

    # The key columns of every table are read once.
    every = reduce(DataFrame.unionByName, [each(*a) for a in asked.values()])
    top = F.expr(f"approx_top_k(key, {_HOT_KEYS}, {_SKETCH_ITEMS}) FILTER (WHERE key IS NOT NULL)")
    for r in every.groupBy("side").agg(top.alias("top"), F.count(F.lit(1)).alias("rows")).collect():
        for item in r["top"]:
            if item["count"] >= _HOT_ROWS and item["count"] * _HOT_KEYS >= r["rows"]:
                for k, _ in wanted[r["side"]]:
                    hot[k][item["item"]] = [0, 0]
    if any(hot):
        here = F.lit(False)
        for n, places in enumerate(wanted):
            some = sorted({key for k, _ in places for key in hot[k]})
            here = here | ((F.col("side") == n) & F.col("key").isin(some)) if some else here
        for r in every.where(here).groupBy("side", "key").agg(F.count(F.lit(1)).alias("rows")).collect():
            for k, place in wanted[r["side"]]:
                if r["key"] in hot[k]:
                    hot[k][r["key"]][place] += r["rows"]
    return [{key: tuple(n) for key, n in table.items()} for table in hot]


def _with_cells(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, hot: Mapping[int, tuple[int, int]], single: bool
) -> tuple[DataFrame, DataFrame, bool]:
    """Both sides with a further key, the cell, and marks of copies and presence; and whether there are copies."""
    copied_left = [h for h, (a, b) in hot.items() if a and b and a < b]
    copied_right = [h for h, (a, b) in hot.items() if a and b and a >= b]
    if how in ("right", "full") and copied_right and not single:
        # Copies on the right that find nothing are dropped, so the left side has to have their keys for certain.
        left = store(left, "joined-parts")
        some = left.select(_key_hash(left, keys).alias("key")).where(F.col("key").isin(copied_right)).distinct()
        copied_right = [r["key"] for r in some.collect()]
    out = []
    for df, copied, mark, here in ((left, copied_left, _LEFT_COPY, _LEFT_HERE), (right, copied_right, _RIGHT_COPY, _RIGHT_HERE)):
        key = _key_hash(df, keys)
        to_all = key.isin(copied) if copied else F.lit(False)
        dealt = key.isNull() | key.isin([h for h in hot if h not in copied])
        # A shuffle can hand a task its rows in another order when it runs again. Sorted by their values, the dealt rows get the draws
        # they had, and equal rows still part; the others stay in front.
        values = F.when(dealt, F.xxhash64(*[_hashable(df, c) for c in df.columns]))
        placed = df.withColumn("__value", values).sortWithinPartitions(F.col("__value").asc_nulls_first())
        draw = F.floor(F.rand(7) * _CELLS).cast("int")
        placed = placed.withColumn("__draw", draw)
        cell = F.when(dealt, F.col("__draw")).otherwise(F.lit(0))
        cells = F.when(F.coalesce(to_all, F.lit(False)), F.sequence(F.lit(0), F.lit(_CELLS - 1))).otherwise(F.array(cell))
        placed = placed.withColumns({mark: F.coalesce(to_all, F.lit(False)), here: F.lit(True), _CELL: F.explode(cells)})
        out.append(placed.drop("__value", "__draw"))
    return out[0], out[1], bool(copied_left or copied_right)


def _hashable(df: DataFrame, column: str) -> Column:
    """The column in a form that can be hashed: maps cannot."""
    held = F.col(f"`{column}`")
    return F.to_json(F.struct(held)) if "map<" in df.schema[column].dataType.simpleString() else held
