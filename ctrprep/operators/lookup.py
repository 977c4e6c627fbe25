"""Replacing values by their feature-map ids."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctrprep.functions.columns import key_text, require_columns, whole_number
from ctrprep.operators.featuremap import FeatureMap
from ctrprep.sources.scratch import is_stored, store

# All dictionaries that one frame broadcasts stay below this estimate together.
BROADCAST_BYTES = 64 << 20
# Object and hash-table cost of one broadcast entry on top of its text.
_ENTRY_OVERHEAD = 64
# A value is hot from one in this many rows on, so there are at most this many.
_HOT_VALUES = 2000
# Where a map has no counts, hot values are looked for in this share of the rows.
_HOT_SAMPLE = 0.001
# Whole numbers up to here are exact as doubles.
_EXACT = 1 << 53

# What becomes of numbers that the map has not seen.
MISSING, NEAREST = "missing", "nearest"
UNSEEN = (MISSING, NEAREST)

Size = tuple[int, int]


def id_column(name: str) -> str:
    return f"{name}_id"


def small_enough(sizes: Mapping[str, Size], limit: int = BROADCAST_BYTES) -> set[str]:
    """The dictionaries to broadcast, smallest first while their total size
    (rows, value bytes) stays within ``limit``."""
    chosen, used = set(), 0
    cost = {name: rows * _ENTRY_OVERHEAD + (value_bytes or 0) for name, (rows, value_bytes) in sizes.items()}
    for name in sorted(cost, key=cost.get):
        used += cost[name]
        if used > limit:
            break
        chosen.add(name)
    return chosen


def look_up_small(df: DataFrame, entries: DataFrame, key: Column, to: str) -> DataFrame:
    """Add ``to``: the id that ``entries(value, id)`` gives the text ``key``, NULL
    for a miss, by broadcasting the entries.  Their size must have been checked,
    and their values must be unique."""
    dictionary = entries.select(F.col("value").alias("__value"), F.col("id").alias(to))
    found = df.withColumn("__key", key).join(
        F.broadcast(dictionary), F.col("__key") == F.col("__value"), "left"
    )
    return found.drop("__key", "__value")


def hot_by_counts(entries: DataFrame, total: int) -> DataFrame:
    """The entries whose own count ``pv`` makes them hot among ``total``."""
    return entries.where(F.col("pv") >= F.lit(-(-total // _HOT_VALUES))).select("value", "id")


def frequent_values(df: DataFrame, keys: Mapping[str, Column]) -> dict[str, list[str]]:
    """Per column the values (at most ``_HOT_VALUES``) that are frequent in a sample of the
    rows; one reading for all columns.  They decide how rows travel and never what they get."""
    if not keys:
        return {}
    codes = {name: str(k) for k, name in enumerate(keys)}
    sampled = df.sample(_HOT_SAMPLE, 7).select(*[key.alias(codes[name]) for name, key in keys.items()])
    long = sampled.unpivot([], list(codes.values()), "code", "value").where(F.col("value").isNotNull())
    counted = long.groupBy("code", "value").agg(F.count(F.lit(1)).alias("n"))
    # One total per column.
    totals = F.broadcast(long.groupBy("code").agg(F.count(F.lit(1)).alias("total")))
    frequent = counted.where("n > 1").join(totals, "code").where(F.col("n") * F.lit(_HOT_VALUES) >= F.col("total"))
    found: dict[str, list[str]] = {name: [] for name in keys}
    names = {code: name for name, code in codes.items()}
    for r in frequent.collect():
        found[names[r["code"]]].append(r["value"])
    return found


def hot_among(df: DataFrame, values: Sequence[str], entries: DataFrame) -> DataFrame:
    """``(value, id)`` of the given few values, with a NULL id for those that ``entries`` lacks."""
    table = pa.table({"value": pa.array(list(values), pa.string())})
    wanted = df.sparkSession.createDataFrame(table)
    known = entries.select("value", "id").join(F.broadcast(wanted), "value", "left_semi")
    # Both sides hold the few wanted values only.
    return wanted.join(F.broadcast(known), "value", "left")


def look_up_large(
    df: DataFrame, entries: DataFrame, key: Column, to: str, hot: DataFrame, spread_by: Sequence[str] | None = None
) -> DataFrame:
    """The same for entries too large to broadcast: rows meet them by a shuffle.

    ``hot`` are the few values (at most ``_HOT_VALUES``) that many rows
    share, with their ids, or NULL for those that have none.  They are broadcast
    and resolved first; those rows, and rows whose value is NULL, then travel under
    a spread key that meets no entry, instead of all meeting in one task.  ``spread_by`` names columns that tell rows
    apart; without it all columns are read for that.
    """
    hot = hot.select(F.col("value").alias("__hot_value"), F.col("id").alias("__hot_id"))
    keyed = df.withColumn("__key", key).join(
        F.broadcast(hot), F.col("__key") == F.col("__hot_value"), "left"
    )
    keyed = keyed.withColumn("__key", F.when(F.col("__hot_value").isNull(), F.col("__key")))
    # The second key has to be computed on both sides: the optimizer would drop a
    # constant one from the shuffle.
    spread = F.when(F.col("__key").isNull(), F.xxhash64(*[F.col(c) for c in spread_by or df.columns]))
    keyed = keyed.withColumn("__spread", F.coalesce(spread, F.xxhash64("__key")))
    dictionary = entries.select(
        F.col("value").alias("__value"), F.col("id").alias("__id"), F.xxhash64("value").alias("__place")
    )
    met = (F.col("__key") == F.col("__value")) & (F.col("__spread") == F.col("__place"))
    found = keyed.join(dictionary, met, "left").withColumn(to, F.coalesce("__hot_id", "__id"))
    return found.select(*df.columns, to)


@dataclass(frozen=True)
class LargeLookup:
    """One column's dictionary that is too large to broadcast: its entries, the rows' value, the column for the id, and the hot values."""

    entries: DataFrame
    key: Column
    to: str
    hot: DataFrame


def look_up_several(df: DataFrame, lookups: Sequence[LargeLookup], spread_by: Sequence[str] | None = None) -> DataFrame:
    """:func:`look_up_large` for several columns, with one shuffle of the rows instead of one for each column.

    Ids depend on the values alone, so what travels to the dictionaries are the values: a narrow reading of the looked-up columns,
    as (code of the row's values, column, value), meets all dictionaries in one exchange and comes together again by the code. Rows then
    take all their ids in a single join by that code. The code has 128 bits and covers what is left of the values after the hot ones
    are resolved; combinations that many rows share consist of hot values only, so no code is frequent. Rows with nothing left to
    look up are spread by ``spread_by`` or by all columns.
    """
    rows, opened = df, []
    for k, part in enumerate(lookups):
        value, place, found = f"__value_{k}", f"__hot_value_{k}", f"__hot_id_{k}"
        hot = F.broadcast(part.hot.select(F.col("value").alias(place), F.col("id").alias(found)))
        rows = rows.withColumn(value, part.key).join(hot, F.col(value) == F.col(place), "left")
        opened.append(F.when(F.col(place).isNull(), F.col(value)))
    wanting = reduce(lambda a, b: a | b, [o.isNotNull() for o in opened])
    # NULLs leave a hash as it is, so each column says whether it has a value.
    marked = [c for o in opened for c in (o.isNull(), o)]
    one, two = F.xxhash64(*marked), F.xxhash64(F.lit(2), *marked)
    codes = [str(k) for k in range(len(lookups))]

    narrow = rows.where(wanting).select(one.alias("__one"), two.alias("__two"), *[o.alias(c) for o, c in zip(opened, codes)])
    asked = narrow.unpivot(["__one", "__two"], codes, "__code", "__value").where(F.col("__value").isNotNull())
    known = [p.entries.select(F.lit(c).alias("__code"), F.col("value").alias("__value"), "id") for p, c in zip(lookups, codes)]
    met = asked.join(reduce(DataFrame.unionByName, known), ["__code", "__value"])
    ids = [F.max(F.when(F.col("__code") == c, F.col("id"))).alias(f"__id_{c}") for c in codes]
    gathered = met.groupBy("__one", "__two").agg(*ids)

    spread = F.xxhash64(*[F.col(c) for c in spread_by or df.columns])
    coded = rows.withColumns({"__one": F.when(wanting, one).otherwise(spread), "__two": F.when(wanting, two)})
    # Named apart from the codes of the narrow reading, which is made of the same rows.
    coded = coded.withColumnsRenamed({"__one": "__row_one", "__two": "__row_two"})
    joined = coded.join(gathered, (F.col("__row_one") == F.col("__one")) & (F.col("__row_two") == F.col("__two")), "left")
    return joined.select(*df.columns, *[F.coalesce(f"__hot_id_{c}", f"__id_{c}").alias(p.to) for p, c in zip(lookups, codes)])


def _look_up_all_large(df: DataFrame, lookups: Sequence[LargeLookup], spread_by: Sequence[str]) -> DataFrame:
    if len(lookups) > 1:
        return look_up_several(df, lookups, spread_by)
    for part in lookups:
        df = look_up_large(df, part.entries, part.key, part.to, part.hot, spread_by)
    return df


def add_bucket_ids(
    df: DataFrame, column: str, to: str, bounds: Sequence[tuple[int, int]], nearest: bool = False
) -> DataFrame:
    """Add the id of the last bucket ``(low, id)`` whose low the number reaches:
    a search among a few hundred bounds in place of a join on the number.  Smaller
    numbers have no id, or with ``nearest`` that of the lowest bucket."""
    lows = [float(low) for low, _ in bounds]
    search = Bucketizer(
        splits=[float("-inf"), *lows, float("inf")], inputCol="__number", outputCol="__place", handleInvalid="keep"
    )
    placed = search.transform(df.withColumn("__number", whole_number(df, column).cast("double")))
    # Place 0 lies below all buckets and the place after the last is for NULL;
    # both fall outside this constant array.
    place = F.when(F.col("__place") < 1, 1.0).otherwise(F.col("__place")) if nearest else F.col("__place")
    ids = _numbers([i for _, i in bounds])
    return placed.withColumn(to, F.get(ids, place.cast("int") - F.lit(1))).drop("__number", "__place")


def add_nearest_bucket_ids(df: DataFrame, column: str, to: str, bounds: Sequence[tuple[int, int]]) -> DataFrame:
    """Add the id of the last bucket whose low the number reaches, of the lowest one for smaller numbers; without buckets, NULL.

    Any bigint is compared exactly."""
    if not bounds:
        return df.withColumn(to, F.lit(None).cast("bigint"))
    if all(abs(low) <= _EXACT for low, _ in bounds):
        return add_bucket_ids(df, column, to, bounds, nearest=True)
    # Blocks of bounds first, then the bounds within the block.
    lows, ids, step = _numbers([low for low, _ in bounds]), _numbers([i for _, i in bounds]), math.isqrt(len(bounds)) + 1
    block = F.greatest(F.lit(0), _reached(_numbers([low for low, _ in bounds[::step]])) - F.lit(1))
    inside = F.greatest(F.lit(0), _reached(F.slice(lows, block * F.lit(step) + F.lit(1), F.lit(step))) - F.lit(1))
    placed = df.withColumn("__number", whole_number(df, column))
    found = F.when(F.col("__number").isNotNull(), F.get(ids, block * F.lit(step) + inside))
    return placed.withColumn(to, found).drop("__number")


def _numbers(values: Sequence[int]) -> Column:
    """A constant array, made from one text."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _reached(lows: Column) -> Column:
    return F.size(F.filter(lows, lambda low: low <= F.col("__number")))


def stored_bounds(entries: DataFrame, numbers: Sequence[str]) -> dict[str, list[tuple[int, int]]]:
    """The ``(lowest number, id)`` of every bucket of a stored map's bucketed columns, ascending: at most two per configured bucket."""
    some = entries.where(F.col("name").isin(list(numbers)))
    lowest = some.groupBy("name", "id").agg(F.min(F.col("value").try_cast("bigint")).alias("low")).where("low is not null")
    found: dict[str, list[tuple[int, int]]] = {}
    for low, name, i in sorted((r["low"], r["name"], r["id"]) for r in lowest.collect()):
        found.setdefault(name, []).append((low, i))
    return found


def _checked(unseen_numbers: str) -> str:
    if unseen_numbers not in UNSEEN:
        raise ValueError(f"unseen numbers {unseen_numbers!r} is not one of {UNSEEN}")
    return unseen_numbers


def add_ids(
    df: DataFrame,
    fmap: FeatureMap,
    columns: Mapping[str, str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    same_rows: bool = False,
    spread_by: Sequence[str] | None = None,
    unseen_numbers: str = MISSING,
) -> DataFrame:
    """Add an id column for every mapped column (``{column: new name}``).

    ``unseen_numbers='nearest'`` gives numbers of bucketed columns that the map has not seen the id of the bucket whose lowest
    number they reach, or of the lowest bucket; otherwise they have no id.

    ``same_rows`` states that the map was built from just these rows.  Every
    number then lies in the bucket that the bounds give, and bucketed columns
    need no lookup by value.  Lookups that shuffle come last, when the rows are
    narrowest, and all together, so that the rows are shuffled once.
    """
    columns = columns or {c: id_column(c) for c in fmap.columns}
    require_columns(df, columns)
    nearest = _checked(unseen_numbers) == NEAREST
    bounds = fmap.bucket_bounds if (same_rows or nearest) and any(c in columns for c, _ in fmap.intervals) else {}
    by_bounds = {c for c in columns if bounds.get(c) and (nearest or all(abs(low) <= _EXACT for low, _ in bounds[c]))}
    small = small_enough({c: fmap.sizes[c] for c in columns if c not in by_bounds}, broadcast_bytes)
    large = [c for c in columns if c not in by_bounds and c not in small]
    rows, given, bucketed = df, df.columns, dict(fmap.intervals)

    def key_of(column: str) -> Column:
        return whole_number(rows, column).cast("string") if column in bucketed else key_text(column)

    frequent = {} if same_rows else frequent_values(rows, {c: key_of(c) for c in large})
    lookups = []
    for column in columns:
        to = columns[column]
        if column in by_bounds:
            df = (add_nearest_bucket_ids if nearest else add_bucket_ids)(df, column, to, bounds[column])
            continue
        entries = fmap.of(column)
        if column in small:
            df = look_up_small(df, entries, key_of(column), to)
        else:
            counted = same_rows or not frequent[column]
            hot = hot_by_counts(entries, fmap.count(column)) if counted else hot_among(rows, frequent[column], entries)
            lookups.append(LargeLookup(entries, key_of(column), to, hot))
    df = _look_up_all_large(df, lookups, spread_by or given)
    return df.select(*given, *columns.values())


def add_ids_from(
    df: DataFrame,
    entries: DataFrame,
    columns: Mapping[str, str],
    broadcast_bytes: int = BROADCAST_BYTES,
    spread_by: Sequence[str] | None = None,
    numbers: Sequence[str] = (),
    unseen_numbers: str = MISSING,
) -> DataFrame:
    """Like :func:`add_ids` for a map read from elsewhere: ``(name, value, id)``.
    The values of the columns ``numbers`` are looked up as whole numbers, however
    they are written."""
    require_columns(df, columns)
    if _checked(unseen_numbers) == NEAREST and numbers:
        bounds, given = stored_bounds(entries, numbers), df.columns
        for column in numbers:
            df = add_nearest_bucket_ids(df, column, columns[column], bounds.get(column, []))
        others = {c: to for c, to in columns.items() if c not in numbers}
        if others:
            df = add_ids_from(df, entries, others, broadcast_bytes, spread_by or given)
        return df.select(*given, *columns.values())
    wanted = entries.where(F.col("name").isin(list(columns))).select("name", "value", "id")
    entries = wanted if is_stored(entries) else store(wanted, "side-map", ["name"])
    measured = entries.groupBy("name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.octet_length("value")).alias("bytes"),
        F.count_distinct("value").alias("values"),
    )
    found = {r["name"]: r for r in measured.collect()}
    for column in columns:
        if column in found and found[column]["values"] != found[column]["rows"]:
            raise ValueError(f"the map has repeated values for {column}; a join would multiply rows")
    sizes = {c: (found[c]["rows"], found[c]["bytes"]) if c in found else (0, 0) for c in columns}
    small = small_enough(sizes, broadcast_bytes)
    rows, given = df, df.columns
    keys = {c: whole_number(rows, c).cast("string") if c in numbers else key_text(c) for c in columns}
    frequent = frequent_values(rows, {c: key for c, key in keys.items() if c not in small})
    lookups = []
    for column in columns:
        mine, to = entries.where(F.col("name") == column), columns[column]
        if column in small:
            df = look_up_small(df, mine, keys[column], to)
        else:
            lookups.append(LargeLookup(mine, keys[column], to, hot_among(rows, frequent[column], mine)))
    df = _look_up_all_large(df, lookups, spread_by or given)
    return df.select(*given, *columns.values())


def require_ids(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Drop rows in which any id is missing."""
    for name in ids:
        df = df.where(F.col(name).isNotNull())
    return df
