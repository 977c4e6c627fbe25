"""Feature maps: dictionary ids for categories, equal-frequency buckets for numbers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ctrprep.functions.columns import require_columns, text, whole_number
from ctrprep.operators.ranking import (
    SEQ,
    SLOT,
    broadcast_rows,
    row_index,
    slot,
    slot_totals,
    store_ranked,
    with_row_index,
    with_running,
)
from ctrprep.operators.stats import distinct_values, value_counts
from ctrprep.sources.text import EXTRACT_SEPARATOR


# Bucket ids as the plain quotient of running count and frequency, whose top id can
# exceed the number of buckets, or as true equal-frequency buckets.
EXACT, EVEN = "exact", "even"
BUCKET_MODES = (EXACT, EVEN)


@dataclass(frozen=True)
class FeatureMap:
    """A feature map over a stored, sorted vocabulary.

    Bucket ids come first, in the order of ``intervals``; the ids of dictionary
    columns follow densely, in the order of ``indexes`` and then of the value.
    A bucketed column takes as many ids as it has buckets, or as many as it needs
    where the top id of mode ``exact`` exceeds that, so no two columns share an id.
    ``totals`` describe the parts of the stored vocabulary.
    """

    ranked: DataFrame
    totals: tuple[dict, ...]
    intervals: tuple[tuple[str, int], ...]
    indexes: tuple[str, ...]
    mode: str = EXACT
    first_index_id: int = 1

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.intervals] + list(self.indexes)

    @property
    def entries(self) -> DataFrame:
        """``(name, value, id, pv)``."""
        if not self.intervals:
            return self.index_entries()
        if not self.indexes:
            return self._interval_entries()
        return self._interval_entries().unionByName(self.index_entries())

    def of(self, name: str) -> DataFrame:
        """``(value, id, pv)`` of one column; reads only that column's files."""
        position = self.columns.index(name)
        part = self.index_entries if name in self.indexes else self._interval_entries
        return part(position).select("value", "id", "pv")

    @cached_property
    def bucket_bounds(self) -> dict[str, list[tuple[int, int]]]:
        """Per bucketed column the ``(lowest number, id)`` of every bucket in use,
        ascending: at most two per configured bucket."""
        lowest = self._interval_entries().groupBy("name", "id").agg(
            F.min(F.col("value").try_cast("bigint")).alias("low")
        )
        found = sorted((r["name"], r["low"], r["id"]) for r in lowest.collect())
        return {name: [(low, i) for n, low, i in found if n == name] for name, _ in self.intervals}

    @property
    def sizes(self) -> dict[str, tuple[int, int]]:
        """Rows and value bytes per column."""
        return {
            name: (self._sum(k, "rows"), self._sum(k, "bytes")) for k, name in enumerate(self.columns)
        }

    def count(self, name: str) -> int:
        """How many rows had a value in the column."""
        return self._sum(self.columns.index(name), "pv")

    def _sum(self, position: int, measure: str) -> int:
        return sum(t[measure] for t in self.totals if t["position"] == position)

    def index_entries(self, position: int | None = None, carry: Sequence[str] = ("pv",)) -> DataFrame:
        """The dictionary part: ``(name, value, id)`` and the counts in ``carry``."""
        first = len(self.intervals)
        rows = self.ranked.where(F.col("position") >= first if position is None else F.col("position") == position)
        totals = [t for t in self.totals if t["position"] >= first]
        by_slot = {}
        for t in totals:
            kept = by_slot.setdefault(t[SLOT], {**t, "rows": 0})
            kept["rows"] += t["rows"]
        placed, index = row_index(rows, list(by_slot.values()), self.index_base())
        return placed.select("name", "value", index.alias("id"), *carry)

    def bucket_starts(self) -> list[int]:
        """What is added to the bucket numbers of each bucketed column."""
        starts = [0]
        for k, (_, n) in enumerate(self.intervals):
            starts.append(starts[-1] + max(n, self._top(k) + 1))
        return starts[: len(self.intervals)]

    def index_base(self) -> int:
        """The first id of the dictionary columns."""
        if not self.intervals:
            return self.first_index_id
        start, last = self.bucket_starts()[-1], len(self.intervals) - 1
        return max(self.first_index_id + start + self.intervals[last][1], start + self._top(last) + 1)

    def _top(self, position: int) -> int:
        """The largest bucket number in use, -1 without values."""
        total, n = self._sum(position, "pv"), self.intervals[position][1]
        if not total:
            return -1
        return ((total - 1) * n) // total if self.mode == EVEN else total // max(total // n, 1)

    def _interval_entries(self, position: int | None = None) -> DataFrame:
        last = len(self.intervals)
        rows = self.ranked.where(F.col("position") < last if position is None else F.col("position") == position)
        offsets = []
        for k in range(last):
            for t in with_running([t for t in self.totals if t["position"] == k], "pv"):
                offsets.append({"position": k, SLOT: t[SLOT], "before": t["before"], "total": self._sum(k, "pv")})
        kinds = {"position": pa.int32(), SLOT: pa.int64(), "before": pa.int64(), "total": pa.int64()}
        small = broadcast_rows(rows.sparkSession, offsets, kinds)

        up_to_here = Window.partitionBy("position", SLOT).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, 0)
        counted = rows.withColumn(SLOT, slot()).withColumn("running", F.sum("pv").over(up_to_here))
        placed = counted.join(small, ["position", SLOT])
        buckets, start = _by_position([n for _, n in self.intervals]), _by_position(self.bucket_starts())
        bucket = _bucket(F.col("before") + F.col("running"), F.col("total"), buckets, self.mode)
        return placed.select("name", "value", (bucket + start).alias("id"), "pv")


def _by_position(values: Sequence[int]) -> Column:
    return F.get(F.array(*[F.lit(v).cast("bigint") for v in values]), F.col("position"))


def _bucket(running: Column, total: Column, buckets: Column, mode: str) -> Column:
    """Exact: ``floor(running / frequency)`` with ``frequency = floor(total / buckets)``,
    at least 1.  Even: the bucket that the value's last row falls into when all rows
    are dealt out evenly."""
    if mode == EVEN:
        return _whole_division((running - F.lit(1)) * buckets, total)
    return _whole_division(running, F.greatest(_whole_division(total, buckets), F.lit(1)))


def _whole_division(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def build_feature_map(
    df: DataFrame,
    intervals: Sequence[tuple[str, int]] = (),
    indexes: Sequence[str] = (),
    mode: str = EXACT,
    first_index_id: int = 1,
    null_token: str | None = None,
) -> FeatureMap:
    """Number the values of ``indexes`` and bucket those of ``intervals``, which
    are taken as whole numbers, however they are written.

    One pass over ``df`` counts all columns; everything later works on the
    distinct values only.
    """
    names = [name for name, _ in intervals] + list(indexes)
    if not names:
        raise ValueError("no column to number")
    if len(set(names)) != len(names):
        raise ValueError(f"a column is transformed twice in {names}")
    for name, n in intervals:
        if n < 1:
            raise ValueError(f"{name} needs at least one bucket, not {n}")
    df = df.withColumns({name: whole_number(df, name) for name, _ in intervals})
    return rank_counts(value_counts(df, names, null_token), intervals, indexes, mode, first_index_id)


def rank_counts(
    counts: DataFrame,
    intervals: Sequence[tuple[str, int]] = (),
    indexes: Sequence[str] = (),
    mode: str = EXACT,
    first_index_id: int = 1,
) -> FeatureMap:
    """A feature map from ready ``(name, value, pv[, click])`` counts."""
    if mode not in BUCKET_MODES:
        raise ValueError(f"bucket mode {mode!r} is not one of {BUCKET_MODES}")
    names = [name for name, _ in intervals] + list(indexes)
    position = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("name")).cast("int") - F.lit(1)
    placed = counts.withColumn("position", position).where(F.col("position") >= 0)
    number = F.when(F.col("position") < len(intervals), F.col("value").try_cast("bigint"))
    placed = placed.withColumn("number", number)
    if intervals:
        placed = placed.where((F.col("position") >= len(intervals)) | F.col("number").isNotNull())
    ranked = store_ranked(placed, ["position", "number", "value"], "vocabulary", ["position"])
    measures = {"rows": F.count(F.lit(1)), "pv": F.sum("pv"), "bytes": F.sum(F.octet_length("value"))}
    totals = slot_totals(ranked, ["position"], measures)
    return FeatureMap(ranked, tuple(totals), tuple(intervals), tuple(indexes), mode, first_index_id)


def counts_as_numbers(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts in which the values of ``columns`` are whole numbers, however they were written."""
    number = F.col("value").try_cast("bigint").cast("string")
    value = F.when(F.col("name").isin(list(columns)), number).otherwise(F.col("value"))
    measures = [F.sum(c).alias(c) for c in counts.columns if c not in ("name", "value")]
    return counts.withColumn("value", value).where(F.col("value").isNotNull()).groupBy("name", "value").agg(*measures)


def feature_map_with_stats(stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(name, value, id, pv, click)`` from the counts of ``pv_click``."""
    return rank_counts(stats, indexes=columns).index_entries(carry=["pv", "click"])


def number_values(df: DataFrame, columns: Sequence[str], start: int = 0) -> DataFrame:
    """``(value, id)``: the distinct values, column by column, numbered without
    their column name."""
    return build_feature_map(df, indexes=columns, first_index_id=start).entries.select("value", "id")


def number_distinct(df: DataFrame, column: str, start: int = 0) -> DataFrame:
    """``(value, id)`` for the sorted distinct values of one column."""
    return with_row_index(store_ranked(distinct_values(df, column), ["value"], "distinct"), "id", start)


def crossed_columns(columns: Sequence[str], factor: int = 2, bundle: Sequence[str] = ()) -> dict[str, tuple[str, ...]]:
    """Names and members of all crossings of ``factor`` columns, each together
    with the fixed ``bundle``."""
    if not 1 <= factor <= len(columns):
        raise ValueError(f"cannot cross {factor} of {len(columns)} columns")
    crossings = [(*bundle, *chosen) for chosen in combinations(columns, factor)]
    return {"_x_".join(members): members for members in crossings}


def cross(df: DataFrame, columns: Sequence[str], factor: int = 2, bundle: Sequence[str] = ()) -> DataFrame:
    """Add one column per crossing; its value joins the members' values by the
    extraction separator, which no field can contain.  NULL in any gives NULL."""
    require_columns(df, [*columns, *bundle])
    added = {}
    for name, members in crossed_columns(columns, factor, bundle).items():
        pieces = [text(members[0])]
        for member in members[1:]:
            pieces += [F.lit(EXTRACT_SEPARATOR), text(member)]
        added[name] = F.concat(*pieces)
    return df.withColumns(added)
