"""Feature maps that go on from day to day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrprep.operators.featuremap import counts_as_numbers
from ctrprep.operators.lookup import add_nearest_bucket_ids, stored_bounds
from ctrprep.operators.ranking import store_ranked, with_row_index
from ctrprep.sources.scratch import store


def carry_forward(
    earlier: DataFrame, counts: DataFrame, columns: Sequence[str], intervals: Sequence[str] = ()
) -> DataFrame:
    """An earlier map brought up to date with new counts: ``(name, value, id)`` and the counts ``pv`` (and ``click``), added up.

    ``earlier`` is a stored map ``(name, value, id[, pv[, click]])`` and ``counts`` are ``(name, value, pv[, click])`` of later rows,
    whose values of ``intervals`` are taken as whole numbers.  Every earlier id stays.  New values of other ``columns`` are numbered densely
    behind the largest id, in the order of ``columns`` and then of the value; a new number of ``intervals`` takes the bucket that it
    falls into, of the lowest one if it is below all.  Columns that are in neither list keep their entries as they were.
    """
    measures = [c for c in ("pv", "click") if c in counts.columns]
    some = counts_as_numbers(counts, intervals) if intervals else counts
    some = some.where(F.col("name").isin([*columns, *intervals])).select("name", "value", *measures)
    known = earlier.select("name", "value", "id", *[F.col(c).alias(f"__{c}") for c in measures if c in earlier.columns])
    for c in measures:
        if f"__{c}" not in known.columns:
            known = known.withColumn(f"__{c}", F.lit(0).cast("bigint"))
    total = [(F.coalesce(c, F.lit(0)) + F.coalesce(f"__{c}", F.lit(0))).cast("bigint").alias(c) for c in measures]
    # Both sides have a key once.
    merged = store(some.join(known, ["name", "value"], "full").select("name", "value", "id", *total), "carried-map")
    old, new = merged.where("id is not null"), merged.where("id is null").drop("id")

    top = earlier.agg(F.max("id")).first()[0]
    position = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("name")) if columns else F.lit(0)
    fresh = new.where(F.col("name").isin(list(columns))).withColumn("position", position)
    ranked = store_ranked(fresh, ["position", "value"], "new-values")
    numbered = with_row_index(ranked, "id", 1 if top is None else top + 1)
    out = old.unionByName(numbered.select("name", "value", "id", *measures))
    for name, bounds in (stored_bounds(earlier, intervals) if intervals else {}).items():
        numbers = new.where(F.col("name") == name)
        out = out.unionByName(add_nearest_bucket_ids(numbers, "value", "id", bounds).select("name", "value", "id", *measures))
    return out
