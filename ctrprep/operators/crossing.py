"""Crossings that occur often enough to be features.

A crossing cannot occur more often than any of its members. So the members are counted first, rows lose the members that are too
rare, and only what is left is crossed, shuffled and counted: rare values, of which there are most, make no crossings at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrprep.operators.featuremap import cross, crossed_columns
from ctrprep.operators.lookup import BROADCAST_BYTES, add_ids_from
from ctrprep.operators.stats import pv_click, value_counts
from ctrprep.sources.scratch import store


def cross_frequent(
    df: DataFrame,
    columns: Sequence[str],
    factor: int = 2,
    bundle: Sequence[str] = (),
    least: int = 1,
    broadcast_bytes: int = BROADCAST_BYTES,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Like :func:`~ctrprep.operators.featuremap.cross`, but NULL where a member occurs in fewer than ``least`` rows.

    The columns themselves stay as they are.  Frequent members are looked up as dictionaries are: broadcast if they are
    small, all large ones together by one exchange of their values otherwise.
    """
    if least <= 1:
        return cross(df, columns, factor, bundle)
    members = list(dict.fromkeys([*bundle, *columns]))
    frequent = value_counts(df, members).where(F.col("pv") >= F.lit(least)).select("name", "value", F.lit(1).cast("bigint").alias("id"))
    frequent = store(frequent, "frequent-members", ["name"])
    flags = {m: f"__often_{k}" for k, m in enumerate(members)}
    marked = add_ids_from(df, frequent, flags, broadcast_bytes, spread_by)
    held = {m: f"__member_{k}" for k, m in enumerate(members)}
    pruned = marked.select(*df.columns, *[F.when(F.col(flags[m]).isNotNull(), F.col(m)).alias(held[m]) for m in members])
    crossed = cross(pruned, [held[c] for c in columns], factor, [held[b] for b in bundle])
    inner = crossed_columns([held[c] for c in columns], factor, [held[b] for b in bundle])
    named = crossed_columns(columns, factor, bundle)
    return crossed.select(*df.columns, *[F.col(a).alias(b) for a, b in zip(inner, named)])


def crossing_counts(crossed: DataFrame, names: Sequence[str], least: int = 1, label: str | None = None) -> DataFrame:
    """``(name, value, pv)`` of the crossings in ``names`` that occur in ``least`` rows or more, with ``click`` if there is a ``label``."""
    counted = pv_click(crossed, names, label) if label else value_counts(crossed, names)
    return counted.where(F.col("pv") >= F.lit(least))
