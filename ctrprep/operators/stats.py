"""Counts per feature value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctrprep.functions.columns import key_text, require_columns


def _long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), null_token: str | None = None) -> DataFrame:
    """One row per input row and column as ``(code, value)``, the code being the
    column's number; all columns in one pass over the input.  NULL gives no row,
    unless a token stands for it."""
    require_columns(df, [*columns, *keep])
    texts = [key_text(c) if null_token is None else F.coalesce(key_text(c), F.lit(null_token)) for c in columns]
    codes = [str(k) for k in range(len(columns))]
    wide = df.select(*keep, *[value.alias(code) for code, value in zip(codes, texts)])
    narrow = wide.unpivot(list(keep), codes, "code", "value")
    return narrow.where(F.col("value").isNotNull())


def _named(coded: DataFrame, columns: Sequence[str], *rest: str) -> DataFrame:
    """Put the column's name in place of its code, after the rows have been
    grouped and shuffled under the shorter one."""
    names = F.array(*[F.lit(c) for c in columns])
    return coded.select(F.get(names, F.col("code").cast("int")).alias("name"), "value", *rest)


def value_counts(df: DataFrame, columns: Sequence[str], null_token: str | None = None) -> DataFrame:
    """``(name, value, pv)``: how often each value of each column occurs."""
    columns = list(dict.fromkeys(columns))
    counted = _long_form(df, columns, null_token=null_token).groupBy("code", "value").agg(F.count(F.lit(1)).alias("pv"))
    return _named(counted, columns, "pv")


def vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct ``(name, value)`` pairs."""
    columns = list(dict.fromkeys(columns))
    return _named(_long_form(df, columns).distinct(), columns)


def distinct_values(df: DataFrame, column: str, ordered: bool = False) -> DataFrame:
    """Distinct values of one column, sorted on request."""
    require_columns(df, [column])
    values = df.select(key_text(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    return values.orderBy("value") if ordered else values


def pv_click(df: DataFrame, columns: Sequence[str], label: str = "click") -> DataFrame:
    """``(name, value, pv, click)``: views per value, and those whose label is ``1``.

    Any other label, blanks and ``-1`` included, is a view without a click.
    """
    columns = list(dict.fromkeys(columns))
    require_columns(df, [label])
    clicked = F.coalesce((key_text(label) == F.lit("1")).cast("bigint"), F.lit(0))
    flagged = df.select(*columns, clicked.alias("__click"))
    counted = (
        _long_form(flagged, columns, keep=["__click"])
        .groupBy("code", "value")
        .agg(F.count(F.lit(1)).alias("pv"), F.sum("__click").alias("click"))
    )
    return _named(counted, columns, "pv", "click")
