"""Rendering encoded rows as samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctrprep.functions.columns import array_of_present, key_text, require_columns, text
from ctrprep.functions.draws import below, ticket

ON_MISSING = ("drop", "null", "error")
ABSENT = "-1"


def features(df: DataFrame, ids: Sequence[str], label: str, order_by_id: bool = False) -> DataFrame:
    """``(label, features array<struct<id, value>>)``; missing ids are left out."""
    require_columns(df, [label, *ids])
    pairs = [
        (F.col(i).isNotNull(), F.struct(F.col(i).cast("bigint").alias("id"), F.lit(1.0).cast("float").alias("value")))
        for i in ids
    ]
    found = array_of_present(pairs, "struct<id:bigint,value:float>")
    if order_by_id:
        found = F.sort_array(found)
    return df.select(text(label).alias("label"), found.alias("features"))


def libsvm(
    df: DataFrame,
    ids: Mapping[str, str],
    label: str,
    on_missing: str = "drop",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``label<TAB>id:1<TAB>id:1...`` as ``value``, features in the order of ``ids``
    (``{column: its id column}``).

    A value without an id leaves no feature (``drop``), prints ``null:1``
    (``null``) or fails the job (``error``).  NULL values never print.
    """
    if on_missing not in ON_MISSING:
        raise ValueError(f"on_missing {on_missing!r} is not one of {ON_MISSING}")
    require_columns(df, [label, *ids, *ids.values(), *keep])
    printed = [F.coalesce(text(label), F.lit(""))]
    for column, name in ids.items():
        feature = F.concat(text(name), F.lit(":1"))
        missed = F.col(name).isNull() & F.col(column).isNotNull()
        if on_missing == "null":
            feature = F.when(missed, F.lit("null:1")).otherwise(feature)
        elif on_missing == "error":
            complaint = F.concat(F.lit(f"no id for {column}="), text(column))
            feature = F.when(missed, F.raise_error(complaint).cast("string")).otherwise(feature)
        printed.append(feature)
    return df.select(*keep, F.concat_ws("\t", *printed).alias("value"))


def template(
    df: DataFrame,
    pattern: str,
    columns: Sequence[str],
    dropout: Mapping[str, float] | None = None,
    key: Sequence[str] | None = None,
    seed: int = 42,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Fill ``${1}``, ``${2}``... of ``pattern`` with the trimmed ``columns``, one
    after the other, as ``value``.

    ``dropout`` blanks a column with the given probability.  A blank or NULL
    column renders as ``-1``, and ``-1:1`` features are taken out.  Rows that
    still hold a ``$`` are dropped.
    """
    require_columns(df, [*columns, *keep])
    dropout = dropout or {}
    unknown = [c for c in dropout if c not in columns]
    if unknown:
        raise ValueError(f"dropout for {unknown}, which the format does not print")
    line: Column = F.lit(pattern)
    for position, name in enumerate(columns, start=1):
        shown = F.coalesce(key_text(name), F.lit(ABSENT))
        if name in dropout:
            blank = below(ticket(seed, f"dropout|{name}", key), dropout[name])
            shown = F.when(blank, F.lit(ABSENT)).otherwise(shown)
        line = F.replace(line, F.lit("${" + str(position) + "}"), shown)
    for absent in (f"{ABSENT}:1 ", f"{ABSENT}:1"):
        line = F.replace(line, F.lit(absent), F.lit(""))
    # The filter would move below this projection and fill every line twice; it
    # cannot move below an explode.
    filled = df.select(*keep, F.explode(F.array(line)).alias("value"))
    return filled.where(~F.contains("value", F.lit("$")))


def recode(ids: Column, offset: int) -> Column:
    """Add ``offset`` to every id of a comma-separated list."""
    shifted = F.transform(F.split(ids, ",", -1), lambda i: (i.cast("bigint") + F.lit(offset)).cast("string"))
    return F.array_join(shifted, ",")


def recode_lines(lines: DataFrame, field_index: int, offset: int, separator: str = " ") -> DataFrame:
    """Recode one field of every sample line."""
    parts = F.split(F.col("value"), separator, -1)
    changed = F.transform(parts, lambda part, i: F.when(i == field_index, recode(part, offset)).otherwise(part))
    return lines.select(F.array_join(changed, separator).alias("value"))
