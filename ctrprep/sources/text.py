"""Delimited text in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ctrprep.functions.columns import field, fields, require_columns

EXTRACT_SEPARATOR = "\x01"
SAMPLE_SEPARATOR = " "
MAP_SEPARATOR = "\t"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def parse_lines(
    lines: DataFrame,
    schema: T.StructType,
    wanted: Sequence[str] | None = None,
    separator: str = EXTRACT_SEPARATOR,
    keep_trailing: bool = True,
    short_rows: str = "drop",
) -> DataFrame:
    """Turn ``value`` lines into typed columns.

    ``schema`` lists the fields in file order, ``wanted`` the ones to keep.
    ``short_rows='drop'`` rejects a line that lacks a wanted field;
    ``'null'`` keeps it with NULL there.
    """
    names = schema.fieldNames()
    wanted = list(wanted or names)
    unknown = [w for w in wanted if w not in names]
    if unknown:
        raise ValueError(f"unknown column(s) {unknown}; have {names}")
    if short_rows not in ("drop", "null"):
        raise ValueError(f"short_rows {short_rows!r} is neither 'drop' nor 'null'")
    parts = fields(F.col("value"), separator, keep_trailing)
    if short_rows == "drop":
        needed = 1 + max(names.index(w) for w in wanted)
        lines = lines.where(F.size(parts) >= F.lit(needed))
    return lines.select(*[_typed(field(parts, names.index(w)), schema[w].dataType).alias(w) for w in wanted])


def _typed(raw: Column, kind: T.DataType) -> Column:
    return raw if isinstance(kind, T.StringType) else raw.try_cast(kind)


def reject_counts(lines: DataFrame, needed: int, separator: str = EXTRACT_SEPARATOR) -> DataFrame:
    """How many lines :func:`parse_lines` keeps and drops for ``needed`` fields."""
    short = F.size(fields(F.col("value"), separator)) < F.lit(needed)
    return lines.groupBy().agg(
        F.count(F.lit(1)).alias("lines"),
        F.coalesce(F.sum(short.cast("bigint")), F.lit(0)).alias("rejected"),
    )


def field_of_lines(lines: DataFrame, index: int, separator: str = MAP_SEPARATOR) -> DataFrame:
    """One field of every line as ``value``; lines without it give no row."""
    return lines.select(field(fields(F.col("value"), separator), index).alias("value")).where(
        F.col("value").isNotNull()
    )


def to_lines(df: DataFrame, columns: Sequence[str], separator: str = EXTRACT_SEPARATOR) -> DataFrame:
    """Join columns to one ``value`` line; NULL becomes an empty field."""
    require_columns(df, columns)
    return df.select(
        F.concat_ws(separator, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value")
    )


def with_line_order(lines: DataFrame) -> DataFrame:
    """Add ``line_order``, which sorts the lines of a text file as written."""
    meta = F.col("_metadata")
    return lines.select(
        "value",
        F.struct(
            meta["file_path"].alias("file"),
            meta["file_block_start"].alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("line_order"),
    )


def parse_feature_map(lines: DataFrame, order: str | None = None, separator: str | None = None) -> DataFrame:
    """Feature-map lines ``name value id ...`` to ``(name, value, id)``.

    Fields end at ``separator``, or at any blank, tab or comma without one; lines
    with fewer than three are skipped, an id that is no number raises.  When a key
    comes twice the last line counts, by the column ``order``; without it the
    largest id, so that the result is repeatable.
    """
    line = F.translate("value", "\t,", "  ") if separator is None else F.col("value")
    parts = fields(line, separator or " ")
    number = field(parts, 2).try_cast("bigint")
    checked = F.when(number.isNotNull(), number).otherwise(
        F.raise_error(F.concat(F.lit("no id in the feature-map line "), "value")).cast("bigint")
    )
    entries = lines.where(F.size(parts) >= 3).select(
        field(parts, 0).alias("name"),
        field(parts, 1).alias("text"),
        checked.alias("id"),
        *([F.col(order).alias("line_order")] if order else []),
    )
    chosen = F.max_by("id", "line_order") if order else F.max("id")
    return entries.groupBy("name", F.col("text").alias("value")).agg(chosen.alias("id"))


def read_feature_map_text(spark: SparkSession, path: str, separator: str | None = MAP_SEPARATOR) -> DataFrame:
    """A map in text form.  ``separator=None`` reads the older form, whose values hold no blank, tab or comma."""
    return parse_feature_map(with_line_order(spark.read.text(path)), "line_order", separator)


def read_feature_map(spark: SparkSession, path: str) -> DataFrame:
    """``(name, value, id)`` and whatever counts were written with them."""
    return spark.read.parquet(path)


def write_lines(lines: DataFrame, path: str, column: str = "value") -> None:
    """Write one text column, replacing exactly ``path``."""
    lines.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_feature_map(entries: DataFrame, path: str) -> None:
    """Write a map with its types, whatever its values hold, replacing exactly ``path``."""
    require_columns(entries, ["name", "value", "id"])
    entries.write.mode("overwrite").parquet(path)


def write_feature_map_text(entries: DataFrame, path: str, single_file: bool = False) -> None:
    """Write ``name<TAB>value<TAB>id`` lines; names and values that hold a tab or a line
    end raise.  ``single_file`` suits small maps only."""
    require_columns(entries, ["name", "value", "id"])
    broken = F.concat_ws(" ", "name", "value").rlike("[\t\r\n]")
    checked = F.when(~broken, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("not a text-map value: "), "value")).cast("string"))
    out = to_lines(entries.withColumn("value", checked), ["name", "value", "id"], MAP_SEPARATOR)
    write_lines(out.coalesce(1) if single_file else out, path)
