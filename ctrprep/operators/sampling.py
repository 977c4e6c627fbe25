"""Row sampling, noise, duplication and shuffling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctrprep.functions.columns import any_of, equals_int, equals_text, require_columns, text
from ctrprep.functions.draws import below, number, ticket

KEEP_ALL = -1
RESIDUES = 10


@dataclass(frozen=True)
class Condition:
    """Keep a share ``rate`` of the rows whose ``column`` equals ``value``."""

    column: str
    value: str
    rate: float


def parse_conditions(args: str) -> list[Condition]:
    """``"column:value:rate column:value:rate"``."""
    found = []
    for item in args.split():
        pieces = item.split(":")
        if len(pieces) != 3:
            raise ValueError(f"condition {item!r} is not column:value:rate")
        found.append(Condition(pieces[0], pieces[1], float(pieces[2])))
    return found


def sample_union(df: DataFrame, conditions: Sequence[Condition], key: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """A row once for every condition that it matches and wins; rows without a
    match are dropped.  One pass, however many conditions."""
    if not conditions:
        return df
    matches = [equals_text(df, c.column, c.value) for c in conditions]
    kept = [
        F.when(match & below(ticket(seed, f"shrink|{i}", key), c.rate), F.lit(i))
        for i, (match, c) in enumerate(zip(matches, conditions))
    ]
    copies = df.where(any_of(matches)).select(*df.columns, F.explode(F.array(*kept)).alias("__copy"))
    return copies.where(F.col("__copy").isNotNull()).drop("__copy")


def sample_any(df: DataFrame, shrinks: Sequence[Sequence[Condition]], key: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Rows that win under any condition, at most once each.  All conditions of
    one shrink share a draw."""
    shrinks = [s for s in shrinks if s]
    if not shrinks:
        return df
    drawn = {f"__ticket{i}": ticket(seed, f"shrink|{i}", key) for i in range(len(shrinks))}
    wins = [
        equals_text(df, c.column, c.value) & below(F.col(f"__ticket{i}"), c.rate)
        for i, shrink in enumerate(shrinks)
        for c in shrink
    ]
    matches = any_of([equals_text(df, c.column, c.value) for shrink in shrinks for c in shrink])
    return df.where(matches).withColumns(drawn).where(any_of(wins)).select(*df.columns)


def sample_keep_unmatched(df: DataFrame, conditions: Sequence[Condition], key: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Thin out matching rows and keep all others.  The first match decides:
    columns in table order, then conditions in the order given."""
    if not conditions:
        return df
    require_columns(df, [c.column for c in conditions])
    ranked = sorted(conditions, key=lambda c: df.columns.index(c.column))
    drawn = ticket(seed, "shrink", key)
    keep: Column = F.lit(True)
    for c in reversed(ranked):
        keep = F.when(equals_int(df, c.column, c.value), below(drawn, c.rate)).otherwise(keep)
    return df.where(keep)


def sample_residues(df: DataFrame, residues: Sequence[int], key: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Keep rows whose draw modulo ten is listed; ``-1`` keeps all."""
    if KEEP_ALL in residues:
        return df
    return df.where((number(ticket(seed, "residue", key)) % RESIDUES).isin([int(r) for r in residues]))


def parse_residues(text_form: str) -> list[int]:
    """``"0:3:7"`` or ``"-1"``."""
    return [int(r) for r in text_form.split(":")]


def add_noise(df: DataFrame, column: str, to: str, value: str, factor: float, key: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Add ``to``: the column's text, or ``value`` for a share ``factor`` of rows."""
    require_columns(df, [column])
    hit = below(ticket(seed, f"noise|{to}", key), factor)
    return df.withColumn(to, F.when(hit, F.lit(value)).otherwise(text(column)))


def duplicate_positives(df: DataFrame, label: str) -> DataFrame:
    """Give every row labelled ``1`` a copy labelled ``0``."""
    require_columns(df, [label])
    own = F.col(label)
    copy = F.lit("0").cast(df.schema[label].dataType)
    labels = F.when(text(label) == "1", F.array(own, copy)).otherwise(F.array(own))
    return df.withColumn(label, F.explode(labels))


def duplicate_positive_lines(lines: DataFrame, separator: str = " ") -> DataFrame:
    """The same on sample lines whose first field is the label."""
    line = F.col("value")
    positive = (F.split(line, separator, 2)[0]) == F.lit("1")
    both = F.array(line, F.concat(F.lit("0"), F.substring(line, 2, 2147483647)))
    return lines.select(F.explode(F.when(positive, both).otherwise(F.array(line))).alias("value"))


def shuffle_rows(df: DataFrame, partitions: int | None = None, key: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Bring rows into random order across all partitions.

    Rows are dealt out evenly and ordered by chance inside each partition, so
    that even a large group of equal rows spreads over all partitions and mixes
    with the others.  With a ``key`` that tells all rows apart, place and order
    follow from the key alone, whatever the input's partitions; rows that share
    a key then stay together.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not key:
        return df.repartition(partitions).sortWithinPartitions(F.rand(seed))
    placed = df.withColumn("__order", F.xxhash64(F.lit(seed), *[F.col(k) for k in key]))
    return placed.repartition(partitions, "__order").sortWithinPartitions("__order").drop("__order")


def with_split(df: DataFrame, validate_rate: float, key: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Add ``split``: ``valid`` for ``validate_rate`` percent of rows, else ``train``.
    Written with ``partitionBy('split')`` both sets come from one pass."""
    valid = below(ticket(seed, "split", key), validate_rate / 100)
    return df.withColumn("split", F.when(valid, F.lit("valid")).otherwise(F.lit("train")))
