"""Running positions over a total order, without a single-task window.

``over (order by ...)`` sends every row to one task.  Here the rows are range
partitioned and sorted once, and each row is stored with its position inside
its partition.  What remains to be summed up centrally is one total per
partition, a few thousand numbers whatever the data size.  The sorted frame has
to be stored: partition borders come from a sample and may fall elsewhere when
the frame is computed again.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrprep.sources.scratch import store

# monotonically_increasing_id keeps the partition number above this bit and
# the position inside the partition below it.
_POSITION_BITS = 33

SEQ = "seq"
SLOT = "slot"


def slot() -> Column:
    return F.shiftright(F.col(SEQ), _POSITION_BITS)


def store_ranked(df: DataFrame, order_by: Sequence[str], label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Sort ``df`` by ``order_by`` over all partitions and store it with ``seq``,
    which increases along that order."""
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    return store(ordered.withColumn(SEQ, F.monotonically_increasing_id()), label, partition_by)


def slot_totals(ranked: DataFrame, within: Sequence[str], measures: dict[str, Column]) -> list[dict]:
    """Per slot (and value of ``within``), in order, the first ``seq`` and the
    ``measures``: as many rows as partitions were written."""
    per_slot = ranked.groupBy(*within, slot().alias(SLOT)).agg(
        F.min(SEQ).alias("first_seq"), *[measure.alias(name) for name, measure in measures.items()]
    )
    return sorted((r.asDict() for r in per_slot.collect()), key=lambda r: r["first_seq"])


def with_running(totals: Sequence[dict], measure: str) -> list[dict]:
    """Add ``before``: the sum of ``measure`` over all earlier totals."""
    running, out = 0, []
    for total in totals:
        out.append({**total, "before": running})
        running += total[measure]
    return out


def broadcast_rows(spark: SparkSession, rows: Sequence[dict], columns: dict[str, pa.DataType]) -> DataFrame:
    arrays = {name: pa.array([r[name] for r in rows], kind) for name, kind in columns.items()}
    return F.broadcast(spark.createDataFrame(pa.table(arrays)))


def row_index(ranked: DataFrame, totals: Sequence[dict], start: int) -> tuple[DataFrame, Column]:
    """``ranked`` with what the dense index of its rows needs, and that index."""
    offsets = [{SLOT: t[SLOT], "shift": t["before"] - t["first_seq"] + start} for t in with_running(totals, "rows")]
    small = broadcast_rows(ranked.sparkSession, offsets, {SLOT: pa.int64(), "shift": pa.int64()})
    return ranked.withColumn(SLOT, slot()).join(small, SLOT), F.col(SEQ) + F.col("shift")


def with_row_index(ranked: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Number the rows of a stored ranking densely from ``start``."""
    totals = slot_totals(ranked, [], {"rows": F.count(F.lit(1))})
    placed, index = row_index(ranked, totals, start)
    return placed.withColumn(name, index).drop(SLOT, SEQ, "shift")
