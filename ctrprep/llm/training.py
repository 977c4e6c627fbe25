"""Labelled rows for fitting classifiers: the fixed fold set aside, and bounded samples per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a row is set aside: crc32 of the id as text leaves no remainder by ``FOLDS``. A NULL id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def even_share(rows: DataFrame, wanted: int, total: int, *key: str, seed: int = 7) -> DataFrame:
    """About ``wanted`` of ``total`` rows, by a hash of their key, so that every run and retry takes the same."""
    if total <= wanted:
        return rows
    return rows.where(F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1 << 30)) < int(wanted / total * (1 << 30)))


def class_samples(labels: DataFrame, label: str, per_class: int, doc_id: str = "doc_id") -> tuple[DataFrame, dict[int, int]]:
    """About ``per_class`` labelled rows of each class outside the held-out fold, as (doc_id, y), and the classes' sizes.

    NULL ids and labels are left out; an id labelled twice is taken once for each label.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.where("doc_id is not null and y in (0, 1)").where(~held_out(F.col("doc_id"))).distinct()
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    parts = [even_share(known.where(F.col("y") == y), per_class, n, "doc_id") for y, n in sorted(sizes.items())]
    if not parts:
        return known, sizes
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.unionByName(part)
    return chosen, sizes
