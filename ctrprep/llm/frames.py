"""Small helpers for schemas and workers."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable, Sequence
from types import ModuleType
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

T = TypeVar("T")


def kept_in_worker(key: Hashable, make: Callable[[], T]) -> T:
    """What ``make`` returns, made once per Python worker and kept for its later tasks.

    Functions sent by value bring their own globals with every task, so these cannot hold it.
    """
    kept = sys.modules.setdefault("ctrprep_kept", ModuleType("ctrprep_kept")).__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def schema_with(df: DataFrame, keep: Sequence[str], fields: str) -> StructType:
    """The schema of ``keep`` of ``df``, and the further fields given as in DDL."""
    return StructType([*df.select(*keep).schema.fields, *StructType.fromDDL(fields).fields])
