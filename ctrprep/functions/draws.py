"""Seeded uniform draws.

A draw is a hash of (seed, purpose, row key), so it depends neither on how the
rows are partitioned nor on how often a task is re-run, and two readers of one
sampled frame see the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F

RANGE = 1 << 32


def ticket(seed: int, purpose: str, key: Sequence[str] | None) -> Column:
    """A uniform hexadecimal text; its first 8 digits are the draw.

    ``key`` names columns that tell rows apart.  Without a key the ticket comes
    from Spark's own ``rand``: copies of a row then draw differently, but a frame
    that is read twice has to be stored first to stay the same.
    """
    if not key:
        return F.md5(F.rand(crc32(f"{seed}|{purpose}".encode())).cast("string"))
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    return F.md5(F.concat_ws("|", F.lit(f"{seed}|{purpose}"), *parts))


def below(ticket: Column, rate: float) -> Column:
    """True for a share ``rate`` of the tickets; 0 and 1 are exact.  Fixed-width
    hexadecimal sorts like the number, so nothing has to be converted."""
    if not 0.0 <= rate <= 1.0:
        raise ValueError(f"rate {rate} lies outside [0, 1]")
    threshold = int(rate * RANGE)
    return F.lit(True) if threshold == RANGE else ticket < F.lit(f"{threshold:08x}")


def number(ticket: Column) -> Column:
    """The draw as a bigint in ``[0, 2^32)``."""
    return F.conv(F.substring(ticket, 1, 8), 16, 10).cast("bigint")
