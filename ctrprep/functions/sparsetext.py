"""Sparse vectors in text, ``number:value`` items between commas, parsed for whole batches inside a task.

Only texts of the characters in ``CHARACTERS`` are meant; what they hold is parsed as a cast in a query would.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHARACTERS = "0123456789:.,-"
# Items that are parsed as columns; others of these characters are looked at one by one.
_PLAIN = r"^-?[0-9]{1,9}:-?(?:[0-9]{1,20}\.?[0-9]{0,20}|\.[0-9]{1,20})$"
_NUMBER = re.compile(r"-?[0-9]+\Z")
_VALUE = re.compile(r"-?(?:[0-9]+\.?[0-9]*|\.[0-9]+)\Z")


def parse_items(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, number and value of every well-formed item, in order."""
    items = pc.split_pattern(texts, ",")
    row = np.repeat(np.arange(len(texts)), items.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    flat = items.flatten()
    plain = pc.match_substring_regex(flat, _PLAIN).to_numpy(zero_copy_only=False).astype(bool)
    halves = pc.split_pattern(flat if plain.all() else flat.filter(pa.array(plain)), ":").flatten()
    even = np.arange(0, len(halves), 2)
    number = halves.take(pa.array(even)).cast(pa.int64()).to_numpy(zero_copy_only=False)
    value = halves.take(pa.array(even + 1)).cast(pa.float32()).to_numpy(zero_copy_only=False)
    if plain.all():
        return row, number, value
    odd = [(at, *found) for at in np.flatnonzero(~plain).tolist() if (found := _odd_item(flat[at].as_py()))]
    at = np.concatenate([np.flatnonzero(plain), np.array([o[0] for o in odd], np.int64)])
    number = np.concatenate([number, np.array([o[1] for o in odd], np.int64)])
    value = np.concatenate([value, np.array([o[2] for o in odd], np.float32)])
    order = np.argsort(at, kind="stable")
    return row[at[order]], number[order], value[order]


def _odd_item(item: str) -> tuple[int, float] | None:
    """The number before the first colon and the value behind the last one, if they are such."""
    left, colon, _ = item.partition(":")
    right = item.rpartition(":")[2]
    if not colon or not _NUMBER.match(left) or not _VALUE.match(right) or not -(1 << 31) <= int(left[:12]) < 1 << 31 or len(left.lstrip("-0")) > 10:
        return None
    try:
        return int(left), pa.scalar(right).cast(pa.float32()).as_py()
    except pa.ArrowInvalid:
        return int(left), float(right)


def last_items(row: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Places of the items that count: of equal numbers in a row the last one. A row that repeats a number is in the order of numbers."""
    order = np.lexsort((np.arange(len(row)), number, row))
    r, n = row[order], number[order]
    again = np.zeros(len(row), bool)
    again[:-1] = (r[1:] == r[:-1]) & (n[1:] == n[:-1])
    if not again.any():
        return np.arange(len(row))
    repeating = np.zeros(int(row.max()) + 1, bool)
    repeating[r[again]] = True
    kept = order[~again]
    # Places within a row: by number where one is repeated, else as given.
    rank = np.where(repeating[row[kept]], np.arange(len(kept)), kept)
    return kept[np.lexsort((rank, row[kept]))]


def item_lists(texts: pa.Array) -> pa.Array:
    """The items of each text as a list of ``(id, value)``; NULL for NULL."""
    row, number, value = parse_items(texts)
    kept = last_items(row, number)
    sizes = np.bincount(row[kept], minlength=len(texts))
    ends = np.zeros(len(texts) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    pairs = pa.StructArray.from_arrays([pa.array(number[kept].astype(np.int32)), pa.array(value[kept])], ["id", "value"])
    missing = texts.is_null()
    return pa.ListArray.from_arrays(pa.array(ends), pairs, mask=missing if texts.null_count else None)
