"""Sparse feature vectors as maps from feature number to value."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from ctrprep.functions import sparsetext
from ctrprep.functions.columns import array_of_present
from ctrprep.functions.sparsetext import CHARACTERS, item_lists

if TYPE_CHECKING:
    from ctrprep.operators.trees import TreeInput

# Parsing travels to the Python workers as code, so that they need not have this package on their path.
cloudpickle.register_pickle_by_value(sparsetext)


def sparse_vector(inputs: Sequence[TreeInput]) -> Column:
    """The inputs of a row as ``map<int, float>``; NULLs are absent, and of equal
    feature numbers the last one counts."""
    entries = []
    for i in inputs:
        if i.feature is None:
            number, value = F.col(i.column).try_cast("int"), F.lit(i.value).cast("float")
        else:
            number, value = F.lit(i.feature), F.col(i.column).try_cast("float")
        entries.append((i.feature, number, value, number.isNotNull() & value.isNotNull()))
    pairs = []
    for k, (fixed, number, value, present) in enumerate(entries):
        for other_fixed, other, _, other_present in entries[k + 1 :]:
            if fixed is None or other_fixed is None or fixed == other_fixed:
                present = present & ~F.coalesce(other_present & (other == number), F.lit(False))
        pairs.append((present, F.struct(number.alias("id"), value.alias("value"))))
    return F.map_from_entries(array_of_present(pairs, "struct<id:int,value:float>"))


def is_plain(vector: Column) -> Column:
    """Whether a text has digits, signs and separators only, so that it is parsed column-wise."""
    return F.coalesce(F.translate(vector, CHARACTERS, "") == F.lit(""), F.lit(False))


def parse_sparse(vector: Column) -> Column:
    """``"id:value,id:value"`` text as ``map<int, float>``; malformed pairs are absent.

    Of equal numbers the last one counts.  Plain texts are parsed by an Arrow UDF for whole batches; others, with blanks or
    exponents, by expressions, with the same outcome where both apply.
    """

    @F.arrow_udf("array<struct<id:int,value:float>>")
    def parse(texts: pa.Array) -> pa.Array:
        return item_lists(texts)

    plain = is_plain(vector)
    return F.when(plain, F.map_from_entries(parse(F.when(plain, vector)))).otherwise(parse_any(F.when(~plain, vector)))


def parse_any(vector: Column) -> Column:
    """The same by expressions, for any text."""

    def pair(item: Column) -> Column:
        number = F.substring_index(item, ":", 1).try_cast("int")
        value = F.when(F.contains(item, F.lit(":")), F.substring_index(item, ":", -1).try_cast("float"))
        return F.struct(number.alias("id"), value.alias("value"))

    def valid_pair(item: Column) -> Column:
        return item["id"].isNotNull() & item["value"].isNotNull()

    def last_ones(valid: Column) -> Column:
        """Sorted by number and place, the pairs before another number are the last of theirs."""
        placed = F.array_sort(
            F.transform(valid, lambda p, at: F.struct(p["id"].alias("id"), at.alias("at"), p["value"].alias("value")))
        )
        # The one-element array gives the sorted pairs a name, so that they are sorted once.
        kept = F.transform(
            F.array(placed),
            lambda rows: F.filter(rows, lambda p, at: ~F.coalesce(F.get(rows, at + F.lit(1))["id"] == p["id"], F.lit(False))),
        )[0]
        return F.transform(kept, lambda p: F.struct(p["id"].alias("id"), p["value"].alias("value")))

    def chosen(valid: Column) -> Column:
        ids = F.transform(valid, lambda p: p["id"])
        unique = F.size(F.array_distinct(ids)) == F.size(valid)
        return F.map_from_entries(F.when(unique, valid).otherwise(last_ones(valid)))

    valid = F.filter(F.transform(F.split(vector, ","), pair), valid_pair)
    return F.transform(F.array(valid), chosen)[0]
