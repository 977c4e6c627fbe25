"""Small column expressions: typed comparison, fixed point, field access."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def require_columns(df: DataFrame, names) -> None:
    """Raise before any job runs when a configured column does not exist."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"unknown column(s) {missing}; have {df.columns}")


def text(name: str) -> Column:
    return F.col(name).cast("string")


def trimmed(value: Column) -> Column:
    """Without blanks and control characters at either end."""
    return F.btrim(value, F.lit("".join(map(chr, range(0x21)))))


def key_text(name: str) -> Column:
    """A column's value as it enters the feature map and is looked up there."""
    return trimmed(text(name))


def whole_number(df: DataFrame, name: str) -> Column:
    """A column's value as bigint, NULL where it is none."""
    require_columns(df, [name])
    if isinstance(df.schema[name].dataType, _WHOLE_TYPES):
        return F.col(name).cast("bigint")
    return key_text(name).try_cast("bigint")


def equals_text(df: DataFrame, name: str, value: str) -> Column:
    """``column == value`` as text, in the column's own type where that is the
    same thing, so that the predicate can reach the file scan."""
    require_columns(df, [name])
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.col(name) == F.lit(value)
    if isinstance(kind, _WHOLE_TYPES):
        number = _whole_number(value)
        if number is None or str(number) != value:
            return F.lit(False)
        return F.col(name) == F.lit(number)
    return text(name) == F.lit(value)


def equals_int(df: DataFrame, name: str, value: str) -> Column:
    """``column == value`` after parsing both as integers; text that is no
    integer matches nothing."""
    require_columns(df, [name])
    number = _whole_number(value)
    if number is None:
        raise ValueError(f"condition value {value!r} for {name} is not an integer")
    kind = df.schema[name].dataType
    if isinstance(kind, _WHOLE_TYPES):
        return F.col(name) == F.lit(number)
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        # A cast to whole numbers would cut 1.5 to 1.
        return F.coalesce(F.col(name) == F.lit(number).cast(kind), F.lit(False))
    return F.coalesce(F.col(name).try_cast("bigint") == F.lit(number), F.lit(False))


def _whole_number(value: str) -> int | None:
    try:
        return int(value)
    except ValueError:
        return None


def any_of(predicates: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates, F.lit(False))


def fixed_point(column: Column, factor: float, precision: str = "float") -> Column:
    """``floor(column * factor)`` as bigint.  The value passes through single
    precision first, as the stored ids depend on it (0.02 at 100000 is 1999);
    ``precision='double'`` skips that."""
    if precision not in ("float", "double"):
        raise ValueError(f"precision {precision!r} is neither 'float' nor 'double'")
    return F.floor(column.cast(precision).cast("double") * F.lit(float(factor))).cast("bigint")


def array_of_present(items: list[tuple[Column, Column]], kind: str) -> Column:
    """An array of the items whose condition holds, ``(condition, item)`` each.
    Joining short arrays compiles, where filtering one array is interpreted."""
    none = F.array().cast(f"array<{kind}>")
    if not items:
        return none
    return F.concat(*[F.when(present, F.array(item)).otherwise(none) for present, item in items])


def fields(line: Column, separator: str, keep_trailing: bool = True) -> Column:
    """Split a delimited line; ``keep_trailing=False`` drops empty fields at the end."""
    if not keep_trailing:
        line = F.rtrim(line, F.lit(separator))
    return F.split(line, _literal(separator), -1)


def _literal(separator: str) -> str:
    """The separator as a pattern; in this form a single character is split on
    without compiling a pattern per row."""
    return "".join("\\" + c if c in r".$|()[]{}^?*+\\" else c for c in separator)


def field(parts: Column, index: int) -> Column:
    """Field ``index``, NULL on a short line."""
    return F.get(parts, F.lit(index))
