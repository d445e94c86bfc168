"""Column functions. All are built-in expressions, so they stay inside code generation."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F, types as T

from cohortica import fixed


def ilike_any(column: Column, patterns: list[str]) -> Column:
    """True when the text matches any LIKE pattern, ignoring case."""
    return reduce(lambda a, b: a | b, [column.ilike(p) for p in patterns])


def nan_to_null(column: Column, data_type: T.DataType) -> Column:
    """The column with NaN turned into NULL; other types pass through."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column)
    return column


def na_to_null(column: Column, tokens: list[str] = fixed.NA_TOKENS) -> Column:
    """Text with every missing-value token turned into NULL."""
    return F.when(~column.isin(tokens), column)


def clean_number(column: Column) -> Column:
    """Text or number as double; unreadable text and NaN become NULL."""
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def pair_part(column: Column, index: int, separator: str = "/") -> Column:
    """Part `index` of separated text, NULL where the text has no such part."""
    return F.get(F.split(column, separator), index)


def presence_flag(column: Column) -> Column:
    return column.isNotNull().cast("int")


def plausible(column: Column, above: float) -> Column:
    """The value where it lies above the cut, else NULL."""
    return F.when(column > F.lit(float(above)), column)


def bmi(weight_kg: Column, height_cm: Column) -> Column:
    metres = height_cm / F.lit(100.0)
    return F.try_divide(weight_kg, metres * metres)


def _test(column: Column, kind: str, text: str) -> Column:
    if kind == "contains":
        return column.contains(text)
    if kind == "startswith":
        return column.startswith(text)
    if kind == "equals":
        return column == F.lit(text)
    raise ValueError(f"unknown test {kind!r}")


def first_match(column: Column, rules, default: str) -> Column:
    """Name of the first rule that hits; NULL text falls to the default."""
    result = None
    for group, tests in rules:
        hit = reduce(lambda a, b: a | b, [_test(column, kind, text) for kind, text in tests])
        result = F.when(hit, group) if result is None else result.when(hit, group)
    return result.otherwise(default)


def group_race(column: Column) -> Column:
    return first_match(F.upper(column), fixed.RACE_GROUPS, fixed.RACE_DEFAULT)


def group_admission_type(column: Column) -> Column:
    return first_match(column, fixed.ADMIT_TYPE_GROUPS, fixed.ADMIT_TYPE_DEFAULT)


def group_admission_location(column: Column) -> Column:
    return first_match(column, fixed.ADMIT_LOCATION_GROUPS, fixed.ADMIT_LOCATION_DEFAULT)


def strip_prefix(column: Column, prefix: str) -> Column:
    return F.regexp_replace(column, "^" + re.escape(prefix), "")


def typed_value(column: Column) -> Column:
    """Text as struct(as_int, as_double, as_text): one is set, none for the text "none".

    Whole numbers (an optional minus and digits) fill as_int, other numbers as_double, the rest
    as_text. The cast of trimmed "nan"/"inf" words follows Spark's double parser.
    """
    value = F.when(F.lower(column) != "none", column)
    whole = value.rlike("^-?[0-9]+$")
    as_int = F.when(whole, value.try_cast("bigint"))
    as_double = F.when(as_int.isNull(), value.try_cast("double"))
    as_text = F.when(as_int.isNull() & as_double.isNull(), value)
    return F.struct(as_int.alias("as_int"), as_double.alias("as_double"), as_text.alias("as_text"))
