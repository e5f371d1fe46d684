"""Text from JSON records to the declared column types."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemart.schemas import Table

BAD_VALUES = "_bad_values"
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_DECIMAL = re.compile(r"DECIMAL\((\d+),(\d+)\)")

# Digits beyond a decimal column's scale: True cuts them off, False rounds half up.
TRUNCATE_DECIMALS = True


# Milliseconds that a timestamp can hold.
_MILLIS = (1 << 63) // 1000

# Digits that a decimal is read with behind its point.
_PLACES = 18


# Text of up to so many characters has no digit behind the 18th.
_SHORT = _PLACES + 1


def _exact(text: Column) -> Column:
    """A number as it is spelled (39, 39.0, 1.541e12), its digits behind the 18th cut off.

    With an exponent, digits behind the 18th are rounded.
    """
    cut = F.regexp_replace(text, rf"^(\s*[+-]?\d*\.\d{{{_PLACES}}})\d+(\s*)$", "$1")
    return F.when(F.length(text) > _SHORT, cut).otherwise(text).try_cast(f"decimal(38,{_PLACES})")


def _whole(exact: Column, text: Column, type_name: str) -> Column:
    tail = (F.length(text) > _SHORT) & text.rlike(rf"\.\d{{{_PLACES}}}\d*[1-9]")
    return F.when(~((exact != F.floor(exact)) | tail), exact.cast("decimal(20,0)")).try_cast(type_name)


def to_whole(text: Column, type_name: str) -> Column:
    """A whole number in any spelling; a fraction or too large a number is NULL."""
    return _whole(_exact(text), text, type_name)


def _from_millis(millis: Column) -> Column:
    known = F.when(millis.between(-_MILLIS, _MILLIS), millis)
    return F.timestamp_add("MILLISECOND", known, F.expr(EPOCH))


def epoch_millis(text: Column) -> Column:
    """Epoch milliseconds to a timestamp without zone, whatever the session zone is."""
    return _from_millis(to_whole(text, "bigint"))


def _decimal(exact: Column, precision: int, scale: int, truncate: bool) -> Column:
    if truncate:
        digits = F.lit(scale)
        exact = F.when(exact < 0, F.ceil(exact, digits)).otherwise(F.floor(exact, digits))
    return exact.try_cast(f"decimal({precision},{scale})")


def to_decimal(text: Column, precision: int, scale: int, truncate: bool = TRUNCATE_DECIMALS) -> Column:
    """Text to DECIMAL(precision, scale)."""
    return _decimal(_exact(text), precision, scale, truncate)


def _typed(exact: Column, text: Column, type_name: str) -> Column:
    decimal = _DECIMAL.fullmatch(type_name)
    if decimal:
        return _decimal(exact, int(decimal[1]), int(decimal[2]), TRUNCATE_DECIMALS)
    return _whole(exact, text, type_name)


def to_type(text: Column, type_name: str) -> Column:
    """One text column to one declared type; text that does not fit is NULL."""
    if type_name == "STRING":
        return text
    return epoch_millis(text) if type_name == "TIMESTAMP_NTZ" else _typed(_exact(text), text, type_name)


def _number(exact: Column, text: Column, type_name: str) -> Column:
    """A column's number; of a timestamp its milliseconds."""
    return _typed(exact, text, "bigint" if type_name == "TIMESTAMP_NTZ" else type_name)


def coerce(
    texts: DataFrame, table: Table, on_bad_value: str = "fail", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Type every column of `table` from text; columns named in `keep` pass unchanged.

    Blank text is NULL. Other text that does not fit its column is a bad value: it fails the
    job, becomes NULL, or with "reject" is listed in the column `_bad_values`.
    """
    numbers = [c for c in table.columns if c.value_type != "STRING"]
    # Each step in a projection of its own: what is used more than once is then worked out once.
    exact, value = ({c.name: f"{c.name} {step}" for c in numbers} for step in ("exact", "typed"))
    read = texts.withColumns({exact[c.name]: _exact(F.col(c.name)) for c in numbers})
    read = read.withColumns({value[c.name]: _number(F.col(exact[c.name]), F.col(c.name), c.value_type) for c in numbers})
    typed, listed = [], []
    for c in table.columns:
        text = F.col(c.name)
        if c not in numbers:
            typed.append(text)
            continue
        fitted = F.col(value[c.name])
        if c.value_type == "TIMESTAMP_NTZ":
            fitted = _from_millis(fitted)
        bad = fitted.isNull() & (F.trim(text) != "")
        if on_bad_value == "reject":
            entry = F.struct(F.lit(c.name).alias("column_name"), text.alias("value"))
            listed.append(F.when(bad, entry))
        if on_bad_value == "fail":
            message = F.concat(F.lit(f"BAD_VALUE: {table.name}.{c.name}: "), text)
            fitted = F.when(bad, F.raise_error(message).cast(c.value_type)).otherwise(fitted)
        typed.append(fitted.alias(c.name))
    if on_bad_value == "reject":
        typed.append(F.filter(F.array(*listed), lambda x: x.isNotNull()).alias(BAD_VALUES))
    return read.select(*typed, *keep)
