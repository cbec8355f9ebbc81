"""Null-safe casts for dirty invoice exports.

Bad input becomes NULL, never an error. Rounding follows the SQL engine the exports were first
loaded with, which differs from Spark's own casts in a few places:

* double to decimal rounds the scaled binary value half away from zero (1.005 gives 1.00);
* text to integer rounds half away from zero ('12.5' gives 13), double to integer half to even;
* text dates take one of four separators and an optional time of day, and need all three parts.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal shapes of the silver tables and the date put in place of unreadable ones.
MONEY = (15, 2)
QUANTITY = (10, 2)
PERCENT = (5, 2)
MISSING_DATE = "1900-01-01"

_TIME_TEXT = r"([ T]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?\s*$"
_DATE_TEXT = r"^\s*(\d{4}([-/\\ ])\d{1,2}\2\d{1,2})" + _TIME_TEXT
_DASHED_TIMESTAMP = r"^\s*\d{4}-\d{1,2}-\d{1,2}" + _TIME_TEXT


def scaled_half_away(value: Column, scale: int) -> Column:
    """``value * 10**scale`` as a whole number, ties away from zero; NULL when it does not fit.

    Twice the scaled value is cut to a whole number, which keeps the half, and is then halved away
    from zero. All of it is primitive arithmetic.
    """
    doubled = (value * float(2 * 10**scale)).try_cast("bigint")
    return F.shiftright(doubled + 1 + F.shiftright(doubled, 63), 1)


def decimal_from_double(value: Column, precision: int, scale: int) -> Column:
    """The whole number is brought to its scale in decimal arithmetic, never through text."""
    whole = scaled_half_away(value, scale).try_cast(T.DecimalType(precision, 0))
    unit = F.lit(Decimal(1).scaleb(-scale)).cast(T.DecimalType(scale, scale))
    return (whole * unit).cast(T.DecimalType(precision, scale))


def decimal_from_text(value: Column, precision: int, scale: int) -> Column:
    return value.try_cast(T.DecimalType(precision, scale))


def integer_from_text(value: Column) -> Column:
    return F.round(F.trim(value).try_cast("decimal(38,10)"), 0).try_cast("int")


def integer_from_double(value: Column) -> Column:
    return F.rint(value).try_cast("int")


def _day_text(value: Column) -> Column:
    """The ``yyyy-m-d`` part of a date or timestamp text, empty where there is none."""
    return F.translate(F.regexp_extract(value, _DATE_TEXT, 1), "/\\ ", "---")


def date_from_text(value: Column) -> Column:
    return _day_text(value).try_cast("date")


def timestamp_from_text(value: Column) -> Column:
    """The common form takes one pattern match; the other separators are tried where it fails."""
    plain = F.regexp_extract(value, _DASHED_TIMESTAMP, 0).try_cast("timestamp_ntz")
    other = F.concat(_day_text(value), F.regexp_extract(value, _DATE_TEXT, 3)).try_cast("timestamp_ntz")
    return F.coalesce(plain, other)


def transaction_date(value: Column) -> Column:
    """Whole text, then its first ten characters, then the missing-date marker."""
    first_ten = date_from_text(F.substring(F.trim(value), 1, 10))
    return F.coalesce(date_from_text(value), first_ten, F.lit(MISSING_DATE).cast("date"))


def phone_first(value: Column) -> Column:
    """Trimmed phone with only its first non-digit removed (what the silver tables hold)."""
    return F.regexp_replace(F.trim(value), r"^([0-9]*)[^0-9]", "$1")


def phone_all(value: Column) -> Column:
    """Trimmed phone reduced to its digits."""
    return F.regexp_replace(F.trim(value), r"[^0-9]", "")


def email(value: Column) -> Column:
    return F.lower(F.trim(value))


def is_blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")


class ColumnCasts:
    """Casts by column name; picks the text, double or exact route from the frame's schema."""

    def __init__(self, df: DataFrame):
        self._df = df
        self._types = {field.name.lower(): field.dataType for field in df.schema.fields}

    def has(self, name: str) -> bool:
        return name.lower() in self._types

    def raw(self, name: str) -> Column:
        """The column, or NULL when this load never had it."""
        return self._df[name] if self.has(name) else F.lit(None).cast("string")

    def _type(self, name: str) -> T.DataType:
        return self._types.get(name.lower(), T.StringType())

    def decimal(self, name: str, shape: tuple[int, int]) -> Column:
        value, dtype = self.raw(name), self._type(name)
        if isinstance(dtype, T.StringType):
            return decimal_from_text(value, *shape)
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            return decimal_from_double(value.cast("double"), *shape)
        return value.try_cast(T.DecimalType(*shape))

    def money(self, name: str) -> Column:
        return self.decimal(name, MONEY)

    def quantity(self, name: str) -> Column:
        return self.decimal(name, QUANTITY)

    def percent(self, name: str) -> Column:
        return self.decimal(name, PERCENT)

    def integer(self, name: str) -> Column:
        value, dtype = self.raw(name), self._type(name)
        if isinstance(dtype, T.StringType):
            return integer_from_text(value)
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            return integer_from_double(value.cast("double"))
        return value.try_cast("int")

    def number(self, name: str) -> Column:
        return self.raw(name).try_cast("double")

    def text(self, name: str) -> Column:
        return F.trim(self.raw(name).cast("string"))

    def day(self, name: str) -> Column:
        if isinstance(self._type(name), T.StringType):
            return date_from_text(self.raw(name))
        return self.raw(name).try_cast("date")

    def transaction_day(self, name: str, day: Column | None = None) -> Column:
        """``day`` hands in the cast of the whole value where it was made already."""
        whole = self.day(name) if day is None else day
        parts = [whole]
        if isinstance(self._type(name), T.StringType):
            parts.append(date_from_text(F.substring(F.trim(self.raw(name)), 1, 10)))
        return F.coalesce(*parts, F.lit(MISSING_DATE).cast("date"))

    def timestamp(self, name: str) -> Column:
        if isinstance(self._type(name), T.StringType):
            return timestamp_from_text(self.raw(name))
        return self.raw(name).try_cast("timestamp_ntz")
