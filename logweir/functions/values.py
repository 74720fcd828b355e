"""Typed values of the `$...$` tokens."""

from pyspark.sql import Column
from pyspark.sql import functions as F

VALUE_TYPE = "decimal(38,10)"

_NUMBER = r"\A[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"
_PARTS = r"\A[+-]?(\d*)\.?(\d*)[eE]?([+-]?\d*)\z"
# Two characters per part; a sign in place of the tens digit is taken, as integer parsing does.
_TIME_OF_DAY = r"\A(\+\d|-0|\d\d):(\+\d|-0|\d\d)\z"


def is_number(text: Column) -> Column:
    return text.rlike(_NUMBER)


def number(text: Column) -> Column:
    """Decimal value, or null if it does not fit (keep the text beside it)."""
    return text.try_cast(VALUE_TYPE)


def is_exact(text: Column) -> Column:
    """Whether a number fits into the decimal type without loss of digits.

    Its lowest digit other than zero must not stand beyond the tenth decimal place.
    """
    parts = [F.regexp_extract(text, _PARTS, i) for i in (1, 2, 3)]
    digits = F.concat(parts[0], parts[1])
    zeros = F.length(digits) - F.length(F.rtrim(digits, F.lit("0")))
    exponent = F.when(parts[2] == "", 0).otherwise(parts[2].try_cast("int"))
    places = F.length(parts[1]) - zeros - exponent
    plain = ~text.rlike(r"[eE]|\.\d{11}")
    fits = plain | (F.rtrim(digits, F.lit("0")) == "") | F.coalesce(places <= 10, F.lit(False))
    return number(text).isNotNull() & fits


def minutes_of_day(text: Column) -> Column:
    """`HH:mm` to minutes after midnight, null when it is no time of day."""
    hours = F.substring(text, 1, 2).try_cast("int")
    minutes = F.substring(text, 4, 2).try_cast("int")
    return F.when(
        text.rlike(_TIME_OF_DAY) & hours.between(0, 23) & minutes.between(0, 59),
        hours * 60 + minutes,
    )
