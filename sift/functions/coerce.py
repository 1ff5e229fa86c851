"""Text coercion that gives one result whether ANSI mode is on or off.

Reading text as an integer cuts the fraction off ('-1.5' is -1, '-0.5' is 0),
and text that is no number, or does not fit, is NULL. Spark's own cast does
this only with ANSI mode off; `try_cast` refuses the fraction. Every other
target type reads text the same way through `try_cast`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
TEXT_TYPES = (T.StringType, T.CharType, T.VarcharType)
DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)

# Characters Spark trims from a number.
_BLANK = r"[\x00-\x20\x7f]*"
# A number with integer digits, and one that begins with its point; up to the
# very end, as `$` lets a line terminator follow, which Spark may not trim.
_NUMBER = rf"^{_BLANK}[+-]?[0-9]+(?:\.[0-9]*)?{_BLANK}\z"
_FRACTION = rf"^{_BLANK}[+-]?\.[0-9]*{_BLANK}\z"

# The texts Spark reads as a boolean, in any case.
_BOOLEAN = r"^[\x00-\x20\x7f]*(?i:t|true|y|yes|1|f|false|n|no|0)[\x00-\x20\x7f]*$"

_ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def integer(text: Column, type_name: str = "int") -> Column:
    """Text as an integer type, fraction cut off, NULL if that is impossible.

    `try_cast` raises and catches an exception for every text it refuses,
    which costs far more than asking a pattern first. Texts of a few plain
    digits, the usual case, take one short pattern; other numbers one longer
    one, and what stands before the point is then short enough to fit, or fits
    a long integer whose range is asked, or is left to `try_cast`.
    """
    target = T.DataType.fromDDL(type_name)
    bits = INTEGER_BITS[type(target)]
    limit = 2 ** (bits - 1)
    always_fits = len(str(limit)) - 1
    whole = F.substring_index(text, ".", 1)
    long = whole.cast("bigint")
    number = F.when(F.length(whole) <= always_fits, whole.cast(type_name))
    if bits < 64:
        in_range = F.when(long.between(-limit, limit - 1), long.cast(type_name))
        number = number.when(F.length(whole) <= 18, in_range)
    number = number.otherwise(whole.try_cast(type_name))
    plain = text.rlike(f"^[+-]?[0-9]{{1,{always_fits}}}\\z")
    return (
        F.when(plain, text.cast(type_name))
        .when(text.rlike(_NUMBER), number)
        .when(text.rlike(_FRACTION), F.lit(0).cast(type_name))
    )


def is_negative(text: Column, *, exact: bool = False) -> Column:
    """Whether text reads as a number below zero; NULL for what is no number.

    The default compares the integer part, so '-0.5' is not negative. `exact`
    compares the number itself, exponents and large values included.
    """
    if exact:
        return text.try_cast("double") < 0
    return integer(text, "int") < 0


def is_moment(text: Column, *, exact: bool = False) -> Column:
    """Whether text reads as a date or time, never NULL.

    The default takes everything Spark can turn into a timestamp: '2024',
    '2024-8-1', '12:30'. `exact` takes only calendar dates yyyy-MM-dd.
    """
    if exact:
        trimmed = F.trim(text)
        return F.coalesce(
            trimmed.rlike(_ISO_DATE) & trimmed.try_cast("date").isNotNull(), F.lit(False)
        )
    return text.try_cast("timestamp_ltz").isNotNull()


def lenient_cast(value: Column, source: T.DataType, type_name: str) -> Column:
    """Cast to a declared type; what cannot be cast becomes NULL."""
    target = T.DataType.fromDDL(type_name)
    if isinstance(source, TEXT_TYPES):
        if type(target) in INTEGER_BITS:
            return integer(value, type_name)
        if isinstance(target, T.BooleanType):
            return F.when(value.rlike(_BOOLEAN), value.try_cast(type_name))
    return value.try_cast(type_name)
