"""Text-to-number casts that behave the same under ANSI and non-ANSI sessions.

Raw wave files arrive as text. A plain ``cast`` throws on bad text when ANSI
mode is on (the Spark 4 default) and silently returns null when it is off, so
the contract uses ``try_cast`` throughout. Integer columns additionally accept
decimal text truncated toward zero (``"9.7"`` -> 9), which is what a non-ANSI
cast has always done; exponent notation stays unparseable (null).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, LongType, StringType


def lenient_int(text: Column, target: DataType = IntegerType()) -> Column:
    """``' 9 '`` -> 9, ``'9.7'`` -> 9, ``'-3.2'`` -> -3; bad text, exponents, overflow -> null.

    Plain integer text takes the direct cast; only text that fails it pays for
    the decimal parse (``coalesce`` evaluates its second branch lazily).
    """
    t = F.trim(text)
    direct = t.try_cast(target)
    has_exponent = t.contains("e") | t.contains("E")
    via_decimal = F.when(~has_exponent, t.try_cast("decimal(38,18)").try_cast(target))
    return F.coalesce(direct, via_decimal)


def lenient_double(text: Column) -> Column:
    """Text -> double; unparseable -> null. NaN / Infinity text parse as such."""
    return F.trim(text).try_cast(DoubleType())


def parse_as(value: Column, source: DataType, target: DataType) -> Column:
    """Coerce one raw column to its contract type without ever failing the job."""
    if source == target:
        return value
    if isinstance(source, StringType):
        if isinstance(target, (IntegerType, LongType)):
            return lenient_int(value, target)
        if isinstance(target, DoubleType):
            return lenient_double(value)
    return value.try_cast(target)
