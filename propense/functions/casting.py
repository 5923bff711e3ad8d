"""Strict "can this value be read as ..." tests, as SQL conditions.

Spark's own text casts accept forms a data check must reject (``'1d'`` as a double, ``'2024'`` as a
date) and reject some it must accept (``'2024/01/05'``), so text is matched against a pattern first.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The text forms accepted as a number and as a date or timestamp.
DIGITS = r"[0-9]+(?:_[0-9]+)*"
NUMBER_PATTERN = (
    rf"^\s*[+-]?(?:(?:{DIGITS}(?:\.(?:{DIGITS})?)?|\.{DIGITS})(?:[eE][+-]?[0-9]+)?"
    r"|(?i:inf|infinity|nan))\s*$"
)
DATE_PATTERN = r"^\s*([0-9]{1,6})([-/ ])([0-9]{1,2})\2([0-9]{1,2})"
DATE_TAIL_PATTERN = (
    r"(?:\s*|[ T](?:(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9](?::[0-5]?[0-9](?:\.[0-9]+)?)?|24:00(?::00)?)"
    r"\s*(?:Z|UTC|[+-][0-9]{2}(?::?[0-9]{2})?)?\s*)$"
)
DATE_WORDS = ("epoch", "infinity", "-infinity")

TEXT = (T.StringType, T.CharType, T.VarcharType)


def reads_as_number(field: str, dtype: T.DataType) -> str:
    """True where a non-null value can be read as a double."""
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return f"{field} IS NOT NULL"
    if isinstance(dtype, TEXT):
        return f"{field} RLIKE r'{NUMBER_PATTERN}'"
    return "false"


def reads_as_datetime(field: str, dtype: T.DataType) -> str:
    """True where a non-null value can be read as a date or as a timestamp."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return f"{field} IS NOT NULL"
    if not isinstance(dtype, TEXT):
        return "false"
    year, month, day = (f"regexp_extract({field}, r'{DATE_PATTERN}', {i})" for i in (1, 3, 4))
    # Years below 1000 need leading zeros to be cast.
    date = f"concat_ws('-', lpad({year}, greatest(4, length({year})), '0'), {month}, {day})"
    words = ", ".join(f"'{w}'" for w in DATE_WORDS)
    return (
        f"(lower(trim({field})) IN ({words}) OR ({field} RLIKE r'{DATE_PATTERN}{DATE_TAIL_PATTERN}' "
        f"AND try_cast({date} AS DATE) IS NOT NULL))"
    )
