"""Text expressions. All are built-in functions and stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pattern a valid e-mail address has to match.
EMAIL_PATTERN = r"^([a-zA-Z0-9_\-\.]+)@([a-zA-Z0-9_\-\.]+)\.([a-zA-Z]{2,5})$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_email(value: Column | str) -> Column:
    return _col(value).rlike(EMAIL_PATTERN)


def email_domain(value: Column | str) -> Column:
    """Text after the first @, or '' when there is none."""
    return F.regexp_extract(_col(value), "(?<=@).+", 0)


def mask_tail(value: Column | str, keep: int = 2) -> Column:
    """Stars for all but the last ``keep`` characters; shorter texts come out as they are."""
    value = _col(value)
    return F.concat(F.repeat(F.lit("*"), F.length(value) - keep), F.right(value, F.lit(keep)))


def first_char(value: Column | str) -> Column:
    return F.substring(_col(value), 1, 1)
