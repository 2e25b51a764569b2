"""Time expressions. The session time zone is expected to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Five folder levels, year to minute, each either a bare number or name=number.
TIME_FOLDERS = r"/(?:\w+=)?(\d{4})/(?:\w+=)?(\d{1,2})/(?:\w+=)?(\d{1,2})/(?:\w+=)?(\d{1,2})/(?:\w+=)?(\d{1,2})/[^/]+$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_micros(value: Column | str) -> Column:
    return F.unix_micros(_col(value).cast("timestamp"))


def from_micros(value: Column | str) -> Column:
    """Exact for every long; dividing by 1e6 first would lose microseconds to rounding."""
    return F.timestamp_micros(_col(value)).cast("timestamp_ntz")


def day_of(value: Column | str) -> Column:
    return F.date_trunc("DD", _col(value)).cast("timestamp_ntz")


def folder_time(path: Column | str) -> Column:
    """Time named by the yyyy/MM/dd/HH/mm folders of a file path; NULL where there are none."""
    path = _col(path)
    year, month, day, hour, minute = (
        F.regexp_extract(path, TIME_FOLDERS, i).try_cast("int") for i in range(1, 6)
    )
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, F.lit(0))
