"""Business-time rendering.

Log ``ts`` is epoch milliseconds, change-record ``ts`` is epoch seconds; both
are shown in GMT+8 as ``yyyy-MM-dd`` / ``yyyy-MM-dd HH:mm:ss`` text.
``timestamp_millis`` is used first because ``from_utc_timestamp`` rejects a
bare BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the warehouse renders all business times in this zone.
BUSINESS_TZ = "GMT+8"
DATE_FMT = "yyyy-MM-dd"
TIME_FMT = "yyyy-MM-dd HH:mm:ss"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_ts_from_ms(ms: str | Column) -> Column:
    return F.from_utc_timestamp(F.timestamp_millis(_col(ms)), BUSINESS_TZ)


def local_ts_from_s(sec: str | Column) -> Column:
    return F.from_utc_timestamp(F.timestamp_millis(_col(sec) * F.lit(1000)), BUSINESS_TZ)


def date_from_ms(ms: str | Column) -> Column:
    return F.date_format(local_ts_from_ms(ms), DATE_FMT)


def time_from_ms(ms: str | Column) -> Column:
    return F.date_format(local_ts_from_ms(ms), TIME_FMT)


def date_from_s(sec: str | Column) -> Column:
    return F.date_format(local_ts_from_s(sec), DATE_FMT)


def time_from_s(sec: str | Column) -> Column:
    return F.date_format(local_ts_from_s(sec), TIME_FMT)


def date_of_text(text: str | Column) -> Column:
    """``date_format('yyyy-MM-dd HH:mm:ss' text, 'yyyy-MM-dd')`` without a parse."""
    return F.substring(_col(text), 1, 10)
