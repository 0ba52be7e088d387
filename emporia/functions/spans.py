"""Shared building blocks for 1-day / n-day / to-date summaries.

All date arithmetic works on ``yyyy-MM-dd`` strings: partition columns are
strings, and string order equals date order for that format.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(16,2)"


def day_offset(do_date: str, days: int) -> Column:
    """``do_date - days`` as a ``yyyy-MM-dd`` string literal expression."""
    return F.date_format(F.date_sub(F.lit(do_date).cast("date"), days), "yyyy-MM-dd")


def shift_date(do_date: str, days: int) -> str:
    """``do_date + days`` computed on the driver (a constant, not data)."""
    import datetime as _dt

    d = _dt.date.fromisoformat(do_date) + _dt.timedelta(days=days)
    return d.isoformat()


def in_window(dt_col: str | Column, do_date: str, days: int) -> Column:
    """``dt`` within the ``days``-long window ending at ``do_date`` (inclusive)."""
    c = F.col(dt_col) if isinstance(dt_col, str) else dt_col
    return (c >= F.lit(shift_date(do_date, -(days - 1)))) & (c <= F.lit(do_date))


def recent_sum(value: str | Column, do_date: str, days: int = 7, dt_col: str = "dt") -> Column:
    """``sum(if(dt >= do_date-(days-1), value, 0))`` — the 7-of-30 conditional sum."""
    v = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(F.col(dt_col) >= F.lit(shift_date(do_date, -(days - 1))), v).otherwise(F.lit(0)))


def money(c: Column) -> Column:
    """Cast back to the warehouse money type after a sum or product."""
    return c.cast(MONEY)


def nd_measures(
    measures: Sequence[tuple[str, str, str]], do_date: str, short: int = 7, long: int = 30
) -> list[Column]:
    """Conditional 7-day sums plus plain 30-day sums from one scan.

    ``measures`` holds ``(input_col, output_stem, type)`` where ``type`` is
    ``"bigint"`` or ``"money"``; output columns are ``{stem}_{short}d`` and
    ``{stem}_{long}d``. The caller has already limited rows to the long window.
    """
    short_cols, long_cols = [], []
    for src, stem, kind in measures:
        cast = MONEY if kind == "money" else "bigint"
        short_cols.append(recent_sum(src, do_date, short).cast(cast).alias(f"{stem}_{short}d"))
        long_cols.append(F.sum(src).cast(cast).alias(f"{stem}_{long}d"))
    return short_cols + long_cols


def explode_spans(df: DataFrame, spans: Iterable[int], name: str = "recent_days") -> DataFrame:
    """One copy of each row per report span (the literal-array generator)."""
    arr = F.array(*[F.lit(int(s)).cast("bigint") for s in spans])
    return df.withColumn(name, F.explode(arr))


def pick_span(recent_days: str, by_span: dict[int, str | Column]) -> Column:
    """``case recent_days when 7 then x_7d when 30 then x_30d end``."""
    expr = None
    for span, col in by_span.items():
        c = F.col(col) if isinstance(col, str) else col
        cond = F.col(recent_days) == F.lit(span)
        expr = F.when(cond, c) if expr is None else expr.when(cond, c)
    return expr


def change_has(old_col: str, key: str) -> Column:
    """Column ``key`` is among the changed columns of an update record."""
    return F.coalesce(F.map_contains_key(F.col(old_col), F.lit(key)), F.lit(False))
