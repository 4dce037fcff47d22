"""Date rules, zone shifts and elapsed times as Spark column expressions.

All wall times are ``TIMESTAMP_NTZ``.  A shift between zones always names both
zones (``convert_timezone``), so the session time zone never changes a result.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reporting window rule of the reference.  The window starts at
# FLOOR_DATE while the Sunday week of (as_of - 1 year) is on or before the
# cut-off, else 3 months back; it ends yesterday.
FLOOR_DATE = _dt.date(2022, 3, 21)
CUTOFF_DATE = _dt.date(2022, 3, 21)
REFUNDS_CUTOFF_DATE = _dt.date(2022, 8, 21)
LOOKBACK_YEARS = 1
RECENT_MONTHS = 3

_UNIT_MICROS = {"SECOND": 1_000_000, "MILLISECOND": 1_000, "MINUTE": 60_000_000}


def _as_col(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, (_dt.date, _dt.datetime)):
        return F.lit(x)
    return F.col(x)


def sunday_week_start(d) -> Column:
    """First day (Sunday) of the week holding ``d``; Spark's own WEEK trunc starts Monday."""
    d = _as_col(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def date_window(as_of, cutoff=CUTOFF_DATE, floor=FLOOR_DATE) -> tuple[Column, Column]:
    """(start, end) of the rolling report window as foldable date columns.

    With literal inputs Catalyst folds both to constants, so the bounds reach
    the Parquet scan as pushed filters.
    """
    as_of = _as_col(as_of).cast("date")
    year_ago = F.add_months(as_of, -12 * LOOKBACK_YEARS)
    start = F.when(sunday_week_start(year_ago) <= F.lit(cutoff), F.lit(floor)) \
             .otherwise(F.add_months(as_of, -RECENT_MONTHS))
    end = F.date_sub(as_of, 1)
    return start, end


def date_window_values(as_of: _dt.date, cutoff: _dt.date = CUTOFF_DATE,
                       floor: _dt.date = FLOOR_DATE) -> tuple[_dt.date, _dt.date]:
    """The same rule on Python dates (used for parameters and tests)."""

    def add_months(d: _dt.date, n: int) -> _dt.date:
        m = d.month - 1 + n
        y, m = d.year + m // 12, m % 12 + 1
        last = (_dt.date(y + (m == 12), m % 12 + 1, 1) - _dt.timedelta(days=1)).day
        return _dt.date(y, m, min(d.day, last))

    year_ago = add_months(as_of, -12 * LOOKBACK_YEARS)
    week = year_ago - _dt.timedelta(days=(year_ago.weekday() + 1) % 7)
    start = floor if week <= cutoff else add_months(as_of, -RECENT_MONTHS)
    return start, as_of - _dt.timedelta(days=1)


def local_to_utc(ts, tz) -> Column:
    """Wall time in zone ``tz`` -> UTC wall time (a gap hour keeps the earlier offset)."""
    return F.convert_timezone(_as_col(tz), F.lit("UTC"), _as_col(ts))


def utc_to_local(ts, tz) -> Column:
    """UTC wall time -> wall time in zone ``tz``."""
    return F.convert_timezone(F.lit("UTC"), _as_col(tz), _as_col(ts))


_EPOCH: dict = {}


def _epoch() -> Column:
    """The NTZ epoch literal, built once per JVM gateway (it appears in every
    boundary difference; building it is a few round trips to the JVM)."""
    from pyspark import SparkContext
    gw = getattr(SparkContext, "_gateway", None)
    hit = _EPOCH.get(id(gw))
    if hit is None or hit[0] is not gw:
        hit = (gw, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
        _EPOCH[id(gw)] = hit
    return hit[1]


def _ticks(ts: Column, unit: str) -> Column:
    micros = F.timestamp_diff("MICROSECOND", _epoch(), ts)
    return micros - F.pmod(micros, F.lit(_UNIT_MICROS[unit]))


def trunc_to_second(ts) -> Column:
    """``ts`` with its fraction of a second dropped (wall time, no zone involved)."""
    ts = _as_col(ts)
    micros = F.timestamp_diff("MICROSECOND", _epoch(), ts)
    return F.timestamp_add("MICROSECOND", -F.pmod(micros, F.lit(1_000_000)), ts)


def boundary_diff(end, start, unit: str = "SECOND") -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end``.

    This is the warehouse DATETIME_DIFF: 00.9 s -> 01.1 s counts 1 second,
    although less than a second passed.  Null if either side is null.
    """
    e, s = _ticks(_as_col(end), unit), _ticks(_as_col(start), unit)
    return ((e - s) / F.lit(_UNIT_MICROS[unit])).cast("long")


def elapsed_sec(end, start, tz=None) -> Column:
    """Second boundaries from ``start`` to ``end``; both shifted from ``tz`` to UTC first."""
    end, start = _as_col(end), _as_col(start)
    if tz is not None:
        end, start = local_to_utc(end, tz), local_to_utc(start, tz)
    return boundary_diff(end, start, "SECOND")


def truncated_ms_sec(end, start, tz=None) -> Column:
    """Millisecond difference / 1000, truncated toward zero, as a double."""
    end, start = _as_col(end), _as_col(start)
    if tz is not None:
        end, start = local_to_utc(end, tz), local_to_utc(start, tz)
    ms = boundary_diff(end, start, "MILLISECOND")
    return (ms / F.lit(1000.0)).cast("long").cast("double")


def add_minutes(ts, minutes) -> Column:
    """``ts`` plus a whole number of minutes given by an expression."""
    return F.timestamp_add("MINUTE", _as_col(minutes).cast("int"), _as_col(ts))


def day_diff(end, start) -> Column:
    return F.datediff(_as_col(end), _as_col(start))
