"""Day and timestamp rules: cut-offs, periods, scan windows, sentinels.

Filters compare the stored column with a typed literal, so they reach the
Parquet scan; nothing wraps the column in a formatting function.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The open end of a period, as text and as a day.
OPEN_END_TEXT = "99991231"
OPEN_END = date(9999, 12, 31)
DAY_PATTERN = "yyyyMMdd"


def as_date(value: date | datetime | str) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(value)


def day_lit(value: date | str) -> Column:
    return F.lit(as_date(value))


def open_end() -> Column:
    return F.lit(OPEN_END)


def parse_day(col: Column | str) -> Column:
    """``yyyyMMdd`` text to a date; text that is no date (``00000000``) gives null."""
    return F.try_to_date(col, DAY_PATTERN)


def day_text(col: Column | str) -> Column:
    return F.date_format(col, DAY_PATTERN)


def _typed(df: DataFrame, name: str, value: datetime) -> Column:
    """Literal of the column's own type, so that no cast lands on the column."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.lit(value.date())
    if isinstance(kind, T.StringType):
        return F.lit(value.strftime("%Y%m%d"))
    return F.lit(value.isoformat(sep=" ")).cast(kind)


def _midnight(day: date | str) -> datetime:
    return datetime.combine(as_date(day), datetime.min.time())


def as_of(df: DataFrame, run_dt: date | str, ts_col: str, inclusive: bool = True) -> DataFrame:
    """Versions extracted on or before the run day, or strictly before it."""
    bound = _midnight(run_dt) + timedelta(days=1 if inclusive else 0)
    return df.filter(F.col(ts_col) < _typed(df, ts_col, bound))


def effective_on(df: DataFrame, day: date | str, from_col: str, to_col: str) -> DataFrame:
    """Rows whose period holds the day, both ends included.

    Text periods also get the plain string range, which every match satisfies
    and which Parquet statistics can use.
    """
    at = as_date(day)
    start, end = F.col(from_col), F.col(to_col)
    if isinstance(df.schema[from_col].dataType, T.StringType):
        text = F.lit(at.strftime("%Y%m%d"))
        df = df.filter((start <= text) & (end >= text))
        start, end = parse_day(start), parse_day(end)
    return df.filter(F.lit(at).between(start, end))


def open_only(df: DataFrame, to_col: str) -> DataFrame:
    """Rows whose period has not ended."""
    return df.filter(F.col(to_col) == _typed(df, to_col, _midnight(OPEN_END)))


def scan_window(df: DataFrame, col: str, run_dt: date | str, before: int = 0, after: int = 0) -> DataFrame:
    """Rows from ``before`` days ahead of the run day to ``after`` days past it."""
    first = _midnight(run_dt) - timedelta(days=before)
    last = _midnight(run_dt) + timedelta(days=after)
    if isinstance(df.schema[col].dataType, (T.DateType, T.StringType)):
        return df.filter(F.col(col).between(_typed(df, col, first), _typed(df, col, last)))
    stop = last + timedelta(days=1)
    return df.filter((F.col(col) >= _typed(df, col, first)) & (F.col(col) < _typed(df, col, stop)))


def incremental_window(
    df: DataFrame, end_ts: datetime, hours: int, extract: str, load: str, load_shift_hours: int = 10
) -> DataFrame:
    """Extracted in the last ``hours`` up to ``end_ts``, or loaded in them.

    Load times are UTC and the window is local, so the window is shifted back
    instead of the column forward. ``hours=0`` switches the filter off.
    """
    if hours == 0:
        return df
    start = end_ts - timedelta(hours=hours)
    shift = timedelta(hours=load_shift_hours)

    def inside(name: str, back: timedelta) -> Column:
        return F.col(name).between(_typed(df, name, start - back), _typed(df, name, end_ts - back))

    return df.filter(inside(extract, timedelta(0)) | inside(load, shift))


def retain_days(df: DataFrame, col: str, as_of_day: date | str, days: int) -> DataFrame:
    """Rows dated at most ``days`` before ``as_of_day``."""
    return df.filter(F.col(col) >= _typed(df, col, _midnight(as_of_day) - timedelta(days=days)))


def recency_flag(col: Column | str, run_dt: date | str, days: int) -> Column:
    """``Y`` when the day is at most ``days`` before the run day, else ``N``."""
    limit = F.lit(as_date(run_dt) - timedelta(days=days))
    value = F.col(col) if isinstance(col, str) else col
    return F.when(value.cast("date") >= limit, "Y").otherwise("N")


def floor_date(col: Column | str, day: date | str) -> Column:
    """Raise days before ``day`` to it; null stays null."""
    value = F.col(col) if isinstance(col, str) else col
    return F.when(value < day_lit(day), day_lit(day)).otherwise(value)


def default_end(col: Column | str, text: bool = False) -> Column:
    """Missing end becomes the open end, in the column's own type."""
    value = F.col(col) if isinstance(col, str) else col
    return F.coalesce(value, F.lit(OPEN_END_TEXT) if text else open_end())


def closed_end(col: Column | str, shift: int) -> Column:
    """End timestamp as a day: open stays open, else moved back ``shift`` days."""
    value = F.col(col) if isinstance(col, str) else col
    day = F.coalesce(value.cast("date"), open_end())
    return F.when(day == open_end(), day).otherwise(F.date_sub(day, shift))


def to_zone(col: Column | str, zone: str) -> Column:
    """UTC wall-clock timestamp to another zone, whatever the session zone is."""
    value = F.col(col) if isinstance(col, str) else col
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), value.cast("timestamp_ntz"))
