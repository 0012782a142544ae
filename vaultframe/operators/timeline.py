"""Cutting dated attributes into one timeline per key."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultframe.functions.dates import day_lit
from vaultframe.operators import windows
from vaultframe.operators.joins import FEW_PAIRS, overlap_join
from vaultframe.operators.versions import first_per_key, first_rank


def boundaries(df: DataFrame, keys: list[str], cols: list[str], name: str = "day") -> DataFrame:
    """Distinct boundary days of a key, nulls left out.

    A row's own duplicates are folded before it is expanded, and the distinct
    folds again before the shuffle; afterwards a key has at most one row per day
    of the calendar, which bounds every window of this module.
    """
    days = F.array_compact(F.array_distinct(F.array(*cols)))
    return df.select(*keys, F.explode(days).alias(name)).distinct()


def all_boundaries(parts: list[tuple[DataFrame, list[str]]], keys: list[str], name: str = "day") -> DataFrame:
    """Boundaries of several attribute tables, gathered without joining them."""
    found = [boundaries(df, keys, cols, name) for df, cols in parts]
    return reduce(DataFrame.unionByName, found).distinct()


def slices(days: DataFrame, keys: list[str], name: str = "day") -> DataFrame:
    """Each boundary up to the next one; the last boundary has no end."""
    window = Window.partitionBy(*keys).orderBy(name)
    return days.select(*keys, F.col(name).alias("from_dt"), F.lead(name).over(window).alias("to_dt"))


def clean_slices(df: DataFrame, keys: list[str], min_days: int = 1, min_end: date | str | None = None) -> DataFrame:
    """Drop slices of ``min_days`` or less, then make neighbours disjoint.

    The end moves back one day only when the next *kept* slice starts on it, so
    a dropped slice leaves a hole and the last slice keeps its end.
    """
    kept = df.filter(F.datediff("to_dt", "from_dt") > min_days)
    if min_end is not None:
        kept = kept.filter(F.col("to_dt") >= day_lit(min_end))
    following = F.lead("from_dt").over(Window.partitionBy(*keys).orderBy("from_dt"))
    return kept.withColumn("__next", following).withColumn(
        "to_dt", F.when(F.col("__next") == F.col("to_dt"), F.date_sub("to_dt", 1)).otherwise(F.col("to_dt"))
    ).drop("__next")


def timeline(parts: list[tuple[DataFrame, list[str]]], keys: list[str], min_end: date | str | None = None) -> DataFrame:
    """Cleaned slices over the boundaries of several attribute tables."""
    return clean_slices(slices(all_boundaries(parts, keys), keys), keys, min_end=min_end)


def time_slice(
    slices_df: DataFrame,
    keys: list[str],
    attributes: list[tuple[DataFrame, tuple[str, str], str]],
    few_pairs: int | None = FEW_PAIRS,
) -> DataFrame:
    """Attach attributes to slices: each item is (frame, period columns, how).

    Every attribute is matched against the slices alone and the matches are then
    joined on the slice, so the plan grows with the number of attributes and not
    with their combinations.
    """
    out = slices_df
    for frame, period, how in attributes:
        matches = overlap_join(slices_df, frame, keys, ("from_dt", "to_dt"), period, "inner", few_pairs)
        out = out.join(matches, [*keys, "from_dt", "to_dt"], how)
    return out


def dedup_slices(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per slice key."""
    return first_per_key(df, keys, order)


def rank_slices(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Every row of a slice that shares the best priority."""
    return first_rank(df, keys, order)


def array_timeline(
    df: DataFrame,
    keys: list[str],
    starts: list[str],
    ends: list[str],
    removal: str,
    ties: list[str],
    slice_by: Column | None = None,
) -> DataFrame:
    """Timeline of rows carrying several periods side by side.

    The row ends at its earliest end. Rows with a start after that end are
    dropped; a missing start or end passes. The row begins at its first start
    later than the end of the row before it, or at its first start when there is
    none, and ends no later than ``removal``. ``ties`` order rows of equal end.
    """
    consistent = [F.col(s).isNull() | F.col("min_to").isNull() | (F.col(s) <= F.col("min_to")) for s in starts]
    rows = df.withColumn("min_to", F.array_min(F.array(*ends))).filter(reduce(lambda a, b: a & b, consistent))
    rows = windows.previous_value(rows, keys, ["min_to", *ties], {"__last_to": "min_to"}, slice_by)
    ordered = F.array_sort(F.array(*starts))
    later = F.filter(ordered, lambda d: d > F.col("__last_to"))
    return rows.withColumns(
        {
            "timeline_from": F.coalesce(F.try_element_at(later, F.lit(1)), F.try_element_at(ordered, F.lit(1))),
            "timeline_to": F.when(F.col("min_to") > F.col(removal), F.col(removal)).otherwise(F.col("min_to")),
        }
    ).drop("__last_to")


def leading_gap(df: DataFrame, keys: list[str], start: str, first: str) -> DataFrame:
    """The stretch from the key's start to the day before its first event."""
    return df.groupBy(*keys, F.col(start).alias("from_dt")).agg(F.date_sub(F.min(first), 1).alias("to_dt"))


def span(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """One period per key: earliest start, latest end."""
    return df.groupBy(*keys).agg(F.min(start).alias(start), F.max(end).alias(end))


def interval_keys(df: DataFrame, end: str, length_s: str) -> DataFrame:
    """Read date and sequence number of interval reads.

    The date is that of the interval's beginning, so a read at midnight belongs
    to the day before; whole minutes of the length count. The sequence is the
    number of lengths since that day's midnight.
    """
    whole_minutes = F.floor(F.col(length_s) / 60).cast("int")
    begin = F.col(end) - F.make_dt_interval(mins=whole_minutes)
    day = begin.cast("date")
    seconds = (
        F.datediff(F.col(end).cast("date"), day) * 86400
        + F.hour(end) * 3600
        + F.minute(end) * 60
        + F.second(end)
    )
    return df.withColumns(
        {
            "read_date": day,
            "read_dt": F.date_format(day, "yyyyMMdd").cast("int"),
            "interval_seq_num": (seconds / F.col(length_s)).cast("int"),
        }
    )
