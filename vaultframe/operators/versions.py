"""Picking versions of a satellite.

``row_number() = 1`` is recognised by Spark as a group limit: every input
partition keeps one row per key before the shuffle, so a hot key sends at most
one row per task. The same holds for ``rank() = 1`` and ``row_number() <= 2``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultframe.functions.dates import day_text, open_end
from vaultframe.operators import windows

DELETED = "D"


def newest(*cols: str) -> list[Column]:
    """Ordering that puts the largest value first and nulls last."""
    return [F.col(c).desc_nulls_last() for c in cols]


def oldest(*cols: str) -> list[Column]:
    """Ordering that puts the smallest value first and nulls last."""
    return [F.col(c).asc_nulls_last() for c in cols]


def not_deleted(change_col: str = "change_type") -> Column:
    return F.col(change_col) != DELETED


def first_per_key(df: DataFrame, keys: Iterable[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")


def first_rank(df: DataFrame, keys: Iterable[str], order: list[Column]) -> DataFrame:
    """All rows of a key that share the first place in ``order``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rk", F.rank().over(window)).filter("__rk = 1").drop("__rk")


def current_version(
    df: DataFrame,
    keys: Iterable[str],
    order: list[Column],
    pre: Column | None = None,
    post: Column | None = None,
) -> DataFrame:
    """First version of every key.

    ``pre`` filters before ranking, so an older version can come to the front;
    ``post`` filters the winners, so the key disappears when its newest version
    fails. ``order`` should end in tie-breakers that make the choice unique.
    """
    if pre is not None:
        df = df.filter(pre)
    df = first_per_key(df, keys, order)
    return df if post is None else df.filter(post)


def live(
    df: DataFrame,
    keys: Iterable[str],
    order: list[Column],
    deleted: str = "after",
    change_col: str = "change_type",
) -> DataFrame:
    """Versions that count as alive under one of three tombstone rules.

    ``after``  the newest version decides: a deleted key is gone.
    ``before`` tombstones are ignored: the last version before one resurfaces.
    ``all``    every version that is no tombstone, without ranking.
    """
    if deleted == "after":
        return current_version(df, keys, order, post=not_deleted(change_col))
    if deleted == "before":
        return current_version(df, keys, order, pre=not_deleted(change_col))
    if deleted == "all":
        return df.filter(not_deleted(change_col))
    raise ValueError(f"unknown tombstone rule: {deleted}")


def current_per_day(df: DataFrame, keys: list[str], ts: str, ties: Iterable[str] = ()) -> DataFrame:
    """Last version of every key and calendar day."""
    daily = df.withColumn("__day", F.col(ts).cast("date"))
    return first_per_key(daily, [*keys, "__day"], newest(ts, *ties)).drop("__day")


def validity_from_versions(
    df: DataFrame, keys: list[str], ts: str, ties: Iterable[str] = (), text: bool = False, daily: bool = False
) -> DataFrame:
    """Versions to periods: from the extract day to the next version's day.

    The last version stays open. Days come as dates, or as ``yyyyMMdd`` text. ``daily`` says that a key
    has one row a day at most, as after :func:`current_per_day`: its window is bounded by the calendar, and
    the input is read once.
    """
    rows = df.withColumn("valid_from", F.col(ts).cast("date"))
    if daily:
        following = F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from"))
        periods = rows.withColumn("valid_to", following)
    else:
        periods = windows.next_value(rows, keys, [ts, *ties], {"valid_to": "valid_from"})
    periods = periods.withColumn("valid_to", F.coalesce("valid_to", open_end()))
    if text:
        periods = periods.withColumns({c: day_text(c) for c in ("valid_from", "valid_to")})
    return periods


def eav_attribute(
    df: DataFrame,
    keys: list[str],
    attribute: str,
    alias: str,
    name: str = "fname",
    value: str = "value",
    period: tuple[str, str] = ("ab", "bis"),
) -> DataFrame:
    """One attribute of a name/value satellite, with its own period."""
    return df.filter((F.col(name) == attribute) & F.col(value).isNotNull()).select(
        *keys,
        F.col(value).alias(alias),
        F.col(period[0]).alias(f"{alias}_from"),
        F.col(period[1]).alias(f"{alias}_to"),
    )


def eav_columns(df: DataFrame, keys: list[str], names: Iterable[str], name: str = "fname", value: str = "value") -> DataFrame:
    """Named attributes side by side, one row per key; needs one row per key and name."""
    wanted = list(names)
    return (
        df.filter(F.col(name).isin(*wanted))
        .groupBy(*keys)
        .agg(*[F.max(F.when(F.col(name) == n, F.col(value))).alias(n) for n in wanted])
    )


def top2_values(df: DataFrame, keys: list[str], value: str, order: list[Column], names: tuple[str, str]) -> DataFrame:
    """First row of every key with the value of the row after it beside its own."""
    window = Window.partitionBy(*keys).orderBy(*order)
    pair = df.withColumn("__rn", F.row_number().over(window)).filter("__rn <= 2")
    return (
        pair.withColumn(names[1], F.lead(value).over(window))
        .filter("__rn = 1")
        .withColumn(names[0], F.col(value))
        .drop("__rn")
    )
