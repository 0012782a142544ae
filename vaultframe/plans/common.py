"""Conventions shared by the data products.

Satellites carry ``extract_ts``, ``seq`` (load order, the tie-breaker of equal
extract times) and ``change_type`` beside their parent key and payload. Same-as
links carry ``salnk_key`` with the hub keys ``key1``, ``key2`` (``key3``).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame

from vaultframe.functions.dates import as_of, effective_on
from vaultframe.functions.keys import pack
from vaultframe.operators.versions import live, newest


def latest_first() -> list[Column]:
    return newest("extract_ts", "seq")


def packed_keys(*frames: DataFrame) -> list[DataFrame]:
    """The frames with their hash keys (``*_key``, ``key1`` to ``key3``) packed, as they travel through a plan's shuffles.

    All frames that meet on a key must pass through here, a key of a type other than text stays as it is.
    """
    return [pack(df, *[c for c in df.columns if c.endswith("_key") or c in ("key1", "key2", "key3")]) for df in frames]


def distinct_by(df: DataFrame, key: str) -> DataFrame:
    """Distinct rows, dealt by the key of the join that follows: both share one shuffle.

    For rows that are nearly distinct already; others are folded before their shuffle by a plain ``distinct``.
    """
    return df.repartition(key).distinct()


def current(
    sat: DataFrame,
    keys: list[str],
    run_dt: date | str | None = None,
    *,
    inclusive: bool = True,
    period: tuple[str, str] | None = None,
    pre: Column | None = None,
    post: Column | None = None,
    order: list[Column] | None = None,
    deleted: str = "after",
) -> DataFrame:
    """Current rows of a satellite: cut-off, effective day, filter, rank, tombstone, filter."""
    if run_dt is not None:
        sat = as_of(sat, run_dt, "extract_ts", inclusive)
        if period is not None:
            sat = effective_on(sat, run_dt, *period)
    if pre is not None:
        sat = sat.filter(pre)
    rows = live(sat, keys, order or latest_first(), deleted)
    return rows if post is None else rows.filter(post)
