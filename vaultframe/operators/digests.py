"""Comparing two tables by a tree of digests.

Keys are dealt by hash into ``FANOUT`` ranges and each again into ``FANOUT``. A range's digest is free of order:
its row count, and the xor and sum of its row hashes. Two tables whose digests agree are equal and no row
of either has been moved or joined; where a range differs, only its rows are looked at closer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FANOUT = 256


def _ranges(keys: list[str]) -> tuple[Column, Column]:
    spread = F.xxhash64(*keys)
    return F.pmod(spread, F.lit(FANOUT)), F.pmod(F.shiftright(spread, 20), F.lit(FANOUT))


def digests(df: DataFrame, keys: list[str], values: list[str], by: list[Column]) -> DataFrame:
    """``n``, ``x`` and ``s`` of the rows in each range; folded before the shuffle to a row a range and task."""
    names = [f"r{k}" for k in range(len(by))]
    rows = df.select(*[c.alias(n) for c, n in zip(by, names, strict=True)], F.xxhash64(*keys, *values).alias("h"))
    return rows.groupBy(*names).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")
    )


def _differing(first: DataFrame, second: DataFrame, keys: list[str], values: list[str], by: list[Column]) -> list[tuple]:
    a, b = ({tuple(r[: len(by)]): tuple(r[len(by) :]) for r in digests(df, keys, values, by).collect()} for df in (first, second))
    return sorted(place for place in a.keys() | b.keys() if a.get(place) != b.get(place))


def differing_keys(first: DataFrame, second: DataFrame, keys: list[str], values: list[str] | None = None) -> DataFrame:
    """Keys whose rows are not the same in both tables, with the number of rows on each side (``rows_a``, ``rows_b``).

    ``values`` are the compared columns, by default all others. Rows are compared as multisets; nulls equal nulls. At most
    ``FANOUT`` digests of the first level and ``FANOUT`` squared of the second reach the driver.
    """
    values = [c for c in first.columns if c not in keys] if values is None else values
    top, next_ = _ranges(keys)
    wide = [place[0] for place in _differing(first, second, keys, values, [top])]
    if not wide:
        return first.select(*keys, F.lit(0).cast("long").alias("rows_a"), F.lit(0).cast("long").alias("rows_b")).limit(0)
    first, second = (df.filter(top.isin(wide)) for df in (first, second))
    narrow = _differing(first, second, keys, values, [top, next_])
    inside = (top * FANOUT + next_).isin([a * FANOUT + b for a, b in narrow])

    def side(df: DataFrame, a: int) -> DataFrame:
        return df.filter(inside).select(*keys, F.xxhash64(*keys, *values).alias("h"), F.lit(a).alias("a"), F.lit(1 - a).alias("b"))

    rows = side(first, 1).unionAll(side(second, 0)).groupBy(*keys, "h").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    unlike = F.max((F.col("a") != F.col("b")).cast("int")).alias("unlike")
    per_key = rows.groupBy(*keys).agg(F.sum("a").alias("rows_a"), F.sum("b").alias("rows_b"), unlike)
    return per_key.filter("unlike = 1").drop("unlike")


def tables_equal(first: DataFrame, second: DataFrame, keys: list[str]) -> bool:
    """Whether two tables hold the same rows, from ``FANOUT`` digests of each."""
    values = sorted(c for c in first.columns if c not in keys)
    if values != sorted(c for c in second.columns if c not in keys):
        return False
    return not _differing(first, second, keys, values, [_ranges(keys)[0]])
