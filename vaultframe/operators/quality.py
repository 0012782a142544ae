"""Checks over tables and products."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vaultframe.functions.keys import hash_key


def _per_table(frames: Mapping[str, DataFrame], measure: Column) -> DataFrame:
    rows = [df.agg(measure).select(F.lit(name).alias("table_name"), "*") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, rows)


def count_tables(frames: Mapping[str, DataFrame], where: Column | None = None) -> DataFrame:
    """Row count per table; ``where`` counts only rows that satisfy it."""
    if where is not None:
        frames = {name: df.filter(where) for name, df in frames.items()}
    return _per_table(frames, F.count(F.lit(1)).alias("row_count"))


def freshness(frames: Mapping[str, DataFrame], ts_col: str) -> DataFrame:
    """Newest extract time per table."""
    return _per_table(frames, F.max(ts_col).alias("max_extract"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def compare(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """One row comparing two definitions of a product.

    Both sides are folded to one row per key in a single shuffle, so nulls
    compare equal and no anti join is needed.
    """
    sides = first.select(*keys, F.lit(1).alias("a"), F.lit(0).alias("b")).unionAll(
        second.select(*keys, F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    per_key = sides.groupBy(*keys).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))

    def keys_where(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    return per_key.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("rows_a"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("rows_b"),
        keys_where((F.col("a") > 0) & (F.col("b") == 0)).alias("keys_only_a"),
        keys_where((F.col("a") == 0) & (F.col("b") > 0)).alias("keys_only_b"),
    )


def domain_audit(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Distinct values of a code column, counted, with whether they fit a pattern."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("row_count")).withColumn("expected", F.col(col).like(pattern))


def length_audit(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows in which an identifier is longer than allowed."""
    too_long = [F.length(F.col(c).cast("string")) > n for c, n in limits.items()]
    return df.filter(reduce(lambda a, b: a | b, too_long))


def null_audit(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows in which one of the columns is missing."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def wrong_hash(key: str, cols: list[str]) -> Column:
    """True for a row whose stored key is not the one its business keys give."""
    return ~F.col(key).eqNullSafe(hash_key(*cols))


def unexpected(col: str, pattern: str) -> Column:
    """True for a value outside its domain; a missing one is not judged."""
    return ~F.col(col).like(pattern)


def too_long(limits: Mapping[str, int]) -> Column:
    return reduce(lambda a, b: a | b, [F.length(F.col(c).cast("string")) > n for c, n in limits.items()])


def missing(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def audit_on_load(df: DataFrame, audits: Mapping[str, Column], load: Callable[[DataFrame], object]) -> dict[str, int]:
    """Load a table and count, in the same pass, its rows and those that each audit objects to.

    ``load`` writes the frame that it is given, once. The counts ride along with the write's tasks, so several
    audits cost no scan of their own; a condition that is null does not object.
    """
    seen = Observation()
    counts = [F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in audits.items()]
    load(df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts))
    return dict(seen.get)
