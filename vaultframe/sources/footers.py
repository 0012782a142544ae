"""Counts and extremes of stored Parquet tables from their footers, without reading a page of data.

Spark's V2 Parquet source answers count(*), and min and max of whole numbers, floats, booleans and dates, from
the statistics of the row groups. Timestamps and texts have no usable extremes there: these fall back to
reading the one column. Filters on other than partition columns switch the shortcut off, so filtered counts stay
with ``operators.quality``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FOOTERS = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}


@contextmanager
def reading_footers(spark: SparkSession) -> Iterator[None]:
    """The V2 Parquet source with aggregates pushed into it, inside the ``with`` block."""
    before = {name: spark.conf.get(name) for name in _FOOTERS}
    try:
        for name, value in _FOOTERS.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _union(spark: SparkSession, measured: list[tuple[str, str, list[Column]]]) -> DataFrame:
    rows = [spark.read.parquet(path).agg(*columns).select(F.lit(name).alias("table_name"), "*") for name, path, columns in measured]
    return reduce(DataFrame.unionByName, rows)


def counting_plan(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """The counts as one query; to be run inside :func:`reading_footers`."""
    return _union(spark, [(name, path, [F.count(F.lit(1)).alias("row_count")]) for name, path in paths.items()])


def footer_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``table_name`` and ``row_count`` of every path, all in one query; a row per table comes back."""
    with reading_footers(spark):
        plan = counting_plan(spark, paths)
        return spark.createDataFrame(plan.collect(), plan.schema)


def footer_extremes(spark: SparkSession, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``table_name``, ``lowest``, ``highest`` of one column each: table name -> (path, column), columns of one type."""
    with reading_footers(spark):
        wanted = [(name, path, [F.min(c).alias("lowest"), F.max(c).alias("highest")]) for name, (path, c) in columns.items()]
        plan = _union(spark, wanted)
        return spark.createDataFrame(plan.collect(), plan.schema)
