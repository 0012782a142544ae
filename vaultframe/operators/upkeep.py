"""Keeping the newest version of every key up to date, window by window.

The state is a catalog table with one row per key, tombstones included, partitioned by a hash of the key. A window's
rows are merged into the partitions that their keys fall in; the others are not read. Order alone
decides which version wins, so late rows lose to newer ones, a row that comes twice changes nothing, and a
tombstone keeps an older row that arrives after it from coming back. Replaying a history in any windows and any order
gives the state that one pass over all of it gives.

A changed partition is written aside and the table is then pointed to it, so a failed merge leaves
the state as it was. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultframe.operators.versions import first_per_key, newest, not_deleted
from vaultframe.sources.sink import TableSpec, create_table, drop_replaced_runs, write_runs

PART = "key_part"


class CurrentVersions:
    """The newest row of every key by ``order`` (largest first); ``order`` must tell any two versions of a key apart."""

    def __init__(self, spark: SparkSession, table: str, path: str, keys: Iterable[str], order: Iterable[str], parts: int = 64):
        self.spark, self.table, self.path, self.parts = spark, table, path.rstrip("/"), parts
        self.keys, self.order = list(keys), list(order)

    def create(self, columns: str) -> CurrentVersions:
        """An empty state with the given columns (DDL)."""
        create_table(self.spark, TableSpec(self.table, f"{columns}, {PART} INT", (PART,)), self.path)
        return self

    def rows(self) -> DataFrame:
        """The newest version of every key, deleted or not."""
        return self.spark.table(self.table).drop(PART)

    def live(self, change_col: str = "change_type") -> DataFrame:
        return self.rows().filter(not_deleted(change_col))

    def _parted(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PART, F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int"))

    def merge(self, window: DataFrame) -> int:
        """Merge a window's rows, in any order and with repeats; returns the number of partitions rewritten.

        The window is read twice, for the partitions it touches and for its rows.
        """
        state = self.spark.table(self.table)
        fresh = self._parted(window.select(*[c for c in state.columns if c != PART])).select(*state.columns)
        touched = sorted(r[PART] for r in fresh.select(PART).distinct().collect())
        if not touched:
            return 0
        # a key sends one row a task of its new versions into the shuffle, beside its one stored row
        both = state.filter(F.col(PART).isin(touched)).unionByName(fresh)
        write_runs(first_per_key(both, [PART, *self.keys], newest(*self.order)), self.path, PART, self.table)
        return len(touched)

    def drop_replaced(self) -> int:
        """Delete the partitions' earlier files."""
        return drop_replaced_runs(self.spark, self.path, PART, self.table)
