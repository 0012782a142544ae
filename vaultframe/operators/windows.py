"""Ordered windows that stay parallel inside one hot key.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. Here the
keys are counted first, and those of up to ``SLICE_ROWS`` rows are windowed plainly. The
rows of a hotter key are cut into slices in the order of the window: the
window runs per (key, slice), one small summary row per (key, slice) carries what the
earlier or later slices contribute (a prefix scan over the slices), and the two are joined again on
(key, slice).

The cuts come from the data: rows drawn by a hash of their order columns give quantiles
of the whole ordering tuple, so a key with most of its rows on one day, at a sentinel date
or under a ghost value is spread by the columns that break the tie. Rows of equal tuples always share a
slice. ``slice_by`` replaces this by a rule known beforehand, such as the month; it must be a function
of the first ordering column, and no key is counted then.

The input is read once to count, and for hot keys twice more: a stored table is simply
scanned, a derived frame should be staged first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultframe.session import stage

_SLICE = "__slice"
#: Rows of a key up to which one task windows it, and about the rows of a slice.
SLICE_ROWS = 500_000
#: Slices of one key at most; beyond, slices grow.
MOST_SLICES = 512
#: Rows drawn for each cut.
DRAWN = 16
#: Hot keys up to this number are kept in the plan, more are written to the work folder.
HELD_KEYS = 10_000


def by_month(col: str) -> Column:
    """Slice of a timestamp or date column: its month."""
    return F.year(col) * 12 + F.month(col)


def by_hour(col: str) -> Column:
    """Slice of a timestamp column: its hour, for keys with many rows a day."""
    return F.unix_date(F.col(col).cast("date")) * 24 + F.hour(col)


def by_range(col: str, width: float) -> Column:
    """Slice of a numeric column: fixed-width range."""
    return F.floor(F.col(col) / width)


def _same(keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in keys])


def hot_keys(df: DataFrame, keys: list[str], slice_rows: int | None = None) -> DataFrame | None:
    """Keys of more than ``slice_rows`` rows with their count ``__n``, columns ``__h_<key>``; ``None`` if there are none.

    A null key is a key like any other.
    """
    # A hash of the key is counted first, in a few bytes a row; only rows of hot hashes are counted by the key.
    many = F.col("__n") > (slice_rows or SLICE_ROWS)
    hashed = df.select(F.xxhash64(*keys).alias("__x"), *[F.col(c).alias(f"__h_{c}") for c in keys])
    suspects = hashed.groupBy("__x").agg(F.count(F.lit(1)).alias("__n")).filter(many).select("__x")
    held = suspects.limit(HELD_KEYS + 1).collect()
    if not held:
        return None
    if len(held) <= HELD_KEYS:
        suspects = df.sparkSession.createDataFrame(held, suspects.schema)
    rows = hashed.join(suspects, "__x", "left_semi")
    hot = rows.groupBy(*[f"__h_{c}" for c in keys]).agg(F.count(F.lit(1)).alias("__n")).filter(many)
    held = hot.limit(HELD_KEYS + 1).collect()
    if not held:
        return None
    if len(held) > HELD_KEYS:
        return stage(hot, "hot")
    return df.sparkSession.createDataFrame(held, hot.schema)


def cuts(df: DataFrame, keys: list[str], order: list[str], hot: DataFrame, slice_rows: int | None = None) -> DataFrame:
    """``__h_<key>`` and ``__cuts``, ascending ordering tuples at about equal distances."""
    wanted = F.least(F.lit(MOST_SLICES), F.ceil(F.col("__n") / (slice_rows or SLICE_ROWS)))
    share = wanted * DRAWN / F.col("__n")
    drawn = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(1 << 30)) < share * (1 << 30)
    rows = df.join(hot, _same(keys, "__h_")).filter(drawn)
    own = [f"__h_{c}" for c in keys]
    tuples = rows.groupBy(*own).agg(F.array_sort(F.collect_set(F.struct(*order))).alias("__t"))  # DRAWN for each slice
    return tuples.select(*own, F.filter("__t", lambda _, i: i % DRAWN == DRAWN - 1).alias("__cuts"))


def _split(
    df: DataFrame, keys: list[str], order: list[str], slice_by: Column | None
) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows to window plainly, and those to window by slices with their slice; ``None``: there are none."""
    if slice_by is not None:
        return None, df.withColumn(_SLICE, slice_by)
    hot = hot_keys(df, keys)
    if hot is None:
        return df, None
    plain = df.join(hot, _same(keys, "__h_"), "left_anti")
    found = stage(cuts(df, keys, order, hot), "cuts")
    # a key whose drawn rows gave no cut is one slice
    sliced = df.join(hot.drop("__n"), _same(keys, "__h_"), "left_semi").join(found, _same(keys, "__h_"), "left")
    place = F.size(F.filter("__cuts", lambda c: c <= F.struct(*order)))
    return plain, sliced.withColumn(_SLICE, F.coalesce(place, F.lit(0))).drop("__cuts", *[f"__h_{c}" for c in keys])


def _both(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    slice_by: Column | None,
    plainly: Callable[[DataFrame], DataFrame],
    by_slices: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    plain, sliced = _split(df, keys, order, slice_by)
    if sliced is None:
        return plainly(plain)
    return by_slices(sliced) if plain is None else plainly(plain).unionByName(by_slices(sliced))


def _sort(order: list[str], ascending: bool = True) -> list[Column]:
    return [F.col(c).asc() if ascending else F.col(c).desc() for c in order]


def _attach(df: DataFrame, summary: DataFrame, keys: list[str], extra: list[str]) -> DataFrame:
    """Join the per-slice summary back; null keys and slices match each other."""
    right = summary.select(*[F.col(c).alias(f"__r_{c}") for c in [*keys, _SLICE]], *extra)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in [*keys, _SLICE]])
    return df.join(right, same, "left").drop(*[f"__r_{c}" for c in [*keys, _SLICE]])


def _shifted(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, str], slice_by: Column | None, forward: bool
) -> DataFrame:
    step, edge = (F.lead, F.min_by) if forward else (F.lag, F.max_by)

    def plainly(rows: DataFrame) -> DataFrame:
        whole = Window.partitionBy(*keys).orderBy(*_sort(order))
        return rows.withColumns({out: step(v).over(whole) for out, v in values.items()})

    def by_slices(sliced: DataFrame) -> DataFrame:
        inner = Window.partitionBy(*keys, _SLICE).orderBy(*_sort(order))
        edges = sliced.groupBy(*keys, _SLICE).agg(
            edge(F.struct(*[F.col(v).alias(out) for out, v in values.items()]), F.struct(*order)).alias("__edge")
        )
        across = Window.partitionBy(*keys).orderBy(_SLICE)
        edges = edges.withColumn("__edge", step("__edge").over(across))
        body = sliced.withColumn("__has", step(F.lit(True)).over(inner)).withColumns(
            {f"__in_{out}": step(v).over(inner) for out, v in values.items()}
        )
        joined = _attach(body, edges, keys, ["__edge"])
        return joined.withColumns(
            {
                out: F.when(F.col("__has"), F.col(f"__in_{out}")).otherwise(F.col("__edge").getField(out))
                for out in values
            }
        ).drop("__edge", "__has", _SLICE, *[f"__in_{out}" for out in values])

    return _both(df, keys, order, slice_by, plainly, by_slices)


def next_value(df: DataFrame, keys: list[str], order: list[str], values: dict[str, str], slice_by: Column | None = None) -> DataFrame:
    """Value of the next row of the key: ``values`` maps output name to column.

    ``order`` must tell any two rows of a key apart.
    """
    return _shifted(df, keys, order, values, slice_by, forward=True)


def previous_value(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, str], slice_by: Column | None = None
) -> DataFrame:
    """Value of the row before, otherwise as :func:`next_value`."""
    return _shifted(df, keys, order, values, slice_by, forward=False)


def _ranked(
    df: DataFrame, keys: list[str], order: list[str], name: str, slice_by: Column | None, ascending: bool, function
) -> DataFrame:
    def plainly(rows: DataFrame) -> DataFrame:
        whole = Window.partitionBy(*keys).orderBy(*_sort(order, ascending))
        return rows.withColumn(name, function().over(whole).cast("long"))

    def by_slices(sliced: DataFrame) -> DataFrame:
        inner = Window.partitionBy(*keys, _SLICE).orderBy(*_sort(order, ascending))
        edge = F.col(_SLICE).asc() if ascending else F.col(_SLICE).desc()
        before = Window.partitionBy(*keys).orderBy(edge).rowsBetween(Window.unboundedPreceding, -1)
        counts = sliced.groupBy(*keys, _SLICE).agg(F.count(F.lit(1)).alias("__n"))
        counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        body = sliced.withColumn("__rank", function().over(inner))
        joined = _attach(body, counts, keys, ["__before"])
        return joined.withColumn(name, (F.col("__rank") + F.col("__before")).cast("long")).drop(
            "__rank", "__before", _SLICE
        )

    return _both(df, keys, order, slice_by, plainly, by_slices)


def row_numbers(
    df: DataFrame, keys: list[str], order: list[str], name: str, slice_by: Column | None = None, ascending: bool = True
) -> DataFrame:
    """``row_number`` of every row in its key."""
    return _ranked(df, keys, order, name, slice_by, ascending, F.row_number)


def ranks(
    df: DataFrame, keys: list[str], order: list[str], name: str, slice_by: Column | None = None, ascending: bool = True
) -> DataFrame:
    """``rank`` of every row in its key; equal rows share a rank."""
    return _ranked(df, keys, order, name, slice_by, ascending, F.rank)


def running_extremes(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    low: dict[str, str],
    high: dict[str, str],
    slice_by: Column | None = None,
) -> DataFrame:
    """Running minimum and maximum up to the row, its peers included."""
    wanted = [(out, v, F.min, F.least) for out, v in low.items()]
    wanted += [(out, v, F.max, F.greatest) for out, v in high.items()]

    def plainly(rows: DataFrame) -> DataFrame:
        whole = Window.partitionBy(*keys).orderBy(*_sort(order))
        return rows.withColumns({out: agg(v).over(whole) for out, v, agg, _ in wanted})

    def by_slices(sliced: DataFrame) -> DataFrame:
        inner = Window.partitionBy(*keys, _SLICE).orderBy(*_sort(order))
        before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
        summary = sliced.groupBy(*keys, _SLICE).agg(*[agg(v).alias(f"__s_{out}") for out, v, agg, _ in wanted])
        summary = summary.withColumns({f"__s_{out}": agg(f"__s_{out}").over(before) for out, _, agg, _ in wanted})
        body = sliced.withColumns({f"__in_{out}": agg(v).over(inner) for out, v, agg, _ in wanted})
        joined = _attach(body, summary, keys, [f"__s_{out}" for out, *_ in wanted])
        merged = joined.withColumns({out: pick(f"__in_{out}", f"__s_{out}") for out, _, _, pick in wanted})
        return merged.drop(_SLICE, *[f"__in_{o}" for o, *_ in wanted], *[f"__s_{o}" for o, *_ in wanted])

    return _both(df, keys, order, slice_by, plainly, by_slices)
