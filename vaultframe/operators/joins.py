"""Vault joins.

No join carries a broadcast hint: Spark broadcasts a side only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and
merges, where adaptive execution splits a hot key. Only a key sketch, of bounded size, is asked to be broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultframe.functions.keys import pack, unpack
from vaultframe.session import stage


def resolve(df: DataFrame, hub: DataFrame, on: str, hub_key: str, columns: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Bring hub columns to a key column: ``columns`` maps hub column to output name."""
    side = hub.select(F.col(hub_key).alias(on), *[F.col(c).alias(out) for c, out in columns.items()])
    return df.join(side, on, how)


def sat_link_hub(
    sat: DataFrame, link: DataFrame, link_key: str, hubs: list[tuple[DataFrame, str, str, Mapping[str, str]]]
) -> DataFrame:
    """Satellite rows with their link's keys and the business keys of its hubs."""
    joined = sat.join(link, link_key)
    for hub, on, hub_key, columns in hubs:
        joined = resolve(joined, hub, on, hub_key, columns)
    return joined


def same_as_roles(link: DataFrame, hub: DataFrame, hub_key: str, business_key: str, roles: Mapping[str, str]) -> DataFrame:
    """Business keys of every role column of a same-as link.

    The link is shuffled once a role, so its keys travel packed. The hub grows with the link and is never
    broadcast: what is shuffled grows with the rows at every size.
    """
    kinds = {dict(link.dtypes)[role] for role in roles} | {dict(hub.dtypes)[hub_key]}
    if kinds == {"string"}:
        link, hub = pack(link, *roles), pack(hub, hub_key)
    hub = hub.hint("merge")
    for role, out in roles.items():
        link = resolve(link, hub, role, hub_key, {business_key: out})
    return unpack(link, *roles) if kinds == {"string"} else link


def drop_matching(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with no partner in ``other``; a null key never has one."""
    return df.join(other.select(*keys), keys, "left_anti")


def not_exists_mapped(df: DataFrame, other: DataFrame, keys: list[str], mapped: Column, other_col: str) -> DataFrame:
    """Rows with no partner under a computed key.

    The mapped value is materialised before the join. A row it maps to null has
    no partner, so it is always kept.
    """
    found = other.select(*keys, F.col(other_col).alias("__mapped")).distinct()
    return df.withColumn("__mapped", mapped).join(found, [*keys, "__mapped"], "left_anti").drop("__mapped")


def join_mapped(df: DataFrame, other: DataFrame, keys: list[str], mapped: Column, other_col: str, how: str = "left") -> DataFrame:
    """Join on keys and a computed value that must equal ``other_col``."""
    side = other.withColumnRenamed(other_col, "__mapped")
    return df.withColumn("__mapped", mapped).join(side, [*keys, "__mapped"], how).drop("__mapped")


def default_branch(df: DataFrame, matches: DataFrame, keys: list[str], defaults: Mapping[str, object]) -> DataFrame:
    """Matched rows, plus every unmatched row once with default values.

    One left join with a marker does both branches.
    """
    joined = df.join(matches.withColumn("__hit", F.lit(True)), keys, "left")
    filled = {
        name: F.when(F.col("__hit"), F.col(name)).otherwise(F.lit(value).cast(joined.schema[name].dataType))
        for name, value in defaults.items()
    }
    return joined.withColumns(filled).drop("__hit")


def ref_filter_join(df: DataFrame, ref: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a reference table, never multiplied by it."""
    return df.join(ref.select(key).distinct(), key, "left_semi")


def tree_parent_clone(df: DataFrame, node: str, parent: str, clone: str, carry: list[str]) -> DataFrame:
    """Clone and parent attributes beside every node, one level up; both optional."""

    def side(on: str, prefix: str) -> DataFrame:
        return df.select(F.col(node).alias(on), *[F.col(c).alias(f"{prefix}_{c}") for c in carry])

    out = df.withColumns({"__clone": F.col(clone), "__parent": F.col(parent)})
    out = out.join(side("__clone", "clone"), "__clone", "left")
    out = out.join(side("__parent", "parent"), "__parent", "left")
    return out.drop("__clone", "__parent")


#: A key whose sides make no more pairs than this is joined on the key alone.
FEW_PAIRS = 4096
#: Aimed-at rows of a crowded key in one of its smallest cells.
ROWS_PER_CELL = 64
#: A cell is as wide as this many of the level below; seven levels of days reach past the year 9999.
FANOUT = 16
LEVELS = 7
#: Crowded keys up to this number are kept in the plan, more are written to the work folder.
HELD_KEYS = 20_000


#: Bits of a sketch for each row it is made from, and at most: 32 MB, whatever the number of keys.
SKETCH_BITS = 8
MOST_SKETCH_BITS = 1 << 28
#: Types whose equal values have equal hashes.
SKETCHED = ("binary", "string", "int", "bigint")


class KeySketch(NamedTuple):
    """Which hashes the keys of a frame have: lists of 64 words of 64 bits each by ``__slot``; ``kind`` is the keys' type."""

    slots: DataFrame
    bits: int
    kind: str


def key_sketch(df: DataFrame, key: str) -> KeySketch:
    """Sketch of the keys of a staged frame, to tell rows of another that can't meet them before these are shuffled.

    A key of the frame is always found again, one in ten others is so by chance. Beyond 33 million rows the sketch
    grows no further, and others are found more often.
    """
    rows, bits = df.count(), 1 << 12
    while bits < min(rows * SKETCH_BITS, MOST_SKETCH_BITS):
        bits *= 2
    at = F.xxhash64(key).bitwiseAND(bits - 1)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))
    words = df.filter(F.col(key).isNotNull()).select(F.shiftright(at, 6).alias("__word"), one.alias("__bits"))
    none = df.sparkSession.range(bits // 64).select(F.col("id").alias("__word"), F.lit(0).cast("long").alias("__bits"))
    words = words.unionAll(none).groupBy("__word").agg(F.bit_or("__bits").alias("__bits"))
    listed = F.array_sort(F.collect_list(F.struct("__word", "__bits"))).getField("__bits")
    slots = words.groupBy(F.shiftright("__word", 6).alias("__slot")).agg(listed.alias("__words"))
    return KeySketch(stage(slots, "sketch"), bits, dict(df.dtypes)[key])


def with_chance(df: DataFrame, sketch: KeySketch, key: str, name: str) -> DataFrame:
    """The frame with a flag: false only for rows whose key is null or surely none of the sketch's.

    The sketch is sent to all tasks. Keys of another type than its own all have their chance.
    """
    if sketch.kind not in SKETCHED or dict(df.dtypes)[key] != sketch.kind:
        return df.withColumn(name, F.col(key).isNotNull())
    at = F.xxhash64(key).bitwiseAND(sketch.bits - 1)
    found = df.withColumn("__at", F.when(F.col(key).isNotNull(), at)).withColumn("__slot", F.shiftright("__at", 12))
    found = found.join(F.broadcast(sketch.slots), "__slot", "left")
    word = F.get("__words", F.shiftright("__at", 6).bitwiseAND(63).cast("int"))
    bit = F.call_function("shiftright", word, F.col("__at").bitwiseAND(63).cast("int")).bitwiseAND(1)
    return found.withColumn(name, F.coalesce(bit == 1, F.lit(False))).drop("__at", "__slot", "__words")


def may_meet(df: DataFrame, sketch: KeySketch, key: str) -> DataFrame:
    """Rows that an inner join with the sketch's frame may still need; the join itself must follow."""
    return with_chance(df, sketch, key, "__chance").filter("__chance").drop("__chance")


def lightened(df: DataFrame, sketch: KeySketch, key: str, payload: list[str]) -> DataFrame:
    """All rows, with key and payload null where the key can't meet the sketch's.

    For versions ranked by another key before the join: each takes part in the ranking, and one that would lead
    nowhere if it came first travels light.
    """
    flagged = with_chance(df, sketch, key, "__chance")
    return flagged.withColumns({c: F.when(F.col("__chance"), F.col(c)) for c in [key, *payload]}).drop("__chance")


def crowded_keys(
    left: DataFrame, right: DataFrame, keys: list[str], few_pairs: int = FEW_PAIRS, most_rows: int | None = None
) -> DataFrame | None:
    """Keys whose rows on both sides make more than ``few_pairs`` pairs; ``None`` if there are none.

    With ``most_rows`` also the keys of more rows than that. The first count is by a hash of the key, folded to one
    row a task and hash before its shuffle: what shares a hash is at least as crowded as its keys, so that only rows of
    crowded hashes are counted by the keys themselves.
    """
    sides = left.select(*keys, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionAll(
        right.select(*keys, F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    )
    sides = sides.na.drop(subset=keys)

    def crowded(rows: DataFrame, by: list[str]) -> DataFrame:
        counts = rows.groupBy(*by).agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))
        full = F.col("__l") * F.col("__r") > few_pairs
        if most_rows is not None:
            full = full | (F.col("__l") + F.col("__r") > most_rows)
        return counts.filter(full).select(*by)

    hashed = sides.withColumn("__h", F.xxhash64(*keys))
    suspects = crowded(hashed, ["__h"])
    held = suspects.limit(HELD_KEYS + 1).collect()
    if not held:
        return None
    if len(held) <= HELD_KEYS:
        suspects = left.sparkSession.createDataFrame(held, suspects.schema)
    many = crowded(hashed.join(suspects, "__h", "left_semi"), keys)
    held = many.limit(HELD_KEYS + 1).collect()
    if not held:
        return None
    if len(held) > HELD_KEYS:
        return stage(many, "crowded")
    return left.sparkSession.createDataFrame(held, many.schema)


def _spans(df: DataFrame, keys: list[str], period: tuple[str, str]) -> DataFrame:
    """Keys with ``__lo`` and ``__hi``, the days a period reaches over, turned round where it ends before it starts."""
    days = [F.unix_date(c) for c in period]
    return df.select(*keys, F.least(*days).alias("__lo"), F.greatest(*days).alias("__hi")).filter(
        days[0].isNotNull() & days[1].isNotNull()
    )


def _level(lo: Column, hi: Column, width: Column) -> Column:
    """The lowest level whose cells are at least as wide as the span."""
    wider = [(hi - lo + 1 > width * FANOUT**k).cast("int") for k in range(LEVELS - 1)]
    return reduce(lambda x, y: x + y, wider)


def cell_shapes(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of every crowded key, from its own periods: ``__width`` in days, ``__horizon``, ``__levels``.

    The width puts some ``ROWS_PER_CELL`` rows into a smallest cell where most periods begin. No common
    part of two periods begins after the last period does, the horizon: there open ends and misread dates
    are cut off. Levels are those that some period of the key has.
    """
    begin = spans.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.max("__lo").alias("__horizon"),
        F.percentile_approx("__lo", F.array(F.lit(0.05), F.lit(0.95)), 200).alias("__q"),
    )
    dense = F.ceil((F.col("__q")[1] - F.col("__q")[0]) * F.lit(float(ROWS_PER_CELL)) / F.col("__n")).cast("long")
    begin = begin.select(*keys, F.greatest(F.lit(1).cast("long"), dense).alias("__width"), "__horizon")
    level = _level(F.col("__lo"), F.least("__hi", "__horizon"), F.col("__width"))
    levels = spans.join(begin, keys).groupBy(*keys, "__width", "__horizon")
    return levels.agg(F.array_sort(F.collect_set(level)).alias("__levels"))


def _celled(df: DataFrame, keys: list[str], period: tuple[str, str], shapes: DataFrame) -> DataFrame:
    """A row for each cell a period touches: one or two on its own level and on each coarser one that occurs."""
    days = [F.unix_date(c) for c in period]
    rows = df.filter(days[0].isNotNull() & days[1].isNotNull()).join(shapes, keys)
    rows = rows.withColumns({"__lo": F.least(*days), "__hi": F.least(F.greatest(*days), F.greatest(F.least(*days), "__horizon"))})
    rows = rows.withColumn("__level", _level(F.col("__lo"), F.col("__hi"), F.col("__width")))

    def size(k: Column) -> Column:
        return F.col("__width") * F.pow(F.lit(FANOUT), k)

    def touched(k: Column) -> Column:
        cells = F.sequence(F.floor(F.col("__lo") / size(k)).cast("int"), F.floor(F.col("__hi") / size(k)).cast("int"))
        return F.transform(cells, lambda c: F.struct(k.cast("int").alias("level"), c.alias("cell")))

    levels = F.filter("__levels", lambda k: k >= F.col("__level"))
    return rows.withColumn("__cell", F.explode(F.flatten(F.transform(levels, touched)))).drop("__levels", "__hi", "__horizon")


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_period: tuple[str, str],
    right_period: tuple[str, str],
    how: str = "inner",
    few_pairs: int | None = FEW_PAIRS,
) -> DataFrame:
    """Join rows of equal key whose date periods overlap; touching ends do not.

    Keys with few periods are joined on the key alone. The keys are counted first, so both
    sides should be stored or staged. The periods of a crowded key are cut into cells whose
    width and levels come from these periods (``cell_shapes``). Two periods meet on the level of the longer
    one, in the cell that holds the later of their beginnings: that cell both touch, so a pair
    arises exactly once, a hot key is spread over its cells, and rows of different
    times are not compared. ``few_pairs=None`` joins on the key without counting, for keys known to have few periods.
    """
    l_from, l_to = left_period
    r_from, r_to = right_period
    overlap = (F.col(r_to) > F.col(l_from)) & (F.col(r_from) < F.col(l_to))
    sides = {c: f"__k_{c}" for c in keys}
    same_key = reduce(lambda a, b: a & b, [F.col(c) == F.col(k) for c, k in sides.items()])

    def on_key(some: DataFrame, other: DataFrame) -> DataFrame:
        return some.join(other.withColumnsRenamed(sides), same_key & overlap, how).drop(*sides.values())

    crowded = None if few_pairs is None else crowded_keys(left, right, keys, few_pairs)
    if crowded is None:
        return on_key(left, right)
    plain = on_key(left.join(crowded, keys, "left_anti"), right.join(crowded, keys, "left_anti"))

    left, right = (df.join(crowded, keys, "left_semi") for df in (left, right))
    spans = _spans(left, keys, left_period).unionAll(_spans(right, keys, right_period))
    shapes = stage(cell_shapes(spans, keys), "cells")
    rows = left if how == "inner" else left.select(*keys, l_from, l_to).distinct()
    rows = _celled(rows, keys, left_period, shapes)
    other = _celled(right, keys, right_period, shapes).drop("__width")
    other = other.withColumnsRenamed({**sides, "__cell": "__rcell", "__lo": "__rlo", "__level": "__rlevel"})
    wider = F.greatest("__level", "__rlevel")
    begins = F.floor(F.greatest("__lo", "__rlo") / (F.col("__width") * F.pow(F.lit(FANOUT), wider)))
    same_cell = (F.col("__cell") == F.col("__rcell")) & (F.col("__cell.level") == wider) & (F.col("__cell.cell") == begins)
    extra = ["__cell", "__rcell", "__lo", "__rlo", "__level", "__rlevel", "__width"]
    matches = rows.join(other, same_key & same_cell & overlap).drop(*extra, *sides.values())
    if how != "inner":
        matches = left.join(matches, [*keys, l_from, l_to], "left")
    return plain.unionByName(matches)
