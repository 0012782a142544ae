"""Longest-processing-time sharding: equal texts stay together, largest groups first, each to the least-loaded shard.

The heap runs on the driver over a bounded list of items: groups above 1/256 of a
shard's share stand alone (there can be at most 256 for each shard), all smaller
groups are gathered by hash into 256 bundles for each shard. The item list thus
has at most 512 entries a shard however many documents there are.

A null text counts as empty. Repeated rows get a slot each; no rows give no rows.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultframe.session import stage

PARTS = 256
CELL_ROWS = 20_000


def longest_first(sizes: dict[str, int], shards: int) -> dict[str, int]:
    """Item -> shard; ties by name, so that the result is fixed."""
    loads = [(0, shard) for shard in range(shards)]
    placed = {}
    for item, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(loads)
        placed[item] = shard
        heapq.heappush(loads, (load + size, shard))
    return placed


def shard(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law`` ('bytes'), ``shard``, ``slot``, ``grown_shard`` (null).

    ``size`` is UTF-8 bytes plus 8. Groups are told apart by crc32, a 64-bit hash
    and the size; should two texts share all three they would stay together too.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    thin = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h"))
    key = ["h", "text_crc32", "size"]
    groups = stage(thin.groupBy(*key).agg(F.sum("size").alias("bytes")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    limit = total // (shards * PARTS)
    bundle = F.pmod(F.xxhash64("h", "text_crc32"), F.lit(shards * PARTS)).cast("string")
    item = F.concat_ws("/", *key)
    items = groups.select(F.when(F.col("bytes") > limit, item).otherwise(F.concat(F.lit("b"), bundle)).alias("item"), "bytes")
    sizes = {r["item"]: r["bytes"] for r in items.groupBy("item").agg(F.sum("bytes").alias("bytes")).collect()}
    placed = longest_first(sizes, shards)
    # bounded: at most 2 * PARTS * shards rows
    where = F.broadcast(spark.createDataFrame([*placed.items()], "item string, shard int"))
    alone = where.select(F.col("item").alias("own"), F.col("shard").alias("own_shard"))
    cells = max(8, math.ceil(docs.count() / shards / CELL_ROWS))
    placed_docs = (
        thin.join(alone, item == F.col("own"), "left")
        .join(where, F.concat(F.lit("b"), bundle) == F.col("item"), "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("own_shard", "shard").alias("shard"), F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(cells)).alias("cell"))
    )
    placed_docs = stage(placed_docs, "placed")
    # slots: numbers inside a cell of a shard, after those of the cells before it
    counts = placed_docs.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard", "cell", F.coalesce(before, F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size"))
    numbered = placed_docs.withColumn("inside", inside).join(starts, ["shard", "cell"])
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("inside") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
