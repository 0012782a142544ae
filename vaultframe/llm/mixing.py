"""Mixing sources to target weights by temperature.

Method: each source's share of tokens is raised to an exponent and normalised. The
exponent is bisected until the weights reach a target entropy, or until no source
is repeated more often than a limit. The weights are then realised under a token
budget: a source gets whole epochs of its blocks, each in a permutation of its
own, and a last epoch that stops where its budget is used up; inside the block
where that happens documents are taken one by one.

Tokens are words. Each source has up to 4,096 blocks, so the table of blocks is
bounded by the number of sources, and a hot source is spread over its blocks. The
driver sees one row for each source.

A null source is a source of its own. Documents without words cost nothing and
come with their block. Repeated rows are separate documents. A source without any
word is taken once. No rows give no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultframe.llm.common import WORD, packed
from vaultframe.session import stage

CELLS = 4096
BLOCK_TOKENS = 20_000
SEED = 20_25
#: Tables of at most this many rows (some dozen bytes each) are sent to every task; larger ones are joined by a shuffle.
SENT_ROWS = 200_000


@dataclass(frozen=True)
class Target:
    """``budget``: tokens to give out; None gives enough for every source to be used once or more."""

    max_repeats: float | None = 4.0
    entropy: float | None = None
    budget: int | None = None


def weights(tokens: dict[str, int], alpha: float) -> dict[str, float]:
    total = sum(tokens.values())
    raised = {k: (n / total) ** alpha if n else 0.0 for k, n in sorted(tokens.items())}
    whole = math.fsum(raised.values())
    return {k: x / whole for k, x in raised.items()}


def budget_of(tokens: dict[str, int], w: dict[str, float], target: Target) -> float:
    if target.budget is not None:
        return target.budget
    return max(n / w[k] for k, n in tokens.items() if n)


def _entropy(w: dict[str, float]) -> float:
    return -math.fsum(x * math.log(x) for x in w.values() if x)


def solve(tokens: dict[str, int], target: Target) -> tuple[float, dict[str, float]]:
    """The least exponent in [0, 1] that the target allows (the nearest end, if none does), and its weights."""

    def too_flat(alpha: float) -> bool:
        w = weights(tokens, alpha)
        if target.entropy is not None:
            return _entropy(w) > target.entropy
        budget = budget_of(tokens, w, target)
        return max(w[k] * budget / n for k, n in tokens.items() if n) > target.max_repeats * (1 + 1e-12)

    low, high = 0.0, 1.0
    if not too_flat(low):
        return low, weights(tokens, low)
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if too_flat(middle) else (low, middle)
    return high, weights(tokens, high)


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _sent(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= SENT_ROWS else table


def _borders(cut: DataFrame) -> DataFrame:
    """Where each cut block ends: rows of ``kind``, ``epoch``, ``border`` (a slice of the order) and ``last`` (a place in it, null: before
    the slice's first row).

    ``cut`` has ``kind``, ``epoch``, ``left``, ``place`` (its first field is a hash) and ``n_tokens``. The order is cut into slices by the
    hash's upper bits; a prefix sum over the slices finds the one that the budget ends in, and only its rows are summed one by
    one. Rows of equal places are used together or not at all.
    """
    sliced = cut.withColumn("slice", F.shiftright("place.turn", 54))
    sums = sliced.groupBy("kind", "epoch", "slice", "left").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.partitionBy("kind", "epoch").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    border = sums.where("before <= left and before + tokens > left").select("kind", "epoch", F.col("slice").alias("border"), "before")
    inside = sliced.join(border, ["kind", "epoch"]).where("slice = border")
    so_far = F.col("before") + F.sum("n_tokens").over(Window.partitionBy("kind", "epoch").orderBy("place"))
    last = inside.withColumn("so_far", so_far).where("so_far <= left").groupBy("kind", "epoch").agg(F.max("place").alias("last"))
    return border.join(last, ["kind", "epoch"], "left").select("kind", "epoch", "border", "last")


def mixed(docs: DataFrame, target: Target = Target()) -> DataFrame:  # noqa: B008
    """One row for each use of a document: ``row`` (the document), ``doc_id``, ``source``, ``n_tokens``, ``weight``,
    ``epoch`` (from 0), ``block``, ``block_rank`` (the block's place in the epoch's permutation, from 1)."""
    spark = docs.sparkSession
    kind = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    cell = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(CELLS))
    frame = packed(docs, doc_id=F.col("doc_id"), source=F.col("source"), kind=kind, cell=cell, n_tokens=n_words())
    cells = stage(frame.groupBy("kind", "cell").agg(F.sum("n_tokens").alias("tokens")), "cells")
    tokens = {r["kind"]: r["tokens"] for r in cells.groupBy("kind").agg(F.sum("tokens").alias("tokens")).collect()}
    shares = []
    if any(tokens.values()):
        alpha, w = solve({k: n for k, n in tokens.items() if n}, target)
        budget = budget_of(tokens, w, target)
    for k, n in sorted(tokens.items()):
        if n:
            given = w[k] * budget
            epochs = math.floor(given / n + 1e-9)
            shares.append((k, w[k], max(1, min(CELLS, math.ceil(n / BLOCK_TOKENS))), epochs, max(0, math.floor(given - epochs * n + 1e-6))))
        else:
            shares.append((k, 0.0, 1, 1, 0))
    plan = spark.createDataFrame(shares, "kind string, weight double, blocks int, epochs int, rest long")
    sized = cells.join(plan, "kind")
    blocks = sized.groupBy("kind", F.pmod("cell", "blocks").cast("int").alias("block"), "weight", "blocks", "epochs", "rest").agg(F.sum("tokens").alias("tokens"))
    uses = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs"))))
    order = Window.partitionBy("kind", "epoch").orderBy(F.xxhash64("kind", "block", "epoch", F.lit(SEED)), "block")
    before = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    uses = uses.select("kind", "block", "blocks", "weight", "epoch", "epochs", "tokens", (F.col("rest") - before).alias("left"), F.row_number().over(order).alias("block_rank"))
    uses = stage(uses.where("epoch < epochs or (left > 0 and tokens > 0)").withColumn("whole", F.expr("epoch < epochs or left >= tokens")), "uses")
    taken_blocks, cut_blocks = uses.where("whole"), uses.where("not whole")
    of = _sent(plan.select("kind", F.col("blocks").alias("of")), len(shares))
    by_kind = frame.join(of, "kind").withColumn("block", F.pmod("cell", "of").cast("int")).drop("of", "cell")
    out = ["row", "doc_id", "source", "n_tokens", "weight", "epoch", "block", "block_rank"]
    taken = by_kind.join(_sent(taken_blocks, taken_blocks.count()), ["kind", "block"]).select(out)
    # words are counted only in the blocks that the budget cuts: one for each source and epoch at most
    place = F.struct(F.xxhash64("doc_id", "epoch", F.lit(SEED)).alias("turn"), "doc_id", "n_tokens").alias("place")
    cut = packed(docs, doc_id=F.col("doc_id"), source=F.col("source"), text=F.col("text"), kind=kind, cell=cell).join(of, "kind")
    cut = cut.withColumn("block", F.pmod("cell", "of").cast("int")).join(_sent(cut_blocks, len(shares)), ["kind", "block"])
    cut = cut.withColumn("n_tokens", n_words()).select(*out, "kind", "left", place)
    borders = stage(_borders(cut.select("kind", "epoch", "left", "place", "n_tokens")), "borders")
    ended = cut.join(_sent(borders, len(shares)), ["kind", "epoch"])
    slice_of = F.shiftright("place.turn", 54)
    within = (slice_of < F.col("border")) | ((slice_of == F.col("border")) & F.coalesce(F.col("place") <= F.col("last"), F.lit(False)))
    return taken.union(ended.where(within).select(out))


def mix_query(docs: DataFrame, target: Target) -> DataFrame:
    return mixed(docs.select("doc_id", "source", "text"), target).drop("row")
