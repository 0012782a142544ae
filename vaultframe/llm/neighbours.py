"""Approximate nearest neighbours by a forest of random-projection trees with a shared queue.

Method: each tree splits space by hyperplanes between two random points of a
bounded sample. A query walks all trees through one priority queue, ordered by the
sum of squares of how far the query lies beyond the splits on the way, up to a
reach that all queries share. Every vector is indexed: it lies in one leaf of each
tree. The leaf tasks rank their vectors exactly (cosine in double precision), and
the best over all leaves are the answer.

The reach comes from the table: ``PROBES`` of its queries are held against every
vector, and the reach is the one at which their true neighbours are met at the rate
``RECALL``. So the share of the leaves that is searched follows the data and the
recall does not fall as the table grows: clustered vectors need a few leaves, vectors
without any structure a good part of them.

Equal vectors form a class that is indexed once and keeps its smallest ids, as
many as an answer can use; so a vector copied a million times is one entry. Leaves
that follow each other in a tree share a bucket of up to ``CHUNK`` entries, to which
a query goes once; larger leaves are split by hash, and their queries go to every
part. Buckets asked by more than ``ASKS`` queries are ranked once for each slice of them.

Vectors that are null, zero, of another length than most, or that hold nulls or
non-finite numbers take no part. Ties go to the smaller id. A query with fewer
than ``k`` others gets all of them, an empty table gives no rows; other columns
are ignored. Repeated rows of one id are one vector if equal.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from vaultframe.session import stage

SAMPLE_ROWS = 20_000
TREES = 8
LEAF = 64
PROBES = 256
RECALL = 0.96
CHUNK = 4096
ASKS = 20_000
TRIES = 3


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees. Below 0, ``left`` and ``right`` are leaves (-1 - leaf number); ``ends`` is the leaf number each tree ends before."""

    roots: np.ndarray
    normals: np.ndarray
    left: np.ndarray
    right: np.ndarray
    ends: np.ndarray


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def grow(sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 11) -> Forest:
    draw = np.random.default_rng(seed)
    points = unit(sample.astype(np.float64)) if len(sample) else sample
    normals: list[np.ndarray] = []
    left: list[int] = []
    right: list[int] = []
    leaves, roots, ends = 0, [], []
    for _ in range(trees):
        todo = [(np.arange(len(points)), None, 0)]
        while todo:
            own, parent, side = todo.pop()
            split = None
            for _ in range(TRIES if len(own) > leaf else 0):
                a, b = draw.choice(own, 2, replace=False)
                normal = points[a] - points[b]
                beyond = points[own] @ normal > 0
                if min(beyond.sum(), len(own) - beyond.sum()) >= 0.05 * len(own):
                    split = normal
                    break
            if split is None and len(own) > leaf:
                normal = draw.standard_normal(points.shape[1])
                beyond = points[own] @ normal > np.median(points[own] @ normal)
                split = normal if 0 < (points[own] @ normal > 0).sum() < len(own) else None
                beyond = points[own] @ normal > 0
            if split is None:
                node, leaves = -1 - leaves, leaves + 1
            else:
                node = len(normals)
                normals.append(split / max(np.linalg.norm(split), 1e-300))
                left.append(0), right.append(0)
                todo += [(own[~beyond], node, 0), (own[beyond], node, 1)]
            if parent is None:
                roots.append(node)
            else:
                (right if side else left)[parent] = node
        ends.append(leaves)
    width = sample.shape[1] if sample.ndim == 2 else 0
    return Forest(np.array(roots), np.array(normals).reshape(len(normals), width), np.array(left, int), np.array(right, int), np.array(ends))


def leaves_of(forest: Forest, vectors: np.ndarray) -> np.ndarray:
    """Leaf of each vector in each tree."""
    at = np.repeat(forest.roots[None, :], len(vectors), 0)
    while (inner := at >= 0).any():
        rows, trees = np.nonzero(inner)
        nodes = at[rows, trees]
        beyond = np.einsum("ij,ij->i", vectors[rows], forest.normals[nodes]) > 0
        at[rows, trees] = np.where(beyond, forest.right[nodes], forest.left[nodes])
    return -1 - at


def leaves_for(forest: Forest, sizes: np.ndarray, query: np.ndarray, reach: float, least: int) -> list[int]:
    """Leaves for a query through the queue shared by all trees: those within ``reach``, and further ones until those of one tree hold ``least`` vectors."""
    margins = (forest.normals @ query).tolist()
    queue = [(0.0, int(root), tree) for tree, root in enumerate(forest.roots)]
    heapq.heapify(queue)
    found, held = [], [0] * len(forest.roots)
    while queue and (queue[0][0] <= reach or max(held) < least):
        beyond, node, tree = heapq.heappop(queue)
        if node < 0:
            found.append(-1 - node)
            held[tree] += int(sizes[-1 - node])
            continue
        margin = margins[node]
        other = beyond + margin * margin
        heapq.heappush(queue, (beyond if margin > 0 else other, int(forest.right[node]), tree))
        heapq.heappush(queue, (other if margin > 0 else beyond, int(forest.left[node]), tree))
    return found


def reach_of(forest: Forest, queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """For each pair of a query and a vector the reach at which the query meets the vector in some tree."""
    at = np.repeat(forest.roots[None, :], len(vectors), 0)
    beyond = np.zeros(at.shape)
    while (inner := at >= 0).any():
        rows, trees = np.nonzero(inner)
        nodes = at[rows, trees]
        right = np.einsum("ij,ij->i", vectors[rows], forest.normals[nodes]) > 0
        margin = np.einsum("ij,ij->i", queries[rows], forest.normals[nodes])
        beyond[rows, trees] += np.where((margin > 0) == right, 0, margin * margin)
        at[rows, trees] = np.where(right, forest.right[nodes], forest.left[nodes])
    return beyond.min(1)


def buckets_of(sizes: np.ndarray, ends: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """First bucket and number of buckets of each leaf; neighbouring leaves of a tree share one while they hold ``chunk`` entries at most."""
    first, parts = np.zeros(len(sizes), np.int64), np.maximum(1, -(-sizes // chunk))
    bucket, held, starts = 0, 0, set(ends.tolist())
    for leaf, size in enumerate(sizes):
        if held and (held + size > chunk or leaf in starts):
            bucket, held = bucket + 1, 0
        first[leaf] = bucket
        held += int(size)
        if parts[leaf] > 1:
            bucket, held = bucket + int(parts[leaf]), 0
    return first, parts


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _classes(vectors: DataFrame, every: int, k: int) -> DataFrame:
    """Distinct vectors: ``h``, ``v``, ``cid`` (smallest id), ``members`` (the k + 1 smallest ids), ``asks``."""
    first = F.row_number().over(Window.partitionBy("h", "v").orderBy("vec_id"))
    few = vectors.distinct().withColumn("n", first).where(F.col("n") <= k + 1)
    members = few.groupBy("h", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
    asked = vectors.where(F.col("vec_id") % every == 0).select("h", "v").distinct().withColumn("asks", F.lit(True))
    return members.join(asked, ["h", "v"], "left").select("h", "v", F.get("members", F.lit(0)).alias("cid"), "members", F.coalesce("asks", F.lit(False)).alias("asks"))


def usable(table: DataFrame, column: str) -> DataFrame:
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kind = "array<float>" if table.schema[column].dataType == ArrayType(FloatType(), table.schema[column].dataType.containsNull) else "array<double>"
    fine = table.where(v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).select(F.col("vec_id").cast("long"), v.cast(kind).alias("v"))
    common = fine.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return fine.where(F.size("v") == (common["d"] if common else 0)).where("vec_id is not null").withColumn("h", F.xxhash64("v"))


def measured_reach(classes: DataFrame, forest: Forest, k: int, probes: int = PROBES, recall: float = RECALL) -> float:
    """The reach at which ``probes`` queries of the table meet ``recall`` of their true neighbours, found among all vectors."""
    asked = classes.where("asks").orderBy(F.xxhash64("cid"), "cid").limit(probes).select("cid", "v").toPandas()
    if asked.empty:
        return np.inf
    ids, points = asked["cid"].to_numpy(), unit(np.array(asked["v"].tolist(), float))

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best ``k`` vectors of a task for each probe."""
        scores, cids, best = np.zeros((len(ids), 0)), np.zeros((len(ids), 0), np.int64), np.zeros((len(ids), 0, points.shape[1]))
        for batch in batches:
            if not batch.num_rows:
                continue
            v, own = _matrix(batch["v"]), batch["cid"].to_numpy()
            near = points @ unit(v).T
            near[ids[:, None] == own[None, :]] = -np.inf
            few = np.argpartition(-near, min(k, near.shape[1]) - 1, 1)[:, :k]
            scores = np.hstack([scores, np.take_along_axis(near, few, 1)])
            cids, best = np.hstack([cids, own[few]]), np.concatenate([best, v[few]], 1)
            keep = np.argsort(-scores, 1, kind="stable")[:, :k]
            scores, cids = np.take_along_axis(scores, keep, 1), np.take_along_axis(cids, keep, 1)
            best = np.take_along_axis(best, keep[:, :, None], 1)
        probe, at = np.nonzero(np.isfinite(scores))
        yield pa.RecordBatch.from_arrays(
            [pa.array(probe, pa.int32()), pa.array(scores[probe, at]), pa.array(cids[probe, at]), pa.array(best[probe, at].tolist(), pa.list_(pa.float64()))],
            ["probe", "score", "cid", "v"],
        )

    held = classes.select("cid", "v").mapInArrow(hold, "probe int, score double, cid long, v array<double>")
    place = F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "cid"))
    true = held.withColumn("n", place).where(F.col("n") <= k).select("probe", "v").toPandas()  # k rows a probe
    if true.empty:
        return np.inf
    needs = np.sort(reach_of(forest, points[true["probe"].to_numpy()], unit(np.array(true["v"].tolist(), float))))
    return float(needs[min(len(needs) - 1, int(np.ceil(recall * len(needs))) - 1)])


def nearest(table: DataFrame, column: str = "embedding", every: int = 50, k: int = 5, recall: float = RECALL, chunk: int = CHUNK, asks: int = ASKS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` for the rows whose ``vec_id`` is divisible by ``every``."""
    spark = table.sparkSession
    vectors = usable(table, column)
    classes = stage(_classes(vectors, every, k), "classes")
    kind = classes.schema["v"].dataType.simpleString()
    sample = classes.select("cid", "v").orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE_ROWS).toPandas()
    points = np.array(sample["v"].tolist(), float)
    forest = grow(points)
    shared = spark.sparkContext.broadcast((forest.roots, forest.normals, forest.left, forest.right, forest.ends))
    reach = measured_reach(classes, forest, k, recall=recall)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Forest(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                leaves = leaves_of(own, _matrix(part["v"]))
                yield pa.RecordBatch.from_arrays([part["cid"], pa.array(leaves.tolist(), pa.list_(pa.int32())), part["v"]], ["cid", "leaves", "v"])

    placed = stage(classes.select("cid", "v").mapInArrow(place, f"cid long, leaves array<int>, v {kind}"), "placed")
    counts = placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect()  # one row for each leaf of the forest
    sizes = np.zeros(forest.ends[-1], np.int64)
    for row in counts:
        sizes[row["leaf"]] = row["count"]
    first, parts = buckets_of(sizes, forest.ends, chunk)
    known = spark.sparkContext.broadcast((sizes, first, parts))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (sizes, first, parts) = Forest(*shared.value), known.value
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows, buckets, cells = [], [], []
                for row, query in enumerate(unit(_matrix(part["v"]))):
                    by_bucket: dict[int, list[int]] = {}
                    for leaf in leaves_for(own, sizes, query, reach, k + 1):
                        for bucket in range(int(first[leaf]), int(first[leaf] + parts[leaf])):
                            by_bucket.setdefault(bucket, []).append(leaf)
                    rows += [row] * len(by_bucket)
                    buckets += by_bucket.keys()
                    cells += by_bucket.values()
                who = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part["cid"].take(who), part["v"].take(who), pa.array(buckets, pa.int64()), pa.array(cells, pa.list_(pa.int32()))], ["query", "q", "bucket", "cells"]
                )

    asked = stage(classes.where("asks").select("cid", "v").mapInArrow(ask, f"query long, q {kind}, bucket long, cells array<int>"), "asked")
    slices = asked.groupBy("bucket").agg(F.ceil(F.count("*") / asks).alias("slices"))
    asked = asked.join(slices, "bucket").select("query", "q", "cells", "bucket", F.pmod(F.xxhash64("query"), "slices").alias("slice"))
    homes = spark.createDataFrame([(leaf, int(f), int(n)) for leaf, (f, n) in enumerate(zip(first, parts, strict=True))], "leaf int, first long, parts long")
    entries = placed.select("cid", "v", F.explode("leaves").alias("leaf")).join(homes, "leaf")
    entries = entries.select("cid", "v", "leaf", (F.col("first") + F.pmod(F.xxhash64("cid"), "parts")).alias("bucket")).join(slices, "bucket")
    entries = entries.select("cid", "v", "leaf", "bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    keep = k + 1

    def rank(queries: pa.Table, rows: pa.Table) -> pa.Table:
        names, types = ["query", "cid", "score"], [pa.int64(), pa.int64(), pa.float64()]
        if not queries.num_rows or not rows.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in types], names)
        q, v = _matrix(queries["q"]), _matrix(rows["v"])
        ids = rows["cid"].to_numpy()
        leaves, home = np.unique(rows["leaf"].to_numpy(), return_inverse=True)
        mine, unit_q, unit_v = queries["cells"].combine_chunks(), unit(q), unit(v)
        owner = np.repeat(np.arange(len(q)), np.diff(mine.offsets.to_numpy()))
        cell = mine.flatten().to_numpy()
        there = np.isin(cell, leaves)
        open_ = np.zeros((len(q), len(leaves)), bool)
        open_[owner[there], np.searchsorted(leaves, cell[there])] = True
        out_q, out_v = [], []
        for at in range(0, len(q), 256):
            near = unit_q[at : at + 256] @ unit_v.T
            near[~open_[at : at + 256][:, home]] = -np.inf
            for k_, line in enumerate(near, at):
                best = np.flatnonzero(np.isfinite(line) if len(line) <= keep else line >= max(np.partition(line, -keep)[-keep] - 1e-9, -2.0))
                best = best[np.lexsort((ids[best], -np.round(line[best], 12)))][: keep + 2]
                out_q.append(np.full(len(best), k_)), out_v.append(best)
        at_q, at_v = np.concatenate(out_q), np.concatenate(out_v)
        # row by row, so that a pair scores the same wherever it is met
        dot = (q[at_q] * v[at_v]).sum(1)
        score = dot / (np.sqrt((q[at_q] ** 2).sum(1)) * np.sqrt((v[at_v] ** 2).sum(1)))
        return pa.Table.from_arrays([queries["query"].take(pa.array(at_q)), pa.array(ids[at_v]), pa.array(score)], names)

    found = asked.groupBy("bucket", "slice").cogroup(entries.groupBy("bucket", "slice")).applyInArrow(rank, "query long, cid long, score double")
    found = found.groupBy("query", "cid").agg(F.max("score").alias("score"))
    by_class = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "cid"))
    found = found.withColumn("n", by_class).where(F.col("n") <= keep).join(classes.select("cid", "members"), "cid")
    found = found.select("query", "score", F.explode("members").alias("vec_id"))
    queries = vectors.where(F.col("vec_id") % every == 0).select("h", "v", F.col("vec_id").alias("query_id")).distinct()
    queries = queries.join(classes.where("asks").select("h", "v", F.col("cid").alias("query")), ["h", "v"]).select("query_id", "query")
    pairs = queries.join(found, "query").where("vec_id <> query_id")
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact(table: DataFrame, column: str = "embedding", every: int = 50, k: int = 5) -> list[tuple[int, list[int]]]:
    """Brute force on the driver, for small tables in tests."""
    rows = usable(table, column).select("vec_id", "v").toPandas().sort_values("vec_id")
    ids, v = rows["vec_id"].to_numpy(), unit(np.array(rows["v"].tolist()))
    out = []
    for at in np.flatnonzero(ids % every == 0):
        near = v @ v[at]
        near[at] = -np.inf
        out.append((int(ids[at]), ids[np.lexsort((ids, -near))][:k].tolist()))
    return out
