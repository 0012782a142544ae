"""Exact top-k inner products by pruning blocks of the forward index.

Components are numbers of ``floor(scale * x)``; the components of a vector are its terms.

Index: every vector goes to a range, that of the pivot nearest to it (pivots are a
bounded sample, ``PIVOTS`` vectors that come first by a hash; they only decide the order). Crowded
ranges are split by hash into ranges of about ``RANGE_ROWS``. A range is cut into blocks of
``BLOCK_ROWS`` vectors; a block is one row: ids, forward index (the vectors, packed in as few bytes as
they need), and the largest and smallest value of each term.

Search: a query's bound in a block is the sum over its terms of value times the term's
maximum (minimum, where the value is negative). Blocks are visited in the order of these bounds, the block's
forward index scores all its vectors at once, and the query stops when the next bound falls below its
``k``-th score. Queries start in their own range, which gives each a first threshold; then they
go, in chunks, to every range whose bound reaches that threshold. One task holds one range and one
chunk of queries, and the best over all ranges are merged at the end. Nothing equal to the ``k``-th score
is pruned, so ties go to the smaller id exactly.

Scores are exact integers: matrix products in floating point where all sums are whole numbers
below the type's limit, otherwise Python integers without pruning. Components and scores beyond 64 bits stay at
the limit. A vector shorter than another counts as 0 in the terms it lacks.

Vectors that are null or hold null or non-finite components, and rows without id, take no part; a vector of
noughts or without components does. Equal rows (id and vector) count once. A query id with several
vectors asks with the first of them in array order; rows of the query's own id are no candidates. A query
with fewer than ``k`` others gets all. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultframe.session import stage

PIVOTS = 256
ROWS_PER_PIVOT = 4096
RANGE_ROWS = 16_384
BLOCK_ROWS = 256
CHUNK_QUERIES = 4096
#: Range maxima are sent to the tasks up to this many numbers; beyond, queries go to every range and the bounds are tested there.
SENT_BOUNDS = 2_000_000
FOUND = "query_id long, vec_id long, score long"
_LOWEST, _HIGHEST = -(2**63), 2**63 - 1


def usable(table: DataFrame, column: str, scale: int) -> DataFrame:
    """``vec_id``, ``v`` (array of long), equal rows once."""
    x = F.col(column)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))
    rows = table.where(x.isNotNull() & finite).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    return rows.where("vec_id is not null").distinct()


def packed(values: np.ndarray) -> bytes:
    """Integers of any shape in as few bytes each as the largest needs; the first byte tells how many."""
    most = max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0
    width = next(w for w in (1, 2, 4, 8) if w == 8 or most < 1 << (8 * w - 1))
    return bytes([width]) + values.astype(f"<i{width}").tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<i{blob[0]}", offset=1).astype(np.int64)


def rows_of(column) -> list[np.ndarray]:
    return [np.array(x, np.int64) for x in column.to_pylist()]


def pivots_of(vectors: DataFrame, rows: int) -> list[list[int]]:
    number = min(PIVOTS, max(1, rows // ROWS_PER_PIVOT))
    return [r["v"] for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").select("v").limit(number).collect()]


def placed(vectors: DataFrame, pivots: list[list[int]]) -> DataFrame:
    """``vectors`` with the ``pivot`` of largest cosine."""
    width = max(map(len, pivots), default=0)
    grid = np.zeros((max(1, len(pivots)), width))
    for line, pivot in zip(grid, pivots, strict=False):
        line[: len(pivot)] = pivot
    grid /= np.maximum(np.linalg.norm(grid, axis=1, keepdims=True), 1e-300)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["v"].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            sizes = np.diff(batch["v"].offsets.to_numpy())
            whole = np.zeros((batch.num_rows, width))
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            inside = place < width
            whole[np.repeat(np.arange(batch.num_rows), sizes)[inside], place[inside]] = flat[inside]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((whole @ grid.T).argmax(1), pa.int32())], ["vec_id", "v", "pivot"])

    return vectors.mapInArrow(run, "vec_id long, v array<long>, pivot int")


def blocks_of(vectors: DataFrame) -> DataFrame:
    """The index: a row for each block, its vectors all of one ``size``."""

    def run(table: pa.Table) -> pa.Table:
        rows = rows_of(table["v"])
        ids = table["vec_id"].to_numpy()
        which, size = table["range"][0].as_py(), len(rows[0])
        values = np.array(rows).reshape(len(rows), size)
        order = np.argsort(values[:, values.std(0).argmax()], kind="stable") if size else np.arange(len(rows))
        out = []
        for at in range(0, len(rows), BLOCK_ROWS):
            part = order[at : at + BLOCK_ROWS]
            part = part[np.argsort(ids[part])]
            v = values[part]
            out.append((which, size, ids[part].tobytes(), packed(v), packed(v.max(0)), packed(v.min(0))))
        types = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
        names = ["range", "size", "ids", "values", "high", "low"]
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    kept = vectors.select("range", F.size("v").alias("size"), "vec_id", "v")
    return kept.groupBy("range", "size").applyInArrow(run, "range int, size int, ids binary, values binary, high binary, low binary")


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Largest product each query can have with any vector between ``low`` and ``high``, a column for each pair of them."""
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def _padded(rows: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for line, row in zip(out, rows, strict=True):
        line[: len(row)] = row[:width]
    return out


def walk(queries: list[np.ndarray], own: np.ndarray, least: np.ndarray, blocks: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Rows (query number, id, score) that can be among the ``k`` best, given scores ``least`` to reach; and the number of blocks scored.

    ``blocks`` are (ids ascending, values, high, low).
    """
    width = max([len(q) for q in queries] + [b[1].shape[1] for b in blocks])
    widest = _padded(queries, width)
    most = [max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0 for x in (widest, *[b[1] for b in blocks])]
    reach = most[0] * max(most[1:]) * max(1, width)
    kind = np.float32 if reach < 2**24 else np.float64 if reach < 2**53 else object
    asking = widest.astype(kind)
    high, low = (_padded([b[c] for b in blocks], width).astype(kind) for c in (2, 3))
    if kind is object:
        limit = np.full((len(queries), len(blocks)), _HIGHEST)
    else:
        limit = bounds(asking, high, low).astype(np.int64)
    order = np.argsort(-limit, axis=1, kind="stable")
    number = np.arange(len(queries))
    least = least.copy()
    best = [np.zeros(0, np.int64)] * 3
    scored = 0
    for step in range(len(blocks)):
        block = order[:, step]
        alive = np.flatnonzero(limit[number, block] >= least)
        if not len(alive):
            break
        fresh = [best]
        turn = alive[np.argsort(block[alive], kind="stable")]
        for group in np.split(turn, np.flatnonzero(np.diff(block[turn])) + 1):
            ids, values = blocks[block[group[0]]][:2]
            near = asking[group, : values.shape[1]] @ values.astype(kind).T
            near = np.clip(near, _LOWEST, _HIGHEST).astype(np.int64) if kind is object else near
            at_q, at_v = np.nonzero((near >= least[group, None]) & (ids[None, :] != own[group, None]))
            fresh.append([group[at_q], ids[at_v], near[at_q, at_v].astype(np.int64)])
            scored += len(group)
        q, v, s = (np.concatenate(x) for x in zip(*fresh, strict=True))
        turn = np.lexsort((v, -s if len(s) and s.min() > _LOWEST else ~s, q))
        q, v, s = q[turn], v[turn], s[turn]
        starts = np.searchsorted(q, number)
        place = np.arange(len(q)) - starts[q]
        best = [x[place < k] for x in (q, v, s)]
        full = np.flatnonzero(place == k - 1)
        least[q[full]] = np.maximum(least[q[full]], s[full])
    return *best, scored


def _tiles(asked: DataFrame, index: DataFrame, chunks: int, k: int) -> DataFrame:
    """``asked``: a row for each query and range to visit (``range``, ``chunk``, ``query_id``, ``v``, ``least``)."""

    def run(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        names, types = ["query_id", "vec_id", "score"], [pa.int64()] * 3
        if not queries.num_rows or not blocks.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in types], names)
        held = []
        for row in blocks.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            held.append((ids, unpacked(row["values"]).reshape(len(ids), row["size"]), unpacked(row["high"]), unpacked(row["low"])))
        own = queries["query_id"].to_numpy()
        q, v, s, _ = walk([unpacked(x.as_py()) for x in queries["v"]], own, queries["least"].to_numpy().copy(), held, k)
        return pa.Table.from_arrays([pa.array(own[q]), pa.array(v), pa.array(s)], names)

    spread = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    return asked.groupBy("range", "chunk").cogroup(spread.groupBy("range", "chunk")).applyInArrow(run, FOUND)


def _ranges_to_visit(queries: DataFrame, index: DataFrame, ranges: list[int]) -> DataFrame:
    """Every query (``home`` left out) with each range whose bound reaches its ``least``."""
    width = index.agg(F.max("size")).first()[0] or 0
    small = len(ranges) * width * 2 <= SENT_BOUNDS

    def merge(table: pa.Table) -> pa.Table:
        high, low = (_padded([unpacked(x.as_py()) for x in table[c]], width) for c in ("high", "low"))
        return pa.table({"range": table["range"][:1], "high": pa.array([high.max(0).tolist()], pa.list_(pa.int64())), "low": pa.array([low.min(0).tolist()], pa.list_(pa.int64()))})

    ends = []
    if small:
        ends = index.select("range", "high", "low").groupBy("range").applyInArrow(merge, "range int, high array<long>, low array<long>").collect()
    shared = index.sparkSession.sparkContext.broadcast((ranges, ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, ends = shared.value
        high, low = (np.array([r[c] for r in ends], np.int64).reshape(len(ends), width) for c in ("high", "low"))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                if not ends:
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array([ranges] * part.num_rows, pa.list_(pa.int32()))], [*part.schema.names, "ranges"])
                    continue
                asking = _padded([unpacked(x.as_py()) for x in part["v"]], width)
                most = [max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0 for x in (asking, high, low)]
                safe = most[0] * max(most[1:]) * max(1, width) < 2**53
                reach = bounds(asking.astype(float), high.astype(float), low.astype(float)) if safe else np.full((len(asking), len(ends)), np.inf)
                wanted = reach >= part["least"].to_numpy()[:, None]
                names = np.array([r["range"] for r in ends])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([names[w].tolist() for w in wanted], pa.list_(pa.int32()))], [*part.schema.names, "ranges"])

    chosen = queries.select("home", "chunk", "query_id", "v", "least").mapInArrow(run, "home int, chunk int, query_id long, v binary, least long, ranges array<int>")
    return chosen.select("home", "chunk", "query_id", "v", "least", F.explode("ranges").alias("range")).where("range <> home")


def top_products(table: DataFrame, column: str = "embedding", every: int = 20, k: int = 20, scale: int = 64) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` for the rows whose ``vec_id`` is divisible by ``every``."""
    vectors = stage(usable(table, column, scale), "vectors")
    pivots = pivots_of(vectors, vectors.count())
    at_pivot = stage(placed(vectors, pivots), "placed")
    crowds = at_pivot.groupBy("pivot").agg(F.count("*").alias("n")).collect()  # PIVOTS rows at most
    parts = {r["pivot"]: -(-r["n"] // RANGE_ROWS) for r in crowds}
    starts = dict(zip(sorted(parts), np.cumsum([0, *[parts[p] for p in sorted(parts)]]).tolist(), strict=False))
    ranges = list(range(sum(parts.values())))
    numbers = F.create_map(*[F.lit(x) for p in parts for x in (p, starts[p])]) if parts else F.create_map(F.lit(0), F.lit(0))
    shares = F.create_map(*[F.lit(x) for p in parts for x in (p, parts[p])]) if parts else F.create_map(F.lit(0), F.lit(1))
    which = numbers[F.col("pivot")] + F.pmod(F.xxhash64("vec_id", "v"), shares[F.col("pivot")]).cast("int")
    ranged = at_pivot.select(which.alias("range"), "vec_id", "v")
    index = stage(blocks_of(ranged), "blocks")

    rows = ranged.where(F.col("vec_id") % every == 0)
    first = F.row_number().over(Window.partitionBy("vec_id").orderBy("v"))
    once = rows.withColumn("n", first).where("n = 1").select(F.col("range").alias("home"), F.col("vec_id").alias("query_id"), "v")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["home"], batch["query_id"], pa.array([packed(x) for x in rows_of(batch["v"])], pa.binary())], ["home", "query_id", "v"])

    queries = stage(once.mapInArrow(pack, "home int, query_id long, v binary"), "queries")
    chunks = max(1, math.ceil(queries.count() / CHUNK_QUERIES))
    queries = queries.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int"))
    at_home = queries.select(F.col("home").alias("range"), "chunk", "query_id", "v", F.lit(_LOWEST).alias("least"))
    near = stage(_tiles(at_home, index, chunks, k), "near")
    reached = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k).drop("n")
    asking = queries.join(reached, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(_LOWEST)))
    far = _tiles(_ranges_to_visit(asking, index, ranges), index, chunks, k)
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = near.union(far).withColumn("rank", order).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


SQL = """
with vectors as (
  select vec_id, [floor(64 * x::double) for x in embedding] as v from embeddings
  where embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scores as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from vectors q join vectors c on c.vec_id <> q.vec_id where q.vec_id % 20 = 0),
ranked as (select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from scores)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 20
"""
