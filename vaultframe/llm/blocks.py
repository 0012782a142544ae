"""Corpus-wide counts for the keys of each block of documents, by request and answer.

Joining every n-gram occurrence of a corpus with its count shuffles a row for
each occurrence, twice. Here documents are dealt into blocks; a block asks for
its distinct keys, sorted and delta-coded (about five bytes each), one message
for every key range. The task of a key range adds up what all blocks have sent
and answers each block with counts in the order it asked, so an answer needs no
keys. A frequent key is one entry per block and can't make a range heavy.

The number of blocks and of ranges grows with the input (``block_count``), so a
task's memory is that of one block or one range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultframe.llm.common import LOWER

BLOCK_BYTES = 12 << 20
LEAST_BLOCKS = 32
MOST_BLOCKS = 60_000  # beyond it blocks grow: messages number blocks * ranges and would become tiny
KEY_BITS = 48
ASK = "block int, range int, keys binary, counts binary, marks binary"
_EMPTY = np.zeros(0, np.uint64)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    MOST = 400_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def hashes_of(text: bytes | None, known: WordHashes) -> np.ndarray:
    """Hashes of the words of a text, A-Z lower-cased; null and blank texts have none."""
    words = (text or b"").translate(LOWER).split()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words)) if words else _EMPTY


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash for each window of ``n`` words; none if there are fewer words."""
    count = max(0, len(hashes) - n + 1)
    out = mixed(hashes[:count])
    for k in range(1, n):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count])
    return out


def short_key(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - KEY_BITS)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys: the first whole, then differences, each in as few bytes as the largest one needs."""
    if not len(keys):
        return b""
    steps = np.diff(keys).astype("<u8")
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    if not blob:
        return _EMPTY
    width = blob[0]
    raw = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    full = np.zeros((len(raw) + 1, 8), np.uint8)
    full[0] = np.frombuffer(blob, np.uint8, 8, offset=1)
    full[1:, :width] = raw
    return np.cumsum(full.view("<u8").ravel(), dtype=np.uint64)


def pack_counts(values: np.ndarray) -> bytes:
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpack_counts(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<u{blob[0]}", offset=1).astype(np.int64) if blob else np.zeros(0, np.int64)


def block_count(docs: DataFrame, text: str = "text") -> int:
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(LEAST_BLOCKS, min(MOST_BLOCKS, math.ceil(size / BLOCK_BYTES)))


def block_of(column: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def asks(block: int, ranges: int, keys: np.ndarray, counts: np.ndarray, marks: np.ndarray | None, bits: int = KEY_BITS) -> Iterator[dict]:
    """Messages of one block. ``keys`` ascend; ``marks`` is a second count, or None."""
    edges = np.searchsorted(keys, [np.uint64((r << bits) // ranges) for r in range(1, ranges)])
    for r, (a, b) in enumerate(zip([0, *edges], [*edges, len(keys)], strict=True)):
        if a < b:
            yield {"block": block, "range": r, "keys": pack_sorted(keys[a:b]), "counts": pack_counts(counts[a:b]), "marks": b"" if marks is None else pack_counts(marks[a:b])}


def as_table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


ASK_ARROW = pa.schema([("block", pa.int32()), ("range", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("marks", pa.binary())])


def answers(requests: DataFrame) -> DataFrame:
    """Totals for each message, in its order of keys (``keys`` comes back empty).

    Each range also gives a row of block -1: ``counts`` then holds the number of
    keys counted at least once and the sum of all counts.
    """

    def total(messages: pa.Table) -> pa.Table:
        asked = [unpack_sorted(x.as_py()) for x in messages["keys"]]
        distinct, at = np.unique(np.concatenate(asked), return_inverse=True)
        sums = []
        for name in ("counts", "marks"):
            values = np.concatenate([unpack_counts(x.as_py()) for x in messages[name]])
            sums.append(np.bincount(at, values, len(distinct)).astype(np.int64) if len(values) else None)
        ends = np.cumsum([len(x) for x in asked])[:-1]
        which = messages["range"][0].as_py()
        rows = [
            {"block": block.as_py(), "range": which, "keys": b"", "counts": pack_counts(sums[0][part]), "marks": b"" if sums[1] is None else pack_counts(sums[1][part])}
            for block, part in zip(messages["block"], np.split(at, ends), strict=True)
        ]
        told = np.array([np.count_nonzero(sums[0]), sums[0].sum()])
        return as_table([*rows, {"block": -1, "range": which, "keys": b"", "counts": pack_counts(told), "marks": b""}], ASK_ARROW)

    return requests.groupBy("range").applyInArrow(total, ASK)


def read_answers(messages: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Counts and marks of a block's keys, in the ascending order it asked for them."""
    messages = messages.sort_by("range")
    empty = np.zeros(0, np.int64)
    counts = [unpack_counts(x.as_py()) for x in messages["counts"]]
    marks = [unpack_counts(x.as_py()) for x in messages["marks"]]
    return np.concatenate([empty, *counts]), np.concatenate([empty, *marks])
