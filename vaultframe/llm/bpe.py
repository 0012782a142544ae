"""Byte-level BPE encoding and decoding over a contiguous array of ranks.

Method: a pre-token's bytes are cut into parts held as a list of boundaries with,
beside each boundary, the rank of merging the part that starts there with the
next one. The least rank is found by scanning, its boundary is deleted, and the
ranks of the two neighbours are refreshed, until no pair can merge. Scanning is
quadratic, so pre-tokens longer than ``SHORT`` bytes keep the same ranks in a heap
over linked parts; both give the same ids. Ids of pre-tokens are remembered up to
a bound, so that common words are merged once a worker.

The vocabulary (some 50,000 entries, whatever the corpus) is read on the driver
and broadcast; executors need no file. Whole texts are encoded, one at a time.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: How byte-level BPE cuts a text before merging. The common case, a word, is tried first;
#: no word starts with an apostrophe, so the contractions still win where they apply.
PRE_TOKEN = r" ?\p{L}++| ?\p{N}++|'(?:s|t|re|ve|m|ll|d)| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
#: The same for texts below U+0250, with the letters, digits and spaces of that range spelt out.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\\t-\\r \x85\xa0"
LATIN_PRE_TOKEN = rf" ?[{_L}]++| ?[{_N}]++|'(?:s|t|re|ve|m|ll|d)| ?[^{_S}{_L}{_N}]++|[{_S}]+(?![^{_S}])|[{_S}]+"
SHORT = 96
RUN_BYTES = 1 << 19
REMEMBERED = 400_000
SHIFT = 24  # bits of an id inside a pair or beside a rank
MASK = (1 << SHIFT) - 1
NONE = 1 << 60


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable Latin-1
    characters stand for themselves, all others are numbered from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """``merges``: left id and right id in one number -> rank and merged id in one number;
    ``special``: whole strings with an id of their own."""

    byte_ids: tuple[int, ...]
    merges: dict[int, int]
    token_bytes: dict[int, bytes]
    special: dict[str, int] = field(default_factory=dict)


def load_vocabulary(path: str) -> Vocabulary:
    """Reads a byte-level BPE file of the ``tokenizers`` library (JSON)."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    letters = byte_letters()
    ids = stored["model"]["vocab"]
    merges = {}
    for rank, pair in enumerate(stored["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges[ids[left] << SHIFT | ids[right]] = rank << SHIFT | ids[left + right]
    token_bytes = {i: bytes(letters[c] for c in token) for token, i in ids.items() if all(c in letters for c in token)}
    special = {t["content"]: t["id"] for t in stored["added_tokens"]}
    token_bytes |= {i: text.encode() for text, i in special.items()}
    by_byte = {b: ids[letter] for letter, b in letters.items()}
    return Vocabulary(tuple(by_byte[b] for b in range(256)), merges, token_bytes, special)


def merge_scanning(ids: list[int], merges: dict[int, int]) -> list[int]:
    """``ids``: one for each byte. Scans for the least rank; the leftmost of equals merges first."""
    find = merges.get
    ranks = [find(a << SHIFT | b, NONE) for a, b in zip(ids, ids[1:])]  # noqa: B905
    while ranks and (best := min(ranks)) != NONE:
        at = ranks.index(best)
        merged = best & MASK
        ids[at : at + 2] = [merged]
        del ranks[at]
        if at < len(ranks):
            ranks[at] = find(merged << SHIFT | ids[at + 1], NONE)
        if at:
            ranks[at - 1] = find(ids[at - 1] << SHIFT | merged, NONE)
    return ids


def merge_heaped(ids: list[int], merges: dict[int, int]) -> list[int]:
    """The same merges in the same order, in n log n steps for long pre-tokens."""
    end = len(ids)
    after, before, version = [*range(1, end + 1)], [*range(-1, end - 1)], [0] * end
    heap: list[tuple[int, int, int, int]] = []

    def offer(at: int) -> None:
        if at >= 0 and after[at] < end and (rank := merges.get(ids[at] << SHIFT | ids[after[at]])) is not None:
            heapq.heappush(heap, (rank, at, version[at], version[after[at]]))

    for at in range(end - 1):
        offer(at)
    while heap:
        rank, at, own, its = heapq.heappop(heap)
        if version[at] != own or after[at] >= end or version[after[at]] != its:
            continue
        gone = after[at]
        version[gone] = -1
        ids[at], after[at] = rank & MASK, after[gone]
        version[at] += 1
        if after[at] < end:
            before[after[at]] = at
        offer(at)
        offer(before[at])
    out, at = [], 0
    while at < end:
        out.append(ids[at])
        at = after[at]
    return out


class Merger:
    """Merges many short pre-tokens at once: one row each of part ids and adjacent ranks, scanned for the
    least rank row by row; the boundary is deleted by closing the gap, and its two neighbours are refreshed."""

    def __init__(self, vocabulary: Vocabulary):
        pairs = np.array(sorted(vocabulary.merges), np.int64)
        found = np.array([vocabulary.merges[p] for p in pairs.tolist()], np.int64)
        self.pairs, self.found = np.append(pairs, np.int64(NONE)), np.append(found, np.int64(NONE))
        self.byte_ids = np.array(vocabulary.byte_ids, np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << SHIFT | right
        at = np.searchsorted(self.pairs, wanted)
        return np.where(self.pairs[at] == wanted, self.found[at], NONE)

    def merge(self, words: list[bytes]) -> list[tuple[int, ...]]:
        out: list[tuple[int, ...]] = [()] * len(words)
        order = sorted(range(len(words)), key=lambda k: len(words[k]))
        for start in range(0, len(order), 4096):
            self._merge_alike(words, order[start : start + 4096], out)
        return out

    def _merge_alike(self, words: list[bytes], which: list[int], out: list) -> None:
        size = np.array([len(words[k]) for k in which])
        wide = max(2, int(size.max()))
        raw = np.frombuffer(b"".join(words[k].ljust(wide, b"\0") for k in which), np.uint8).reshape(-1, wide)
        ids, columns, own = self.byte_ids[raw], np.arange(wide), np.array(which)
        ranks = np.full(ids.shape, NONE)
        ranks[:, :-1] = self.ranks(ids[:, :-1], ids[:, 1:])
        ranks[columns >= size[:, None] - 1] = NONE
        while len(own):
            at = ranks.argmin(1)
            rows = np.arange(len(own))
            best = ranks[rows, at]
            done = best == NONE
            if done.any():
                for k, n, row in zip(own[done].tolist(), size[done].tolist(), ids[done].tolist(), strict=True):
                    out[k] = tuple(row[:n])
                left = ~done
                ids, ranks, size, own, at, best = ids[left], ranks[left], size[left], own[left], at[left], best[left]
                rows = rows[: len(own)]
            shifted = np.minimum(columns + (columns > at[:, None]), wide - 1)
            ids, ranks = np.take_along_axis(ids, shifted, 1), np.take_along_axis(ranks, shifted, 1)
            size = size - 1
            ids[rows, at] = best & MASK
            ranks[rows, np.minimum(size - 1, wide - 1)] = NONE
            inner = at + 1 < size
            r, c = rows[inner], at[inner]
            ranks[r, c] = self.ranks(ids[r, c], ids[r, c + 1])
            r, c = rows[at > 0], at[at > 0]
            ranks[r, c - 1] = self.ranks(ids[r, c - 1], ids[r, c])


class Encoder(dict):
    """Pre-token -> ids, remembered up to ``REMEMBERED`` entries."""

    def __init__(self, vocabulary: Vocabulary):
        import regex

        super().__init__()
        self.vocabulary = vocabulary
        self.merger = Merger(vocabulary)
        self.bytes_of = [vocabulary.token_bytes.get(i, b"") for i in range(max(vocabulary.token_bytes) + 1)]
        self.any_pieces = regex.compile(PRE_TOKEN).findall
        self.latin_pieces = re.compile(LATIN_PRE_TOKEN).findall
        self.beyond_latin = re.compile("[^\0-\u024f]").search
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")").split if special else None

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = [self.vocabulary.byte_ids[b] for b in piece.encode()]
        merged = tuple((merge_scanning if len(ids) <= SHORT else merge_heaped)(ids, self.vocabulary.merges))
        if len(ids) <= SHORT:
            self[piece] = merged
        return merged

    def pieces(self, text: str) -> list[str]:
        return (self.any_pieces if self.beyond_latin(text) else self.latin_pieces)(text)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; null and empty texts have none."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of a few texts; the pre-tokens not met before are merged together."""
        cut = self.cut or (lambda text: [text])
        parts = [[p if k % 2 else self.pieces(p) for k, p in enumerate(cut(text))] if text else [] for text in texts]
        if len(self) >= REMEMBERED:
            self.clear()
        new = {piece for doc in parts for part in doc[::2] for piece in part if piece not in self}
        short = {piece: raw for piece in new if len(raw := piece.encode()) <= SHORT}
        self.update(zip(short, self.merger.merge([*short.values()]), strict=True))
        out: list[list[int]] = []
        for doc in parts:
            ids: list[int] = []
            for k, part in enumerate(doc):
                if k % 2:
                    ids.append(self.vocabulary.special[part])
                else:
                    ids.extend(chain.from_iterable(map(self.__getitem__, part)))
            out.append(ids)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Bytes that aren't UTF-8 become U+FFFD, as in the ``tokenizers`` library."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def few_at_a_time(column: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a batch in runs of about ``RUN_BYTES``, so that memory is that of a run or of one text."""
    run: list[str | None] = []
    size = 0
    for text in (x.as_py() for x in column):
        run.append(text)
        size += len(text or "")
        if size >= RUN_BYTES:
            yield run
            run, size = [], 0
    if run:
        yield run


def shared_vocabulary(spark: SparkSession, path: str):
    """The fields of the vocabulary, broadcast: their size is that of the file."""
    v = load_vocabulary(path)
    return spark.sparkContext.broadcast((v.byte_ids, v.merges, v.token_bytes, v.special))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``text`` -> ``doc_id``, ``ids`` (array of int), ``decoded`` (text again).

    Null and empty texts give an empty list and an empty text; repeated rows stay
    repeated; other columns are ignored; no rows give no rows. A special token's
    string in a text becomes its id, as the ``tokenizers`` library does.
    """
    vocabulary = shared_vocabulary(docs.sparkSession, path)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*vocabulary.value))
        for batch in batches:
            ids = [x for run in few_at_a_time(batch["text"]) for x in encoder.encode_all(run)]
            texts = [encoder.decode(x) for x in ids]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``: the digests of ``encode``, taken beside
    the encoder so that neither ids nor texts travel back."""
    vocabulary = shared_vocabulary(docs.sparkSession, path)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*vocabulary.value))
        decimal = {i: str(i) for i in encoder.vocabulary.token_bytes}.__getitem__
        for batch in batches:
            counts, of_ids, of_texts = [], [], []
            for ids in (x for run in few_at_a_time(batch["text"]) for x in encoder.encode_all(run)):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                of_texts.append(hashlib.sha256(encoder.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)
