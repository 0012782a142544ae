"""Words made of letters and digits, for the operators on term statistics.

A word is a run of 0-9, A-Z, a-z and characters from U+0080 up, A-Z lower-cased; everything
else only separates. In UTF-8 that is a rule on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Lower-cases A-Z, turns every separator into a space and leaves other bytes alone.
TO_WORDS = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
#: The same words for SQL engines whose patterns see characters.
WORD_SQL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PIECE_BYTES = 1 << 20


def pieces(text: bytes | None, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a whole text in runs of about ``size`` bytes, so that a very long text is never one big list."""
    clean = (text or b"").translate(TO_WORDS)
    at = 0
    while at < len(clean):
        cut = clean.find(b" ", at + size) if at + size < len(clean) else -1
        end = cut if cut >= 0 else len(clean)
        words = clean[at:end].split()
        if words:
            yield words
        at = end


def texts_of(column: pa.Array) -> Iterator[bytes | None]:
    """The texts of an Arrow column as UTF-8 bytes."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py()
