"""Hash keys and hash-diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def hash_key(*cols: Column | str) -> Column:
    """sha1 over every business key followed by a colon; null if any part is null."""
    parts = []
    for col in cols:
        parts += [_text(col), F.lit(":")]
    return F.sha1(F.concat(*parts))


def hash_diff(*cols: Column | str) -> Column:
    """sha1 over trimmed texts joined by colons; a missing value counts as empty."""
    return F.sha1(F.concat_ws(":", *[F.trim(F.coalesce(_text(c), F.lit(""))) for c in cols]))


def packed(col: Column | str) -> Column:
    """A hash key in half its bytes, for shuffles: 20 bytes for 40 lower-case hex digits.

    Any other text becomes its own bytes behind 21 zero bytes, so that two keys are equal packed if and only if
    they are equal as texts. The order of packed keys is not that of the texts.
    """
    text = _text(col)
    raw = F.unhex(text)
    is_hash = (F.length(text) == 40) & (F.lower(F.hex(raw)) == text)
    return F.when(is_hash, raw).otherwise(F.concat(F.lit(bytes(21)), text.cast("binary")))


def unpacked(col: Column | str) -> Column:
    """The text of a key from :func:`packed`."""
    key = F.col(col) if isinstance(col, str) else col
    return F.when(F.length(key) == 20, F.lower(F.hex(key))).otherwise(F.substring(key, 22, 1 << 30).cast("string"))


def pack(df: DataFrame, *cols: str) -> DataFrame:
    """The frame with its text keys packed; keys of other types stay."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: packed(c) for c in cols if kinds[c] == "string"})


def unpack(df: DataFrame, *cols: str) -> DataFrame:
    """The frame with its packed keys as texts again."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: unpacked(c) for c in cols if kinds[c] == "binary"})


def audit_hash(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Rows whose stored key is not the one their business keys give."""
    return df.filter(~F.col(key).eqNullSafe(hash_key(*cols)))
