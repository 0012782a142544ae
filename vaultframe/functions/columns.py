"""Column rules: blanks, codes, decodes, patterns and lineage stamps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultframe.functions.dates import as_date


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def not_blank(col: Column | str) -> Column:
    return F.length(F.trim(_col(col))) > 0


def blank_to_null(col: Column | str) -> Column:
    return F.nullif(F.trim(_col(col)), F.lit(""))


def null_if_blank(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Trim the columns and turn empty text into null, in one projection."""
    return df.withColumns({name: blank_to_null(name) for name in cols})


def code_in(col: Column | str, values: Iterable[str], negate: bool = False) -> Column:
    """Membership of a trimmed, upper-cased code."""
    found = F.trim(F.upper(_col(col))).isin(*values)
    return ~found if negate else found


def like_any(col: Column | str, patterns: Iterable[str]) -> Column:
    """Case-folded LIKE against any of the upper-case patterns."""
    folded = F.upper(_col(col))
    return reduce(lambda a, b: a | b, [folded.like(p) for p in patterns])


def decode(col: Column | str, mapping: Mapping[str, object], default: object = None) -> Column:
    """Code to label, with a default for every other code."""
    chain = None
    for code, label in mapping.items():
        chain = (F if chain is None else chain).when(_col(col) == code, F.lit(label))
    return chain.otherwise(F.lit(default))


def fold_category(col: Column | str, groups: Mapping[str, Iterable[str]]) -> Column:
    """Several codes to one group name; a code outside every group gives null."""
    chain = None
    for name, codes in groups.items():
        chain = (F if chain is None else chain).when(_col(col).isin(*codes), F.lit(name))
    return chain


def insert_time(now_utc: datetime, offset_hours: int = 10) -> Column:
    """The local time of a run, as feeds carry it; the clock is an argument."""
    return F.lit((now_utc + timedelta(hours=offset_hours)).strftime("%Y-%m-%d %H:%M:%S"))


def stamp(df: DataFrame, run_dt: date | str, source: str, now_utc: datetime, offset_hours: int = 10) -> DataFrame:
    """Lineage columns; the clock is an argument, so a rerun gives the same rows."""
    return df.withColumns(
        {
            "record_source": F.lit(source),
            "run_date": F.lit(as_date(run_dt)),
            "row_insert_dtm": insert_time(now_utc, offset_hours),
        }
    )


def lookup(df: DataFrame, col: str, values: Iterable[object] | DataFrame) -> DataFrame:
    """Rows whose key is one of a few literals, or occurs in a frame of keys."""
    if isinstance(values, DataFrame):
        return df.join(values.select(col).distinct(), col, "left_semi")
    return df.filter(F.col(col).isin(*values))


def in_codes(df: DataFrame, col: str, codes: DataFrame, code_col: str) -> DataFrame:
    """Rows whose code is listed in a code table; codes match as stored."""
    wanted = codes.select(F.col(code_col).alias(col)).distinct()
    return df.join(wanted, col, "left_semi")
