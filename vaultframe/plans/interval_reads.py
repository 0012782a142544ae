"""Interval-read feed: a whole partition day, or an hourly window."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultframe.functions.columns import code_in, like_any
from vaultframe.functions.dates import as_date, incremental_window, retain_days, scan_window
from vaultframe.operators.joins import ref_filter_join
from vaultframe.operators.timeline import interval_keys
from vaultframe.operators.versions import current_version, first_per_key, newest, not_deleted


def organisation(orgs: DataFrame, org_hub: DataFrame, name: str) -> DataFrame:
    """Ids of the organisation whose newest name is ``name``."""
    latest = current_version(orgs, ["org_key"], newest("extract_ts", "load_ts"), post=F.col("name") == name)
    return latest.select("org_key").join(org_hub, "org_key").select("org_id")


def feed_channels(params: DataFrame, name: str, patterns: tuple[str, ...]) -> DataFrame:
    """Channels with a live suffix of the wanted kind.

    The feed needs to know only that a channel has one, so the newest version per
    name and start need not be picked: some version wins wherever one exists.
    """
    rows = params.filter((F.col("name") == name) & not_deleted() & like_any("value", patterns))
    return rows.select("channel_key").distinct()


def interval_reads(
    reads: DataFrame,
    orgs: DataFrame,
    org_hub: DataFrame,
    params: DataFrame,
    hub_channel: DataFrame,
    *,
    run_dt: date | str | datetime,
    org_name: str,
    hours: int | None = None,
    param: str = "Data Stream Suffix",
    patterns: tuple[str, ...] = ("%B%", "%E%"),
    statuses: tuple[str, ...] = ("VAL", "EST"),
    retention_days: int = 761,
    ordered: bool = False,
) -> DataFrame:
    """Newest read per channel and interval end.

    ``hours=None`` takes the partition of the run day. With hours, the partitions
    around the run time are scanned and only what was extracted or loaded in the
    last hours is kept (0 keeps all of it). ``ordered`` sorts the whole feed,
    which a consumer of files seldom needs.
    """
    day = as_date(run_dt)
    if hours is None:
        rows = scan_window(reads, "extract_day", day)
    else:
        rows = scan_window(reads, "extract_day", day, before=1, after=1)
        rows = incremental_window(rows, run_dt, hours, "extract_ts", "load_ts")
    rows = rows.filter(code_in("status", statuses))
    rows = ref_filter_join(rows, organisation(orgs, org_hub, org_name), "org_id")
    rows = ref_filter_join(rows, feed_channels(params, param, patterns), "channel_key")
    rows = retain_days(interval_keys(rows, "interval_end", "interval_len"), "read_date", day, retention_days)
    rows = first_per_key(rows, ["channel_key", "interval_end"], newest("extract_ts", "load_ts"))
    rows = rows.join(hub_channel.select("channel_key", "channel_id"), "channel_key")
    feed = rows.select(
        "channel_id",
        "read_dt",
        "interval_seq_num",
        F.col("lp_value").cast("decimal(21,6)").alias("consumption"),
        "status",
        "change_method",
        F.col("interval_len").cast("int").alias("interval_len"),
    )
    return feed.orderBy("channel_id", "read_dt", "interval_seq_num") if ordered else feed
