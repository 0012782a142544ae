"""Device events around a day, alarm history, and feed status."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultframe.functions.columns import in_codes
from vaultframe.functions.dates import as_date, scan_window, to_zone
from vaultframe.operators.joins import resolve
from vaultframe.operators.versions import current_version, newest, not_deleted

LOCAL_ZONE = "Australia/Melbourne"


def device_events(
    events: DataFrame,
    links: DataFrame,
    hub_device: DataFrame,
    codes: DataFrame,
    *,
    run_dt: date | str,
    layout: Mapping[str, str],
    days: int = 4,
) -> DataFrame:
    """Live events with a listed code, up to ``days`` around the run day.

    ``layout`` maps feed column to source column.
    """
    rows = scan_window(events, "extract_day", run_dt, before=days, after=days).filter(not_deleted())
    rows = in_codes(rows, "event_id", codes, "code").join(links, "job_link_key")
    rows = resolve(rows, hub_device, "device_key", "device_key", {"device_id": "serial_number"})
    return rows.select("serial_number", *[F.col(source).alias(out) for out, source in layout.items()])


def month_window(month: date | str, zone: str = LOCAL_ZONE) -> tuple[datetime, datetime]:
    """UTC bounds of a local month widened by one day on both sides."""
    first = as_date(month).replace(day=1)
    following = (first + timedelta(days=32)).replace(day=1)

    def utc(day: date) -> datetime:
        local = datetime.combine(day, datetime.min.time(), ZoneInfo(zone))
        return local.astimezone(ZoneInfo("UTC")).replace(tzinfo=None)

    return utc(first) - timedelta(days=1), utc(following) + timedelta(days=1)


def _at(df: DataFrame, col: str, value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast(df.schema[col].dataType)


def _latest_alarms(rows: DataFrame, hub_alarm: DataFrame, excluded: str, zone: str, local: tuple[str, ...]) -> DataFrame:
    rows = rows.filter(F.col("plant_attribute") != excluded)
    rows = current_version(rows, ["alarm_key", "reference"], newest("extract_ts", "seq"))
    rows = resolve(rows, hub_alarm, "alarm_key", "alarm_key", {"alarm_id": "alarm_id"})
    return rows.withColumns({f"{c}_local": to_zone(c, zone) for c in local}).drop("seq")


def alarm_history(
    alarms: DataFrame,
    hub_alarm: DataFrame,
    start: datetime,
    end: datetime,
    *,
    excluded: str,
    zone: str = LOCAL_ZONE,
    local: tuple[str, ...] = ("alarm_ts", "ack_ts", "insert_ts"),
) -> DataFrame:
    """Newest version per alarm and reference among alarms inserted in the window."""
    inside = F.col("insert_ts").between(_at(alarms, "insert_ts", start), _at(alarms, "insert_ts", end))
    return _latest_alarms(alarms.filter(inside), hub_alarm, excluded, zone, local)


def alarm_updates(
    alarms: DataFrame,
    hub_alarm: DataFrame,
    loaded_after: datetime,
    inserted_until: datetime,
    *,
    excluded: str,
    zone: str = LOCAL_ZONE,
    local: tuple[str, ...] = ("alarm_ts", "ack_ts", "insert_ts"),
) -> DataFrame:
    """The same for alarms loaded after one time and inserted up to another."""
    late = F.col("load_ts") > _at(alarms, "load_ts", loaded_after)
    old = F.col("insert_ts") <= _at(alarms, "insert_ts", inserted_until)
    return _latest_alarms(alarms.filter(late & old), hub_alarm, excluded, zone, local)


def feed_status(feed: DataFrame, as_of_day: date | str, months: int = 2) -> DataFrame:
    """Rows per report time, insert time, update time and status of the last months."""
    since = F.add_months(F.lit(as_date(as_of_day)), -months).cast(feed.schema["insert_ts"].dataType)
    keys = ["report_ts", "insert_ts", "update_ts", "read_status"]
    counted = feed.filter(F.col("insert_ts") > since).groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    return counted.sort("report_ts", ascending=False)
