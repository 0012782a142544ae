"""Meter-channel timeline of every site."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultframe.functions.columns import code_in
from vaultframe.functions.dates import closed_end
from vaultframe.operators.joins import overlap_join, resolve
from vaultframe.operators.timeline import dedup_slices, timeline
from vaultframe.operators.versions import first_per_key, newest, oldest
from vaultframe.plans.common import current, packed_keys
from vaultframe.session import stage


def _period(df: DataFrame, name: str) -> DataFrame:
    """Start day, end day as boundary (one day earlier) and as match limit."""
    return df.withColumns(
        {
            f"{name}_from": F.col("eff_start").cast("date"),
            f"{name}_edge": closed_end("eff_end", 1),
            f"{name}_to": closed_end("eff_end", 0),
        }
    ).drop("eff_start", "eff_end")


def meter_channels(
    points: DataFrame,
    point_devices: DataFrame,
    devices: DataFrame,
    channels: DataFrame,
    device_channels: DataFrame,
    channel_params: DataFrame,
    site_links: DataFrame,
    hub_site: DataFrame,
    hub_channel: DataFrame,
    *,
    run_dt: date | str,
    param: str = "DATA STREAM SUFFIX",
    channel_type: str = "Interval Data",
    by_version_no: bool = True,
    per_slice: bool = False,
) -> DataFrame:
    """One channel per site, meter and suffix, optionally per slice as well.

    Three dated relations make the timeline: service point to device, device to
    channel, and the channel's suffix parameter. Their boundaries count when they
    lie on a complete way from the site to a suffix, virtual channels included;
    only real channels are then attached to the slices.
    """
    points, point_devices, devices, channels = packed_keys(points, point_devices, devices, channels)
    device_channels, channel_params = packed_keys(device_channels, channel_params)
    site_links, hub_site, hub_channel = packed_keys(site_links, hub_site, hub_channel)
    spots = current(points, ["salnk_key"], run_dt).select("salnk_key").join(site_links, "salnk_key")
    spots = spots.select(F.col("key1").alias("site_key"), F.col("key2").alias("point_key")).distinct()
    spots = resolve(spots, hub_site, "site_key", "site_key", {"site_id": "site_id"}).drop("site_key")
    fitted = current(point_devices, ["point_key", "device_key", "eff_start"], run_dt)
    fitted = _period(fitted.select("point_key", "device_key", "eff_start", "eff_end"), "fit")
    serials = first_per_key(devices, ["device_key"], newest("extract_ts", "seq")).select("device_key", "meter_num")
    wired = current(device_channels, ["device_key", "channel_key", "eff_start"], run_dt)
    wired = _period(wired.select("device_key", "channel_key", "eff_start", "eff_end"), "wire")
    listed = current(channels, ["point_key", "channel_key"], run_dt, pre=F.col("channel_type") == channel_type)
    listed = listed.select("point_key", "channel_key", "is_virtual")
    named = F.upper(F.trim("name")) == param
    if by_version_no:
        suffix = current(channel_params, ["channel_key", "name", "eff_start"], run_dt, pre=named, order=newest("rec_version"))
    else:
        suffix = current(channel_params, ["channel_key", "param_id", "name"], run_dt, pre=named)
    suffix = _period(suffix.select("channel_key", F.col("value").alias("suffix"), "eff_start", "eff_end"), "sfx")
    fitted, wired, suffix = stage(fitted, "fitted"), stage(wired, "wired"), stage(suffix, "suffix")

    way = (
        spots.join(fitted.select("point_key", "device_key").distinct(), "point_key")
        .join(serials, "device_key")
        .join(wired.select("device_key", "channel_key").distinct(), "device_key")
        .join(listed, ["point_key", "channel_key"])
        .join(suffix.select("channel_key").distinct(), "channel_key")
    )
    way = stage(way, "ways")
    fit = way.select("site_id", "point_key", "device_key").distinct().join(fitted, ["point_key", "device_key"])
    wire = way.select("site_id", "device_key", "channel_key").distinct().join(wired, ["device_key", "channel_key"])
    sfx = way.select("site_id", "channel_key").distinct().join(suffix, "channel_key")
    parts = [(fit, ["fit_from", "fit_edge"]), (wire, ["wire_from", "wire_edge"]), (sfx, ["sfx_from", "sfx_edge"])]
    cuts = stage(timeline(parts, ["site_id"]), "slices")

    key = ["site_id", "from_dt", "to_dt"]

    def match(frame: DataFrame, name: str, columns: list[str]) -> DataFrame:
        period = (f"{name}_from", f"{name}_to")
        rows = overlap_join(cuts, frame, ["site_id"], ("from_dt", "to_dt"), period, "inner")
        return rows.select(*key, *columns).distinct()

    real = way.filter(code_in("is_virtual", ["N"]))
    ways = real.select("site_id", "point_key", "device_key", "channel_key", "meter_num", "is_virtual").distinct()
    rows = (
        match(fit, "fit", ["point_key", "device_key"])
        .join(ways, ["site_id", "point_key", "device_key"])
        .join(match(wire, "wire", ["device_key", "channel_key"]), [*key, "device_key", "channel_key"])
        .join(match(sfx, "sfx", ["channel_key", "suffix"]), [*key, "channel_key"])
    )
    rows = resolve(rows, hub_channel, "channel_key", "channel_key", {"channel_id": "channel_id"})
    rows = rows.select("site_id", "meter_num", "suffix", "channel_id", "is_virtual", "from_dt", "to_dt").distinct()
    once = ["site_id", "meter_num", "suffix"] + (["from_dt"] if per_slice else [])
    return dedup_slices(rows, once, oldest("channel_id", "from_dt", "is_virtual"))
