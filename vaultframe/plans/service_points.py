"""Service point to device, and site geometry."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultframe.functions.columns import not_blank
from vaultframe.functions.dates import as_of, closed_end
from vaultframe.functions.geometry import lcc_inverse, wkt_xy
from vaultframe.operators.joins import resolve
from vaultframe.operators.versions import current_version, first_per_key, newest
from vaultframe.plans.common import current, latest_first


def point_devices(
    relations: DataFrame,
    points: DataFrame,
    devices: DataFrame,
    site_links: DataFrame,
    hub_site: DataFrame,
    *,
    run_dt: date | str,
    excluded_org: str = "102",
    active: str = "active",
    audit: tuple[str, ...] = ("org_id",),
    ordered: bool = False,
) -> DataFrame:
    """Current device of every service point, one row per point and start day.

    The point's status counts before ranking: its newest active version is used
    even when a later one is not active.
    """
    rows = as_of(relations, run_dt, "extract_ts", inclusive=False).filter(F.col("org_id") != excluded_org)
    rows = first_per_key(rows, ["point_key", "eff_start"], latest_first())
    rows = rows.withColumns({"start_date": F.col("eff_start").cast("date"), "end_date": closed_end("eff_end", 0)})
    rows = first_per_key(rows, ["point_key", "start_date"], newest("end_date", "extract_ts", "seq"))
    spots = current_version(
        as_of(points, run_dt, "extract_ts", inclusive=False),
        ["salnk_key"],
        latest_first(),
        pre=F.lower("status") == active,
    ).select("salnk_key", "mdm_id")
    spots = spots.join(site_links, "salnk_key").select(F.col("key1").alias("site_key"), F.col("key2").alias("point_key"), "mdm_id")
    spots = resolve(spots.distinct(), hub_site, "site_key", "site_key", {"site_id": "site_id"})
    known = first_per_key(as_of(devices, run_dt, "extract_ts", inclusive=False), ["device_key"], latest_first())
    known = known.filter(not_blank("serial") & (F.lower("serial") != "null")).select("device_key", "device_id", "serial")
    out = rows.join(spots, "point_key").join(known, "device_key")
    out = out.select("site_id", "mdm_id", "serial", "start_date", "end_date", "device_id", *audit).distinct()
    return out.orderBy("site_id") if ordered else out


def site_geometry(
    points: DataFrame,
    geometries: DataFrame,
    links: DataFrame,
    hub_site: DataFrame,
    hub_substation: DataFrame,
    *,
    run_dt: date | str,
) -> DataFrame:
    """Newest location of every site with longitude and latitude."""
    order = newest("extract_ts", "last_update", "seq")
    spots = current(points, ["link_key"], run_dt, inclusive=False, order=order).select("link_key", "extract_ts", "seq")
    places = current(geometries, ["link_key"], run_dt, inclusive=False).select("link_key", "location")
    lon, lat = lcc_inverse(*wkt_xy("location"))
    rows = spots.join(places, "link_key", "left").join(links, "link_key")
    rows = resolve(rows, hub_site, "site_key", "site_key", {"site_id": "site_id"})
    rows = resolve(rows, hub_substation, "substation_key", "substation_key", {"substation_id": "substation_id"})
    rows = first_per_key(rows, ["site_id"], newest("extract_ts", "seq", "substation_id"))
    return rows.select(
        "site_id",
        "substation_id",
        F.col("extract_ts").alias("source_extract_dtm"),
        "location",
        lat.cast("decimal(21,15)").alias("latitude"),
        lon.cast("decimal(21,15)").alias("longitude"),
    )
