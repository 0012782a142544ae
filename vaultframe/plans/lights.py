"""Street-light register."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultframe.functions.columns import decode, insert_time
from vaultframe.functions.geometry import lcc_inverse, wkt_xy
from vaultframe.operators.joins import resolve
from vaultframe.operators.versions import first_rank, newest


def street_lights(
    lights: DataFrame,
    geometries: DataFrame,
    specifications: DataFrame,
    spec_links: DataFrame,
    hub_equipment: DataFrame,
    *,
    billing_sites: Mapping[str, str],
    default_site: str,
    cost_share: Mapping[str, tuple[str, int]],
    now_utc: datetime,
    latest_location: bool = True,
) -> DataFrame:
    """Lights with specification, billing site decoded from the maker, location, and the time of the run.

    ``latest_location=False`` keeps every stored location, so a moved light shows
    up several times; that form feeds the duplicate check.
    """
    places = geometries
    if latest_location:
        places = first_rank(geometries, ["equipment_key"], newest("extract_ts"))
    lon, lat = lcc_inverse(*wkt_xy("location"))
    rows = spec_links.join(specifications, "spec_key").join(lights, "equipment_key")
    rows = rows.join(places.select("equipment_key", "location"), "equipment_key")
    rows = resolve(rows, hub_equipment, "equipment_key", "equipment_key", {"light_id": "light_id"})
    maker = F.trim("manufacturer")
    return rows.select(
        decode(maker, billing_sites, default_site).alias("site"),
        "light_id",
        decode(maker, {m: site for m, (site, _) in cost_share.items()}).alias("cost_share_site"),
        decode(maker, {m: percent for m, (_, percent) in cost_share.items()}).alias("cost_share_percent"),
        maker.alias("manufacturer"),
        "model",
        "lamp_type",
        F.col("watts_rating").cast("decimal(12,1)").alias("watts_rating"),
        F.col("market_watts_rating").cast("decimal(12,1)").alias("market_watts_rating"),
        "fitting",
        "control_gear",
        decode("real_spec", {"true": "Standard"}, "Non-Standard").alias("real_spec"),
        "connection_date",
        "lamp_changed",
        "billing_from",
        lat.cast("decimal(21,15)").alias("latitude"),
        lon.cast("decimal(21,15)").alias("longitude"),
        "owner_name",
        "billing_status",
        F.col("status").alias("lc_status"),
        insert_time(now_utc).alias("row_insert_dtm"),
    )
