"""Site address, and the newest premise of every site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultframe.functions.columns import null_if_blank
from vaultframe.operators.joins import resolve
from vaultframe.operators.versions import current_version, newest
from vaultframe.plans.common import current

ADDRESS_PARTS = ["building", "lot_num", "house_num", "street", "street_type", "suburb", "state", "post_cd"]
PREMISE_PARTS = ["location_desc", "unit_num", "unit_typ", "street_suffix"]


def premises(premise_sat: DataFrame, premise_links: DataFrame, site_links: DataFrame, hub_site: DataFrame, role: str = "EXT_UI") -> DataFrame:
    """Premise rows with the external site reached over three same-as hops.

    Premise -> installation -> internal id -> external id. Each hop is distinct,
    so parallel links do not multiply.
    """
    rows = current(premise_sat, ["premise_link_key"]).join(premise_links, "premise_link_key")
    hop1 = site_links.select(F.col("key2").alias("premise_key"), F.col("key1").alias("install_key")).distinct()
    hop2 = site_links.select(F.col("key1").alias("install_key"), F.col("key2").alias("internal_key")).distinct()
    hop3 = site_links.filter(F.col("role1") == role)
    hop3 = hop3.select(F.col("key2").alias("internal_key"), F.col("key1").alias("site_key")).distinct()
    reach = hop1.join(hop2, "install_key").join(hop3, "internal_key").select("premise_key", "site_key").distinct()
    return resolve(rows.join(reach, "premise_key"), hub_site, "site_key", "site_key", {"site_id": "site_id"})


def site_address(
    addresses: DataFrame,
    locations: DataFrame,
    places: DataFrame,
    premise_sat: DataFrame,
    location_links: DataFrame,
    premise_links: DataFrame,
    site_links: DataFrame,
    hub_site: DataFrame,
    *,
    role: str = "EXT_UI",
) -> DataFrame:
    """Distinct site and address parts, blanks as null."""
    address = current(addresses, ["address_key"]).select("address_key", *ADDRESS_PARTS)
    located = current(locations, ["location_link_key", "line_no"]).select("location_link_key", "line_no")
    located = located.join(location_links, "location_link_key").select("address_key", "place_key", "line_no").distinct()
    placed = current(places, ["place_key"]).select("place_key", "line_no", "house_key")
    found = premises(premise_sat, premise_links, site_links, hub_site, role).select("house_key", "site_id", *PREMISE_PARTS)
    joined = address.join(located, "address_key").join(placed, ["place_key", "line_no"]).join(found.distinct(), "house_key")
    parts = [*ADDRESS_PARTS, *PREMISE_PARTS]
    return null_if_blank(joined.select("site_id", *parts), parts).distinct()


def latest_premise(premise_sat: DataFrame, premise_links: DataFrame, site_links: DataFrame, hub_site: DataFrame, role: str = "EXT_UI") -> DataFrame:
    """The newest premise of every site."""
    rows = premises(premise_sat, premise_links, site_links, hub_site, role)
    return current_version(rows, ["site_id"], newest("extract_ts", "seq")).select("site_id", *PREMISE_PARTS)
