"""Register-suffix periods per site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultframe.functions.columns import like_any, not_blank
from vaultframe.operators.joins import resolve
from vaultframe.operators.versions import first_per_key
from vaultframe.plans.common import current, distinct_by, latest_first, packed_keys


def site_equipment(ids: DataFrame, installs: DataFrame, holdings: DataFrame, site_links: DataFrame, equipment_links: DataFrame, hub_site: DataFrame) -> DataFrame:
    """Site id and equipment key: external id, installation, held equipment."""
    external = current(ids, ["salnk_key", "date_from"], pre=not_blank("checksum")).select("salnk_key")
    external = distinct_by(external.join(site_links, "salnk_key").select(F.col("key1").alias("site_key"), "key2"), "site_key")
    external = resolve(external, hub_site, "site_key", "site_key", {"site_id": "site_id"})
    installed = current(installs, ["salnk_key", "date_from"]).select("salnk_key")
    installed = distinct_by(installed.join(site_links, "salnk_key").select(F.col("key1").alias("install_key"), "key2"), "key2")
    held = current(holdings, ["link_key", "ab"]).select("link_key").join(equipment_links, "link_key")
    held = distinct_by(held.select(F.col("site_key").alias("install_key"), "equipment_key"), "install_key")
    return distinct_by(external.join(installed, "key2").join(held, "install_key").select("site_id", "equipment_key"), "equipment_key")


def suffix_periods(
    ids: DataFrame,
    installs: DataFrame,
    holdings: DataFrame,
    registers: DataFrame,
    site_links: DataFrame,
    equipment_links: DataFrame,
    register_links: DataFrame,
    hub_site: DataFrame,
    *,
    prefixes: tuple[str, ...] = ("E%", "B%"),
    kind: str = "C",
    running: bool = False,
) -> DataFrame:
    """Distinct suffix periods of every site.

    The plain form takes the newest version of each register. The running form
    ranks per register period, drops empty periods, and stretches each period to
    the earliest start of equal ends and the latest end of equal starts.
    """
    ids, installs, holdings, registers, site_links, equipment_links, register_links, hub_site = packed_keys(
        ids, installs, holdings, registers, site_links, equipment_links, register_links, hub_site
    )
    sites = site_equipment(ids, installs, holdings, site_links, equipment_links, hub_site)
    wanted: Column = like_any("suffix", prefixes) & (F.col("kind") == kind)
    keys = ["reg_link_key", "register_no"] + (["ab"] if running else [])
    found = first_per_key(registers.filter(wanted), keys, latest_first())
    if running:
        found = found.filter("ab < bis")
    found = found.select("reg_link_key", "suffix", "ab", "bis").join(register_links, "reg_link_key")
    found = distinct_by(found.select("equipment_key", "suffix", "ab", "bis"), "equipment_key")
    periods = sites.join(found, "equipment_key").select("site_id", "suffix", "ab", "bis").distinct()
    if not running:
        return periods.withColumnsRenamed({"ab": "from_dt", "bis": "to_dt"})
    # Distinct first: a group of equal ends has one row per start day at most.
    by_end = Window.partitionBy("site_id", "suffix", "bis").orderBy("ab")
    by_start = Window.partitionBy("site_id", "suffix", "ab").orderBy("ab")
    return periods.select(
        "site_id",
        "suffix",
        F.min("ab").over(by_end).alias("from_dt"),
        F.max("bis").over(by_start).alias("to_dt"),
    ).distinct()
