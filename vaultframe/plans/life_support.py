"""Life-support register: flagged sites with their open meters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultframe.functions.columns import not_blank
from vaultframe.functions.dates import open_only
from vaultframe.operators.joins import resolve
from vaultframe.operators.versions import current_version, live
from vaultframe.plans.common import current, latest_first


def life_support(
    flags: DataFrame,
    installs: DataFrame,
    ids: DataFrame,
    status: DataFrame,
    holdings: DataFrame,
    meter_groups: DataFrame,
    equipment: DataFrame,
    site_links: DataFrame,
    equipment_links: DataFrame,
    hub_site: DataFrame,
    *,
    flag: str = "LS",
    status_rule: str = "after_in",
    statuses: tuple[str, ...] = ("A", "D", "G"),
    excluded: tuple[str, ...] = ("X",),
    kind: str = "Z",
) -> DataFrame:
    """Distinct site, flag, status and meter.

    ``status_rule`` says where the status counts: ``before_in`` and ``after_in``
    require one of ``statuses`` before or after picking the newest version,
    ``after_not`` refuses ``excluded`` after it. Every other table contributes
    all versions that are not deleted; each is made distinct before it is joined,
    because the result is distinct anyway.
    """
    flagged = current(flags, ["salnk_key"], post=F.trim("flag") == flag).select("salnk_key", "flag")
    flagged = flagged.join(site_links, "salnk_key").select(F.col("key1").alias("install_key"), "flag").distinct()
    installed = live(installs, [], [], "all").select("salnk_key").distinct().join(site_links, "salnk_key")
    installed = installed.select(F.col("key1").alias("install_key"), "key2").distinct()
    external = live(ids, [], [], "all").filter(not_blank("checksum")).select("salnk_key").distinct()
    external = external.join(site_links, "salnk_key").select(F.col("key1").alias("site_key"), "key2").distinct()
    external = resolve(external, hub_site, "site_key", "site_key", {"site_id": "site_id"})

    open_status = open_only(status, "to_dt").filter(not_blank("checksum"))
    listed = F.trim("status").isin(*statuses)
    rules = {
        "before_in": {"pre": listed},
        "after_in": {"post": listed},
        "after_not": {"post": ~F.trim("status").isin(*excluded)},
    }
    state = current_version(open_status, ["site_key"], latest_first(), **rules[status_rule]).select("site_key", "status")

    held = live(open_only(holdings, "bis"), [], [], "all").select("link_key").distinct()
    held = held.join(equipment_links, "link_key").select(F.col("site_key").alias("install_key"), "equipment_key").distinct()
    meters = live(open_only(meter_groups, "bis"), [], [], "all").filter(F.col("kombinat") == kind)
    meters = meters.select(F.col("logical_key").alias("equipment_key"), "meter_key").distinct()
    serials = live(equipment, [], [], "all").select("meter_key", F.trim("device_id").alias("meter_num")).distinct()
    return (
        flagged.join(installed, "install_key")
        .join(external, "key2")
        .join(state, "site_key")
        .join(held, "install_key")
        .join(meters, "equipment_key")
        .join(serials, "meter_key")
        .select("site_id", "flag", "status", "meter_num")
        .distinct()
    )
