"""Site register: status, meter, span and market role of every site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultframe.functions.columns import not_blank
from vaultframe.functions.dates import OPEN_END_TEXT
from vaultframe.operators.joins import resolve
from vaultframe.operators.timeline import span
from vaultframe.operators.versions import current_version, newest, not_deleted
from vaultframe.plans.common import current, distinct_by, latest_first, packed_keys


def meter_spans(
    holdings: DataFrame,
    equipment_links: DataFrame,
    device_groups: DataFrame,
    meter_groups: DataFrame,
    equipment: DataFrame,
    *,
    kind: str = "Z",
    filter_kind_first: bool = True,
) -> DataFrame:
    """Earliest start and latest end per installation and meter, over both meter classes.

    The kind of a group counts before ranking (an older row of the kind may win)
    or after it (the newest row must be of the kind).
    """
    by_start = newest("ab", "extract_ts", "seq")
    held = current(holdings, ["link_key"], order=by_start).select("link_key", "ab", "bis")
    held = held.join(equipment_links, "link_key").select(F.col("site_key").alias("install_key"), "equipment_key", "ab", "bis")
    # Folded before the joins: earliest and latest compose, pairs of periods need not arise.
    # Dealt by the key of the joins alone, which then need no shuffle of it.
    held = span(held.repartition("equipment_key"), ["install_key", "equipment_key"], "ab", "bis")

    def group(sat: DataFrame) -> DataFrame:
        is_kind = F.col("kombinat") == kind
        if filter_kind_first:
            return current(sat, ["group_key"], pre=is_kind, order=by_start)
        return current(sat, ["group_key"], post=is_kind, order=by_start)

    keys = ["install_key", "meter_num"]
    first = group(device_groups).select(F.col("logical_key").alias("equipment_key"), F.col("device_id").alias("meter_num"))
    first = held.join(distinct_by(first, "equipment_key"), "equipment_key").select(*keys, "ab", "bis")
    serials = current(equipment, ["meter_key"]).select("meter_key", F.col("device_id").alias("meter_num"))
    second = distinct_by(group(meter_groups).select(F.col("logical_key").alias("equipment_key"), "meter_key"), "meter_key")
    second = held.join(second.join(serials, "meter_key"), "equipment_key").select(*keys, "ab", "bis")
    return span(first.unionByName(second).repartition("install_key"), keys, "ab", "bis")


def site_register(
    ids: DataFrame,
    status: DataFrame,
    services: DataFrame,
    installs: DataFrame,
    holdings: DataFrame,
    device_groups: DataFrame,
    meter_groups: DataFrame,
    equipment: DataFrame,
    site_links: DataFrame,
    equipment_links: DataFrame,
    hub_site: DataFrame,
    *,
    role_prefix: str,
    statuses: tuple[str, ...] = ("A", "D"),
    service: str = "LNSP",
    filter_kind_first: bool = True,
) -> DataFrame:
    """All sites with what is known of them; everything but the site is optional."""
    ids, status, services, installs, holdings = packed_keys(ids, status, services, installs, holdings)
    device_groups, meter_groups, equipment = packed_keys(device_groups, meter_groups, equipment)
    site_links, equipment_links, hub_site = packed_keys(site_links, equipment_links, hub_site)
    sites = current(ids, ["salnk_key", "date_from"], pre=not_blank("checksum")).select("salnk_key")
    sites = distinct_by(sites.join(site_links, "salnk_key").select(F.col("key1").alias("site_key"), "key2"), "site_key")
    sites = resolve(sites, hub_site, "site_key", "site_key", {"site_id": "site_id"})
    state = current(
        status,
        ["site_key"],
        pre=not_blank("checksum"),
        order=newest("from_dt", "extract_ts", "seq"),
        post=F.trim("status").isin(*statuses) & (F.col("to_dt") == OPEN_END_TEXT),
    ).select("site_key", "status")
    role = current_version(
        services,
        ["service_link_key", "contract"],
        latest_first(),
        post=(F.col("service") == service)
        & F.col("service_id").like(role_prefix)
        & (F.col("service_end") == OPEN_END_TEXT)
        & not_deleted(),
    ).select(F.col("site_key").alias("key2"), F.col("service_id").alias("market_role_key")).distinct()
    installed = current(installs, ["salnk_key"], order=newest("date_from", "extract_ts", "seq")).select("salnk_key")
    installed = distinct_by(installed.join(site_links, "salnk_key").select(F.col("key1").alias("install_key"), "key2"), "key2")
    spans = meter_spans(
        holdings, equipment_links, device_groups, meter_groups, equipment, filter_kind_first=filter_kind_first
    )
    joined = (
        sites.join(state, "site_key", "left")
        .join(role, "key2", "left")
        .join(installed, "key2", "left")
        .join(spans, "install_key", "left")
    )
    return joined.select(
        "site_id",
        "status",
        F.coalesce(F.trim("meter_num"), F.lit("0")).alias("meter_num"),
        F.coalesce("ab", F.lit(OPEN_END_TEXT)).alias("meter_start"),
        F.col("bis").alias("meter_end"),
        "market_role_key",
    ).distinct()
