"""Communication faults: active meters without interval data for some days."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultframe.functions.columns import blank_to_null, fold_category, not_blank
from vaultframe.functions.dates import as_date, as_of, effective_on, recency_flag, scan_window
from vaultframe.functions.keys import hash_diff, unpack, unpacked
from vaultframe.operators.joins import drop_matching, join_mapped, not_exists_mapped
from vaultframe.operators.versions import current_version, first_per_key, newest, not_deleted
from vaultframe.plans.common import current, latest_first, packed_keys
from vaultframe.session import stage
from vaultframe.sources.sink import replace_run

# Module types per network, the status codes that retire
# equipment, and the type of a meter without a card.
NETWORKS = {"MESH": ("MICROAP", "MESH"), "WIMAX": ("3G", "WIMAX")}
RETIRED = ("I0076", "I0320")
NO_CARD = "MESH"


def network_of(col: str, networks: Mapping[str, tuple[str, ...]] = NETWORKS) -> Column:
    return fold_category(col, networks)


def by_text(df: DataFrame, *keys: str) -> list[Column]:
    """The largest key first, packed keys in the order of their texts."""
    kinds = dict(df.dtypes)
    return [(unpacked(c) if kinds[c] == "binary" else F.col(c)).desc_nulls_last() for c in keys]


def active_meters(
    status: DataFrame,
    ids: DataFrame,
    installs: DataFrame,
    holdings: DataFrame,
    site_links: DataFrame,
    equipment_links: DataFrame,
    *,
    run_dt: date | str,
    statuses: tuple[str, ...] = ("A",),
) -> DataFrame:
    """Distinct site, internal id and equipment in force on the run day."""
    status, ids, installs, holdings = packed_keys(status, ids, installs, holdings)
    site_links, equipment_links = packed_keys(site_links, equipment_links)
    state = current(
        status,
        ["site_key"],
        run_dt,
        period=("from_dt", "to_dt"),
        post=not_blank("checksum") & F.col("status").isin(*statuses),
    ).select("site_key")
    days = ("date_from", "date_to")
    external = current(ids, ["salnk_key"], run_dt, period=days, pre=not_blank("checksum")).select("salnk_key")
    external = external.join(site_links, "salnk_key").select(F.col("key1").alias("site_key"), F.col("key2").alias("internal_key"))
    installed = current(installs, ["salnk_key"], run_dt, period=days).select("salnk_key")
    installed = installed.join(site_links, "salnk_key").select(F.col("key1").alias("install_key"), F.col("key2").alias("internal_key"))
    held = current(holdings, ["link_key"], run_dt, period=("ab", "bis")).select("link_key")
    held = held.join(equipment_links, "link_key").select(F.col("site_key").alias("install_key"), "equipment_key")
    found = (
        state.join(external, "site_key")
        .join(installed, "internal_key")
        .join(held, "install_key")
        .select("site_key", "internal_key", "equipment_key")
        .distinct()
    )
    return unpack(found, "site_key", "internal_key", "equipment_key")


def comms_cards(
    order_status: DataFrame,
    equipment: DataFrame,
    card_links: DataFrame,
    groups: DataFrame,
    active: DataFrame,
    *,
    run_dt: date | str,
) -> DataFrame:
    """Module type per meter: that of its card, or the default without a card.

    ``equipment`` has equipment, device, module type, order number and creation
    day; ``card_links`` ties a meter's logical equipment (``key1``) to its card's
    (``key2``); ``groups`` ties equipment to logical equipment, kind ``Z`` for
    meters and ``S`` for cards.
    """
    equipment, card_links, groups, active = packed_keys(equipment, card_links, groups, active)
    retired = as_of(order_status, run_dt, "extract_ts", inclusive=False)
    retired = retired.filter(not_deleted() & (F.col("inact") != "X") & F.col("stat").isin(*RETIRED))
    in_use = drop_matching(current(equipment, ["eq_link_key"], run_dt), retired.select("order_no").distinct(), ["order_no"])
    in_use = stage(in_use.select("equipment_key", "device_key", "module_type", "created"), "equipment")
    usable = stage(active.select(F.col("equipment_key").alias("logical_key")).distinct(), "usable")
    linked = current(card_links, ["salnk_key"], run_dt, period=("ab", "bis"), deleted="before")
    linked = linked.select(F.col("key1").alias("logical_key"), F.col("key2").alias("card_logical_key"), "ab", "bis")

    def group(kind: str) -> DataFrame:
        rows = current(groups, ["group_key"], run_dt, period=("ab", "bis"), pre=F.col("kombinat") == kind)
        return rows.select("logical_key", F.col("equipment_key").alias("item_key")).join(usable, "logical_key", "left_semi")

    meters = group("Z").join(linked, "logical_key", "left").join(
        in_use.select(F.col("equipment_key").alias("item_key"), "device_key"), "item_key"
    )
    meters = first_per_key(meters, ["device_key"], [*newest("ab"), *by_text(meters, "item_key", "card_logical_key")])
    meters = stage(meters.withColumnRenamed("item_key", "meter_key"), "card_meters")

    cards = group("S").withColumnRenamed("logical_key", "card_logical_key").join(
        in_use.select(
            F.col("equipment_key").alias("item_key"),
            F.col("device_key").alias("card_device_key"),
            F.col("module_type").alias("comms_type"),
            "created",
        ),
        "item_key",
    )
    with_card = effective_on(meters, run_dt, "ab", "bis").join(cards, "card_logical_key")
    with_card = first_per_key(with_card, ["card_device_key"], [*newest("created"), *by_text(with_card, "meter_key")])
    columns = ["device_key", "meter_key", "comms_type"]
    without = meters.filter(F.col("card_logical_key").isNull()).withColumn("comms_type", F.lit(NO_CARD))
    return unpack(with_card.select(*columns).unionByName(without.select(*columns)), "device_key", "meter_key")


def device_intervals(
    direct: DataFrame,
    relayed: DataFrame,
    same_as: DataFrame,
    hub_device: DataFrame,
    *,
    run_dt: date | str,
    scan_days: int = 30,
    threshold_days: int = 5,
) -> DataFrame:
    """Newest interval per device and network with its freshness flag.

    The direct network reports under the device's own key; the relayed one under
    a key that a same-as link (``key1``, ``key3``) leads back from.
    """

    direct, relayed, same_as, hub_device = packed_keys(direct, relayed, same_as, hub_device)

    def newest_interval(sat: DataFrame) -> DataFrame:
        rows = scan_window(sat, "extract_day", run_dt, before=scan_days)
        return rows.groupBy("device_key").agg(F.max("interval_ts").alias("interval_ts"))

    known = hub_device.select("device_key").distinct()
    first = newest_interval(direct).select("device_key", "interval_ts", F.lit("WIMAX").alias("network"))
    pairs = same_as.select(F.col("key1").alias("own_key"), F.col("key3").alias("device_key")).distinct()
    second = newest_interval(relayed).join(known, "device_key", "left_semi").join(pairs, "device_key")
    second = second.select(F.col("own_key").alias("device_key"), "interval_ts", F.lit("MESH").alias("network"))
    second = second.join(known, "device_key", "left_semi")
    flag = recency_flag("interval_ts", run_dt, threshold_days).alias("fresh")
    found = first.unionByName(second).distinct()
    return unpack(found, "device_key").select("device_key", "interval_ts", "network", flag)


def read_types(
    attributes: DataFrame,
    streams: DataFrame,
    stream_links: DataFrame,
    device_equipment: DataFrame,
    hub_device: DataFrame,
    *,
    run_dt: date | str,
    attribute: str = "READ_TYPE_CODE",
    prefix: str = "RWD%",
) -> DataFrame:
    """Read-type code of equipment that has an active interval data stream."""
    attributes, streams, stream_links = packed_keys(attributes, streams, stream_links)
    device_equipment, hub_device = packed_keys(device_equipment, hub_device)
    codes = current(
        attributes,
        ["equipment_key"],
        run_dt,
        period=("ab", "bis"),
        pre=F.col("fname") == attribute,
        post=F.col("value").like(prefix),
    ).select("equipment_key", F.col("value").alias("read_type_code"))
    stream = as_of(streams, run_dt, "extract_ts", inclusive=False)
    order = [*newest("extract_ts"), F.col("suffix").asc_nulls_last(), *newest("seq")]
    stream = current_version(
        stream,
        ["link_key"],
        order,
        post=(blank_to_null("data_type") == "I") & (blank_to_null("data_status") == "A"),
    ).select("link_key")
    named = hub_device.filter(not_blank("device_id")).select("device_key")
    measured = (
        stream.join(stream_links, "link_key")
        .select("device_key")
        .distinct()
        .join(named, "device_key", "left_semi")
        .join(device_equipment.select("device_key", "equipment_key").distinct(), "device_key")
    )
    found = codes.join(measured.select("equipment_key").distinct(), "equipment_key", "left_semi").distinct()
    return unpack(found, "equipment_key")


def device_details(mesh: DataFrame, wimax: DataFrame) -> DataFrame:
    """Newest device attributes of both networks."""
    mesh, wimax = packed_keys(mesh, wimax)
    columns = ["device_key", "mac", "meter_firmware", "comms_firmware", "last_comms"]
    parts = [
        first_per_key(sat, ["device_key"], latest_first()).select(*columns, F.lit(name).alias("network"))
        for name, sat in (("MESH", mesh), ("WIMAX", wimax))
    ]
    return unpack(parts[0].unionByName(parts[1]).distinct(), "device_key")


def comms_faults(
    cards: DataFrame, codes: DataFrame, details: DataFrame, intervals: DataFrame, hub_device: DataFrame, *, run_dt: date | str
) -> DataFrame:
    """Meters whose network has no fresh interval, with the last stale one.

    A module type outside every network folds to null and never finds a fresh
    interval, so such a meter is always reported.
    """
    cards, codes, details, intervals, hub_device = packed_keys(cards, codes, details, intervals, hub_device)
    meters = cards.join(codes.withColumnRenamed("equipment_key", "meter_key"), "meter_key")
    meters = first_per_key(meters, ["device_key"], [*newest("read_type_code"), *by_text(meters, "meter_key")])
    meters = meters.join(hub_device.select("device_key", F.col("device_id").alias("serial")), "device_key")
    network = network_of("comms_type")
    meters = join_mapped(meters, details, ["device_key"], network, "network").distinct()
    fresh = intervals.filter("fresh = 'Y'")
    stale = intervals.filter("fresh = 'N'").select("device_key", "network", F.col("interval_ts").cast("date").alias("last_interval"))
    silent = not_exists_mapped(meters, fresh, ["device_key"], network, "network")
    silent = join_mapped(silent, stale, ["device_key"], network, "network")
    hashed = ["serial", "mac", "meter_firmware", "read_type_code", "comms_type", "comms_firmware", "last_comms", "last_interval"]
    return unpack(silent.select("device_key", *hashed).distinct(), "device_key").select(
        "device_key",
        F.lit("OUTBOUND_COMMS_FAULT").alias("record_source"),
        hash_diff(*hashed).alias("hash_diff"),
        *hashed,
        F.lit(as_date(run_dt)).alias("run_date"),
    )


def load_comms_faults(faults: DataFrame, path: str, run_dt: date | str, now_local: datetime) -> None:
    """Stamp the report time and replace the run day's rows."""
    stamped = faults.withColumn("report_time", F.lit(now_local.strftime("%Y-%m-%d %H:%M:%S")))
    replace_run(stamped, path, "run_date", run_dt)
