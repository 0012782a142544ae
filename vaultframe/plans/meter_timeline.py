"""Meter timeline of every site."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultframe.functions.columns import blank_to_null, not_blank
from vaultframe.functions.dates import as_of, open_end, parse_day
from vaultframe.operators.joins import crowded_keys, key_sketch, lightened, may_meet, overlap_join, resolve
from vaultframe.operators.timeline import array_timeline, leading_gap, span
from vaultframe.operators.versions import eav_attribute, first_per_key, newest, not_deleted, oldest
from vaultframe.operators.windows import SLICE_ROWS
from vaultframe.plans.common import current, distinct_by, packed_keys
from vaultframe.session import stage

# Start given to a period whose start is missing, so that it can be compared.
FIRST_DAY = date(1800, 1, 1)


def _bounds(df: DataFrame, name: str) -> DataFrame:
    """Comparable days of an attribute period; the end is moved past its last day."""
    return df.withColumns(
        {
            f"{name}_day": F.coalesce(parse_day(f"{name}_from"), F.lit(FIRST_DAY)),
            f"{name}_past": F.date_add(F.coalesce(parse_day(f"{name}_to"), open_end()), 1),
        }
    )


def paired_attributes(first: DataFrame, second: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Periods of two attributes of a meter that have a day in common.

    A meter with only one of the attributes keeps its rows with the other null;
    a meter with both keeps the pairs that meet, and no others.
    """
    a, b = names
    pairs = overlap_join(
        _bounds(first, a), _bounds(second, b), ["meter_key"], (f"{a}_day", f"{a}_past"), (f"{b}_day", f"{b}_past")
    ).drop(f"{a}_day", f"{a}_past", f"{b}_day", f"{b}_past")
    only_first = first.join(second.select("meter_key"), "meter_key", "left_anti")
    only_second = second.join(first.select("meter_key"), "meter_key", "left_anti")
    return pairs.unionByName(only_first, allowMissingColumns=True).unionByName(only_second, allowMissingColumns=True)


def with_attributes(meters: DataFrame, attributes: DataFrame, first: str, second: str, names: tuple[str, str]) -> DataFrame:
    """Meters with the newest periods of two attributes that meet; a meter without any attribute is kept bare.

    ``first`` and ``second`` name the attributes in ``attributes``, ``names`` their columns. A meter with one of them
    keeps its periods with the other null; one whose attributes never meet has no row at all. The versions of meters
    with few of them are dealt by the meter alone, so that ranking and both joins need no further shuffle; meters with many
    are ranked by their whole key, and their periods are paired by the overlap join.
    """
    a, b = names
    keys = ["meter_key", "fname", "ab"]
    attributes = attributes.filter(F.col("fname").isin(first, second) & F.col("meter_key").isNotNull())

    def both(latest: DataFrame) -> tuple[DataFrame, DataFrame]:
        return eav_attribute(latest, ["meter_key"], first, a), eav_attribute(latest, ["meter_key"], second, b)

    def plainly(rows: DataFrame, versions: DataFrame) -> DataFrame:
        left, right = both(current(versions.repartition("meter_key"), keys))
        rows = rows.join(_bounds(left, a), "meter_key", "left").join(_bounds(right, b), "meter_key", "left")
        meet = (F.col(f"{b}_past") > F.col(f"{a}_day")) & (F.col(f"{b}_day") < F.col(f"{a}_past"))
        rows = rows.filter(F.col(f"{a}_past").isNull() | F.col(f"{b}_past").isNull() | meet)
        return rows.drop(f"{a}_day", f"{a}_past", f"{b}_day", f"{b}_past")

    sides = [attributes.filter(F.col("fname") == name) for name in (first, second)]
    crowded = crowded_keys(*sides, ["meter_key"], most_rows=SLICE_ROWS)
    if crowded is None:
        return plainly(meters, attributes)
    plain = plainly(*[df.join(crowded, "meter_key", "left_anti") for df in (meters, attributes)])
    latest = stage(current(attributes.join(crowded, "meter_key", "left_semi"), keys), "attributes")
    left, right = both(latest)
    some = left.select("meter_key").unionByName(right.select("meter_key")).distinct()
    rows = meters.join(crowded, "meter_key", "left_semi")
    busy = rows.join(paired_attributes(left, right, names), "meter_key")
    bare = rows.join(some, "meter_key", "left_anti")
    return plain.unionByName(busy).unionByName(bare, allowMissingColumns=True)


def meter_timeline(
    equipment: DataFrame,
    attributes: DataFrame,
    meter_groups: DataFrame,
    device_groups: DataFrame,
    holdings: DataFrame,
    installs: DataFrame,
    ids: DataFrame,
    site_links: DataFrame,
    equipment_links: DataFrame,
    hub_site: DataFrame,
    *,
    run_dt: date | str,
    kind: str = "Z",
    read_type: str = "READ_TYPE_CODE",
    install_type: str = "INSTALL_TYPE_CODE",
    holding_versions: str = "all",
) -> DataFrame:
    """Site, meter, types and period: installed meters, the gap before the first
    one, and the meters of the other class.

    ``holding_versions``: "all" lets every live version of a holding reach into its
    span; "newest" only the newest of each link and start.
    """
    equipment, attributes, meter_groups, device_groups = packed_keys(equipment, attributes, meter_groups, device_groups)
    holdings, installs, ids = packed_keys(holdings, installs, ids)
    site_links, equipment_links, hub_site = packed_keys(site_links, equipment_links, hub_site)
    start = ["date_from", "time_from"]
    external = current(ids, ["salnk_key", *start], run_dt, pre=not_blank("checksum"))
    external = external.select("salnk_key", F.col("date_from").alias("id_from"), F.col("date_to").alias("id_to"))
    external = external.join(site_links, "salnk_key").select(F.col("key1").alias("site_key"), F.col("key2").alias("internal_key"), "id_from", "id_to")
    external = resolve(distinct_by(external, "site_key"), hub_site, "site_key", "site_key", {"site_id": "site_id"})
    installed = current(installs, ["salnk_key", *start], run_dt).select("salnk_key").join(site_links, "salnk_key")
    installed = distinct_by(installed.select(F.col("key1").alias("install_key"), F.col("key2").alias("internal_key")), "internal_key")
    sites = stage(external.join(installed, "internal_key").drop("internal_key"), "sites")
    live_holdings = {
        "all": lambda: as_of(holdings, run_dt, "extract_ts").filter(not_deleted()),
        "newest": lambda: current(holdings, ["link_key", "ab"], run_dt),
    }[holding_versions]()
    links = may_meet(equipment_links, key_sketch(sites, "install_key"), "site_key")
    held = live_holdings.select("link_key", "ab", "bis").join(links, "link_key")
    held = held.select(F.col("site_key").alias("install_key"), F.col("equipment_key").alias("logical_key"), "ab", "bis")
    # Dealt by the key of the next join alone: folding and join share one shuffle.
    held = span(held.repartition("install_key"), ["install_key", "logical_key"], "ab", "bis")
    placed = stage(sites.join(held, "install_key").select("site_id", "id_from", "id_to", "logical_key", "ab", "bis"), "placed")

    # What no join below can need travels light, or not at all.
    at_places = key_sketch(placed, "logical_key")
    other = lightened(device_groups, at_places, "logical_key", ["device_id", "category", "bis"])
    other = current(other, ["group_key", "ab"], run_dt).filter(F.col("logical_key").isNotNull())
    other = other.select("logical_key", "device_id", "category", "ab", "bis")
    other = span(other.repartition("logical_key"), ["logical_key", "device_id", "category"], "ab", "bis")
    other = distinct_by(placed.select("site_id", "logical_key"), "logical_key").join(other, "logical_key")
    other = stage(span(other, ["site_id", "device_id", "category"], "ab", "bis"), "others")

    groups = lightened(meter_groups, at_places, "logical_key", ["meter_key"])
    groups = current(groups, ["group_key", "ab"], run_dt, pre=F.col("kombinat") == kind).filter(F.col("logical_key").isNotNull())
    spans = placed.join(distinct_by(groups.select("logical_key", "meter_key"), "logical_key"), "logical_key")
    spans = span(spans, ["meter_key", "site_id", "id_from", "id_to"], "ab", "bis")
    spans = stage(spans.withColumnsRenamed({"ab": "install_date", "bis": "removal_date"}), "spans")

    at_meters = key_sketch(spans, "meter_key")
    serials = current(lightened(equipment, at_meters, "meter_key", ["device_id"]), ["eq_link_key"], run_dt)
    serials = serials.filter(F.col("meter_key").isNotNull()).select("meter_key", F.col("device_id").alias("meter_num"))
    attributes = may_meet(attributes, at_meters, "meter_key")
    rows = with_attributes(serials.join(spans, "meter_key"), attributes, read_type, install_type, ("read", "typ"))
    rows = stage(rows.drop("meter_key"), "rows")
    lines = array_timeline(
        rows,
        ["site_id", "meter_num"],
        ["read_from", "typ_from", "install_date"],
        ["typ_to", "read_to", "removal_date"],
        "removal_date",
        ["read_from", "typ_from", "install_date", "id_from"],
    )
    lines = stage(lines, "timeline")

    def feed(df: DataFrame, meter: Column, typ: Column, read: Column, first: Column, last: Column) -> DataFrame:
        return df.select(
            "site_id",
            meter.alias("meter_num"),
            typ.alias("installation_typ"),
            read.alias("read_typ_cd"),
            first.alias("from_dt"),
            last.alias("to_dt"),
        )

    none = F.lit(None).cast("string")
    main = feed(
        lines, F.col("meter_num"), blank_to_null("typ"), blank_to_null("read"), parse_day("timeline_from"), parse_day("timeline_to")
    )
    gap = lines.select("site_id", parse_day("id_from").alias("opened"), parse_day("install_date").alias("first"))
    gap = leading_gap(gap, ["site_id"], "opened", "first")
    gap = feed(gap, F.lit("0"), none, none, F.col("from_dt"), F.col("to_dt"))
    other = feed(other, F.col("device_id"), none, none, parse_day("ab"), parse_day("bis"))
    # No distinct before: equal rows tie in every column, and the first of them is taken.
    every = main.unionByName(gap).unionByName(other)
    order = [*newest("to_dt"), *oldest("installation_typ", "read_typ_cd")]
    return first_per_key(every, ["site_id", "meter_num", "from_dt"], order)
