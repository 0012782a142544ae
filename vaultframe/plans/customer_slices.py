"""Customer time slices: who was the customer of a site, and how to reach them, when."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultframe.functions.columns import insert_time, not_blank
from vaultframe.functions.dates import as_of, floor_date, open_end, parse_day
from vaultframe.operators import windows
from vaultframe.operators.joins import overlap_join, resolve
from vaultframe.operators.timeline import rank_slices, time_slice, timeline
from vaultframe.operators.versions import (
    current_per_day,
    current_version,
    first_per_key,
    newest,
    not_deleted,
    top2_values,
    validity_from_versions,
)
from vaultframe.plans.common import current
from vaultframe.session import stage


def _days(df: DataFrame, start: str, end: str, out: tuple[str, str]) -> DataFrame:
    return df.withColumns({out[0]: parse_day(F.substring(start, 1, 8)), out[1]: parse_day(F.substring(end, 1, 8))})


def site_periods(
    ids: DataFrame, site_links: DataFrame, hub_site: DataFrame, run_dt: date | str, roles: tuple[str, str]
) -> DataFrame:
    """External id periods of every site: the spine. Only links between the two ``roles`` count."""
    rows = current(ids, ["salnk_key", "date_from", "time_from"], run_dt, pre=not_blank("checksum"))
    in_role = (F.col("role1") == roles[0]) & (F.col("role2") == roles[1])
    rows = rows.join(site_links.filter(in_role), "salnk_key").withColumnsRenamed({"key1": "site_key", "key2": "internal_key"})
    rows = resolve(rows, hub_site, "site_key", "site_key", {"site_id": "site_id"})
    return _days(rows, "date_from", "date_to", ("id_from", "id_to")).select(
        "site_id", "internal_key", "id_from", "id_to"
    ).distinct()


def service_contracts(services: DataFrame, spine: DataFrame, run_dt: date | str, service: str) -> DataFrame:
    """Newest version per site and contract, then one contract per site and end."""
    rows = current(services, ["site_key", "contract"], run_dt, pre=F.col("service") == service)
    rows = rows.withColumnRenamed("site_key", "internal_key").join(
        spine.select("internal_key", "site_id").distinct(), "internal_key"
    )
    rows = first_per_key(rows, ["site_id", "service_end"], newest("extract_ts", "service_start", "seq"))
    rows = rows.withColumn("contract_eff", F.col("extract_ts"))
    return _days(rows, "service_start", "service_end", ("contract_from", "contract_to")).select(
        "site_id", "service_id", "contract", "contract_eff", "contract_from", "contract_to"
    )


def site_partners(
    installs: DataFrame,
    accounts: DataFrame,
    partners: DataFrame,
    site_links: DataFrame,
    partner_links: DataFrame,
    spine: DataFrame,
    run_dt: date | str,
) -> DataFrame:
    """Undated way from site to business partner: installation, account, live link of account and partner."""
    installed = current(installs, ["salnk_key"], run_dt).select("salnk_key").join(site_links, "salnk_key")
    installed = installed.select(F.col("key1").alias("install_key"), F.col("key2").alias("internal_key")).distinct()
    account = current(accounts, ["install_key", "account_key"], run_dt).select("install_key", "account_key").distinct()
    partner = current(partners, ["link_key"], run_dt).select("link_key").join(partner_links, "link_key")
    partner = partner.select("account_key", "partner_key").distinct()
    sites = spine.select("site_id", "internal_key").distinct()
    return (
        sites.join(installed, "internal_key")
        .join(account, "install_key")
        .join(partner, "account_key")
        .select("site_id", "partner_key")
        .distinct()
    )


def partner_names(names: DataFrame, partner_links: DataFrame, run_dt: date | str) -> DataFrame:
    """Last name of each link and day, each valid to the day of the link's next one.

    Names hang on the links of accounts and partners. A partner with several accounts has a chain of
    names for each, and all of them are the partner's, by whichever account a site reaches it.
    """
    daily = current_per_day(as_of(names, run_dt, "extract_ts"), ["link_key"], "extract_ts", ["seq"])
    daily = daily.filter(not_deleted())
    periods = validity_from_versions(daily, ["link_key"], "extract_ts", ["seq"], daily=True)
    return periods.join(partner_links.select("link_key", "partner_key"), "link_key").select(
        "partner_key",
        "name_org1",
        "name_org2",
        "name_org3",
        "name_org4",
        "partner_type",
        F.col("valid_from").alias("name_from"),
        F.col("valid_to").alias("name_to"),
    )


def partner_addresses(addresses: DataFrame, run_dt: date | str, kind: str) -> DataFrame:
    """Address periods of one kind, newest version per link and end."""
    rows = current(
        addresses, ["partner_key", "address_key", "valid_to"], run_dt, pre=F.col("adr_kind") == kind
    ).withColumn("address_eff", F.col("extract_ts"))
    return _days(rows, "valid_from", "valid_to", ("address_from", "address_to")).select(
        "partner_key", "address_key", "adr_kind", "address_eff", "address_from", "address_to"
    )


def phone_history(phones: DataFrame, run_dt: date | str) -> DataFrame:
    """Every live phone of an address, valid from its extract day to the next one's; the last is open.

    The second number is the one that follows in order of preference, deleted or not: in ascending
    order of the same columns, the one before.
    """
    preferred = {"tel_number2": "tel_number"}
    rows = as_of(phones, run_dt, "extract_ts")
    rows = windows.previous_value(rows, ["address_key"], ["flag_default", "cons_number", "seq"], preferred)
    live = rows.filter(not_deleted()).withColumn("tel_from", F.col("extract_ts").cast("date"))
    live = windows.next_value(live, ["address_key"], ["extract_ts", "seq"], {"tel_to": "tel_from"})
    return live.select(
        "address_key",
        F.col("tel_number").alias("tel_number1"),
        "tel_number2",
        "person_number",
        F.col("date_from").alias("tel_date_from"),
        "cons_number",
        "tel_from",
        F.coalesce("tel_to", open_end()).alias("tel_to"),
    )


def address_phones(phones: DataFrame, run_dt: date | str) -> DataFrame:
    """Preferred and second phone of every address, valid from the day it was extracted."""
    order = newest("flag_default", "cons_number", "seq")
    pair = top2_values(
        as_of(phones, run_dt, "extract_ts"), ["address_key"], "tel_number", order, ("tel_number1", "tel_number2")
    ).filter(not_deleted())
    return pair.select(
        "address_key",
        "tel_number1",
        "tel_number2",
        "person_number",
        F.col("date_from").alias("tel_date_from"),
        "cons_number",
        F.col("extract_ts").cast("date").alias("tel_from"),
        open_end().alias("tel_to"),
    )


def customer_slices(
    ids: DataFrame,
    services: DataFrame,
    installs: DataFrame,
    accounts: DataFrame,
    partners: DataFrame,
    names: DataFrame,
    addresses: DataFrame,
    phones: DataFrame,
    site_links: DataFrame,
    partner_links: DataFrame,
    hub_site: DataFrame,
    *,
    run_dt: date | str,
    now_utc: datetime,
    roles: tuple[str, str] = ("EXT_UI", "INT_UI"),
    service: str = "FRMP",
    address_kind: str = "XXDEFAULT",
    min_end: date | str | None = None,
    floor: date | str | None = None,
    phone_rule: str = "history",
) -> DataFrame:
    """One row per site and slice, with the best-ranked customer data.

    ``phone_rule``: "history" chains all live phones of an address; "first" keeps
    the preferred one alone, open for ever.

    Boundaries are gathered attribute by attribute. Every attribute is matched
    against the slices alone; the dependent ones (address of the slice's partner,
    phone of that address) are then joined on the slice and the key they hang on.
    """
    numbered = {"history": phone_history, "first": address_phones}[phone_rule]
    spine = stage(site_periods(ids, site_links, hub_site, run_dt, roles), "spine")
    contracts = stage(service_contracts(services, spine, run_dt, service), "contracts")
    site_partner = site_partners(installs, accounts, partners, site_links, partner_links, spine, run_dt)
    name = stage(site_partner.join(partner_names(names, partner_links, run_dt), "partner_key").distinct(), "names")
    named = name.select("site_id", "partner_key").distinct()
    address = stage(named.join(partner_addresses(addresses, run_dt, address_kind), "partner_key"), "addresses")
    addressed = address.select("site_id", "partner_key", "address_key").distinct()
    phone = stage(addressed.join(numbered(phones, run_dt), "address_key"), "phones")

    parts = [
        (spine, ["id_from", "id_to"]),
        (contracts, ["contract_from", "contract_to"]),
        (name, ["name_from", "name_to"]),
        (address, ["address_from", "address_to"]),
        (phone, ["tel_from", "tel_to"]),
    ]
    cuts = stage(timeline(parts, ["site_id"], min_end), "slices")
    slice_key = ["site_id", "from_dt", "to_dt"]

    def attach(out: DataFrame, frame: DataFrame, period: tuple[str, str], depends_on: tuple[str, ...] = (), how: str = "left") -> DataFrame:
        matches = overlap_join(cuts, frame, ["site_id"], ("from_dt", "to_dt"), period, "inner")
        return out.join(matches, [*slice_key, *depends_on], how)

    # The best row of a slice has the latest name and, under it, the latest
    # address. Picking each as soon as it is attached keeps combinations small.
    rows = time_slice(
        cuts, ["site_id"], [(spine.select("site_id", "id_from", "id_to").distinct(), ("id_from", "id_to"), "inner")]
    ).select(*slice_key).distinct()
    rows = rank_slices(attach(rows, name, ("name_from", "name_to")), slice_key, newest("name_from"))
    rows = attach(rows, address, ("address_from", "address_to"), ("partner_key",))
    rows = rank_slices(rows, slice_key, newest("address_eff"))
    rows = attach(rows, phone, ("tel_from", "tel_to"), ("partner_key", "address_key"))
    best = attach(rows, contracts, ("contract_from", "contract_to"), how="inner")
    start = F.col("from_dt") if floor is None else floor_date("from_dt", floor)
    return best.select(
        "site_id",
        start.alias("start_dt"),
        F.col("to_dt").alias("end_dt"),
        "name_org1",
        "name_org2",
        "name_org3",
        "name_org4",
        "partner_type",
        F.col("name_from").alias("name_eff_day"),
        "tel_number1",
        "tel_number2",
        "person_number",
        "tel_date_from",
        "cons_number",
        F.col("tel_from").alias("tel_eff_day"),
        "service_id",
        "contract",
        "contract_eff",
        F.col("contract_from").alias("service_start"),
        F.col("contract_to").alias("service_end"),
        "partner_key",
        "address_key",
        "adr_kind",
        F.col("address_from").alias("address_valid_from"),
        F.col("address_to").alias("address_valid_to"),
        "address_eff",
        insert_time(now_utc).alias("row_insert_dtm"),
    ).distinct()
