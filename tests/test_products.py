from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from vaultframe.adapters import Tables
from vaultframe.checks.meters import timeline_of
from vaultframe.checks.standins import AmendedVault, Vault
from vaultframe.plans import comms_fault, components, events, suffix
from vaultframe.plans.customer_slices import partner_names, site_partners
from vaultframe.plans.life_support import life_support
from vaultframe.plans.service_points import point_devices

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


def suffix_tables(spark, install_change: str):
    common = "extract_ts TIMESTAMP_NTZ, seq INT, change_type STRING"
    make = spark.createDataFrame
    return {
        "ids": make([("t", "2020", "C", T0, 1, "A"), ("t2", "2020", " ", T0, 1, "A")], f"salnk_key STRING, date_from STRING, checksum STRING, {common}"),
        "installs": make([("n", "2020", T0, 1, "A"), ("n", "2020", T1, 2, install_change)], f"salnk_key STRING, date_from STRING, {common}"),
        "holdings": make([("l", "20200101", T0, 1, "A")], f"link_key STRING, ab STRING, {common}"),
        "registers": make(
            [
                ("g", 1, "E1", "C", "20200101", "20210101", T0, 1),
                ("g", 1, "E1", "C", "20210101", "99991231", T1, 2),
                ("g", 2, "e2", "C", "20200101", "20200101", T0, 1),
                ("g", 3, "Q1", "C", "20200101", "99991231", T0, 1),
                ("g", 4, "B1", "P", "20200101", "99991231", T0, 1),
            ],
            "reg_link_key STRING, register_no INT, suffix STRING, kind STRING, ab STRING, bis STRING, extract_ts TIMESTAMP_NTZ, seq INT",
        ),
        "site_links": make([("t", "E", "I"), ("n", "A", "I"), ("t2", "E2", "I")], "salnk_key STRING, key1 STRING, key2 STRING"),
        "equipment_links": make([("l", "A", "Q")], "link_key STRING, site_key STRING, equipment_key STRING"),
        "register_links": make([("g", "Q")], "reg_link_key STRING, equipment_key STRING"),
        "hub_site": make([("E", "site 1"), ("E2", "site 2")], "site_key STRING, site_id STRING"),
    }


def test_suffix_periods(spark, rows):
    tables = suffix_tables(spark, "U")
    plain = suffix.suffix_periods(**tables)
    assert rows(plain) == [("site 1", "E1", "20210101", "99991231"), ("site 1", "e2", "20200101", "20200101")]
    running = suffix.suffix_periods(**tables, running=True)
    assert rows(running) == [("site 1", "E1", "20200101", "20210101"), ("site 1", "E1", "20210101", "99991231")]


def test_a_deleted_installation_removes_the_site(spark):
    assert suffix.suffix_periods(**suffix_tables(spark, "D")).count() == 0


def test_life_support_status_rules_differ(spark, rows):
    make = spark.createDataFrame
    common = "extract_ts TIMESTAMP_NTZ, seq INT, change_type STRING"
    far = "99991231"
    tables = dict(
        flags=make([("n", "LS ", T0, 1, "A")], f"salnk_key STRING, flag STRING, {common}"),
        installs=make([("n", T0, 1, "A")], f"salnk_key STRING, {common}"),
        ids=make([("t", "C", T0, 1, "A")], f"salnk_key STRING, checksum STRING, {common}"),
        status=make([("E", far, "A", "C", T0, 1, "A"), ("E", far, "X", "C", T1, 2, "U")], f"site_key STRING, to_dt STRING, status STRING, checksum STRING, {common}"),
        holdings=make([("l", far, T0, 1, "A"), ("l", far, T1, 2, "A")], f"link_key STRING, bis STRING, {common}"),
        meter_groups=make([("Z", far, "Q", "M", T0, 1, "A")], f"kombinat STRING, bis STRING, logical_key STRING, meter_key STRING, {common}"),
        equipment=make([("M", " 77 ", T0, 1, "A")], f"meter_key STRING, device_id STRING, {common}"),
        site_links=make([("t", "E", "I"), ("n", "A", "I")], "salnk_key STRING, key1 STRING, key2 STRING"),
        equipment_links=make([("l", "A", "Q")], "link_key STRING, site_key STRING, equipment_key STRING"),
        hub_site=make([("E", "site 1")], "site_key STRING, site_id STRING"),
    )
    assert rows(life_support(**tables, status_rule="before_in")) == [("site 1", "LS ", "A", "77")]
    assert life_support(**tables, status_rule="after_in").count() == 0
    assert life_support(**tables, status_rule="after_not").count() == 0


def test_faults_report_stale_and_unknown_modules(spark, rows):
    make = spark.createDataFrame
    cards = make([("d1", "m1", "3G"), ("d2", "m2", "MESH"), ("d3", "m3", "PLC")], "device_key STRING, meter_key STRING, comms_type STRING")
    codes = make([("m1", "RWD1"), ("m2", "RWD1"), ("m3", "RWD2")], "equipment_key STRING, read_type_code STRING")
    details = make([("d1", "mac1", "f", "c", "t", "WIMAX")], "device_key STRING, mac STRING, meter_firmware STRING, comms_firmware STRING, last_comms STRING, network STRING")
    seen = make(
        [("d1", T0, "WIMAX", "N"), ("d2", T2, "MESH", "Y"), ("d3", T2, "MESH", "Y")],
        "device_key STRING, interval_ts TIMESTAMP_NTZ, network STRING, fresh STRING",
    )
    hub = make([("d1", "S1"), ("d2", "S2"), ("d3", "S3")], "device_key STRING, device_id STRING")
    out = comms_fault.comms_faults(cards, codes, details, seen, hub, run_dt="2024-01-03")
    assert rows(out, "device_key", "mac", "last_interval") == [("d1", "mac1", date(2024, 1, 1)), ("d3", None, None)]
    expected = out.filter("device_key = 'd1'").select(
        F.col("hash_diff") == F.sha1(F.lit("S1:mac1:f:RWD1:3G:c:t:2024-01-01"))
    )
    assert expected.first()[0]


def test_point_status_counts_before_ranking(spark, rows):
    make = spark.createDataFrame
    relations = make(
        [
            ("p", "d", "101", T0, None, T0, 1),
            ("p", "d", "101", datetime(2024, 1, 1, 5), T1, T0, 2),
            ("p", "x", "102", T1, None, T1, 3),
        ],
        "point_key STRING, device_key STRING, org_id STRING, eff_start TIMESTAMP_NTZ, eff_end TIMESTAMP_NTZ, extract_ts TIMESTAMP_NTZ, seq INT",
    )
    points = make([("s", "M", "ACTIVE", T0, 1), ("s", "M", "closed", T1, 2)], "salnk_key STRING, mdm_id STRING, status STRING, extract_ts TIMESTAMP_NTZ, seq INT")
    devices = make([("d", "D", "SN", T0, 1), ("x", "X", "null", T0, 1)], "device_key STRING, device_id STRING, serial STRING, extract_ts TIMESTAMP_NTZ, seq INT")
    links = make([("s", "E", "p")], "salnk_key STRING, key1 STRING, key2 STRING")
    hub = make([("E", "site")], "site_key STRING, site_id STRING")
    out = point_devices(relations, points, devices, links, hub, run_dt="2024-01-05")
    assert rows(out) == [("site", "M", "SN", date(2024, 1, 1), date(9999, 12, 31), "D", "101")]


def test_blank_typed_components_still_serve_as_parents(spark, rows):
    make = spark.createDataFrame
    sat = make(
        [
            ("k1", "/a", "a", "1", None, None, "U", T0, 1),
            ("k2", "/b", "b", "2", 1, None, "U", T0, 1),
            ("k3", "/c", "c", "9", 1, 2, "U", T0, 1),
            ("k4", "/d", "d", "2", 1, None, "D", T0, 1),
        ],
        """component_key STRING, pathname STRING, alias STRING, component_class STRING, parent_id INT, clone_id INT,
        change_type STRING, extract_ts TIMESTAMP_NTZ, seq INT""",
    )
    hub = make([("k1", 1), ("k2", 2), ("k3", 3), ("k4", 4)], "component_key STRING, component_id INT")
    classes = make([("1", " ", "Blank", "U"), ("2", "", "Switch", "U")], "class_index STRING, abbreviation STRING, class_name STRING, change_type STRING")
    out = components.component_register(sat, hub, classes)
    assert rows(out, "component_id", "asset_type", "parent_pathname", "clone_pathname") == [
        (2, "Switch", "/a", None),
        (3, None, "/a", "/b"),
    ]


def test_month_window_is_a_local_month_widened_by_a_day():
    assert events.month_window("2024-07-15") == (datetime(2024, 6, 29, 14), datetime(2024, 8, 1, 14))
    assert events.month_window("2024-01-01") == (datetime(2023, 12, 30, 13), datetime(2024, 2, 1, 13))


def test_timeline_of_amended_versions_depends_on_each_choice_of_version(spark):
    """Taking the first version of one satellite, or each key's newest holding only, changes rows."""
    t = Tables(spark, "/root/testdata/sf0.001")

    def rows(**first):
        v = AmendedVault(t)
        for name in first:
            setattr(v, name, getattr(Vault(t), name))
        return {tuple(r) for r in timeline_of(v).collect()}

    every = rows()
    for name in ("holdings", "fitted", "fitted_groups"):
        assert rows(**{name: True}) != every
    assert {tuple(r) for r in timeline_of(AmendedVault(t), holding_versions="newest").collect()} != every


PARTNER_LINKS = [("L1", "K1", "B"), ("L2", "K2", "B"), ("L3", "K3", "C")]
LINK_SCHEMA = "link_key STRING, account_key STRING, partner_key STRING"


def test_names_are_chained_by_link_and_belong_to_the_partner(spark):
    org = "name_org1 STRING, name_org2 STRING, name_org3 STRING, name_org4 STRING, partner_type STRING"
    days = [datetime(2024, 1, d, h) for d, h in ((1, 8), (1, 9), (2, 8), (3, 8), (4, 8))]
    versions = [("L1", 0, "a", "U"), ("L1", 1, "b", "U"), ("L2", 2, "c", "U"), ("L1", 3, "d", "U"), ("L3", 2, "e", "U"), ("L3", 3, "f", "D"), ("L1", 4, "g", "U")]
    names = spark.createDataFrame(
        [(link, days[day], i, change, name, None, None, None, "2") for i, (link, day, name, change) in enumerate(versions)],
        f"link_key STRING, extract_ts TIMESTAMP_NTZ, seq INT, change_type STRING, {org}",
    )
    links = spark.createDataFrame(PARTNER_LINKS, LINK_SCHEMA)
    found = partner_names(names, links, "2024-01-03").select("partner_key", "name_org1", "name_from", "name_to")
    far = date(9999, 12, 31)
    assert sorted(map(tuple, found.collect())) == [
        ("B", "b", date(2024, 1, 1), date(2024, 1, 3)),
        ("B", "c", date(2024, 1, 2), far),
        ("B", "d", date(2024, 1, 3), far),
        ("C", "e", date(2024, 1, 2), far),
    ]


def test_a_site_reaches_its_partner_by_live_links_only(spark):
    make = spark.createDataFrame
    common = "extract_ts TIMESTAMP_NTZ, seq INT, change_type STRING"
    states = [("L1", T0, 1, "U"), ("L2", T0, 1, "U"), ("L2", T1, 2, "D"), ("L3", T0, 1, "U"), ("L3", T2, 2, "D")]
    found = site_partners(
        make([("n", T0, 1, "U")], f"salnk_key STRING, {common}"),
        make([("A", k, T0, 1, "U") for k in ("K2", "K3")], f"install_key STRING, account_key STRING, {common}"),
        make(states, f"link_key STRING, {common}"),
        make([("n", "A", "I")], "salnk_key STRING, key1 STRING, key2 STRING"),
        make(PARTNER_LINKS, LINK_SCHEMA),
        make([("s", "I")], "site_id STRING, internal_key STRING"),
        "2024-01-02",
    )
    assert [tuple(r) for r in found.collect()] == [("s", "C")]
