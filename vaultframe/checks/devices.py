"""Data products about devices, locations, events and components."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from vaultframe.adapters import LSAT_TIES, RUN_EVENTS, RUN_ORDERS, Tables
from vaultframe.checks.registry import ROLES, check, with_roles
from vaultframe.checks.scalars import lcc_sql
from vaultframe.checks.sites import TIES
from vaultframe.checks.standins import OV_SQL, Vault, key
from vaultframe.functions.columns import decode
from vaultframe.operators import quality, windows
from vaultframe.plans import components, events
from vaultframe.plans.lights import street_lights
from vaultframe.plans.service_points import point_devices, site_geometry


@check(
    "p_service_point_device",
    with_roles(
        """SELECT DISTINCT p.user_id AS site_id, 'M' || p.user_id AS mdm_id, 'SN' || r2.event_type AS serial, r2.start_date, r2.end_date,
               r2.event_type AS device_id, r2.org_id
           FROM r2 JOIN p ON p.user_id = r2.user_id WHERE r2.event_type <> 'view'""",
        ev="""SELECT *, CASE event_type WHEN 'error' THEN '102' ELSE '101' END AS org_id,
              lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS eff_end FROM events""",
        r1="""SELECT *, ts::DATE AS start_date, coalesce(eff_end::DATE, DATE '9999-12-31') AS end_date FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY ts DESC, event_id DESC) AS rn FROM ev
              WHERE org_id <> '102' AND ts < TIMESTAMP '2024-01-20') WHERE rn = 1""",
        r2="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, start_date ORDER BY end_date DESC, ts DESC, event_id DESC) AS rn2
              FROM r1) WHERE rn2 = 1""",
        p="""SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_type <> 'signup'""",
    ),
)
def p_service_point_device(t: Tables):
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    rows = windows.next_value(rows, ["user_id"], ["ts"], {"eff_end": "ts"})
    relations = rows.select(
        key("PT", "user_id").alias("point_key"),
        key("DV", "event_type").alias("device_key"),
        decode("event_type", {"error": "102"}, "101").alias("org_id"),
        F.col("ts").alias("eff_start"),
        "eff_end",
        F.col("ts").alias("extract_ts"),
        F.col("event_id").alias("seq"),
    )
    points = t.events.select(
        key("SP", "user_id").alias("salnk_key"),
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("mdm_id"),
        F.when(F.col("event_type") == "signup", "Closed").otherwise("Active").alias("status"),
        F.col("ts").alias("extract_ts"),
        F.col("event_id").alias("seq"),
    )
    devices = t.events.select(
        key("DV", "event_type").alias("device_key"),
        F.col("event_type").alias("device_id"),
        F.when(F.col("event_type") == "view", " ").otherwise(F.concat(F.lit("SN"), "event_type")).alias("serial"),
        F.col("ts").alias("extract_ts"),
        F.col("event_id").alias("seq"),
    )
    ids = t.hub_device
    links = ids.select(
        key("SP", "device_id").alias("salnk_key"), key("ST", "device_id").alias("key1"), key("PT", "device_id").alias("key2")
    )
    hub = ids.select(key("ST", "device_id").alias("site_key"), F.col("device_id").alias("site_id"))
    return point_devices(relations, points, devices, links, hub, run_dt=RUN_EVENTS, ordered=True)


# --- locations --------------------------------------------------------------

GEO_SQL = """SELECT site, location, TIMESTAMP '1996-01-01' AS extract_ts FROM ({0})
    UNION ALL SELECT site, replace(location, 'POINT(', 'POINT(9'), TIMESTAMP '1997-01-01' FROM ({0}) WHERE site % 10 = 0"""


def geometry_versions(t: Tables, name: str, prefix: str):
    """Locations, with a second version for every tenth site."""
    first = t.geometry.select(
        key(prefix, "site").alias(name),
        "site",
        "location",
        F.lit("1996-01-01").cast("timestamp_ntz").alias("extract_ts"),
        F.col("site").alias("seq"),
        F.lit("U").alias("change_type"),
    )
    moved = first.filter(F.col("site") % 10 == 0).withColumns(
        {
            "location": F.replace("location", F.lit("POINT("), F.lit("POINT(9")),
            "extract_ts": F.lit("1997-01-01").cast("timestamp_ntz"),
        }
    )
    return first.unionByName(moved).drop("site")


SPLIT = "{0} AS x, {1} AS y".format(
    "split_part(regexp_replace(location, '[POINT()]', '', 'g'), ' ', 1)",
    "string_split(regexp_replace(location, '[POINT()]', '', 'g'), ' ')[-1]",
)


@check(
    "p_site_geometry",
    with_roles(
        f"""SELECT *, {SPLIT} FROM (
              SELECT s.cust AS site_id, n_name AS substation_id, s.extract_ts AS source_extract_dtm, g.location
              FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cust ORDER BY extract_ts DESC, price DESC, seq DESC) AS rn FROM ov
                    WHERE extract_ts < TIMESTAMP '1999-06-30') WHERE rn = 1 AND change_type <> 'D') s
              LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY extract_ts DESC) AS rn FROM geo) WHERE rn = 1) g
                ON g.site = s.cust
              JOIN customer ON c_custkey = s.cust JOIN nation ON n_nationkey = c_nationkey)""",
        ov=OV_SQL,
        geo=GEO_SQL.format(ROLES["geometry"]),
    )
    .join(["WITH base AS (", "), "])
    + lcc_sql("base", "x", "y", "site_id, substation_id, source_extract_dtm, location")
    + """ SELECT site_id, substation_id, source_extract_dtm, location, round(degrees(lat6), 6) AS latitude,
          round(degrees(theta / n) + 145, 6) AS longitude FROM f6""",
)
def p_site_geometry(t: Tables):
    v = Vault(t)
    points = v.versions(link_key=key("NS", "cust"), last_update=F.col("price"))
    links = t.customer.select(
        key("NS", "c_custkey").alias("link_key"),
        key("E", "c_custkey").alias("site_key"),
        key("NK", "c_nationkey").alias("substation_key"),
    )
    hub = t.nation.select(key("NK", "n_nationkey").alias("substation_key"), F.col("n_name").alias("substation_id"))
    rows = site_geometry(points, geometry_versions(t, "link_key", "NS"), links, v.hub_site, hub, run_dt=RUN_ORDERS)
    return rows.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in ("latitude", "longitude")})


LIGHT_COLUMNS = """light_id, p_brand, p_type, p_name, p_size, p_retailprice, c_mktsegment, c_acctbal"""
LIGHT_SQL = f"""SELECT c_custkey AS light_id, p_brand, p_type, p_name, p_size, p_retailprice, c_mktsegment, c_acctbal, {SPLIT}
    FROM customer JOIN part ON p_partkey = c_custkey JOIN geo ON geo.site = c_custkey"""


def lights_of(t: Tables, latest: bool):
    lights = t.customer.select(
        key("LI", "c_custkey").alias("equipment_key"),
        F.lit("2010-01-01").alias("connection_date"),
        F.concat(F.lit("G"), (F.col("c_custkey") % 5).cast("string")).alias("control_gear"),
        F.when(F.col("c_custkey") % 2 == 0, "2015-06-30").alias("lamp_changed"),
        F.lit("2016-01-01").alias("billing_from"),
        F.col("c_mktsegment").alias("owner_name"),
        F.when(F.col("c_acctbal") < 0, "OFF").otherwise("ON").alias("billing_status"),
        F.lit("In service").alias("status"),
    )
    specs = t.part.select(
        key("PS", "p_partkey").alias("spec_key"),
        F.concat(F.lit(" "), "p_brand", F.lit(" ")).alias("manufacturer"),
        F.col("p_type").alias("model"),
        F.col("p_name").alias("lamp_type"),
        F.concat(F.lit("T"), (F.col("p_size") % 4).cast("string")).alias("fitting"),
        F.col("p_size").alias("watts_rating"),
        F.col("p_retailprice").alias("market_watts_rating"),
        F.when(F.col("p_size") > 25, "true").otherwise("false").alias("real_spec"),
    )
    links = t.customer.select(key("LI", "c_custkey").alias("equipment_key"), key("PS", "c_custkey").alias("spec_key"))
    hub = t.customer.select(key("LI", "c_custkey").alias("equipment_key"), F.col("c_custkey").alias("light_id"))
    return street_lights(
        lights, geometry_versions(t, "equipment_key", "LI"), specs, links, hub,
        billing_sites={"Brand#1": "S1", "Brand#2": "S2", "Brand#3": "S3"}, default_site="S9",
        cost_share={"Brand#1": ("S9", 40)}, now_utc=datetime(2024, 2, 1, 9), latest_location=latest,
    )


@check(
    "p_lights",
    with_roles(
        LIGHT_SQL,
        all_geo=GEO_SQL.format(ROLES["geometry"]),
        geo="SELECT * FROM (SELECT *, rank() OVER (PARTITION BY site ORDER BY extract_ts DESC) AS rk FROM all_geo) WHERE rk = 1",
    ).join(["WITH base AS (", "), "])
    + lcc_sql("base", "x", "y", LIGHT_COLUMNS)
    + """ SELECT CASE p_brand WHEN 'Brand#1' THEN 'S1' WHEN 'Brand#2' THEN 'S2' WHEN 'Brand#3' THEN 'S3' ELSE 'S9' END AS site, light_id,
          CASE p_brand WHEN 'Brand#1' THEN 'S9' END AS cost_share_site, CASE p_brand WHEN 'Brand#1' THEN 40 END AS cost_share_percent,
          p_brand AS manufacturer, p_type AS model, p_name AS lamp_type, p_size::DECIMAL(12,1) AS watts_rating,
          p_retailprice::DECIMAL(12,1) AS market_watts_rating, 'T' || (p_size % 4) AS fitting, 'G' || (light_id % 5) AS control_gear,
          CASE WHEN light_id % 2 = 0 THEN '2015-06-30' END AS lamp_changed, '2016-01-01' AS billing_from,
          '2024-02-01 19:00:00' AS row_insert_dtm, CASE WHEN p_size > 25 THEN 'Standard' ELSE 'Non-Standard' END AS real_spec,
          '2010-01-01' AS connection_date, round(degrees(lat6), 6) AS latitude, round(degrees(theta / n) + 145, 6) AS longitude,
          c_mktsegment AS owner_name, CASE WHEN c_acctbal < 0 THEN 'OFF' ELSE 'ON' END AS billing_status, 'In service' AS lc_status FROM f6""",
)
def p_lights(t: Tables):
    rows = lights_of(t, latest=True)
    return rows.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in ("latitude", "longitude")})


@check(
    "p_lights_duplicates",
    "SELECT c_custkey AS light_id, 2::BIGINT AS row_count FROM customer JOIN part ON p_partkey = c_custkey WHERE c_custkey % 10 = 0",
)
def p_lights_duplicates(t: Tables):
    return quality.duplicate_keys(lights_of(t, latest=False), ["light_id"])


# --- events and alarms ------------------------------------------------------


@check(
    "p_device_events",
    with_roles(
        """SELECT user_id AS serial_number, event_id AS event_log_id, event_type AS event_cd, extract_ts AS event_dtm, value AS event_val,
                  props AS event_text, load_ts AS insert_dtm
           FROM sat WHERE extract_ts >= TIMESTAMP '2024-01-16' AND extract_ts < TIMESTAMP '2024-01-25' AND change_type <> 'D'
             AND event_type IN (SELECT event_type FROM events WHERE value > 300)""",
        "sat",
    ),
)
def p_device_events(t: Tables):
    rows = t.sat.select(
        F.col("event_id").alias("log_id"),
        F.col("event_type").alias("event_id"),
        "value",
        "props",
        "extract_ts",
        "load_ts",
        "change_type",
        F.col("extract_ts").cast("date").alias("extract_day"),
        key("JL", "user_id").alias("job_link_key"),
    )
    ids = t.hub_device
    links = ids.select(key("JL", "device_id").alias("job_link_key"), "device_key")
    codes = t.events.filter("value > 300").select(F.col("event_type").alias("code"))
    layout = {
        "event_log_id": "log_id",
        "event_cd": "event_id",
        "event_dtm": "extract_ts",
        "event_val": "value",
        "event_text": "props",
        "insert_dtm": "load_ts",
    }
    return events.device_events(rows, links, ids, codes, run_dt=RUN_EVENTS, layout=layout)


def local_sql(col: str) -> str:
    return f"timezone('Australia/Melbourne', timezone('UTC', {col}))"


def alarm_sql(where: str) -> str:
    return with_roles(
        f"""SELECT sha1('AL' || user_id || ':') AS alarm_key, user_id AS alarm_id, event_type AS reference, event_type AS plant_attribute,
               value AS alarm_value, props AS message, extract_ts, load_ts, extract_ts AS alarm_ts, load_ts AS ack_ts, extract_ts AS insert_ts,
               {local_sql('extract_ts')} AS alarm_ts_local, {local_sql('load_ts')} AS ack_ts_local, {local_sql('extract_ts')} AS insert_ts_local
            FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY extract_ts DESC, event_id DESC) AS rn FROM sat
                  WHERE {where} AND event_type <> 'signup') WHERE rn = 1""",
        "sat",
    )


def alarm_tables(t: Tables):
    alarms = t.sat.select(
        key("AL", "user_id").alias("alarm_key"),
        F.col("event_type").alias("reference"),
        F.col("event_type").alias("plant_attribute"),
        F.col("value").alias("alarm_value"),
        F.col("props").alias("message"),
        "extract_ts",
        "load_ts",
        F.col("extract_ts").alias("alarm_ts"),
        F.col("load_ts").alias("ack_ts"),
        F.col("extract_ts").alias("insert_ts"),
        F.col("event_id").alias("seq"),
    )
    hub = t.hub_device.select(key("AL", "device_id").alias("alarm_key"), F.col("device_id").alias("alarm_id"))
    return alarms, hub


@check("p_alarm_history", alarm_sql("extract_ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'"))
def p_alarm_history(t: Tables):
    alarms, hub = alarm_tables(t)
    return events.alarm_history(alarms, hub, datetime(2024, 1, 5), datetime(2024, 1, 20), excluded="signup")


@check("p_alarm_updates", alarm_sql("load_ts > TIMESTAMP '2024-01-10' AND extract_ts <= TIMESTAMP '2024-01-20'"))
def p_alarm_updates(t: Tables):
    alarms, hub = alarm_tables(t)
    return events.alarm_updates(alarms, hub, datetime(2024, 1, 10), datetime(2024, 1, 20), excluded="signup")


@check(
    "p_feed_status",
    """SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS report_ts, o_orderdate AS insert_ts, o_orderdate AS update_ts,
              o_orderstatus AS read_status, count(*) AS cnt
       FROM orders WHERE o_orderdate > DATE '1999-06-30' - INTERVAL 2 MONTH GROUP BY ALL ORDER BY 1 DESC""",
)
def p_feed_status(t: Tables):
    feed = t.orders.select(
        F.trunc(F.col("o_orderdate").cast("date"), "month").cast("timestamp_ntz").alias("report_ts"),
        F.col("o_orderdate").alias("insert_ts"),
        F.col("o_orderdate").alias("update_ts"),
        F.col("o_orderstatus").alias("read_status"),
    )
    return events.feed_status(feed, RUN_ORDERS)


# --- components and asset keys ----------------------------------------------

COMPONENT_SQL = {
    "latest": f"""SELECT l_partkey AS component_id, 'path' || l_orderkey AS pathname, 'A' || l_suppkey AS alias, l_returnflag AS component_class,
        l_partkey // 10 AS parent_id, CASE WHEN l_partkey % 7 = 0 THEN l_partkey - 1 END AS clone_id FROM (
        SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY extract_ts DESC, l_orderkey DESC, l_linenumber DESC, {TIES}) AS rn FROM lsat)
        WHERE rn = 1 AND l_quantity >= 5""",
    "comp": """SELECT sha1('CK' || component_id || ':') AS component_key, *,
        CASE component_class WHEN 'A' THEN 'ABR' WHEN 'N' THEN 'N name' ELSE ' ' END AS asset_type FROM latest""",
}


@check(
    "p_components",
    with_roles(
        """SELECT a.*, c.component_key AS clone_component_key, c.pathname AS clone_pathname, c.alias AS clone_alias,
               p.component_key AS parent_component_key, p.pathname AS parent_pathname, p.alias AS parent_alias
           FROM comp a LEFT JOIN comp c ON c.component_id = a.clone_id LEFT JOIN comp p ON p.component_id = a.parent_id
           WHERE a.asset_type <> ' '""",
        "lsat",
        **COMPONENT_SQL,
    ),
)
def p_components(t: Tables):
    rows = t.lsat.select(
        key("CK", "l_partkey").alias("component_key"),
        F.concat(F.lit("path"), F.col("l_orderkey").cast("string")).alias("pathname"),
        F.concat(F.lit("A"), F.col("l_suppkey").cast("string")).alias("alias"),
        F.col("l_returnflag").alias("component_class"),
        F.floor(F.col("l_partkey") / 10).cast("long").alias("parent_id"),
        F.when(F.col("l_partkey") % 7 == 0, F.col("l_partkey") - 1).alias("clone_id"),
        F.when(F.col("l_quantity") < 5, "D").otherwise("U").alias("change_type"),
        "extract_ts",
        F.struct("l_orderkey", "l_linenumber", *LSAT_TIES).alias("seq"),
    )
    hub = t.part.select(key("CK", "p_partkey").alias("component_key"), F.col("p_partkey").alias("component_id"))
    classes = t.lineitem.select(F.col("l_returnflag").alias("class_index")).distinct()
    classes = classes.select(
        "class_index",
        decode("class_index", {"A": "ABR", "N": ""}, " ").alias("abbreviation"),
        F.concat("class_index", F.lit(" name")).alias("class_name"),
        F.lit("U").alias("change_type"),
    )
    return components.component_register(rows, hub, classes)


@check(
    "p_asset_key_match",
    """WITH e AS (SELECT *, CASE WHEN p_size < 25 THEN 'DS-' WHEN p_size < 40 THEN 'TS-' ELSE 'XX-' END || p_partkey AS loc FROM part
                  WHERE p_type LIKE 'S%' AND p_retailprice < 1500),
            d AS (SELECT l_partkey, max(l_linenumber) AS m FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey)
       SELECT p_partkey AS equipment_id, loc AS location, 'SERV' AS user_status, p_type AS object_type, 'A' || p_partkey AS alias,
              'K' || p_size AS system_key, 'K' || m AS composite_key, 'device ' || l_partkey AS device_name,
              CASE WHEN m IS NOT NULL AND 'K' || m <> 'K' || p_size THEN 'K' || m ELSE 'K' || p_size END AS derived_key
       FROM e LEFT JOIN d ON d.l_partkey = e.p_partkey WHERE loc NOT LIKE 'XX-%'""",
)
def p_asset_key_match(t: Tables):
    number = F.col("p_partkey").cast("string")
    area = F.when(F.col("p_size") < 25, "DS-").when(F.col("p_size") < 40, "TS-").otherwise("XX-")
    equipment = t.part.select(
        F.col("p_partkey").alias("equipment_id"),
        F.concat(area, number).alias("location"),
        F.when(F.col("p_retailprice") < 1500, "SERV").otherwise("OUT").alias("user_status"),
        F.col("p_type").alias("object_type"),
        F.when(F.col("p_type").like("S%"), "CB").otherwise("TX").alias("cat_profile"),
    )
    named = [("SCADA_KEY", F.concat(F.lit("K"), F.col("p_size").cast("string"))), ("ALIAS", F.concat(F.lit("A"), number))]
    parts = [
        t.part.select(F.concat(area, number).alias("object_no"), F.lit(n).alias("char_name"), value.alias("value_char"))
        for n, value in named
    ]
    known = t.lineitem.filter("l_returnflag = 'R'").groupBy("l_partkey").agg(F.max("l_linenumber").alias("m"))
    known = known.withColumn("text", F.col("l_partkey").cast("string"))
    comps = known.select(key("CO", "l_partkey").alias("component_key"), F.concat(F.lit("A"), "text").alias("component_alias"))
    attributes = known.select(
        key("CO", "l_partkey").alias("component_key"),
        F.concat(F.lit("K"), F.col("m").cast("string")).alias("composite_key"),
        F.concat(F.lit("device "), "text").alias("device_name"),
    )
    return components.asset_key_match(equipment, parts[0].unionByName(parts[1]), comps, attributes)
