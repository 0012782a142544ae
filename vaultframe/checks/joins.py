"""Vault joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultframe.adapters import COMMS_GROUPS, LSAT_KEYS, LSAT_TIES, Tables
from vaultframe.checks.registry import check, with_roles
from vaultframe.functions.columns import fold_category
from vaultframe.functions.keys import hash_key
from vaultframe.operators import joins, versions
from vaultframe.operators.versions import newest

FOLD_SQL = "CASE WHEN {0} IN ('MICROAP', 'MESH') THEN 'MESH' WHEN {0} IN ('3G', 'WIMAX') THEN 'WIMAX' END"
INTERVALS_SQL = """SELECT user_id AS device_id, CASE event_type WHEN 'click' THEN 'MESH' ELSE 'WIMAX' END AS network,
    max(ts) AS last_ts FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL"""


def last_intervals(t: Tables):
    """Newest interval of each device and network."""
    kinds = t.events.filter(F.col("event_type").isin("click", "view"))
    network = F.when(F.col("event_type") == "click", "MESH").otherwise("WIMAX").alias("network")
    return kinds.groupBy(F.col("user_id").alias("device_id"), network).agg(F.max("ts").alias("last_ts"))


@check(
    "sat_link_hub",
    with_roles(
        """SELECT b.site_id, h.meter_id, s.o_orderstatus, s.o_totalprice
           FROM (SELECT sha1(o_orderkey || ':' || o_custkey || ':') AS link_key, o_orderstatus, o_totalprice FROM orders) s
           JOIN lnk_site_meter k ON s.link_key = k.link_key
           JOIN hub_site b ON k.site_key = b.site_key JOIN hub_meter h ON k.meter_key = h.meter_key""",
        "lnk_site_meter",
        "hub_site",
        "hub_meter",
    ),
)
def sat_link_hub(t: Tables):
    sat = t.orders.select(hash_key("o_orderkey", "o_custkey").alias("link_key"), "o_orderstatus", "o_totalprice")
    hubs = [
        (t.hub_site, "site_key", "site_key", {"site_id": "site_id"}),
        (t.hub_meter, "meter_key", "meter_key", {"meter_id": "meter_id"}),
    ]
    return joins.sat_link_hub(sat, t.lnk_site_meter, "link_key", hubs).select(
        "site_id", "meter_id", "o_orderstatus", "o_totalprice"
    )


ROLE_HUB_SQL = """SELECT sha1('P' || p_partkey || ':') AS k, p_name AS bk FROM part
    UNION ALL SELECT sha1('S' || s_suppkey || ':'), s_name FROM supplier
    UNION ALL SELECT sha1('O' || o_orderkey || ':'), 'order ' || o_orderkey FROM orders"""


def role_key(prefix: str, col: str):
    return hash_key(F.concat(F.lit(prefix), F.col(col).cast("string")))


@check(
    "same_as_roles",
    with_roles(
        """SELECT l.l_orderkey, l.l_linenumber, h1.bk AS external_id, h2.bk AS internal_id, h3.bk AS contract_id
           FROM (SELECT *, sha1('P' || l_partkey || ':') AS k1, sha1('S' || l_suppkey || ':') AS k2,
                        sha1('O' || l_orderkey || ':') AS k3 FROM lineitem) l
           JOIN h h1 ON l.k1 = h1.k JOIN h h2 ON l.k2 = h2.k JOIN h h3 ON l.k3 = h3.k""",
        h=ROLE_HUB_SQL,
    ),
)
def same_as_roles(t: Tables):
    hub = (
        t.part.select(role_key("P", "p_partkey").alias("k"), F.col("p_name").alias("bk"))
        .unionByName(t.supplier.select(role_key("S", "s_suppkey").alias("k"), F.col("s_name").alias("bk")))
        .unionByName(
            t.orders.select(
                role_key("O", "o_orderkey").alias("k"),
                F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("bk"),
            )
        )
    )
    roles = {"k1": ("P", "l_partkey"), "k2": ("S", "l_suppkey"), "k3": ("O", "l_orderkey")}
    link = t.lineitem.select("l_orderkey", "l_linenumber", *[role_key(*c).alias(k) for k, c in roles.items()])
    named = {"k1": "external_id", "k2": "internal_id", "k3": "contract_id"}
    return joins.same_as_roles(link, hub, "k", "bk", named).drop(*roles)


VAULT_CHAIN_SQL = with_roles(
    f"""SELECT DISTINCT c.c_custkey AS site, n.n_name AS area, r.r_name AS zone, o.o_orderkey AS meter,
              s.l_linenumber AS register, s.l_returnflag AS suffix
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
        JOIN orders o ON o.o_custkey = c.c_custkey
        JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY extract_ts DESC, {', '.join(f'{c} DESC' for c in LSAT_TIES)}) AS rn FROM lsat) WHERE rn = 1) s
          ON s.l_orderkey = o.o_orderkey""",
    "lsat",
)


@check("vault_chain", VAULT_CHAIN_SQL)
def vault_chain(t: Tables):
    lines = versions.current_version(t.lsat, LSAT_KEYS, newest("extract_ts", *LSAT_TIES)).select(
        F.col("l_orderkey").alias("meter"), F.col("l_linenumber").alias("register"), F.col("l_returnflag").alias("suffix")
    )
    sites = t.customer.select(F.col("c_custkey").alias("site"), "c_nationkey")
    areas = joins.resolve(sites, t.nation, "c_nationkey", "n_nationkey", {"n_name": "area", "n_regionkey": "n_regionkey"})
    areas = joins.resolve(areas, t.region, "n_regionkey", "r_regionkey", {"r_name": "zone"})
    meters = t.orders.select(F.col("o_custkey").alias("site"), F.col("o_orderkey").alias("meter"))
    joined = areas.join(meters, "site").join(lines, "meter")
    return joined.select("site", "area", "zone", "meter", "register", "suffix").distinct()


@check(
    "left_join",
    """SELECT c.c_custkey, o.o_orderkey, o.o_orderstatus FROM customer c
       LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') o ON c.c_custkey = o.o_custkey""",
)
def left_join(t: Tables):
    pending = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    return t.customer.select("c_custkey").join(pending, "c_custkey", "left")


@check(
    "anti_join",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""",
)
def anti_join(t: Tables):
    inactive = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.drop_matching(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), inactive, ["l_orderkey"])


@check(
    "not_exists_mapped",
    with_roles(
        f"""SELECT o_orderkey, device_id, module FROM comms c WHERE NOT EXISTS (
              SELECT 1 FROM seen i WHERE i.device_id = c.device_id AND i.last_ts >= TIMESTAMP '2024-01-15'
              AND i.network = {FOLD_SQL.format('c.module')})""",
        "comms",
        seen=INTERVALS_SQL,
    ),
)
def not_exists_mapped(t: Tables):
    fresh = last_intervals(t).filter("last_ts >= TIMESTAMP_NTZ '2024-01-15'")
    meters = t.comms.select("o_orderkey", "device_id", "module")
    return joins.not_exists_mapped(meters, fresh, ["device_id"], fold_category("module", COMMS_GROUPS), "network")


@check(
    "case_key_join",
    with_roles(
        f"""SELECT c.o_orderkey, c.device_id, c.module, i.last_ts FROM comms c LEFT JOIN seen i
            ON i.device_id = c.device_id AND i.network = {FOLD_SQL.format('c.module')}""",
        "comms",
        seen=INTERVALS_SQL,
    ),
)
def case_key_join(t: Tables):
    meters = t.comms.select("o_orderkey", "device_id", "module")
    return joins.join_mapped(meters, last_intervals(t), ["device_id"], fold_category("module", COMMS_GROUPS), "network")


OVERLAP_SIDES = {
    "urgent": "SELECT site, val AS urgent, p_from AS u_from, p_to AS u_to FROM dated WHERE attribute = '1-URGENT'",
    "low": "SELECT site, val AS low, p_from AS low_from, p_to AS low_to FROM dated WHERE attribute = '5-LOW'",
}


def overlap_sides(t: Tables):
    urgent = t.attribute("1-URGENT", "urgent").withColumnsRenamed({"urgent_from": "u_from", "urgent_to": "u_to"})
    return urgent, t.attribute("5-LOW", "low")


@check(
    "overlap_inner",
    with_roles(
        """SELECT u.site, u.urgent, u.u_from, u.u_to, l.low, l.low_from, l.low_to FROM urgent u
           JOIN low l ON u.site = l.site AND l.low_to > u.u_from AND l.low_from < u.u_to""",
        "dated",
        **OVERLAP_SIDES,
    ),
)
def overlap_inner(t: Tables):
    urgent, low = overlap_sides(t)
    return joins.overlap_join(urgent, low, ["site"], ("u_from", "u_to"), ("low_from", "low_to"))


@check(
    "overlap_left",
    with_roles(
        """SELECT u.site, u.urgent, u.u_from, u.u_to, l.low, l.low_from, l.low_to FROM urgent u
           LEFT JOIN low l ON u.site = l.site AND l.low_to > u.u_from AND l.low_from < u.u_to""",
        "dated",
        **OVERLAP_SIDES,
    ),
)
def overlap_left(t: Tables):
    urgent, low = overlap_sides(t)
    return joins.overlap_join(urgent, low, ["site"], ("u_from", "u_to"), ("low_from", "low_to"), how="left")


@check(
    "tree_parent_clone",
    with_roles(
        """SELECT a.*, c.pathname AS clone_pathname, c.alias AS clone_alias, p.pathname AS parent_pathname,
                  p.alias AS parent_alias
           FROM tree a LEFT JOIN tree c ON a.clone_id = c.component_id LEFT JOIN tree p ON a.parent_id = p.component_id""",
        "tree",
    ),
)
def tree_parent_clone(t: Tables):
    return joins.tree_parent_clone(t.tree, "component_id", "parent_id", "clone_id", ["pathname", "alias"])


@check(
    "default_branch",
    """SELECT o.o_orderkey, s.lines, s.module FROM orders o
       JOIN (SELECT l_orderkey, count(*) AS lines, 'CARD' AS module FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) s
         ON o.o_orderkey = s.l_orderkey
       UNION ALL SELECT o_orderkey, 0, 'MESH' FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def default_branch(t: Tables):
    cards = (
        t.lineitem.filter("l_returnflag = 'R'")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("lines"))
        .withColumn("module", F.lit("CARD"))
    )
    meters = t.orders.select("o_orderkey")
    return joins.default_branch(meters, cards, ["o_orderkey"], {"lines": 0, "module": "MESH"})


@check(
    "asset_key_match",
    """SELECT a.p_partkey, a.p_name AS alias, b.p_brand AS system_key, s.s_name AS device_name
       FROM part a JOIN part b ON a.p_partkey = b.p_partkey
       LEFT JOIN supplier s ON a.p_partkey = s.s_suppkey WHERE a.p_size < 40 AND b.p_type LIKE 'S%'""",
)
def asset_key_match(t: Tables):
    aliases = t.part.filter("p_size < 40").select("p_partkey", F.col("p_name").alias("alias"))
    system = t.part.filter(F.col("p_type").like("S%")).select("p_partkey", F.col("p_brand").alias("system_key"))
    devices = t.supplier.select(F.col("s_suppkey").alias("p_partkey"), F.col("s_name").alias("device_name"))
    return aliases.join(system, "p_partkey").join(devices, "p_partkey", "left")


@check(
    "ref_filter_join",
    """SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey IN (
         SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')""",
)
def ref_filter_join(t: Tables):
    region = t.region.filter("r_name = 'ASIA'").select(F.col("r_regionkey").alias("n_regionkey"))
    ref = t.nation.join(region, "n_regionkey", "left_semi").select(F.col("n_nationkey").alias("c_nationkey"))
    return joins.ref_filter_join(t.customer.select("c_custkey", "c_name", "c_nationkey"), ref, "c_nationkey")
