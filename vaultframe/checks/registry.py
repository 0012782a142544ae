"""Where a query and the SQL it must agree with are declared side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vaultframe.adapters import Tables
from vaultframe.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
GROUPS: dict[str, str] = {}

# The adapters of vaultframe.adapters again, as SQL.
ROLES = {
    "sat": """SELECT event_id, user_id, event_type, value, props, ts AS extract_ts, ts + INTERVAL 1 HOUR AS load_ts,
        CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'A' ELSE 'U' END AS change_type FROM events""",
    "lsat": """SELECT * EXCLUDE (l_shipdate), l_shipdate AS extract_ts, strftime(l_shipdate, '%Y%m%d') AS ab,
        CASE WHEN l_returnflag = 'N' THEN '99991231'
             ELSE strftime(l_shipdate + to_days(CAST(l_quantity AS INT)), '%Y%m%d') END AS bis FROM lineitem""",
    "hub_site": "SELECT sha1(c_custkey || ':') AS site_key, c_custkey AS site_id FROM customer",
    "hub_meter": "SELECT sha1(o_orderkey || ':') AS meter_key, o_orderkey AS meter_id FROM orders",
    "hub_device": "SELECT DISTINCT sha1(user_id || ':') AS device_key, user_id AS device_id FROM events",
    "lnk_site_meter": """SELECT sha1(o_orderkey || ':' || o_custkey || ':') AS link_key,
        sha1(o_custkey || ':') AS site_key, sha1(o_orderkey || ':') AS meter_key FROM orders""",
    "eav": """SELECT user_id, event_type AS fname, value, strftime(ts, '%Y%m%d') AS ab, ts AS extract_ts,
        coalesce(lead(strftime(ts, '%Y%m%d')) OVER (PARTITION BY user_id, event_type ORDER BY ts), '99991231') AS bis
        FROM events""",
    "dated": """SELECT o_custkey AS site, o_orderpriority AS attribute, o_orderkey AS val, o_orderdate::DATE AS p_from,
        coalesce(lead(o_orderdate::DATE) OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey),
                 DATE '9999-12-31') AS p_to FROM orders""",
    "reads": """SELECT user_id AS channel_id, time_bucket(INTERVAL 30 MINUTE, ts) AS interval_end, 1800 AS interval_len,
        value AS lp_value,
        CASE event_type WHEN 'click' THEN 'VAL' WHEN 'view' THEN 'est ' ELSE 'REJ' END AS status,
        event_type AS change_method, CAST(user_id % 5 AS INT) AS org_id, ts AS extract_ts,
        ts + INTERVAL 1 HOUR AS load_ts, ts::DATE AS extract_day FROM events""",
    "comms": """SELECT o_orderkey, o_custkey AS device_id, o_orderdate,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'MESH' WHEN '2-HIGH' THEN 'MICROAP' WHEN '3-MEDIUM' THEN 'WIMAX'
             WHEN '4-NOT SPECIFIED' THEN '3G' END AS module FROM orders""",
    "geometry": """SELECT c_custkey AS site,
        'POINT(' || (1000000000 + (c_custkey % 200 - 100) * 1000000) || ' '
                 || (1000000000 + (c_custkey % 150 - 75) * 1000000) || ')' AS location,
        c_nationkey AS substation FROM customer""",
    "tree": """SELECT p_partkey AS component_id, p_name AS pathname, p_brand AS alias, p_partkey // 10 AS parent_id,
        CASE WHEN p_partkey % 7 = 0 THEN p_partkey - 1 END AS clone_id, p_type AS class_name,
        CASE WHEN p_size % 5 = 0 THEN ' ' ELSE upper(substr(p_type, 1, 3)) END AS abbreviation FROM part""",
    "blanks": """SELECT d.doc_id, d.lang, ' ' || d.source || ' ' AS source,
        coalesce(CAST(l.quality AS VARCHAR), '  ') AS quality
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
}


def with_roles(body: str, *names: str, **extra: str) -> str:
    """SQL with the named role tables, then further tables, in front of it."""
    parts = [f"{n} AS ({ROLES[n]})" for n in names] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def check(key: str, sql: str | None = None):
    """Register a query under a key, with the SQL its result must equal."""

    def wrap(function: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = lambda spark, sf_dir: function(Tables(tune(spark), sf_dir))
        GROUPS[key] = function.__module__.rsplit(".", 1)[-1]
        if sql is not None:
            ORACLES[key] = sql
        return function

    return wrap
