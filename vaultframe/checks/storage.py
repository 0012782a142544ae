"""Sources and sinks: what is written is read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vaultframe.adapters import Tables
from vaultframe.checks.registry import check, with_roles
from vaultframe.functions import dates
from vaultframe.functions.keys import hash_key
from vaultframe.session import new_work_path
from vaultframe.operators import upkeep
from vaultframe.operators.versions import first_per_key, newest
from vaultframe.sources import scan, sink


def unique(name: str) -> str:
    """A table name no other run uses."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


@check("scan_parquet", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 30")
def scan_parquet(t: Tables):
    view = unique("landed")
    scan.scan_parquet(t.spark, f"{t.sf_dir}/lineitem.parquet", view)
    return t.spark.table(view).filter("l_quantity > 30").select("l_orderkey", "l_linenumber", "l_quantity")


@check("scan_path", "SELECT c_custkey, c_mktsegment FROM customer")
def scan_path(t: Tables):
    return scan.scan_path(t.spark, "parquet", f"{t.sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")


@check(
    "scan_csv_plain",
    "SELECT CAST(event_id AS VARCHAR) AS _c0, strftime(ts, '%Y%m%d') AS _c1, event_type AS _c2 FROM events",
)
def scan_csv_plain(t: Tables):
    path = new_work_path(t.spark, "tags")
    t.events.select("event_id", dates.day_text("ts").alias("day"), "event_type").write.csv(path)
    return scan.scan_csv(t.spark, path)


@check("scan_csv_inferred", "SELECT p_partkey::INT AS p_partkey, p_brand, p_size, p_retailprice FROM part")
def scan_csv_inferred(t: Tables):
    path = new_work_path(t.spark, "parts")
    t.part.select("p_partkey", "p_brand", "p_size", "p_retailprice").write.option("header", True).csv(path)
    return scan.scan_csv(t.spark, path, header=True, infer=True)


@check("scan_csv_schema", "SELECT p_partkey, p_brand, p_size FROM part")
def scan_csv_schema(t: Tables):
    path = new_work_path(t.spark, "parts")
    t.part.select("p_partkey", "p_brand", "p_size").write.option("header", True).csv(path)
    return scan.scan_csv(t.spark, path, header=True, schema="p_partkey BIGINT, p_brand STRING, p_size INT")


@check("scan_vault_table", with_roles("SELECT site_key, site_id FROM hub_site", "hub_site"))
def scan_vault_table(t: Tables):
    catalog = scan.VaultCatalog(t.spark, unique("tst"))
    root = new_work_path(t.spark, "vault")
    catalog.create_schema("rawvault", root)
    sink.write_table(t.hub_site, catalog.name("rawvault", "hub_site"), f"{root}/hub_site")
    return catalog.table("rawvault", "hub_site")


@check("sink_overwrite", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def sink_overwrite(t: Tables):
    name, path = unique("orders_out"), new_work_path(t.spark, "overwrite")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    sink.write_table(orders.filter("o_orderstatus = 'F'"), name, path)
    return sink.write_table(orders.filter("o_orderstatus = 'O'"), name, path)


@check("sink_rebuild", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def sink_rebuild(t: Tables):
    name = unique("stage")
    sink.rebuild_table(t.orders.select("o_custkey"), name, new_work_path(t.spark, "stage"))
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return sink.rebuild_table(counts, name, new_work_path(t.spark, "stage"))


@check(
    "sink_replace_run",
    """SELECT event_id, value + CASE WHEN ts::DATE = DATE '2024-01-03' THEN 1 ELSE 0 END AS value, ts::DATE AS run_date
       FROM events WHERE ts::DATE <> DATE '2024-01-04'""",
)
def sink_replace_run(t: Tables):
    """All runs are loaded, then one is replaced and one emptied; the catalog table sees both."""
    path, name = new_work_path(t.spark, "runs"), unique("runs")
    t.spark.sql(f"CREATE TABLE {name} (event_id BIGINT, value DOUBLE, run_date DATE) USING parquet PARTITIONED BY (run_date) LOCATION '{path}'")
    rows = t.events.select("event_id", "value", F.col("ts").cast("date").alias("run_date"))
    sink.write_runs(rows, path, "run_date", name)
    third = rows.filter("run_date = DATE '2024-01-03'").withColumn("value", F.col("value") + 1)
    sink.replace_run(third, path, "run_date", "2024-01-03", name)
    sink.replace_run(rows.filter("run_date = DATE '2024-01-04' AND event_id < 0"), path, "run_date", "2024-01-04", name)
    return t.spark.table(name)


DEVICE_EVENT = """parent_key CHAR(40), event_id BIGINT, event_type VARCHAR(20), event_value DOUBLE,
    price DECIMAL(12,1), amount FLOAT, event_day DATE, load_ts TIMESTAMP_NTZ, tz_offset INT"""


@check(
    "typed_table",
    """SELECT sha1(user_id || ':') AS parent_key, event_id, event_type, value AS event_value, value::DECIMAL(12,1) AS price,
              value::FLOAT AS amount, ts + INTERVAL 1 HOUR AS load_ts, 10 AS tz_offset, ts::DATE AS event_day FROM events""",
)
def typed_table(t: Tables):
    spec = sink.TableSpec(unique("sat_device_event"), DEVICE_EVENT, ("event_day",), "device events")
    sink.create_table(t.spark, spec, new_work_path(t.spark, "typed"))
    rows = t.events.select(
        hash_key("user_id").alias("parent_key"),
        "event_id",
        "event_type",
        F.col("value").alias("event_value"),
        F.col("value").alias("price"),
        F.col("value").alias("amount"),
        F.col("ts").cast("date").alias("event_day"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("load_ts"),
        F.lit(10).alias("tz_offset"),
    )
    return sink.fill_table(rows, spec)


@check("sink_truncate", "SELECT count(*) AS before, 0::BIGINT AS after, count(*) AS refilled FROM supplier")
def sink_truncate(t: Tables):
    catalog = scan.VaultCatalog(t.spark, unique("tst"))
    catalog.create_schema("transform", new_work_path(t.spark, "transform"))
    name = catalog.name("transform", "emptied")
    suppliers = t.supplier.select("s_suppkey", "s_name")
    counted = [sink.rebuild_table(suppliers, name).count(), sink.truncate_table(t.spark, name).count()]
    suppliers.write.insertInto(name)
    rows = t.spark.table(name).agg(F.count(F.lit(1)).alias("refilled"))
    return rows.select(F.lit(counted[0]).cast("long").alias("before"), F.lit(counted[1]).cast("long").alias("after"), "refilled")


@check("compact_partitioned", "SELECT event_id, value, event_type FROM events")
def compact_partitioned(t: Tables):
    name = unique("parts")
    t.events.select("event_id", "value", "event_type").repartition(6).write.partitionBy("event_type").option(
        "path", new_work_path(t.spark, "parts")
    ).saveAsTable(name)
    sink.compact_tables(t.spark, [name], new_work_path(t.spark, "compacted"))
    return t.spark.table(name)


@check("compact_rows", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem")
def compact_rows(t: Tables):
    small, target = new_work_path(t.spark, "many"), new_work_path(t.spark, "few")
    t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").repartition(12).write.parquet(small)
    sink.compact(t.spark, small, target)
    return scan.scan_parquet(t.spark, target)


@check(
    "file_manifest",
    """SELECT event_type AS part, 1::BIGINT AS files, true AS has_bytes, count(*) AS row_count FROM events GROUP BY event_type""",
)
def file_manifest(t: Tables):
    path = new_work_path(t.spark, "landing")
    t.events.repartition("event_type").write.partitionBy("event_type").parquet(path)
    part = F.regexp_extract("directory", "event_type=([^/]*)$", 1)
    listed = scan.directory_summary(t.spark, f"{path}/*").select(part.alias("part"), "files", (F.col("bytes") > 0).alias("has_bytes"))
    counted = scan.rows_per_file(scan.scan_parquet(t.spark, path))
    counted = counted.groupBy(F.regexp_extract("file_path", "event_type=([^/]*)/", 1).alias("part")).agg(
        F.sum("row_count").alias("row_count")
    )
    return listed.join(counted, "part")


@check(
    "staged_vs_landed",
    "SELECT (SELECT count(*) FROM customer) AS staged_rows, (SELECT count(*) FROM customer) AS landed_rows",
)
def staged_vs_landed(t: Tables):
    path = new_work_path(t.spark, "landed")
    t.customer.write.option("header", True).csv(path)
    return scan.staged_vs_landed(t.customer, scan.scan_csv(t.spark, path, header=True))


STATE = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, extract_ts TIMESTAMP_NTZ, change_type STRING"


@check(
    "current_by_upkeep",
    with_roles(
        """SELECT * EXCLUDE (rn) FROM (SELECT event_id, user_id, event_type, value, extract_ts, change_type,
             row_number() OVER (PARTITION BY user_id ORDER BY extract_ts DESC, event_id DESC) AS rn FROM sat)
           WHERE rn = 1 AND change_type <> 'D'""",
        "sat",
    ),
)
def current_by_upkeep(t: Tables):
    """The history replayed in three windows whose rows come late, early and twice."""
    name, path = unique("newest"), new_work_path(t.spark, "newest")
    state = upkeep.CurrentVersions(t.spark, name, path, ["user_id"], ["extract_ts", "event_id"], parts=8).create(STATE)
    for some in ("event_id % 3 = 1", "event_id % 3 = 0", "event_id % 3 <> 0"):
        state.merge(t.sat.filter(some))
    return state.live()


@check(
    "sat_link_clustered",
    with_roles(
        """SELECT k.site_key, s.l_orderkey, s.l_linenumber, s.extract_ts FROM (
             SELECT sha1(l_orderkey || ':') AS meter_key, l_orderkey, l_linenumber, l_shipdate AS extract_ts, row_number() OVER (
               PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC) AS rn FROM lineitem) s
           JOIN lnk_site_meter k ON s.meter_key = k.meter_key WHERE rn = 1""",
        "lnk_site_meter",
    ),
)
def sat_link_clustered(t: Tables):
    """The newest version of each key, joined to its link, on tables clustered by the key."""
    return clustered_join(t, 8)


def clustered_join(t: Tables, buckets: int):
    sat = t.lineitem.select(hash_key("l_orderkey").alias("meter_key"), "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("extract_ts"))
    buckets = sink.bucket_count(t.lineitem, t.lnk_site_meter, least=buckets)
    sat = sink.write_clustered(sat, unique("sat"), new_work_path(t.spark, "sat"), "meter_key", buckets)
    link = sink.write_clustered(t.lnk_site_meter, unique("link"), new_work_path(t.spark, "link"), "meter_key", buckets)
    latest = first_per_key(sat, ["meter_key"], newest("extract_ts", "l_linenumber"))
    return latest.join(link, "meter_key").select("site_key", "l_orderkey", "l_linenumber", "extract_ts")
