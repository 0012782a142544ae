"""Checks over tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultframe.adapters import LSAT_KEYS, RUN_EVENTS, Tables
from vaultframe.checks.registry import check, with_roles
from vaultframe.functions.keys import audit_hash, hash_key
from vaultframe.operators import digests, quality, versions
from vaultframe.operators.versions import newest
from vaultframe.session import new_work_path
from vaultframe.sources import footers

COUNTED = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()


@check("count_tables", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in COUNTED))
def count_tables(t: Tables):
    return quality.count_tables({name: t.read(name) for name in COUNTED})


@check("count_tables_footers", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in COUNTED))
def count_tables_footers(t: Tables):
    return footers.footer_counts(t.spark, {name: f"{t.sf_dir}/{name}.parquet" for name in COUNTED})


KEYED = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey", "lineitem": "l_orderkey"}


@check(
    "key_extremes",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, min({c}) AS lowest, max({c}) AS highest FROM {n}" for n, c in KEYED.items()),
)
def key_extremes(t: Tables):
    return footers.footer_extremes(t.spark, {name: (f"{t.sf_dir}/{name}.parquet", c) for name, c in KEYED.items()})


VARIANT = "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem"


@check(
    "differing_keys",
    f"""WITH a AS ({VARIANT}), b AS (
          SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 97 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_returnflag
          FROM a WHERE l_orderkey % 101 <> 0 OR l_linenumber <> 1)
        SELECT l_orderkey, count(*) FILTER (side = 'a') AS rows_a, count(*) FILTER (side = 'b') AS rows_b
        FROM (SELECT 'a' AS side, * FROM a UNION ALL SELECT 'b', * FROM b)
        WHERE l_orderkey IN (SELECT l_orderkey FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
                             UNION SELECT l_orderkey FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))
        GROUP BY l_orderkey""",
)
def differing_keys(t: Tables):
    first = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    raised = F.when(F.col("l_orderkey") % 97 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    second = first.filter("l_orderkey % 101 <> 0 OR l_linenumber <> 1").withColumn("l_quantity", raised)
    return digests.differing_keys(first, second, ["l_orderkey"])


@check(
    "count_live",
    with_roles(
        """SELECT 'sat' AS table_name, count(*) AS row_count FROM sat WHERE change_type <> 'D'
           UNION ALL SELECT 'lsat', count(*) FROM lsat WHERE l_returnflag <> 'R'""",
        "sat",
        "lsat",
    ),
)
def count_live(t: Tables):
    lsat = t.lsat.select(F.when(F.col("l_returnflag") == "R", "D").otherwise("U").alias("change_type"))
    return quality.count_tables({"sat": t.sat, "lsat": lsat}, where=versions.not_deleted())


@check(
    "freshness",
    with_roles(
        "SELECT 'sat' AS table_name, max(extract_ts) AS max_extract FROM sat UNION ALL SELECT 'lsat', max(extract_ts) FROM lsat",
        "sat",
        "lsat",
    ),
)
def freshness(t: Tables):
    return quality.freshness({"sat": t.sat, "lsat": t.lsat}, "extract_ts")


@check(
    "compare_variants",
    with_roles(
        """SELECT (SELECT count(*) FROM a) AS rows_a, (SELECT count(*) FROM b) AS rows_b,
                  (SELECT count(*) FROM a WHERE user_id NOT IN (SELECT user_id FROM b)) AS keys_only_a,
                  (SELECT count(*) FROM b WHERE user_id NOT IN (SELECT user_id FROM a)) AS keys_only_b""",
        "sat",
        a="""SELECT user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY extract_ts DESC) AS rn
             FROM sat WHERE event_type IN ('click', 'view')) WHERE rn = 1""",
        b="""SELECT user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY extract_ts DESC) AS rn
             FROM sat) WHERE rn = 1 AND event_type IN ('click', 'view')""",
    ),
)
def compare_variants(t: Tables):
    kinds = F.col("event_type").isin("click", "view")
    order = newest("extract_ts", "event_id")
    before = versions.current_version(t.sat, ["user_id"], order, pre=kinds)
    after = versions.current_version(t.sat, ["user_id"], order, post=kinds)
    return quality.compare(before, after, ["user_id"])


@check(
    "audit_on_load",
    with_roles(
        """SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey % 10 = 0) AS wrong_hash,
             count(*) FILTER (o_orderstatus NOT LIKE 'F%') AS unexpected, count(*) FILTER (length(o_orderpriority) > 8) AS too_long,
             count(*) FILTER (o_orderkey % 7 = 0) AS missing FROM orders""",
    ),
)
def audit_on_load(t: Tables):
    """Four audits ride along with the write that loads the table."""
    spoilt = F.when(F.col("o_orderkey") % 10 == 0, F.lit("x")).otherwise(hash_key("o_custkey"))
    rows = t.orders.withColumn("site_key", spoilt).withColumn("clerk", F.when(F.col("o_orderkey") % 7 != 0, F.lit("c")))
    audits = {
        "wrong_hash": quality.wrong_hash("site_key", ["o_custkey"]),
        "unexpected": quality.unexpected("o_orderstatus", "F%"),
        "too_long": quality.too_long({"o_orderpriority": 8, "o_custkey": 20}),
        "missing": quality.missing(["o_custkey", "clerk"]),
    }
    told = quality.audit_on_load(rows, audits, lambda df: df.write.parquet(new_work_path(t.spark, "audited")))
    return t.spark.createDataFrame([(told.pop("rows"), *told.values())], f"n_rows long, {', '.join(f'{n} long' for n in audits)}")


@check(
    "audit_hash",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN sha1(o_custkey || '') ELSE sha1(o_custkey || ':') END AS site_key
       FROM orders WHERE o_orderstatus = 'P'""",
)
def audit_hash_check(t: Tables):
    wrong = F.sha1(F.col("o_custkey").cast("string"))
    stored = t.orders.select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") == "P", wrong).otherwise(hash_key("o_custkey")).alias("site_key"),
    )
    return audit_hash(stored, "site_key", ["o_custkey"])


@check(
    "domain_audit",
    "SELECT source, count(*) AS row_count, source LIKE 'web%' AS expected FROM documents GROUP BY source",
)
def domain_audit(t: Tables):
    return quality.domain_audit(t.documents, "source", "web%")


@check(
    "length_audit",
    "SELECT page_id, url FROM pages WHERE length(url) > 40 OR length(CAST(page_id AS VARCHAR)) > 2",
)
def length_audit(t: Tables):
    return quality.length_audit(t.pages.select("page_id", "url"), {"url": 40, "page_id": 2})


@check(
    "null_audit",
    with_roles("SELECT component_id, clone_id, parent_id FROM tree WHERE clone_id IS NULL OR parent_id IS NULL", "tree"),
)
def null_audit(t: Tables):
    return quality.null_audit(t.tree.select("component_id", "clone_id", "parent_id"), ["clone_id", "parent_id"])
