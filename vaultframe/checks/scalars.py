"""Filters, projections, scalar families, keys, geometry and plain aggregates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from vaultframe.adapters import COMMS_GROUPS, RUN_EVENTS, RUN_ORDERS, Tables
from vaultframe.checks.registry import check, with_roles
from vaultframe.functions import columns, dates, geometry, keys
from vaultframe.operators import quality, windows

LSAT_OUT = ["l_orderkey", "l_linenumber", "l_partkey", "extract_ts", "ab", "bis"]
LSAT_SQL = "l_orderkey, l_linenumber, l_partkey, extract_ts, ab, bis"


@check("as_of_inclusive", with_roles(f"SELECT {LSAT_SQL} FROM lsat WHERE extract_ts < TIMESTAMP '1999-07-01'", "lsat"))
def as_of_inclusive(t: Tables):
    return dates.as_of(t.lsat, RUN_ORDERS, "extract_ts").select(*LSAT_OUT)


@check("as_of_strict", with_roles(f"SELECT {LSAT_SQL} FROM lsat WHERE extract_ts < TIMESTAMP '1999-06-30'", "lsat"))
def as_of_strict(t: Tables):
    return dates.as_of(t.lsat, RUN_ORDERS, "extract_ts", inclusive=False).select(*LSAT_OUT)


@check(
    "effective_on",
    with_roles(
        f"""SELECT {LSAT_SQL} FROM lsat WHERE DATE '1999-06-30'
            BETWEEN try_strptime(ab, '%Y%m%d')::DATE AND try_strptime(bis, '%Y%m%d')::DATE""",
        "lsat",
    ),
)
def effective_on(t: Tables):
    return dates.effective_on(t.lsat, RUN_ORDERS, "ab", "bis").select(*LSAT_OUT)


@check("open_only", with_roles(f"SELECT {LSAT_SQL} FROM lsat WHERE bis = '99991231'", "lsat"))
def open_only(t: Tables):
    return dates.open_only(t.lsat, "bis").select(*LSAT_OUT)


@check(
    "scan_window",
    """SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND ts < TIMESTAMP '2024-01-25'""",
)
def scan_window(t: Tables):
    return dates.scan_window(t.events, "ts", RUN_EVENTS, before=4, after=4).select("event_id", "user_id", "ts")


@check(
    "incremental_window",
    with_roles(
        """SELECT event_id, extract_ts, load_ts FROM sat
           WHERE extract_ts BETWEEN TIMESTAMP '2024-01-20 00:00:00' AND TIMESTAMP '2024-01-20 08:00:00'
              OR load_ts + INTERVAL 10 HOUR BETWEEN TIMESTAMP '2024-01-20 00:00:00' AND TIMESTAMP '2024-01-20 08:00:00'""",
        "sat",
    ),
)
def incremental_window(t: Tables):
    end = datetime(2024, 1, 20, 8)
    return dates.incremental_window(t.sat, end, 8, "extract_ts", "load_ts").select("event_id", "extract_ts", "load_ts")


@check("retain_days", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1999-06-30' - 761")
def retain_days(t: Tables):
    return dates.retain_days(t.orders, "o_orderdate", RUN_ORDERS, 761).select("o_orderkey", "o_orderdate")


@check(
    "code_filter",
    """SELECT c_custkey, c_mktsegment, upper(trim(c_mktsegment)) NOT IN ('BUILDING') AS other
       FROM customer WHERE trim(upper(c_mktsegment)) IN ('BUILDING', 'MACHINERY')""",
)
def code_filter(t: Tables):
    kept = t.customer.filter(columns.code_in("c_mktsegment", ["BUILDING", "MACHINERY"]))
    return kept.select(
        "c_custkey", "c_mktsegment", columns.code_in("c_mktsegment", ["BUILDING"], negate=True).alias("other")
    )


@check("not_blank", with_roles("SELECT * FROM blanks WHERE length(trim(quality)) > 0", "blanks"))
def not_blank(t: Tables):
    return t.blanks.filter(columns.not_blank("quality"))


@check(
    "like_filter",
    """SELECT p_partkey, p_name, p_type FROM part
       WHERE (upper(p_type) LIKE 'STANDARD%' OR upper(p_type) LIKE '%MALL%') AND p_brand NOT LIKE 'Brand#1%'""",
)
def like_filter(t: Tables):
    wanted = columns.like_any("p_type", ["STANDARD%", "%MALL%"]) & ~F.col("p_brand").like("Brand#1%")
    return t.part.filter(wanted).select("p_partkey", "p_name", "p_type")


@check(
    "event_code_semi",
    """SELECT event_id, user_id, event_type FROM events
       WHERE event_type IN (SELECT DISTINCT event_type FROM events WHERE value > 400)""",
)
def event_code_semi(t: Tables):
    codes = t.events.filter("value > 400").select(F.col("event_type").alias("code"))
    return columns.in_codes(t.events, "event_type", codes, "code").select("event_id", "user_id", "event_type")


@check(
    "null_if_blank",
    with_roles("SELECT doc_id, lang, nullif(trim(source), '') AS source, nullif(trim(quality), '') AS quality FROM blanks", "blanks"),
)
def null_if_blank(t: Tables):
    return columns.null_if_blank(t.blanks, ["source", "quality"])


@check(
    "decode_map",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE 'Other' END AS status,
              CASE WHEN o_orderstatus = 'P' THEN 40 END AS share FROM orders""",
)
def decode_map(t: Tables):
    return t.orders.select(
        "o_orderkey",
        columns.decode("o_orderstatus", {"F": "Finished", "O": "Open"}, "Other").alias("status"),
        columns.decode("o_orderstatus", {"P": 40}).alias("share"),
    )


@check(
    "fold_category",
    with_roles(
        """SELECT o_orderkey, module, CASE WHEN module IN ('MICROAP', 'MESH') THEN 'MESH'
           WHEN module IN ('3G', 'WIMAX') THEN 'WIMAX' END AS network FROM comms""",
        "comms",
    ),
)
def fold_category(t: Tables):
    return t.comms.select("o_orderkey", "module", columns.fold_category("module", COMMS_GROUPS).alias("network"))


@check(
    "default_end",
    """SELECT user_id, ts, coalesce(lead(ts::DATE) OVER (PARTITION BY user_id ORDER BY ts), DATE '9999-12-31') AS end_day,
              coalesce(strftime(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), '%Y%m%d'), '99991231') AS end_text
       FROM events""",
)
def default_end(t: Tables):
    rows = t.events.select("user_id", "ts")
    rows = windows.next_value(rows, ["user_id"], ["ts"], {"next_ts": "ts"})
    return rows.select(
        "user_id",
        "ts",
        dates.default_end(F.col("next_ts").cast("date")).alias("end_day"),
        dates.default_end(dates.day_text("next_ts"), text=True).alias("end_text"),
    )


@check(
    "recency_flag",
    "SELECT event_id, CASE WHEN ts::DATE >= DATE '2024-01-15' THEN 'Y' ELSE 'N' END AS fresh FROM events",
)
def recency_flag(t: Tables):
    return t.events.select("event_id", dates.recency_flag("ts", RUN_EVENTS, 5).alias("fresh"))


@check(
    "floor_date",
    """SELECT o_orderkey, CASE WHEN o_orderdate::DATE < DATE '1997-01-01' THEN DATE '1997-01-01'
              ELSE o_orderdate::DATE END AS start_dt FROM orders""",
)
def floor_date(t: Tables):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", dates.floor_date(day, "1997-01-01").alias("start_dt"))


@check(
    "stamp_columns",
    """SELECT c_custkey, 'CUSTOMER_FEED' AS record_source, DATE '1999-06-30' AS run_date,
              '1999-07-01 07:30:00' AS row_insert_dtm FROM customer""",
)
def stamp_columns(t: Tables):
    now = datetime(1999, 6, 30, 21, 30)
    return columns.stamp(t.customer.select("c_custkey"), RUN_ORDERS, "CUSTOMER_FEED", now)


@check(
    "feed_layout",
    """SELECT event_id AS event_log_id, event_type AS event_cd, ts AS event_dtm, value AS event_val, props AS event_args,
              events.* FROM events""",
)
def feed_layout(t: Tables):
    return t.events.select(
        F.col("event_id").alias("event_log_id"),
        F.col("event_type").alias("event_cd"),
        F.col("ts").alias("event_dtm"),
        F.col("value").alias("event_val"),
        F.col("props").alias("event_args"),
        "*",
    )


@check(
    "point_lookup",
    """SELECT o_orderkey, sha1(o_custkey || ':') AS site_key, o_orderstatus FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def point_lookup(t: Tables):
    wanted = t.customer.filter("c_mktsegment = 'BUILDING'").select(keys.hash_key("c_custkey").alias("site_key"))
    keyed = t.orders.select("o_orderkey", keys.hash_key("o_custkey").alias("site_key"), "o_orderstatus")
    return columns.lookup(keyed, "site_key", wanted)


# --- scalar families -------------------------------------------------------


@check(
    "fn_dates",
    """SELECT l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y%m%d') AS day_text,
              strptime(strftime(l_shipdate, '%Y%m%d'), '%Y%m%d')::DATE AS day,
              l_shipdate::DATE - 30 AS month_back, l_shipdate::DATE + 7 AS week_on,
              date_diff('day', DATE '1995-01-01', l_shipdate::DATE)::INT AS day_no,
              CAST((l_shipdate::DATE - INTERVAL 2 MONTH) AS DATE) AS two_months_back,
              CASE WHEN l_returnflag = 'R' THEN try_strptime('00000000', '%Y%m%d')::DATE ELSE l_shipdate::DATE END AS bad_day
       FROM lineitem""",
)
def fn_dates(t: Tables):
    day = F.col("l_shipdate").cast("date")
    text = F.when(F.col("l_returnflag") == "R", "00000000").otherwise(dates.day_text("l_shipdate"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        dates.day_text("l_shipdate").alias("day_text"),
        dates.parse_day(dates.day_text("l_shipdate")).alias("day"),
        F.date_sub(day, 30).alias("month_back"),
        F.date_add(day, 7).alias("week_on"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("day_no"),
        F.add_months(day, -2).alias("two_months_back"),
        dates.parse_day(text).alias("bad_day"),
    )


@check(
    "fn_timestamps",
    """SELECT event_id, ts + INTERVAL 10 HOUR AS fixed_local,
              timezone('Australia/Melbourne', timezone('UTC', ts)) AS dst_local,
              ts - to_minutes(90) AS earlier, floor(epoch(ts))::BIGINT AS unix_s,
              strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
              strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed FROM events""",
)
def fn_timestamps(t: Tables):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t.events.select(
        "event_id",
        dates.to_zone("ts", "+10:00").alias("fixed_local"),
        dates.to_zone("ts", "Australia/Melbourne").alias("dst_local"),
        (F.col("ts") - F.make_dt_interval(mins=F.lit(90))).alias("earlier"),
        F.unix_timestamp("ts").alias("unix_s"),
        text.alias("ts_text"),
        F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss")).alias("parsed"),
    )


@check(
    "fn_strings",
    """SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, length(p_name)::INT AS name_len, upper(p_name) AS up,
              lower(p_brand) AS low, substr(p_type, 1, 8) AS head8, split_part(p_name, ' ', 1) AS first_word,
              string_split(p_name, ' ')[-1] AS last_word, regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits,
              replace(p_brand, '#', '') AS no_hash, p_brand || '-' || p_size AS joined FROM part""",
)
def fn_strings(t: Tables):
    return t.part.select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.length("p_name").alias("name_len"),
        F.upper("p_name").alias("up"),
        F.lower("p_brand").alias("low"),
        F.substring("p_type", 1, 8).alias("head8"),
        F.substring_index("p_name", " ", 1).alias("first_word"),
        F.substring_index("p_name", " ", -1).alias("last_word"),
        F.regexp_replace("p_brand", "[^0-9]", "").alias("digits"),
        F.replace("p_brand", F.lit("#"), F.lit("")).alias("no_hash"),
        F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string")).alias("joined"),
    )


@check(
    "fn_arrays",
    """SELECT o_orderkey, list_min(a) AS smallest, list_sort(a, 'ASC', 'NULLS LAST')[1] AS first_v,
              list_sort(a, 'ASC', 'NULLS LAST')[3] AS third_v, list_sort(a, 'ASC', 'NULLS LAST')[4] AS past_end
       FROM (SELECT o_orderkey, [o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 7::BIGINT END] AS a FROM orders)""",
)
def fn_arrays(t: Tables):
    items = F.array("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") == "P", F.lit(7).cast("long")))
    ordered = F.array_sort(items)
    return t.orders.select(
        "o_orderkey",
        F.array_min(items).alias("smallest"),
        F.try_element_at(ordered, F.lit(1)).alias("first_v"),
        F.try_element_at(ordered, F.lit(3)).alias("third_v"),
        F.try_element_at(ordered, F.lit(4)).alias("past_end"),
    )


@check(
    "fn_casts",
    """SELECT l_orderkey, l_linenumber, l_partkey, trunc(l_quantity)::INT AS qty_int, l_extendedprice::DECIMAL(21,6) AS price_dec,
              l_discount::DECIMAL(12,1) AS disc_dec, l_shipdate::DATE AS ship_day, l_partkey::VARCHAR AS part_text,
              l_linenumber::DOUBLE AS line_dbl, l_quantity::FLOAT AS qty_flt, 'double' AS qty_type FROM lineitem""",
)
def fn_casts(t: Tables):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_quantity").cast("int").alias("qty_int"),
        F.col("l_extendedprice").cast("decimal(21,6)").alias("price_dec"),
        F.col("l_discount").cast("decimal(12,1)").alias("disc_dec"),
        F.col("l_shipdate").cast("date").alias("ship_day"),
        F.col("l_partkey").cast("string").alias("part_text"),
        F.col("l_linenumber").cast("double").alias("line_dbl"),
        F.col("l_quantity").cast("float").alias("qty_flt"),
        F.typeof("l_quantity").alias("qty_type"),
    )


@check(
    "fn_nulls",
    with_roles(
        """SELECT doc_id, coalesce(nullif(trim(quality), ''), source) AS filled,
                  CASE WHEN nullif(trim(quality), '') IS NULL THEN 'none' ELSE 'some' END AS has_quality,
                  coalesce(nullif(trim(quality), ''), '0') AS quality_or_zero,
                  source || nullif(trim(quality), '') AS null_concat FROM blanks""",
        "blanks",
    ),
)
def fn_nulls(t: Tables):
    quality_or_null = columns.blank_to_null("quality")
    return t.blanks.select(
        "doc_id",
        F.coalesce(quality_or_null, "source").alias("filled"),
        F.when(quality_or_null.isNull(), "none").otherwise("some").alias("has_quality"),
        F.coalesce(quality_or_null, F.lit("0")).alias("quality_or_zero"),
        F.concat("source", quality_or_null).alias("null_concat"),
    )


# --- keys and geometry -----------------------------------------------------


@check(
    "hash_key",
    """SELECT o_orderkey, sha1(o_custkey || ':') AS site_key, sha1(o_orderkey || ':' || o_custkey || ':') AS link_key,
              CASE WHEN o_orderstatus = 'P' THEN NULL ELSE sha1(o_orderstatus || ':') END AS status_key FROM orders""",
)
def hash_key(t: Tables):
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return t.orders.select(
        "o_orderkey",
        keys.hash_key("o_custkey").alias("site_key"),
        keys.hash_key("o_orderkey", "o_custkey").alias("link_key"),
        keys.hash_key(status).alias("status_key"),
    )


@check(
    "hash_diff",
    with_roles(
        """SELECT doc_id, sha1(trim(coalesce(CAST(doc_id AS VARCHAR), '')) || ':' || trim(coalesce(lang, '')) || ':' ||
              trim(coalesce(source, '')) || ':' || trim(coalesce(nullif(trim(quality), ''), ''))) AS diff FROM blanks""",
        "blanks",
    ),
)
def hash_diff(t: Tables):
    diff = keys.hash_diff("doc_id", "lang", "source", columns.blank_to_null("quality"))
    return t.blanks.select("doc_id", diff.alias("diff"))


@check(
    "wkt_point",
    with_roles(
        """SELECT site, split_part(regexp_replace(location, '[POINT()]', '', 'g'), ' ', 1) AS x,
                  string_split(regexp_replace(location, '[POINT()]', '', 'g'), ' ')[-1] AS y FROM geometry""",
        "geometry",
    ),
)
def wkt_point(t: Tables):
    x, y = geometry.wkt_xy("location")
    return t.geometry.select("site", x.alias("x"), y.alias("y"))


def lcc_sql(source: str, x: str, y: str, keep: str) -> str:
    """The projection step by step over a query with columns ``x`` and ``y``."""
    steps = [
        f"g0 AS (SELECT {keep}, CAST({x} AS DOUBLE) / 1000 - 1000000 AS dx, CAST({y} AS DOUBLE) / 1000 - 1000000 AS dy FROM {source})",
        """k0 AS (SELECT sqrt(2 / 298.257222101 - pow(1 / 298.257222101, 2)) AS e)""",
        """k1 AS (SELECT e, cos(radians(-36)) / sqrt(1 - pow(e * sin(radians(-36)), 2)) AS m1,
             cos(radians(-38)) / sqrt(1 - pow(e * sin(radians(-38)), 2)) AS m2,
             tan(pi() / 4 + radians(36) / 2) / pow((1 - e * sin(radians(-36))) / (1 + e * sin(radians(-36))), e / 2) AS t1,
             tan(pi() / 4 + radians(38) / 2) / pow((1 - e * sin(radians(-38))) / (1 + e * sin(radians(-38))), e / 2) AS t2,
             tan(pi() / 4 + radians(37) / 2) / pow((1 - e * sin(radians(-37))) / (1 + e * sin(radians(-37))), e / 2) AS t0 FROM k0)""",
        "k2 AS (SELECT *, ln(m1 / m2) / ln(t1 / t2) AS n FROM k1)",
        "k3 AS (SELECT *, 6378137 * m1 / (n * pow(t1, n)) AS bf, 6378137 * m1 / (n * pow(t1, n)) * pow(t0, n) AS r0 FROM k2)",
        f"""p0 AS (SELECT g0.*, e, n, pow(-sqrt(dx * dx + (r0 - dy) * (r0 - dy)) / bf, 1 / n) AS t,
             atan2(-dx, -(r0 - dy)) AS theta FROM g0, k3)""",
        "f0 AS (SELECT *, pi() / 2 - 2 * atan(t) AS lat0 FROM p0)",
    ]
    for i in range(1, 7):
        steps.append(
            f"f{i} AS (SELECT *, pi() / 2 - 2 * atan(t * pow((1 - e * sin(lat{i - 1})) / (1 + e * sin(lat{i - 1})), e / 2)) AS lat{i} FROM f{i - 1})"
        )
    return ", ".join(steps)


@check(
    "lcc_inverse",
    "WITH xy AS ("
    + with_roles(
        """SELECT site, split_part(regexp_replace(location, '[POINT()]', '', 'g'), ' ', 1) AS x,
                  string_split(regexp_replace(location, '[POINT()]', '', 'g'), ' ')[-1] AS y FROM geometry""",
        "geometry",
    )
    + "), "
    + lcc_sql("xy", "x", "y", "site")
    + " SELECT site, round(degrees(theta / n) + 145, 6) AS lon, round(degrees(lat6), 6) AS lat FROM f6",
)
def lcc_inverse(t: Tables):
    lon, lat = geometry.lcc_inverse(*geometry.wkt_xy("location"))
    return t.geometry.select("site", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


# --- aggregates, sorts, set operations --------------------------------------


@check(
    "group_count",
    """SELECT o_orderdate::DATE AS day, o_orderstatus, count(*) AS cnt FROM orders
       GROUP BY 1, 2 ORDER BY day DESC, o_orderstatus""",
)
def group_count(t: Tables):
    grouped = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus")
    return grouped.agg(F.count(F.lit(1)).alias("cnt")).sort("day", "o_orderstatus", ascending=[False, True])


@check(
    "group_avg",
    "SELECT p_brand, round(avg(p_size), 6) AS avg_size FROM part GROUP BY p_brand ORDER BY p_brand",
)
def group_avg(t: Tables):
    return t.part.groupBy("p_brand").agg(F.round(F.avg("p_size"), 6).alias("avg_size")).sort("p_brand")


@check(
    "global_agg",
    "SELECT count(*) AS n, max(l_shipdate) AS newest, min(l_shipdate) AS oldest FROM lineitem",
)
def global_agg(t: Tables):
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("newest"), F.min("l_shipdate").alias("oldest")
    )


@check(
    "group_min_max",
    "SELECT l_partkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_partkey",
)
def group_min_max(t: Tables):
    return t.lineitem.groupBy("l_partkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )


@check("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t: Tables):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@check("group_distinct", "SELECT l_partkey, l_suppkey FROM lineitem GROUP BY l_partkey, l_suppkey")
def group_distinct(t: Tables):
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@check(
    "dup_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def dup_keys(t: Tables):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@check("global_sort", "SELECT o_custkey, o_orderdate, o_orderkey FROM orders ORDER BY 1, 2, 3")
def global_sort(t: Tables):
    return t.orders.select("o_custkey", "o_orderdate", "o_orderkey").orderBy(
        F.asc_nulls_last("o_custkey"), F.asc_nulls_last("o_orderdate"), F.asc_nulls_last("o_orderkey")
    )


@check(
    "top_n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def top_n(t: Tables):
    ordered = t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey")
    return ordered.limit(100)


@check(
    "union_distinct",
    """SELECT l_partkey AS holder, l_suppkey AS device FROM lineitem WHERE l_linestatus = 'F'
       UNION SELECT l_suppkey, l_suppkey FROM lineitem WHERE l_linestatus = 'O'""",
)
def union_distinct(t: Tables):
    first = t.lineitem.filter("l_linestatus = 'F'").select(F.col("l_partkey").alias("holder"), F.col("l_suppkey").alias("device"))
    second = t.lineitem.filter("l_linestatus = 'O'").select(F.col("l_suppkey").alias("holder"), F.col("l_suppkey").alias("device"))
    return first.unionByName(second).distinct()


@check(
    "union_all",
    """SELECT o_orderkey AS id, 'order' AS kind FROM orders UNION ALL SELECT c_custkey, 'customer' FROM customer""",
)
def union_all(t: Tables):
    first = t.orders.select(F.col("o_orderkey").alias("id"), F.lit("order").alias("kind"))
    return first.unionByName(t.customer.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind")))


@check(
    "union_three",
    """SELECT o_custkey AS site, CAST(o_orderkey AS VARCHAR) AS meter, o_orderdate::DATE AS from_dt FROM orders
       UNION SELECT c_custkey, '0', DATE '1995-01-01' FROM customer
       UNION SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def union_three(t: Tables):
    first = t.orders.select(
        F.col("o_custkey").alias("site"),
        F.col("o_orderkey").cast("string").alias("meter"),
        F.col("o_orderdate").cast("date").alias("from_dt"),
    )
    second = t.customer.select(
        F.col("c_custkey").alias("site"), F.lit("0").alias("meter"), F.lit("1995-01-01").cast("date").alias("from_dt")
    )
    third = t.supplier.select(
        F.col("s_suppkey").alias("site"), F.col("s_name").alias("meter"), F.lit(None).cast("date").alias("from_dt")
    )
    return first.unionByName(second).unionByName(third).distinct()
