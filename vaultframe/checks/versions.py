"""Version operators and ordered windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultframe.adapters import LSAT_KEYS, LSAT_TIES, Tables
from vaultframe.checks.registry import check, with_roles
from vaultframe.operators import versions, windows
from vaultframe.operators.versions import newest, oldest

SAT_SQL = "event_id, user_id, event_type, value, extract_ts, change_type"
SAT_OUT = ["event_id", "user_id", "event_type", "value", "extract_ts", "change_type"]
LSAT_OUT = ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "extract_ts", "ab", "bis"]
LSAT_SQL = ", ".join(LSAT_OUT)
TIES_SQL = ", ".join(f"{c} DESC" for c in LSAT_TIES)


def lsat_order():
    return newest("extract_ts", *LSAT_TIES)



def top1(role: str, out: str, keys: str, order: str, pre: str = "true", post: str = "true") -> str:
    return with_roles(
        f"""SELECT {out} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn
            FROM {role} WHERE {pre}) WHERE rn = 1 AND {post}""",
        role,
    )


LSAT_BY = f"extract_ts DESC, {TIES_SQL}"


@check("current_version", top1("lsat", LSAT_SQL, "l_orderkey, l_linenumber", LSAT_BY))
def current_version(t: Tables):
    return versions.current_version(t.lsat, LSAT_KEYS, lsat_order()).select(*LSAT_OUT)


@check("current_per_slice", top1("lsat", LSAT_SQL, "l_orderkey, l_linenumber, ab", LSAT_BY))
def current_per_slice(t: Tables):
    return versions.current_version(t.lsat, [*LSAT_KEYS, "ab"], lsat_order()).select(*LSAT_OUT)


@check("current_per_subkey", top1("lsat", LSAT_SQL, "l_orderkey, l_returnflag", f"{LSAT_BY}, l_linenumber DESC"))
def current_per_subkey(t: Tables):
    order = [*lsat_order(), *newest("l_linenumber")]
    return versions.current_version(t.lsat, ["l_orderkey", "l_returnflag"], order).select(*LSAT_OUT)


@check("live_after", top1("sat", SAT_SQL, "user_id", "extract_ts DESC, event_id DESC", post="change_type <> 'D'"))
def live_after(t: Tables):
    return versions.live(t.sat, ["user_id"], newest("extract_ts", "event_id")).select(*SAT_OUT)


@check("live_before", top1("sat", SAT_SQL, "user_id", "extract_ts DESC, event_id DESC", pre="change_type <> 'D'"))
def live_before(t: Tables):
    return versions.live(t.sat, ["user_id"], newest("extract_ts", "event_id"), "before").select(*SAT_OUT)


@check("live_all_versions", with_roles(f"SELECT {SAT_SQL} FROM sat WHERE change_type <> 'D'", "sat"))
def live_all_versions(t: Tables):
    return versions.live(t.sat, ["user_id"], [], "all").select(*SAT_OUT)


@check(
    "filter_before_rank",
    top1("sat", SAT_SQL, "user_id", "extract_ts DESC, event_id DESC", pre="event_type IN ('click', 'view')"),
)
def filter_before_rank(t: Tables):
    kinds = F.col("event_type").isin("click", "view")
    return versions.current_version(t.sat, ["user_id"], newest("extract_ts", "event_id"), pre=kinds).select(*SAT_OUT)


@check(
    "filter_after_rank",
    top1("sat", SAT_SQL, "user_id", "extract_ts DESC, event_id DESC", post="event_type IN ('click', 'view')"),
)
def filter_after_rank(t: Tables):
    kinds = F.col("event_type").isin("click", "view")
    return versions.current_version(t.sat, ["user_id"], newest("extract_ts", "event_id"), post=kinds).select(*SAT_OUT)


@check("current_by_version_no", top1("sat", SAT_SQL, "user_id, event_type", "event_id DESC"))
def current_by_version_no(t: Tables):
    return versions.current_version(t.sat, ["user_id", "event_type"], newest("event_id")).select(*SAT_OUT)


@check(
    "current_with_ties",
    top1("lsat", LSAT_SQL, "l_orderkey, l_linenumber", "l_returnflag, extract_ts DESC, l_partkey, l_suppkey, l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC"),
)
def current_with_ties(t: Tables):
    order = [
        *oldest("l_returnflag"),
        *newest("extract_ts"),
        *oldest("l_partkey", "l_suppkey"),
        *newest("l_extendedprice", "l_quantity", "l_discount", "l_tax"),
    ]
    return versions.current_version(t.lsat, LSAT_KEYS, order).select(*LSAT_OUT)


@check("current_per_day", top1("sat", SAT_SQL, "user_id, extract_ts::DATE", "extract_ts DESC, event_id DESC"))
def current_per_day(t: Tables):
    return versions.current_per_day(t.sat, ["user_id"], "extract_ts", ["event_id"]).select(*SAT_OUT)


@check(
    "validity_periods",
    with_roles(
        """SELECT user_id, event_id, strftime(extract_ts, '%Y%m%d') AS valid_from,
                  coalesce(lead(strftime(extract_ts, '%Y%m%d')) OVER (PARTITION BY user_id ORDER BY extract_ts), '99991231') AS valid_to
           FROM (SELECT *, row_number() OVER (PARTITION BY user_id, extract_ts::DATE ORDER BY extract_ts DESC, event_id DESC) AS rn FROM sat)
           WHERE rn = 1""",
        "sat",
    ),
)
def validity_periods(t: Tables):
    daily = versions.current_per_day(t.sat, ["user_id"], "extract_ts", ["event_id"])
    periods = versions.validity_from_versions(daily, ["user_id"], "extract_ts", text=True, daily=True)
    return periods.select("user_id", "event_id", "valid_from", "valid_to")


@check(
    "dedup_chain",
    with_roles(
        """SELECT meter_id, site_key, l_linenumber, extract_ts FROM (
             SELECT h.meter_id, k.site_key, s.l_linenumber, s.extract_ts,
                    row_number() OVER (PARTITION BY k.site_key ORDER BY s.extract_ts DESC, h.meter_id DESC, s.l_linenumber DESC) AS rn2
             FROM (SELECT *, sha1(l_orderkey || ':') AS meter_key,
                          row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY """
        + LSAT_BY
        + """) AS rn FROM lsat) s
             JOIN lnk_site_meter k ON s.meter_key = k.meter_key JOIN hub_meter h ON s.meter_key = h.meter_key
             WHERE s.rn = 1) WHERE rn2 = 1""",
        "lsat",
        "lnk_site_meter",
        "hub_meter",
    ),
)
def dedup_chain(t: Tables):
    from vaultframe.functions.keys import hash_key

    lines = versions.current_version(t.lsat, LSAT_KEYS, lsat_order())
    lines = lines.select(hash_key("l_orderkey").alias("meter_key"), "l_linenumber", "extract_ts")
    joined = lines.join(t.lnk_site_meter.select("site_key", "meter_key"), "meter_key").join(t.hub_meter, "meter_key")
    order = newest("extract_ts", "meter_id", "l_linenumber")
    return versions.current_version(joined, ["site_key"], order).select(
        "meter_id", "site_key", "l_linenumber", "extract_ts"
    )


@check(
    "eav_pivot",
    with_roles(
        """SELECT user_id, max(value) FILTER (fname = 'click') AS click, max(value) FILTER (fname = 'view') AS view,
                  max(value) FILTER (fname = 'signup') AS signup
           FROM (SELECT *, row_number() OVER (PARTITION BY user_id, fname ORDER BY extract_ts DESC) AS rn FROM eav)
           WHERE rn = 1 AND fname IN ('click', 'view', 'signup') GROUP BY user_id""",
        "eav",
    ),
)
def eav_pivot(t: Tables):
    latest = versions.current_version(t.eav, ["user_id", "fname"], newest("extract_ts"))
    return versions.eav_columns(latest, ["user_id"], ["click", "view", "signup"])


@check(
    "eav_attribute",
    with_roles("SELECT user_id, value AS spend, ab AS spend_from, bis AS spend_to FROM eav WHERE fname = 'purchase'", "eav"),
)
def eav_attribute(t: Tables):
    return versions.eav_attribute(t.eav, ["user_id"], "purchase", "spend")


@check(
    "top2_values",
    """SELECT o_custkey, first_value, second_value FROM (
         SELECT o_custkey, o_orderkey AS first_value, lead(o_orderkey) OVER w AS second_value, row_number() OVER w AS rn
         FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC)) WHERE rn = 1""",
)
def top2_values(t: Tables):
    pairs = versions.top2_values(
        t.orders, ["o_custkey"], "o_orderkey", newest("o_totalprice", "o_orderkey"), ("first_value", "second_value")
    )
    return pairs.select("o_custkey", "first_value", "second_value")


@check(
    "win_row_number",
    """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events""",
)
def win_row_number(t: Tables):
    rows = t.events.select("event_id", "user_id", "ts")
    return windows.row_numbers(
        rows, ["user_id"], ["ts", "event_id"], "rn", ascending=False
    ).select("event_id", "user_id", "rn")


@check(
    "win_rank",
    """SELECT o_orderkey, o_custkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE) AS rk FROM orders""",
)
def win_rank(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return windows.ranks(rows, ["o_custkey"], ["day"], "rk").select(
        "o_orderkey", "o_custkey", "rk"
    )


@check(
    "win_lead",
    """SELECT event_id, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next_ts,
              lead(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS next_type FROM events""",
)
def win_lead(t: Tables):
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    wanted = {"next_ts": "ts", "next_type": "event_type"}
    return windows.next_value(rows, ["user_id"], ["ts"], wanted).select(
        "event_id", "next_ts", "next_type"
    )


@check(
    "win_lag",
    """SELECT event_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS last_ts,
              lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS last_value FROM events""",
)
def win_lag(t: Tables):
    rows = t.events.select("event_id", "user_id", "value", "ts")
    wanted = {"last_ts": "ts", "last_value": "value"}
    return windows.previous_value(rows, ["user_id"], ["ts"], wanted).select(
        "event_id", "last_ts", "last_value"
    )


@check(
    "win_running_min_max",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
              min(l_quantity) OVER w AS low_qty, max(l_quantity) OVER w AS high_qty
       FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate)""",
)
def win_running_min_max(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
    out = windows.running_extremes(
        rows,
        ["l_suppkey"],
        ["l_shipdate"],
        {"low_qty": "l_quantity"},
        {"high_qty": "l_quantity"},
    )
    return out.drop("l_suppkey", "l_quantity")
