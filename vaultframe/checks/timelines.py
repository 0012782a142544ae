"""Timeline operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultframe.adapters import Tables
from vaultframe.checks.registry import check, with_roles
from vaultframe.functions import dates
from vaultframe.operators import timeline, windows
from vaultframe.operators.versions import newest
from vaultframe.session import stage

PERIOD = ["p_from", "p_to"]
CUTTING = {
    "days": "SELECT DISTINCT site, unnest([p_from, p_to]) AS day FROM dated",
    "cuts": "SELECT site, day AS from_dt, lead(day) OVER (PARTITION BY site ORDER BY day) AS to_dt FROM days",
    "kept": "SELECT * FROM cuts WHERE date_diff('day', from_dt, to_dt) > 1",
    "clean": """SELECT site, from_dt, CASE WHEN lead(from_dt) OVER (PARTITION BY site ORDER BY from_dt) = to_dt
        THEN to_dt - 1 ELSE to_dt END AS to_dt FROM kept""",
}
FIRST_TWO = {k: CUTTING[k] for k in ("days", "cuts")}


@check("boundaries", with_roles("SELECT site, day FROM days", "dated", days=CUTTING["days"]))
def boundaries(t: Tables):
    return timeline.boundaries(t.dated, ["site"], PERIOD)


@check("slices", with_roles("SELECT * FROM cuts", "dated", **FIRST_TWO))
def slices(t: Tables):
    return timeline.slices(timeline.boundaries(t.dated, ["site"], PERIOD), ["site"])


@check("clean_slices", with_roles("SELECT * FROM clean", "dated", **CUTTING))
def clean_slices(t: Tables):
    return timeline.timeline([(t.dated, PERIOD)], ["site"])


@check(
    "clean_slices_min_end",
    with_roles(
        "SELECT * FROM clean",
        "dated",
        **{**CUTTING, "kept": CUTTING["kept"] + " AND to_dt >= DATE '1999-06-30'"},
    ),
)
def clean_slices_min_end(t: Tables):
    return timeline.timeline([(t.dated, PERIOD)], ["site"], min_end="1999-06-30")


@check(
    "closed_end",
    """SELECT event_id, CASE WHEN d = DATE '9999-12-31' THEN d ELSE d - 1 END AS end_less_1, d AS end_less_0
       FROM (SELECT event_id, coalesce(lead(ts::DATE) OVER (PARTITION BY user_id ORDER BY ts), DATE '9999-12-31') AS d FROM events)""",
)
def closed_end(t: Tables):
    rows = t.events.select("event_id", "user_id", "ts")
    rows = windows.next_value(rows, ["user_id"], ["ts"], {"eff_end": "ts"})
    return rows.select(
        "event_id", dates.closed_end("eff_end", 1).alias("end_less_1"), dates.closed_end("eff_end", 0).alias("end_less_0")
    )


ATTRIBUTES = {
    "urgent": "SELECT site, val AS urgent, p_from AS urgent_from, p_to AS urgent_to FROM dated WHERE attribute = '1-URGENT'",
    "high": "SELECT site, val AS high, p_from AS high_from, p_to AS high_to FROM dated WHERE attribute = '2-HIGH'",
    "low": "SELECT site, val AS low, p_from AS low_from, p_to AS low_to FROM dated WHERE attribute = '5-LOW'",
}
SLICED_SQL = """SELECT c.site, c.from_dt, c.to_dt, l.low, l.low_from, l.low_to, u.urgent, u.urgent_from, u.urgent_to,
        h.high, h.high_from, h.high_to
    FROM clean c JOIN low l ON c.site = l.site AND l.low_to > c.from_dt AND l.low_from < c.to_dt
    LEFT JOIN urgent u ON c.site = u.site AND u.urgent_to > c.from_dt AND u.urgent_from < c.to_dt
    LEFT JOIN high h ON c.site = h.site AND h.high_to > c.from_dt AND h.high_from < c.to_dt"""


def sliced(t: Tables):
    cuts = stage(timeline.timeline([(t.dated, PERIOD)], ["site"]), "slices")
    parts = [("5-LOW", "low", "inner"), ("1-URGENT", "urgent", "left"), ("2-HIGH", "high", "left")]
    attributes = [(t.attribute(p, n), (f"{n}_from", f"{n}_to"), how) for p, n, how in parts]
    return timeline.time_slice(cuts, ["site"], attributes)


@check("time_slice", with_roles(SLICED_SQL, "dated", **CUTTING, **ATTRIBUTES))
def time_slice(t: Tables):
    return sliced(t)


@check(
    "dedup_slices",
    with_roles(
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY site, from_dt
             ORDER BY urgent DESC NULLS LAST, high DESC NULLS LAST, low DESC) AS rn FROM sliced) WHERE rn = 1""",
        "dated",
        **CUTTING,
        **ATTRIBUTES,
        sliced=SLICED_SQL,
    ),
)
def dedup_slices(t: Tables):
    return timeline.dedup_slices(sliced(t), ["site", "from_dt"], newest("urgent", "high", "low"))


@check(
    "rank_slices",
    with_roles(
        """SELECT * EXCLUDE (rk) FROM (SELECT *, rank() OVER (PARTITION BY site
             ORDER BY urgent_from DESC NULLS LAST, high_from DESC NULLS LAST) AS rk FROM sliced) WHERE rk = 1""",
        "dated",
        **CUTTING,
        **ATTRIBUTES,
        sliced=SLICED_SQL,
    ),
)
def rank_slices(t: Tables):
    return timeline.rank_slices(sliced(t), ["site"], newest("urgent_from", "high_from"))


ARRAY_SQL = {
    "rows0": """SELECT *, list_min([bis, removal]) AS min_to FROM (
        SELECT l_partkey AS site, l_suppkey AS meter, l_orderkey, l_linenumber, ab, bis, min(ab) OVER w AS install, max(bis) OVER w AS removal
        FROM lsat WINDOW w AS (PARTITION BY l_partkey, l_suppkey))""",
    "rows1": "SELECT * FROM rows0 WHERE ab <= min_to AND install <= min_to",
    "rows2": """SELECT *, lag(min_to) OVER (PARTITION BY site, meter ORDER BY min_to, ab, l_orderkey, l_linenumber) AS last_to,
        list_sort([ab, install], 'ASC', 'NULLS LAST') AS a FROM rows1""",
    "rows3": """SELECT site, meter, l_orderkey, l_linenumber, install, removal, CASE WHEN a[1] > last_to THEN a[1]
        WHEN a[2] > last_to THEN a[2] ELSE a[1] END AS timeline_from,
        CASE WHEN min_to > removal THEN removal ELSE min_to END AS timeline_to FROM rows2""",
}


def meter_rows(t: Tables):
    lines = t.lsat.select(
        F.col("l_partkey").alias("site"), F.col("l_suppkey").alias("meter"), "l_orderkey", "l_linenumber", "ab", "bis"
    )
    spans = timeline.span(lines, ["site", "meter"], "ab", "bis").withColumnsRenamed({"ab": "install", "bis": "removal"})
    rows = stage(lines.join(spans, ["site", "meter"]), "rows")
    return timeline.array_timeline(
        rows,
        ["site", "meter"],
        ["ab", "install"],
        ["bis", "removal"],
        "removal",
        ["ab", "l_orderkey", "l_linenumber"],
        F.substring("min_to", 1, 6),
    ).select("site", "meter", "l_orderkey", "l_linenumber", "install", "removal", "timeline_from", "timeline_to")


@check("array_timeline", with_roles("SELECT * FROM rows3", "lsat", **ARRAY_SQL))
def array_timeline(t: Tables):
    return meter_rows(t)


@check(
    "leading_gap",
    """SELECT o_custkey, DATE '1995-01-01' AS from_dt, min(o_orderdate)::DATE - 1 AS to_dt FROM orders GROUP BY o_custkey""",
)
def leading_gap(t: Tables):
    rows = t.orders.select("o_custkey", dates.day_lit("1995-01-01").alias("opened"), F.col("o_orderdate").cast("date").alias("day"))
    return timeline.leading_gap(rows, ["o_custkey"], "opened", "day")


SPAN_SQL = """SELECT holder, device, min(a) AS start_dt, max(b) AS end_dt FROM (
      SELECT l_partkey AS holder, l_suppkey AS device, min(ab) AS a, max(bis) AS b FROM lsat WHERE l_linestatus = 'F' GROUP BY 1, 2
      UNION SELECT l_partkey, l_suppkey, min(ab), max(bis) FROM lsat WHERE l_linestatus = 'O' GROUP BY 1, 2) GROUP BY 1, 2"""


@check("span_collapse", with_roles(SPAN_SQL, "lsat"))
def span_collapse(t: Tables):
    rows = t.lsat.select(
        F.col("l_partkey").alias("holder"),
        F.col("l_suppkey").alias("device"),
        F.col("ab").alias("start_dt"),
        F.col("bis").alias("end_dt"),
        "l_linestatus",
    )
    keys = ["holder", "device"]
    per_class = [
        timeline.span(rows.filter(F.col("l_linestatus") == kind), keys, "start_dt", "end_dt") for kind in ("F", "O")
    ]
    return timeline.span(per_class[0].unionByName(per_class[1]), keys, "start_dt", "end_dt")


@check(
    "interval_keys",
    with_roles(
        """SELECT channel_id, interval_end, extract_ts, (interval_end - to_minutes(30))::DATE AS read_date,
                  CAST(strftime(interval_end - to_minutes(30), '%Y%m%d') AS INT) AS read_dt,
                  CAST(trunc((epoch(interval_end) - epoch((interval_end - to_minutes(30))::DATE)) / interval_len) AS INT) AS interval_seq_num
           FROM reads""",
        "reads",
    ),
)
def interval_keys(t: Tables):
    return timeline.interval_keys(t.reads, "interval_end", "interval_len").select(
        "channel_id", "interval_end", "extract_ts", "read_date", "read_dt", "interval_seq_num"
    )
