"""Data products about meters, channels and reads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from vaultframe.adapters import COMMS_BY_PRIORITY, RUN_EVENTS, Tables
from vaultframe.checks.registry import ROLES, check, with_roles
from vaultframe.checks.sites import NOT_BLANK, TIES, newest_ov
from vaultframe.checks.standins import AMENDED_SQL, OV_SQL, AmendedVault, Vault, key, later
from vaultframe.functions.columns import decode
from vaultframe.functions.dates import OPEN_END_TEXT, day_text
from vaultframe.plans import comms_fault as cf
from vaultframe.plans.interval_reads import interval_reads
from vaultframe.plans.meter_channels import meter_channels
from vaultframe.plans.meter_timeline import meter_timeline

RUN_ALL = "2002-12-31"

# --- communication faults ---------------------------------------------------


def module():
    return decode("pri", COMMS_BY_PRIORITY)


class Faults(Vault):
    """Raw tables of the communication-fault product."""

    def active(self):
        status = self.status.withColumn("status", F.trim("status"))
        return cf.active_meters(
            status, self.ids, self.installs, self.holdings, self.site_links, self.equipment_links,
            run_dt=RUN_EVENTS, statuses=("F", "O"),
        )

    def cards(self):
        orders = self.versions(
            order_no=F.col("seq"),
            stat=F.when(F.col("st") == "F", "I0076").otherwise("I0001"),
            inact=F.when(F.col("price") > 200000, "X").otherwise(" "),
        )

        def item(prefix: str, device):
            return self.versions(
                eq_link_key=key(prefix, "seq"),
                equipment_key=key(prefix, "seq"),
                device_key=device,
                module_type=module(),
                order_no=F.col("seq"),
                created=F.col("ab"),
            )

        def group(prefix: str, kind: str):
            return self.versions(
                group_key=key(prefix, "seq"),
                equipment_key=key(prefix, "seq"),
                logical_key=key("Q", "seq"),
                kombinat=F.lit(kind),
                ab=F.col("ab"),
                bis=F.lit(OPEN_END_TEXT),
            )

        links = self.versions(
            F.col("price") > 150000,
            salnk_key=key("SC", "seq"),
            key1=key("Q", "seq"),
            key2=key("Q", "seq"),
            ab=F.col("ab"),
            bis=F.when(F.col("pri") == "4-NOT SPECIFIED", later(500)).otherwise(OPEN_END_TEXT),
        )
        equipment = item("Z", key("D", "cust")).unionByName(item("C", key("X", "seq")))
        groups = group("Z", "Z").unionByName(group("C", "S"))
        return cf.comms_cards(orders, equipment, links, groups, self.active(), run_dt=RUN_EVENTS)

    @property
    def hub_device(self):
        own = self.t.customer.select(key("D", "c_custkey").alias("device_key"), F.col("c_name").alias("device_id"))
        relay = self.t.customer.select(key("DD", "c_custkey").alias("device_key"), F.col("c_name").alias("device_id"))
        return own.unionByName(relay)

    def intervals(self):
        def sat(kind: str, prefix: str):
            rows = self.t.events.filter(F.col("event_type") == kind)
            return rows.select(
                key(prefix, "user_id").alias("device_key"),
                F.col("ts").alias("interval_ts"),
                F.col("ts").cast("date").alias("extract_day"),
            )

        same_as = self.t.events.select(key("D", "user_id").alias("key1"), key("DD", "user_id").alias("key3"))
        return cf.device_intervals(
            sat("view", "D"), sat("click", "DD"), same_as, self.hub_device, run_dt=RUN_EVENTS, scan_days=10
        )

    def codes(self):
        attributes = self.t.lsat.select(
            key("Z", "l_orderkey").alias("equipment_key"),
            decode("l_returnflag", {"N": "READ_TYPE_CODE"}, "INSTALL").alias("fname"),
            F.concat(decode("l_linestatus", {"O": "MRAM"}, "RWD"), F.col("l_linenumber").cast("string")).alias("value"),
            "ab",
            "bis",
            "extract_ts",
            F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("seq"),
            F.lit("U").alias("change_type"),
        )
        streams = self.versions(
            link_key=key("SD", "seq"),
            data_type=F.when(F.col("price") > 80000, "I ").otherwise("B"),
            data_status=F.lit("A"),
            suffix=F.col("pri"),
        )
        links = self.ov.select(key("SD", "seq").alias("link_key"), key("D", "cust").alias("device_key"))
        devices = self.ov.select(key("D", "cust").alias("device_key"), key("Z", "seq").alias("equipment_key"))
        return cf.read_types(attributes, streams, links, devices, self.hub_device, run_dt=RUN_EVENTS)

    def details(self):
        def sat(kind: str):
            rows = self.t.events.filter(F.col("event_type") == kind)
            return rows.select(
                key("D", "user_id").alias("device_key"),
                F.concat(F.lit("mac"), F.col("event_id").cast("string")).alias("mac"),
                F.lit(kind).alias("meter_firmware"),
                F.col("props").alias("comms_firmware"),
                day_text("ts").alias("last_comms"),
                F.col("ts").alias("extract_ts"),
                F.col("event_id").alias("seq"),
            )

        return cf.device_details(sat("purchase"), sat("signup"))


MODULE_SQL = "CASE pri WHEN '1-URGENT' THEN 'MESH' WHEN '2-HIGH' THEN 'MICROAP' WHEN '3-MEDIUM' THEN 'WIMAX' WHEN '4-NOT SPECIFIED' THEN '3G' END"
FOLD = "CASE WHEN {0} IN ('MICROAP', 'MESH') THEN 'MESH' WHEN {0} IN ('3G', 'WIMAX') THEN 'WIMAX' END"
FAULT_SQL = {
    "lsat": ROLES["lsat"],
    "ov": OV_SQL,
    "zs": newest_ov("price > 100000", post=f"{NOT_BLANK} AND st IN ('F', 'O')"),
    "i": newest_ov(NOT_BLANK),
    "n": newest_ov(),
    "active": """SELECT DISTINCT i.cust, h.seq FROM zs JOIN i ON zs.cust = i.cust JOIN n ON n.cust = i.cust JOIN ov h ON h.cust = n.cust
        AND h.change_type <> 'D' AND (h.st <> 'F' OR h.extract_ts::DATE + 2000 >= DATE '2024-01-20')""",
    "retired": "SELECT seq FROM ov WHERE change_type <> 'D' AND st = 'F' AND NOT (price > 200000)",
    "eq": f"SELECT seq, cust, {MODULE_SQL} AS module, ab FROM ov WHERE change_type <> 'D' AND seq NOT IN (SELECT seq FROM retired)",
    "lk": """SELECT seq, ab FROM ov WHERE price > 150000 AND change_type <> 'D'
        AND (pri <> '4-NOT SPECIFIED' OR extract_ts::DATE + 500 >= DATE '2024-01-20')""",
    "gm": """SELECT * FROM (SELECT eq.cust, eq.seq, lk.seq AS card, lk.ab,
        row_number() OVER (PARTITION BY eq.cust ORDER BY lk.ab DESC NULLS LAST, sha1('Z' || eq.seq || ':') DESC) AS rn
        FROM ov g JOIN active ON active.seq = g.seq AND g.change_type <> 'D' LEFT JOIN lk ON lk.seq = g.seq JOIN eq ON eq.seq = g.seq) WHERE rn = 1""",
    "cards": """SELECT gm.cust, gm.seq, eq.module AS comms_type FROM gm JOIN active ON active.seq = gm.card JOIN eq ON eq.seq = gm.card
        UNION ALL SELECT cust, seq, 'MESH' FROM gm WHERE card IS NULL""",
    "iv": """SELECT device, max(ts) AS interval_ts, network FROM (
        SELECT user_id AS device, ts, CASE event_type WHEN 'view' THEN 'WIMAX' ELSE 'MESH' END AS network FROM events
        WHERE event_type IN ('view', 'click') AND ts::DATE BETWEEN DATE '2024-01-10' AND DATE '2024-01-20') GROUP BY device, network""",
    "ivf": "SELECT *, CASE WHEN interval_ts::DATE >= DATE '2024-01-15' THEN 'Y' ELSE 'N' END AS fresh FROM iv",
    "codes": """SELECT l_orderkey AS seq, value AS read_type_code FROM (
        SELECT *, CASE WHEN l_linestatus = 'O' THEN 'MRAM' ELSE 'RWD' END || l_linenumber AS value,
          row_number() OVER (PARTITION BY l_orderkey ORDER BY extract_ts DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
        FROM lsat WHERE l_returnflag = 'N') WHERE rn = 1 AND value LIKE 'RWD%'
        AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 80000))""",
    "det": """SELECT user_id AS device, 'mac' || event_id AS mac, event_type AS meter_firmware, props AS comms_firmware,
        strftime(ts, '%Y%m%d') AS last_comms, CASE event_type WHEN 'purchase' THEN 'MESH' ELSE 'WIMAX' END AS network FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events
        WHERE event_type IN ('purchase', 'signup')) WHERE rn = 1""",
    "mtr": f"""SELECT c.cust, c_name AS serial, mac, meter_firmware, read_type_code, comms_type, comms_firmware, last_comms FROM (
        SELECT cards.cust, cards.comms_type, codes.read_type_code,
          row_number() OVER (PARTITION BY cards.cust ORDER BY read_type_code DESC, sha1('Z' || cards.seq || ':') DESC) AS rn
        FROM cards JOIN codes ON codes.seq = cards.seq) c JOIN customer ON c_custkey = c.cust
        LEFT JOIN det ON det.device = c.cust AND det.network = {FOLD.format('comms_type')} WHERE rn = 1""",
    "silent": f"""SELECT mtr.*, stale.interval_ts::DATE AS last_interval FROM mtr
        LEFT JOIN ivf stale ON stale.device = mtr.cust AND stale.fresh = 'N' AND stale.network = {FOLD.format('comms_type')}
        WHERE NOT EXISTS (SELECT 1 FROM ivf f WHERE f.device = mtr.cust AND f.fresh = 'Y' AND f.network = {FOLD.format('mtr.comms_type')})""",
}


@check(
    "p_active_meter",
    with_roles(
        "SELECT sha1('E' || cust || ':') AS site_key, sha1('I' || cust || ':') AS internal_key, sha1('Q' || seq || ':') AS equipment_key FROM active",
        **FAULT_SQL,
    ),
)
def p_active_meter(t: Tables):
    return Faults(t).active()


@check(
    "p_comms_card",
    with_roles(
        "SELECT sha1('D' || cust || ':') AS device_key, sha1('Z' || seq || ':') AS meter_key, comms_type FROM cards", **FAULT_SQL
    ),
)
def p_comms_card(t: Tables):
    return Faults(t).cards()


@check(
    "p_device_interval",
    with_roles("SELECT sha1('D' || device || ':') AS device_key, interval_ts, network, fresh FROM ivf", **FAULT_SQL),
)
def p_device_interval(t: Tables):
    return Faults(t).intervals()


@check(
    "p_read_type",
    with_roles("SELECT sha1('Z' || seq || ':') AS equipment_key, read_type_code FROM codes", **FAULT_SQL),
)
def p_read_type(t: Tables):
    return Faults(t).codes()


@check(
    "p_comms_fault",
    with_roles(
        """SELECT sha1('D' || cust || ':') AS device_key, 'OUTBOUND_COMMS_FAULT' AS record_source,
             sha1(trim(serial) || ':' || trim(coalesce(mac, '')) || ':' || trim(coalesce(meter_firmware, '')) || ':' || trim(read_type_code)
               || ':' || trim(coalesce(comms_type, '')) || ':' || trim(coalesce(comms_firmware, '')) || ':' || trim(coalesce(last_comms, ''))
               || ':' || trim(coalesce(last_interval::VARCHAR, ''))) AS hash_diff,
             serial, mac, meter_firmware, read_type_code, comms_type, comms_firmware, last_comms, last_interval, DATE '2024-01-20' AS run_date
           FROM silent""",
        **FAULT_SQL,
    ),
)
def p_comms_fault(t: Tables):
    f = Faults(t)
    return cf.comms_faults(f.cards(), f.codes(), f.details(), f.intervals(), f.hub_device, run_dt=RUN_EVENTS)


# --- meter timeline ---------------------------------------------------------

TIMELINE_SQL = {
    "lsat": ROLES["lsat"],
    "ov": OV_SQL,
    "i": newest_ov(NOT_BLANK),
    "n": newest_ov(),
    "h": "SELECT *, CASE WHEN st = 'F' THEN strftime(extract_ts + to_days(2000), '%Y%m%d') ELSE '99991231' END AS bis "
    "FROM ov WHERE change_type <> 'D'",
    "spans": """SELECT h.seq AS meter, i.cust AS site, min(h.ab) AS install, max(h.bis) AS removal FROM i JOIN n ON i.cust = n.cust
        JOIN h ON h.cust = i.cust JOIN ov g ON g.seq = h.seq AND g.price > 50000 AND g.change_type <> 'D' GROUP BY ALL""",
    "attr": f"""SELECT l_orderkey AS meter, CASE l_returnflag WHEN 'A' THEN 'READ' ELSE 'TYP' END AS fname,
        CASE WHEN l_linenumber = 3 THEN ' ' ELSE 'V' || l_linenumber END AS val, ab, bis FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, CASE l_returnflag WHEN 'A' THEN 'READ' ELSE 'TYP' END, ab
          ORDER BY extract_ts DESC, {TIES}, l_linenumber DESC) AS rn FROM lsat) WHERE rn = 1""",
    "joined": """SELECT s.site, 'D' || s.meter AS meter_num, r.val AS read, r.ab AS read_from, r.bis AS read_to,
        y.val AS typ, y.ab AS typ_from, y.bis AS typ_to, s.install, s.removal, list_min([y.bis, r.bis, s.removal]) AS min_to
        FROM spans s LEFT JOIN attr r ON r.meter = s.meter AND r.fname = 'READ' LEFT JOIN attr y ON y.meter = s.meter AND y.fname = 'TYP'""",
    "kept": """SELECT * FROM joined WHERE coalesce(read_from, '0') <= min_to AND coalesce(typ_from, '0') <= min_to AND install <= min_to""",
    "lagged": """SELECT *, lag(min_to) OVER (PARTITION BY site, meter_num ORDER BY min_to, read_from NULLS FIRST, typ_from NULLS FIRST, install) AS last_to,
        list_sort([read_from, typ_from, install], 'ASC', 'NULLS LAST') AS a FROM kept""",
    "tl": """SELECT *, CASE WHEN a[1] > last_to THEN a[1] WHEN a[2] > last_to THEN a[2] WHEN a[3] > last_to THEN a[3] ELSE a[1] END AS t_from,
        CASE WHEN min_to > removal THEN removal ELSE min_to END AS t_to FROM lagged""",
    "every": """SELECT DISTINCT site AS site_id, meter_num, nullif(trim(typ), '') AS installation_typ, nullif(trim(read), '') AS read_typ_cd,
          strptime(t_from, '%Y%m%d')::DATE AS from_dt, strptime(t_to, '%Y%m%d')::DATE AS to_dt FROM tl
        UNION SELECT site, '0', NULL, NULL, DATE '1995-01-01', min(strptime(install, '%Y%m%d'))::DATE - 1 FROM tl GROUP BY site
        UNION SELECT i.cust, ' P' || g.l_partkey, NULL, NULL, min(strptime(g.ab, '%Y%m%d'))::DATE, max(strptime(g.bis, '%Y%m%d')::DATE)
          FROM i JOIN n ON i.cust = n.cust JOIN h ON h.cust = i.cust
          JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, ab ORDER BY extract_ts DESC, """
    + TIES
    + """) AS rn FROM lsat WHERE l_linestatus = 'F') WHERE rn = 1) g ON g.l_orderkey = h.seq
          GROUP BY i.cust, g.l_partkey, CASE WHEN g.l_returnflag <> 'N' THEN 'Z' ELSE 'W' END""",
}


TIMELINE_BODY = """SELECT * EXCLUDE (rno) FROM (SELECT *, row_number() OVER (PARTITION BY site_id, meter_num, from_dt
    ORDER BY to_dt DESC NULLS LAST, installation_typ NULLS LAST, read_typ_cd NULLS LAST) AS rno FROM every) WHERE rno = 1"""


def timeline_of(v: Vault, **settings):
    t = v.t
    attributes = t.lsat.select(
        key("Z", "l_orderkey").alias("meter_key"),
        decode("l_returnflag", {"A": "READ"}, "TYP").alias("fname"),
        F.when(F.col("l_linenumber") == 3, " ").otherwise(F.concat(F.lit("V"), F.col("l_linenumber").cast("string"))).alias("value"),
        "ab",
        "bis",
        "extract_ts",
        F.struct("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linenumber").alias("seq"),
        F.lit("U").alias("change_type"),
    )
    others = v.device_groups.withColumnRenamed("kombinat", "category")
    return meter_timeline(
        v.fitted, attributes, v.fitted_groups, others, v.holdings, v.installs.withColumn("time_from", F.lit("000000")), v.ids,
        v.site_links, v.equipment_links, v.hub_site, run_dt=RUN_ALL, read_type="READ", install_type="TYP", **settings,
    )


@check("p_meter_timeline", with_roles(TIMELINE_BODY, **TIMELINE_SQL))
def p_meter_timeline(t: Tables):
    return timeline_of(Vault(t))


def amended_sql(holding_versions: str) -> dict[str, str]:
    """The timeline's SQL over several versions of holdings, equipment and groups."""
    held = """SELECT *, CASE WHEN version = 2 THEN strftime(strptime(ab, '%Y%m%d') + to_days(900), '%Y%m%d')
        WHEN st = 'F' THEN strftime(strptime(ab, '%Y%m%d') + to_days(2000), '%Y%m%d') ELSE '99991231' END AS bis,
        row_number() OVER (PARTITION BY seq, ab ORDER BY extract_ts DESC) AS rn FROM amended"""
    grouped = """SELECT *, row_number() OVER (PARTITION BY seq, ab ORDER BY extract_ts DESC) AS rn FROM amended
        WHERE price > 50000 AND NOT (version = 2 AND pri = '1-URGENT')"""
    parts = {
        **{name: TIMELINE_SQL[name] for name in ("lsat", "ov", "i", "n")},
        "amended": AMENDED_SQL,
        "h": f"SELECT * FROM ({held}) WHERE change_type <> 'D'" + (" AND rn = 1" if holding_versions == "newest" else ""),
        "g": f"SELECT * FROM ({grouped}) WHERE rn = 1 AND change_type <> 'D'",
        "fitted": """SELECT seq, CASE version WHEN 2 THEN 'E' ELSE 'D' END || seq AS meter_num FROM (
            SELECT *, row_number() OVER (PARTITION BY seq ORDER BY extract_ts DESC) AS rn FROM amended) WHERE rn = 1 AND change_type <> 'D'""",
        "spans": """SELECT h.seq AS meter, i.cust AS site, min(h.ab) AS install, max(h.bis) AS removal FROM i JOIN n ON i.cust = n.cust
            JOIN h ON h.cust = i.cust JOIN (SELECT DISTINCT seq FROM g) g ON g.seq = h.seq GROUP BY ALL""",
        "attr": TIMELINE_SQL["attr"],
        "joined": TIMELINE_SQL["joined"].replace("'D' || s.meter AS meter_num", "e.meter_num").replace("FROM spans s", "FROM spans s JOIN fitted e ON e.seq = s.meter"),
    }
    return parts | {name: TIMELINE_SQL[name] for name in ("kept", "lagged", "tl", "every")}


@check("p_meter_timeline_amended", with_roles(TIMELINE_BODY, **amended_sql("all")))
def p_meter_timeline_amended(t: Tables):
    """Several versions of holdings, equipment and groups: every live holding reaches into its span."""
    return timeline_of(AmendedVault(t))


@check("p_meter_timeline_newest", with_roles(TIMELINE_BODY, **amended_sql("newest")))
def p_meter_timeline_newest(t: Tables):
    """The same versions, with the newest holding of each link and start only."""
    return timeline_of(AmendedVault(t), holding_versions="newest")


# --- meter channels ---------------------------------------------------------

CLOSED = "CASE WHEN {0} = DATE '9999-12-31' THEN {0} ELSE {0} - 1 END"


def relation_sql(pri: str, keys: str) -> str:
    """Newest live version per key and start, with its period."""
    return f"""SELECT *, extract_ts::DATE AS f, CASE WHEN st = 'O' THEN DATE '9999-12-31' ELSE extract_ts::DATE + 200 END AS e FROM (
        SELECT *, cust * 2 + CASE WHEN price > 250000 THEN 1 ELSE 0 END AS chan,
          row_number() OVER (PARTITION BY {keys}, extract_ts ORDER BY extract_ts DESC, seq DESC) AS rn FROM (
          SELECT *, cust * 2 + CASE WHEN price > 250000 THEN 1 ELSE 0 END AS chan0 FROM ov WHERE pri = '{pri}')) WHERE rn = 1 AND change_type <> 'D'"""


def channel_sql(param_keys: str, once: str) -> str:
    parts = {
        "ov": OV_SQL,
        "fit": relation_sql("1-URGENT", "cust"),
        "wire": relation_sql("2-HIGH", "chan0"),
        "sfx": f"""SELECT *, CASE WHEN st = 'O' THEN 'E1' ELSE 'B1' END AS suffix, extract_ts::DATE AS f,
            CASE WHEN st = 'O' THEN DATE '9999-12-31' ELSE extract_ts::DATE + 200 END AS e FROM (
            SELECT *, row_number() OVER (PARTITION BY {param_keys} ORDER BY extract_ts DESC, seq DESC) AS rn FROM (
            SELECT *, cust * 2 + CASE WHEN price > 250000 THEN 1 ELSE 0 END AS chan FROM ov WHERE pri = '3-MEDIUM')) WHERE rn = 1 AND change_type <> 'D'""",
        "ways": """SELECT DISTINCT c_custkey AS site, wire.chan, CASE WHEN c_acctbal < 0 THEN 'Y' ELSE 'n ' END AS is_virtual FROM customer
            JOIN fit ON fit.cust = c_custkey JOIN wire ON wire.cust = c_custkey JOIN sfx ON sfx.chan = wire.chan""",
        "days": f"""SELECT site, unnest([f, {CLOSED.format('e')}]) AS day FROM ways JOIN fit ON fit.cust = site
            UNION SELECT site, unnest([f, {CLOSED.format('e')}]) FROM ways JOIN wire ON wire.cust = site AND wire.chan = ways.chan
            UNION SELECT site, unnest([f, {CLOSED.format('e')}]) FROM ways JOIN sfx ON sfx.chan = ways.chan""",
        "cuts": "SELECT site, day AS from_dt, lead(day) OVER (PARTITION BY site ORDER BY day) AS to_dt FROM days",
        "kept": "SELECT * FROM cuts WHERE date_diff('day', from_dt, to_dt) > 1",
        "sl": """SELECT site, from_dt, CASE WHEN lead(from_dt) OVER (PARTITION BY site ORDER BY from_dt) = to_dt
            THEN to_dt - 1 ELSE to_dt END AS to_dt FROM kept""",
        "joined": """SELECT DISTINCT w.site AS site_id, 'S' || w.site AS meter_num, sfx.suffix, w.chan AS channel_id, w.is_virtual, sl.from_dt, sl.to_dt
            FROM ways w JOIN sl ON sl.site = w.site
            JOIN fit ON fit.cust = w.site AND fit.e > sl.from_dt AND fit.f < sl.to_dt
            JOIN wire ON wire.cust = w.site AND wire.chan = w.chan AND wire.e > sl.from_dt AND wire.f < sl.to_dt
            JOIN sfx ON sfx.chan = w.chan AND sfx.e > sl.from_dt AND sfx.f < sl.to_dt WHERE upper(trim(w.is_virtual)) = 'N'""",
    }
    return with_roles(
        f"""SELECT * EXCLUDE (rno) FROM (SELECT *, row_number() OVER (PARTITION BY {once} ORDER BY channel_id, from_dt, is_virtual) AS rno
            FROM joined) WHERE rno = 1""",
        **parts,
    )


def channels_of(t: Tables, **options):
    v = Vault(t)
    chan = (F.col("cust") * 2 + F.when(F.col("price") > 250000, 1).otherwise(0)).cast("string")
    channel_key = F.sha1(F.concat(F.lit("CH"), chan, F.lit(":")))
    start = F.col("extract_ts")
    end = F.when(F.col("st") != "O", F.col("extract_ts") + F.expr("INTERVAL 200 DAYS"))
    points = t.customer.select(
        key("P", "c_custkey").alias("salnk_key"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("extract_ts"),
        F.col("c_custkey").alias("seq"),
        F.lit("U").alias("change_type"),
    )
    links = t.customer.select(
        key("P", "c_custkey").alias("salnk_key"), key("E", "c_custkey").alias("key1"), key("PT", "c_custkey").alias("key2")
    )
    fitted = v.versions(
        F.col("pri") == "1-URGENT", point_key=key("PT", "cust"), device_key=key("D", "cust"), eff_start=start, eff_end=end
    )
    devices = t.customer.select(
        key("D", "c_custkey").alias("device_key"),
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("meter_num"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("extract_ts"),
        F.col("c_custkey").alias("seq"),
    )
    numbers = t.customer.withColumn("n", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "channel_id", F.col("c_custkey") * 2 + F.col("n")
    )
    listed = numbers.select(
        key("PT", "c_custkey").alias("point_key"),
        key("CH", "channel_id").alias("channel_key"),
        F.lit("Interval Data").alias("channel_type"),
        F.when(F.col("c_acctbal") < 0, "Y").otherwise("n ").alias("is_virtual"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("extract_ts"),
        F.col("c_custkey").alias("seq"),
        F.lit("U").alias("change_type"),
    )
    wired = v.versions(
        F.col("pri") == "2-HIGH", device_key=key("D", "cust"), channel_key=channel_key, eff_start=start, eff_end=end
    )
    params = v.versions(
        F.col("pri") == "3-MEDIUM",
        channel_key=channel_key,
        param_id=F.lit(1),
        name=F.lit("Data Stream Suffix "),
        value=F.when(F.col("st") == "O", "E1").otherwise("B1"),
        rec_version=F.col("seq"),
        eff_start=start,
        eff_end=end,
    )
    hub_channel = numbers.select(key("CH", "channel_id").alias("channel_key"), "channel_id")
    return meter_channels(
        points, fitted, devices, listed, wired, params, links, v.hub_site, hub_channel, run_dt=RUN_ALL, **options
    )


@check("p_meter_channels", channel_sql("chan, extract_ts", "site_id, meter_num, suffix"))
def p_meter_channels(t: Tables):
    return channels_of(t)


@check("p_meter_channels_per_slice", channel_sql("chan", "site_id, meter_num, suffix, from_dt"))
def p_meter_channels_per_slice(t: Tables):
    return channels_of(t, by_version_no=False, per_slice=True)


# --- interval reads ---------------------------------------------------------

READ_PARTS = {
    "org": "SELECT r_regionkey AS org_id FROM region WHERE r_name = 'ASIA'",
    "chan": """SELECT DISTINCT user_id AS channel_id FROM events WHERE event_type <> 'error' AND value > 20""",
}


def reads_sql(where: str) -> str:
    return with_roles(
        f"""SELECT channel_id, CAST(strftime(interval_end - to_minutes(30), '%Y%m%d') AS INT) AS read_dt,
               CAST(trunc((epoch(interval_end) - epoch((interval_end - to_minutes(30))::DATE)) / interval_len) AS INT) AS interval_seq_num,
               lp_value::DECIMAL(21,6) AS consumption, status, change_method, interval_len FROM (
             SELECT *, row_number() OVER (PARTITION BY channel_id, interval_end ORDER BY extract_ts DESC, load_ts DESC) AS rn FROM reads
             WHERE org_id IN (SELECT org_id FROM org) AND channel_id IN (SELECT channel_id FROM chan)
               AND trim(upper(status)) IN ('VAL', 'EST') AND {where}) WHERE rn = 1""",
        "reads",
        **READ_PARTS,
    )


def reads_of(t: Tables, run_dt, **options):
    reads = t.reads.withColumn("channel_key", key("CH", "channel_id")).drop("channel_id")
    orgs = t.region.select(
        key("OR", "r_regionkey").alias("org_key"),
        F.col("r_name").alias("name"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("extract_ts"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("load_ts"),
    )
    org_hub = t.region.select(key("OR", "r_regionkey").alias("org_key"), F.col("r_regionkey").alias("org_id"))
    params = t.sat.select(
        key("CH", "user_id").alias("channel_key"),
        F.lit("Data Stream Suffix").alias("name"),
        F.when(F.col("value") > 20, "e1").otherwise("Q1").alias("value"),
        "change_type",
    )
    hub = t.hub_device.select(key("CH", "device_id").alias("channel_key"), F.col("device_id").alias("channel_id"))
    return interval_reads(reads, orgs, org_hub, params, hub, run_dt=run_dt, org_name="ASIA", **options)


@check("p_interval_reads", reads_sql("extract_day = DATE '2024-01-20' AND (interval_end - to_minutes(30))::DATE >= DATE '2024-01-20' - 761"))
def p_interval_reads(t: Tables):
    return reads_of(t, RUN_EVENTS, ordered=True)


@check(
    "p_interval_reads_hourly",
    reads_sql(
        """extract_day BETWEEN DATE '2024-01-19' AND DATE '2024-01-21'
           AND (extract_ts BETWEEN TIMESTAMP '2024-01-20 00:00:00' AND TIMESTAMP '2024-01-20 08:00:00'
             OR load_ts + INTERVAL 10 HOUR BETWEEN TIMESTAMP '2024-01-20 00:00:00' AND TIMESTAMP '2024-01-20 08:00:00')"""
    ),
)
def p_interval_reads_hourly(t: Tables):
    return reads_of(t, datetime(2024, 1, 20, 8), hours=8)
