"""Data products about sites."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultframe.adapters import LSAT_TIES, RUN_ORDERS, Tables
from vaultframe.checks.registry import check, with_roles
from vaultframe.checks.standins import OV_SQL, Vault, key, later
from vaultframe.functions.dates import OPEN_END_TEXT
from vaultframe.plans.customer_slices import customer_slices
from vaultframe.plans.life_support import life_support
from vaultframe.plans.site_address import latest_premise, site_address
from vaultframe.plans.site_register import site_register
from vaultframe.plans.substation import site_substation
from vaultframe.plans.suffix import suffix_periods

TIES = ", ".join(f"{c} DESC" for c in LSAT_TIES)


def newest_ov(where: str = "true", keys: str = "cust", order: str = "extract_ts DESC, seq DESC", post: str = "true") -> str:
    """Newest live order version, as SQL."""
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM ov
        WHERE {where}) WHERE rn = 1 AND change_type <> 'D' AND {post}"""


NOT_BLANK = "length(trim(checksum)) > 0"
SITE_SQL = {
    "ov": OV_SQL,
    "i": newest_ov(NOT_BLANK),
    "n": newest_ov(),
    "h": "SELECT *, CASE WHEN st = 'F' THEN strftime(extract_ts + to_days(2000), '%Y%m%d') ELSE '99991231' END AS bis "
    "FROM ov WHERE change_type <> 'D'",
}


def registers_sql(keys: str, post: str) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY extract_ts DESC, {TIES}) AS rn FROM lsat
        WHERE (upper(l_returnflag) LIKE 'A%' OR upper(l_returnflag) LIKE 'R%') AND l_linestatus = 'F') WHERE rn = 1 AND {post}"""


SUFFIX_BODY = """SELECT DISTINCT i.cust AS site_id, l_returnflag AS suffix, {from_dt} AS from_dt, {to_dt} AS to_dt
    FROM i JOIN n ON i.cust = n.cust JOIN h ON h.cust = i.cust JOIN r ON r.l_orderkey = h.seq"""


def suffix(t: Tables, running: bool):
    v = Vault(t)
    return suffix_periods(
        v.ids, v.installs, v.holdings, v.registers, v.site_links, v.equipment_links, v.register_links, v.hub_site,
        prefixes=("A%", "R%"), kind="F", running=running,
    )


@check(
    "p_suffix",
    with_roles(
        SUFFIX_BODY.format(from_dt="r.ab", to_dt="r.bis"), "lsat", **SITE_SQL, r=registers_sql("l_orderkey, l_linenumber", "true")
    ),
)
def p_suffix(t: Tables):
    return suffix(t, running=False)


@check(
    "p_suffix_running",
    with_roles(
        SUFFIX_BODY.format(
            from_dt="min(r.ab) OVER (PARTITION BY i.cust, l_returnflag, r.bis ORDER BY r.ab)",
            to_dt="max(r.bis) OVER (PARTITION BY i.cust, l_returnflag, r.ab ORDER BY r.ab)",
        ),
        "lsat",
        **SITE_SQL,
        r=registers_sql("l_orderkey, l_linenumber, ab", "ab < bis"),
    ),
)
def p_suffix_running(t: Tables):
    return suffix(t, running=True)


def group_sql(line_status: str, first: bool) -> str:
    kind = "l_returnflag <> 'N'"
    pre, post = (kind, "true") if first else ("true", kind)
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY ab DESC, extract_ts DESC, {TIES}) AS rn FROM lsat WHERE l_linestatus = '{line_status}' AND {pre}) WHERE rn = 1 AND {post}"""


def register_sql(first: bool) -> str:
    return with_roles(
        """SELECT DISTINCT i.cust AS site_id, s.status, coalesce(trim(m.meter_num), '0') AS meter_num,
                  coalesce(m.ab, '99991231') AS meter_start, m.bis AS meter_end, e.service_id AS market_role_key
           FROM i LEFT JOIN s ON s.cust = i.cust LEFT JOIN e ON e.cust = i.cust LEFT JOIN n ON n.cust = i.cust
           LEFT JOIN m ON m.cust = n.cust""",
        "lsat",
        **SITE_SQL,
        s=f"""SELECT cust, ' ' || st AS status FROM (SELECT *, row_number() OVER (PARTITION BY cust ORDER BY ab DESC, extract_ts DESC, seq DESC) AS rn
              FROM ov WHERE {NOT_BLANK}) WHERE rn = 1 AND change_type <> 'D' AND st IN ('F', 'O') AND price > 100000""",
        e="""SELECT DISTINCT cust, 'NORTH ' || pri AS service_id FROM (SELECT *, row_number() OVER (PARTITION BY cust, pri
              ORDER BY extract_ts DESC, seq DESC) AS rn FROM ov) WHERE rn = 1 AND st = 'F' AND pri < '4' AND price > 250000""",
        m=f"""SELECT cust, meter_num, min(ab) AS ab, max(bis) AS bis FROM (
              SELECT h.cust, ' P' || g.l_partkey AS meter_num, h.ab, h.bis FROM h JOIN ({group_sql('F', first)}) g ON g.l_orderkey = h.seq
              UNION ALL SELECT h.cust, s_name, h.ab, h.bis FROM h JOIN ({group_sql('O', first)}) g ON g.l_orderkey = h.seq
              JOIN supplier ON s_suppkey = g.l_suppkey) GROUP BY ALL""",
    )


def register(t: Tables, first: bool):
    v = Vault(t)
    services = v.versions(
        service_link_key=key("S", "cust"),
        contract=F.col("pri"),
        service=F.when(F.col("st") == "F", "LNSP").otherwise("FRMP"),
        service_id=F.concat(F.when(F.col("pri") < "4", "NORTH ").otherwise("OTHER "), F.col("pri")),
        service_end=F.when(F.col("price") > 250000, OPEN_END_TEXT).otherwise("20000101"),
        site_key=key("I", "cust"),
    )
    return site_register(
        v.ids, v.status, services, v.installs, v.holdings, v.device_groups, v.meter_groups, v.equipment,
        v.site_links, v.equipment_links, v.hub_site, role_prefix="NORTH%", statuses=("F", "O"), filter_kind_first=first,
    )


@check("p_site_register", register_sql(True))
def p_site_register(t: Tables):
    return register(t, True)


@check("p_site_register_after_rank", register_sql(False))
def p_site_register_after_rank(t: Tables):
    return register(t, False)


def life_sql(pre: str, post: str) -> str:
    return with_roles(
        """SELECT DISTINCT l.cust AS site_id, 'LS' AS flag, ' ' || s.st AS status, trim(s_name) AS meter_num
           FROM l JOIN n2 ON n2.cust = l.cust JOIN i2 ON i2.cust = l.cust JOIN s ON s.cust = l.cust
           JOIN h ON h.cust = l.cust AND h.bis = '99991231'
           JOIN lsat g ON g.l_orderkey = h.seq AND g.l_linestatus = 'O' AND g.l_returnflag <> 'N'
           JOIN supplier ON s_suppkey = g.l_suppkey""",
        "lsat",
        **SITE_SQL,
        l=newest_ov(post="pri = '1-URGENT'"),
        n2="SELECT DISTINCT cust FROM ov WHERE change_type <> 'D'",
        i2=f"SELECT DISTINCT cust FROM ov WHERE change_type <> 'D' AND {NOT_BLANK}",
        s=f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cust ORDER BY extract_ts DESC, seq DESC) AS rn FROM ov
              WHERE price > 100000 AND {NOT_BLANK} AND {pre}) WHERE rn = 1 AND {post}""",
    )


def support(t: Tables, rule: str):
    v = Vault(t)
    flags = v.versions(salnk_key=key("N", "cust"), flag=F.when(F.col("pri") == "1-URGENT", "LS").otherwise(" "))
    groups = v.meter_groups.withColumn("bis", F.when(F.col("kombinat") == "Z", OPEN_END_TEXT).otherwise(F.col("bis")))
    return life_support(
        flags, v.installs, v.ids, v.status, v.holdings, groups, v.equipment, v.site_links, v.equipment_links,
        v.hub_site, status_rule=rule, statuses=("F", "O"), excluded=("O",),
    )


@check("p_life_support", life_sql("true", "st IN ('F', 'O')"))
def p_life_support(t: Tables):
    return support(t, "after_in")


@check("p_life_support_before", life_sql("st IN ('F', 'O')", "true"))
def p_life_support_before(t: Tables):
    return support(t, "before_in")


@check("p_life_support_not", life_sql("true", "st NOT IN ('O')"))
def p_life_support_not(t: Tables):
    return support(t, "after_not")


ADDRESS_SQL = with_roles(
    """SELECT DISTINCT a.cust AS site_id, a.st AS building, NULL::VARCHAR AS lot_num, a.seq::VARCHAR AS house_num, a.pri AS street,
              CASE WHEN a.price > 250000 THEN NULL ELSE 'ST' END AS street_type, a.pri AS suburb, a.st AS state,
              a.ab AS post_cd, NULL::VARCHAR AS location_desc, p.seq::VARCHAR AS unit_num, p.pri AS unit_typ,
              NULL::VARCHAR AS street_suffix
       FROM n a JOIN w ON w.cust = a.cust JOIN n f ON f.cust = a.cust AND f.st = w.st JOIN n p ON p.cust = a.cust""",
    ov=OV_SQL,
    n=newest_ov(),
    w=newest_ov(keys="cust, st"),
)


def address_tables(v: Vault):
    blank = F.lit("  ")
    addresses = v.versions(
        address_key=key("R", "cust"),
        building=F.col("st"),
        lot_num=blank,
        house_num=F.col("seq").cast("string"),
        street=F.col("pri"),
        street_type=F.when(F.col("price") > 250000, blank).otherwise("ST"),
        suburb=F.col("pri"),
        state=F.col("st"),
        post_cd=F.col("ab"),
    )
    locations = v.versions(location_link_key=key("W", "cust"), line_no=F.col("st"))
    places = v.versions(place_key=key("H", "cust"), line_no=F.col("st"), house_key=key("U", "cust"))
    premise = v.versions(
        premise_link_key=key("X", "cust"),
        location_desc=blank,
        unit_num=F.col("seq").cast("string"),
        unit_typ=F.col("pri"),
        street_suffix=blank,
    )
    ids = v.t.customer
    location_links = ids.select(
        key("W", "c_custkey").alias("location_link_key"),
        key("R", "c_custkey").alias("address_key"),
        key("H", "c_custkey").alias("place_key"),
    )
    premise_links = ids.select(
        key("X", "c_custkey").alias("premise_link_key"),
        key("U", "c_custkey").alias("house_key"),
        key("V", "c_custkey").alias("premise_key"),
    )
    return addresses, locations, places, premise, location_links, premise_links


@check("p_site_address", ADDRESS_SQL)
def p_site_address(t: Tables):
    v = Vault(t)
    addresses, locations, places, premise, location_links, premise_links = address_tables(v)
    return site_address(addresses, locations, places, premise, location_links, premise_links, v.site_links, v.hub_site)


@check(
    "p_latest_premise",
    with_roles(
        """SELECT cust AS site_id, '  ' AS location_desc, seq::VARCHAR AS unit_num, pri AS unit_typ, '  ' AS street_suffix FROM n""",
        ov=OV_SQL,
        n=newest_ov(),
    ),
)
def p_latest_premise(t: Tables):
    v = Vault(t)
    *_, premise, _, premise_links = address_tables(v)
    return latest_premise(premise, premise_links, v.site_links, v.hub_site)


@check(
    "p_site_substation",
    """SELECT c_custkey AS site_id, c_nationkey AS substation, o_orderkey, o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def p_site_substation(t: Tables):
    v = Vault(t)
    sat = t.orders.select(key("Y", "o_custkey").alias("link_key"), "o_orderkey", "o_orderdate")
    link = t.customer.select(
        key("Y", "c_custkey").alias("link_key"), key("E", "c_custkey").alias("site_key"), F.col("c_nationkey").alias("substation")
    )
    return site_substation(sat, link, v.hub_site).select("site_id", "substation", "o_orderkey", "o_orderdate")


BEFORE_RUN = "extract_ts < TIMESTAMP '1999-07-01'"
SLICE_SQL = {
    "ov": OV_SQL,
    "i": newest_ov(f"{BEFORE_RUN} AND {NOT_BLANK}"),
    "spine": "SELECT cust AS site, DATE '1995-01-01' AS id_from, DATE '9999-12-31' AS id_to FROM i",
    "c0": f"""SELECT cust AS site, 'R' || st AS service_id, seq AS contract, seq, extract_ts AS contract_eff, ab AS s_start,
        CASE WHEN st = 'O' THEN '99991231' ELSE strftime(extract_ts + to_days(400), '%Y%m%d') END AS s_end FROM ov
        WHERE pri = '5-LOW' AND price > 100000 AND change_type <> 'D' AND {BEFORE_RUN}""",
    "c": """SELECT *, strptime(s_start, '%Y%m%d')::DATE AS c_from, try_strptime(s_end, '%Y%m%d')::DATE AS c_to FROM (
        SELECT *, row_number() OVER (PARTITION BY site, s_end ORDER BY contract_eff DESC, s_start DESC, seq DESC) AS rn FROM c0)
        WHERE rn = 1 AND site IN (SELECT site FROM spine)""",
    "acc": newest_ov(BEFORE_RUN),
    "nm0": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cust, link, extract_ts::DATE ORDER BY extract_ts DESC, seq DESC) AS rn
        FROM (SELECT *, CASE WHEN cust % 2 = 0 AND seq % 4 < 2 THEN 2 ELSE 1 END AS link FROM ov)
        WHERE pri = '1-URGENT' AND {BEFORE_RUN}) WHERE rn = 1 AND change_type <> 'D'""",
    "nm": """SELECT DISTINCT cust AS site, 'N' || seq AS name_org1, st AS name_org2, 'P' || (seq % 3) AS name_org3, CASE WHEN seq % 2 = 0 THEN 'Q' END AS name_org4, '2' AS partner_type, extract_ts::DATE AS n_from,
        coalesce(lead(extract_ts::DATE) OVER (PARTITION BY cust, link ORDER BY extract_ts, seq), DATE '9999-12-31') AS n_to FROM nm0
        WHERE cust % 7 <> 0 AND cust IN (SELECT cust FROM acc) AND cust IN (SELECT site FROM spine)""",
    "ad": f"""SELECT cust AS site, extract_ts AS address_eff, extract_ts::DATE AS a_from,
        CASE WHEN st = 'O' THEN DATE '9999-12-31' ELSE extract_ts::DATE + 300 END AS a_to FROM (
        SELECT *, row_number() OVER (PARTITION BY cust, CASE WHEN st = 'O' THEN '99991231' ELSE strftime(extract_ts + to_days(300), '%Y%m%d') END
            ORDER BY extract_ts DESC, seq DESC) AS rn FROM ov WHERE pri = '2-HIGH' AND price > 50000 AND {BEFORE_RUN})
        WHERE rn = 1 AND change_type <> 'D' AND cust IN (SELECT site FROM nm)""",
    "ph": f"""SELECT cust AS site, 'T' || seq AS tel_number1, tel2 AS tel_number2, 'C' || seq AS cons_number, 'U' || cust AS person_number, ab AS tel_date_from, extract_ts::DATE AS t_from,
        coalesce(lead(extract_ts::DATE) OVER (PARTITION BY cust ORDER BY extract_ts, seq), DATE '9999-12-31') AS t_to FROM (
        SELECT *, lead('T' || seq) OVER w AS tel2 FROM ov WHERE pri = '3-MEDIUM' AND {BEFORE_RUN}
        WINDOW w AS (PARTITION BY cust ORDER BY CASE WHEN price > 250000 THEN 'X' ELSE ' ' END DESC, 'C' || seq DESC, seq DESC))
        WHERE change_type <> 'D' AND cust IN (SELECT site FROM ad)""",
    "first_ph": f"""SELECT cust AS site, 'T' || seq AS tel_number1, tel2 AS tel_number2, 'C' || seq AS cons_number, 'U' || cust AS person_number, ab AS tel_date_from, extract_ts::DATE AS t_from,
        DATE '9999-12-31' AS t_to FROM (
        SELECT *, lead('T' || seq) OVER w AS tel2, row_number() OVER w AS rn FROM ov WHERE pri = '3-MEDIUM' AND {BEFORE_RUN}
        WINDOW w AS (PARTITION BY cust ORDER BY CASE WHEN price > 250000 THEN 'X' ELSE ' ' END DESC, 'C' || seq DESC, seq DESC))
        WHERE rn = 1 AND change_type <> 'D' AND cust IN (SELECT site FROM ad)""",
    "days": """SELECT site, unnest([id_from, id_to]) AS day FROM spine UNION SELECT site, unnest([c_from, c_to]) FROM c
        UNION SELECT site, unnest([n_from, n_to]) FROM nm UNION SELECT site, unnest([a_from, a_to]) FROM ad
        UNION SELECT site, unnest([t_from, t_to]) FROM ph""",
    "cuts": "SELECT site, day AS from_dt, lead(day) OVER (PARTITION BY site ORDER BY day) AS to_dt FROM days",
    "kept": "SELECT * FROM cuts WHERE date_diff('day', from_dt, to_dt) > 1",
    "sl": """SELECT site, from_dt, CASE WHEN lead(from_dt) OVER (PARTITION BY site ORDER BY from_dt) = to_dt
        THEN to_dt - 1 ELSE to_dt END AS to_dt FROM kept""",
    "joined": """SELECT DISTINCT sl.site AS site_id, sl.from_dt, sl.to_dt, name_org1, name_org2, name_org3, name_org4, partner_type, n_from, tel_number1, tel_number2, person_number, tel_date_from,
        cons_number, t_from, service_id, contract, contract_eff, c_from, c_to,
        CASE WHEN nm.site IS NULL THEN NULL ELSE sha1('B' || nm.site || ':') END AS partner_key,
        CASE WHEN ad.site IS NULL THEN NULL ELSE sha1('R' || ad.site || ':') END AS address_key,
        CASE WHEN ad.site IS NULL THEN NULL ELSE 'XXDEFAULT' END AS adr_kind, a_from, a_to, address_eff
        FROM spine JOIN sl ON spine.site = sl.site AND id_to > sl.from_dt AND id_from < sl.to_dt
        LEFT JOIN c ON c.site = sl.site AND c_to > sl.from_dt AND c_from < sl.to_dt
        LEFT JOIN nm ON nm.site = sl.site AND n_to > sl.from_dt AND n_from < sl.to_dt
        LEFT JOIN ad ON ad.site = nm.site AND a_to > sl.from_dt AND a_from < sl.to_dt
        LEFT JOIN ph ON ph.site = ad.site AND t_to > sl.from_dt AND t_from < sl.to_dt""",
}


def slice_sql(start: str) -> str:
    return f"""SELECT DISTINCT site_id, {start} AS start_dt, to_dt AS end_dt, name_org1, name_org2, name_org3, name_org4, partner_type, n_from AS name_eff_day,
        tel_number1, tel_number2, person_number, tel_date_from, cons_number, t_from AS tel_eff_day, '2024-02-01 19:00:00' AS row_insert_dtm, service_id, contract, contract_eff, c_from AS service_start,
        c_to AS service_end, partner_key, address_key, adr_kind, a_from AS address_valid_from, a_to AS address_valid_to, address_eff
        FROM (SELECT *, rank() OVER (PARTITION BY site_id, from_dt ORDER BY n_from DESC NULLS LAST, address_eff DESC NULLS LAST) AS rno FROM joined)
        WHERE rno = 1 AND contract IS NOT NULL"""


def slices_of(t: Tables, **options):
    v = Vault(t)
    services = v.versions(
        F.col("pri") == "5-LOW",
        site_key=key("I", "cust"),
        contract=F.col("seq"),
        service=F.when(F.col("price") > 100000, "FRMP").otherwise("LNSP"),
        service_id=F.concat(F.lit("R"), F.col("st")),
        service_start=F.col("ab"),
        service_end=F.when(F.col("st") == "O", OPEN_END_TEXT).otherwise(later(400)),
    )
    accounts = v.versions(install_key=key("A", "cust"), account_key=key("K", "cust"))
    # customers of even number have a second account, which no installation uses; its names count, too
    first_link = t.customer.select(
        key("P", "c_custkey").alias("link_key"),
        key("K", "c_custkey").alias("account_key"),
        key("B", "c_custkey").alias("partner_key"),
    )
    second_link = t.customer.filter("c_custkey % 2 = 0").select(
        key("O", "c_custkey").alias("link_key"),
        key("J", "c_custkey").alias("account_key"),
        key("B", "c_custkey").alias("partner_key"),
    )
    partner_links = first_link.unionByName(second_link)
    # every seventh link ends before the run, and all of them after it, which must not be seen
    states = [("1995-01-01", "U", "true"), ("1997-01-01", "D", "c_custkey % 7 = 0"), ("2003-05-01", "D", "true")]
    partners = reduce(
        DataFrame.unionByName,
        [
            t.customer.filter(which).select(
                key("P", "c_custkey").alias("link_key"),
                F.lit(day).cast("timestamp_ntz").alias("extract_ts"),
                F.col("c_custkey").alias("seq"),
                F.lit(change).alias("change_type"),
            )
            for day, change, which in states
        ],
    )
    names = v.versions(
        F.col("pri") == "1-URGENT",
        link_key=F.when((F.col("cust") % 2 == 0) & (F.col("seq") % 4 < 2), key("O", "cust")).otherwise(key("P", "cust")),
        name_org1=F.concat(F.lit("N"), F.col("seq").cast("string")),
        name_org2=F.col("st"),
        name_org3=F.concat(F.lit("P"), (F.col("seq") % 3).cast("string")),
        name_org4=F.when(F.col("seq") % 2 == 0, "Q"),
        partner_type=F.lit("2"),
    )
    addresses = v.versions(
        F.col("pri") == "2-HIGH",
        partner_key=key("B", "cust"),
        address_key=key("R", "cust"),
        adr_kind=F.when(F.col("price") > 50000, "XXDEFAULT").otherwise("OTHER"),
        valid_from=F.concat(F.col("ab"), F.lit("000000")),
        valid_to=F.concat(F.when(F.col("st") == "O", OPEN_END_TEXT).otherwise(later(300)), F.lit("235959")),
    )
    phones = v.versions(
        F.col("pri") == "3-MEDIUM",
        address_key=key("R", "cust"),
        tel_number=F.concat(F.lit("T"), F.col("seq").cast("string")),
        flag_default=F.when(F.col("price") > 250000, "X").otherwise(" "),
        cons_number=F.concat(F.lit("C"), F.col("seq").cast("string")),
        person_number=F.concat(F.lit("U"), F.col("cust").cast("string")),
        date_from=F.col("ab"),
    )
    # the same links in another role lead to another site, and must not be followed
    other_role = t.customer.filter("c_custkey % 5 = 0").withColumn("next", F.col("c_custkey") + 1).select(
        key("T", "c_custkey").alias("salnk_key"),
        key("E", "next").alias("key1"),
        key("I", "c_custkey").alias("key2"),
        F.lit("OLD_UI").alias("role1"),
        F.lit("INT_UI").alias("role2"),
    )
    return customer_slices(
        v.ids, services, v.installs, accounts, partners, names, addresses, phones, v.site_links.unionByName(other_role), partner_links, v.hub_site,
        run_dt=RUN_ORDERS, now_utc=datetime(2024, 2, 1, 9), **options,
    )


@check("p_customer_slices", with_roles(slice_sql("from_dt"), **SLICE_SQL))
def p_customer_slices(t: Tables):
    return slices_of(t)


@check(
    "p_customer_slices_first_phone",
    with_roles(slice_sql("from_dt"), **{**SLICE_SQL, "ph": SLICE_SQL["first_ph"]}),
)
def p_customer_slices_first_phone(t: Tables):
    return slices_of(t, phone_rule="first")


@check(
    "p_customer_slices_floor",
    with_roles(
        slice_sql("CASE WHEN from_dt < DATE '1997-01-01' THEN DATE '1997-01-01' ELSE from_dt END"),
        **{**SLICE_SQL, "kept": SLICE_SQL["kept"] + " AND to_dt >= DATE '1998-01-01'"},
    ),
)
def p_customer_slices_floor(t: Tables):
    return slices_of(t, min_end="1998-01-01", floor="1997-01-01")
