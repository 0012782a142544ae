"""Vault tables of the data products, made from the driver's tables.

Orders serve as versions (of sites, installations, contracts, names ...), order
lines as registers and meters, events as device data. Every builder returns the
raw shape its product expects; nothing is ranked or joined here.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultframe.adapters import LSAT_TIES, Tables
from vaultframe.functions.columns import decode
from vaultframe.functions.dates import OPEN_END_TEXT, day_text
from vaultframe.functions.keys import hash_key

# The order versions again, as SQL.
OV_SQL = """SELECT o_orderkey AS seq, o_custkey AS cust, o_orderdate AS extract_ts, o_orderstatus AS st,
    o_orderpriority AS pri, o_totalprice AS price, CASE WHEN o_orderstatus = 'P' THEN 'D' ELSE 'U' END AS change_type,
    strftime(o_orderdate, '%Y%m%d') AS ab, CASE WHEN o_orderpriority = '5-LOW' THEN '  ' ELSE 'C' END AS checksum
    FROM orders"""


def key(prefix: str, col: str) -> Column:
    """Hash key in a named key space."""
    return hash_key(F.concat(F.lit(prefix), F.col(col).cast("string")))


def later(days: int) -> Column:
    return day_text(F.date_add(F.col("extract_ts").cast("date"), days))


class Vault:
    """Raw vault tables over one :class:`Tables`."""

    def __init__(self, t: Tables):
        self.t = t

    @cached_property
    def ov(self) -> DataFrame:
        return self.t.orders.select(
            F.col("o_orderkey").alias("seq"),
            F.col("o_custkey").alias("cust"),
            F.col("o_orderdate").alias("extract_ts"),
            F.col("o_orderstatus").alias("st"),
            F.col("o_orderpriority").alias("pri"),
            F.col("o_totalprice").alias("price"),
            decode("o_orderstatus", {"P": "D"}, "U").alias("change_type"),
            day_text("o_orderdate").alias("ab"),
            decode("o_orderpriority", {"5-LOW": "  "}, "C").alias("checksum"),
        )

    def versions(self, keep: Column | None = None, **columns: Column) -> DataFrame:
        """Order versions with the given payload."""
        rows = self.ov if keep is None else self.ov.filter(keep)
        return rows.select("extract_ts", "seq", "change_type", *[c.alias(n) for n, c in columns.items()])

    # --- hubs and links ----------------------------------------------------

    @cached_property
    def hub_site(self) -> DataFrame:
        return self.t.customer.select(key("E", "c_custkey").alias("site_key"), F.col("c_custkey").alias("site_id"))

    @cached_property
    def site_links(self) -> DataFrame:
        """External-internal id, installation-internal id, installation-premise."""
        kinds = [("T", "E", "I", "EXT_UI", "INT_UI"), ("N", "A", "I", "INST", "INT_UI"), ("V", "A", "V", "INST", "PREM")]
        parts = [
            self.t.customer.select(
                key(link, "c_custkey").alias("salnk_key"),
                key(first, "c_custkey").alias("key1"),
                key(second, "c_custkey").alias("key2"),
                F.lit(role1).alias("role1"),
                F.lit(role2).alias("role2"),
            )
            for link, first, second, role1, role2 in kinds
        ]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    @cached_property
    def equipment_links(self) -> DataFrame:
        return self.t.orders.select(
            key("L", "o_orderkey").alias("link_key"),
            key("A", "o_custkey").alias("site_key"),
            key("Q", "o_orderkey").alias("equipment_key"),
        )

    @cached_property
    def register_links(self) -> DataFrame:
        return self.t.orders.select(
            key("G", "o_orderkey").alias("reg_link_key"), key("Q", "o_orderkey").alias("equipment_key")
        )

    # --- satellites of sites -----------------------------------------------

    @cached_property
    def ids(self) -> DataFrame:
        return self.versions(
            salnk_key=key("T", "cust"),
            date_from=F.lit("19950101"),
            time_from=F.lit("000000"),
            date_to=F.lit(OPEN_END_TEXT),
            checksum=F.col("checksum"),
        )

    @cached_property
    def installs(self) -> DataFrame:
        return self.versions(
            salnk_key=key("N", "cust"), date_from=F.lit("19950101"), date_to=F.lit(OPEN_END_TEXT)
        )

    @cached_property
    def holdings(self) -> DataFrame:
        end = F.when(F.col("st") == "F", later(2000)).otherwise(OPEN_END_TEXT)
        return self.versions(link_key=key("L", "seq"), ab=F.col("ab"), bis=end)

    @cached_property
    def status(self) -> DataFrame:
        return self.versions(
            site_key=key("E", "cust"),
            from_dt=F.col("ab"),
            to_dt=F.when(F.col("price") > 100000, OPEN_END_TEXT).otherwise("20200101"),
            status=F.concat(F.lit(" "), F.col("st")),
            checksum=F.col("checksum"),
        )

    @cached_property
    def registers(self) -> DataFrame:
        return self.t.lsat.select(
            key("G", "l_orderkey").alias("reg_link_key"),
            F.col("l_linenumber").alias("register_no"),
            F.col("l_returnflag").alias("suffix"),
            F.col("l_linestatus").alias("kind"),
            "ab",
            "bis",
            "extract_ts",
            F.struct(*LSAT_TIES).alias("seq"),
        )

    def _groups(self, line_status: str) -> DataFrame:
        return self.t.lsat.filter(F.col("l_linestatus") == line_status).select(
            hash_key("l_orderkey", "l_linenumber").alias("group_key"),
            key("Q", "l_orderkey").alias("logical_key"),
            F.when(F.col("l_returnflag") != "N", "Z").otherwise("W").alias("kombinat"),
            F.concat(F.lit(" P"), F.col("l_partkey").cast("string")).alias("device_id"),
            key("M", "l_suppkey").alias("meter_key"),
            "ab",
            "bis",
            "extract_ts",
            F.struct(*LSAT_TIES).alias("seq"),
            F.lit("U").alias("change_type"),
        )

    @cached_property
    def device_groups(self) -> DataFrame:
        return self._groups("F").drop("meter_key")

    @cached_property
    def meter_groups(self) -> DataFrame:
        return self._groups("O").drop("device_id")

    @cached_property
    def equipment(self) -> DataFrame:
        return self.t.supplier.select(
            key("M", "s_suppkey").alias("meter_key"),
            F.col("s_name").alias("device_id"),
            F.lit("2000-01-01").cast("timestamp_ntz").alias("extract_ts"),
            F.col("s_suppkey").alias("seq"),
            F.lit("U").alias("change_type"),
        )

    # --- meters of the timeline ---------------------------------------------

    @cached_property
    def fitted(self) -> DataFrame:
        return self.versions(
            eq_link_key=key("Z", "seq"), meter_key=key("Z", "seq"), device_id=F.concat(F.lit("D"), F.col("seq").cast("string"))
        )

    @cached_property
    def fitted_groups(self) -> DataFrame:
        return self.versions(
            group_key=key("Z", "seq"),
            kombinat=F.when(F.col("price") > 50000, "Z").otherwise("W"),
            ab=F.col("ab"),
            bis=F.lit(OPEN_END_TEXT),
            meter_key=key("Z", "seq"),
            logical_key=key("Q", "seq"),
        )


# The later versions of :class:`AmendedVault` as SQL: which orders have one and what it says.
AMENDED_SQL = """SELECT seq, cust, st, pri, price, ab, extract_ts, change_type, 1 AS version FROM ov
    UNION ALL SELECT seq, cust, st, pri, price, ab, extract_ts + to_days(40), CASE WHEN pri = '2-HIGH' THEN 'D' ELSE 'U' END, 2 FROM ov WHERE price > 90000"""


class AmendedVault(Vault):
    """Holdings, equipment and groups with several versions of a key.

    The dearer orders get a second version forty days later, which changes the
    payload or is a tombstone, and every key gets a tombstone after the run, which
    a query as of the run must not see.
    """

    AFTER_RUN = "2003-05-01"

    def versions(self, keep: Column | None = None, **columns: Column) -> DataFrame:
        """Versions that carry what decides whether and how they are amended, so that no join has to find it."""
        return super().versions(keep, **columns, order_price=F.col("price"), order_pri=F.col("pri"))

    def _amend(self, first: DataFrame, **changes: Column) -> DataFrame:
        second = first.filter((F.col("order_price") > 90000) & F.col("seq").isNotNull()).withColumns(
            {
                "extract_ts": F.col("extract_ts") + F.expr("INTERVAL 40 DAYS"),
                "change_type": decode("order_pri", {"2-HIGH": "D"}, "U"),
                **changes,
            }
        )
        kind = first.schema["extract_ts"].dataType
        gone = first.withColumns({"extract_ts": F.lit(self.AFTER_RUN).cast(kind), "change_type": F.lit("D")})
        return first.unionByName(second).unionByName(gone).drop("order_price", "order_pri")

    @cached_property
    def holdings(self) -> DataFrame:
        shorter = day_text(F.date_add(F.to_date("ab", "yyyyMMdd"), 900))
        return self._amend(super().holdings, bis=shorter)

    @cached_property
    def fitted(self) -> DataFrame:
        return self._amend(super().fitted, device_id=F.concat(F.lit("E"), F.col("seq").cast("string")))

    @cached_property
    def fitted_groups(self) -> DataFrame:
        return self._amend(super().fitted_groups, kombinat=F.when(F.col("order_pri") == "1-URGENT", "W").otherwise(F.col("kombinat")))
