"""The driver's tables in vault roles: hubs, links, satellites, reads.

Each property is a lazy frame. The rules are those of FIXTURES.md, section B.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultframe.functions.columns import decode
from vaultframe.functions.dates import OPEN_END_TEXT, day_text, open_end
from vaultframe.functions.keys import hash_key
from vaultframe.operators import windows
from vaultframe.session import stage

RUN_EVENTS = "2024-01-20"
RUN_ORDERS = "1999-06-30"
COMMS_BY_PRIORITY = {
    "1-URGENT": "MESH",
    "2-HIGH": "MICROAP",
    "3-MEDIUM": "WIMAX",
    "4-NOT SPECIFIED": "3G",
}
COMMS_GROUPS = {"MESH": ["MICROAP", "MESH"], "WIMAX": ["3G", "WIMAX"]}
LSAT_KEYS = ["l_orderkey", "l_linenumber"]
LSAT_TIES = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]


class Tables:
    """Driver tables of one scale folder, and the vault roles built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    @cached_property
    def hub_site(self) -> DataFrame:
        return self.customer.select(hash_key("c_custkey").alias("site_key"), F.col("c_custkey").alias("site_id"))

    @cached_property
    def hub_meter(self) -> DataFrame:
        return self.orders.select(hash_key("o_orderkey").alias("meter_key"), F.col("o_orderkey").alias("meter_id"))

    @cached_property
    def hub_device(self) -> DataFrame:
        ids = self.events.select("user_id").distinct()
        return ids.select(hash_key("user_id").alias("device_key"), F.col("user_id").alias("device_id"))

    @cached_property
    def lnk_site_meter(self) -> DataFrame:
        return self.orders.select(
            hash_key("o_orderkey", "o_custkey").alias("link_key"),
            hash_key("o_custkey").alias("site_key"),
            hash_key("o_orderkey").alias("meter_key"),
        )

    @cached_property
    def sat(self) -> DataFrame:
        """Satellite with tombstones: one parent per user."""
        return self.events.select(
            "event_id",
            "user_id",
            "event_type",
            "value",
            "props",
            F.col("ts").alias("extract_ts"),
            (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("load_ts"),
            decode("event_type", {"error": "D", "signup": "A"}, "U").alias("change_type"),
        )

    @cached_property
    def lsat(self) -> DataFrame:
        """Link satellite with text periods: one parent per order line."""
        ab = day_text("l_shipdate")
        closed = day_text(F.date_add(F.col("l_shipdate").cast("date"), F.col("l_quantity").cast("int")))
        return self.lineitem.withColumns(
            {
                "extract_ts": F.col("l_shipdate"),
                "ab": ab,
                "bis": F.when(F.col("l_returnflag") == "N", OPEN_END_TEXT).otherwise(closed),
            }
        ).drop("l_shipdate")

    @cached_property
    def eav(self) -> DataFrame:
        """Name/value satellite: a value lasts to the user's next one of its name."""
        rows = self.events.select(
            "user_id",
            F.col("event_type").alias("fname"),
            "value",
            day_text("ts").alias("ab"),
            F.col("ts").alias("extract_ts"),
        )
        chained = windows.next_value(
            rows, ["user_id", "fname"], ["extract_ts"], {"bis": "ab"}
        )
        return chained.withColumn("bis", F.coalesce("bis", F.lit(OPEN_END_TEXT)))

    @cached_property
    def dated(self) -> DataFrame:
        """Dated attribute periods: one attribute per customer and priority."""
        rows = self.orders.select(
            F.col("o_custkey").alias("site"),
            F.col("o_orderpriority").alias("attribute"),
            F.col("o_orderkey").alias("val"),
            F.col("o_orderdate").cast("date").alias("p_from"),
            "o_orderdate",
        )
        chained = windows.next_value(
            rows, ["site", "attribute"], ["o_orderdate", "val"], {"p_to": "p_from"}
        )
        return stage(chained.withColumn("p_to", F.coalesce("p_to", open_end())).drop("o_orderdate"), "dated")

    def attribute(self, priority: str, value: str) -> DataFrame:
        """One dated attribute with its own column names."""
        return self.dated.filter(F.col("attribute") == priority).select(
            "site", F.col("val").alias(value), F.col("p_from").alias(f"{value}_from"), F.col("p_to").alias(f"{value}_to")
        )

    @cached_property
    def reads(self) -> DataFrame:
        """Half-hour interval reads, one channel per user."""
        half_hour = (F.floor(F.minute("ts") / 30) * 30).cast("int")
        midnight = F.col("ts").cast("date").cast("timestamp_ntz")
        return self.events.select(
            F.col("user_id").alias("channel_id"),
            (midnight + F.make_dt_interval(hours=F.hour("ts"), mins=half_hour)).alias("interval_end"),
            F.lit(1800).alias("interval_len"),
            F.col("value").alias("lp_value"),
            decode("event_type", {"click": "VAL", "view": "est "}, "REJ").alias("status"),
            F.col("event_type").alias("change_method"),
            (F.col("user_id") % F.lit(5)).cast("int").alias("org_id"),
            F.col("ts").alias("extract_ts"),
            (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("load_ts"),
            F.col("ts").cast("date").alias("extract_day"),
        )

    @cached_property
    def comms(self) -> DataFrame:
        """Meters with their module type."""
        return self.orders.select(
            "o_orderkey",
            F.col("o_custkey").alias("device_id"),
            "o_orderdate",
            decode("o_orderpriority", COMMS_BY_PRIORITY).alias("module"),
        )

    @cached_property
    def geometry(self) -> DataFrame:
        """Site location as WKT, in millimetres."""
        x = F.lit(1_000_000_000) + (F.col("c_custkey") % 200 - 100) * 1_000_000
        y = F.lit(1_000_000_000) + (F.col("c_custkey") % 150 - 75) * 1_000_000
        return self.customer.select(
            F.col("c_custkey").alias("site"),
            F.concat(F.lit("POINT("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")")).alias("location"),
            F.col("c_nationkey").alias("substation"),
        )

    @cached_property
    def tree(self) -> DataFrame:
        """Component tree over parts."""
        return self.part.select(
            F.col("p_partkey").alias("component_id"),
            F.col("p_name").alias("pathname"),
            F.col("p_brand").alias("alias"),
            F.floor(F.col("p_partkey") / 10).cast("long").alias("parent_id"),
            F.when(F.col("p_partkey") % 7 == 0, F.col("p_partkey") - 1).alias("clone_id"),
            F.col("p_type").alias("class_name"),
            F.when(F.col("p_size") % 5 == 0, F.lit(" ")).otherwise(F.upper(F.substring("p_type", 1, 3))).alias("abbreviation"),
        )

    @cached_property
    def blanks(self) -> DataFrame:
        """Text columns with blanks: documents and their label, if any."""
        return self.documents.select("doc_id", "lang", "source").join(self.labels.select("doc_id", "quality"), "doc_id", "left").select(
            "doc_id",
            "lang",
            F.concat(F.lit(" "), "source", F.lit(" ")).alias("source"),
            F.coalesce(F.col("quality").cast("string"), F.lit("  ")).alias("quality"),
        )
