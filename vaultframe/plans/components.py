"""Component register and the asset keys of two systems."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultframe.operators.joins import tree_parent_clone
from vaultframe.operators.versions import first_per_key, newest, not_deleted


def component_register(components: DataFrame, hub_component: DataFrame, classes: DataFrame) -> DataFrame:
    """Live components with asset type, clone and parent.

    The asset type is the class abbreviation, or the class name when that is
    empty. Components whose type is a blank are dropped at the end, after they
    have served as clones and parents of others.
    """
    rows = first_per_key(components, ["component_key"], newest("extract_ts", "seq")).filter(not_deleted())
    rows = rows.join(hub_component, "component_key", "left")
    kinds = classes.filter(not_deleted()).select(F.col("class_index").alias("component_class"), "abbreviation", "class_name")
    rows = rows.join(kinds, "component_class", "left")
    rows = rows.withColumn("asset_type", F.coalesce(F.nullif("abbreviation", F.lit("")), "class_name"))
    rows = rows.select(
        "component_key", "component_id", "pathname", "alias", "component_class", "parent_id", "clone_id", "asset_type"
    )
    carry = ["component_key", "pathname", "alias"]
    tree = tree_parent_clone(rows, "component_id", "parent_id", "clone_id", carry)
    return tree.filter(F.col("asset_type").isNull() | (F.col("asset_type") != " "))


def asset_key_match(
    equipment: DataFrame,
    characteristics: DataFrame,
    components: DataFrame,
    component_attributes: DataFrame,
    *,
    profile: str = "CB",
    user_status: str = "SERV",
    prefixes: tuple[str, ...] = ("DS-%", "TS-%"),
    system_key: str = "SCADA_KEY",
    alias: str = "ALIAS",
) -> DataFrame:
    """Keys of in-service breakers in the asset system beside those of the control system.

    The derived key is the control system's when it is there and differs.
    """
    located = reduce(lambda a, b: a | b, [F.col("location").like(p) for p in prefixes])
    wanted = equipment.filter((F.col("cat_profile") == profile) & (F.col("user_status") == user_status) & located)

    def values(name: str, out: str) -> DataFrame:
        rows = characteristics.filter(F.col("char_name") == name)
        return rows.select(F.col("object_no").alias("location"), F.col("value_char").alias(out))

    aliased = wanted.select("equipment_id", "location", "user_status", "object_type").join(values(alias, "alias"), "location")
    keyed = wanted.select("location").join(values(system_key, "system_key"), "location")
    known = components.join(component_attributes, "component_key").select(
        F.col("component_alias").alias("alias"), "composite_key", "device_name"
    )
    rows = aliased.join(keyed, "location").join(known, "alias", "left")
    differs = F.col("composite_key").isNotNull() & (F.col("system_key") != F.col("composite_key"))
    return rows.withColumn("derived_key", F.when(differs, F.col("composite_key")).otherwise(F.col("system_key")))
