"""What a plan keeps off the disk: rows that can't meet their join, shuffle files of a finished stage."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from vaultframe import session
from vaultframe.adapters import Tables
from vaultframe.checks.meters import timeline_of
from vaultframe.checks.standins import AmendedVault
from vaultframe.functions.keys import hash_key, pack
from vaultframe.operators import joins
from vaultframe.plans import meter_timeline
from vaultframe.plans.common import current

SF = "/root/testdata/sf0.001"
ODD = ["ab" * 20, "AB" * 20, "", " ", "\0", "ä", None]


def hashed(spark, first: int, last: int):
    return pack(spark.range(first, last).select("id", hash_key("id").alias("k")), "k")


@pytest.mark.parametrize("most_bits", [1 << 28, 1 << 12, 1 << 14])
def test_a_sketch_finds_each_of_its_keys_again(spark, monkeypatch, most_bits):
    monkeypatch.setattr(joins, "MOST_SKETCH_BITS", most_bits)
    sketch = joins.key_sketch(hashed(spark, 0, 3_000), "k")
    found = [r.id for r in joins.may_meet(hashed(spark, 0, 9_000), sketch, "k").select("id").collect()]
    assert set(range(3_000)) <= set(found) and len(found) == len(set(found))
    assert most_bits < 1 << 28 or len(found) < 4_200  # one in ten of the others, about


def test_sketches_of_odd_keys_nulls_and_other_types(spark, rows):
    texts = spark.createDataFrame([(k, i) for i, k in enumerate(ODD)], "k STRING, n INT")
    sketch = joins.key_sketch(texts.unionAll(texts), "k")
    assert rows(joins.may_meet(texts, sketch, "k")) == rows(texts.filter("k IS NOT NULL"))
    numbers = joins.key_sketch(texts, "n")
    assert rows(joins.may_meet(texts.select("n"), numbers, "n")) == [(i,) for i in range(len(ODD))]
    # An INT and a BIGINT may be equal and have other hashes: such rows all have their chance.
    wider = spark.range(100).select(F.col("id").alias("n"))
    assert joins.may_meet(wider, numbers, "n").count() == 100
    assert joins.may_meet(texts.filter("false"), sketch, "k").count() == 0
    none = joins.key_sketch(texts.filter("false"), "k")
    assert joins.may_meet(texts, none, "k").count() == 0


def test_a_version_that_leads_nowhere_still_hides_the_older_ones(spark, rows):
    some = [("g", 1, "here", "x"), ("g", 2, "gone", "y"), ("h", 1, "gone", "x"), ("h", 2, "here", "y"), ("i", 1, None, "x")]
    versions = spark.createDataFrame([(*r, 0, "U") for r in some], "g STRING, extract_ts INT, k STRING, v STRING, seq INT, change_type STRING")
    light = joins.lightened(versions, joins.key_sketch(versions.filter("k = 'here'"), "k"), "k", ["v"])
    assert rows(light, "g", "extract_ts", "k", "v") == [
        ("g", 1, "here", "x"), ("g", 2, None, None), ("h", 1, None, None), ("h", 2, "here", "y"), ("i", 1, None, None),
    ]
    assert rows(current(light, ["g"]).filter("k IS NOT NULL"), "g", "k", "v") == [("h", "here", "y")]


def test_attributes_of_meters_without_a_place_stay_out_of_the_timelines_shuffles(spark, monkeypatch):
    seen = {}

    def spy(meters, attributes, *rest, plainly=meter_timeline.with_attributes):
        seen["meters"] = {bytes(r.meter_key) for r in meters.select("meter_key").distinct().collect()}
        seen["attributes"] = [bytes(r.meter_key) for r in attributes.select("meter_key").collect()]
        return plainly(meters, attributes, *rest)

    monkeypatch.setattr(meter_timeline, "with_attributes", spy)
    t = Tables(spark, SF)
    timeline_of(AmendedVault(t))
    every = t.lineitem.select(F.unhex(hash_key(F.concat(F.lit("Z"), F.col("l_orderkey").cast("string")))).alias("k")).collect()
    needed = [bytes(r.k) for r in every if bytes(r.k) in seen["meters"]]
    assert needed and len(seen["attributes"]) < 0.8 * len(every)
    assert sorted(k for k in seen["attributes"] if k in seen["meters"]) == sorted(needed)


def test_a_stage_gives_back_its_shuffle_files_and_the_setting(spark):
    def shuffled() -> set[str]:
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in files.mkString("|").split("|") if "shuffle_" in f}

    before, setting = shuffled(), spark.conf.get(session.RELEASE, None)
    staged = session.stage(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count(), "released")
    until = time.time() + 30
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert staged.count() == 100 and spark.conf.get(session.RELEASE, None) == setting
