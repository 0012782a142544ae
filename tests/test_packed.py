"""What large joins shuffle: packed keys, shared shuffles, counts by hash, buckets that grow with the table."""

from __future__ import annotations

from functools import partial

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vaultframe.adapters import Tables
from vaultframe.checks.standins import AmendedVault
from vaultframe.functions.keys import pack, unpack
from vaultframe.operators import joins
from vaultframe.plans import meter_timeline
from vaultframe.sources import sink

SF = "/root/testdata/sf0.001"
ODD = ["ab" * 20, "AB" * 20, "ab" * 19, "zz" * 20, "ä" * 40, "", " ", "\0", None]


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_packed_keys_are_one_to_one(spark):
    keys = spark.createDataFrame([(k, 1) for k in ODD], "k STRING, n INT")
    packed = pack(keys, "k", "n")
    assert packed.dtypes == [("k", "binary"), ("n", "int")]
    assert [r.k for r in unpack(packed, "k", "n").collect()] == ODD
    assert packed.select("k").distinct().count() == len(ODD)
    assert packed.select(F.length("k")).first()[0] == 20


def test_same_as_roles_with_odd_keys_packed_and_never_broadcast(spark, rows):
    hub = spark.createDataFrame([(k, f"b{i}") for i, k in enumerate(ODD)], "k STRING, bk STRING")
    link = spark.createDataFrame([(i, k, ODD[0]) for i, k in enumerate(ODD)], "n INT, k1 STRING, k2 STRING")
    named = joins.same_as_roles(link, hub, "k", "bk", {"k1": "one", "k2": "two"})
    assert "unhex" in plan(named) and "Broadcast" not in plan(named)
    assert rows(named, "n", "k1", "k2", "one", "two") == [(i, k, ODD[0], f"b{i}", "b0") for i, k in enumerate(ODD) if k is not None]
    numbers = joins.same_as_roles(link.drop("k1", "k2").withColumn("k1", F.col("n")), hub.withColumn("k", F.lit(3)), "k", "bk", {"k1": "one"})
    assert {r.k1 for r in numbers.collect()} == {3}


@pytest.mark.parametrize("key", ["p_suffix", "p_suffix_running", "p_site_register", "p_site_register_after_rank"])
def test_plans_shuffle_packed_keys(spark, key):
    assert "unhex" in plan(entry.queries()[key](spark, SF))


def test_meters_with_many_attribute_periods_give_the_same_rows(spark, rows, monkeypatch):
    common = "ab STRING, bis STRING, extract_ts INT, seq INT, change_type STRING"
    kinds = [("a", "R", 5), ("a", "T", 4), ("b", "R", 2), ("c", "T", 3), (None, "R", 1)]
    some = [(m, f, f"v{i}", f"2020{i + 1:02d}01", f"2020{i + 2:02d}15", 1, i, "U") for m, f, n in kinds for i in range(n)]
    some += [("d", "R", "x", "20200101", "20200201", 1, 1, "U"), ("d", "T", "y", "20210101", "20210201", 1, 1, "U")]
    some += [("b", "R", "gone", "20200101", "20200215", 2, 1, "D"), ("f", "R", "gone", "20200101", "20200215", 2, 1, "D")]
    attributes = spark.createDataFrame(some, f"meter_key STRING, fname STRING, value STRING, {common}")
    meters = spark.createDataFrame([(m, s) for m in "abcdef" for s in (1, 2)] + [(None, 9)], "meter_key STRING, site INT")
    columns = ["meter_key", "site", "r", "r_from", "r_to", "t", "t_from", "t_to"]

    def found():
        return rows(meter_timeline.with_attributes(meters, attributes, "R", "T", ("r", "t")).select(columns).fillna("-"))

    plain = found()
    assert {r[0] for r in plain} == {"a", "b", "c", "e", "f", "-"}  # the attributes of d never meet
    assert len([r for r in plain if r[0] == "b"]) == 2 and len([r for r in plain if r[0] == "a"]) > 10
    monkeypatch.setattr(meter_timeline, "crowded_keys", partial(joins.crowded_keys, few_pairs=0))
    assert found() == plain
    monkeypatch.setattr(meter_timeline, "SLICE_ROWS", 1)
    assert found() == plain


def test_keys_of_many_rows_count_as_crowded_when_asked(spark, rows):
    left = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",), (None,)], "k STRING")
    right = spark.createDataFrame([("b",), ("b",)], "k STRING")
    assert joins.crowded_keys(left, right, ["k"]) is None
    assert rows(joins.crowded_keys(left, right, ["k"], few_pairs=3)) == [("b",)]
    assert rows(joins.crowded_keys(left, right, ["k"], few_pairs=3, most_rows=2)) == [("a",), ("b",)]


def test_amended_versions_need_no_join(spark):
    v = AmendedVault(Tables(spark, SF))
    for name in ("holdings", "fitted", "fitted_groups"):
        df = getattr(v, name)
        assert "Join" not in plan(df) and "order_pri" not in df.columns


def test_buckets_grow_with_the_table(spark):
    one, many = spark.range(10), spark.range(2_100)
    assert sink.bucket_count(one, many, least=8, rows=1_000) == 8
    assert sink.bucket_count(one, many, least=8, rows=100) == 32
