from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vaultframe import session
from vaultframe.adapters import Tables
from vaultframe.checks.storage import clustered_join
from vaultframe.operators import digests, quality, versions
from vaultframe.operators.upkeep import CurrentVersions
from vaultframe.operators.versions import newest
from vaultframe.session import new_work_path
from vaultframe.sources import footers

STATE = "k STRING, ts TIMESTAMP_NTZ, seq INT, change_type STRING, v INT"


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(3)
    rows = []
    for seq in range(900):
        key = "hot" if seq % 3 == 0 else None if seq % 50 == 1 else f"k{rng.randint(0, 40)}"
        ts = datetime(2024, 1, 1) + timedelta(hours=rng.randint(0, 90))
        rows.append((key, ts, seq, rng.choice("AUUD"), rng.randint(0, 9)))
    return spark.createDataFrame(rows, STATE)


def test_replay_in_windows_equals_the_full_computation(spark, history, rows):
    want = rows(versions.live(history, ["k"], newest("ts", "seq")))
    by_arrival = [history.filter(f"seq % 4 = {n}") for n in (2, 0, 3, 1)]  # every window has late rows and tombstones
    by_time = [history.filter(f"ts >= TIMESTAMP_NTZ'2024-01-0{d}' AND ts < TIMESTAMP_NTZ'2024-01-0{d + 1}'") for d in (1, 2, 3, 4)]
    for n, windows in enumerate((by_arrival, by_time, [*by_time[::-1], by_time[1]])):
        state = CurrentVersions(spark, f"newest_{n}", new_work_path(spark, "newest"), ["k"], ["ts", "seq"], parts=5).create(STATE)
        for window in windows:
            state.merge(window)
        assert rows(state.live()) == want
        assert state.merge(history.filter("seq < 0")) == 0
        assert state.drop_replaced() > 0 and rows(state.live()) == want


def test_a_window_rewrites_only_the_parts_of_its_keys(spark, history, rows):
    state = CurrentVersions(spark, "newest_parts", new_work_path(spark, "newest"), ["k"], ["ts", "seq"], parts=16).create(STATE)
    state.merge(history)
    before = set(spark.table("newest_parts").inputFiles())
    late = history.filter("k = 'hot'").limit(1).withColumn("ts", F.lit("2030-01-01").cast("timestamp_ntz")).withColumn("change_type", F.lit("D"))
    assert state.merge(late) == 1
    assert len(before - set(spark.table("newest_parts").inputFiles())) == 1
    assert rows(state.live().filter("k = 'hot'")) == [] and state.rows().filter("k = 'hot'").count() == 1


def test_a_failed_merge_keeps_the_state(spark, history, rows):
    state = CurrentVersions(spark, "newest_kept", new_work_path(spark, "newest"), ["k"], ["ts", "seq"], parts=4).create(STATE)
    state.merge(history.filter("seq < 500"))
    before = rows(state.rows())
    bad = history.withColumn("v", F.when(F.col("seq") == 899, F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        state.merge(bad)
    assert rows(state.rows()) == before


def test_counts_come_from_the_footers(spark):
    path = new_work_path(spark, "counted")
    spark.range(1000).selectExpr("id", "id % 7 AS v", "uuid() AS s").repartition(3).write.parquet(path)
    with footers.reading_footers(spark):
        plan = footers.counting_plan(spark, {"a": path, "b": path})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 2
    assert sorted(map(tuple, footers.footer_counts(spark, {"a": path, "b": path}).collect())) == [("a", 1000), ("b", 1000)]
    assert tuple(footers.footer_extremes(spark, {"a": (path, "id")}).first()) == ("a", 0, 999)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_digests_find_exactly_the_differing_keys(spark, rows, monkeypatch):
    monkeypatch.setattr(digests, "FANOUT", 16)
    a = spark.range(5000).selectExpr("CASE WHEN id % 500 = 3 THEN NULL ELSE id % 1700 END AS k", "id AS v", "CASE WHEN id % 2 = 0 THEN 'x' END AS s")
    assert digests.tables_equal(a, a.orderBy(F.desc("v")).select("s", "v", "k"), ["k"])
    assert digests.differing_keys(a, a.repartition(5), ["k"]).count() == 0
    b = a.filter("v <> 77").withColumn("s", F.when(F.col("v") == 1801, "y").otherwise(F.col("s")))
    b = b.union(a.filter("v = 42")).union(spark.sql("SELECT 9999L, 1L, 'new'")).withColumn("v", F.when(F.col("k").isNull(), -F.col("v")).otherwise(F.col("v")))
    got = {r["k"]: (r["rows_a"], r["rows_b"]) for r in digests.differing_keys(a, b, ["k"]).collect()}
    count = lambda df: {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    na, nb = count(a), count(b)
    assert got == {k: (na.get(k, 0), nb.get(k, 0)) for k in (77, 101, 42, 9999, None)}
    assert not digests.tables_equal(a, b, ["k"])


def test_clustered_tables_need_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = clustered_join(Tables(spark, "/root/testdata/sf0.001"), 4)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_audits_ride_along_with_the_load(spark):
    path, loads = new_work_path(spark, "audited"), []
    df = spark.createDataFrame([("a", "web1", None), ("b", None, 3), (None, "tape", 12345)], "id STRING, source STRING, n INT")

    def load(frame):
        loads.append(frame._jdf.queryExecution().optimizedPlan().toString())
        frame.write.parquet(path)

    audits = {"unexpected": quality.unexpected("source", "web%"), "too_long": quality.too_long({"n": 4, "id": 9}), "missing": quality.missing(["id", "n"])}
    assert quality.audit_on_load(df, audits, load) == {"rows": 3, "unexpected": 1, "too_long": 1, "missing": 2}
    assert len(loads) == 1 and loads[0].count("CollectMetrics") == 1 and spark.read.parquet(path).count() == 3


def test_a_cluster_session_without_shared_folder_is_refused():
    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context  # noqa: N815

        class conf:  # noqa: N801
            get = staticmethod(lambda name, default=None: default if name == "spark.checkpoint.dir" else "wh")

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(Session)
    Context.master = "local[4]"
    assert session.work_dir(Session) == "wh/_work"
