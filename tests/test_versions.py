from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vaultframe.operators import versions, windows
from vaultframe.operators.versions import newest, oldest

SAT = "k STRING, extract_ts TIMESTAMP_NTZ, seq INT, change_type STRING, status STRING"


@pytest.fixture(scope="module")
def sat(spark):
    day = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [
            ("gone", day, 1, "A", "A"),
            ("gone", day + timedelta(days=1), 2, "D", "A"),
            ("back", day, 1, "A", "A"),
            ("back", day + timedelta(days=1), 2, "D", "A"),
            ("back", day + timedelta(days=2), 3, "U", "X"),
            ("tie", day, 1, "U", "A"),
            ("tie", day, 2, "U", "B"),
        ],
        SAT,
    )


def test_tombstone_rules(sat, rows):
    order = newest("extract_ts", "seq")
    assert rows(versions.live(sat, ["k"], order, "after"), "k", "seq") == [("back", 3), ("tie", 2)]
    assert rows(versions.live(sat, ["k"], order, "before"), "k", "seq") == [("back", 3), ("gone", 1), ("tie", 2)]
    assert versions.live(sat, ["k"], order, "all").count() == 5
    with pytest.raises(ValueError):
        versions.live(sat, ["k"], order, "sometimes")


def test_filter_place_changes_the_answer(sat, rows):
    order, is_a = newest("extract_ts", "seq"), F.col("status") == "A"
    before = versions.current_version(sat, ["k"], order, pre=is_a)
    after = versions.current_version(sat, ["k"], order, post=is_a)
    assert rows(before, "k", "seq") == [("back", 2), ("gone", 2), ("tie", 1)]
    assert rows(after, "k", "seq") == [("gone", 2)]


def test_current_version_has_unique_keys(sat):
    picked = versions.current_version(sat, ["k"], oldest("extract_ts", "seq"))
    assert picked.count() == picked.select("k").distinct().count() == 3


def test_last_of_day_and_periods(spark, rows):
    base = datetime(2024, 1, 1, 8)
    df = spark.createDataFrame(
        [("a", base, 1), ("a", base + timedelta(hours=3), 2), ("a", base + timedelta(days=40), 3), (None, base, 4)],
        "k STRING, ts TIMESTAMP_NTZ, v INT",
    )
    daily = versions.current_per_day(df, ["k"], "ts")
    assert rows(daily, "v") == [(2,), (3,), (4,)]
    periods = versions.validity_from_versions(daily, ["k"], "ts")
    far = date(9999, 12, 31)
    assert rows(periods, "v", "valid_from", "valid_to") == [
        (2, date(2024, 1, 1), date(2024, 2, 10)),
        (3, date(2024, 2, 10), far),
        (4, date(2024, 1, 1), far),
    ]


def test_top2_and_eav(spark, rows):
    phones = spark.createDataFrame(
        [("a", "1", "X"), ("a", "2", " "), ("a", "3", " "), ("b", "9", " ")], "k STRING, tel STRING, flag STRING"
    )
    out = versions.top2_values(phones, ["k"], "tel", newest("flag", "tel"), ("t1", "t2"))
    assert rows(out, "k", "t1", "t2") == [("a", "1", "3"), ("b", "9", None)]
    eav = spark.createDataFrame(
        [("m", "READ", "x", "1", "2"), ("m", "KIND", "y", "3", "4"), ("n", "KIND", None, "5", "6")],
        "k STRING, fname STRING, value STRING, ab STRING, bis STRING",
    )
    assert rows(versions.eav_attribute(eav, ["k"], "KIND", "kind")) == [("m", "y", "3", "4")]
    assert set(rows(versions.eav_columns(eav, ["k"], ["READ", "KIND"]))) == {("m", "x", "y"), ("n", None, None)}


@pytest.fixture(scope="module")
def events(spark):
    """One key holds a third of all rows; some keys and times are null or equal."""
    rng = random.Random(7)
    base = datetime(2023, 1, 1)
    data = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rng.randint(1, 60)
        ts = None if rng.random() < 0.01 else base + timedelta(hours=rng.randint(0, 12000))
        data.append((None if rng.random() < 0.02 else key, ts, i, rng.randint(0, 99)))
    return spark.createDataFrame(data, "k INT, ts TIMESTAMP_NTZ, id INT, v INT")


@pytest.mark.parametrize("rule", ["month", "data", "plain"])
def test_sliced_windows_equal_plain_windows(events, rows, rule, monkeypatch):
    cut, order = windows.by_month("ts") if rule == "month" else None, ["ts", "id"]
    if rule == "data":
        monkeypatch.setattr(windows, "SLICE_ROWS", 60)
        assert windows.hot_keys(events, ["k"]) is not None
    plain = Window.partitionBy("k").orderBy("ts", "id")
    down = Window.partitionBy("k").orderBy(F.col("ts").desc(), F.col("id").desc())
    peers = Window.partitionBy("k").orderBy("ts")
    got = windows.next_value(events, ["k"], order, {"n": "v"}, cut)
    assert rows(got, "id", "n") == rows(events.select("id", F.lead("v").over(plain)))
    got = windows.previous_value(events, ["k"], order, {"n": "v", "w": "ts"}, cut)
    assert rows(got, "id", "n", "w") == rows(events.select("id", F.lag("v").over(plain), F.lag("ts").over(plain)))
    got = windows.row_numbers(events, ["k"], order, "n", cut, ascending=False)
    assert rows(got, "id", "n") == rows(events.select("id", F.row_number().over(down).cast("long")))
    got = windows.ranks(events, ["k"], ["ts"], "n", cut)
    assert rows(got, "id", "n") == rows(events.select("id", F.rank().over(peers).cast("long")))
    got = windows.running_extremes(events, ["k"], ["ts"], {"lo": "v"}, {"hi": "v"}, cut)
    assert rows(got, "id", "lo", "hi") == rows(events.select("id", F.min("v").over(peers), F.max("v").over(peers)))


def crowded_day(spark):
    """One key has all but a few rows, nine tenths of them on one day and at one sentinel."""
    return spark.range(20_000).selectExpr(
        "0 AS k",
        "CASE WHEN id % 10 = 0 THEN date_add(DATE '2020-01-01', cast(id % 700 AS int)) WHEN id % 10 < 5 THEN DATE '2021-06-01' ELSE DATE '9999-12-31' END AS day",
        "id * 7919 % 20011 AS id",
    ).unionByName(spark.sql("SELECT 1 AS k, DATE '2021-06-01' AS day, 5L AS id"))


def test_a_key_with_its_rows_on_one_day_is_spread(spark, rows, monkeypatch):
    monkeypatch.setattr(windows, "SLICE_ROWS", 1000)
    df, order = crowded_day(spark), ["day", "id"]
    plain, sliced = windows._split(df, ["k"], order, None)
    assert rows(plain, "k") == [(1,)]
    sizes = [r["count"] for r in sliced.groupBy("__slice").count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) >= 10 and max(sizes) <= 4000
    whole = Window.partitionBy("k").orderBy(*order)
    assert rows(windows.next_value(df, ["k"], order, {"n": "id"}), "id", "n") == rows(df.select("id", F.lead("id").over(whole)))
    assert rows(windows.row_numbers(df, ["k"], order, "n"), "id", "n") == rows(df.select("id", F.row_number().over(whole).cast("long")))
    days = Window.partitionBy("k").orderBy("day")  # peers stay together, however many
    assert rows(windows.ranks(df, ["k"], ["day"], "n"), "id", "n") == rows(df.select("id", F.rank().over(days).cast("long")))


def test_few_rows_a_key_take_a_plain_window(events):
    plan = windows.next_value(events, ["k"], ["ts", "id"], {"n": "v"})._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Window") == 1


def test_a_hot_key_is_spread_over_tasks(spark, events):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = windows.next_value(events, ["k"], ["ts", "id"], {"n": "v"}, windows.by_month("ts")).filter("k = 0")
        share = hot.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(share) == 4
    assert max(r["count"] for r in share) < 0.6 * sum(r["count"] for r in share)
