from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from vaultframe.operators import timeline

FAR = date(9999, 12, 31)


def d(day: int) -> date:
    return date(2024, 1, day)


def test_short_slices_leave_holes_and_neighbours_step_back(spark, rows):
    days = spark.createDataFrame([("s", d(1)), ("s", d(5)), ("s", d(6)), ("s", d(10)), ("s", FAR)], "k STRING, day DATE")
    out = timeline.clean_slices(timeline.slices(days, ["k"]), ["k"])
    # 5..6 is too short: the slice before it keeps its end, the next two touch.
    assert rows(out, "from_dt", "to_dt") == [(d(1), d(5)), (d(6), d(9)), (d(10), FAR)]
    cut = timeline.clean_slices(timeline.slices(days, ["k"]), ["k"], min_end=d(10))
    assert rows(cut, "from_dt", "to_dt") == [(d(6), d(9)), (d(10), FAR)]


def test_boundaries_drop_nulls_and_repeats(spark, rows):
    df = spark.createDataFrame([("s", d(1), None), ("s", d(1), d(3)), ("t", None, None)], "k STRING, a DATE, b DATE")
    assert rows(timeline.boundaries(df, ["k"], ["a", "b"])) == [("s", d(1)), ("s", d(3))]


def test_slices_of_a_key_never_overlap_and_carry_attributes(spark, rows):
    a = spark.createDataFrame([("s", 1, d(1), d(11)), ("s", 2, d(11), FAR), ("t", 3, d(2), d(9))], "k STRING, a INT, af DATE, at DATE")
    b = spark.createDataFrame([("s", 7, d(5), d(20))], "k STRING, b INT, bf DATE, bt DATE")
    cuts = timeline.timeline([(a, ["af", "at"]), (b, ["bf", "bt"])], ["k"])
    out = timeline.time_slice(cuts, ["k"], [(a, ("af", "at"), "inner"), (b, ("bf", "bt"), "left")])
    assert rows(out, "k", "from_dt", "to_dt", "a", "b") == [
        ("s", d(1), d(4), 1, None),
        ("s", d(5), d(10), 1, 7),
        ("s", d(11), d(19), 2, 7),
        ("s", d(20), FAR, 2, None),
        ("t", d(2), d(9), 3, None),
    ]
    pairs = out.alias("x").join(out.alias("y"), "k").filter(
        (F.col("x.from_dt") < F.col("y.from_dt")) & (F.col("x.to_dt") >= F.col("y.from_dt"))
    )
    assert pairs.count() == 0


def test_array_timeline(spark, rows):
    df = spark.createDataFrame(
        [
            ("s", "m", "20200101", "20200601", "20200101", "20251231"),
            ("s", "m", "20200602", "99991231", "20200101", "20251231"),
            ("s", "m", "20300101", "99991231", "20200101", "20251231"),
            ("s", "n", None, None, "20200101", "20200201"),
        ],
        "k STRING, m STRING, rf STRING, rt STRING, inst STRING, rem STRING",
    )
    out = timeline.array_timeline(df, ["k", "m"], ["rf", "inst"], ["rt", "rem"], "rem", ["rf"], F.substring("min_to", 1, 4))
    assert rows(out, "m", "timeline_from", "timeline_to") == [
        ("m", "20200101", "20200601"),
        ("m", "20200602", "20251231"),
        ("n", "20200101", "20200201"),
    ]


def test_leading_gap_and_span(spark, rows):
    df = spark.createDataFrame([("s", d(1), d(9), "a", "b"), ("s", d(1), d(5), "0", "c")], "k STRING, o DATE, f DATE, ab STRING, bis STRING")
    assert rows(timeline.leading_gap(df, ["k"], "o", "f")) == [("s", d(1), d(4))]
    assert rows(timeline.span(df, ["k"], "ab", "bis")) == [("s", "0", "c")]


def test_rank_keeps_ties(spark):
    df = spark.createDataFrame([("s", 2, 1), ("s", 2, 2), ("s", 1, 3)], "k STRING, p INT, id INT")
    assert timeline.rank_slices(df, ["k"], [F.col("p").desc()]).count() == 2
    assert timeline.dedup_slices(df, ["k"], [F.col("p").desc(), F.col("id")]).count() == 1
