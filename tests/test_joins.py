from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from vaultframe.functions.columns import fold_category
from vaultframe.operators import joins

FAR = date(9999, 12, 31)
GROUPS = {"MESH": ["MICROAP", "MESH"], "WIMAX": ["3G", "WIMAX"]}


def periods(rng: random.Random, n: int, keys: int) -> list[tuple]:
    out = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rng.randint(1, keys)
        start = date(2010, 1, 1) + timedelta(days=rng.randint(0, 4000))
        end = FAR if rng.random() < 0.3 else start + timedelta(days=rng.randint(-20, 900))
        if rng.random() < 0.02:
            start = FAR
        if rng.random() < 0.02:
            end = None
        out.append((None if rng.random() < 0.02 else key, start, end, i))
    return out


@pytest.mark.parametrize("few", [0, 200, 4096, None])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_overlap_join_equals_all_pairs(spark, rows, few, how):
    rng = random.Random(11)
    left, right = periods(rng, 240, 12), periods(rng, 200, 12)
    a = spark.createDataFrame(left, "k INT, a_from DATE, a_to DATE, a INT")
    b = spark.createDataFrame(right, "k INT, b_from DATE, b_to DATE, b INT")
    got = joins.overlap_join(a, b, ["k"], ("a_from", "a_to"), ("b_from", "b_to"), how, few)
    want = []
    for k, f, t, i in left:
        hits = [
            j for k2, f2, t2, j in right
            if k is not None and k == k2 and None not in (f, t, f2, t2) and t2 > f and f2 < t
        ]
        want += [(i, j) for j in hits] or ([(i, None)] if how == "left" else [])
    assert rows(got, "a", "b") == sorted(want, key=lambda r: [(v is None, v) for v in r])


def test_touching_periods_do_not_match(spark):
    a = spark.createDataFrame([("x", date(2024, 1, 1), date(2024, 1, 10))], "k STRING, f DATE, t DATE")
    b = spark.createDataFrame([("x", date(2024, 1, 10), FAR), ("x", date(2023, 1, 1), date(2024, 1, 1))], "k STRING, g DATE, u DATE")
    assert joins.overlap_join(a, b, ["k"], ("f", "t"), ("g", "u")).count() == 0


def test_unknown_module_is_never_matched(spark, rows):
    meters = spark.createDataFrame([(1, "3G"), (2, "PLC"), (3, "MESH"), (4, None)], "d INT, m STRING")
    seen = spark.createDataFrame([(1, "WIMAX"), (2, "MESH"), (3, "WIMAX"), (4, None)], "d INT, network STRING")
    fold = fold_category("m", GROUPS)
    assert rows(joins.not_exists_mapped(meters, seen, ["d"], fold, "network"), "d") == [(2,), (3,), (4,)]
    tagged = seen.withColumn("hit", F.lit(1))
    joined = joins.join_mapped(meters, tagged, ["d"], fold, "network")
    assert set(rows(joined, "d", "hit")) == {(1, 1), (2, None), (3, None), (4, None)}


def test_default_branch_and_reference_filter(spark, rows):
    meters = spark.createDataFrame([(1,), (2,)], "d INT")
    cards = spark.createDataFrame([(1, "3G"), (1, "MESH")], "d INT, kind STRING")
    assert rows(joins.default_branch(meters, cards, ["d"], {"kind": "MESH"})) == [(1, "3G"), (1, "MESH"), (2, "MESH")]
    ref = spark.createDataFrame([(1,), (1,), (1,)], "d INT")
    assert rows(joins.ref_filter_join(meters, ref, "d")) == [(1,)]


def test_tree_keeps_nodes_without_clone_or_parent(spark, rows):
    tree = spark.createDataFrame([(1, None, None, "root"), (2, 1, 1, "kid"), (3, 9, None, "lost")], "id INT, p INT, c INT, name STRING")
    out = joins.tree_parent_clone(tree, "id", "p", "c", ["name"])
    assert set(rows(out, "id", "clone_name", "parent_name")) == {(1, None, None), (2, "root", "root"), (3, None, None)}


def celled(df, keys=("k",)):
    return joins._celled(df, [*keys], ("f", "t"), joins.cell_shapes(joins._spans(df, [*keys], ("f", "t")), [*keys]))


def test_a_misread_date_costs_only_its_own_row(spark, rows):
    """Open ends and far dates take a handful of cells, and none of another key's."""
    open_rows = spark.range(4000).selectExpr("id % 2 AS k", "date_add(DATE '2001-02-03', cast(id AS int)) AS f", "DATE '9999-12-31' AS t")
    bad = spark.sql("SELECT 1L AS k, DATE '9999-12-30' AS f, DATE '9999-12-31' AS t UNION ALL SELECT 1L, DATE '0001-01-01', DATE '9999-12-31'")
    for df, most in ((open_rows, 8), (open_rows.union(bad), 12)):
        fans = celled(df).groupBy("k", "f", "t").count()
        assert fans.agg(F.max("count")).first()[0] <= most
        assert fans.filter("k = 0").agg(F.sum("count")).first()[0] <= 2000 * 8
    few = open_rows.union(bad).filter("k = 1 AND (f > DATE '2011-12-01' OR f < DATE '2001-03-20')")
    other = few.selectExpr("k", "f AS g", "t AS u")
    want = few.join(other, "k").filter("u > f AND g < t").count()
    assert joins.overlap_join(few, other, ["k"], ("f", "t"), ("g", "u"), few_pairs=0).count() == want


def test_a_crowded_key_compares_neighbours_only(spark):
    """One key with all rows: cells keep compared pairs near the matching ones, whatever the density."""
    for step, length in ((1, 3), (40, 3), (1, 700)):
        df = spark.range(6000).selectExpr("0 AS k", f"date_add(DATE '1950-01-01', cast(id * {step} AS int)) AS f", f"date_add(DATE '1950-01-01', cast(id * {step} + {length} AS int)) AS t")
        cells = celled(df).groupBy("__cell").count()
        compared = cells.agg(F.sum(F.col("count") * F.col("count"))).first()[0]
        matching = 6000 * (2 * length // step + 1)
        assert compared <= 40 * matching + 6000 * 300
        assert celled(df).count() <= 6000 * 6
