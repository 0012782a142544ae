from __future__ import annotations

from vaultframe.operators import quality
from vaultframe.operators.versions import not_deleted


def test_compare_counts_rows_and_one_sided_keys(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k INT, v STRING")
    b = spark.createDataFrame([(1, None), (3, "y")], "k INT, v STRING")
    out = quality.compare(a, b, ["k", "v"]).first().asDict()
    assert out == {"rows_a": 3, "rows_b": 2, "keys_only_a": 1, "keys_only_b": 1}
    empty = quality.compare(a.filter("k > 9"), b.filter("k > 9"), ["k"]).first()
    assert tuple(empty) == (0, 0, 0, 0)


def test_counts_duplicates_and_audits(spark, rows):
    df = spark.createDataFrame([("A", "1"), ("D", "1"), (None, "333")], "change_type STRING, id STRING")
    assert rows(quality.count_tables({"t": df, "u": df})) == [("t", 3), ("u", 3)]
    assert rows(quality.count_tables({"t": df}, where=not_deleted())) == [("t", 1)]
    assert rows(quality.duplicate_keys(df, ["id"])) == [("1", 2)]
    assert rows(quality.length_audit(df, {"id": 2}), "id") == [("333",)]
    assert rows(quality.null_audit(df, ["change_type"]), "id") == [("333",)]
    assert set(rows(quality.domain_audit(df, "change_type", "A%"))) == {("A", 1, True), ("D", 1, False), (None, 1, None)}
