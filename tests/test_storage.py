from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vaultframe.plans.comms_fault import load_comms_faults
from vaultframe.session import new_work_path, run_folder, stage, work_dir
from vaultframe.sources import compaction, files, scan, sink


@pytest.fixture
def runs(spark):
    return spark.createDataFrame(
        [(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, date(2024, 1, 2))], "id INT, run_date DATE"
    )


def test_replace_run_is_idempotent_and_empties_a_day(spark, runs, rows):
    path = new_work_path(spark, "runs")

    def stored():
        return rows(spark.read.schema("id INT, run_date DATE").parquet(path), "id")

    sink.replace_run(runs.filter("id = 1"), path, "run_date", "2024-01-01")
    second = runs.filter("id > 1")
    sink.replace_run(second, path, "run_date", "2024-01-02")
    sink.replace_run(second, path, "run_date", "2024-01-02")
    assert stored() == [(1,), (2,), (3,)]
    sink.replace_run(runs.filter("id < 0"), path, "run_date", "2024-01-02")
    assert stored() == [(1,)]


def test_a_row_of_another_run_fails_the_write(spark, runs):
    path = new_work_path(spark, "runs")
    with pytest.raises(Exception, match="another run"):
        sink.replace_run(runs, path, "run_date", "2024-01-02")
    sink.write_runs(runs, path, "run_date")
    sink.write_runs(runs.filter("id = 2"), path, "run_date")
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2]


def published(spark, path, name):
    spark.sql(f"CREATE TABLE {name} (id INT, run_date DATE) USING parquet PARTITIONED BY (run_date) LOCATION '{path}'")
    return name


@pytest.mark.parametrize("catalog", [False, True])
def test_a_rejected_or_failed_write_keeps_the_old_run(spark, runs, rows, catalog):
    path = new_work_path(spark, "runs")
    table = published(spark, path, "kept_runs") if catalog else None

    def stored():
        return rows(spark.table(table) if catalog else spark.read.parquet(path), "id", "run_date")

    day = date(2024, 1, 2)
    sink.replace_run(runs.filter("id > 1"), path, "run_date", day, table)
    sink.replace_run(runs.filter("id = 1"), path, "run_date", "2024-01-01", table)
    before = stored()
    assert len(before) == 3
    with pytest.raises(Exception, match="another run"):
        sink.replace_run(runs, path, "run_date", day, table)
    assert stored() == before
    # most tasks have written their files when one fails
    half = spark.range(0, 4000, 1, 8).select(F.when(F.col("id") == 3999, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("int").alias("id"))
    with pytest.raises(Exception, match="killed"):
        sink.replace_run(half, path, "run_date", day, table)
    assert stored() == before
    sink.replace_run(runs.filter("id = 3"), path, "run_date", day, table)
    assert stored() == [(1, date(2024, 1, 1)), (3, day)]
    sink.replace_run(runs.filter("id < 0"), path, "run_date", day, table)
    assert stored() == [(1, date(2024, 1, 1))]
    if catalog:
        assert sink.drop_replaced_runs(spark, path, "run_date", table) >= 2
        assert stored() == [(1, date(2024, 1, 1))]


def test_a_reader_keeps_the_run_it_holds(spark, runs, rows):
    path = new_work_path(spark, "runs")
    table = published(spark, path, "held_runs")
    sink.write_runs(runs, path, "run_date", table)
    held = spark.table(table).filter("run_date = DATE '2024-01-02'").inputFiles()  # what a running reader has planned on
    sink.write_runs(runs.filter("id = 2").withColumn("id", F.lit(7)), path, "run_date", table)
    assert rows(spark.read.parquet(*held), "id") == [(2,), (3,)]
    assert rows(spark.table(table), "id") == [(1,), (7,)]


def test_a_swap_that_fails_puts_the_old_folder_back(spark):
    path = new_work_path(spark, "swap")
    spark.range(3).write.parquet(f"{path}/live")
    with pytest.raises(Exception):  # noqa: B017
        files.swap_in(spark, f"{path}/nothing", f"{path}/live", f"{path}/_aside")
    assert spark.read.parquet(f"{path}/live").count() == 3


def test_run_folder_is_dropped(spark):
    with run_folder(spark) as folder:
        df = stage(spark.range(3), "three")
        assert folder in df.inputFiles()[0] and df.count() == 3
    assert not Path(folder.removeprefix("file:")).exists()


def test_fault_load_replaces_its_day(spark, rows):
    path = new_work_path(spark, "faults")
    faults = spark.createDataFrame([("d1", date(2024, 1, 2))], "device_key STRING, run_date DATE")
    for _ in range(2):
        load_comms_faults(faults, path, "2024-01-02", datetime(2024, 1, 2, 17, 30))
    out = spark.read.parquet(path)
    assert rows(out, "device_key", "report_time", "run_date") == [("d1", "2024-01-02 17:30:00", date(2024, 1, 2))]


def test_compaction_keeps_the_rows(spark):
    small, target = new_work_path(spark, "small"), new_work_path(spark, "large")
    df = spark.range(500).selectExpr("id", "id % 7 AS v")
    df.repartition(20).write.parquet(small)
    assert sink.compact(spark, small, target) == 1
    back = spark.read.parquet(target)
    assert back.exceptAll(df).count() == 0 and back.count() == 500
    assert scan.file_manifest(spark, target).filter("file_name LIKE '%.parquet'").count() == 1


def test_compact_tables_points_the_table_to_the_new_files(spark):
    sink.write_table(spark.range(40).repartition(8), "many_files", new_work_path(spark, "many"))
    root = new_work_path(spark, "compacted")
    assert sink.compact_tables(spark, ["many_files"], root) == {"many_files": 1}
    assert root in sink.table_location(spark, "many_files")
    assert spark.table("many_files").count() == 40


ODD = ["a/b", "x:y", "it's", "50%", "a+b c", "ö=ü", "{x}*?", None]


def test_compaction_merges_small_files_of_any_partition(spark, rows):
    df = spark.range(800).withColumn("part", F.array(*[F.lit(v) for v in ODD])[(F.col("id") % 8).cast("int")])
    df.repartition(5).write.partitionBy("part").option("path", new_work_path(spark, "odd parts")).saveAsTable("odd_parts")
    spark.range(4).selectExpr("id + 1000 AS id", "'x:y' AS part").write.insertInto("odd_parts")
    before = rows(spark.table("odd_parts"), "id", "part")
    assert len(before) == 804
    assert sink.compact_tables(spark, ["odd_parts"], new_work_path(spark, "unused")) == {"odd_parts": 8}
    assert rows(spark.table("odd_parts"), "id", "part") == before
    assert len(spark.table("odd_parts").inputFiles()) == 8
    assert sink.compact_tables(spark, ["odd_parts"], "unused") == {"odd_parts": 0}


def test_compaction_leaves_large_files_alone(spark, rows):
    path = new_work_path(spark, "mixed")
    spark.range(200_000).selectExpr("id", "uuid() AS v").coalesce(1).write.parquet(path)
    spark.range(200_000, 200_600).selectExpr("id", "'s' AS v", "1 AS later").repartition(6).write.mode("append").parquet(path)
    listed = lambda: {r["file_name"]: r["modified"] for r in scan.file_manifest(spark, path).filter("file_name LIKE '%.parquet'").collect()}
    before = listed()
    large = max(before, key=lambda n: Path(path.removeprefix("file:"), n).stat().st_size)
    assert compaction.compact_files(spark, path, target_mb=1) == (6, 1)
    after = listed()
    assert after[large] == before[large] and len(after) == 2
    assert spark.read.option("mergeSchema", True).parquet(path).filter("later = 1").count() == 600
    assert spark.read.parquet(path).count() == 200_600 and compaction.compact_files(spark, path, target_mb=1) == (0, 0)


def test_bins_hold_about_the_wanted_size(spark):
    sizes = [("d", f"f{k:03d}", 30 + k % 20) for k in range(200)] + [("d", "big", 900), ("e", "alone", 5)]
    listing = spark.createDataFrame(sizes, "directory string, file_name string, bytes long")
    found = compaction.bins(listing, 200).groupBy("bin").agg(F.sum("bytes").alias("n"), F.collect_set("directory").alias("d"))
    totals = [r["n"] for r in found.collect()]
    assert sum(totals) == sum(n for _, f, n in sizes if f.startswith("f")) and max(totals) < 300 and min(sorted(totals)[1:]) > 100


@pytest.mark.parametrize("died", ["before the plan", "after the plan", "among the moves"])
def test_a_compaction_that_died_is_completed(spark, monkeypatch, died):
    path = new_work_path(spark, "died")
    spark.range(100).repartition(5).write.parquet(path)
    spark.range(100, 200).repartition(5).write.parquet(f"{path}/p=1")
    name, lets = {"before the plan": ("names", 1), "after the plan": ("move", 0), "among the moves": ("delete", 2)}[died]
    real, calls = getattr(files, name), []

    def stops(*args):
        calls.append(args)
        if len(calls) > lets:
            raise KeyboardInterrupt
        return real(*args)

    with monkeypatch.context() as m:
        m.setattr(files, name, stops)
        with pytest.raises(KeyboardInterrupt):
            compaction.compact_files(spark, path)
    compaction.compact_files(spark, path)
    found = spark.read.option("recursiveFileLookup", True).parquet(path)
    assert sorted(r["id"] for r in found.collect()) == list(range(200)) and len(found.inputFiles()) == 2


def test_typed_table_and_truncate(spark):
    spec = sink.TableSpec("typed", "id BIGINT, price DECIMAL(12,1), day DATE", ("day",), "a comment")
    sink.create_table(spark, spec, new_work_path(spark, "typed"))
    df = spark.sql("SELECT 1 AS id, 2.25D AS price, DATE '2024-01-01' AS day")
    filled = sink.fill_table(df, spec)
    assert filled.schema["price"].dataType.simpleString() == "decimal(12,1)"
    assert filled.count() == 1
    assert spec.schema.names == ["id", "price", "day"]
    sink.rebuild_table(df, "to_empty")
    assert sink.truncate_table(spark, "to_empty").count() == 0


def test_stage_and_work_dir(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = stage(spark.range(3), "three")
    assert df.count() == 3 and df.inputFiles()[0].find(work_dir(spark)) >= 0


def test_jdbc_options():
    assert scan.jdbc_options("jdbc:x", dbtable="t") == {"url": "jdbc:x", "dbtable": "t"}
    assert scan.jdbc_options("jdbc:x", query="SELECT 1", driver="d") == {"url": "jdbc:x", "driver": "d", "query": "SELECT 1"}
    parallel = scan.jdbc_options("jdbc:x", query="SELECT 1", partition=("id", 0, 100, 4))
    assert parallel["dbtable"] == "(SELECT 1) part" and parallel["numPartitions"] == "4" and "query" not in parallel
    with pytest.raises(ValueError):
        scan.jdbc_options("jdbc:x")
