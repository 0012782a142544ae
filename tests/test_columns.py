from __future__ import annotations

from datetime import date, datetime
from math import cos, isclose, log, pi, radians, sin, sqrt, tan

import pytest
from pyspark.sql import functions as F

from vaultframe.functions import columns, dates, geometry, keys
from vaultframe.operators.timeline import interval_keys


def test_as_of_is_by_day(spark, rows):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 9, 23, 59)), (2, datetime(2024, 1, 10)), (3, datetime(2024, 1, 10, 23, 59)), (4, datetime(2024, 1, 11))],
        "id INT, ts TIMESTAMP_NTZ",
    )
    assert rows(dates.as_of(df, "2024-01-10", "ts"), "id") == [(1,), (2,), (3,)]
    assert rows(dates.as_of(df, "2024-01-10", "ts", inclusive=False), "id") == [(1,)]


def test_effective_on_includes_both_ends_and_survives_bad_dates(spark, rows):
    df = spark.createDataFrame(
        [
            (1, "20240110", "99991231"),
            (2, "20230101", "20240110"),
            (3, "20240111", "99991231"),
            (4, "00000000", "99991231"),
            (5, "20230101", "20240109"),
            (6, None, "99991231"),
        ],
        "id INT, ab STRING, bis STRING",
    )
    assert rows(dates.effective_on(df, "2024-01-10", "ab", "bis"), "id") == [(1,), (2,)]
    assert rows(dates.open_only(df, "bis"), "id") == [(1,), (3,), (4,), (6,)]


def test_incremental_window(spark, rows):
    end = datetime(2024, 1, 10, 8)
    df = spark.createDataFrame(
        [
            (1, datetime(2024, 1, 10, 0), datetime(2023, 1, 1)),
            (2, datetime(2024, 1, 10, 8), datetime(2023, 1, 1)),
            (3, datetime(2024, 1, 10, 8, 1), datetime(2023, 1, 1)),
            (4, datetime(2023, 1, 1), datetime(2024, 1, 9, 14)),
            (5, datetime(2023, 1, 1), datetime(2024, 1, 9, 13, 59)),
        ],
        "id INT, extract_ts TIMESTAMP_NTZ, load_ts TIMESTAMP_NTZ",
    )
    assert rows(dates.incremental_window(df, end, 8, "extract_ts", "load_ts"), "id") == [(1,), (2,), (4,)]
    assert dates.incremental_window(df, end, 0, "extract_ts", "load_ts").count() == 5


def test_end_rules(spark, rows):
    df = spark.createDataFrame(
        [(1, None), (2, datetime(9999, 12, 31, 5)), (3, datetime(2024, 1, 10, 12))], "id INT, e TIMESTAMP_NTZ"
    )
    out = rows(df.select("id", dates.closed_end("e", 1).alias("a"), dates.closed_end("e", 0).alias("b")))
    far = date(9999, 12, 31)
    assert out == [(1, far, far), (2, far, far), (3, date(2024, 1, 9), date(2024, 1, 10))]
    floors = spark.createDataFrame([(None,), (date(2014, 1, 1),), (date(2016, 1, 1),)], "d DATE")
    assert set(rows(floors.select(dates.floor_date("d", "2015-01-01")))) == {(None,), (date(2015, 1, 1),), (date(2016, 1, 1),)}


def test_zone_conversion_does_not_depend_on_the_session(spark, rows):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 7, 1),)], "ts TIMESTAMP_NTZ")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = rows(df.select(dates.to_zone("ts", "Australia/Melbourne"), dates.to_zone("ts", "+10:00")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert out == [
        (datetime(2024, 1, 1, 11), datetime(2024, 1, 1, 10)),
        (datetime(2024, 7, 1, 10), datetime(2024, 7, 1, 10)),
    ]


def test_blanks_codes_and_folds(spark, rows):
    df = spark.createDataFrame([(" a ", "3G"), ("  ", "MESH"), (None, "PLC")], "v STRING, m STRING")
    assert rows(columns.null_if_blank(df, ["v"]), "v") == [("a",), (None,), (None,)]
    assert df.filter(columns.not_blank("v")).count() == 1
    assert df.filter(columns.code_in("v", ["A"])).count() == 1
    fold = columns.fold_category("m", {"MESH": ["MICROAP", "MESH"], "WIMAX": ["3G", "WIMAX"]})
    assert set(rows(df.select("m", fold))) == {("3G", "WIMAX"), ("MESH", "MESH"), ("PLC", None)}
    label = columns.decode("m", {"3G": "radio"}, "other")
    assert set(rows(df.select("m", label))) == {("3G", "radio"), ("MESH", "other"), ("PLC", "other")}


def test_codes_match_as_stored(spark, rows):
    df = spark.createDataFrame([("58 ",), ("58",), ("59",)], "code STRING")
    codes = spark.createDataFrame([("58 ",), ("58 ",), ("59",)], "c STRING")
    assert rows(columns.in_codes(df, "code", codes, "c")) == [("58 ",), ("59",)]


def test_hashes(spark):
    df = spark.createDataFrame([("C0001", None, " x ")], "bk STRING, n STRING, v STRING")
    key, missing, diff = df.select(keys.hash_key("bk"), keys.hash_key("bk", "n"), keys.hash_diff("bk", "n", "v")).first()
    assert key == "24cec86c8662618697636f7b9dcc2dc28e2da838"
    assert missing is None
    assert diff == df.select(F.sha1(F.lit("C0001::x"))).first()[0]
    stored = spark.createDataFrame([("C0001", key), ("C0002", key), ("C0003", None)], "bk STRING, k STRING")
    assert {r.bk for r in keys.audit_hash(stored, "k", ["bk"]).collect()} == {"C0002", "C0003"}


def test_wkt_rules(spark):
    df = spark.createDataFrame([("POINT(12 -3)",), ("POINT (12 -3)",), ("LINE(1 2)",)], "g STRING")
    loose, strict = geometry.wkt_xy("g"), geometry.wkt_xy("g", strict=True)
    out = [tuple(r) for r in df.select(*loose, *strict).collect()]
    assert out[0] == ("12", "-3", "12", "-3")
    assert out[1] == ("", "-3", "12", "-3")
    assert out[2][2:] == (None, None)


def forward(lon: float, lat: float) -> tuple[float, float]:
    """Textbook forward projection, to metres."""
    f = 1 / 298.257222101
    e = sqrt(2 * f - f * f)

    def m(p):
        return cos(p) / sqrt(1 - (e * sin(p)) ** 2)

    def ell(p):
        return tan(pi / 4 - p / 2) / ((1 - e * sin(p)) / (1 + e * sin(p))) ** (e / 2)

    p1, p2, p0 = radians(-36), radians(-38), radians(-37)
    n = (log(m(p1)) - log(m(p2))) / (log(ell(p1)) - log(ell(p2)))
    big = m(p1) / (n * ell(p1) ** n) * 6378137
    rho, rho0 = big * ell(radians(lat)) ** n, big * ell(p0) ** n
    theta = n * radians(lon - 145)
    return 1e6 + rho * sin(theta), 1e6 + rho0 - rho * cos(theta)


@pytest.mark.parametrize("lon,lat", [(145, -37), (144.5, -37.8), (147.25, -38.9), (141.1, -34.2)])
def test_projection_round_trip(spark, lon, lat):
    x, y = forward(lon, lat)
    df = spark.createDataFrame([(repr(x * 1000), repr(y * 1000))], "x STRING, y STRING")
    got = df.select(*geometry.lcc_inverse("x", "y")).first()
    assert isclose(got[0], lon, abs_tol=1e-9) and isclose(got[1], lat, abs_tol=1e-9)


def test_read_at_midnight_belongs_to_the_day_before(spark, rows):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 2, 0, 0), 1800), (datetime(2024, 1, 2, 0, 30), 1800), (datetime(2024, 1, 2, 12, 0), 900)],
        "e TIMESTAMP_NTZ, n INT",
    )
    assert rows(interval_keys(df, "e", "n"), "read_dt", "interval_seq_num") == [
        (20240101, 48),
        (20240102, 1),
        (20240102, 48),
    ]
