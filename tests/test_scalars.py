from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidewatch import functions as fn
from tidewatch.config import Config
from tidewatch.operators.alerts import LogIds
from tidewatch.sources import metrics as src
from tidewatch.sources.metrics import bad_rows, check_aligned, day_bounds, floor_datetime, hour_bounds, normalize, safe_end, table_name


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_floor_and_bounds(spark):
    assert floor_datetime(datetime(2026, 8, 17, 11, 37, 42), 5) == datetime(2026, 8, 17, 11, 35)
    assert one(spark, fn.floor_time(ts("2026-08-17 11:37:42"), 5)) == datetime(2026, 8, 17, 11, 35)
    assert hour_bounds(datetime(2026, 8, 17, 20, 35), datetime(2026, 8, 17, 20, 40)) == (datetime(2026, 8, 17, 20), datetime(2026, 8, 17, 21))
    assert hour_bounds(datetime(2026, 8, 17, 20, 55), datetime(2026, 8, 17, 21))[1] == datetime(2026, 8, 17, 21)
    assert day_bounds(datetime(2026, 8, 17, 23, 55), datetime(2026, 8, 18)) == (date(2026, 8, 17), date(2026, 8, 17))
    with pytest.raises(ValueError):
        check_aligned(datetime(2026, 8, 17, 20, 36), 5)
    assert safe_end(datetime(2026, 8, 17, 12, 37), Config()) == datetime(2026, 8, 17, 11, 35)
    assert one(spark, src.watermark(ts("2026-08-17 12:37:00"), Config())) == datetime(2026, 8, 17, 11, 35)
    assert safe_end(None, Config()) is None


@pytest.mark.parametrize("at,off", [("2026-08-17 21:00:00", True), ("2026-08-17 07:59:00", True), ("2026-08-17 08:00:00", False),
                                    ("2026-08-17 19:59:00", False), ("2026-08-16 12:00:00", True)])
def test_off_hours(spark, at, off):
    assert one(spark, fn.off_hours(ts(at), 20, 8)) is off


def test_off_hours_within_a_day(spark):
    assert one(spark, fn.off_hours(ts("2026-08-17 12:00:00"), 11, 13)) is True
    assert one(spark, fn.off_hours(ts("2026-08-17 12:00:00"), 9, 9)) is False


def test_rounding(spark):
    assert [one(spark, fn.quantile_round(F.lit(x).cast("double"))) for x in (float("nan"), -1.0, 0.0, 2.5, 1e300)] == [0, 0, 0, 3, fn.LONG_MAX]
    assert [one(spark, fn.positive_round(F.lit(x).cast("double"), F.lit(7).cast("bigint"))) for x in (float("inf"), -1.0, 2.4, 2.5)] == [7, 7, 2, 3]
    assert one(spark, fn.saturating_add(F.lit(fn.LONG_MAX), F.lit(1).cast("bigint"))) == fn.LONG_MAX
    assert [one(spark, fn.protocol_norm(F.lit(x).cast("string"))) for x in (None, "  ", " tls ")] == ["UNKNOWN", "UNKNOWN", "tls"]


def test_normalize_and_bad_rows(spark):
    rows = [("2026-08-17 10:00:00", None, "b", " ", -5, None, 1, fn.LONG_MAX, 5), ("2026-08-17T10:00:01", "a", "b", "c", 1, 1, 1, 1, 1),
            ("2026-08-17 10:00:02.5", "a", "b", "c", 1, 1, 1, 1, 1), ("2026-08-17 10:00:03.125", "a", "b", "c", 1, 1, 1, 1, 1),
            ("17.08.2026", "a", "b", "c", 1, 1, 1, 1, 1), (None, "a", "b", "c", 1, 1, 1, 1, 1)]
    d = spark.createDataFrame(rows, "collect_time string, src_ip string, dst_ip string, protocol string, conn_count long, c2s_pkts long, s2c_pkts long, c2s_bytes long, s2c_bytes long")
    got = sorted(normalize(d).collect(), key=lambda r: r["collect_time"])
    assert [r["collect_time"].second for r in got] == [0, 1, 2, 3] and bad_rows(d).count() == 2
    assert (got[0]["src_ip"], got[0]["conn_count"], got[0]["c2s_pkts"], got[0]["total_bytes"], got[0]["total_pkts"]) == ("", 0, 0, fn.LONG_MAX, 1)


def test_table_name():
    assert table_name("db.metric_endpoint") == "db.metric_endpoint"
    for bad in ("a;drop table b", "", "a b", "a.b.c.d"):
        with pytest.raises(ValueError):
            table_name(bad)


def test_log_ids():
    ids = LogIds("123456")
    assert [ids.next(date(2026, 8, 18)) for _ in range(2)] == ["20260818123456" + "0" * 18, "20260818123456" + "0" * 17 + "1"]
    assert ids.next(date(2026, 8, 19)).endswith("0" * 18) and ids.snapshot() == "20260819|1"
    again = LogIds.restore("123456", ids.snapshot())
    assert again.next(date(2026, 8, 19)).endswith("1")
    with pytest.raises(RuntimeError):
        again.next(date(2026, 8, 18))
    with pytest.raises(ValueError):
        LogIds("12345")
    assert LogIds.restore("123456", "").next(date(2026, 1, 1)).startswith("20260101")
