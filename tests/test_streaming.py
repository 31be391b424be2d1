import json
from dataclasses import replace
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewatch.config import Config, ConfigError
from tidewatch.plans.state import StateStore
from tidewatch.schema import METRICS
from tidewatch.sources.metrics import jdbc_progress, normalize, progress, read_jdbc
from tidewatch.sources.sinks import Delivery, FileSink, KafkaSink, LogSink, NoopSink, kafka_options, probe, sinks_of
from tidewatch.streaming import ProgressLog, WindowRunner, run_with_restarts, start_off_hours_stream, start_window_stream

START = datetime(2026, 8, 17, 21)


def rows(windows=3, gap=()):
    return [(START + timedelta(minutes=5 * w + i), f"s{i}", "d", "TCP", i + 1, 1, 1, 50, 50, 10 * w + i) for w in range(windows) if w not in gap for i in range(3)] + [
        (START + timedelta(minutes=5 * windows), "z", "d", "TCP", 1, 1, 1, 1, 1, 999)]


def runner(spark, tmp_path, data, **kw):
    cfg = Config(start_mode="fixed", start_time="2026-08-17T21:00:00", stable_delay_minutes=0, device_id="123456", topn=2, sketch_capacity=8, **kw)
    d = spark.createDataFrame(data, METRICS)
    return WindowRunner(spark, lambda s: d, StateStore(spark, str(tmp_path / "state")), [FileSink(str(tmp_path / "out"))], cfg,
                        today=lambda: date(2026, 8, 17), sleep=lambda s: None)


def ids(spark, tmp_path):
    return sorted(json.loads(r["value"])["logId"] for r in spark.read.text(str(tmp_path / "out")).collect())


def test_runner_processes_in_order_and_restarts(spark, tmp_path):
    r = runner(spark, tmp_path, rows())
    c = r.run(until_waiting=True)
    assert c.processed_windows == 3 and c.emitted_alerts == 6 and r.state.cursor == START + timedelta(minutes=15)
    got = ids(spark, tmp_path)
    assert len(set(got)) == 6 and got[-1].endswith("5")
    again = runner(spark, tmp_path, rows(4))
    assert again.cursor() == START + timedelta(minutes=15)
    assert again.run(until_waiting=True).processed_windows == 1
    assert ids(spark, tmp_path)[-1].endswith("7")


def test_crash_between_alerts_and_state_repeats_the_version(spark, tmp_path, monkeypatch):
    r = runner(spark, tmp_path, rows(1))
    with monkeypatch.context() as m:
        m.setattr(r.store, "write", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            r.step()
    assert runner(spark, tmp_path, rows(1)).run(until_waiting=True).processed_windows == 1
    assert len(ids(spark, tmp_path)) == 2  # the version was replaced, not doubled


def test_empty_window_is_held_or_passed(spark, tmp_path):
    held = runner(spark, tmp_path / "a", rows(3, gap=(1,)))
    assert [held.step(), held.step(), held.step()] == ["processed", "empty", "empty"] and held.counters.empty_window_retries == 2
    on = runner(spark, tmp_path / "b", rows(3, gap=(1,)), empty_advance=True)
    assert on.run(until_waiting=True).processed_windows == 3


def test_failures_are_bounded(spark, tmp_path):
    r = runner(spark, tmp_path, rows(1), max_failures=2)
    r.read = lambda s: s.read.parquet(str(tmp_path / "missing"))
    assert r.step() == "failed"
    with pytest.raises(PySparkException):
        r.step()
    assert r.counters.query_failures == 2


def test_failures_of_the_store_are_bounded(spark, tmp_path):
    r = runner(spark, tmp_path, rows(1), max_failures=3)
    assert r.safe_end() is not None and r.counters.watermark_queries == 1
    good, r.read = r.read, lambda s: s.read.jdbc("jdbc:nosuch://127.0.0.1/x", "t")
    assert r.step() == "failed" and r.step() == "failed" and r.failures == 2
    r.read = good  # the watermark is asked anew after a failure, and a window that works ends the row of failures
    before = r.counters.watermark_queries
    assert r.step() == "processed" and r.failures == 0 and r.counters.watermark_queries == before + 1
    r.read = lambda s: s.read.jdbc("jdbc:nosuch://127.0.0.1/x", "t")
    r.cfg = replace(r.cfg, max_failures=1)
    r.cursor = lambda: START
    with pytest.raises(Py4JJavaError):
        r.step()


@pytest.mark.parametrize("hour_col", [None, "hour"])
def test_unreadable_text_times_are_counted_once(spark, tmp_path, hour_col):
    d = spark.createDataFrame(rows(3), METRICS)
    bad = d.limit(2).withColumn("collect_time", F.lit("not a time"))
    text = d.withColumn("collect_time", F.date_format("collect_time", "yyyy-MM-dd HH:mm:ss")).unionByName(bad)
    text = text.withColumns({"hour": F.lit(START).cast("timestamp_ntz")})
    r = runner(spark, tmp_path, rows(3))
    r = WindowRunner(spark, lambda s: text, r.store, r.sinks, r.cfg, today=lambda: date(2026, 8, 17), sleep=lambda s: None, hour_col=hour_col)
    c = r.run(until_waiting=True)
    assert c.processed_windows == 3 and c.queried_rows == 9 and c.bad_rows == 2 and c.query_failures == 0
    assert r.sizes["pairs"] == 3 and r.sizes["context_days"] > 0


def test_today_is_that_of_the_business_zone(spark, tmp_path):
    for zone in ("Pacific/Kiritimati", "Etc/GMT+12"):
        r = WindowRunner(spark, lambda s: None, StateStore(spark, str(tmp_path / "s")), [], Config(timezone=zone))
        assert r.today() == datetime.now(ZoneInfo(zone)).date()


def test_progress_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame(rows(), METRICS).write.parquet(str(tmp_path / "m"))
    d = spark.read.parquet(str(tmp_path / "m"))
    p = progress(d, date(2026, 8, 17), 3)
    plan = p._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(collect_time,2026-08-15T00:00)" in plan and "LessThan(collect" in plan
    assert p.first()["latest"] == START + timedelta(minutes=15)
    assert progress(d, date(2026, 8, 16), 3).first()["latest"] is None and progress(d, date(2026, 8, 20), 3).first()["latest"] is None
    text = d.withColumn("collect_time", F.date_format("collect_time", "yyyy-MM-dd HH:mm:ss"))
    assert progress(text, date(2026, 8, 17), 1).first()["latest"] == START + timedelta(minutes=15)


def test_a_window_and_the_progress_over_jdbc(spark):
    """An in-memory database takes the predicates, the slices and the timeouts, and its times become metrics."""
    url, driver = "jdbc:derby:memory:tidewatch;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    d = spark.createDataFrame(rows(2), METRICS)
    d = d.toDF(*[c.upper() for c in d.columns]).withColumns({"DAYTIME": F.to_date("COLLECT_TIME"), "DAYHOURTIME": F.date_trunc("hour", "COLLECT_TIME").cast("timestamp_ntz")})
    d.write.mode("append").jdbc(url, "METRIC", properties=driver)
    names = {"day_col": "DAYTIME", "ts_col": "COLLECT_TIME"}
    cols = {c.split()[0]: c.split()[0].upper() for c in METRICS.split(", ")}
    part = read_jdbc(spark, url, "METRIC", START, START + timedelta(minutes=5), hour_col="DAYHOURTIME", columns=cols, partitions=5, fetch_size=2, **names, **driver)
    assert part.rdd.getNumPartitions() == 5
    assert sorted(r["src_ip"] for r in normalize(part).collect()) == ["s0", "s1", "s2"]
    ask = lambda day: jdbc_progress(spark, url, "METRIC", day, 3, **names, **driver).first()["latest"]
    assert ask(date(2026, 8, 18)) == START + timedelta(minutes=10) and ask(date(2026, 8, 16)) is None
    with pytest.raises(ValueError):
        jdbc_progress(spark, url, "METRIC; DROP", date(2026, 8, 18), 3)


def test_progress_log(spark, tmp_path, caplog):
    import logging

    log = ProgressLog(every=10)
    with caplog.at_level(logging.INFO, logger="tidewatch.stream"):
        for n in (4, 5, 2, 30):
            log.add(n, "here")
    assert [r.getMessage() for r in caplog.records] == ["11 rows read: here", "41 rows read: here"]


def test_old_versions_are_dropped(spark, tmp_path):
    r = runner(spark, tmp_path, rows(6))
    assert r.run(until_waiting=True).processed_windows == 6
    for name in ("manifest", "pair-history", "context-history"):
        assert len([p for p in (tmp_path / "state" / name).iterdir() if p.is_dir()]) == 3
    assert r.store.latest() == 5 and r.store.read(3).cursor == START + timedelta(minutes=20)
    with pytest.raises(ValueError):
        StateStore(spark, "x", keep=1)


def test_restarts_are_bounded(spark, tmp_path):
    made = []

    def make():
        made.append(1)
        if len(made) < 3:
            raise OSError("store is down")
        return runner(spark, tmp_path, rows(1))

    assert run_with_restarts(make, attempts=2, sleep=lambda s: None, until_waiting=True).processed_windows == 1
    with pytest.raises(OSError):
        run_with_restarts(lambda: (_ for _ in ()).throw(OSError("down")), attempts=2, sleep=lambda s: None)


def test_off_hours_stream(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame(rows(), METRICS).repartition(1).write.parquet(str(src))
    late = [(START, "late", "d", "TCP", 99, 1, 1, 1, 1, 5000), (START + timedelta(hours=9), "end", "d", "TCP", 1, 1, 1, 1, 1, 5001)]
    got = []
    cfg = Config(stable_delay_minutes=5, topn=2, sketch_capacity=8)

    def go():
        s = spark.readStream.schema(METRICS).parquet(str(src))
        q = start_off_hours_stream(s, cfg, lambda d, v: got.extend(d.select("win", "src_ip", F.col("detail3.conns").alias("conns")).collect()), str(tmp_path / "cp"))
        q.awaitTermination()

    go()
    spark.createDataFrame(late[1:], METRICS).write.mode("append").parquet(str(src))
    go()
    spark.createDataFrame(late[:1], METRICS).write.mode("append").parquet(str(src))
    go()
    assert [(r["src_ip"], r["conns"]) for r in sorted(got, key=lambda r: (r["win"], -r["conns"])) if r["win"] == START] == [("s2", 3), ("s1", 2)]
    assert "late" not in {r["src_ip"] for r in got}


def test_window_stream(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame(rows(), METRICS).write.parquet(str(src))
    r = runner(spark, tmp_path, rows())
    start_window_stream(spark.readStream.schema(METRICS).parquet(str(src)), r.step, str(tmp_path / "cp")).awaitTermination()
    assert r.counters.processed_windows == 3


def test_sinks(spark, tmp_path, caplog):
    lines = spark.createDataFrame([("{}",)], "value string")
    LogSink().write(lines, 0)
    assert "{}" in caplog.text
    NoopSink().write(lines, 0)
    d = Delivery(FileSink(str(tmp_path / "x")))
    d.write(lines, 0)

    class Bad:
        def write(self, lines, version):
            raise OSError("down")

    b = Delivery(Bad())
    with pytest.raises(OSError):
        b.write(lines, 0)
    assert d.summary()["delivered"] == 1 and d.summary()["delivered_bytes"] == 2 and d.acknowledged and not b.acknowledged
    got = b.summary()
    assert {k: got[k] for k in ("attempted", "delivered", "failed", "in_flight", "first_failure")} == {
        "attempted": 1, "delivered": 0, "failed": 1, "in_flight": 0, "first_failure": "OSError: down"}
    now = [1_000.0]
    t = Delivery(NoopSink(), seconds=300, clock=lambda: now[0])
    for now[0] in (1_000.0, 1_100.0, 1_250.0, 2_500.0):
        t.write(lines, 0)
    assert [(s["since"], s["until"], s["delivered"]) for s in t.summaries] == [(900.0, 1_200.0, 2), (1_200.0, 2_400.0, 1)]
    assert t.close()["delivered"] == 1 and t.summaries[-1]["total"]["delivered"] == 4
    keyed = KafkaSink("h:1", "t").records(spark.createDataFrame([("1", "{}")], "log_id string, value string"))
    assert [tuple(r) for r in keyed.collect()] == [("1", "{}")] and keyed.columns == ["key", "value"]
    assert isinstance(sinks_of(Config())[0], NoopSink) and isinstance(sinks_of(Config(log_enabled=True))[0], LogSink)
    with pytest.raises(ConfigError):
        sinks_of(Config(kafka_enabled=True))
    assert kafka_options("h:1", kerberos=True)["kafka.sasl.mechanism"] == "GSSAPI"
    assert probe("localhost:1", timeout=0.2) == []
    with pytest.raises(ConnectionError):
        probe("localhost:1", timeout=0.2, fail_fast=True)
