import random
from datetime import datetime, timedelta

import pytest

from tidewatch.config import Config
from tidewatch.operators import large, offhours, pairs, windows
from tidewatch.operators.context import DayRecursion, quantile
from tidewatch.operators.pairs import PairFold
from tidewatch.operators.sketches import CountMin, SpaceSaving
from tidewatch.plans.backfill import run_backfill
from tidewatch.plans.incremental import State, run_range, run_window
from tidewatch.schema import METRICS
from tidewatch.sources.metrics import normalize

COLS = [c.strip().split()[0] for c in METRICS.split(",")]


def frame(spark, rows):
    return normalize(spark.createDataFrame(rows, METRICS))


def row(t, b, p, i=0, src="10.0.0.1", dst="10.0.1.1", proto="", conn=1):
    return (t, src, dst, proto, conn, p // 2, p - p // 2, b // 2, b - b // 2, i)


def seeded(day):
    return [row(day + timedelta(seconds=i % 50), 100, 1, i, src=f"h{i}") for i in range(100)] + [row(day, 1000, 10, 100, src="h100")]


DET = Config(min_days=1, candidate_capacity=1_000, min_samples=3, offhours_enabled=False)


@pytest.mark.parametrize("b,p,reason", [(5000, 50, "BYTES_AND_PKTS"), (5000, 5, "EXTREME_BYTES")])
def test_detector_fixture(spark, b, p, reason):
    past, now = datetime(2026, 8, 14, 0, 1), datetime(2026, 8, 17, 0, 1)
    d = frame(spark, [*seeded(past), row(now, b, p, 200, src="x")])
    got = [r for r in run_backfill(d, DET).alerts.collect() if r["win"] >= datetime(2026, 8, 17)]
    assert len(got) == 1 and got[0]["anomaly_type"] == 2
    x = got[0]["detail2"].asDict()
    assert len(x) == 8 and x["anomaly_reason"] == reason and x["current_bytes"] == b and x["baseline_bytes"] == 100
    assert x["bytes_threshold"] == 1000.0 and x["extreme_bytes_threshold"] == 2000.0 and x["pkts_threshold"] == 10.0


def test_capped_bootstrap_learning_and_mature_protection():
    end = datetime(2026, 8, 17, 0, 5)
    t = datetime(2026, 8, 17, 0, 1)
    f = PairFold(DET)
    assert f.window(end, [(t, 1, 5000, 50, 100, 1000, 1, 10, "HISTORY")])[9] == "BYTES_AND_PKTS"
    assert (f.eb, f.ep, f.n) == (1000.0, 10.0, 1)  # held to the context's threshold
    mature = PairFold(DET, (100.0, 1.0, 3, t - timedelta(days=1), 0))
    assert mature.window(end, [(t, 1, 5000, 50, 100, 1000, 1, 10, "HISTORY")])
    assert (mature.eb, mature.n) == (100.0, 3)
    skip = PairFold(Config(capped_learning=False, min_samples=3))
    skip.window(end, [(t, 1, 5000, 50, 100, 1000, 1, 10, "HISTORY")])
    assert skip.n == 0


def test_ema_and_expiry():
    c = Config()
    t = datetime(2026, 8, 10, 10)
    f = PairFold(c)
    f.window(t + timedelta(minutes=5), [(t, 1, 1_000_000, 10, 1, 0, 1, 0, "CURRENT")])
    f.window(t + timedelta(minutes=10), [(t + timedelta(minutes=5), 2, 2_000_000, 10, 1, 0, 1, 0, "CURRENT")])
    assert f.eb == 1_100_000.0 and f.n == 2
    g = PairFold(c, (1.0, 1.0, 5, t, 0))
    g.window(t + timedelta(days=7), [(t + timedelta(days=7) - timedelta(seconds=1), 1, 7, 7, 1, 0, 1, 0, "CURRENT")])
    assert g.n == 6  # seen exactly the time to live before the window's end: kept
    h = PairFold(c, (1.0, 1.0, 5, t, 0))
    h.window(t + timedelta(days=7, minutes=5), [(t + timedelta(days=7, minutes=1), 1, 7, 7, 1, 0, 1, 0, "CURRENT")])
    assert (h.n, h.eb) == (1, 7.0)


def test_two_days_make_a_context_usable_and_thresholds_stay_bounded():
    rec = DayRecursion(Config())
    assert rec.stats(10)[0] == 0
    rec.learn(10, "bytes", {1000: 1}, 0, 0)
    days, s = rec.stats(11)
    assert days == 1 and s["high_bytes"] == 1000
    rec.learn(11, "bytes", {1200: 1}, days, s["high_bytes"])
    assert rec.stats(12)[0] == 2 and rec.stats(12)[1]["high_bytes"] == 1000  # held to the first threshold
    r = random.Random(1)
    rec, first = DayRecursion(Config(bytes_quantile=0.9)), None
    for day in range(40):
        days, s = rec.stats(day)
        if days:
            first = first or s["high_bytes"]
            assert s["high_bytes"] <= first
        rec.learn(day, "bytes", {r.randint(1, 10_000): r.randint(1, 5) for _ in range(20)}, days, s["high_bytes"])


def test_quantile_matches_definition():
    r = random.Random(2)
    for _ in range(200):
        xs = sorted(r.randint(0, 30) for _ in range(r.randint(1, 40)))
        q = r.choice([0.5, 0.9, 0.999])
        want = xs[-(-int(q * 1000) * len(xs) // 1000) - 1]
        assert quantile({v: xs.count(v) for v in xs}, q) == want


def test_off_hours_fixture(spark):
    base = datetime(2026, 8, 17, 21)
    rows = [row(base + timedelta(minutes=i // 2), 10, 1, i, src=f"10.0.0.{i % 3}", proto="TCP", conn=i + 1) for i in range(10)]
    cfg = Config(topn=2, sketch_capacity=8, large_enabled=False)
    got = sorted(run_backfill(frame(spark, rows), cfg).alerts.collect(), key=lambda r: r["detail3"]["topRank"])
    assert [(r["src_ip"], r["detail3"]["conns"], r["detail3"]["TopN"]) for r in got] == [("10.0.0.0", 22, 2), ("10.0.0.2", 18, 2)]


def test_candidates_keep_the_largest(spark):
    t = datetime(2026, 8, 17, 21)
    cfg = Config(candidate_capacity=2)
    d = windows.assign(frame(spark, [row(t, b, 1, i) for i, b in enumerate((5, 9, 9, 7))]), cfg)
    assert sorted(r["row_id"] for r in large.candidates(d, cfg).collect()) == [1, 2]


def noise(n, seed, days=4):
    r = random.Random(seed)
    out = []
    for i in range(n):
        t = datetime(2026, 8, 13) + timedelta(minutes=r.randrange(days) * 1440 + r.randrange(2) * 60 + r.randrange(60))
        b = int(r.paretovariate(1.1) * 100)
        out.append(row(t, b, 1 + b // 90, i, src=f"s{r.randrange(4)}", dst=f"d{r.randrange(2)}", proto=r.choice(["TCP", "UDP ", ""]), conn=r.randrange(4)))
    return out


KEYS = ("win", "anomaly_type", "src_ip", "dst_ip", "protocol", "collect_time", "detail2", "detail3", "weight")


def plain(alerts):
    return sorted((tuple(str(r[k]) for k in KEYS) for r in alerts.select(*KEYS).collect()))


def test_backfill_equals_window_by_window_and_splits(spark):
    cfg = Config(window_minutes=60, slot_minutes=60, bytes_quantile=0.9, pkts_quantile=0.9, topn=3, sketch_capacity=8, min_samples=2)
    d = frame(spark, noise(120, 5, days=3)).cache()
    batch = run_backfill(d, cfg)
    wins = [r["win"] for r in windows.assign(d, cfg).select("win").distinct().orderBy("win").collect()]
    a = run_range(d, cfg, windows_=wins[:3])
    b = run_range(d, cfg, state=State(a.pair_state, a.histograms), windows_=wins[3:])
    assert batch.mode == "parallel"
    assert plain(batch.alerts) == plain(a.alerts.unionByName(b.alerts)) and len(plain(batch.alerts)) > 5
    state = lambda s: sorted((r["src_ip"], r["dst_ip"], r["protocol"], round(r["ema_bytes"], 6), r["samples"], r["last_seen"]) for r in s.collect())
    assert state(batch.pair_state) == state(b.pair_state)


def test_the_limit_on_pairs_is_kept(spark):
    cfg = Config(window_minutes=60, slot_minutes=60, max_pairs=1_000, offhours_enabled=False)
    t = datetime(2026, 8, 17, 3)
    d = frame(spark, [row(t + timedelta(seconds=i), 100 + i, 1, i, src=f"s{i}") for i in range(1_005)])
    got = run_backfill(d, cfg)
    kept = {r["src_ip"] for r in got.pair_state.collect()}
    assert got.mode == "sequential" and kept == {f"s{i}" for i in range(5, 1_005)}


def test_empty_input(spark):
    d = frame(spark, [])
    assert run_backfill(d, Config()).alerts.count() == 0
    out, state = run_window(d, datetime(2026, 8, 17), State.empty(spark), Config())
    assert out.count() == 0 and state.pairs.count() == 0


def test_space_saving():
    s = SpaceSaving(4)
    for i in range(50):
        s.add("heavy", 10)
        s.add(f"light{i}", 1)
    top = s.top(1)[0]
    assert top[0] == "heavy" and top[1] >= 500 and top[1] - top[2] <= 500
    s.add(None, 5)
    s.add("x", 0)
    assert "x" not in s.at and len(s.at) == 4
    big, exact = SpaceSaving(1_000), {}
    r = random.Random(3)
    for _ in range(2_000):
        k, w = r.randrange(200), r.randrange(5)
        big.add(k, w)
        exact[k] = exact.get(k, 0) + w
    assert all(n == exact[k] and e == 0 for k, n, e, _ in big.top(1_000))
    other = SpaceSaving(1_000)
    other.add(1, 10)
    big.merge(other)
    assert big.at[1][0] == exact[1] + 10


def test_count_min():
    a, b = CountMin(), CountMin()
    for k, n in (("a", 10), ("a", 20), ("b", 7)):
        a.add(k, n)
    assert a.estimate("a") >= 30 and a.estimate("b") >= 7
    b.add("x", 13)
    a.add("x", 11)
    a.merge(b)
    assert a.estimate("x") >= 24
    with pytest.raises(ValueError):
        a.merge(CountMin(2, 8))


def test_ties_and_repeated_rows(spark):
    t = datetime(2026, 8, 17, 21)
    d = windows.assign(frame(spark, [row(t, 5, 1, i, src=s, conn=2) for i, s in enumerate("ba" * 3)]), Config(topn=1))
    got = offhours.top_pairs(d, Config(topn=1)).collect()
    assert [(r["src_ip"], r["conns"]) for r in got] == [("a", 6)]
    assert pairs.evict(spark.createDataFrame([], "src_ip string, dst_ip string, protocol string, update_time timestamp_ntz, last_seen timestamp_ntz, update_order long"), 5).count() == 0


def test_alerts_are_numbered_once(spark):
    from datetime import date

    from tidewatch.operators import alerts as al

    top = spark.sql("select timestamp_ntz '2026-08-17 21:00:00' as win, timestamp_ntz '2026-08-17 21:01:00' as collect_time, 'a' as src_ip, 'b' as dst_ip, "
                    "'TCP' as protocol, 1 as top_rank, 5L as conns")
    cfg = Config(device_id="123456")
    once = al.number(al.off_hours_alerts(top, cfg), cfg, date(2026, 8, 18), 7)
    assert once.first()["log_id"] == "20260818123456" + "7".zfill(18)
    with pytest.raises(ValueError):
        al.number(once, cfg, date(2026, 8, 18))
