"""Every query of the catalogue against its SQL, as the driver compares them."""

import os

import duckdb
import pandas as pd
import pytest

from tidewatch.plans import catalog

DATA = os.environ.get("TIDEWATCH_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no fixture tables")


def plain(p):
    def cell(v):
        if v is None or v != v:
            return ""
        return str(pd.Timestamp(v)) if hasattr(v, "year") else repr(float(v)) if isinstance(v, float) else str(v)
    return sorted(tuple(map(cell, r)) for r in p[sorted(p.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    got = catalog.QUERIES[name](spark, DATA).toPandas()
    if name not in catalog.ORACLES:
        assert len(got)
        return
    c = duckdb.connect()
    c.sql(f"create view events as from '{DATA}/events.parquet'")
    want = c.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_kll_rank_error(spark):
    from pyspark.sql import functions as F

    from tidewatch.operators import context, sketches

    rows = catalog._rows(spark, DATA).withColumns({"win": F.lit("2024-01-01").cast("timestamp_ntz"), "slot": F.lit(0)})
    a = {(r["context_protocol"], r["day_type"]): r for r in sketches.kll_window_stats(rows, catalog.COLD).collect()}
    for r in context.window_stats(rows, catalog.COLD).collect():
        vals = sorted(x["total_bytes"] for x in rows.filter((F.col("context_protocol") == r["context_protocol"]) & (F.col("day_type") == r["day_type"])).collect())
        rank = sum(v <= a[r["context_protocol"], r["day_type"]]["p50_bytes"] for v in vals) / len(vals)
        assert abs(rank - 0.5) < 0.1


def test_rounded_histograms_are_close(spark):
    from dataclasses import replace

    from tidewatch.operators import context

    rows = catalog._rows(spark, DATA)
    exact = context.window_stats(rows, catalog.CFG).select("win", "context_protocol", "high_bytes").collect()
    near = {(r[0], r[1]): r[2] for r in context.window_stats(rows, replace(catalog.CFG, histogram_digits=3)).select("win", "context_protocol", "high_bytes").collect()}
    assert all(abs(near[r[0], r[1]] - r[2]) <= 0.01 * r[2] for r in exact)


def test_all_alerts_of_more_pairs_than_a_state_holds(spark, monkeypatch):
    """As in the SQL, every pair is kept: no run window by window, no eviction."""
    from dataclasses import replace

    from tidewatch.plans import incremental

    data = "/root/testdata/sf0.01"
    monkeypatch.setattr(catalog, "CFG", replace(catalog.CFG, max_pairs=1_000))
    monkeypatch.setattr(incremental, "run_range", lambda *a, **k: pytest.fail("window by window"))
    assert catalog._rows(spark, data).select("src_ip", "dst_ip", "protocol").distinct().count() > 1_000
    c = duckdb.connect()
    c.sql(f"create view events as from '{data}/events.parquet'")
    for name in ("alerts_union", "alert_type_counts"):
        assert plain(catalog.QUERIES[name](spark, data).toPandas()) == plain(c.sql(catalog.ORACLES[name]).df())


def test_rounding_rules_of_rows_without_bytes(spark, tmp_path):
    spark.sql("""select id as event_id, timestamp '2024-01-01 10:00:00' as ts, id as user_id, 'view' as event_type, case when id < 6 then 0.0 else id / 8.0 end as value,
                 '{"k": 5}' as props from range(12)""").write.parquet(f"{tmp_path}/events.parquet")
    c = duckdb.connect()
    c.sql(f"create view events as from '{tmp_path}/events.parquet/*.parquet'")
    assert plain(catalog.rounding_rules(spark, str(tmp_path)).toPandas()) == plain(c.sql(catalog.ORACLES["rounding_rules"]).df())
