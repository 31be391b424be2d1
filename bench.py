"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1); BENCH_CPUS: cores.
Every query is written to Spark's noop sink, once to warm up and once measured.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("window_summary", "candidates_topk_per_window", "context_window_stats", "context_history_uncapped_7d", "context_history_capped",
            "effective_context", "large_traffic_cold_start", "large_traffic_history", "large_traffic_full", "pair_ema", "off_hours_topn",
            "heavy_hitters_space_saving", "alerts_union", "alert_json_type3")


def main() -> None:
    from pyspark.sql import SparkSession

    from tidewatch.config import Config
    from tidewatch.operators import offhours, windows
    from tidewatch.plans import backfill, catalog
    from tidewatch.sources.fixtures import from_lineitem
    from tidewatch.sources.metrics import normalize

    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    cfg = Config(window_minutes=60, slot_minutes=60)

    def lineitem(s, d):
        return windows.assign(normalize(from_lineitem(s, d)), cfg)

    queries = {n: catalog.QUERIES[n] for n in HEADLINE}
    queries["lineitem_off_hours_topn"] = lambda s, d: offhours.top_pairs(lineitem(s, d), cfg)
    queries["lineitem_large_full"] = lambda s, d: backfill.large_parts(lineitem(s, d), cfg)[0]
    times = {}
    for name, f in queries.items():
        for _ in range(2):
            t = time.time()
            f(spark, sf).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
