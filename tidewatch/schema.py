"""Schemas of rows in, alerts out and state."""

METRICS = ("collect_time timestamp_ntz, src_ip string, dst_ip string, protocol string, conn_count bigint, "
           "c2s_pkts bigint, s2c_pkts bigint, c2s_bytes bigint, s2c_bytes bigint, row_id bigint")
COUNTERS = ("conn_count", "c2s_pkts", "s2c_pkts", "c2s_bytes", "s2c_bytes")
PAIR = ("src_ip", "dst_ip", "protocol")
CONTEXT = ("context_protocol", "day_type", "slot")
STATS = ("p50_bytes", "p90_bytes", "high_bytes", "p50_pkts", "p90_pkts", "high_pkts")

PAIR_STATE = ("src_ip string, dst_ip string, protocol string, ema_bytes double, ema_pkts double, samples bigint, "
              "last_seen timestamp_ntz, update_time timestamp_ntz, update_order bigint")
CONTEXT_STATE = "context_protocol string, day_type string, slot int, day date, measure string, value bigint, n bigint"
