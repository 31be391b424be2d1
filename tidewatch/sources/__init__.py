from .metrics import normalize, read_jdbc, read_metrics, table_name, time_predicate, watermark  # noqa: F401
