"""Versioned state on shared storage: tables first, the manifest last."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from .incremental import State

#: Folders of the tables under the root.
PAIRS, CONTEXTS, MANIFEST = "pair-history", "context-history", "manifest"


class StateStore:
    """State versions 0, 1, ... under ``root``. A version counts once its
    manifest is written, which is after its tables; writing a version again
    replaces it, so a batch that is run again leaves the same state. Of older
    versions ``keep`` stay, the manifest of a dropped one going first."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 3) -> None:
        if keep < 2:
            raise ValueError("the newest version and the one before it are in use")
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def latest(self) -> int | None:
        try:
            rows = self.spark.read.schema("version long, cursor string, log_ids string").json(f"{self.root}/{MANIFEST}/*")
            return rows.agg({"version": "max"}).first()[0]
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None

    def write(self, version: int, state: State) -> None:
        state.pairs.write.mode("overwrite").parquet(f"{self.root}/{PAIRS}/v={version}")
        state.contexts.write.mode("overwrite").parquet(f"{self.root}/{CONTEXTS}/v={version}")
        row = [(version, state.cursor.isoformat() if state.cursor else "", state.log_ids)]
        self.spark.createDataFrame(row, "version long, cursor string, log_ids string").coalesce(1).write.mode("overwrite").json(
            f"{self.root}/{MANIFEST}/v{version:012d}")
        self._prune(version - self.keep)

    def _prune(self, last: int) -> None:
        """Drop the versions up to ``last``; a gap ends it, since what is older went before."""
        for v in range(last, -1, -1):
            if not self._delete(f"{MANIFEST}/v{v:012d}"):
                break
            self._delete(f"{PAIRS}/v={v}")
            self._delete(f"{CONTEXTS}/v={v}")

    def _delete(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def read(self, version: int | None = None) -> State:
        """The given or the newest complete version; the empty state if there is none."""
        version = self.latest() if version is None else version
        if version is None:
            return State.empty(self.spark)
        m = self.spark.read.schema("version long, cursor string, log_ids string").json(f"{self.root}/{MANIFEST}/v{version:012d}").first()
        return State(self.spark.read.parquet(f"{self.root}/{PAIRS}/v={version}"), self.spark.read.parquet(f"{self.root}/{CONTEXTS}/v={version}"),
                     datetime.fromisoformat(m["cursor"]) if m["cursor"] else None, m["log_ids"] or "")
