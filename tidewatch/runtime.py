"""What a run needs of its session: a shared checkpoint folder and this package on the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; one of our own only in local mode, where none is
    set. On a cluster a folder of this machine would be no one else's, so that is an error."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (sc.master or "").startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidewatch-ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Tables written to the shared checkpoint folder. Unlike checkpoints they
    are columnar and carry no constraints of the plans that made them, which
    otherwise grow from round to round of a loop; and they can be dropped."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.root, self.made = spark, f"{checkpoint_dir(spark)}/tidewatch-{uuid.uuid4().hex}", 0

    def cut(self, df: DataFrame) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made}"
        df.write.parquet(path)
        if self.made == 1:
            self._fs(self.root, lambda fs, p: fs.deleteOnExit(p))
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete tables that nothing will read again; the rest goes when the application ends."""
        for t in tables:
            if t is not None and (name := getattr(t, "_scratch_path", None)):
                self._fs(name, lambda fs, p: fs.delete(p, True))

    def _fs(self, name: str, act: Callable) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        act(path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python
    workers can import it wherever the driver was started from."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    pack = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pack)
    path = os.path.join(tempfile.mkdtemp(prefix="tidewatch-zip-"), f"{os.path.basename(pack)}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(pack):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
