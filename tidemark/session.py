"""Session builder and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings every query assumes: UTC, ANSI, adaptive execution.

    On a cluster, submit with the same SQL settings and ``spark.checkpoint.dir`` on shared storage.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


_LOCAL_SCRATCH: list[str] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only a single-machine session (``local[...]``) may go without the setting; it then gets a temporary
    folder. Anywhere else a missing setting is an error, since executors do not share local folders.
    """
    set_by_cluster = spark.conf.get("spark.checkpoint.dir", None)
    if set_by_cluster:
        return set_by_cluster.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _LOCAL_SCRATCH:
        _LOCAL_SCRATCH.append(tempfile.mkdtemp(prefix="tidemark-"))
    return _LOCAL_SCRATCH[0]


class Workspace:
    """A folder of its own below the shared one, and tables in it; both go when the driver ends, or by ``drop``."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.id = spark, f"{name}_{uuid.uuid4().hex}"
        self.path, self.tables = f"{checkpoint_root(spark)}/tidemark/{self.id}", []
        atexit.register(self._sweep)

    def table(self, name: str) -> str:
        """The name of a table of this workspace; its files belong below ``path``."""
        self.tables.append(f"{name}_{self.id}")
        return self.tables[-1]

    def drop(self) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables = []
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _sweep(self) -> None:
        try:
            self.drop()
        except Exception:  # the session is gone already; the folder's owner purges it
            pass
