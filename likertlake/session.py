"""Session settings the engine relies on, and where it may write."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# A fused stage over 27 item columns makes one very long generated method. Above
# 8,000 bytes of bytecode the JVM never compiles it and it runs interpreted, about
# ten times slower; somewhat below, compiling takes so long that most of a task is
# over before it helps. With this limit Spark splits such stages into methods that
# compile at once, while the common stages (2,000 to 3,500 bytes) stay fused.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "4000",
}

# Tables of respondents are written from other such tables. Read by bucket, a task has the rows
# of one, however large the table; else Spark packs files up to a size, whatever a row becomes.
WRITE_CONF = RUNTIME_CONF | {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}

_local_roots: dict[str, str] = {}
_tuning = threading.RLock()


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def tuned(spark: SparkSession) -> Iterator[None]:
    """``WRITE_CONF`` for the writes made inside, in a session that nobody tuned.

    What the session sets itself holds, and afterwards its settings are as before.
    """
    with _tuning:
        unset = {k: v for k, v in WRITE_CONF.items() if spark.conf.get(k, None) is None}
        for key, value in unset.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key in unset:
                spark.conf.unset(key)


def local_session(cores: str = "8", app: str = "likertlake", memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def application_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id")


def shared_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables, visible to every executor.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may do
    without: there driver and executors are one process on one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/likertlake"
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder"
        )
    app = application_id(spark)
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _local_roots[app]


class Workspace:
    """A private folder below the shared root, one per owner."""

    def __init__(self, spark: SparkSession, name: str = "work") -> None:
        self.spark = spark
        self.root = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def inner(self, name: str) -> Workspace:
        """A folder below this one, to be dropped as a whole."""
        space = Workspace(self.spark, name)
        space.root = f"{self.root}/{space.root.rsplit('/', 1)[-1]}"
        return space

    def drop(self) -> None:
        """Delete the folder with all that was cut there."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a scan of the written files.

        The scan starts a new lineage on durable files, so values that depend on
        the physical layout of the run that wrote them are fixed from here on and
        lost executors cost a re-read, not a recomputation.
        """
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
