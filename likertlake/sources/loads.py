"""Small results kept load by load, so that later loads need not read earlier rows again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LOAD = "carga"


class LoadFolder:
    """One result for each load below ``root``, in a folder ``carga=n`` of its own.

    Writing a load again replaces its result as a whole, so a run that was killed is simply repeated. Only finished
    loads are read: a folder without the writer's mark of success does not count.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, load: int) -> str:
        return f"{self.root}/{LOAD}={load}"

    def loads(self) -> list[int]:
        """Numbers of the finished loads, ascending."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        at = path(self.root)
        fs = at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n[len(LOAD) + 1 :]) for n in names if n.startswith(f"{LOAD}=") and fs.exists(path(f"{self.root}/{n}/_SUCCESS")))

    def write(self, load: int, rows: DataFrame) -> DataFrame:
        """Keep the result of a load; the rows as they are kept."""
        rows.write.mode("overwrite").parquet(self._path(load))
        return self.spark.read.schema(rows.schema).parquet(self._path(load))

    def read(self, before: int | None = None) -> DataFrame | None:
        """The results of all finished loads, or of those below ``before``, with their number; None without any."""
        paths = [self._path(n) for n in self.loads() if before is None or n < before]
        return self.spark.read.option("basePath", self.root).parquet(*paths) if paths else None
