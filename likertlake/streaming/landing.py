"""Files that arrive over time, appended to bronze exactly once.

A streaming query with an ``availableNow`` trigger takes the files that no earlier run has
taken and ends. Its checkpoint remembers them, and the sink's own log says which part
files belong to a finished batch, so a run that is killed and started again neither
loses a row nor has one twice. Rows carry when and from where they came, and lines of the wrong width go to
a part of their own in the same write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from likertlake.sources import files


class Landing:
    """Delimited files of one header below ``source``, landed below ``root``.

    ``root`` must be in shared storage: it holds the rows and the checkpoint, and both
    belong together. ``columns`` is the header, which every file must have; a file of another header stops
    the run (see ``files.read_versions`` for those). ``files_at_once`` bounds a batch. A file counts as seen by its
    path; one that turns up with a time of ``oldest`` before the newest is no longer looked at.
    """

    def __init__(
        self, spark: SparkSession, source: str, root: str, columns: Sequence[str], sep: str = "\t",
        files_at_once: int | None = None, oldest: str = "3650d",
    ) -> None:
        self.spark, self.source, self.root = spark, source, root.rstrip("/")
        self.columns, self.sep, self.files_at_once, self.oldest = list(columns), sep, files_at_once, oldest

    @property
    def path(self) -> str:
        return f"{self.root}/rows"

    def arrivals(self) -> DataFrame:
        """The stream of raw lines with their lineage, whole ones and ragged ones."""
        fields = [T.StructField(c, T.StringType()) for c in [*self.columns, files.RAGGED]]
        reader = self.spark.readStream.schema(T.StructType(fields)).option("header", True).option("sep", self.sep).option("enforceSchema", False)
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", files.RAGGED).option("maxFileAge", self.oldest)
        if self.files_at_once:
            reader = reader.option("maxFilesPerTrigger", self.files_at_once)
        rows = files.with_lineage(reader.csv(self.source))
        return rows.withColumn(files.REJECTED, F.col(files.RAGGED).isNotNull())

    def run(self) -> int:
        """Take all files that are there now and were not taken before; the number of their lines."""
        query = (
            self.arrivals()
            .writeStream.format("parquet")
            .option("path", self.path)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .partitionBy(files.REJECTED)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    def _schema(self) -> T.StructType:
        text = [T.StructField(c, T.StringType()) for c in [*self.columns, files.RAGGED]]
        return T.StructType([*text, T.StructField(files.INGESTED, T.TimestampType()), T.StructField(files.ORIGIN, T.StringType())])

    def lines(self) -> DataFrame:
        """Everything landed. The sink's log is heeded: part files of unfinished batches are not read."""
        return self.spark.read.schema(self._schema().add(files.REJECTED, T.BooleanType())).parquet(self.path)

    def parts(self) -> list[str]:
        """The landed files that hold rows, by name: what a later step takes in portions."""
        return sorted(x for x in self.lines().inputFiles() if f"/{files.REJECTED}=false/" in x)

    def rows(self, parts: Sequence[str] | None = None) -> DataFrame:
        """Bronze: the lines of the right width, as text; all of them, or those of some ``parts``.

        A landed file never changes, so its name and the number of the row in it are a key that a row keeps
        (``files.FILE_ORDER``): ids can be given to answers that bring no key of their own.
        """
        whole = self.lines().where(~F.col(files.REJECTED)) if parts is None else self.spark.read.schema(self._schema()).parquet(*parts)
        place = [F.col("_metadata.file_name").alias(files.BLOCK), F.col("_metadata.row_index").alias(files.LINE)]
        return whole.select(*self.columns, files.INGESTED, files.ORIGIN, *place)

    def rejects(self) -> DataFrame:
        """The other lines, with the reason."""
        lines = self.lines().where(files.REJECTED)
        return files.reject_reasons(lines, len(self.columns), self.sep).select(files.REASON, files.RAGGED, files.INGESTED, files.ORIGIN)
