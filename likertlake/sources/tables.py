"""Layered tables: schemas, writes, comments and descriptions."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from likertlake.sources.versions import Shape, Version, VersionFolder

LAYERS = ("bronze", "silver", "gold")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Layers:
    """One schema per layer, optionally with a common prefix and location.

    ``location`` puts the managed tables of every layer below one shared folder;
    without it they go to the warehouse of the session. ``fmt`` is any table
    format the session knows. ``buckets`` is the least number of files that tables of
    respondents are dealt to by id, so that they join without a shuffle; a lake takes more
    for more respondents. Delta tables have no buckets: they are clustered by the id
    instead, and their joins do shuffle.

    A table is replaced by a new version of its files beside the old one (``save``);
    ``keep`` versions stay. Delta has versions of its own and is left to them.
    """

    def __init__(
        self,
        spark: SparkSession,
        prefix: str = "",
        location: str | None = None,
        fmt: str = "parquet",
        buckets: int = 8,
        keep: int = 2,
    ) -> None:
        self.spark, self.prefix, self.fmt, self.buckets, self.keep = spark, prefix, fmt, buckets, max(1, keep)
        for layer in LAYERS:
            at = f" LOCATION {_quoted(f'{location}/{layer}')}" if location else ""
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema(layer)}{at}")

    def schema(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.schema(layer)}.{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def save(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        comment: str = "",
        columns: Mapping[str, str] | None = None,
        bucket_by: str | None = None,
        partition_by: str | None = None,
        checks: Mapping[str, Column] | None = None,
        buckets: int | None = None,
    ) -> DataFrame:
        """Replace the table and its schema, then document it.

        The rows are written to a folder of their own, read back and held against
        ``checks`` (aggregates that must be true). Until then the table is untouched: a run
        that fails or is killed leaves the old rows readable, and the next one starts
        afresh. The replacement is then one change of location in the catalogue. Where the
        columns, buckets or partitions differ, the table is dropped and the new one takes its name;
        ``recover`` puts it back should the run end between the two.
        """
        notes = dict(columns or {})
        noted = df.select(
            *[
                F.col(c).alias(c, metadata={"comment": notes[c]}) if c in notes else F.col(c)
                for c in df.columns
            ]
        )
        if self.fmt == "delta":
            self._save_delta(noted, self.name(layer, table), bucket_by, partition_by)
        else:
            self._publish(noted, layer, table, bucket_by, partition_by, checks or {}, buckets or self.buckets)
        if comment:
            self.comment(layer, table, comment)
        return self.read(layer, table)

    def _save_delta(self, df: DataFrame, name: str, bucket_by: str | None, partition_by: str | None) -> None:
        writer = df.write.format(self.fmt).mode("overwrite").option("overwriteSchema", "true")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        elif bucket_by:
            writer = writer.clusterBy(bucket_by)
        writer.saveAsTable(name)

    # -- versions -----------------------------------------------------------

    def versions(self, layer: str, table: str) -> VersionFolder:
        root = self.spark.catalog.getDatabase(self.schema(layer)).locationUri
        return VersionFolder(self.spark, f"{root.rstrip('/')}/{table}")

    def buckets_of(self, layer: str, table: str) -> int:
        """Files of the newest version of a bucketed table; the least number for a table that is none or of another make."""
        valid = [] if self.fmt == "delta" else self.versions(layer, table).all()
        return (valid[-1].shape.buckets if valid else 0) or self.buckets

    def _publish(
        self, df: DataFrame, layer: str, table: str, bucket_by: str | None, partition_by: str | None, checks: Mapping[str, Column], buckets: int
    ) -> None:
        folder, live = self.versions(layer, table), self.name(layer, table)
        before = folder.all()
        number, path = folder.next()
        staged = f"{live}__staged"
        self.spark.sql(f"DROP TABLE IF EXISTS {staged}")
        written = Observation()
        writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write.format(self.fmt).option("path", path)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        if bucket_by:
            writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
        writer.saveAsTable(staged)
        shape = Shape(self.fmt, self.spark.table(staged).schema.json(), partition_by, bucket_by, buckets if bucket_by else 0)
        version = Version(number, path, written.get["rows"], shape)
        try:
            folder.validate(version, checks)
        except ValueError:
            self.spark.sql(f"DROP TABLE {staged}")
            raise
        folder.mark(version)
        if before and before[-1].shape == shape and not partition_by and self.exists(layer, table):
            self.spark.sql(f"ALTER TABLE {live} SET LOCATION {_quoted(path)}")
            self.spark.sql(f"DROP TABLE {staged}")
        else:  # partitions keep locations of their own
            self.spark.sql(f"DROP TABLE IF EXISTS {live}")
            self.spark.sql(f"ALTER TABLE {staged} RENAME TO {live}")
        self.spark.catalog.refreshTable(live)
        folder.prune(self.keep)

    def recover(self, layer: str, table: str) -> bool:
        """Point the catalogue at the newest valid version, if it points elsewhere or nowhere.

        For a new session over the files of an old one, and after a run that was killed
        between validation and swap. False if there is no valid version.
        """
        folder, name = self.versions(layer, table), self.name(layer, table)
        valid = folder.all()
        if not valid:
            return False
        version = valid[-1]
        self.spark.sql(f"DROP TABLE IF EXISTS {name}__staged")
        if self.exists(layer, table):
            if self.location(layer, table).endswith(version.path.rsplit("/", 1)[1]):
                return True
            self.spark.sql(f"DROP TABLE {name}")
        shape = version.shape
        note = lambda f: f" COMMENT {_quoted(f.metadata['comment'])}" if "comment" in f.metadata else ""
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{note(f)}" for f in StructType.fromJson(json.loads(shape.schema)))
        parts = f" PARTITIONED BY (`{shape.partition_by}`)" if shape.partition_by else ""
        dealt = f" CLUSTERED BY (`{shape.bucket_by}`) SORTED BY (`{shape.bucket_by}`) INTO {shape.buckets} BUCKETS" if shape.bucket_by else ""
        self.spark.sql(f"CREATE TABLE {name} ({fields}) USING {shape.fmt}{parts}{dealt} LOCATION {_quoted(version.path)}")
        if shape.partition_by:
            self.spark.catalog.recoverPartitions(name)
        return True

    def history(self, layer: str, table: str) -> DataFrame:
        """The valid versions of a table and their rows; the last is the one in use."""
        rows = [(v.number, v.rows, v.number == n) for valid in [self.versions(layer, table).all()] for n in [max((x.number for x in valid), default=0)] for v in valid]
        return self.spark.createDataFrame(rows, "versao int, registros bigint, em_uso boolean")

    def version(self, layer: str, table: str, number: int) -> DataFrame:
        """The rows of one version."""
        folder = self.versions(layer, table)
        found = [v for v in folder.all() if v.number == number]
        if not found:
            raise LookupError(f"{self.name(layer, table)} has no version {number}")
        return folder.read(found[0])

    def changes(self, layer: str, table: str, old: int, new: int, key: str) -> DataFrame:
        """How many rows, found by ``key``, were added, removed, changed or kept between two versions.

        Rows are compared by a digest of the columns that both versions have; a null key is one key.
        """
        before, after = self.version(layer, table, old), self.version(layer, table, new)
        shared = [c for c in before.columns if c in after.columns and c != key]
        cells = lambda: F.sha2(F.to_json(F.struct(*[f"`{c}`" for c in shared]), {"ignoreNullFields": "false"}), 256)
        a = before.select(F.col(key).alias("_a"), cells().alias("_old"))
        b = after.select(F.col(key).alias("_b"), cells().alias("_new"))
        state = F.when(F.col("_old").isNull(), "incluido").when(F.col("_new").isNull(), "removido").when(F.col("_old") == F.col("_new"), "igual").otherwise("alterado")
        both = a.join(b, F.col("_a").eqNullSafe(F.col("_b")), "full").groupBy(state.alias("situacao"))
        return both.agg(F.count(F.lit(1)).alias("registros"))

    def comment(self, layer: str, table: str, text: str) -> None:
        self.spark.sql(f"COMMENT ON TABLE {self.name(layer, table)} IS {_quoted(text)}")

    def listing(self, layer: str) -> DataFrame:
        """The tables of a layer; the catalogue lists views of the session with those of every schema."""
        return self.spark.sql(f"SHOW TABLES IN {self.schema(layer)}").where("not isTemporary")

    def describe(self, layer: str, table: str) -> DataFrame:
        return self.spark.sql(f"DESCRIBE EXTENDED {self.name(layer, table)}")

    def view(self, df: DataFrame, name: str) -> DataFrame:
        """Session view for use from SQL; nothing is written."""
        df.createOrReplaceTempView(name)
        return self.spark.table(name)

    def rows_written(self, layer: str, table: str) -> int | None:
        """The rows of the version in use, as its write counted them; None for a table of another make."""
        valid = [] if self.fmt == "delta" else self.versions(layer, table).all()
        return valid[-1].rows if valid and self.location(layer, table).endswith(valid[-1].path.rsplit("/", 1)[1]) else None

    def location(self, layer: str, table: str) -> str:
        at = self.describe(layer, table).where("col_name = 'Location'").first()
        return at.data_type.rstrip("/") if at else ""

    def profile(self, layer: str) -> DataFrame:
        """Rows, columns and comment of each table that the catalogue lists.

        Rows were counted when they were written, so no table is read; one that was not written by ``save`` is counted.
        """
        out = []
        for table in sorted(r.tableName for r in self.listing(layer).collect()):
            df, rows = self.read(layer, table), self.rows_written(layer, table)
            note = self.spark.catalog.getTable(self.name(layer, table)).description or ""
            out.append((layer, table, df.count() if rows is None else rows, len(df.columns), note))
        return self.spark.createDataFrame(out, "camada string, tabela string, registros bigint, colunas int, comentario string")

    def column_catalogue(self, layer: str, table: str) -> DataFrame:
        """Type and description as the catalogue has them, and observed domain of each column."""
        df = self.read(layer, table)
        known = self.spark.sql(f"DESCRIBE TABLE {self.name(layer, table)}").where("data_type <> '' AND col_name NOT LIKE '#%'")
        # Partition columns are listed twice.
        known = known.distinct().select(
            F.col("col_name").alias("campo"), F.col("data_type").alias("tipo"), F.coalesce("comment", F.lit("")).alias("descricao")
        )
        shown = df.select(*[F.col(c).alias(c) for c in df.columns])
        aggs = [
            x
            for c in df.columns
            for x in (
                F.count(c).alias(f"{c}__n"),
                F.min(c).cast("string").alias(f"{c}__lo"),
                F.max(c).cast("string").alias(f"{c}__hi"),
            )
        ]
        cells = [
            x
            for f in df.schema.fields
            for x in (
                F.lit(f.name),
                F.col(f"{f.name}__n"),
                F.col(f"{f.name}__lo"),
                F.col(f"{f.name}__hi"),
            )
        ]
        names = ("campo", "preenchidos", "minimo", "maximo")
        domain = shown.agg(*aggs).select(F.stack(F.lit(len(df.columns)), *cells).alias(*names))
        return known.join(domain, "campo").select("campo", "tipo", "descricao", "preenchidos", "minimo", "maximo")
