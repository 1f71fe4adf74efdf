"""File sources: delimited text, text inspection and file listing."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INGESTED, ORIGIN = "_data_ingestao", "_arquivo_origem"
BLOCK, LINE = "_bloco", "_linha"
FILE_ORDER = (ORIGIN, BLOCK, LINE)
RAGGED, REJECTED, REASON = "_linha_bruta", "_rejeitada", "motivo"
SCHEMA_VERSION = "_versao_esquema"


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    sep: str = "\t",
    corrupt_column: str | None = None,
) -> DataFrame:
    """Delimited file with a header, every column as text.

    ``columns`` must agree with the header; without them the header names the columns,
    which costs a look at the first line. Nothing is inferred from the rows. With
    ``corrupt_column`` rows of the wrong width are kept there as raw text instead of
    being padded or cut in silence.
    """
    if columns is None:
        columns = spark.read.option("header", True).option("sep", sep).csv(path if isinstance(path, str) else list(path)).columns
    fields = [T.StructField(c, T.StringType()) for c in columns]
    reader = spark.read.option("header", True).option("sep", sep).option("enforceSchema", False)
    if corrupt_column:
        fields.append(T.StructField(corrupt_column, T.StringType()))
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(T.StructType(fields)).csv(path if isinstance(path, str) else list(path))


def write_delimited(df: DataFrame, path: str, sep: str = "\t") -> None:
    (
        df.write.option("header", True)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def reject_reasons(lines: DataFrame, width: int, sep: str = "\t") -> DataFrame:
    """Why a raw line is not a row: too few fields, too many, or fields that cannot be told apart.

    Separators inside quotes are no separators; a line with a quote that is never closed is of the last kind.
    """
    plain = F.regexp_replace(RAGGED, '"([^"\\\\]|\\\\.)*"', "")
    fields = F.size(F.split(plain, F.lit(f"[{sep}]"), -1))
    reason = F.when(F.contains(plain, F.lit('"')) | (fields == width), "ilegivel").when(fields < width, "campos a menos").otherwise("campos a mais")
    return lines.withColumn(REASON, reason)


def split_ragged(spark: SparkSession, path: str | Sequence[str], to: str, columns: Sequence[str] | None = None, sep: str = "\t") -> tuple[DataFrame, DataFrame]:
    """Rows and rejected lines of delimited files, told apart in one pass over them.

    One write puts both below the folder ``to``, each in its part. Rows have the columns and their lineage;
    rejects have the reason, the raw line and its lineage. Together they are all lines but the headers.
    """
    scan = with_lineage(read_delimited(spark, path, columns, sep, corrupt_column=RAGGED))
    names = [c for c in scan.columns if c not in (RAGGED, INGESTED, ORIGIN)]
    scan.withColumn(REJECTED, F.col(RAGGED).isNotNull()).write.partitionBy(REJECTED).parquet(to)
    # Without a row there is no part to infer the schema from.
    landed = spark.read.schema(T.StructType([*scan.schema.fields, T.StructField(REJECTED, T.BooleanType())])).parquet(to)
    rejects = reject_reasons(landed.where(REJECTED), len(names), sep)
    return landed.where(~F.col(REJECTED)).select(*names, INGESTED, ORIGIN), rejects.select(REASON, RAGGED, INGESTED, ORIGIN)


def headers(spark: SparkSession, path: str, sep: str = "\t", at_once: int = 16) -> list[tuple[str, tuple[str, ...]]]:
    """File and column names of every delimited file below ``path``, by name of the file.

    Like the footers of columnar files, headers are read by the driver, several at a time: one short read for each
    file, whatever its size. Hidden and empty files are left out.
    """
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found, listing = [], fs.listFiles(at, True)
    while listing.hasNext():
        status = listing.next()
        if status.getPath().getName()[:1] not in "._" and status.getLen():
            found.append(status.getPath().toString())

    def header(file: str) -> tuple[str, tuple[str, ...]]:
        names = spark.read.option("header", True).option("sep", sep).csv(file).columns
        return file, tuple(names)

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(header, sorted(found)))


def schema_versions(found: Sequence[tuple[str, tuple[str, ...]]], known: Sequence[tuple[str, ...]] = ()) -> list[tuple[str, ...]]:
    """Headers in order of their first file, after those ``known``. The place of one is its version, counted from 1.

    Columns in another order are the same header to a reader by name, but another to one by position, so they are a version of their own.
    """
    out = list(known)
    for _, names in found:
        if names not in out:
            out.append(names)
    return out


def read_versions(spark: SparkSession, path: str, sep: str = "\t", known: Sequence[tuple[str, ...]] = ()) -> DataFrame:
    """Delimited files of several headers as one table, columns found by name.

    A column that a file does not have is null in its rows, wherever the others stand. Each row has the version of its
    file's header (``schema_versions``) and its lineage. There is one scan for each version, none for each file.
    """
    found = headers(spark, path, sep)
    versions = schema_versions(found, known)
    out = None
    for number, names in enumerate(versions, 1):
        own = [file for file, header in found if header == names]
        if own:
            if len(set(names)) < len(names):
                raise ValueError(f"a column name occurs twice in {own[0]}")
            scan = with_lineage(read_delimited(spark, own, names, sep)).withColumn(SCHEMA_VERSION, F.lit(number))
            out = scan if out is None else out.unionByName(scan, allowMissingColumns=True)
    if out is None:
        raise LookupError(f"no delimited file below {path}")
    lineage = [INGESTED, ORIGIN, SCHEMA_VERSION]
    return out.select(*[c for c in out.columns if c not in lineage], *lineage)


def with_lineage(scan: DataFrame) -> DataFrame:
    """Load time and source file of every row. ``scan`` must read files directly."""
    return scan.select(
        "*",
        F.current_timestamp().alias(INGESTED),
        F.col("_metadata.file_path").alias(ORIGIN),
    )


def with_file_order(scan: DataFrame) -> DataFrame:
    """Where a row stood: file, start of its block, and a number that grows within it.

    Ordering by the three gives the line order of the files however they are
    split, because a line belongs to exactly one block and rows of a block are
    read in sequence.
    """
    return scan.select(
        "*",
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(LINE),
    )


def text_head(spark: SparkSession, path: str, lines: int = 3, width: int = 500) -> DataFrame:
    """First lines of one file, cut to ``width``, broken bytes replaced.

    A limit without an order stops after the first rows of the first block.
    """
    head = spark.read.text(path).limit(lines)
    return head.select(F.substring(F.make_valid_utf8("value"), 1, width).alias("linha"))


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    """Small documents such as a codebook, one row per file."""
    return spark.read.text(path, wholetext=True).select(
        F.regexp_extract("_metadata.file_path", "[^/]+$", 0).alias("arquivo"),
        F.make_valid_utf8("value").alias("texto"),
    )


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and time of the files in a folder; contents are never read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.regexp_extract("path", "[^/]+$", 0).alias("arquivo"),
        F.col("length").alias("bytes"),
        F.round(F.col("length") / (1024 * 1024), 2).alias("tamanho_mb"),
        F.col("modificationTime").alias("modificado_em"),
    ).orderBy("arquivo")
