"""Versions of a table's files, each in a folder of its own.

A version counts once its files were read back and found whole: it then gets a marker,
which says how the files are to be read. Folders without one are remains of a run that
ended early; readers never see them and the next run removes them. Since markers lie
beside the files, tables can be put back into a catalogue that has lost them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Readers skip names with this first character.
MARKER = "_valid.json"


class InvalidVersion(ValueError):
    """What was written is not what was meant; the table is as it was."""


class Shape(NamedTuple):
    """How the files of a version are to be read. Versions of one shape can be swapped by location alone."""

    fmt: str
    schema: str
    partition_by: str | None
    bucket_by: str | None
    buckets: int


class Version(NamedTuple):
    number: int
    path: str
    rows: int
    shape: Shape


class VersionFolder:
    """All versions of one table below ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def _files(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _numbers(self) -> dict[int, list[str]]:
        """Folders by number, finished or not."""
        at, fs = self._files(self.root)
        out: dict[int, list[str]] = {}
        if fs.exists(at):
            for status in fs.listStatus(at):
                name = status.getPath().getName()
                if status.isDirectory() and name[:1] == "v" and name[1:7].isdigit():
                    out.setdefault(int(name[1:7]), []).append(f"{self.root}/{name}")
        return out

    def _marker(self, path: str) -> dict | None:
        at, fs = self._files(f"{path}/{MARKER}")
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def all(self) -> list[Version]:
        """Valid versions, oldest first."""
        found = []
        for number, paths in sorted(self._numbers().items()):
            for path in paths:
                if info := self._marker(path):
                    found.append(Version(number, path, info["rows"], Shape(**info["shape"])))
        return found

    def next(self) -> tuple[int, str]:
        """Number and folder of a version to be written; what earlier runs left unfinished goes."""
        numbers = self._numbers()
        for paths in numbers.values():
            for path in paths:
                if self._marker(path) is None:
                    self.remove(path)
        number = max(numbers, default=0) + 1
        return number, f"{self.root}/v{number:06d}-{uuid.uuid4().hex[:8]}"

    def read(self, version: Version) -> DataFrame:
        schema = StructType.fromJson(json.loads(version.shape.schema))
        return self.spark.read.format(version.shape.fmt).schema(schema).load(version.path)

    def validate(self, version: Version, checks: Mapping[str, Column]) -> None:
        """Read the files back, compare their rows with those written and evaluate ``checks``.

        A check is an aggregate that must be true; over no rows, null passes.
        """
        got = self.read(version).agg(F.count(F.lit(1)).alias("rows"), *[c.alias(f"c{i}") for i, c in enumerate(checks.values())]).first()
        wrong = [name for i, name in enumerate(checks) if got[f"c{i}"] is False]
        if got["rows"] != version.rows:
            wrong.append(f"{got['rows']} rows read, {version.rows} written")
        if wrong:
            self.remove(version.path)
            raise InvalidVersion(f"{self.root}: {'; '.join(wrong)}")

    def mark(self, version: Version) -> None:
        """From here on the version is valid, whatever happens to this run."""
        at, fs = self._files(f"{version.path}/{MARKER}")
        stream = fs.create(at, True)
        try:
            stream.write(bytearray(json.dumps({"rows": version.rows, "shape": version.shape._asdict()}).encode()))
        finally:
            stream.close()

    def prune(self, keep: int) -> None:
        """Remove all but the newest ``keep`` valid versions; readers of the one before may go on."""
        for version in self.all()[:-keep]:
            self.remove(version.path)

    def remove(self, path: str) -> None:
        at, fs = self._files(path)
        fs.delete(at, True)
