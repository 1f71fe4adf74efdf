"""Replacing a table: validated versions, one swap, and what a killed run leaves behind."""

import os
import signal
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from likertlake.sources.tables import Layers
from likertlake.sources.versions import MARKER, InvalidVersion

FORMS = [{}, {"bucket_by": "id"}, {"partition_by": "p"}, {"bucket_by": "id", "partition_by": "p"}]


@pytest.fixture
def layers(spark, tmp_path):
    made = Layers(spark, f"v{abs(hash(str(tmp_path))) % 10**9}_", str(tmp_path), buckets=3)
    yield made
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA {made.schema(layer)} CASCADE")


@pytest.fixture
def rows(spark):
    return spark.range(60).select("id", (F.col("id") % 3).cast("string").alias("p"), F.lit(1).alias("v"))


def folders(tmp_path, table):
    return sorted(p.name for p in (tmp_path / "gold" / table).iterdir() if p.is_dir())


@pytest.mark.parametrize("form", FORMS)
def test_a_failed_write_leaves_the_table_as_it_was(layers, rows, form, tmp_path):
    layers.save(rows, "gold", "t", "first", **form)
    before = sorted(map(tuple, layers.read("gold", "t").select("id", "p", "v").collect()))
    broken = rows.withColumn("v", F.when(F.col("id") == 41, F.raise_error(F.lit("no"))).otherwise(2))
    with pytest.raises(Exception, match="no"):
        layers.save(broken, "gold", "t", "second", **form)
    assert sorted(map(tuple, layers.read("gold", "t").select("id", "p", "v").collect())) == before
    after = layers.save(rows.where("id < 10").withColumn("v", F.lit(3)), "gold", "t", "third", **form)
    assert {r.v for r in after.collect()} == {3} and after.count() == 10
    assert [r.tableName for r in layers.listing("gold").collect()] == ["t"]
    assert all((tmp_path / "gold" / "t" / f / MARKER).exists() for f in folders(tmp_path, "t"))


def test_what_is_not_valid_is_not_published(layers, rows, tmp_path):
    layers.save(rows, "gold", "t")
    with pytest.raises(InvalidVersion, match="ids are distinct"):
        layers.save(rows.union(rows), "gold", "t", checks={"ids are distinct": F.count("id") == F.count_distinct("id")})
    assert layers.read("gold", "t").count() == 60 and len(folders(tmp_path, "t")) == 1
    assert layers.save(rows.limit(0), "gold", "t", checks={"small": F.max("id") < 5}).count() == 0


def test_both_versions_can_be_read_and_compared(layers, rows):
    layers.save(rows, "gold", "t")
    old = layers.read("gold", "t")
    changed = rows.where("id > 4").withColumn("v", F.when(F.col("id") < 20, F.lit(None)).otherwise(F.col("v"))).union(rows.where("id < 7").withColumn("id", F.col("id") + 100))
    layers.save(changed, "gold", "t")
    assert old.count() == 60  # a reader of the version before goes on
    assert [tuple(r) for r in layers.history("gold", "t").collect()] == [(1, 60, False), (2, 62, True)]
    got = {r.situacao: r.registros for r in layers.changes("gold", "t", 1, 2, "id").collect()}
    assert got == {"removido": 5, "incluido": 7, "alterado": 15, "igual": 40}
    layers.save(rows, "gold", "t")
    with pytest.raises(LookupError):
        layers.version("gold", "t", 1)
    assert layers.version("gold", "t", 2).count() == 62


def test_the_swap_is_one_change_of_location(layers, rows, spark):
    """Columns, comments and the table itself stay; only where its files are changes."""
    layers.save(rows, "gold", "t", "note", {"v": "value"}, bucket_by="id")
    said = lambda: {r.col_name: (r.data_type, r.comment) for r in layers.describe("gold", "t").collect()}
    before = said()
    layers.save(rows.where("id < 5"), "gold", "t", "note", {"v": "value"}, bucket_by="id")
    after = said()
    assert {k for k in before if before[k] != after.get(k)} <= {"Location", "Statistics"}
    assert after["Location"] != before["Location"] and after["v"] == ("int", "value")


def test_columns_may_change(layers, rows):
    layers.save(rows, "gold", "t", bucket_by="id")
    got = layers.save(rows.select("id", F.lit("x").alias("w")), "gold", "t")
    assert got.columns == ["id", "w"] and got.count() == 60
    assert layers.changes("gold", "t", 1, 2, "id").collect()[0].situacao == "igual"


@pytest.mark.parametrize("form", FORMS)
def test_files_without_a_catalogue_are_found_again(layers, rows, spark, form):
    layers.save(rows, "gold", "t", "note", {"v": "value"}, **form)
    layers.save(rows.where("id < 30"), "gold", "t", "note", {"v": "value"}, **form)
    spark.sql(f"DROP TABLE {layers.name('gold', 't')}")
    assert layers.recover("gold", "t") and layers.read("gold", "t").count() == 30
    assert dict(layers.read("gold", "t").dtypes) == dict(rows.dtypes)
    assert layers.recover("gold", "t")  # nothing to do
    assert not layers.recover("gold", "never_written")
    joined = layers.read("gold", "t").groupBy("id").count()
    if form == {"bucket_by": "id"}:
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 30


def test_the_catalogue_knows_the_rows_without_counting(layers, rows, spark, tmp_path):
    layers.save(rows, "gold", "t", "note")
    layers.save(rows.where("id < 7"), "gold", "t", "note")
    rows.limit(3).write.saveAsTable(layers.name("gold", "other"))
    got = layers.profile("gold")
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in got.orderBy("tabela").collect()] == [("gold", "other", 3, 3, ""), ("gold", "t", 7, 3, "note")]
    assert layers.rows_written("gold", "other") is None
    assert layers.profile("silver").collect() == []


KILLED = """
import os, signal, sys, threading, time
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from likertlake.session import local_session
from likertlake.sources.tables import Layers
spark = local_session("2", "killed", "1g")
layers = Layers(spark, "", {root!r})
rows = spark.range(0, 1000, 1, 4).select("id", F.lit({v}).alias("v"))
layers.save(rows, "gold", "t")
folder = layers.versions("gold", "t")
if {where!r} == "writing":
    slow = F.when(F.col("id") > 600, F.java_method(F.lit("java.lang.Thread"), F.lit("sleep"), F.lit(100).cast("bigint")))
    def kill():
        while len(folder._numbers()) < 2:
            time.sleep(0.05)
        time.sleep(1)
        os.kill(os.getpid(), signal.SIGKILL)
    threading.Thread(target=kill, daemon=True).start()
    layers.save(rows.withColumn("v", F.lit(2)).where(F.col("id") + F.coalesce(F.length(slow), F.lit(0)) >= 0), "gold", "t")
else:
    mark = type(folder).mark
    def and_die(self, version):
        mark(self, version)
        os.kill(os.getpid(), signal.SIGKILL)
    type(folder).mark = and_die
    layers.save(rows.withColumn("v", F.lit(2)), "gold", "t")
"""


@pytest.mark.parametrize("where, value", [("writing", 1), ("before the swap", 2)])
def test_a_killed_build(layers, spark, tmp_path, where, value):
    """Killed in the write, the old rows are there; killed once the new ones were valid, these are."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = textwrap.dedent(KILLED).format(repo=repo, root=str(tmp_path), v=1, where=where)
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=180, cwd=tmp_path)
    assert done.returncode == -signal.SIGKILL, done.stderr.decode()[-2000:]
    assert layers.recover("gold", "t")
    rows = layers.read("gold", "t")
    assert rows.count() == 1000 and {r.v for r in rows.select("v").distinct().collect()} == {value}
    layers.save(rows.select("id", F.lit(9).alias("v")), "gold", "t")
    assert all((tmp_path / "gold" / "t" / f / MARKER).exists() for f in folders(tmp_path, "t"))
    assert {r.v for r in layers.read("gold", "t").select("v").distinct().collect()} == {9}
