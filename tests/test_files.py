"""Landed files through the whole pipeline, and the table layer."""

import os
import tempfile
import uuid

import pytest

from likertlake.instrument import SHORT_FORM_27 as SPEC
from likertlake.operators import analysis
from likertlake.plans.lake import file_lake
from likertlake.sources import files
from likertlake.sources.tables import Layers


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def write(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_ragged_rows(spark, folder):
    path = write(folder, "data.csv", ["a\tb\tc", "1\t2", "1\t2\t3\t4", "1\t\t3", 'x\t"y z"\tw'])
    plain = [tuple(r) for r in files.read_delimited(spark, path, ["a", "b", "c"]).collect()]
    assert plain == [("1", "2", None), ("1", "2", "3"), ("1", None, "3"), ("x", "y z", "w")]
    kept = files.read_delimited(spark, path, ["a", "b", "c"], corrupt_column="_corrupt").collect()
    assert [r._corrupt for r in kept] == ["1\t2", "1\t2\t3\t4", None, None]


def test_header_must_agree(spark, folder):
    path = write(folder, "data.csv", ["a\tz", "1\t2"])
    with pytest.raises(Exception, match="(?i)header"):
        files.read_delimited(spark, path, ["a", "b"]).collect()


def test_text_head_whole_text_and_manifest(spark, folder):
    path = write(folder, "codebook.txt", ["first " + "x" * 600, "second", "third", "fourth"])
    head = [r.linha for r in files.text_head(spark, path).collect()]
    assert [len(h) for h in head] == [500, 6, 5]
    whole = files.whole_text(spark, path).first()
    assert whole.arquivo == "codebook.txt" and whole.texto.endswith("fourth\n")
    size = files.file_manifest(spark, folder).first()
    assert (size.arquivo, size.bytes) == ("codebook.txt", os.path.getsize(path))


def test_broken_bytes_are_replaced(spark, folder):
    path = os.path.join(folder, "data.csv")
    with open(path, "wb") as f:
        f.write(b"caf\xc3\xa9 \xff\xfe end\nsecond\n")
    assert files.text_head(spark, path).first().linha == "café \ufffd\ufffd end"
    assert files.whole_text(spark, path).first().texto == "café \ufffd\ufffd end\nsecond\n"


def test_files_to_star_schema(spark, lake, folder):
    """The derived survey, landed as files and loaded again, gives the same answers."""
    raw = lake.bronze().select(*SPEC.raw_columns)
    landed = os.path.join(folder, "landed")
    files.write_delimited(raw.repartition(3), landed)
    tag = f"t{uuid.uuid4().hex[:8]}_"
    layers = Layers(spark, prefix=tag, location=os.path.join(folder, "tables"))
    own = file_lake(spark, landed, layers)
    own.gold()

    assert own.silver().columns == ["id_respondente", *SPEC.item_ids, "country", "source", "_data_ingestao"]
    ids = [r[0] for r in own.silver().select("id_respondente").orderBy("id_respondente").collect()]
    assert ids == list(range(1, lake.silver().count() + 1))
    for question in (
        lambda x: analysis.profile_distribution(x.scores(), x.profiles()),
        lambda x: analysis.item_endorsement(x.silver(), x.items(), SPEC),
        lambda x: analysis.trait_correlation(x.scores(), SPEC),
    ):
        assert question(own).collect() == question(lake).collect()

    names = {r.tableName for r in layers.listing("gold").collect()}
    assert {"dim_item", "dim_respondente", "dim_perfil", "fato_resposta_item", "fato_escore_respondente"} <= names
    described = {r.col_name: r for r in layers.describe("gold", "dim_item").collect()}
    assert described["invertido"].comment == "agreement lowers the trait"
    assert described["Comment"].data_type.startswith("What each question asks")


def test_ids_follow_file_and_line_order_for_any_split(spark, folder):
    row = "\t".join(str(1 + i % 5) for i in range(27))
    header = "\t".join(SPEC.raw_columns)
    for name in ("a.csv", "b.csv"):
        write(folder, name, [header, *[f"{row}\t{name[0]}{i:04d}\t1" for i in range(900)]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = []
    try:
        for size in ("128m", "7k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            tag = f"t{uuid.uuid4().hex[:8]}_"
            out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
            own = file_lake(spark, folder, Layers(spark, prefix=tag, location=f"{out}/tables"))
            seen.append([r.country for r in own.silver().orderBy("id_respondente").collect()])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert seen[0] == seen[1] == [f"{f}{i:04d}" for f in "ab" for i in range(900)]


def test_a_second_run_replaces_tables_and_schema(spark, folder):
    layers = Layers(spark, prefix=f"t{uuid.uuid4().hex[:8]}_", location=folder)
    layers.save(spark.range(3).toDF("a"), "gold", "t", "it's a note")
    again = layers.save(spark.range(2).selectExpr("id AS b", "'x' AS c"), "gold", "t")
    assert again.columns == ["b", "c"] and again.count() == 2
    layers.view(again, "numbers")
    assert spark.sql("SELECT count(*) FROM numbers").first()[0] == 2


def test_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    from likertlake import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077", "spark.app.id": "app"}.get(key, default)

    class Remote:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(Remote())


def test_shared_folder_of_the_session_is_used(spark, folder):
    from likertlake import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": folder + "/"}.get(key, default)

    class Remote:
        conf = Conf()

    assert session.shared_root(Remote()) == f"{folder}/likertlake"
