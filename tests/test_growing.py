"""Refreshes that read new rows only, against a lake built from everything at once."""

import os
import shutil

import pytest
from pyspark.sql import functions as F
from test_growing_lake import drop, people

from likertlake.instrument import SHORT_FORM_27 as SPEC
from likertlake.operators import analysis, star
from likertlake.operators import statistics as S
from likertlake.plans.growing import FUNNEL, SILVER, GrowingLake
from likertlake.plans.lake import file_lake
from likertlake.sources import files
from likertlake.sources.tables import Layers
from likertlake.streaming.landing import Landing

HEADER = [*SPEC.raw_columns]


@pytest.fixture
def grown(spark, tmp_path):
    """Three refreshes and the lake of all files together."""
    def made():
        return GrowingLake(Landing(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), HEADER), str(tmp_path / "lake"))

    for seed in range(3):
        drop(str(tmp_path / "in"), f"{9 - seed}.tsv", people(30 + 10 * seed, seed))
        assert made().refresh() == seed + 1
    assert made().refresh() is None
    layers = Layers(spark, f"w{abs(hash(str(tmp_path))) % 10**9}_", str(tmp_path / "tables"), buckets=2)
    yield made, file_lake(spark, str(tmp_path / "in"), layers)
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA {layers.schema(layer)} CASCADE")


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_loads_add_up_to_the_whole(grown, spark):
    made, whole = grown
    lake = made()
    assert rows(lake.silver(), *SPEC.raw_columns) == rows(whole.silver(), *SPEC.raw_columns)
    assert rows(lake.cuts(), "traco", "corte") == rows(whole.cuts(), "traco", "corte")
    place = lambda x: rows(x.scores().join(x.respondents(), star.ID), "pais_acesso", *SPEC.score_columns, *SPEC.flag_columns, "id_perfil")
    assert place(lake) == place(whole)
    assert rows(lake.funnel(), "*") == rows(whole.funnel(), "*")
    assert lake.responses().count() == whole.responses().count()
    want = {r.traco: r for r in S.summary(star.score_counts(whole.scores(), SPEC)).collect()}
    for r in lake.descriptives().collect():
        w = want[r.traco]
        assert (r.n, r.minimo, r.maximo) == (w.n, w.minimo, w.maximo) and r.media == pytest.approx(w.media) and r.desvio_padrao == pytest.approx(w.desvio_padrao)
    pairs = {r.par_de_tracos: r.correlacao for r in analysis.trait_correlation(whole.scores(), SPEC).collect()}
    assert sorted(round(r.correlacao, 4) for r in lake.correlations().collect()) == sorted(pairs.values())
    assert {r.traco: r.q for r in lake.sketched_cuts({"q": 0.75}).collect()} == {r.traco: r.corte for r in lake.cuts().collect()}


def test_ids_of_earlier_loads_stay(grown):
    made, _ = grown
    got = made().silver().select("carga", star.ID).collect()
    ids = [sorted(r[1] for r in got if r.carga == n) for n in (1, 2, 3)]
    assert [x for own in ids for x in own] == list(range(1, len(got) + 1))


def test_a_refresh_reads_the_new_files_only(grown, tmp_path, spark):
    """Earlier landed files could be gone: nothing of theirs is read again."""
    made, _ = grown
    before = rows(made().silver(), star.ID, "country")
    old = made().landing.parts()
    kept = {p: p.replace("file:", "").replace("//", "/") for p in old}
    for p in kept.values():
        with open(p, "wb"):
            pass  # what is left cannot be read
    drop(str(tmp_path / "in"), "late.tsv", people(20, 77))
    assert made().refresh() == 4
    assert [r for r in rows(made().silver(), star.ID, "country") if r in before] == before


def test_a_load_that_was_killed_is_made_again(grown, tmp_path):
    made, _ = grown
    before, last = rows(made().silver(), star.ID, "country"), tmp_path / "lake"
    os.remove(last / FUNNEL / "carga=3" / "_SUCCESS")
    shutil.copytree(last / SILVER / "carga=3", last / SILVER / "carga=9")  # of no load that counts
    os.remove(last / SILVER / "carga=9" / "_SUCCESS")
    assert made().loads() == [1, 2] and len(made().silver().collect()) < len(before)
    drop(str(tmp_path / "in"), "late.tsv", people(20, 77))
    assert made().refresh() == 3 and rows(made().silver(), star.ID, "country") == before
    assert made().refresh() == 4 and made().refresh() is None
    assert len(made().silver().collect()) == len(before) + len([r for r in people(20, 77) if any(r[:27])])


def test_a_key_of_the_answers_is_taken_once(spark, tmp_path):
    header = [*SPEC.raw_columns, "k"]
    lake = lambda: GrowingLake(Landing(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), header), str(tmp_path / "lake"), keys=["k"])

    def put(name, keys):
        os.makedirs(tmp_path / "in", exist_ok=True)
        lines = ["\t".join(header), *["\t".join([*["1", "2", "3"] * 9, "x", "1", k]) for k in keys]]
        (tmp_path / "in" / f".{name}").write_text("\n".join(lines) + "\n")
        os.rename(tmp_path / "in" / f".{name}", tmp_path / "in" / name)

    put("1.tsv", ["b", "d"])
    lake().refresh()
    put("2.tsv", ["a", "b", "c"])
    lake().refresh()
    assert rows(lake().silver(), "k", star.ID) == [("a", 3), ("b", 1), ("c", 4), ("d", 2)]
    with pytest.raises(LookupError):
        GrowingLake(Landing(spark, "x", "y", HEADER), str(tmp_path / "empty")).silver()
