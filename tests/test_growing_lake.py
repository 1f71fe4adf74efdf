"""A lake that files are added to, and one whose build is taken up again."""

import os
import random

import pytest
from pyspark.sql import functions as F

from likertlake.instrument import SHORT_FORM_27 as SPEC
from likertlake.operators.ids import IdMap
from likertlake.plans import lake as L
from likertlake.plans.lake import file_lake, landing_lake, open_lake
from likertlake.sources import files
from likertlake.sources.tables import Layers
from likertlake.streaming.landing import Landing


@pytest.fixture
def layers(spark, tmp_path):
    made = Layers(spark, f"g{abs(hash(str(tmp_path))) % 10**9}_", str(tmp_path / "tables"), buckets=2)
    yield made
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP SCHEMA {made.schema(layer)} CASCADE")


def drop(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w", encoding="utf-8") as f:
        f.write("\n".join(["\t".join(SPEC.raw_columns), *["\t".join(map(str, r)) for r in rows]]) + "\n")
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def people(n, seed):
    """Answers whose place names the respondent; some are not valid."""
    rng = random.Random(seed)
    return [[*([0] * 27 if i % 7 == 3 else [rng.randint(1, 5) for _ in range(27)]), f"{seed}-{i}", rng.choice([1, 2, 3])] for i in range(n)]


def by_place(table, *cols):
    return {r.pais_acesso if "pais_acesso" in table.columns else r.country: tuple(r[c] for c in cols) for r in table.collect()}


def test_respondents_keep_their_ids_when_files_are_added(spark, layers, tmp_path):
    source = str(tmp_path / "in")
    landing = lambda: Landing(spark, source, str(tmp_path / "bronze"), SPEC.raw_columns)
    known = IdMap(spark, str(tmp_path / "ids"), files.FILE_ORDER)
    seen, all_rows = {}, []
    for seed, name in enumerate(("m.tsv", "a.tsv", "z.tsv")):
        rows = people(40 + seed, seed)
        all_rows += rows
        drop(source, name, rows)
        landing().run()
        lake = landing_lake(landing(), layers, known)
        lake.gold()
        valid = [r for r in all_rows if any(r[:27])]
        now = by_place(lake.respondents(), "id_respondente")
        assert {k: v for k, v in now.items() if k in seen} == seen
        assert sorted(v for (v,) in now.values()) == list(range(1, len(valid) + 1)) and set(now) == {r[27] for r in valid}
        seen = now
        answers = {r[27]: tuple(r[:27]) for r in valid}
        assert by_place(lake.silver(), *SPEC.item_ids) == answers
        assert lake.scores().count() == len(valid) and lake.responses().count() == 27 * len(valid)
        assert lake.funnel().first().total_inicial == len(all_rows)
    assert [v.rows for v in layers.versions("gold", L.SCORES).all()][-1] == len(valid)
    before = layers.versions("gold", L.RESPONDENTS).all()[-2].number
    got = {r.situacao: r.registros for r in layers.changes("gold", L.RESPONDENTS, before, before + 1, "id_respondente").collect()}
    assert got == {"igual": len([r for r in all_rows[:81] if any(r[:27])]), "incluido": len([r for r in all_rows[81:] if any(r[:27])])}


def test_a_header_or_key_that_does_not_fit(spark, layers, tmp_path):
    with pytest.raises(ValueError, match="lacks"):
        landing_lake(Landing(spark, "x", "y", ["M1"]), layers, IdMap(spark, "z", files.FILE_ORDER))
    with pytest.raises(ValueError, match="keyed"):
        landing_lake(Landing(spark, "x", "y", SPEC.raw_columns), layers, IdMap(spark, "z", ["k"]))


def test_a_build_goes_on_after_its_last_whole_table(spark, layers, tmp_path):
    """The catalogue is lost and the scores were never written: nothing before them is built again."""
    drop(str(tmp_path / "in"), "1.tsv", people(60, 5))
    first = file_lake(spark, str(tmp_path / "in"), layers)
    first.respondents(), first.responses(), first.cuts()
    kept = {t: layers.versions(a, t).all()[-1].path for a, t in (("bronze", L.BRONZE), ("silver", L.SILVER), ("gold", L.CUTS))}
    ids = by_place(first.respondents(), "id_respondente")
    for layer in ("bronze", "silver", "gold"):
        for row in layers.listing(layer).collect():
            spark.sql(f"DROP TABLE {layers.schema(layer)}.{row.tableName}")
    again = file_lake(spark, str(tmp_path / "in"), layers, resume=True)
    again.gold()
    assert {t: layers.versions(a, t).all()[-1].path for a, t in (("bronze", L.BRONZE), ("silver", L.SILVER), ("gold", L.CUTS))} == kept
    assert by_place(again.respondents(), "id_respondente") == ids and again.scores().count() == len(ids)
    assert again.scores().join(again.cuts().where("traco = 'Narcisismo'"), F.col("escore_narcisismo") > F.col("corte")).count() == again.scores().where("elevado_narcisismo").count()
    for layer in ("bronze", "silver", "gold"):
        for row in layers.listing(layer).collect():
            spark.sql(f"DROP TABLE {layers.schema(layer)}.{row.tableName}")
    assert open_lake(spark, layers).scores().count() == len(ids)
