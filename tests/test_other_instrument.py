"""A questionnaire of another shape: two traits, scale 0..10, missing code -1."""

import os
import tempfile
import uuid

import pytest

from likertlake.instrument import Instrument, Item, Trait
from likertlake.operators import analysis, quality
from likertlake.plans.lake import SILVER, file_lake, open_lake
from likertlake.sources.tables import Layers

SPEC = Instrument(
    traits=(
        Trait("Alpha", "alpha", (Item("a1", "A one"), Item("a2", "A two", reversed=True))),
        Trait("Beta", "beta", (Item("b1", "B one"), Item("b2", "B two"), Item("b3", "B three"))),
    ),
    lo=0,
    hi=10,
    missing=-1,
    origin_labels={1: "web"},
    origin_default="other",
    profile_labels=("none", "beta", "alpha", "both"),
)

ROWS = [
    "10\t0\t1\t2\t4\tUS\t1",  # alpha 10, beta 7/3
    "0\t10\t9\t9\t9\tUS\t2",  # alpha 0, beta 9
    "5\t4\t0\t0\t0\t FR \t1",  # alpha 5.5, beta 0
    "5\t5\t5\t5\t5\tFR\t1",  # straight line: leaves
    "-1\t3\t1\t1\t1\tFR\t1",  # blank item: leaves
    "7\t3\t2\t2\t3\t\t9",  # alpha 7, beta 7/3
]


@pytest.fixture(scope="module")
def own(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    raw = os.path.join(folder, "raw")
    os.mkdir(raw)
    with open(os.path.join(raw, "data.csv"), "w", encoding="utf-8") as f:
        f.write("\n".join(["\t".join(SPEC.raw_columns), *ROWS]) + "\n")
    layers = Layers(spark, prefix=f"t{uuid.uuid4().hex[:8]}_", location=f"{folder}/tables")
    return file_lake(spark, raw, layers, SPEC, names={SILVER: "valid_answers"})


def test_scores_and_profiles(own):
    rows = {r.id_respondente: r for r in own.scores().collect()}
    assert [rows[i].escore_alpha for i in (1, 2, 3, 4)] == [10.0, 0.0, 5.5, 7.0]
    assert [rows[i].escore_beta for i in (1, 2, 3, 4)] == [2.3333, 9.0, 0.0, 2.3333]
    cuts = {r.traco: r.corte for r in own.cuts().collect()}
    assert cuts == {"Alpha": 7.0, "Beta": 2.3333}
    assert [rows[i].id_perfil for i in (1, 2, 3, 4)] == [2, 1, 0, 0]


def test_questions(own):
    shares = {r.descricao_perfil: r.percentual for r in analysis.profile_distribution(own.scores(), own.profiles()).collect()}
    assert shares == {"none": 50.0, "alpha": 25.0, "beta": 25.0}
    names = {r.descricao_perfil: r.qtd_respondentes for r in analysis.profile_dictionary(own.profiles(), own.scores()).collect()}
    assert names["both"] == 0 and len(names) == 4
    items = {r.id_item: r for r in analysis.item_endorsement(own.silver(), own.items(), SPEC, agree_from=7).collect()}
    assert (items["a2"].media_corrigida, items["a2"].pct_concordancia) == (5.75, 50.0)
    bins = analysis.lattice_histogram(own.scores(), own.cuts(), SPEC).collect()
    assert sum(r.qtd for r in bins if r.traco == "Alpha") == 4
    assert sum(1 for r in bins if r.traco == "Beta") == 31
    groups = {r.origem_acesso: r.respondentes for r in analysis.group_means(own.scores(), own.respondents(), "origem_acesso", SPEC).collect()}
    assert groups == {"web": 2, "other": 2}
    matrix = {r.traco: r for r in analysis.trait_correlation_matrix(own.scores(), SPEC).collect()}
    assert matrix["Alpha"].Alpha == 1.0 and matrix["Alpha"].Beta == matrix["Beta"].Alpha < 0


def test_tables_can_be_named(own):
    own.silver()
    assert "valid_answers" in {r.tableName for r in own.layers.listing("silver").collect()}
    assert own.layers.read("silver", "valid_answers").count() == 4


def test_other_context_columns(spark):
    """No place and no route code, a column more in the file, lines of the wrong width kept."""
    spec = Instrument(traits=SPEC.traits, lo=0, hi=10, missing=-1, context=("age",), place=None, origin=None)
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    with open(os.path.join(folder, "data.csv"), "w", encoding="utf-8") as f:
        f.write("a1\ta2\textra\tb1\tb2\tb3\tage\n10\t0\tx\t1\t2\t4\t 31 \n5\t4\ty\t0\t0\t0\t\n1\t2\n")
    layers = Layers(spark, prefix=f"t{uuid.uuid4().hex[:8]}_", location=f"{folder}/tables")
    lake = file_lake(spark, os.path.join(folder, "data.csv"), layers, spec, corrupt_column="_bad")
    lake.gold()
    bronze = lake.bronze()
    assert [r.extra for r in bronze.where("_bad IS NULL").orderBy("extra").collect()] == ["x", "y"]
    assert [r._bad for r in bronze.where("_bad IS NOT NULL").collect()] == ["1\t2"]
    assert lake.respondents().columns == ["id_respondente", "age", "data_ingestao"]
    assert [r.age for r in lake.silver().orderBy("id_respondente").collect()] == ["31", None]
    assert quality.context_missing(bronze, spec).first().age_ausente == 2
    shares = {r.descricao_perfil: r.qtd_respondentes for r in analysis.profile_distribution(lake.scores(), lake.profiles()).collect()}
    assert sum(shares.values()) == 2


def test_an_existing_lake_is_opened(own, spark):
    own.gold()
    before = {t: own.layers.read("gold", t).inputFiles() for t in ("fato_escore_respondente", "dim_perfil")}
    again = open_lake(spark, own.layers, SPEC, names={SILVER: "valid_answers"})
    assert analysis.profile_distribution(again.scores(), again.profiles()).collect()
    assert {t: own.layers.read("gold", t).inputFiles() for t in before} == before
    with pytest.raises(LookupError):
        open_lake(spark, Layers(spark, prefix=f"t{uuid.uuid4().hex[:8]}_"), SPEC).bronze()


def test_quality(own):
    missing = {r.campo: (r.nulos, r.zeros) for r in quality.missing_profile(own.typed(), SPEC.item_ids, SPEC.missing).collect()}
    assert missing["a1"] == (0, 1) and missing["a2"] == (0, 0)
    assert quality.domain_violation_count(own.typed(), SPEC.item_ids, SPEC.missing, SPEC.hi).first()[0] == 0
    r = quality.duplicate_summary(own.typed(), SPEC).first()
    assert (r.total, r.repetidas) == (6, 0)
    scores = quality.provisional_scores(own.typed(), SPEC, [*own.order_by]).orderBy(*own.order_by).collect()
    assert scores[4].alpha == 3.0 and scores[0].alpha == 5.0
