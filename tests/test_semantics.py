"""Hand-written edge tables for the rules that are easy to get wrong."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from likertlake.functions import columns as C
from likertlake.instrument import SHORT_FORM_27 as SPEC
from likertlake.operators import analysis, cleaning, quality, star
from likertlake.operators import statistics as S

ITEMS = SPEC.item_ids
PLAIN = [1 + (i % 5) for i in range(27)]


def wide(spark, rows, kind="int"):
    schema = "src_row bigint, " + ", ".join(f"{c} {kind}" for c in ITEMS)
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


def edge_items(spark):
    one_null = [None, *PLAIN[1:]]
    one_zero = [0, *PLAIN[1:]]
    one_wild = [7, *PLAIN[1:]]
    rows = [one_null, one_zero, [0] * 27, [None] * 27, [5] * 27, one_wild, PLAIN, PLAIN]
    return wide(spark, rows)


def column(df, name=None):
    return [r[0] if name is None else r[name] for r in df.collect()]


def test_text_to_int_never_fails(spark):
    df = spark.createDataFrame([("3",), (" 3 ",), ("",), ("x",), (None,), ("3.7",)], "v string")
    assert column(df.select(C.to_int("v"))) == [3, 3, None, None, None, None]


def test_blank_count_is_null_with_a_null_item(spark):
    got = column(edge_items(spark).orderBy("src_row").select(C.blank_count(ITEMS)))
    assert got == [None, 1, 27, None, 0, 0, 0, 0]


def test_null_counts_as_a_distinct_value(spark):
    df = edge_items(spark).orderBy("src_row")
    assert column(df.select(C.distinct_count(ITEMS))) == [6, 6, 1, 1, 1, 6, 5, 5]
    uniform = column(df.select(C.is_uniform(ITEMS)))
    assert [bool(u) for u in uniform] == [False, False, True, True, True, False, False, False]


def test_clean_keeps_wild_codes_unless_asked(spark):
    df = edge_items(spark)
    assert sorted(column(cleaning.clean(df, SPEC), "src_row")) == [5, 6, 7]
    assert sorted(column(cleaning.clean(df, SPEC, drop_out_of_domain=True), "src_row")) == [6, 7]


def test_funnel_adds_up(spark):
    r = cleaning.exclusion_funnel(edge_items(spark), SPEC).first()
    assert (r.total_inicial, r.com_item_nulo, r.com_item_zero) == (8, 2, 2)
    assert (r.removidos_branco, r.restantes, r.removidos_uniforme, r.registros_validos) == (4, 4, 1, 3)


def test_domain_check_admits_zero_and_ignores_null(spark):
    rows = quality.domain_violations(edge_items(spark), ITEMS, 0, 5)
    assert column(rows, "src_row") == [5]
    assert quality.domain_violation_count(edge_items(spark), ITEMS, 0, 5).first()[0] == 1


def test_domain_profile_keeps_all_null_columns(spark):
    df = wide(spark, [[None, *PLAIN[1:]], [None, *PLAIN[1:]]])
    rows = {r.campo: r for r in quality.domain_profile(df, ITEMS).collect()}
    assert len(rows) == 27 and rows["M1"].minimo is None and rows["M1"].media_validos is None


def test_duplicates_tell_null_zero_and_wild_apart(spark):
    null, zero, wild = ([v, *PLAIN[1:]] for v in (None, 0, 7))
    far = [2_000_000_000, *PLAIN[1:]]
    df = wide(spark, [null, null, zero, wild, wild, wild, far, PLAIN])
    r = quality.duplicate_summary(df, SPEC).first()
    assert (r.total, r.distintas, r.repetidas) == (8, 5, 3)
    top = [(r["count"], r.M1, r.P9) for r in quality.duplicate_groups(df, SPEC).collect()]
    assert top == [(3, 7, PLAIN[26]), (2, None, PLAIN[26])]


def test_duplicate_summary_of_nothing(spark):
    r = quality.duplicate_summary(wide(spark, []), SPEC).first()
    assert (r.total, r.distintas, r.repetidas) == (0, 0, 0)


def test_provisional_scores_ignore_blanks_and_do_not_reverse(spark):
    row = [0, None, 5, *[1] * 6, 1, 5, *[1] * 7, *[0] * 9]
    r = quality.provisional_scores(wide(spark, [row]), SPEC).first()
    assert r.maquiavelismo == round(11 / 7, 9)
    assert r.narcisismo == round(13 / 9, 9)
    assert r.psicopatia is None


def test_straight_lines_by_value(spark):
    rows = {r.valor_repetido: r["count"] for r in quality.straight_line_histogram(edge_items(spark), ITEMS).collect()}
    assert rows == {0: 1, None: 1, 5: 1}


def test_country_frequency_is_untrimmed_on_request(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), (" US ",), ("US",)], "country string")
    assert quality.frequency(df, "country").count() == 5
    trimmed = {r.country: r["count"] for r in quality.frequency(df, "country", trim=True).collect()}
    assert trimmed == {None: 1, "": 2, "US": 2}


def test_elevated_is_strictly_above_the_cut(spark):
    scores = spark.createDataFrame(
        [(i, v, v, v) for i, v in enumerate([1.0, 3.0, 3.0, 3.0, 3.0, 3.0, 3.0, 4.0])],
        "id_respondente bigint, " + ", ".join(f"{c} double" for c in SPEC.score_columns),
    )
    cuts = star.cutoffs(scores, SPEC)
    assert {r.corte for r in cuts.collect()} == {3.0}
    flagged = star.score_profiles(scores, cuts, SPEC)
    assert {(r.id_respondente, r.id_perfil) for r in flagged.collect() if r.id_perfil} == {(7, 7)}


def test_outliers_on_each_side(spark):
    values = [1.0] + [3.0] * 4 + [3.5] * 4 + [9.0, None]
    df = spark.createDataFrame([("a", v) for v in values] + [(None, 1.0)], "g string, x double")
    counts = S.grouped_value_counts(df, "g", "x")
    rows = {r.g: r for r in S.iqr_outliers(counts, "g").collect()}
    assert (rows["a"].n_low, rows["a"].n_high, rows["a"].n_total) == (1, 1, 2)
    assert (rows["a"].q1, rows["a"].q3) == (3.0, 3.5)
    assert rows[None].n_total == 0


def test_quantiles_against_sorting(spark):
    """Negative, tiny, huge and heavily tied values; a third of a group is one value."""
    import random

    rng = random.Random(7)
    pools = [
        [rng.choice([1.0, 2.5, 2.5, 3.0]) for _ in range(301)],
        [round(rng.uniform(-1e4, 1e4), 2) for _ in range(400)] + [17.0] * 200,
        [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-9, 300) for _ in range(500)],
        [float(rng.randrange(2_000_000_000)) for _ in range(500)] + [3.0] * 251,
        [0.0],
    ]
    data = [(g, v) for g, pool in enumerate(pools) for v in pool]
    counts = S.grouped_value_counts(spark.createDataFrame(data, "g int, x double").repartition(5), "g", "x")
    probs = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p100": 1.0}
    got = {r.g: r for r in S.quantiles(counts, probs, "g").collect()}
    full = {r.g: r for r in S.summary(counts, "g").collect()}
    for g, pool in enumerate(pools):
        order = sorted(pool)
        for name, p in probs.items():
            assert got[g][name] == order[max(1, math.ceil(p * len(order))) - 1], (g, name)
        assert full[g].mediana == statistics.median(pool) and full[g].n == len(pool)
        assert (full[g].minimo, full[g].maximo) == (order[0], order[-1])


def test_summary_moments(spark):
    values = [1.0, 1.5, 1.5, 4.25, 5.0]
    counts = S.grouped_value_counts(spark.createDataFrame([("a", v) for v in values], "g string, x double"), "g", "x")
    r = S.summary(counts, "g").first()
    assert r.media == pytest.approx(statistics.mean(values))
    assert r.desvio_padrao == pytest.approx(statistics.stdev(values))


@pytest.mark.parametrize("start", [0.0, -1e9, 1e8, 1e9, 1e12])
def test_deviation_of_large_values(spark, start):
    rows = spark.range(4).selectExpr("'a' AS g", f"{start!r}D + id AS x")
    want = rows.agg(F.stddev_samp("x")).first()[0]
    assert S.summary(S.grouped_value_counts(rows, "g", "x"), "g").first().desvio_padrao == pytest.approx(want, rel=1e-9)


def test_an_oversized_band_is_split(spark):
    """100,000 values within one hundredth of a percent, and a few far away."""
    near = spark.range(100_000).selectExpr("'a' AS g", "1000000D + id / 1000D AS x")
    far = spark.createDataFrame([("a", -5e6), ("a", 9e6), ("a", 9e6), (None, 1.0)], "g string, x double")
    counts = S.grouped_value_counts(near.union(far), "g", "x")
    assert counts.select(S._band("valor")).distinct().count() <= 6
    want = sorted([1e6 + i / 1000 for i in range(100_000)] + [-5e6, 9e6, 9e6])
    r = S.quantiles(counts, {"q": 0.25, "h": 0.5}, "g").where("g = 'a'").first()
    assert (r.q, r.h) == (want[math.ceil(0.25 * len(want)) - 1], want[math.ceil(0.5 * len(want)) - 1])
    out = {r.g: (r.n_low, r.n_high, r.n_total) for r in S.iqr_outliers(counts, "g").collect()}
    assert out == {"a": (1, 2, 3), None: (0, 0, 0)}


def test_profiles_without_a_label_stay(spark):
    scores = spark.createDataFrame([(0,), (0,), (5,), (None,)], "id_perfil int")
    profiles = spark.createDataFrame([(0, "none", 0)], "id_perfil int, descricao_perfil string, qtd_tracos_elevados int")
    rows = analysis.profile_distribution(scores, profiles).collect()
    assert sorted((r.qtd_respondentes, r.percentual) for r in rows) == [(1, 25.0), (1, 25.0), (2, 50.0)]


def test_labels_are_made_and_checked():
    from likertlake.instrument import Instrument, Item, Trait

    traits = tuple(Trait(x, x.lower(), (Item(f"{x}1", "?"),)) for x in "AB")
    assert Instrument(traits).profile_labels == ("–", "B", "A", "A + B")
    with pytest.raises(ValueError):
        Instrument(traits, profile_labels=("none", "all"))


def test_summary_of_a_single_value_has_no_deviation(spark):
    counts = spark.createDataFrame([("a", 2.0, 1)], "traco string, valor double, n bigint")
    r = S.summary(counts).first()
    assert (r.n, r.media, r.desvio_padrao, r.q25, r.mediana) == (1, 2.0, None, 2.0, 2.0)


@pytest.mark.parametrize("total,n,digits", [(-1, 8, 2), (-5, 16, 3), (-28, 9, 4), (28, 9, 4), (1, 8, 2), (3, 8, 2), (5, 16, 3), (45, 9, 4), (0, 9, 4)])
def test_ratio_rounds_half_up(spark, total, n, digits):
    from decimal import ROUND_HALF_UP, Decimal

    want = float((Decimal(total) / Decimal(n)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))
    assert spark.range(1).select(C.ratio(F.lit(total), n, digits)).first()[0] == want


def test_correlation_skips_pairs_with_null_and_constant_columns(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 1.0), (2.0, None, 1.0), (3.0, 5.0, 1.0), (4.0, 4.0, 1.0)], "a double, b double, c double"
    )
    rows = {r.p: r.correlacao for r in S.correlations(df, {"ab": ("a", "b"), "ac": ("a", "c")}, name="p").collect()}
    # over the pairs (1,2), (3,5), (4,4)
    assert rows["ab"] == 0.7857
    assert rows["ac"] is None


def test_origin_label_falls_back(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "source int")
    labels = column(df.select(C.code_label("source", SPEC.origin_labels, SPEC.origin_default)))
    assert labels == [*SPEC.origin_labels.values(), "Não identificada", "Não identificada"]


def test_bands_keep_missing_scores_in_the_total(spark):
    scores = spark.createDataFrame(
        [(1.0, 2.4, 5.0), (1.49, 2.5, None)], ", ".join(f"{c} double" for c in SPEC.score_columns)
    )
    rows = {(r.traco, r.faixa): (r.qtd, r.percentual) for r in analysis.score_bands(scores, SPEC).collect()}
    assert rows[("Maquiavelismo", 1.0)] == (2, 100.0)
    assert rows[("Narcisismo", 2.0)] == rows[("Narcisismo", 2.5)] == (1, 50.0)
    assert rows[("Psicopatia", None)] == (1, 50.0)


def test_endorsement_of_reversed_items(spark):
    df = wide(spark, [[5] * 27, [1] * 27, [2] * 27]).withColumnRenamed("src_row", "id_respondente")
    rows = {r.id_item: r for r in analysis.item_endorsement(df, star.dim_item(spark, SPEC), SPEC).collect()}
    assert (rows["M1"].media_corrigida, rows["M1"].pct_concordancia) == (2.67, 33.33)
    assert (rows["N2"].media_corrigida, rows["N2"].pct_concordancia) == (3.33, 66.67)


def test_labels(spark):
    df = spark.createDataFrame([("N2", True, 7), ("M1", False, 8)], "i string, r boolean, n bigint")
    assert column(df.select(C.item_label("i", "r"))) == ["N2*", "M1"]
    assert column(df.select(C.group_label("i", "n"))) == ["N2 (n=7)", "M1 (n=8)"]


# -- variability, SQL functions, observed counts ------------------------------


def test_row_variability(spark):
    from likertlake.operators import quality

    cols = ["a", "b", "c", "d"]
    rows = [(1, 3, 3, 3, 3), (2, 1, 5, 1, 5), (3, 0, 2, 2, None), (4, 2, 0, 2, 2), (5, None, None, 0, 0), (6, 4, 0, 0, 0), (7, 5, 5, 4, 5)]
    df = spark.createDataFrame(rows, "k int, a int, b int, c int, d int")
    got = {r.k: (r.validas, None if r.desvio_linha is None else round(r.desvio_linha, 6), r.maior_sequencia) for r in quality.answer_variability(df, cols, keep=["k"]).collect()}
    assert got == {1: (4, 0.0, 4), 2: (4, 2.309401, 1), 3: (2, 0.0, 2), 4: (3, 0.0, 2), 5: (0, None, 0), 6: (1, None, 1), 7: (4, 0.5, 2)}
    found = {r.k: r.motivo for r in quality.low_variability(df, cols, keep=["k"], below=0.5, run=3).collect()}
    assert found == {1: "desvio e sequencia", 3: "desvio", 4: "desvio"}
    assert {r.k for r in quality.low_variability(df, cols, keep=["k"], below=0.0, run=2).collect()} == {1, 3, 4, 7}


def test_sql_functions_are_written_into_the_plan(spark):
    from likertlake.functions import sql
    from likertlake.instrument import SHORT_FORM_27 as spec

    assert "resposta_corrigida" in sql.register(spark, spec) and sql.register(spark, spec)
    one = lambda text: spark.sql(f"SELECT {text} AS x").first().x
    assert [one(f"resposta_corrigida('{i}', {v})") for i, v in (("N2", 1), ("N2", 5), ("M1", 1), ("N2", "CAST(NULL AS INT)"))] == [5, 1, 1, None]
    assert one("faixa_escore(3.74D, 2)") == 3.5 and one("codigo_perfil(true, false, true)") == 5 and one("codigo_perfil(true, NULL, true)") is None
    assert one("rotulo_perfil(5)") == "Maquiavelismo + psicopatia" and one("rotulo_perfil(9)") is None
    assert one("rotulo_origem(2)") == "Busca no Google" and one("rotulo_origem(NULL)") == "Não identificada"
    assert one("media_validos(array(0, 4, NULL, 5))") == 4.5 and one("media_validos(array(0))") is None
    assert one("rotulo_item('P7')") == "P7*" and one("item_invertido('P1')") is False
    spark.range(3).selectExpr("'N2' AS i", "CAST(id AS INT) AS v").createOrReplaceTempView("respostas_de_teste")
    plan = spark.sql("SELECT resposta_corrigida(i, v) AS x FROM respostas_de_teste WHERE resposta_corrigida(i, v) > 4")._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "resposta_corrigida(" not in plan


def test_the_write_of_silver_counts_the_funnel(spark, lake):
    from likertlake.operators import cleaning
    from likertlake.plans.lake import FUNNEL

    got = lake.funnel()
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()
    row = got.first().asDict()
    assert row.pop("removidos_dominio") == 0
    assert row == cleaning.exclusion_funnel(lake.typed(), lake.spec).first().asDict()
    name = lake.layers.name("silver", "respostas")
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES ('{FUNNEL}')")
    assert lake.funnel().first().asDict() == row
