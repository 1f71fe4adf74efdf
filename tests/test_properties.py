"""Properties that must hold for any answers."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from likertlake.functions import columns as C
from likertlake.instrument import SHORT_FORM_27 as SPEC
from likertlake.operators import ids, quality, star
from likertlake.session import Workspace

ITEMS = SPEC.item_ids
RELAXED = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
answer = st.one_of(st.none(), st.integers(-2, 8), st.just(2_000_000_000))
rows_of = st.lists(st.lists(answer, min_size=27, max_size=27), min_size=1, max_size=12)


def frame(spark, rows):
    schema = "id_respondente bigint, " + ", ".join(f"{c} int" for c in ITEMS)
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


@RELAXED
@given(rows=rows_of)
def test_packing_is_reversible_and_injective(spark, rows):
    packed = C.PackedVector(ITEMS, 0, 5)
    df = frame(spark, rows)
    back = packed.pack(df, ["id_respondente"]).select("id_respondente", *packed.unpack())
    assert [tuple(r)[1:] for r in back.orderBy("id_respondente").collect()] == [tuple(r) for r in rows]
    keys = packed.pack(df).collect()
    assert len(set(map(tuple, keys))) == len(set(map(tuple, rows)))


@RELAXED
@given(rows=rows_of)
def test_duplicate_summary_counts_exactly(spark, rows):
    r = quality.duplicate_summary(frame(spark, rows), SPEC).first()
    distinct = len(set(map(tuple, rows)))
    assert (r.total, r.distintas, r.repetidas) == (len(rows), distinct, len(rows) - distinct)


@RELAXED
@given(rows=rows_of)
def test_uniform_is_one_distinct_value(spark, rows):
    df = frame(spark, rows).select(C.distinct_count(ITEMS).alias("d"), C.is_uniform(ITEMS).alias("u"))
    assert all((r.d == 1) == bool(r.u) for r in df.collect())


@RELAXED
@given(rows=st.lists(st.lists(st.integers(1, 5), min_size=27, max_size=27), min_size=1, max_size=8))
def test_long_form_and_back(spark, rows):
    df = frame(spark, rows)
    facts = star.response_facts(df, SPEC)
    joined = star.reverse_by_dimension(star.long_answers(df, ITEMS), star.dim_item(spark, SPEC), 1, 5)
    assert sorted(map(tuple, facts.collect())) == sorted(map(tuple, joined.select(*facts.columns).collect()))
    wide = facts.groupBy("id_respondente").pivot("id_item", ITEMS).agg(F.first("resposta_original"))
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, df.collect()))
    by_row = star.trait_scores(df, SPEC)
    by_fact = star.trait_scores_from_facts(facts, SPEC)
    assert sorted(map(tuple, by_row.collect())) == sorted(map(tuple, by_fact.collect()))


def test_reverse_is_an_involution(spark):
    df = spark.range(1, 6).select(F.col("id").alias("x"))
    twice = df.select("x", C.reverse(C.reverse("x", 1, 5), 1, 5).alias("y"))
    assert all(r.x == r.y for r in twice.collect())


def test_profile_code_is_a_bijection_with_the_flags(spark):
    flags = spark.range(8).selectExpr("id", "(id & 4) > 0 AS a", "(id & 2) > 0 AS b", "(id & 1) > 0 AS c")
    assert all(r.id == r.code for r in flags.withColumn("code", C.bit_code(["a", "b", "c"])).collect())
    dims = {r.id_perfil: r.qtd_tracos_elevados for r in star.dim_profile(spark, SPEC).collect()}
    assert dims == {c: bin(c).count("1") for c in range(8)}


def test_ids_do_not_depend_on_partitions_or_key_spread(spark):
    # a third of the keys close together, the rest scattered over a huge range
    keys = [*range(400), *[i * 10**12 + 17 for i in range(1, 801)]]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    want = {k: i + 1 for i, k in enumerate(sorted(keys))}
    for source, parts in ((df.repartition(7), 5), (df.repartition(3, "k"), 16), (df.coalesce(1), 1)):
        got = ids.dense_id(source, ["k"], Workspace(spark, "ids"), parts, "id").collect()
        assert {r.k: r.id for r in got} == want


def test_ids_spread_a_shared_key(spark):
    """A third of the rows carry one key: ids stay dense and in key order."""
    df = spark.range(900).selectExpr("IF(id % 3 = 0, 50, id) AS k", "id AS row").repartition(6)
    work = Workspace(spark, "ids")
    got = ids.dense_id(df, ["k"], work, 8, "id", unique=False)
    rows = got.orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, 901))
    assert [r.k for r in rows] == sorted(r.k for r in rows)
    assert len({r.row for r in rows}) == 900 and set(got.columns) == {"id", "k", "row"}


def test_percentages_sum_to_hundred(spark, lake):
    from likertlake.operators import analysis

    rows = analysis.profile_distribution(lake.scores(), lake.profiles()).collect()
    assert abs(sum(r.percentual for r in rows) - 100) < 0.05
