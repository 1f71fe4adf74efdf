"""Part counts that follow the data, and a session that is left alone."""

from pyspark.sql import functions as F

from likertlake.instrument import SHORT_FORM_27 as SPEC
from likertlake.operators import quality, star
from likertlake.plans import lake as L
from likertlake.plans.lake import BUCKET_ROWS, LARGE_PART, Lake, bucket_count, derived_lake, open_lake, range_parts
from likertlake.plans.queries import all_queries
from likertlake.session import RUNTIME_CONF, Workspace, tuned
from likertlake.sources.files import INGESTED, ORIGIN
from likertlake.sources.tables import Layers


def test_small_data_uses_few_parts():
    assert range_parts(0, 8) == 1
    assert range_parts(15_000, 8) == 1
    assert range_parts(150_000, 8) == 8
    assert range_parts(150_000, 200) == 8


def test_session_parallelism_is_used_but_not_exceeded_without_need():
    assert range_parts(10**9, 200) == 200
    assert range_parts(10**9, 64) == 125


def test_no_range_is_larger_than_planned_at_any_size():
    for rows in (10**11, 10**13, 10**15):
        assert rows / range_parts(rows, 200) <= LARGE_PART


def settings(spark):
    return {r.key: r.value for r in spark.sql("SET").collect()}


def test_the_session_keeps_its_settings(spark, sf_dir):
    before = settings(spark)
    derived_lake(spark, sf_dir).gold()
    assert settings(spark) == before


def test_buckets_grow_with_the_respondents():
    assert bucket_count(0, 8) == bucket_count(8 * BUCKET_ROWS, 8) == 8
    for rows in (10**7, 10**8, 10**9):
        assert rows / bucket_count(rows, 8) <= BUCKET_ROWS


def test_tables_of_respondents_have_the_buckets_of_silver(spark, tmp_path, monkeypatch):
    """A task of the facts has the respondents of one bucket, and they still join without a shuffle."""
    monkeypatch.setattr("likertlake.plans.lake.BUCKET_ROWS", 100)
    rows = spark.range(500).select(
        F.col("id").alias("k"), *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(5)) + 1).cast("string").alias(c) for i, c in enumerate(SPEC.item_ids)],
        F.lit("N1").alias("country"), F.lit("1").alias("source"), F.current_timestamp().alias(INGESTED), F.lit("f").alias(ORIGIN),
    )
    layers = Layers(spark, f"z{abs(hash(str(tmp_path))) % 10**9}_", str(tmp_path), buckets=2)
    lake = Lake(spark, lambda: rows, ["k"], layers, Workspace(spark, "sizing"), SPEC)
    lake.gold()
    assert [layers.buckets_of(*t) for t in (("silver", L.SILVER), ("gold", L.RESPONSES), ("gold", L.SCORES), ("gold", L.RESPONDENTS))] == [5] * 4
    assert lake.responses().count() == 27 * lake.silver().count() == 27 * 500
    with tuned(spark):
        assert lake.silver().rdd.getNumPartitions() == 5
    plan = star.trait_scores_from_facts(lake.responses(), SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # A lake that only takes up the tables deals missing ones as silver is dealt.
    spark.sql(f"DROP TABLE {layers.name('gold', L.SCORES)}")
    layers.versions("gold", L.SCORES).remove(f"{tmp_path}/gold/{L.SCORES}")
    open_lake(spark, layers).scores()
    assert layers.buckets_of("gold", L.SCORES) == 5


def test_writes_have_settings_of_their_own(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    plain, before = spark.newSession(), settings(spark)
    own = settings(plain)
    assert plain.conf.get(key, None) is None
    with tuned(plain), tuned(plain):
        assert plain.conf.get(key) == RUNTIME_CONF[key]
    assert settings(plain) == own and settings(spark) == before
    plain.conf.set(key, "9000")
    with tuned(plain):
        assert plain.conf.get(key) == "9000"
    assert plain.conf.get(key) == "9000"


def test_tables_are_built_with_small_methods(spark, tmp_path):
    """Wide rows fuse into a method that the JVM never compiles, unless the session says otherwise."""
    key, seen, plain = "spark.sql.codegen.hugeMethodLimit", [], spark.newSession()
    lake = Lake(plain, lambda: seen.append(plain.conf.get(key, None)) or plain.range(3).toDF("k"), ["k"], Layers(plain, f"y{abs(hash(str(tmp_path))) % 10**9}_", str(tmp_path)), Workspace(plain, "sizing"), SPEC)
    assert lake.bronze().count() == 3 and seen == [RUNTIME_CONF[key]] and plain.conf.get(key, None) is None


def test_views_of_the_session_are_no_tables_of_a_layer(spark, tmp_path):
    layers = Layers(spark, f"x{abs(hash(str(tmp_path))) % 10**9}_", str(tmp_path))
    layers.view(spark.range(1), "visao_da_sessao")
    layers.save(spark.range(2), "gold", "t")
    assert [r.tableName for r in layers.listing("gold").collect()] == ["t"]


def orders(spark, path, n):
    """``n`` rows, each answering like another one, in one row group of one file."""
    spark.range(n).selectExpr(f"id % {n // 2} o_orderkey", f"id % {n // 2} o_custkey").coalesce(1).write.parquet(f"{path}/orders.parquet")
    return derived_lake(spark, str(path))


def test_a_row_group_is_dealt_to_many_parts(spark, tmp_path, monkeypatch):
    """No task of the first tables has more rows than planned, however few parts the files allow."""
    monkeypatch.setattr(L, "SMALL_PART", 100)
    monkeypatch.setattr(L, "BUCKET_ROWS", 100)
    lake = orders(spark, tmp_path, 2000)
    for rows in (lake.bronze(), lake.silver()):
        sizes = [r["count"] for r in rows.groupBy("_metadata.file_name").count().collect()]
        assert len(sizes) > 10 and max(sizes) < 250
    assert lake.bronze().count() == 2000 and lake.bronze().select(ORIGIN).distinct().count() == 1


def test_uniqueness_groups_written_words(spark, tmp_path):
    """What is grouped was packed by a write with its own settings; the grouping reads no item and packs nothing."""
    plain = spark.newSession()
    lake = orders(plain, tmp_path, 600)
    found, summed = (f(lake.vectors(), SPEC) for f in (quality.duplicate_groups, quality.duplicate_summary))
    assert found.collect() == quality.duplicate_groups(lake.typed(), SPEC).collect() and found.count() == 10
    assert summed.collect() == quality.duplicate_summary(lake.typed(), SPEC).collect() and summed.first().repetidas >= 300
    read = [r for r in found._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in r]
    assert read and all("_w0" in r and "M1" not in r for r in read)
    assert all("/vectors-" in f for name in ("duplicate_groups", "duplicate_summary") for f in all_queries()[name](plain, str(tmp_path)).inputFiles())
