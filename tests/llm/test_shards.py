import zlib

from likertlake.llm import queries, shards


def check(rows, n):
    """Slots without gaps, and shards as equal as whole rows allow."""
    own = {}
    for r in rows:
        own.setdefault(r.shard, []).append(r)
    assert all(0 <= s < n for s in own)
    for part in own.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    total, most = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for s in range(n):
        assert abs(sum(r["size"] for r in own.get(s, [])) - total / n) <= most + 1


def test_query(spark, sf_dir, texts):
    df = queries.op9_shards(spark, sf_dir)
    rows = df.collect()
    check(rows, 24)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts.items()}
    assert "Python" not in df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_a_text_that_most_rows_share(spark):
    rows = [(i, "same") for i in range(3000)] + [(i, f"other {i}" * 50) for i in range(1000)] + [(7, "twice")] * 500 + [(9, "x" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(6)
    for range_rows in (shards.RANGE_ROWS, 20):
        got = shards.assign(df, shards=5, range_rows=range_rows).collect()
        assert len(got) == len(rows)
        check(got, 5)


def test_the_sample_is_that_of_the_least_draws(spark):
    """Also where few rows have nearly all of the size, and where more are asked for than there are."""
    sizes = [10] * 2000 + [10_000_000] * 3
    rows = spark.createDataFrame([(f"{i:016x}", s) for i, s in enumerate(sizes)], "key string, size bigint").repartition(7)
    draw = lambda n: shards._sample(rows, n, 1, sum(sizes), len(sizes))
    for n in (1, 50, 500, 5000):
        got = draw(n)
        assert len(got) == len(set(got)) == min(n, len(sizes)) and got == sorted(got)
    assert {f"{i:016x}" for i in (2000, 2001, 2002)} <= set(draw(50)) <= set(draw(500))  # a smaller sample begins a larger one


def test_odd_rows(odd, none):
    got = shards.assign(odd, shards=3, carry=("text", "shard", "size")).collect()
    check(got, 3)
    assert all(r["size"] == 8 and r.text_crc32 is None for r in got if r.text is None)
    assert {r._shard for r in got} == {"shard"}
    assert shards.assign(none).collect() == []


def test_records_of_each_shard_are_written(spark, docs, tmp_path):
    shards.write(docs.limit(50), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and back.select("shard").distinct().count() == 4
