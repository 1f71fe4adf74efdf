"""Loads that come one after the other: landing, ids, moments, sketches, ragged lines, headers."""

import glob
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from likertlake.operators import state
from likertlake.operators.ids import IdMap
from likertlake.session import Workspace
from likertlake.sources import files
from likertlake.sources.loads import LoadFolder
from likertlake.streaming.landing import Landing

HEADER = ["k", "a", "b"]


def drop(folder, name, lines, header=HEADER):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w", encoding="utf-8") as f:
        f.write("".join(f"{x}\n" for x in ["\t".join(header), *lines]))
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def keys(df):
    return sorted(r.k for r in df.collect())


# -- landing ----------------------------------------------------------------


def test_every_file_lands_once(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "bronze")
    landing = lambda: Landing(spark, source, root, HEADER, files_at_once=1)
    drop(source, "1.tsv", ["1\tx\ty", "2\t\tz"])
    drop(source, "2.tsv", ["3\tx\ty"])
    assert landing().run() == 3 and landing().run() == 0
    drop(source, "3.tsv", ["4\té\t\"a\tb\"", "5\tx\ty"])
    assert landing().run() == 2
    rows = landing().rows()
    assert keys(rows) == ["1", "2", "3", "4", "5"]
    got = {r.k: r for r in rows.collect()}
    assert got["2"].a is None and got["4"].b == "a\tb" and got["4"][files.ORIGIN].endswith("3.tsv")
    assert all(r[files.INGESTED] for r in got.values())


def test_a_batch_that_is_replayed_adds_nothing(spark, tmp_path):
    """A run killed after the rows were written, before the checkpoint knew of it."""
    source, root = str(tmp_path / "in"), str(tmp_path / "bronze")
    drop(source, "1.tsv", [f"{i}\tx\ty" for i in range(50)])
    Landing(spark, source, root, HEADER).run()
    drop(source, "2.tsv", [f"{i}\tx\ty" for i in range(50, 80)])
    Landing(spark, source, root, HEADER).run()
    commits = sorted(glob.glob(f"{root}/checkpoint/commits/[0-9]*"))
    os.remove(commits[-1])
    crc = f"{os.path.dirname(commits[-1])}/.{os.path.basename(commits[-1])}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    Landing(spark, source, root, HEADER).run()
    rows = Landing(spark, source, root, HEADER).rows()
    assert sorted(int(r.k) for r in rows.collect()) == list(range(80))


def test_files_of_an_unfinished_batch_are_not_read(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "bronze")
    drop(source, "1.tsv", ["1\tx\ty"])
    landing = Landing(spark, source, root, HEADER)
    landing.run()
    landing.lines().drop(files.REJECTED).write.mode("append").parquet(f"{landing.path}/{files.REJECTED}=false")
    assert keys(Landing(spark, source, root, HEADER).rows()) == ["1"]


def test_ragged_lines_land_beside_the_rows(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "bronze")
    drop(source, "1.tsv", ["1\tx\ty", "2\tx", "3\tx\ty\tz", "4", "5\t\"q\tr\"\ty"])
    landing = Landing(spark, source, root, HEADER)
    assert landing.run() == 5
    assert keys(landing.rows()) == ["1", "5"]
    assert {r[files.RAGGED]: r.motivo for r in landing.rejects().collect()} == {"2\tx": "campos a menos", "3\tx\ty\tz": "campos a mais", "4": "campos a menos"}


def test_another_header_stops_the_run(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "bronze")
    drop(source, "1.tsv", ["1\tx\ty"])
    landing = Landing(spark, source, root, HEADER)
    landing.run()
    drop(source, "2.tsv", ["2\ty\tx"], header=["k", "b", "a"])
    with pytest.raises(Exception, match="header|schema"):
        landing.run()
    assert keys(landing.rows()) == ["1"]


# -- ragged lines, headers --------------------------------------------------


def test_rows_and_rejects_are_all_lines(spark, tmp_path):
    rng = random.Random(4)
    lines = ["\t".join(["v"] * rng.choice([1, 2, 3, 3, 3, 4, 7])) for _ in range(300)]
    for i in range(3):
        drop(str(tmp_path / "in"), f"{i}.tsv", lines[i::3])
    rows, rejects = files.split_ragged(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    widths = [x.count("\t") + 1 for x in lines]
    got = {r.motivo: r["count"] for r in rejects.groupBy("motivo").count().collect()}
    assert rows.count() == widths.count(3) and got == {"campos a menos": sum(w < 3 for w in widths), "campos a mais": sum(w > 3 for w in widths)}
    assert sorted(r[files.RAGGED] for r in rejects.collect()) == sorted(x for x, w in zip(lines, widths) if w != 3)


def test_files_without_a_ragged_line_or_without_a_line(spark, tmp_path):
    drop(str(tmp_path / "a"), "1.tsv", ["1\tx\ty"])
    rows, rejects = files.split_ragged(spark, str(tmp_path / "a"), str(tmp_path / "oa"))
    assert rows.count() == 1 and rejects.count() == 0
    drop(str(tmp_path / "b"), "1.tsv", [])
    rows, rejects = files.split_ragged(spark, str(tmp_path / "b"), str(tmp_path / "ob"))
    assert rows.count() == 0 and rejects.count() == 0


def test_columns_are_found_by_name_in_every_version(spark, tmp_path):
    folder = str(tmp_path / "in")
    drop(folder, "1.tsv", ["1\tx\ty", "2\tx\t"])
    drop(folder, "2.tsv", ["n\t3\tx\ty"], header=["new", *HEADER])
    drop(folder, "3.tsv", ["4\tx\ty"])
    drop(folder, "4.tsv", ["y\t5"], header=["b", "k"])
    got = {r.k: r for r in files.read_versions(spark, folder).collect()}
    assert {k: (r.a, r.b, r.new, r[files.SCHEMA_VERSION]) for k, r in got.items()} == {
        "1": ("x", "y", None, 1), "2": ("x", None, None, 1), "3": ("x", "y", "n", 2), "4": ("x", "y", None, 1), "5": (None, "y", None, 3),
    }
    assert got["5"][files.ORIGIN].endswith("4.tsv")
    known = [("b", "k")]
    assert {r.k: r[files.SCHEMA_VERSION] for r in files.read_versions(spark, folder, known=known).collect()} == {"5": 1, "1": 2, "2": 2, "4": 2, "3": 3}


def test_one_scan_for_each_version(spark, tmp_path):
    for i in range(9):
        drop(str(tmp_path / "in"), f"{i}.tsv", [f"{i}\tx\ty"], header=HEADER if i % 3 else ["k", "b", "c"])
    plan = files.read_versions(spark, str(tmp_path / "in"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2


# -- ids --------------------------------------------------------------------


def as_dict(df):
    return {tuple(r[c] for c in df.columns if c != "id_respondente"): r.id_respondente for r in df.collect()}


def test_ids_are_kept_and_dense(spark, tmp_path):
    rng, known, seen = random.Random(5), {}, []
    ids, work = IdMap(spark, str(tmp_path / "map"), ["place", "k"]), Workspace(spark, "t")
    for load in range(1, 5):
        seen += [(rng.choice(["a", "b", None]), rng.randrange(400)) for _ in range(150)] + [(None, None)]
        ids.add(spark.createDataFrame(seen, "place string, k bigint").repartition(4), load, work, 3)
        now = as_dict(ids.known().drop("carga"))
        assert {k: v for k, v in now.items() if k in known} == known
        assert sorted(now.values()) == list(range(1, len(set(seen)) + 1)) and set(now) == set(seen)
        new = sorted((k for k in now if k not in known), key=lambda k: tuple((x is not None, x) for x in k))
        assert [now[k] for k in new] == list(range(len(known) + 1, len(now) + 1))
        known = now
    assigned = ids.assign(spark.createDataFrame([(None, None, 1), ("z", 1, 2)], "place string, k bigint, id_respondente int"))
    assert [(r.id_respondente is None) for r in assigned.orderBy("place").collect()] == [False, True]


def test_a_load_run_again_gives_the_same_ids(spark, tmp_path):
    ids, work = IdMap(spark, str(tmp_path / "map"), ["k"]), Workspace(spark, "t")
    rows = lambda *r: spark.createDataFrame([(i,) for i in r], "k int")
    ids.add(rows(5, 3), 1, work, 2)
    ids.add(rows(5, 1, 9), 2, work, 2)
    before = as_dict(ids.known().drop("carga"))
    os.remove(tmp_path / "map" / "carga=2" / "_SUCCESS")  # as if killed before the end
    assert as_dict(ids.known().drop("carga")) == {(3,): 1, (5,): 2}
    ids.add(rows(5, 1, 9), 2, work, 2)
    assert as_dict(ids.known().drop("carga")) == before == {(3,): 1, (5,): 2, (1,): 3, (9,): 4}
    with pytest.raises(ValueError, match="cannot follow"):
        ids.add(rows(7), 1, work, 2)
    ids.add(rows(), 3, work, 2)
    assert as_dict(ids.known().drop("carga")) == before


def test_rows_before_any_load_have_no_id(spark, tmp_path):
    got = IdMap(spark, str(tmp_path / "none"), ["k"]).assign(spark.createDataFrame([(1,)], "k int"))
    assert [tuple(r) for r in got.collect()] == [(None, 1)]


# -- moments and sketches ---------------------------------------------------


def test_moments_of_loads_are_those_of_all_rows(spark, tmp_path):
    """Far from zero, with nulls, loads of one row and an empty load."""
    rng = random.Random(6)
    rows = [(rng.choice("xy"), 1e9 + rng.random(), None if rng.random() < 0.2 else rng.gauss(0, 3), 7.0) for _ in range(400)]
    cols, stored = {"A": "a", "B": "b", "C": "c"}, LoadFolder(spark, str(tmp_path / "state"))
    schema = "g string, a double, b double, c double"
    for load, (i, j) in enumerate([(0, 1), (1, 150), (150, 150), (150, 400)]):
        stored.write(load, state.moments(spark.createDataFrame(rows[i:j], schema), cols, ["g"]))
    found = state.merged(stored.read(), ["g"])
    whole = {(r.g, r.a, r.b): r for r in state.moments(spark.createDataFrame(rows, schema), cols, ["g"]).collect()}
    for r in found.collect():
        want = whole[r.g, r.a, r.b]
        assert (r.n, r.minimo, r.maximo) == (want.n, want.minimo, want.maximo)
        for c in ("media_a", "media_b", "m2_a", "m2_b", "c"):
            assert r[c] == pytest.approx(want[c], rel=1e-6, abs=1e-6)
    for r in state.descriptives(found, ["g"]).collect():
        own = [x["ABC".index(r.traco) + 1] for x in rows if x[0] == r.g and x["ABC".index(r.traco) + 1] is not None]
        assert r.n == len(own) and r.media == pytest.approx(statistics.fmean(own)) and r.desvio_padrao == pytest.approx(statistics.stdev(own), rel=1e-6, abs=1e-9)
    for r in state.correlations(found, ["g"]).collect():
        both = [(x["ABC".index(r.a) + 1], x["ABC".index(r.b) + 1]) for x in rows if x[0] == r.g]
        both = [p for p in both if None not in p]
        assert r.n == len(both)
        assert r.correlacao is None if "C" in (r.a, r.b) else r.correlacao == pytest.approx(statistics.correlation(*zip(*both)), abs=1e-6)


def test_sketches_of_loads_keep_the_stated_error(spark, tmp_path):
    rng, stored = random.Random(7), LoadFolder(spark, str(tmp_path / "sketches"))
    rows = [("p", rng.lognormvariate(0, 2)) for _ in range(60_000)] + [("q", float(rng.randrange(5))) for _ in range(30_000)] + [("r", None)]
    df = spark.createDataFrame(rows, "g string, x double").withColumn("part", F.pmod(F.xxhash64("x"), F.lit(3))).cache()
    for load in range(4):
        stored.write(load, state.sketches(df.where((F.col("part") == load) | ((F.col("g") == "r") & F.lit(load == 3))), {"X": "x"}, ["g"]))
    probs = {"a": 0.01, "b": 0.25, "c": 0.5, "d": 0.75, "e": 0.999}
    cuts = state.quantiles(state.merged_sketches(stored.read(), ["g"]), probs, ["g"])
    got = {r.g: r for r in cuts.collect()}
    assert got["r"].n == 0 and got["r"].a is None and got["p"].n == 60_000
    off = state.rank_errors(df, {"X": "x"}, cuts, probs, "g").collect()
    assert {r.g for r in off} == {"p", "q"} and all(0 <= r[k] <= state.RANK_ERROR for r in off for k in probs)


def test_a_sketch_is_small_whatever_it_holds(spark):
    sizes = [state.sketches(spark.range(n).select(F.rand(1).alias("x")), {"X": "x"}).select(F.length("esboco")).first()[0] for n in (200_000, 2_000_000)]
    assert sizes[1] < 1.2 * sizes[0] < 400_000
