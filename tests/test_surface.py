"""Files, folders, configuration, extractors of one's own, gates that raise: what has no table to compare with."""

import json
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillframe.functions import messages as M
from rillframe.functions import vectors as V
from rillframe.functions.kinematics import pose, quaternion, read_chain
from rillframe.operators import chains, clean, episodes, stats
from rillframe.operators.metadata import Config, apply_rules, valid_vector
from rillframe.plans import metadata as plans
from rillframe.session import task_slots
from rillframe.sinks import datasets as sinks
from rillframe.sources import datasets as sources


def test_files_and_folders(spark, tmp_path):
    df = spark.range(25).select("id", (F.col("id") * 2).alias("state/arm/left"), F.col("id").cast("string").alias("state/name"))
    for policy in ("error", "skip", "append"):
        sinks.write_nested(df, str(tmp_path / "n"), policy, most_rows=10)
    back = spark.read.parquet(str(tmp_path / "n"))
    assert back.count() == 50 and back.schema["state"].dataType.simpleString() == "struct<arm:struct<left:bigint>,name:string>"
    assert sorted(M.flatten_fields(back).columns) == ["id", "state/arm/left", "state/name"]
    with pytest.raises(Exception, match="exists"):
        sinks.write_nested(df, str(tmp_path / "n"))
    sinks.write_json({"fps": 30, "scene": "Küche"}, str(tmp_path / "meta/info.json"))
    assert json.loads((tmp_path / "meta/info.json").read_text(encoding="utf-8")) == {"fps": 30, "scene": "Küche"}
    sinks.write_json_lines(df.select("id"), str(tmp_path / "lines"))
    assert sources.read_json_lines(spark, str(tmp_path / "lines"), "id long").agg(F.sum("id")).first()[0] == 300
    target = sinks.pack_folder(str(tmp_path / "meta"), str(tmp_path / "meta.tar"))
    with tarfile.open(target) as tar:
        assert "meta/info.json" in tar.getnames()
    with pytest.raises(OSError):
        sinks.pack_folder(str(tmp_path / "nowhere"), str(tmp_path / "x.tar"), tries=2, pause=0)
    assert not list(tmp_path.glob("*.part"))


def test_corrupt_files_are_set_aside(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "p"))
    (tmp_path / "p" / "broken.parquet").write_bytes(b"PAR1 this is no parquet file at all PAR1")
    rows, bad = sources.read_with_quarantine(spark, str(tmp_path / "p"), "id long")
    assert rows.count() == 5
    assert [r.path.rsplit("/", 1)[-1] for r in bad.collect()] == ["broken.parquet"]


def test_datasets_are_complete_folders(spark):
    whole = [f"/r/a/{f}" for f in sources.DATASET_FILES] + ["/r/a/data/x.parquet", "/r/a/videos/y.mp4", "/r/a/parameters/z.json"]
    part = [f"/r/b/{f}" for f in sources.DATASET_FILES[:3]] + ["/r/b/data/x.parquet"]
    paths = spark.createDataFrame([(p,) for p in whole + part], "path string")
    assert [r.root for r in sources.deepest_datasets(paths, sources.DATASET_FILES, sources.DATASET_FOLDERS).collect()] == ["/r/a"]


def test_gaps_raise(spark):
    df = spark.createDataFrame([("a", 0), ("a", 10), ("a", 100), ("a", 300), ("b", 5)], "k string, t long")
    with pytest.raises(chains.GapError) as e:
        chains.require_no_gaps(df, ["k"], "t", 50)
    assert (e.value.key, e.value.at, e.value.gap, e.value.count, e.value.threshold) == (("a",), 10, 90, 2, 50) and "2 gaps" in str(e.value)
    assert chains.require_no_gaps(df, ["k"], "t", 200) is df


@pytest.mark.parametrize("width", [7, 50, 10_000])
def test_next_times_over_slices(spark, width):
    rows = [("a", t) for t in (0, 3, 3, 20, 21, 90, None)] + [("b", 5), (None, 1), (None, 60)]
    df = spark.createDataFrame(rows, "k string, t long")
    got = sorted(((r.k, r.t, r.n) for r in clean.with_next(df, ["k"], "t", "n", width).collect()), key=repr)
    want = [("a", 0, 3), ("a", 3, 3), ("a", 3, 20), ("a", 20, 21), ("a", 21, 90), ("a", 90, None), ("a", None, None), ("b", 5, None), (None, 1, 60), (None, 60, None)]
    assert got == sorted(want, key=repr)


def test_config():
    c = Config().overridden({"train_hz": 10, "eef_type": None, "odd": 1}, {"main_timeline_fps": 60, "which_arm": "left"})
    assert (c.stride, c.eef_type, c.which_arm) == (6, "leju_claw", "left")
    for bad in ({"eef_type": "hook"}, {"train_hz": 0}):
        with pytest.raises(ValueError):
            Config().overridden(bad)


def test_rules_and_vectors(spark):
    df = spark.createDataFrame([("a.1",), ("axb",), ("b",)], "n string")
    got = {r.n: (r.x, r.y) for r in apply_rules(df, [("*", "x", "0"), ("a.?", "x", "1"), ("a*", "y", "2")], F.col("n"), ["x", "y"]).collect()}
    assert got == {"a.1": ("1", "2"), "axb": ("0", "2"), "b": ("0", None)}
    v = spark.createDataFrame([([1.0],), ([],), (None,), ([1.0, None],)], "v array<double>")
    assert [r.ok for r in v.select(valid_vector(F.col("v")).alias("ok")).collect()] == [True, False, False, False]
    assert M.joint_names("both", "claw")[7] == "left_claw" and len(M.joint_names("both", "claw", body=True)) == 30 and len(M.joint_names("left", "hand")) == 13
    e = spark.createDataFrame([([0.0, 0.0], [1.0]), ([2.0], [3.0, 0.0]), ([2.0], [0.0]), (None, [0.0])], "a array<double>, b array<double>")
    assert [r.v for r in e.select(M.busier(F.col("a"), F.col("b")).alias("v")).collect()] == [[1.0], [3.0, 0.0], [2.0], None]
    j = spark.createDataFrame([([float(i) for i in range(28)],)], "j array<double>")
    assert len(j.select(V.assemble_state(F.col("j")).alias("s")).first().s) == 28


def test_extractors_of_ones_own(spark):
    df = spark.createDataFrame([("a", "/x", 7, ((3.0,),)), ("a", "/y", 8, ((4.0,),))], "bag string, topic string, t long, msg struct<p:struct<v:double>>")
    double = F.udf(lambda v: [2 * v], "array<double>")
    mine = [("/x", "once", False, lambda m: F.array(m["p"]["v"])), ("/x", "twice", True, lambda m: double(m["p"]["v"]))]
    got = sorted((r.t, r.key, r.is_fallback, r.v) for r in M.extract(df, mine).collect())
    assert got == [(7, "once", False, [3.0]), (7, "twice", True, [6.0])]
    arm = spark.createDataFrame([("/r2_arm_traj", 1), ("/arm_traj", 2), ("/other_arm_trajectory", 3)], "topic string, t long").withColumn("msg", F.struct(F.array(F.lit(180.0)).alias("position")))
    assert sorted((r.t, round(r.v[0], 4)) for r in M.extract(arm, [x for x in M.EXTRACTORS if x[1] == "arm_traj"]).collect()) == [(1, 3.1416), (2, 3.1416)]


def test_task_numbers_go_on(spark):
    frames = spark.createDataFrame([(0, 0, "new"), (0, 1, "new"), (1, 0, "old"), (1, 1, None), (2, 0, "newer")], "ep long, t long, task string")
    known = spark.createDataFrame([("old", 0), ("unused", 1)], "task string, task_index long")
    rows, tasks = episodes.commit_episodes(frames, "ep", ["t"], "task", 10.0, 100, known)
    assert {(r.task, r.task_index) for r in tasks.collect()} == {("old", 0), ("unused", 1), ("new", 2), ("newer", 3)}
    assert sorted((r["ep"], r["t"], r["index"], r["task_index"]) for r in rows.collect()) == [(0, 0, 100, 2), (0, 1, 101, 2), (1, 0, 102, 0), (1, 1, 103, None), (2, 0, 104, 3)]


def test_numbering_over_partitions(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k"))
    got = episodes.numbered(df, ["k"], "n").collect()
    assert all(r.k == r.n for r in got) and len(got) == 5000
    sums = {r.k: r.s for r in episodes.running_sum(df, ["k"], "k", "s").collect()}
    assert sums == {k: k * (k + 1) // 2 for k in range(5000)}


def test_arm_against_matrices():
    """The seven-joint arm: the joints' transforms multiplied one by one."""
    q = np.random.default_rng(2).normal(size=(5, 7))
    got = pose(read_chain(plans._ARM, "tip"), q)
    for n in range(5):
        m = np.eye(4)
        for i in range(7):
            t, c, s = np.eye(4), np.cos(q[n, i]), np.sin(q[n, i])
            t[:3, 3] = [0.1, 0, 0] if i % 2 else [0, 0, 0.2]
            r = np.eye(4)
            r[:3, :3] = [[c, 0, s], [0, 1, 0], [-s, 0, c]] if i % 2 else [[c, -s, 0], [s, c, 0], [0, 0, 1]]
            m = m @ t @ r
        assert np.allclose(got[n, :3, 3], (m @ [0.15, 0, 0, 1])[:3])
    assert np.allclose(np.linalg.norm(quaternion(got[:, :3, :3]), axis=1), 1)


def test_small_things(spark):
    assert 1 <= task_slots(spark, 2) <= 2 and task_slots(spark) == spark.sparkContext.defaultParallelism
    s = spark.createDataFrame([("a", 0, 1.0, 2.0, 1.5, 0.1, 3), ("a", 2, 3.0, 2.0, 9.0, -1.0, 0), ("b", 0, None, 2.0, 1.5, 0.1, 3)], "k string, pos int, min double, max double, mean double, std double, n long")
    assert {(r.k, r.reason) for r in stats.stats_violations(s, ["k"]).collect()} == {("a", x) for x in ("order", "mean", "spread", "count", "shape")} | {("b", "missing")}
    assert sources.list_files(spark, "/root/testdata/sf0.001", "nation*").count() == 1


@pytest.mark.parametrize("width", [3, 40, 100_000])
def test_places_over_slices(spark, width):
    rng = np.random.default_rng(4)
    rows = [(["a", "b", None][k], int(t), i) for i, (k, t) in enumerate(zip(rng.integers(3, size=200), rng.integers(-50, 150, 200)))] + [("a", None, 900)]
    df = spark.createDataFrame(rows, "k string, t long, id long")
    got = {r.id: r.n for r in clean.placed(df, ["k"], ["t", "id"], "n", width).collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    assert got == {r[2]: n for k in ("a", "b", None) for n, r in enumerate(x for x in order if x[0] == k)}
    assert clean.placed(df.limit(0), ["k"], ["t"], "n").count() == 0
