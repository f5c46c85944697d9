"""Golden micro-cases, SQL twins on small data, file round trips, streaming."""

import glob
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rillframe.functions import kinematics, vectors
from rillframe.functions.images import clip_depth, denoise_depth, still_prefix
from rillframe.operators import asof, clean, stats, timeline
from rillframe.operators.episodes import delta_frames
from rillframe.plans import catalog, catalog_sql, chains, features, metadata, training, training_sql
from rillframe.sinks.datasets import dataset_info, write_episodes
from rillframe.sources.datasets import deepest_datasets, read_episodes, recordings_in

DATA = "/root/testdata/sf0.001"
PARTS = (features.R, chains.R, metadata.R)
TWINS = {**catalog_sql.ORACLES, **training_sql.ORACLES, **{k: q for p in PARTS for k, q in p.oracles.items()}}
ALL = {**catalog.QUERIES, **training.QUERIES, **{k: q for p in PARTS for k, q in p.queries.items()}}


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def norm(v):
    return round(v, 6) + 0.0 if isinstance(v, float) else float(v) if isinstance(v, int) and not isinstance(v, bool) else v


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, duck, name):
    df = ALL[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(repr([norm(r[c]) for c in cols]) for r in df.collect())
    cur = duck.execute(TWINS[name])
    at = [c[0] for c in cur.description]
    assert sorted(at) == cols
    assert got == sorted(repr([norm(r[at.index(c)]) for c in cols]) for r in cur.fetchall())


@pytest.mark.parametrize(("tie", "want"), [("later", [0, 10, 20, 20, 40, 40, 40]), ("earlier", [0, 0, 10, 20, 20, 40, 40])])
def test_nearest_golden(spark, tie, want):
    main = spark.createDataFrame([("a", t, t) for t in (-5, 5, 15, 29, 30, 31, 100)], "k string, t long, id long")
    other = spark.createDataFrame([("a", t, t) for t in (0, 10, 20, 40)], "k string, t long, id long")
    for width in (None, 7):
        got = asof.nearest_asof(main, other, ["k"], "t", "id", tie, width).orderBy("t").select("near_t").collect()
        assert [r[0] for r in got] == want
    assert asof.nearest_asof(main, other.limit(0), ["k"], "t", "id").where("near_t is null").count() == 7


def test_gap_fill_golden(spark):
    df = spark.createDataFrame([("a", t) for t in (0, 10, 35, 36, 70)], "k string, t long")
    assert [r.t for r in clean.fill_gaps(df, ["k"], "t", 10).orderBy("t").collect()] == [0, 10, 18, 26, 35, 36, 44, 53, 61, 70]


def test_insert_golden(spark):
    df = spark.createDataFrame([("a", t * 1000) for t in (0, 100, 140, 206)], "k string, t long")
    for n, want in ((7, [0, 25, 50, 100, 140, 173, 206]), (13, [0, 25, 50, 75, 100, 120, 140, 173, 206])):
        got = timeline.insert_frames(df, ["k"], "t", n / 0.206, 33_000)
        assert sorted(r.t for r in got.collect()) == [x * 1000 for x in want]


def test_stride_and_samples(spark):
    df = spark.range(20).withColumn("k", F.lit("a"))
    assert [r.id for r in timeline.drop_and_stride(df, ["k"], ["id"], 3, 3).orderBy("id").collect()] == [3, 6, 9, 12, 15]
    n = spark.createDataFrame([(x,) for x in (1, 50, 99, 100, 500, 1000, 10_000, 300_000)], "n long").select(stats.sample_size(F.col("n")).alias("k"))
    assert [r.k for r in n.collect()] == [1, 50, 99, 100, 105, 177, 1000, 10_000]
    assert delta_frames([0.05, 0.15, 0.25, -0.05, -0.25], 10) == [0, 2, 2, 0, -2]


def test_thin_timeline():
    t = np.cumsum(np.r_[0, np.full(60, 30_000)])
    out = timeline.thin_timeline(t, 50)
    assert len(out) == 50 and out[0] == t[0] and out[-1] == t[-1] and np.all(np.diff(out) > 0)


def test_torque_golden(spark):
    v = spark.createDataFrame([([float(i + 1) for i in range(28)],), ([1.0],)], "v array<double>").select(vectors.current_to_torque(F.col("v")).alias("x")).collect()
    assert v[1].x is None
    assert [round(v[0].x[i], 6) for i in (0, 1, 12, 13, 19, 20, 26, 27)] == [1.0, 1.75, 11.375, 33.333333, 17.5, 50.0, 2.7, 62.666667]


def test_kinematics():
    chain = kinematics.read_chain(catalog._URDF, "tip")
    p = kinematics.pose(chain, np.array([[0.0, 0.0], [np.pi / 2, 0.0], [0.0, np.pi / 2]]))
    assert np.allclose(p[:, :3, 3], [[0.75, 0, 1], [0, 0.75, 1], [0.5, 0, 0.75]])
    assert np.allclose(kinematics.quaternion(p[:, :3, :3])[1], [0, 0, np.sqrt(0.5), np.sqrt(0.5)])


def test_images():
    depth = np.full((20, 20), 500)
    depth[4:6, 4:7] = 20_000
    assert denoise_depth(depth).max() == 500
    assert clip_depth(np.array([[0, 5], [10, 99]]), 0, 10).shape == (2, 2, 3)
    assert still_prefix([1, 1, 1, 9, 9], 2, 0.7, 2) == 4


def test_dataset_round_trip(spark, tmp_path):
    frames = spark.range(100).select((F.col("id") % 3).alias("episode_index"), F.col("id").alias("frame_index"))
    write_episodes(frames, str(tmp_path / "x"), chunk_size=2)
    back = read_episodes(spark, str(tmp_path / "x"), [1])
    assert back.count() == 33 and {r.chunk for r in back.select("chunk").distinct().collect()} == {0}
    assert tuple(dataset_info(frames, 30.0, chunk_size=2).first())[:5] == (3, 100, 2, 30.0, "0:3")


def test_discovery(spark):
    paths = spark.createDataFrame([(p,) for p in ("/a/x y.bag", "/b/x y.bag", "/b/x.c.bag", "/b/._.bag", "/r/one/meta/info.json", "/r/one/two/meta/info.json", "/r/ten/meta/info.json")], "path string")
    assert sorted(r.dataset for r in recordings_in(paths).collect()) == ["bag", "x_y", "x_y_2"]
    assert sorted(r.root for r in deepest_datasets(paths).collect()) == ["/r/one/two", "/r/ten"]


def test_stream_equals_batch(spark):
    """All batches, the short last ones included, against the events themselves."""
    times = {}
    for r in catalog.messages(spark, DATA).collect():
        times.setdefault(r.bag_id, []).append(r.t)
    want = {(u, i // 20): (part[0], part[-1], len(part)) for u, t in times.items() for i in range(0, len(t), 20) for part in [sorted(t)[i : i + 20]]}
    assert {(r.bag_id, r.batch): (r.first_t, r.last_t, r.n) for r in catalog.stream_batches(spark, DATA).collect()} == want
