"""Whole results: nothing of the input is left out."""

import json
import zoneinfo
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillframe.operators import instants, outliers
from rillframe.operators.drift import consistent_cells, consistent_table
from rillframe.operators.intervals import periods_and_gaps
from rillframe.operators.outliers import interventions
from rillframe.operators.units import convert_units, phrases_of
from rillframe.plans import catalog
from rillframe.streaming.batches import count_batches, last_batches

DATA = "/root/testdata/sf0.001"


def twin(rows, size):
    """Batches of all rows, in batch mode."""
    n = F.row_number().over(Window.partitionBy("bag_id").orderBy("t")) - 1
    cut = rows.select("bag_id", "t", F.floor(n / size).alias("batch"))
    return sorted(map(tuple, cut.groupBy("bag_id", "batch").agg(F.min("t"), F.max("t"), F.count("*")).collect()))


def test_stream_flushes_all(spark):
    rows = catalog.messages(spark, DATA).where("bag_id is not null and t is not null")
    got = sorted(map(tuple, catalog.stream_batches(spark, DATA).collect()))
    assert got == twin(rows, 20)
    assert sum(r[-1] for r in got) == rows.count()


def test_stream_ties_and_short_entities(spark, tmp_path):
    """Several micro-batches; times that tie at the end of a batch; an entity with less than one batch."""
    files = [[("a", t) for t in (0, 1, 2, 2, 2, 90)], [("a", t) for t in (91, 92, 92, 200, 201)], [("b", 5), ("a", 202), ("c", None)]]
    schema = "bag_id string, t long"
    for i, part in enumerate(files):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    run = count_batches(stream, "bag_id", "t", 3, 10).writeStream.format("parquet").option("path", str(tmp_path / "out"))
    run.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    got = out.unionByName(last_batches(spark, str(tmp_path / "state"), "bag_id", 3))
    rows = spark.createDataFrame([r for part in files for r in part if r[1] is not None], schema)
    assert out.count() and sorted(map(tuple, got.select("bag_id", "batch", "first_t", "last_t", "n").collect())) == twin(rows, 3)


def test_vectors_are_whole(spark, tmp_path):
    """Embeddings longer than today's 64 keep all dimensions."""
    rows = [(i, 0, [float(i * j) for j in range(70)]) for i in range(1, 4)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    d = str(tmp_path)
    for q in (catalog.feature_stats, catalog.stats_merge_parallel, catalog.stats_merge_sumsq):
        assert sorted((r.pos, r.max) for r in q(spark, d).collect()) == [(j, 3.0 * j) for j in range(70)]
    assert sorted((r.vec_id, r["diff"]) for r in catalog.frame_difference(spark, d).collect()) == [(1, 34.5), (2, 34.5)]


def test_interventions_ignore_other_series():
    """A spike at the end of a series is found beside a larger one at the start of the next, and none is left after many rounds."""
    rng = np.random.default_rng(1)
    one, two = rng.normal(size=(60, 1)), rng.normal(size=(60, 1))
    one[58] += 30
    two[1] += 300
    many = rng.normal(size=(200, 1))
    many[50:150] += np.cumsum(rng.choice([-1, 1], 100) * 10.0 ** rng.uniform(1, 6, 100))[:, None]

    def run(*parts):
        x, group = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        effect, _ = interventions(x, group, np.full(x.shape, 1.4), (np.full(x.shape, -0.5), np.zeros(x.shape)))
        return np.split(effect != 0, np.cumsum([len(p) for p in parts])[:-1])

    together = run(one, two, many)
    assert together[0][58, 0] and together[1][1, 0]
    for part, found in zip((one, two, many), together):
        assert np.array_equal(run(part)[0], found)


def test_units_in_long_runs_of_han(spark):
    note = "测" * 60 + "千克力厘米" + "试" * 60
    found = spark.createDataFrame([(note,)], "note string").select(phrases_of(F.col("note")).alias("p")).first().p
    assert "千克力厘米" in found


def test_spikes_come_from_the_interventions(monkeypatch):
    """Excursions of one to three readings are told by the effects found in the residuals; without these there are none."""
    rng = np.random.default_rng(3)
    x = np.cumsum(rng.normal(size=300)) * 0.2 + rng.normal(size=300)
    want = {40, 100, 101, 160, 161, 162}
    x[sorted(want)] += 25
    x[220:] += 40  # lasting
    n = len(x)
    rows = pa.table({"bag": ["b"] * n, "topic": ["t"] * n, "chunk": [0] * n, "seq": list(range(n)), "v": pa.array([[float(v)] for v in x])})
    fit = np.broadcast_to(np.array([1.45, 20.0, 0.0, -0.45, -0.2]), (n, 1, 5))
    limits = np.tile([-np.inf, np.inf], (n, 1))

    def spikes():
        return set(np.flatnonzero(outliers.flags(outliers.Block(rows), fit, limits, np.zeros(n, bool), 7.5, 40.0)[1]))

    assert spikes() == want
    for useless in (np.ones((n, 1)), np.zeros((n, 1))):
        monkeypatch.setattr(outliers, "interventions", lambda x, *_, e=useless: (e, np.zeros(x.shape)))
        assert spikes() == set()


def test_unit_at_the_end_of_a_long_note(spark):
    """A note of fifty characters without punctuation, and a spelling longer than any name of a unit."""
    notes = spark.createDataFrame([("a", "测" * 45 + "公斤力厘米"), ("b", "in kilogram force centi metres here")], "bag string, note string")
    df = spark.createDataFrame([(1, "a", "5", None), (2, "b", "5", None), (3, "a", "5", "newton - - - - - - - - - - - - - - - - - - - - - - - - - - - - - - - - - - - metres")], "id long, bag string, v string, u string")
    got = {r.id: (round(r.value, 7), r.unit) for r in convert_units(df, notes, "id", "bag", {"v": ("v", "u", "torque")}, "note").where("value is not null").collect()}
    assert got[1] == (0.4903325, "kgf·cm") and got[2] == (0.4903325, "kgf·cm") and got[3] == (5.0, "N·m")


def test_withheld_zones_are_estimated(spark, monkeypatch):
    """Texts of three clocks, over changes of the clock, without any stated zone; one clock states a wrong one."""
    zones = {"a": "Europe/Berlin", "b": "Asia/Kolkata", "c": "America/New_York", "w": "Asia/Tokyo"}
    rng, windows, texts, want = np.random.default_rng(5), [], [], {}
    for k, zone in zones.items():
        for i in range(60):
            low = 1_753_000_000_000_000 + i * 3 * 24 * instants.HOUR + int(rng.integers(24 * instants.HOUR))
            windows.append((f"{k}{i}", k, low, low + 600_000_000, "Europe/Paris" if k == "w" else None))
            for j in range(4):
                at = low + int(rng.integers(600)) * 1_000_000
                wall = datetime.fromtimestamp(at / 1e6, UTC).astimezone(zoneinfo.ZoneInfo(zone))
                texts.append((len(texts), f"{k}{i}", wall.strftime(["%Y-%m-%d %H:%M:%S", "%d.%m.%Y %H:%M:%S"][j % 2])))
                want[texts[-1][0]] = at // 1_000_000 * 1_000_000
    df = spark.createDataFrame(texts, "id long, bag string, x string")
    win = spark.createDataFrame(windows, "bag string, dev string, low long, high long, zone string")
    share = lambda: np.mean([want[r.id] == r.value_us for r in instants.normalise_instants(df, win, "id", "bag", ["x"], clock="dev").collect()])
    assert share() >= 0.99
    none = spark.createDataFrame([(f"c{k}", [(-(1 << 62), 1 << 62, 0)]) for k in zones], "clock string, history array<struct<since:bigint,until:bigint,o:bigint>>")
    monkeypatch.setattr(instants, "estimate_histories", lambda unsure: none)
    assert share() < 0.5


def test_periods_over_cells(spark):
    """Stretches that touch, span or skip small cells and upper cells; intervals of any length."""
    rng = np.random.default_rng(8)
    data = [(f"k{i % 3}", int(s), int(s + n)) for i, (s, n) in enumerate(zip(rng.integers(-400, 400, 120), rng.choice([1, 2, 4, 8, 16, 60, 100], 120)))]
    data += [("k1", 64, 128), ("k1", 128, 192), ("far", -(10**12), 10**12), ("far", 10**12, 10**12 + 5), ("far", 3, 9), ("far", 2 * 10**12, 2 * 10**12 + 1)]
    want = []
    for k in {d[0] for d in data}:
        union = []
        for s, e in sorted((s, e) for x, s, e in data if x == k):
            if union and s <= union[-1][1]:
                union[-1][1] = max(union[-1][1], e)
            else:
                union.append([s, e])
        want += [(k, "period", s, e) for s, e in union] + [(k, "gap", a[1], b[0]) for a, b in zip(union, union[1:])]
    df = spark.createDataFrame(data, "k string, s long, e long")
    near, far = df.where("k <> 'far'"), [w for w in want if w[0] == "far"]
    for bits in (2, 3, 4, 5):
        assert sorted(map(tuple, periods_and_gaps(near, "k", "s", "e", bits).collect())) == sorted(w for w in want if w[0] != "far")
    assert sorted(map(tuple, periods_and_gaps(df.where("k = 'far'"), "k", "s", "e").collect())) == sorted(far)


def test_drift_casts_and_defaults(spark):
    """Every cell has its target type; failed casts and absent fields are recorded; the table has typed columns."""
    bodies = []
    for i in range(24):
        b = {"hz": str(i) if i < 8 else i, "flag": "true" if i < 8 else True, "note": i if i < 8 else f"t{i}", "box": {"value": f"v{i}"} if i < 8 else f"v{i}"}
        b["marks"] = [{"pos": "0.5" if i < 8 else 0.5, "kind": "a"}, {"pos": None if i < 8 else 0.25, "kind": "b"}]
        if i == 3:
            b["hz"] = "fast"
        if i >= 12:
            b["late"] = 1.5 * i
        bodies.append(json.dumps(b))
    df = spark.createDataFrame([("x", f"2025-01-01 00:00:{i:02d}", i, b) for i, b in enumerate(bodies)] + [("x", "2025-01-01 00:00:03", 3, bodies[3])], "exporter string, at string, id long, body string").withColumn("at", F.to_timestamp("at"))
    args = (df, "exporter", "at", "id", "body")
    cells = {(r.id, r.field, r.item): r for r in consistent_cells(*args).collect()}
    target = {"hz": "number", "flag": "boolean", "note": "string", "box": "string", "marks[].pos": "number", "marks[].kind": "string", "late": "number"}
    assert {r.field: r.type for r in cells.values()} == target
    assert cells[2, "hz", None].value == "2.0" and cells[3, "hz", None].rule == "failed" and cells[3, "hz", None].written == "fast"
    assert cells[1, "box", None].value == "v1" and cells[1, "note", None].value == "1" and cells[5, "late", None].rule == "default"
    wide = {r.id: r for r in consistent_table(*args, defaults={"late": "-1"}).collect()}
    assert len(wide) == 24 and wide[3].failed == ["hz"] and wide[3].hz is None and wide[3].defaulted == ["late"] and wide[3].late == -1.0
    assert wide[20].late == 30.0 and wide[20].flag is True and wide[2].flag is True and [(m.pos, m.kind) for m in wide[2].marks] == [(0.5, "a"), (None, "b")]
    assert consistent_table(df.limit(0), *args[1:]).count() == 0 and consistent_cells(df.limit(0), *args[1:]).count() == 0
