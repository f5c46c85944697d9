"""Operators of problems 1 to 7: against brute force, and on nulls, empty tables, ties, repeats and clashing columns."""

import json
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillframe.functions.units import spelling_distance
from rillframe.operators.drift import schema_changes
from rillframe.operators.grid import regular_grid
from rillframe.operators.instants import length_us, normalise_instants
from rillframe.operators.intervals import periods_and_gaps
from rillframe.operators.nearest import nearest_within
from rillframe.operators.outliers import implausible_readings
from rillframe.operators.units import convert_units


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# 1 ---------------------------------------------------------------- intervals


def union_of(parts):
    out = []
    for s, e in sorted(parts):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


@pytest.mark.parametrize("bits", [3, 6, 16])
def test_periods_against_brute_force(spark, bits):
    rng = random.Random(bits)
    data = [(f"k{rng.randrange(4)}", s := rng.randrange(-300, 900), s + rng.choice([-2, 0, 1, 2, 3, 8, 60])) for _ in range(400)]
    got = rows(periods_and_gaps(spark.createDataFrame(data, "k string, s long, e long"), "k", "s", "e", bits))
    want = []
    for k in {d[0] for d in data}:
        u = union_of([(s, e) for x, s, e in data if x == k and e > s])
        want += [(k, "period", s, e) for s, e in u] + [(k, "gap", a[1], b[0]) for a, b in zip(u, u[1:])]
    assert got == sorted(want, key=repr)


def test_periods_edge_cases(spark):
    schema = "kind string, s long, e long, cell string, lvl int"  # names the operator uses itself
    data = [("a", 0, 4, "x", 1), ("a", 0, 4, "y", 2), ("a", 4, 6, None, 3), ("a", 9, 9, "", 1), ("a", 9, 7, "", 1), (None, 0, 1, "", 1), ("b", None, 4, "", 1), ("b", 1, None, "", 1)]
    df = spark.createDataFrame(data, schema).withColumnRenamed("kind", "bag")
    assert rows(periods_and_gaps(df, "bag", "s", "e")) == [("a", "period", 0, 6)]
    assert rows(periods_and_gaps(df.limit(0), "bag", "s", "e")) == []


# 2 ---------------------------------------------------------------- units


def test_units(spark):
    schema = "id long, bag string, effort string, unit string, note string, x int"
    data = [
        (1, "a", "1,5 mN*m", None, "n", 1), (2, "a", "2.000e+00", "KGF-CM", "n", 1), (3, "a", "n/a", "Nm", "n", 1), (4, "a", None, "Nm", "n", 1), (5, "a", "7", "furlong", "n", 1),
        (1, "a", "1,5 mN*m", None, "n", 1), (6, "b", "30", None, "n", 1), (7, "c", "9000", None, "n", 1), (8, "c", "12000", None, "n", 1), (9, "d", "9", "Nm", "n", 1), (10, "a", "  8 newton metr ", "", "n", 1),
        (11, None, "3 Nm", None, "n", 1), (12, "a", "", None, "n", 1), (13, "a", "1.234,5 Nm", None, "n", 1), (14, "a", "9" * 5000, "Nm", "n", 1),
    ]
    notes = spark.createDataFrame([("b", "Drehmoment in Newtonzentimeter, Strom in Ampere"), ("c", "a 5 kgf weight"), ("a", None)], "bag string, note string")
    out = {r.id: (None if r.value is None else round(r.value, 6), r.unit) for r in convert_units(spark.createDataFrame(data, schema), notes, "id", "bag", {"effort": ("effort", "unit", "torque")}, "note").collect()}
    assert out == {
        1: (0.0015, "mN·m"), 2: (0.196133, "kgf·cm"), 5: (None, None), 6: (0.3, "N·cm"), 7: (9.0, "mN·m"), 8: (12.0, "mN·m"), 9: (9.0, "N·m"), 10: (8.0, "N·m"), 11: (3.0, "N·m"), 13: (1234.5, "N·m"),
    }
    empty = spark.createDataFrame([], schema)
    assert convert_units(empty, notes, "id", "bag", {"effort": ("effort", "unit", "torque")}, "note").count() == 0


def test_spelling_distance():
    assert spelling_distance("mA", "MA") < 0.1 < spelling_distance("mA", "cA")
    assert spelling_distance("N·m", "N m") < 0.1


# 3 ---------------------------------------------------------------- outliers


def series(n, seed, scale=1.0):
    r = np.random.default_rng(seed)
    return np.cumsum(r.normal(0, 0.1, n)) * scale + r.normal(0, 1, n) * scale


def test_outliers(spark):
    data, want = [], defaultdict(set)
    for bag in range(6):
        x, y = series(400, bag), series(400, bag + 50)
        for at, size, kind in ((60, 1, "spike"), (120, 3, "spike"), (260, 25, "stuck")):
            if kind == "spike":
                x[at : at + size] += 40
            else:
                x[at : at + size] = x[at]
            want[kind] |= {(f"b{bag}", at + i) for i in range(size)}
        x[330:] += 60  # a lasting shift
        x[200] = 1e9
        want["impossible"].add((f"b{bag}", 200))
        for i in range(400):
            data.append((f"b{bag}", "dev", "t", i, 1000 + i, [float(x[i]), float(y[i])], "clash"))
        data.append(data[-1])  # a repeated row
    data += [("b0", "dev", "t", 900, None, [1.0, 1.0], ""), ("b0", "dev", "t", 901, 2, None, ""), ("b0", "dev", "t", 902, 2, [], ""), ("b0", "dev", "t", 903, 5, [1.0, float("nan")], ""), ("b0", "dev", "t", 904, 1100, [1.0, None], "")]
    want["outside"], want["impossible"] = {("b0", 903)}, want["impossible"] | {("b0", 903), ("b0", 904)}
    df = spark.createDataFrame(data, "bag string, dev string, topic string, seq long, t long, v array<double>, chunk string")
    windows = spark.createDataFrame([(f"b{b}", 1000, 1500) for b in range(6)], "bag string, low long, high long")
    call = lambda d: implausible_readings(d, windows, "bag", "dev", "topic", "seq", "t", "v", chunk=150)
    got = call(df).collect()
    for kind in ("outside", "impossible", "spike", "stuck"):
        assert {(r.bag, r.seq) for r in got if r[kind]} == want[kind], kind
    assert len({(r.bag, r.seq) for r in got}) == len(got)
    assert call(df.limit(0)).count() == 0


# 4 ---------------------------------------------------------------- nearest


def test_nearest_against_brute_force(spark):
    rng = random.Random(7)
    left = [(f"e{rng.randrange(3)}", "c", i, rng.randrange(0, 4000)) for i in range(500)]
    right = [(f"e{rng.randrange(4)}", i, rng.randrange(0, 4000)) for i in range(150)]
    lf = spark.createDataFrame(left + left[:50], "e string, a string, b long, t long")
    rt = spark.createDataFrame(right + right[:20], "e string, seq long, t long")
    want = []
    for e, a, b, t in left:
        near = [(abs(s - t), -s, -q) for x, q, s in right if x == e and abs(s - t) <= 40]
        if near:
            want.append((e, a, b, -min(near)[2]))
    for width in (37, 500, 60_000):
        assert rows(nearest_within(lf, rt, "e", "t", ("a", "b"), "t", "seq", 40, width)) == sorted(want, key=repr)


def test_nearest_edge_cases(spark):
    lf = spark.createDataFrame([("e", "c", 1, 10, "x"), ("e", None, None, 20, "x"), ("e", "c", 3, None, "x"), (None, "c", 4, 10, "x")], "e string, a string, b long, t long, slice string")
    rt = spark.createDataFrame([("e", 5, 8), ("e", 6, 12), ("e", 7, 12), ("e", None, 10), ("e", 9, None), (None, 1, 10)], "e string, seq long, t long")
    assert rows(nearest_within(lf, rt, "e", "t", ("a", "b"), "t", "seq", 8)) == [("e", "c", 1, 7), ("e", None, None, 7)]
    assert nearest_within(lf, rt.limit(0), "e", "t", ("a", "b"), "t", "seq", 8).count() == 0
    assert nearest_within(lf.limit(0), rt, "e", "t", ("a", "b"), "t", "seq", 8).count() == 0


# 5 ---------------------------------------------------------------- grid


@pytest.mark.parametrize("chunk", [700, 60_000_000])
def test_grid(spark, chunk):
    data = [("b", "s", t, [float(t)], "z") for t in (100, 150, 420, 480, 1900, 1900)] + [("b", "s", None, [1.0], "z"), ("b", "s", 700, [], "z"), ("b", "s", 800, None, "z"), ("b", "far", 99_000, [1.0], "z"), ("x", "s", 5, [1.0], "z"), (None, "s", 5, [1.0], "z")]
    df = spark.createDataFrame(data, "bag string, src string, t long, v array<double>, slot string")
    spans = spark.createDataFrame([("b", 100, 2100, 1, 200), ("x", None, 5, 1, 1)], "bag string, start long, stop long, rate long, per long")
    got = {(r.src, r.slot): (r.at, r.value, r.status) for r in regular_grid(df, spans, "bag", "src", "t", "v", 400, chunk).collect()}
    assert len(got) == 20 and all(got["far", k][2] == "missing" for k in range(10))
    status = [got["s", k][2] for k in range(10)]
    assert status == ["observed", "observed", "missing", "missing", "missing", "missing", "missing", "missing", "missing", "observed"]
    assert got["s", 0][:2] == (100, [100.0]) and got["s", 1][:2] == (300, [300.0]) and got["s", 9][1] == [1900.0]
    wide = {r.slot: r for r in regular_grid(df, spans, "bag", "src", "t", "v", 5000, chunk).where("src = 's'").collect()}
    assert wide[5].status == "filled" and wide[5].value == [pytest.approx(1100.0)]
    assert regular_grid(df.limit(0), spans, "bag", "src", "t", "v").count() == 0


# 6 ---------------------------------------------------------------- instants

BERLIN = 1_761_439_537_843_453  # 2025-10-26 02:45:37.8 in Berlin, before the clock goes back


def test_instants(spark):
    texts = {
        1: ("2025-10-26 02:45:40.5", 1_761_439_540_500_000), 2: ("2025-10-26T00:45:40Z", 1_761_439_540_000_000), 3: ("26.10.2025 02:45:40", 1_761_439_540_000_000), 4: ("10/26/2025 2:45:40 AM", 1_761_439_540_000_000),
        5: ("20251026T004540.25Z", 1_761_439_540_250_000), 6: ("Sun, 26 Oct 2025 02:45:40 +0200", 1_761_439_540_000_000), 7: ("2025年10月26日 02:45:40", 1_761_439_540_000_000), 8: ("1761439540123", 1_761_439_540_123_000),
        9: ("1761439540123456789", 1_761_439_540_123_456), 10: (" 2025-10-25 20:45:40 EDT ", 1_761_439_540_000_000), 11: ("1761439540.5", 1_761_439_540_500_000),
        12: ("0000-00-00 00:00:00", None), 13: ("", None), 14: (None, None), 15: ("2025-02-30 10:00:00", None), 16: ("junk" * 50_000, None), 17: ("2025-10-26 25:00:00", None),
    }
    df = spark.createDataFrame([(i, "b", t, "clash") for i, (t, _) in texts.items()] + [(1, "b", texts[1][0], "clash"), (20, "n", "2025-10-26 10:45:40", "c"), (21, None, "2025-10-26 10:45:40", "c")], "id long, bag string, x string, low string")
    windows = spark.createDataFrame([("b", BERLIN, BERLIN + 20_000_000, "Europe/Berlin"), ("n", BERLIN, BERLIN + 20_000_000, None)], "bag string, low long, high long, zone string")
    out = rows(normalise_instants(df, windows, "id", "bag", ["x"]))
    assert dict((i, v) for i, _, v in out) == {i: v for i, (_, v) in texts.items() if v} | {20: 1_761_439_540_000_000}
    assert normalise_instants(df.limit(0), windows, "id", "bag", ["x"]).count() == 0


def test_lengths(spark):
    cases = {"0.529s": 529_000, "1.5": 1_500_000, "1 s 436 ms": 1_436_000, "00:01:01.575": 61_575_000, "PT1M2.5S": 62_500_000, "1,821 Sek.": 1_821_000, "1.583 秒": 1_583_000, "2109000 µs": 2_109_000, " 0.4 seconds ": 400_000, "?": None, "": None, None: None, "n/a": None, "5 parsecs": None}
    df = spark.createDataFrame([(k,) for k in cases], "d string").select("d", length_us(F.col("d")).alias("v"))
    assert {r.d: r.v for r in df.collect()} == cases


# 7 ---------------------------------------------------------------- drift


def test_drift(spark):
    bodies = []
    for i in range(30):
        b = {"scene_name": f"room_{'abcd'[i % 4]}", "hz": i % 3 * 10, "marks": [{"start": f"2025-01-{i + 1:02d}", "kind": "ab"[i % 2]}], "note": None if i % 5 == 0 else "text"}
        if i >= 8:
            b["primary_scene"] = b.pop("scene_name")
        if i >= 12:
            b["hz"] = str(b["hz"])
        if i == 15:
            del b["hz"]  # one odd file
        if i >= 18:
            b["extra"] = True
        if i >= 20:
            b["moments"] = b.pop("marks")
        if i >= 24:
            b["moments"] = [{"start": m["start"]} for m in b["moments"]]
        if i >= 28:
            b["late"] = 1  # two files only
        bodies.append(json.dumps(b))
    bodies[5] = bodies[5][:20]
    data = [("x", f"2025-01-01 00:00:{i:02d}", i, b, 0) for i, b in enumerate(bodies)]
    data += [data[3], ("y", "2025-01-01 00:00:00", 100, "[1]", 0), ("y", "2025-01-01 00:00:01", 101, None, 0), (None, "2025-01-01 00:00:02", 102, "{}", 0), ("z", None, 103, "{}", 0)]
    df = spark.createDataFrame(data, "exporter string, at string, id long, body string, kind int").withColumn("at", F.to_timestamp("at"))
    got = rows(schema_changes(df, "exporter", "at", "id", "body"))
    assert got == sorted([(8, "renamed", "scene_name", "primary_scene"), (12, "retyped", "hz", "hz"), (18, "added", "", "extra"), (20, "renamed", "marks", "moments"), (24, "removed", "moments[].kind", "")], key=repr)
    assert schema_changes(df.limit(0), "exporter", "at", "id", "body").count() == 0
