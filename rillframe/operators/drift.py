"""Schemas that drift between files: fingerprints, changes, and one consistent table.

Files are range-partitioned by (exporter, time), so an exporter with most of the files is spread over
many partitions.  Each partition reduces its stretch of files to schema fingerprints and those to runs
(a field present or absent, of one type, for so many successive files); only runs that can matter leave
it.  Per exporter the runs are then walked in order, which gives the explicit migration steps (added,
removed, renamed, retyped).  The steps define epochs of field names through which every file is routed.
"""

from __future__ import annotations

import difflib
import functools
import hashlib
import itertools
import json
import re
from collections import defaultdict, namedtuple
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillframe.session import cut_lineage, epoch_us

LASTING = 3  # successive files from which on a difference is a change
_FEATURES = 48  # bottom-k sketch of a field's values

_RUNS = "exporter string, seg bigint, kind string, path string, val string, i0 bigint, i1 bigint, file_id bigint, at bigint, n bigint, features array<bigint>, low double, high double, whole double"
_STEPS = "exporter string, kind string, file_id bigint, at bigint, until bigint, change string, old_field string, new_field string, type string"


def type_of(v) -> str | None:
    if v is None:
        return None
    return {bool: "boolean", int: "number", float: "number", str: "string", list: "array", dict: "object"}[type(v)]


def parse_body(body: str | None) -> dict | None:
    """The JSON object of a body; None for null, cut-off or other bodies."""
    try:
        doc = json.loads(body) if body else None
    except (ValueError, RecursionError):
        return None
    return doc if isinstance(doc, dict) else None


def fields_of(doc: dict) -> Iterator[tuple[str, object]]:
    """(path, value) of the top-level fields and of the keys of objects in top-level arrays."""
    for key, v in doc.items():
        yield key, v
        if isinstance(v, list):
            for item in v:
                if isinstance(item, dict):
                    for k, x in item.items():
                        yield f"{key}[].{k}", x


@functools.lru_cache(1 << 16)
def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=7).digest(), "big")


def _number(v) -> float | None:
    if isinstance(v, bool) or not isinstance(v, int | float | str):
        return None
    if isinstance(v, str) and not _NUMERIC.match(v):
        return None
    try:
        x = float(v)
    except (ValueError, OverflowError):
        return None
    return x if x - x == 0 else None


_NUMERIC = re.compile(r"\s*[-+.\dinIN]")


@functools.lru_cache(1 << 16)
def _words_of(v: str) -> tuple[str, ...]:
    return tuple(("s:" + re.sub(r"\d", "9", w)) if re.search(r"\d", w) else "w:" + w.lower() for w in v.split())


def _features(v) -> list[str]:
    """What a value is known by, whatever type it is written as: its words, the shape of its digits, its number, its keys."""
    if isinstance(v, bool):
        return ["bool"]
    if (x := _number(v)) is not None:
        return [f"n:{x:g}"]
    if isinstance(v, str):
        return list(_words_of(v))
    if isinstance(v, dict):
        return [f for x in v.values() for f in _features(x)] if list(v) == ["value"] else [f"k:{k}" for k in v]
    if isinstance(v, list):
        return [f"k:{k}" for x in v if isinstance(x, dict) for k in x] + [f for x in v if not isinstance(x, dict) for f in _features(x)] or ["list"]
    return []


class _Profile:
    """Bottom-k sketch of a field's value features, with the range of its numbers."""

    def __init__(self):
        self.seen: set[int] = set()
        self.low, self.high, self.whole, self.edge = np.inf, -np.inf, 1.0, None

    def add(self, v) -> None:
        for f in _features(v):
            self.add_hash(_hash(f))
        inner = v["value"] if isinstance(v, dict) and list(v) == ["value"] else v[0] if isinstance(v, list) and len(v) == 1 else v
        if (x := _number(inner)) is not None:
            self.low, self.high = min(self.low, x), max(self.high, x)
            self.whole = min(self.whole, float(x.is_integer()))

    def add_hash(self, h: int) -> None:
        if self.edge is not None and h >= self.edge:
            return
        self.seen.add(h)
        if len(self.seen) > 2 * _FEATURES:
            self.seen = set(sorted(self.seen)[:_FEATURES])
            self.edge = max(self.seen)

    def least(self) -> list[int]:
        return sorted(self.seen)[:_FEATURES]


def _runs(values: list, index: list[int]) -> list[tuple]:
    """(value, first index, last index, count) of the runs of equal values."""
    out = []
    for v, i in zip(values, index):
        if out and out[-1][0] == v:
            out[-1] = (v, out[-1][1], i, out[-1][3] + 1)
        else:
            out.append((v, i, i, 1))
    return out


def _segment(exporter: str, files: list[tuple[int, int, int]], prints: list[dict], profiles: dict[str, _Profile]) -> list[tuple]:
    """Rows for a stretch of files of one exporter: (file_id, at, fingerprint) in order."""
    seg = files[0][1]
    rows = [(exporter, seg, "files", "", "", 0, len(files) - 1, files[0][0], files[0][1], len(files), None, None, None, None)]
    observed = {"": list(range(len(files)))}
    for i, (_, _, p) in enumerate(files):
        for path, (kind, has_keys) in prints[p].items():
            if has_keys:
                observed.setdefault(path, []).append(i)
    for path, at in observed.items():
        if path:
            f = files[at[0]]
            rows.append((exporter, seg, "list", path, "", at[0], at[-1], f[0], f[1], len(at), None, None, None, None))
    for path in sorted({p for _, _, k in files for p in prints[k]}):
        owner = path.split("[].", 1)[0] if "[]." in path else ""
        at = observed.get(owner, [])
        here = [path in prints[files[i][2]] for i in at]
        kinds = [(i, prints[files[i][2]][path][0]) for i, x in zip(at, here) if x]
        kinds = [(i, k) for i, k in kinds if k is not None]
        for kind, runs in (("presence", _runs([str(x) for x in here], at)), ("type", _runs([k for _, k in kinds], [i for i, _ in kinds]))):
            for j, (v, i0, i1, n) in enumerate(runs):
                if n >= LASTING or j in (0, len(runs) - 1):  # a short run inside is no change
                    rows.append((exporter, seg, kind, path, v, i0, i1, files[i0][0], files[i0][1], n, None, None, None, None))
        q = profiles[path]
        rows.append((exporter, seg, "profile", path, "", 0, 0, None, None, 0, q.least(), *((q.low, q.high, q.whole) if q.high >= q.low else (None, None, None))))
    return rows


def _to_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64(), "array<bigint>": pa.list_(pa.int64())}[t]) for n, t in (x.split() for x in _RUNS.split(", "))])
    exporter, files, prints, known, profiles, last = None, [], [], {}, defaultdict(_Profile), None
    ready: list[tuple] = []

    def flush() -> None:
        if files:
            ready.extend(_segment(exporter, files, prints, profiles))

    def packed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*ready), schema)], schema=schema)
        ready.clear()
        return out

    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(4)]
        for who, at, file_id, body in zip(*cols):
            if who != exporter:
                flush()
                if len(ready) > 10_000:
                    yield packed()
                exporter, files, prints, known, profiles, last = who, [], [], {}, defaultdict(_Profile), None
            if file_id == last:
                continue  # a repeated row
            last = file_id
            doc = parse_body(body)
            if doc is None:
                continue
            shape: dict[str, tuple] = {}
            for path, v in fields_of(doc):
                profiles[path].add(v)
                kind, old = type_of(v), shape.get(path)
                has_keys = isinstance(v, list) and any(isinstance(x, dict) for x in v)
                shape[path] = (old[0] if old and old[0] else kind, has_keys)
            mark = tuple(sorted((p, k or "", h) for p, (k, h) in shape.items()))
            if mark not in known:
                known[mark] = len(prints)
                prints.append(shape)
            files.append((file_id, at, known[mark]))
    flush()
    if ready:
        yield packed()


def _words(name: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)]


def same_name(a: str, b: str) -> float:
    """Likeness of two field names: 1 for the same words in another style."""
    a, b = a.rsplit("[].", 1)[-1], b.rsplit("[].", 1)[-1]
    x, y = _words(a), _words(b)
    if "".join(x) == "".join(y):
        return 1.0
    shared = len(set(x) & set(y)) / max(1, len(set(x) | set(y)))
    return max(shared, 0.5 * difflib.SequenceMatcher(None, "".join(x), "".join(y)).ratio())


def same_values(a: _Profile, b: _Profile, ta: str | None, tb: str | None) -> float:
    """Likeness of the values of two fields, from their sketches."""
    if ta is None or tb is None or "boolean" in (ta, tb):
        return 0.3 if ta == tb or None in (ta, tb) else 0.0
    x, y = a.least(), b.least()
    if a.high >= a.low and b.high >= b.low and len(x) > 16 and len(y) > 2 and a.whole == b.whole:
        width = max(a.high, b.high) - min(a.low, b.low)
        return max(0.0, min(a.high, b.high) - max(a.low, b.low)) / width if width > 0 else 1.0
    if not x or not y:
        return 0.3
    edge = min([x[-1]] * (len(x) == _FEATURES) + [y[-1]] * (len(y) == _FEATURES) or [np.inf])
    p, q = {h for h in x if h <= edge}, {h for h in y if h <= edge}
    inside = len(p & q) / max(1, min(len(p), len(q)))
    numbers = a.high >= a.low and b.high >= b.low  # few numbers are easily among many others
    return (inside + len(p & q) / max(1, len(p | q))) / 2 if numbers else inside


def _match(added: list[str], removed: list[str], profiles, kinds) -> list[tuple[str, str]]:
    pairs = []
    for r in removed:
        for a in added:
            name, value = same_name(r, a), same_values(profiles[r], profiles[a], kinds.get(r), kinds.get(a))
            if name >= 0.99 or (0.6 * name + value >= 0.75 and value > 0):
                pairs.append((-(0.6 * name + value), r, a))
    out, used = [], set()
    for _, r, a in sorted(pairs):
        if r not in used and a not in used:
            used |= {r, a}
            out.append((r, a))
    return out


_Run = namedtuple("_Run", [x.split()[0] for x in _RUNS.split(", ")])


def walk(rows: list[tuple]) -> list[tuple]:
    """Migration steps and name epochs of one exporter from its runs: (kind, file_id, at, until, change, old, new, type)."""
    by_kind: dict[str, list[_Run]] = defaultdict(list)
    for r in map(_Run._make, rows):
        by_kind[r.kind].append(r)
    segs = sorted(by_kind["files"], key=lambda r: r.seg)
    order = {r.seg: i for i, r in enumerate(segs)}
    start = {i: (r.file_id, r.at) for i, r in enumerate(segs)}
    count = {i: r.n for i, r in enumerate(segs)}
    profiles: dict[str, _Profile] = defaultdict(_Profile)
    for r in by_kind["profile"]:
        p = profiles[r.path]
        for h in r.features or ():
            p.add_hash(h)
        if r.low is not None:
            p.low, p.high, p.whole = min(p.low, r.low), max(p.high, r.high), min(p.whole, r.whole)
    lists: dict[str, dict[int, tuple]] = defaultdict(dict)
    for r in by_kind["list"]:
        lists[r.path][order[r.seg]] = ((order[r.seg], r.i0), (order[r.seg], r.i1), r.file_id, r.at, r.n)
    raw: dict[tuple, list] = defaultdict(list)
    for kind in ("presence", "type"):
        for r in by_kind[kind]:
            raw[kind, r.path].append(((order[r.seg], r.i0), (order[r.seg], r.i1), r.file_id, r.at, r.n, r.val))
    paths = sorted({p for k, p in raw if k == "presence"})
    for path in paths:  # stretches of an exporter in which a field never occurs
        here = {x[0][0] for x in raw["presence", path]}
        owner = path.split("[].", 1)[0] if "[]." in path else None
        for s in count:
            if s not in here:
                if owner is None:
                    raw["presence", path].append(((s, 0), (s, count[s] - 1), *start[s], count[s], "False"))
                elif s in lists[owner]:
                    raw["presence", path].append((*lists[owner][s], "False"))

    @functools.cache
    def lasting(kind: str, path: str) -> list[tuple]:
        """Runs joined over the stretches' borders: (first, last, file, at, n, value); the first one whatever its length."""
        out: list[list] = []
        for x in sorted(raw[kind, path]):
            if out and out[-1][5] == x[5]:
                out[-1][1], out[-1][4] = x[1], out[-1][4] + x[4]
            else:
                out.append(list(x))
        keep: list[list] = []
        for k, x in enumerate(out):
            if k and x[4] < LASTING:
                continue
            keep.append(x)
        return [tuple(x) for x in keep]

    steps, end = [], (1 << 60, 0)

    def toggles(path: str, since, until, state: str | None, silent_start: bool):
        """Lasting switches of presence in [since, until): (pos, file, at, now present); and the state at the end."""
        out = []
        prior = None
        for first, last, file_id, at, n, val in lasting("presence", path):
            if first >= until:
                break
            if last < since:
                prior = val
                continue
            if state is None:
                state = val
            elif val != state and n >= LASTING:
                fresh = silent_start and (prior is None or first == since) and not out
                if not fresh:
                    out.append((first, file_id, at, val == "True"))
                state = val
            prior = val
        return out, state

    def kind_at(path: str, pos) -> str | None:
        held = None
        for first, last, _, _, n, val in lasting("type", path):
            if first > pos and held is not None:
                break
            held = val
            if last >= pos and n >= LASTING:
                break
        return held

    def retypes(path: str, since, until) -> list[tuple]:
        state, out = None, []
        for k, (first, last, file_id, at, n, val) in enumerate(lasting("type", path)):
            if last < since or first >= until:
                continue
            if state is None:
                if n >= LASTING or (k == 0 and since == (0, 0)):
                    state = val
            elif val != state and n >= LASTING:
                out.append((first, file_id, at, val))
                state = val
        return out

    def scope(members: list[str], found: dict[str, list], initial: dict[str, bool], since, until):
        """Changes among fields of one level; epochs of each name as path -> [(from, to, identity, at)]."""
        live = {p: (since, p, 0) for p in members if initial.get(p)}
        epochs, by_pos = [], defaultdict(list)
        for p in members:
            for pos, file_id, at, now in found[p]:
                by_pos[pos].append((p, file_id, at, now))
        for pos in sorted(by_pos):
            added = [x[0] for x in by_pos[pos] if x[3]]
            removed = [x[0] for x in by_pos[pos] if not x[3]]
            _, file_id, at, _ = by_pos[pos][0]
            kinds = {p: kind_at(p, pos) for p in added}
            kinds |= {p: ([v for f, _, _, _, _, v in lasting("type", p) if f < pos] or [None])[-1] for p in removed}
            renamed = _match(added, removed, profiles, kinds)
            for r, a in renamed:
                steps.append(("step", file_id, at, None, "renamed", r, a, kinds.get(a)))
                began, who, began_at = live.pop(r, (since, r, 0))
                epochs.append((r, began, pos, who, began_at, at, a))
                live[a] = (pos, who, at)
            for r in set(removed) - {x for x, _ in renamed}:
                steps.append(("step", file_id, at, None, "removed", r, "", None))
                began, who, began_at = live.pop(r, (since, r, 0))
                epochs.append((r, began, pos, who, began_at, at, None))
            for a in set(added) - {x for _, x in renamed}:
                steps.append(("step", file_id, at, None, "added", "", a, kinds.get(a)))
                live[a] = (pos, a, at)
        epochs += [(p, began, until, who, began_at, None, None) for p, (began, who, began_at) in live.items()]
        return epochs

    top = [p for p in paths if "[]." not in p]
    found, initial = {}, {}
    for p in top:
        runs = lasting("presence", p)
        initial[p] = runs[0][5] == "True"
        found[p], _ = toggles(p, (0, 0), end, runs[0][5], False)
    epochs = scope(top, found, initial, (0, 0), end)
    arrived_by_rename = {(e[6], e[2]): e[0] for e in epochs if e[6]}
    key_state: dict[tuple, dict[str, str]] = {}
    all_epochs = list(epochs)
    arrays = []
    for p, began, until, _who, _, _, _ in epochs:
        changes = retypes(p, began, until)
        for pos, file_id, at, val in changes:
            steps.append(("step", file_id, at, None, "retyped", p, p, val))
        if p not in lists:
            continue
        now = kind_at(p, began) if began != (0, 0) else (lasting("type", p) or [(0, 0, 0, 0, 0, None)])[0][5]
        at = began
        for pos, _, _, val in [*changes, (until, 0, 0, None)]:
            if now == "array":
                arrays.append((at, pos, p))
            at, now = pos, val
    for since, until, p in sorted(arrays):
        keys = [k for k in paths if k.startswith(p + "[].")]
        before = arrived_by_rename.get((p, since))
        carried = key_state.get((before, since), {}) if before else {}
        found, initial = {}, {}
        states = {}
        for k in keys:
            leaf = k.split("[].", 1)[1]
            state = ("True" if carried.get(leaf) == "True" else "False") if carried else None
            if state is None:
                runs = [r for r in lasting("presence", k) if r[1] >= since and r[0] < until]
                steady = [r for r in runs if r[4] >= LASTING] if since != (0, 0) else runs
                state = (steady or runs)[0][5] if runs else "False"
            found[k], states[leaf] = toggles(k, since, until, state, since != (0, 0))
            initial[k] = state == "True"
        key_state[p, until] = states
        all_epochs += scope(keys, found, initial, since, until)
        for k in keys:
            for pos, file_id, at, val in retypes(k, since, until):
                steps.append(("step", file_id, at, None, "retyped", k, k, val))
    # names of one identity lead to the last of them
    final: dict[str, str] = {}
    for e in sorted(all_epochs, key=lambda e: e[1]):
        final[e[3]] = e[0]
    for p, _began, _until, who, began_at, until_at, _ in all_epochs:
        kinds = lasting("type", final[who])
        steps.append(("epoch", None, began_at, until_at, "", p, final[who], kinds[-1][5] if kinds else None))
    return steps


def migration_steps(files: DataFrame, exporter: str, at: str, file_id: str, body: str) -> DataFrame:
    """Changes and epochs of every exporter; ``kind`` is ``step`` or ``epoch`` (see :func:`schema_changes`)."""
    rows = files.select(F.col(exporter).cast("string").alias("exporter"), epoch_us(at).alias("at"), F.col(file_id).cast("bigint").alias("file_id"), F.col(body).cast("string").alias("body"))
    rows = rows.where("exporter is not null and at is not null and file_id is not null")
    ordered = rows.repartitionByRange("exporter", "at").sortWithinPartitions("exporter", "at", "file_id")
    runs = cut_lineage(ordered.mapInArrow(_to_runs, _RUNS))
    # what a name's values look like is learned from all exporters: one sketch per name
    seen = runs.where("kind = 'profile'").withColumn("leaf", F.substring_index("path", "[].", -1))
    ranges = seen.groupBy("leaf").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("whole").alias("whole"))
    least = seen.select("leaf", F.explode("features").alias("h")).distinct()
    least = least.withColumn("r", F.row_number().over(Window.partitionBy("leaf").orderBy("h"))).where(F.col("r") <= _FEATURES)
    sketches = least.groupBy("leaf").agg(F.collect_list("h").alias("features")).join(ranges, "leaf", "full")
    once = seen.groupBy("exporter", "path", "leaf").agg(F.min("seg").alias("seg"))  # one a field, however many stretches it is in
    blank = {c: F.lit(None).cast(runs.schema[c].dataType) for c in ("i0", "i1", "file_id", "at", "n")}
    mine = once.withColumns({"kind": F.lit("profile"), "val": F.lit(""), **blank}).join(sketches, "leaf", "left").select(*runs.columns)
    runs = runs.where("kind <> 'profile'").unionByName(mine)

    return runs.repartition("exporter").sortWithinPartitions("exporter").mapInArrow(_walks, _STEPS)


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Steps of whole exporters, one after the other."""
    names = [x.split()[0] for x in _STEPS.split(", ")]
    schema = pa.schema([(n, pa.int64() if n in ("file_id", "at", "until") else pa.string()) for n in names])
    runs = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
    out: list[tuple] = []
    for who, mine in itertools.groupby(runs, key=lambda r: r[0]):
        out += [(who, *x) for x in walk(list(mine))]
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def schema_changes(files: DataFrame, exporter: str, at: str, file_id: str, body: str) -> DataFrame:
    """(file_id, change, old_field, new_field): every lasting change of an exporter's JSON bodies.

    Per exporter, in the order of ``at``, bodies that are no JSON object are left out and the first one
    is the starting state.  A difference counts as a change, once, at the first file from which it holds
    for three successive files.  Fields are the top-level keys and ``list[].key`` for keys of the
    objects in a top-level array; a field that gives way to another of like name or like values in the
    same file is ``renamed``.  Null has no type; a file in which an array is absent, empty or of another
    type says nothing about its keys.  Keys of an array that is itself added, removed, renamed or
    retyped in a file are not reported there.

    Repeated rows count once (by ``file_id``); rows with a null exporter, time or id are ignored; of two
    files of one time that with the lower id comes first; empty tables give an empty result; other
    columns are ignored.
    """
    steps = migration_steps(files, exporter, at, file_id, body).where("kind = 'step'")
    return steps.select(F.col("file_id").alias(file_id), "change", "old_field", "new_field")


_CELL = T.StructType([T.StructField(n, t) for n, t in (("field", T.StringType()), ("item", T.LongType()), ("value", T.StringType()), ("type", T.StringType()))])


@F.pandas_udf(T.ArrayType(_CELL))
def _cells(body: pd.Series) -> pd.Series:
    def cells(text):
        doc = parse_body(text)
        if doc is None:
            return None
        out = []
        for key, v in doc.items():
            keyed = isinstance(v, list) and any(isinstance(x, dict) for x in v)
            if keyed:
                for i, item in enumerate(v):
                    if isinstance(item, dict):
                        out += [(f"{key}[].{k}", i, x) for k, x in item.items()]
                    else:
                        out.append((key, i, item))
            else:
                out.append((key, None, v))
        return [(f, i, None if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False), type_of(v)) for f, i, v in out]

    return body.map(cells)


# how a JSON text is told apart and brought to a type; a value alone and {"value": it} or [it] stand for each other
def _scalar() -> Column:
    """The one value of a cell as text: of a scalar, of an object with nothing but ``value``, of an array of one; else null."""
    boxed = F.when(F.col("type") == "object", F.when(F.to_json(F.json_object_keys("value")) == '["value"]', F.get_json_object("value", "$.value")))
    single = F.when(F.col("type") == "array", F.when(F.json_array_length("value") == 1, F.get_json_object("value", "$[0]")))
    return F.when(F.col("type").isin("string", "number", "boolean"), F.col("value")).otherwise(F.coalesce(boxed, single))


def _cast_to_target() -> Column:
    """A cell's value as text of its target type (JSON for arrays and objects), null if it cannot be cast."""
    one, kind, goal = F.col("one"), F.col("type"), F.col("target_type")
    low = F.lower(F.trim(one))
    number = F.when(low == "true", 1.0).when(low == "false", 0.0).otherwise(F.trim(one).try_cast("double"))
    truth = F.when(low.isin("true", "1", "1.0", "yes"), "true").when(low.isin("false", "0", "0.0", "no"), "false")
    quoted = F.when(kind.isin("number", "boolean"), F.col("value")).otherwise(F.substring(F.to_json(F.array(one)), F.lit(2), F.length(F.to_json(F.array(one))) - 2))
    return (
        F.when(F.col("value").isNull() | (kind == goal) | goal.isNull(), F.col("value"))
        .when(goal == "number", number.cast("string"))
        .when(goal == "boolean", truth)
        .when(goal == "string", F.coalesce(one, F.col("value")))
        .when(goal == "array", F.concat(F.lit("["), F.when(kind == "object", F.col("value")).otherwise(quoted), F.lit("]")))
        .when((goal == "object") & (kind != "array"), F.concat(F.lit('{"value":'), quoted, F.lit("}")))
        .when(goal == "object", F.concat(F.lit('{"value":'), F.coalesce(F.when(one.isNotNull(), quoted), F.col("value")), F.lit("}")))
    )


def consistent_cells(files: DataFrame, exporter: str, at: str, file_id: str, body: str) -> DataFrame:
    """All bodies as cells: (file_id, exporter, field, item, value, type, written, written_type, written_as, rule).

    Each cell is routed through the chain of renames of its exporter to the field's last name, by the
    epoch its file lies in, and cast to the type that field ended with: ``value`` is text of ``type``
    (JSON for arrays and objects), null where the value is null or no cast gives it.  ``rule`` records
    what happened: ``kept``, ``cast``, ``failed`` (``written`` holds what could not be cast), or
    ``default`` for a top-level field of the exporter's last schema that the file lacks (value null; only
    these have no ``written_as``).  ``written``, ``written_type`` and ``written_as`` are as in the file.
    ``item`` numbers the objects of an array.  A field outside any epoch (of a single odd file) keeps its
    name and type.  Bodies that cannot be parsed have no cells; repeated rows count once; see
    :func:`schema_changes` for the rest.
    """
    return _cells_of(files, _epochs(files, exporter, at, file_id, body), exporter, at, file_id, body)


def _epochs(files: DataFrame, exporter: str, at: str, file_id: str, body: str) -> DataFrame:
    epochs = migration_steps(files, exporter, at, file_id, body).where("kind = 'epoch'")
    return cut_lineage(epochs.select("exporter", F.col("old_field").alias("written_as"), F.col("new_field").alias("name"), F.col("type").alias("target_type"), F.col("at").alias("since"), "until"))


def _cells_of(files: DataFrame, epochs: DataFrame, exporter: str, at: str, file_id: str, body: str) -> DataFrame:
    rows = files.select(F.col(exporter).cast("string").alias("exporter"), epoch_us(at).alias("at"), F.col(file_id).cast("bigint").alias("file_id"), F.col(body).cast("string").alias("body"))
    rows = rows.where("exporter is not null and at is not null and file_id is not null").dropDuplicates(["exporter", "file_id"])
    # the last schema of each exporter, as one more source of cells: its fields with their types
    last = epochs.where("until is null and not contains(name, '[].')").groupBy("exporter").agg(F.collect_set(F.struct(F.col("name").alias("field"), F.col("target_type").alias("type"))).alias("schema"))  # as many as fields
    parsed = rows.select("exporter", "at", "file_id", _cells("body").alias("cells")).where("cells is not null")
    cells = parsed.select("exporter", "at", "file_id", F.explode("cells").alias("c")).select("exporter", "at", "file_id", F.col("c.field").alias("written_as"), "c.item", "c.value", "c.type")
    # epochs of one name do not overlap, so the join keeps one row per cell
    names = ["exporter", "written_as"]
    history = epochs.groupBy(*names).agg(F.collect_set(F.struct("since", "until", "name", "target_type")).alias("epochs"))  # as many as the name's migration steps
    hit = F.filter("epochs", lambda e: (F.col("at") >= e["since"]) & (e["until"].isNull() | (F.col("at") < e["until"])))
    routed = cells.join(history, names, "left").withColumn("e", F.try_element_at(hit, F.lit(1)))
    routed = routed.select("exporter", "file_id", F.coalesce("e.name", "written_as").alias("field"), "item", "value", "type", F.coalesce("e.target_type", "type").alias("target_type"), "written_as")
    routed = routed.withColumn("one", _scalar()).withColumn("to", _cast_to_target())
    rule = F.when(F.col("value").isNull() | (F.col("type") == F.col("target_type")), "kept").when(F.col("to").isNull(), "failed").otherwise("cast")
    out = ("exporter", "file_id", "field", "item", "value", "type", "written", "written_type", "written_as", "rule")
    done = routed.select("exporter", "file_id", "field", "item", F.col("to").alias("value"), F.col("target_type").alias("type"), F.col("value").alias("written"), F.col("type").alias("written_type"), "written_as", rule.alias("rule"))
    # a name and the fields it leads to, to tell which fields of the schema a file lacks without regrouping cells
    led = epochs.groupBy("exporter").agg(F.collect_set(F.struct("since", "until", "written_as", "name")).alias("led"))  # the steps of one exporter
    lacking = parsed.select("exporter", "at", "file_id", F.array_distinct(F.transform("cells", lambda c: F.substring_index(c["field"], "[].", 1))).alias("have")).join(last, "exporter").join(led, "exporter")
    met = F.transform(F.filter("led", lambda e: (F.col("at") >= e["since"]) & (e["until"].isNull() | (F.col("at") < e["until"])) & F.array_contains("have", e["written_as"])), lambda e: e["name"])
    lacking = lacking.withColumn("met", F.concat(met, "have")).select("exporter", "file_id", F.explode(F.filter("schema", lambda f: ~F.array_contains("met", f["field"]))).alias("f"))
    none = F.lit(None).cast("string")
    defaults = lacking.select("exporter", "file_id", "f.field", F.lit(None).cast("bigint").alias("item"), none.alias("value"), "f.type", none.alias("written"), none.alias("written_type"), none.alias("written_as"), F.lit("default").alias("rule"))
    both = done.select(*out).unionByName(defaults)
    return both.select(F.col("file_id").alias(file_id), F.col("exporter").alias(exporter), *out[2:])


_COLUMN_TYPES = {"number": "double", "boolean": "boolean"}


def consistent_table(files: DataFrame, exporter: str, at: str, file_id: str, body: str, defaults: dict[str, str] | None = None) -> DataFrame:
    """All bodies in one table with one typed column per field: (file_id, exporter, fields..., failed, defaulted).

    A field is named by its last name; numbers are doubles, booleans booleans, other values text (JSON
    for arrays and objects of no known keys); an array of objects is an array of structs of its keys, in
    order.  A field that ended with different types at different exporters is text.  Fields that a file
    lacks take the text of ``defaults``, cast to the column's type, else null.  ``failed`` lists the
    fields whose value could not be cast, ``defaulted`` those of the exporter's last schema that the file
    lacks.  The columns are those of the last schemas, in alphabetical order (their names are collected:
    as many as there are fields); what only single odd files have is left to :func:`consistent_cells`.
    """
    epochs = _epochs(files, exporter, at, file_id, body)
    fields: dict[str, set] = defaultdict(set)
    for r in epochs.where("until is null").select("name", "target_type").distinct().collect():
        fields[r.name].add(r.target_type)
    kind = {f: _COLUMN_TYPES.get(next(iter(t)), "string") if len(t) == 1 else "string" for f, t in fields.items()}
    top = sorted(f for f in kind if "[]." not in f)
    lists = {f: sorted(k for k in kind if k.startswith(f + "[].")) for f in top}
    cells = _cells_of(files, epochs, exporter, at, file_id, body).withColumnsRenamed({file_id: "file_id", exporter: "exporter"})
    key = ["exporter", "file_id"]

    def value(f: str) -> Column:
        return F.max(F.when(F.col("field") == f, F.col("value"))).try_cast(kind[f])

    owner = F.substring_index("field", "[].", 1)
    number = {k: f"k{i}" for i, k in enumerate(k for ks in lists.values() for k in ks)}
    items = cells.where("item is not null").groupBy(*key, owner.alias("list"), "item").agg(F.lit(0).alias("_"), *[value(k).alias(n) for k, n in number.items()])

    def objects(f: str, ks: list[str]) -> Column:
        """The objects of a list in order, as structs of their keys."""
        found = F.array_sort(F.collect_list(F.when(F.col("list") == f, F.struct("item", *[F.col(number[k]) for k in ks]))))  # of one file
        return F.transform(found, lambda x: F.struct(*[x[number[k]].alias(k.split("[].", 1)[1]) for k in ks])).alias(f)

    arrays = items.groupBy(*key).agg(*[objects(f, ks) for f, ks in lists.items() if ks]) if any(lists.values()) else None
    plain = [f for f in top if not lists[f]]
    listed = lambda rule: F.array_sort(F.collect_set(F.when(F.col("rule") == rule, F.col("field"))))
    wide = cells.groupBy(*key).agg(*[F.coalesce(value(f), F.lit((defaults or {}).get(f)).try_cast(kind[f])).alias(f) for f in plain], listed("failed").alias("failed"), listed("default").alias("defaulted"))
    wide = wide.join(arrays, key, "left") if arrays is not None else wide
    return wide.select(F.col("file_id").alias(file_id), F.col("exporter").alias(exporter), *[f"`{f}`" for f in top], "failed", "defaulted")
