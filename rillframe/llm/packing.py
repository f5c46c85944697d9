"""Texts into containers of fixed capacity, by linear grouping.

A size is a whole number of tokens of at most the capacity, so everything that must be decided
depends on the histogram of sizes, whose length the capacity bounds.  Large sizes are rounded up to
the largest of their group, in groups of equal cardinality; configurations of the few remaining sizes
are optimised by column generation; the actual texts then take the places of their group, and small
texts are best-fitted into the space that is left.  Texts meet their places by (size, rank), in joins;
no text and no container passes through the driver.
"""

from __future__ import annotations

import bisect
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillframe.session import cut_lineage, floor_div

GROUPS = 32
_SHARDS, _IN_SHARD = 64, 500_000  # ranks inside one size are counted in so many parts at least, of so many rows if all have one size


def best_pattern(sizes: np.ndarray, worth: np.ndarray, capacity: int, most: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of at most ``most`` items that fits (unbounded knapsack)."""
    value = np.zeros(capacity + 1)
    choice: list[np.ndarray] = []
    for _ in range(most):
        best, pick = value.copy(), np.full(capacity + 1, -1)
        for g, s in enumerate(sizes):
            if s <= capacity and worth[g] > 0:
                with_g = value[: capacity + 1 - s] + worth[g]
                better = with_g > best[s:] + 1e-12
                best[s:][better], pick[s:][better] = with_g[better], g
        choice.append(pick)
        if np.all(pick < 0):
            break
        value = best
    pattern, room = np.zeros(len(sizes), int), capacity
    for pick in reversed(choice):
        if pick[room] >= 0:
            pattern[pick[room]] += 1
            room -= sizes[pick[room]]
    return float(pattern @ worth), pattern


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns and copies that hold the demanded number of items of each of a few sizes.

    The linear relaxation is solved by column generation; its solution is rounded down and what is
    then missing is packed best-fit, largest first.
    """
    s, d = np.asarray(sizes, int), np.asarray(demand, float)
    n, most = len(s), capacity // int(min(sizes))
    columns = np.diag(capacity // s).astype(float)
    amount = d / np.diag(columns)
    for _ in range(40 * n):
        inverse = np.linalg.inv(columns)
        worth, pattern = best_pattern(s, np.maximum(inverse.sum(axis=0), 0), capacity, most)
        if worth <= 1 + 1e-7:
            break
        step = inverse @ pattern
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        trial = columns.copy()
        trial[:, leave] = pattern
        if abs(np.linalg.det(trial / np.maximum(trial.max(axis=0), 1))) < 1e-14:
            break
        amount = amount - ratio[leave] * step
        amount[leave] = ratio[leave]
        columns = trial
    out, left = [], d.astype(int)
    for j in range(n):
        pattern = columns[:, j].astype(int)
        copies = int(np.floor(amount[j] + 1e-9))
        copies = min([copies, *(int(left[g] // pattern[g]) for g in range(n) if pattern[g])])
        if copies > 0:
            out.append((pattern, copies))
            left = left - pattern * copies
    rest: list[tuple[int, np.ndarray]] = []  # (room, pattern)
    for g in np.argsort(-s):
        for _ in range(int(left[g])):
            fit = min((i for i, (room, _) in enumerate(rest) if room >= s[g]), key=lambda i: rest[i][0], default=None)
            if fit is None:
                rest.append((capacity, np.zeros(n, int)))
                fit = len(rest) - 1
            room, pattern = rest[fit]
            pattern[g] += 1
            rest[fit] = (room - s[g], pattern)
    return out + [(p, 1) for _, p in rest]


def place_large(histogram: dict[int, int], capacity: int, groups: int = GROUPS) -> tuple[list[tuple], int]:
    """Places of large items: rows (size, from, to, segment start, items a container, first container), and the containers used.

    Ranks count the items of all sizes from the largest down; rows are over the ranks [from, to).
    """
    order = sorted(histogram, reverse=True)
    total = sum(histogram.values())
    if not total:
        return [], 0
    groups = min(groups, total)
    cuts = [total * g // groups for g in range(groups + 1)]
    ends = np.cumsum([histogram[x] for x in order])
    biggest = [order[int(np.searchsorted(ends, c, side="right"))] for c in cuts[:-1]]
    plan = configurations(biggest, [b - a for a, b in zip(cuts, cuts[1:])], capacity)
    segments, used, container = [], [0] * groups, 0
    for pattern, copies in plan:
        for g in np.flatnonzero(pattern):
            a = int(pattern[g])
            segments.append((cuts[g] + used[g], a * copies, a, container))
            used[g] += a * copies
        container += copies
    rows = []
    segments.sort()
    at, i = 0, 0
    for x in order:
        low, high = at, at + histogram[x]
        while i < len(segments) and segments[i][0] + segments[i][1] <= low:
            i += 1
        j = i
        while j < len(segments) and segments[j][0] < high:
            start, n, a, first = segments[j]
            rows.append((x, max(low, start), min(high, start + n), start, a, first))
            j += 1
        at = high
    return rows, container


def place_small(histogram: dict[int, int], room: dict[int, int], capacity: int) -> tuple[list[tuple], int]:
    """Best fit, largest first: rows (size, from, to, items a container, class, first rank in it), and the new containers.

    ``room`` counts the containers by free space; a class is a free space before any small item, -1
    for new containers; ranks [from, to) count the items of the size.
    """
    free: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for f, n in room.items():
        if f > 0 and n:
            free[f].append((f, 0, n))
    keys = sorted(free)
    rows, fresh = [], 0

    def give(f: int, part: tuple[int, int, int]) -> None:
        if f > 0 and part[2] > part[1]:
            if not free[f]:
                bisect.insort(keys, f)
            free[f].append(part)

    for size in sorted(histogram, reverse=True):
        n, rank = histogram[size], 0
        while n > 0:
            k = bisect.bisect_left(keys, size)
            if k == len(keys):
                each = capacity // size
                more = -(-n // each)
                give(capacity, (-1, fresh, fresh + more))
                fresh += more
                continue
            f = keys[k]
            origin, a, b = free[f].pop()
            if not free[f]:
                keys.pop(k)
            each = f // size
            take = min(n, (b - a) * each)
            full, rest = divmod(take, each)
            if full:
                rows.append((size, rank, rank + full * each, each, origin, a))
                give(f - each * size, (origin, a, a + full))
            if rest:
                rows.append((size, rank + full * each, rank + take, rest, origin, a + full))
                give(f - rest * size, (origin, a + full, a + full + 1))
            give(f, (origin, a + full + (rest > 0), b))
            rank, n = rank + take, n - take
    return rows, fresh


def _ranked(df: DataFrame, by: str, order: list[str], shards: int) -> DataFrame:
    """Rank (from 0) within ``by``, counted in shards so that one value may hold most of the rows."""
    shard = F.pmod(F.xxhash64(*order), F.lit(shards))
    rows = df.withColumn("_shard", shard)
    counts = rows.groupBy(by, "_shard").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy(by).orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(by, "_shard", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    inner = Window.partitionBy(by, "_shard").orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(inner) - 1).join(offsets, [by, "_shard"]).withColumn("rank", F.col("_r") + F.col("_before")).drop("_shard", "_r", "_before")


def _table(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))  # as many rows as the capacity allows sizes


def pack(items: DataFrame, capacity: int, groups: int = GROUPS, small: float = 1 / 8) -> DataFrame:
    """Containers for the items (doc_id, n_tokens): (container_no, doc_id, piece, first_token, n_tokens).

    An item longer than the capacity is cut into full pieces and a rest, others are never split.
    Items of no tokens, null sizes or null ids take no place; repeated ids are different items only if
    their sizes differ, equal rows count once; an empty table gives an empty result.
    """
    cap = F.lit(int(capacity)).cast("bigint")
    whole = items.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("n_tokens").cast("bigint").alias("size")).where("doc_id is not null and size > 0").distinct()
    cuts = F.explode(F.sequence(F.lit(0).cast("bigint"), floor_div(F.col("size") - 1, cap))).alias("piece")
    pieces = whole.select("doc_id", "size", cuts).select("doc_id", "piece", (F.col("piece") * cap).alias("first_token"), F.least(cap, F.col("size") - F.col("piece") * cap).alias("size"))
    shards = max(_SHARDS, items.count() // _IN_SHARD)
    ranked = cut_lineage(_ranked(pieces, "size", ["doc_id", "piece"], shards))
    histogram = {r["size"]: r["n"] for r in ranked.groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    full = histogram.pop(capacity, 0)
    limit = max(1, int(capacity * small))
    large = {k: n for k, n in histogram.items() if k > limit}
    rows, used = place_large(large, capacity, groups)
    start, at = {}, 0
    for x in sorted(large, reverse=True):
        start[x] = at
        at += large[x]

    def number(expr: Column) -> Column:
        return (expr).cast("bigint").alias("container_no")

    def chosen(plan: DataFrame, rank: Column) -> DataFrame:
        # each size has as many plan rows as segments meet it: an equi-join on the size, then the range
        return ranked.join(plan, "size").where((rank >= F.col("low")) & (rank < F.col("high")))

    cols = ["doc_id", "piece", "first_token", "size"]
    plan = _table(items, [(s, lo, hi, seg, a, first + full, start[s]) for s, lo, hi, seg, a, first in rows], "size bigint, low bigint, high bigint, seg bigint, each bigint, first bigint, start bigint")
    position = F.col("rank") + F.col("start")
    inside = position - F.col("seg")
    big = cut_lineage(chosen(plan, position).select(number(F.col("first") + floor_div(inside, F.col("each"))), *cols))
    rooms = _ranked(big.groupBy("container_no").agg((cap - F.sum("size")).alias("room")), "room", ["container_no"], shards)
    rooms = cut_lineage(rooms)
    free = {r["room"]: r["n"] for r in rooms.groupBy("room").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    tiny = {k: n for k, n in histogram.items() if k <= limit}
    fits, _ = place_small(tiny, free, capacity)
    plan = _table(items, fits, "size bigint, low bigint, high bigint, each bigint, class bigint, first bigint")
    inside = F.col("rank") - F.col("low")
    little = chosen(plan, F.col("rank")).withColumn("nth", F.col("first") + floor_div(inside, F.col("each")))
    new = little.where("class < 0").select(number(F.col("nth") + full + used), *cols)
    known = rooms.select("container_no", F.col("room").alias("class"), F.col("rank").alias("nth"))
    into = little.where("class >= 0").join(known, ["class", "nth"]).select("container_no", *cols)
    entire = ranked.where(F.col("size") == cap).select(number(F.col("rank")), *cols)
    return entire.unionByName(big).unionByName(new).unionByName(into).withColumnRenamed("size", "n_tokens")


def fill_report(packed: DataFrame, capacity: int) -> DataFrame:
    """(containers, tokens, least_containers, fill): what was used, and the least any packing needs; fill is null without containers."""
    per = packed.groupBy("container_no").agg(F.sum("n_tokens").alias("t"))
    total = per.agg(F.count("*").alias("containers"), F.coalesce(F.sum("t"), F.lit(0)).alias("tokens"))
    return total.select("containers", "tokens", F.ceil(F.col("tokens") / capacity).alias("least_containers"), F.round(F.try_divide(F.col("tokens"), F.col("containers") * capacity), 6).alias("fill"))
