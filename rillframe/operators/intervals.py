"""Continuous periods and gaps of overlapping integer intervals, by dyadic blocks.

The line is cut into cells of 2**cell_bits positions, and those into upper cells of as many cells.  An
interval becomes at most two pieces inside cells and a run of whole cells, so its length costs nothing.
Pieces are decomposed inside their cell, and runs inside their upper cell, into canonical dyadic blocks
(at most two a level).  Blocks that an ancestor covers are dropped (cells that a run of whole cells
covers, with all their pieces), sibling pairs are merged upward level by level, and adjacent blocks are
coalesced.  A cell is the unit of work: a key that holds most of the rows is spread over its cells, and a
cell never holds more than 2**cell_bits distinct pieces however many rows it gets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillframe.session import cut_lineage, floor_div

_STRETCH = "k string, cell bigint, s bigint, e bigint, is_first boolean, is_last boolean, next_s bigint"


def dyadic_blocks(lo: np.ndarray, hi: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(interval, level, start) of the canonical dyadic blocks of the intervals [lo, hi) inside a cell."""
    which, level, at = [], [], []

    def add(rows: np.ndarray, lvl: int, start: np.ndarray) -> None:
        which.append(rows), level.append(np.full(len(rows), lvl, np.int64)), at.append(start)

    whole = (lo == 0) & (hi == 1 << bits)
    add(np.flatnonzero(whole), bits, lo[whole])
    for lvl in range(bits):
        left, right = (lo + (1 << lvl) - 1) >> lvl, hi >> lvl
        part = ~whole & (left < right)
        a, b = np.flatnonzero(part & (left & 1 == 1)), np.flatnonzero(part & (right & 1 == 1))
        add(a, lvl, left[a] << lvl), add(b, lvl, (right[b] - 1) << lvl)
    return np.concatenate(which), np.concatenate(level), np.concatenate(at)


def canonical_stretches(group: np.ndarray, lvl: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coalesced stretches (group, start, end) of dyadic blocks sorted by (group, at, -lvl)."""
    end = at + (np.int64(1) << lvl)
    # an earlier block of the same group that reaches at least as far is an ancestor (or a copy)
    span = np.int64(1) << (bits + 1)
    reach = np.maximum.accumulate(group * span + end)
    covered = np.zeros(len(at), bool)
    covered[1:] = reach[:-1] >= group[1:] * span + end[1:]
    group, lvl, at = group[~covered], lvl[~covered], at[~covered]
    for level in range(bits):  # merge sibling pairs upward
        if len(at) < 2:
            break
        size = np.int64(1) << level
        pair = (
            (group[1:] == group[:-1]) & (lvl[1:] == level) & (lvl[:-1] == level)
            & (at[:-1] % (2 * size) == 0) & (at[1:] == at[:-1] + size)
        )
        if pair.any():
            lvl = lvl.copy()
            lvl[:-1][pair] += 1
            keep = np.r_[True, ~pair]
            group, lvl, at = group[keep], lvl[keep], at[keep]
    end = at + (np.int64(1) << lvl)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (group[1:] != group[:-1]) | (at[1:] != end[:-1])
    first = np.flatnonzero(fresh)
    return group[first], at[first], end[np.r_[first[1:] - 1, len(at) - 1]] if len(at) else at


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole (k, cell) groups: rows of the last one wait for the next batch."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        last = len(held) - 1
        if last < 0:
            continue
        same = pa.compute.and_(pa.compute.equal(held["k"], held["k"][last]), pa.compute.equal(held["cell"], held["cell"][last]))
        done = int(np.flatnonzero(~np.asarray(same.to_numpy(zero_copy_only=False), bool))[-1] + 1) if not pa.compute.all(same).as_py() else 0
        if done:
            yield held.slice(0, done)
            held = held.slice(done)
    if held is not None and len(held):
        yield held


def _grouped(rows: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, cells, the number of the group of each row, and the first row of each group."""
    key = rows["k"].combine_chunks()
    code, cell = key.dictionary_encode().indices.to_numpy(zero_copy_only=False), rows["cell"].to_numpy()
    change = np.r_[False, (code[1:] != code[:-1]) | (cell[1:] != cell[:-1])]
    return key, cell, np.cumsum(change).astype(np.int64), np.flatnonzero(np.r_[True, change[1:]])


def _blocks_in_order(rows: pa.Table, group: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    which, lvl, at = dyadic_blocks(rows["lo"].to_numpy(), rows["hi"].to_numpy(), bits)
    order = np.lexsort((-lvl, at, group[which]))
    return group[which[order]], lvl[order], at[order]


def _stretches(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches):
            key, cell, group, head = _grouped(rows)
            g, s, e = canonical_stretches(*_blocks_in_order(rows, group, bits), bits)
            first = np.r_[True, g[1:] != g[:-1]]
            last = np.r_[first[1:], True]
            base = cell[head][g] << bits
            follow = np.r_[s[1:], 0] + base
            yield pa.RecordBatch.from_arrays(
                [
                    key.take(pa.array(head[g])), pa.array(cell[head][g]), pa.array(s + base), pa.array(e + base),
                    pa.array(first), pa.array(last), pa.array(follow, mask=last),
                ],
                names=["k", "cell", "s", "e", "is_first", "is_last", "next_s"],
            )

    return run


_UPPER = "k string, free boolean, s bigint, e bigint"


def _upper(bits: int):
    """Of upper cells: the stretches of whole cells, and the marked cells that none of them covers, in numbers of cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches):
            key, cell, group, head = _grouped(rows)
            mark = rows["mark"].to_numpy(zero_copy_only=False).astype(bool)
            whole = rows.filter(pa.array(~mark))
            g, lvl, at = _blocks_in_order(whole, group[~mark], bits)
            base = cell[head] << bits
            if len(g):
                sg, s, e = canonical_stretches(g, lvl, at, bits)
                yield pa.RecordBatch.from_arrays([key.take(pa.array(head[sg])), pa.array(np.zeros(len(sg), bool)), pa.array(s + base[sg]), pa.array(e + base[sg])], names=["k", "free", "s", "e"])
            # a marked cell is a block of the lowest level; an ancestor covers it if it begins before and ends behind
            mg, m = group[mark], rows["lo"].to_numpy()[mark]
            span = np.int64(1) << (bits + 1)
            reach = np.maximum.accumulate(g * span + at + (np.int64(1) << lvl)) if len(g) else g
            before = np.searchsorted(g * span + at, mg * span + m, side="right") - 1
            covered = (before >= 0) & (reach[np.maximum(before, 0)] > mg * span + m) if len(g) else np.zeros(len(m), bool)
            mg, m = mg[~covered], m[~covered]
            if len(m):
                at_cell = m + base[mg]
                yield pa.RecordBatch.from_arrays([key.take(pa.array(head[mg])), pa.array(np.ones(len(m), bool)), pa.array(at_cell), pa.array(at_cell + 1)], names=["k", "free", "s", "e"])

    return run


def _links(group: str) -> tuple[Column, Column, Column]:
    """Whether a stretch is the first or the last of its (k, group), and where the next one starts."""
    w = Window.partitionBy("k", group).orderBy("s")
    return F.lag("s").over(w).isNull(), F.lead("s").over(w).isNull(), F.lead("s").over(w)


def _joined(stretches: DataFrame, group: str) -> DataFrame:
    """Stretches of each (k, group) with adjacent ones coalesced, and their links.

    ``tail`` says that a stretch was the last of its part of the group; the others' gaps are known already.
    """
    w = Window.partitionBy("k", group).orderBy("s")
    fresh = F.when(F.col("s") == F.lag("e").over(w), 0).otherwise(1)
    runs = stretches.select("k", group, "s", "e", "tail", fresh.alias("fresh")).withColumn("run", F.sum("fresh").over(w))
    runs = runs.groupBy("k", group, "run").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.max_by("tail", "e").alias("tail"))
    first, last, after = _links(group)
    return runs.select("k", group, "s", "e", first.alias("is_first"), last.alias("is_last"), F.when(F.col("tail"), after).alias("next_s"))


def _settled(parts: DataFrame, outer_too: bool = False) -> DataFrame:
    """(k, kind, s, e): stretches that meet nothing outside their group, and the gaps behind stretches."""
    done = F.lit(True) if outer_too else ~F.col("is_first") & ~F.col("is_last")
    kinds = F.array(
        F.when(done, F.struct(F.lit("period").alias("kind"), F.col("s").alias("s"), F.col("e").alias("e"))),
        F.when(F.col("next_s") > F.col("e"), F.struct(F.lit("gap").alias("kind"), F.col("e").alias("s"), F.col("next_s").alias("e"))),
    )
    return parts.select("k", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("r")).select("k", "r.*")


def periods_and_gaps(df: DataFrame, key: str, start: str, end: str, cell_bits: int = 16) -> DataFrame:
    """Periods that the intervals [start, end) of each key cover, and the gaps between them.

    ``start`` and ``end`` are integer columns; out come rows (key, kind, start, end) with kind
    ``period`` or ``gap``.  Touching intervals belong together.  Rows with a null key or bound, and
    empty or reversed intervals, are ignored; repeated rows and other columns make no difference; an
    empty table gives an empty result.  Intervals of any length are two pieces and a run of whole cells;
    the run is copied once for each upper cell, of 2**(2 * cell_bits) positions, that it crosses.

    Pieces are exchanged before they are decomposed.  Cells of one key meet only at their outer stretches,
    two rows a cell however many rows it had, and these in ranges of the line, of which two rows each are
    left for the key as a whole.
    """
    bits = F.lit(1 << cell_bits).cast("bigint")
    rows = df.select(F.col(key).cast("string").alias("k"), F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e")).where("k is not null and s < e")
    first, last = floor_div(F.col("s"), bits), floor_div(F.col("e") - 1, bits)
    rows = rows.withColumns({"a": first, "b": last}).withColumns({"lo": F.col("s") - F.col("a") * bits, "hi": F.col("e") - F.col("b") * bits})
    alone, piece = F.col("a") == F.col("b"), lambda c, lo, hi: F.struct(c.alias("cell"), lo.alias("lo"), hi.alias("hi"))
    zero = F.lit(0).cast("bigint")
    parts = F.array(
        F.when(alone & ((F.col("lo") > 0) | (F.col("hi") < bits)), piece(F.col("a"), F.col("lo"), F.col("hi"))),
        F.when(~alone & (F.col("lo") > 0), piece(F.col("a"), F.col("lo"), bits)), F.when(~alone & (F.col("hi") < bits), piece(F.col("b"), zero, F.col("hi"))),
    )
    cut = rows.select("k", F.explode(F.filter(parts, lambda x: x.isNotNull())).alias("p")).select("k", "p.*")
    # of pieces with one start the longest, chosen before the exchange
    pieces = cut.groupBy("k", "cell", "lo").agg(F.max("hi").alias("hi"))

    # runs of whole cells, in upper cells, together with the cells that hold pieces
    runs = rows.select("k", F.when(F.col("lo") > 0, F.col("a") + 1).otherwise(F.col("a")).alias("u"), F.when(F.col("hi") < bits, F.col("b")).otherwise(F.col("b") + 1).alias("v")).where("u < v")
    over = runs.select("k", "u", "v", F.explode(F.sequence(floor_div(F.col("u"), bits), floor_div(F.col("v") - 1, bits))).alias("cell"))
    base = F.col("cell") * bits
    over = over.select("k", "cell", (F.greatest("u", base) - base).alias("lo"), (F.least("v", base + bits) - base).alias("hi"), F.lit(False).alias("mark"))
    over = over.groupBy("k", "cell", "lo", "mark").agg(F.max("hi").alias("hi"))
    marks = pieces.where("hi > 0").select("k", "cell").distinct().withColumn("c", floor_div(F.col("cell"), bits))
    marks = marks.select("k", F.col("c").alias("cell"), (F.col("cell") - F.col("c") * bits).alias("lo"), F.lit(True).alias("mark"), (F.col("cell") - F.col("c") * bits + 1).alias("hi"))
    # each step is written once: it has several uses, and the last ones are other jobs
    upper = cut_lineage(over.unionByName(marks).repartition("k", "cell").sortWithinPartitions("k", "cell").mapInArrow(_upper(cell_bits), _UPPER))
    free = upper.where("free").select("k", F.col("s").alias("cell"))
    inner = cut_lineage(pieces.join(free, ["k", "cell"], "left_semi").repartition("k", "cell").sortWithinPartitions("k", "cell").mapInArrow(_stretches(cell_bits), _STRETCH))

    # what may touch stretches of other cells, in ranges of the line, which stay as they are once written
    edges = inner.where("is_first or is_last").select("k", "s", "e", F.col("is_last").alias("tail"))
    covered = upper.where("not free").select("k", (F.col("s") * bits).alias("s"), (F.col("e") * bits).alias("e"), F.lit(True).alias("tail"))
    outer = cut_lineage(edges.unionByName(covered).repartitionByRange("k", "s").withColumn("part", F.spark_partition_id()))
    wide = _joined(outer, "part")
    rest = wide.where("is_first or is_last").select("k", F.lit(0).alias("all"), "s", "e", F.col("is_last").alias("tail"))
    out = _settled(inner).unionByName(_settled(wide.drop("part"))).unionByName(_settled(_joined(rest, "all"), outer_too=True))
    return out.select(F.col("k").alias(key), "kind", F.col("s").alias(start), F.col("e").alias(end))
