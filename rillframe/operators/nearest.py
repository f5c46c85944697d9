"""Nearest record in time of the same entity, by a streaming two-pointer merge.

Both tables are repartitioned by (entity, time slice) and sorted inside the partitions; one iterator
per partition then walks over them and holds only the neighbouring right record and the left records
that still wait for a later one (never more than a tolerance's worth).  Slices split an entity that
holds most of the rows; right records near a border are sent to both sides of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillframe.session import floor_div

_NONE = np.int64(-(1 << 62))


def merge_nearest(group: np.ndarray, t: np.ndarray, right: np.ndarray, value: np.ndarray, tolerance: int):
    """For each left row of a sorted run: (has partner, partner's value); ties go to the later record.

    ``group`` is non-decreasing, ``t`` sorted within a group, ``right`` marks right rows.  Of right
    rows with equal time the one with the larger value is taken.
    """
    n = len(t)
    at = np.arange(n)
    prev = np.maximum.accumulate(np.where(right, at, -1))
    nxt = np.minimum.accumulate(np.where(right, at, n)[::-1])[::-1]
    start = np.r_[True, group[1:] != group[:-1]]
    first = np.maximum.accumulate(np.where(start, at, 0))
    stop = np.r_[start[1:], True]
    last = np.minimum.accumulate(np.where(stop, at, n)[::-1])[::-1]
    p, q = np.where(prev >= first, prev, -1), np.where(nxt <= last, nxt, -1)
    # the last right row of a run of equal times has the largest value: move q to the end of its run
    run_end = np.where(np.r_[(t[1:] != t[:-1]) | (group[1:] != group[:-1]) | ~right[1:], True], at, n)
    run_end = np.minimum.accumulate(run_end[::-1])[::-1]
    q = np.where(q >= 0, run_end[np.maximum(q, 0)], -1)
    far = np.int64(1 << 62)
    before = np.where(p >= 0, t - t[np.maximum(p, 0)], far)
    after = np.where(q >= 0, t[np.maximum(q, 0)] - t, far)
    pick = np.where(after <= before, q, p)
    found = ~right & (np.minimum(before, after) <= tolerance)
    return found, value[np.maximum(pick, 0)]


def _iterator(tolerance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        seen = 0  # rows at the front of held that were already answered and only serve as neighbours
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if not len(rows):
                continue
            held = rows if held is None else pa.concat_tables([held, rows])
            t = held["t"].to_numpy()
            group, right = groups(held), held["is_right"].to_numpy(zero_copy_only=False).astype(bool)
            # answered: left rows with a right row or more than the tolerance of time behind them
            tail = group == group[-1]
            open_ = tail & ((t > t[-1] - tolerance - 1) | ((np.arange(len(t)) == len(t) - 1)))
            cut = int(np.flatnonzero(open_)[0])
            out = answer(held, group, t, right, seen, cut)
            if out is not None:
                yield out
            keep = np.flatnonzero(right[:cut] & tail[:cut])
            front = keep[-1] if len(keep) else cut  # the neighbour before the open rows
            held = pa.concat_tables([held.slice(front, 1), held.slice(cut)]) if front < cut else held.slice(cut)
            seen = 1 if front < cut else 0
        if held is not None and len(held) > seen:
            out = answer(held, groups(held), held["t"].to_numpy(), held["is_right"].to_numpy(zero_copy_only=False).astype(bool), seen, len(held))
            if out is not None:
                yield out

    def groups(rows: pa.Table) -> np.ndarray:
        code = rows["entity"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        part = rows["slice"].to_numpy()
        return np.cumsum(np.r_[0, (code[1:] != code[:-1]) | (part[1:] != part[:-1])]).astype(np.int64)

    def answer(rows, group, t, right, seen, cut) -> pa.RecordBatch | None:
        found, value = merge_nearest(group, t, right, rows["seq"].to_numpy(zero_copy_only=False), tolerance)
        found[:seen] = False
        found[cut:] = False
        # repeated left rows are adjacent, and rows of one time are always answered together
        l1, l2 = (rows[c].combine_chunks() for c in ("l1", "l2"))
        code = l1.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        number, null = l2.fill_null(0).to_numpy(zero_copy_only=False), l2.is_null().to_numpy(zero_copy_only=False)
        found[1:] &= ~(
            (group[1:] == group[:-1]) & (t[1:] == t[:-1]) & ~right[:-1]
            & (code[1:] == code[:-1]) & (number[1:] == number[:-1]) & (null[1:] == null[:-1])
        )
        at = np.flatnonzero(found)
        if not len(at):
            return None
        left = rows.select(["entity", "l1", "l2"]).take(pa.array(at)).combine_chunks()
        return pa.RecordBatch.from_arrays([*(left[c].combine_chunks() for c in ("entity", "l1", "l2")), pa.array(value[at].astype(np.int64))], names=["entity", "l1", "l2", "seq"])

    return run


def nearest_within(
    left: DataFrame, right: DataFrame, entity: str, left_time: str, left_id: tuple[str, str],
    right_time: str, right_seq: str, tolerance: int, slice_width: int = 60_000_000,
) -> DataFrame:
    """Pair each left record with the right record of its entity that is nearest in time.

    Times are integers; a pair may be at most ``tolerance`` apart.  Of two equally near records the
    later is taken, of records with one time that with the highest ``right_seq`` (an integer).
    ``left_id`` names the two columns (string, integer) that identify a left record.  Out come
    (entity, left_id..., right_seq), one row per left record that has a partner; repeated left rows
    count once, repeated right rows make no difference.  Rows with a null entity or time take no part
    (nor right rows with a null sequence number); a null in ``left_id`` is kept as it is.  Other
    columns are ignored, and an empty side gives an empty result.
    """
    a, b = left_id
    width, tol = F.lit(slice_width).cast("bigint"), F.lit(tolerance).cast("bigint")
    lefts = left.select(
        F.col(entity).alias("entity"), F.col(left_time).cast("bigint").alias("t"), F.col(a).cast("string").alias("l1"), F.col(b).cast("bigint").alias("l2")
    ).where("entity is not null and t is not null")
    lefts = lefts.select("entity", floor_div(F.col("t"), width).alias("slice"), "t", F.lit(False).alias("is_right"), F.lit(0).cast("bigint").alias("seq"), "l1", "l2")
    rights = right.select(
        F.col(entity).alias("entity"), F.col(right_time).cast("bigint").alias("t"), F.col(right_seq).cast("bigint").alias("seq")
    ).where("entity is not null and t is not null and seq is not null")
    near = F.explode(F.sequence(floor_div(F.col("t") - tol, width), floor_div(F.col("t") + tol, width)))
    rights = rights.select(
        "entity", near.alias("slice"), "t", F.lit(True).alias("is_right"), "seq", F.lit(None).cast("string").alias("l1"), F.lit(None).cast("bigint").alias("l2")
    )
    both = lefts.unionByName(rights).repartition("entity", "slice").sortWithinPartitions("entity", "slice", "t", "is_right", "seq", "l1", "l2")
    kind = left.schema[entity].dataType.simpleString()
    pairs = both.mapInArrow(_iterator(tolerance), f"entity {kind}, l1 string, l2 bigint, seq bigint")
    return pairs.select(F.col("entity").alias(entity), F.col("l1").alias(a), F.col("l2").alias(b), F.col("seq").alias(right_seq))
