"""Master timelines: choice, thinning, batches, and repair of the frame rate."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillframe.operators.clean import placed, with_next


def drop_and_stride(df: DataFrame, keys: list[str], order: list[str], drop: int, stride: int) -> DataFrame:
    """Rows without the first and last ``drop`` of each key, every ``stride``-th of the rest."""
    size = df.groupBy(*keys).agg(F.count("*").alias("_size"))
    rn = placed(df, keys, order, "_i").join(size, keys)
    return rn.where((F.col("_i") >= drop) & (F.col("_i") < F.col("_size") - drop) & ((F.col("_i") - drop) % stride == 0)).drop("_i", "_size")


def main_key(df: DataFrame, entity: list[str], key: str, priority: list[str]) -> DataFrame:
    """(entity, key): the key with most messages, ties to the first in ``priority``."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col(key))
    counts = df.where(rank > 0).groupBy(*entity, key).agg(F.count("*").alias("_n"))
    return counts.groupBy(*entity).agg(F.max_by(key, F.struct(F.col("_n"), -rank)).alias(key))


def insert_frames(df: DataFrame, keys: list[str], time: str, rate: float, least: int) -> DataFrame:
    """Timeline with midpoints inserted into its largest intervals until it has int(span * rate) frames.

    Repeatedly halving the largest interval above ``least`` (ties to the leftmost) is the same as
    taking the N largest of the sub-intervals g / 2**j, so no loop is needed.  Times in microseconds.
    Only the N largest intervals can be among them, and of the r-th largest no more than N - r + 1 parts.
    """
    rows = with_next(df.select(*keys, F.col(time).cast("bigint").alias("t")), keys, "t", "g").withColumn("g", F.col("g") - F.col("t"))
    need = rows.groupBy(*keys).agg(((F.max("t") - F.min("t")) / 1e6 * rate).cast("bigint").alias("target"), F.count("*").alias("have"))
    short = need.where("target > have").withColumn("want", F.col("target") - F.col("have"))
    large = rows.where(F.col("g") > least).withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("g").desc(), F.col("t")))).join(short.select(*keys, "want"), keys).where("r <= want")
    depth = F.greatest(F.lit(0), F.least(F.ceil(F.log2(F.col("g") / F.lit(float(least)))), F.floor(F.log2(F.col("want") - F.col("r") + 1))).cast("int"))
    levels = large.withColumn("j", F.explode(F.sequence(F.lit(0), depth)))
    size = F.col("g") / F.pow(F.lit(2.0), F.col("j"))
    parts = levels.withColumn("size", size).where(F.col("size") > least)
    parts = parts.withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.pow(F.lit(2.0), F.col("j")).cast("bigint") - 1)))
    parts = parts.withColumn("at", F.col("t") + F.col("i") * F.col("size"))
    best = Window.partitionBy(*keys).orderBy(F.col("size").desc(), F.col("at"))
    chosen = parts.withColumn("n", F.row_number().over(best)).join(need, keys).where(F.col("n") <= F.col("target") - F.col("have"))
    added = chosen.select(*keys, (F.col("at") + F.col("size") / 2).cast("bigint").alias(time), F.lit(True).alias("inserted"))
    return df.select(*keys, F.col(time).cast("bigint").alias(time), F.lit(False).alias("inserted")).unionByName(added)


def thin_timeline(t: np.ndarray, target: int, windows: tuple[int, ...] = (5, 7, 9, 11, 13, 15)) -> np.ndarray:
    """Times with frames removed one by one until ``target`` are left, the rest of a window re-spaced evenly.

    The victim is the centre of the odd window with the best score: largest interval, plus twice the
    spread of the intervals, minus their mean, all after removal; the smallest score wins, ties to the
    shorter and then the earlier window.  Where the timeline is shorter than all windows, one of three
    frames is used; the first and the last frame stay.
    """
    t = np.sort(np.asarray(t, float))
    while len(t) > max(target, 2):
        best = None
        for size in [w for w in windows if w <= len(t)] or [3]:
            starts = np.arange(len(t) - size + 1)
            step = (t[starts + size - 1] - t[starts]) / (size - 2)
            edge = np.maximum(np.r_[0, t[1:] - t[:-1]][starts], np.r_[t[1:] - t[:-1], 0][starts + size - 1])
            score = np.maximum(step, edge) - step  # even spacing has no spread inside
            k = int(np.argmin(score))
            if best is None or score[k] < best[0] - 1e-9:
                best = (score[k], k, size)
        _, a, size = best
        t = np.r_[t[:a], np.linspace(t[a], t[a + size - 1], size - 1), t[a + size :]]
    return np.rint(t).astype(np.int64)


def remove_frames(df: DataFrame, keys: list[str], time: str, rate: float) -> DataFrame:
    """Timelines thinned to int(span * rate) frames, evenly where frames were removed (sequential, one key a task)."""
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in keys) + f", {time} bigint"

    def thin(pdf: pd.DataFrame) -> pd.DataFrame:
        t = pdf[time].dropna().to_numpy(float)
        if not len(t):
            return pdf.head(0)[[*keys, time]]
        out = thin_timeline(t, int((t.max() - t.min()) / 1e6 * rate))
        return pd.DataFrame({c: [pdf[c].iloc[0]] * len(out) for c in keys} | {time: out})

    return df.select(*keys, F.col(time).cast("bigint").alias(time)).groupBy(*keys).applyInPandas(thin, schema)


def batches(df: DataFrame, frame: str, size: int) -> DataFrame:
    return df.withColumn("batch", F.call_function("div", F.col(frame), F.lit(size).cast("bigint")))


def stitch(df: DataFrame, keys: list[str], batch: str, frame: str, rel: str, period: float) -> DataFrame:
    """Frames of successive batches as one sequence: numbers and relative times are shifted by all earlier batches."""
    sizes = df.groupBy(*keys, batch).agg(F.count("*").alias("_n"), (F.max(rel) + F.lit(period)).alias("_len"))
    before = Window.partitionBy(*keys).orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    offset = sizes.select(*keys, batch, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_f"), F.coalesce(F.sum("_len").over(before), F.lit(0.0)).alias("_t"))
    joined = df.join(offset, [*keys, batch])
    return joined.withColumn(frame, (F.col(frame) + F.col("_f")).cast("bigint")).withColumn(rel, F.col(rel) + F.col("_t")).drop("_f", "_t")


def shift_batches(df: DataFrame, keys: list[str], batch: str, time: str, low: int = 25_000, high: int = 99_000, gap: int = 33_000) -> DataFrame:
    """Batches moved so that the step from one to the next is ``gap`` where it was outside [low, high].

    Each batch is kept rigid; its shift depends on the shifted one before, so batches (not rows) are
    walked in order, per key, from one summary row each.
    """
    spans = df.groupBy(*keys, batch).agg(F.min(time).alias("a"), F.max(time).alias("b"))
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in [*keys, batch]) + ", _shift bigint"

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(batch)
        shift, end = [], None
        for a, b in zip(pdf["a"], pdf["b"]):
            move = 0 if end is None or low <= a - end <= high else end + gap - a
            shift.append(int(move))
            end = b + move
        return pdf[[*keys, batch]].assign(_shift=shift)

    moved = spans.groupBy(*keys).applyInPandas(walk, schema)
    return df.join(moved, [*keys, batch]).withColumn(time, F.col(time) + F.col("_shift")).drop("_shift")


def start_offset(df: DataFrame, entity: list[str], frame: str, spread: str, probe: int = 5, tries: int = 20, good: int = 20_000) -> DataFrame:
    """(entity, start, worst): the first of at most ``tries`` starts whose next ``probe`` frames spread at most ``good``, else the best."""
    head = df.where(F.col(frame) < tries + probe)
    starts = head.select(*entity, F.col(spread).alias("_v"), F.explode(F.sequence(F.greatest(F.lit(0).cast("bigint"), F.col(frame) - probe + 1), F.col(frame))).alias("start")).where(F.col("start") < tries)
    worst = starts.groupBy(*entity, "start").agg(F.max("_v").alias("worst"), F.count("*").alias("n")).where(F.col("n") == probe)
    pick = F.min_by(F.struct("start", "worst"), F.struct(F.when(F.col("worst") <= good, 0).otherwise(F.col("worst")), F.col("start")))
    return worst.groupBy(*entity).agg(pick.alias("p")).select(*entity, "p.start", "p.worst")


def repair_stuck_prefix(df: DataFrame, entity: list[str], frame: str, main_t: str, t: str, tolerance: int, most: int = 50) -> DataFrame:
    """Times before the first frame within ``tolerance`` of the timeline are set to the timeline (``most`` frames if there is none)."""
    first = df.groupBy(*entity).agg(F.min(F.when(F.abs(F.col(t) - F.col(main_t)) <= tolerance, F.col(frame))).alias("_first"))
    stuck = F.col(frame) < F.coalesce("_first", F.lit(most))
    return df.join(first, entity).withColumn("repaired", stuck).withColumn(t, F.when(stuck, F.col(main_t)).otherwise(F.col(t))).drop("_first")
