"""Whole chains: preprocessing, alignment of all keys to a timeline, joined frames, validation, trims."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillframe.operators import asof, clean, quality, timeline


@dataclass
class GapError(Exception):
    """The first gap of a stream that is longer than allowed."""

    key: tuple
    at: int
    gap: int
    count: int
    threshold: int

    def __str__(self) -> str:
        return f"{self.key}: {self.count} gaps over {self.threshold} us, the first after {self.at} of {self.gap} us"


def gap_report(df: DataFrame, keys: list[str], time: str, limit: int) -> DataFrame:
    """(keys, gaps, longest, first_at, first_gap) of keys with a gap over ``limit``."""
    found = clean.gaps(df, keys, time, limit)
    return found.groupBy(*keys).agg(F.count("*").alias("gaps"), F.max("gap").alias("longest"), F.min("gap_start").alias("first_at"), F.min_by("gap", "gap_start").alias("first_gap"))


def require_no_gaps(df: DataFrame, keys: list[str], time: str, limit: int) -> DataFrame:
    """The table itself; raises :class:`GapError` for the first gap over ``limit``."""
    worst = gap_report(df, keys, time, limit).orderBy("first_at", *keys).first()
    if worst is not None:
        raise GapError(tuple(worst[k] for k in keys), worst.first_at, worst.first_gap, worst.gaps, limit)
    return df


def preprocess(df: DataFrame, keys: list[str], time: str, order: str, limit: Column | int | None, gate: int | None = None) -> DataFrame:
    """One row per time of each key (the first in ``order``), gaps over ``limit`` filled with copies (``limit`` null: not filled).

    ``gate`` raises for gaps longer than it.
    """
    once = clean.keep_first(df.where(F.col(time).isNotNull()), [*keys, time], [order])
    if gate is not None:
        require_no_gaps(once, keys, time, gate)
    return once.withColumn("interpolated", F.lit(False)) if limit is None else clean.fill_gaps(once, keys, time, limit)


def main_timeline(df: DataFrame, entity: list[str], key: str, time: str, order: str, wanted: str, priority: list[str], limit: int, drop: int, stride: int) -> DataFrame:
    """(entity, key, t, frame): the timeline of ``wanted`` or, where an entity lacks it, of its busiest key of ``priority``.

    Times are made distinct, gaps filled, ends dropped and the rest strided.
    """
    has = df.where(F.col(key) == wanted).select(*entity).distinct().withColumn("_has", F.lit(True))
    other = timeline.main_key(df, entity, key, priority).withColumnRenamed(key, "_main")
    chosen = df.join(has, entity, "left").join(other, entity, "left").where(F.col(key) == F.when(F.col("_has"), F.lit(wanted)).otherwise(F.col("_main"))).select(*entity, key, time, order)
    kept = timeline.drop_and_stride(preprocess(chosen, [*entity, key], time, order, limit), entity, [time], drop, stride)
    return clean.placed(kept.select(*entity, key, F.col(time).alias("t")), entity, ["t"], "frame")


def align(main: DataFrame, df: DataFrame, entity: list[str], key: str, time: str, order: str, limit: int, slice_width: int | None = clean.SLICE) -> DataFrame:
    """(entity, key, frame, t, near_id, near_t, corrected): every frame of a timeline with the nearest row of each key.

    ``main`` has (entity, frame, t), one row per frame; rows of ``df`` are first made distinct by time.
    Rows further than ``limit`` count as taken at the frame's time (``corrected``).
    """
    once = preprocess(df, [*entity, key], time, order, None)
    frames = main.select(*entity, "frame", "t").join(once.select(*entity, key).distinct(), entity)
    near = asof.nearest_asof(frames, once.withColumnRenamed(time, "t"), [*entity, key], "t", order, "later", slice_width)
    fixed = asof.correct_times(near, "t", limit)
    return fixed.select(*entity, key, "frame", "t", "near_id", F.col("aligned_t").alias("near_t"), "corrected")


def align_strict(df: DataFrame, entity: list[str], key: str, time: str, order: str, priority: list[str], fill: int, drop: int, stride: int, limit: int, least_frames: int = 2) -> DataFrame:
    """The strict profile: fill, choose the timeline, trim to the common end, drop bad starts and bad timelines, align, repair spreads.

    Entities whose timeline fails the quality gate (a step longer than four times the mean, or two equal
    times) or is shorter than ``least_frames`` have no rows.
    """
    filled = preprocess(df, [*entity, key], time, order, fill)
    mains = main_timeline(df, entity, key, time, order, priority[0], priority, fill, drop, stride)
    ends = filled.groupBy(*entity, key).agg(F.max(time).alias("_l")).groupBy(*entity).agg(F.min("_l").alias("_end"))
    mains = mains.join(ends, entity).where("t < _end").drop("_end", key)
    measured = quality.interval_stats(mains, entity, "t").where((F.col("n") >= least_frames) & (F.col("n") == F.col("n_distinct")) & (F.col("max_ms") <= 4 * F.col("mean_ms")))
    mains = mains.join(measured.select(*entity), entity, "left_semi")
    joined = align(mains, filled, entity, key, time, order, limit)
    spread = quality.frame_spread(joined, [*entity, "frame"], key, "near_t")
    offset = timeline.start_offset(spread, entity, "frame", "spread", good=limit).select(*entity, "start")
    kept = joined.join(offset, entity, "left").where(F.col("frame") >= F.coalesce("start", F.lit(0))).drop("start")
    return quality.repair_spread(kept, [*entity, "frame"], "t", "near_t", limit)


def joined_frames(aligned: DataFrame, frame: list[str], key: str, value: str, keys: list[str]) -> DataFrame:
    """One row per frame with a column for each key, null where the frame lacks it."""
    return aligned.groupBy(*frame).agg(*[F.first(F.when(F.col(key) == k, F.col(value)), True).alias(k) for k in keys])


def complete_frames(frames: DataFrame, required: list[str], either: list[list[str]] = ()) -> DataFrame:
    """Frames with all required columns and, of each list in ``either``, at least one."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    for names in either:
        ok = ok & F.coalesce(*[F.col(c).isNotNull() if len(names) == 1 else F.when(F.col(c).isNotNull(), True) for c in names], F.lit(False))
    return frames.where(ok)


def positional_join(a: DataFrame, b: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Rows of ``a`` with the ``columns`` of the row of ``b`` in the same place of its key, null beyond its end."""
    right = clean.placed(b, keys, [order], "place").select(*keys, "place", *columns)
    return clean.placed(a, keys, [order], "place").join(right, [*keys, "place"], "left")


def two_stage_nearest(main: DataFrame, other: DataFrame, keys: list[str], time: str, order: str, chunk: str, pad: int) -> DataFrame:
    """Nearest row by the whole timeline, then the row nearest to its time among those loaded for the main row's chunk.

    A chunk loads what lies between ``pad`` before its first and ``pad`` after its last main row; adds
    near_t and near_id, null where it loads nothing.
    """
    first = asof.nearest_asof(main, other, keys, time, order, "earlier").withColumnRenamed("near_t", "_target").drop("near_id", "delta")
    spans = main.groupBy(*keys, chunk).agg((F.min(time) - pad).alias("_low"), (F.max(time) + pad).alias("_high"))
    loaded = asof.in_windows(other.select(*keys, F.col(time).alias("_target"), order), spans, keys, "_target", "_low", "_high", 4 * pad)
    rest = [c for c in first.columns if c not in (*keys, chunk, "_target")]
    packed = first.select(*keys, chunk, "_target", F.struct(*rest).alias("_main"))
    found = asof.nearest_asof(packed, loaded.select(*keys, chunk, "_target", order), [*keys, chunk], "_target", order, "earlier", None)
    return found.select(*keys, chunk, *[F.col("_main")[c].alias(c) for c in rest], "near_t", "near_id")


def trim_frames(df: DataFrame, keys: list[str], order: list[str], head: Column | int, tail: Column | int) -> DataFrame:
    """Rows without the first ``head`` and the last ``tail`` of each key (columns: a number per key)."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    size = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    rows = clean.placed(df, keys, order, "_i").join(size, keys)
    return rows.where((F.col("_i") >= lit(head)) & (F.col("_i") < F.col("_n") - lit(tail))).drop("_i", "_n")


def static_ends(df: DataFrame, entity: list[str], time: str, values: str, limit: float = 0.1, width: int = 2_000_000, step: int = 1_000_000) -> DataFrame:
    """(entity, head, tail): how long, in microseconds, an entity stands still at its start and at its end.

    Windows of ``width`` slide by ``step`` from the first time on.  One is still if no component moves
    more than ``limit`` inside it; head is where the last of the still windows that follow each other from
    the start ends, tail the same from the end (windows that reach past the last time are no windows).
    """
    span = df.groupBy(*entity).agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
    rel = F.col(time) - F.col("_a")
    last = F.call_function("div", F.col("_b") - F.col("_a") - width, F.lit(step).cast("bigint"))
    rows = df.join(span, entity).where(F.col("_b") - F.col("_a") >= width).withColumn("_m", last)
    first = F.greatest(F.lit(0).cast("bigint"), F.call_function("div", rel - width, F.lit(step).cast("bigint")) + F.when(rel >= width, 1).otherwise(0))
    upto = F.least(F.call_function("div", rel, F.lit(step).cast("bigint")), F.col("_m"))
    placed = rows.where(first <= upto).select(*entity, "_a", "_b", "_m", values, F.explode(F.sequence(first, upto)).alias("_k"))
    moved = placed.select(*entity, "_a", "_b", "_m", "_k", F.posexplode(values).alias("_p", "_x")).groupBy(*entity, "_a", "_b", "_m", "_k", "_p").agg((F.max("_x") - F.min("_x")).alias("_d"))
    still = moved.groupBy(*entity, "_a", "_b", "_m", "_k").agg((F.max("_d") <= limit).alias("_s"))
    ends = still.groupBy(*entity, "_a", "_b", "_m").agg(F.min(F.when(~F.col("_s"), F.col("_k"))).alias("_first"), F.max(F.when(~F.col("_s"), F.col("_k"))).alias("_last"))
    none = F.lit(0).cast("bigint")
    head = F.when(F.col("_first").isNull(), F.col("_b") - F.col("_a")).when(F.col("_first") > 0, (F.col("_first") - 1) * step + width).otherwise(none)
    tail = F.when(F.col("_last").isNull(), F.col("_b") - F.col("_a")).when(F.col("_last") < F.col("_m"), F.col("_b") - F.col("_a") - (F.col("_last") + 1) * step).otherwise(none)
    return ends.select(*entity, head.alias("head"), tail.alias("tail"))


def still_time(diffs: DataFrame, keys: list[str], time: str, diff: str, threshold: float, ratio: float, shortest: int = 2_000_000, step: int = 500_000) -> DataFrame:
    """(keys, still): how long a stream of frame differences stays calm from its start, in microseconds, 0 if not for ``shortest``.

    Windows from the start grow by ``step`` from ``shortest`` on, as long as at least ``ratio`` of their
    differences are at most ``threshold``; those longer than the stream are not tried.
    """
    span = diffs.groupBy(*keys).agg(F.min(time).alias("_a"), (F.max(time) - F.min(time)).alias("_end"))
    rows = diffs.join(span, keys).select(*keys, "_end", (F.col(time) - F.col("_a")).alias("_t"), (F.col(diff) <= threshold).cast("int").alias("_c"))
    # the first window that holds a difference; 0 is the shortest
    bin_ = F.greatest(F.lit(0).cast("bigint"), F.call_function("div", F.col("_t") - shortest + step - 1, F.lit(step).cast("bigint")))
    per = rows.groupBy(*keys, "_end", bin_.alias("_k")).agg(F.sum("_c").alias("_c"), F.count("*").alias("_n"))  # a row per step of time
    run = Window.partitionBy(*keys).orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    share = per.select(*keys, "_k", "_end", (F.sum("_c").over(run) / F.sum("_n").over(run)).alias("_r"))
    most = F.call_function("div", F.col("_end") - shortest, F.lit(step).cast("bigint"))
    good = share.groupBy(*keys, "_end").agg(F.min(F.when(F.col("_r") < ratio, F.col("_k"))).alias("_bad"))
    still = F.when(F.col("_end") < shortest, 0).when(F.col("_bad").isNull() | (F.col("_bad") > most), shortest + most * step).when(F.col("_bad") > 0, shortest + (F.col("_bad") - 1) * step).otherwise(0)
    return good.select(*keys, still.cast("bigint").alias("still"))


def rate_class(df: DataFrame, keys: list[str], time: str, low: float, high: float) -> DataFrame:
    """(keys, action): keep, insert or remove, by the rate of each key; keep where there is none."""
    rate = quality.effective_rate(df, keys, time)
    return rate.select(*keys, F.when(F.col("rate") < low, "insert").when(F.col("rate") > high, "remove").otherwise("keep").alias("action"))


def adjust_rate(df: DataFrame, keys: list[str], time: str, low: float, high: float, least: int) -> DataFrame:
    """(keys, time, action): timelines brought between two rates: midpoints inserted below, frames removed above, the rest kept."""
    rows = df.select(*keys, F.col(time).cast("bigint").alias(time)).join(rate_class(df, keys, time, low, high), keys)
    of = lambda a: rows.where(F.col("action") == a).drop("action")
    more = timeline.insert_frames(of("insert"), keys, time, low, least).drop("inserted")
    less = timeline.remove_frames(of("remove"), keys, time, low)
    parts = [x.withColumn("action", F.lit(a)) for a, x in (("keep", of("keep")), ("insert", more), ("remove", less))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def downsample(df: DataFrame, keys: list[str], order: list[str], target: Column) -> DataFrame:
    """As many rows of each key as ``target`` says (a column of keys and ``_n``, its rows), at evenly spaced places cut to whole numbers."""
    size = df.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_k", F.least(F.greatest(target.cast("bigint"), F.lit(1).cast("bigint")), F.col("_n")))
    spots = size.withColumn("_j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_k") - 1)))
    at = F.when(F.col("_k") == 1, F.lit(0).cast("bigint")).otherwise(F.call_function("div", F.col("_j") * (F.col("_n") - 1), F.col("_k") - 1))
    return clean.placed(df, keys, order, "_i").join(spots.select(*keys, at.alias("_i")).distinct(), [*keys, "_i"]).drop("_i")


def validate_strict(frames: DataFrame, keys: list[str], time: str, spread: str, least_frames: int = 300, least_us: int = 10_000_000, low_fps: float = 29.905, high_fps: float = 30.095, max_ms: float = 40.0, max_spread: int = 20_000) -> DataFrame:
    """(keys, check, value, threshold) of what an aligned episode fails."""
    s = quality.interval_stats(frames, keys, time).join(quality.effective_rate(frames, keys, time), keys)
    s = s.join(frames.groupBy(*keys).agg((F.max(time) - F.min(time)).alias("_us"), F.max(spread).alias("_spread")), keys)
    checks = F.array(*[
        F.struct(F.lit(n).alias("check"), v.cast("double").alias("value"), F.lit(float(t)).alias("threshold"), bad.alias("bad"))
        for n, v, t, bad in (
            ("frames", F.col("n"), least_frames, F.col("n") < least_frames), ("duration", F.col("_us"), least_us, F.col("_us") < least_us), ("rate_low", F.col("rate"), low_fps, F.col("rate") < low_fps),
            ("rate_high", F.col("rate"), high_fps, F.col("rate") > high_fps), ("max_interval", F.col("max_ms"), max_ms, F.col("max_ms") > max_ms), ("spread", F.col("_spread"), max_spread, F.col("_spread") > max_spread),
        )
    ])
    return s.select(*keys, F.explode(checks).alias("c")).where("c.bad").select(*keys, "c.check", "c.value", "c.threshold")


def worst(df: DataFrame, keys: list[str], measure: str, order: list[str], k: int = 3) -> DataFrame:
    """The ``k`` rows of each key with the largest measure (a report)."""
    w = Window.partitionBy(*keys).orderBy(F.col(measure).desc_nulls_last(), *order)
    return df.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)


def random_subset(df: DataFrame, row_id: str, k: int, seed: int) -> DataFrame:
    """``k`` rows without replacement, the same for the same seed (a sampling operator)."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string"))), row_id).limit(k)
