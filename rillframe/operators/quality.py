"""Quality of timelines and alignments, as tables of measures and of violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def interval_stats(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    """(keys, n, n_distinct, min_ms, max_ms, mean_ms, std_ms) of the steps between successive times.

    The mean is the whole range over the number of steps, the same without the errors of a sum.
    """
    w = Window.partitionBy(*keys).orderBy(time)
    step = ((F.col(time) - F.lag(time).over(w)) / 1000.0).alias("_step")
    return df.select(*keys, time, step).groupBy(*keys).agg(
        F.count(time).alias("n"), F.countDistinct(time).alias("n_distinct"), F.min("_step").alias("min_ms"), F.max("_step").alias("max_ms"), ((F.max(time) - F.min(time)) / F.nullif(F.count(time) - 1, F.lit(0)) / 1000.0).alias("mean_ms"), F.stddev_pop("_step").alias("std_ms")
    )


def timeline_violations(df: DataFrame, keys: list[str], time: str, max_ms: float = 40.0, min_ms: float = 0.1, std_ms: float = 15.0, low_fps: float = 29.905, high_fps: float = 30.095) -> DataFrame:
    """(keys, check, value, threshold): the strict checks a timeline fails."""
    s = interval_stats(df, keys, time).join(effective_rate(df, keys, time), keys)
    checks = F.array(*[
        F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), F.lit(float(limit)).alias("threshold"), bad.alias("bad"))
        for name, value, limit, bad in (
            ("max_interval", F.col("max_ms"), max_ms, F.col("max_ms") > max_ms), ("min_interval", F.col("min_ms"), min_ms, F.col("min_ms") < min_ms),
            ("duplicates", F.col("n") - F.col("n_distinct"), 0, F.col("n") > F.col("n_distinct")), ("jitter", F.col("std_ms"), std_ms, F.col("std_ms") > std_ms),
            ("rate_low", F.col("rate"), low_fps, F.col("rate") < low_fps), ("rate_high", F.col("rate"), high_fps, F.col("rate") > high_fps),
        )
    ])
    return s.select(*keys, F.explode(checks).alias("c")).where("c.bad").select(*keys, "c.check", "c.value", "c.threshold")


def effective_rate(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    """(keys, n, rate): messages (not intervals) per second of their range; null where the range is empty."""
    span = (F.max(time) - F.min(time)) / 1e6
    return df.groupBy(*keys).agg(F.count("*").alias("_c"), span.alias("_span")).select(*keys, F.when(F.col("_span") > 0, F.col("_c") / F.col("_span")).alias("rate"))


def frame_spread(df: DataFrame, frame: list[str], key: str, time: str, leave_out: list[str] = ()) -> DataFrame:
    """(frame, spread): latest minus earliest time of a frame's modalities, without those whose name ends in ``leave_out``."""
    kept = df
    for end in leave_out:
        kept = kept.where(~F.col(key).endswith(end))
    return kept.groupBy(*frame).agg((F.max(time) - F.min(time)).alias("spread"))


def error_histogram(joined: DataFrame, keys: list[str], delta: str, limits: list[int]) -> DataFrame:
    size = F.abs(delta)
    return joined.groupBy(*keys).agg(F.count(delta).alias("n"), *[F.count_if(size > x).alias(f"over_{x}") for x in limits], F.avg(size).alias("mean_abs"), F.max(size).alias("max_abs"))


def repair_spread(df: DataFrame, frame: list[str], main_t: str, t: str, limit: int = 20_000) -> DataFrame:
    """Frames whose modalities spread more than ``limit`` take the timeline's time everywhere."""
    spread = df.groupBy(*frame).agg((F.max(t) - F.min(t)).alias("_spread"))
    return df.join(spread, frame).withColumn(t, F.when(F.col("_spread") > limit, F.col(main_t)).otherwise(F.col(t))).drop("_spread")


def irregular_rows(df: DataFrame, episode: str, frame: str, time: str, period: float, tolerance: float) -> DataFrame:
    """Rows whose step from the row before, inside the episode, differs from the period by more than the tolerance."""
    step = F.col(time) - F.lag(time).over(Window.partitionBy(episode).orderBy(frame))
    return df.withColumn("step", step).where(F.abs(F.col("step") - period) > tolerance)


def off_grid_deltas(deltas: DataFrame, delta: str, fps: float, tolerance: float = 1e-4) -> DataFrame:
    """Time offsets that are no whole number of frames."""
    return deltas.where(F.abs(F.col(delta) * fps - F.bround(F.col(delta) * fps)) / fps > tolerance)


def length_mismatches(lengths: DataFrame, entity: str, stream: str, length: str) -> DataFrame:
    """(entity, stream, length, expected): streams whose length is not the most frequent one of the entity (ties: the smallest)."""
    modes = lengths.groupBy(entity, length).agg(F.count("*").alias("_n")).groupBy(entity).agg(F.min_by(length, F.struct(-F.col("_n"), F.col(length))).alias("expected"))
    return lengths.join(modes, entity).where(F.col(length) != F.col("expected")).select(entity, stream, length, "expected")


def missing_required(df: DataFrame, entity: list[str], key: str, required: list[str]) -> DataFrame:
    """(entity, key): required keys an entity lacks."""
    wanted = df.select(*entity).distinct().withColumn(key, F.explode(F.array(*map(F.lit, required))))
    return wanted.join(df.select(*entity, key).distinct(), [*entity, key], "left_anti")


def slow_keys(df: DataFrame, keys: list[str], time: str, least: float) -> DataFrame:
    """(keys, rate) of keys with at most ``least`` rows a second, or with no rate."""
    return effective_rate(df, keys, time).where(F.col("rate").isNull() | (F.col("rate") <= least))


def timings(df: DataFrame, keys: list[str], duration: str, order: list[str]) -> DataFrame:
    """(keys, n, total, mean, p50, p95, last) of recorded durations."""
    half, most = F.percentile(duration, 0.5), F.percentile(duration, 0.95)
    return df.groupBy(*keys).agg(F.count(duration).alias("n"), F.sum(duration).alias("total"), F.avg(duration).alias("mean"), half.alias("p50"), most.alias("p95"), F.max_by(duration, F.struct(*order)).alias("last"))


def leaf_rows(df: DataFrame) -> DataFrame:
    """One row ``rows``: the number of values in all leaves, an array counting its elements."""

    def leaves(schema, path: str = "") -> list[Column]:
        out = []
        for f in schema.fields:
            at, kind = f"{path}`{f.name}`", f.dataType.typeName()
            out += leaves(f.dataType, f"{at}.") if kind == "struct" else [F.coalesce(F.size(at), F.lit(0)) if kind == "array" else F.lit(1)]
        return out

    total = F.lit(0).cast("bigint")
    for c in leaves(df.schema):
        total = total + F.greatest(c, F.lit(0))
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).alias("rows"))


def counted(df: DataFrame, counters: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """The table with counters that are observed when it is read, and where they can be read then."""
    seen = Observation()
    return df.observe(seen, *[c.alias(n) for n, c in counters.items()]), seen
