"""Cleaning of message streams: duplicates, gaps, time ranges, channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillframe.session import floor_div


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per keys: the first in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


SLICE = 3_600_000_000  # microseconds of a key that one task puts in order


def with_next(df: DataFrame, keys: list[str], time: str, name: str, slice_width: int = SLICE) -> DataFrame:
    """Adds the next time of the same keys, null for the last and for null times.

    A key's rows are put in order in slices of time, so that one with most of the rows is spread over many
    tasks; the last row of a slice takes the first time of the next slice that has any, from one row a slice.
    """
    rows = _sliced(df, keys, time, slice_width)
    inner = F.lead(time).over(Window.partitionBy("_k", "_slice").orderBy(time))
    heads = rows.where(F.col(time).isNotNull()).groupBy("_k", "_slice").agg(F.min(time).alias("_head"))
    heads = heads.select("_k", "_slice", F.lead("_head").over(Window.partitionBy("_k").orderBy("_slice")).alias("_after"))
    joined = rows.withColumn("_inner", inner).join(heads, ["_k", "_slice"], "left")
    return joined.select(*df.columns, F.coalesce("_inner", "_after").alias(name))


def _sliced(df: DataFrame, keys: list[str], by: str, width: int) -> DataFrame:
    """Adds the keys as one struct, equal also where they are null, and the slice of a whole number, the first one for nulls."""
    cut = floor_div(F.col(by).cast("bigint"), F.lit(width).cast("bigint"))
    return df.withColumns({"_k": F.struct(F.lit(0).alias("_"), *keys), "_slice": F.coalesce(cut, F.lit(-(1 << 62)).cast("bigint"))})


def placed(df: DataFrame, keys: list[str], order: list[str], name: str, slice_width: int = SLICE) -> DataFrame:
    """Adds the place of each row among those of its keys, from 0, in the order of ``order``; nulls come first.

    Where the first column of the order is a whole number (a time) it is cut into slices, which are put in
    order apart and numbered on by the number of rows of the slices before, from one row a slice.
    """
    whole = df.schema[order[0]].dataType.typeName() in ("long", "integer")
    if not whole:
        return df.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("bigint"))
    rows = _sliced(df, keys, order[0], slice_width)
    counts = rows.groupBy("_k", "_slice").agg(F.count("*").alias("_c"))
    before = F.sum("_c").over(Window.partitionBy("_k").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("_k", "_slice", F.coalesce(before, F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy("_k", "_slice").orderBy(*order)) - 1
    return rows.withColumn("_inner", inner).join(counts, ["_k", "_slice"]).select(*df.columns, (F.col("_inner") + F.col("_before")).cast("bigint").alias(name))


def gaps(df: DataFrame, keys: list[str], time: str, limit: int, slice_width: int = SLICE) -> DataFrame:
    """(keys, gap_start, gap): differences of successive times above ``limit``."""
    seen = with_next(df.where(F.col(time).isNotNull()).select(*keys, time), keys, time, "_next", slice_width)
    return seen.select(*keys, F.col(time).alias("gap_start"), (F.col("_next") - F.col(time)).alias("gap")).where(F.col("gap") > limit)


def fill_gaps(df: DataFrame, keys: list[str], time: str, limit: Column | int, slice_width: int = SLICE) -> DataFrame:
    """All rows and, in each gap above ``limit``, evenly spaced copies of the row before it, flagged ``interpolated``.

    A gap gets ceil(gap / limit) - 1 copies; a gap exactly at the limit gets none.  ``limit`` may be a
    column (a limit per kind of key).
    """
    lim = limit if isinstance(limit, Column) else F.lit(limit).cast("bigint")
    rows = with_next(df, keys, time, "_gap", slice_width).withColumn("_gap", F.col("_gap") - F.col(time))
    k = F.when(F.col("_gap") > lim, F.call_function("div", F.col("_gap") + lim - 1, lim) - 1).otherwise(0)
    steps = rows.withColumn("_k", F.coalesce(k, F.lit(0)).cast("bigint")).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_k"))))
    filled = steps.withColumn("interpolated", F.col("_i") > 0).withColumn(time, F.when(F.col("_i") > 0, F.col(time) + F.call_function("div", F.col("_i") * F.col("_gap"), F.col("_k") + 1)).otherwise(F.col(time)))
    return filled.drop("_gap", "_k", "_i")


def gap_limit_of(name: Column, strict: bool = False) -> Column:
    """Largest gap (microseconds) left unfilled for a key, by its name."""
    top = name.rlike("head|top") & ~name.contains("depth")
    if strict:
        return F.when(top, 39_800).otherwise(2_000).cast("bigint")
    return F.when(top, 39_800).when(name.contains("wrist") & ~name.contains("depth"), 8_000).when(name.contains("depth"), 8_000).otherwise(4_000).cast("bigint")


def trim_to_common_end(df: DataFrame, entity: list[str], key: str, time: str) -> DataFrame:
    """Rows before the earliest of the last times of the entity's keys."""
    ends = df.groupBy(*entity, key).agg(F.max(time).alias("_last")).groupBy(*entity).agg(F.min("_last").alias("_end"))
    return df.join(ends, entity).where(F.col(time) < F.col("_end")).drop("_end")


def time_fraction(df: DataFrame, entity: list[str], time: str, start: float, end: float) -> DataFrame:
    """Rows between two fractions of their entity's time range, both included."""
    span = df.groupBy(*entity).agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
    width = F.col("_b") - F.col("_a")
    low, high = F.col("_a") + (width * start).cast("bigint"), F.col("_a") + (width * end).cast("bigint")
    return df.join(span, entity).where(F.col(time).between(low, high)).drop("_a", "_b")


def first_seen_channel(df: DataFrame, keys: list[str], channel: str, order: list[str]) -> DataFrame:
    """Rows of the channel whose message came first for the keys."""
    chosen = df.groupBy(*keys).agg(F.min_by(channel, F.struct(*order)).alias("_c"))
    return df.join(chosen, keys).where(F.col(channel) == F.col("_c")).drop("_c")


def primary_or_fallback(df: DataFrame, keys: list[str], is_fallback: str) -> DataFrame:
    """Primary rows; the fallback's only for keys without any."""
    has = df.where(~F.col(is_fallback)).select(*keys).distinct()
    return df.where(~F.col(is_fallback)).unionByName(df.where(F.col(is_fallback)).join(has, keys, "left_anti"))


def first_present(df: DataFrame, entity: list[str], key: str, priority: list[str]) -> DataFrame:
    """(entity, key): of the keys in ``priority`` the first that an entity has rows of."""
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col(key))
    return df.where(rank > 0).groupBy(*entity).agg(F.min_by(key, rank).alias(key))
