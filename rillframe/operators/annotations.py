"""Annotations: metadata of two generations, mapping to frames, chaining, trimming, device rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlap_frames(start: Column, duration: Column, rec_start: Column, rec_end: Column, frames: Column) -> tuple[Column, Column]:
    """First and last frame of an annotation in its recording, null where they do not meet.

    Offsets are scaled by the number of frames and truncated; both ends stay within the frames.
    """
    end = start + duration
    meets = (start <= rec_end) & (end >= rec_start)
    width = (rec_end - rec_start).cast("double")
    at = lambda x: F.least(frames - 1, F.greatest(F.lit(0), ((x - rec_start) / width * frames).cast("bigint")))
    return F.when(meets, at(F.greatest(start, rec_start))), F.when(meets, at(F.least(end, rec_end)))


def chain(df: DataFrame, episode: str, skill: str, stamp: str, start: str, end: str, total: str) -> DataFrame:
    """Annotations of an episode as a gapless chain of frame ranges.

    Of rows with one (skill, stamp) one with frames is kept.  In the order of stamps the first starts
    at its start (or 0), each next where the one before ends, and the last ends at the last frame;
    ends never go back.
    """
    pref = Window.partitionBy(episode, skill, stamp).orderBy(F.col(start).isNull(), F.col(start), F.col(end))
    one = df.withColumn("_n", F.row_number().over(pref)).where("_n = 1")
    w = Window.partitionBy(episode).orderBy(F.coalesce(F.col(stamp), F.lit("")), skill)
    rows = one.withColumns({"_i": F.row_number().over(w), "_last": F.lead(skill).over(w).isNull()})
    first = F.coalesce(F.first(start).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    own = F.when(F.col("_last"), F.col(total) - 1).otherwise(F.coalesce(F.least(F.col(end), F.col(total) - 1), F.lit(0)))
    rows = rows.withColumn("_e", F.greatest(first, F.max(own).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    begin = F.coalesce(F.lag("_e").over(w), first)
    return rows.select(episode, skill, stamp, begin.cast("bigint").alias("start_frame"), F.col("_e").cast("bigint").alias("end_frame"))


def position_range(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys, low, high): least start and greatest end that can be read as numbers."""
    return df.groupBy(*keys).agg(F.min(F.col(start).try_cast("double")).alias("low"), F.max(F.col(end).try_cast("double")).alias("high"))


def normalise_metadata(df: DataFrame, body: str) -> DataFrame:
    """Adds generation, scene, sub_scene, task, device and n_marks of JSON bodies of either generation.

    A body with a ``marks`` array is new; otherwise it is old.  Empty texts count as missing.
    """
    get = lambda path: F.nullif(F.trim(F.get_json_object(body, f"$.{path}")), F.lit(""))
    first = lambda *paths: F.coalesce(*map(get, paths))
    marks, moments = F.get_json_object(body, "$.marks"), F.get_json_object(body, "$.moments")
    new = marks.startswith("[")
    return df.select(
        "*", F.when(new, "new").otherwise("old").alias("generation"), first("primaryScene", "scene_code").alias("scene"), first("tertiaryScene", "sub_scene_code").alias("sub_scene"),
        first("taskName", "task_name").alias("task"), first("deviceSn", "device_sn").alias("device"),
        F.coalesce(F.json_array_length(F.when(new, marks).otherwise(moments)), F.lit(0)).cast("bigint").alias("n_marks"),
    )


def apply_device_rules(df: DataFrame, rules: DataFrame, device: str, day: str) -> DataFrame:
    """Adds ``action`` of the rule for the device whose days [since, until] contain the row's day, null without one.

    ``rules`` has (device, since, until, action); of several that fit the first action in order counts.
    """
    r = rules.select(F.col("device").alias(device), "since", "until", "action").groupBy(device).agg(F.sort_array(F.collect_set(F.struct("since", "until", "action"))).alias("_rules"))  # the few rules of one device
    fit = F.filter("_rules", lambda x: F.col(day).between(F.coalesce(x["since"], F.col(day)), F.coalesce(x["until"], F.col(day))))
    return df.join(r, device, "left").withColumn("action", F.array_min(F.transform(fit, lambda x: x["action"]))).drop("_rules")


def step_range(df: DataFrame, keys: list[str], start: str, end: str, row_id: str) -> DataFrame:
    """(keys, low, high): start of the first and end of the last step in the order of their starts."""
    order = F.struct(start, end, row_id)
    return df.groupBy(*keys).agg(F.min_by(start, order).alias("low"), F.max_by(end, order).alias("high"))


def trim_cap(trim: Column, action_frames: Column) -> Column:
    """Frames to trim, at most half of the action they fall into."""
    return F.least(trim, F.call_function("div", action_frames, F.lit(2).cast("bigint")))
