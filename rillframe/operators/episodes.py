"""Episodes and datasets: numbering, offsets, lead/lag windows, task dictionaries, merging and re-chunking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillframe.operators.clean import placed
from rillframe.session import cut_lineage


def number_frames(df: DataFrame, episode: str, order: list[str], fps: float | None = None) -> DataFrame:
    """Adds frame_index, the global index (episodes in order) and, with ``fps``, timestamp = frame_index / fps."""
    offsets = episode_offsets(df, episode).select(episode, "from_index")
    out = placed(df, [episode], order, "frame_index").join(offsets, episode).withColumn("index", F.col("from_index") + F.col("frame_index")).drop("from_index")
    return out.withColumn("timestamp", (F.col("frame_index") / fps).cast("float")) if fps else out


def episode_offsets(df: DataFrame, episode: str) -> DataFrame:
    """(episode, length, from_index, to_index); the running sum is over episodes, not rows."""
    lengths = df.groupBy(episode).agg(F.count("*").alias("length"))
    return running_sum(lengths, [episode], "length", "to_index").select(episode, "length", (F.col("to_index") - F.col("length")).alias("from_index"), "to_index")


def running_sum(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` up to each row in an order that tells rows apart; like :func:`numbered`, not in one task."""
    spread = cut_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    inner = F.sum(value).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    sums = spread.groupBy("_part").agg(F.sum(value).alias("_c"))  # a row per partition
    before = sums.select("_part", F.coalesce(F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return spread.withColumn("_s", inner).join(F.broadcast(before), "_part").withColumn(name, F.col("_s") + F.col("_b")).drop("_part", "_s", "_b")


def delta_window(frames: DataFrame, episode: str, frame: str, values: list[str], deltas: list[int]) -> DataFrame:
    """(episode, frame, delta, values..., is_pad): rows at frame + delta, clamped to the episode."""
    size = frames.groupBy(episode).agg(F.count("*").alias("_n"))
    asked = frames.select(episode, frame).join(size, episode).withColumn("delta", F.explode(F.array(*[F.lit(d).cast("bigint") for d in deltas])))
    at = F.col(frame) + F.col("delta")
    asked = asked.select(episode, frame, "delta", F.greatest(F.lit(0).cast("bigint"), F.least(F.col("_n") - 1, at)).alias("_at"), ((at < 0) | (at >= F.col("_n"))).alias("is_pad"))
    return asked.join(frames.select(episode, F.col(frame).alias("_at"), *values), [episode, "_at"]).select(episode, frame, "delta", *values, "is_pad")


def delta_frames(seconds: list[float], fps: float) -> list[int]:
    """Frames of time offsets, halves to even."""
    return [round(s * fps) for s in seconds]


def encode_tasks(df: DataFrame, task: str, order: list[str]) -> DataFrame:
    """(task, task_index): tasks numbered by first appearance."""
    first = df.where(F.col(task).isNotNull()).groupBy(task).agg(F.min(F.struct(*order)).alias("_first"))
    return numbered(first, ["_first", task], "task_index").select(task, "task_index")


def decode_tasks(df: DataFrame, tasks: DataFrame, task: str, index: str = "task_index") -> DataFrame:
    """Rows with the text of their task's number, null for a number that is not in the dictionary."""
    return df.join(tasks.select(index, task), index, "left")


def merge_datasets(episodes: DataFrame, dataset: str, episode: str, frames: str, least: int) -> DataFrame:
    """Episodes of all datasets with at least ``least`` frames, numbered on: (dataset, episode, frames, episode_index)."""
    sizes = episodes.groupBy(dataset).agg(F.sum(frames).alias("_frames"), F.count("*").alias("_n")).where(F.col("_frames") >= least)
    before = F.sum("_n").over(Window.orderBy(dataset).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(dataset, F.coalesce(before, F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy(dataset).orderBy(episode)) - 1
    return episodes.withColumn("_i", local).join(offsets, dataset).select(dataset, episode, frames, (F.col("_i") + F.col("_before")).cast("bigint").alias("episode_index"))


def rechunk(episodes: DataFrame, episode_index: str, size: int = 1000) -> DataFrame:
    """Adds chunk and path of each episode's file."""
    chunk = F.call_function("div", F.col(episode_index), F.lit(size).cast("bigint"))
    return episodes.withColumn("chunk", chunk).withColumn("path", F.format_string("data/chunk-%03d/episode_%06d.parquet", F.col("chunk"), F.col(episode_index)))


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds the place of every row in the order of ``order``, from 0, without bringing all rows to one task.

    The rows are range-partitioned and numbered in their partition; the rows of all earlier partitions are
    added from a count per partition.  They are written to the checkpoint folder in between, so that both
    see the same partitions whatever is run again.  ``order`` must tell any two rows apart.
    """
    spread = cut_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    placed = spread.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    counts = spread.groupBy("_part").agg(F.count("*").alias("_c"))  # a row per partition
    before = counts.select("_part", F.coalesce(F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return placed.join(F.broadcast(before), "_part").withColumn(name, (F.col("_n") - 1 + F.col("_b")).cast("bigint")).drop("_part", "_n", "_b")


def common_columns(parts: list[DataFrame]) -> tuple[list[str], list[str]]:
    """Columns that all tables have, in the order of the first, and those that only some have."""
    common = [c for c in parts[0].columns if all(c in p.columns for p in parts)]
    return common, sorted({c for p in parts for c in p.columns} - set(common))


def concat_datasets(parts: list[DataFrame], order: list[list[str]]) -> DataFrame:
    """Union over the common columns with dataset_index, local_index and a running index over all.

    The order of each table must tell any two of its rows apart.
    """
    common, _ = common_columns(parts)
    if not common:
        raise ValueError("the datasets have no column in common")
    rows = [numbered(p, o, "local_index").select(F.lit(i).cast("bigint").alias("dataset_index"), "local_index", *common) for i, (p, o) in enumerate(zip(parts, order))]
    sizes = [p.agg(F.count("*").alias("_n")).select(F.lit(i).cast("bigint").alias("dataset_index"), "_n") for i, p in enumerate(parts)]
    whole, size = rows[0], sizes[0]
    for r, s in zip(rows[1:], sizes[1:]):
        whole, size = whole.unionByName(r), size.unionByName(s)
    before = F.coalesce(F.sum("_n").over(Window.orderBy("dataset_index").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return whole.join(F.broadcast(size.select("dataset_index", before.alias("_b"))), "dataset_index").withColumn("index", F.col("local_index") + F.col("_b")).drop("_b")  # one row a dataset


def summary(episodes: DataFrame, frames: str, fps: float) -> DataFrame:
    total = episodes.agg(F.count("*").alias("episodes"), F.coalesce(F.sum(frames), F.lit(0)).cast("bigint").alias("frames"))
    return total.select("episodes", "frames", F.ceil(F.col("episodes") / 1000).alias("chunks"), (F.col("frames") / fps).alias("seconds"), (F.col("frames") / fps / 3600).alias("hours"))


def commit_episodes(frames: DataFrame, episode: str, order: list[str], task: str, fps: float, start_index: int = 0, known_tasks: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(frames, tasks) of new episodes: frames with episode_index, frame_index, timestamp, index and task_index; the task dictionary.

    Episodes and frames are numbered on after ``start_index`` frames; tasks in ``known_tasks`` (task,
    task_index) keep their numbers and new ones are numbered on by first appearance.
    """
    rows = number_frames(frames, episode, order, fps).withColumn("index", F.col("index") + start_index)
    places = numbered(frames.select(episode).distinct(), [episode], "episode_index")
    seen = frames.select(task, F.struct(episode, *order).alias("_at")).where(F.col(task).isNotNull())
    tasks = encode_tasks(seen, task, ["_at"])
    if known_tasks is not None:
        last = known_tasks.agg(F.max("task_index")).first()[0]  # one number
        base = 0 if last is None else last + 1
        fresh = encode_tasks(seen.join(known_tasks.select(task), task, "left_anti"), task, ["_at"]).withColumn("task_index", F.col("task_index") + base)
        tasks = known_tasks.select(task, "task_index").unionByName(fresh)
    return rows.join(places, episode).join(tasks, task, "left"), tasks


def commit_check(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """(episode_index, what): episodes whose frames do not number from 0 without holes, or differ in number from ``episodes`` (episode_index, length)."""
    per = frames.groupBy("episode_index").agg(F.count("*").alias("_n"), F.min("frame_index").alias("_a"), F.max("frame_index").alias("_b"), F.countDistinct("frame_index").alias("_d"))
    both = per.join(episodes.select("episode_index", "length"), "episode_index", "full")
    bad = F.array(
        F.when(F.coalesce(F.col("_n"), F.lit(0)) != F.coalesce("length", F.lit(0)), F.lit("length")), F.when((F.col("_a") != 0) | (F.col("_b") != F.col("_n") - 1) | (F.col("_d") != F.col("_n")), F.lit("frames"))
    )
    return both.select("episode_index", F.explode(F.filter(bad, lambda x: x.isNotNull())).alias("what"))


def frame_manifest(frames: DataFrame, episode: str, stream: str, order: list[str], fps: float, segment: int = 800, group: int = 2) -> DataFrame:
    """What an encoder is to write, in order: adds ordinal, segment, place in it, keyframe flag, time and the file of each frame."""
    n = (F.row_number().over(Window.partitionBy(episode, stream).orderBy(*order)) - 1).cast("bigint")
    size, gop = F.lit(segment).cast("bigint"), F.lit(group).cast("bigint")
    rows = frames.withColumn("ordinal", n)
    rows = rows.withColumns({"segment": F.call_function("div", F.col("ordinal"), size), "place": F.col("ordinal") % size, "pts": F.col("ordinal") / fps})
    return rows.withColumns({"keyframe": F.col("place") % gop == 0, "file": F.format_string("videos/%s/%s/segment_%04d.mp4", F.col(stream), F.col(episode), F.col("segment"))})


def ordered_unique(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """(keys, value, place): the distinct values of each key in the order of their first appearance."""
    first = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(F.struct(*order)).alias("_f"))
    return first.withColumn("place", (F.row_number().over(Window.partitionBy(*keys).orderBy("_f", value)) - 1).cast("bigint")).drop("_f")


def merge_with_tasks(frames: DataFrame, dataset: str, episode: str, task: str, least: int) -> DataFrame:
    """(dataset, episode, episode_index, from_index, to_index, task_index) of all datasets with at least ``least`` frames.

    ``frames`` has a row per frame.  Episodes and frames are numbered on over the datasets; tasks have
    one dictionary, in the order of their first episode, null where an episode has none.
    """
    lengths = frames.groupBy(dataset, episode).agg(F.count("*").alias("frames"), F.min(task).alias(task))
    merged = merge_datasets(lengths, dataset, episode, "frames", least)
    places = running_sum(merged, ["episode_index"], "frames", "to_index").withColumn("from_index", F.col("to_index") - F.col("frames"))
    named = places.join(lengths.select(dataset, episode, task), [dataset, episode])
    return named.join(encode_tasks(named, task, ["episode_index"]), task, "left").select(dataset, episode, "episode_index", "from_index", "to_index", "task_index")


def item(frames: DataFrame, tasks: DataFrame, episode: str, frame: str, index: int, values: list[str], deltas: list[int]) -> DataFrame:
    """One item of a dataset by its ``index``: the rows of its delta window with the text of its task (random access)."""
    asked = frames.where(F.col("index") == index).select(episode, F.col(frame).alias("_f"), "task_index")
    window = delta_window(frames.join(asked.select(episode), episode, "left_semi"), episode, frame, values, deltas)
    hit = window.join(asked, episode).where(F.col(frame) == F.col("_f")).drop("_f")
    return decode_tasks(hit, tasks, "task").drop("task_index")


def properties(frames: DataFrame, fps: float, episode: str, widths: dict[str, int] | None = None) -> DataFrame:
    """(name, value): totals, rate, and the kind and width of each column, as text."""
    total = frames.agg(F.countDistinct(episode).cast("string").alias("episodes"), F.count("*").cast("string").alias("frames"))
    facts = [F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in (("total_episodes", F.col("episodes")), ("total_frames", F.col("frames")), ("fps", F.lit(f"{fps:g}")))]
    facts += [F.struct(F.lit(f"feature.{f.name}").alias("name"), F.lit(f"{f.dataType.simpleString()}[{(widths or {}).get(f.name, 1)}]").alias("value")) for f in frames.schema.fields]
    return total.select(F.explode(F.array(*facts)).alias("p")).select("p.*")
