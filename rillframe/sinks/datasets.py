"""Writers of datasets: one folder per episode, JSON-lines metadata."""

from __future__ import annotations

import json
import tarfile
import time
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillframe.functions.messages import nest_fields

# What is done where the output is there already
POLICIES = {"error": "error", "skip": "ignore", "overwrite": "overwrite", "append": "append"}


def write_episodes(frames: DataFrame, root: str, episode: str = "episode_index", chunk_size: int = 1000, mode: str = "error") -> None:
    """Frames as parquet under data/chunk/episode, sorted; an episode is one task's and one file's work.

    ``mode`` is Spark's: error, ignore, overwrite.
    """
    rows = frames.withColumn("chunk", F.call_function("div", F.col(episode), F.lit(chunk_size).cast("bigint")))
    rows.repartition("chunk", episode).sortWithinPartitions("chunk", episode, "frame_index").write.mode(mode).partitionBy("chunk", episode).parquet(f"{root}/data")


def write_json_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).json(path)


def write_json(row: dict, path: str) -> None:
    """One small object (totals, camera parameters) as a JSON file of its own, indented."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(row, ensure_ascii=False, indent=4), encoding="utf-8")


def write_nested(df: DataFrame, path: str, policy: str = "error", most_rows: int = 10_000) -> None:
    """Columns named by paths (``state/arm/position``) as nested structs, in parquet files of at most ``most_rows`` rows.

    With the policy ``append`` later batches are added to those before; ``skip`` leaves an output that is there.
    """
    nest_fields(df).write.mode(POLICIES[policy]).option("maxRecordsPerFile", most_rows).parquet(path)


def pack_folder(folder: str, target: str, tries: int = 3, pause: float = 0.1) -> str:
    """The folder as a tar archive; written beside its place first and tried again if that fails."""
    for left in range(tries - 1, -1, -1):
        part = Path(f"{target}.part")
        try:
            with tarfile.open(part, "w") as tar:
                tar.add(folder, arcname=Path(folder).name)
            return str(part.rename(target))
        except OSError:
            part.unlink(missing_ok=True)
            if not left:
                raise
            time.sleep(pause)
    raise ValueError("tries must be positive")


def dataset_info(frames: DataFrame, fps: float, episode: str = "episode_index", chunk_size: int = 1000, videos: list[str] = ()) -> DataFrame:
    """One row of totals for ``info.json``: episodes, frames, videos, chunks, rate, split, path templates and features.

    Features are given as (name, type) of the frame table's columns.
    """
    per = frames.groupBy(episode).agg(F.count("*").alias("n"))
    features = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")) for f in frames.schema.fields])
    return per.agg(F.count("*").alias("total_episodes"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_frames")).select(
        "total_episodes", "total_frames", F.ceil(F.col("total_episodes") / chunk_size).alias("total_chunks"), F.lit(float(fps)).alias("fps"), F.format_string("0:%d", F.col("total_episodes")).alias("train_split"),
        (F.col("total_episodes") * len(videos)).alias("total_videos"), F.lit("data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet").alias("data_path"),
        F.lit("videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4").alias("video_path"), features.alias("features"),
    )
