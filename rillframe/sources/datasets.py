"""Discovery of recordings and datasets, and readers of their files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillframe.functions.vectors import safe_name


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, size, modified) of all files under a folder, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def recordings_in(paths: DataFrame, root: str | None = None) -> DataFrame:
    """(path, dataset, start, end) of recordings (``*.bag`` but not ``*.c.bag``), each with a unique dataset name.

    With ``root`` only those in the folder itself or one level below count.  Names that repeat, in the
    order of the paths (those in the folder itself first), get a number; start and end are the fractions
    of the recording to read, at first all of it.
    """
    base = F.regexp_extract("path", r"([^/]+)\.bag$", 1)
    rows = paths.where(F.col("path").rlike(r"\.bag$") & ~F.col("path").rlike(r"\.c\.bag$")).withColumn("_name", safe_name(base))
    depth = F.size(F.split("path", "/"))
    if root is not None:
        at = root.rstrip("/") + "/"
        rows = rows.where(F.col("path").startswith(at)).withColumn("_deep", F.size(F.split(F.substring("path", len(at) + 1, 10_000), "/"))).where("_deep <= 2")
    else:
        rows = rows.withColumn("_deep", depth)
    n = F.row_number().over(Window.partitionBy("_name").orderBy("_deep" if root is not None else F.lit(0), "path"))
    return rows.select("path", F.when(n == 1, F.col("_name")).otherwise(F.concat("_name", F.lit("_"), n)).alias("dataset"), F.lit(0.0).alias("start"), F.lit(1.0).alias("end"))


# What makes a folder a dataset
DATASET_FILES = ["meta/info.json", "meta/episodes.jsonl", "meta/episodes_stats.jsonl", "meta/tasks.jsonl"]
DATASET_FOLDERS = ["data", "videos", "parameters"]


def deepest_datasets(paths: DataFrame, files: list[str] = ("meta/info.json",), folders: list[str] = ()) -> DataFrame:
    """Folders that hold all of ``files`` and something in each of ``folders``, and have no other such folder below them.

    ``files=DATASET_FILES, folders=DATASET_FOLDERS`` are those of a complete dataset.
    """
    marks = [F.when(F.col("path").endswith(f"/{f}"), F.struct(F.regexp_replace("path", f"/{f}$", "").alias("root"), F.lit(f).alias("what"))) for f in files]
    marks += [F.when(F.col("path").rlike(f"/{d}/"), F.struct(F.regexp_extract("path", f"^(.*?)/{d}/", 1).alias("root"), F.lit(f"{d}/").alias("what"))) for d in folders]
    found = paths.select(F.explode(F.filter(F.array(*marks), lambda x: x.isNotNull())).alias("m")).select("m.*").distinct()
    roots = found.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") == len(files) + len(folders)).select("root")
    parents = roots.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("root", "/")) - 1), lambda n: F.array_join(F.slice(F.split("root", "/"), 1, n), "/"))).alias("root")).distinct()
    return roots.join(parents, "root", "left_anti")


def bag_headers(messages: DataFrame, entity: str, time: str, offset_hours: int = 8) -> DataFrame:
    """(entity, start, end, seconds, started) of recordings: first and last time, duration, and the start as text at an offset from UTC; null where there is no time."""
    per = messages.groupBy(entity).agg(F.min(time).alias("start"), F.max(time).alias("end"))
    local = F.timestamp_micros(F.col("start") + F.lit(offset_hours * 3_600_000_000))
    text = F.concat(F.date_format(F.convert_timezone(F.lit("UTC"), F.lit("UTC"), local.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(f"{offset_hours:+03d}:00"))
    return per.select(entity, "start", "end", ((F.col("end") - F.col("start")) / 1e6).alias("seconds"), text.alias("started"))


def read_with_quarantine(spark: SparkSession, root: str, schema: str, pattern: str = "*.parquet") -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine): the rows of all files that can be read, and (path, size) of those that gave none and are not empty tables by their size."""
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).parquet(root)
    seen = rows.select(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("path")).distinct()
    listed = list_files(spark, root, pattern).select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"), "size")
    return rows, listed.join(seen, "path", "left_anti")


def read_episodes(spark: SparkSession, root: str, episodes: list[int] | None = None) -> DataFrame:
    """Frames of a dataset written by :func:`rillframe.sinks.datasets.write_episodes`; only the folders of ``episodes`` are read."""
    frames = spark.read.parquet(f"{root}/data")
    return frames.where(F.col("episode_index").isin(episodes)) if episodes is not None else frames


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def messages_of(messages: DataFrame, topics: DataFrame, topic: str = "topic") -> DataFrame:
    """Messages with the keys their topics feed; ``topics`` has (topic, key, is_fallback), one topic may feed several keys."""
    return messages.join(topics, topic)
