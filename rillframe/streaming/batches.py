"""Batches of a message stream, emitted by the progress of event time, and a running regular rate."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def count_batches(stream: DataFrame, entity: str, time: str, size: int, slack: int = 100_000) -> DataFrame:
    """(entity, batch, first_t, last_t, n): batches of ``size`` messages per entity of a stream.

    A batch is emitted when a message more than ``slack`` microseconds after its last one has arrived,
    so it is complete if messages are late by less than that.  Later messages open no new batch: those
    before the last emitted time are dropped; those that tie with it go to the next batch.  What waits
    when the stream has ended is given by :func:`last_batches`.
    """
    kind = stream.schema[entity].dataType.simpleString()

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, done, waiting = state.get if state.exists else (0, -(1 << 62), [])
        times = list(waiting)
        for part in parts:
            times += [int(x) for x in part[time].dropna()]
        times = sorted(x for x in times if x >= done)
        out = []
        while len(times) > size and times[-1] > times[size - 1] + slack:
            mine, times = times[:size], times[size:]
            out.append((key[0], number, mine[0], mine[-1], len(mine)))
            number, done = number + 1, mine[-1]
        state.update((number, done, times))
        yield pd.DataFrame(out, columns=[entity, "batch", "first_t", "last_t", "n"])

    grouped = stream.select(F.col(entity), F.col(time).cast("bigint").alias(time)).where(F.col(entity).isNotNull()).groupBy(entity)
    return grouped.applyInPandasWithState(
        run, f"{entity} {kind}, batch bigint, first_t bigint, last_t bigint, n bigint", "number bigint, done bigint, waiting array<bigint>", "append", GroupStateTimeout.NoTimeout
    )


def last_batches(spark: SparkSession, checkpoint: str, entity: str, size: int) -> DataFrame:
    """The batches of :func:`count_batches` that wait in the state of a query that has ended, the last of an entity maybe short.

    ``checkpoint`` is the query's folder; a query started again from it would emit these messages again.
    """
    state = spark.read.format("statestore").load(checkpoint).select(f"key.{entity}", "value.groupState.*")
    rows = state.select(entity, "number", F.posexplode("waiting").alias("i", "t"))  # less than a batch and what came within the slack
    batch = (F.col("number") + F.call_function("div", F.col("i"), F.lit(size))).alias("batch")
    return rows.groupBy(entity, batch).agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.count("*").alias("n"))


def windowed_rate(stream: DataFrame, key: str, event_time: str, late: str = "10 seconds", width: str = "10 seconds", slide: str | None = None) -> DataFrame:
    """Messages per key and event-time window (sliding with ``slide``), with a watermark for late ones."""
    w = F.window(event_time, width, slide) if slide else F.window(event_time, width)
    return stream.withWatermark(event_time, late).groupBy(w, key).agg(F.count("*").alias("n"))


def open_stream(spark: SparkSession, path: str, schema, max_files: int = 100) -> DataFrame:
    """A stream of parquet files, at most ``max_files`` a batch, so that a slow reader is not flooded."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def live_messages(stream: DataFrame, body: str, received: str, payload: str, topics: list[str]) -> DataFrame:
    """(topic, stamp, payload...) of JSON messages of some topics; the stamp is the header's, or the time of receipt."""
    parsed = stream.select(F.from_json(body, f"topic string, header struct<stamp_us bigint>, {payload}").alias("m"), F.col(received).alias("_r"))
    names = [x.split()[0] for x in payload.split(", ")]
    return parsed.where(F.col("m.topic").isin(topics)).select("m.topic", F.coalesce("m.header.stamp_us", "_r").alias("stamp"), *[F.col(f"m.{n}") for n in names])


def for_each_batch(stream: DataFrame, callback, checkpoint: str, mode: str = "append"):
    """Starts a query that hands every batch of a stream (a table and its number) to a callback, until nothing is left to read."""
    return stream.writeStream.outputMode(mode).foreachBatch(callback).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
