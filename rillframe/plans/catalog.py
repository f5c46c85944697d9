"""Queries of the reference's operators over the star-schema, event, embedding and robot tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillframe.functions import vectors as V
from rillframe.functions.kinematics import end_pose
from rillframe.operators import annotations, asof, clean, episodes, quality, stats, timeline
from rillframe.session import checkpoint_dir, epoch_us, table

HOUR = 3_600_000_000
QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def messages(spark: SparkSession, d: str, *kinds: str) -> DataFrame:
    """Events as messages: (bag_id, key, t, id, value, props)."""
    rows = table(spark, d, "events").select(F.col("user_id").alias("bag_id"), F.col("event_type").alias("key"), epoch_us("ts").alias("t"), F.col("event_id").alias("id"), "value", "props")
    return rows.where(F.col("key").isin(*kinds)) if kinds else rows


def vectors(spark: SparkSession, d: str, width: int | None = None) -> DataFrame:
    """Embeddings as vectors, whole or, for a fixed layout, their first ``width`` values."""
    v = F.slice("embedding", 1, width) if width else F.col("embedding")
    return table(spark, d, "embeddings").select("vec_id", F.col("label").cast("bigint").alias("label"), v.alias("v"))


def _near(spark, d, **options) -> DataFrame:
    return asof.nearest_asof(messages(spark, d, "view").select("bag_id", "t", "id"), messages(spark, d, "click"), ["bag_id"], "t", "id", **options)


@query
def nearest_asof_later(spark, d):
    return _near(spark, d).select("id", "near_id", "delta")


@query
def nearest_asof_earlier(spark, d):
    return _near(spark, d, tie="earlier").select("id", "near_id", "delta")


@query
def nearest_asof_sliced(spark, d):
    return _near(spark, d, slice_width=24 * HOUR).select("id", "near_id", "delta")


@query
def nearest_with_tolerance(spark, d):
    return asof.correct_times(_near(spark, d), "t", HOUR).select("id", "aligned_t", "corrected")


@query
def frames_to_force(spark, d):
    """Every camera frame with the nearest left force reading of its recording, however far."""
    frames = table(spark, d, "camera_frames").where("timestamp_us is not null").select("bag_id", "camera", "frame_no", F.col("timestamp_us").alias("t")).distinct()
    force = table(spark, d, "messages").where("topic = '/force6d_left_hand_force_torque' and timestamp_us is not null and size(data) > 0")
    force = force.select("bag_id", F.col("timestamp_us").alias("t"), F.col("seq").alias("id")).distinct()
    return asof.nearest_asof(frames, force, ["bag_id"], "t", "id", slice_width=60_000_000).select("bag_id", "camera", "frame_no", "near_t", "delta")


@query
def dedup_keep_first(spark, d):
    rows = messages(spark, d).withColumn("hour", F.call_function("div", F.col("t"), F.lit(HOUR)))
    return clean.keep_first(rows, ["bag_id", "key", "hour"], ["t", "id"]).select("bag_id", "key", "hour", "id")


@query
def gap_gate(spark, d):
    return clean.gaps(messages(spark, d), ["bag_id", "key"], "t", 6 * HOUR)


@query
def gap_fill(spark, d):
    return clean.fill_gaps(messages(spark, d, "view").select("bag_id", "id", "t"), ["bag_id"], "t", 2 * HOUR)


@query
def gap_interval_flag(spark, d):
    return asof.gap_flag(messages(spark, d, "click").select("bag_id", "t", "id"), messages(spark, d, "view"), ["bag_id"], "t", 12 * HOUR).select("id", "in_gap")


@query
def master_timeline(spark, d):
    rows = messages(spark, d, "view").withColumn("hour", F.call_function("div", F.col("t"), F.lit(HOUR)))
    one = clean.keep_first(rows, ["bag_id", "hour"], ["t", "id"])
    return timeline.drop_and_stride(one, ["bag_id"], ["t", "id"], 1, 3).select("bag_id", "id")


@query
def timeline_key_choice(spark, d):
    return timeline.main_key(messages(spark, d), ["bag_id"], "key", ["view", "click", "purchase", "error"])


@query
def end_boundary_trim(spark, d):
    return clean.trim_to_common_end(messages(spark, d), ["bag_id"], "key", "t").select("bag_id", "id")


@query
def channel_choice_first_seen(spark, d):
    return clean.first_seen_channel(messages(spark, d, "view", "click"), ["bag_id"], "key", ["t", "id"]).select("bag_id", "key", "id")


@query
def channel_choice_fallback(spark, d):
    rows = messages(spark, d, "purchase", "error").withColumn("fallback", F.col("key") == "error")
    return clean.primary_or_fallback(rows, ["bag_id"], "fallback").select("bag_id", "key", "id")


@query
def fraction_range(spark, d):
    return clean.time_fraction(messages(spark, d), ["bag_id"], "t", 0.25, 0.75).select("bag_id", "id")


@query
def interval_stats(spark, d):
    s = quality.interval_stats(messages(spark, d), ["bag_id", "key"], "t")
    return s.select("bag_id", "key", "n", "n_distinct", *[F.round(c, 3).alias(c) for c in ("min_ms", "max_ms")], "mean_ms", F.round("std_ms", 2).alias("std_ms"))


@query
def camera_timeline_checks(spark, d):
    """Checks that camera timelines fail."""
    frames = table(spark, d, "camera_frames").where("timestamp_us is not null").select("bag_id", "camera", "frame_no", "timestamp_us").distinct()
    return quality.timeline_violations(frames, ["bag_id", "camera"], "timestamp_us").select("bag_id", "camera", "check", F.round("value", 3).alias("value"), "threshold")


@query
def frame_spread(spark, d):
    rows = messages(spark, d).withColumn("frame", F.call_function("div", F.col("t"), F.lit(24 * HOUR)))
    return quality.frame_spread(rows, ["bag_id", "frame"], "key", "t", ["error"])


@query
def error_histogram(spark, d):
    h = quality.error_histogram(_near(spark, d), ["bag_id"], "delta", [HOUR, 2 * HOUR, 6 * HOUR])
    return h.select("bag_id", "n", *[F.col(f"over_{x * HOUR}").alias(f"over_{x}h") for x in (1, 2, 6)], F.round("mean_abs", 3).alias("mean_abs"), "max_abs")


@query
def effective_rate(spark, d):
    return quality.effective_rate(messages(spark, d), ["bag_id", "key"], "t").select("bag_id", "key", F.round(F.col("rate") * 1e6, 6).alias("per_million_s"))


@query
def frame_numbering(spark, d):
    return episodes.number_frames(messages(spark, d), "bag_id", ["t", "id"]).select("id", "frame_index", "index")


@query
def episode_offsets(spark, d):
    return episodes.episode_offsets(messages(spark, d), "bag_id")


def _frames(spark, d) -> DataFrame:
    w = Window.partitionBy("bag_id").orderBy("t", "id")
    return messages(spark, d).select("bag_id", "id", "t", "key", (F.row_number().over(w) - 1).cast("bigint").alias("frame"))


@query
def delta_window(spark, d):
    return episodes.delta_window(_frames(spark, d).select("bag_id", "frame", "id"), "bag_id", "frame", ["id"], [-1, 0, 2])


@query
def regularity_check(spark, d):
    return quality.irregular_rows(_frames(spark, d), "bag_id", "frame", "t", 6 * HOUR, 6 * HOUR).select("bag_id", "frame", "step")


@query
def batch_stitch(spark, d):
    rows = timeline.batches(_frames(spark, d), "frame", 20).withColumn("local", F.col("frame") % 20).withColumn("rel", F.col("local") / 30.0)
    return timeline.stitch(rows, ["bag_id"], "batch", "local", "rel", 1 / 30).select("id", "local", F.round("rel", 6).alias("rel"))


def _aligned(spark, d) -> DataFrame:
    near = _near(spark, d).where("near_t is not null")
    return near.withColumn("frame", (F.row_number().over(Window.partitionBy("bag_id").orderBy("t", "id")) - 1).cast("bigint"))


@query
def stuck_prefix_repair(spark, d):
    return timeline.repair_stuck_prefix(_aligned(spark, d), ["bag_id"], "frame", "t", "near_t", HOUR // 6).select("id", "near_t", "repaired")


@query
def start_offset_search(spark, d):
    rows = _aligned(spark, d).withColumn("spread", F.abs("delta"))
    return timeline.start_offset(rows, ["bag_id"], "frame", "spread", good=2 * HOUR)


def _marks(spark, d) -> DataFrame:
    span = messages(spark, d).groupBy("bag_id").agg(F.min("t").alias("a"), F.max("t").alias("b"), F.count("*").alias("n"))
    rows = messages(spark, d, "purchase").join(span, "bag_id")
    first, last = annotations.overlap_frames(F.col("t"), (F.col("value") * 1e9).cast("bigint"), F.col("a"), F.col("b"), F.col("n"))
    return rows.select("bag_id", "id", "n", first.cast("bigint").alias("first"), last.cast("bigint").alias("last"))


@query
def annotation_frames(spark, d):
    return _marks(spark, d).select("id", "first", "last")


@query
def annotation_chain(spark, d):
    rows = _marks(spark, d).select("bag_id", F.lit("buy").alias("skill"), F.lpad(F.col("id").cast("string"), 12, "0").alias("stamp"), "first", "last", "n")
    return annotations.chain(rows, "bag_id", "skill", "stamp", "first", "last", "n").select("bag_id", "stamp", "start_frame", "end_frame")


@query
def annotation_range(spark, d):
    rows = messages(spark, d).withColumn("k", F.get_json_object("props", "$.k"))
    return annotations.position_range(rows, ["bag_id"], "k", "k")


@query
def metadata_normalise(spark, d):
    files = table(spark, d, "sidecar_files").where("doc_kind = 'metadata'").select("file_id", "body").distinct()
    valid = files.where(F.expr("try_parse_json(body) is not null"))
    return annotations.normalise_metadata(valid, "body").drop("body")


@query
def device_rules(spark, d):
    rules = spark.createDataFrame([("KV66U1013", None, "2026-06-30", "flip"), ("KV66U1013", "2026-07-01", None, "swap"), ("KV28L1048", "2025-06-01", "2026-01-31", "flip")], "device string, since string, until string, action string")
    rows = table(spark, d, "recordings").select("bag_id", "device_sn", F.to_date(F.timestamp_micros("start_us")).cast("string").alias("day")).distinct()
    return annotations.apply_device_rules(rows, rules, "device_sn", "day").select("bag_id", "action")


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select("label", F.col("pos").cast("bigint").alias("pos"), *[F.round(F.col(c).cast("double"), digits).alias(c) for c in ("min", "max", "mean", "std")], "n")


@query
def feature_stats(spark, d):
    return _rounded(stats.feature_stats(vectors(spark, d), ["label"], "v"))


def _parts(spark, d) -> DataFrame:
    parts = vectors(spark, d).withColumn("part", F.col("vec_id") % 7)
    return stats.feature_stats(parts, ["label", "part"], "v")


@query
def stats_merge_parallel(spark, d):
    return _rounded(stats.merge_stats(_parts(spark, d), ["label", "pos"]))


@query
def stats_merge_sumsq(spark, d):
    return _rounded(stats.merge_stats_sumsq(_parts(spark, d), ["label", "pos"]), 5)


@query
def even_sample(spark, d):
    rows = messages(spark, d).select("key", "id", (F.row_number().over(Window.partitionBy("key").orderBy("t", "id")) - 1).cast("bigint").alias("i"))
    return stats.even_sample(rows, ["key"], "i").select("key", "i", "id")


@query
def normalise_features(spark, d):
    v = vectors(spark, d)
    out = stats.normalise(v, stats.feature_stats(v, ["label"], "v"), ["label"], "v")
    return out.select("vec_id", F.posexplode("v").alias("pos", "x")).select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("x", 5).alias("x"))


def _long(df: DataFrame, column: str, digits: int) -> DataFrame:
    return df.select("vec_id", F.posexplode(column).alias("pos", "x")).select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("x").cast("double"), digits).alias("x"))


@query
def vector_slices(spark, d):
    v = vectors(spark, d, 28)
    return _long(v.withColumn("a", V.with_arms(F.col("v"), F.reverse(V.cut(F.col("v"), V.LAYOUT["arm"])))), "a", 6)


@query
def current_to_torque(spark, d):
    return _long(vectors(spark, d, 28).withColumn("a", V.current_to_torque(F.col("v"))), "a", 5)


@query
def torque_round_trip(spark, d):
    return _long(vectors(spark, d, 28).withColumn("a", V.torque_to_current(F.col("v"))), "a", 5)


@query
def hand_normalise(spark, d):
    claw = F.transform(F.slice("v", 1, 2), lambda x: x.cast("double") * 500)
    v = vectors(spark, d, 2).select("vec_id", claw.alias("c"))
    return v.select("vec_id", *[F.round(F.element_at(V.normalise_effector(F.col("c"), "claw", b), i), 5).alias(f"{n}{i}") for b, n in ((True, "on"), (False, "share")) for i in (1, 2)])


@query
def intrinsics_split(spark, d):
    v = vectors(spark, d, 35).select("vec_id", V.intrinsics(F.col("v")).alias("k"))
    return v.select("vec_id", *[F.round(F.col(f"k.{c}").cast("double"), 6).alias(c) for c in ("fx", "fy", "ppx", "ppy", "k1", "k3")])


@query
def frame_difference(spark, d):
    a = vectors(spark, d)
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("w"))
    return a.join(b, "vec_id").select("vec_id", F.round(V.frame_difference(F.col("v"), F.col("w")), 6).alias("diff"))


# a synthetic two-joint arm
_URDF = """<robot><joint name="a" type="revolute"><parent link="base"/><child link="upper"/><origin xyz="0 0 1" rpy="0 0 0"/><axis xyz="0 0 1"/></joint>
<joint name="b" type="revolute"><parent link="upper"/><child link="lower"/><origin xyz="0.5 0 0" rpy="0 0 0"/><axis xyz="0 1 0"/></joint>
<joint name="tool" type="fixed"><parent link="lower"/><child link="tip"/><origin xyz="0.25 0 0" rpy="0 0 0"/></joint></robot>"""


@query
def forward_kinematics(spark, d):
    v = vectors(spark, d, 2).select("vec_id", F.transform("v", lambda x: x.cast("double")).alias("q"))
    return v.select("vec_id", end_pose(_URDF, "tip")("q").alias("p")).select("vec_id", *[F.round(F.element_at("p", i + 1), 6).alias(c) for i, c in enumerate(("x", "y", "z", "qx", "qy", "qz", "qw"))])


def _customers(spark, d) -> DataFrame:
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("frames"))
    c = table(spark, d, "customer").select(F.col("c_nationkey").cast("bigint").alias("dataset"), F.col("c_custkey").alias("episode"))
    return c.join(orders, c.episode == orders.o_custkey).select("dataset", "episode", "frames")


@query
def dataset_merge(spark, d):
    return episodes.merge_datasets(_customers(spark, d), "dataset", "episode", "frames", 95)


@query
def rechunk(spark, d):
    return episodes.rechunk(table(spark, d, "customer").select(F.col("c_custkey").alias("episode_index")), "episode_index", 1000)


@query
def multi_dataset_concat(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return episodes.concat_datasets([c, s], [["key"], ["key"]])


@query
def task_encode(spark, d):
    return episodes.encode_tasks(table(spark, d, "documents").select("source", "doc_id"), "source", ["doc_id"])


@query
def summary_report(spark, d):
    return episodes.summary(_customers(spark, d), "frames", 30.0).select("episodes", "frames", "chunks", F.round("seconds", 6).alias("seconds"), F.round("hours", 6).alias("hours"))


@query
def name_sanitise(spark, d):
    return table(spark, d, "recordings").select("bag_id", V.safe_name(F.col("note")).alias("name")).distinct()


@query
def magic_cut(spark, d):
    rest = V.after_magic(F.encode("text", "UTF-8"), "4B56")
    return table(spark, d, "documents").select("doc_id", F.length(rest).cast("bigint").alias("n_bytes")).where("n_bytes is not null")


@query
def required_topics_anti(spark, d):
    topics = ["/force6d_left_hand_force_torque", "/force6d_right_hand_force_torque", "/leju_claw_state", "/gripper/state"]
    return quality.missing_required(table(spark, d, "messages").select("bag_id", "topic"), ["bag_id"], "topic", topics)


@query
def length_consistency(spark, d):
    lengths = table(spark, d, "camera_frames").groupBy("bag_id", "camera").agg(F.countDistinct("frame_no").alias("frames"))
    return quality.length_mismatches(lengths, "bag_id", "camera", "frames")


@query
def topic_rates(spark, d):
    """Messages a second of every topic of every recording."""
    rows = table(spark, d, "messages").where("timestamp_us is not null").select("bag_id", "topic", "seq", "timestamp_us").distinct()
    return quality.effective_rate(rows, ["bag_id", "topic"], "timestamp_us").select("bag_id", "topic", F.round("rate", 4).alias("rate"))


@query
def frame_insert(spark, d):
    return timeline.insert_frames(messages(spark, d, "view").select("bag_id", "t"), ["bag_id"], "t", 1 / 21_600, HOUR)


@query
def frame_remove(spark, d):
    return timeline.remove_frames(messages(spark, d).select("bag_id", "t"), ["bag_id"], "t", 1 / 36_000)


@query
def continuity_shift(spark, d):
    rows = timeline.batches(_frames(spark, d), "frame", 20)
    return timeline.shift_batches(rows, ["bag_id"], "batch", "t", HOUR, 6 * HOUR, 2 * HOUR).select("id", "t")


@query
def batch_windowed_nearest(spark, d):
    main = timeline.batches(_frames(spark, d).where("key = 'view'"), "frame", 20).select("bag_id", "batch", "t", "id")
    return asof.window_nearest(main, messages(spark, d, "click"), ["bag_id"], "t", "id", "batch", 2 * HOUR, HOUR).select("id", "near_id")


@query
def stream_batches(spark, d):
    """Batches of 20 events per user, the last one with the rest, from a file stream run to its end."""
    from rillframe.streaming.batches import count_batches, last_batches

    where = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    source = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/event[s].parquet")
    rows = source.select(F.col("user_id").alias("bag_id"), epoch_us("ts").alias("t"))
    run = count_batches(rows, "bag_id", "t", 20, HOUR).writeStream.format("parquet").option("path", f"{where}/out").option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    done = spark.read.schema("bag_id bigint, batch bigint, first_t bigint, last_t bigint, n bigint").parquet(f"{where}/out")
    return done.unionByName(last_batches(spark, f"{where}/state", "bag_id", 20))
