"""Queries of the general data-preparation problems (p1 to p7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillframe.operators.drift import consistent_cells, consistent_table, schema_changes
from rillframe.operators.grid import latest_revision, regular_grid
from rillframe.operators.instants import length_us, normalise_instants
from rillframe.operators.intervals import periods_and_gaps
from rillframe.operators.nearest import nearest_within
from rillframe.operators.outliers import implausible_readings
from rillframe.operators.units import convert_units
from rillframe.session import table

SENSOR_TOPICS = ["/force6d_left_hand_force_torque", "/force6d_right_hand_force_torque", "/leju_claw_state", "/gripper/state"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    steps = table(spark, d, "steps").where("step_end > step_start")
    ppm = steps.select("bag_id", *[F.round(F.col(c) * 1_000_000).cast("bigint").alias(n) for c, n in (("step_start", "start_ppm"), ("step_end", "end_ppm"))])
    return periods_and_gaps(ppm, "bag_id", "start_ppm", "end_ppm")


def p2_values(spark: SparkSession, d: str) -> DataFrame:
    """Every readable value in newton metres or amperes."""
    fields = {"effort": ("effort", "effort_unit", "torque"), "current_value": ("current_value", "current_unit", "current")}
    return convert_units(table(spark, d, "joint_states"), table(spark, d, "recordings"), "reading_id", "bag_id", fields, "note")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    other = p2_values(spark, d).where("value is not null and unit not in ('N·m', 'A')")
    return other.select("reading_id", "field", F.round(F.col("value") * 1000).cast("bigint").alias("value_milli")).distinct()


# Positions run from 0 to 100, no base moves at 10 m/s or turns at 10 rad/s; commands may hold a value
_LIMITS = {t: (0.0, 100.0) for t in ("/leju_claw_state", "/leju_claw_command", "/gripper/state")} | {"/cmd_pose_world_synced": (-10.0, 10.0)}
_COMMANDS = ["/leju_claw_command", "/cmd_pose_world_synced"]


def p3_flags(spark: SparkSession, d: str) -> DataFrame:
    """Every reading that is out of line, with the reasons."""
    windows = table(spark, d, "recordings").select("bag_id", F.col("start_us").alias("low"), F.col("end_us").alias("high"))
    return implausible_readings(table(spark, d, "messages"), windows, "bag_id", "device_sn", "topic", "seq", "timestamp_us", "data", _LIMITS, _COMMANDS)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_flags(spark, d).select("bag_id", "topic", "seq")


def p3_outside(spark: SparkSession, d: str) -> DataFrame:
    """Readings whose time is not in their recording."""
    return p3_flags(spark, d).where("outside").select("bag_id", "topic", "seq")


def p3_stuck(spark: SparkSession, d: str) -> DataFrame:
    """Readings in runs of at least twenty equal values of a component that otherwise changes."""
    return p3_flags(spark, d).where("stuck").select("bag_id", "topic", "seq")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    frames = table(spark, d, "camera_frames")
    force = table(spark, d, "messages").where((F.col("topic") == SENSOR_TOPICS[0]) & (F.size("data") > 0))
    return nearest_within(frames, force, "bag_id", "timestamp_us", ("camera", "frame_no"), "timestamp_us", "seq", 10_000)


def _grid_of_recordings(spark: SparkSession, d: str) -> DataFrame:
    """One row per recording with the grid its configuration sets: (bag_id, start, stop, rate, per)."""
    recordings = table(spark, d, "recordings").groupBy("bag_id").agg(F.max("start_us").alias("start"), F.max("end_us").alias("stop"))
    config = latest_revision(table(spark, d, "bag_config"), "bag_id", "revision", ["train_hz", "main_timeline_fps"])
    hz = F.when(F.col("train_hz") > 0, F.col("train_hz")).otherwise(10)
    fps = F.when(F.col("main_timeline_fps") > 0, F.col("main_timeline_fps")).otherwise(30)
    jump = F.greatest(F.lit(1).cast("bigint"), (fps - fps % hz) / hz).cast("bigint")
    return recordings.join(config, "bag_id", "left").select("bag_id", "start", "stop", fps.cast("bigint").alias("rate"), (jump * 1_000_000).alias("per"))


def p5_series(spark: SparkSession, d: str) -> DataFrame:
    """The whole regular series, values included."""
    messages = table(spark, d, "messages").where(F.col("topic").isin(SENSOR_TOPICS))
    return regular_grid(messages, _grid_of_recordings(spark, d), "bag_id", "topic", "timestamp_us", "data")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_series(spark, d).where("status <> 'observed'").select("bag_id", "topic", "slot")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    marks = table(spark, d, "marks")
    devices = table(spark, d, "devices").groupBy("device_sn").agg(F.max("time_zone").alias("zone"))
    recordings = table(spark, d, "recordings").groupBy("bag_id").agg(F.max("device_sn").alias("device_sn"), F.min("start_us").alias("low"), F.max("end_us").alias("high"))
    windows = recordings.join(devices, "device_sn", "left")
    instants = normalise_instants(marks, windows, "mark_id", "bag_id", ["mark_start", "mark_end", "trigger_time"], clock="device_sn")
    lengths = marks.select("mark_id", F.lit("duration").alias("field"), length_us(F.col("duration")).alias("value_us")).where("value_us is not null").distinct()
    return instants.unionByName(lengths)


_SIDECAR = ("exporter", "written_at", "file_id", "body")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return schema_changes(table(spark, d, "sidecar_files"), *_SIDECAR)


def p7_cells(spark: SparkSession, d: str) -> DataFrame:
    """Every value of every body under its last name and type, and by which rule."""
    return consistent_cells(table(spark, d, "sidecar_files"), *_SIDECAR)


def p7_kept(spark: SparkSession, d: str) -> DataFrame:
    """Per readable body the number of its top-level fields that the cells hold, and of cells that have another type than their field or were lost."""
    cells = p7_cells(spark, d)
    top = F.when(F.col("rule") != "default", F.substring_index("written_as", "[].", 1))
    types = cells.groupBy("exporter", "field").agg(F.countDistinct("type").alias("types"))
    odd = cells.join(types, ["exporter", "field"]).where("types > 1 and rule <> 'kept'")
    per = cells.groupBy("file_id").agg(F.countDistinct(top).alias("fields"))
    return per.join(odd.groupBy("file_id").agg(F.count("*").alias("odd")), "file_id", "left").select("file_id", "fields", F.coalesce("odd", F.lit(0)).alias("odd"))


def p7_table(spark: SparkSession, d: str) -> DataFrame:
    """One consistent table of all bodies, one typed column per field."""
    return consistent_table(table(spark, d, "sidecar_files"), *_SIDECAR)


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p2_values, p3_found, p3_flags, p3_outside, p3_stuck, p4_found, p5_found, p5_series, p6_found, p7_found, p7_cells, p7_kept, p7_table)}
