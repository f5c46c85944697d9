"""From raw messages to feature vectors: extractors per topic, their registry, and vectors of features.

A raw message row has (bag_id, topic, received_us, msg), where ``msg`` is the decoded message as a
struct.  An extractor is a function of the struct to a vector; any number of keys may be fed by one
topic, and a key by a primary and a fallback topic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

XYZ, XYZW = ("x", "y", "z"), ("x", "y", "z", "w")


def at(msg: Column, path: str) -> Column:
    for part in path.split("."):
        msg = msg[part]
    return msg


def vector(path: str) -> Callable[[Column], Column]:
    """The array at a path as doubles; an empty one where it is missing."""
    return lambda m: F.coalesce(at(m, path).cast("array<double>"), F.array().cast("array<double>"))


def parts(*paths: str, names: tuple[str, ...] = XYZ) -> Callable[[Column], Column]:
    """Named numbers under some paths, in order; null where one of the structs is missing."""
    return lambda m: F.when(F.lit(True) if not paths else ~F.exists(F.array(*[at(m, p).isNull() for p in paths]), lambda x: x), F.array(*[at(m, p)[n].cast("double") for p in paths for n in names]))


def imu(m: Column) -> Column:
    """Gyro, acceleration, free acceleration, quaternion: 13 numbers."""
    return F.concat(parts("imu_data.gyro", "imu_data.acc", "imu_data.free_acc")(m), parts("imu_data.quat", names=XYZW)(m))


def current_or_torque(m: Column) -> Column:
    """The measured current, or what older messages call torque."""
    return F.coalesce(at(m, "joint_data.joint_current"), at(m, "joint_data.joint_torque")).cast("array<double>")


def radians(path: str) -> Callable[[Column], Column]:
    return lambda m: F.transform(vector(path)(m), lambda x: F.radians(x))


def hands(m: Column) -> Column:
    return F.concat(vector("left_hand_position")(m), vector("right_hand_position")(m))


def octets(data: Column) -> Column:
    """Bytes as numbers 0 to 255."""
    text = F.hex(data)
    return F.when(F.length(data) > 0, F.transform(F.sequence(F.lit(0), F.length(data) - 1), lambda i: F.conv(F.substring(text, 2 * i + 1, F.lit(2)), 16, 10).cast("double"))).otherwise(F.when(data.isNotNull(), F.array().cast("array<double>")))


def camera_info(m: Column) -> Column:
    """Distortion, intrinsic, rectification and projection numbers in one vector."""
    return F.concat(*[at(m, f"camera.{c}").cast("array<double>") for c in "DKRP"])


def base_pose(m: Column) -> Column:
    return F.array(*[at(m, p).cast("double") for p in ("twist.linear.x", "twist.linear.y", "twist.angular.z")])


# Topics, the keys they feed, and whether a topic is the key's fallback
EXTRACTORS: list[tuple[str, str, bool, Callable[[Column], Column]]] = [
    ("/sensors_data_raw", "joint_q", False, vector("joint_data.joint_q")),
    ("/sensors_data_raw", "joint_v", False, vector("joint_data.joint_v")),
    ("/sensors_data_raw", "joint_vd", False, vector("joint_data.joint_vd")),
    ("/sensors_data_raw", "joint_current", False, current_or_torque),
    ("/sensors_data_raw", "imu", False, imu),
    ("/arm_traj", "arm_traj", False, radians("position")),
    *[("/joint_cmd", f"cmd_{c}", False, vector(f"command.{c}")) for c in ("joint_q", "joint_v", "tau", "tau_max", "tau_ratio", "joint_kp", "joint_kd", "control_modes")],
    ("/control_robot_hand_position", "hand_action", False, hands),
    ("/control_robot_hand_position_state", "hand_state", False, hands),
    ("/dexhand/state", "hand_state", True, vector("position")),
    ("/cb_left_hand_state", "hand_left", False, vector("position")),
    ("/cb_right_hand_state", "hand_right", False, vector("position")),
    ("/leju_claw_state", "claw_state", False, vector("data.position")),
    ("/leju_claw_command", "claw_action", False, vector("data.position")),
    ("/gripper/state", "gripper_state", False, vector("position")),
    ("/gripper/command", "gripper_action", False, vector("position")),
    ("/force6d_left_hand_force_torque", "force_left", False, parts("wrench.force", "wrench.torque")),
    ("/force6d_right_hand_force_torque", "force_right", False, parts("wrench.force", "wrench.torque")),
    ("/cb_left_hand_matrix_touch_pc2", "touch_left", False, lambda m: octets(m["bytes"])),
    ("/cam_h/color/camera_info", "camera_info", False, camera_info),
    ("/cmd_pose_world_synced", "base_pose", False, base_pose),
]


def extract(messages: DataFrame, extractors: list[tuple[str, str, bool, Callable[[Column], Column]]] = EXTRACTORS, msg: str = "msg", topic: str = "topic") -> DataFrame:
    """One row per message and key its topic feeds: the other columns, key, is_fallback and ``v``.

    The time of a message stays the one at which it was received; a stamp in the message's header is not
    taken.  Messages of other topics have no row; a robot's name before ``arm_traj`` makes no difference.
    Extractors are column expressions (or pandas UDFs), so they travel to the executors with the plan.
    """
    named = F.regexp_replace(F.col(topic), r"^/[A-Za-z0-9]+_arm_traj$", "/arm_traj")
    by_topic: dict[str, list] = {}
    for t, key, fallback, f in extractors:
        by_topic.setdefault(t, []).append((key, fallback, f))
    rest = [c for c in messages.columns if c != msg]
    fed = None
    for t, keys in by_topic.items():
        values = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(b).alias("is_fallback"), f(F.col(msg)).alias("v")) for k, b, f in keys])
        fed = F.when(named == t, values) if fed is None else fed.when(named == t, values)
    known = messages.where(named.isin(list(by_topic)))
    return known.select(*rest, F.explode(fed).alias("_f")).select(*rest, "_f.*")


def with_flag(v: Column, pose: Column, arm: Column) -> Column:
    """A vector with the base's pose and 1 if the arm trajectory holds the gap mark 999, else 0, appended."""
    return F.concat(v.cast("array<double>"), pose.cast("array<double>"), F.array(F.exists(arm, lambda x: x == 999.0).cast("double")))


def busier(a: Column, b: Column) -> Column:
    """Of two effector vectors the one that is not all zero; of two such the wider, the first if equal; else null."""
    used = lambda v: F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    return F.when(used(a) & used(b), F.when(F.size(b) > F.size(a), b).otherwise(a)).when(used(a), a).when(used(b), b)


# Short names of cameras
CAMERA_NAMES = {"head_cam_h": "head", "wrist_cam_l": "hand_left", "wrist_cam_r": "hand_right", "camera_top": "head", "camera_wrist_left": "hand_left", "camera_wrist_right": "hand_right"}


def camera_name(name: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in CAMERA_NAMES.items() for x in kv]), name), name)


def clip_depth(v: Column, low: float, high: float) -> Column:
    """Depth values clipped, scaled by their own range to whole numbers 0 to 255."""
    cut = F.transform(v.cast("array<double>"), lambda x: F.least(F.greatest(x, F.lit(low)), F.lit(high)))
    return F.transform(F.array(cut), lambda c: F.transform(c, lambda x: ((x - F.array_min(c)) / (F.array_max(c) - F.array_min(c) + 1e-9) * 255).cast("int")))[0]


def flatten_fields(df: DataFrame, sep: str = "/") -> DataFrame:
    """Nested structs as columns named by their paths."""

    def leaves(schema, path: tuple[str, ...]) -> list[tuple[str, ...]]:
        return [leaf for f in schema.fields for leaf in (leaves(f.dataType, (*path, f.name)) if f.dataType.typeName() == "struct" else [(*path, f.name)])]

    return df.select(*[F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path in leaves(df.schema, ())])


def nest_fields(df: DataFrame, sep: str = "/") -> DataFrame:
    """The reverse of :func:`flatten_fields`."""

    def build(names: list[tuple[tuple[str, ...], str]]) -> list[Column]:
        heads = dict.fromkeys(p[0] for p, _ in names)
        out = []
        for h in heads:
            mine = [(p[1:], c) for p, c in names if p[0] == h]
            out.append(F.col(f"`{mine[0][1]}`").alias(h) if not mine[0][0] else F.struct(*build(mine)).alias(h))
        return out

    return df.select(*build([(tuple(c.split(sep)), c) for c in df.columns]))


def feature_specs(df: DataFrame, fixed: dict[str, int]) -> list[tuple[str, str, list[int]]]:
    """(feature, element type, shape) of a frame table: arrays have the width given in ``fixed``, others shape (1)."""
    out = []
    for f in df.schema.fields:
        array = f.dataType.typeName() == "array"
        kind = f.dataType.elementType if array else f.dataType
        out.append((f.name, kind.simpleString(), [fixed.get(f.name, 0)] if array else [1]))
    return out


def joint_names(side: str, effector: str, fingers: int = 6, body: bool = False) -> list[str]:
    """Names of the state's components: arm joints of the side or sides with their effector, with the body legs first and head last."""
    tails = {"claw": ["claw"], "hand": [f"finger_{i + 1}" for i in range(fingers)], "none": []}[effector]
    sides = ["left", "right"] if side == "both" else [side]
    arms = [f"{s}_{n}" for s in sides for n in [*(f"arm_joint_{i + 1}" for i in range(7)), *tails]]
    legs = [f"{s}_leg_joint_{i + 1}" for s in ("left", "right") for i in range(6)]
    return [*legs, *arms, "head_joint_1", "head_joint_2"] if body else arms


def frame_violations(frames: DataFrame, row_id: str, wanted: dict[str, int | None]) -> DataFrame:
    """(row_id, feature, reason) of features that a frame lacks: ``absent`` from the table, ``missing`` (null), or of another ``width`` than given (null: any)."""
    bad = []
    for name, width in wanted.items():
        if name not in frames.columns:
            reason = F.lit("absent")
        else:
            off = F.size(name) != width if width is not None else F.lit(False)
            reason = F.when(F.col(name).isNull(), "missing").when(off, "width")
        bad.append(F.when(reason.isNotNull(), F.struct(F.lit(name).alias("feature"), reason.alias("reason"))))
    return frames.select(row_id, F.explode(F.filter(F.array(*bad), lambda x: x.isNotNull())).alias("b")).select(row_id, "b.*")
