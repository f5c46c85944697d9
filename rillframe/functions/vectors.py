"""Vectors of joints and effectors as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layout of the 28 joints and motor coefficients (current to torque)
LAYOUT = {"leg": (0, 12), "left_arm": (12, 19), "right_arm": (19, 26), "arm": (12, 26), "head": (26, 28)}
IMU = {"gyro": (0, 3), "acc": (3, 6), "free_acc": (6, 9), "quat": (9, 13)}
COEFFICIENTS = [
    2, 1.05, 1.05, 2, 2.1, 2.1, 2, 1.05, 1.05, 2, 2.1, 2.1, 1.05, 5, 2.3, 5, 4.7, 4.7, 4.7, 1.05, 5, 2.3, 5, 4.7, 4.7, 4.7, 0.21, 4.7,
]
DIVISOR = {**dict.fromkeys([*range(13, 19), *range(20, 28)], 2.1), **dict.fromkeys([1, 2, 7, 8, 12, 19], 1.2)}


def cut(v: Column, span: tuple[int, int]) -> Column:
    """v[a:b]"""
    return F.slice(v, span[0] + 1, span[1] - span[0])


def with_arms(action: Column, arms: Column) -> Column:
    """The action with its 14 arm joints replaced; unchanged where there are none."""
    return F.when(arms.isNull(), action).otherwise(F.concat(F.slice(action, 1, 12), arms, F.slice(action, 27, 2)))


def _factors() -> Column:
    return F.array(*[F.lit(c / DIVISOR[i] if i in DIVISOR else 1.0) for i, c in enumerate(COEFFICIENTS)])


def current_to_torque(v: Column) -> Column:
    """Torques of measured currents (motors that report torque stay); null for another width."""
    return F.when(F.size(v) == 28, F.zip_with(v.cast("array<double>"), _factors(), lambda x, f: x * f))


def torque_to_current(v: Column) -> Column:
    inverse = F.array(*[F.lit(DIVISOR.get(i, 1.0) / c) for i, c in enumerate(COEFFICIENTS)])
    return F.when(F.size(v) == 28, F.zip_with(v.cast("array<double>"), inverse, lambda x, f: x * f))


def normalise_effector(v: Column, kind: str, binary: bool) -> Column:
    """Claw, hand and gripper positions as 0/1 or as fractions of their range."""
    limit = {"claw": 50.0, "hand": 50.0, "gripper_state": 0.4, "gripper_command": 70.0}[kind]
    full = {"claw": 100.0, "hand": 100.0, "gripper_state": 0.8, "gripper_command": 255.0}[kind]
    return F.transform(v.cast("array<double>"), lambda x: F.when(x > limit, 1.0).otherwise(0.0) if binary else x / full)


def intrinsics(v: Column) -> Column:
    """Camera parameters of a vector D ++ K ++ R ++ P of length 35 or 38, else null."""
    d = F.size(v) - 30
    at = lambda i: F.try_element_at(v, (d + 1 + i).cast("int"))
    dist = lambda i: F.try_element_at(v, F.lit(i + 1))
    fields = [at(0).alias("fx"), at(4).alias("fy"), at(2).alias("ppx"), at(5).alias("ppy"), *[dist(i).alias(n) for i, n in enumerate(("k1", "k2", "p1", "p2", "k3"))]]
    return F.when(F.size(v).isin(35, 38), F.struct(*fields))


def padded(v: Column, width: int) -> Column:
    """The first ``width`` values; zeros where the vector is null or too short."""
    return F.when(F.size(v) >= width, F.slice(v, 1, width).cast("array<float>")).otherwise(F.array_repeat(F.lit(0.0).cast("float"), width))


def halves(v: Column) -> tuple[Column, Column]:
    """Left and right half of a vector of at least 12 values, else null."""
    ok = F.size(v) >= 12
    return F.when(ok, F.slice(v, 1, 6)), F.when(ok, F.slice(v, 7, 6))


def assemble_state(joints: Column, left: Column | None = None, right: Column | None = None, side: str = "both", half_body: bool = False) -> Column:
    """State of one or both arms with their effectors; with the whole body legs come first and the head last."""
    arms = {"left": [cut(joints, LAYOUT["left_arm"]), left], "right": [cut(joints, LAYOUT["right_arm"]), right]}
    parts = [p for s in ("left", "right") if side in (s, "both") for p in arms[s] if p is not None]
    return F.concat(*parts) if half_body or side != "both" else F.concat(cut(joints, LAYOUT["leg"]), *parts, cut(joints, LAYOUT["head"]))


def safe_name(text: Column) -> Column:
    """A dataset name: letters, digits and ``-_.`` kept, others ``_``, no ``._`` at the ends, ``bag`` if nothing is left."""
    kept = F.regexp_replace(text, r"[^\p{L}\p{N}_.\-]", "_")
    return F.coalesce(F.nullif(F.regexp_replace(kept, r"^[._]+|[._]+$", ""), F.lit("")), F.lit("bag"))


def after_magic(data: Column, magic: str) -> Column:
    """Bytes from a magic number (hexadecimal) on; null where it does not occur at a byte boundary."""
    text = F.hex(data)
    at = F.regexp_instr(text, F.lit(f"^(?:[0-9A-F]{{2}})*?{magic}"))
    before = F.length(F.regexp_extract(text, f"^((?:[0-9A-F]{{2}})*?){magic}", 1))
    return F.when(at > 0, F.substring(data, (before / 2 + 1).cast("int"), F.length(data)))


def frame_difference(a: Column, b: Column) -> Column:
    """Mean absolute difference of two equally long vectors."""
    parts = F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))
    return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x) / F.size(a)
