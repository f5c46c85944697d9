"""Forward kinematics of a serial chain read from a robot description (URDF)."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def _rpy(r: float, p: float, y: float) -> np.ndarray:
    cr, sr, cp, sp, cy, sy = np.cos(r), np.sin(r), np.cos(p), np.sin(p), np.cos(y), np.sin(y)
    return np.array([[cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr], [sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr], [-sp, cp * sr, cp * cr]])


def read_chain(urdf: str, tip: str) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """(fixed transform, joint axis or None) from the root to the link ``tip``."""
    joints = {}
    for j in ET.fromstring(urdf).iter("joint"):
        child = j.find("child")
        if child is None:
            continue
        origin, axis = j.find("origin"), j.find("axis")
        numbers = lambda e, a, d: [float(x) for x in (e.get(a) if e is not None and e.get(a) else d).split()]
        t = np.eye(4)
        t[:3, :3], t[:3, 3] = _rpy(*numbers(origin, "rpy", "0 0 0")), numbers(origin, "xyz", "0 0 0")
        turns = j.get("type") in ("revolute", "continuous")
        joints[child.get("link")] = (j.find("parent").get("link"), t, np.array(numbers(axis, "xyz", "1 0 0")) if turns else None)
    chain = []
    while tip in joints:
        tip, t, axis = joints[tip]
        chain.append((t, axis))
    return chain[::-1]


def pose(chain: list[tuple[np.ndarray, np.ndarray | None]], q: np.ndarray) -> np.ndarray:
    """Poses (n, 4, 4) of the tip for joint angles (n, joints)."""
    out, k = np.broadcast_to(np.eye(4), (len(q), 4, 4)).copy(), 0
    for t, axis in chain:
        out = out @ t
        if axis is not None:
            a = axis / np.linalg.norm(axis)
            x = np.array([[0, -a[2], a[1]], [a[2], 0, -a[0]], [-a[1], a[0], 0]])
            s, c = np.sin(q[:, k])[:, None, None], np.cos(q[:, k])[:, None, None]
            turn = np.broadcast_to(np.eye(4), (len(q), 4, 4)).copy()
            turn[:, :3, :3] = np.eye(3) + s * x + (1 - c) * (x @ x)
            out, k = out @ turn, k + 1
    return out


def quaternion(r: np.ndarray) -> np.ndarray:
    """Quaternions (x, y, z, w) with w >= 0 of rotations (n, 3, 3)."""
    m = r
    squares = np.stack([1 + m[:, 0, 0] - m[:, 1, 1] - m[:, 2, 2], 1 - m[:, 0, 0] + m[:, 1, 1] - m[:, 2, 2], 1 - m[:, 0, 0] - m[:, 1, 1] + m[:, 2, 2], 1 + m[:, 0, 0] + m[:, 1, 1] + m[:, 2, 2]], axis=1)
    q = np.sqrt(np.maximum(squares, 0)) / 2
    best = np.argmax(q, axis=1)
    sums = {(0, 1): m[:, 0, 1] + m[:, 1, 0], (0, 2): m[:, 0, 2] + m[:, 2, 0], (1, 2): m[:, 1, 2] + m[:, 2, 1], (0, 3): m[:, 2, 1] - m[:, 1, 2], (1, 3): m[:, 0, 2] - m[:, 2, 0], (2, 3): m[:, 1, 0] - m[:, 0, 1]}
    out = np.empty((len(m), 4))
    for i in range(4):
        rows = best == i
        for j in range(4):
            out[rows, j] = q[rows, i] if i == j else sums[min(i, j), max(i, j)][rows] / (4 * q[rows, i])
    return out * np.where(out[:, 3:] < 0, -1.0, 1.0)


def end_pose(urdf: str, tip: str):
    """A pandas UDF: joint angles to the tip's (x, y, z, qx, qy, qz, qw); null for angles that are missing, not finite or too few."""
    chain = read_chain(urdf, tip)
    joints = sum(a is not None for _, a in chain)

    @F.pandas_udf("array<double>")
    def run(angles: pd.Series) -> pd.Series:
        ok = [a is not None and len(a) >= joints and np.all(np.isfinite(np.asarray(a[:joints], float))) for a in angles]
        out = np.empty(len(angles), object)
        at = np.flatnonzero(ok)
        if len(at):
            p = pose(chain, np.stack([np.asarray(angles.iloc[i][:joints], float) for i in at]))
            both = np.concatenate([p[:, :3, 3], quaternion(p[:, :3, :3])], axis=1)
            for i, row in zip(at, both):
                out[i] = row
        return pd.Series(out)

    return run
