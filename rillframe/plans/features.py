"""Queries of extractors, feature vectors and images, over vectors that stand for decoded messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillframe.functions import images as I
from rillframe.functions import messages as M
from rillframe.functions import vectors as V
from rillframe.operators import stats
from rillframe.plans.registry import Registry
from rillframe.session import table

R = Registry()
TOPICS = list(dict.fromkeys(t for t, *_ in M.EXTRACTORS))


def decoded(spark: SparkSession, d: str) -> DataFrame:
    """Every embedding as one decoded message of each topic; numbers are cut from the vector at fixed places."""
    e = F.col("e")
    cut = lambda a, n: F.slice(e, a, n)
    xyz = lambda a, names=M.XYZ: F.struct(*[F.get(e, F.lit(a - 1 + i)).alias(c) for i, c in enumerate(names)])
    odd = F.col("vec_id") % 3 == 0
    joint = F.struct(cut(1, 28).alias("joint_q"), cut(2, 28).alias("joint_v"), cut(3, 28).alias("joint_vd"), F.when(~odd, cut(4, 28)).alias("joint_current"), cut(5, 28).alias("joint_torque"))
    inertia = F.struct(xyz(41).alias("gyro"), xyz(44).alias("acc"), xyz(47).alias("free_acc"), xyz(50, M.XYZW).alias("quat"))
    names = ("joint_q", "joint_v", "tau", "tau_max", "tau_ratio", "joint_kp", "joint_kd", "control_modes")
    command = F.struct(*[cut(10 + i, 28).alias(n) for i, n in enumerate(names)])
    msg = F.struct(
        joint.alias("joint_data"), inertia.alias("imu_data"), F.when(~odd, cut(20, 14)).alias("position"), command.alias("command"), cut(1, 6).alias("left_hand_position"), cut(7, 6).alias("right_hand_position"),
        F.struct(cut(33, 2).alias("position")).alias("data"), F.struct(xyz(11).alias("force"), xyz(14).alias("torque")).alias("wrench"), F.unhex(F.md5(F.col("vec_id").cast("string"))).alias("bytes"),
        F.struct(cut(1, 5).alias("D"), cut(6, 9).alias("K"), cut(15, 9).alias("R"), cut(24, 12).alias("P"), F.lit("plumb_bob").alias("distortion_model")).alias("camera"),
        F.struct(xyz(60).alias("linear"), xyz(57).alias("angular")).alias("twist"),
    )
    rows = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    return rows.select("vec_id", msg.alias("msg")).withColumn("topic", F.explode(F.array(*map(F.lit, TOPICS))))


def features(spark, d, *keys: str) -> DataFrame:
    wanted = [x for x in M.EXTRACTORS if x[1] in keys]
    long = M.extract(decoded(spark, d), wanted).select("vec_id", "topic", "key", F.posexplode("v").alias("pos", "x"))
    return long.select("vec_id", "topic", "key", F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("x"))


def _slice(topic: str, key: str, first: int, n: int, value: str = "x", where: str = "true") -> str:
    return f"""select vec_id, '{topic}' as topic, '{key}' as key, i as pos, round({value}, 6) as x from
      (select vec_id, i, cast(embedding[{first} + i] as double) as x from embeddings, range({n}) r(i) where {where})"""


def _union(*parts: str) -> str:
    return " union all ".join(parts)


_S = "/sensors_data_raw"


@R.query(_union(*[_slice(_S, k, a, 28) for k, a in (("joint_q", 1), ("joint_v", 2), ("joint_vd", 3))], _slice(_S, "joint_current", 4, 28, where="vec_id % 3 <> 0"), _slice(_S, "joint_current", 5, 28, where="vec_id % 3 = 0")))
def joint_state_features(spark, d):
    """Joint positions, velocities, accelerations, currents (or torques)."""
    return features(spark, d, "joint_q", "joint_v", "joint_vd", "joint_current")


@R.query(_union(*[_slice("/joint_cmd", f"cmd_{k}", 10 + i, 28) for i, k in enumerate(("joint_q", "joint_v", "tau", "tau_max", "tau_ratio", "joint_kp", "joint_kd", "control_modes"))]))
def joint_command_features(spark, d):
    return features(spark, d, *[k for t, k, *_ in M.EXTRACTORS if t == "/joint_cmd"])


@R.query(_slice(_S, "imu", 41, 13))
def imu_features(spark, d):
    return features(spark, d, "imu")


@R.query(_slice("/arm_traj", "arm_traj", 20, 14, "radians(x)", "vec_id % 3 <> 0"))
def arm_trajectory_features(spark, d):
    """Arm trajectories in radians; messages without positions have an empty vector."""
    return features(spark, d, "arm_traj")


@R.query(_union(
    _slice("/control_robot_hand_position", "hand_action", 1, 12), _slice("/control_robot_hand_position_state", "hand_state", 1, 12), _slice("/dexhand/state", "hand_state", 20, 14, where="vec_id % 3 <> 0"),
    _slice("/cb_left_hand_state", "hand_left", 20, 14, where="vec_id % 3 <> 0"), _slice("/cb_right_hand_state", "hand_right", 20, 14, where="vec_id % 3 <> 0"),
))
def hand_features(spark, d):
    return features(spark, d, "hand_action", "hand_state", "hand_left", "hand_right")


@R.query(_union(
    _slice("/leju_claw_state", "claw_state", 33, 2), _slice("/leju_claw_command", "claw_action", 33, 2),
    _slice("/gripper/state", "gripper_state", 20, 14, where="vec_id % 3 <> 0"), _slice("/gripper/command", "gripper_action", 20, 14, where="vec_id % 3 <> 0"),
))
def claw_gripper_features(spark, d):
    return features(spark, d, "claw_state", "claw_action", "gripper_state", "gripper_action")


@R.query(_union(_slice("/force6d_left_hand_force_torque", "force_left", 11, 6), _slice("/force6d_right_hand_force_torque", "force_right", 11, 6)))
def wrench_features(spark, d):
    return features(spark, d, "force_left", "force_right")


@R.query("""select vec_id, '/cb_left_hand_matrix_touch_pc2' as topic, 'touch_left' as key, i as pos, ('0x' || substr(md5(vec_id::varchar), (2 * i + 1)::int, 2))::int::double as x from embeddings, range(16) r(i)""")
def touch_features(spark, d):
    """Bytes of a touch matrix as numbers."""
    return features(spark, d, "touch_left")


@R.query(_slice("/cam_h/color/camera_info", "camera_info", 1, 35))
def camera_info_features(spark, d):
    return features(spark, d, "camera_info")


@R.query("select vec_id, '/cmd_pose_world_synced' as topic, 'base_pose' as key, i as pos, round(cast(embedding[[60, 61, 59][i + 1]] as double), 6) as x from embeddings, range(3) r(i)")
def base_pose_features(spark, d):
    return features(spark, d, "base_pose")


@R.query("select vec_id, octet_length(b) as n_bytes, compressed from (select vec_id, unhex(md5(vec_id::varchar)) as b, unnest([true, false]) as compressed from embeddings)")
def image_bytes(spark, d):
    """Image bytes as they are, with the flag of their topic (compressed topics end in compressed or compressedDepth)."""
    topics = ["/cam_h/depth/image_raw/compressedDepth", "/cam_h/depth/image_raw"]
    rows = decoded(spark, d).where(F.col("topic") == TOPICS[0]).select("vec_id", F.explode(F.array(*map(F.lit, topics))).alias("topic"), F.col("msg.bytes").alias("data"))
    return rows.select("vec_id", F.length("data").cast("bigint").alias("n_bytes"), F.col("topic").rlike("/compressed(Depth)?$").alias("compressed"))


def _vectors(spark, d, **columns) -> DataFrame:
    rows = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    return rows.select("vec_id", *[f(F.col("e")).alias(n) for n, f in columns.items()])


def _long(df: DataFrame, column: str, digits: int = 6) -> DataFrame:
    return df.select("vec_id", F.posexplode(column).alias("pos", "x")).select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("x").cast("double"), digits).alias("x"))


def _at(index: str, n: int, value: str = "x") -> str:
    return f"select vec_id, i as pos, round({value}, 6) as x from (select vec_id, i, cast(embedding[{index}] as double) as x from embeddings, range({n}) r(i))"


# whole body with claws: legs, left arm, left claw, right arm, right claw, head
@R.query(_at("case when i < 19 then i + 1 when i = 19 then 41 when i < 27 then i when i = 27 then 42 else i - 1 end", 30))
def state_assembly(spark, d):
    """State of the whole body with claws: 30 wide, claws after their arms."""
    df = _vectors(spark, d, joints=lambda e: F.slice(e, 1, 28), left=lambda e: F.slice(e, 41, 1), right=lambda e: F.slice(e, 42, 1))
    return _long(df.select("vec_id", V.assemble_state(F.col("joints"), F.col("left"), F.col("right")).alias("s")), "s")


@R.query(_at("case when i < 7 then i + 20 else i + 34 end", 13))
def state_assembly_right(spark, d):
    """State of the right arm with a hand of six joints."""
    df = _vectors(spark, d, joints=lambda e: F.slice(e, 1, 28), right=lambda e: F.slice(e, 41, 6))
    return _long(df.select("vec_id", V.assemble_state(F.col("joints"), None, F.col("right"), "right", True).alias("s")), "s")


_PARTS = {"leg": (0, 12), "arm": (12, 14), "head": (26, 2), "gyro": (40, 3), "acc": (43, 3), "free_acc": (46, 3), "quat": (49, 4)}


@R.query(" union all ".join(f"select vec_id, '{k}' as part, i as pos, round(cast(embedding[{a + 1} + i] as double), 6) as x from embeddings, range({n}) r(i)" for k, (a, n) in _PARTS.items()))
def named_parts(spark, d):
    """Legs, arms and head of a joint vector; gyro, accelerations and quaternion of an inertial one."""
    df = _vectors(spark, d, joints=lambda e: F.slice(e, 1, 28), imu=lambda e: F.slice(e, 41, 13))
    spans = [F.struct(F.lit(k).alias("part"), V.cut(F.col("joints"), V.LAYOUT[k]).alias("v")) for k in ("leg", "arm", "head")] + [F.struct(F.lit(k).alias("part"), V.cut(F.col("imu"), s).alias("v")) for k, s in V.IMU.items()]
    long = df.select("vec_id", F.explode(F.array(*spans)).alias("p")).select("vec_id", "p.part", F.posexplode("p.v").alias("pos", "x"))
    return long.select("vec_id", "part", F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("x"))


@R.query(f"select vec_id, pos, case when vec_id % 4 = 0 then 0.0::double else x end as x from ({_at('i + 1', 14)})")
def padded_lookup(spark, d):
    """The first 14 values where there are as many, else zeros."""
    df = _vectors(spark, d, v=lambda e: F.slice(e, 1, 14)).withColumn("v", F.when(F.col("vec_id") % 4 != 0, F.col("v")))
    return _long(df.select("vec_id", V.padded(F.col("v"), 14).alias("p")), "p")


@R.query("select vec_id, round(cast(embedding[1] as double), 6) as left_first, round(cast(embedding[7] as double), 6) as right_first from embeddings where vec_id % 2 = 0 union all select vec_id, null, null from embeddings where vec_id % 2 = 1")
def hand_halves(spark, d):
    """Left and right half of 12-vectors; null for shorter ones."""
    df = _vectors(spark, d, a=lambda e: F.slice(e, 1, 12), b=lambda e: F.slice(e, 1, 11)).withColumn("v", F.when(F.col("vec_id") % 2 == 0, F.col("a")).otherwise(F.col("b")))
    left, right = V.halves(F.col("v"))
    return df.select("vec_id", F.round(F.get(left, F.lit(0)), 6).alias("left_first"), F.round(F.get(right, F.lit(0)), 6).alias("right_first"))


@R.query(f"select * from ({_at('i + 1', 17)}) union all select vec_id, 17, case when vec_id % 5 = 0 then 1.0::double else 0.0 end from embeddings")
def gap_flag_append(spark, d):
    """Actions with the base's pose and the flag of a gap in the arm trajectory."""
    arm = F.when(F.col("vec_id") % 5 == 0, F.array(F.lit(0.0), F.lit(999.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0)))
    df = _vectors(spark, d, action=lambda e: F.slice(e, 1, 14), pose=lambda e: F.slice(e, 15, 3))
    return _long(df.select("vec_id", M.with_flag(F.col("action"), F.col("pose"), arm).alias("v")), "v")


_DEPTH = "f as (select vec_id, i as pos, least(greatest(round(cast(embedding[i + 1] as double) * 4000), 100), 900) as c from embeddings, range(64) r(i)), m as (select vec_id, min(c) lo, max(c) hi from f group by 1)"


@R.query(f"with {_DEPTH} select vec_id, pos, trunc((c - lo) / (hi - lo + 1e-9::double) * 255)::double as x from f join m using (vec_id)")
def depth_clip(spark, d):
    """Depth frames clipped to a range and scaled to bytes by their own range."""
    df = _vectors(spark, d, f=lambda e: F.transform(e, lambda x: F.round(x * 4000)))
    return _long(df.select("vec_id", M.clip_depth(F.col("f"), 100.0, 900.0).alias("v")), "v")


@R.query("select vec_id, n from (select vec_id, case when vec_id % 3 = 0 then null when vec_id % 3 = 1 then 6 else 2 end as n from embeddings) where n is not null")
def effector_selection(spark, d):
    """Width of the effector that moves: the wider where both do, none where neither does."""
    zero = F.transform(F.slice("e", 1, 2), lambda x: F.lit(0.0))
    df = _vectors(spark, d, e=lambda e: e)
    hand = F.when(F.col("vec_id") % 3 == 1, F.slice("e", 1, 6)).otherwise(zero)
    claw = F.when(F.col("vec_id") % 3 == 0, zero).otherwise(F.slice("e", 7, 2))
    return df.select("vec_id", F.size(M.busier(claw, hand)).cast("bigint").alias("n")).where("n > 0")


@R.query("select camera, case camera when 'head_cam_h' then 'head' when 'wrist_cam_l' then 'hand_left' when 'wrist_cam_r' then 'hand_right' when 'camera_top' then 'head' when 'camera_wrist_left' then 'hand_left' when 'camera_wrist_right' then 'hand_right' else camera end as name, count(*) as n from camera_frames group by 1")
def camera_names(spark, d):
    return table(spark, d, "camera_frames").groupBy("camera").agg(F.count("*").alias("n")).select("camera", M.camera_name(F.col("camera")).alias("name"), "n")


@R.query("select vec_id, round(cast(embedding[1] as double), 6) as \"arm/left\", round(cast(embedding[2] as double), 6) as \"arm/right\", round(cast(embedding[3] as double), 6) as head from embeddings")
def nested_round_trip(spark, d):
    """Columns named by paths nested into structs and flattened again."""
    flat = _vectors(spark, d, e=lambda e: e).select("vec_id", *[F.round(F.get("e", F.lit(i)), 6).alias(n) for i, n in enumerate(("arm/left", "arm/right", "head"))])
    return M.flatten_fields(M.nest_fields(flat))


@R.query("select * from (values ('embedding', 'float', 64), ('label', 'int', 1), ('vec_id', 'bigint', 1)) t(feature, kind, width)")
def feature_schema(spark, d):
    """Features of a frame table with element type and width."""
    df = table(spark, d, "embeddings")
    width = df.select(F.max(F.size("embedding"))).first()[0]
    rows = [(f, k, int(s[0])) for f, k, s in M.feature_specs(df, {"embedding": width})]
    return spark.createDataFrame(rows, "feature string, kind string, width bigint")


# images: the 64 values as 8 x 8 pixels of one channel, or 4 x 4 of three and one spare
_PIX = "p as (select vec_id, cast(label as bigint) as label, i, cast(floor(abs(cast(embedding[i + 1] as double)) * 255) as bigint) % 256 as x from embeddings, range(64) r(i))"


def _pixels(spark, d) -> DataFrame:
    pix = F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 255) % 256)
    return table(spark, d, "embeddings").select("vec_id", F.col("label").cast("bigint").alias("label"), pix.alias("pixels"))


@R.query(f"with {_PIX} select vec_id, 63 - i as pos, x::double as x from p")
def rotate_180(spark, d):
    """Frames of one channel turned by half a turn."""
    return _long(_pixels(spark, d).withColumn("v", I.rotate_180(F.col("pixels"))), "v")


@R.query(f"with {_PIX} select vec_id, (15 - i // 4) * 4 + i % 4 as pos, x::double as x from p")
def rotate_180_channels(spark, d):
    """Frames of four channels turned by half a turn."""
    return _long(_pixels(spark, d).withColumn("v", I.rotate_180(F.col("pixels"), 4)), "v")


@R.query(f"with {_PIX}, k as (select i as pos, (i // 2 // 6) * 4 // 3 as r, (i // 2 % 6) * 8 // 6 as c, i % 2 as ch from range(36) r(i)) select vec_id, k.pos, x::double as x from k join p on p.i = (r * 8 + c) * 2 + ch")
def image_resize(spark, d):
    """Frames of 4 x 8 pixels and two channels as 3 x 6 pixels."""
    return _long(_pixels(spark, d).withColumn("v", I.resize(F.col("pixels"), (4, 8), (3, 6), 2)), "v")


_HOT = f"{_PIX}, h as (select vec_id, i, i // 8 as r, i % 8 as c, case when i = vec_id % 64 then 20000 else x + 400 end as x from p)"


@R.query(f"""with {_HOT}, q as (select a.vec_id, trunc(avg(b.x))::bigint as m from h a join h b on a.vec_id = b.vec_id and abs(a.r - b.r) <= 3 and abs(a.c - b.c) <= 3 and b.x < 10000 where a.x >= 10000 group by 1)
  select vec_id, i as pos, (case when x >= 10000 then m else x end)::double as x from h join q using (vec_id)""")
def depth_denoise(spark, d):
    """Depth frames with a hot pixel, which takes the mean around it."""
    hot = F.transform("pixels", lambda x, i: F.when(i == F.col("vec_id") % 64, F.lit(20_000).cast("bigint")).otherwise(x + 400))
    return _long(_pixels(spark, d).withColumn("f", hot).withColumn("v", I.denoise_frames(8, 8)("f")), "v")


@R.query("""select vec_id, 'embedding' as feature, case when vec_id % 7 = 0 then 'missing' else 'width' end as reason from embeddings where vec_id % 7 = 0 or vec_id % 5 = 0
  union all select vec_id, 'state', 'absent' from embeddings""")
def frame_violations(spark, d):
    """Frames whose features are absent, null or of another width than given."""
    e = table(spark, d, "embeddings").withColumn("embedding", F.when(F.col("vec_id") % 7 == 0, None).when(F.col("vec_id") % 5 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding")))
    return M.frame_violations(e, "vec_id", {"embedding": 64, "label": None, "state": 28})


_SAMPLE = """r as (select vec_id, cast(label as bigint) as label, row_number() over (partition by label order by vec_id) - 1 as k, count(*) over (partition by label) as n from embeddings),
  s as (select *, greatest(least(n, 100), least(cast(trunc(pow(n, 0.75)) as bigint), 10000)) as m from r),
  w as (select distinct label, cast(round_even(j * (n - 1) / nullif(m - 1, 0)::double, 0) as bigint) as k from (select distinct label, n, m, unnest(range(0, m)) as j from s)),
  c as (select vec_id from r join w using (label, k))"""


def _stats_sql(scale: str) -> str:
    return f"""with {_PIX}, {_SAMPLE} select label, i % 4 as channel, round(min(x) / {scale}, 6) as min, round(max(x) / {scale}, 6) as max, round(avg(x) / {scale}, 6) as mean,
      round(stddev_pop(x) / {scale}, 6) as std, count(distinct vec_id) as n from p join c using (vec_id) group by 1, 2"""


def _image_stats(spark, d, scale: float) -> DataFrame:
    out = stats.image_stats(_pixels(spark, d), ["label"], ["vec_id"], "pixels", 4, scale)
    return out.select("label", "channel", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")], "n")


@R.query(_stats_sql("255.0::double"))
def image_stats(spark, d):
    """Statistics of sampled frames per channel, on the scale 0 to 1."""
    return _image_stats(spark, d, 255.0)


@R.query(_stats_sql("1.0::double"))
def depth_stats(spark, d):
    """The same frames sampled for 16-bit depth, which keeps its scale."""
    return _image_stats(spark, d, 1.0)
