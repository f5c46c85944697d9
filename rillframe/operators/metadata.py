"""Metadata of recordings: bodies of two generations, their actions, checks, gates; sidecar files, structure, configuration."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ACTION = "array<struct<markStart string, triggerTime string, duration string, duration_s string, startPosition string, start_position string, endPosition string, end_position string, skillAtomic string, skill_atomic_en string, skillDetail string, skill_detail string, enSkillDetail string, en_skill_detail string, markType string, mark_type string>>"


def _text(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def is_json(body: str) -> Column:
    """Whether a body is one whole JSON object."""
    return F.coalesce(F.try_parse_json(body).isNotNull() & F.trim(F.col(body)).startswith("{"), F.lit(False))


def quarantine(df: DataFrame, body: str) -> tuple[DataFrame, DataFrame]:
    """(readable rows, unreadable rows with a ``reason``)."""
    ok = is_json(body)
    reason = F.when(F.col(body).isNull() | (F.trim(body) == ""), "empty").otherwise("unreadable")
    return df.where(ok), df.where(~ok).withColumn("reason", reason)


def actions(df: DataFrame, row_id: str, body: str) -> DataFrame:
    """(row_id, generation, place, stamp, duration_s, start_position, end_position, skill, text, is_mistake): the annotated actions of JSON bodies.

    New bodies have ``marks``, old ones ``moments``; a duration may carry an ``s``.  An action of the type
    ``retry`` is a mistake; bodies without actions have no row.
    """
    marks, moments = F.get_json_object(body, "$.marks"), F.get_json_object(body, "$.moments")
    new = F.coalesce(marks.startswith("["), F.lit(False))
    listed = F.from_json(F.when(new, marks).otherwise(moments), _ACTION)
    rows = df.select(F.col(row_id), F.when(new, "new").otherwise("old").alias("generation"), F.posexplode(listed).alias("place", "a"))
    pick = lambda *names: F.coalesce(*[_text(F.col("a")[n]) for n in names])
    number = lambda *names: F.regexp_replace(pick(*names), "s$", "").try_cast("double")
    return rows.where("a is not null").select(
        row_id, "generation", F.col("place").cast("bigint").alias("place"), pick("markStart", "triggerTime").alias("stamp"), number("duration", "duration_s").alias("duration_s"),
        number("startPosition", "start_position").alias("start_position"), number("endPosition", "end_position").alias("end_position"), pick("skillAtomic", "skill_atomic_en").alias("skill"),
        F.regexp_replace(pick("enSkillDetail", "en_skill_detail", "skillDetail", "skill_detail"), "_", " ").alias("text"), F.coalesce(pick("markType", "mark_type") == "retry", F.lit(False)).alias("is_mistake"),
    )


def position_ranges(found: DataFrame, row_id: str) -> DataFrame:
    """(row_id, low, high): least start and greatest end of the actions; the old generation's only where the new has none."""
    end = F.coalesce("end_position", "start_position")
    of = lambda g: (F.min(F.when(F.col("generation") == g, F.col("start_position"))), F.max(F.when(F.col("generation") == g, end)))
    (a, b), (c, e) = of("new"), of("old")
    return found.groupBy(row_id).agg(F.coalesce(a, c).alias("low"), F.coalesce(b, e).alias("high"))


def metadata_violations(normalised: DataFrame, found: DataFrame, row_id: str) -> DataFrame:
    """(row_id, place, missing): what the strict check misses in a body (place null) or in one of its actions."""
    body = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ("scene", "sub_scene", "task", "device")], F.when(F.col("n_marks") == 0, F.lit("marks")))
    one = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ("stamp", "duration_s", "skill")])
    present = lambda a: F.explode(F.filter(a, lambda x: x.isNotNull())).alias("missing")
    return normalised.select(row_id, F.lit(None).cast("bigint").alias("place"), present(body)).unionByName(found.select(row_id, "place", present(one)))


def write_gate(normalised: DataFrame, moments: Column) -> DataFrame:
    """Adds ``writable``: a body of the new generation, or of the old with moments."""
    return normalised.withColumn("writable", (F.col("generation") == "new") | F.coalesce(moments.startswith("["), F.lit(False)))


def frame_size(body: str, *paths: tuple[str, str], default: tuple[int, int] = (480, 848)) -> tuple[Column, Column]:
    """Height and width from the first pair of JSON paths that has both, else the default."""
    pairs = [(F.get_json_object(body, h).try_cast("bigint"), F.get_json_object(body, w).try_cast("bigint")) for h, w in paths]
    both = [F.when(h.isNotNull() & w.isNotNull(), F.struct(h.alias("h"), w.alias("w"))) for h, w in pairs]
    size = F.coalesce(*both, F.struct(F.lit(default[0]).cast("bigint").alias("h"), F.lit(default[1]).cast("bigint").alias("w")))
    return size["h"], size["w"]


def resolve_sidecars(recordings: DataFrame, files: DataFrame, row_id: str, candidates: list[str]) -> DataFrame:
    """(row_id, path): of the candidate paths of a recording, given in columns in order of priority, the first that exists."""
    tried = recordings.select(row_id, F.posexplode(F.array(*candidates)).alias("_rank", "path")).where("path is not null")
    there = tried.join(files.select("path").distinct(), "path")
    best = there.groupBy(row_id).agg(F.min_by("path", "_rank").alias("path"))
    return recordings.select(row_id).distinct().join(best, row_id, "left")


# What a dataset's folder has to hold; a pattern stands for at least one file
REQUIRED_FILES = [
    "meta/info.json", "meta/episodes.jsonl", "meta/episodes_stats.jsonl", "meta/tasks.jsonl", "data/chunk-000/episode_*.parquet",
    *[f"videos/chunk-000/observation.images.{c}/episode_*.mp4" for c in ("camera_top", "camera_wrist_left", "camera_wrist_right")],
    *[f"parameters/{c}_{k}.json" for c in ("camera_top", "camera_wrist_left", "camera_wrist_right") for k in ("extrinsic", "intrinsic")],
]


def missing_files(files: DataFrame, dataset: str, required: list[str] = REQUIRED_FILES) -> DataFrame:
    """(dataset, pattern) of required files that a dataset lacks or has only empty; ``files`` has (dataset, path, size), paths below its folder."""
    hit = F.array(*[F.when(F.col("path").rlike(f"^{_as_regex(p)}$"), F.lit(p)) for p in required])
    there = files.where("size > 0").select(dataset, F.explode(F.filter(hit, lambda x: x.isNotNull())).alias("pattern")).distinct()
    wanted = files.select(dataset).distinct().withColumn("pattern", F.explode(F.array(*map(F.lit, required))))
    return wanted.join(there, [dataset, "pattern"], "left_anti")


def outside_years(df: DataFrame, time: str, first: int = 2025, before: int = 2040) -> DataFrame:
    """Rows whose time (microseconds) lies in no year from ``first`` up to, not including, ``before``."""
    year = F.year(F.timestamp_micros(F.col(time)))
    return df.where((year < first) | (year >= before))


def valid_vector(v: Column, width: int | None = None) -> Column:
    """Whether a vector is there, not empty, without nulls and, if asked, of one width."""
    ok = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull())
    return F.coalesce(ok & (F.size(v) == width) if width else ok, F.lit(False))


def apply_rules(df: DataFrame, rules: list[tuple[str, str, str]], name: Column, settings: list[str]) -> DataFrame:
    """Settings of each row by rules (pattern, setting, value) on its name; of several that fit the last holds.

    Patterns are those of file names.  The rules are a configuration, as long as it is written.
    """
    out = df
    for s in settings:
        fit = F.lit(None).cast("string")
        for pattern, setting, value in rules:
            if setting == s:
                fit = F.when(name.rlike("^" + _as_regex(pattern) + "$"), F.lit(value)).otherwise(fit)
        out = out.withColumn(s, F.coalesce(fit, F.col(s).cast("string")) if s in df.columns else fit)
    return out


def _as_regex(pattern: str) -> str:
    special = {"*": ".*", "?": "."}
    return "".join(special.get(c, c if c.isalnum() else "\\" + c) for c in pattern)


# What settings may be
CHOICES = {"eef_type": ["leju_claw", "qiangnao", "rq2f85", "dexhand"], "which_arm": ["left", "right", "both"]}


def config_violations(df: DataFrame, row_id: str) -> DataFrame:
    """(row_id, setting, value) of settings out of their choices or range: rates must be positive and the timeline no slower than training."""
    checks = [(c, F.col(c).isNotNull() & ~F.col(c).isin(v)) for c, v in CHOICES.items()]
    checks += [(c, F.col(c) <= 0) for c in ("train_hz", "main_timeline_fps")] + [("main_timeline_fps", F.col("main_timeline_fps") < F.col("train_hz")), ("sample_drop", F.col("sample_drop") < 0)]
    bad = F.array(*[F.when(b, F.struct(F.lit(c).alias("setting"), F.col(c).cast("string").alias("value"))) for c, b in checks])
    return df.select(row_id, F.explode(F.filter(bad, lambda x: x.isNotNull())).alias("b")).select(row_id, "b.*").distinct()


@dataclass(frozen=True)
class Config:
    """Settings of a conversion, with the defaults that hold where a configuration is silent."""

    train_hz: int = 10
    main_timeline_fps: int = 30
    sample_drop: int = 0
    chunk_size: int = 800
    only_arm: bool = False
    eef_type: str = "leju_claw"
    which_arm: str = "both"

    def overridden(self, *layers: dict) -> Config:
        """With the values of several layers, later ones first; nulls and unknown settings are passed over."""
        known = {f.name for f in fields(self)}
        values = {k: v for layer in layers for k, v in layer.items() if k in known and v is not None}
        return replace(self, **values).checked()

    def checked(self) -> Config:
        for name, allowed in CHOICES.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} is {getattr(self, name)!r}, not one of {allowed}")
        if self.train_hz <= 0 or self.main_timeline_fps <= 0 or self.sample_drop < 0 or self.chunk_size <= 0:
            raise ValueError("rates and sizes must be positive")
        return self

    @property
    def stride(self) -> int:
        return max(1, self.main_timeline_fps // self.train_hz)


# Rotation (by rows) and translation of the cameras
EXTRINSICS = {
    "camera_top": ([0.8829475928589267, 0.0, 0.4694715627858914, 0.0, 1.0, 0.0, -0.4694715627858914, 0.0, 0.8829475928589267], [0.0967509784707853, 0.0175003248712456, 0.12595326511272098]),
    "camera_wrist_right": ([-0.7071096173630955, -0.7071039221275017, 0.0001798458248664092, 0.1830017433973951, -0.18275752957580388, 0.9659762146641413, -0.6830127018922347, 0.6830839836325056, 0.25863085732104], [0.115405591590931, 0.015431235212043481, -0.10772412843089599]),
    "camera_wrist_left": ([-0.7076167402785503, 0.5411120873595152, 0.45439658646493686, -0.17642866083771364, 0.48740501040759066, -0.855166231480516, -0.6842159575109087, -0.685298522355772, -0.249428263724113], [0.11540559159102, -0.014558611066996074, -0.110123491595499]),
}


def with_extrinsics(df: DataFrame, camera: str) -> DataFrame:
    """Adds rotation (9) and translation (3) of a camera, null for an unknown one."""
    known = df.sparkSession.createDataFrame([(c, r, t) for c, (r, t) in EXTRINSICS.items()], f"{camera} string, rotation array<double>, translation array<double>")
    return df.join(F.broadcast(known), camera, "left")  # three rows


def size_text(size: Column) -> Column:
    """Bytes in gigabytes, the point written as p: 53p21."""
    gb = size / F.lit(1024.0**3)
    whole = F.floor(gb)
    return F.format_string("%dp%02d", whole, F.bround((gb - whole) * 100).cast("bigint"))


def output_paths(df: DataFrame, uuid: str, names: list[str] | None = None, size: str | None = None, count: str | None = None) -> DataFrame:
    """Adds the folders of an episode: below its id, or below one folder per name with size and count."""
    if names:
        tail = F.concat(F.lit("-"), size_text(F.col(size)), F.lit("GB_"), F.col(count).cast("string"), F.lit("counts_0p00h"))
        base = F.concat_ws("/", *[F.concat(F.col(n), tail) for n in names], F.col(uuid))
    else:
        base = F.col(uuid)
    rows = df.withColumn("base", F.concat(base, F.lit("/")))
    return rows.withColumns({f: F.concat("base", F.lit(p)) for f, p in (("depth", "camera/depth/"), ("video", "camera/video/"), ("parameters", "parameters/"), ("proprio", "proprio_stats/"))})


def camera_parts(v: Column) -> Column:
    """D, K, R and P of a camera vector of 35 (D of 5) or 38 (D of 8) numbers, else null."""
    d = F.size(v) - 30
    part = lambda at, n, name: F.slice(v, at, n).alias(name)
    return F.when(F.size(v).isin(35, 38), F.struct(part(F.lit(1), d, "D"), part(d + 1, F.lit(9), "K"), part(d + 10, F.lit(9), "R"), part(d + 19, F.lit(12), "P")))
