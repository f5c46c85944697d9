"""Queries of metadata, configuration, episodes, files, kinematics and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillframe.functions.kinematics import end_pose
from rillframe.operators import annotations, clean, episodes, stats, timeline
from rillframe.operators import metadata as M
from rillframe.operators.grid import latest_revision
from rillframe.plans.catalog import HOUR, messages, vectors
from rillframe.plans.catalog_sql import _CUST, _E, _FRAMES, _VEC
from rillframe.plans.registry import Registry
from rillframe.session import checkpoint_dir, epoch_us, table
from rillframe.sources.datasets import bag_headers as bag_headers_of
from rillframe.sources.datasets import recordings_in
from rillframe.streaming.batches import for_each_batch, live_messages, open_stream, windowed_rate

R = Registry()


def _bodies(spark, d, kind: str = "metadata") -> DataFrame:
    files = table(spark, d, "sidecar_files").where(F.col("doc_kind") == kind).select("file_id", "body").distinct()
    return M.quarantine(files, "body")[0]


def _sql_bodies(kind: str = "metadata") -> str:
    return f"b as (select distinct file_id, body from sidecar_files where doc_kind = '{kind}' and coalesce(json_valid(body) and starts_with(ltrim(body, ' ' || chr(9) || chr(10) || chr(13)), '{{'), false))"


def _get(*paths: str, source: str = "body") -> str:
    return "coalesce(" + ", ".join(f"nullif(trim(json_extract_string({source}, '$.{p}')), '')" for p in paths) + ")"


@R.query("select distinct file_id, case when body is null or trim(body) = '' then 'empty' else 'unreadable' end as reason from sidecar_files where not coalesce(json_valid(body) and starts_with(ltrim(body, ' ' || chr(9) || chr(10) || chr(13)), '{'), false)")
def quarantine(spark, d):
    """Bodies that cannot be read, set aside with the reason."""
    return M.quarantine(table(spark, d, "sidecar_files").select("file_id", "body").distinct(), "body")[1].select("file_id", "reason")


@R.query("""with m as (select bag_id, min(timestamp_us) a, max(timestamp_us) b from messages where bag_id is not null group by 1)
  select bag_id, a as start, b as "end", (b - a) / 1e6::double as seconds, strftime(make_timestamp(a + 28800000000), '%Y-%m-%dT%H:%M:%S') || '+08:00' as started from m""")
def bag_headers(spark, d):
    """First and last time of every recording, its length, and its start as text at UTC+8."""
    return bag_headers_of(table(spark, d, "messages").where("bag_id is not null"), "bag_id", "timestamp_us")


_LISTED = "p as (select distinct '/bags/' || device_sn || '/' || bag_id || case when n_bytes % 5 = 0 then '.c.bag' else '.bag' end as path from recordings where bag_id is not null and device_sn is not null union select distinct '/bags/' || bag_id || '.bag' from recordings where bag_id is not null and n_bytes % 3 = 0)"


@R.query(f"""with {_LISTED}, b as (select path, regexp_extract(path, '([^/]+)\\.bag$', 1) as name, len(string_split(path, '/')) as deep from p where path not like '%.c.bag'),
  n as (select *, row_number() over (partition by name order by deep, path) as n from b) select path, case when n = 1 then name else name || '_' || n end as dataset, 0.0::double as start, 1.0::double as "end" from n""")
def bag_discovery(spark, d):
    """Recordings in a folder and one level below, with unique names; compressed ones are passed over."""
    r = table(spark, d, "recordings").where("bag_id is not null")
    end = F.when(F.col("n_bytes") % 5 == 0, ".c.bag").otherwise(".bag")
    below = r.where("device_sn is not null").select(F.concat(F.lit("/bags/"), "device_sn", F.lit("/"), "bag_id", end).alias("path"))
    here = r.where("n_bytes % 3 = 0").select(F.concat(F.lit("/bags/"), "bag_id", F.lit(".bag")).alias("path"))
    deep = r.select(F.concat(F.lit("/bags/a/b/"), "bag_id", F.lit(".bag")).alias("path"))
    return recordings_in(below.unionByName(here).unionByName(deep).distinct(), "/bags")


_NEW = "starts_with(coalesce(json_extract_string(body, '$.marks'), ''), '[')"
# lists may also be written as text
_LIST = "case when json_valid({0}) and starts_with({0}, '[') then {0}::json end"
_MARKS, _MOMENTS = (_LIST.format(f"json_extract_string(body, '$.{n}')") for n in ("marks", "moments"))
_ACTIONS = f"""{_sql_bodies()}, g as (select file_id, {_NEW} as new, case when {_NEW} then {_MARKS} else {_MOMENTS} end as l from b),
  x as (select file_id, new, unnest(range(0, json_array_length(l)::bigint)) as place, l from g where json_type(l) = 'ARRAY'), y as (select file_id, new, place, json_extract(l, '$[' || place || ']') as a from x),
  acts as (select file_id, case when new then 'new' else 'old' end as generation, place, {_get('markStart', 'triggerTime', source='a')} as stamp,
    try_cast(regexp_replace({_get('duration', 'duration_s', source='a')}, 's$', '') as double) as duration_s, try_cast(regexp_replace({_get('startPosition', 'start_position', source='a')}, 's$', '') as double) as start_position,
    try_cast(regexp_replace({_get('endPosition', 'end_position', source='a')}, 's$', '') as double) as end_position, {_get('skillAtomic', 'skill_atomic_en', source='a')} as skill,
    replace({_get('enSkillDetail', 'en_skill_detail', 'skillDetail', 'skill_detail', source='a')}, '_', ' ') as text, coalesce({_get('markType', 'mark_type', source='a')} = 'retry', false) as is_mistake from y where json_type(a) = 'OBJECT')"""


@R.query(f"with {_ACTIONS} select file_id, generation, place, stamp, duration_s, start_position, skill, text, is_mistake from acts")
def metadata_actions(spark, d):
    """The annotated actions of all bodies of both generations; an action of type retry is a mistake."""
    return M.actions(_bodies(spark, d), "file_id", "body").drop("end_position")


@R.query(f"""with {_ACTIONS} select file_id, coalesce(min(start_position) filter (generation = 'new'), min(start_position) filter (generation = 'old')) as low,
  coalesce(max(coalesce(end_position, start_position)) filter (generation = 'new'), max(coalesce(end_position, start_position)) filter (generation = 'old')) as high from acts group by 1""")
def position_ranges(spark, d):
    """Range of a recording that its actions span."""
    return M.position_ranges(M.actions(_bodies(spark, d), "file_id", "body"), "file_id")


_NORMAL = f"""nm as (select file_id, body, case when {_NEW} then 'new' else 'old' end as generation, {_get('primaryScene', 'scene_code')} as scene, {_get('tertiaryScene', 'sub_scene_code')} as sub_scene, {_get('taskName', 'task_name')} as task, {_get('deviceSn', 'device_sn')} as device,
  coalesce(json_array_length(case when {_NEW} then {_MARKS} else {_MOMENTS} end), 0)::bigint as n_marks from b)"""


@R.query(f"""with {_ACTIONS}, {_NORMAL}, w as (select file_id, null::bigint as place, unnest([case when scene is null then 'scene' end, case when sub_scene is null then 'sub_scene' end, case when task is null then 'task' end, case when device is null then 'device' end, case when n_marks = 0 then 'marks' end]) as missing from nm
  union all select file_id, place, unnest([case when stamp is null then 'stamp' end, case when duration_s is null then 'duration_s' end, case when skill is null then 'skill' end]) from acts) select * from w where missing is not null""")
def metadata_violations(spark, d):
    """Fields that the strict check of bodies and actions misses."""
    bodies = _bodies(spark, d)
    return M.metadata_violations(annotations.normalise_metadata(bodies, "body"), M.actions(bodies, "file_id", "body"), "file_id")


@R.query(f"with {_sql_bodies()}, {_NORMAL} select file_id, generation, generation = 'new' or coalesce(starts_with(json_extract_string(body, '$.moments'), '['), false) as writable from nm")
def metadata_gate(spark, d):
    """Bodies that may be written: the new generation, or the old one with moments."""
    rows = annotations.normalise_metadata(_bodies(spark, d), "body")
    return M.write_gate(rows, F.get_json_object("body", "$.moments")).select("file_id", "generation", "writable")


@R.query(f"with {_sql_bodies('config')}, s as (select file_id, try_cast(json_extract_string(body, '$.resize.height') as bigint) h, try_cast(json_extract_string(body, '$.resize.width') as bigint) w from b) select file_id, case when h is null or w is null then 480 else h end as height, case when h is null or w is null then 848 else w end as width from s")
def camera_size(spark, d):
    """Height and width of frames as configured, else the default."""
    h, w = M.frame_size("body", ("$.resize.height", "$.resize.width"))
    return _bodies(spark, d, "config").select("file_id", h.alias("height"), w.alias("width"))


_CONFIG = "c as (select *, row_number() over (partition by bag_id order by revision desc) n from bag_config where bag_id is not null qualify n = 1)"


@R.query(f"""with {_CONFIG}, x as (select bag_id, unnest([case when eef_type not in ('leju_claw', 'qiangnao', 'rq2f85', 'dexhand') then {{'s': 'eef_type', 'v': eef_type}} end, case when which_arm not in ('left', 'right', 'both') then {{'s': 'which_arm', 'v': which_arm}} end,
  case when train_hz <= 0 then {{'s': 'train_hz', 'v': train_hz::bigint::varchar}} end, case when main_timeline_fps <= 0 or main_timeline_fps < train_hz then {{'s': 'main_timeline_fps', 'v': main_timeline_fps::bigint::varchar}} end, case when sample_drop < 0 then {{'s': 'sample_drop', 'v': sample_drop::varchar}} end]) b from c)
  select bag_id, b.s as setting, b.v as value from x where b is not null""")
def config_violations(spark, d):
    """Settings out of their choices or range, of the last revision."""
    last = latest_revision(table(spark, d, "bag_config"), "bag_id", "revision", ["eef_type", "which_arm", "train_hz", "main_timeline_fps", "sample_drop"])
    return M.config_violations(last, "bag_id")


_RULES = [("*", "profile", "default"), ("KV1*", "profile", "first"), ("KV?[0-4]*", "profile", "none"), ("KV3*", "flip", "yes"), ("*2?20", "flip", "no"), ("KV31Z*", "profile", "special")]


@R.query("""select device_sn, case when regexp_matches(device_sn, '^KV31Z.*$') then 'special' when regexp_matches(device_sn, '^KV1.*$') then 'first' else 'default' end as profile,
  case when regexp_matches(device_sn, '^.*2.20$') then 'no' when regexp_matches(device_sn, '^KV3.*$') then 'yes' end as flip from devices""")
def rule_settings(spark, d):
    """Settings of devices by rules on their names, later ones first."""
    return M.apply_rules(table(spark, d, "devices").select("device_sn"), _RULES, F.col("device_sn"), ["profile", "flip"])


@R.query("""with r as (select distinct bag_id from recordings where bag_id is not null), a as (select r.bag_id, exists (select 1 from bag_config c where c.bag_id = r.bag_id and c.revision = 2) as o, exists (select 1 from marks m where m.bag_id = r.bag_id) as k, exists (select 1 from steps s where s.bag_id = r.bag_id) as s from r)
  select bag_id, case when o then '/override/' || bag_id || '.json' when k then '/bags/' || bag_id || '/metadata.json' when s then '/root/metadata-' || bag_id || '.json' end as path from a""")
def sidecar_resolution(spark, d):
    """The sidecar file of each recording, by priority of places."""
    bags = table(spark, d, "recordings").where("bag_id is not null").select("bag_id").distinct()
    places = {"override": F.concat(F.lit("/override/"), "bag_id", F.lit(".json")), "own": F.concat(F.lit("/bags/"), "bag_id", F.lit("/metadata.json")), "root": F.concat(F.lit("/root/metadata-"), "bag_id", F.lit(".json"))}
    there = [(table(spark, d, "bag_config").where("revision = 2"), "override"), (table(spark, d, "marks"), "own"), (table(spark, d, "steps"), "root")]
    files = None
    for t, place in there:
        part = t.where("bag_id is not null").select(places[place].alias("path"))
        files = part if files is None else files.unionByName(part)
    return M.resolve_sidecars(bags.withColumns(places), files, "bag_id", list(places))


@R.query("""with f as (select bag_id as dataset, 'videos/' || camera || '/episode_' || (frame_no % 3) || '.mp4' as path, n_bytes as size from camera_frames where bag_id is not null union all select bag_id, 'meta/info.json', n_bytes from recordings where bag_id is not null and scene is not null),
  q(pattern) as (values ('meta/info.json'), ('videos/head_cam_h/episode_*.mp4'), ('videos/wrist_cam_l/episode_*.mp4'), ('data/*.parquet'))
  select d.dataset, q.pattern from (select distinct dataset from f) d, q where not exists (select 1 from f where f.dataset = d.dataset and f.size > 0 and f.path glob q.pattern)""")
def structure_check(spark, d):
    """Required files that a recording's folder lacks."""
    frames = table(spark, d, "camera_frames").where("bag_id is not null").select(F.col("bag_id").alias("dataset"), F.concat(F.lit("videos/"), "camera", F.lit("/episode_"), (F.col("frame_no") % 3).cast("string"), F.lit(".mp4")).alias("path"), F.col("n_bytes").alias("size"))
    infos = table(spark, d, "recordings").where("bag_id is not null and scene is not null").select(F.col("bag_id").alias("dataset"), F.lit("meta/info.json").alias("path"), F.col("n_bytes").alias("size"))
    return M.missing_files(frames.unionByName(infos), "dataset", ["meta/info.json", "videos/head_cam_h/episode_*.mp4", "videos/wrist_cam_l/episode_*.mp4", "data/*.parquet"])


@R.query("select bag_id, topic, seq, timestamp_us from messages where year(make_timestamp(timestamp_us)) not between 2025 and 2039")
def year_sanity(spark, d):
    """Messages with times before 2025 or from 2040 on."""
    return M.outside_years(table(spark, d, "messages"), "timestamp_us").select("bag_id", "topic", "seq", "timestamp_us")


@R.query("select topic, count(*) filter (data is not null and len(data) > 0 and not list_contains(list_transform(data, lambda x: x is null), true)) as valid, count(*) as n from messages where topic like '/leju_claw%' or topic = '/gripper/state' group by 1")
def valid_hand_data(spark, d):
    """Messages of hands with data."""
    rows = table(spark, d, "messages").where("topic like '/leju_claw%' or topic = '/gripper/state'")
    return rows.groupBy("topic").agg(F.count_if(M.valid_vector(F.col("data"))).alias("valid"), F.count("*").alias("n"))


@R.query("""with r as (select distinct bag_id, n_bytes, scene from recordings where bag_id is not null), g as (select *, n_bytes / pow(1024.0::double, 3) as gb from r)
  select bag_id, coalesce(scene, 'none') || '-' || printf('%dp%02d', floor(gb)::bigint, round_even((gb - floor(gb)) * 100, 0)::bigint) || 'GB_1counts_0p00h/' || bag_id || '/camera/video/' as video, bag_id || '/parameters/' as parameters from g""")
def output_paths(spark, d):
    """Folders of episodes, by scene and size, or simply by id."""
    rows = table(spark, d, "recordings").where("bag_id is not null").select("bag_id", "n_bytes", F.coalesce("scene", F.lit("none")).alias("scene")).distinct().withColumn("count", F.lit(1))
    full = M.output_paths(rows, "bag_id", ["scene"], "n_bytes", "count").select("bag_id", "video")
    return full.join(M.output_paths(rows, "bag_id").select("bag_id", "parameters"), "bag_id")


@R.query("select vec_id, n, i as pos, part, round(cast(embedding[a + i] as double), 6) as x from embeddings, (values (35, 'D', 1, 5), (35, 'K', 6, 9), (35, 'R', 15, 9), (35, 'P', 24, 12), (38, 'D', 1, 8), (38, 'K', 9, 9), (38, 'R', 18, 9), (38, 'P', 27, 12)) q(n, part, a, w), range(12) r(i) where i < w and n = case when vec_id % 2 = 0 then 35 else 38 end")
def camera_info_parts(spark, d):
    """Camera vectors of both widths split into their parts."""
    v = vectors(spark, d).withColumn("n", F.when(F.col("vec_id") % 2 == 0, 35).otherwise(38))
    parts = M.camera_parts(F.slice("v", F.lit(1), F.col("n")))
    rows = v.select("vec_id", F.col("n").cast("bigint").alias("n"), parts.alias("p"))
    named = F.explode(F.array(*[F.struct(F.lit(c).alias("part"), F.col("p")[c].alias("v")) for c in "DKRP"])).alias("s")
    return rows.select("vec_id", "n", named).select("vec_id", "n", "s.part", F.posexplode("s.v").alias("pos", "x")).select("vec_id", "n", "part", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("x").cast("double"), 6).alias("x"))


@R.query("""with c as (select camera, count(*) as n from camera_frames group by 1), k(camera, name) as (values ('head_cam_h', 'camera_top'), ('wrist_cam_l', 'camera_wrist_left'), ('wrist_cam_r', 'camera_wrist_right')),
  e(name, trace, tx) as (values ('camera_top', 2.7658951857178534::double, 0.0967509784707853::double), ('camera_wrist_right', -0.631236289618849::double, 0.115405591590931::double), ('camera_wrist_left', -0.46963999359484::double, 0.11540559159102::double))
  select c.camera, n, round(trace, 9) as trace, tx from c left join k using (camera) left join e using (name)""")
def camera_extrinsics(spark, d):
    """Rotation and translation of each camera."""
    names = F.create_map(*[F.lit(x) for kv in {"head_cam_h": "camera_top", "wrist_cam_l": "camera_wrist_left", "wrist_cam_r": "camera_wrist_right"}.items() for x in kv])
    rows = table(spark, d, "camera_frames").groupBy("camera").agg(F.count("*").alias("n")).withColumn("name", F.try_element_at(names, F.col("camera")))
    known = M.with_extrinsics(rows, "name")
    return known.select("camera", "n", F.round(F.get("rotation", F.lit(0)) + F.get("rotation", F.lit(4)) + F.get("rotation", F.lit(8)), 9).alias("trace"), F.get("translation", F.lit(0)).alias("tx"))


@R.query(f"""with {_FRAMES}, k as (select key, row_number() over (order by min((bag_id, t, id))) - 1 as task_index from e group by 1), p as (select bag_id, dense_rank() over (order by bag_id) - 1 as episode_index, id, frame, row_number() over (order by bag_id, t, id) - 1 + 1000 as index, key from f)
  select id, episode_index, frame as frame_index, index, task_index, round(frame / 30.0::double, 4) as stamp from p join k using (key)""")
def episode_commit(spark, d):
    """Frames of new episodes, numbered on after 1000 others, with their tasks."""
    frames, _ = episodes.commit_episodes(messages(spark, d), "bag_id", ["t", "id"], "key", 30.0, 1000)
    return frames.select("id", "episode_index", "frame_index", "index", "task_index", F.round(F.col("frame_index") / 30.0, 4).alias("stamp"))


@R.query(f"with {_FRAMES}, n as (select bag_id as episode_index, count(*) n from f where frame <> 3 or bag_id % 2 = 0 group by 1), l as (select bag_id as episode_index, count(*) as length from f group by 1) select episode_index, 'length' as what from n full join l using (episode_index) where coalesce(n, 0) <> length union all select episode_index, 'frames' from n join l using (episode_index) where n < length and length > 4")
def commit_check(spark, d):
    """Episodes with a hole: every second one lacks a frame."""
    from rillframe.plans.catalog import _frames

    frames = _frames(spark, d).select(F.col("bag_id").alias("episode_index"), F.col("frame").alias("frame_index"))
    sizes = frames.groupBy("episode_index").agg(F.count("*").alias("length"))
    return episodes.commit_check(frames.where("frame_index <> 3 or episode_index % 2 = 0"), sizes)


@R.query("""with f as (select distinct bag_id, camera, frame_no from camera_frames), n as (select *, row_number() over (partition by bag_id, camera order by frame_no) - 1 as ordinal from f)
  select bag_id, camera, frame_no, ordinal, ordinal // 100 as segment, ordinal % 100 % 2 = 0 as keyframe, round(ordinal / 30.0::double, 6) as pts, 'videos/' || camera || '/' || bag_id || '/' || printf('segment_%04d.mp4', ordinal // 100) as file from n""")
def frame_manifest(spark, d):
    """What an encoder is to write per camera, in order, in segments of 100 frames."""
    frames = table(spark, d, "camera_frames").select("bag_id", "camera", "frame_no").distinct()
    return episodes.frame_manifest(frames, "bag_id", "camera", ["frame_no"], 30.0, 100).select("bag_id", "camera", "frame_no", "ordinal", "segment", "keyframe", F.round("pts", 6).alias("pts"), "file")


@R.query("with r as (select device_sn, scene, min((start_us, bag_id)) f from recordings where scene is not null and device_sn is not null group by 1, 2) select device_sn, scene, row_number() over (partition by device_sn order by f, scene) - 1 as place from r")
def scene_order(spark, d):
    """Scenes of each device in the order of their first recording."""
    return episodes.ordered_unique(table(spark, d, "recordings").where("device_sn is not null"), ["device_sn"], "scene", ["start_us", "bag_id"])


@R.query(f"""with {_CUST}, k as (select dataset from c group by 1 having sum(frames) >= 95), s as (select c_custkey as episode, c_mktsegment as task from customer), x as (select dataset, episode, frames, task, row_number() over (order by dataset, episode) - 1 as episode_index from c join s using (episode) where dataset in (select dataset from k)),
  t as (select task, row_number() over (order by min(episode_index)) - 1 as task_index from x group by 1)
  select dataset, episode, episode_index, (sum(frames) over (order by episode_index) - frames)::bigint as from_index, (sum(frames) over (order by episode_index))::bigint as to_index, task_index from x join t using (task)""")
def dataset_merge_tasks(spark, d):
    """Datasets merged into one: episodes, frames and tasks numbered on."""
    orders, c = table(spark, d, "orders"), table(spark, d, "customer")
    frames = orders.join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").cast("bigint").alias("dataset"), F.col("c_custkey").alias("episode"), F.col("c_mktsegment").alias("task"))
    return episodes.merge_with_tasks(frames, "dataset", "episode", "task", 95)


@R.query("select * from (values ('c_acctbal'), ('c_custkey'), ('c_mktsegment'), ('c_name'), ('c_nationkey'), ('s_acctbal'), ('s_name'), ('s_nationkey'), ('s_suppkey')) t(disabled)")
def disabled_features(spark, d):
    """Columns that only some of the tables of a concatenation have."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment").withColumn("key", F.col("c_custkey"))
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal").withColumn("key", F.col("s_suppkey"))
    return spark.createDataFrame([(x,) for x in episodes.common_columns([c, s])[1]], "disabled string")


_ITEM = f"{_FRAMES}, g as (select *, row_number() over (order by bag_id, t, id) - 1 as index from f), a as (select * from g where index = 123), n as (select count(*) n from g where bag_id in (select bag_id from a))"


@R.query(f"with {_ITEM}, w as (select a.bag_id, a.frame, x.d as delta, greatest(0, least(n.n - 1, a.frame + x.d)) w, a.frame + x.d < 0 or a.frame + x.d >= n.n is_pad, a.key as task from a, n, (values (-2), (0), (3)) x(d)) select w.bag_id, w.frame, w.delta::bigint as delta, g.id, is_pad, task from w join g on g.bag_id = w.bag_id and g.frame = w.w")
def item_lookup(spark, d):
    """Item 123 of the events as a dataset: its delta window and task."""
    frames, tasks = episodes.commit_episodes(messages(spark, d), "bag_id", ["t", "id"], "key", 30.0)
    rows = frames.withColumnRenamed("frame_index", "frame").select("bag_id", "frame", "index", "id", "task_index")
    return episodes.item(rows, tasks.withColumnRenamed("key", "task"), "bag_id", "frame", 123, ["id"], [-2, 0, 3])


@R.query(f"with {_VEC} select pos, round(min(x), 6) as min, round(max(x), 6) as max, round(avg(x), 6) as mean, round(stddev_pop(x), 6) as std, count(x) as n from v where label in (1, 3, 5) group by 1")
def subset_stats(spark, d):
    """Statistics of some episodes, merged from those of each."""
    per = stats.feature_stats(vectors(spark, d), ["label"], "v").where(F.col("label").isin(1, 3, 5))
    out = stats.merge_stats(per, ["pos"])
    return out.select(F.col("pos").cast("bigint").alias("pos"), *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")], "n")


@R.query("select unnest(['total_episodes', 'total_frames', 'fps', 'feature.vec_id', 'feature.embedding', 'feature.label']) as name, unnest([count(distinct label)::varchar, count(*)::varchar, '30', 'bigint[1]', 'array<float>[64]', 'int[1]']) as value from embeddings")
def dataset_properties(spark, d):
    return episodes.properties(table(spark, d, "embeddings").select("vec_id", "embedding", "label"), 30.0, "label", {"embedding": 64})


@R.query(f"""with {_E}, p as (select bag_id, key, count(*) n, min(t) a, max(t) b, avg(t::double) m from e group by 1, 2), o as (select *, coalesce(sum(n) over (partition by bag_id order by key rows between unbounded preceding and 1 preceding), 0) before, sum(n) over (partition by bag_id) total from p)
  select bag_id, key, round((before / 30.0::double), 6) as shift, total::bigint as total from o""")
def stats_time_shift(spark, d):
    """By how much the times of each part are moved when parts are joined: the frames before it over the rate; and all frames."""
    parts = messages(spark, d).groupBy("bag_id", "key").agg(F.count("*").alias("n"))
    return stats.time_shifts(parts, ["bag_id"], ["key"], "n", 30.0).select("bag_id", "key", F.round("shift", 6).alias("shift"), "total")


@R.query(f"with {_E}, o as (select * from e where key = 'view' qualify row_number() over (partition by bag_id, t // {HOUR} order by t, id) = 1), n as (select *, row_number() over (partition by bag_id order by t, id) - 1 i from o) select bag_id, id from n where i % 2 = 0")
def stride_without_drop(spark, d):
    """Every second row where nothing is dropped at the ends."""
    rows = messages(spark, d, "view").withColumn("hour", F.call_function("div", F.col("t"), F.lit(HOUR)))
    return timeline.drop_and_stride(clean.keep_first(rows, ["bag_id", "hour"], ["t", "id"]), ["bag_id"], ["t", "id"], 0, 2).select("bag_id", "id")


_SLIDES = {"hand": ("x > 50", "x / 100"), "gripper_state": ("x > 0.4", "x / 0.8"), "gripper_command": ("x > 70", "x / 255")}


@R.query(f"with {_VEC}, h as (select vec_id, pos, x * 300 as x from v where pos < 2) " + " union all ".join(f"select vec_id, pos, '{k}' as kind, case when {b} then 1.0::double else 0.0 end as bit, round({s}, 5) as share from h" for k, (b, s) in _SLIDES.items()))
def effector_kinds(spark, d):
    """Positions of hands and grippers as 0 and 1 and as shares of their range."""
    from rillframe.functions import vectors as V

    v = vectors(spark, d, 2).select("vec_id", F.transform("v", lambda x: x.cast("double") * 300).alias("v"))
    kinds = [F.struct(F.lit(k).alias("kind"), F.arrays_zip(V.normalise_effector(F.col("v"), k, True).alias("bit"), V.normalise_effector(F.col("v"), k, False).alias("share")).alias("z")) for k in _SLIDES]
    long = v.select("vec_id", F.explode(F.array(*kinds)).alias("k")).select("vec_id", "k.kind", F.posexplode("k.z").alias("pos", "z"))
    return long.select("vec_id", F.col("pos").cast("bigint").alias("pos"), "kind", F.col("z")["bit"].alias("bit"), F.round(F.col("z")["share"], 5).alias("share"))


# a synthetic arm of seven joints about z and y in turn, and a head of two with a camera
_ARM = "<robot>" + "".join(
    f'<joint name="j{i}" type="revolute"><parent link="l{i}"/><child link="l{i + 1}"/><origin xyz="{[0, 0.1][i % 2]} 0 {[0.2, 0][i % 2]}" rpy="0 0 0"/><axis xyz="{["0 0 1", "0 1 0"][i % 2]}"/></joint>' for i in range(7)
) + '<joint name="tool" type="fixed"><parent link="l7"/><child link="tip"/><origin xyz="0.15 0 0" rpy="0 0 0"/></joint></robot>'
_HEAD = """<robot><joint name="yaw" type="revolute"><parent link="torso"/><child link="neck"/><origin xyz="0 0 1.2" rpy="0 0 0"/><axis xyz="0 0 1"/></joint>
<joint name="pitch" type="revolute"><parent link="neck"/><child link="head"/><origin xyz="0.05 0 0.1" rpy="0 0 0"/><axis xyz="0 1 0"/></joint>
<joint name="camera" type="fixed"><parent link="head"/><child link="camera"/><origin xyz="0.1 0 0" rpy="0 0 0"/></joint></robot>"""


def _quaternions() -> str:
    """SQL of the arm: quaternions (w, x, y, z) and positions, joint after joint."""
    steps, last = [], "select vec_id, embedding, 1.0::double w, 0.0::double x, 0.0::double y, 0.0::double z, 0.0::double px, 0.0::double py, 0.0::double pz from embeddings"

    def moved(tx: float, tz: float) -> str:  # p + q (tx, 0, tz) q*
        return f"px + (1 - 2 * (y * y + z * z)) * {tx} + 2 * (x * z + w * y) * {tz} as px, py + 2 * (x * y + w * z) * {tx} + 2 * (y * z - w * x) * {tz} as py, pz + 2 * (x * z - w * y) * {tx} + (1 - 2 * (x * x + y * y)) * {tz} as pz"

    for i in range(7):
        c, s = f"cos(embedding[{i + 1}]::double / 2)", f"sin(embedding[{i + 1}]::double / 2)"
        turn = f"w * {c} - z * {s} as w, x * {c} + y * {s} as x, y * {c} - x * {s} as y, z * {c} + w * {s} as z" if i % 2 == 0 else f"w * {c} - y * {s} as w, x * {c} - z * {s} as x, y * {c} + w * {s} as y, z * {c} + x * {s} as z"
        steps.append(f"s{i} as ({last})")
        last = f"select vec_id, embedding, {turn}, {moved(0.1 if i % 2 else 0, 0 if i % 2 else 0.2)} from s{i}"
    steps.append(f"s7 as ({last})")
    return f"with {', '.join(steps)}, t as (select *, {moved(0.15, 0).replace(' as px', ' as ex').replace(' as py', ' as ey').replace(' as pz', ' as ez')}, case when w < 0 then -1 else 1 end as sg from s7) select vec_id, round(ex, 5) as x, round(ey, 5) as y, round(ez, 5) as z, round(sg * x, 5) as qx, round(sg * y, 5) as qy, round(sg * z, 5) as qz, round(sg * w, 5) as qw from t"


def _pose_columns(p: str) -> list:
    return [F.round(F.element_at(p, i + 1), 5).alias(c) for i, c in enumerate(("x", "y", "z", "qx", "qy", "qz", "qw"))]


@R.query(_quaternions())
def arm_pose(spark, d):
    """Pose of the end of an arm of seven joints."""
    v = vectors(spark, d, 7).select("vec_id", F.transform("v", lambda x: x.cast("double")).alias("q"))
    return v.select("vec_id", end_pose(_ARM, "tip")("q").alias("p")).select("vec_id", *_pose_columns("p"))


@R.query("with q as (select vec_id, embedding[27]::double a, embedding[28]::double b from embeddings) select vec_id, round(cos(a) * (0.05 + 0.1 * cos(b)), 5) as x, round(sin(a) * (0.05 + 0.1 * cos(b)), 5) as y, round(1.3 - 0.1 * sin(b), 5) as z from q")
def head_camera_pose(spark, d):
    """Place of the head's camera from the head's two joints."""
    v = vectors(spark, d, 28).select("vec_id", F.transform(F.slice("v", 27, 2), lambda x: x.cast("double")).alias("q"))
    return v.select("vec_id", end_pose(_HEAD, "camera")("q").alias("p")).select("vec_id", *_pose_columns("p")[:3])


def _events_stream(spark, d) -> DataFrame:
    return open_stream(spark, f"{d}/event[s].parquet", table(spark, d, "events").schema)


@R.query(f"with {_E} select id, key, case when id % 3 = 0 then t else t - 500000 end as stamp from e where key in ('view', 'error')")
def live_subscription(spark, d):
    """Messages of some topics from a stream of JSON: the stamp of the header, or when it was received."""
    where = f"{checkpoint_dir(spark)}/live-{uuid.uuid4().hex}"
    t = epoch_us("ts")
    header = F.struct((t - 500_000).alias("stamp_us"))
    raw = _events_stream(spark, d).select(F.to_json(F.struct(F.col("event_type").alias("topic"), F.when(F.col("event_id") % 3 != 0, header).alias("header"), F.col("event_id").alias("id"))).alias("body"), t.alias("received_us"))
    out = live_messages(raw, "body", "received_us", "id bigint", ["view", "error"])
    run = out.writeStream.format("parquet").option("path", f"{where}/out").option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema("topic string, stamp bigint, id bigint").parquet(f"{where}/out").select("id", F.col("topic").alias("key"), "stamp")


@R.query(f"with {_E} select t // {24 * HOUR} as day, key, count(*) as n from e group by 1, 2")
def windowed_counts(spark, d):
    """Messages a day and topic, kept up to date by a stream and written by a callback for each of its batches."""
    where = f"{checkpoint_dir(spark)}/windows-{uuid.uuid4().hex}"
    rows = _events_stream(spark, d).select(F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("key"))
    counts = windowed_rate(rows, "key", "at", "1 day", "1 day")
    run = for_each_batch(counts, lambda df, _: df.select(F.unix_micros("window.start").alias("start"), "key", "n").write.mode("overwrite").parquet(f"{where}/out"), f"{where}/state", "complete")
    run.awaitTermination()
    return spark.read.schema("start bigint, key string, n bigint").parquet(f"{where}/out").select(F.call_function("div", F.col("start"), F.lit(24 * HOUR)).alias("day"), "key", "n")
