"""Queries of alignment chains, scans, trims, rate repair and reports, over events and robot tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillframe.operators import annotations, asof, chains, clean, episodes, quality, stats, timeline
from rillframe.plans.catalog import HOUR, _frames, messages, vectors
from rillframe.plans.catalog_sql import _E, _FRAMES, _VEC
from rillframe.plans.registry import Registry
from rillframe.sources.datasets import messages_of
from rillframe.session import table

R = Registry()
_NEAR_ARGMIN = """n as (select m.bag_id, m.t, m.id, o.t near_t, o.id near_id, row_number() over (partition by m.id order by abs(o.t - m.t), o.t, o.id) rn from m join o using (bag_id) qualify rn = 1)"""
_MO = f"{_E}, m as (select * from e where key = 'view'), o as (select * from e where key = 'click')"


def _sides(spark, d) -> tuple[DataFrame, DataFrame]:
    return messages(spark, d, "view").select("bag_id", "t", "id"), messages(spark, d, "click").select("bag_id", "t", "id")


@R.query(f"with {_MO}, h as (select bag_id, t // {HOUR} * {HOUR} as t, id from o), {_NEAR_ARGMIN.replace('join o ', 'join h o ')} select id, near_id from n")
def nearest_argmin(spark, d):
    """Nearest of times that repeat (hours): of equally near ones the earlier, of one time the first."""
    main, other = _sides(spark, d)
    hours = other.withColumn("t", F.call_function("div", F.col("t"), F.lit(HOUR)) * HOUR)
    return asof.nearest_asof(main, hours, ["bag_id"], "t", "id", "first").where("near_id is not null").select("id", "near_id")


@R.query(f"with {_MO}, {_NEAR_ARGMIN} select m.id from m left join n on m.id = n.id where n.id is null or abs(n.near_t - m.t) >= {6 * HOUR}")
def nearest_violations(spark, d):
    main, other = _sides(spark, d)
    return asof.nearest_violations(asof.nearest_asof(main, other, ["bag_id"], "t", "id"), 6 * HOUR).select("id")


@R.query(f"""with {_MO}, {_NEAR_ARGMIN}, c as (select bag_id, id, t, t // {72 * HOUR} as chunk from m), s as (select bag_id, chunk, min(t) - {2 * HOUR} lo, max(t) + {2 * HOUR} hi from c group by 1, 2),
  l as (select s.bag_id, s.chunk, o.t, o.id from s join o on s.bag_id = o.bag_id and o.t between lo and hi),
  k as (select c.id, l.id as near_id, row_number() over (partition by c.id order by abs(l.t - n.near_t), l.t, l.id) rn from c left join n on c.id = n.id left join l on c.bag_id = l.bag_id and c.chunk = l.chunk and n.near_t is not null)
  select id, near_id from k where rn = 1""")
def nearest_two_stage(spark, d):
    """Nearest by the whole timeline, then among what a chunk of three days loads."""
    main, other = _sides(spark, d)
    main = main.withColumn("chunk", F.call_function("div", F.col("t"), F.lit(72 * HOUR)))
    return chains.two_stage_nearest(main, other, ["bag_id"], "t", "id", "chunk", 2 * HOUR).select("id", "near_id")


@R.query(f"""with {_FRAMES}, c as (select bag_id, frame // 20 as chunk, min(t) a, max(t) b from f group by 1, 2)
  select c.bag_id, c.chunk, e.id from c join e on c.bag_id = e.bag_id and e.t between a - {HOUR} and b + {HOUR}""")
def chunk_scan(spark, d):
    """Messages of every chunk of 20 frames, a period around it included."""
    spans = timeline.batches(_frames(spark, d), "frame", 20).groupBy("bag_id", F.col("batch").alias("chunk")).agg(F.min("t").alias("a"), F.max("t").alias("b"))
    return asof.chunk_scan(messages(spark, d).select("bag_id", "t", "id"), spans, ["bag_id"], "t", "a", "b", 1e6 / HOUR).select("bag_id", "chunk", "id")


@R.query(f"""with {_E}, a as (select bag_id, t // {24 * HOUR} as day, key, max(id) id from e group by 1, 2, 3)
  select bag_id, day, max(id) filter (key = 'view') as "view", max(id) filter (key = 'click') as click, max(id) filter (key = 'purchase') as purchase, max(id) filter (key = 'error') as error from a group by 1, 2""")
def joined_frames(spark, d):
    """Frames (days) with a column per modality."""
    return _days(spark, d).select("bag_id", "day", "view", "click", "purchase", "error")


def _days(spark, d) -> DataFrame:
    rows = messages(spark, d).withColumn("day", F.call_function("div", F.col("t"), F.lit(24 * HOUR))).groupBy("bag_id", "day", "key").agg(F.max("id").alias("id"))
    return chains.joined_frames(rows, ["bag_id", "day"], "key", "id", ["view", "click", "purchase", "error"])


@R.query(f"""with {_E} select bag_id, t // {24 * HOUR} as day from e group by 1, 2 having count(*) filter (key = 'view') > 0 and count(*) filter (key in ('click', 'purchase')) > 0""")
def complete_frames(spark, d):
    """Frames with all required modalities and one of a pair."""
    return chains.complete_frames(_days(spark, d), ["view"], [["click", "purchase"]]).select("bag_id", "day")


@R.query(f"""with {_MO}, a as (select bag_id, id, row_number() over (partition by bag_id order by id) - 1 as place from m), b as (select bag_id, value, row_number() over (partition by bag_id order by id) - 1 as place from o)
  select a.bag_id, a.id, place, round(b.value, 6) as value from a left join b using (bag_id, place)""")
def positional_join(spark, d):
    a, b = messages(spark, d, "view").select("bag_id", "id"), messages(spark, d, "click").select("bag_id", "id", "value")
    return chains.positional_join(a, b, ["bag_id"], "id", ["value"]).select("bag_id", "id", "place", F.round("value", 6).alias("value"))


_TOPIC_KEYS = [("view", "camera_top", False), ("view", "master", False), ("click", "claw", False), ("purchase", "claw", True)]


@R.query(f"with {_E}, k(key, feeds, is_fallback) as (values {', '.join(str(x).replace('False', 'false').replace('True', 'true') for x in _TOPIC_KEYS)}) select id, feeds, is_fallback from e join k using (key)")
def topic_keys(spark, d):
    """Messages under every key that their topic feeds."""
    keys = spark.createDataFrame(_TOPIC_KEYS, "key string, feeds string, is_fallback boolean")
    return messages_of(messages(spark, d), F.broadcast(keys), "key").select("id", "feeds", "is_fallback")


@R.query("with k as (select source, row_number() over (order by min(doc_id)) - 1 as i from documents where source is not null group by 1), t as (select distinct doc_id, source from documents where doc_id is not null) select doc_id, coalesce(i, 1000000) as task_index, k.source as task from t left join k using (source)")
def task_decode(spark, d):
    """Documents whose source is a number, and its text again."""
    docs = table(spark, d, "documents").where("doc_id is not null").select("doc_id", "source").distinct()
    tasks = episodes.encode_tasks(table(spark, d, "documents").select("source", "doc_id"), "source", ["doc_id"]).withColumnRenamed("source", "task")
    coded = docs.join(tasks.withColumnRenamed("task", "source"), "source", "left").select("doc_id", F.coalesce("task_index", F.lit(1_000_000).cast("bigint")).alias("task_index"))
    return episodes.decode_tasks(coded, tasks, "task").select("doc_id", "task_index", "task")


@R.query(f"""with {_E}, s as (select bag_id, key, t, lead(t) over (partition by bag_id, key order by t) - t as gap from e)
  select bag_id, key, count(*) as gaps, max(gap) as longest, min(t) as first_at, arg_min(gap, t) as first_gap from s where gap > {24 * HOUR} group by 1, 2""")
def gap_report(spark, d):
    """Gaps over a day: number, longest, first."""
    return chains.gap_report(messages(spark, d), ["bag_id", "key"], "t", 24 * HOUR)


_CAMERA_LIMIT = "case when (camera like '%head%' or camera like '%top%') and camera not like '%depth%' then 39800 when camera like '%wrist%' and camera not like '%depth%' then 8000 when camera like '%depth%' then 8000 else 4000 end"
_CAM = "f as (select bag_id, camera, timestamp_us as t, min(frame_no) as frame_no from camera_frames where timestamp_us is not null group by 1, 2, 3)"


@R.query(f"""with {_CAM}, g as (select *, lead(t) over (partition by bag_id, camera order by t) - t as gap, {_CAMERA_LIMIT} as lim from f), k as (select *, case when gap > lim then (gap + lim - 1) // lim - 1 else 0 end as k from g)
  select bag_id, camera, frame_no, case when i > 0 then t + (i * gap) // (k + 1) else t end as t, i > 0 as interpolated from (select *, unnest(range(0, k + 1)) i from k)""")
def gap_fill_by_kind(spark, d):
    """Camera frames without repeats, gaps filled by the limit of the camera's kind."""
    return _camera_filled(spark, d, clean.gap_limit_of(F.col("camera")))


def _camera_times(spark, d) -> DataFrame:
    return table(spark, d, "camera_frames").select("bag_id", "camera", "frame_no", F.col("timestamp_us").alias("t"))


def _camera_filled(spark, d, limit) -> DataFrame:
    return chains.preprocess(_camera_times(spark, d), ["bag_id", "camera"], "t", "frame_no", limit).select("bag_id", "camera", "frame_no", "t", "interpolated")


@R.query(f"""with {_CAM}, g as (select *, lead(t) over (partition by bag_id, camera order by t) - t as gap from f), k as (select *, case when gap > 2000000 then (gap + 1999999) // 2000000 - 1 else 0 end as k from g)
  select bag_id, camera, count(*) as n, sum(k)::bigint as filled from (select bag_id, camera, k, unnest(range(0, k + 1)) from k) group by 1, 2""".replace("sum(k)::bigint", "count(*) filter (i > 0)").replace("unnest(range(0, k + 1)) from", "unnest(range(0, k + 1)) i from"))
def preprocess(spark, d):
    """Deduplicated and gap-filled camera timelines: frames and copies."""
    return _camera_filled(spark, d, 2_000_000).groupBy("bag_id", "camera").agg(F.count("*").alias("n"), F.count_if("interpolated").alias("filled"))


@R.query(f"with {_CAM} select bag_id, camera, frame_no, t, false as interpolated from f")
def preprocess_dedup(spark, d):
    """Deduplicated camera timelines, nothing filled."""
    return _camera_filled(spark, d, None)


_MAIN = f"""x as (select bag_id, key, t, min(id) id from e group by 1, 2, 3),
  c as (select bag_id, key from (select bag_id, key, row_number() over (partition by bag_id order by case when key = 'purchase' then 0 else 1 end, count(*) desc, list_position(['view', 'click', 'error'], key)) rn from x where key <> 'signup' and key in ('view', 'click', 'purchase', 'error') group by 1, 2) where rn = 1)"""
_PRESCAN = f"""{_E}, o as (select bag_id, key, row_number() over (partition by bag_id order by case when key = 'purchase' then 0 else 1 end, count(*) desc, list_position(['view', 'click', 'error'], key)) rn from e where key in ('view', 'click', 'error', 'purchase') group by 1, 2),
  x as (select bag_id, key, t, min(id) id from e join (select bag_id, key from o where rn = 1) using (bag_id, key) group by 1, 2, 3),
  g as (select *, lead(t) over (partition by bag_id, key order by t) - t gap from x), k as (select *, case when gap > {12 * HOUR} then (gap + {12 * HOUR} - 1) // {12 * HOUR} - 1 else 0 end k from g),
  z as (select bag_id, key, case when i > 0 then t + (i * gap) // (k + 1) else t end as t from (select *, unnest(range(0, k + 1)) i from k)),
  n as (select *, row_number() over (partition by bag_id order by t) - 1 i, count(*) over (partition by bag_id) c from z),
  main as (select bag_id, key, t, row_number() over (partition by bag_id order by t) - 1 as frame from n where i >= 2 and i < c - 2 and (i - 2) % 3 = 0)"""


def _prescan(spark, d) -> DataFrame:
    return chains.main_timeline(messages(spark, d), ["bag_id"], "key", "t", "id", "purchase", ["view", "click", "error"], 12 * HOUR, 2, 3)


@R.query(f"with {_PRESCAN} select bag_id, key, t, frame from main")
def timeline_prescan(spark, d):
    """Timelines of purchases, else of the busiest other kind: gaps filled, ends dropped, strided."""
    return _prescan(spark, d)


@R.query(f"""with {_PRESCAN}, u as (select bag_id, key, t, min(id) id from e where key in ('view', 'click') group by 1, 2, 3), p as (select distinct bag_id, key from u),
  a as (select main.bag_id, p.key, frame, main.t, u.t as ut, u.id, row_number() over (partition by main.bag_id, p.key, frame order by abs(u.t - main.t), u.t desc, u.id) rn from main join p using (bag_id) join u on u.bag_id = main.bag_id and u.key = p.key)
  select bag_id, key, frame, t, id as near_id, case when abs(ut - t) > {6 * HOUR} then t else ut end as near_t, abs(ut - t) > {6 * HOUR} as corrected from a where rn = 1""")
def align_stream(spark, d):
    """Views and clicks aligned to a given timeline; rows further than six hours take the frame's time."""
    return chains.align(_prescan(spark, d), messages(spark, d, "view", "click"), ["bag_id"], "key", "t", "id", 6 * HOUR)


@R.query()
def align_strict(spark, d):
    """The strict profile from raw messages to repaired frames."""
    return chains.align_strict(messages(spark, d), ["bag_id"], "key", "t", "id", ["view", "click", "purchase", "error"], 24 * HOUR, 1, 2, 12 * HOUR)


_ALIGN = f"""{_PRESCAN}, u as (select bag_id, key, t, min(id) id from e where key in ('view', 'click') group by 1, 2, 3), p as (select distinct bag_id, key from u),
  a as (select main.bag_id, p.key, frame, main.t, u.t as ut, row_number() over (partition by main.bag_id, p.key, frame order by abs(u.t - main.t), u.t desc) rn from main join p using (bag_id) join u on u.bag_id = main.bag_id and u.key = p.key),
  al as (select bag_id, key, frame, t, ut from a where rn = 1), sp as (select bag_id, frame, max(ut) - min(ut) as spread from al group by 1, 2)"""


def _near_all(spark, d) -> DataFrame:
    return chains.align(_prescan(spark, d), messages(spark, d, "view", "click"), ["bag_id"], "key", "t", "id", 1 << 60)


@R.query(f"with {_ALIGN} select bag_id, key, frame, case when spread > {24 * HOUR} then t else ut end as near_t from al join sp using (bag_id, frame)")
def spread_repair(spark, d):
    """Frames whose modalities are more than a day apart take the timeline's time."""
    return quality.repair_spread(_near_all(spark, d), ["bag_id", "frame"], "t", "near_t", 24 * HOUR).select("bag_id", "key", "frame", "near_t")


@R.query(f"with {_ALIGN}, wk as (select bag_id, frame, spread, row_number() over (partition by bag_id order by spread desc, frame) as rank from sp) select bag_id, frame, spread, rank from wk where rank <= 3")
def worst_spreads(spark, d):
    """The three frames of each recording whose modalities are furthest apart."""
    return chains.worst(quality.frame_spread(_near_all(spark, d), ["bag_id", "frame"], "key", "near_t"), ["bag_id"], "spread", ["frame"])


@R.query(f"""with {_FRAMES}, s as (select bag_id, t, (t - lag(t) over (partition by bag_id order by t)) / 1000.0::double as d, abs(value) as v from f),
  a as (select bag_id, count(*) n, max(t) - min(t) us, max(d) mx, cast(max(v) as bigint) sp, case when max(t) > min(t) then count(*) / ((max(t) - min(t)) / 1e6::double) end rate from s group by 1)
  select bag_id, c.name as "check", c.v as value, c.lim as threshold from a, lateral (select unnest([{{'name': 'frames', 'v': n::double, 'lim': 60.0::double, 'bad': n < 60}}, {{'name': 'duration', 'v': us::double, 'lim': {float(24 * 30 * HOUR)}::double, 'bad': us < {24 * 30 * HOUR}}},
    {{'name': 'rate_low', 'v': rate, 'lim': 0.00002::double, 'bad': rate < 0.00002}}, {{'name': 'rate_high', 'v': rate, 'lim': 0.00003::double, 'bad': rate > 0.00003}}, {{'name': 'max_interval', 'v': mx, 'lim': {float(96 * HOUR / 1000)}::double, 'bad': mx > {96 * HOUR / 1000}}},
    {{'name': 'spread', 'v': sp::double, 'lim': 150.0::double, 'bad': sp > 150}}]) as c) where c.bad""")
def strict_validation(spark, d):
    """What episodes fail of the strict checks: frames, duration, rate, longest step, spread."""
    rows = messages(spark, d).withColumn("spread", F.abs("value"))
    per = rows.groupBy("bag_id").agg(F.bround(F.max("spread")).cast("bigint").alias("spread"))
    rows = rows.drop("spread").join(per, "bag_id")
    out = chains.validate_strict(rows, ["bag_id"], "t", "spread", 60, 24 * 30 * HOUR, 0.00002, 0.00003, 96 * HOUR / 1000, 150)
    return out.select("bag_id", "check", "value", "threshold")


@R.query(f"with {_FRAMES}, n as (select *, count(*) over (partition by bag_id) c from f) select bag_id, id from n where frame >= 3 and frame < c - 2")
def trim_frames(spark, d):
    return chains.trim_frames(messages(spark, d), ["bag_id"], ["t", "id"], 3, 2).select("bag_id", "id")


@R.query("""with r as (select distinct bag_id, seq, timestamp_us t, hz from messages join (select bag_id, coalesce(train_hz, 10) hz, row_number() over (partition by bag_id order by revision desc, train_hz desc nulls last) n from bag_config qualify n = 1) using (bag_id) where topic = '/cmd_pose_world_synced' and timestamp_us is not null),
  s as (select bag_id, t, hz, lead(t) over (partition by bag_id order by t) - t gap from r) select bag_id, t as gap_start, gap from s where gap > 1500000 // hz""")
def trajectory_gaps(spark, d):
    """Gaps of commands longer than one and a half steps of ten of the training rate."""
    from rillframe.operators.grid import latest_revision

    rows = table(spark, d, "messages").where("topic = '/cmd_pose_world_synced' and timestamp_us is not null").select("bag_id", "seq", F.col("timestamp_us").alias("t")).distinct()
    rate = latest_revision(table(spark, d, "bag_config"), "bag_id", "revision", ["train_hz"]).select("bag_id", F.coalesce("train_hz", F.lit(10).cast("bigint")).alias("hz"))
    found = clean.gaps(rows, ["bag_id"], "t", 0).join(rate, "bag_id")
    return found.where(F.col("gap") > F.call_function("div", F.lit(1_500_000).cast("bigint"), F.col("hz"))).select("bag_id", "gap_start", "gap")


_CLAW = "r as (select distinct bag_id, seq, timestamp_us t, data[1] a, data[2] b from messages where topic = '/leju_claw_state' and timestamp_us is not null and len(data) = 2 and not isnan(data[1]) and not isnan(data[2]) and data[1] is not null and data[2] is not null)"


@R.query(f"""with {_CLAW}, s as (select bag_id, min(t) a0, max(t) b0 from r group by 1 having max(t) - min(t) >= 2000000), m as (select *, (b0 - a0 - 2000000) // 1000000 as m from s),
  x as (select m.*, r.a, r.b, unnest(range(greatest(0, (r.t - a0 - 2000000) // 1000000 + case when r.t - a0 >= 2000000 then 1 else 0 end), least((r.t - a0) // 1000000, m.m) + 1)) as k from m join r using (bag_id)),
  w as (select bag_id, a0, b0, m, k, greatest(max(a) - min(a), max(b) - min(b)) as d from x group by 1, 2, 3, 4, 5),
  e as (select bag_id, a0, b0, m, min(k) filter (d > 30) as f, max(k) filter (d > 30) as l from w group by 1, 2, 3, 4)
  select bag_id, case when f is null then b0 - a0 when f > 0 then (f - 1) * 1000000 + 2000000 else 0 end as head, case when l is null then b0 - a0 when l < m then b0 - a0 - (l + 1) * 1000000 else 0 end as tail from e""")
def static_head_tail(spark, d):
    """How long the claws of a recording stand still at its start and end."""
    rows = table(spark, d, "messages").where("topic = '/leju_claw_state' and timestamp_us is not null and size(data) = 2 and not exists(data, x -> x is null or isnan(x))")
    return chains.static_ends(rows.select("bag_id", "seq", F.col("timestamp_us").alias("t"), "data").distinct(), ["bag_id"], "t", "data", 30.0)


_DIFFS = "v as (select vec_id, vec_id // 40 as bag, vec_id % 40 * 250000 as t, embedding from embeddings), p as (select a.bag, a.t, list_avg(list_transform(range(1, 65), lambda i: abs(a.embedding[i]::double - b.embedding[i]::double))) as diff from v a join v b on b.vec_id = a.vec_id - 1 and a.bag = b.bag)"


def _still(ratio: str, order: str = "t") -> str:
    return f"""w as (select bag, t - min(t) over (partition by bag) as t, diff <= 1.05 as c from p), s as (select bag, max(t) as z from w group by 1),
      r as (select s.bag, s.z, k, (select avg(c::int) from w where w.bag = s.bag and w.t <= 2000000 + k * 500000) as ratio from s, lateral (select unnest(range(0, greatest(0, (z - 2000000) // 500000 + 1))) as k)),
      q as (select bag, min(k) filter (ratio < {ratio}) as bad, max(k) as m from r group by 1)
      select s.bag, case when z < 2000000 then 0 when bad is null then 2000000 + m * 500000 when bad > 0 then 2000000 + (bad - 1) * 500000 else 0 end::bigint as still from s left join q using (bag)"""


def _diffs(spark, d) -> DataFrame:
    from rillframe.functions.vectors import frame_difference

    size = F.lit(40).cast("bigint")
    v = table(spark, d, "embeddings").select("vec_id", F.call_function("div", F.col("vec_id"), size).alias("bag"), (F.col("vec_id") % 40 * 250_000).alias("t"), F.col("embedding").alias("e"))
    before = v.select((F.col("vec_id") + 1).alias("vec_id"), "bag", F.col("e").alias("b"))
    return v.join(before, ["vec_id", "bag"]).select("bag", "t", frame_difference(F.col("e"), F.col("b")).alias("diff"))


@R.query(f"with {_DIFFS}, {_still('0.5')}")
def image_stillness(spark, d):
    """How long a series of frames stays calm from its start."""
    return chains.still_time(_diffs(spark, d), ["bag"], "t", "diff", 1.05, 0.5)


@R.query(f"with {_DIFFS}, x as ({'select * from (' + 'with ' + _still('0.5') + ')'}), n as (select bag, t, row_number() over (partition by bag order by t) - 1 i, count(*) over (partition by bag) c from p) select n.bag, n.t from n join x using (bag) where i >= least(still // 250000, c // 2) and i < c")
def stillness_trim(spark, d):
    """Frames without the calm ones at the start, of which at most half of the series is dropped."""
    diffs = _diffs(spark, d)
    head = chains.still_time(diffs, ["bag"], "t", "diff", 1.05, 0.5).join(diffs.groupBy("bag").agg(F.count("*").alias("c")), "bag")
    capped = annotations.trim_cap(F.call_function("div", F.col("still"), F.lit(250_000).cast("bigint")), F.col("c")).alias("head")
    return chains.trim_frames(diffs.join(head.select("bag", capped), "bag"), ["bag"], ["t"], F.col("head"), 0).select("bag", "t")


@R.query(f"""with {_E}, a as (select bag_id, count(*) n, max(t) - min(t) us, case when max(t) > min(t) then count(*) / ((max(t) - min(t)) / 1e6::double) end rate from e group by 1),
  c as (select *, case when rate < {1 / 43_200} then 'insert' when rate > {1 / 36_000} then 'remove' else 'keep' end as action from a),
  g as (select bag_id, lead(t) over (partition by bag_id order by t) - t g from e), p as (select bag_id, sum(pow(2, j))::bigint as may from g, range(0, 30) x(j) where g / pow(2.0::double, j) > {HOUR} group by 1)
  select bag_id, action, case action when 'keep' then n when 'insert' then n + greatest(0, least(cast(trunc(us / 1e6::double * {1 / 43_200}) as bigint) - n, coalesce(may, 0))) else greatest(least(n, 2), cast(trunc(us / 1e6::double * {1 / 43_200}) as bigint)) end as frames from c left join p using (bag_id)""")
def rate_adjust(spark, d):
    """Timelines brought between two rates, and how many frames they have then."""
    out = chains.adjust_rate(messages(spark, d).select("bag_id", "t"), ["bag_id"], "t", 1 / 43_200, 1 / 36_000, HOUR)
    return out.groupBy("bag_id", "action").agg(F.count("*").alias("frames"))


@R.query(f"""with {_FRAMES}, n as (select bag_id, count(*) n, greatest(1, count(*) * 2 // 3) k from f group by 1), s as (select distinct bag_id, case when k = 1 then 0 else (j * (n - 1)) // (k - 1) end as frame from (select *, unnest(range(0, k)) j from n))
  select bag_id, id from f join s using (bag_id, frame)""")
def rate_downsample(spark, d):
    """Two thirds of each recording's messages, evenly spaced."""
    return chains.downsample(messages(spark, d), ["bag_id"], ["t", "id"], F.call_function("div", F.col("_n") * 2, F.lit(3).cast("bigint"))).select("bag_id", "id")


@R.query("select bag_id from (select distinct bag_id from recordings where bag_id is not null) order by md5('7:' || bag_id), bag_id limit 50")
def random_subset(spark, d):
    """Fifty recordings taken at random with a seed."""
    return chains.random_subset(table(spark, d, "recordings").where("bag_id is not null").select("bag_id").distinct(), "bag_id", 50, 7)


@R.query("""with m as (select distinct * from marks) select mark_id, row_number() over (partition by bag_id order by coalesce(mark_start, trigger_time, ''), mark_id) - 1 as place from m where bag_id is not null""")
def action_order(spark, d):
    """Marks of a recording in the order of their stamps as text, those without first."""
    rows = table(spark, d, "marks").where("bag_id is not null").distinct()
    return rows.select("mark_id", (F.row_number().over(Window.partitionBy("bag_id").orderBy(F.coalesce("mark_start", "trigger_time", F.lit("")), "mark_id")) - 1).cast("bigint").alias("place"))


@R.query(f"with {_E}, k as (select *, round_even(value * 10, 0) r from e) select id, round(value, 6) as value from k where abs(value * 10 - r) / 10 > 0.01")
def off_grid_deltas(spark, d):
    """Time offsets that are no whole number of frames of a tenth of a second."""
    return quality.off_grid_deltas(messages(spark, d), "value", 10.0, 0.01).select("id", F.round("value", 6).alias("value"))


@R.query(f"with {_VEC}, p as (select label, vec_id % 7 as part, pos, x from v where not (vec_id % 7 = 3 and pos >= 32)) select label, pos, round(min(x), 6) as min, round(max(x), 6) as max, round(avg(x), 6) as mean, round(stddev_pop(x), 6) as std, count(x) as n from p group by 1, 2")
def stats_merge_missing(spark, d):
    """Statistics merged over parts one of which lacks half of the features."""
    v = vectors(spark, d).withColumn("part", F.col("vec_id") % 7)
    v = v.withColumn("v", F.when(F.col("part") == 3, F.slice("v", 1, 32)).otherwise(F.col("v")))
    out = stats.merge_stats(stats.feature_stats(v, ["label", "part"], "v"), ["label", "pos"])
    return out.select("label", F.col("pos").cast("bigint").alias("pos"), *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")], "n")


@R.query(f"with {_VEC} select label, 'shape' as reason from v group by 1 having count(*) < 0 union all select label, 'order' from v where pos = 5 and label % 2 = 1 group by 1 union all select label, 'mean' from v where pos = 5 and label % 2 = 1 group by 1 union all select label, 'spread' from v where pos = 6 and label % 3 = 1 group by 1")
def stats_violations(spark, d):
    """Malformed statistics: of some features, min and max are exchanged or the spread is negative."""
    s = stats.feature_stats(vectors(spark, d), ["label"], "v").withColumn("odd", (F.col("pos") == 5) & (F.col("label") % 2 == 1))
    s = s.withColumns({"min": F.when(F.col("odd"), F.col("max")).otherwise(F.col("min")), "max": F.when(F.col("odd"), F.col("min")).otherwise(F.col("max")), "std": F.when((F.col("pos") == 6) & (F.col("label") % 3 == 1), -F.col("std")).otherwise(F.col("std"))})
    return stats.stats_violations(s, ["label"]).select("label", "reason").distinct()


@R.query(f"with {_E} select key, count(*) as n, round(sum(value), 3) as total, round(avg(value), 6) as mean, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.95), 6) as p95, round(arg_max(value, (t, id)), 6) as last from e group by 1")
def timing_summary(spark, d):
    """Recorded durations: count, total, mean, percentiles, last."""
    return quality.timings(messages(spark, d), ["key"], "value", ["t", "id"]).select("key", "n", F.round("total", 3).alias("total"), *[F.round(c, 6).alias(c) for c in ("mean", "p50", "p95", "last")])


@R.query("select 64 * count(*) + 2 * count(*) as rows from embeddings")
def leaf_count(spark, d):
    """Values in all leaves of nested rows."""
    return quality.leaf_rows(table(spark, d, "embeddings"))


@R.query("with s as (select * from steps where step_start is not null and step_end is not null) select bag_id, round(arg_min(step_start, (step_start, step_end, step_id)), 6) as low, round(arg_max(step_end, (step_start, step_end, step_id)), 6) as high from s where bag_id is not null group by 1")
def step_range(spark, d):
    """Range of a recording that its first and last step set."""
    rows = table(spark, d, "steps").where("bag_id is not null and step_start is not null and step_end is not null")
    return annotations.step_range(rows, ["bag_id"], "step_start", "step_end", "step_id").select("bag_id", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@R.query("""with f as (select distinct bag_id, camera, frame_no, timestamp_us t from camera_frames where timestamp_us is not null), r as (select bag_id, camera, case when max(t) > min(t) then count(*) / ((max(t) - min(t)) / 1e6::double) end rate from f group by 1, 2)
  select bag_id, camera, round(rate, 6) as rate from r where rate <= 20 or rate is null""")
def camera_rate_gate(spark, d):
    """Cameras slower than 20 frames a second."""
    rows = table(spark, d, "camera_frames").where("timestamp_us is not null").select("bag_id", "camera", "frame_no", "timestamp_us").distinct()
    return quality.slow_keys(rows, ["bag_id", "camera"], "timestamp_us", 20.0).select("bag_id", "camera", F.round("rate", 6).alias("rate"))


_HANDS = ["/gripper/state", "/leju_claw_state", "/leju_claw_command"]


@R.query(f"select bag_id, arg_min(topic, list_position({_HANDS}, topic)) as topic from messages where topic in {tuple(_HANDS)} and len(data) > 0 group by 1")
def effector_probe(spark, d):
    """The first topic of hands that a recording has any data of."""
    return clean.first_present(table(spark, d, "messages").where("size(data) > 0"), ["bag_id"], "topic", _HANDS)


@R.query("select count(distinct bag_id) as bags, count(*) as frames, count(*) filter (timestamp_us is not null) as stamped from camera_frames")
def frame_counters(spark, d):
    """Counters observed while a table passes by, read after the pass."""
    counted, seen = quality.counted(table(spark, d, "camera_frames"), {"frames": F.count(F.lit(1)), "stamped": F.count("timestamp_us")})
    bags = counted.select("bag_id").distinct().count()
    return spark.createDataFrame([(bags, seen.get["frames"], seen.get["stamped"])], "bags bigint, frames bigint, stamped bigint")


_REMOVED = f"{_E}, a as (select bag_id, count(*) n, min(t) a, max(t) b, cast(trunc((max(t) - min(t)) / 1e6::double * {1 / 36_000}) as bigint) k from e group by 1)"


@R.query(f"with {_REMOVED} select bag_id, greatest(least(n, 2), least(n, k)) as frames, a as first, b as last, true as rising from a")
def frame_remove_ends(spark, d):
    """What thinned timelines keep: the number asked for, both ends, the order."""
    thin = timeline.remove_frames(messages(spark, d).select("bag_id", "t"), ["bag_id"], "t", 1 / 36_000)
    back = F.coalesce(F.col("t") < F.lag("t").over(Window.partitionBy("bag_id").orderBy("t")), F.lit(False))
    return thin.withColumn("back", back).groupBy("bag_id").agg(F.count("*").alias("frames"), F.min("t").alias("first"), F.max("t").alias("last"), (F.count_if("back") == 0).alias("rising"))
