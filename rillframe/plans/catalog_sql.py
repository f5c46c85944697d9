"""DuckDB twins of the catalogue queries."""

_E = "e as (select user_id bag_id, event_type as key, epoch_us(ts) t, event_id id, value, props from events)"
_HOUR = 3_600_000_000


def _near(tie: str) -> str:
    return f"""{_E}, m as (select * from e where key='view'), o as (select * from e where key='click'),
    near as (select m.bag_id, m.t, m.id, o.t near_t, o.id near_id, o.t-m.t delta, row_number() over (partition by m.id order by abs(o.t-m.t), o.t {tie}, o.id) rn
      from m left join o on m.bag_id=o.bag_id qualify rn=1)"""


_FRAMES = f"{_E}, f as (select *, row_number() over (partition by bag_id order by t,id)-1 frame from e)"
_VEC = "v as (select vec_id, cast(label as bigint) as label, pos-1 as pos, cast(embedding[pos] as double) x from embeddings, range(1,65) r(pos))"
_MARKS = f"""{_E}, span as (select bag_id, min(t) a, max(t) b, count(*) n from e group by 1),
    k as (select e.bag_id, id, n, t s, t+cast(trunc(value*1e9) as bigint) z, a, b from e join span using(bag_id) where key='purchase'),
    marks as (select bag_id, id, n, case when s<=b and z>=a then least(n-1, greatest(0, cast(trunc((greatest(s,a)-a)/cast(b-a as double)*n) as bigint))) end as first,
      case when s<=b and z>=a then least(n-1, greatest(0, cast(trunc((least(z,b)-a)/cast(b-a as double)*n) as bigint))) end as last from k)"""
_CUST = "c as (select cast(c_nationkey as bigint) dataset, c_custkey episode, count(*) frames from customer join orders on o_custkey=c_custkey group by 1,2)"
_STATS = "round(min(x),6) as min, round(max(x),6) as max, round(avg(x),6) as mean, round(stddev_pop(x),6) as std, count(x) as n"
_C2T = "[2,1.05,1.05,2,2.1,2.1,2,1.05,1.05,2,2.1,2.1,1.05,5,2.3,5,4.7,4.7,4.7,1.05,5,2.3,5,4.7,4.7,4.7,0.21,4.7]"
_DIV = "case when pos between 13 and 18 or pos between 20 and 27 then 2.1 when pos in (1,2,7,8,12,19) then 1.2 end"

ORACLES = {
    "nearest_asof_later": f"with {_near('desc')} select id, near_id, delta from near",
    "nearest_asof_sliced": f"with {_near('desc')} select id, near_id, delta from near",
    "nearest_asof_earlier": f"with {_near('asc')} select id, near_id, delta from near",
    "nearest_with_tolerance": f"with {_near('desc')} select id, case when abs(delta)>{_HOUR} then t else near_t end as aligned_t, coalesce(abs(delta)>{_HOUR}, false) as corrected from near",
    "frames_to_force": """with f as (select distinct bag_id, camera, frame_no, timestamp_us t from camera_frames where timestamp_us is not null),
      o as (select distinct bag_id, timestamp_us t from messages where topic='/force6d_left_hand_force_torque' and timestamp_us is not null and len(data)>0),
      p as (select f.*, o.t pt from f asof left join o on f.bag_id=o.bag_id and f.t>=o.t),
      n as (select p.*, o.t nt from p asof left join o on p.bag_id=o.bag_id and p.t<=o.t)
      select bag_id, camera, frame_no, x near_t, x-t delta from (select *, case when nt is null or t-pt < nt-t then pt else nt end x from n)""",
    "dedup_keep_first": f"with {_E} select bag_id, key, t//{_HOUR} as hour, id from e qualify row_number() over (partition by bag_id, key, t//{_HOUR} order by t,id)=1",
    "gap_gate": f"with {_E} select * from (select bag_id, key, t gap_start, lead(t) over (partition by bag_id,key order by t)-t gap from e) where gap>{6 * _HOUR}",
    "gap_fill": f"""with {_E}, g as (select bag_id, id, t, lead(t) over (partition by bag_id order by t)-t gap from e where key='view'),
      k as (select *, case when gap>{2 * _HOUR} then (gap+{2 * _HOUR}-1)//{2 * _HOUR}-1 else 0 end k from g)
      select bag_id, id, case when i>0 then t+(i*gap)//(k+1) else t end as t, i>0 as interpolated from (select *, unnest(range(0,k+1)) i from k)""",
    "gap_interval_flag": f"""with {_E}, g as (select bag_id, t a, lead(t) over (partition by bag_id order by t) b from e where key='view')
      select e.id, coalesce(bool_or(g.b-g.a>{12 * _HOUR} and e.t>g.a and e.t<g.b), false) as in_gap from e left join g on e.bag_id=g.bag_id where e.key='click' group by 1""",
    "master_timeline": f"""with {_E}, o as (select * from e where key='view' qualify row_number() over (partition by bag_id, t//{_HOUR} order by t,id)=1),
      n as (select *, row_number() over (partition by bag_id order by t,id)-1 i, count(*) over (partition by bag_id) c from o)
      select bag_id, id from n where i>=1 and i<c-1 and (i-1)%3=0""",
    "timeline_key_choice": f"""with {_E} select bag_id, key from (select bag_id, key, row_number() over (partition by bag_id order by count(*) desc, list_position(['view','click','purchase','error'], key)) rn
      from e where key in ('view','click','purchase','error') group by 1,2) where rn=1""",
    "end_boundary_trim": f"with {_E}, b as (select bag_id, min(l) z from (select bag_id, key, max(t) l from e group by 1,2) group by 1) select bag_id, id from e join b using(bag_id) where t<z",
    "channel_choice_first_seen": f"with {_E}, x as (select * from e where key in ('view','click')) select bag_id, key, id from x qualify key = first_value(key) over (partition by bag_id order by t,id)",
    "channel_choice_fallback": f"with {_E} select bag_id, key, id from e where key='purchase' or (key='error' and bag_id not in (select bag_id from e where key='purchase'))",
    "fraction_range": f"""with {_E}, b as (select bag_id, min(t) a, max(t) z from e group by 1)
      select bag_id, id from e join b using(bag_id) where t between a+cast(trunc((z-a)*0.25::double) as bigint) and a+cast(trunc((z-a)*0.75::double) as bigint)""",
    "interval_stats": f"""with {_E}, s as (select bag_id, key, t, (t-lag(t) over (partition by bag_id,key order by t))/1000.0::double d from e)
      select bag_id, key, count(t) n, count(distinct t) n_distinct, round(min(d),3) min_ms, round(max(d),3) max_ms, (max(t)-min(t))/nullif(count(t)-1,0)/1000.0::double as mean_ms, round(stddev_pop(d),2) std_ms from s group by 1,2""",
    "camera_timeline_checks": """with f as (select distinct bag_id, camera, frame_no, timestamp_us t from camera_frames where timestamp_us is not null),
      s as (select *, (t-lag(t) over (partition by bag_id,camera order by t))/1000.0::double d from f),
      a as (select bag_id, camera, count(t) n, count(distinct t) nd, min(d) mn, max(d) mx, stddev_pop(d) sd, case when max(t)>min(t) then count(*)/((max(t)-min(t))/1e6::double) end rate from s group by 1,2),
      c as (select bag_id, camera, 'max_interval' as "check", mx as value, 40.0::double as threshold from a where mx>40 union all select bag_id, camera, 'min_interval', mn, 0.1 from a where mn<0.1
        union all select bag_id, camera, 'duplicates', n-nd, 0 from a where n>nd union all select bag_id, camera, 'jitter', sd, 15 from a where sd>15
        union all select bag_id, camera, 'rate_low', rate, 29.905 from a where rate<29.905 union all select bag_id, camera, 'rate_high', rate, 30.095 from a where rate>30.095)
      select bag_id, camera, "check", round(value,3) as value, threshold from c""",
    "frame_spread": f"with {_E} select bag_id, t//{24 * _HOUR} as frame, max(t)-min(t) as spread from e where key<>'error' group by 1,2",
    "error_histogram": f"""with {_near('desc')} select bag_id, count(delta) n, count(*) filter (abs(delta)>{_HOUR}) over_1h, count(*) filter (abs(delta)>{2 * _HOUR}) over_2h, count(*) filter (abs(delta)>{6 * _HOUR}) over_6h,
      round(avg(abs(delta)),3) mean_abs, max(abs(delta)) max_abs from near group by 1""",
    "effective_rate": f"with {_E} select bag_id, key, round(case when max(t)>min(t) then count(*)/((max(t)-min(t))/1e6::double) end * 1e6, 6) per_million_s from e group by 1,2",
    "frame_numbering": f"with {_E} select id, row_number() over (partition by bag_id order by t,id)-1 frame_index, row_number() over (order by bag_id,t,id)-1 as index from e",
    "episode_offsets": f"with {_E}, l as (select bag_id, count(*) as length from e group by 1) select bag_id, length, cast(sum(length) over (order by bag_id) as bigint)-length from_index, cast(sum(length) over (order by bag_id) as bigint) to_index from l",
    "delta_window": f"""with {_FRAMES}, n as (select bag_id, count(*) n from f group by 1),
      a as (select f.bag_id, frame, d as delta, greatest(0, least(n-1, frame+d)) w, frame+d<0 or frame+d>=n is_pad from f join n using(bag_id), (values (-1),(0),(2)) x(d))
      select a.bag_id, a.frame, cast(delta as bigint) delta, f.id, is_pad from a join f on f.bag_id=a.bag_id and f.frame=a.w""",
    "regularity_check": f"with {_FRAMES} select * from (select bag_id, frame, t-lag(t) over (partition by bag_id order by frame) step from f) where abs(step-{6 * _HOUR})>{6 * _HOUR}",
    "batch_stitch": f"with {_FRAMES} select id, frame as local, round(frame/30.0::double, 6) as rel from f",
    "stuck_prefix_repair": f"""with {_near('desc')}, a as (select *, row_number() over (partition by bag_id order by t,id)-1 frame from near where near_t is not null),
      w as (select bag_id, min(frame) filter (abs(near_t-t)<={_HOUR // 6}) first from a group by 1)
      select id, case when frame<coalesce(first,50) then t else near_t end as near_t, frame<coalesce(first,50) as repaired from a join w using(bag_id)""",
    "start_offset_search": f"""with {_near('desc')}, a as (select *, row_number() over (partition by bag_id order by t,id)-1 frame from near where near_t is not null),
      s as (select s.start, a.bag_id, max(abs(delta)) worst, count(*) n from a, range(0,20) s(start) where a.frame between s.start and s.start+4 group by 1,2 having count(*)=5)
      select bag_id, start, worst from s qualify row_number() over (partition by bag_id order by case when worst<={2 * _HOUR} then 0 else worst end, start)=1""",
    "annotation_frames": f"with {_MARKS} select id, first, last from marks",
    "annotation_chain": f"""with {_MARKS}, r as (select *, lpad(cast(id as varchar),12,'0') stamp, row_number() over w i, lead(id) over w is null lst, coalesce(first_value(first) over w, 0) f0 from marks window w as (partition by bag_id order by lpad(cast(id as varchar),12,'0'))),
      x as (select *, greatest(f0, max(case when lst then n-1 else coalesce(least(last,n-1),0) end) over (partition by bag_id order by stamp)) z from r)
      select bag_id, stamp, coalesce(lag(z) over (partition by bag_id order by stamp), f0) start_frame, z end_frame from x""",
    "annotation_range": f"with {_E}, k as (select bag_id, try_cast(json_extract_string(props,'$.k') as double) k from e) select bag_id, min(k) as low, max(k) as high from k group by 1",
    "metadata_normalise": """with b as (select distinct file_id, body from sidecar_files where doc_kind='metadata' and json_valid(body)),
      x as (select *, starts_with(m,'[') nw from (select file_id, body, coalesce(json_extract_string(body,'$.marks'),'') m, coalesce(json_extract_string(body,'$.moments'),'') o from b))
      select file_id, case when nw then 'new' else 'old' end as generation,
        coalesce(case when nw and json_valid(m) then json_array_length(m) when not nw and json_valid(o) and starts_with(o,'[') then json_array_length(o) end, 0)::bigint as n_marks,
        """
    + ", ".join(f"coalesce(nullif(trim(json_extract_string(body,'$.{a}')),''), nullif(trim(json_extract_string(body,'$.{b}')),'')) as {n}" for a, b, n in (("primaryScene", "scene_code", "scene"), ("tertiaryScene", "sub_scene_code", "sub_scene"), ("taskName", "task_name", "task"), ("deviceSn", "device_sn", "device")))
    + " from x",
    "device_rules": """with r as (select distinct bag_id, device_sn, cast(cast(make_timestamp(start_us) as date) as varchar) as day from recordings),
      k(device_sn, since, until, action) as (values ('KV66U1013','0000','2026-06-30','flip'),('KV66U1013','2026-07-01','9999','swap'),('KV28L1048','2025-06-01','2026-01-31','flip'))
      select bag_id, min(action) as action from r left join k on r.device_sn=k.device_sn and day between since and until group by bag_id""",
    "feature_stats": f"with {_VEC} select label, pos, {_STATS} from v group by 1,2",
    "stats_merge_parallel": f"with {_VEC} select label, pos, {_STATS} from v group by 1,2",
    "stats_merge_sumsq": f"with {_VEC} select label, pos, {_STATS.replace(',6)', ',5)')} from v group by 1,2",
    "even_sample": f"""with {_E}, r as (select key, id, row_number() over (partition by key order by t,id)-1 i, count(*) over (partition by key) n from e),
      k as (select key, n, greatest(least(n,100), least(cast(trunc(pow(n,0.75)) as bigint),10000)) k from (select distinct key, n from r)),
      w as (select distinct key, cast(round_even(j*(n-1)/(k-1)::double,0) as bigint) i from (select *, unnest(range(0,k)) j from k))
      select key, i, id from r join w using(key,i)""",
    "normalise_features": f"with {_VEC}, s as (select label, pos, avg(x) m, stddev_pop(x) d from v group by 1,2) select vec_id, pos, round(case when d>0 then (x-m)/d else 0 end,5) as x from v join s using(label,pos)",
    "vector_slices": f"with {_VEC} select vec_id, case when pos between 12 and 25 then 37-pos else pos end as pos, round(x,6) as x from v where pos<28",
    "current_to_torque": f"with {_VEC} select vec_id, pos, round(x*coalesce({_C2T}[pos+1]::double/({_DIV})::double, 1),5) as x from v where pos<28",
    "torque_round_trip": f"with {_VEC} select vec_id, pos, round(x*coalesce(({_DIV})::double,1)/{_C2T}[pos+1]::double,5) as x from v where pos<28",
    "hand_normalise": f"""with {_VEC}, c as (select vec_id, max(x*500) filter (pos=0) a, max(x*500) filter (pos=1) b from v group by 1)
      select vec_id, case when a>50 then 1.0::double else 0.0 end as on1, case when b>50 then 1.0::double else 0.0 end as on2, round(a/100,5) as share1, round(b/100,5) as share2 from c""",
    "intrinsics_split": "select vec_id, "
    + ", ".join(f"round(cast(embedding[{i}] as double),6) as {n}" for n, i in (("fx", 6), ("fy", 10), ("ppx", 8), ("ppy", 11), ("k1", 1), ("k3", 5)))
    + " from embeddings",
    # joint a about z at height 1, joint b about y half a metre out, the tip a quarter further
    "forward_kinematics": "with q as (select vec_id, cast(embedding[1] as double) a, cast(embedding[2] as double) b from embeddings), w as (select *, cos(a/2)*cos(b/2) as w from q), s as (select *, case when w<0 then -1 else 1 end as s from w) select vec_id, round(cos(a)*(0.5+0.25*cos(b)),6) as x, round(sin(a)*(0.5+0.25*cos(b)),6) as y, round(1-0.25*sin(b),6) as z, round(-s*sin(a/2)*sin(b/2),6) as qx, round(s*cos(a/2)*sin(b/2),6) as qy, round(s*sin(a/2)*cos(b/2),6) as qz, round(s*w,6) as qw from s",
    "frame_difference": f"with {_VEC} select a.vec_id, round(avg(abs(a.x-b.x)),6) as diff from v a join v b on b.vec_id=a.vec_id+1 and a.pos=b.pos group by 1",
    "dataset_merge": f"""with {_CUST}, k as (select dataset from c group by 1 having sum(frames)>=95)
      select dataset, episode, frames, row_number() over (order by dataset, episode)-1 as episode_index from c where dataset in (select dataset from k)""",
    "rechunk": "select c_custkey as episode_index, c_custkey//1000 as chunk, printf('data/chunk-%03d/episode_%06d.parquet', c_custkey//1000, c_custkey) as path from customer",
    "multi_dataset_concat": """with x as (select 0::bigint dataset_index, row_number() over (order by c_custkey)-1 local_index, c_custkey as key, c_name as name from customer
      union all select 1, row_number() over (order by s_suppkey)-1, s_suppkey, s_name from supplier)
      select *, local_index + case when dataset_index=1 then (select count(*) from customer) else 0 end as index from x""",
    "task_encode": "select source, row_number() over (order by min(doc_id))-1 as task_index from documents where source is not null group by 1",
    "summary_report": f"with {_CUST} select count(*) episodes, cast(sum(frames) as bigint) frames, cast(ceil(count(*)/1000.0) as bigint) chunks, round(sum(frames)/30.0::double,6) as seconds, round(sum(frames)/30.0::double/3600,6) as hours from c",
    "name_sanitise": r"select distinct bag_id, coalesce(nullif(regexp_replace(regexp_replace(note,'[^\p{L}\p{N}_.\-]','_','g'),'^[._]+|[._]+$','','g'),''),'bag') as name from recordings",
    "magic_cut": "select doc_id, octet_length(encode(substr(text, strpos(text,'KV')))) as n_bytes from documents where strpos(text,'KV')>0",
    "required_topics_anti": """with b as (select distinct bag_id from messages), q(topic) as (values ('/force6d_left_hand_force_torque'),('/force6d_right_hand_force_torque'),('/leju_claw_state'),('/gripper/state'))
      select bag_id, topic from b, q except select bag_id, topic from messages""",
    "length_consistency": """with l as (select bag_id, camera, count(distinct frame_no) frames from camera_frames group by 1,2),
      m as (select bag_id, frames expected from (select bag_id, frames, row_number() over (partition by bag_id order by count(*) desc, frames) rn from l group by 1,2) where rn=1)
      select bag_id, camera, frames, expected from l join m using(bag_id) where frames<>expected""",
    "topic_rates": """with r as (select distinct bag_id, topic, seq, timestamp_us t from messages where timestamp_us is not null)
      select bag_id, topic, round(case when max(t)>min(t) then count(*)/((max(t)-min(t))/1e6::double) end,4) as rate from r group by 1,2""",
    "frame_insert": f"""with {_E}, r as (select bag_id, t, lead(t) over (partition by bag_id order by t)-t g from e where key='view'),
      n as (select bag_id, cast(trunc((max(t)-min(t))/1e6::double/21600) as bigint) tg, count(*) c from r group by 1),
      p as (select bag_id, t, j, g/pow(2.0::double,j) size from r, range(0,24) x(j) where g>{_HOUR} and g/pow(2.0::double,j)>{_HOUR}),
      q as (select bag_id, size, t+i*size pos from (select *, unnest(range(0, cast(pow(2,j) as bigint))) i from p)),
      k as (select q.*, row_number() over (partition by bag_id order by size desc, pos) rn from q)
      select bag_id, t, false as inserted from r union all select bag_id, cast(trunc(pos+size/2) as bigint), true from k join n using(bag_id) where rn<=tg-c""",
    "continuity_shift": f"""with recursive {_FRAMES}, s as (select bag_id, frame // 20 as batch, min(t) a, max(t) b from f group by 1, 2),
      m as (select bag_id, batch, 0::bigint as shift, b as z from s where batch = 0 union all select s.bag_id, s.batch,
        case when s.a - m.z between {_HOUR} and {6 * _HOUR} then 0 else m.z + {2 * _HOUR} - s.a end, s.b + case when s.a - m.z between {_HOUR} and {6 * _HOUR} then 0 else m.z + {2 * _HOUR} - s.a end
        from m join s on s.bag_id = m.bag_id and s.batch = m.batch + 1)
      select id, t + shift as t from f join m on f.bag_id = m.bag_id and f.frame // 20 = m.batch""",
    "stream_batches": f"""with {_E}, n as (select bag_id, t, (row_number() over (partition by bag_id order by t) - 1) // 20 as batch from e where bag_id is not null and t is not null)
      select bag_id, batch, min(t) as first_t, max(t) as last_t, count(*) as n from n group by 1, 2""",
    "batch_windowed_nearest": f"""with {_FRAMES}, m as (select bag_id, id, t, frame//20 as batch from f where key='view'),
      s as (select bag_id, batch, min(t) a, max(t) b from m group by 1,2), z as (select *, lag(b) over (partition by bag_id order by batch) pb from s),
      w as (select bag_id, batch, greatest(a-{2 * _HOUR}, coalesce(pb+1, a-{2 * _HOUR})) lo, b+{_HOUR} hi from z),
      o as (select w.bag_id, w.batch, e.t, e.id from w join e on e.bag_id=w.bag_id and e.key='click' and e.t between lo and hi)
      select m.id, o.id as near_id from m left join o on m.bag_id=o.bag_id and m.batch=o.batch qualify row_number() over (partition by m.id order by abs(o.t-m.t), o.t desc)=1""",
}
