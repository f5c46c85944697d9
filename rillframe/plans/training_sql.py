"""DuckDB twins of the p queries that SQL can state."""

from rillframe.functions.units import UNITS
from rillframe.operators.instants import _LENGTHS, ABBREVIATIONS, MONTHS

# p6: texts to candidate wall clocks (microseconds), offsets from the text or from the site's zone, and the choice nearest to the recording
_TIME, _ZONE = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)? ?([AaPp][Mm])?", r" ?([Zz]|[+-]\d{2}(?::?\d{2})?|[A-Za-z]{2,5})?"
_FORMS = [
    (rf"^(\d{{4}})[-/.年](\d{{1,2}})[-/.月](\d{{1,2}})日?[Tt ]? ?{_TIME}{_ZONE}$", "y,m,d,h,i,s,f,ap,z"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})[Tt ](\d{{2}})(\d{{2}})(\d{{2}})(?:[.,](\d+))?(){_ZONE}$", "y,m,d,h,i,s,f,ap,z"),
    (rf"^(\d{{1,2}})[./-](\d{{1,2}})[./-](\d{{4}}),?[Tt ] ?{_TIME}{_ZONE}$", "d,m,y,h,i,s,f,ap,z"),
    (rf"^(?:[A-Za-z]{{2,9}},? )?(\d{{1,2}}) ([A-Za-z]{{3}})[a-z]*\.? (\d{{4}}) {_TIME}{_ZONE}$", "d,m,y,h,i,s,f,ap,z"),
]


def _text_form(n: int) -> str:
    pattern, names = _FORMS[n]
    return f"regexp_extract(text, '{pattern}', [{', '.join(repr(x) for x in names.split(','))}])"


def _tidy(c: str) -> str:
    return rf"trim(regexp_replace(replace({c}, '−', '-'), '[\x{{00a0}}\x{{2007}}\x{{2009}}\x{{202f}}\s]+', ' ', 'g'))"


_ABBR = "map {" + ", ".join(f"'{k}': {v}" for k, v in ABBREVIATIONS.items()) + "}"
_MONTH = "list_position(" + repr(MONTHS) + ", lower(g.m))"
_OFF = "epoch_us(timezone(zone, make_timestamptz({0}))) - ({0})"
_WALL = (
    "epoch_us(try_cast(printf('%04d-%02d-%02d %02d:%02d:%02d', try_cast(g.y as int), {m}, {d}, case lower(g.ap) when 'pm' then try_cast(g.h as int) % 12 + 12 when 'am' then try_cast(g.h as int) % 12 else try_cast(g.h as int) end, try_cast(g.i as int), "
    "case when g.s = '' then 0 else try_cast(g.s as int) end) as timestamp)) + case when g.f = '' then 0 else rpad(g.f[1:6], 6, '0')::bigint end"
)
_LENGTH_MAP = "map {" + ", ".join(f"'{n}': {float(f)}" for f, ns in _LENGTHS.items() for n in ns) + "}"
_NUM = r"\d+(?:\.\d+)?|\.\d+"
_P6 = rf"""with cells as (select distinct mark_id, bag_id, field, {_tidy('raw')} as text from (
   select mark_id, bag_id, unnest(['mark_start','mark_end','trigger_time']) field, unnest([mark_start, mark_end, trigger_time]) raw from marks) where raw is not null),
 e as (select *, regexp_extract(text, '^(\d{{9,20}})(?:\.(\d+))?$', ['w','f']) n, case {' '.join(f"when regexp_matches(text, '{p}') then {i}" for i, (p, _) in enumerate(_FORMS))} end form from cells),
 p as (select *, case form {' '.join(f"when {i} then {_text_form(i)}" for i in range(4) if i < 2)} end as a, case form {' '.join(f"when {i} then {_text_form(i)}" for i in (2, 3))} end as b from e),
 q as (select *, case when form < 2 then {{'y': a.y, 'm': a.m, 'd': a.d, 'h': a.h, 'i': a.i, 's': a.s, 'f': a.f, 'ap': a.ap, 'z': a.z}} when form >= 2 then {{'y': b.y, 'm': b.m, 'd': b.d, 'h': b.h, 'i': b.i, 's': b.s, 'f': b.f, 'ap': b.ap, 'z': b.z}} end as g from p),
 w as (select mark_id, bag_id, field, n, g.z as z, case when length(n.w) between 9 and 11 then n.w::hugeint * 1000000 + case when n.f = '' then 0 else rpad(n.f[1:6], 6, '0')::bigint end when length(n.w) between 12 and 14 then n.w::hugeint * 1000 + case when n.f = '' then 0 else rpad(n.f[1:3], 3, '0')::bigint end
     when length(n.w) between 15 and 17 then n.w::hugeint when length(n.w) >= 18 then n.w::hugeint // 1000 end as epoch,
   case when form is null or (g.ap <> '' and try_cast(g.h as int) not between 1 and 12) then [] when form = 2 then [{_WALL.format(m='try_cast(g.m as int)', d='try_cast(g.d as int)')}, {_WALL.format(m='try_cast(g.d as int)', d='try_cast(g.m as int)')}]
     when form = 3 then [case when {_MONTH} > 0 then {_WALL.format(m=_MONTH, d='try_cast(g.d as int)')} end] else [{_WALL.format(m='try_cast(g.m as int)', d='try_cast(g.d as int)')}] end as walls from q),
 r as (select bag_id, max(device_sn) device_sn, min(start_us) low, max(end_us) high from recordings group by 1),
 s as (select w.*, low, high, (select max(time_zone) from devices d where d.device_sn = r.device_sn) as zone, unnest(case when epoch is not null then [null] else walls end) as wall from w left join r using (bag_id)),
 o as (select *, case when z is null or z = '' then case when low is null or zone is null then [] else list_distinct([{_OFF.format('low')}, {_OFF.format('high')}, {_OFF.format('(low - 21600000000)')}, {_OFF.format('(high + 21600000000)')}]) end
     when regexp_matches(z, '^[+-]') then [(case when z[1] = '-' then -1 else 1 end) * (regexp_replace(z, '[^0-9]', '', 'g')[1:2]::bigint * 60 + coalesce(try_cast(regexp_replace(z, '[^0-9]', '', 'g')[3:4] as bigint), 0)) * 60000000]
     else list_transform(coalesce({_ABBR}[upper(z)], []), lambda x: x::bigint * 60000000) end as offs from s where epoch is not null or wall is not null),
 x as (select *, unnest(case when epoch is not null then [0::bigint] else offs end) as off from o),
 y as (select *, coalesce(epoch, wall - off)::bigint as inst, epoch is null and coalesce(z, '') = '' and {_OFF.format('(wall - off)')} <> off as unlawful from x),
 k as (select mark_id, field, inst, row_number() over (partition by mark_id, bag_id, field, n, z, walls order by unlawful, coalesce(greatest(low - inst, inst - high, 0), 0), inst) rn from y)
 select distinct mark_id, field, inst as value_us from k where rn = 1
 union all select distinct mark_id, 'duration', cast(round(us) as bigint) from (select mark_id, coalesce(
   case when regexp_matches(t, '^\+?(?:{_NUM})$') then try_cast(t as double) * 1000000 end,
   case when regexp_matches(t, '^(?:\d+:)?\d{{1,2}}:\d{{1,2}}(?:\.\d+)?$') then list_sum(list_transform(list_reverse(string_split(t, ':')), lambda v, i: v::double * [1, 60, 3600][i])) * 1000000 end,
   case when length(t) > 2 and regexp_matches(t, '^p(?:\d+d)?(?:t(?:\d+h)?(?:\d+m)?(?:\d+(?:\.\d+)?s)?)?$') then {' + '.join(f"coalesce(try_cast(regexp_extract(t, '{v}', 1) as double), 0) * {f}" for v, f in ((r'(\d+)d', 86_400_000_000), (r'(\d+)h', 3_600_000_000), (r'(\d+)m', 60_000_000), (r'(\d+(?:\.\d+)?)s', 1_000_000)))} end,
   case when regexp_matches(t, '^(?:(?:{_NUM}) ?[a-zµμ\p{{Han}}]+\.? ?)+$') then list_sum(list_transform(regexp_extract_all(t, '({_NUM}) ?[a-zµμ\p{{Han}}]+\.?', 1), lambda v, i: v::double * {_LENGTH_MAP}[regexp_extract_all(t, '(?:{_NUM}) ?([a-zµμ\p{{Han}}]+)\.?', 1)[i]])) end) us, 
   t from (select mark_id, regexp_replace(lower({_tidy('duration')}), '(\d),(\d)', '\1.\2', 'g') t from marks where duration is not null)) where us is not null"""

# p2: a spelling without case and separators is a key of the names of units; a note is searched for whole names
_ODD = r"[ .·*\-_/]"


def _key(text: str) -> str:
    return f"regexp_replace(lower({text}), '{_ODD}', '', 'g')"


_UNIT_ROWS = ", ".join(f"('{q}', '{u}', {f!r}::double, '{n}')" for u, (q, f, names) in UNITS.items() for n in names)
_NUMBER = r"^([+-]?(?:\d[\d.,]*\d|\d|[.,]\d+)(?:[eE][+-]?\d+)?)"
_P2 = rf"""with names(quantity, unit, factor, name) as (values {_UNIT_ROWS}), keys as (select quantity, {_key('name')} as key, min(unit) as unit, min(factor) as factor from names group by 1, 2),
 rows0 as (select reading_id, bag_id, unnest(['effort', 'current_value']) as field, unnest(['torque', 'current']) as quantity, unnest([effort, current_value]) as raw, unnest([effort_unit, current_unit]) as label from joint_states),
 rows1 as (select reading_id, bag_id, field, quantity, {_tidy('raw')} as v, nullif({_tidy('label')}, '') as label from rows0 where raw is not null),
 rows2 as (select *, lower(regexp_extract(v, '{_NUMBER}', 1)) as digits from rows1),
 rows3 as (select *, split_part(digits, 'e', 1) as m, case when contains(digits, 'e') then 'e' || split_part(digits, 'e', 2) else '' end as ex, nullif(ltrim(v[length(digits) + 1:]), '') as rest from rows2 where digits <> ''),
 rows4 as (select *, length(m) - length(replace(m, ',', '')) as c, length(m) - length(replace(m, '.', '')) as p from rows3),
 rows5 as (select reading_id, bag_id, field, quantity, coalesce(label, rest) as spelling, try_cast(ltrim(case when c = 0 and p <= 1 then m when (c = 1 and p = 0) or (c > 0 and p > 0 and strpos(reverse(m), ',') < strpos(reverse(m), '.')) then replace(replace(m, '.', ''), ',', '.')
   when p > 1 and c = 0 then replace(m, '.', '') else replace(m, ',', '') end, '+') || ex as double) as x from rows4),
 r as (select * from rows5 where x is not null and not isnan(x) and abs(x) < 1e300),
 hits as (select n.bag_id, k.quantity, k.unit, k.factor, length(k.name) as size, k.name from (select distinct bag_id, {_tidy('note')} as note from recordings where note is not null) n join names k
   on case when regexp_matches(k.name, '^\p{{Han}}+$') then contains(n.note, k.name) when length(k.name) = 1 then regexp_matches(n.note, '[=\[] ?' || k.name || '([\];,. ]|$)')
     else regexp_matches(lower(n.note), '(^|[^\p{{L}}\p{{N}}_])' || regexp_replace(regexp_escape(lower(k.name)), 'metres?$', 'metres?') || '($|[^\p{{L}}\p{{N}}_])') end),
 noted as (select bag_id, quantity, arg_max(unit, (size, name)) as unit, arg_max(factor, (size, name)) as factor from hits group by 1, 2),
 named as (select r.*, spelling is null as silent, case when spelling is null then d.unit else k.unit end as unit, case when spelling is null then d.factor else k.factor end as factor, spelling is null and d.unit is null as bare
   from r left join keys k on k.quantity = r.quantity and k.key = {_key('r.spelling')} left join noted d on d.bag_id = r.bag_id and d.quantity = r.quantity),
 usual as (select quantity, avg(ln(abs(x * factor))) as usual from named where not bare and x <> 0 and factor is not null group by 1),
 level as (select bag_id, quantity, avg(ln(abs(x))) as level from named where bare and x <> 0 group by 1, 2),
 p2 as (select distinct n.reading_id, n.field, n.x * case when bare then case when level - usual > ln(1000.0) / 2 then 0.001::double else 1.0::double end else factor end as value,
   case when bare then case when level - usual > ln(1000.0) / 2 then case quantity when 'torque' then 'mN·m' else 'mA' end else case quantity when 'torque' then 'N·m' else 'A' end end else unit end as unit
   from named n left join level l using (bag_id, quantity) left join usual u using (quantity))"""

_P5 = """with c as (select bag_id, coalesce(train_hz,10) hz, coalesce(main_timeline_fps,30) fps from (select *, row_number() over (partition by bag_id order by revision desc) n from bag_config) where n=1),
 g as (select r.bag_id, start_us, end_us, coalesce(fps,30)::bigint fps, (greatest(1, coalesce(fps,30)//coalesce(hz,10)) * 1000000)::bigint per from (select bag_id, max(start_us) start_us, max(end_us) end_us from recordings group by 1) r left join c using (bag_id)),
 m as (select bag_id, topic, timestamp_us t, min(data) lo, max(data) hi from messages where timestamp_us is not null and len(data) > 0 and topic in ('/force6d_left_hand_force_torque','/force6d_right_hand_force_torque','/leju_claw_state','/gripper/state') group by 1, 2, 3),
 n as (select m.*, ((t - start_us) * fps) // per as k from m join g using (bag_id) where t >= start_us and t < end_us),
 a as (select s.bag_id, s.topic, slot, start_us - (-slot * per) // fps - case when (slot * per) % fps <> 0 then -1 else 0 end as at0 from (select distinct bag_id, topic from m) s join g using (bag_id), lateral (select unnest(range(0, (((end_us - start_us) * fps) // per)::bigint)) as slot)),
 x as (select a.*, n.t t1, n.lo v1, n.k k1 from a asof left join n on a.bag_id = n.bag_id and a.topic = n.topic and a.at0 <= n.t),
 y as (select x.*, n.t t0, n.hi v0 from x asof left join n on x.bag_id = n.bag_id and x.topic = n.topic and x.at0 > n.t),
 z as (select bag_id, topic, slot, at0 as "at", case when at0 = t1 then v1 when t1 - t0 <= 500000 and len(v0) = len(v1) then list_transform(range(1, len(v0) + 1), lambda i: v0[i] + (v1[i] - v0[i]) * ((at0 - t0) / (t1 - t0))) end as value, coalesce(k1 = slot, false) as seen from y)
 select bag_id, topic, slot, "at", value, case when seen then 'observed' when value is not null then 'filled' else 'missing' end as status from z"""

ORACLES = {
    "p1_found": """with s as (select distinct bag_id, cast(round(step_start*1000000) as bigint) s, cast(round(step_end*1000000) as bigint) e from steps where step_end>step_start),
 m as (select *, max(e) over (partition by bag_id order by s,e rows between unbounded preceding and 1 preceding) r from s),
 g as (select *, sum(case when r is null or s>r then 1 else 0 end) over (partition by bag_id order by s,e) n from m),
 p as (select bag_id, n, min(s) s, max(e) e from g group by 1,2)
 select bag_id, 'period' as kind, s as start_ppm, e as end_ppm from p union all
 select bag_id, 'gap', e, nx from (select *, lead(s) over (partition by bag_id order by s) nx from p) where nx is not null""",
    "p4_found": """with f as (select distinct bag_id,camera,frame_no,timestamp_us t from camera_frames where timestamp_us is not null),
 m as (select distinct bag_id, timestamp_us t, seq from messages where topic='/force6d_left_hand_force_torque' and timestamp_us is not null and len(data)>0),
 j as (select f.*, m.seq, row_number() over (partition by f.bag_id,camera,frame_no order by abs(m.t-f.t), m.t desc, m.seq desc) n from f join m on f.bag_id=m.bag_id and m.t between f.t-10000 and f.t+10000)
 select bag_id,camera,frame_no,seq from j where n=1""",
    "p5_found": """with c as (select bag_id, coalesce(train_hz,10) hz, coalesce(main_timeline_fps,30) fps from (select *, row_number() over (partition by bag_id order by revision desc) n from bag_config) where n=1),
 r as (select distinct bag_id,start_us,end_us from recordings),
 g as (select r.*, coalesce(fps,30) fps, greatest(1, coalesce(fps,30)//coalesce(hz,10)) j from r left join c using(bag_id)),
 m as (select distinct bag_id, topic, timestamp_us t from messages where timestamp_us is not null and len(data)>0 and topic in ('/force6d_left_hand_force_torque','/force6d_right_hand_force_torque','/leju_claw_state','/gripper/state')),
 s as (select distinct bag_id, topic from m),
 a as (select s.bag_id, s.topic, unnest(range(0, cast(((end_us-start_us)*fps)//(j*1000000) as bigint))) as slot from s join g using(bag_id))
 select a.bag_id,a.topic,a.slot from a anti join (select bag_id,topic,cast(floor((t-start_us)*fps/(j*1000000.0)) as bigint) slot from m join g using (bag_id)) o on a.bag_id=o.bag_id and a.topic=o.topic and a.slot=o.slot""",
    "p6_found": _P6,
    "p2_values": f"{_P2} select reading_id, field, value, unit from p2",
    "p2_found": f"{_P2} select distinct reading_id, field, cast(round(value * 1000) as bigint) as value_milli from p2 where value is not null and unit not in ('N·m', 'A')",
    "p5_series": _P5,
    "p3_outside": """select distinct m.bag_id, topic, seq from messages m join (select bag_id, min(start_us) a, max(end_us) b from recordings group by 1) r using (bag_id)
 where topic is not null and seq is not null and len(data) > 0 and (timestamp_us < a or timestamp_us >= b)""",
    "p3_stuck": """with m as (select bag_id, topic, seq, min(device_sn) as source, min(data) as data from messages where bag_id is not null and topic is not null and seq is not null and timestamp_us is not null and len(data) > 0 group by 1, 2, 3),
 c as (select bag_id, topic, source, seq, unnest(range(1, len(data) + 1)) as i, unnest(data) as x from m), l as (select *, lag(x) over (partition by bag_id, topic, i order by seq) as before from c),
 s as (select source, topic, i, avg((x = before)::int) as repeats from l where isfinite(x) and isfinite(before) group by 1, 2, 3),
 r as (select *, sum(case when x = before then 0 else 1 end) over (partition by bag_id, topic, i order by seq) as run from l), n as (select *, count(*) over (partition by bag_id, topic, i, run) as size from r where x is not null)
 select distinct bag_id, topic, seq from n join s using (source, topic, i) where size >= 20 and repeats < 0.5 and isfinite(x) and topic not in ('/leju_claw_command', '/cmd_pose_world_synced')""",
    "p7_kept": """select distinct file_id, len(json_keys(body))::bigint as fields, 0::bigint as odd from sidecar_files
 where exporter is not null and written_at is not null and json_valid(body) and json_type(body) = 'OBJECT'""",
}
