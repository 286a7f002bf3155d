"""Queries of the general problems (2 and 5), with oracles that read the notations family by family."""

from __future__ import annotations

from ..operators.intervals import continuous_periods
from ..operators.timestamps import normalise_all
from ..sources.tables import load


def p2_found(spark, sf_dir):
    return continuous_periods(load(spark, sf_dir, "recordings"), load(spark, sf_dir, "sites"))


def p5_found(spark, sf_dir):
    return normalise_all(load(spark, sf_dir, "studies"), load(spark, sf_dir, "recordings"), load(spark, sf_dir, "sites"))


_FAMILIES = {
    "a": r"^(\d{4})[-/](\d{2})[-/](\d{2})(?:[T ](.*))?$|['y','m','d','r']",
    "b": r"^(\d{4})(\d{2})(\d{2})(?:T(.*))?$|['y','m','d','r']",
    "c": r"^(\d{2})\.(\d{2})\.(\d{4}|\d{2})(?: (.*))?$|['d','m','y','r']",
    "e": r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4}|\d{2})(?: (.*))?$|['p','q','y','r']",
    "f": r"^(?:[A-Z][a-z]{2}, )?(\d{1,2})[- ]([A-Za-z]{3,9})[- ](\d{4}|\d{2})(?: (.*))?$|['d','n','y','r']",
    "g": r"^([A-Za-z]{3,9}) (\d{1,2}), (\d{4})(?: (.*))?$|['n','d','y','r']",
}
_SPLIT = {k: v.rsplit("$|", 1) for k, v in _FAMILIES.items()}
_GROUPS = ", ".join(f"regexp_extract(t, '{p}$', {names}) as {k}" for k, (p, names) in _SPLIT.items())
_IS = {k: f"regexp_matches(t, '{p}$')" for k, (p, _) in _SPLIT.items()}
_MONTH = "cast((strpos('janfebmaraprmayjunjulaugsepoctnovdec', lower(left({0}.n, 3))) + 2) / 3 as integer)"
_PICK = lambda field, parts: "case " + " ".join(f"when {_IS[k]} then {v}" for k, v in parts.items()) + f" end as {field}"
_ZONES = "map {'Z': 0, 'UTC': 0, 'GMT': 0, 'BST': 60, 'CET': 60, 'CEST': 120, 'IST': 330, 'EST': -300, 'EDT': -240, 'CST': -360, 'CDT': -300, 'MST': -420, 'MDT': -360, 'PST': -480, 'PDT': -420}"
_TIME = r"^(\d{1,2})[:.]?(\d{2})(?:[:.]?(\d{2}))?(?:\.\d+)?\s*([AP]M)?\s*(.*)$"


def _seconds(s: str) -> str:
    hour = f"case when {s}.ap = '' then try_cast({s}.h as integer) else try_cast({s}.h as integer) % 12 + case when {s}.ap = 'PM' then 12 else 0 end end"
    return f"(({hour}) * 3600 + try_cast({s}.i as integer) * 60 + coalesce(try_cast({s}.s as integer), 0))"


_INSTANTS = f"""raw as (
  select 'studies' as source_table, study_row_id as row_id, 'eeg_start_date' as field, eeg_start_date as v, eeg_start_time as c, site_code from studies
  union all select 'studies', study_row_id, 'patient_dob', patient_dob, null, site_code from studies
  union all select 'recordings', recording_id, 'startdate', startdate, starttime, site_code from recordings),
groups as (select *, {_GROUPS} from (select raw.*, trim(v) as t, zone_name, date_order from raw left join sites using (site_code) where v is not null)),
parts as (select *, {_PICK("y", {k: f"{k}.y" for k in "abcefg"})},
  {_PICK("m", {"a": "try_cast(a.m as integer)", "b": "try_cast(b.m as integer)", "c": "try_cast(c_.m as integer)", "e": "try_cast(case when date_order = 'DMY' then e.q else e.p end as integer)", "f": _MONTH.format("f"), "g": _MONTH.format("g")})},
  {_PICK("d", {"a": "a.d", "b": "b.d", "c": "c_.d", "e": "case when date_order = 'DMY' then e.p else e.q end", "f": "f.d", "g": "g.d"})},
  {_PICK("r", {k: f"{k}.r" for k in "abcefg"})}
  from groups),
dated as (select *, try_cast(concat(case when length(y) = 2 then cast(case when cast(y as integer) <= 25 then 2000 else 1900 end + cast(y as integer) as varchar) else y end, '-', lpad(cast(m as varchar), 2, '0'), '-', lpad(d, 2, '0')) as date) as day,
  regexp_extract(r, '{_TIME}', ['h','i','s','ap','z']) as o, regexp_extract(c, '{_TIME}', ['h','i','s','ap','z']) as k,
  case when regexp_matches(t, '^\\d{{10}}$') then cast(t as bigint) when regexp_matches(t, '^\\d{{13}}$') then cast(t as bigint) // 1000 end as unix from parts),
timed as (select *, case when r <> '' then {_seconds("o")} end as own, case when trim(c) <> '' then {_seconds("k")} end as beside,
  case when r <> '' and regexp_matches(o.z, '^[+-]') then (case when o.z[1] = '-' then -1 else 1 end) * (cast(substr(replace(o.z, ':', ''), 2, 2) as integer) * 60 + cast(substr(replace(o.z, ':', ''), 4, 2) as integer))
       when r <> '' and o.z <> '' then {_ZONES}[o.z] end as zone_minutes from dated),
chosen as (select *, day + to_seconds(coalesce(case when own = 0 and zone_minutes is null and trim(c) <> '' then null else own end, beside)) as local from timed),
placed as (select *, epoch(timezone(zone_name, local)) as later from chosen),
instants as (select source_table, row_id, field, day, cast(case when unix is not null then unix when zone_minutes is not null then epoch(local) - zone_minutes * 60
  when timezone(zone_name, to_timestamp(later - 3600)) = local then later - 3600 else later end as bigint) as sec_utc, unix from placed)""".replace("as c, regexp", "as c_, regexp").replace("then c.y", "then c_.y").replace("then c.r", "then c_.r")

ORACLES: dict[str, str] = {
    "p5_found": f"""with {_INSTANTS} select source_table, row_id, field, case when field = 'patient_dob' then cast(coalesce(day, cast(to_timestamp(unix) as date)) as varchar)
      when sec_utc is not null then strftime(make_timestamp(sec_utc * 1000000), '%Y-%m-%dT%H:%M:%SZ') else cast(day as varchar) end as normal_value from instants where day is not null or unix is not null""",
    "p2_found": f"""with {_INSTANTS}, spans as (select folder_name, sec_utc as s, sec_utc + cast(ceil(duration_sec) as bigint) as e from instants join recordings on row_id = recording_id where source_table = 'recordings' and sec_utc is not null and duration_sec > 0),
      reach as (select *, max(e) over (partition by folder_name order by s, e rows between unbounded preceding and 1 preceding) as before from spans),
      marked as (select *, sum(case when before is null or s > before then 1 else 0 end) over (partition by folder_name order by s, e) as island from reach),
      periods as (select folder_name, island, min(s) as s, max(e) as e from marked group by 1, 2)
      select folder_name, 'period' as kind, s as start_epoch, e as end_epoch from periods
      union all select folder_name, 'gap', p, s from (select *, lag(e) over (partition by folder_name order by s) as p from periods) where p is not null""",
}
QUERIES = {"p2_found": p2_found, "p5_found": p5_found}
