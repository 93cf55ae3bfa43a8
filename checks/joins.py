"""Joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from activity_lake.functions.business import max_distance
from activity_lake.operators.comments import default_comments
from activity_lake.operators.diff import change_audit
from activity_lake.operators.shaping import (
    attach_comments, enrich_names, exists_in, merge_hr_sport, merge_indicator, missing, normalize_sport, orphans,
)
from activity_lake.session import new_path
from activity_lake.sources.change_log import cdc_source
from activity_lake.streaming.gold import activities_gold, enrich_stream, start_gold
from checks.registry import check
from checks.scans import finish, topic
from checks.views import Views, limit_of, normalized

# Differing images, by comparing both sides directly.
DIFF = """images as (
    select i.*, null as comment, 'left_only' as _merge from incoming i
      where not exists (select 1 from stored s where s.id = i.id and s.fingerprint = i.fingerprint)
    union all by name
    select s.*, 'right_only' as _merge from stored s
      where not exists (select 1 from incoming i where s.id = i.id and s.fingerprint = i.fingerprint)),
  diff as (select *, case when count(*) over (partition by id) > 1 then 'modified'
      when _merge = 'right_only' then 'deleted' else 'new' end as status from images)"""


@check("left_merge", """select h.id, h.business_unit, s.sport_type as sport_type
  from employees h left join sport_declared s on h.id = s.id""")
def _(v: Views):
    return merge_hr_sport(v.employees.select("id", "business_unit"), v.sport_declared)


@check("merge_indicator", """select coalesce(i.id, s.id) as id, coalesce(i.fingerprint, s.fingerprint) as fingerprint,
  case when i.id is null then s.duration_sec else i.duration_sec end as duration_sec, s.comment,
  case when i.id is null then 'right_only' when s.id is null then 'left_only' else 'both' end as _merge
  from incoming i full join stored s on i.id = s.id and i.fingerprint = s.fingerprint""")
def _(v: Views):
    return merge_indicator(
        v.incoming.select("id", "fingerprint", "duration_sec"),
        v.stored.select("id", "fingerprint", "duration_sec", "comment"), ["id", "fingerprint"])


@check("anti_left", """select id, sport_type from sport_declared where id not in (select id from employees)""")
def _(v: Views):
    return orphans(v.sport_declared, v.employees, "id")


@check("anti_right", "select id, business_unit from employees where id not in (select id from sport_declared)")
def _(v: Views):
    return missing(v.sport_declared, v.employees.select("id", "business_unit"), "id")


@check("semi_exists", """select id, employee_id from activities
  where employee_id in (select id from known_employees)""")
def _(v: Views):
    return exists_in(v.activities.select("id", "employee_id"), v.known_employees, "employee_id")


@check("enrich_left", """select a.id, a.employee_id, e.first_name, e.last_name
  from activities a left join known_employees e on a.employee_id = e.id""")
def _(v: Views):
    return enrich_names(v.activities.select("id", "employee_id"), v.known_employees)


@check("carry_over_left", f"""with {DIFF} select id, _merge, status, case when _merge = 'left_only'
  then 'Bypass IA : ' || coalesce(nullif(situation, ''), 'No comment') else comment end as comment from diff""")
def _(v: Views):
    actions = v.actions
    written = default_comments(actions.filter("_merge = 'left_only'"))
    return attach_comments(actions, written).select("id", "_merge", "status", "comment")


@check("lookup_limit", f"select id, transport_mode, {limit_of('transport_mode')} as max_kms from employees")
def _(v: Views):
    return v.employees.select("id", "transport_mode", max_distance("transport_mode").alias("max_kms"))


@check("lookup_alias", f"""with listed as (select position, sport, unnest(string_split(alias, ',')) as alias from sports),
  aliases as (select trim(alias) as k, arg_max(sport, position) as sport from listed group by 1),
  names as (select {normalized('sport')} as k, arg_min(sport, position) as sport from sports group by 1)
  select r.position, r.sport_type, coalesce(a.sport, n.sport) as official from raw_sports r
  left join aliases a on r.sport_type <> '' and a.k = {normalized('r.sport_type')}
  left join names n on r.sport_type <> '' and n.k = {normalized('r.sport_type')}""")
def _(v: Views):
    return normalize_sport(v.raw_sports, v.sports)


AUDITED = ["id", "employee_id", "sport", "distance_meters", "duration_sec", "comment"]


def _record(alias: str) -> str:
    return " || ', ' || ".join(f"'{c}=' || coalesce(cast({alias}.{c} as varchar), 'null')" for c in AUDITED)


@check("audit_images", f"""with {DIFF} select o.id, o.status, {_record('o')} as old_values,
  case when n.id is not null then {_record('n')} end as new_values
  from diff o left join diff n on n.id = o.id and n._merge = 'left_only'
  where o._merge = 'right_only' and o.status in ('modified', 'deleted')""")
def _(v: Views):
    return change_audit(v.actions, AUDITED)


@check("stream_static_join", """select g.id, g.social_year, e.business_unit
  from gold g left join known_employees e on g.employee_id = e.id""")
def _(v: Views):
    people = v.known_employees.select(F.col("id").alias("employee_id"), "business_unit")
    stream = activities_gold(cdc_source(v.spark, topic(v, v.cdc_activities)))
    path, checkpoint = new_path(v.spark, "joined"), new_path(v.spark, "checkpoint")
    finish(start_gold(enrich_stream(stream, people, "employee_id"), path, checkpoint, once=True))
    return v.spark.read.parquet(path).select("id", "social_year", "business_unit")
