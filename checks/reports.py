"""Aggregations, order, limits and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from activity_lake.functions.business import with_bonus
from activity_lake.functions.dates import activity_date
from activity_lake.functions.dates import social_year as year_of
from activity_lake.operators.cdc import latest_state
from activity_lake.operators.comments import default_comments
from activity_lake.operators.reporting import bonus_what_if, employee_sheet, social_year_stats, token_report
from activity_lake.operators.shaping import (
    changed_ids, dedupe, head, share, sort_by_indicator, union_all, with_batch,
)
from activity_lake.sources.tables import token_total
from checks.joins import DIFF
from checks.registry import check
from checks.views import Views, eligible, social_year

_GOLD_NOW = f"""now as (select *, {social_year('begin_date')} as social_year
  from (select * from activity_events where op <> 'd' qualify row_number() over (partition by id order by ts_ms desc, lsn desc) = 1))"""


@check("count_rows", "select l_returnflag, count(*) as rows from lineitem group by l_returnflag")
def _(v: Views):
    return v.table("lineitem").groupBy("l_returnflag").agg(F.count("*").alias("rows"))


@check("count_non_null", "select business_unit, count(sport_type) as declared from employees group by business_unit")
def _(v: Views):
    return v.employees.groupBy("business_unit").agg(F.count("sport_type").alias("declared"))


@check("distinct_keep_first", """select p_name, p_partkey, p_brand from part
  qualify row_number() over (partition by p_name order by p_partkey) = 1""")
def _(v: Views):
    return dedupe(v.table("part").select("p_name", "p_partkey", "p_brand"), "p_name", ["p_partkey"])


@check("distinct_ids", f"""with {DIFF} select id, fingerprint, _merge from diff
  where id in (select id from diff group by id having count(*) > 1)""")
def _(v: Views):
    diff = v.actions.select("id", "fingerprint", "_merge")
    return diff.join(changed_ids(diff), "id", "left_semi")


@check("social_year_stats", f"""with {_GOLD_NOW} select employee_id, social_year, count(*) as activities,
  cast(sum(distance_meters) as bigint) as distance_meters, cast(sum(duration_sec) as bigint) as duration_sec
  from now group by employee_id, social_year""")
def _(v: Views):
    current = latest_state(v.activity_events.filter("op <> 'd'"))
    return social_year_stats(current.withColumn("social_year", year_of(activity_date("begin_date"))))


RATES = ["0.03", "0.05", "0.075", "0.1"]


@check("bonus_what_if", f"""select cast(rate as double) as rate, count(*) as employees,
  cast(sum(salary) * rate as double) as total_bonus from hr cross join (values {', '.join(
      f'({r}::decimal(6,4))' for r in RATES)}) r(rate) where {eligible()} group by rate""")
def _(v: Views):
    return bonus_what_if(with_bonus(v.hr), RATES)


@check("employee_sheet", f"""with {_GOLD_NOW},
  totals as (select employee_id, count(*) as activities, count(distinct social_year) as social_years,
    cast(sum(distance_meters) as bigint) as distance_meters, cast(sum(duration_sec) as bigint) as duration_sec
    from now group by employee_id),
  last as (select employee_id, comment as last_comment from stored
    qualify row_number() over (partition by employee_id order by begin_date desc, id desc) = 1)
  select h.id as employee_id, h.last_name, {eligible()} as is_eligible_bonus,
    case when {eligible()} then cast(salary * 0.05 as double) else 0.0::double end as bonus_amount,
    coalesce(activities, 0) as activities, coalesce(social_years, 0) as social_years,
    coalesce(distance_meters, 0) as distance_meters, coalesce(duration_sec, 0) as duration_sec, last_comment
  from hr h left join totals t on h.id = t.employee_id left join last l on h.id = l.employee_id""")
def _(v: Views):
    people = with_bonus(v.hr).select("id", "last_name", "is_eligible_bonus", "bonus_amount")
    current = latest_state(v.activity_events.filter("op <> 'd'"))
    gold = current.withColumn("social_year", year_of(activity_date("begin_date")))
    comments = v.stored.select("employee_id", "begin_date", "id", "comment")
    return employee_sheet(people, gold, comments)


@check("token_report", """select session_id, min(timestamp) as session_start, max(timestamp) as session_end,
  count(*) filter (operation = 'vectorization') as vectorizations,
  cast(coalesce(sum(chunks) filter (operation = 'vectorization'), 0) as bigint) as chunks,
  cast(coalesce(sum(tokens) filter (operation = 'vectorization'), 0) as bigint) as vector_tokens,
  count(*) filter (operation in ('search', 'chat')) as searches,
  cast(coalesce(sum(query_tokens + context_tokens + llm_tokens) filter (operation in ('search', 'chat')), 0) as bigint)
    as search_tokens,
  coalesce(cast(sum(tokens) filter (operation = 'vectorization') as double)
    / nullif(sum(chunks) filter (operation = 'vectorization'), 0), 0) as avg_tokens_per_chunk,
  coalesce(cast(sum(query_tokens + context_tokens + llm_tokens) filter (operation in ('search', 'chat')) as double)
    / nullif(count_if(operation in ('search', 'chat')), 0), 0) as avg_tokens_per_search,
  cast(coalesce(sum(tokens) filter (operation = 'vectorization'), 0)
    + coalesce(sum(query_tokens + context_tokens + llm_tokens) filter (operation in ('search', 'chat')), 0) as bigint)
    as total_tokens from token_log group by session_id""")
def _(v: Views):
    return token_report(v.token_log.withColumn("total_tokens", token_total()))


@check("token_total", """select session_id, timestamp, query_tokens + context_tokens + llm_tokens as total_tokens
  from token_log""")
def _(v: Views):
    return v.token_log.select("session_id", "timestamp", token_total().alias("total_tokens"))


@check("weights_normalise", """select id, business_unit, cast(vacation_days as double)
  / sum(vacation_days) over (partition by business_unit) as share from employees""")
def _(v: Views):
    return share(v.employees.select("id", "business_unit", "vacation_days"), "business_unit", "vacation_days") \
        .drop("vacation_days")


@check("sort_by_id", "select id, sport from activities order by id")
def _(v: Views):
    return v.activities.select("id", "sport").orderBy("id")


@check("sort_by_indicator", f"with {DIFF} select id, _merge from diff")
def _(v: Views):
    return sort_by_indicator(v.diff).select("id", "_merge")


@check("limit_rows", "select id, last_name from employees order by id limit 5")
def _(v: Views):
    return head(v.employees.select("id", "last_name"), "id", 5)


@check("batch_number", """select id, sport,
  (row_number() over (order by id) - 1) // 100 as batch from activities""")
def _(v: Views):
    return with_batch(v.activities.select("id", "sport"), order=("id",))


@check("append_batches", """select id, 'Bypass IA : ' || coalesce(nullif(situation, ''), 'No comment') as comment
  from activities""")
def _(v: Views):
    slices = 5
    part = F.pmod(F.xxhash64("id"), F.lit(slices))
    return union_all(*[default_comments(v.activities.filter(part == k)) for k in range(slices)])
