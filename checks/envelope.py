"""Change envelopes, projections and masks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_lake import schemas
from activity_lake.functions.business import ACTIVE_MODES
from activity_lake.functions.dates import activity_date
from activity_lake.operators.cdc import cdc_flatten, cdc_parse, cdc_rows, cdc_upserts
from activity_lake.operators.shaping import conform, split_active, stamp, update_where
from checks.registry import check
from checks.views import Views

_IMAGE = "id, employee_id, sport, epoch_us(begin_date) as begin_date, duration_sec, distance_meters"
_EMPTY = """null::varchar as id, null::varchar as employee_id, null::varchar as sport, null::bigint as begin_date,
  null::int as duration_sec, null::int as distance_meters"""


@check("cdc_parse", """select op, ts_ms, case when op <> 'd' then id end as after_id,
    case when op = 'd' then id end as before_id from activity_events
  union all select null, null, null, null from activities where n % 50 = 0
  union all select null, null, null, null from activities where n % 997 = 0""")
def _(v: Views):
    return cdc_parse(v.cdc_activities, schemas.ACTIVITY_EVENT).select(
        "data.payload.op", "data.payload.ts_ms", F.col("data.payload.after.id").alias("after_id"),
        F.col("data.payload.before.id").alias("before_id"))


@check("cdc_flatten", f"""select {_IMAGE} from activity_events where op <> 'd'
  union all select {_EMPTY} from activities where n % 50 = 0
  union all select {_EMPTY} from activities where n % 50 = 0
  union all select {_EMPTY} from activities where n % 997 = 0""")
def _(v: Views):
    return cdc_flatten(cdc_parse(v.cdc_activities, schemas.ACTIVITY_EVENT))


@check("cdc_drop_deletes", f"select {_IMAGE} from activity_events where op <> 'd'")
def _(v: Views):
    return cdc_upserts(cdc_flatten(cdc_parse(v.cdc_activities, schemas.ACTIVITY_EVENT)))


@check("epoch_to_timestamp", """select id, begin_date,
  strftime(activity_date, '%Y-%m-%d %H:%M:%S') as activity_date from gold""")
def _(v: Views):
    events = cdc_rows(v.cdc_activities, schemas.ACTIVITY_EVENT)
    return events.select(
        "id", "begin_date", activity_date("begin_date").cast("string").alias("activity_date"))


@check("cast_columns", """select id, cast(employee_id as varchar) as employee_id,
  try_cast(distance_text as int) as distance_meters, try_cast(duration_text as int) as duration_sec
  from (select id, cast(employee_id as bigint) as employee_id,
    case when n % 13 = 0 then 'far' else cast(distance_meters as varchar) end as distance_text,
    case when n % 17 = 0 then '' else cast(duration_sec as varchar) end as duration_text from activities)""")
def _(v: Views):
    loose = v.activities.selectExpr(
        "id", "cast(employee_id as bigint) as employee_id",
        "case when n % 13 = 0 then 'far' else cast(distance_meters as string) end as distance_meters",
        "case when n % 17 = 0 then '' else cast(duration_sec as string) end as duration_sec")
    names = ["id", "employee_id", "distance_meters", "duration_sec"]
    return conform(loose, T.StructType([f for f in schemas.ACTIVITY_SHEET if f.name in names]))


@check("rename_columns", """select c_custkey as id, c_name as last_name, c_nationkey as country,
  c_acctbal as balance, c_mktsegment as business_unit from customer""")
def _(v: Views):
    return v.table("customer").toDF("id", "last_name", "country", "balance", "business_unit")


@check("drop_columns", """select id, employee_id, sport, situation, distance_meters, duration_sec from activities""")
def _(v: Views):
    return v.activities.drop("n", "begin_date")


@check("project_columns", """select id, first_name as name, sport_type as sport from employees""")
def _(v: Views):
    return v.employees.select("id", F.col("first_name").alias("name"), F.col("sport_type").alias("sport"))


@check("default_column", "select id, 0.0::double as distance_kms, 'new' as status from employees")
def _(v: Views):
    return v.employees.select("id").withColumns({"distance_kms": F.lit(0.0), "status": F.lit("new")})


@check("masked_update", """select id, transport_mode, case when transport_mode in
  ('Marche/running', 'Vélo/Trottinette/Autres') then cast(distance_kms as double) else 0.0::double end as kms
  from employees""")
def _(v: Views):
    start = v.employees.select("id", "transport_mode", "distance_kms", F.lit(0.0).alias("kms"))
    relevant = F.col("transport_mode").isin(ACTIVE_MODES)
    return update_where(start, relevant, {"kms": F.col("distance_kms").cast("double")}).drop("distance_kms")


@check("filter_in_set", """select id, transport_mode from employees
  where transport_mode in ('Marche/running', 'Vélo/Trottinette/Autres')""")
def _(v: Views):
    return v.employees.filter(F.col("transport_mode").isin(ACTIVE_MODES)).select("id", "transport_mode")


@check("split_by_null", """select id, sport_type, case when sport_type is null then 'inactive' else 'active' end
  as pool from employees""")
def _(v: Views):
    active, inactive = split_active(v.employees.select("id", "sport_type"))
    return active.withColumn("pool", F.lit("active")).unionByName(inactive.withColumn("pool", F.lit("inactive")))


@check("ingest_stamp", "select id, true as stamped from employees")
def _(v: Views):
    return stamp(v.employees.select("id")).select("id", F.col("processed_at").isNotNull().alias("stamped"))
