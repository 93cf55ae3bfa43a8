"""Whole jobs over the adapter views."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from activity_lake import schemas
from activity_lake.functions.dates import epoch_micros
from activity_lake.functions.privacy import decrypted, encrypt
from activity_lake.operators.comments import INSTRUCTIONS
from activity_lake.operators.quality import publish
from activity_lake.operators.reporting import alerts, rollup
from activity_lake.operators.versions import BucketTable
from activity_lake.plans.activities import comment_actions, ingest_activities
from activity_lake.plans.hr import ingest_hr
from activity_lake.plans.runs import RunLog, run_table
from activity_lake.plans.suites import hr_suite
from activity_lake.session import new_path
from activity_lake.sources.tables import path_missing
from checks.columns import HOME_DISTANCE
from checks.joins import DIFF
from checks.quality import HR_RULES, violations_sql
from checks.registry import check
from checks.views import AS_OF, COMPANY, FINGERPRINT, KEY, REPAIRED, Views, limit_of

NAMES = ["first_name", "last_name"]


@check("publish_violations", f"""with {violations_sql('hr_dirty', HR_RULES)}
  select position, rule, reference, value from violations""")
def _(v: Views):
    found = new_path(v.spark, "violations")
    publish(v.hr_dirty, hr_suite(), new_path(v.spark, "published"), violations_path=found)
    return v.spark.read.parquet(found).select("position", "rule", "reference", "value")


# Which batches and ids the writer leaves out, as arithmetic that SQL can follow: the number in an id.
_NUMBER = "cast(substr(id, 2) as bigint)"


@check("comment_actions", f"""with {DIFF}, fresh as (select id, situation, {_NUMBER} as n from diff where _merge = 'left_only')
  select id, case when n % 7 <> 0 then 'Well done, ' || id when situation is null or situation = ''
    then 'Bypass IA : No comment' else 'Bypass IA : ' || situation end as comment from fresh""")
def _(v: Views):
    def writer(prompt: str) -> str:
        asked = [r["id"] for r in json.loads(prompt[len(INSTRUCTIONS):])]
        told = [{"id": i, "comment": f"Well done, {i}"} for i in asked if int(i[1:]) % 7]
        return json.dumps({"results": told})

    def broken(prompt: str) -> str:
        raise RuntimeError("not reachable")

    written = comment_actions(v.actions, encrypt(v.employees, NAMES, KEY), KEY, {"broken": broken, "w": writer})
    fresh = written.filter("_merge = 'left_only'")
    return fresh.select("id", decrypted("comment", KEY).alias("comment"))


_HR_RUN = f"""measured as ({HOME_DISTANCE}), placed as (select h.* exclude (distance_kms, margin_kms), {REPAIRED} as mode,
    m.distance_kms from hr h join (select id, case when transport_mode = 'Inconnu' then null else distance_kms end as distance_kms
    from measured) m using (id)),
  audited as (select *, round({limit_of('mode')} - distance_kms, 2) as margin from placed),
  clean as (select * from audited where distance_kms is not null and margin >= 0 and salary between 15000 and 150000)"""


def _hr_sheet(v: Views):
    return v.employees.withColumn("transport_mode", F.expr(REPAIRED)).select(*schemas.HR_SHEET.fieldNames())


@check("ingest_hr", f"""with {_HR_RUN} select c.id, c.business_unit, c.age, c.seniority_years, c.vacation_days,
  c.employement_contract, cast(c.salary as double) as salary, mode as transport_mode,
  cast(cast(distance_kms as decimal(10,1)) as double) as distance_kms, cast(cast(margin as decimal(10,1)) as double) as margin_kms,
  s.sport_type from clean c left join sport_declared s using (id)""")
def _(v: Views):
    # Declarations of people who are no employees count as none; the next entry has them.
    sport = v.sport_declared.withColumn("sport_type", F.when(~F.col("id").startswith("X"), F.col("sport_type")))
    target = new_path(v.spark, "employees")
    for load in (None, "WARNING"):  # the second run finds everybody there
        statuses = ingest_hr(_hr_sheet(v), sport, v.geo, v.sports, COMPANY, AS_OF, KEY, target)
        assert statuses["merge"] == "WARNING" and statuses.get("load") == load, statuses
    loaded = v.spark.read.parquet(target)
    doubles = [F.col(c).cast("double").alias(c) for c in ("salary", "distance_kms", "margin_kms")]
    return loaded.select(
        "id", "business_unit", "age", "seniority_years", "vacation_days", "employement_contract", "transport_mode",
        "sport_type", *doubles)


@check("ingest_hr_orphans", """select id, sport_type, 'FAILED' as merge from sport_declared
  where id like 'X%' and sport_type is not null""")
def _(v: Views):
    target, account = new_path(v.spark, "employees"), new_path(v.spark, "account")
    statuses = ingest_hr(
        _hr_sheet(v), v.sport_declared, v.geo, v.sports, COMPANY, AS_OF, KEY, target, account=account)
    assert "load" not in statuses and path_missing(v.spark, target), statuses
    return v.spark.read.parquet(f"{account}/orphans").select("id", "sport_type", F.lit(statuses["merge"]).alias("merge"))


@check("ingest_activities", f"""select id, employee_id, sport, situation, distance_meters,
  epoch_us(begin_date) as begin_micros, duration_sec, {FINGERPRINT} as fingerprint from activities
  where employee_id in (select id from known_employees)""")
def _(v: Views):
    people = encrypt(v.known_employees, NAMES, KEY)
    table = BucketTable.create(v.stored, new_path(v.spark, "activities"), buckets=16)
    statuses = ingest_activities(v.activities, table, people, KEY)
    assert statuses["continue"] == "YES" and statuses["scan"] == "WARNING" and table.version() == 1, statuses
    assert ingest_activities(v.activities, table, people, KEY)["continue"] == "NO" and table.version() == 1
    return table.read().withColumn("begin_micros", epoch_micros("begin_date")).select(
        "id", "employee_id", "sport", "situation", "distance_meters", "begin_micros", "duration_sec", "fingerprint")


@check("run_alerts", """with moved as (select count(*) as n from activities), people as (select count(*) as n from hr),
  declared as (select count(*) as n from sport_declared)
  select 'ingest_activities' as flow, 'validate' as step, 'WARNING' as status, n as rows, 'WARNING' as run_status from moved
  union all select 'ingest_hr', 'hr', 'WARNING', n, 'FAILED' from people
  union all select 'ingest_hr', 'sport', 'WARNING', n, 'FAILED' from declared""")
def _(v: Views):
    path = new_path(v.spark, "runs")
    ingest_hr(_hr_sheet(v), v.sport_declared, v.geo, v.sports, COMPANY, AS_OF, KEY, new_path(v.spark, "employees"),
              log=RunLog(v.spark, path, "ingest_hr", "hr 1"))
    ingest_activities(
        v.activities, BucketTable.create(v.stored, new_path(v.spark, "activities"), buckets=16),
        encrypt(v.known_employees, NAMES, KEY), KEY, log=RunLog(v.spark, path, "ingest_activities", "activities 1"))
    steps = run_table(v.spark, path)
    told = alerts(rollup(steps)).withColumnRenamed("status", "run_status")
    return steps.filter("step in ('hr', 'sport', 'validate')").join(told, "run").select(
        "flow", "step", "status", "rows", "run_status")
