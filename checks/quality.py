"""Rules, suites, publishing and run status."""

from __future__ import annotations

from pyspark.sql import functions as F

from activity_lake.functions.dates import epoch_micros
from activity_lake.operators.quality import (
    Between, DistinctInSet, InSet, NotNull, Unique, clean, publish, quarantine, reconcile, run_suite, suite_status,
)
from activity_lake.operators.reporting import official_sports, rollup, run_metrics, step_durations
from activity_lake.operators.shaping import merge_hr_sport
from activity_lake.plans.suites import activity_suite, hr_suite, sport_suite
from activity_lake.session import new_path
from activity_lake.sources.tables import write_stage
from checks.registry import check
from checks.views import Views

# position, text, severity, drops rows, reference, column, condition that breaks the rule
HR_RULES = [
    (1, "id is given", "WARNING", True, "last_name", "id", "id is null"),
    (2, "id is unique", "FAILED", False, "last_name", "id",
     "id in (select id from t group by id having count(*) > 1)"),
    (3, "first name is given", "WARNING", False, "id", "first_name", "first_name is null"),
    (4, "last name is given", "FAILED", False, "id", "last_name", "last_name is null"),
    (5, "transport mode is known", "FAILED", False, "id", "transport_mode", "transport_mode = 'Inconnu'"),
    (6, "distance is given", "WARNING", True, "id", "distance_kms", "distance_kms is null"),
    (7, "contract type is known", "WARNING", False, "id", "employement_contract",
     "employement_contract not in ('CDI', 'CDD')"),
    (8, "distance fits the transport mode", "WARNING", True, "id", "margin_kms", "margin_kms < 0"),
    (9, "age is 16 to 80", "WARNING", False, "id", "age", "age not between 16 and 80"),
    (10, "seniority is 0 to 7", "WARNING", False, "id", "seniority_years", "seniority_years not between 0 and 7"),
    (11, "salary is 15000 to 150000", "WARNING", True, "id", "salary", "salary not between 15000 and 150000"),
]
SPORT_RULES = [
    (1, "id is given", "WARNING", True, "id", "id", "id is null"),
    (2, "id is unique", "FAILED", False, "id", "id",
     "id in (select id from t group by id having count(*) > 1)"),
    (3, "sport is an official one", "WARNING", False, "id", "sport_type",
     "sport_type not in (select sport from sports where strava_list = 1)"),
]
ACTIVITY_RULES = [
    (1, "id is given", "WARNING", True, "id", "id", "id is null"),
    (2, "id is unique", "FAILED", False, "id", "id",
     "id in (select id from t group by id having count(*) > 1)"),
    (3, "employee exists", "WARNING", True, "id", "employee_id",
     "employee_id not in (select id from known_employees)"),
    (4, "sport is given", "WARNING", True, "id", "sport", "sport is null"),
    (5, "duration is given", "WARNING", True, "id", "duration_sec", "duration_sec is null"),
    (6, "begin date is given", "WARNING", True, "id", "begin_date", "begin_date is null"),
]


def violations_sql(table: str, rules: list[tuple], dropping: bool = False) -> str:
    parts = [
        f"select {p} as position, '{text}' as rule, cast({ref} as varchar) as reference, "
        f"cast({col} as varchar) as value from t where {broken}"
        for p, text, _, drops, ref, col, broken in rules if drops or not dropping
    ]
    return f"t as (select * from {table}), violations as ({' union all '.join(parts)})"


def report_sql(table: str, rules: list[tuple]) -> str:
    listed = ", ".join(f"({p}, '{text}', '{severity}')" for p, text, severity, *_ in rules)
    return f"""{violations_sql(table, rules)}, rules(position, rule, severity) as (values {listed}),
      report as (select r.position, r.rule, r.severity, count(v.position) as broken,
        case when count(v.position) = 0 then 'SUCCESS' else r.severity end as result
        from rules r left join violations v using (position) group by r.position, r.rule, r.severity)"""


_SAMPLE = """(select position, string_agg(shown, '; ' order by shown) as sample from (
  select position, coalesce(reference, 'null') || ' -> ' || coalesce(value, 'null') as shown from violations
  qualify row_number() over (partition by position order by shown) <= 20) group by position)"""


@check("expect_not_null", "select last_name, business_unit from hr_dirty where first_name is null")
def _(v: Views):
    rule = NotNull("first_name", "first name is given")
    return rule.violating(v.hr_dirty).select("last_name", "business_unit")


@check("expect_unique", """select l_orderkey, l_linenumber, l_partkey from lineitem
  where (l_orderkey, l_linenumber) in (select (l_orderkey, l_linenumber) from lineitem
    group by l_orderkey, l_linenumber having count(*) > 1)""")
def _(v: Views):
    lines = v.table("lineitem").withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    rule = Unique("line", "one row per order line")
    return rule.violating(lines).select("l_orderkey", "l_linenumber", "l_partkey")


@check("expect_in_set", "select id, transport_mode from hr where transport_mode = 'Inconnu'")
def _(v: Views):
    rule = InSet("transport_mode", "mode is known", values=(
        "Transports en commun", "véhicule thermique/électrique", "Marche/running", "Vélo/Trottinette/Autres"))
    return rule.violating(v.hr).select("id", "transport_mode")


@check("expect_distinct_in_set", """select id, sport_type from sport_declared
  where sport_type not in (select sport from sports where strava_list = 1)""")
def _(v: Views):
    rule = DistinctInSet(
        "sport_type", "sport is official", known=official_sports(v.sports), known_column="sport")
    return rule.violating(v.sport_declared)


@check("expect_between", "select id, cast(salary as double) as salary from hr where salary < 15000 or salary > 150000")
def _(v: Views):
    rule = Between("salary", "salary is plausible", low=15000, high=150000)
    return rule.violating(v.hr).select("id", F.col("salary").cast("double").alias("salary"))


@check("quality_report", f"""with {report_sql('hr_dirty', HR_RULES)}
  select report.*, sample from report left join {_SAMPLE} using (position)""")
def _(v: Views):
    return run_suite(v.hr_dirty, hr_suite())


@check("quality_status", f"""with {report_sql('hr_valid', HR_RULES)} select case when bool_or(result = 'FAILED')
  then 'FAILED' when bool_or(result = 'WARNING') then 'WARNING' else 'SUCCESS' end as status from report""")
def _(v: Views):
    return suite_status(run_suite(v.hr_valid, hr_suite(), with_sample=False))


_KEPT = "id is not null and distance_kms is not null and margin_kms >= 0 and salary between 15000 and 150000"


@check("quality_clean", f"select id, last_name, transport_mode, age from hr_valid where {_KEPT}")
def _(v: Views):
    return clean(v.hr_valid, hr_suite()).select("id", "last_name", "transport_mode", "age")


@check("quality_quarantine", f"""with {violations_sql('hr_valid', HR_RULES, dropping=True)}
  select position, rule, reference, value from violations""")
def _(v: Views):
    return quarantine(v.hr_valid, hr_suite())


@check("hr_suite", f"with {report_sql('hr_dirty', HR_RULES)} select * from report")
def _(v: Views):
    return run_suite(v.hr_dirty, hr_suite(), with_sample=False)


@check("sport_suite", f"with {report_sql('sport_declared', SPORT_RULES)} select * from report")
def _(v: Views):
    return run_suite(v.sport_declared, sport_suite(v.sports), with_sample=False)


@check("activity_suite", f"with {report_sql('activities_dirty', ACTIVITY_RULES)} select * from report")
def _(v: Views):
    return run_suite(v.activities_dirty, activity_suite(v.known_employees), with_sample=False)


@check("official_list", "select sport from sports where strava_list = 1")
def _(v: Views):
    return official_sports(v.sports)


@check("merge_reconcile", """with merged as (select h.id, s.sport_type from hr h left join sport_declared s using (id)),
  extra as (select * from sport_declared where id not in (select id from merged)),
  checks(position, rule, severity, found) as (
    select 1, 'every employee kept', 'FAILED', abs((select count(*) from hr) - (select count(*) from merged))
    union all select 2, 'every employee has a sport row', 'WARNING',
      (select count(*) from merged where id not in (select id from sport_declared))
    union all select 3, 'no sport row without employee', 'WARNING', (select count(*) from extra)
    union all select 4, 'no declared sport without employee', 'FAILED', (select count(sport_type) from extra))
  select *, case when found = 0 then 'SUCCESS' else severity end as result from checks""")
def _(v: Views):
    people = v.hr.select("id", "business_unit")
    merged = write_stage(merge_hr_sport(people, v.sport_declared), name="merged")
    return reconcile(people, v.sport_declared, merged)


@check("wap_gate", f"select id, last_name, cast(salary as double) as salary from hr_valid where {_KEPT}")
def _(v: Views):
    path = new_path(v.spark, "published")
    status, _ = publish(v.hr_valid, hr_suite(), path)
    assert status == "WARNING", status
    published = v.spark.read.schema(v.hr_valid.schema).parquet(path)
    return published.select("id", "last_name", F.col("salary").cast("double").alias("salary"))


@check("status_rollup", """select run, case when bool_or(status = 'FAILED') then 'FAILED'
  when bool_or(status = 'WARNING') then 'WARNING' else 'SUCCESS' end as status from run_steps group by run""")
def _(v: Views):
    return rollup(v.run_steps)


@check("run_metrics", """select run, step, epoch_us(min(ts)) as started, epoch_us(max(ts)) as ended,
  epoch_us(max(ts)) - epoch_us(min(ts)) as elapsed_micros, (select count(*) from run_steps) as rows, 4 as columns
  from run_steps group by run, step""")
def _(v: Views):
    spans = step_durations(v.run_steps, ["run", "step"], "ts", "ts")
    shape = run_metrics(v.run_steps).first()
    return spans.withColumns({
        "started": epoch_micros("started"), "ended": epoch_micros("ended"),
        "rows": F.lit(shape["rows"]).cast("long"), "columns": F.lit(shape["columns"]),
    })
