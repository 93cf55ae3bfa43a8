"""Streaming jobs, notifications and scored batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from activity_lake import schemas
from activity_lake.functions import privacy
from activity_lake.functions.text import parse_answer
from activity_lake.functions.dates import epoch_micros
from activity_lake.operators.comments import INSTRUCTIONS, build_prompts, score_batches, score_once
from activity_lake.operators.reporting import alerts, rollup
from activity_lake.operators.versions import BucketTable
from activity_lake.session import new_path
from activity_lake.sources.change_log import cdc_source
from activity_lake.sources.tables import write_stage
from activity_lake.streaming.gold import activities_gold, employees_gold, enriched, start_enriched, start_gold
from activity_lake.streaming.outbox import alert_messages, notifications, route, start_outbox
from activity_lake.streaming.state import compact, current_state, start_upsert
from activity_lake.streaming.totals import compact_totals, current_totals, start_totals
from checks.registry import check
from checks.scans import GOLD_COLUMNS, finish, topic
from checks.views import KEY, Views, eligible, social_year


START_MS = 1_700_000_000_000


def run_gold(v: Views, gold, **options):
    """Run a gold stream over what is there and read the table back."""
    path, checkpoint = new_path(v.spark, "gold"), new_path(v.spark, "checkpoint")
    finish(start_gold(gold, path, checkpoint, once=True, **options))
    return v.spark.read.parquet(path)


@check("stream_employees_gold", f"""select id, last_name, first_name, age, business_unit,
  cast(salary as double) as salary, cast(margin_kms as double) as margin_kms, {eligible()} as is_eligible_bonus,
  case when {eligible()} then cast(salary * 0.05 as double) else 0.0::double end as bonus_amount
  from employee_events where op <> 'd'""")
def _(v: Views):
    gold = run_gold(v, employees_gold(cdc_source(v.spark, topic(v, v.cdc_employees)), KEY))
    return gold.select(
        "id", "last_name", "first_name", "age", "business_unit", F.col("salary").cast("double").alias("salary"),
        F.col("margin_kms").cast("double").alias("margin_kms"), "is_eligible_bonus", "bonus_amount")


@check("stream_activities_gold", f"select {', '.join(GOLD_COLUMNS)} from gold")
def _(v: Views):
    gold = run_gold(v, activities_gold(cdc_source(v.spark, topic(v, v.cdc_activities))))
    return gold.select(*GOLD_COLUMNS)


def sealed_messages(v: Views):
    """The activity messages with an encrypted comment."""
    image = F.struct("id", privacy.encrypted("situation", KEY).alias("comment"))
    return v.activities.select(
        F.to_json(F.struct(F.struct(image.alias("after")).alias("payload"))).alias("value"))


_TEXTS = """select id, '{target}' as target, trim(replace(situation, '"', '''')) as text from activities
  where trim(situation) <> ''"""


@check("stream_notifications", _TEXTS.format(target="SLACK"))
def _(v: Views):
    path, checkpoint = new_path(v.spark, "outbox"), new_path(v.spark, "checkpoint")
    source = cdc_source(v.spark, topic(v, sealed_messages(v)), files_per_trigger=4)
    finish(start_outbox(source, KEY, "SLACK", path, checkpoint, once=True))
    return v.spark.read.parquet(path).select("id", "target", "text")


@check("route_notifications", f"""select *, case target when 'SLACK' then 'send' when 'LOG' then 'log'
  else 'ignore' end as route from (select id, text, case when employee_id < '2' then 'SLACK'
    when employee_id < '5' then 'LOG' else 'NONE' end as target
    from ({_TEXTS.format(target='')}) join (select id, employee_id from activities) using (id))""")
def _(v: Views):
    people = v.activities.select("id", "employee_id")
    messages = notifications(sealed_messages(v), KEY, "NONE").join(people, "id")
    target = F.when(F.col("employee_id") < "2", "SLACK").when(F.col("employee_id") < "5", "LOG").otherwise("NONE")
    return route(messages.select("id", "text", target.alias("target")))


@check("stream_upsert", """select id, employee_id, sport, duration_sec, distance_meters, epoch_us(begin_date) as begin_date
  from (select * from activity_events qualify row_number() over (partition by id order by ts_ms desc, lsn desc) = 1)
  where op <> 'd'""")
def _(v: Views):
    path, checkpoint, row = new_path(v.spark, "state"), new_path(v.spark, "checkpoint"), schemas.ACTIVITY_EVENT
    source = cdc_source(v.spark, topic(v, v.cdc_activities), files_per_trigger=8)
    finish(start_upsert(source, row, path, checkpoint, once=True))
    compact(v.spark, path, row)
    return current_state(v.spark, path, row)


def _logged(v: Views):
    """Changes with the whole old row: some activities move by a year and grow longer, some are deleted, in any order."""
    first, moved = "n is not null", "n % 20 = 0"
    micros = epoch_micros("begin_date")
    later = epoch_micros(F.expr("begin_date + make_ym_interval(case when n % 40 = 0 then 1 else 0 end, 0)"))

    def image(begin, added):
        return F.struct("id", "employee_id", "sport", begin.alias("begin_date"),
                        (F.col("duration_sec") + added).alias("duration_sec"), "distance_meters")

    old, new, none = image(micros, 0), image(later, 30), F.lit(None)
    last = F.when(F.expr(moved), new).otherwise(old)
    parts = [
        v.activities.filter(condition).select("n", F.to_json(F.struct(F.struct(
            F.lit(op).alias("op"), (F.col("n") * 10 + START_MS).alias("ts_ms"),
            F.struct((F.col("n") * 10 + place).alias("lsn")).alias("source"), before.alias("before"), after.alias("after")
        ).alias("payload"))).alias("value"))
        for place, (op, condition, before, after) in enumerate([
            ("c", first, none, old), ("u", moved, old, new), ("d", "n % 50 = 0", last, none)])]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check("stream_social_year_stats", f"""with alive as (select *, case when n % 20 = 0 then duration_sec + 30 else duration_sec end
    as duration, case when n % 40 = 0 then begin_date + interval 1 year else begin_date end as started
    from activities where n % 50 <> 0)
  select employee_id, {social_year('started')} as social_year, count(*) as activities,
  cast(sum(distance_meters) as bigint) as distance_meters, cast(sum(duration) as bigint) as duration_sec from alive group by all""")
def _(v: Views):
    path, checkpoint = new_path(v.spark, "totals"), new_path(v.spark, "checkpoint")
    messages = _logged(v)
    # Some come a second time.
    sent = topic(v, messages.unionByName(messages.filter("n % 11 = 0")))
    source = cdc_source(v.spark, sent, files_per_trigger=8)
    finish(start_totals(source, path, checkpoint, once=True, within="3650 days"))
    compact_totals(v.spark, path)
    return current_totals(v.spark, path)


@check("stream_notifications_once", _TEXTS.format(target="SLACK"))
def _(v: Views):
    path, checkpoint = new_path(v.spark, "outbox"), new_path(v.spark, "checkpoint")
    image = F.struct("id", privacy.encrypted("situation", KEY).alias("comment"))
    place = F.struct(F.col("n").alias("lsn"))
    messages = v.activities.select("n", F.to_json(F.struct(F.struct(
        F.lit("c").alias("op"), (F.col("n") * 1000 + START_MS).alias("ts_ms"), place.alias("source"), image.alias("after")
    ).alias("payload"))).alias("value"))
    sent = topic(v, messages.unionByName(messages.filter("n % 3 = 0")))
    source = cdc_source(v.spark, sent, files_per_trigger=4)
    finish(start_outbox(source, KEY, "SLACK", path, checkpoint, once=True, within="3650 days"))
    return v.spark.read.parquet(path).select("id", "target", "text")


@check("stream_static_join_fresh", """select g.id, g.social_year, e.business_unit from gold g left join employees e on g.employee_id = e.id""")
def _(v: Views):
    people = v.employees.select(F.col("id").alias("employee_id"), "business_unit").withColumn("fingerprint", F.md5("business_unit"))
    known = v.known_employees.select(F.col("id").alias("employee_id"))
    table = BucketTable.create(people.join(known, "employee_id", "left_semi"), new_path(v.spark, "people"), key="employee_id", buckets=16)
    path, checkpoint = new_path(v.spark, "joined"), new_path(v.spark, "checkpoint")

    def newest():
        # The others are added when the stream has started.
        if table.version() == 0:
            table.apply(write_stage(table.diff(people), name="hired"))
        return table.read().select("employee_id", "business_unit")

    stream = activities_gold(cdc_source(v.spark, topic(v, v.cdc_activities), files_per_trigger=8)).select(
        "id", "employee_id", "social_year")
    finish(start_enriched(stream, newest, "employee_id", path, checkpoint, once=True))
    return enriched(v.spark, path, schemas.T.StructType.fromDDL("id string, social_year string, business_unit string"))


@check("alert_filter", """select run, status, 'log' as route, status || ' **ALERT MESSAGE : Abnormal termination of flow : ' || status
  || '**' || chr(10) || '&nbsp;' || chr(10) || 'run ' || run as text from (
  select run, case when bool_or(status = 'FAILED') then 'FAILED' when bool_or(status = 'WARNING') then 'WARNING'
  else 'SUCCESS' end as status from run_steps group by run) where status <> 'SUCCESS'""")
def _(v: Views):
    message = F.concat(F.lit("run "), F.col("run").cast("string"))
    return alert_messages(alerts(rollup(v.run_steps)).withColumn("message", message)).drop("message")


@check("score_batches", """select id, 'Well done: ' || sport as comment, 'second' as writer from activities""")
def _(v: Views):
    seen = v.activities.select("id", F.col("employee_id").alias("name"), "sport", "situation")
    prompts = build_prompts(seen, ["id", "name", "sport", "situation"])
    skip = len(INSTRUCTIONS)

    def first(prompt: str) -> str:
        raise RuntimeError("not reachable")

    def second(prompt: str) -> str:
        import json

        told = [{"id": r["id"], "comment": "Well done: " + r["sport"]} for r in json.loads(prompt[skip:])]
        return "```json\n" + json.dumps({"results": told}) + "\n```"

    scored = write_stage(score_batches(prompts, {"first": first, "second": second}), name="answers")
    answered = scored.select("writer", F.explode(parse_answer("answer")["results"]).alias("r"))
    return answered.select("r.id", "r.comment", "writer")


@check("score_batches_ledger", "select id, 'Well done: ' || sport as comment from activities")
def _(v: Views):
    seen = v.activities.select("id", F.col("employee_id").alias("name"), "sport", "situation")
    prompts = write_stage(build_prompts(seen, ["id", "name", "sport", "situation"]), name="prompts")
    ledger, skip = new_path(v.spark, "ledger"), len(INSTRUCTIONS)

    def answer(prompt: str) -> str:
        import json

        return json.dumps({"results": [{"id": r["id"], "comment": "Well done: " + r["sport"]} for r in json.loads(prompt[skip:])]})

    def half(prompt: str) -> str:
        if len(prompt) % 2:
            raise RuntimeError("not reachable")
        return answer(prompt)

    def nobody(prompt: str) -> str:
        raise RuntimeError("asked again")

    score_once(prompts, {"half": half}, ledger, per_task=8)
    score_once(prompts, {"rest": answer}, ledger, per_task=8)
    scored = score_once(prompts, {"nobody": nobody}, ledger)
    return scored.select(F.explode(parse_answer("answer")["results"]).alias("r")).select("r.id", "r.comment")
