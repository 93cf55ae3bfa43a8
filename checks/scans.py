"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from activity_lake import schemas
from activity_lake.operators.cdc import cdc_events, cdc_rows
from activity_lake.session import new_path
from activity_lake.sources.change_log import cdc_source
from activity_lake.sources.tables import (
    append_token_records, is_empty, rows, table_append, table_scan, token_log, typed_scan, write_stage,
)
from activity_lake.streaming.gold import activities_gold, foreach_batch, start_gold
from checks.registry import check
from checks.views import Views


def topic(v: Views, messages) -> str:
    """A folder of messages, one per line, as the stream source reads it; tombstones are empty lines."""
    path = new_path(v.spark, "topic")
    messages.select(F.coalesce("value", F.lit("")).alias("value")).write.text(path)
    return path


def finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@check("cdc_source", "select id, op, ts_ms from activity_events")
def _(v: Views):
    source = cdc_source(v.spark, topic(v, v.cdc_activities), fail_on_loss=False)
    path, checkpoint = new_path(v.spark, "messages"), new_path(v.spark, "checkpoint")
    finish(start_gold(source, path, checkpoint, once=True))
    read = v.spark.read.schema("value string").parquet(path)
    return cdc_events(read, schemas.ACTIVITY_EVENT).select("id", "op", "ts_ms")


@check("typed_scan", """select id, last_name, first_name, birthday, business_unit, entry_date,
  cast(salary as double) as salary, employement_contract, vacation_days, address, transport_mode from employees""")
def _(v: Views):
    path = new_path(v.spark, "sheet")
    sheet = v.employees.select(*schemas.HR_SHEET.fieldNames())
    # The header of a sheet is not trusted: names come from the schema.
    sheet.toDF(*[f"Column {i}" for i in range(len(sheet.columns))]).write.option("header", True).csv(path)
    return typed_scan(v.spark, path, schemas.HR_SHEET).withColumn("salary", F.col("salary").cast("double"))


@check("typed_scan_breaks", """select cast(o_orderkey as varchar) as id, o_orderstatus || ' "' || o_orderpriority || '"' || chr(10)
  || case when o_orderkey % 3 = 0 then 'a, b' || chr(10) || chr(10) || '"' else '' end || o_orderdate as sport_type from orders""")
def _(v: Views):
    path = new_path(v.spark, "sheet")
    cell = F.expr("""concat(o_orderstatus, ' "', o_orderpriority, '"', chr(10),
      case when o_orderkey % 3 = 0 then concat('a, b', chr(10), chr(10), '"') else '' end, o_orderdate)""")
    quoted = F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), quoted).alias("value")
    v.table("orders").select(line).coalesce(1).write.text(path)
    return typed_scan(v.spark, path, schemas.SPORT_SHEET, header=False, multi_line=True)


@check("parquet_scan", "select o_orderkey, o_custkey, o_orderstatus from orders")
def _(v: Views):
    return v.spark.read.parquet(f"{v.sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")


@check("parquet_sink", "select l_orderkey, l_linenumber, l_quantity from lineitem")
def _(v: Views):
    return write_stage(v.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))


@check("table_scan", "select c_custkey as employee_id, c_name as last_name from customer")
def _(v: Views):
    return table_scan(
        v.spark, f"{v.sf_dir}/customer.parquet", {"c_custkey": "employee_id", "c_name": "last_name"})


@check("table_append", "select id, last_name, business_unit from employees")
def _(v: Views):
    path = new_path(v.spark, "employees")
    people = v.employees.select("id", "last_name", "business_unit")
    table_append(people.filter("business_unit < 'F'"), path)
    table_append(people.filter("business_unit >= 'F'"), path)
    return v.spark.read.schema(people.schema).parquet(path)


@check("table_count_gate", "select count(*) as nb_emp, count(*) = 0 as bootstrap from employees")
def _(v: Views):
    empty = is_empty(v.employees)
    return v.employees.agg(F.count("*").alias("nb_emp")).withColumn("bootstrap", F.lit(empty))


GOLD_COLUMNS = ["id", "employee_id", "sport", "begin_date", "duration_sec", "distance_meters", "social_year"]


@check("gold_append_sink", f"""select {', '.join(GOLD_COLUMNS)}, epoch_us(activity_date) as activity_micros
  from gold""")
def _(v: Views):
    source = cdc_source(v.spark, topic(v, v.cdc_activities))
    path, checkpoint = new_path(v.spark, "gold"), new_path(v.spark, "checkpoint")
    finish(start_gold(activities_gold(source), path, checkpoint, partition_by=["start_year"], once=True))
    gold = v.spark.read.parquet(path)
    micros = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), "activity_date")
    return gold.select(*GOLD_COLUMNS, micros.alias("activity_micros"))


@check("batch_callback_sink", "select id, situation as comment from activity_events where op <> 'd'")
def _(v: Views):
    path, checkpoint = new_path(v.spark, "batches"), new_path(v.spark, "checkpoint")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    source = cdc_rows(cdc_source(v.spark, topic(v, v.cdc_activities)), schemas.COMMENT_EVENT)
    finish(foreach_batch(source, write, checkpoint, once=True))
    return v.spark.read.parquet(path).select("id", "comment")


TOKENS = "session_id, timestamp, operation, query_tokens, context_tokens, llm_tokens"


@check("json_lines_scan", f"select {TOKENS}, chunks, tokens from token_log")
def _(v: Views):
    path = new_path(v.spark, "tokens")
    lines = v.token_log.select(F.explode(F.array(F.to_json(F.struct("*")), F.lit(""))).alias("value"))
    lines.write.text(path)
    return token_log(v.spark, path).drop("total_tokens")


@check("json_lines_append", f"""select {TOKENS}, query_tokens + context_tokens + llm_tokens as total_tokens
  from token_log""")
def _(v: Views):
    path = new_path(v.spark, "tokens")
    log = v.token_log.drop("chunks", "tokens")
    append_token_records(log.filter("operation = 'search'"), path)
    append_token_records(log.filter("operation <> 'search'"), path)
    return token_log(v.spark, path).drop("chunks", "tokens")


@check("csv_sink", """select s_name as name, cast(s_nationkey as varchar) as city from supplier""")
def _(v: Views):
    path = new_path(v.spark, "csv")
    v.table("supplier").selectExpr("s_name as name", "cast(s_nationkey as string) as city") \
        .write.option("header", True).csv(path)
    return v.spark.read.schema("name string, city string").option("header", True).csv(path)


@check("inline_rows", """select label, count(*) as activities from (values ('click', 'A'), ('view', 'B'),
  ('signup', 'A'), ('error', 'C'), ('purchase', 'B')) t(sport, label) join activities using (sport) group by label""")
def _(v: Views):
    labels = rows(v.spark, [("click", "A"), ("view", "B"), ("signup", "A"), ("error", "C"), ("purchase", "B")],
                  "sport string, label string")
    return v.activities.join(labels, "sport").groupBy("label").agg(F.count("*").alias("activities"))
