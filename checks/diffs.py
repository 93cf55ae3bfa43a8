"""Snapshot comparison, upserts and current state."""

from __future__ import annotations

from pyspark.sql import functions as F

from activity_lake.functions.dates import epoch_micros
from activity_lake.operators.cdc import latest_state, latest_state_with_deletes
from activity_lake.operators.diff import (
    apply_changes, change_counts, diff_gate, diff_labels, diff_summary, fingerprint, mark_duplicates,
)
from activity_lake.operators.versions import BucketTable
from activity_lake.session import new_path
from activity_lake.sources.tables import write_stage
from checks.joins import DIFF
from checks.registry import check
from checks.views import FINGERPRINT, Views

_COUNTS = """counts as (select (select count(*) from incoming) as incoming,
    (select count(*) from incoming i join stored s on s.id = i.id and s.fingerprint = i.fingerprint) as identical,
    (select count(*) from diff where status = 'new') as new,
    (select count(*) from diff where status = 'deleted') as deleted,
    (select count(*) from diff where status = 'modified' and _merge = 'left_only') as modified)"""
_ROW = "id, employee_id, sport, situation, distance_meters, epoch_us(begin_date) as begin_micros, duration_sec, comment, fingerprint"


def _flat(df):
    return df.withColumn("begin_micros", epoch_micros("begin_date")).drop("begin_date")


@check("row_fingerprint", f"select id, {FINGERPRINT} as fingerprint from activities")
def _(v: Views):
    return fingerprint(v.activities).select("id", "fingerprint")


@check("snapshot_diff", f"with {DIFF} select {_ROW}, _merge, status from diff")
def _(v: Views):
    return _flat(v.diff)


@check("snapshot_diff_buckets", f"with {DIFF} select {_ROW}, _merge, status from diff")
def _(v: Views):
    return _flat(BucketTable.create(v.stored, new_path(v.spark, "table"), buckets=32).diff(v.incoming))


@check("snapshot_labels", f"with {DIFF} select id, fingerprint, _merge, status from diff")
def _(v: Views):
    return diff_labels(v.incoming, v.stored)


@check("diff_duplicate_mark", """select l_orderkey, l_linenumber, l_partkey,
  count(*) over (partition by l_orderkey, l_linenumber) > 1 as duplicated from lineitem""")
def _(v: Views):
    lines = v.table("lineitem").withColumn("line", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return mark_duplicates(lines, "line").select("l_orderkey", "l_linenumber", "l_partkey", "duplicated")


@check("diff_summary", f"with {DIFF}, {_COUNTS} select * from counts")
def _(v: Views):
    return diff_summary(v.actions, v.incoming)


@check("diff_gate", f"""with {DIFF}, {_COUNTS}
  select case when new + deleted + modified > 0 then 'YES' else 'NO' end as continue,
  case when deleted + modified > 0 then 'WARNING' else 'SUCCESS' end as status from counts""")
def _(v: Views):
    return diff_gate(diff_summary(v.actions, v.incoming))


@check("apply_changes", f"""select id, employee_id, sport, situation, distance_meters,
  epoch_us(begin_date) as begin_micros, duration_sec, fingerprint from incoming""")
def _(v: Views):
    return _flat(apply_changes(v.stored, v.actions)).drop("comment")


@check("apply_changes_buckets", f"""select id, employee_id, sport, situation, distance_meters,
  epoch_us(begin_date) as begin_micros, duration_sec, fingerprint, 1 as version from incoming""")
def _(v: Views):
    table = BucketTable.create(v.stored, new_path(v.spark, "table"), buckets=32)
    version = table.apply(write_stage(table.diff(v.incoming), name="actions"))
    assert table.differing(v.incoming) == set()
    return _flat(table.read(version)).drop("comment").withColumn("version", F.lit(version))


@check("change_counts", f"""with {DIFF} select status, count(*) as rows from diff
  where not (status = 'modified' and _merge = 'right_only') group by status""")
def _(v: Views):
    return change_counts(v.actions)


_LAST = "row_number() over (partition by id order by ts_ms desc, lsn desc) = 1"


@check("latest_state", f"""select id, employee_id, sport, duration_sec, distance_meters, ts_ms
  from (select * from activity_events where op <> 'd') qualify {_LAST}""")
def _(v: Views):
    upserts = v.activity_events.filter("op <> 'd'")
    return latest_state(upserts).select("id", "employee_id", "sport", "duration_sec", "distance_meters", "ts_ms")


@check("latest_state_with_deletes", f"""select id, employee_id, sport, duration_sec, distance_meters, ts_ms
  from (select * from activity_events qualify {_LAST}) where op <> 'd'""")
def _(v: Views):
    return latest_state_with_deletes(v.activity_events).select(
        "id", "employee_id", "sport", "duration_sec", "distance_meters", "ts_ms")
