"""Adapter views: the driver's tables in the shape of the pipeline's inputs.

Each view exists for Spark (a method of ``Views``) and as SQL for the check
(an entry of ``SQL``). Both start from the same table and keep all its rows.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_lake import schemas
from activity_lake.functions.dates import epoch_micros, full_years
from activity_lake.functions.business import margin_kms
from activity_lake.operators.cdc import cdc_events
from activity_lake.operators.diff import diff_labels, fingerprint, snapshot_diff
from activity_lake.sources.tables import write_stage
from activity_lake.streaming.gold import activities_gold

AS_OF = "2026-01-01"
COMPANY = (43.57, 3.9)
KEY = "0123456789abcdef"

# --- expressions both dialects read -----------------------------------------

# Contract types and transport modes, as the rules name them.
CONTRACT = "case when c_custkey % 50 = 0 then 'Stage' when c_custkey % 3 = 0 then 'CDD' else 'CDI' end"
MODE = """case when c_custkey % 97 = 0 then 'Inconnu'
  when c_mktsegment = 'FURNITURE' then 'Transports en commun'
  when c_mktsegment = 'MACHINERY' then 'véhicule thermique/électrique'
  when c_mktsegment = 'BUILDING' then 'Marche/running'
  else 'Vélo/Trottinette/Autres' end"""
REPAIRED = "case when transport_mode = 'Inconnu' then 'Marche/running' else transport_mode end"
FAVOURITE = """case when c_custkey % 5 = 0 then null
  when c_nationkey % 2 = 0 then 'click' else 'purchase' end"""
PERSON = [
    "cast(c_custkey as string) as id", "c_name as last_name",
    "concat('F', cast(c_nationkey as string)) as first_name", "c_mktsegment as business_unit",
    "cast(10000 + c_acctbal * 12 as decimal(10,2)) as salary", f"{CONTRACT} as employement_contract",
    "cast(c_custkey % 40 as int) as vacation_days",
    "concat(cast(c_custkey as string), ' rue de ', c_mktsegment) as address", f"{MODE} as transport_mode",
    "cast(round((c_custkey * 7 % 300) / 10.0, 1) as decimal(10,1)) as distance_kms",
    f"{FAVOURITE} as sport_type", "c_custkey as n",
]
DIRTY = [
    "case when n % 211 = 0 then null else id end as id", "last_name",
    "case when n % 149 = 0 then null else first_name end as first_name", "business_unit", "salary",
    "employement_contract", "vacation_days", "transport_mode",
    "case when n % 173 = 0 then null else distance_kms end as distance_kms",
    "case when n % 173 = 0 then null else margin_kms end as margin_kms",
    "age", "seniority_years", "sport_type", "n",
]
DIRTY_MOVE = [
    "case when n % 307 = 0 then null when n % 101 = 0 then 'A1' else id end as id",
    "case when n % 89 = 0 then null else employee_id end as employee_id",
    "case when n % 71 = 0 then null else sport end as sport", "situation", "distance_meters",
    "case when n % 53 = 0 then null else begin_date end as begin_date",
    "case when n % 67 = 0 then null else duration_sec end as duration_sec", "n",
]
SPORT = [
    "p_partkey as position",
    "concat(replace(p_name, 'e', 'é'), '-', cast(p_partkey as string)) as sport",
    """case when p_partkey % 3 = 0 then null else concat(' alt ', cast(p_partkey as string), ', ',
      lower(p_type), ' ', cast(p_partkey % 100 as string), ' ,Alt/', cast(p_partkey as string)) end as alias""",
    "concat(p_name, ' at {loc}|', p_brand, ' by {loc}') as templates",
    "case when p_size % 4 = 0 then 0 else 1 end as strava_list",
]
RAW_SPORT = [
    "upper(sport)", "concat(' alt ', cast(position as string))",
    "concat('Alt/', cast(position as string))", "concat('unknown ', cast(position as string))",
    "replace(sport, '-', '/')", "''",
]
OPERATION = """case when role = 'system' then 'other' when turn % 4 = 3 then 'vectorization'
  when role = 'user' then 'search' else 'chat' end"""
VERSIONS = [
    # op, condition, seconds added to the duration, milliseconds after the start;
    # some changes of a key have the same time and differ in their log place only.
    ("c", "true", 0, "0"),
    ("u", "n % 20 = 0", 30, "case when n % 40 = 0 then 0 else 60000 end"),
    ("d", "n % 50 = 0", 0, "case when n % 200 = 0 then 0 else 120000 end"),
]
PLACES = {op: place for place, (op, *_) in enumerate(VERSIONS)}


def moves(value: str = "value") -> list[str]:
    """An event as an activity; distance and duration follow from its value."""
    return [
        "concat('A', cast(event_id as string)) as id", "cast(user_id as string) as employee_id",
        "event_type as sport", "case when event_id % 3 = 0 then '' else props end as situation",
        f"case when event_type = 'view' then null else cast(floor({value} * 100) as int) end as distance_meters",
        f"60 + cast(floor({value} * 60) as int) as duration_sec", "event_id as n",
    ]


# Some stored activities differ from the incoming ones in their value.
OLDER = "(case when event_id % 7 = 0 then value + 1 else value end)"


class Views:
    """The adapter views over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def employees(self) -> DataFrame:
        def day(start: str, step: int, span: int, bad: int) -> str:
            date = f"cast(date_add(date'{start}', cast(c_custkey * {step} % {span} as int)) as string)"
            return f"case when c_custkey % {bad} = 0 then 'unknown' else {date} end"

        return self.table("customer").selectExpr(
            *PERSON, f"{day('1945-01-01', 37, 24000, 83)} as birthday",
            f"{day('2015-01-01', 13, 4500, 79)} as entry_date")

    @cached_property
    def hr(self) -> DataFrame:
        return self.employees.withColumns({
            "margin_kms": margin_kms("transport_mode", "distance_kms"),
            "age": full_years("birthday", AS_OF),
            "seniority_years": full_years("entry_date", AS_OF),
        })

    @cached_property
    def hr_dirty_once(self) -> DataFrame:
        return self.hr.selectExpr(*DIRTY)

    @cached_property
    def hr_dirty(self) -> DataFrame:
        dirty = self.hr_dirty_once
        return dirty.unionByName(dirty.filter("n % 250 < 3"))

    @cached_property
    def hr_valid(self) -> DataFrame:
        """All rows, without the two failures that block publishing."""
        return self.hr_dirty_once.withColumn("transport_mode", F.expr(REPAIRED))

    @cached_property
    def geo(self) -> DataFrame:
        return self.employees.filter("n % 41 <> 0").selectExpr(
            "address", "43.0D + cast(distance_kms as double) / 25 as lat",
            "3.5D + cast(distance_kms as double) / 30 as lon")

    @cached_property
    def known_employees(self) -> DataFrame:
        return self.employees.filter("n % 17 <> 0")

    def _moves(self, value: str = "value") -> DataFrame:
        return self.table("events").selectExpr(
            *moves(value),
            "cast(ts as timestamp_ntz) + make_ym_interval(0, cast(event_id % 24 as int)) as begin_date")

    @cached_property
    def activities(self) -> DataFrame:
        return self._moves()

    @cached_property
    def activities_dirty(self) -> DataFrame:
        return self.activities.selectExpr(*DIRTY_MOVE)

    @cached_property
    def incoming(self) -> DataFrame:
        return fingerprint(self.activities.filter("n % 13 <> 5").drop("n"))

    @cached_property
    def stored(self) -> DataFrame:
        older = self._moves(OLDER)
        older = older.filter("n % 10 <> 3").withColumn("comment", F.expr("concat('c', id)")).drop("n")
        return fingerprint(older).select(*schemas.STORED_COLUMNS)

    @cached_property
    def labels(self) -> DataFrame:
        """Labels of the differing images, as a written table."""
        return write_stage(diff_labels(self.incoming, self.stored, unique=True), name="labels")

    @cached_property
    def diff(self) -> DataFrame:
        return snapshot_diff(self.incoming, self.stored, labels=self.labels)

    @cached_property
    def actions(self) -> DataFrame:
        """The difference as the stage that later steps read."""
        return write_stage(self.diff, name="actions")

    def _messages(self, rows: DataFrame, image, start_ms) -> DataFrame:
        """Envelopes of all versions, a tombstone per delete, and unreadable lines."""
        parts = []
        for op, condition, _, later in VERSIONS:
            seen = rows.filter(condition)
            gone = F.lit(None)
            payload = F.struct(
                F.lit(op).alias("op"), (start_ms + F.expr(later)).alias("ts_ms"),
                F.struct((F.col("n") * 10 + PLACES[op]).alias("lsn")).alias("source"),
                (F.struct("id") if op == "d" else gone).alias("before"),
                (gone if op == "d" else image(op)).alias("after"))
            parts.append(seen.select(F.to_json(F.struct(payload.alias("payload"))).alias("value")))
            if op == "d":
                parts.append(seen.select(F.lit(None).cast("string").alias("value")))
        parts.append(rows.filter("n % 997 = 0").select(F.concat(F.lit("{broken "), "id").alias("value")))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    @cached_property
    def cdc_activities(self) -> DataFrame:
        added = {op: seconds for op, _, seconds, _ in VERSIONS}

        def image(op: str):
            return F.struct(
                "id", "employee_id", "sport", epoch_micros("begin_date").alias("begin_date"),
                (F.col("duration_sec") + added[op]).alias("duration_sec"), "distance_meters",
                F.col("situation").alias("comment"))

        return self._messages(self.activities, image, F.floor(epoch_micros("begin_date") / 1000))

    @cached_property
    def cdc_employees(self) -> DataFrame:
        from activity_lake.functions.privacy import encrypted

        def image(op: str):
            salary = F.col("salary") + (100 if op == "u" else 0)
            return F.struct(
                "id", encrypted("last_name", KEY).alias("last_name"),
                F.when(F.col("n") % 59 == 0, "garbled").otherwise(encrypted("first_name", KEY)).alias("first_name"),
                "age", "business_unit", salary.cast("double").alias("salary"),
                F.col("distance_kms").cast("double").alias("distance_kms"),
                F.col("margin_kms").cast("double").alias("margin_kms"), "sport_type", "transport_mode")

        return self._messages(self.hr, image, F.col("n") * 1000)

    @cached_property
    def activity_events(self) -> DataFrame:
        return cdc_events(self.cdc_activities, schemas.ACTIVITY_EVENT)

    @cached_property
    def gold(self) -> DataFrame:
        return activities_gold(self.cdc_activities).drop("_event_timestamp")

    @cached_property
    def sports(self) -> DataFrame:
        return self.table("part").selectExpr(*SPORT)

    @cached_property
    def raw_sports(self) -> DataFrame:
        variants = F.explode(F.array(*[F.expr(v) for v in RAW_SPORT])).alias("sport_type")
        return self.sports.select("position", variants)

    @cached_property
    def sport_declared(self) -> DataFrame:
        """One declaration per employee but some, and some of nobody, as a sheet on file."""
        names = self.sports.select(F.col("position").alias("n"), "sport")
        listed = self.employees.filter("n % 19 <> 0").join(names, "n", "left")
        return write_stage(listed.selectExpr(
            "case when n % 23 = 0 then concat('X', id) else id end as id",
            "case when n % 5 = 0 then null else sport end as sport_type"), name="sport")

    @cached_property
    def token_log(self) -> DataFrame:
        from activity_lake.functions.text import answer_tokens, prompt_tokens

        return self.table("conversations").select(
            F.col("conv_id").cast("string").alias("session_id"),
            F.concat(F.lit("2024-01-01T00:00:0"), F.col("turn").cast("string")).alias("timestamp"),
            F.expr(OPERATION).alias("operation"), answer_tokens("text").alias("query_tokens"),
            prompt_tokens("text").alias("context_tokens"), F.col("turn").alias("llm_tokens"),
            F.when(F.expr(f"{OPERATION} = 'vectorization'"), F.col("turn")).alias("chunks"),
            F.when(F.expr(f"{OPERATION} = 'vectorization'"), F.length("text").cast("long")).alias("tokens"),
        )

    @cached_property
    def answers(self) -> DataFrame:
        """Model answers: plain, fenced, and unreadable."""
        result = F.to_json(F.struct(F.array(F.struct(
            "id", F.concat(F.lit("Bravo "), "sport").alias("comment"))).alias("results")))
        return self.activities.select("id", (
            F.when(F.expr("n % 31 = 0"), F.lit("Unable to get an answer."))
            .when(F.expr("n % 2 = 0"), F.concat(F.lit("```json\n"), result, F.lit("\n```")))
            .otherwise(result)).alias("answer"))

    @cached_property
    def places(self) -> DataFrame:
        """One document per supplier's nation, an element per supplier."""
        document = """named_struct(
          'lat', case when s_suppkey % 2 = 0 then 40.0D + s_nationkey end,
          'lon', case when s_suppkey % 2 = 0 then 3.0D + s_suppkey % 7 end,
          'center', named_struct('lat', 50.0D + s_nationkey, 'lon', 5.0D + s_suppkey % 7),
          'tags', map_filter(map('name', case when s_suppkey % 9 <> 0 then s_name end,
            'addr:city', case when s_suppkey % 3 = 0 then concat('city ', s_nationkey) end,
            'is_in:city', case when s_suppkey % 4 = 0 then concat('near ', s_nationkey) else '' end,
            'sport', case when s_suppkey % 5 = 0 then 'tennis' end,
            'leisure', case when s_suppkey % 2 = 0 then 'park' end), (k, v) -> v is not null))"""
        return self.table("supplier").selectExpr(
            f"to_json(named_struct('elements', array({document}))) as document")

    @cached_property
    def run_steps(self) -> DataFrame:
        """One run per user, a step per event."""
        status = F.expr("case when value > 250 then 'FAILED' when value > 100 then 'WARNING' else 'SUCCESS' end")
        return self.table("events").select(
            F.col("user_id").alias("run"), F.col("event_type").alias("step"), "ts", status.alias("status"))


# --- the same views as SQL ---------------------------------------------------


def digest(*parts: str) -> str:
    marked = [
        f"coalesce(cast(length(cast({p} as varchar)) as varchar) || ':' || cast({p} as varchar), '-')"
        for p in parts
    ]
    return f"md5({' || chr(124) || '.join(marked)})"


def normalized(c: str) -> str:
    return f"translate(lower(trim({c})), 'àãáâéèêëîïùüûôö-/', 'aaaaeeeeiiuuuoo  ')"


def years(c: str) -> str:
    days = f"(date '{AS_OF}' - try_cast({c} as date))"
    return f"cast(coalesce(floor({days} / 365.0), 0) as int)"


def social_year(ts: str, first_month: int = 6) -> str:
    start = f"(case when month({ts}) > {first_month} then year({ts}) else year({ts}) - 1 end)"
    return f"cast({start} as varchar) || '-' || cast({start} + 1 as varchar)"


def limit_of(mode: str) -> str:
    return (f"(case {mode} when 'Transports en commun' then 150 when 'véhicule thermique/électrique' then 250 "
            f"when 'Marche/running' then 15 when 'Vélo/Trottinette/Autres' then 25 else 0 end)")


def eligible(mode: str = "transport_mode", margin: str = "margin_kms") -> str:
    return f"coalesce({mode} in ('Marche/running', 'Vélo/Trottinette/Autres') and {margin} >= 0, false)"


FINGERPRINT = digest(
    "employee_id", "sport", "situation", "distance_meters", "epoch_us(begin_date)", "duration_sec")
_DAY = ("case when c_custkey % {bad} = 0 then 'unknown' else "
        "cast(date '{start}' + cast(c_custkey * {step} % {span} as int) as varchar) end")
_SHIFT = "ts + to_months(cast(event_id % 24 as int)) as begin_date"
_IMAGE = "id, employee_id, sport, begin_date, distance_meters, situation"

SQL = {
    "employees": f"""select {', '.join(PERSON)},
      {_DAY.format(start='1945-01-01', step=37, span=24000, bad=83)} as birthday,
      {_DAY.format(start='2015-01-01', step=13, span=4500, bad=79)} as entry_date from customer""",
    "hr": f"""select *, {limit_of('transport_mode')} - distance_kms as margin_kms,
      {years('birthday')} as age, {years('entry_date')} as seniority_years from employees""",
    "hr_dirty_once": f"select {', '.join(DIRTY)} from hr",
    "hr_dirty": "select * from hr_dirty_once union all select * from hr_dirty_once where n % 250 < 3",
    "hr_valid": f"select * replace ({REPAIRED} as transport_mode) from hr_dirty_once",
    "geo": """select address, 43.0::double + cast(distance_kms as double) / 25 as lat,
      3.5::double + cast(distance_kms as double) / 30 as lon from employees where n % 41 <> 0""",
    "known_employees": "select * from employees where n % 17 <> 0",
    "activities": f"select {', '.join(moves())}, {_SHIFT} from events",
    "activities_dirty": f"select {', '.join(DIRTY_MOVE)} from activities",
    "incoming": f"select * exclude (n), {FINGERPRINT} as fingerprint from activities where n % 13 <> 5",
    "older": f"select {', '.join(moves(OLDER))}, {_SHIFT} from events",
    "stored": f"""select {', '.join(schemas.STORED_COLUMNS[:-2])}, 'c' || id as comment,
      {FINGERPRINT} as fingerprint from older where n % 10 <> 3""",
    "activity_events": " union all ".join(
        f"""select id, '{op}' as op, epoch_us(begin_date) // 1000 + {later} as ts_ms, n * 10 + {PLACES[op]} as lsn, """
        + ("null as employee_id, null as sport, null as begin_date, null as duration_sec, "
           "null as distance_meters, null as situation" if op == "d" else
           f"employee_id, sport, begin_date, duration_sec + {added} as duration_sec, distance_meters, situation")
        + f" from activities where {condition}"
        for op, condition, added, later in VERSIONS),
    "gold": f"""select id, employee_id, sport, epoch_us(begin_date) as begin_date, duration_sec, distance_meters,
      date_trunc('second', begin_date) as activity_date, {social_year('begin_date')} as social_year
      from activity_events where op <> 'd'""",
    "employee_events": " union all ".join(
        f"""select id, n, '{op}' as op, n * 1000 + {later} as ts_ms, n * 10 + {PLACES[op]} as lsn, """
        + ("null as last_name, null as first_name, null as age, null as business_unit, null as salary, "
           "null as distance_kms, null as margin_kms, null as sport_type, null as transport_mode" if op == "d" else
           "last_name, case when n % 59 = 0 then 'Error_Decrypt' else first_name end as first_name, age, "
           f"business_unit, salary + {100 if op == 'u' else 0} as salary, distance_kms, margin_kms, sport_type, "
           "transport_mode")
        + f" from hr where {condition}"
        for op, condition, _, later in VERSIONS),
    "sports": f"select {', '.join(SPORT)} from part",
    "raw_sports": f"select position, unnest([{', '.join(RAW_SPORT)}]) as sport_type from sports",
    "sport_declared": """select case when e.n % 23 = 0 then 'X' || id else id end as id,
      case when e.n % 5 = 0 then null else s.sport end as sport_type
      from employees e left join sports s on e.n = s.position where e.n % 19 <> 0""",
    "token_log": f"""select cast(conv_id as varchar) as session_id, '2024-01-01T00:00:0' || turn as timestamp,
      {OPERATION} as operation,
      case when trim(text, chr(32) || chr(10) || chr(9)) = '' then 0 else cast(floor(len(regexp_split_to_array(
        trim(text, chr(32) || chr(10) || chr(9)), '\\s+')) * 1.3::double) as bigint) end as query_tokens,
      cast(floor(length(text) * 1.3::double) as bigint) as context_tokens, turn as llm_tokens,
      case when {OPERATION} = 'vectorization' then turn end as chunks,
      case when {OPERATION} = 'vectorization' then length(text) end as tokens from conversations""",
    "run_steps": """select user_id as run, event_type as step, ts,
      case when value > 250 then 'FAILED' when value > 100 then 'WARNING' else 'SUCCESS' end as status from events""",
}


def compose(query: str) -> str:
    """The query with the views it needs in front, as one statement."""
    needed, todo = set(), [query]
    while todo:
        text = todo.pop()
        for name in SQL:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(SQL[name])
    if not needed:
        return query
    views = ",\n".join(f"{name} as ({SQL[name]})" for name in SQL if name in needed)
    joiner = ",\n" if query.lstrip().lower().startswith("with ") else "\n"
    body = query.lstrip()[5:] if joiner == ",\n" else query
    return f"with {views}{joiner}{body}"
