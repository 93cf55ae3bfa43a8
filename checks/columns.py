"""Business, text and privacy columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from activity_lake import schemas
from activity_lake.functions import dates, privacy, text
from activity_lake.functions.business import bonus_amount, is_eligible, margin_kms, with_distance
from activity_lake.operators.cdc import cdc_rows
from activity_lake.operators.comments import build_prompts, parse_answers, INSTRUCTIONS
from activity_lake.operators.places import flatten_places
from activity_lake.operators.reporting import with_templates
from activity_lake.operators.shaping import alias_table, with_batch
from activity_lake.streaming.outbox import clean_comments
from checks.joins import DIFF
from checks.registry import check
from checks.views import AS_OF, COMPANY, KEY, Views, digest, eligible, limit_of, normalized, social_year, years


@check("social_year", f"""select id, {social_year('begin_date')} as from_june,
  {social_year('begin_date', 9)} as from_september from activities""")
def _(v: Views):
    return v.activities.select(
        "id", dates.social_year("begin_date").alias("from_june"),
        dates.social_year("begin_date", 9).alias("from_september"))


@check("bonus_eligibility", f"select id, {eligible()} as is_eligible_bonus from hr_dirty_once")
def _(v: Views):
    return v.hr_dirty_once.select("id", is_eligible("transport_mode", "margin_kms").alias("is_eligible_bonus"))


@check("bonus_amount", f"""select id, case when {eligible()} then cast(salary * 0.05 as double)
  else 0.0::double end as bonus_amount from hr""")
def _(v: Views):
    return v.hr.select("id", bonus_amount(is_eligible("transport_mode", "margin_kms"), "salary").alias("bonus_amount"))


@check("age_years", f"select id, {years('birthday')} as age from employees")
def _(v: Views):
    return v.employees.select("id", dates.full_years("birthday", AS_OF).alias("age"))


@check("seniority_years", f"select id, {years('entry_date')} as seniority_years from employees")
def _(v: Views):
    return v.employees.select("id", dates.full_years("entry_date", AS_OF).alias("seniority_years"))


@check("coerce_date", "select id, try_cast(birthday as date) as born from employees")
def _(v: Views):
    return v.employees.select("id", dates.coerce_date("birthday").alias("born"))


@check("epoch_roundtrip", """select id, epoch_us(begin_date) // 1000000 as seconds,
  strftime(date_trunc('second', begin_date), '%Y-%m-%d %H:%M:%S') as again from activities""")
def _(v: Views):
    seconds = v.activities.select("id", dates.to_epoch("begin_date").alias("seconds"))
    return seconds.withColumn("again", dates.from_epoch("seconds").cast("string"))


def _vincenty_sql() -> str:
    """The ellipsoid distance, one step of the iteration per subquery."""
    a, f = 6378.137, 1 / 298.257223563
    b = a * (1 - f)
    arc = """select *, sqrt(pow(c2 * sin(lam), 2) + pow(c1 * s2 - s1 * c2 * cos(lam), 2)) as ss,
      s1 * s2 + c1 * c2 * cos(lam) as cs from ({0})"""
    angles = """select *, atan2(ss, cs) as sig, case when ss = 0 then 0 else c1 * c2 * sin(lam) / ss end as sa
      from ({0})"""
    middle = """select *, 1 - sa * sa as c2a, cs - case when 1 - sa * sa = 0 then 0
      else 2 * s1 * s2 / (1 - sa * sa) end as mid from ({0})"""
    point = f"atan({1 - f!r}::double * tan(radians({{0}})))"
    inner = f"""select id, transport_mode, sin({point.format('43.57')}) as s1, cos({point.format('43.57')}) as c1,
      sin({point.format('lat')}) as s2, cos({point.format('lat')}) as c2, radians(lon - 3.9) as dlon,
      radians(lon - 3.9) as lam from employees left join geo using (address)"""
    for _ in range(5):
        inner = middle.format(angles.format(arc.format(inner)))
        inner = f"select *, {f / 16!r}::double * c2a * (4 + {f!r}::double * (4 - 3 * c2a)) as k from ({inner})"
        inner = f"""select id, transport_mode, s1, c1, s2, c2, dlon, dlon + (1 - k) * {f!r}::double * sa * (sig + k * ss *
          (mid + k * cs * (2 * mid * mid - 1))) as lam from ({inner})"""
    inner = middle.format(angles.format(arc.format(inner)))
    inner = f"select *, c2a * {(a * a - b * b) / (b * b)!r}::double as u from ({inner})"
    inner = f"""select *, 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u))) as sc,
      u / 1024 * (256 + u * (-128 + u * (74 - 47 * u))) as sh from ({inner})"""
    length = f"""{b!r}::double * sc * (sig - sh * ss * (mid + sh / 4 * (cs * (2 * mid * mid - 1)
      - sh / 6 * mid * (4 * ss * ss - 3) * (4 * mid * mid - 3))))"""
    return f"""select id, case when transport_mode = 'Inconnu' then 0 else round({length}, 2) end as distance_kms
      from ({inner})"""


HOME_DISTANCE = _vincenty_sql()


@check("home_distance", HOME_DISTANCE)
def _(v: Views):
    people = v.employees.select("id", "transport_mode", "address")
    return with_distance(people, v.geo, COMPANY).select("id", "distance_kms")


@check("margin_kms", f"""select id, cast({limit_of('transport_mode')} - distance_kms as double) as margin_kms
  from employees""")
def _(v: Views):
    return v.employees.select("id", margin_kms("transport_mode", "distance_kms").cast("double").alias("margin_kms"))


@check("normalize_text", f"select position, {normalized('sport_type')} as name from raw_sports")
def _(v: Views):
    return v.raw_sports.select("position", text.normalize_text("sport_type").alias("name"))


@check("alias_explode", """select trim(a) as alias, arg_max(sport, position) as sport
  from (select position, sport, unnest(string_split(alias, ',')) as a from sports) group by 1""")
def _(v: Views):
    return alias_table(v.sports)


@check("template_split", """select sport, len(string_split(templates, '|')) as templates,
  string_split(templates, '|')[2] as second from sports""")
def _(v: Views):
    listed = with_templates(v.sports)
    return listed.select(
        "sport", F.size("templates").cast("long").alias("templates"), F.col("templates")[1].alias("second"))


@check("display_name", """select id, first_name || case when last_name is null then '' else
  ' ' || left(last_name, 1) || '.' end as name from (select id, first_name,
  case when n % 7 = 0 then null else last_name end as last_name from employees)""")
def _(v: Views):
    last = F.when(F.expr("n % 7 <> 0"), F.col("last_name"))
    return v.employees.select("id", text.display_name("first_name", last).alias("name"))


_CLOCK = """case when duration_sec >= 3600 then cast(duration_sec // 3600 as varchar) || 'h'
  || lpad(cast(duration_sec % 3600 // 60 as varchar), 2, '0')
  else cast(duration_sec // 60 as varchar) || ' min' end"""


@check("format_performance", f"""select id, case when coalesce(distance_meters, 0) = 0 then '' else
  format('{{:.1f}}', distance_meters / 1000.0::double) || ' km en ' end || {_CLOCK} as performance from activities""")
def _(v: Views):
    return v.activities.select("id", text.format_performance("distance_meters", "duration_sec").alias("performance"))


@check("comment_clean", """select id, trim(replace(situation, '"', '''')) as text from activities
  where trim(situation) <> ''""")
def _(v: Views):
    sealed = v.activities.select("id", privacy.encrypted("situation", KEY).alias("comment"))
    return clean_comments(sealed, KEY)


@check("markup_clean", """select page_id, replace(replace(html, ' ', '&nbsp;'), '&nbsp;', ' ') as html from pages""")
def _(v: Views):
    marked = F.replace(F.col("html"), F.lit(" "), F.lit("&nbsp;"))
    return v.table("pages").select("page_id", text.clean_markup(marked).alias("html"))


@check("default_comment", """select id, 'Bypass IA : ' || case when situation = '' then 'No comment'
  else situation end as comment from activities""")
def _(v: Views):
    return v.activities.select("id", text.default_comment("situation").alias("comment"))


@check("build_prompts", f"""with numbered as (select id, employee_id, sport, situation,
  (row_number() over (order by id) - 1) // 100 as batch from activities)
  select batch, count(*) as rows, '{INSTRUCTIONS}' || to_json(list({{'id': id, 'name': employee_id, 'sport': sport,
    'situation': situation}} order by id)) as prompt from numbered group by batch""")
def _(v: Views):
    seen = v.activities.select("id", F.col("employee_id").alias("name"), "sport", "situation")
    return build_prompts(with_batch(seen, order=("id",)), ["id", "name", "sport", "situation"])


@check("parse_answers", """select id, 'Bravo ' || sport as comment, 'read' as part from activities where n % 31 <> 0
  union all select id, 'Unable to get an answer.', 'rejected' from activities where n % 31 = 0""")
def _(v: Views):
    comments, rejects = parse_answers(v.answers)
    return comments.withColumn("part", F.lit("read")).unionByName(
        rejects.select("id", F.col("answer").alias("comment"), F.lit("rejected").alias("part")))


_WORDS = """case when trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' then 0 else
  len(regexp_split_to_array(trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\\s\\x0b]+')) end"""


@check("estimate_tokens", f"""select doc_id, cast(floor(length(text) * 1.3::double) as bigint) as prompt_tokens,
  cast(floor({_WORDS} * 1.3::double) as bigint) as answer_tokens from documents""")
def _(v: Views):
    return v.table("documents").select(
        "doc_id", text.prompt_tokens("text").alias("prompt_tokens"), text.answer_tokens("text").alias("answer_tokens"))


@check("first_char", "select id, left(employement_contract, 1) as initial from employees")
def _(v: Views):
    return v.employees.select("id", text.first_char("employement_contract").alias("initial"))


@check("coalesce_falsy", """select id, coalesce(nullif(situation, ''), nullif(case when n % 2 = 0 then sport else '' end, ''),
  'none') as told from activities""")
def _(v: Views):
    sport = F.when(F.expr("n % 2 = 0"), F.col("sport")).otherwise("")
    return v.activities.select("id", text.first_filled("situation", sport, default="none").alias("told"))


@check("flatten_places", """select s_name as name,
  case when s_suppkey % 3 = 0 then 'city ' || s_nationkey when s_suppkey % 4 = 0 then 'near ' || s_nationkey
    else 'Hérault' end as city,
  case when s_suppkey % 5 = 0 then 'tennis' when s_suppkey % 2 = 0 then 'park' else 'lieu' end as category,
  case when s_suppkey % 2 = 0 then 40.0::double else 50.0::double end + s_nationkey as lat,
  case when s_suppkey % 2 = 0 then 3.0::double else 5.0::double end + s_suppkey % 7 as lon
  from supplier where s_suppkey % 9 <> 0""")
def _(v: Views):
    return flatten_places(v.places)


@check("activity_key", f"""select id, 'ACT-' || strftime(begin_date, '%y%m%d-%H%M') || '-'
  || lpad(cast(('0x' || left({digest('id', 'employee_id')}, 8))::bigint % 100000 as varchar), 5, '0') as key
  from activities""")
def _(v: Views):
    return v.activities.select("id", text.activity_key("begin_date", "id", "employee_id").alias("key"))


# --- privacy -----------------------------------------------------------------


@check("encrypt_columns", """select id, last_name, first_name, true as hidden from hr_dirty_once
  where first_name is not null union all select id, last_name, null, null from hr_dirty_once where first_name is null""")
def _(v: Views):
    plain = v.hr_dirty_once.select("id", "last_name", "first_name")
    sealed = privacy.encrypt(plain.withColumn("clear", F.col("first_name")), ["last_name", "first_name"], KEY)
    opened = privacy.decrypt(
        sealed.withColumn("hidden", F.col("first_name") != F.col("clear")), ["last_name", "first_name"], KEY)
    return opened.drop("clear")


@check("decrypt_columns", """select id, case when op = 'd' then null else last_name end as last_name, first_name
  from employee_events where op <> 'd'""")
def _(v: Views):
    rows = cdc_rows(v.cdc_employees, schemas.EMPLOYEE_EVENT)
    return privacy.decrypt(rows, ["last_name", "first_name"], KEY).select("id", "last_name", "first_name")


@check("encrypt_once", f"""with {DIFF} select id, _merge, situation as comment,
  _merge = 'left_only' as fresh from diff""")
def _(v: Views):
    actions = v.actions.withColumn("comment", F.col("situation"))
    sealed = privacy.encrypt_new(actions, "comment", KEY)
    fresh = F.col("comment") != F.col("situation")
    opened = F.when(fresh, privacy.decrypted("comment", KEY)).otherwise(F.col("comment"))
    return sealed.select("id", "_merge", fresh.alias("fresh"), opened.alias("comment"))


@check("drop_pii", "select id, business_unit, transport_mode, vacation_days from employees")
def _(v: Views):
    return privacy.drop_pii(v.employees).drop(
        "last_name", "first_name", "salary", "employement_contract", "distance_kms", "sport_type", "n")
