"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_lake.llm.chat import format_conversations, read_turns, trained_text
from activity_lake.llm.common import conversations, documents
from activity_lake.llm.exact import exact_dedup
from activity_lake.llm.language import predict_language, train_languages
from activity_lake.llm.line_rules import line_rules
from activity_lake.llm.merge_dropout import decode_ids, encode_with_dropout
from activity_lake.llm.packing import pack_documents
from activity_lake.llm.repair import damage, repair_report
from activity_lake.llm.simhash import fingerprint_hex, simhash_groups
from activity_lake.llm.spelling import DAMAGE, group_variants, word_counts
from activity_lake.llm.substrings import substring_dedup
from activity_lake.llm.token_counts import count_tokens
from activity_lake.llm.token_files import read_token_files, write_token_files
from activity_lake.llm.toxicity import score_toxicity, train_toxicity
from activity_lake.session import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


# The table of CRC-32, and the sum of a list of bytes, in SQL.
CRC_TABLE = """crc as (select list(v order by i) as tab from (select i, list_reduce([cast(i as bigint)] || range(8),
  lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256) r(i)))"""


def crc_sql(code_points: str) -> str:
    return f"""xor(list_reduce([4294967295] || {code_points},
  lambda c, b: xor(c >> 8, tab[cast(xor(c, b) & 255 as int) + 1])), 4294967295)"""


@query("op1_exact_dedup", r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
  doc_id = min(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256 from d""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir), digest_all=True)


@query("op3_line_rules", r"""
with d as (select doc_id, source as host, coalesce(text, '') as text from documents),
w as (select doc_id, text, host, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
starts as (select doc_id, i, words[i:i + 2] as win from w, range(1, len(words) - 1) r(i) where len(words) >= 3),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, win) as c from starts) where c > 1),
covered as (select doc_id, count(distinct i + k) as n_repeat_words from twice, range(0, 3) s(k) group by doc_id),
per_line as (select doc_id, host, text, l, len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> ''))
  as n, regexp_replace(regexp_replace(trim(lower(l), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g') as line
  from (select doc_id, host, text, unnest(lines) as l from w)),
common as (select host, line from per_line group by all having count(distinct doc_id) > 10),
removed as (select doc_id, count(*) as n_common_lines, sum(n) as gone from per_line join common
  on per_line.line = common.line and per_line.host is not distinct from common.host group by doc_id),
f as (select doc_id, cast(len(words) as bigint) as n_words,
  cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
  cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
  cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
  cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
  cast(coalesce(n_common_lines, 0) as bigint) as n_common_lines,
  cast(len(words) - coalesce(gone, 0) as bigint) as n_words_left
  from w left join covered using (doc_id) left join removed using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from f)
select *, not base_failed and not (n_common_lines > 0 and (n_words_left < 50 or 100 * n_words_left < 50 * n_words))
  as kept from b""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules(documents(spark, sf_dir))


@query("op5_substring_dedup", r"""
with w as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
  lambda x: x <> '') as words from documents),
starts as (select doc_id, i, array_to_string(words[i:i + 19], ' ') as win from w, range(1, len(words) - 18) r(i)
  where len(words) >= 20),
later as (select doc_id, i from (select doc_id, i, row_number() over (partition by win order by doc_id, i) as n
  from starts) where n > 1),
gone as (select distinct doc_id, i + k as pos from later, range(0, 20) s(k)),
words as (select doc_id, i as pos, words[i] as word from w, range(1, len(words) + 1) r(i)),
kept as (select words.doc_id, count(gone.pos) as n_removed, coalesce(string_agg(word, ' ' order by words.pos)
  filter (where gone.pos is null), '') as kept from words left join gone using (doc_id, pos) group by words.doc_id)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256 from w left join kept using (doc_id)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir)).select(
        "doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


@query("op2_token_files")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@query("op4_language")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict_language(docs, train_languages(docs))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_toxicity(docs, train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query("op6_merge_dropout")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_with_dropout(documents(spark, sf_dir), model, seed=17, dropout=0.1)
    return decode_ids(encoded, model).select(
        "doc_id", F.expr("length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
        F.sha2("text", 256).alias("decoded_sha256"))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_repair", rf"""
with recursive {CRC_TABLE},
base as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(cast(conv_id as varchar), ' ')
  || ':' || coalesce(cast(turn as varchar), ' ') as key from conversations),
fated as (select *, {crc_sql("list_transform(string_split(key, ''), lambda x: cast(unicode(x) as bigint))")} % 20 as fate
  from base, crc),
damaged as (select conv_id, turn, case when fate = 4 then 'user' else role end as role, case when fate = 1 then ''
  when fate = 2 then translate(text, '.!?', '') else text end as text
  from fated, range(case fate when 0 then 0 when 3 then 2 else 1 end)),
numbered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text)) as i from damaged),
placed as (select *, row_number() over (partition by conv_id, role, text order by i) as nth, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare from numbered),
found as (select *, case when bare = '' then 'blank' when nth > 1 then 'duplicate'
  when right(bare, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
  left(role, 1) || lead(left(role, 1)) over (partition by conv_id order by i) as joint from placed),
inserts(q, ins, q2) as (values (0, '', 0), (1, '', 1), (2, '', 2), (3, '', 3), (0, 'I', 2), (0, 'II', 3), (1, 'I', 2),
  (1, 'II', 3), (2, 'I', 3), (3, 'I', 2)),
next(q, initial, q2) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
moves as (select q, 'D' as edit, null as initial, q as q2 from range(4) r(q) union all select q, 'K', initial, q2 from next
  union all select q, 'R', null, q2 from next where initial <> 's'),
paths as (select conv_id, cast(0 as bigint) as i, cast(0 as bigint) as q, cast(0 as bigint) as cost, '' as audit
  from (select distinct conv_id from found)
  union all
  select conv_id, i, q, best.cost, best.audit from (
  select p.conv_id, p.i + 1 as i, cast(m.q2 as bigint) as q, min(struct_pack(cost := p.cost + 3 * length(s.ins)
    + case m.edit when 'D' then 4 when 'R' then 3 else 0 end
    + case when m.edit <> 'D' and f.fault = 'truncated' then 3 else 0 end, audit := p.audit || s.ins || m.edit)) as best
  from paths p join found f on f.conv_id is not distinct from p.conv_id and f.i = p.i + 1
  join inserts s on s.q = p.q join moves m on m.q = s.q2
  where m.edit = 'D' or (f.fault not in ('blank', 'duplicate') and (m.edit = 'R' or m.initial = left(f.role, 1)))
  group by p.conv_id, p.i + 1, m.q2)),
ended as (select p.conv_id, min(struct_pack(cost := p.cost + 3 * length(s.ins), audit := p.audit || s.ins)) as best
  from paths p join inserts s on s.q = p.q and s.q2 in (0, 3)
  where p.i = (select max(i) from found f where f.conv_id is not distinct from p.conv_id) group by p.conv_id),
edits as (select conv_id, best.audit as audit, generate_subscripts(string_split(best.audit, ''), 1) as k,
  unnest(string_split(best.audit, '')) as edit from ended),
counted as (select *, count(*) filter (where edit <> 'I') over w as i, count(*) filter (where edit <> 'D') over w as o,
  count(*) filter (where edit <> 'D') over (partition by conv_id) as n from edits
  window w as (partition by conv_id order by k rows unbounded preceding)),
lines as (select c.conv_id, c.k, case when c.edit = 'K' then f.role when (c.o + c.n) % 2 = 1 then 'user'
  else 'assistant' end || ':' || case when c.edit = 'I' then '' else f.text end as line
  from counted c left join found f on f.conv_id is not distinct from c.conv_id and f.i = c.i where c.edit <> 'D'),
repaired as (select conv_id, sha256(string_agg(line, chr(10) order by k)) as digest from lines group by conv_id),
faults as (select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps,
  count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
  count(*) filter (where fault = 'truncated') as truncated,
  count(*) filter (where joint not in ('su', 'ua', 'au')) as illegal from found group by conv_id)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce(e.best.cost, 0) as bigint) as cost,
  coalesce(e.best.audit, '') as audit, coalesce(digest, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) c left join faults f on f.conv_id is not distinct from c.conv_id
left join ended e on e.conv_id is not distinct from c.conv_id
left join repaired r on r.conv_id is not distinct from c.conv_id""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations(spark, sf_dir)
    return repair_report(damage(rows), rows)


@query("op12_spelling", rf"""
with recursive {CRC_TABLE},
runs as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) as run from documents),
counted as (select doc_id, run, count(*) as n from runs where length(run) >= 6 group by all),
hashed as (select run, n, {crc_sql("""flatten(list_transform(string_split(coalesce(cast(doc_id as varchar), '') || ':' || run, ''),
  lambda x: case when unicode(x) < 128 then [cast(unicode(x) as bigint)] else [195, cast(unicode(x) as bigint) - 64] end))""")}
  as h from counted, crc),
cut as (select case when h % 199 = 0 then left(run, cast(h % length(run) as int))
  || substr(run, cast(h % length(run) as int) + 2) else run end as word, n from hashed),
words as (select word, cast(sum(n) as bigint) as n from cut where length(word) >= 6 group by word having sum(n) >= 5),
without as (select word, n, i, left(word, cast(i as int)) || '$' || substr(word, cast(i as int) + 2) as rest
  from words, range(length(word)) r(i)),
whole as (select word, n, left(word, cast(i as int)) || '$' || substr(word, cast(i as int) + 1) as rest
  from words, range(length(word) + 1) r(i)),
pairs as (select a.word, b.word as other, b.n from without a join without b on a.rest = b.rest and a.word <> b.word
  union select a.word, b.word, b.n from without a join whole b on a.rest = b.rest
  union select b.word, a.word, a.n from without a join whole b on a.rest = b.rest),
near as (select word, count(*) as n_near, min(struct_pack(less := -n, word := other)) as best from pairs group by word),
forms as (select words.word, words.n, coalesce(n_near, 0) as n_near,
  case when -best.less >= 5 * words.n then best.word end as form,
  case when -best.less >= 5 * words.n then -best.less end as form_n from words left join near using (word)),
chain as (select word, word as reached, 0 as hops from forms
  union all select c.word, f.form, hops + 1 from chain c join forms f on f.word = c.reached where f.form is not null),
roots as (select word, arg_max(reached, hops) as root from chain group by word)
select word, form, root, n, n_near, form_n from forms join roots using (word)""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(word_counts(documents(spark, sf_dir), damage=DAMAGE))


@query("op13_chat", r"""
with turns as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
shown as (select *, replace(replace(replace(text, chr(92), chr(92) || 's'), '###', chr(92) || 'h'), '</turn>', chr(92) || 't')
  as escaped from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('### ') + length(role) + case when role in ('system', 'user', 'assistant') then 0 else 5 end + length(': ')
  + length(escaped) + length(' </turn>') + 1) as bigint) as formatted_chars
from shown group by conv_id""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"))
    rows = conversations(spark, sf_dir).select("conv_id", "turn", "role", "text").unionByName(fixed)
    turns = read_turns(F.col("formatted"))
    read = format_conversations(rows).select(
        "conv_id", "formatted", turns.alias("turns"), trained_text(F.col("segments")).alias("trained"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
