"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, conversation_repair, exact_dedup, html_text, jaccard_join, line_dedup, packing, quality, sharding, spelling, suffix_dedup, url_filter

SHARDS = [f"shard-{i:02d}" for i in range(12)]

#: (verdict, host, path) of the hand-written URL rules.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def with_probe(rows: DataFrame) -> DataFrame:
    """The conversations and conversation -1, whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = rows.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(probe)


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = chat.nodes_table(with_probe(table(spark, sf_dir, "conversations")))
    steps = chat.paths(nodes)
    out = chat.format_paths(nodes, steps, chat.best(nodes, steps, top=1))
    turns = chat.parsed(F.col("formatted"))
    out = out.withColumn("_turns", turns)
    said = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), chat.unescape(t["raw"]), F.lit("\n")))
    loss = F.transform("loss_spans", lambda s: chat.unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    out = out.withColumn("_loss", F.array_join(loss, ""))
    return out.select(F.col("tree").try_cast("long").alias("conv_id"), F.size("_turns").cast("long").alias("n_turns"), F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"), F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality.verdict(quality.verdict(quality.ledger(table(spark, sf_dir, "documents")), "base", "_base"))
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~F.col("_base")).alias("base_failed"), "kept", "bits")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(spark, table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placed_files(table(spark, sf_dir, "documents"), SHARDS).select("doc_id", "slot", "shard")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.groups(spark, table(spark, sf_dir, "documents"), exact=True)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(spark, table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(spark, table(spark, sf_dir, "documents"))


def document_number(url: F.Column) -> F.Column:
    """The number that ends a page's path: the document that the page shows."""
    return F.regexp_extract(url, r"/([0-9]{1,18})(?:\.html)?/?(?:[?#].*)?$", 1).try_cast("long")


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A URL is labelled by its page's document: to be blocked if that is of low quality or toxic."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, sf_dir, "labels").filter("doc_id is not null").select(F.col("doc_id").alias("key"), F.coalesce(bad, F.lit(False)).cast("double").alias("block"))
    out = url_filter.judge(table(spark, sf_dir, "pages"), labels, document_number(F.col("url")), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts, paths and the rules that fit, of all pages."""
    return url_filter.ruled(url_filter.split_url(table(spark, sf_dir, "pages").select("page_id", "url")), URL_RULES).select("page_id", "host", "path", "rule", "rule_verdict")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy rejects, from the ledger of all documents."""
    return quality.ablations(quality.ledger(table(spark, sf_dir, "documents")))


def ranked_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with one opening as branches of a tree; of each tree the best branch, formatted."""
    nodes = chat.shared_roots(table(spark, sf_dir, "conversations"))
    steps = chat.paths(nodes)
    chosen = chat.best(nodes, steps, top=1)
    out = chat.format_paths(nodes, steps, chosen).join(chosen.select("tree", "leaf", "score", "size").hint("merge"), ["tree", "leaf"])
    return out.select("tree", "leaf", F.round("score", 6).alias("score"), F.col("size").alias("n_turns"), F.length("formatted").cast("long").alias("formatted_chars"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_html_extraction, op2_packing, op3_chat_formatting, op4_quality_rules, op5_suffix_array_dedup, op6_sharding, op7_line_dedup, op8_ngram_jaccard_join, op9_byte_bpe, op10_exact_dedup, op11_url_filter, op12_conversation_repair, op13_spelling_variants, url_rules, quality_ablations, ranked_branches)}


WORDS = r"[^\x20\x09-\x0D]+"

SQL_OP3 = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
esc as (
  select *, replace(replace(replace(text, '\', '\b'), '[', '\l'), '<', '\g') as e,
         replace(replace(replace(role, '\', '\b'), '[', '\l'), '<', '\g') as r from rows)
select conv_id::bigint as conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length(e) + 2 * length(r) + 7 + case when role = 'assistant' then 4 else 0 end)::bigint as formatted_chars
from esc group by conv_id
"""

SQL_OP4 = rf"""
with d as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{WORDS}') as w from documents),
l as (
  select *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORDS}')) as lines from d),
g as (
  select doc_id, unnest(range(1, len(w) - 1)) as i, unnest(list_transform(range(1, len(w) - 1), lambda j: w[j:j + 2])) as g from d where len(w) >= 3),
twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from g) where c > 1),
covered as (
  select doc_id, count(distinct i + k)::bigint as n from twice, (select unnest([0, 1, 2]) as k) group by doc_id),
m as (
  select l.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols, len(lines)::bigint as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words
  from l left join covered using (doc_id)),
b as (
  select *, (case when n_words < 50 then 1 else 0 end) + (case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end)
    + (case when 100 * n_symbols > 25 * n_words then 4 else 0 end) + (case when 100 * n_dup_lines > 50 * n_lines then 8 else 0 end)
    + (case when word_chars > 25 * n_words then 16 else 0 end) as bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & 3) <> 0 as base_failed, bits = 0 as kept, bits::int as bits from b
"""

SQL_ABLATIONS = f"""
with led as ({SQL_OP4}), r as (select unnest({list(quality.RULES)!r}) as rule, unnest({list(quality.BITS.values())!r}) as bit), p as (select unnest({list(quality.POLICIES)!r}) as policy, unnest({list(quality.POLICIES.values())!r}) as mask)
select policy, rule, count(*) filter (where bits & mask <> 0)::bigint as rejected, count(*) filter (where bits & bit <> 0)::bigint as failing, count(*) filter (where bits & mask = bit)::bigint as alone from led, r, p where mask & bit <> 0 group by policy, rule
"""

SQL_BRANCHES = r"""
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn, role, text) as i from conversations where conv_id is not null),
f as (select text as opening, min(conv_id) as tree, arg_min(role, conv_id) as role from t where i = 1 group by 1),
m as (select t.conv_id, f.tree, t.i, case when t.i = 1 then f.role else t.role end as role, t.text from t join t as o on o.conv_id = t.conv_id and o.i = 1 join f on f.opening = o.text),
z as (select *, length(replace(replace(replace(text, '\', '\b'), '[', '\l'), '<', '\g')) + 2 * length(replace(replace(replace(replace(replace(role, '\', '\b'), '[', '\l'), '<', '\g'), ']', '\r'), '/', '\s')) + 7 + case when role = 'assistant' then 4 else 0 end as c from m),
b as (select tree, conv_id, count(*)::bigint as n_turns, avg(length(text)) as score, sum(c)::bigint as formatted_chars from z group by 1, 2),
k as (select *, case when n_turns = 1 then tree else conv_id end * 1000000 + n_turns as leaf, max(n_turns) over (partition by tree) as most from b),
r as (select *, row_number() over (partition by tree order by score desc, n_turns desc, leaf) as rn from k where n_turns > 1 or most = 1)
select tree, leaf, round(score, 6) as score, n_turns, formatted_chars from r where rn = 1
"""

SQL_OP6 = f"""
select doc_id, slot, ['{"', '".join(SHARDS)}'][{[x + 1 for x in sharding.fill(SHARDS)]}[slot + 1]] as shard
from (select doc_id, (('0x' || substr(sha256(doc_id::varchar), 1, 15))::bigint % {sharding.SLOTS})::int as slot from documents)
"""

SQL_OP10 = r"""
with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over (partition by text_sha256) as keep_id, count(*) over (partition by text_sha256)::bigint as group_size,
  doc_id = min(doc_id) over (partition by text_sha256) as kept, text_sha256 from d
"""

SQL_URL_RULES = r"""
with p as (select page_id, coalesce(url, '') as u from pages),
r as (select *, case when contains(u, '://') then substr(u, position('://' in u) + 3) else '' end as rest from p),
h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from r),
rules(verdict, rh, rp) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u as (select distinct host, path from h),
best as (select host, path, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(verdict, length(rh || rp)) as rule_verdict from u join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by 1, 2)
select page_id, h.host, h.path, rule, rule_verdict from h left join best on h.host = best.host and h.path = best.path
"""

#: The checksum of texts, bytewise with its table worked out by its rule.
SQL_CRC = """crc_table as (
  select list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
crc as (
  select key, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(key))), lambda i: ('0x' || substr(hex(encode(key)), 2 * i + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as h from keys, crc_table)"""

SQL_OP12 = rf"""
with recursive src as (select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
keys as (select distinct key from src),
{SQL_CRC},
dam as (
  select conv_id, turn, case when h % 20 = 4 then 'user' else coalesce(role, ' ') end as role,
    case h % 20 when 1 then '' when 2 then translate(coalesce(text, ' '), '.!?', '') else coalesce(text, ' ') end as text,
    unnest(range(case h % 20 when 0 then 0 when 3 then 2 else 1 end)) as copy
  from src join crc using (key)),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i, row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen from dam),
f as (
  select *, substr(role, 1, 1) as c, case when not regexp_matches(text, '[^ 	-
]') then 'b' when seen > 1 then 'd' when not regexp_matches(text, '[.!?][ 	-
]*$') then 't' else '' end as fault,
    lag(substr(role, 1, 1)) over (partition by conv_id order by i) as before
  from o),
stat as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (where fault = 'b')::bigint as blank, count(*) filter (where fault = 'd')::bigint as duplicate,
    count(*) filter (where fault = 't')::bigint as truncated, count(*) filter (where before is not null and before || c not in ('su', 'ua', 'au'))::bigint as illegal, count(*) as n
  from f group by conv_id),
-- grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a; s0..s3 are [cost, audit] of the best rest from row i on
dp as (
  select conv_id, n + 1 as i, {{'c': 0, 'a': ''}} as s0, {{'c': 10, 'a': 'II'}} as s1, {{'c': 5, 'a': 'I'}} as s2, {{'c': 0, 'a': ''}} as s3 from stat
  union all
  select conv_id, i, list_min([o0, {{'c': i2.c + 5, 'a': 'I' || i2.a}}]), list_min([o1, {{'c': i2.c + 5, 'a': 'I' || i2.a}}]), i2, i3 from (
    select *, list_min([o2, {{'c': o3.c + 5, 'a': 'I' || o3.a}}]) as i2, list_min([o3, {{'c': o2.c + 5, 'a': 'I' || o2.a}}]) as i3 from (
      select conv_id, i,
        list_min([{{'c': s0.c + 2, 'a': 'D' || s0.a}}, {{'c': s2.c + 1 + x, 'a': 'R' || s2.a}}, {{'c': case c when 'u' then s2.c when 's' then s1.c else 1000000000 end + x, 'a': 'K' || case c when 's' then s1.a else s2.a end}}]) as o0,
        list_min([{{'c': s1.c + 2, 'a': 'D' || s1.a}}, {{'c': s2.c + 1 + x, 'a': 'R' || s2.a}}, {{'c': case c when 'u' then s2.c else 1000000000 end + x, 'a': 'K' || s2.a}}]) as o1,
        list_min([{{'c': s2.c + 2, 'a': 'D' || s2.a}}, {{'c': s3.c + 1 + x, 'a': 'R' || s3.a}}, {{'c': case c when 'a' then s3.c else 1000000000 end + x, 'a': 'K' || s3.a}}]) as o2,
        list_min([{{'c': s3.c + 2, 'a': 'D' || s3.a}}, {{'c': s2.c + 1 + x, 'a': 'R' || s2.a}}, {{'c': case c when 'u' then s2.c else 1000000000 end + x, 'a': 'K' || s2.a}}]) as o3
      from (select dp.*, f.c, case f.fault when 't' then 5 when '' then 0 else 1000000000 end as x from dp join f on f.conv_id is not distinct from dp.conv_id and f.i = dp.i - 1) as z(conv_id, j, s0, s1, s2, s3, c, x), lateral (select j - 1 as i)))),
best as (select dp.conv_id, s0.c as cost, s0.a as audit from dp where i = 1),
walk as (
  select conv_id, audit, 0 as pos, 1 as i, 0 as state, null::varchar as line, 0 as q from best
  union all
  select w.conv_id, audit, pos + 1, w.i + (e <> 'I')::int, case when e = 'D' then state when e = 'K' and f.c = 's' then 1 when state = 2 then 3 else 2 end,
    case e when 'D' then null when 'K' then f.role || ':' || f.text when 'R' then case state when 2 then 'assistant' else 'user' end || ':' || f.text else case state when 2 then 'assistant' else 'user' end || ':' end, 0
  from (select *, substr(audit, pos + 1, 1) as e from walk where pos < length(audit)) as w left join f on f.conv_id is not distinct from w.conv_id and f.i = w.i),
text as (select conv_id, string_agg(line, chr(10) order by pos) filter (where line is not null) as t from walk group by conv_id)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal,
  coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit, sha256(coalesce(t, '')) as repaired_sha256
from (select distinct conv_id from conversations) as c left join stat on stat.conv_id is not distinct from c.conv_id left join best on best.conv_id is not distinct from c.conv_id left join text on text.conv_id is not distinct from c.conv_id
"""

SQL_OP13 = rf"""
with recursive runs as (select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{6,}}')) as r from documents),
low as (select id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as r, count(*) as n from runs group by 1, 2),
keys as (select id || ':' || r as key from low),
{SQL_CRC},
cut as (select case when h % 199 = 0 then substr(r, 1, (h % length(r))::int) || substr(r, (h % length(r))::int + 2) else r end as word, n from low join crc on key = id || ':' || r),
words as (select word, sum(n)::bigint as n from cut where length(word) >= 6 group by 1 having sum(n) >= 5),
gone as (select word, n, unnest(range(1, length(word) + 1)) as i, unnest(list_transform(range(1, length(word) + 1), lambda i: substr(word, 1, i::int - 1) || substr(word, i::int + 1))) as g from words),
pairs as (
  select a.word, b.word as other, b.n from gone as a join gone as b on a.g = b.g and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from gone as a join words as b on a.g = b.word
  union select a.word, b.word, b.n from words as a join gone as b on a.word = b.g),
near as (select word, count(*)::bigint as n_near, min({{'n': -n, 'w': other}}) as b from pairs group by 1),
forms as (select words.word, words.n, coalesce(n_near, 0)::bigint as n_near, case when -b.n >= 5 * words.n then b.w end as form, case when -b.n >= 5 * words.n then -b.n end::bigint as form_n from words left join near using (word)),
follow as (select word, word as root, form as next from forms union all select follow.word, f.word, f.form from follow join forms as f on f.word = follow.next)
select word, form, root, n, n_near, form_n from forms join (select word, root from follow where next is null) using (word)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_formatting": SQL_OP3, "op4_quality_rules": SQL_OP4, "op6_sharding": SQL_OP6, "op10_exact_dedup": SQL_OP10, "op12_conversation_repair": SQL_OP12, "op13_spelling_variants": SQL_OP13, "url_rules": SQL_URL_RULES, "quality_ablations": SQL_ABLATIONS, "ranked_branches": SQL_BRANCHES}
