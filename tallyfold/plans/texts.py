"""Queries over documents, pages, conversations and the benchmark: triage, mentions, keys and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, keys, names, numbers, terms, web
from ..functions.lexicon import Lexicon
from ..operators import coverage, reconcile, select, signals, triage
from ..sources.landing import written
from .common import query, quote, table

#: Vocabulary of the invented prose: its frequent tokens stand for brands, closures and so on.
PROSE = Lexicon(
    brands={"North": ["thtion", "nd of", "ertion"], "South": ["enschau", "lichung"], "West": ["tionoi", "ciónque"]},
    closure=["tionre", "heitver", "des les", "mente"], points=["of the"], partners=["in the"], conversions=["that the"], banking=["is the"], staff=["was of", "nicht"], branch="ing th", full_office="of the", postal_brand="Post",
)
CUES = ["de", "of", "in", "der", "the"]
FOLD = "strip_accents(lower({}))"


def folded(c: str) -> str:
    return FOLD.format(c)


def m(c: str, words: list[str]) -> str:
    return f"regexp_matches({c}, {quote(terms.alternation(words))})"


def sql_postal(c: str) -> str:
    return f"({m(c, PROSE.points)} and {m(c, PROSE.closure)} and (not {m(c, PROSE.partners)} or (contains({c}, '{PROSE.full_office}') and {m(c, PROSE.conversions)}) or {m(c, PROSE.banking)}))"


def sql_brand(c: str) -> str:
    return m(c, triage.spellings(PROSE))


def sql_places(c: str) -> str:
    spans = f"regexp_extract_all({c}, {quote(triage.place_pattern(CUES))}, 1)"
    items = f"flatten(list_transform({spans}, lambda z: regexp_split_to_array(substring(z, 1, {triage.MOST_SPAN}), ',\\s*|\\s+et\\s+')))"
    found = f"list_filter(list_transform({items}, lambda z: regexp_extract(trim(z), {quote('^(' + triage.PLACE_NAME + ')')}, 1)), lambda z: z <> '' and not regexp_matches(z, '\\d'))"
    return found


SENTENCES = "list_filter(list_transform(regexp_split_to_array({}, '[.!?\n]+'), lambda z: trim(z)), lambda z: z <> '')"


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles; the first 60 characters are the title."""
    return table(spark, sf_dir, "documents").select("doc_id", "lang", F.substring("text", 1, 60).alias("title"), "text")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.analyse(articles(spark, sf_dir), PROSE, cues=CUES)


_A = f"""a as (select doc_id, lang, substring(text, 1, 60) as title, text, {folded("substring(text, 1, 60)")} as ft, {folded("substring(text, 1, 60) || ' ' || text")} as fa,
  {SENTENCES.format("substring(text, 1, 60) || '. ' || text")} as sents from documents),
s0 as (select doc_id, unnest(sents) as s, generate_subscripts(sents, 1) as pos from a),
s1 as (select doc_id, pos, s, {folded("s")} as f, {sql_places("s")} as pl from s0),
s2 as (select doc_id, pos, s, pl, ({sql_brand("f")} and {m("f", PROSE.closure)}) or {sql_postal("f")} as strong, {sql_brand("f")} or {m("f", PROSE.closure)} or {sql_postal("f")} as weak from s1),
s3 as (select doc_id, pos, s, list_distinct(pl[1:{triage.MOST_PLACES}]) as pl, strong, weak, len(pl) as raw from s2),
s4 as (select doc_id, bool_or(strong and raw > 0) as hit, len(list_distinct(flatten(list(pl)))) as n_places, count(*) filter (weak) as n_relevant from s3 group by doc_id),
d as (select a.*, coalesce(hit, false) as hit, coalesce(n_places, 0) as n_places, coalesce(n_relevant, 0) as n_relevant from a left join s4 using (doc_id)),
e as (select *, ({sql_brand("fa")} and {m("fa", PROSE.closure)}) or {sql_postal("fa")} as is_relevant,
  (case when {sql_brand("ft")} and ({m("ft", PROSE.closure)} or contains(ft, '{PROSE.branch}')) then 3 else 0 end)
  + (case when {sql_postal("ft")} then 3 else 0 end) + (case when hit then 3 else 0 end) + (case when n_places >= 2 then 2 else 0 end)
  + (case when len(regexp_extract_all(title || ' ' || text, {quote(triage.DATE.replace("(?iu)", "(?i)"))})) > 0 then 2 else 0 end)
  + (case when len(regexp_extract_all(title || ' ' || text, {quote(triage.ADDRESS.replace("(?iu)", "(?i)"))})) > 0 then 1 else 0 end)
  - (case when not {sql_brand("fa")} and not {sql_postal("fa")} and not {m("fa", PROSE.closure)} then 3 else 0 end)
  - (case when {m("fa", PROSE.staff)} and not contains(fa, '{PROSE.branch}') then 2 else 0 end) as score from d)"""


@query(f"""with {_A} select lang, case when not is_relevant then 'irrelevant' when score <= -2 then 'weak_signal' else 'extract' end as outcome, count(*)::bigint as n from e group by 1, 2""")
def triage_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.recap(triage.route(scored(spark, sf_dir)), "lang")


@query(f"""with {_A} select doc_id, is_relevant, score::int as score, n_places::int as n_places, n_relevant::int as n_relevant from e""")
def triage_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("doc_id", "is_relevant", "score", F.size("places").alias("n_places"), F.size("relevant_sentences").alias("n_relevant"))


_KEY = "trim(regexp_replace(strip_accents(lower(replace(replace({}, '’', ''''), '‘', ''''))), '[\\s]+', ' ', 'g'))"


@query(f"""select doc_id, substr(sha256({_KEY.format("text")}), 1, 16) as key_hash, substr(sha256({_KEY.format("source")} || '|' || {_KEY.format("lang")} || '|closure'), 1, 16) as event_id from documents""")
def canonical_key_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", keys.text_hash(keys.canonical("text")).alias("key_hash"), keys.event_id("source", "lang", F.lit("closure")).alias("event_id"))


def _one_of(host: str, names: list[str]) -> str:
    return f"regexp_matches({host}, {quote('(^|[.])(' + '|'.join(n.replace('.', '[.]') for n in names) + ')$')})"


_HOSTS = [*web.TIER_A, *web.TIER_B, *web.TIER_C, *web.TIER_E, "prefet69.gouv.fr", "mairie-lyon.fr", "lamairie.org", "ma.bnpparibas.net", "www.google.com/maps", "maps.google.fr", "news.google.com", "unjournalinconnu.fr"]


@query(f"""with p as (select page_id, url from pages union all select -1 - page_id, 'https://' || {_HOSTS}[1 + page_id % {len(_HOSTS)}] || '/' || page_id from pages),
h as (select page_id, url, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)', 1)), '^\\.*(?:www\\.)?', '') as host, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)) as path from p)
select page_id, host, case when host = '' then 'D' when {_one_of("host", [*web.TIER_A, "gouv.fr"])} or contains(host, 'mairie') or contains(host, 'bnpparibas') then 'A' when {_one_of("host", web.TIER_B)} then 'B' when {_one_of("host", web.TIER_C)} then 'C' when {_one_of("host", web.TIER_E)} then 'E'
  when starts_with(host, 'maps.google.') or (contains(host, 'google.') and host <> 'news.google.com' and regexp_matches(path, 'maps|avis|reviews|business')) then 'E' else 'D' end as tier from h""")
def url_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers of the pages' URLs, and of one URL more for each page, at a host that a tier or a rule has."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host = F.get(F.array(*[F.lit(h) for h in _HOSTS]), (F.col("page_id") % len(_HOSTS)).cast("int"))
    more = pages.select((-1 - F.col("page_id")).alias("page_id"), F.concat(F.lit("https://"), host, F.lit("/"), F.col("page_id").cast("string")).alias("url"))
    return pages.unionByName(more).select("page_id", web.host("url").alias("host"), web.source_tier("url").alias("tier"))


_UNESC = "{}"
for _k, _v in web.REFERENCES.items():
    _UNESC = f"replace({_UNESC}, {quote(_k)}, {quote(_v)})"


_BARE = "html"
for _tag in ("script", "style", "nav", "footer", "head"):
    _BARE = f"regexp_replace({_BARE}, '(?is)<{_tag}[^>]*>.*?</{_tag}>', ' ', 'g')"


@query(f"""select page_id, trim(regexp_replace({_UNESC.format("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}, '\\s+', ' ', 'g')) as title, sha256(substring(trim(regexp_replace({_UNESC.format(f"regexp_replace({_BARE}, '(?s)<!--.*?-->|<[^>]*>', ' ', 'g')")}, '\\s+', ' ', 'g')), 1, 20000)) as text_hash from pages""")
def html_title_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", web.page_title("html").alias("title"), F.sha2(web.page_text("html"), 256).alias("text_hash"))


@query(f"""with s as (select doc_id, {SENTENCES.format("text")} as sents from documents)
select doc_id, len(sents)::int as n_sentences, len(list_filter(sents, lambda z: {m(folded("z"), PROSE.closure)}))::int as n_hits, sha256(array_to_string(sents, '|')) as joined from s""")
def sentence_split_relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("s", triage.sentences("text"))
    hits = F.filter("s", lambda x: terms.has_any(keys.fold(x), PROSE.closure))
    return d.select("doc_id", F.size("s").alias("n_sentences"), F.size(hits).alias("n_hits"), F.sha2(F.array_join("s", "|"), 256).alias("joined"))


MENTION = r"[A-Z][a-z]+ of [a-z]+"


@query(f"""select doc_id, len(regexp_extract_all(text, '{MENTION}'))::int as n_mentions, array_to_string(regexp_extract_all(text, '{MENTION}'), '|') as mentions from documents""")
def regex_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(MENTION), 0)
    return table(spark, sf_dir, "documents").select("doc_id", F.size(found).alias("n_mentions"), F.array_join(found, "|").alias("mentions"))


@query(f"""with p as (select doc_id, lang, text, list_filter(string_split(text, chr(10)), lambda z: {m(folded("z"), PROSE.closure)}) as kept from documents),
c as (select doc_id, lang || chr(10) || (case when len(kept) > 0 then array_to_string(kept, chr(10)) else text end) as t from p),
h as (select doc_id, t, left(t, 8000) as head from c),
x as (select doc_id, t, head, regexp_extract(head, '(?s)^(.*[.\\n])', 1) as upto from h)
select doc_id, case when length(t) <= 8000 then t when upto <> '' then upto else head end as context from x""")
def compact_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", triage.compact_context(F.col("lang"), F.col("text"), terms.alternation(PROSE.closure), 8_000, "\n").alias("context"))


_HOSTED = "regexp_replace(url, '^https?://', '')"


@query(f"""with u as (select 0 as source_rank, page_id, {_HOSTED} as url from pages union all select 1, page_id, {_HOSTED} from pages where url like 'https%' union all select 2, doc_id, '' from documents),
r as (select *, row_number() over (partition by url order by source_rank, to_json({{'page_id': page_id}})) as rn from u)
select url, source_rank::int as source_rank, page_id from r where rn = 1 and url <> '' union all select url, source_rank, page_id from u where url = ''""")
def url_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    bare = pages.select("page_id", F.regexp_replace("url", "^https?://", "").alias("url"))
    secure = pages.filter("url like 'https%'").select("page_id", F.regexp_replace("url", "^https?://", "").alias("url"))
    none = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), F.lit("").alias("url"))
    return triage.union_first([bare, secure, none]).select("url", "source_rank", "page_id")


@query("""with c as (select doc_id, case when quality = 1 then 'closure' when toxic = 1 then 'none' else 'error' end as status, (doc_id % 5)::int as attempts, timestamp '2024-01-15 00:00:00' + (doc_id % 7 - 3) * interval 1 day as retry_after from labels)
select d.doc_id, case when status = 'closure' then 'hit' when status = 'none' then 'none' when status = 'error' and (attempts >= 3 or timestamp '2024-01-15 00:00:00' < retry_after) then 'blocked' else 'process' end as state,
  timestamp '2024-01-15 00:00:00' + (3600 * pow(2, d.doc_id % 4)) * interval 1 second as again from documents d left join c using (doc_id)""")
def result_cache_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("2024-01-15 00:00:00").cast("timestamp")
    cache = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "closure").when(F.col("toxic") == 1, "none").otherwise("error").alias("status"), (F.col("doc_id") % 5).cast("int").alias("attempts"), F.timestamp_seconds(F.unix_seconds(now) + 86400 * (F.col("doc_id") % 7 - 3)).alias("retry_after"))
    state = reconcile.retry_state(table(spark, sf_dir, "documents").select("doc_id"), cache, ["doc_id"], now)
    return state.withColumn("again", reconcile.retry_after(now, F.col("doc_id") % 4 + 1))


@query("""with u as (select url from pages union all select 'https://tionsh.example.net/' || lang || '/' || doc_id from documents), s as (select distinct url from pages where url like 'https%')
select distinct u.url from u join s using (url)""")
def requeue_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    made = table(spark, sf_dir, "documents").select(F.concat(F.lit("https://tionsh.example.net/"), "lang", F.lit("/"), F.col("doc_id").cast("string")).alias("url"))
    return reconcile.requeue(pages.filter("url like 'https%'").select("url"), pages.select("url"), made)[0]


@query("""with w as (select item_id, list_distinct(list_filter(string_split(strip_accents(lower(text)), ' '), lambda z: length(z) > 3)) as tokens from benchmark),
p as (select page_id, strip_accents(lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1))) as t from pages),
j as (select item_id, page_id, len(list_filter(tokens, lambda z: contains(t, z))) / len(tokens)::double as share from w join p on len(tokens) > 0),
r as (select *, row_number() over (partition by item_id order by share desc, page_id) as rn from j where share >= 0.1)
select item_id, page_id, round(share, 6) as share from r where rn <= 5""")
def token_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.array_distinct(F.filter(F.split(keys.fold("text"), " "), lambda z: F.length(z) > 3))
    asked = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), tokens.alias("tokens"))
    title = keys.fold(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))
    entries = table(spark, sf_dir, "pages").select(F.col("page_id").alias("url"), title.alias("title_key"))
    return select.search(asked, entries, 0.1, 5).select(F.col("query_id").alias("item_id"), F.col("url").alias("page_id"), F.round("share", 6).alias("share"))


@query("""with g as (select conv_id, list({'turn': turn, 'role': role, 'text': text} order by turn) as items from conversations group by conv_id)
select conv_id, list_filter(list_transform(items, lambda x: x.role), lambda z: z <> '')[1] as first_role, substring(array_to_string(list_filter(list_transform(items, lambda x: x.text), lambda z: z <> ''), ' | '), 1, 500) as evidence, list_max(list_transform(items, lambda x: length(x.text)))::int as score from g""")
def signal_per_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct("turn", F.col("role").alias("bank"), F.lit(None).cast("string").alias("department"), F.col("text").alias("evidence"), F.length("text").alias("score"))
    grouped = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("url")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    one = signals.one_signal(grouped, "items")
    return one.select(F.col("url").alias("conv_id"), F.col("bank").alias("first_role"), "evidence", "score")


@query(f"""with p as (select doc_id, lang, list_filter(list_transform(flatten(list_transform(regexp_extract_all(text, {quote(triage.place_pattern(CUES))}, 1), lambda z: regexp_split_to_array(substring(z, 1, {triage.MOST_SPAN}), ',\\s*|\\s+et\\s+'))), lambda z: regexp_extract(trim(z), {quote('^(' + triage.PLACE_NAME + ')')}, 1)), lambda z: z <> '' and not regexp_matches(z, '\\d')) as pl from documents),
u as (select doc_id, unnest(pl) as place, generate_subscripts(pl, 1) as i from p),
f as (select doc_id, place, min(i) as i from u group by 1, 2),
r as (select doc_id, place, row_number() over (partition by doc_id order by i) - 1 as place_pos from f)
select doc_id, place_pos::int as place_pos, place, substr(sha256({_KEY.format("place")}), 1, 16) as place_id from r where place_pos < {triage.MOST_PLACES}""")
def plan_explosion(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("places", triage.places_of("text", CUES))
    return signals.per_place(d, "places", "doc_id").withColumn("place_id", keys.text_hash(keys.canonical("place")))


@query("""with t as (select conv_id, turn, greatest(1, length(text) // 4) as tokens from conversations),
r as (select conv_id, turn, sum(tokens * 0.2 / 1e6 + tokens * 1.25 / 1e6) over (partition by conv_id order by turn) as running from t)
select conv_id, turn, round(running, 9) as running_cost, round(running, 9) <= 0.0005 as admitted from r""")
def budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = numbers.token_estimate("text")
    calls = table(spark, sf_dir, "conversations").select("conv_id", "turn", numbers.cost(tokens, tokens, 0.2, 1.25).alias("cost"))
    out = reconcile.within_budget(calls, "conv_id", ["turn"], "cost", 0.0005)
    return out.select("conv_id", "turn", F.round("running_cost", 9).alias("running_cost"), (F.round("running_cost", 9) <= 0.0005).alias("admitted"))


@query("""with o as (select o_orderkey, o_orderdate::date as d from orders),
w as (select o_orderkey, d, case o_orderkey % 4 when 0 then strftime(d, '%Y-%m-%d') || 'T08:00:00Z' when 1 then strftime(d, '%a, %d %b %Y') || ' 23:30:00 -0200' when 2 then strftime(d, 'le %d/%m/%Y environ') else 'sans date' end as s from o)
select o_orderkey, case when s like '%-02-30%' then null when o_orderkey % 4 = 0 then d when o_orderkey % 4 = 1 then d + 1 else null end::date::varchar as article_day,
  case when o_orderkey % 4 = 0 then d when o_orderkey % 4 = 1 then d else null end::date::varchar as local_day,
  case when o_orderkey % 4 = 0 then d when o_orderkey % 4 = 2 then d else null end::date::varchar as listed_day from w""")
def written_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    s = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T08:00:00Z"))).when(F.col("o_orderkey") % 4 == 1, F.concat(F.date_format(d, "EEE, dd MMM yyyy"), F.lit(" 23:30:00 -0200"))).when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit("le "), F.date_format(d, "dd/MM/yyyy"), F.lit(" environ"))).otherwise("sans date")
    o = table(spark, sf_dir, "orders").select("o_orderkey", s.alias("s"))
    return o.select("o_orderkey", dates.article_date("s").cast("string").alias("article_day"), dates.article_date_local("s").cast("string").alias("local_day"), dates.listed_date("s").cast("string").alias("listed_day"))


_MONTHS_SQL = "[" + ", ".join(quote(x) for x in dates.MONTHS) + "]"


@query(f"""with o as (select o_orderkey, o_orderdate::date as d from orders),
w as (select o_orderkey, d, {_MONTHS_SQL}[month(d)] as mo, d - (o_orderkey % 20)::int as pub from o)
select o_orderkey, d::varchar as whole_day, (case when abs(date_diff('day', pub, make_date(year(pub), month(d), least(day(d), 28)))) <= 300 then make_date(year(pub), month(d), least(day(d), 28)) when make_date(year(pub), month(d), least(day(d), 28)) > pub then make_date(year(pub) - 1, month(d), least(day(d), 28)) else make_date(year(pub) + 1, month(d), least(day(d), 28)) end)::varchar as title_day, true as inferred from w""")
def title_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    month = F.get(F.array(*[F.lit(x) for x in dates.MONTHS]), F.month(d) - 1)
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws(" ", F.lit("fermeture le"), F.day(d), month, F.year(d)).alias("whole"), F.concat_ws(" ", F.lit("fermeture le"), F.least(F.day(d), F.lit(28)), month).alias("title"), F.date_sub(d, (F.col("o_orderkey") % 20).cast("int")).alias("pub"))
    t = dates.title_date("title", F.col("pub"))
    return o.select("o_orderkey", dates.text_date("whole").cast("string").alias("whole_day"), t["day"].cast("string").alias("title_day"), t["inferred"].alias("inferred"))


@query(f"""with b as (select item_id, {_KEY.format("text")} as k from benchmark), d as (select doc_id, {_KEY.format("text")} as t from documents),
hit as (select distinct item_id from b join d on contains(d.t, b.k)), first3 as (select distinct item_id from b join (select distinct word from (select unnest(string_split(t, ' ')) as word from d)) w on w.word = string_split(b.k, ' ')[1])
select item_id, case when item_id in (select item_id from hit) then 'mentioned' when item_id in (select item_id from first3) then 'word_known' else 'absent' end as status from b""")
def coverage_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark, sf_dir)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items by whether a document holds their whole text, or else their first word."""
    items = table(spark, sf_dir, "benchmark").select("item_id", keys.canonical("text").alias("k")).withColumn("first", F.get(F.split("k", " "), 0))
    docs = written(table(spark, sf_dir, "documents").select("doc_id", keys.canonical("text").alias("t")), "coverage-docs")  # read for words, items and whole texts
    hit = coverage.text_mentions(items, docs)
    words = select.among(docs.select(F.explode(F.array_distinct(F.split("t", " "))).alias("first")), "first", items).distinct()
    known = items.join(words.hint("merge"), "first", "left_semi")
    return coverage.first_rule(items, "item_id", (hit, "mentioned"), (known, "word_known"))


@query("""with s as (select unnest(['mentioned', 'word_known', 'absent', 'never']) as status), c as (
""" + """select item_id, case when item_id in (select b.item_id from b join d on contains(d.t, b.k)) then 'mentioned' when item_id in (select item_id from b join (select distinct word from (select unnest(string_split(t, ' ')) as word from d)) w on w.word = string_split(b.k, ' ')[1]) then 'word_known' else 'absent' end as status from b)
select s.status, count(c.item_id)::bigint as n, round(100.0 * count(c.item_id) / greatest((select count(*) from c), 1), 1) as share from s left join c using (status) group by s.status""".replace("from b)", "from b)"))
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    statuses = spark.createDataFrame([("mentioned",), ("word_known",), ("absent",), ("never",)], "status string")
    return coverage.summary(classified(spark, sf_dir), statuses)


from .common import SQL  # noqa: E402

SQL["coverage_summary"] = f"with b as (select item_id, {_KEY.format('text')} as k from benchmark), d as (select doc_id, {_KEY.format('text')} as t from documents), " + SQL["coverage_summary"].removeprefix("with ")


@query("""with e as (select event_id, user_id, (json_extract_string(props, '$.k'))::int as k, substr(sha256(coalesce(user_id::varchar, '') || '|' || coalesce(event_id::varchar, '')), 1, 16) as id from events)
select user_id, count(*) filter (where k between 0 and 49)::bigint as n_valid, count(*) filter (where not (k between 0 and 49))::bigint as n_invalid, sum(k)::bigint as total, min(id) as first_id from e group by user_id""")
def json_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = signals.parse(table(spark, sf_dir, "events"), "props", "k int", unit=[]).withColumn("valid", F.col("valid") & F.col("parsed.k").between(0, 49))
    return e.groupBy("user_id").agg(F.count_if("valid").alias("n_valid"), F.count_if(~F.col("valid")).alias("n_invalid"), F.sum("parsed.k").alias("total"), F.min(keys.content_id("user_id", "event_id")).alias("first_id"))


@query(f"""with d as (select doc_id, {folded("text")} as t from documents)
select doc_id, array_to_string(list_filter(['North', 'South', 'West', 'Post'], lambda b: (b = 'North' and {m("t", PROSE.brands["North"])}) or (b = 'South' and {m("t", PROSE.brands["South"])}) or (b = 'West' and {m("t", PROSE.brands["West"])}) or (b = 'Post' and {sql_postal("t")})), ',') as brands from d""")
def brands_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # read many times by brands_of, so that the optimizer leaves the fold a column of its own
    d = table(spark, sf_dir, "documents").withColumn("_fold", keys.fold("text"))
    d = d.select("doc_id", triage.brands_of(F.col("_fold"), PROSE).alias("found"))
    order = F.array_intersect(F.array(*[F.lit(b) for b in ("North", "South", "West", "Post")]), "found")
    return d.select("doc_id", F.array_join(order, ",").alias("brands"))


@query(f"""with d as (select doc_id, {folded("text")} as t from documents)
select doc_id, regexp_matches(t, {quote(f"(?s){terms.alternation(PROSE.closure)}.{{0,40}}{terms.alternation(PROSE.points)}|{terms.alternation(PROSE.points)}.{{0,40}}{terms.alternation(PROSE.closure)}")}) as is_near from d""")
def nearby_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", triage.near(keys.fold("text"), PROSE.closure, PROSE.points, 40).alias("is_near"))


@query("""with b as (select p_partkey, p_brand || ' ' || p_type as name from part), c as (select unnest(['Brand#1', 'Brand#11', 'Brand#2', 'Brand#25']) as canonical),
j as (select p_partkey, name, canonical, row_number() over (partition by p_partkey order by length(canonical) desc) as rn from b join c on trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) = regexp_replace(lower(canonical), '[^a-z0-9]+', ' ', 'g') or starts_with(trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')), regexp_replace(lower(canonical), '[^a-z0-9]+', ' ', 'g') || ' '))
select b.p_partkey, coalesce(j.canonical, trim(b.name)) as canonical_name from b left join j on b.p_partkey = j.p_partkey and rn = 1""")
def brand_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = names.alias_table(spark, {b: [b] for b in ("Brand#1", "Brand#11", "Brand#2", "Brand#25")})
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_brand", "p_type").alias("name"))
    return names.canonical_name(p, "name", aliases).select("p_partkey", "canonical_name")
