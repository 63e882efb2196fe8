"""Queries for the operators of the curation pipeline over the driver's tables, and their DuckDB SQL.

Documents stand in for posts, questions and answers; labels for scores; orders and lineitem for pools of examples.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import encoders, taxonomy
from ..functions import chat
from ..functions import text as tx
from ..operators import balance, coverage, gates, keyed, similarity, stats
from ..providers import Offline, ask_batch
from ..settings import Settings
from . import phases

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# ---- pages: URLs, ids, text

_URL = """case when regexp_extract(url, '^([^:/?#]+)://', 1) = '' then regexp_replace(regexp_extract(url, '^([^?#]*)', 1), '/+$', '') else
lower(regexp_extract(url, '^([^:/?#]+)://', 1)) || '://' || regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1)
|| regexp_replace(regexp_replace(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), ';[^/]*$', ''), '/+$', '') end"""


@query(f"select page_id, {_URL} url from pages")
def url_normalize(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", tx.normalize_url(F.col("url")).alias("url"))


@query(f"select min(page_id) page_id, url from (select page_id, {_URL} url from pages) group by url")
def url_dedup_first(spark, sf_dir):
    rows = url_normalize(spark, sf_dir)
    return keyed.keep_first(rows, F.col("url"), "page_id")


@query(f"select page_id, sha256({_URL}) id from pages")
def post_id(spark, sf_dir):
    return url_normalize(spark, sf_dir).select("page_id", tx.url_id(F.col("url")).alias("id"))


def _html_sql() -> str:
    out = "html"
    for pattern in tx._DROPPED:
        out = f"regexp_replace({out}, {_sql(pattern)}, '', 'g')"
    out = f"regexp_replace({out}, {_sql(tx._LINK)}, '[\\2](\\1)', 'g')"
    out = f"regexp_replace(regexp_replace({out}, '(?i)</t[dh]>', ' | ', 'g'), '(?i)</(p|div|h[1-6]|li|tr)>|<br\\s*/?>', chr(10), 'g')"
    out = f"regexp_replace(regexp_replace({out}, '<[^>]+>', ' ', 'g'), '[ \\t]+', ' ', 'g')"
    for entity, char in tx._ENTITIES[:-1]:
        out = f"replace({out}, {_sql(entity)}, {_sql(char)})"
    plain = f"replace({out}, '&amp;', '&')"
    numbered = f"list_reduce(list_prepend({out}, list_distinct(regexp_extract_all({out}, '&#([0-9]{{2,6}});', 1))), lambda s, n: replace(s, '&#' || n || ';', chr(n::int)))"
    out = f"case when regexp_matches({out}, '&#[0-9]{{2,6}};') then replace({numbered}, '&amp;', '&') else {plain} end"
    return f"nullif(trim(regexp_replace(regexp_replace({out}, ' ?\\n ?', chr(10), 'g'), '\\n{{2,}}', chr(10), 'g'), ' ' || chr(10)), '')"


@query(f"select page_id, markdown from (select page_id, {_html_sql()} markdown from pages) where markdown is not null")
def html_main_text(spark, sf_dir):
    rows = _t(spark, sf_dir, "pages").select("page_id", tx.html_text(F.col("html")).alias("markdown"))
    return rows.where(F.col("markdown").isNotNull())


def _meta_sql(name: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract(html, {_sql(p)}, {g}), '')" for p in tx.meta_patterns(name) for g in (1, 2)) + ")"


@query(
    "select page_id, coalesce(nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), ''), nullif(url, '')) title, "
    f"{_meta_sql('author')} author, coalesce({_meta_sql('date')}, 'undated') published from pages"
)
def page_metadata(spark, sf_dir):
    html = F.col("html")
    return _t(spark, sf_dir, "pages").select(
        "page_id", tx.first_filled(tx.html_title(html), F.col("url")).alias("title"), tx.html_meta(html, "author").alias("author"),
        tx.first_filled(tx.html_meta(html, "date"), F.lit("undated")).alias("published"),
    )


@query(
    f"""with x as (select page_id, {_html_sql()} m from pages)
select count(*) filter (m is not null and len(list_filter(regexp_split_to_array(m, '\\s+'), lambda w: w <> '')) >= 20) extracted,
count(*) filter (not coalesce(m is not null and len(list_filter(regexp_split_to_array(m, '\\s+'), lambda w: w <> '')) >= 20, false)) skipped from x"""
)
def extraction_counters(spark, sf_dir):
    rows = _t(spark, sf_dir, "pages").select(tx.html_text(F.col("html")).alias("m"))
    return stats.extraction_counters(rows, F.col("m").isNotNull() & (tx.word_count(F.col("m")) >= 20))


# ---- documents: words, filters, resume

_WORDS = "list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')"


@query(f"select * from (select doc_id, len({_WORDS}) word_count from documents) where word_count >= 300")
def word_count_filter(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select("doc_id", tx.word_count(F.col("text")).alias("word_count"))
    return rows.where(F.col("word_count") >= Settings().min_words)


@query(f"select doc_id, case when len({_WORDS}) > 4000 then array_to_string(({_WORDS})[1:4000], ' ') else text end as text from documents")
def truncate_words(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", tx.truncate_words(F.col("text"), Settings().truncate_words).alias("text"))


@query("select event_id, user_id from (select *, case when event_id % 10 = 0 then null else ts end t from events) where t is null or t >= (select min(ts) + interval 3 day from events)")
def since_filter(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").withColumn("t", F.when(F.col("event_id") % 10 != 0, F.col("ts")))
    start = rows.agg(F.min("ts").alias("first")).select((F.col("first") + F.expr("interval 3 days")).alias("start"))
    return keyed.since(rows.join(start), F.col("t"), F.col("start")).select("event_id", "user_id")


@query("select doc_id, lang from documents where doc_id not in (select doc_id from labels where doc_id is not null)")
def resume_anti_join(spark, sf_dir):
    return keyed.remaining(_t(spark, sf_dir, "documents"), "doc_id", _t(spark, sf_dir, "labels"), "doc_id").select("doc_id", "lang")


@query("select distinct doc_id from labels where doc_id is not null")
def processed_ids(spark, sf_dir):
    return keyed.processed_ids(_t(spark, sf_dir, "labels"), "doc_id")


@query("select count(*) n from (select unnest(string_split(text, chr(10))) line from documents) where trim(line) <> ''")
def count_nonblank(spark, sf_dir):
    lines = _t(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.where(F.trim("line") != "").agg(F.count("*").alias("n"))


@query("select doc_id, sha256(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) digest from documents")
def normalized_hash(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", tx.normalized_hash(F.col("text")).alias("digest"))


@query("select doc_id, lang from documents where doc_id not in (select doc_id from labels where doc_id is not null) order by doc_id limit 25")
def limit_after_resume(spark, sf_dir):
    """The limit counts rows that are still to be done."""
    rows = keyed.remaining(_t(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", _t(spark, sf_dir, "labels"), "doc_id")
    return keyed.first_rows(rows, 25, "doc_id")


# ---- taxonomy

@query("select p_partkey, p_type from part where p_type in (select p_type from (select p_type, row_number() over (order by p_type) r from part group by p_type) where r > 1)")
def taxonomy_filter(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    known = part.select(F.col("p_type").alias("name")).distinct()  # the types are the taxonomy here
    known = known.join(known.agg(F.min("name").alias("least"))).where(F.col("name") != F.col("least"))
    return keyed.in_taxonomy(part, "p_type", known).select("p_partkey", "p_type")


@query(
    "with k as (select p_type, 'parts of kind ' || lower(p_type) description from (select p_type, row_number() over (order by p_type) r from part group by p_type) where r > 1) "
    "select p_partkey, coalesce(description, part.p_type) description from part left join k using (p_type)"
)
def description_lookup(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    known = part.select("p_type").distinct()
    known = known.join(known.agg(F.min("p_type").alias("least"))).where(F.col("p_type") != F.col("least"))
    dimension = known.select(F.col("p_type").alias("name"), F.concat(F.lit("parts of kind "), F.lower("p_type")).alias("description"))
    return keyed.with_description(part, "p_type", dimension, "description").select("p_partkey", "description")


_DOMAIN_ROWS = ", ".join(f"({_sql(d)})" for d in taxonomy.DOMAINS)


@query(
    f"with dom(name) as (values {_DOMAIN_ROWS}), r as (select doc_id, name, row_number() over (partition by doc_id order by sha256('42:' || doc_id || ':' || name)) i from documents, dom) "
    "select doc_id, string_agg(name, ', ' order by i) domains from r where i <= 5 group by doc_id"
)
def domain_sample(spark, sf_dir):
    s = Settings()
    rows = keyed.seeded_sample(_t(spark, sf_dir, "documents").select("doc_id"), "doc_id", taxonomy.DOMAINS, s.domains_per_annotation, s.seed, "domains")
    return rows.select("doc_id", F.array_join("domains", ", ").alias("domains"))


@query("select doc_id, substring(sha256(doc_id || ':' || (doc_id % 8) || ':' || substring(text, 1, 50)), 1, 16) id from documents")
def question_ids(spark, sf_dir):
    doc = F.col("doc_id")
    return _t(spark, sf_dir, "documents").select("doc_id", tx.question_id(doc.cast("string"), doc % 8, F.col("text")).alias("id"))


@query("select distinct conv_id, substring(sha256('mt:' || conv_id), 1, 16) id from conversations")
def multi_turn_ids(spark, sf_dir):
    return _t(spark, sf_dir, "conversations").select("conv_id", tx.multi_turn_id(F.col("conv_id").cast("string")).alias("id")).distinct()


@query(
    "select doc_id, replace(replace(replace('Q: {question} of {domain} at {scale}', '{question}', text || ' {domain}'), '{domain}', coalesce(source, 'none')), '{scale}', lang) prompt from documents"
)
def prompt_fill(spark, sf_dir):
    question = F.concat("text", F.lit(" {domain}"))
    values = {"question": question, "domain": F.coalesce("source", F.lit("none")), "scale": F.col("lang")}
    return _t(spark, sf_dir, "documents").select("doc_id", tx.fill(F.lit("Q: {question} of {domain} at {scale}"), values).alias("prompt"))


_GROUND = """with l as (select doc_id post_id, quality, toxic, 0 pos from labels union all select doc_id, 1 - quality, toxic, 1 from labels where doc_id % 3 = 0),
last as (select post_id, arg_max(quality, pos) quality, arg_max(toxic, pos) toxic from l group by post_id)
select doc_id, case when post_id is null then 'unknown' else 'quality ' || quality end g_primitive,
case when post_id is null then 'none' when toxic = 1 then 'toxic, flagged' else 'none specified' end g_constraints,
case when post_id is null then 'none' else 'lesson ' || post_id end g_lesson from documents left join last on post_id = doc_id"""


@query(_GROUND)
def grounding_context(spark, sf_dir):
    order = [F.lit(1).cast("long").alias("batch"), F.lit(0).cast("long").alias("position")]
    labels = _t(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("post_id"), "quality", "toxic", *order)
    again = labels.where("post_id % 3 = 0").select("post_id", (1 - F.col("quality")).alias("quality"), "toxic", F.lit(2).cast("long").alias("batch"), "position")
    some = F.when(F.col("toxic") == 1, F.array(F.lit("toxic"), F.lit("flagged"))).otherwise(F.array().cast("array<string>"))
    annotations = labels.unionByName(again).select(
        "post_id", F.concat(F.lit("quality "), "quality").alias("primary_primitive"), some.alias("constraints"), some.alias("tradeoffs"), some.alias("failure_modes"),
        F.concat(F.lit("lesson "), "post_id").alias("domain_independent_lesson"), "batch", "position",
    )
    questions = _t(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("source_annotation_id"))
    return phases.grounded(questions, annotations).select("doc_id", "g_primitive", "g_constraints", "g_lesson")


@query(
    "with r as (select doc_id, text response, 1 batch, doc_id position from documents union all select doc_id, 'later ' || lang, 2, -doc_id from documents where lang is not null), "
    "l as (select *, row_number() over (partition by doc_id order by batch desc, position desc) i from r) select doc_id id, response from l where i = 1"
)
def pairs_last_wins(spark, sf_dir):
    """Answered questions with the response that was appended last, whatever its text."""
    docs = _t(spark, sf_dir, "documents")
    first = docs.select(F.col("doc_id").alias("question_id"), F.col("text").alias("response"), F.lit(1).cast("long").alias("batch"), F.col("doc_id").alias("position"))
    later = docs.where("lang is not null").select(F.col("doc_id").alias("question_id"), F.concat(F.lit("later "), "lang").alias("response"), F.lit(2).cast("long").alias("batch"), (-F.col("doc_id")).alias("position"))
    return phases.pairs(docs.select(F.col("doc_id").alias("id")), first.unionByName(later)).select("id", "response")


@query("select conv_id, turn, coalesce(lag(text) over (partition by conv_id order by turn), 'none') context from conversations where role = 'user'")
def prev_turn_context(spark, sf_dir):
    rows = _t(spark, sf_dir, "conversations").where("role = 'user'")
    return keyed.previous_user_turn(rows, "conv_id", "turn", "text").select("conv_id", "turn", "context")


@query("select doc_id from documents where not (trim(case when doc_id % 4 = 0 then '  ' else text end) = '' and trim(case when doc_id % 6 = 0 then '' else text end) = '')")
def blank_pair_drop(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 4 == 0, "  ").otherwise(F.col("text")).alias("a"), F.when(F.col("doc_id") % 6 == 0, "").otherwise(F.col("text")).alias("b")
    )
    return gates.drop_blank_pairs(rows, "a", "b").select("doc_id")


# ---- similarity and gates

#: The tables have no brand names and no near-duplicate vectors, so these make the checks decide something.
TEST_BRANDS = ["worthless", "pathetic", "que", "ist"]
TEST_LEADS = ["with the", "zu der"]
TEST_NEAR = 0.5

_SIM = """e as (select vec_id, embedding::double[] v from embeddings),
sim as (select a.vec_id, round(greatest(coalesce(max(list_cosine_similarity(a.v, b.v)), 0), 0), 6) max_sim from e a left join e b on a.vec_id <> b.vec_id group by a.vec_id)"""


@query(f"with {_SIM} select vec_id, max_sim from sim")
def near_dup_max_sim(spark, sf_dir):
    return similarity.max_similarity(_t(spark, sf_dir, "embeddings"), "vec_id", "embedding")


@query(f"with {_SIM} select vec_id from sim where max_sim < {TEST_NEAR}")
def near_dup_gate(spark, sf_dir):
    return near_dup_max_sim(spark, sf_dir).where(similarity.not_near_duplicate(F.col("max_sim"), TEST_NEAR)).select("vec_id")


_DUP = """h as (select doc_id, sha256(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g'))) digest from documents),
dup as (select doc_id, bool_or(i > 1) is_duplicate from (select doc_id, row_number() over (partition by digest order by doc_id) i from h) group by doc_id)"""


@query(f"with {_DUP} select doc_id, is_duplicate from dup")
def exact_dup_flags(spark, sf_dir):
    return keyed.duplicate_flags(_t(spark, sf_dir, "documents"), "doc_id", tx.normalized_hash(F.col("text")), "doc_id")


_BRAND = (
    f"case when regexp_matches(lower(text), {_sql(tx.allowed_pattern(TEST_LEADS))}) then null else coalesce("
    + ", ".join(f"case when regexp_matches(lower(text), {_sql(tx.brand_pattern([b]))}) then {_sql(b)} end" for b in TEST_BRANDS)
    + ") end"
)
_REASON = f"coalesce('Brand leak: ' || {_BRAND}, 'OK')"
_TOKENS = "len(regexp_extract_all(text, '\\pL+|\\pN{1,3}|[^\\s\\pL\\pN]+'))"


@query(f"select doc_id, {_REASON} reason, {_REASON} = 'OK' passed from documents")
def brand_check(spark, sf_dir):
    reason = tx.brand_reason(tx.brand_leak(F.col("text"), TEST_BRANDS, TEST_LEADS))
    return _t(spark, sf_dir, "documents").select("doc_id", reason.alias("reason"), (reason == "OK").alias("passed"))


@query(f"select * from (select doc_id, {_TOKENS} token_count from documents) where token_count >= 50")
def token_gate(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select("doc_id", tx.pre_token_count(F.col("text")).alias("token_count"))
    return rows.where(F.col("token_count") >= Settings().min_tokens)


def _flagged(spark, sf_dir) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    near = near_dup_max_sim(spark, sf_dir)
    return gates.flags(docs, "doc_id", "text", "text", near, Settings(near_duplicate=TEST_NEAR), TEST_BRANDS, TEST_LEADS)


_FLAGS = f"""with {_SIM}, {_DUP}, f as (select d.doc_id, {_TOKENS} token_count, coalesce(max_sim, 0) max_sim, is_duplicate, {_REASON} brand_reason
from documents d join dup using (doc_id) left join sim on vec_id = d.doc_id),
g as (select *, brand_reason = 'OK' and token_count >= 50 and not is_duplicate and max_sim < {TEST_NEAR} passed from f)"""


@query(f"{_FLAGS} select doc_id, token_count, is_duplicate, max_sim, brand_reason, passed from g")
def prefilter_gate(spark, sf_dir):
    return _flagged(spark, sf_dir).select("doc_id", "token_count", "is_duplicate", "max_sim", "brand_reason", gates.passes().alias("passed"))


@query(
    f"{_FLAGS} select count(*) total, count(*) filter (passed) passed, count(*) filter (brand_reason <> 'OK') rejected_brand, count(*) filter (token_count < 50) rejected_length, "
    f"count(*) filter (is_duplicate) rejected_duplicate, count(*) filter (max_sim >= {TEST_NEAR}) rejected_near_duplicate from g"
)
def prefilter_counters(spark, sf_dir):
    return gates.reject_counters(_flagged(spark, sf_dir))


_SCORE = "2.5 + quality + 0.25 * (doc_id % 5) - toxic"


@query(f"select doc_id, {_SCORE} score, {_SCORE} >= 3.5 accepted from labels")
def judge_accept(spark, sf_dir):
    score = F.lit(2.5) + F.col("quality") + 0.25 * (F.col("doc_id") % 5) - F.col("toxic")
    return _t(spark, sf_dir, "labels").select("doc_id", score.alias("score"), gates.accepted(score, Settings()).alias("accepted"))


# ---- coverage

_PAIRS = "pairs as (select {0} primitive, n_name domain from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey)"


def _pairs(spark, sf_dir, column: str) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem")
    rows = rows.join(_t(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).join(_t(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.join(_t(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select(F.expr(column).alias("primitive"), F.col("n_name").alias("domain"))


def _dimensions(spark, sf_dir, column: str) -> tuple[DataFrame, DataFrame]:
    names = _t(spark, sf_dir, "part").select(F.expr(column).alias("name")).distinct()
    return names, _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("position"), F.col("n_name").alias("name"))


#: Brand and size together are so many that some pairs with a nation are rare or missing, so that the rules find something.
_FINE = "p_brand || '/' || p_size"
_DENSE, _SPARSE = _PAIRS.format("p_type"), _PAIRS.format(_FINE)


@query(f"with {_DENSE} select primitive, domain, count(*) n from pairs group by 1, 2")
def coverage_matrix(spark, sf_dir):
    return coverage.matrix(_pairs(spark, sf_dir, "p_type"))


#: All of nation, a fixed table of 25 rows.
_NATIONS = tuple(f"NATION_{i}" for i in range(25))


@query(f"with {_DENSE} select primitive, " + ", ".join(f"count(*) filter (domain = '{c}') \"{c}\"" for c in _NATIONS) + ', count(*) "Total" from pairs group by 1')
def coverage_pivot(spark, sf_dir):
    """A column for every nation, and the total over all pairs."""
    return coverage.pivot(_pairs(spark, sf_dir, "p_type"), list(_NATIONS), total="Total")


_UNDER = f"""c as (select primitive, domain, count(*) n from pairs group by 1, 2), names as (select distinct {_FINE} primitive from part),
under as (select names.primitive, count(c.domain) domains_covered, string_agg(n_name, ',' order by n_nationkey) filter (c.domain is null) missing
from names cross join nation left join c on c.primitive = names.primitive and c.domain = n_name group by 1 having count(c.domain) < 15)"""


@query(f"with {_SPARSE}, {_UNDER} select primitive, domains_covered, coalesce(missing, '') missing from under")
def undercovered(spark, sf_dir):
    names, domains = _dimensions(spark, sf_dir, _FINE)
    found = coverage.undercovered(coverage.matrix(_pairs(spark, sf_dir, _FINE)), names, domains, 15)
    return found.withColumn("missing", F.array_join("missing", ","))


_GAPS = "gaps as (select names.primitive, coalesce(sum(n), 0)::bigint count, 25 required, (25 - coalesce(sum(n), 0))::bigint deficit from names left join c using (primitive) group by 1 having coalesce(sum(n), 0) < 25)"


@query(f"with {_SPARSE}, {_UNDER}, {_GAPS} select * from gaps")
def priority_gaps(spark, sf_dir):
    names, _ = _dimensions(spark, sf_dir, _FINE)
    return coverage.priority_gaps(coverage.matrix(_pairs(spark, sf_dir, _FINE)), names, 25)


_SKEW = "skew as (select domain, sum(n)::bigint count, round(sum(n) / (select sum(n) from c), 3) pct from c group by 1 having sum(n) / (select sum(n) from c) > 0.05)"


@query(f"with {_SPARSE}, {_UNDER}, {_SKEW} select * from skew")
def domain_imbalance(spark, sf_dir):
    return coverage.domain_imbalance(coverage.matrix(_pairs(spark, sf_dir, _FINE)), 0.05)


@query(
    f"""with {_SPARSE}, {_UNDER}, {_GAPS}, {_SKEW},
u as (select string_agg(primitive || ':' || domains_covered || '/15:' || coalesce(missing, ''), ';' order by primitive) undercovered, count(*) nu from under),
g as (select string_agg(primitive || ':' || count || '/25:' || deficit, ';' order by primitive) top10_gaps, count(*) ng from gaps),
d as (select string_agg(domain || ':' || count || ':' || round(1000 * pct)::int, ';' order by domain) domain_imbalances, count(*) nd from skew),
m as (select string_agg(primitive || ':' || domain || ':' || n, ';' order by primitive, domain) matrix from c)
select (select coalesce(sum(n), 0)::bigint from c) total_examples, (select count(distinct primitive) from c) unique_primitives, coalesce(undercovered, '') undercovered, coalesce(top10_gaps, '') top10_gaps,
coalesce(domain_imbalances, '') domain_imbalances, coalesce(matrix, '') matrix, nu + ng + nd = 0 passed from u, g, d, m"""
)
def coverage_report(spark, sf_dir):
    """The whole report, its lists and its matrix as text."""
    names, domains = _dimensions(spark, sf_dir, _FINE)
    settings = Settings(min_domains=15, min_priority_examples=25, max_domain_share=0.05)
    found = coverage.report(_pairs(spark, sf_dir, _FINE), names, domains, names, settings)

    def listed(column: str, line) -> Column:
        return F.array_join(F.transform(column, line), ";").alias(column.removesuffix("_primitives"))

    cells = F.flatten(F.transform(F.array_sort(F.map_keys("coverage_matrix")), lambda p: F.transform(F.array_sort(F.map_keys(F.col("coverage_matrix")[p])), lambda d: F.concat_ws(":", p, d, F.col("coverage_matrix")[p][d]))))
    return found.select(
        "total_examples", "unique_primitives",
        listed("undercovered_primitives", lambda x: F.concat_ws(":", x["primitive"], F.concat_ws("/", x["domains_covered"], x["required"]), F.array_join(x["missing_domains"], ","))),
        listed("top10_gaps", lambda x: F.concat_ws(":", x["primitive"], F.concat_ws("/", x["count"], x["required"]), x["deficit"])),
        listed("domain_imbalances", lambda x: F.concat_ws(":", x["domain"], x["count"], F.round(1000 * x["pct"]).cast("int"))), F.array_join(cells, ";").alias("matrix"), "passed",
    )


# ---- composition

#: Targets by order priority: one above its pool at small scales, one class left out.
WANTED = {"1-URGENT": 40, "2-HIGH": 60, "3-MEDIUM": 1_000_000, "4-NOT SPECIFIED": 25}
_WANTED_ROWS = ", ".join(f"({_sql(c)}, {i}, {n})" for i, (c, n) in enumerate(WANTED.items()))


@query("select * from (values " + ", ".join(f"({_sql(c)}, {i}, {n})" for i, (c, n) in enumerate(Settings().targets().items())) + ") t(complexity, position, target)")
def composition_targets(spark, sf_dir):
    return balance.targets(spark, Settings().targets())


@query(
    f"with w(complexity, position, target) as (values {_WANTED_ROWS}) select complexity, target, count(o_orderkey) available, least(count(o_orderkey), target) taken "
    "from w left join orders on o_orderpriority = complexity group by 1, 2"
)
def composition_shortfall(spark, sf_dir):
    return balance.shortfall(_t(spark, sf_dir, "orders"), balance.targets(spark, WANTED), "o_orderpriority")


def _pool(spark, sf_dir) -> DataFrame:
    customers = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    rows = _t(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("complexity"), F.col("c_mktsegment").alias("primitive"), F.col("o_orderstatus").alias("domain"), F.col("o_totalprice").alias("quality_score")
    )


def _balanced_sql(wanted_rows: str, seed: int = 42) -> str:
    return f"""w(complexity, position, target) as (values {wanted_rows}),
pool as (select o_orderkey id, o_orderpriority complexity, c_mktsegment primitive, o_orderstatus as domain, o_totalprice quality_score from orders join customer on o_custkey = c_custkey),
r as (select *, row_number() over (partition by complexity, primitive, domain order by quality_score desc, id) r from pool join w using (complexity)),
k as (select *, row_number() over (partition by complexity, primitive order by r, quality_score desc, id) k from r),
p as (select *, row_number() over (partition by complexity order by k, sha256('{seed}:' || complexity || ':' || primitive), quality_score desc, id) place from k),
chosen as (select * from p where place <= target)"""


@query(f"with {_balanced_sql(_WANTED_ROWS)} select id, complexity, primitive, domain, quality_score, position, place from chosen")
def balanced_sample(spark, sf_dir):
    return balance.balanced(_pool(spark, sf_dir), balance.targets(spark, WANTED), max(WANTED.values()), Settings().seed)


# ---- chat and export

_P = _sql(chat.PERSONA)


def _message_sql(role: str, content: str, channel: str | None = None) -> str:
    return f"struct_pack(role := '{role}', content := {content}, channel := {_sql(channel) if channel else 'null::varchar'})"


_RENDER = "array_to_string(list_transform({0}, lambda m: '<|start|>' || m.role || coalesce('<|channel|>' || m.channel, '') || '<|message|>' || m.content || '<|end|>'), '')"


#: First character after a third, and after two thirds, of a text: question, analysis and answer together hold all of it.
_THIRDS = ("(length(text) // 3 + 1)", "(length(text) // 3 * 2 + 1)")
_CHAT = "[" + ", ".join([
    _message_sql("developer", _P), _message_sql("user", f"substring(text, 1, {_THIRDS[0]} - 1)"),
    _message_sql("assistant", f"substring(text, {_THIRDS[0]}, {_THIRDS[1]} - {_THIRDS[0]})", "analysis"), _message_sql("assistant", f"substring(text, {_THIRDS[1]})", "final"),
]) + "]"


def _single(spark, sf_dir) -> DataFrame:
    t = F.col("text")
    third = F.floor(F.char_length(t) / 3).cast("int")
    messages = chat.single_turn(F.substring(t, F.lit(1), third), F.substring(t, third + 1, third), F.substring(t, third * 2 + 1, F.char_length(t)))
    return _t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", messages.alias("messages"))


@query(f"select doc_id, i position, m.role \"role\", m.content content, m.channel channel from (select doc_id, unnest({_CHAT}) m, unnest(range(4)) i from documents)")
def single_turn_chat(spark, sf_dir):
    rows = _single(spark, sf_dir).select("doc_id", F.posexplode("messages").alias("position", "m"))
    return rows.select("doc_id", "position", "m.role", "m.content", "m.channel")


_TURNS = """t as (select conv_id, turn, text, lead(text) over w answer, lead(role) over w next_role, role from conversations where role <> 'system' window w as (partition by conv_id order by turn)),
c as (select conv_id, list(struct_pack(u := text, a := answer) order by turn) turns from t where role = 'user' and next_role = 'assistant' group by conv_id),
m as (select conv_id, [{0}] || flatten(list_transform(turns, lambda x: [{1}, {2}, {3}])) messages from c)""".format(
    _message_sql("developer", _P), _message_sql("user", "x.u"), _message_sql("assistant", "'about ' || length(x.u)", "analysis"), _message_sql("assistant", "x.a", "final")
)


def _conversations(spark, sf_dir) -> DataFrame:
    """Conversations as turns; a user turn without an answer is left out."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = _t(spark, sf_dir, "conversations").where("role <> 'system'")
    rows = rows.withColumn("answer", F.lead("text").over(w)).withColumn("next_role", F.lead("role").over(w)).where("role = 'user' and next_role = 'assistant'")
    turn = F.struct("turn", F.col("text").alias("user"), F.concat(F.lit("about "), F.char_length("text")).alias("chain_of_thought"), F.col("answer").alias("response"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return turns.select("conv_id", chat.multi_turn(F.col("turns")).alias("messages"))


@query(f"with {_TURNS} select conv_id, len(messages) n_messages, {_RENDER.format('messages')} as text from m")
def multi_turn_chat(spark, sf_dir):
    return _conversations(spark, sf_dir).select("conv_id", F.size("messages").alias("n_messages"), chat.render(F.col("messages")).alias("text"))


@query(f"select doc_id, {_RENDER.format(_CHAT)} as text from documents")
def chat_template(spark, sf_dir):
    return _single(spark, sf_dir).select("doc_id", chat.render(F.col("messages")).alias("text"))


@query(f"with {_TURNS} select conv_id, count(*) trained, sum(length(z.content))::bigint trained_chars from (select conv_id, unnest(messages) z from m) where z.role = 'assistant' and z.channel = 'final' group by 1")
def response_mask(spark, sf_dir):
    masked = _conversations(spark, sf_dir).select("conv_id", F.filter(chat.response_mask(F.col("messages")), lambda m: m["train"]).alias("trained"))
    chars = F.aggregate("trained", F.lit(0).cast("long"), lambda s, m: s + F.char_length(m["content"]))
    return masked.select("conv_id", F.size("trained").alias("trained"), chars.alias("trained_chars"))


@query(
    f"with {_TURNS} select 'single' kind, doc_id id, lang \"domain\", source primitive, 4 n_messages, n_chars::double quality_score from documents "
    "union all select 'multi', conv_id, '', '', len(messages), 0.0 from m"
)
def export_union(spark, sf_dir):
    single = _single(spark, sf_dir).select(
        F.lit("single").alias("kind"), F.col("doc_id").alias("id"), F.col("lang").alias("domain"), F.col("source").alias("primitive"), F.size("messages").alias("n_messages"), F.col("n_chars").cast("double").alias("quality_score")
    )
    many = _conversations(spark, sf_dir).select(
        F.lit("multi").alias("kind"), F.col("conv_id").alias("id"), F.lit("").alias("domain"), F.lit("").alias("primitive"), F.size("messages").alias("n_messages"), F.lit(0.0).alias("quality_score")
    )
    return single.unionByName(many)


def _text_sql(column: str) -> str:
    return f"(select string_agg(v || '=' || n, ';' order by v || '=' || n) from (select coalesce({column}, '') v, count(*) n from chosen group by 1)) {column}_distribution"


@query(f"with {_balanced_sql(_WANTED_ROWS)} select count(*) total_examples, round(coalesce(avg(quality_score), 0), 6) avg_quality_score, {_text_sql('complexity')}, {_text_sql('primitive')}, {_text_sql('domain')} from chosen")
def export_meta(spark, sf_dir):
    return stats.sidecar(balanced_sample(spark, sf_dir))


@query(f"with {_balanced_sql(_WANTED_ROWS)} select complexity, count(*) n, round(100 * count(*) / (select count(*) from chosen), 1) pct from chosen group by 1")
def stats_complexity(spark, sf_dir):
    return stats.by_complexity(balanced_sample(spark, sf_dir))


@query(f"with {_DENSE} select primitive, count(*) n from pairs group by 1 order by n desc, primitive limit 15")
def stats_top15(spark, sf_dir):
    return stats.top(_pairs(spark, sf_dir, "p_type"), "primitive")


@query(f"with {_DENSE} select domain, substring(domain, 1, 8) short, count(*) n from pairs group by 1")
def stats_domains(spark, sf_dir):
    return stats.by_domain(_pairs(spark, sf_dir, "p_type"))


@query("select sum(event_id % 100)::bigint prompt_tokens, sum(user_id % 50)::bigint completion_tokens, count(*) calls, count(*) filter (event_id % 41 = 0) failed_calls, (sum(event_id % 100) + sum(user_id % 50))::bigint total_tokens from events")
def usage_summary(spark, sf_dir):
    calls = _t(spark, sf_dir, "events").select(
        (F.col("event_id") % 100).alias("prompt_tokens"), (F.col("user_id") % 50).alias("completion_tokens"), F.lit(1).alias("calls"), (F.col("event_id") % 41 == 0).cast("int").alias("failed_calls")
    )
    return stats.usage(calls)


# ---- phases with the offline provider

_NAMES = "[" + ", ".join(map(_sql, taxonomy.primitive_names())) + "]"
_ANNOTATE_SQL = "replace(replace({0}, '{{primitives}}', {1}), '{{content}}', case when len({2}) > 4000 then array_to_string(({2})[1:4000], ' ') else text end)".format(_sql(phases.ANNOTATE), _sql(", ".join(taxonomy.primitive_names())), _WORDS)
_ANNOTATED = f"""h as (select doc_id, source, sha256({_ANNOTATE_SQL}) h from documents where doc_id not in (select doc_id from labels where toxic = 1)),
a as (select doc_id::varchar post_id, ({_NAMES})[(('0x' || h[1:8])::bigint % {len(taxonomy.primitive_names())}) + 1] primary_primitive, 'constraint ' || h[1:6] constraints, 'tradeoff ' || h[7:12] tradeoffs, 'failure ' || h[13:18] failure_modes, 'lesson ' || h[1:12] domain_independent_lesson from h)"""


def _annotations(spark, sf_dir) -> DataFrame:
    docs = _t(spark, sf_dir, "documents")
    posts = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("url"), F.col("text").alias("markdown"))
    done = _t(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("post_id"))
    return phases.annotate(posts, done, Settings())


@query(f"with {_ANNOTATED} select post_id, primary_primitive, constraints, domain_independent_lesson from a")
def phase1_annotations(spark, sf_dir):
    return _annotations(spark, sf_dir).select("post_id", "primary_primitive", F.array_join("constraints", ", ").alias("constraints"), "domain_independent_lesson")


def _questions(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    annotations = _annotations(spark, sf_dir)
    done = spark.createDataFrame([], "source_annotation_id string")
    return annotations, *phases.generate_questions(annotations, done, Settings())


def _filled_sql(template: str, values: dict[str, str]) -> str:
    out = _sql(template)
    for slot, value in values.items():
        out = f"replace({out}, '{{{slot}}}', {value})"
    return out


_ABOUT = ", ".join(f"({_sql(n)}, {_sql(d)})" for ps in taxonomy.PRIMITIVES.values() for n, d, _ in ps)
_ASKED = f"""{_ANNOTATED}, about(name, description) as (values {_ABOUT}), dom(name) as (values {_DOMAIN_ROWS}),
ds as (select post_id, list(name order by i) domains from (select post_id, name, row_number() over (partition by post_id order by sha256('42:' || post_id || ':' || name)) i from a, dom) where i <= 5 group by post_id),
p as (select a.*, domains, sha256({_filled_sql(phases.QUESTIONS, {"primitive": "primary_primitive", "primitive_description": "description", "domain_independent_lesson": "domain_independent_lesson", "constraints": "constraints", "count": "'8'", "design_count": "'4'", "domains": "array_to_string(domains, ', ')"})}) d
  from a join about on name = primary_primitive join ds using (post_id)),
q as (select *, 'How would you build ' || d[8 * i + 1:8 * i + 8] || ' for ' || domains[i % 5 + 1] || '?' question, domains[i % 5 + 1] "domain", ({[*taxonomy.COMPOSITION][:5]})[i % 5 + 1] complexity from (select *, unnest(range(8)) i from p)),
questions as (select sha256(post_id || ':' || i || ':' || question[1:50])[1:16] id, post_id source_annotation_id, primary_primitive primitive, "domain", question, complexity, 0 evol_generation, i from q),
mt as (select *, sha256({_filled_sql(phases.TURNS, {"primitive": "primitive", "domain": '"domain"', "initial_question": "question"})}) t from questions where i = 0)"""


@query(f"with {_ASKED} select * exclude (i) from questions")
def phase2_questions(spark, sf_dir):
    return _questions(spark, sf_dir)[1]


@query(
    f"with {_ASKED} select sha256('mt:' || source_annotation_id)[1:16] id, source_annotation_id, primitive, \"domain\", "
    "question || '|And what of part ' || t[1:6] || '-0?|And what of part ' || t[1:6] || '-1?' turns, 'multi_turn' complexity, 0 evol_generation from mt"
)
def phase2_multi_turn(spark, sf_dir):
    return _questions(spark, sf_dir)[2].withColumn("turns", F.array_join("turns", "|"))


def _no_answers(spark) -> DataFrame:
    return spark.createDataFrame([], "question_id string")


_SLOTS = {"primitive": "primary_primitive", "constraints": "constraints", "tradeoffs": "tradeoffs", "failure_modes": "failure_modes", "lesson": "domain_independent_lesson"}
_REPLY = "'{0}: ' || array_to_string(list_transform(range(60), lambda k: {1}[k % 56 + 1:k % 56 + 8]), ' ')"


@query(
    f"""with {_ASKED}, x as (select id, question, a.*, sha256({_filled_sql(phases.ANALYSIS, _SLOTS | {"question": "question"})}) ha from questions join a on post_id = source_annotation_id),
y as (select *, {_REPLY.format("task analysis", "ha")} analysis from x), z as (select *, sha256({_filled_sql(phases.ANSWER, _SLOTS | {"analysis": "analysis", "question": "question"})}) hb from y)
select id question_id, analysis chain_of_thought, {_REPLY.format("task answer", "hb")} response from z"""
)
def phase3_responses(spark, sf_dir):
    annotations, questions, _ = _questions(spark, sf_dir)
    return phases.answer(questions, annotations, _no_answers(spark), Settings())


_ASIDE = "'TASK analysis' || chr(10) || 'Previous discussion: ' || {0} || chr(10) || 'Question: ' || {1}"


@query(
    f"""with {_ASKED}, mq as (select sha256('mt:' || source_annotation_id)[1:16] question_id, [question, 'And what of part ' || t[1:6] || '-0?', 'And what of part ' || t[1:6] || '-1?'] turns from mt),
e as (select question_id, i, turns[i + 1] u, case when i = 0 then 'none' else turns[i] end prior from (select *, unnest(range(3)) i from mq)),
told as (select *, sha256({_ASIDE.format("prior", "u")}) ha, sha256(u) hb from e)
select question_id, i position, u "user", {_REPLY.format("task analysis", "ha")} chain_of_thought, lower(u) || ': ' || array_to_string(list_transform(range(60), lambda k: hb[k % 56 + 1:k % 56 + 8]), ' ') response from told"""
)
def phase3_multi_turn(spark, sf_dir):
    annotations, _, multi = _questions(spark, sf_dir)
    answered = phases.answer_turns(multi, annotations, _no_answers(spark), Settings())
    return answered.select("question_id", F.posexplode("turns").alias("position", "t")).select("question_id", "position", "t.user", "t.chain_of_thought", "t.response")


_JUDGED = f"{_FLAGS}, s as (select *, round(3 + ('0x' || sha256({_filled_sql(phases.JUDGE, {'question': 'text', 'response': 'text'})})[1:4])::bigint % 200 / 100, 2) score from g join documents using (doc_id) where passed)"


@query(f"{_JUDGED} select doc_id::varchar question_id, true passed_brand_check, token_count, false is_duplicate, max_sim nearest_neighbor_sim, score llm_judge_score, score >= 3.5 accepted from s")
def phase4_judge(spark, sf_dir):
    flagged = _flagged(spark, sf_dir).where(gates.passes())
    rows = flagged.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("question"), F.col("text").alias("response"), "token_count", "max_sim")
    return phases.judge(rows, _no_answers(spark), Settings())


class Fragile(Offline):
    """Fails for every text whose length is a multiple of five."""

    def chat(self, messages, temperature, max_tokens):
        if len(messages[-1]["content"]) % 5 == 0:
            raise TimeoutError
        return "ask: " + hashlib.sha256(messages[-1]["content"].encode()).hexdigest()[:8]


@query("select doc_id, case when length(text) % 5 <> 0 then 'ask: ' || sha256(text)[1:8] end reply from documents")
def batch_completion(spark, sf_dir):
    """A failed call of a batch gives null and leaves the others."""
    rows = _t(spark, sf_dir, "documents").select("doc_id", "text")
    return ask_batch(rows, "", "text", "reply", lambda: Fragile("offline", attempts=1), 4).select("doc_id", "reply")


_TRIGRAMS = f"""u as (select conv_id || ':' || turn id, lower(text) t from conversations where role = 'user'),
g as (select id, ('0x' || md5(x)[1:4])::bigint % {encoders.DIMENSIONS} b from (select id, unnest(case when length(t) < 3 then [t] else list_transform(range(1, length(t) - 1), lambda i: substring(t, i, 3)) end) x from u)),
v as (select id, b, count(*)::double n from g group by 1, 2), size as (select id, sqrt(sum(n * n)) s from v group by 1),
dot as (select x.id a, y.id o, sum(x.n * y.n) d from v x join v y on x.b = y.b and x.id <> y.id group by 1, 2),
near as (select a id, max(d / (p.s * q.s)) best from dot join size p on p.id = a join size q on q.id = o group by 1)"""


@query(f"with {_TRIGRAMS} select id, round(greatest(coalesce(best, 0), 0), 6) max_sim, coalesce(best, 0) < 0.94 passed_near from u left join near using (id)")
def phase4_near_duplicates(spark, sf_dir):
    """The near-duplicate gate with the offline encoder, over the user turns."""
    rows = _t(spark, sf_dir, "conversations").where("role = 'user'").select(F.concat_ws(":", "conv_id", "turn").alias("id"), F.col("text").alias("question"))
    responses = rows.select(F.col("id").alias("question_id"), F.col("question").alias("response"))
    return phases.prefilter(rows, responses, Settings(), encoders.offline).select("id", "max_sim", "passed_near")
