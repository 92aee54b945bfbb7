"""Queries on sources and sinks: items in each source's own form, made of the tables, read back by the adapters.

The items are JSON or XML texts with all rows of a table, so the adapters parse what a landed page would hold.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import documents as docs
from ..functions import text as X
from ..operators import dedupe, enrich, filters, rank, render, sinks, state
from ..runtime import shared_dir, spread, table
from ..sources import items, pages, readers
from .core import _SQ, AS_OF

_ISO_PARTS = r"^[0-9]{4}(-[0-9]{1,2}){0,2}$"


def _parts(c: Column) -> Column:
    """date-parts of a full or partial dashed date, null for any other text."""
    x = F.trim(c)
    return F.when(x.rlike(_ISO_PARTS), F.struct(F.array(F.transform(F.split(x, "-"), lambda p: p.cast("int"))).alias("date-parts")))


def _works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """article_no, journal, item: published articles as registry items; the year is the date of issue."""
    a = table(spark, sf_dir, "journal_articles")
    names = F.transform("authors", lambda n: F.struct(F.regexp_extract(n, r"^(.*\S)\s+\S+$", 1).alias("given"), F.regexp_extract(n, r"(\S+)\s*$", 1).alias("family")))
    item = F.to_json(F.struct(
        F.col("doi").alias("DOI"), F.array("title").alias("title"), names.alias("author"), F.array("journal").alias("container-title"), _parts(F.col("published")).alias("published-print"),
        F.when(F.col("year").isNotNull(), F.struct(F.array(F.array("year")).alias("date-parts"))).alias("issued"), F.col("url").alias("URL"), F.concat(F.lit("<jats:p>"), "abstract", F.lit("</jats:p>")).alias("abstract"), "type",
    ))
    return a.select("article_no", "journal", F.from_json(item, readers.WORK).alias("item"))


def registry_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the simple registry scan, as payloads."""
    rows = items.registry_rows(_works(spark, sf_dir), F.col("item"), "top_journal", "article_no")
    out = items.of_source(items.payload(rows, "article_no"), "top3")
    return out.select("article_no", "id", "source", "title", F.array_join("authors", "; ").alias("authors"), "journal", "published", "abstract", "url")


_PARTS_OK = f"regexp_matches(trim(published), '{_ISO_PARTS}')"
_YMD = "case len(p) when 1 then try_cast(p[1] || '-01-01' as date) when 2 then try_cast(p[1] || '-' || lpad(p[2], 2, '0') || '-01' as date) else try_cast(p[1] || '-' || lpad(p[2], 2, '0') || '-' || lpad(p[3], 2, '0') as date) end"
_ARTICLE = f"""a as (select *, case when {_PARTS_OK} then string_split(trim(published), '-') end p from journal_articles),
b as (select *, coalesce(strftime({_YMD}, '%Y-%m-%d'), case when year is not null then lpad(year::varchar, 4, '0') || '-01-01' end) as iso_day from a)"""
_AUTHORS = f"array_to_string(list_filter(list_transform(coalesce(authors, []), lambda n: {_SQ.format('n')}), lambda n: n <> ''), '; ')"
_REGISTRY = rf"""with {_ARTICLE} select article_no, coalesce(doi, '') id, 'top3' source, coalesce(title, '') title, {_AUTHORS} authors, coalesce(journal, '') journal, coalesce(iso_day, '') published,
  coalesce({_SQ.format("regexp_replace(abstract, '<[^>]+>', ' ', 'g')")}, '') abstract, case when coalesce(doi, '') <> '' then 'https://doi.org/' || doi else '' end url from b"""


def journal_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked scan: articles, the first of each journal and key, 25 a journal."""
    rows = items.journal_rows(_works(spark, sf_dir), F.col("item"), "journal", F.col("journal"), "article_no", 25)
    return rows.select("article_no", "paper_id", "date", "link", "normalized_title")


_STATED = "case when p is not null then printf('%04d-%02d-%02d', p[1]::int, coalesce(p[2], '1')::int, coalesce(p[3], '1')::int) when year is not null then printf('%04d-01-01', year) end"
_JOURNALS = rf"""with {_ARTICLE}, t as (select *, coalesce(nullif(lower(trim(doi)), ''), nullif(url, ''), nullif(title, '')) k from b where coalesce(trim(type), '') in ('', 'journal-article')),
u as (select *, row_number() over (partition by journal order by article_no) n from (select *, row_number() over (partition by journal, coalesce(k, article_no::varchar) order by article_no) f from t) where f = 1),
c as (select *, {_SQ.format("regexp_replace(coalesce(title, ''), '<[^>]*>', ' ', 'g')")} tt from u where n <= 25)
select article_no, lower(coalesce(journal, '')) || ':' || coalesce(nullif(trim(doi), ''), nullif(trim(title), ''), substr(sha1(trim(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', ' ', 'g'))), 1, 16)) paper_id, {_STATED} date, coalesce(url, '') link,
  trim(regexp_replace(lower(replace(replace(replace(replace(replace(replace(tt, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')), '[^a-z0-9]+', ' ', 'g')) normalized_title from c"""


def preprint_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preprints among registry items (five marks), one for each id with all its finds, in the adaptive window, latest first."""
    p = table(spark, sf_dir, "papers")
    source = F.lower(F.trim(F.col("source")))
    item = F.to_json(F.struct(
        F.when(source == "openshelf", F.concat(F.lit("10.2139/SSRN."), F.col("row_no").cast("string"))).otherwise(F.col("paper_id")).alias("DOI"), F.array("title").alias("title"),
        F.array(F.when(source == "econdepot", "SSRN Journal").otherwise("none")).alias("container-title"), F.when(source == "journalfeed", "SSRN").alias("group-title"), F.col("link").alias("URL"),
        _parts(F.col("date")).alias("posted"), _parts(F.substring(F.col("fetched_at").cast("string"), 1, 10)).alias("deposited"), "abstract",
    ))
    group = F.coalesce(X.blank_to_null(F.get("query_groups", F.lit(0))), F.lit("none"))
    found = p.select("row_no", F.from_json(item, readers.WORK).alias("item"), group.alias("found_by"))
    rows = items.preprint_rows(found, F.col("item"), "row_no", "found_by")
    age = D.days_since(F.coalesce("recency_date", "date"), AS_OF)
    rows = filters.adaptive_window(rows, age, ["source"], 400, 1500, 40)
    return rows.orderBy(F.coalesce("recency_date", "date").desc_nulls_last(), F.col("paper_id").desc()).select("row_no", "paper_id", "date", "recency_date", F.array_join("query_groups", ",").alias("query_groups"))


_PREPRINTS = f"""with q as (select row_no, lower(trim(source)) s, paper_id, title, link, trim(date) d, strftime(fetched_at, '%Y-%m-%d') rec, coalesce(nullif(query_groups[1], ''), 'none') g from papers),
f as (select *, case when s = 'openshelf' then row_no::varchar else coalesce(regexp_extract(paper_id, '([^.]*)$', 1), '') end tail from q where s in ('openshelf', 'econdepot', 'journalfeed')),
i as (select *, 'ssrn:' || coalesce(nullif(trim(case when s <> 'openshelf' and coalesce(paper_id, '') = '' then title else tail end), ''), substr(sha1(trim(regexp_replace(lower(coalesce(title, '')), '[^a-z0-9]+', ' ', 'g'))), 1, 16)) id,
  case when regexp_matches(d, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') then printf('%04d-%02d-%02d', split_part(d, '-', 1)::int, split_part(d, '-', 2)::int, split_part(d, '-', 3)::int) end date from f),
o as (select id, min(row_no) row_no from i group by 1), gs as (select id, g, min(row_no) n from i group by 1, 2), gl as (select id, string_agg(g, ',' order by n) query_groups from gs group by 1),
r as (select i.row_no, i.id paper_id, i.date, rec recency_date, query_groups, date_diff('day', try_cast(coalesce(rec, i.date) as date), date '2025-06-30') age from o join i on i.id = o.id and i.row_no = o.row_no join gl on gl.id = o.id),
c as (select *, count_if(coalesce(age <= 400, true)) over () n from r)
select row_no, paper_id, date, recency_date, query_groups from c where coalesce(age <= 1500, true) and (coalesce(age <= 400, true) or n < 40)"""


def scholar_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of a scholarly graph made of the papers: ids by precedence, finds merged."""
    p = table(spark, sf_dir, "papers")
    own = F.when(F.col("source_handler") != "", F.col("paper_id"))
    item = F.to_json(F.struct(own.alias("paperId"), "title", F.transform("authors", lambda n: F.struct(n.alias("name"))).alias("authors"), "abstract", F.col("date").alias("publicationDate"), F.struct(F.when(F.lower(F.trim("source")) == "openshelf", F.col("canonical_url")).alias("DOI")).alias("externalIds")))
    found = p.select("row_no", F.from_json(item, readers.SCHOLAR).alias("item"), F.coalesce("source_handler", F.lit("none")).alias("found_by"))
    rows = items.scholar_rows(found, F.col("item"), "row_no", "found_by")
    return rows.select("row_no", "paper_id", "date", "link", F.array_join("authors", "; ").alias("authors"), F.array_join("query_groups", ",").alias("query_groups"))


_SCHOLAR = rf"""with q as (select row_no, {_SQ.format("coalesce(title, '')")} t, case when source_handler <> '' then coalesce(trim(paper_id), '') else '' end own, case when lower(trim(source)) = 'openshelf' then nullif(canonical_url, '') end doi, {_SQ.format('date')} d, authors, coalesce(source_handler, 'none') g from papers),
i as (select *, 'semanticscholar:' || trim(coalesce(doi, nullif(own, ''), t)) id from q where t <> ''), o as (select id, min(row_no) row_no from i group by 1),
gs as (select id, g, min(row_no) n from i group by 1, 2), gl as (select id, string_agg(g, ',' order by n) query_groups from gs group by 1)
select i.row_no, i.id paper_id, nullif(d, '') date, case when own <> '' then 'https://www.semanticscholar.org/paper/' || own else '' end link, {_AUTHORS} authors, query_groups from o join i on i.id = o.id and i.row_no = o.row_no join gl on gl.id = o.id"""


def atom_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed entries made of the parts: id with its version, page link, date of the update."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    xml = F.concat(
        F.lit("<entry><id>http://feed.example/abs/"), key, F.lit("v1/</id><title> "), F.col("p_name"), F.lit("\n</title><summary>"), F.col("p_type"), F.lit("</summary><published>2024-01-02T00:00:00Z</published><updated>"),
        F.when(F.col("p_size") > 25, "2024-03-04T05:06:07Z").otherwise(""), F.lit("</updated><author><name>"), F.col("p_type"), F.lit("</name></author><author><name>"), F.col("p_brand"), F.lit('</name></author><link href="http://feed.example/pdf/'), key,
        F.lit('" rel="related" type="application/pdf"/><link href="'), F.when(F.col("p_size") > 10, F.concat(F.lit("http://feed.example/page/"), key)).otherwise(""), F.lit('" rel="alternate" type="text/html"/></entry>'),
    )
    found = spread(p).select("p_partkey", F.from_xml(xml, readers.ENTRY).alias("entry"), F.lit("parts").alias("found_by"))
    rows = items.atom_rows(found, F.col("entry"), "p_partkey", "found_by")
    return rows.select("p_partkey", "paper_id", "title", "date", "link", F.array_join("authors", "; ").alias("authors"))


_ATOM = f"""select p_partkey, 'arxiv:' || p_partkey || 'v1' paper_id, {_SQ.format('p_name')} title, case when p_size > 25 then '2024-03-04' else '2024-01-02' end date,
  case when p_size > 10 then 'http://feed.example/page/' || p_partkey else 'http://feed.example/abs/' || p_partkey || 'v1/' end link, p_type || '; ' || p_brand authors from part"""


def _bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), table(spark, sf_dir, "supplier")
    w = lambda c: F.concat(F.lit("w"), c.cast("string"))
    o = o.select(w(F.col("o_custkey")).alias("paper"), F.col("o_orderkey").alias("nth"), F.col("o_orderpriority").alias("name"), F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("issue_date"))
    titles = c.select(w(F.col("c_custkey")).alias("paper"), F.col("c_custkey").alias("nth"), F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise("").alias("title"))
    authors = o.select("paper", "nth", F.concat("name", F.lit(", "), F.col("o_orderstatus"), F.lit(",")).alias("name"))
    refs = s.select(F.col("s_suppkey").cast("string").alias("paper"), F.col("s_suppkey").alias("nth"), F.col("s_name").alias("title"), F.lit("1999-05-06").alias("issue_date"), F.concat(F.lit("10.1/"), F.col("s_suppkey").cast("string")).alias("doi"), F.concat(F.lit("Ref A, "), "s_name").alias("author"))
    return items.bulk_merge(titles, authors, o.select("paper", "nth", "issue_date"), titles.select("paper", "nth", F.col("title").alias("abstract")), refs)


def bulk_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers merged from five bulk tables: titles, authors, dates, abstracts and references."""
    return items.bulk_rows(_bulk(spark, sf_dir)).select("paper", "paper_id", "title", F.array_join("authors", "; ").alias("authors"), "date", "doi", "abstract", "link")


def bulk_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 80 latest bulk papers."""
    return items.bulk_rows(_bulk(spark, sf_dir), 80).select(F.col("place").cast("bigint").alias("place"), "paper", "date")


_BULK_CTES = """with ti as (select c_custkey k, case when c_acctbal > 0 then c_name else '' end t from customer),
an as (select o_custkey k, o_orderkey n, unnest([o_orderpriority, o_orderstatus]) v, unnest([0, 1]) i from orders), am as (select k, v, min((n, i)) o from an where v <> '' group by 1, 2), au as (select k, string_agg(v, '; ' order by o) a from am group by 1),
da as (select o_custkey k, arg_max(strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) d from orders group by 1),
m as (select coalesce(ti.k, da.k, s_suppkey) k, coalesce(nullif(t, ''), s_name, '') title, coalesce(a, case when s_suppkey is not null then 'Ref A; ' || s_name end, '') authors, coalesce(d, case when s_suppkey is not null then '1999-05-06' end, '') published, coalesce('10.1/' || s_suppkey, '') doi, coalesce(t, '') abstract
  from ti full outer join da on da.k = ti.k left join au on au.k = coalesce(ti.k, da.k) full outer join supplier on s_suppkey = coalesce(ti.k, da.k))"""
_BULK = _BULK_CTES + " select k::varchar paper, 'nber:' || k paper_id, coalesce(nullif(title, ''), k::varchar) title, authors, nullif(published, '') date, doi, nullif(abstract, '') abstract, 'https://www.nber.org/papers/w' || k link from m"
_LATEST = _BULK_CTES + " select row_number() over (order by published desc, k::varchar desc) place, k::varchar paper, nullif(published, '') date from m order by place limit 80"


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of nations by region, written as landed files and read back through their cursors."""
    folder = f"{shared_dir(spark)}/folioflow/pages-{uuid.uuid4().hex}"
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", "n_name")
    page = n.groupBy("n_regionkey", F.floor(F.col("n_nationkey") / 10).alias("page")).agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("items"))
    text = F.to_json(F.struct("items", F.concat(F.lit("c"), F.col("page").cast("string")).alias("next")))
    page.select(F.concat(F.lit("region"), F.col("n_regionkey").cast("string"), F.lit("-"), F.col("page").cast("string"), F.lit(".json")).alias("path"), text.alias("value")).write.parquet(folder)
    got = pages.pages(spark.read.parquet(folder).select(F.concat(F.lit("/"), "path").alias("path"), "value"))
    return got.select("stream", "page", F.explode("items").alias("item")).select("stream", F.col("page").cast("bigint").alias("page"), F.get_json_object("item", "$.n_nationkey").cast("bigint").alias("n_nationkey"), F.get_json_object("item", "$.n_name").alias("n_name"))


_PAGES = "select 'region' || n_regionkey stream, (n_nationkey // 10)::bigint page, n_nationkey::bigint n_nationkey, n_name from nation"


def json_lines_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered records written as JSON lines and read back."""
    path = f"{shared_dir(spark)}/folioflow/lines-{uuid.uuid4().hex}"
    a = table(spark, sf_dir, "accepted_papers").select("hist_no", "paper_id", "title", "date", "link")
    sinks.write_json_lines(a, path)
    return readers.json_lines(spark, path, a.schema)


def payload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as payloads by alias and back to records."""
    p = items.payload(table(spark, sf_dir, "journal_articles"), "article_no")
    return items.from_payload(p, "article_no").select("article_no", "paper_id", "source", "date", "canonical_url")


_PAYLOADS = """with a as (select article_no, case lower(trim(coalesce(source, ''))) when 'top_journal' then 'top3' when 'econ5_journal' then 'econ5' else lower(trim(coalesce(source, ''))) end source, trim(coalesce(id, ''), ' ' || chr(9)) i, trim(coalesce(doi, '')) doi, coalesce(title, '') title, coalesce(nullif(published, ''), year::varchar, '') d, trim(coalesce(url, '')) u from journal_articles)
select article_no, source || ':' || coalesce(nullif(i, ''), nullif(doi, ''), substr(sha1(trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'))), 1, 16)) paper_id, source, nullif(trim(d), '') date,
  case when u <> '' then case when regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.-]*:') then lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || substr(regexp_replace(u, '(?s)[?#].*$', ''), length(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) + 1) else u end end canonical_url from a"""


def seen_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state that deliveries leave: every key of every record in the common and the task's scope, the latest push of each."""
    a = table(spark, sf_dir, "accepted_papers")
    s = state.latest_seen(state.seen_records(a.withColumn("date", F.coalesce("date", F.lit(""))), F.coalesce("task_name", F.lit("")), F.col("pushed_at")))
    return s.select("scope", "key_kind", "key", F.unix_micros(F.to_utc_timestamp(F.col("pushed_at").cast("timestamp"), "UTC")).alias("pushed"))


_SEEN = """with k as (select unnest(['paper_id', 'canonical_url', 'normalized_title']) key_kind, unnest([paper_id, canonical_url, normalized_title]) as key, coalesce(task_name, '') t, pushed_at from accepted_papers)
select scope, key_kind, key, max(epoch_us(pushed_at)) pushed from (select 'all' as scope, * from k union all select 'task:' || t, * from k) where key <> '' group by 1, 2, 3"""


def commit_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered ids after a commit of the incoming payloads."""
    rows = lambda t: table(spark, sf_dir, t).select(F.lower(F.trim("source")).alias("source"), F.col("paper_id").alias("id"))
    return state.committed(rows("accepted_papers"), rows("incoming_papers"), "openshelf")


_CLEAN = r"regexp_replace(paper_id, '^[\t-\r\x1c-\x20\x{85}\p{Z}]+|[\t-\r\x1c-\x20\x{85}\p{Z}]+$', '', 'g')"
_COMMIT = f"select distinct source, id from (select lower(trim(source)) source, {_CLEAN} id from accepted_papers union all select * from (select lower(trim(source)) source, {_CLEAN} id from incoming_papers) where source = 'openshelf') where id <> '' and upper(id) not in ('NULL', 'NONE', 'N/A', 'NA')"


def prompt_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of the 60 latest records, eight at a time."""
    p = table(spark, sf_dir, "papers").select("row_no", "paper_id", "title", "source", "date", "query_groups", "abstract").orderBy(F.col("row_no").desc()).limit(60)
    text = enrich.prompt(F.col("paper_id"), F.col("title"), F.col("source"), F.col("date"), F.coalesce("query_groups", F.array().cast("array<string>")), F.col("abstract"))
    ranked = rank.numbered(p.withColumn("text", text), [F.col("row_no").desc()])
    return enrich.batch_prompts(ranked, "place", "text", 8, "Judge each record.")


_PROMPTS = """with p as (select *, row_number() over (order by row_no desc) place from (select * from papers order by row_no desc limit 60)),
t as (select place, 'paper_id: ' || coalesce(paper_id, '') || chr(10) || 'title: ' || coalesce(title, '') || chr(10) || 'source: ' || coalesce(source, '') || chr(10) || 'date: ' || coalesce(nullif(date, ''), 'unknown') || chr(10)
  || 'query_groups: ' || coalesce(nullif(array_to_string(list_filter(coalesce(query_groups, []), lambda g: g is not null), ', '), ''), 'unknown') || chr(10) || 'abstract: ' || coalesce(nullif(abstract, ''), 'abstract missing') x from p)
select ((place - 1) // 8)::bigint batch, 'Judge each record.' || chr(10) || chr(10) || string_agg(x, chr(10) || chr(10) order by place) prompt, count(*) records from t group by 1"""


def translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with translations, notes and their fallbacks; answers are a stored backend's, for rows whose source handler is known."""
    p = table(spark, sf_dir, "papers").select("row_no", "title", "abstract", "source", "date", "source_handler")
    said = F.when(F.length("abstract") > 900, F.lit("短")).otherwise(F.concat(F.lit("本文研究LLM；"), F.coalesce("title", F.lit(""))))
    answers = p.where("source_handler <> ''").select("row_no", F.to_json(F.struct(said.alias("translation"))).alias("answer"))
    return enrich.with_translations(p, answers, "row_no").select("row_no", "translated", "note")


def agent_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of answers in three shapes, made of each record's title, source and date."""
    p = table(spark, sf_dir, "papers")
    said = lambda c: F.struct(F.col(c).alias("content"))
    shapes = F.array(
        F.to_json(F.struct(F.struct(F.array(F.struct(F.col("title").alias("text"), F.lit(None).cast("struct<reply:string>").alias("content")), F.struct(F.lit(" ").alias("text"), F.struct(F.col("source").alias("reply")).alias("content"))).alias("payloads")).alias("result"))),
        F.to_json(F.struct(F.array(said("title"), said("date")).alias("messages"))),
        F.to_json(F.struct(F.col("title").alias("reply"), F.col("source").alias("message"))),
    )
    return spread(p.select("row_no", F.get(shapes, F.pmod("row_no", F.lit(3)).cast("int")).alias("answer"))).select("row_no", docs.answer_text("answer").alias("text"))


_STRIP = r"nullif(regexp_replace({0}, '^[\t-\r\x1c-\x20\x{{85}}\p{{Z}}]+|[\t-\r\x1c-\x20\x{{85}}\p{{Z}}]+$', '', 'g'), '')"
_AGENT = f"""with p as (select row_no, {_STRIP.format('title')} t, {_STRIP.format('source')} s, {_STRIP.format('date')} d from papers)
select row_no, nullif(case row_no % 3 when 0 then concat_ws(chr(10), t, s) when 1 then concat_ws(chr(10), t, d) else coalesce(t, s) end, '') as text from p"""


def page_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute links and meta values of pages built from records, all links of each."""
    p = table(spark, sf_dir, "papers")
    href = lambda c: F.concat(F.lit('<a href="'), F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit('">x</a>'))
    html = F.concat(F.lit('<meta name="Author" content="a"><meta property="citation_author" content="b"><meta itemprop="author" content=" c  d ">'), href(F.lit("../up?q=1")), href(F.lit("//cdn.example/x")), href(F.lit("/root")), href(F.lit("#part")), href(F.lit("/root")), href(F.lit("mailto:a@b")))
    g = spread(p.select("row_no")).select("row_no", docs.page(html).alias("g"))
    base = F.concat(F.lit("https://site.example/dir/page"), F.col("row_no").cast("string"), F.lit("?v=2#top"))
    return g.select("row_no", F.array_join(docs.links_like(F.col("g"), base, "^https?:"), " ").alias("links"), F.array_join(docs.meta_values(F.col("g"), "citation_author", "author"), "|").alias("authors"))


_PAGE_PARTS = """select row_no, 'https://site.example/dir/../up?q=1 https://cdn.example/x https://site.example/root https://site.example/dir/page' || row_no || '?v=2#part' links, 'b|a|c  d' authors from papers"""


def digest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every source that was ever delivered, with what was pushed in the last three days; empty ones say so."""
    a = table(spark, sf_dir, "accepted_papers").withColumn("source", F.lower(F.trim("source")))
    last = a.agg(F.max(F.to_date("pushed_at")).alias("last"))
    new = a.join(F.broadcast(last)).where(F.to_date("pushed_at") > F.date_sub("last", 3))
    places = new.groupBy("source").agg(F.count("*").alias("records"), F.concat(F.lit("# Digest: "), F.first("source"), F.lit("\n\n"), F.array_join(F.array_sort(F.collect_list(F.coalesce("title", F.lit("untitled")))), "\n")).alias("markdown"))
    return render.with_empty(places, a.where("source is not null"), ["source"])


_DIGEST_ALL = """with a as (select *, lower(trim(source)) s from accepted_papers), l as (select max(pushed_at::date) d from a),
n as (select s, count(*) records, '# Digest: ' || s || chr(10) || chr(10) || string_agg(coalesce(title, 'untitled'), chr(10) order by coalesce(title, 'untitled')) markdown from a where pushed_at::date > (select d from l) - 3 group by 1)
select s source, coalesce(records, 0) records, coalesce(markdown, '# Digest: ' || s || chr(10) || chr(10) || 'No new records today.') markdown from (select distinct s from a where s is not null) left join n using (s)"""


def archive_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive, latest issue first, in it by time of push and place."""
    a = table(spark, sf_dir, "accepted_papers").withColumn("issue", F.to_date("pushed_at"))
    return rank.numbered(a, render.archive_order(F.col("issue"), F.col("pushed_at"), F.col("hist_no"))).select(F.col("place").cast("bigint").alias("place"), "hist_no")


def text_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs, first texts, wiki tokens, sections, halves rounded to even, of all parts."""
    p = table(spark, sf_dir, "part")
    key = F.concat(F.lit("parts-"), F.col("p_partkey").cast("string"))
    return spread(p).select(
        "p_partkey", X.slug(F.col("p_name")).alias("slug"), X.first_text(F.lit(" "), F.lit(None).cast("string"), F.col("p_type")).alias("first_text"), X.wiki_token(F.concat(F.lit("https://x.example/wiki/"), F.col("p_brand"), F.lit("?a"))).alias("token"),
        sinks.section(F.lit("Parts"), F.lit("parts"), key, F.concat("p_type", F.lit("\n\n"))).alias("section"), docs.rounded(F.col("p_size") / 16).alias("rounded"),
    )


_HELPERS = """select p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') slug, p_type first_text, regexp_extract(p_brand, '^[A-Za-z0-9]+') token,
  '## Parts | ' || p_partkey || chr(10) || chr(10) || p_type || chr(10) || chr(10) || '---' || chr(10) || chr(10) as section, round_even(p_size / 16, 3) rounded from part"""


def first_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First article of each journal and key, monitors' outputs in the order they are listed, preferred first."""
    a = table(spark, sf_dir, "journal_articles").select("article_no", "journal", "doi", "url", "title", "year")
    once = dedupe.by_first_key(a, ["journal"], [F.lower(X.strip(F.col("doi"))), F.col("url"), F.col("title")], "article_no")
    both = dedupe.union_in_order([once.where("year >= 2020").select("article_no", "journal"), once.where("year < 2020").select("article_no", "journal")], "article_no")
    return both.groupBy("journal", "source_nth").agg(F.count("*").alias("n"), F.min("article_no").alias("first")).select("journal", F.col("source_nth").cast("bigint").alias("source_nth"), "n", "first")


_FIRST_KEYS = """with k as (select *, coalesce(nullif(lower(trim(doi)), ''), nullif(url, ''), nullif(title, '')) k from journal_articles), f as (select *, row_number() over (partition by journal, coalesce(k, article_no::varchar) order by article_no) n from k)
select journal, (case when year >= 2020 then 0 else 1 end)::bigint source_nth, count(*) n, min(article_no) as first from f where n = 1 and year is not null group by 1, 2"""


def bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records counted by a bucket that is looked up, unlisted ones as unbucketed."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(rank.named(F.col("o_orderpriority"), json.loads('{"1-URGENT": "core", "2-HIGH": "core", "3-MEDIUM": "tooling"}'), "unbucketed").alias("bucket")).agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (
    registry_scan, journal_scan, preprint_scan, scholar_scan, atom_scan, bulk_tables, bulk_latest, landed_pages, json_lines_round, payload_records, seen_state, commit_ids, prompt_batches, translations, agent_texts, page_parts, digest_all, archive_latest,
    text_helpers, first_keys, bucket_counts,
)}
SQL = {
    "registry_scan": _REGISTRY, "journal_scan": _JOURNALS, "preprint_scan": _PREPRINTS, "scholar_scan": _SCHOLAR, "atom_scan": _ATOM, "bulk_tables": _BULK, "bulk_latest": _LATEST, "landed_pages": _PAGES,
    "json_lines_round": "select hist_no, paper_id, title, date, link from accepted_papers", "payload_records": _PAYLOADS, "seen_state": _SEEN, "commit_ids": _COMMIT, "prompt_batches": _PROMPTS, "agent_texts": _AGENT, "page_parts": _PAGE_PARTS, "digest_all": _DIGEST_ALL,
    "archive_latest": "select row_number() over (order by pushed_at::date desc nulls last, pushed_at desc nulls last, hist_no) place, hist_no from accepted_papers",
    "text_helpers": _HELPERS, "first_keys": _FIRST_KEYS,
    "bucket_counts": "select case o_orderpriority when '1-URGENT' then 'core' when '2-HIGH' then 'core' when '3-MEDIUM' then 'tooling' else 'unbucketed' end bucket, count(*) n from orders group by 1",
}
