"""Queries on the operators over bibliographic records, and their SQL.

``papers`` are harvested records, ``accepted_papers`` what was delivered before, ``incoming_papers`` new batches.
Rule configurations here are small examples; operators take any.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import documents as docs
from ..functions import query_language as Q
from ..functions import notes
from ..functions import text as X
from ..operators import dedupe, enrich, filters, merge, rank, render, rules, state
from ..runtime import released, spread, stage, table

AS_OF = datetime.date(2025, 6, 30)
INCLUDE, EXCLUDE = ["language model", "evidence"], ["intraday", "bailout"]

RULES = rules.Rules(
    groups={
        "methods": ["language models", "topic model", "satellite", "bayesian", "few-shot"],
        "markets": ["credit", "bank", "mortgage", "insurance", "lending"],
        "outcomes": ["returns", "volatility", "spreads", "defaults"],
        "noise": ["climate", "maritime"],
        "vetoed": ["housing bailouts", "shadow governance"],
    },
    buckets=[
        rules.Bucket("core", require_all=["methods", "markets"], title_or_abstract_any=["outcomes"], optional_any=["outcomes"], penalty=["noise"], least_hits=3, bonus="2.5"),
        rules.Bucket("tooling", require_any=["methods"], title_any=["methods"], penalty=["noise"], bonus="1.25"),
        rules.Bucket("adjacent", require_any=["markets", "outcomes"], least_hits=2, bonus="-0.5"),
    ],
    exclude=["vetoed"],
    field_weights={"title": "2.25", "abstract": "1.5", "authors": "0.25"},
    extras=[rules.Extra(["methods"], "1.05"), rules.Extra(["markets"], "1.3"), rules.Extra(["outcomes"], "1.45"), rules.Extra(["methods"], "2.2", fields=("title", "abstract"), bucket="tooling")],
    weights={"require_all": "2.5", "require_any": "1.1", "title_any": "0.4", "title_or_abstract_any": "0.8", "optional_any": "0.6", "abstract": "0.7", "penalty": "1.6"},
)
WEIGHTS = rank.Weights(source={"JournalFeed": 1.5, "OpenShelf": 1.0}, bucket={"core": 1.0, "tooling": 0.5}, group={"core_prediction": 0.75, "backup": -0.5})


def _papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "papers")


# ---------------------------------------------------------------- the simple monitor


def simple_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filter by date and words, first of each id, not delivered before, three newest of each source."""
    p = _papers(spark, sf_dir).withColumn("source", F.lower(F.trim("source")))
    text = F.concat_ws(" ", "title", "abstract")
    p = p.where(filters.not_before(F.col("date"), F.lit(None).cast("int"), "2018-01-01") & filters.mentions(text, INCLUDE, EXCLUDE))
    p = dedupe.first_by_id(p.select("row_no", "paper_id", "source", "date", "title"), "paper_id", "row_no")
    seen = table(spark, sf_dir, "accepted_papers").select(X.strip(F.col("paper_id")).alias("_id")).where("_id <> ''").distinct()
    p = p.join(seen, X.strip(F.col("paper_id")) == F.col("_id"), "left_anti")
    return filters.top_in_group(p, ["source"], [F.col("date").desc_nulls_last(), F.col("row_no")], 3).select("row_no", "paper_id", "source", "date")


_STRICT = "case when regexp_matches(trim(date), '^[0-9]{1,4}-[0-9]{1,2}-[0-9]{1,2}$') then try_strptime(trim(date), '%Y-%m-%d')::date end"
_SIMPLE = f"""
with p as (select row_no, trim(paper_id, ' ' || chr(9)) id, paper_id, lower(trim(source)) source, date, {_STRICT} d, lower(concat_ws(' ', title, abstract)) t from papers),
f as (select * from p where (d is null or d >= date '2018-01-01') and (contains(t, 'language model') or contains(t, 'evidence')) and not contains(t, 'intraday') and not contains(t, 'bailout') and id <> ''),
u as (select *, row_number() over (partition by id order by row_no) n from f),
a as (select *, row_number() over (partition by source order by date desc nulls last, row_no) k from u where n = 1 and id not in (select trim(paper_id, ' ' || chr(9)) from accepted_papers where paper_id is not null))
select row_no, paper_id, source, date from a where k <= 3"""


def substring_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that pass the word rules."""
    d = table(spark, sf_dir, "documents")
    return d.where(filters.mentions(F.col("text"), ["credit", "bank"], ["shadow", "green"])).select("doc_id", "lang")


# ---------------------------------------------------------------- normalisation


def paper_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised title, stable id, cleaned authors of each record."""
    p = _papers(spark, sf_dir)
    local = F.regexp_extract(F.coalesce("paper_id", F.lit("")), "^[^:]*:(.*)$", 1)
    return p.select("row_no", X.squeeze(F.col("title")).alias("title"), X.normalize_title(F.col("title")).alias("title_key"), X.stable_id(F.trim("source"), local, F.col("title")).alias("stable_id"), F.array_join(X.clean_list(F.col("authors")), "; ").alias("authors"))


_SQ = r"trim(regexp_replace({0}, '[\t-\r\x1c-\x20\x{{85}}\p{{Z}}]+', ' ', 'g'))"
_NORM = "trim(regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', ' ', 'g'))"


def _paper_normalize_sql() -> str:
    return f"""select row_no, {_SQ.format('title')} title, {_NORM.format('title')} title_key,
  lower(coalesce(trim(source), '')) || ':' || coalesce(nullif(trim(regexp_extract(coalesce(paper_id, ''), '^[^:]*:(.*)$', 1), ' ' || chr(9)), ''), substr(sha1({_NORM.format('title')}), 1, 16)) stable_id,
  array_to_string(list_filter(list_transform(coalesce(authors, []), lambda a: {_SQ.format('a')}), lambda a: a <> ''), '; ') authors from papers"""


def url_canonicalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical address of each link."""
    return _papers(spark, sf_dir).select("row_no", X.canonical_url(F.col("link")).alias("url"))


_URL = r"""select row_no, case when link <> '' then case when regexp_matches(trim(link), '^[A-Za-z][A-Za-z0-9+.-]*:')
  then lower(regexp_extract(trim(link), '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || substr(regexp_replace(trim(link), '(?s)[?#].*$', ''), length(regexp_extract(trim(link), '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) + 1) else trim(link) end end url from papers"""


#: Typed dates that the tables do not hold, as extra rows of ``date_parse`` (numbers below 0).
TYPED = (
    "Tue, 05 Mar 2024 23:30:00 -0500", "5 March 2024 10:11:12", "Published: 2021-02-03", "Posted: 3 May 2020,", "05 Mar 2024 01:30:00 +0530", "Sun, 31 Dec 2023 22:00:00 PST", "1 Jan 2024 00:10 GMT",
    "seen 2024-99-99 x", "2024-13-05", "1999-01-02T00:00:00Z", "2024-02-30", "March 3, 2020", "n.d.", "",
)


def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO date as typed, age, and the window predicates."""
    p = _papers(spark, sf_dir).select("row_no", "date")
    p = p.unionByName(spark.createDataFrame([(-k, x) for k, x in enumerate(TYPED, 1)], "row_no bigint, date string"))
    iso = D.parse_date(F.col("date"))
    p = p.withColumn("iso", iso)
    return p.select("row_no", "iso", D.days_since(F.col("iso"), AS_OF).cast("bigint").alias("age"), filters.within(F.col("iso"), 900, AS_OF).alias("recent"), filters.on_or_after(F.col("iso"), "2020-01-01").alias("late"))


_CLEAN_DATE = r"regexp_replace(regexp_replace(trim(regexp_replace({0}, '[\t-\r\x1c-\x20\x{{85}}\p{{Z}}]+', ' ', 'g')), 'Published:|Posted:', '', 'g'), '^[, ]+|[, ]+$', '', 'g')"
#: Message dates with a numeric or a named zone, as UTC; without one their own day.
_MESSAGE = r"""coalesce(try_strptime(regexp_replace(x, '^[A-Za-z]{3}, ', ''), '%d %b %Y %H:%M:%S %z')::timestamptz at time zone 'UTC',
  try_strptime(regexp_replace(x, '^(?:[A-Za-z]{3}, )?(.*) GMT$', '\1'), '%d %b %Y %H:%M'), try_strptime(regexp_replace(x, '^(?:[A-Za-z]{3}, )?(.*) PST$', '\1'), '%d %b %Y %H:%M:%S') + interval 8 hours)"""
_ISO = f"""coalesce(strftime(coalesce(try_strptime(x, '%Y-%m-%d'), try_strptime(x, '%Y/%m/%d'), try_strptime(x, '%d %B %Y'), try_strptime(x, '%d %b %Y'), try_strptime(x, '%B %d, %Y'), try_strptime(x, '%b %d, %Y'), try_strptime(x, '%d %B %Y %H:%M:%S'), {_MESSAGE}), '%Y-%m-%d'),
  nullif(regexp_extract(x, '(20[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}})', 1), ''))"""
_TYPED = " union all ".join(f"select {-k}::bigint, '{x}'" for k, x in enumerate(TYPED, 1))
_DATES = f"""with p as (select row_no, {_CLEAN_DATE.format('date')} x from (select row_no, date from papers union all {_TYPED})), q as (select row_no, {_ISO} iso from p)
select row_no, iso, date_diff('day', try_cast(iso as date), date '2025-06-30') age, coalesce(date_diff('day', try_cast(iso as date), date '2025-06-30') <= 900, true) recent, coalesce(iso >= '2020-01-01', false) late from q"""


def adaptive_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent rows of each handler, wider where they are few."""
    p = _papers(spark, sf_dir)
    age = D.days_since(D.parse_date(F.coalesce(X.blank_to_null(F.col("recency_date")), X.blank_to_null(F.col("updated")), X.blank_to_null(F.col("date")))), AS_OF)
    return filters.adaptive_window(p, age, ["source_handler"], 400, 1500, 40, drop_undated=True).select("row_no", "source_handler")


_ADAPTIVE = f"""with p as (select row_no, source_handler, {_CLEAN_DATE.format("coalesce(nullif(recency_date, ''), nullif(updated, ''), nullif(date, ''))")} x from papers),
q as (select row_no, source_handler, date_diff('day', try_cast({_ISO} as date), date '2025-06-30') age from p),
c as (select *, count_if(coalesce(age <= 400, false)) over (partition by source_handler) n from q)
select row_no, source_handler from c where age <= 1500 and (age <= 400 or n < 40)"""


def record_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published articles: journal sources must hold journal articles from 2019 on; latest first."""
    a = table(spark, sf_dir, "journal_articles")
    a = a.where(filters.of_type(F.col("source"), F.col("type"), ["top_journal"], "journal-article") & filters.not_before(F.col("published"), F.col("year"), "2019-01-01"))
    return a.orderBy(F.col("published").desc_nulls_last(), F.col("year").desc_nulls_last(), "article_no").select("article_no", "source", "published")


_TYPES = f"""with a as (select *, {_STRICT.replace('date)', 'published)').replace('trim(date', 'trim(published')} d from journal_articles)
select article_no, source, published from a where (source is distinct from 'top_journal' or coalesce(type = 'journal-article', false)) and (case when d is not null then d >= date '2019-01-01' else coalesce(year, 0) = 0 or year >= 2019 end)"""


# ---------------------------------------------------------------- rules


def phrase_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each phrase that a record's field holds."""
    return rules.long_hits(_papers(spark, sf_dir).select("row_no", "title", "abstract", "authors"), RULES, "row_no")


def _hit_sql() -> str:
    every = [(g, p, p.replace(" ", chr(92) + "s+")) for g, ps in RULES.groups.items() for p in ps]
    found = " union all ".join(rf"select row_no, '{g}' phrase_group, field, '{p}' phrase from tx where regexp_matches(t, '(?i)(^|[^\p{{L}}\p{{N}}_]){x}($|[^\p{{L}}\p{{N}}_])')" for g, p, x in every)
    return f"""tx as materialized (select row_no, 'title' field, coalesce(title, '') t from papers union all select row_no, 'abstract', coalesce(abstract, '') from papers union all select row_no, 'authors', coalesce(array_to_string(authors, ' '), '') from papers),
h as materialized ({found})"""


def bucket_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best bucket and score of each record."""
    d = rules.decide(_papers(spark, sf_dir).select("row_no", "title", "abstract", "authors"), RULES)
    return d.select("row_no", "matched", "bucket", F.round("score", 4).alias("score"))


def _decision_sql(select: str) -> str:
    w, fw = RULES.weights, RULES.field_weights
    groups = list(RULES.groups)
    n = lambda g, f: f"n_{g}_{f}"
    cols = ", ".join(f"count(*) filter (where phrase_group = '{g}' and field = '{f}') {n(g, f)}" for g in groups for f in rules.FIELDS)
    total = lambda g: "(" + " + ".join(n(g, f) for f in rules.FIELDS) + ")"
    some = lambda gs, fs: "(" + " or ".join([f"{n(g, f)} > 0" for g in gs for f in fs] or ["false"]) + ")"
    base = "(" + " + ".join(f"{n(g, f)} * {fw[f]}" for g in groups for f in rules.FIELDS) + ")"
    match, score = [], []
    for b in RULES.buckets:
        ok = [f"{total(g)} > 0" for g in b.require_all] + ([some(b.require_any, rules.FIELDS)] if b.require_any else []) + ([some(b.title_any, ["title"])] if b.title_any else []) + ([some(b.title_or_abstract_any, ["title", "abstract"])] if b.title_or_abstract_any else [])
        own = " + ".join(total(g) for g in dict.fromkeys([*b.require_all, *b.require_any, *b.optional_any])) or "0"
        ok.append(f"(case when {own} > 0 then {own} else {' + '.join(total(g) for g in groups)} end) >= {b.least_hits}")
        match.append("(" + " and ".join(ok) + ")")
        s = [base, b.bonus, f"case when {' and '.join(f'{total(g)} > 0' for g in b.require_all) or 'true'} then {w['require_all']} else 0 end"]
        if b.require_any:
            s.append(f"case when {some(b.require_any, rules.FIELDS)} then {w['require_any']} else 0 end")
        s.append(f"case when {some(b.title_any, ['title']) if b.title_any else 'true'} then {w['title_any']} else 0 end")
        s.append(f"case when {some(b.title_or_abstract_any, ['title', 'abstract']) if b.title_or_abstract_any else 'true'} then {w['title_or_abstract_any']} else 0 end")
        s += [f"case when {total(g)} > 0 then {w['optional_any']} else 0 end" for g in b.optional_any]
        s.append(f"case when {some([*b.require_all, *b.require_any], ['abstract'])} then {w['abstract']} else 0 end")
        s += [f"case when {some(x.groups, x.fields)} then {x.weight} else 0 end" for x in RULES.extras if x.bucket in (None, b.name)]
        s += [f"-{total(g)} * {w['penalty']}" for g in b.penalty]
        score.append("(" + " + ".join(f"({x})" for x in s) + ")")
    veto = some(RULES.exclude, rules.FIELDS)
    cand = " union all ".join(f"select row_no, {i} nth, '{b.name}' bucket, {score[i]} s from c where {match[i]} and not {veto}" for i, b in enumerate(RULES.buckets))
    return f"""with {_hit_sql()},
c as (select p.row_no, {cols} from papers p left join h using (row_no) group by 1),
k as ({cand}), b as (select *, row_number() over (partition by row_no order by s desc, nth) rn from k),
decided as (select c.*, b.bucket, b.bucket is not null matched, round(case when {veto} then 0 else coalesce(b.s, {base}) end::double, 4) score from c left join b on b.row_no = c.row_no and rn = 1)
{select}"""


def legacy_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that satisfy a profile without buckets."""
    d = rules.with_hits(_papers(spark, sf_dir).select("row_no", "title", "abstract", "authors"), RULES)
    return d.where(rules.profile_match(RULES, require_all=["methods"], require_any=["markets", "outcomes"], title_all=["methods"], least_hits=3)).select("row_no")


def _profile_sql() -> str:
    every = " + ".join(f"n_{g}_{f}" for g in RULES.groups for f in rules.FIELDS)
    own = " + ".join(f"n_{g}_{f}" for g in ("methods", "markets", "outcomes") for f in rules.FIELDS)
    veto = " + ".join(f"n_{g}_{f}" for g in RULES.exclude for f in rules.FIELDS)
    side = " + ".join(f"n_{g}_{f}" for g in ("markets", "outcomes") for f in rules.FIELDS)
    return _decision_sql(f"select row_no from decided where n_methods_title > 0 and {side} > 0 and {own} >= 1 and {every} >= 3 and {veto} = 0")


# ---------------------------------------------------------------- ranking and selection


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_no, answer: stored answers of a backend, made of the records' metadata here; records without pages have none."""
    pages = F.get_json_object("raw_metadata", "$.pages")
    said = F.to_json(F.struct(pages.alias("relevance_score"), (pages.try_cast("double") * 1.5).cast("string").alias("top_pick_score"), (pages.try_cast("int") % 2).cast("string").alias("is_relevant")))
    return _papers(spark, sf_dir).where(pages.isNotNull()).select("row_no", said.alias("answer"))


def _decided(spark: SparkSession, sf_dir: str, recent: int | None = None) -> DataFrame:
    """Records, of the last ``recent`` days if given, with their decision and heuristic score. No row is shuffled, and none is filtered by its decision, as that would run the rules twice."""
    p = _papers(spark, sf_dir).withColumn("source", F.trim("source")).select("row_no", "paper_id", "title", "abstract", "authors", "source", "source_handler", "date", "link", "query_groups", "canonical_url", "normalized_title")
    if recent is not None:
        p = p.where(filters.within(D.parse_date(F.col("date")), recent, AS_OF))
    d = rules.decide(p, RULES)
    age = D.days_since(D.parse_date(F.col("date")), AS_OF)
    noise = sum((F.size(F.col(f"hits.noise.{f}")) for f in rules.FIELDS[1:]), F.size("hits.noise.title"))
    heuristic = rank.heuristic(F.col("score"), age, [F.coalesce(F.col("abstract") != "", F.lit(False)), F.coalesce(F.size("authors") > 0, F.lit(False)), F.coalesce(F.col("date") != "", F.lit(False))], F.col("source"), F.col("bucket"), F.coalesce("query_groups", F.array().cast("array<string>")), noise, WEIGHTS)
    return d.withColumn("heuristic", F.round(heuristic, 6)).drop("abstract", "bucket_scores")


def _with_final(spark: SparkSession, sf_dir: str, d: DataFrame) -> DataFrame:
    """Adds the backend's verdicts and the final score."""
    d = enrich.with_verdicts(d, _answers(spark, sf_dir), "row_no")
    return d.withColumn("final", F.round(F.col("heuristic") + F.col("relevance") * WEIGHTS.relevance + F.col("pick") * WEIGHTS.pick, 5))


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decided records with the backend's verdicts, heuristic and final score."""
    # Rules run once; the stages after them read the table of decisions (also twice, as for "any accepted").
    return stage(_with_final(spark, sf_dir, _decided(spark, sf_dir)), "decisions")


def heuristic_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heuristic and final score of the matched records."""
    return _ranked(spark, sf_dir).where("matched").select("row_no", F.round("heuristic", 4).alias("heuristic"), F.round("final", 4).alias("final"))


def _rank_ctes() -> str:
    noise = "n_noise_title + n_noise_abstract + n_noise_authors"
    return f"""select d.row_no, matched, bucket, score, {noise} noise, p.paper_id, trim(p.source) source, p.source_handler, p.date, p.title, p.canonical_url, p.normalized_title, coalesce(p.query_groups, []) qg,
  (coalesce(p.abstract, '') <> '')::int * 1.0 + (coalesce(len(p.authors), 0) > 0)::int * 0.4 + (coalesce(p.date, '') <> '')::int * 0.4 complete,
  (select date_diff('day', try_cast({_ISO} as date), date '2025-06-30') from (select trim(p.date) x)) age,
  raw_metadata->>'$.pages' pages from decided d join papers p using (row_no)"""


def _ranked_sql(select: str) -> str:
    inner = _decision_sql(_rank_ctes())
    return f"""with r as ({inner}),
s as (select *, greatest(0, least(100, coalesce(try_cast(pages as double), 0))) relevance, greatest(0, least(100, coalesce(try_cast(pages as double) * 1.5, 0))) pick,
  case when pages is null then null else try_cast(pages as int) % 2 = 1 end verdict,
  score * 1.0 + complete * 0.75 + 1.25 * (case when age is null then 0.3 when age <= 10 then greatest(0, 1 - age / 10.0::double) else greatest(0, 0.25 - (age - 10) / 365.0::double) end)
  + case source when 'JournalFeed' then 1.5 when 'OpenShelf' then 1.0 else 0.5 end + case bucket when 'core' then 1.0 when 'tooling' then 0.5 else 0 end
  + greatest(0, coalesce(list_max(list_transform(qg, lambda g: case g when 'core_prediction' then 0.75 when 'backup' then -0.5 else 0 end)), 0)) - noise * 1.5 h0 from r),
ranked as (select *, round(h0::double, 6) heuristic, round(round(h0::double, 6) + relevance * 0.03 + pick * 0.04, 5) final from s)
{select}"""


def _asked(r: DataFrame, n: int) -> DataFrame:
    """Adds ``asked``: whether the row is one of the best n by bucket and score; only these have a verdict."""
    priority = rank.lookup(F.col("bucket"), {"core": 3, "tooling": 2, "adjacent": 1}, 0)
    best = rank.top(r, [priority.desc(), F.col("score").desc(), F.col("row_no")], n).select("row_no", F.lit(True).alias("asked"))
    r = r.join(best, "row_no", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))
    return r.withColumn("verdict", F.when(F.col("asked"), F.col("verdict")))


def semantic_topn_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the best 200 candidates by bucket and score those with a true verdict; all candidates if there is none."""
    r = _asked(_ranked(spark, sf_dir).where("matched"), 200)
    return rank.accepted(r, F.col("verdict")).select("row_no", "bucket")


_PRIORITY = "case bucket when 'core' then 3 when 'tooling' then 2 when 'adjacent' then 1 else 0 end desc, score desc, row_no"
_TOPN = f"""select row_no, bucket from (select *, bool_or(coalesce(asked and verdict, false)) over () any_true from (
  select *, row_number() over (order by {_PRIORITY}) <= 200 asked from ranked where matched)) where not any_true or coalesce(asked and verdict, false)"""


def balanced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve records: at least four core, at most three tooling."""
    r = _ranked(spark, sf_dir).where("matched")
    return rank.balanced(r, [F.col("final").desc(), F.col("row_no")], "bucket", "core", 4, "tooling", 3, 12).select("row_no", "bucket", F.col("place").cast("bigint").alias("place"))


_BALANCED = """, w as (select *, row_number() over (partition by bucket order by final desc, row_no) rn from ranked where matched),
b as (select *, bucket = 'core' and rn <= 4 forced from w where bucket <> 'tooling' or rn <= 3)
select row_no, bucket, row_number() over (order by forced desc, final desc, row_no) place from b order by forced desc, final desc, row_no limit 12"""


def backfill_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A selection of core records short of its target, filled from the rest, relevant ones first."""
    r = _ranked(spark, sf_dir).select("row_no", "matched", "bucket", "relevance", "final")
    order = [F.col("final").desc(), F.col("row_no")]
    chosen = rank.balanced(r.where("bucket = 'core'"), order, "bucket", "core", 5, "tooling", 0, 5)
    return rank.backfill(chosen, r, "row_no", F.col("relevance") >= 60, order, 15).select("row_no", F.col("place").cast("bigint").alias("place"))


_BACKFILL = """, c as (select row_no, row_number() over (order by final desc, row_no) place from ranked where bucket = 'core' order by place limit 5),
x as (select row_no, row_number() over (order by relevance < 60, final desc, row_no) k from ranked where row_no not in (select row_no from c))
select row_no, place from c union all select row_no, k + (select count(*) from c) from x where k + (select count(*) from c) <= 15"""


def stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each source through the stages, in one pass."""
    r = _ranked(spark, sf_dir)
    source = F.coalesce(X.blank_to_null(F.col("source_handler")), X.blank_to_null(F.col("source")), F.lit("unknown"))
    return r.groupBy(source.alias("handler"), F.coalesce("bucket", F.lit("unbucketed")).alias("bucket")).agg(F.count("*").alias("fetched"), F.count_if("matched").alias("matched"), F.count_if(F.col("matched") & F.col("verdict")).alias("accepted"), F.count_if(F.col("matched") & ~F.col("verdict")).alias("rejected"))


_METRICS = """select coalesce(nullif(source_handler, ''), nullif(source, ''), 'unknown') handler, coalesce(bucket, 'unbucketed') bucket, count(*) fetched, count_if(matched)::bigint matched, count_if(coalesce(matched and verdict, false))::bigint accepted, count_if(coalesce(matched and not verdict, false))::bigint rejected from ranked group by 1, 2"""


def candidate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate with its decision, scores, verdict, whether it was selected, and its terms in order of first sight."""
    r = _ranked(spark, sf_dir)
    chosen = rank.balanced(r.where("matched"), [F.col("final").desc(), F.col("row_no")], "bucket", "core", 4, "tooling", 3, 12).select("row_no", F.lit(True).alias("selected"))
    terms = F.array_distinct(F.flatten(F.array(*[F.col(f"hits.{g}.{f}") for g in ("methods", "markets") for f in rules.FIELDS])))
    out = r.join(chosen, "row_no", "left")
    return out.select("row_no", "bucket", F.round("final", 3).alias("final"), F.coalesce("verdict", F.lit(False)).alias("verdict"), F.coalesce("selected", F.lit(False)).alias("selected"), F.array_join(terms, ", ").alias("terms"))


def _audit_sql() -> str:
    # Terms stand by group, then field, then name; each where it comes first.
    place = "(case phrase_group when 'methods' then 0 else 3 end + case field when 'title' then 0 when 'abstract' then 1 else 2 end)"
    head = _ranked_sql("").rstrip()
    return f"""{head}, ht as (select row_no, phrase, min(({place}, phrase)) o from (with {_hit_sql()} select * from h) where phrase_group in ('methods', 'markets') group by 1, 2),
tt as (select row_no, string_agg(phrase, ', ' order by o) terms from ht group by 1),
w as (select *, row_number() over (partition by bucket order by final desc, row_no) rn from ranked where matched),
b as (select *, bucket = 'core' and rn <= 4 forced from w where bucket <> 'tooling' or rn <= 3),
c as (select row_no from b order by forced desc, final desc, row_no limit 12)
select r.row_no, bucket, round(final, 3) final, coalesce(verdict, false) verdict, c.row_no is not null selected, coalesce(terms, '') terms from ranked r left join c using (row_no) left join tt using (row_no)"""


def batches_and_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 40 parts of each brand and 300 in all, in batches of 8."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    capped = rank.capped(p, "p_brand", F.col("p_brand"), F.col("p_partkey"), 40, 300)
    return rank.batches(capped, ["p_brand"], [F.col("p_partkey")], 8)


_CAPS = """with a as (select p_partkey, p_brand, row_number() over (partition by p_brand order by p_partkey) r from part),
b as (select p_partkey, p_brand from a where r <= 40 order by p_brand, p_partkey limit 300)
select p_partkey, p_brand, ((row_number() over (partition by p_brand order by p_partkey) - 1) // 8)::bigint batch from b"""


# ---------------------------------------------------------------- joins, dedupe, merges


def pushed_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming rows whose id was not delivered."""
    seen = table(spark, sf_dir, "accepted_papers").select(X.clean_cell(F.col("paper_id")).alias("_id")).where("_id <> ''").distinct()
    i = table(spark, sf_dir, "incoming_papers")
    return i.join(seen, X.clean_cell(F.col("paper_id")) == F.col("_id"), "left_anti").select("arrival_no")


def pushed_match_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By which key an incoming row is known, in order of precedence."""
    i, a = table(spark, sf_dir, "incoming_papers"), table(spark, sf_dir, "accepted_papers")
    i = i.select("arrival_no", "paper_id", "canonical_url", "normalized_title")
    known = dedupe.known_reason(i, a, [("paper_id", "paper_id"), ("canonical_url", "canonical_url"), ("title", "normalized_title")], "hist_no", ("title_similarity", "normalized_title"))
    return known.where("reason is not null").select("arrival_no", "reason")


def _lcs_sql(pairs: str) -> str:
    """CTEs that end in sim (a, b, similarity): the pairs (a, b) of different texts at 96 or more, longest common subsequences row by row."""
    return f"""cand as materialized (select distinct a, b from ({pairs}) where a <> b and abs(length(a) - length(b)) <= (length(a) + length(b)) * 0.04 and levenshtein(a, b) <= (length(a) + length(b)) * 0.04),
lcs as (select a, b, 0 i, list_transform(range(length(b) + 1), lambda x: 0) v from cand
  union all select a, b, i + 1, list_reduce(list_transform(range(1, length(b) + 1), lambda j: [j::int]), lambda acc, x: list_append(acc, greatest(acc[-1], v[x[1] + 1], v[x[1]] + case when a[i + 1] = b[x[1]] then 1 else 0 end)), [0]) from lcs where i < length(a)),
sim as (select a, b, 200.0::double * v[-1] / (length(a) + length(b)) similarity from lcs where i = length(a) and 200 * v[-1] >= 96 * (length(a) + length(b)))"""


_TITLES_MET = "select i.normalized_title a, h.normalized_title b from (select distinct normalized_title from incoming_papers where normalized_title <> '') i, (select distinct normalized_title from accepted_papers where normalized_title <> '') h where abs(length(a) - length(b)) <= 12"
_REASON = f"""with recursive {_lcs_sql(_TITLES_MET)}
select arrival_no, case when paper_id in (select paper_id from accepted_papers where paper_id <> '') then 'paper_id'
  when canonical_url in (select canonical_url from accepted_papers where canonical_url <> '') then 'canonical_url'
  when normalized_title in (select normalized_title from accepted_papers where normalized_title <> '') then 'title'
  when normalized_title in (select a from sim) then 'title_similarity' end reason from incoming_papers where reason is not null"""
_FUZZY = f"""with recursive {_lcs_sql(_TITLES_MET)}
select arrival_no, hist_no, round(similarity, 4) similarity from sim join incoming_papers i on i.normalized_title = a join accepted_papers h on h.normalized_title = b
union all select arrival_no, hist_no, 100.0 from incoming_papers join accepted_papers h using (normalized_title) where normalized_title <> ''"""
#: First-wins in rounds: what meets no earlier undecided row is kept, what meets an earlier kept one goes.
_GREEDY = f"""with recursive t as (select distinct normalized_title x from papers where normalized_title <> ''),
{_lcs_sql("select p.x a, q.x b from t p, t q where length(q.x) between length(p.x) and length(p.x) + 12 and (length(p.x) < length(q.x) or p.x < q.x)")},
p as materialized (select *, row_number() over (order by row_no) i from papers),
k as (select i, 'i' || paper_id k from p where paper_id <> '' union all select i, 'u' || canonical_url from p where canonical_url <> '' union all select i, 't' || normalized_title from p where normalized_title <> ''
  union all select i, 's' || a || '|' || b from p join sim on normalized_title = a or normalized_title = b),
e as (select x.i, list(distinct y.i) n from k x join k y using (k) where y.i < x.i group by 1),
g as (select list(i order by i) und, list(coalesce(n, []) order by i) nb, []::bigint[] kept from p left join e using (i)
  union all select list_filter(und, lambda u: list_has_any(nb[u], und) and not list_has_any(nb[u], new)), nb, list_concat(kept, new) from (select *, list_filter(und, lambda u: not list_has_any(nb[u], und)) new from g) where len(und) > 0)
select row_no from p where i in (select unnest(kept) from g where len(und) = 0)"""


def fuzzy_title_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming and delivered titles at 96 or more on the indel ratio; equal ones are at 100."""
    i = table(spark, sf_dir, "incoming_papers").select(F.col("arrival_no").alias("id"), F.col("normalized_title").alias("text"))
    a = table(spark, sf_dir, "accepted_papers").select(F.col("hist_no").alias("id"), F.col("normalized_title").alias("text"))
    return dedupe.fuzzy_pairs(i, a, 96).select(F.col("left_id").alias("arrival_no"), F.col("right_id").alias("hist_no"), F.round("similarity", 4).alias("similarity"))


def greedy_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept by first-wins on id, address and title, equal or at 96 or more on the indel ratio."""
    p = _papers(spark, sf_dir).select("row_no", "paper_id", "canonical_url", "normalized_title")
    keys = [F.col("paper_id"), F.col("canonical_url"), F.col("normalized_title")]
    return dedupe.greedy(p, "row_no", keys, groups=dedupe.similar_groups(p, "row_no", "normalized_title")).select("row_no")


def provenance_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each id with all its query groups."""
    p = _papers(spark, sf_dir).select("paper_id", "row_no", "source_handler", "query_groups")
    m = dedupe.merged_provenance(p, "paper_id", "row_no", ["query_groups"])
    return m.select("paper_id", "row_no", "source_handler", F.array_join("query_groups", ",").alias("query_groups"))


_PROVENANCE = """with x as (select paper_id, row_no, unnest(query_groups) g, generate_subscripts(query_groups, 1) i from papers where paper_id is not null),
y as (select paper_id, g, min((row_no, i)) o from x where g is not null group by 1, 2), z as (select paper_id, string_agg(g, ',' order by o) query_groups from y group by 1)
select p.paper_id, p.row_no, p.source_handler, coalesce(z.query_groups, '') query_groups from (select paper_id, min(row_no) row_no from papers where paper_id is not null group by 1) m join papers p on p.row_no = m.row_no left join z on z.paper_id = m.paper_id"""


def id_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of delivered and incoming records by source, cleaned, once each."""
    a = table(spark, sf_dir, "accepted_papers").select(F.lower(F.trim("source")).alias("source"), F.col("paper_id").alias("id"))
    i = table(spark, sf_dir, "incoming_papers").select(F.lower(F.trim("source")).alias("source"), F.col("paper_id").alias("id"))
    return state.ids_by_source(a.unionByName(i)).select("source", "n", F.md5(F.array_join("ids", ",")).alias("ids"))


_UNION = r"""with u as (select distinct lower(trim(source)) source, regexp_replace(paper_id, '^[\t-\r\x1c-\x20\x{85}\p{Z}]+|[\t-\r\x1c-\x20\x{85}\p{Z}]+$', '', 'g') id from (select source, paper_id from accepted_papers union all select source, paper_id from incoming_papers))
select source, count(*) n, md5(string_agg(id, ',' order by id)) ids from u where id <> '' and upper(id) not in ('NULL', 'NONE', 'N/A', 'NA') group by 1"""


def bulk_full_outer_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, their last order and their priorities in order of appearance, from three tables."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey", "o_orderstatus", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name", "c_mktsegment")
    last = merge.last_rows(o, "key", "o_orderkey", ["o_orderkey", "o_orderstatus"])
    lists = merge.ordered_items(o, "key", "o_orderkey", F.col("o_orderpriority"), "priorities")
    m = merge.full_merge([c, last, lists], "key")
    return m.select("key", merge.fill(F.col("c_name"), F.lit("unknown")).alias("name"), "o_orderkey", "o_orderstatus", F.array_join("priorities", ";").alias("priorities"))


_BULK = """with o as (select o_custkey k, o_orderkey, o_orderstatus, o_orderpriority p from orders),
l as (select k, max(o_orderkey) o_orderkey, arg_max(o_orderstatus, o_orderkey) o_orderstatus from o group by 1),
i as (select k, p, min(o_orderkey) m from o where p <> '' group by 1, 2), s as (select k, string_agg(p, ';' order by m) priorities from i group by 1)
select coalesce(c_custkey, l.k) as key, coalesce(nullif(c_name, ''), 'unknown') name, o_orderkey, o_orderstatus, priorities from customer full outer join l on c_custkey = l.k left join s on s.k = coalesce(c_custkey, l.k)"""


def archive_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming records merged into the delivered archive, row by row with where each comes from."""
    payload = ["paper_id", "canonical_url", "normalized_title", "title", "source", "date", "link"]
    a = table(spark, sf_dir, "accepted_papers").select("hist_no", *payload, F.to_date("pushed_at").alias("first_seen"))
    i = table(spark, sf_dir, "incoming_papers").select("arrival_no", *payload, "received_at")
    return merge.archive_merge(a, i, ["paper_id", "canonical_url", "normalized_title"], "hist_no", "arrival_no", payload, {"first_seen": F.to_date("received_at")})


_MERGE = """with m as (select arrival_no, least((select min(hist_no) from accepted_papers a where a.paper_id = i.paper_id and i.paper_id <> ''), (select min(hist_no) from accepted_papers a where a.canonical_url = i.canonical_url and i.canonical_url <> ''),
    (select min(hist_no) from accepted_papers a where a.normalized_title = i.normalized_title and i.normalized_title <> '')) hist_no from incoming_papers i),
n as (select hist_no, max(arrival_no) arrival_no from m where hist_no is not null group by 1),
old as (select case when n.arrival_no is null then 'kept' else 'updated' end origin, case when n.arrival_no is null then a.paper_id else i.paper_id end paper_id, case when n.arrival_no is null then a.canonical_url else i.canonical_url end canonical_url, case when n.arrival_no is null then a.normalized_title else i.normalized_title end normalized_title, case when n.arrival_no is null then a.title else i.title end title, case when n.arrival_no is null then a.source else i.source end source, case when n.arrival_no is null then a.date else i.date end date, case when n.arrival_no is null then a.link else i.link end link, pushed_at::date first_seen from accepted_papers a left join n using (hist_no) left join incoming_papers i on i.arrival_no = n.arrival_no),
f as (select i.*, coalesce('paper_id:' || nullif(paper_id, ''), 'canonical_url:' || nullif(canonical_url, ''), 'normalized_title:' || nullif(normalized_title, ''), arrival_no::varchar) k from incoming_papers i where arrival_no in (select arrival_no from m where hist_no is null)),
fresh as (select 'new' origin, paper_id, canonical_url, normalized_title, title, source, date, link, received_at::date first_seen from (select *, row_number() over (partition by k order by arrival_no desc) r from f) where r = 1)
from old union all from fresh"""


# ---------------------------------------------------------------- rendering and text


def digest_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each source's three latest records."""
    p = _papers(spark, sf_dir).withColumn("source", F.lower(F.trim("source")))
    p = filters.top_in_group(p, ["source"], [F.col("row_no").desc()], 3)
    p = p.withColumn("place", F.row_number().over(Window.partitionBy("source").orderBy(F.col("row_no").desc())))
    body = render.entry(F.col("place"), F.col("title"), X.clean_list(F.col("authors")), F.col("source"), F.col("date"), F.col("link"))
    return render.digest(p, ["source"], "place", body, 3)


_DIGEST = f"""with p as (select *, lower(trim(source)) s, row_number() over (partition by lower(trim(source)) order by row_no desc) place from papers),
q as (select *, list_filter(list_transform(coalesce(authors, []), lambda a: {_SQ.format('a')}), lambda a: a <> '') au from p where place <= 3),
e as (select s, place, '### ' || place || '. ' || coalesce(title, 'untitled') || chr(10) || '- Authors: ' || case when len(au) > 0 then array_to_string(au, ', ') else 'unknown' end || chr(10) || '- Source: ' || coalesce(s, 'unknown') || chr(10) || '- Date: ' || coalesce(date, 'unknown') || chr(10) || '- Link: ' || coalesce(link, 'none') t from q)
select s source, count(*) records, '# Digest: ' || coalesce(s, '') || chr(10) || chr(10) || case when count(*) < 3 then 'Only ' || count(*) || ' of 3 records today.' || chr(10) || chr(10) else '' end || string_agg(t, chr(10) || chr(10) order by place) markdown from e group by s"""


def archive_window_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues of the last 14 days of the archive, entries in order."""
    a = table(spark, sf_dir, "accepted_papers").withColumn("issue", F.to_date("pushed_at"))
    a = a.where(filters.in_units(F.col("issue"), datetime.date(2023, 3, 31), 14))
    return render.archive_document(a, "issue", [F.col("pushed_at"), F.col("hist_no")], F.concat(F.lit("- "), F.coalesce("title", F.lit("untitled"))))


_WINDOW = """select pushed_at::date issue, count(*) records, '## ' || strftime(pushed_at::date, '%Y-%m-%d') || chr(10) || string_agg('- ' || coalesce(title, 'untitled'), chr(10) order by pushed_at, hist_no) markdown from accepted_papers where pushed_at::date >= date '2023-03-31' - 13 group by 1"""


def query_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boolean queries made of part names: tokens, terms, free text, fielded syntax."""
    p = table(spark, sf_dir, "part")
    q = F.concat(F.lit('("'), F.col("p_name"), F.lit('" or '), F.col("p_type"), F.lit(") and not "), F.col("p_brand"))
    return p.select("p_partkey", F.size(Q.tokens(q)).cast("bigint").alias("n_tokens"), Q.free_text(q).alias("free_text"), Q.fielded(q).alias("fielded"))


def _query_sql() -> str:
    # Rebuilds the pieces from the query's known shape.
    return """with p as (select p_partkey, '("' || p_name || '" or ' || p_type || ') and not ' || p_brand q from part),
t as (select p_partkey, regexp_extract_all(q, '"[^"]*"|[()]|[^\\s()"]+') t from p),
w as (select p_partkey, t, list_transform(list_filter(t, lambda x: upper(x) not in ('AND', 'OR', 'NOT', '(', ')')), lambda x: trim(replace(x, '"', ''))) w from t)
select p_partkey, len(t)::bigint n_tokens, array_to_string(list_filter(w, lambda x, i: list_position(list_transform(w, lambda y: lower(y)), lower(x)) = i), ' ') free_text,
 array_to_string(list_transform(t, lambda x: case when upper(x) in ('AND', 'OR', 'NOT') then upper(x) when x in ('(', ')') then x when contains(trim(replace(x, '"', '')), ' ') then 'all:"' || trim(replace(x, '"', '')) || '"' else 'all:' || trim(replace(x, '"', '')) end), ' ') fielded from w"""


def run_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily and weekly run keys of order dates, checked back."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    s = F.lit("orders")
    return o.select("o_orderkey", D.day_key(s, F.col("d")).alias("day_key"), D.week_key(s, F.col("d")).alias("week_key"), D.key_suffix(s, D.week_key(s, F.col("d"))).alias("suffix"))


_KEYS = """select o_orderkey, 'orders-' || strftime(o_orderdate, '%Y-%m-%d') day_key, 'orders-' || isoyear(o_orderdate) || '-W' || lpad(week(o_orderdate)::varchar, 2, '0') week_key, isoyear(o_orderdate) || '-W' || lpad(week(o_orderdate)::varchar, 2, '0') suffix from orders"""


#: Openings of reader notes, put before each document in turn, so that every rule of the cleaner meets whole texts.
NOTE_HEADS = (
    "", "如果你关心信贷，这篇文章", "如果你关心信贷, 这篇论文给出的证据很直接。", "这篇文章很值得关注，因为它", "这篇论文值得一读，", "仅从题目看，这篇文章", "文章", "这篇论文它", "这篇论文给出的", "规则命中：",
)


def note_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned notes, their first sentence, closed sentences, settled terms, of each document behind an opening."""
    head = F.element_at(F.array(*[F.lit(h) for h in NOTE_HEADS]), (F.pmod("doc_id", F.lit(len(NOTE_HEADS))) + 1).cast("int"))
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(head, "text").alias("a"))
    return d.select("doc_id", notes.clean_note(F.col("a")).alias("note"), X.first_sentence(F.col("a")).alias("first"), X.end_sentence(F.col("a")).alias("closed"), notes.settled_terms(F.concat(F.lit("LLM FinBERTs 法学硕士LLM "), F.col("a"))).alias("settled"))


def _notes_sql() -> str:
    py = lambda p: p.replace(r"\A", "^").replace(r"\z", "$").replace(X.WS, r"[\t-\r\x1c-\x20\x{85}\p{Z}]")
    heads = ", ".join(f"'{h}'" for h in NOTE_HEADS)
    technical = " or ".join(f"contains(lower(x), '{w.lower()}')" for w in notes.TECHNICAL)
    first, *rest = notes.OPENINGS
    trim = lambda x: _SQ.format(x)
    tail, care = trim(f"regexp_extract(y, '{py(notes.CARE)}', 2)"), py(notes.CARE)
    kind = f"regexp_replace(substr({tail}, {len(notes.EVIDENCE) + 1}), '^[ ，,。]+|[ ，,。]+$', '', 'g')"
    z = f"case when regexp_matches(y, '{care}') then '这篇论文围绕' || {trim(f"regexp_extract(y, '{care}', 1)")} || '，' || case when {tail} = '' then '提供了直接证据' when not starts_with({tail}, '{notes.EVIDENCE}') then {tail} when {kind} = '' then '给出了直接证据' else '给出了' || {kind} || '的证据' end else y end"
    for pattern, to in rest:
        z = f"regexp_replace({z}, '{py(pattern)}', '{to}')"
    end = lambda v: f"(case when {v} = '' then '' when regexp_matches({v}, '[{X.ENDS}]$') then {v} else {v} || '。' end)"
    return rf"""with d as (select doc_id, ([{heads}])[doc_id % {len(NOTE_HEADS)} + 1] || text a from documents),
e as (select *, {trim('a')} x from d),
f as (select *, regexp_replace(replace(x, '这篇文章', '这篇论文'), '{py(first[0])}', '{first[1]}') y from e),
g as (select *, {z} z from f)
select doc_id, case when {technical} then '' else {end(trim('z'))} end note, coalesce(nullif(trim(regexp_extract(x, '^(.+?[{X.ENDS}])(?:[\t-\r\x1c-\x20\x{{85}}\p{{Z}}]|$)', 1)), ''), {end('x')}) as first, {end('x')} closed,
  replace(replace('大语言模型 FinBERTs 大语言模型LLM ' || regexp_replace(regexp_replace(trim(a, ' '), '(?i)(^|[^\p{{L}}\p{{N}}_])LLM($|[^\p{{L}}\p{{N}}_])', '\1大语言模型\2', 'g'), '(?i)(^|[^\p{{L}}\p{{N}}_])FinBERT($|[^\p{{L}}\p{{N}}_])', '\1FinBERT\2', 'g'), '法学硕士', '大语言模型'), '收益电话会议', '业绩电话会') settled from g"""


def translation_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a companion text by key, and whether the companion lost too much."""
    p = _papers(spark, sf_dir).select("row_no", "normalized_title", "abstract").where("normalized_title <> ''")
    t = table(spark, sf_dir, "accepted_papers").where("normalized_title <> ''").groupBy("normalized_title").agg(F.min_by("title", "hist_no").alias("companion"))
    j = p.join(t, "normalized_title", "left")
    return j.select("row_no", render.too_short(F.col("abstract"), F.col("companion")).alias("short"))


_TRANSLATION = """with t as (select normalized_title, arg_min(title, hist_no) c from accepted_papers where normalized_title <> '' group by 1),
x as (select row_no, length(coalesce(abstract, '')) n, length(trim(coalesce(c, ''))) m from papers left join t using (normalized_title) where normalized_title <> '')
select row_no, case when m = 0 and n > 0 then true when n >= 240 then m < greatest(80, floor(n * 0.22)) else false end short from x"""

#: What does not belong in a published text. Credentials, private keys, home folders, chat and document ids.
PATTERNS = {
    "credential": r"[A-Z0-9_]*(?:SECRET|API_KEY|TOKEN|PASSWORD)\s*=\s*[^\s#]{8,}",
    "private_key": r"BEGIN (?:RSA |OPENSSH |EC )?PRIVATE KEY",
    "home_folder": r"/(?:home|Users)/[^/\s]+",
    "chat_id": r"(?:oc_|ou_)[a-zA-Z0-9_-]{16,}|session=agent:|chat:[A-Za-z0-9_:.-]{12,}",
    "document_target": r"(?:doc_token|wiki_token|wiki_url):\s*[\x22]?[A-Za-z0-9_:/.-]{12,}",
    "heading": r"(?m)^#{1,6} ",
    "percent": r"[0-9]+ percent",
}
#: Values that only stand for one.
PLACEHOLDER = r"(?i)paste_|your_|example|placeholder"
#: Lines with such things, put behind each document in turn, as the texts hold none of their own.
LEAKED = ("", "", "X_API_KEY = abcd1234efgh", "-----BEGIN RSA PRIVATE KEY-----", "see /home/someone/x and /Users/else", "oc_0123456789abcdef0 chat:abcdefghijkl", "doc_token: abcdefghijklmno", "doc_token: your_document_token", "API_TOKEN=short")
#: Names of files that hold secrets, and of files that a run leaves behind.
SENSITIVE_FILE = r"(?i)(?:^|/)(?:\.env|jobs\.json|credentials[^/]*|.*\.(?:pem|key|p12|pfx|secret|token)|id_rsa|id_ed25519)$"
RUNTIME_FILE = r"^data/|/data/|(?:^|/)__pycache__/|\.pyc$|\.log$|\.bak(?:$|\.)"


def pattern_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents that hold each pattern, counted by document; targets that are placeholders do not count."""
    tail = F.element_at(F.array(*[F.lit(x) for x in LEAKED]), (F.pmod("doc_id", F.lit(len(LEAKED))) + 1).cast("int"))
    d = spread(table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit("\n"), tail).alias("text")))

    def hits(name: str, pattern: str):
        if name == "document_target":
            return F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(pattern) & ~x.rlike(PLACEHOLDER)))
        return F.regexp_count("text", F.lit(pattern))

    rows = F.array(*[F.struct(F.lit(k).alias("pattern"), hits(k, p).cast("bigint").alias("hits")) for k, p in PATTERNS.items()])
    return d.select("doc_id", F.explode(rows).alias("x")).select("doc_id", "x.pattern", "x.hits").where("hits > 0")


def file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by name and size: sensitive ones, leftovers of runs, those over a mebibyte. Files are the abs files and the parts' names here."""
    a = table(spark, sf_dir, "abs_records").groupBy("file_name").agg(F.sum(F.length("raw_text")).cast("bigint").alias("size"))
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("data/"), F.replace("p_type", F.lit(" "), F.lit("/")), F.lit("/"), F.col("p_partkey").cast("string"), F.lit(".key")).alias("file_name"), (F.col("p_size") * 40000).cast("bigint").alias("size"))
    f = a.unionByName(p)
    return f.select("file_name", F.col("file_name").rlike(SENSITIVE_FILE).alias("sensitive"), F.col("file_name").rlike(RUNTIME_FILE).alias("leftover"), (F.col("size") > 1 << 20).alias("large"))


_TAILED = "select doc_id, text || chr(10) || ([" + ", ".join(f"'{x}'" for x in LEAKED) + f"])[doc_id % {len(LEAKED)} + 1] t from documents"
_SCAN = f"with d as materialized ({_TAILED}) " + " union all ".join(
    f"select doc_id, '{k}' pattern, len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{p}') and not regexp_matches(x, '{PLACEHOLDER}')))::bigint hits from d where hits > 0"
    if k == "document_target" else f"select doc_id, '{k}' pattern, len(regexp_extract_all(t, '{p}'))::bigint hits from d where hits > 0" for k, p in PATTERNS.items()
)
_FILES = f"""with f as (select file_name, sum(length(raw_text))::bigint size from abs_records group by 1 union all select 'data/' || replace(p_type, ' ', '/') || '/' || p_partkey || '.key', p_size * 40000 from part)
select file_name, regexp_matches(file_name, '{SENSITIVE_FILE}') sensitive, regexp_matches(file_name, '{RUNTIME_FILE}') leftover, size > 1048576 as large from f"""


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event of each user and type (the batch form of the incremental delivery)."""
    e = table(spark, sf_dir, "events").withColumn("key", F.concat_ws(":", F.col("user_id").cast("string"), "event_type"))
    return dedupe.first_by_id(e.select("key", "event_id", "value"), "key", "event_id")


def markdown_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in pieces of whole lines of up to 400 characters."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", docs.chunks(400)("text").alias("c"))
    return d.select("doc_id", F.posexplode("c").alias("nth", "piece")).select("doc_id", F.col("nth").cast("bigint").alias("nth"), F.length("piece").cast("bigint").alias("n_chars"))


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of marked-up abstracts, by parser and by pattern."""
    p = _papers(spark, sf_dir).where("abstract like '%<%'")
    return p.select("row_no", docs.markup_text("abstract").alias("parsed"), X.strip_tags(F.col("abstract")).alias("stripped"))


def pages_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, meta and links of pages built from records."""
    p = _papers(spark, sf_dir)
    source = F.concat(F.lit("<html><head><title>"), F.coalesce("title", F.lit("")), F.lit('</title><meta name="citation_id" content="'), F.coalesce("paper_id", F.lit("")), F.lit('"></head><body><a href="'), F.coalesce("link", F.lit("")), F.lit('">full text</a></body></html>'))
    return p.select("row_no", docs.page(source).alias("g")).select("row_no", "g.title", "g.text", F.get("g.links", F.lit(0)).alias("link"))


def json_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON found in texts around records' metadata."""
    p = _papers(spark, sf_dir)
    text = F.concat(F.lit("Here is the result [sic\n```json\n"), F.coalesce("raw_metadata", F.lit("none")), F.lit("\n```\nDone."))
    return p.select("row_no", docs.first_json(text).alias("json")).select("row_no", F.get_json_object("json", "$.pages").try_cast("bigint").alias("pages"))


_JSON = "select row_no, try_cast(raw_metadata->>'$.pages' as bigint) pages from papers"


def ranked_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy dedupe, recency, rules, verdicts of the top candidates, ranking, known records out, balanced selection, filled from the rejected if short."""
    kept = stage(greedy_dedupe(spark, sf_dir), "kept")
    # Each part is written and read again: the plans that the driver holds stay small, and none runs twice.
    d = stage(_decided(spark, sf_dir, 2000).select("row_no", "paper_id", "canonical_url", "normalized_title", "title", "matched", "bucket", "score", "heuristic"), "decisions")
    r = stage(_with_final(spark, sf_dir, d.where("matched").join(kept, "row_no", "left_semi")), "candidates")
    released(spark)
    known = dedupe.known_reason(_asked(r, 120), table(spark, sf_dir, "accepted_papers"), [("paper_id", "paper_id"), ("canonical_url", "canonical_url"), ("title", "normalized_title")], "hist_no", ("title_similarity", "normalized_title"))
    known = stage(known, "known")
    released(spark)
    accepted = rank.accepted(known, F.col("verdict")).where("reason is null")
    order = [F.col("final").desc(), F.col("row_no")]
    chosen = rank.balanced(accepted, order, "bucket", "core", 6, "tooling", 4, 20).select("place", "row_no", "bucket", "final", "title")
    rejected = known.where("asked and not coalesce(verdict, false) and reason is null")
    return rank.backfill(chosen, rejected.select(*[c for c in chosen.columns if c != "place"], "relevance"), "row_no", F.col("relevance") >= 60, order, 20).select(F.col("place").cast("bigint").alias("place"), "row_no", "bucket", "final", "title")


def _pipeline_sql() -> str:
    return _ranked_sql(f""", known as materialized ({_REASON}),
greedy as materialized ({_GREEDY}), acc_titles as (select distinct normalized_title from accepted_papers where normalized_title <> ''),
m as materialized (select *, row_number() over (order by {_PRIORITY}) <= 120 asked from ranked where matched and row_no in (from greedy) and coalesce(age <= 2000, true)),
near as materialized (with recursive {_lcs_sql("select distinct m.normalized_title a, h.normalized_title b from m, acc_titles h where m.normalized_title <> '' and abs(length(m.normalized_title) - length(h.normalized_title)) <= 12")} select distinct a from sim),
v as (select *, bool_or(coalesce(asked and verdict, false)) over () any_true, coalesce(paper_id in (select paper_id from accepted_papers where paper_id <> ''), false) or coalesce(canonical_url in (select canonical_url from accepted_papers where canonical_url <> ''), false)
  or coalesce(normalized_title in (from acc_titles), false) or coalesce(normalized_title in (from near), false) seen from m),
w as (select *, row_number() over (partition by bucket order by final desc, row_no) rn from v where not seen and (not any_true or coalesce(asked and verdict, false))),
b as (select *, bucket = 'core' and rn <= 6 forced from w where bucket <> 'tooling' or rn <= 4),
c as (select row_number() over (order by forced desc, final desc, row_no) place, row_no, bucket, final, title from b order by place limit 20),
x as (select row_number() over (order by relevance < 60, final desc, row_no) k, row_no, bucket, final, title from v where not seen and asked and not coalesce(verdict, false) and row_no not in (select row_no from c))
select place, row_no, bucket, final, title from c union all select k + (select count(*) from c), row_no, bucket, final, title from x where k + (select count(*) from c) <= 20""").replace(f", known as materialized ({_REASON})", "", 1)


QUERIES = {f.__name__: f for f in (
    simple_monitor, substring_filter, paper_normalize, url_canonicalize, date_parse, adaptive_window, record_types, phrase_hits, bucket_decision, legacy_profile, heuristic_rank, semantic_topn_filter,
    balanced_topk, backfill_topk, stage_metrics, candidate_audit, batches_and_caps, pushed_anti_join, pushed_match_reason, fuzzy_title_pairs, greedy_dedupe, provenance_merge, id_union, bulk_full_outer_merge,
    archive_merge, digest_render, archive_window_doc, query_language, run_keys, note_sanitize, translation_enrich, pattern_scan, file_scan, stream_dedupe, markdown_chunks, html_text, pages_parts, json_answers, ranked_pipeline,
)}

SQL = {
    "simple_monitor": _SIMPLE,
    "substring_filter": "select doc_id, lang from documents where (contains(lower(text), 'credit') or contains(lower(text), 'bank')) and not contains(lower(text), 'shadow') and not contains(lower(text), 'green')",
    "paper_normalize": _paper_normalize_sql(),
    "url_canonicalize": _URL,
    "date_parse": _DATES,
    "adaptive_window": _ADAPTIVE,
    "record_types": _TYPES,
    "phrase_hits": f"with {_hit_sql()} select row_no, phrase_group, field, phrase from h",
    "bucket_decision": _decision_sql("select row_no, matched, bucket, score from decided"),
    "legacy_profile": _profile_sql(),
    "heuristic_rank": _ranked_sql("select row_no, round(heuristic, 4) heuristic, round(final, 4) final from ranked where matched"),
    "semantic_topn_filter": _ranked_sql(_TOPN),
    "balanced_topk": _ranked_sql(_BALANCED),
    "backfill_topk": _ranked_sql(_BACKFILL),
    "stage_metrics": _ranked_sql(_METRICS),
    "batches_and_caps": _CAPS,
    "pushed_anti_join": r"""select arrival_no from incoming_papers where coalesce(regexp_replace(paper_id, '^[\t-\r\x1c-\x20\x{85}\p{Z}]+|[\t-\r\x1c-\x20\x{85}\p{Z}]+$', '', 'g'), '') not in (select regexp_replace(paper_id, '^[\t-\r\x1c-\x20\x{85}\p{Z}]+|[\t-\r\x1c-\x20\x{85}\p{Z}]+$', '', 'g') from accepted_papers where paper_id is not null and trim(paper_id) <> '')""",
    "pushed_match_reason": _REASON,
    "fuzzy_title_pairs": _FUZZY,
    "greedy_dedupe": _GREEDY,
    "candidate_audit": _audit_sql(),
    "ranked_pipeline": _pipeline_sql(),
    "file_scan": _FILES,
    "provenance_merge": _PROVENANCE,
    "id_union": _UNION,
    "bulk_full_outer_merge": _BULK,
    "archive_merge": _MERGE,
    "digest_render": _DIGEST,
    "archive_window_doc": _WINDOW,
    "query_language": _query_sql(),
    "run_keys": _KEYS,
    "note_sanitize": _notes_sql(),
    "translation_enrich": _TRANSLATION,
    "pattern_scan": _SCAN,
    "stream_dedupe": "select user_id || ':' || event_type as key, min(event_id) event_id, arg_min(value, event_id) value from events group by 1",
    "json_answers": _JSON,
}
