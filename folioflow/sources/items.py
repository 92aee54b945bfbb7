"""Items of the sources as rows: ids, dates, authors and addresses by each source's own rules, as Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as X
from ..operators import dedupe, filters

#: Which date of a registry item counts, most telling first: simple scan, journals, preprints, and for recency.
SIMPLE_DATES = ("published", "published-print", "published-online", "issued")
JOURNAL_DATES = ("published-online", "published-print", "published", "issued", "created")
PREPRINT_DATES = ("posted", "published-online", "published-print", "published", "issued", "created")
RECENCY_DATES = ("deposited", "indexed", "posted", "published-online", "published-print", "created", "issued")
#: Marks of one preprint server in registry items.
SERVER, SERVER_HOST, SERVER_PREFIX = "SSRN", "ssrn.com", "10.2139/ssrn."
#: Address stems.
DOI_STEM, BULK_STEM, SCHOLAR_STEM = "https://doi.org/", "https://www.nber.org/papers/", "https://www.semanticscholar.org/paper/"
ALIASES = {"top_journal": "top3", "econ5_journal": "econ5"}

def first_of(texts: Column) -> Column:
    """The first non-empty text of an array, else empty."""
    return F.coalesce(F.get(F.filter(texts, lambda t: t != ""), F.lit(0)), F.lit(""))


def full_names(authors: Column) -> Column:
    """``given family`` of each author, squeezed; authors without either go, a null array is empty."""
    return X.clean_list(F.transform(authors, lambda a: F.concat_ws(" ", X.strip(a["given"]), X.strip(a["family"]))))


def finalized(title: Column, authors: Column, abstract: Column, link: Column) -> list[Column]:
    """title, authors, abstract (null if empty), link, canonical_url, normalized_title: what every record gets at the end."""
    clean = X.strip_tags(F.coalesce(title, F.lit("")))
    return [
        clean.alias("title"), X.clean_list(authors).alias("authors"), X.blank_to_null(X.strip_tags(F.regexp_replace(abstract, r"(?i)\A(?:\s|<[^>]*>)*abstract\s*:\s*", ""))).alias("abstract"),
        F.coalesce(link, F.lit("")).alias("link"), X.canonical_url(link).alias("canonical_url"), X.normalize_title(clean).alias("normalized_title"),
    ]


def registry_rows(items: DataFrame, item: Column, label: str, *keep: str) -> DataFrame:
    """The simple scan's rows: id (the DOI), source, title, authors, journal, published, year, doi, abstract, url, type.

    An impossible date is passed over for the next; the year is that of the date.
    """
    doi = F.coalesce(item["DOI"], F.lit(""))
    published = F.coalesce(D.first_parts(item, list(SIMPLE_DATES)), F.lit(""))
    return items.select(
        *keep, doi.alias("id"), F.lit(label).alias("source"), first_of(item["title"]).alias("title"), full_names(item["author"]).alias("authors"), first_of(item["container-title"]).alias("journal"),
        published.alias("published"), F.substring(published, 1, 4).try_cast("int").alias("year"), doi.alias("doi"), X.squeeze(F.regexp_replace(F.coalesce(item["abstract"], F.lit("")), "<[^>]+>", " ")).alias("abstract"),
        F.when(doi != "", F.concat(F.lit(DOI_STEM), doi)).otherwise("").alias("url"), F.coalesce(item["type"], F.lit("")).alias("type"),
    )


def journal_rows(items: DataFrame, item: Column, journal: str, label: Column, order: str, most: int) -> DataFrame:
    """The ranked scan's records: articles only, the first of each journal and key (DOI, else address, else title), ``most`` a journal."""
    kept = items.withColumn("_i", item).where(F.coalesce(F.trim(F.col("_i.type")), F.lit("")).isin("", "journal-article"))
    i = F.col("_i")
    kept = dedupe.by_first_key(kept, [journal], [F.lower(X.strip(i["DOI"])), i["URL"], F.array_join(i["title"], " ")], order)
    kept = filters.top_in_group(kept, [journal], [F.col(order)], most)
    title = F.coalesce(F.get(i["title"], F.lit(0)), F.lit(""))
    link = F.coalesce(X.blank_to_null(i["resource"]["primary"]["URL"]), i["URL"], F.lit(""))
    ident = X.stable_id(label, F.coalesce(X.blank_to_null(i["DOI"]), title), title)
    return kept.select(order, journal, ident.alias("paper_id"), label.alias("source"), D.stated_parts(i, list(JOURNAL_DATES)).alias("date"), *finalized(title, full_names(i["author"]), i["abstract"], link))


def of_server(item: Column) -> Column:
    """Whether a registry item comes from the preprint server, by any of its five marks."""
    joined = lambda c: F.coalesce(F.array_join(c, " "), F.lit(""))
    return (
        joined(item["container-title"]).contains(SERVER) | joined(item["short-container-title"]).contains(SERVER) | F.coalesce(item["group-title"] == SERVER, F.lit(False))
        | F.coalesce(F.lower(item["resource"]["primary"]["URL"]).contains(SERVER_HOST), F.lit(False)) | F.coalesce(F.lower(item["DOI"]).startswith(SERVER_PREFIX), F.lit(False))
    )


def preprint_rows(items: DataFrame, item: Column, order: str, group: str) -> DataFrame:
    """The server's records, one for each id with the query groups of all its finds in order of appearance."""
    kept = items.withColumn("_i", item).where(of_server(F.col("_i")))
    i = F.col("_i")
    doi, title = F.coalesce(i["DOI"], F.lit("")), F.coalesce(F.get(i["title"], F.lit(0)), F.lit(""))
    link = F.coalesce(X.blank_to_null(i["resource"]["primary"]["URL"]), i["URL"], F.lit(""))
    ident = X.stable_id(F.lit("ssrn"), F.when(doi != "", F.substring_index(doi, ".", -1)).otherwise(title), title)
    rows = kept.select(
        order, ident.alias("paper_id"), F.lit(SERVER).alias("source"), D.stated_parts(i, list(PREPRINT_DATES), 3).alias("date"), D.stated_parts(i, list(RECENCY_DATES), 3).alias("recency_date"),
        F.array(group).alias("query_groups"), *finalized(title, full_names(i["author"]), i["abstract"], link),
    )
    return dedupe.merged_provenance(rows, "paper_id", order, ["query_groups"])


def scholar_rows(items: DataFrame, item: Column, order: str, group: str) -> DataFrame:
    """Records of a scholarly graph: id is the DOI, else the preprint id, else its own id, else the title; no title, no record."""
    i = item
    title = X.squeeze(F.coalesce(i["title"], F.lit("")))
    own = X.strip(F.coalesce(i["paperId"], F.lit("")))
    ident = F.coalesce(X.blank_to_null(i["externalIds"]["DOI"]), X.blank_to_null(i["externalIds"]["ArXiv"]), X.blank_to_null(own), title)
    link = F.coalesce(X.blank_to_null(X.squeeze(i["url"])), F.when(own != "", F.concat(F.lit(SCHOLAR_STEM), own)), F.lit(""))
    rows = items.where(title != "").select(
        order, X.stable_id(F.lit("semanticscholar"), ident, title).alias("paper_id"), F.lit("Semantic Scholar").alias("source"), X.blank_to_null(X.squeeze(i["publicationDate"])).alias("date"),
        F.array(group).alias("query_groups"), *finalized(title, F.transform(i["authors"], lambda a: a["name"]), X.squeeze(i["abstract"]), link),
    )
    return dedupe.merged_provenance(rows, "paper_id", order, ["query_groups"])


def page_link(links: Column, ident: Column) -> Column:
    """Of a feed entry's links the first that leads to a page (no relation or ``alternate``, no type or HTML), else the entry's id."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit(""))
    fit = F.filter(links, lambda a: (blank(a["_href"]) != "") & blank(a["_rel"]).isin("", "alternate") & blank(a["_type"]).isin("", "text/html"))
    return F.coalesce(F.trim(F.get(fit, F.lit(0))["_href"]), ident)


def atom_rows(entries: DataFrame, entry: Column, order: str, group: str) -> DataFrame:
    """Records of feed entries: id is the last part of the entry's id (its version included), date that of the update."""
    e = entry
    ident = X.squeeze(F.coalesce(e["id"], F.lit("")))
    own = F.substring_index(F.regexp_replace(ident, "/+$", ""), "/", -1)
    title = X.squeeze(F.coalesce(e["title"], F.lit("")))
    when = F.coalesce(X.blank_to_null(X.squeeze(e["updated"])), X.blank_to_null(X.squeeze(e["published"])))
    rows = entries.select(
        order, X.stable_id(F.lit("arxiv"), own, title).alias("paper_id"), F.lit("arXiv").alias("source"), X.blank_to_null(F.substring(when, 1, 10)).alias("date"),
        F.array(group).alias("query_groups"), *finalized(title, F.transform(e["author"], lambda a: a["name"]), X.squeeze(e["summary"]), page_link(e["link"], ident)),
    )
    return dedupe.merged_provenance(rows, "paper_id", order, ["query_groups"])


# ---------------------------------------------------------------- bulk tables


def bulk_number(c: Column) -> Column:
    """``w123`` reads ``123``; other numbers stay, stripped."""
    x = X.strip(F.coalesce(c, F.lit("")))
    return F.regexp_replace(x, r"\A[wW](\p{Nd}+)\z", "$1")


def bulk_url(c: Column) -> Column:
    """Address of a bulk paper; a number without one of its letters gets ``w``."""
    x = X.strip(F.coalesce(c, F.lit("")))
    return F.when(x == "", "").otherwise(F.concat(F.lit(BULK_STEM), F.when(x.rlike(r"\A[whtc]"), x).otherwise(F.concat(F.lit("w"), x))))


def bulk_merge(titles: DataFrame, authors: DataFrame, dates: DataFrame, abstracts: DataFrame, refs: DataFrame, order: str = "nth") -> DataFrame:
    """paper, title, authors, published, year, doi, abstract of five bulk tables, each with ``paper`` and ``order``.

    Last row of a table wins, even if empty; authors are those of all rows, comma-separated, in order of appearance. The
    references fill an empty title or date with their first non-empty one, give the last non-empty doi, and their first
    authors where there are none. Every table is reduced to one row a paper before the joins, which share one partitioning.
    """
    keyed = lambda df: df.where(F.coalesce(F.col("paper"), F.lit("")) != "").withColumn("paper", bulk_number(F.col("paper")))
    last = lambda df, c, to: keyed(df).groupBy("paper").agg(F.max_by(F.coalesce(c, F.lit("")), order).alias(to))
    split = lambda c: F.filter(F.transform(F.split(c, ","), X.strip), lambda n: n != "")
    names = keyed(authors).select("paper", order, F.posexplode(split(F.col("name"))).alias("_p", "_v")).groupBy("paper", "_v").agg(F.min(F.struct(order, "_p")).alias("_o"))
    names = names.groupBy("paper").agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_v"))), lambda x: x["_v"]).alias("authors"))
    some = lambda c, to, by: by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", F.col(order))).alias(to)
    r = keyed(refs).groupBy("paper").agg(some("title", "_title", F.min_by), some("issue_date", "_date", F.min_by), some("doi", "doi", F.max_by), F.min_by(split(F.col("author")), F.when(F.size(split(F.col("author"))) > 0, F.col(order))).alias("_authors"))
    out = last(titles, F.col("title"), "title")
    for t in (names, last(dates, F.col("issue_date"), "published"), last(abstracts, F.col("abstract"), "abstract"), r):
        out = out.join(t, "paper", "full_outer")
    published = F.coalesce(X.blank_to_null(F.col("published")), F.col("_date"), F.lit(""))
    own = F.coalesce("authors", F.array().cast("array<string>"))
    return out.select(
        "paper", F.coalesce(X.blank_to_null(F.col("title")), F.col("_title"), F.lit("")).alias("title"), F.when(F.size(own) > 0, own).otherwise(F.coalesce("_authors", own)).alias("authors"), published.alias("published"),
        F.when(published.rlike("^[0-9]{4}"), F.substring(published, 1, 4).try_cast("int")).alias("year"), F.coalesce("doi", F.lit("")).alias("doi"), F.coalesce("abstract", F.lit("")).alias("abstract"),
    )


def bulk_rows(merged: DataFrame, most: int | None = None) -> DataFrame:
    """Records of merged bulk papers, latest first by (published, year, number) as texts; ``most``: only so many."""
    order = [F.col("published").desc(), F.coalesce("year", F.lit(0)).desc(), F.col("paper").desc()]
    d = merged.orderBy(*order)
    d = d.limit(most).withColumn("place", F.row_number().over(Window.orderBy(*order))) if most else d
    title = F.coalesce(X.blank_to_null(X.strip(F.col("title"))), F.col("paper"))
    return d.select(*(["place"] if most else []), "paper", X.stable_id(F.lit("nber"), F.col("paper"), title).alias("paper_id"), F.lit("NBER").alias("source"), X.blank_to_null(F.trim("published")).alias("date"), "doi", *finalized(title, F.col("authors"), X.strip(F.col("abstract")), bulk_url(F.col("paper"))))


# ---------------------------------------------------------------- payloads


def payload(df: DataFrame, *keep: str) -> DataFrame:
    """What a monitor hands on: id, source by its alias, title, authors, journal, published (else the year), doi, abstract, url."""
    source = F.lower(F.trim(F.coalesce("source", F.lit(""))))
    alias = F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return df.select(
        *keep, text("id").alias("id"), F.coalesce(F.try_element_at(alias, source), source).alias("source"), text("title").alias("title"), F.coalesce("authors", F.array().cast("array<string>")).alias("authors"), text("journal").alias("journal"),
        F.coalesce(X.blank_to_null(F.col("published")), F.col("year").cast("string"), F.lit("")).alias("published"), text("doi").alias("doi"), text("abstract").alias("abstract"), text("url").alias("url"),
    )


def from_payload(df: DataFrame, *keep: str) -> DataFrame:
    """Records rebuilt from payloads: stable id, stripped texts, derived address and title key."""
    strip = lambda c: X.strip(F.coalesce(F.col(c), F.lit("")))
    return df.select(*keep, X.stable_id(F.col("source"), F.coalesce(X.blank_to_null(strip("id")), strip("doi")), F.col("title")).alias("paper_id"), strip("source").alias("source"), X.blank_to_null(strip("published")).alias("date"), *finalized(strip("title"), F.col("authors"), strip("abstract"), strip("url")))


def of_source(df: DataFrame, wanted: str) -> DataFrame:
    """Rows of one source; ``all`` passes every row."""
    return df if wanted == "all" else df.where(F.col("source") == wanted)
