"""Best representative of each duplicate group: bundles of dependent fields, whole bundles chosen by branch and bound.

A *bundle* is a set of fields that must come from one row (a source with its category and address, a date with its row).
Every bundle of a group gets the candidate of least cost; costs add up, functional dependencies forbid candidates or
combinations. The root of the search tree is the combination of each bundle's best candidate: its cost is a lower bound
for every other, so where it is consistent the search ends there. Groups whose root breaks a dependency branch, over the
bundles that a dependency names; the others keep the root's choice, as they are independent of it.

Nothing is collected: the root is one partially aggregated ``min`` per bundle (a group that holds a third of all rows
shrinks on the map side), and branching is done level by level with joins on the group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.rejects import strip
from ..runtime import stage, table

# ---------------------------------------------------------------- values of one row

#: What ends a cut text.
CUT = r"(?i)(?:\s*(?:\.{3,}|…|\[?\.{3}\]?|[\[(](?:truncated|more|continued|cut|abridged)[\])]))+\s*$"
#: Notices that depositors append to abstracts (beginning of the last sentence up to the end).
NOTICE = (
    r"(?i)\s*(?:"
    r"The views (?:are those|expressed)\b[^.]*\.?"
    r"|Copyright (?:of|by|\(c\)|©)[^.]*\.?"
    r"|(?:©|\(c\)) ?[12][0-9]{3}\b[^.]*\.?"
    r"|All rights reserved\.?"
    r"|\[(?:Full text|Supplementary|Data|Replication)\b[^\]]*\]"
    r")\s*$"
)
#: Whole texts that only say there is no abstract.
NO_ABSTRACT = (
    r"(?i)^(?:[\W_]*|none\.?|null|nil|n/?a\.?|tba|tbd|"
    r"[\[(]?(?:an |the )?(?:abstract|summary)\b.{0,20}\b(?:missing|unavailable|forthcoming|pending|not (?:available|provided|supplied|given|found))\b.{0,80}|"
    r"no (?:abstract|summary)\b.{0,60}|"
    r"this (?:record|paper|item|entry) (?:was|is|has been|comes) (?:deposited |published )?without (?:an? )?(?:abstract|summary)\b.*)$"
)


def clean_abstract(c: Column) -> Column:
    """The text without markup, label, cut-off marks and appended notices; entities count as one character each."""
    x = F.regexp_replace(c, r"</?[A-Za-z][^<>]*>|<!--[\s\S]*?-->", "")
    x = F.regexp_replace(x, r"&(?:[A-Za-z]{2,8}|#[0-9]{1,7}|#x[0-9A-Fa-f]{1,6});", "&")
    x = F.trim(F.regexp_replace(x, r"[\s\x{85}\p{Z}]+", " "))
    x = F.regexp_replace(x, r"(?i)^(?:abstract|summary)\s*[:.\-–—]\s*", "")
    for pattern in (NOTICE, CUT, NOTICE, CUT):
        x = F.regexp_replace(x, pattern, "")
    return F.trim(x)


def title_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " "))


def real_abstract(abstract: Column, normalized_title: Column) -> Column:
    """The cleaned text, or null if it says there is none or only repeats the title (also a cut title)."""
    x = clean_abstract(abstract)
    key = title_key(x)
    cut = abstract.rlike(CUT)
    repeats = (key == normalized_title) | (cut & normalized_title.startswith(key))
    return F.when((x != "") & ~x.rlike(NO_ABSTRACT) & ~F.coalesce(repeats, F.lit(False)), x)


#: English month names by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH_WORD = r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"


def full_day(c: Column) -> Column:
    """DATE of a text that names an existing calendar day in full, else null."""
    x = F.lower(F.trim(F.regexp_replace(c, r"[\s\x{85}\p{Z}]+", " ")))
    number = r"^([0-9]{4})([-/.])([0-9]{1,2})\2([0-9]{1,2})(?:[t ][0-9:.]+ ?(?:z|[+-][0-9:]+)?)?$"
    day_first = rf"^([0-9]{{1,2}})(?:st|nd|rd|th)? {MONTH_WORD}\.?,? ([0-9]{{4}})$"
    month_first = rf"^{MONTH_WORD}\.? ([0-9]{{1,2}})(?:st|nd|rd|th)?,? ([0-9]{{4}})$"
    pick = lambda p, i: F.regexp_extract(x, p, i)
    by_name = F.create_map(*[F.lit(v) for i, m in enumerate(MONTHS, 1) for v in (m, f"{i:02d}")])
    month = lambda t: F.try_element_at(by_name, F.substring(t, 1, 3))
    iso = (
        F.when(x.rlike(number), F.concat_ws("-", pick(number, 1), F.lpad(pick(number, 3), 2, "0"), F.lpad(pick(number, 4), 2, "0")))
        .when(x.rlike(day_first), F.concat_ws("-", pick(day_first, 3), month(pick(day_first, 2)), F.lpad(pick(day_first, 1), 2, "0")))
        .when(x.rlike(month_first), F.concat_ws("-", pick(month_first, 3), month(pick(month_first, 1)), F.lpad(pick(month_first, 2), 2, "0")))
    )
    return F.when(~iso.startswith("0000"), iso.try_cast("date"))


#: Fixed value: an absolute http(s) address with a host.
HTTP = r"(?i)^https?://[^\s/?#@:]*[a-z0-9][^\s/?#]*(?:[/?#]\S*)?$"
LAST_RANK = 2**30


def source_key(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")))


def with_trust(df: DataFrame, trust: DataFrame) -> DataFrame:
    """Adds ``_rank``; a source that is not listed, or null, ranks last."""
    ranks = trust.groupBy(source_key(F.col("source")).alias("_key")).agg(F.min("trust_rank").alias("_listed")).where("_key is not null")
    return df.withColumn("_key", source_key(F.col("source"))).join(ranks, "_key", "left").withColumn("_rank", F.coalesce("_listed", F.lit(LAST_RANK))).drop("_key", "_listed")


# ---------------------------------------------------------------- the operator


@dataclass(frozen=True)
class Bundle:
    """Fields that one row supplies together. ``cost``: sort keys, least first; ``usable``: whether the row may supply it."""

    name: str
    usable: Column
    cost: Sequence[Column]


@dataclass(frozen=True)
class Dependency:
    """A functional dependency that the chosen candidates must keep.

    With ``on``, between two bundles: ``left`` is a value of the candidate of ``of``, ``right`` one of the candidate of
    ``on``; the pair (left, right) must stand together in some row of the group. Without ``on``, over the whole table:
    ``left`` must determine ``right``, so a value of ``left`` that stands with two of ``right``, in whatever rows, is no candidate's.
    A null on either side breaks nothing.
    """

    of: str
    left: Column
    right: Column
    on: str | None = None


def _between(deps: list[Dependency]) -> list[tuple[int, Dependency]]:
    return [(i, d) for i, d in enumerate(deps) if d.on is not None]


def _torn(df: DataFrame, d: Dependency) -> DataFrame:
    """The values of ``left`` that stand with two different values of ``right``."""
    pairs = df.select(d.left.alias("_l"), d.right.alias("_r")).where("_l is not null and _r is not null")
    return pairs.groupBy("_l").agg(F.min("_r").alias("_lo"), F.max("_r").alias("_hi")).where("_lo <> _hi").select("_l")


def rooted(df: DataFrame, group: Sequence[str], order: str, bundles: Sequence[Bundle], dependencies: Sequence[Dependency] = ()) -> DataFrame:
    """The search tree's roots: group, for each bundle its best row, ``_v``: its values in dependencies, ``_broken``: the numbers of those broken."""
    deps = list(dependencies)
    sides = {b.name: [(f"_{s}{i}", c) for i, d in enumerate(deps) for s, of, c in (("l", d.of, d.left), ("r", d.on, d.right)) if of == b.name] for b in bundles}
    keys = [F.col(f"`{g}`") for g in group]
    base = reduce(lambda d, g: d.where(F.col(f"`{g}`").isNotNull()), group, df)
    best = [F.min(F.when(b.usable & F.col(order).isNotNull(), F.struct(*[c.alias(f"c{i}") for i, c in enumerate(b.cost)], F.col(order).alias("_at"), *[c.alias(n) for n, c in sides[b.name]]))).alias(f"_{b.name}") for b in bundles]
    root = base.groupBy(*keys).agg(F.count("*").alias("_n"), *best).where("_n >= 2")
    root = root.select(*keys, *[F.col(f"_{b.name}._at").alias(b.name) for b in bundles], *[F.col(f"_{b.name}.{n}").alias(n) for b in bundles for n, _ in sides[b.name]])
    for i, d in enumerate(deps):
        if d.on is None:
            root = root.join(_torn(df, d).select(F.col("_l").alias(f"_l{i}"), F.lit(True).alias(f"_b{i}")), f"_l{i}", "left")
        else:
            pairs = base.select(*group, d.left.alias(f"_l{i}"), d.right.alias(f"_r{i}"), F.lit(True).alias("_ok")).distinct()
            root = root.join(pairs, [*group, f"_l{i}", f"_r{i}"], "left").withColumn(f"_b{i}", F.col(f"_l{i}").isNotNull() & F.col(f"_r{i}").isNotNull() & F.col("_ok").isNull()).drop("_ok")
    broken = F.array_compact(F.array(*[F.when(F.coalesce(f"_b{i}", F.lit(False)), F.lit(i)) for i in range(len(deps))]).cast("array<int>"))
    return root.select(*keys, *[b.name for b in bundles], broken.alias("_broken"))


def survivors(df: DataFrame, group: Sequence[str], order: str, bundles: Sequence[Bundle], dependencies: Sequence[Dependency] = ()) -> DataFrame:
    """One row for each group of two rows or more: for each bundle the ``order`` value of the row that supplies it, or null.

    Rows with a null in ``group`` belong to no group. Ties go to the lower ``order``; a null ``order`` is never chosen.
    A bundle without a usable row is null. An empty table gives no rows. If no combination satisfies the dependencies,
    the bundles named in ``of`` of a broken dependency are null.
    """
    root = rooted(df, group, order, bundles, dependencies)
    if not dependencies:
        return root.drop("_broken")
    return _branch(df, stage(root, "golden"), list(group), order, list(bundles), list(dependencies))


def _branch(df: DataFrame, root: DataFrame, group: list[str], order: str, bundles: list[Bundle], deps: list[Dependency]) -> DataFrame:
    """Level by level over the open groups: partial choices x candidates of the next bundle, cut where a dependency breaks."""
    names = [b.name for b in bundles]
    fine = root.where(F.size("_broken") == 0).select(*group, *names)
    open_ = root.where(F.size("_broken") > 0)
    base = reduce(lambda d, g: d.where(F.col(f"`{g}`").isNotNull()), group, df).join(open_.select(*group), group, "left_semi")
    tied = [b for b in bundles if any(b.name in (d.of, d.on) for d in deps)]
    free = [n for n in names if n not in {b.name for b in tied}]
    pairs = {i: base.select(*group, d.left.alias(f"_l{i}"), d.right.alias(f"_r{i}"), F.lit(True).alias("_ok")).where(f"_l{i} is not null and _r{i} is not null").distinct() for i, d in _between(deps)}
    partial, done = open_.select(*group, F.lit(0).cast("long").alias("_cost")), []
    for b in tied:
        # Of candidates with equal values in the dependencies only the best can be part of an optimum (dominance).
        sig = [(f"_{s}{i}", c) for i, d in _between(deps) for s, of, c in (("l", d.of, d.left), ("r", d.on, d.right)) if of == b.name]
        own = base.where(b.usable & F.col(order).isNotNull())
        for d in deps:
            if d.on is None and d.of == b.name:
                own = own.withColumn("_l", d.left).join(_torn(df, d), "_l", "left_anti")
        own = own.groupBy(*group, *[c.alias(n) for n, c in sig]).agg(F.min(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(b.cost)], F.col(order).alias("_at"))).alias("_s"))
        place = F.row_number().over(Window.partitionBy(*group).orderBy("_s")) - 1 if sig else F.lit(0)
        own = own.select(*group, *[n for n, _ in sig], F.col("_s._at").alias(b.name), place.alias("_more"))
        partial = partial.join(own, group, "left").withColumn("_cost", F.col("_cost") + F.coalesce("_more", F.lit(0))).drop("_more")
        done.append(b.name)
        for i, d in _between(deps):
            if {d.of, d.on} <= set(done) and b.name in (d.of, d.on):
                partial = partial.join(pairs[i], [*group, f"_l{i}", f"_r{i}"], "left").where(F.col(f"_l{i}").isNull() | F.col(f"_r{i}").isNull() | F.col("_ok")).drop("_ok")
        # Among partial choices with equal values still needed, only the cheapest can lead to the optimum.
        need = [f"_{s}{i}" for i, d in _between(deps) if not {d.of, d.on} <= set(done) for s, of in (("l", d.of), ("r", d.on)) if of in done]
        partial = partial.groupBy(*group, *need).agg(F.min(F.struct("_cost", *done)).alias("_s")).select(*group, *need, "_s.*")
    solved = open_.select(*group, *free).join(partial.drop("_cost"), group).select(*group, *names)
    if not _between(deps):
        return fine.unionByName(solved)
    solved = stage(solved, "golden")
    unsolved = open_.join(solved.select(*group), group, "left_anti")
    for i, d in enumerate(deps):
        unsolved = unsolved.withColumn(d.of, F.when(~F.array_contains("_broken", i), F.col(d.of)))
    return fine.unionByName(solved).unionByName(unsolved.select(*group, *names))


# ---------------------------------------------------------------- papers


def paper_values(papers: DataFrame, trust: DataFrame) -> DataFrame:
    """row_no, normalized_title (null where empty), and what the bundles judge: _length, _day, _source, _rank, _url."""
    p = papers.select("row_no", "normalized_title", "abstract", "date", "source", "canonical_url", "fetched_at")
    p = with_trust(p, trust)
    title, url, source = F.col("normalized_title"), strip(F.col("canonical_url")), source_key(F.col("source"))
    day = full_day(F.col("date"))
    return p.select(
        "row_no", F.when(title != "", title).alias("normalized_title"), F.coalesce(title, F.lit("")).alias("_title"), "_rank",
        F.length(real_abstract(F.col("abstract"), title)).alias("_length"),
        F.when(F.col("fetched_at").isNull() | (day <= F.to_date("fetched_at")), F.unix_date(day)).alias("_day"),
        F.when(source != "", source).alias("_source"), F.when(url.rlike(HTTP), url).alias("_url"),
    )


def address() -> Dependency:
    """An address that stands under two titles (an empty one too) identifies neither."""
    return Dependency("canonical_url", F.col("_url"), F.col("_title"))


def field_bundles() -> list[Bundle]:
    """Every field for itself: each may come from another row."""
    return [
        Bundle("abstract", F.col("_length") > 0, [-F.col("_length")]),
        Bundle("date", F.col("_day").isNotNull(), [-F.col("_day")]),
        Bundle("source", F.col("_source").isNotNull(), [F.col("_rank")]),
        Bundle("canonical_url", F.col("_url").isNotNull(), [F.col("_rank")]),
    ]


def origin_bundles() -> tuple[list[Bundle], list[Dependency]]:
    """Source and address from one row; the date must be one that the chosen source gave the work."""
    origin = Bundle("canonical_url", F.col("_url").isNotNull() & F.col("_source").isNotNull(), [F.col("_rank")])
    return [origin, *[b for b in field_bundles() if b.name in ("date", "abstract")]], [address(), Dependency("date", F.col("_day"), F.col("_source"), on="canonical_url")]


def paper_survivors(papers: DataFrame, trust: DataFrame) -> DataFrame:
    """normalized_title and, for abstract, date, source and canonical_url, the row_no that supplies it (null if none can).

    Groups: one non-empty normalized_title, two rows or more. The address must determine the title over all rows; groups
    whose most trusted address does not branch to the next. A null fetched_at bounds no date.
    """
    return survivors(paper_values(papers, trust), ["normalized_title"], "row_no", field_bundles(), [address()])


FIELDS = ("abstract", "date", "source", "canonical_url")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_no, field: the row of papers that supplies the field of its group."""
    best = paper_survivors(table(spark, sf_dir, "papers"), table(spark, sf_dir, "source_trust"))
    return best.select(F.explode(F.array(*[F.struct(F.col(f).alias("row_no"), F.lit(f).alias("field")) for f in FIELDS])).alias("x")).select("x.row_no", "x.field").where("row_no is not null")


def p2_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """normalized_title, origin (row of source and address), date and abstract rows of each group, consistent with each other."""
    values = paper_values(table(spark, sf_dir, "papers"), table(spark, sf_dir, "source_trust"))
    best = survivors(values, ["normalized_title"], "row_no", *origin_bundles())
    return best.select("normalized_title", F.col("canonical_url").alias("origin"), F.col("date").alias("day"), "abstract")


QUERIES = {"p2_found": p2_found, "p2_bundles": p2_bundles}

_WS = r"[\s\x{85}\p{Z}]+"
_Q = lambda s: "'" + s.replace("'", "''") + "'"


def _sql(select: str) -> str:
    x = f"trim(regexp_replace(regexp_replace(regexp_replace(abstract, '</?[A-Za-z][^<>]*>|<!--[\\s\\S]*?-->', '', 'g'), '&(?:[A-Za-z]{{2,8}}|#[0-9]{{1,7}}|#x[0-9A-Fa-f]{{1,6}});', '&', 'g'), '{_WS}', ' ', 'g'))"
    x = f"regexp_replace({x}, '(?i)^(?:abstract|summary)\\s*[:.\\-–—]\\s*', '')"
    for pattern in (NOTICE, CUT, NOTICE, CUT):
        x = f"regexp_replace({x}, {_Q(pattern)}, '')"
    d = f"lower(trim(regexp_replace(date, '{_WS}', ' ', 'g')))"
    clock = "(?:[t ][0-9:.]+ ?(?:z|[+-][0-9:]+)?)?$"
    number = "|".join(f"^([0-9]{{4}}){s}([0-9]{{1,2}}){s}([0-9]{{1,2}}){clock}" for s in ("-",))
    return rf"""
with trust as (select lower(trim(source)) k, min(trust_rank) r from source_trust group by 1),
b as (select row_no, coalesce(normalized_title, '') t, abstract, {d} d, fetched_at, lower(trim(source)) s, trim(canonical_url) u from papers),
c as (select *, trim({x}) x, coalesce(r, 1073741824) rank from b left join trust on k = s),
e as (select *, trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')) xk,
  coalesce(try_strptime(replace(replace(d, '/', '-'), '.', '-'), '%Y-%m-%d'), try_strptime(d, '%d %b %Y'), try_strptime(d, '%d %B %Y'), try_strptime(d, '%b %d, %Y'), try_strptime(d, '%B %d, %Y'))::date dd from c),
f as (select *, case when x <> '' and not regexp_matches(x, {_Q(NO_ABSTRACT)}) and xk <> t and not (regexp_matches(abstract, {_Q(CUT)}) and starts_with(t, xk)) then length(x) end len,
  case when year(dd) > 0 and dd <= coalesce(fetched_at::date, dd) then dd end dday, regexp_matches(u, {_Q(HTTP)}) http from e),
g as (select t from f where t <> '' group by 1 having count(*) > 1),
lone as (select u from f where http group by 1 having count(distinct t) = 1),
{select}"""


_FOUND = """o as (select row_no, 'abstract' field, row_number() over (partition by t order by len desc, row_no) n from f where len > 0 and t in (from g)
  union all select row_no, 'date', row_number() over (partition by t order by dday desc, row_no) from f where dday is not null and t in (from g)
  union all select row_no, 'source', row_number() over (partition by t order by rank, row_no) from f where s <> '' and t in (from g)
  union all select row_no, 'canonical_url', row_number() over (partition by t order by rank, row_no) from f where http and u in (from lone) and t in (from g))
select row_no, field from o where n = 1"""
#: Brute force over all combinations of an origin and a date of each group; a missing one is a candidate only where there is none.
_BUNDLES = """
r0 as (select t, arg_min(row_no, (rank, row_no)) u0 from f where http and s <> '' group by 1),
d0 as (select t, arg_min(row_no, (-date_diff('day', date '1970-01-01', dday), row_no)) v0 from f where dday is not null group by 1),
torn as (select u from f where http group by 1 having count(distinct t) > 1),
broken as (select t, coalesce((select u from f where row_no = u0) in (from torn), false) b0,
   coalesce(u0 is not null and v0 is not null and not exists (select 1 from f x where x.t = g.t and x.dday = (select dday from f where row_no = v0) and x.s = (select s from f where row_no = u0)), false) b1, u0, v0
   from g left join r0 using (t) left join d0 using (t)),
uc as (select t, s, min((rank, row_no)) o from f where http and s <> '' and u not in (from torn) group by 1, 2),
ur as (select t, s, o[2] row_no, row_number() over (partition by t order by o) - 1 k from uc),
dc as (select t, dday, min((-date_diff('day', date '1970-01-01', dday), row_no)) o from f where dday is not null group by 1, 2),
dr as (select t, dday, o[2] row_no, row_number() over (partition by t order by o) - 1 k from dc),
combo as (select t, ur.row_no u1, dr.row_no v1, coalesce(ur.k, 0) + coalesce(dr.k, 0) k from broken left join ur using (t) left join dr using (t)
   where (b0 or b1) and (ur.s is null or dr.dday is null or exists (select 1 from f x where x.t = broken.t and x.dday = dr.dday and x.s = ur.s))),
best as (select t, arg_min((u1, v1), (k, coalesce(u1, -1), coalesce(v1, -1))) c from combo group by 1),
ab as (select t, arg_min(row_no, (-len, row_no)) a from f where len > 0 group by 1)
select t normalized_title, case when not b0 and not b1 then u0 when c is not null then c[1] when not b0 then u0 end origin,
  case when not b0 and not b1 then v0 when c is not null then c[2] when not b1 then v0 end as day, a abstract
from broken left join best using (t) left join ab using (t)"""

SQL = {"p2_found": _sql(_FOUND), "p2_bundles": _sql(_BUNDLES)}
