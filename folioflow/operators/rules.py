"""Grouped phrase rules compiled to Columns: hits by group and field, bucket requirements, scores, best bucket.

A configuration is data (groups of phrases, buckets, weights). Its phrases become literal regexps, compiled once per
task; each is guarded by a plain search for its first word. Weights are decimals until the end, so sums are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_phrase
from ..runtime import spread

FIELDS = ("title", "abstract", "authors")


@dataclass(frozen=True)
class Bucket:
    """What a record must hit to fall into the bucket; empty lists require nothing."""

    name: str
    require_all: Sequence[str] = ()
    require_any: Sequence[str] = ()
    title_any: Sequence[str] = ()
    title_or_abstract_any: Sequence[str] = ()
    optional_any: Sequence[str] = ()
    penalty: Sequence[str] = ()
    least_hits: int = 1
    bonus: str = "0"


@dataclass(frozen=True)
class Extra:
    """A bonus of its own where any of the groups is hit in one of the fields; ``bucket``: only for that bucket."""

    groups: Sequence[str]
    weight: str
    fields: Sequence[str] = FIELDS
    bucket: str | None = None


@dataclass(frozen=True)
class Rules:
    """Groups of phrases; weights: of a hit by field, and of each satisfied requirement; extras: bonuses of single groups."""

    groups: Mapping[str, Sequence[str]]
    buckets: Sequence[Bucket]
    exclude: Sequence[str] = ()
    field_weights: Mapping[str, str] = field(default_factory=lambda: {"title": "2", "abstract": "1", "authors": "0.5"})
    weights: Mapping[str, str] = field(default_factory=dict)
    extras: Sequence[Extra] = ()


def from_config(config: Mapping) -> Rules:
    """Rules of a loaded configuration: groups, buckets (their requirements by name), exclude, field_weights, weights, extras.

    Numbers may be given as such. Unknown keys of a bucket or an extra are refused; missing parts keep their defaults.
    """
    text = lambda m: {k: str(v) for k, v in (m or {}).items()}
    buckets = [Bucket(name, **{k: str(v) if k == "bonus" else v for k, v in (b or {}).items()}) for name, b in (config.get("buckets") or {}).items()]
    extras = [Extra(**{k: str(v) if k == "weight" else v for k, v in x.items()}) for x in config.get("extras") or []]
    more = {"field_weights": text(config["field_weights"])} if config.get("field_weights") else {}
    return Rules(groups=config.get("groups") or {}, buckets=buckets, exclude=config.get("exclude") or (), weights=text(config.get("weights")), extras=extras, **more)


def _number(x: str) -> Column:
    return F.lit(Decimal(x)).cast("decimal(9,3)")


def hits(text: Column, phrases: Sequence[str]) -> Column:
    """Sorted ARRAY of the distinct phrases in the lower-case text."""
    return F.array_compact(F.array(*[F.when(has_phrase(text, p), F.lit(p)) for p in sorted(set(phrases))]))


def with_hits(df: DataFrame, rules: Rules) -> DataFrame:
    """Adds ``hits``: one struct of (title, abstract, authors) phrase arrays for each group, and their sizes ``_n_group_field``.

    Arrays and sizes are columns of their own: as they are used many times, the optimizer keeps them in a projection
    below the scores instead of repeating every regexp in each of them. ``authors`` may be an array.
    """
    kinds = dict(df.dtypes)
    lower = {f"_l_{f}": F.lower(F.coalesce(F.array_join(f, " ") if kinds[f].startswith("array") else F.col(f), F.lit(""))) for f in FIELDS}
    text = {f: F.col(f"_l_{f}") for f in FIELDS}
    found = spread(df).withColumns(lower).withColumns({f"_h_{g}_{f}": hits(text[f], phrases) for g, phrases in rules.groups.items() for f in FIELDS})
    sized = found.withColumns({f"_n_{g}_{f}": F.size(f"_h_{g}_{f}") for g in rules.groups for f in FIELDS})
    whole = F.struct(*[F.struct(*[F.col(f"_h_{g}_{f}").alias(f) for f in FIELDS]).alias(g) for g in rules.groups])
    return sized.withColumn("hits", whole).drop(*lower, *[f"_h_{g}_{f}" for g in rules.groups for f in FIELDS])


def long_hits(df: DataFrame, rules: Rules, ident: str) -> DataFrame:
    """One row (ident, phrase_group, field, phrase) for each hit."""
    d = with_hits(df, rules)

    def rows_of(g: str, f: str) -> Column:
        return F.transform(F.col(f"hits.{g}.{f}"), lambda p: F.struct(F.lit(g).alias("phrase_group"), F.lit(f).alias("field"), p.alias("phrase")))

    rows = F.flatten(F.array(*[rows_of(g, f) for g in rules.groups for f in FIELDS]))
    return d.select(ident, F.explode(rows).alias("h")).select(ident, "h.*")


def _n(g: str, f: str) -> Column:
    return F.col(f"_n_{g}_{f}")


def _total(g: str) -> Column:
    return sum((_n(g, f) for f in FIELDS[1:]), _n(g, FIELDS[0]))


def _some(groups: Sequence[str], fields: Sequence[str]) -> Column:
    out = F.lit(False)
    for g in groups:
        for f in fields:
            out = out | (_n(g, f) > 0)
    return out


def base_score(rules: Rules) -> Column:
    """Weighted number of hits over all groups and fields."""
    out = _number("0")
    for g in rules.groups:
        for f in FIELDS:
            out = out + _n(g, f) * _number(rules.field_weights[f])
    return out.cast("decimal(18,3)")


def bucket_match(b: Bucket, rules: Rules) -> Column:
    """Whether the bucket's requirements hold."""
    ok = F.lit(True)
    for g in b.require_all:
        ok = ok & (_total(g) > 0)
    if b.require_any:
        ok = ok & _some(b.require_any, FIELDS)
    if b.title_any:
        ok = ok & _some(b.title_any, ["title"])
    if b.title_or_abstract_any:
        ok = ok & _some(b.title_or_abstract_any, ["title", "abstract"])
    wanted = list(dict.fromkeys([*b.require_all, *b.require_any, *b.optional_any]))
    own = sum((_total(g) for g in wanted), F.lit(0))
    every = sum((_total(g) for g in rules.groups), F.lit(0))
    return ok & (F.when(own > 0, own).otherwise(every) >= b.least_hits)


def bucket_score(b: Bucket, rules: Rules) -> Column:
    """Base score, bonuses of the requirements that hold, the bucket's own bonus, less the penalty groups' hits."""
    w = lambda k: _number(rules.weights.get(k, "0"))
    add = lambda cond, k: F.when(cond, w(k)).otherwise(_number("0"))
    every = F.lit(True)
    for g in b.require_all:
        every = every & (_total(g) > 0)
    out = base_score(rules) + _number(b.bonus) + add(every, "require_all")
    if b.require_any:
        out = out + add(_some(b.require_any, FIELDS), "require_any")
    out = out + add(_some(b.title_any, ["title"]) if b.title_any else F.lit(True), "title_any")
    out = out + add(_some(b.title_or_abstract_any, ["title", "abstract"]) if b.title_or_abstract_any else F.lit(True), "title_or_abstract_any")
    for g in b.optional_any:
        out = out + add(_total(g) > 0, "optional_any")
    out = out + add(_some([*b.require_all, *b.require_any], ["abstract"]), "abstract")
    for x in rules.extras:
        if x.bucket in (None, b.name):
            out = out + F.when(_some(x.groups, x.fields), _number(x.weight)).otherwise(_number("0"))
    for g in b.penalty:
        out = out - _total(g) * w("penalty")
    return out.cast("decimal(18,3)")


def decide(df: DataFrame, rules: Rules) -> DataFrame:
    """Adds matched, bucket, score, bucket_scores: the best matching bucket, the earliest listed of equals.

    A hit in an excluded group vetoes: unmatched, score 0, no bucket scores. Unmatched rows score their base score.
    """
    d = with_hits(df, rules)
    veto = _some(rules.exclude, FIELDS)
    scored = d.withColumns({f"_s{i}": bucket_score(b, rules) for i, b in enumerate(rules.buckets)} | {f"_m{i}": bucket_match(b, rules) for i, b in enumerate(rules.buckets)} | {"_veto": veto, "_base": base_score(rules)})
    best = F.array_max(F.array_compact(F.array(*[F.when(F.col(f"_m{i}"), F.struct(F.col(f"_s{i}").alias("score"), F.lit(-i).alias("nth"), F.lit(b.name).alias("name"))) for i, b in enumerate(rules.buckets)])))
    scored = scored.withColumn("_best", F.when(~F.col("_veto"), best))
    score = F.when(F.col("_veto"), 0.0).otherwise(F.coalesce(F.col("_best.score"), F.col("_base")).cast("double"))
    every = F.map_from_arrays(F.array(*[F.lit(b.name) for b in rules.buckets]), F.array(*[F.col(f"_s{i}").cast("double") for i in range(len(rules.buckets))]))
    out = scored.withColumns({"matched": F.col("_best").isNotNull(), "bucket": F.col("_best.name"), "score": score, "bucket_scores": F.when(~F.col("_veto"), every)})
    return out.drop("_veto", "_base", "_best", *[f"_{k}{i}" for k in "sm" for i in range(len(rules.buckets))], *[f"_n_{g}_{f}" for g in rules.groups for f in FIELDS])


def profile_match(rules: Rules, require_all: Sequence[str] = (), require_any: Sequence[str] = (), title_all: Sequence[str] = (), least_hits: int = 1) -> Column:
    """A rule set without buckets: all required groups, all of ``title_all`` in the title, enough hits, no excluded group."""
    b = Bucket("", require_all=require_all, require_any=require_any)
    ok = bucket_match(b, rules) & ~_some(rules.exclude, FIELDS)
    for g in title_all:
        ok = ok & (_n(g, "title") > 0)
    return ok & (sum((_total(g) for g in rules.groups), F.lit(0)) >= least_hits)
