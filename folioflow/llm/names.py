"""Variant spellings of names of people and organisations.

Every distinct string is read once into a core token (surname, or the name proper of an organisation), a given name or
its initial, a middle initial, and the list of its tokens. Core tokens with slips, and given names with slips within one
core, are found through a symmetric-delete neighbourhood index: two tokens within two edits share a string that both
reach by deletions, so an equality join finds them. All tokens of each candidate pair are then aligned by optimal
assignment, permitting initials, short forms and slips, and the rarer spelling takes the core of the better supported one,
as far as such steps lead. Names with equal core and agreeing given names are one person; spellings that leave the given
name open (an initial, a short form of several names) join the only person they fit.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import ship, stage, table
from .history import osa

#: English given names and their short forms.
SHORT_FORMS = """
alexander: alex sasha sandy al xander
alexandra: alex sasha sandra sandy
anthony: tony
barbara: babs barb
benjamin: ben benny
catherine: cathy kate cath cat
charles: chuck charlie
christopher: chris kit
daniel: dan danny
david: dave davy
deborah: debbie deb
dorothy: dot dottie dolly
edward: ted ed eddie ned
eleanor: nell ellie nora
elizabeth: liz beth lizzie betty eliza
francis: frank
frederick: fred freddie
gabriel: gabe
gerald: jerry gerry
gregory: greg
harold: harry hal
henry: hank harry
isabella: bella izzy
jacob: jake
james: jim jimmy jamie
jennifer: jenny jen
jessica: jess jessie
john: jack johnny
joseph: joe joey
joshua: josh
judith: judy jude
katherine: kate kathy kat katie
kenneth: ken kenny
lawrence: larry laurie
leonard: len lenny leo
leonardo: leo
louise: lou
magdalena: lena magda
margaret: peggy maggie meg
matthew: matt
maximilian: max
michael: mike mick
nathaniel: nate nat
nicholas: nick
pamela: pam
patricia: pat patty tricia
peter: pete
philip: phil
rebecca: becky becca
richard: dick rick rich
robert: bob rob bobby
ronald: ron ronnie
rosemary: rosie rose
samuel: sam sammy
sebastian: seb bastian
stephanie: steph
susan: sue susie
theodore: ted theo teddy
theresa: tess terry tessa
thomas: tom tommy
timothy: tim
valentina: val
victoria: vicky tori
vincent: vince vinny
walter: walt wally
william: bill will billy
zachary: zach zack
andrew: andy drew
stephen: steve
jonathan: jon
abigail: abby
"""
#: Kinds of organisations and how they are shortened; the first letter stands for them in acronyms.
ORGANISATIONS = """
university: univ uni
institute: inst
laboratory: lab labs laboratories
foundation: fdn found fndn
center: ctr centre cent
association: assoc assn
department: dept
college: coll
school: sch
society: soc
academy: acad
council: cncl
bureau: bur
agency: agcy
bank: bk
group: grp
"""
#: Words that name nobody, titles and degrees, and words that organisations' spellings drop or add.
NOBODY = frozenset("anonymous|anon|unknown|none|null|nil|na|n a|et al|et alii|and others|others|various|various authors|author|authors|no author|no authors|staff|editor|editors|tba|tbd|not available|not provided|unnamed|multiple authors|author unknown|name withheld|withheld".split("|"))
TITLES = frozenset("prof professor dr phd ph md mr mrs ms miss sir jr sr esq msc mba".split())
LINKS = frozenset("the of for and in on at de la le du des und fur et".split())

FORMS: dict[str, list[str]] = {}
SHORT: dict[str, list[str]] = {}
for _line in SHORT_FORMS.split("\n"):
    if ":" in _line:
        _full, _, _rest = _line.partition(":")
        FORMS[_full] = _rest.split()
        for _s in FORMS[_full]:
            SHORT.setdefault(_s, []).append(_full)
KINDS = {w: a.strip() for line in ORGANISATIONS.split("\n") if ":" in line for a, _, b in [line.partition(":")] for w in [a.strip(), *b.split()]}
GIVEN = frozenset(FORMS) | frozenset(SHORT)


def plain(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def deletions(word: str) -> list[str]:
    """The word and what is left of it after up to two deletions (one in words under seven letters, none under four)."""
    most = 2 if len(word) >= 7 else 1 if len(word) >= 4 else 0
    return sorted({"".join(c for i, c in enumerate(word) if i not in cut) for k in range(most + 1) for cut in combinations(range(len(word)), k)})


#: Deletions of the known names, for the same look-up as between any two tokens.
_NEAR: dict[str, list[str]] = {}
for _full in FORMS:
    for _x in deletions(_full):
        _NEAR.setdefault(_x, []).append(_full)


@lru_cache(1 << 16)
def given_of(token: str) -> list[str]:
    """The full names that a given name may stand for; one slip in a known name is mended; [] if unknown."""
    if token in FORMS:
        return [token]
    if token in SHORT:
        return SHORT[token]
    if len(token) >= 4:
        met = {g for x in deletions(token) for g in _NEAR.get(x, ())}
        apart = [(osa(token, g, 2), g) for g in met]
        for most in (1, 2) if len(token) >= 6 else (1,):
            near = sorted(g for d, g in apart if d <= most)
            if near:
                return [g for g in near if g[0] == token[0]] or near
    return []


def read_name(raw: str | None) -> tuple | None:
    """(kind, core, options, initial, middle, sure, tokens): options are the full given names it may stand for, '' initial if none.

    For organisations the initials of kind and field, sorted, take the given name's place. Tokens are the core and the
    words beside it, kinds of organisations in full. None if it names nobody.
    """
    text = re.sub(r"[’'`]", "", plain(raw or "")).strip()
    flat = re.sub(r"[\W_]+", " ", text).strip().lower()
    if not re.search(r"[^\W\d_]", flat) or flat in NOBODY:
        return None
    halves = [h for h in (x.strip() for x in text.split(",")) if h]
    low = [[t for t in re.findall(r"[^\W_]+", re.sub(r"(?<=\w)-(?=\w)", "", h))] for h in halves]
    # "JR Surname" in mixed case is a pair of initials, not a title.
    low = [[t for k, t in enumerate(h) if t.lower() not in TITLES or (k == 0 and len(h) > 1 and len(t) == 2 and t.isupper() and not text.isupper())] for h in low]
    low = [h for h in low if h]
    if not low:
        return None
    tokens = [t for h in low for t in h]
    words = [t.lower() for t in tokens]
    acronym = next((t for t in tokens if re.fullmatch(r"[A-Z]{3,5}", t)), None) if len(tokens) == 2 and not text.isupper() else None
    if any(w in KINDS for w in words) or (acronym and acronym.lower() not in GIVEN):
        rest = [w for w in words if w not in LINKS]
        if acronym:
            core = next((w for t, w in zip(tokens, words) if t != acronym), words[0])
            return ("org", core, ["".join(sorted(acronym.lower()))], "", "", True, [core])
        proper = [w for w in (low[-1] if len(low) > 1 and not any(t.lower() in KINDS for t in low[-1]) else low[0]) for w in [w.lower()] if w not in LINKS and w not in KINDS]
        if not proper:
            proper = [w for w in rest if w not in KINDS] or rest
        core = proper[0]
        others = list(rest)
        others.remove(core)
        letters = sorted((KINDS[w][0] if w in KINDS else w[0]) for w in others)
        return ("org", core, ["".join(letters)], "", "", True, [core, *(KINDS.get(w, w) for w in others)])
    long = [w for w in words if len(w) > 1]
    # Initials written together, as in "GF Surname".
    runs = [t.lower() for t in tokens if re.fullmatch(r"[A-Z]{2,3}", t) and not text.isupper() and len(long) > 1]
    if len(low) > 1:
        last = "".join(w.lower() for w in low[0])
        given = [w.lower() for h in low[1:] for w in h]
        caps = {t.lower() for h in low[1:] for t in h if re.fullmatch(r"[A-Z]{2,3}", t)}
        given = [c for g in given for c in (list(g) if g in caps and g not in GIVEN and len(given) == 1 else [g])]
        sure = True
    else:
        full = [w for w in long if w not in runs]
        if not full:
            return ("person", flat, [], "", "", True, [flat])
        initials = [w for w in words if len(w) == 1] + [c for r in runs for c in r]
        if len(full) == 1:
            last, given, sure = full[0], initials, True
        else:
            exact = [w in GIVEN for w in full]
            known = exact if any(exact) else [bool(given_of(w)) for w in full]
            first = exact.index(True) if any(exact) else known.index(True) if any(known) else 0
            sure = any(known)
            lead = full[first]
            if len(full) == 2:
                last, given = full[1 - first], [lead, *initials]
            elif first == 0:
                last, given = full[-1], [lead, *full[1:-1], *initials]
            else:
                last, given = "".join(full[:first]), [lead, *full[first + 1 :], *initials]
    if not given:
        return ("person", last, [], "", "", True, [last])
    tokens = [last, *given]
    lead, middle = given[0], given[1][0] if len(given) > 1 else ""
    if len(lead) == 1:
        return ("person", last, [], lead, middle, True, tokens)
    options = given_of(lead) or [lead]
    tokens[1] = options[0] if len(options) == 1 else lead
    return ("person", last, sorted(options), lead[0], middle, sure, tokens)


READ = T.StructType([T.StructField("name", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("core", T.StringType()), T.StructField("options", T.ArrayType(T.StringType())), T.StructField("initial", T.StringType()), T.StructField("middle", T.StringType()), T.StructField("tokens", T.ArrayType(T.StringType()))])


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(n, *r[:5], r[6]) for n in b["name"] if (r := read_name(n)) is not None and r[1]]
        yield pd.DataFrame(rows, columns=[f.name for f in READ.fields])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _deletions(words: pd.Series) -> pd.Series:
    return words.map(deletions)


def token_cost(a: str, b: str) -> float | None:
    """0 for equal tokens, more for short forms, initials and slips; None if they cannot mean the same."""
    if a == b:
        return 0.0
    if len(a) == 1 or len(b) == 1:
        return 0.3 if a[0] == b[0] else None
    if set(given_of(a) if a in GIVEN else [a]) & set(given_of(b) if b in GIVEN else [b]):
        return 0.1
    if a in FORMS and b in FORMS:
        return None
    most = 2 if min(len(a), len(b)) >= 7 else 1 if min(len(a), len(b)) >= 4 else 0
    d = osa(a, b, most)
    return 0.2 * d if d <= most else None


def least_assignment(cost: list[list[float]]) -> float:
    """Least sum of one entry in each row, no two in one column (rows <= columns): shortest augmenting paths."""
    n, m = len(cost), len(cost[0]) if cost else 0
    row, column, owner = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        owner[0], at = i, 0
        short, back, seen = [float("inf")] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while owner[at]:
            seen[at], r, step, to = True, owner[at], float("inf"), 0
            for j in range(1, m + 1):
                if not seen[j]:
                    reduced = cost[r - 1][j - 1] - row[r] - column[j]
                    if reduced < short[j]:
                        short[j], back[j] = reduced, at
                    if short[j] < step:
                        step, to = short[j], j
            for j in range(m + 1):
                if seen[j]:
                    row[owner[j]] += step
                    column[j] -= step
                else:
                    short[j] -= step
            at = to
        while at:
            owner[at] = owner[back[at]]
            at = back[at]
    return -column[0]


#: Cost of two tokens that cannot mean the same; more than any possible sum of others.
_NEVER = 1e6


def aligned(a: list[str], b: list[str]) -> float | None:
    """Least cost of assigning each token of the shorter name to its own token of the longer; None if none is possible.

    Tokens of the longer name that are left over are free: a middle name, a word that a spelling drops. Equal tokens are
    taken together first, so only the rest, a few tokens, is searched.
    """
    if len(a) > len(b):
        a, b = b, a
    rest, other = [], list(b)
    for x in a:
        if x in other:
            other.remove(x)
        else:
            rest.append(x)
    if not rest:
        return 0.0
    total = least_assignment([[_NEVER if (c := token_cost(x, y)) is None else c for y in other] for x in rest])
    return None if total >= _NEVER else round(total, 6)


@F.pandas_udf(T.DoubleType())
def _aligned(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([aligned(list(x), list(y)) for x, y in zip(a, b)], dtype="float64")


def readings(names: DataFrame) -> DataFrame:
    """name, kind, core, options, initial, middle, tokens of each distinct name that names somebody."""
    ship(names.sparkSession)
    distinct = names.where(F.col("name").isNotNull()).groupBy("name").agg(F.count("*").alias("uses")).select("name")
    return distinct.mapInPandas(_read, READ)


def _variants(words: DataFrame, column: str) -> DataFrame:
    """``words`` with the deletions of a column, staged, as both sides of the look-up read it; spread before the UDF."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(words.repartition(parts).withColumn("variant", F.explode(_deletions(column))), "variants")


def _followed(steps: DataFrame, source: str, target: str, keys: list[str]) -> DataFrame:
    """Each step (source -> target among equal keys) followed to its end, by doubling. Steps lead to better support, so there is no circle."""
    steps = stage(steps, "steps")
    while True:
        more = steps.select(F.col(source).alias(target), F.col(target).alias("_next"), *keys)
        joined = stage(steps.join(more, [target, *keys], "left"), "steps")
        steps = joined.select(source, F.coalesce("_next", target).alias(target), *keys)
        if joined.where("_next is not null").isEmpty():
            return steps


def mended(read: DataFrame) -> DataFrame:
    """The readings with slips in the core mended: ``core`` is replaced by a near, better supported core that fits."""
    support = read.groupBy("core").agg(F.count_distinct("name").alias("support"))
    node = ["kind", "core", "options", "initial", "middle"]
    grouped = read.groupBy(*node).agg(F.max(F.struct(F.size("tokens").alias("n"), "tokens")).alias("t")).select(*node, "t.tokens")
    nodes = grouped.join(support, "core").withColumn("nid", F.xxhash64(*node))
    # Near cores among names of one kind whose given name begins alike (organisations: whose initials agree).
    letters = F.when(F.size("options") > 0, F.array_distinct(F.transform("options", lambda x: F.substring(x, 1, 1)))).otherwise(F.array("initial"))
    nodes = stage(nodes.withColumn("gates", F.when(F.col("kind") == "org", F.col("options")).otherwise(letters)), "names")
    gated = nodes.withColumn("gate", F.explode("gates"))
    cores = _variants(gated.select("core", "kind", "gate", "support").distinct(), "core")
    other = cores.select("variant", "kind", "gate", F.col("core").alias("to"), F.col("support").alias("to_support"))
    better = (F.col("to_support") > F.col("support")) | ((F.col("to_support") == F.col("support")) & (F.col("to") > F.col("core")))
    near = cores.join(other, ["variant", "kind", "gate"]).where((F.col("core") != F.col("to")) & better & ((F.col("support") <= 2) | (3 * F.col("support") <= F.col("to_support"))))
    near = near.select("core", "to", "kind", "gate", "to_support").distinct()
    mine = gated.select("nid", "core", "kind", "gate", "options", "middle", F.col("tokens").alias("a"))
    theirs = gated.select(F.col("core").alias("to"), "kind", "gate", F.col("options").alias("to_options"), F.col("middle").alias("to_middle"), F.col("tokens").alias("b"))
    fit = near.join(mine, ["core", "kind", "gate"]).join(theirs, ["to", "kind", "gate"])
    both = (F.size("options") > 0) & (F.size("to_options") > 0)
    fit = fit.where((~both | F.arrays_overlap("options", "to_options")) & ((F.col("middle") == "") | (F.col("to_middle") == "") | (F.col("middle") == F.col("to_middle"))))
    fit = fit.select("nid", "to", "to_support", _aligned("a", "b").alias("cost")).where("cost is not null")
    step = fit.groupBy("nid").agg(F.max(F.struct("to_support", (-F.col("cost")).alias("near"), "to")).alias("best")).select("nid", F.col("best.to").alias("to"))
    first = stage(nodes.join(step, "nid").select("nid", "core", "kind", "gates", "to"), "names")
    # The core found may itself be a slip of a still better supported one: on to the end of such steps.
    further = _followed(first.groupBy("core", "kind", "gates").agg(F.max("to").alias("to")), "core", "to", ["kind", "gates"])
    ends = first.join(further.select(F.col("core").alias("to"), F.col("to").alias("end"), "kind", "gates"), ["to", "kind", "gates"], "left")
    moved = ends.select("nid", F.coalesce("end", "to").alias("new"))
    out = read.withColumn("nid", F.xxhash64(*node)).join(moved, "nid", "left")
    return given_mended(out.select("name", "kind", F.coalesce("new", "core").alias("core"), "options", "initial", "middle"))


def given_mended(read: DataFrame) -> DataFrame:
    """Slips in given names that stand in no list: within one core, a rare one takes the place of a near, better supported one.

    Listed names are names of their own, however near (Maria, Marie), and are mended when they are read.
    """
    read = stage(read, "names")
    listed = sorted(GIVEN)
    one = F.col("options")[0]
    free = read.where((F.col("kind") == "person") & (F.size("options") == 1) & ~one.isin(listed) & (F.length(one) >= 5))
    given = _variants(free.groupBy("core", one.alias("given")).agg(F.count("*").alias("support")), "given")
    other = given.select("variant", "core", F.col("given").alias("to"), F.col("support").alias("to_support"))
    near = given.join(other, ["variant", "core"]).where((F.col("given") != F.col("to")) & (F.col("support") <= 2) & (3 * F.col("support") <= F.col("to_support")) & (F.substring("given", 1, 1) == F.substring("to", 1, 1)))
    near = near.select("core", "given", "to", "to_support").distinct().where(_aligned(F.array("given"), F.array("to")).isNotNull())
    best = near.groupBy("core", "given").agg(F.max(F.struct("to_support", "to")).alias("b")).select("core", "given", F.col("b.to").alias("to"))
    best = _followed(best, "given", "to", ["core"])
    mended = read.withColumn("given", F.when((F.col("kind") == "person") & (F.size("options") == 1), one)).join(best, ["core", "given"], "left")
    return mended.select("name", "kind", "core", F.when(F.col("to").isNotNull(), F.array("to")).otherwise(F.col("options")).alias("options"), "initial", "middle")


def persons(read: DataFrame) -> DataFrame:
    """name, person: the spellings with the key of the person or organisation they mean."""
    r = stage(read, "names")
    known = r.where(F.size("options") == 1).withColumn("full", F.element_at("options", 1))
    middles = known.groupBy("kind", "core", "full").agg(F.count_distinct(F.when(F.col("middle") != "", F.col("middle"))).alias("middles"), F.max("middle").alias("only"))
    known = known.join(middles, ["kind", "core", "full"])
    own = F.when(F.col("middles") <= 1, F.lit("")).otherwise(F.col("middle"))
    known = known.select("name", "kind", "core", "full", F.concat_ws("|", "kind", "core", "full", own).alias("person"), F.when(F.col("middles") <= 1, F.col("only")).otherwise(F.col("middle")).alias("mid"))
    people = known.groupBy("kind", "core", "full", "person", "mid").agg(F.count("*").alias("n")).withColumn("initial", F.substring("full", 1, 1))
    # Only an initial: the one person of that core whose names fit it; where several fit, the one whose middle initial is the same.
    open_ = r.where(F.size("options") == 0)
    asked = open_.where("initial <> ''").select("kind", "core", "initial", "middle").distinct()
    fits = asked.join(people.select("kind", "core", "initial", "person", "mid"), ["kind", "core", "initial"]).where((F.col("middle") == "") | (F.col("mid") == "") | (F.col("middle") == F.col("mid")))
    same = F.when((F.col("middle") != "") & (F.col("middle") == F.col("mid")), F.col("person"))
    fits = fits.groupBy("kind", "core", "initial", "middle").agg(F.count_distinct("person").alias("all"), F.min("person").alias("one"), F.count_distinct(same).alias("same"), F.min(same).alias("same_one"))
    only = F.when(F.col("all") == 1, F.col("one")).when(F.col("same") == 1, F.col("same_one"))
    lone = F.concat_ws("|", "kind", "core", F.lit("?"), "initial", "middle")
    by_initial = open_.join(fits, ["kind", "core", "initial", "middle"], "left").select("name", F.coalesce(only, lone).alias("person"))
    # A short form of several names: the one person of that core who bears one of them.
    several = r.where(F.size("options") > 1).select("name", "kind", "core", "options", "middle")
    asked = several.select("kind", "core", "options", "middle").distinct()
    fits = asked.withColumn("full", F.explode("options")).join(people.select("kind", "core", "full", "person", "mid"), ["kind", "core", "full"]).where((F.col("middle") == "") | (F.col("mid") == "") | (F.col("middle") == F.col("mid")))
    fits = fits.groupBy("kind", "core", "options", "middle").agg(F.count_distinct("person").alias("all"), F.min("person").alias("one"))
    lone = F.concat_ws("|", "kind", "core", F.lit("??"), F.array_join("options", "/"), "middle")
    by_short = several.join(fits, ["kind", "core", "options", "middle"], "left").select("name", F.coalesce(F.when(F.col("all") == 1, F.col("one")), lone).alias("person"))
    return known.select("name", "person").unionByName(by_initial).unionByName(by_short)


def spellings(papers: DataFrame, column: str = "authors") -> DataFrame:
    """name, person for every distinct spelling in ``column`` that names somebody; null arrays and slots have none."""
    return persons(mended(stage(readings(papers.select(F.explode(column).alias("name"))), "names")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name_a, name_b: different spellings of one person or organisation."""
    s = stage(spellings(table(spark, sf_dir, "papers")), "persons")
    a, b = s.select(F.col("name").alias("name_a"), "person"), s.select(F.col("name").alias("name_b"), "person")
    return a.join(b, "person").where(F.col("name_a") < F.col("name_b")).select("name_a", "name_b")


def p5_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each person or organisation of two spellings or more: how many spellings, and the first by code point."""
    s = spellings(table(spark, sf_dir, "papers"))
    return s.groupBy("person").agg(F.count("*").alias("spellings"), F.min("name").alias("first_spelling")).where("spellings > 1")


QUERIES = {"p5_found": p5_found, "p5_spellings": p5_spellings}
SQL: dict[str, str] = {}
