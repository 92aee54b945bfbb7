import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import golden, history, leaks, linkage, mixture, names, spans, titles

T0 = datetime.datetime(2025, 1, 6)


# ---------------------------------------------------------------- best representative

def test_groups_branch_in_the_queries_own_data(spark):
    """Some groups' most trusted address stands under another title too, so their search goes on; the others end at the root."""
    d = "/root/testdata/sf0.001"
    values = golden.paper_values(spark.read.parquet(f"{d}/papers.parquet"), spark.read.parquet(f"{d}/source_trust.parquet"))
    n = {}
    for name, bundles, deps in (("fields", golden.field_bundles(), [golden.address()]), ("origin", *golden.origin_bundles())):
        root = golden.rooted(values, ["normalized_title"], "row_no", bundles, deps)
        n[name] = (root.count(), root.where(F.size("_broken") > 0).count())
    assert 0 < n["fields"][1] < n["fields"][0] and 0 < n["origin"][1] < n["origin"][0]


def test_table_wide_dependency(spark):
    """Rows: group, order, cost, left, right. A left value with two right ones, in whatever rows, is no candidate."""
    rows = [("g", 1, 1, "u", "x"), ("g", 2, 2, "v", "x"), ("g", 3, 3, "v", "x"), ("h", 4, 1, "u", "y"), ("h", 5, 1, None, "y"), (None, 6, 0, "w", "q"), ("k", 7, 5, "w", "k"), ("k", 8, 5, "w", "k"), ("m", 9, 1, "z", None), ("m", 10, 1, "z", "m")]
    df = spark.createDataFrame(rows, "g string, o long, c int, l string, r string")
    bundles = [golden.Bundle("a", F.lit(True), [F.col("c")]), golden.Bundle("b", F.col("c") > 1, [F.col("c")])]
    out = {x.g: (x.a, x.b) for x in golden.survivors(df, ["g"], "o", bundles, [golden.Dependency("a", F.col("l"), F.col("r"))]).collect()}
    assert out == {"g": (2, 2), "h": (5, None), "k": (None, 7), "m": (9, None)}
    assert golden.survivors(df.where("false"), ["g"], "o", bundles, [golden.Dependency("a", F.col("l"), F.col("r"))]).count() == 0


PAPERS = "row_no long, normalized_title string, abstract string, date string, source string, canonical_url string, fetched_at timestamp, _rank string, title string"


def paper(n, title, abstract=None, date=None, source=None, url=None, at=T0):
    return (n, title, abstract, date, source, url, at, "clash", None)


def test_survivors_by_field(spark):
    rows = [
        paper(1, "a b", "<jats:p>Long real text here.</jats:p>", "2024-02-30", " openshelf", "https://x.org/1"),
        paper(2, "a b", "Long real text here. Copyright of the record stays with its depositors.", "3 Mar 2024", "JOURNALFEED ", "https://x.org/shared"),
        paper(3, "a b", "No abstract available.", "2026-01-01", None, "#"),
        paper(4, "a b", "A b (more)", "2024-03", "nobody", "/rel"),
        paper(5, "c", None, None, None, "https://x.org/shared"),
        paper(6, "", "text", "2024-01-01", "OpenShelf", "https://x.org/6"),
        paper(7, None, "text", "2024-01-01", "OpenShelf", "https://x.org/6"),
        paper(8, "d", "", "n.d.", "", None, None),
        paper(9, "d", None, "2099-01-01", None, None, None),
    ]
    trust = spark.createDataFrame([("JournalFeed", 1), ("OpenShelf", 3)], "source string, trust_rank int")
    out = {r.normalized_title: (r.abstract, r.date, r.source, r.canonical_url) for r in golden.paper_survivors(spark.createDataFrame(rows, PAPERS), trust).collect()}
    assert out == {"a b": (1, 2, 2, 1), "d": (None, 9, None, None)}
    assert golden.paper_survivors(spark.createDataFrame([], PAPERS), trust).count() == 0


def test_branch_and_bound_is_optimal(spark):
    rng = random.Random(4)
    rows = [(g, i + 10 * g, rng.randint(0, 5), rng.randint(0, 5), rng.choice("xy"), rng.choice("pq")) for g in range(12) for i in range(5)]
    df = spark.createDataFrame(rows, "g long, o long, ca int, cb int, l string, r string")
    bundles = [golden.Bundle("a", F.lit(True), [F.col("ca")]), golden.Bundle("b", F.lit(True), [F.col("cb")])]
    dep = golden.Dependency("a", F.col("l"), F.col("r"), on="b")
    out = {r.g: (r.a, r.b) for r in golden.survivors(df, ["g"], "o", bundles, [dep]).collect()}
    for g in range(12):
        own = {r[1]: r for r in rows if r[0] == g}
        pairs = {(r[4], r[5]) for r in own.values()}
        place = {k: {o: n for n, (_, o) in enumerate(sorted(best.values()))} for k, best in (("a", {x: min((r[2], r[1]) for r in own.values() if r[4] == x) for x in {r[4] for r in own.values()}}), ("b", {x: min((r[3], r[1]) for r in own.values() if r[5] == x) for x in {r[5] for r in own.values()}}))}
        a, b = out[g]
        assert (own[a][4], own[b][5]) in pairs
        best = min(place["a"][x] + place["b"][y] for x in place["a"] for y in place["b"] if (own[x][4], own[y][5]) in pairs)
        root = (min((r[2], r[1]) for r in own.values())[1], min((r[3], r[1]) for r in own.values())[1])
        assert (a, b) == root or place["a"][a] + place["b"][b] == best


# ---------------------------------------------------------------- history

HIST = "hist_no long, paper_id string, title string, normalized_title string"
INC = "arrival_no long, batch_no int, paper_id string, title string, normalized_title string, blocks string"
LONG = "Reading Bank Contracts with Language Models: Transaction-Level Tests of Passive Wages in Kradokobresk"


def inc(n, title, pid=None, batch=1):
    key = "" if title is None else " ".join(titles_words(title))
    return (n, batch, pid, title, key, "clash")


def titles_words(t):
    return "".join(c if c.isascii() and c.isalnum() else " " for c in t.lower()).split()


ARRIVALS = [
    inc(1, LONG.replace("Contracts", "Cotnracts") + " (Working Paper)"),
    inc(2, LONG + " (II)"),
    inc(3, LONG.replace("Kradokobresk", "Vevubefond")),
    inc(4, "Comment on “" + LONG + "”"),
    inc(5, None, "S:12v2 "),
    inc(6, None, "s:"),
    inc(7, "Short one", "z:1"),
    inc(8, "Short one", None, 2),
    inc(9, LONG[:-4] + "...", None, 2),
    inc(10, None, None, 2),
    inc(11, LONG.replace("Passive Wages", "Passive Wáges"), None, 2),
    inc(12, "数据", "z:1", 3),
]


def test_repeats_and_replay_agree(spark):
    hist = spark.createDataFrame([(1, "s:12", LONG, " ".join(titles_words(LONG))), (2, "s:", "数据", ""), (3, None, None, None)], HIST)
    arrived = spark.createDataFrame(ARRIVALS, INC)
    got = sorted(r.arrival_no for r in history.repeats(hist, arrived).collect())
    assert got == [1, 5, 8, 9, 11, 12]
    index = history.SeenIndex(spark)
    index.append(hist)
    replay = [r.arrival_no for b in (1, 2, 3) for r in index.check(arrived.where(F.col("batch_no") == b)).collect()]
    assert sorted(replay) == got
    assert history.repeats(hist.where("false"), arrived.where("false")).count() == 0


def test_fingerprints_find_slips():
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdefghij") for _ in range(90)) for _ in range(200)]
    slip = [b[:40] + b[41] + b[40] + b[42:] for b in base]
    planes = history._planes()
    x, y = history.fingerprint_bits(base, planes), history.fingerprint_bits(slip, planes)
    met = (history._windows(x) == history._windows(y)).any(axis=1) & ((x != y).sum(1) <= history.MAX_HAMMING)
    assert met.mean() >= 0.98
    assert ((x[:-1] != x[1:]).sum(1) > history.MAX_HAMMING).all()


@pytest.mark.parametrize("length, slips, least", [(40, 1, 0.9), (60, 1, 0.95), (60, 2, 0.85), (90, 1, 0.98), (90, 2, 0.95), (90, 3, 0.85)])
def test_recall_against_all_pairs(length, slips, least):
    """Of titles with random slips, the share that meets its original in a block table within the Hamming distances."""
    rng = random.Random(length + slips)
    words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 11))) for _ in range(400)]
    base = ["".join(rng.choice(words) for _ in range(20))[:length] for _ in range(500)]

    def slip(s):
        s = list(s)
        for _ in range(slips):
            i, kind = rng.randrange(len(s) - 1), rng.random()
            s[i : i + 2] = [s[i + 1], s[i]] if kind < 0.4 else [s[i]] if kind < 0.6 else [s[i], "x", s[i + 1]] if kind < 0.8 else ["q", s[i + 1]]
        return "".join(s)

    planes = history._planes()
    x, y = history.fingerprint_bits(base, planes), history.fingerprint_bits([slip(b) for b in base], planes)
    met = (history._windows(x) == history._windows(y)).any(axis=1) & ((x != y).sum(1) <= history.MAX_HAMMING) & ((x != y)[:, :128].sum(1) <= history.MAX_FIRST)
    assert met.mean() >= least


def test_batches_one_by_one_equal_all_at_once(spark):
    """Vocabulary grows from batch to batch; every title is judged by what was known when it came."""
    rng = random.Random(21)
    stem = [f"{a}{b}ing" for a in ("cred", "mark", "bond", "risk", "lend") for b in ("o", "an", "ur", "el")]
    near = [w[:-2] + "gn" for w in stem]
    made, rows = [], []
    for k in range(240):
        if made and rng.random() < 0.5:
            w = list(rng.choice(made))
            i = rng.randrange(len(w))
            w[i] = rng.choice([near[stem.index(w[i])] if w[i] in stem else w[i], rng.choice(stem)])
        else:
            w = [rng.choice(stem) for _ in range(9)]
        made.append(w)
        text = " ".join(w)
        rows.append((k, k // 60, None if k % 3 else f"s:{rng.randint(1, 60)}", text, text))
    df = spark.createDataFrame(rows, "arrival_no long, batch_no int, paper_id string, title string, normalized_title string")
    hist, new = df.where("batch_no = 0").drop("batch_no"), df.where("batch_no > 0")
    whole = sorted(r.arrival_no for r in history.repeats(hist, new).collect())
    index = history.SeenIndex(spark)
    index.append(hist)
    parts = sorted(r.arrival_no for b in (1, 2, 3) for r in index.check(new.where(F.col("batch_no") == b)).collect())
    assert parts == whole and 20 < len(whole) < 180


def test_plain_titles_equal_the_long_way(spark):
    """The shortcut for plain titles changes nothing."""
    rng = random.Random(13)
    parts = ["The ", "Draft: ", "A & B ", "x &lt; y ", "<i>Bank</i> ", "Lending", " and  Risk", "\tYield", " (Working Paper)", " - revised", "*", " [draft]", "...", " press", ")", " Éclat", "\u00a0", " in press ", "  "]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randint(0, 5))),) for _ in range(400)] + [(None,), ("",), ("Credit - Working Paper*",), ("Part (2)",)]
    df = spark.createDataFrame(rows, "t string")
    marked = df.select("t", titles.plain(F.col("t")).alias("a"), titles.plain(F.concat("t", F.lit("<b>"))).alias("b"))
    assert marked.where("not (a <=> b)").collect() == []


def test_edit_distance():
    assert [history.osa(a, b, 2) for a, b in (("ab", "ba"), ("abc", "abc"), ("abc", "xyz"), ("", "ab"), ("model", "modle"))] == [1, 0, 3, 2, 1]
    assert history.slips("part 1".split(), "part 2".split(), False, False) is None
    assert history.slips("bank yields".split(), "bnak yields".split(), False, False) == [("bank", "bnak")]


# ---------------------------------------------------------------- linkage


def test_linkage(spark):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(n))
    topic, place = [word(4) for _ in range(120)], [word(6) for _ in range(100)]
    who = [f"{rng.choice(['Anna', 'Robert', 'Susan'])} {word(5).title()}" for _ in range(150)]
    left, right, truth = [], [], set()
    for i in range(240):
        words = rng.sample(topic, 4)
        p = rng.choice(place)
        title, authors, month = f"{words[0]} and {words[1]}: tests on {words[2]} and {words[3]} in {p}", rng.sample(who, 2), 24000 + i % 30
        left.append((i, title, authors, month))
        if i % 3 == 0:
            new = title.replace(words[3], words[3][1:]) if i % 2 else title.split(":")[0]
            right.append((1000 + i, new, authors, month + 12))
            truth.add((i, 1000 + i))
        elif i % 3 == 1:
            right.append((1000 + i, "Comment on " + title, rng.sample(who, 2), month + 5))
        else:
            right.append((1000 + i, title.replace(p, rng.choice([x for x in place if x != p])), rng.sample(who, 2), month + 9))
    right += [(5000, None, None, None), (5001, "", [], None)]
    left += [(5000, None, [None], None)]
    schema = "id long, title string, authors array<string>, month int"
    got = linkage.link(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema))
    pairs = {(r.left_id, r.right_id) for r in got.collect()}
    assert len(pairs & truth) >= 0.9 * len(truth) and len(pairs - truth) <= 2
    assert linkage.link(spark.createDataFrame([], schema), spark.createDataFrame(right, schema)).count() == 0


def keys_of(spark, records, df, n=10000):
    """The key sets of (words, head, cores)."""
    rows = [(k, cores, *linkage.blocking_words(ws, head, df, n)) for k, (ws, head, cores) in enumerate(records)]
    schema = "k int, cores array<string>, top array<string>, unknown array<string>, telling array<string>, content string, head string"
    return [set(r.keys) for r in spark.createDataFrame(rows, schema).select("k", linkage.blocking_keys().alias("keys")).orderBy("k").collect()]


def test_blocking_survives_added_words(spark):
    """A title's words all stand in another that adds rarer ones, by a shared author or by the title alone."""
    draft = "reading bank tone with language models cross tests of local yields in brokuhusti".split()
    published = [*draft[:3], "using", "large", *draft[4:]]
    df = {w: 900 for w in {*draft, *published}} | {"bank": 240, "using": 20, "large": 30, "brokuhusti": 100, "tone": 110, "local": 300, "yields": 310}
    for cores in (["librisove/w"], []):
        a, b = keys_of(spark, [(ws, "".join(ws[:k]), cores) for ws, k in ((draft, 6), (published, 7))], df)
        assert a & b
    longer = [*published, "four", "more", "rarer", "names"]
    df |= {w: 10 for w in longer[-4:]}
    keys = keys_of(spark, [(ws, "".join(ws[:k]), ["librisove/w"]) for ws, k in ((draft, 6), (longer, 7))], df)
    assert keys[0] & keys[1]


def test_em_separates():
    patterns = [(5, 0, 0, 3, 3), (0, 1, 0, 0, 3), (2, 1, 0, 0, None)]
    post = linkage.expectation_maximisation(patterns, np.array([50.0, 400.0, 50.0]))
    assert post[0] > 0.95 and post[1] < 0.05 and post[2] < 0.2


# ---------------------------------------------------------------- names


def test_names(spark):
    same = [
        ["Theodore I. Lukagobra", "LUKAGOBRA, Theodore", "Lukagobra T. I.", "Ted Lukagobra", "Theoodore Lukagobra", "Lukagorba, Theodore", "T.Lukagobra", "TI Lukagobra", "Prof. Theodore Luka-Gobra"],
        ["Vuvostapa University for Insurance Economics", "UIE Vuvostapa", "Vuvostapa Univ. Insurance Economics", "University for Insurance Economics, Vuvostapa"],
        ["William Lukagobra", "Bill Lukagobra"],
    ]
    alone = ["Rebecca Tritregitu", "Matthew Tritregitu", "N/A", "et al.", "", "Anonymous", "x"]
    df = spark.createDataFrame([(i, [n, None]) for i, n in enumerate([x for g in same for x in g] + alone)] + [(99, None), (98, [])], "person long, authors array<string>")
    groups = {}
    for r in names.spellings(df).collect():
        groups.setdefault(r.person, set()).add(r.name)
    found = sorted(tuple(sorted(g)) for g in groups.values() if len(g) > 1)
    assert found == sorted(tuple(sorted(g)) for g in same)
    assert names.spellings(df.where("false")).count() == 0


def test_alignment():
    assert names.aligned(["lukagobra", "t"], ["theodore", "lukagobra"]) is not None
    assert names.aligned(["lukagobra", "bill"], ["william", "lukagobra"]) is not None
    assert names.aligned(["lukagobra", "walter"], ["william", "lukagobra"]) is None
    assert names.given_of("micahel") == ["michael"] and names.given_of("zzzz") == []
    a, b = names.deletions("fiplinpa"), names.deletions("fiplinapa")
    assert set(a) & set(b)


def test_assignment_is_least():
    from itertools import permutations

    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(1, 4)
        m = rng.randint(n, 5)
        cost = [[rng.choice([0, 1, 2, 5, 1e6]) * 1.0 for _ in range(m)] for _ in range(n)]
        assert abs(names.least_assignment(cost) - min(sum(cost[i][p[i]] for i in range(n)) for p in permutations(range(m), n))) < 1e-6
    assert names.aligned(["smith", "j", "adam"], ["smiht", "john", "a", "b"]) == round(0.2 + 0.3 + 0.3, 6)
    assert names.aligned(["smith", "j", "a"], ["smith", "john", "b"]) is None and names.aligned([], ["x"]) == 0.0
    assert names.aligned([f"t{k}" for k in range(40)], [f"t{k}" for k in range(40, 0, -1)]) is None


def test_chains_of_slips_and_unlisted_given_names(spark):
    """A slip of a slip goes to the best supported core; a rare unlisted given name to its near, better supported one."""
    given = ["Anna", "Bruno", "Carla", "Dieter", "Erik", "Frida", "Gustav", "Hilde", "Ivo", "Jana", "Klaus", "Lotte", "Moritz"]
    rows = [f"{g} Kordovaneska" for g in given] + [f"{g} Kordovanesak" for g in given[:4]] + ["Anna Kordovanseak"] + ["Xiaoming Petrovalo", "Petrovalo, Xiaoming", "Dr. Xiaoming Petrovalo", "XIAOMING PETROVALO", "Xiaomnig Petrovalo", "Xinyu Petrovalo"]
    out = {r.name: r.person for r in names.spellings(spark.createDataFrame([([r],) for r in rows], "authors array<string>")).collect()}
    assert out["Anna Kordovanseak"] == out["Anna Kordovanesak"] == out["Anna Kordovaneska"] != out["Bruno Kordovaneska"]
    assert out["Xiaomnig Petrovalo"] == out["Xiaoming Petrovalo"] == out["Petrovalo, Xiaoming"] != out["Xinyu Petrovalo"]


# ---------------------------------------------------------------- leaks


def test_leaks(spark):
    rng = random.Random(6)
    vocab = [f"word{i}" for i in range(300)]
    items = [(i, " ".join([f"Name{i}a", *rng.sample(vocab, 18), f"Name{i}b?", *rng.sample(vocab, 8)])) for i in range(20)]
    docs, truth = [], set()
    for d in range(200):
        body = [rng.choice(vocab) for _ in range(120)]
        i = d % 20
        w = items[i][1].split()
        k = 12 if d % 2 else 11
        s = rng.randint(0, len(w) - k)
        body[60:60] = [x.upper() + rng.choice([",", "  -", "\n"]) for x in w[s : s + k]]
        docs.append((d, " ".join(body), "x"))
        if k == 12:
            truth.add((i, d))
    docs += [(900, None, ""), (901, "", ""), (None, items[0][1], ""), (902, items[1][1] * 1, "")]
    truth.add((1, 902))
    items += [(77, None), (78, ""), (79, "too short")]
    out = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string, cosine string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.item_id, r.doc_id) for r in out.where("run >= 12").collect()} == truth
    assert leaks.leaks(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string, cosine string"), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_paraphrases(spark):
    """Items rewritten with dropped, changed and moved words are found in nine of ten cases; unrelated texts are not."""
    rng = random.Random(12)
    vocab = [f"word{i}" for i in range(400)]
    items = [(i, " ".join([f"name{i}a", *rng.sample(vocab, 20), f"name{i}b", *rng.sample(vocab, 12), f"answer{i}"])) for i in range(30)]
    docs, truth = [], set()
    for d in range(240):
        body = [rng.choice(vocab) for _ in range(150)]
        if d % 2:
            i = d % 30
            w = [rng.choice(vocab) if k % 7 == 3 and not x.startswith(("name", "answer")) else x for k, x in enumerate(items[i][1].split())]
            cut = rng.randint(8, len(w) - 8)
            body[70:70] = w[:cut] + rng.sample(vocab, 2) + w[cut:]
            truth.add((i, d))
        docs.append((d, " ".join(body)))
    out = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r.item_id, r.doc_id) for r in out if r.run >= leaks.RUN or (r.lcs_share >= leaks.PARAPHRASE_LCS and r.key_share >= leaks.PARAPHRASE_KEYS)}
    assert len(found & truth) >= 0.9 * len(truth) and len(found - truth) <= 0.02 * len(found)


def test_runs():
    assert leaks.longest_run("a b c d".split(), "x b c y a b c".split()) == 3
    assert leaks.common_subsequence("a b c d".split(), "a x c d".split()) == 3
    for n in (0, 1, 12, 16, 17, 40):
        b = leaks.Batch([["w"], [str(k) for k in range(n)], []], {str(k): k for k in range(n)})
        own = b.at[b.text == 1]
        assert len(own) == leaks.passages(n) and len(b.begin) == len(own) + 1
        assert {i for s in own for i in range(s, s + leaks.SIZE)} >= set(range(n))
        assert all(any(s <= k and k + leaks.RUN <= s + leaks.SIZE for s in own) for k in range(n - leaks.RUN + 1))


def test_projection_is_the_dense_product():
    rng = np.random.default_rng(1)
    index = {f"w{k}": k for k in range(30)}
    texts = [[f"w{rng.integers(0, 36)}" for _ in range(n)] for n in (3, 16, 50, 0, 21)]
    b, idf, basis = leaks.Batch(texts, index), rng.random(30) + 0.1, rng.random((30, 5))
    dense = np.zeros((len(b.begin), 30))
    for row, (k, s) in enumerate(zip(b.text, b.at)):
        for w in texts[k][s : s + leaks.SIZE]:
            if w in index:
                dense[row, index[w]] += idf[index[w]]
    assert np.allclose(b.windows(np.append(idf[:, None] * basis, np.zeros((1, 5)), axis=0)), dense @ basis)
    assert np.allclose(leaks._gram(b, idf, basis), dense.T @ (dense @ basis))


def test_lists_find_near_vectors():
    rng = np.random.default_rng(2)
    v = leaks.unit(rng.standard_normal((900, 24)).astype(np.float32))
    x = leaks.unit(v + 0.12 * rng.standard_normal(v.shape).astype(np.float32))
    i, j, cos = leaks.Lists(v).search(x, 0.6)
    met = set(zip(i.tolist(), j.tolist()))
    assert sum((k, k) in met for k in range(900)) >= 0.9 * 900 and np.allclose(cos, (x[i] * v[j]).sum(1), atol=1e-5)


# ---------------------------------------------------------------- mixture


def test_water_fill():
    give = mixture.water_fill({"a": 0.5, "b": 0.3, "c": 0.2, "none": 0.0}, {"a": 100, "b": 1000, "c": 1000, "none": 50}, {"a": 2, "b": 1, "c": 1, "none": 5}, 1000)
    assert give["a"] == 200 and round(give["b"]) == 480 and round(give["c"]) == 320 and give["none"] == 0
    assert sum(mixture.water_fill({"a": 1.0}, {"a": 10}, {"a": 3}, 1000).values()) == 30


def test_mixture(spark):
    rng = random.Random(9)
    docs = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.randint(0, 60)) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, source string, tokens long").withColumns({"whole": F.lit("clash"), "rest": F.lit(0), "size": F.lit(1)})
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 1), ("gone", 0.0, 2)], "source string, target_share double, max_repeats int")
    planned = mixture.plan(df, targets)
    out = mixture.mixture(df, planned, seed=3)
    rows, size = out.collect(), {}
    for r in rows:
        size[r.source] = size.get(r.source, 0) + r.tokens * r.repeats
    sizes = {s: sum(t for _, x, t in docs if x == s) for s in "abc"}
    give = mixture.water_fill({"a": 0.5, "b": 0.3, "c": 0.2, "gone": 0.0}, sizes, {"a": 1, "b": 3, "c": 1, "gone": 2})
    for s in "abc":
        assert give[s] - 60 <= size[s] <= give[s] + 1e-6
    assert max(r.repeats for r in rows) <= 3 and len({r.doc_id for r in rows}) == len(rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixture.mixture(df.repartition(7), planned, seed=3).collect()))
    assert mixture.mixture(df.where("false"), mixture.plan(df.where("false"), targets)).count() == 0
    tokenized = mixture.with_tokens(spark.createDataFrame([("Hello world <|endoftext|>",), (None,), ("",)], "text string")).collect()
    assert [r.tokens for r in tokenized][1:] == [0, 0] and tokenized[0].tokens > 3


def test_shares_add_up(spark):
    """Reached tokens are those of the mixture; no cap is passed; free sources keep the proportions of their targets within a record."""
    d = "/root/testdata/sf0.001"
    shares = {r.source: r for r in mixture.p7_shares(spark, d).collect()}
    got = mixture.p7_mixture(spark, d).groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("t")).collect()
    assert {r.source: r.t for r in got} == {s: r.reached_tokens for s, r in shares.items() if r.reached_tokens}
    assert all(r.most_repeats <= r.max_repeats for r in shares.values()) and abs(sum(r.reached_share for r in shares.values()) - 1) < 1e-5
    assert all(r.reached_tokens == r.size * r.max_repeats for r in shares.values() if r.capped and r.size)
    free = [r for r in shares.values() if not r.capped and r.size]
    per = [r.reached_tokens / r.target_share for r in free]
    longest = 4000
    assert all(abs(r.reached_tokens - r.target_share * max(per)) <= longest for r in free)


# ---------------------------------------------------------------- spans


def brute(docs):
    out = set()
    for i, (a, x) in enumerate(docs):
        grams = {x[k : k + spans.SPAN] for k in range(len(x) - spans.SPAN + 1)}
        for b, y in docs[i + 1 :]:
            if any(y[k : k + spans.SPAN] in grams for k in range(len(y) - spans.SPAN + 1)):
                out.add((min(a, b), max(a, b)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_spans(spark, seed):
    rng = random.Random(seed)

    def prose(n):
        out = ""
        while len(out) < n:
            out += rng.choice(["", "", "x" * rng.choice([1, 30, 60])]) + "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) + rng.choice([" ", ". ", "\n", "-"])
        return out[:n]

    docs = [(i, prose(rng.randint(0, 1500))) for i in range(30)]
    for _ in range(25):
        (i, x), j = rng.choice(docs), rng.randrange(len(docs))
        n = rng.choice([399, 400, 401, 350, 700])
        if len(x) >= n:
            s, (b, y) = rng.randint(0, len(x) - n), docs[j]
            k = rng.randint(0, len(y))
            docs[j] = (b, y[:k] + x[s : s + n] + y[k:])
    docs += [(100, "z" * 900), (101, "z" * 1000), (102, docs[0][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs] + [(200, None, 1), (201, "", 1)], "doc_id long, text string, path int")
    assert {(r.doc_a, r.doc_b) for r in spans.sharing_pairs(df).collect()} == brute(docs)
    parts = {r.doc_id: r for r in spans.shared_parts(df).collect()}
    assert {i: r.shared_chars for i, r in parts.items() if i < 200} == {i: covered(i, docs) for i, _ in docs}
    assert parts[100].shared_part > 0.9 and parts[201].shared_chars == 0 and all(r.shared_chars <= r.n_chars for r in parts.values() if r.n_chars)
    assert spans.sharing_pairs(df.where("false")).count() == 0 and spans.shared_parts(df.where("false")).count() == 0


def covered(i, docs):
    """Characters of document i in stretches of SPAN or more that stand in another."""
    mine, grams = dict(docs)[i], {y[k : k + spans.SPAN] for j, y in docs if j != i for k in range(len(y) - spans.SPAN + 1)}
    hit = np.zeros(len(mine), bool)
    for k in range(len(mine) - spans.SPAN + 1):
        if mine[k : k + spans.SPAN] in grams:
            hit[k : k + spans.SPAN] = True
    return int(hit.sum())


def test_shared_spans_meet_in_a_kept_kmer():
    """Any stretch of SPAN characters that two texts share holds a k-mer that both keep, whatever stands around it."""
    rng, tables = random.Random(5), {}
    pieces = ["word", "x" * 23, "y" * 24, "z" * 25, "q" * 200, " ", ". ", "-", "ab ab ab ", "é", "\n\n"]
    make = lambda n: "".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(n))[:n]
    for _ in range(200):
        core = make(spans.SPAN)
        texts = [make(rng.randint(0, 300)) + core + make(rng.randint(0, 300)) for _ in range(2)]
        which, start, end, h = spans.kmers(texts, tables)
        both = set(h[which == 0]) & set(h[which == 1])
        assert both and all(e - s < spans.REACH + spans.LONG for s, e in zip(start, end))
        alone = [spans.kmers([t], tables)[1:] for t in texts]
        assert all((a == b).all() for k in (0, 1) for a, b in zip(alone[k], (start[which == k], end[which == k], h[which == k])))


def test_kept_places_of_long_texts(monkeypatch):
    rng = np.random.default_rng(3)
    order = rng.integers(0, 50, 3000).astype(np.uint64) << np.uint64(40)
    inside = np.arange(3000) + spans.WINDOW <= 3000
    want = sorted({max(range(x, x + spans.WINDOW), key=lambda i: (-int(order[i]), i)) for x in range(3000 - spans.WINDOW + 1)})
    assert spans.kept_places(order, inside).tolist() == want
    monkeypatch.setattr(spans, "_PLACE", 10)
    assert spans.kept_places(order, inside).tolist() == want


def test_spans_of_hot_copies_and_stock_paragraphs(spark):
    """A stock paragraph under SPAN in every text makes no pair; a group of copies is one group; equal rows are one."""
    rng = random.Random(9)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    stock, copy = prose(spans.SPAN - 1), prose(900)
    docs = [(i, prose(300) + chr(0x4E00 + i) + stock + chr(0x5E00 + i) + prose(300)) for i in range(40)] + [(i, copy) for i in range(40, 60)]
    df = spark.createDataFrame(docs + docs[:5], "doc_id long, text string")
    assert {(r.doc_a, r.doc_b) for r in spans.sharing_pairs(df).collect()} == {(a, b) for a in range(40, 60) for b in range(a + 1, 60)}
    assert {(r.doc_id, r.shared_chars) for r in spans.shared_parts(df).collect()} == {(i, 0) for i in range(40)} | {(i, 900) for i in range(40, 60)}


def test_titles(spark):
    df = spark.createDataFrame([("The <i>Bänk</i> &amp; Credit [revised]*",), (None,), ("Draft: X – forthcoming",)], "t string")
    assert [r[0] for r in df.select(F.array_join(titles.words(titles.plain(F.col("t"))), " ")).collect()] == ["bank and credit", None, "x"]


def test_unlike_words_are_not_aligned(spark, monkeypatch):
    calls, osa = [], linkage._osa
    monkeypatch.setattr(linkage, "_osa", lambda *x: calls.append(x) or osa(*x))
    a, b = "fiscal funds shape mortgage prices in basel".split(), "global taxes guide dividend audits by turin".split()
    assert linkage.compare_titles(a, b, 7, 7, {}, 100) == (0, 1, 0) and not calls
    assert linkage.compare_titles([*a[:-1], "bsael"], a, 7, 7, {}, 100) == (4, 0, 0) and calls
    df = spark.createDataFrame([(1, "Fiscal Funds", ["A B"], 3)], "id long, title string, authors array<string>, month int")
    # A filter on words goes below the projection, which reads the title again.
    assert "Filter" not in linkage.records(df)._jdf.queryExecution().optimizedPlan().toString()
