import datetime
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from folioflow.functions import dates as D
from folioflow.functions import documents as docs
from folioflow.functions import notes
from folioflow.functions import query_language as Q
from folioflow.functions import text as X
from folioflow.operators import dedupe, enrich, filters, merge, rank, render, rules, sinks, state
from folioflow.plans import core
from folioflow.sources import config, items, pages, readers
from folioflow.streaming.delivery import Delivery


def one(spark, column, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(column(F.col("x"))).collect()]


def test_titles_and_addresses(spark):
    assert one(spark, X.normalize_title, "A—B  Cé", None, "") == ["a b c", "", ""]
    assert one(spark, X.canonical_url, "HTTPS://Ex.org/A?b#c", "ex.org/a?b", "http://a/b;p=1?x#y", "", None) == ["https://Ex.org/A", "ex.org/a?b", "http://a/b;p=1", None, None]
    assert one(spark, X.clean_cell, " n/a ", "x", None) == ["", "x", ""]
    assert one(spark, lambda c: X.has_phrase(F.lower(c), "llm"), "LLMs", "éllm", "an LLM.", None) == [False, False, True, False]
    assert one(spark, X.end_sentence, "A b.", "a!", "", None) == ["A b.。", "a!", "", None]
    assert one(spark, X.first_sentence, "Vs. x. Y", "none", "一。二。", "a; b") == ["Vs. x. Y。", "none。", "一。二。", "a;"]


def test_dates(spark):
    assert one(spark, D.parse_date, "Tue, 05 Mar 2024 23:30:00 -0500", "5 March 2024 10:11:12", "05 Mar 2024 01:30:00 +0530", "31 Dec 2023 22:00:00 PST", "1 Jan 2024 00:10 GMT", "1999-01-02T00:00:00Z") == ["2024-03-06", "2024-03-05", "2024-03-04", "2024-01-01", "2024-01-01", None]
    assert one(spark, D.parse_date, "2024-1-5", "3 Mar 2020", "March 3, 2020", "Posted: 2021-02-03", "seen 2024-99-99 x", "n.d.", None) == ["2024-01-05", "2020-03-03", "2020-03-03", "2021-02-03", "2024-99-99", None, None]
    assert one(spark, D.strict_date, "2024-2-30", "2024-2-3") == [None, datetime.date(2024, 2, 3)]
    df = spark.createDataFrame([(datetime.date(2027, 1, 1),)], "d date")
    row = df.select(D.week_key(F.lit("s"), F.col("d")).alias("w"), D.key_suffix(F.lit("top3"), F.lit("top3-2026-07-12")).alias("k"), D.key_suffix(F.lit("top3"), F.lit("nber-1")).alias("n")).first()
    assert row == ("s-2026-W53", "2026-07-12", None)


def test_queries(spark):
    q = '(LLM OR "generative AI") AND MD&A'
    assert one(spark, Q.tokens, q)[0] == ["(", "LLM", "OR", '"generative AI"', ")", "AND", "MD&A"]
    assert one(spark, Q.free_text, q + " llm") == ["LLM generative AI MD&A"]
    assert one(spark, Q.fielded, "a or \"b c\"") == ['all:a OR all:"b c"']


def test_documents(spark):
    text = "".join(f"line {i}\n" for i in range(20)) + "```\nfenced block that is long\n```\n"
    for most in (35, 60, 5000):
        parts = docs.chunks_of(text, most)
        assert "\n".join(parts) == text and (len(parts) > 1) == (most < len(text))
    tildes = "~~~\n" + "x\n" * 50 + "~~~"
    assert any(p.count("x") == 50 for p in docs.chunks_of("a\n" * 30 + tildes, 40))
    assert docs.packed([3, 3, 5, 1], 6) == [0, 0, 1, 1] and docs.packed([], 6) == []
    with pytest.raises(ValueError):
        docs.packed([7], 6)
    assert docs.json_in('[1] {"a": 2}', dict) == '{"a":2}' and docs.json_in("[1]", dict) is None
    assert docs.json_in('x [bad {"a": [1]} tail') == '{"a":[1]}' and docs.json_in("none") is None
    assert docs.answer_in({"payloads": [{"text": " hi "}, {"reply": ""}]}) == "hi"
    assert [docs.whole_answer(x) for x in ('{"result": {"payloads": [{"content": {"text": "a"}}, {"text": "b"}]}}', '{"messages": [{"content": "x"}, "y"]}', '{"text": " ", "output": ["p"]}', '{"a": 1}', "[1]", " plain ", "", None)] == ["a\nb", "x\ny", "p", None, None, "plain", None, None]
    assert one(spark, lambda c: docs.markup_text(c), "&lt;b&gt;x&lt;/b&gt; y", "<p>Abstract: z</p>", None) == ["x y", "z", None]
    row = spark.createDataFrame([('<title>T</title><meta name="a" content="1"><script type="application/ld+json">{}</script><a href="u">go</a>',)], "x string").select(docs.page("x").alias("g")).first().g
    assert (row.title, row.text, row.links, row.json_ld, row.meta[0].value) == ("T", "go", ["u"], ["{}"], "1")


def test_filters(spark):
    rows = [("keep", "s", "journal-article", "asset pricing", "2021-01-01", 2021), ("corr", "s", "journal-article", "asset pricing corrigendum", "2021-01-01", 2021), ("old", "s", "journal-article", "asset pricing", "2019-12-31", 2019), ("type", "s", "editorial", "asset pricing", "2021-01-01", 2021), ("null", "s", None, None, None, None)]
    df = spark.createDataFrame(rows, "id string, source string, type string, title string, published string, year int")
    ok = filters.of_type(F.col("source"), F.col("type"), ["s"], "journal-article") & filters.not_before(F.col("published"), F.col("year"), "2020-01-01") & filters.mentions(F.col("title"), ["asset pricing"], ["corrigendum"])
    assert [r.id for r in df.where(ok).collect()] == ["keep"]
    ages = spark.createDataFrame([("a", 2), ("a", 5), ("a", None), ("a", 9), (None, 1)], "g string, age int")
    assert sorted((r.g or "", r.age) for r in filters.adaptive_window(ages, F.col("age"), ["g"], 3, 7, 2, True).collect()) == [("", 1), ("a", 2), ("a", 5)]


RULES = rules.Rules(groups={"a": ["llm", "large language model"], "b": ["stock"], "x": ["bad"]}, buckets=[rules.Bucket("one", require_all=["a", "b"], bonus="1"), rules.Bucket("two", require_any=["a"], bonus="1")], exclude=["x"], weights={"require_all": "1"})


def test_rules(spark):
    df = spark.createDataFrame([(1, "LLM for stock", "a large  language model", ["X"]), (2, "llm", None, None), (3, "stock", "bad", []), (4, None, None, None)], "id long, title string, abstract string, authors array<string>")
    out = {r.id: (r.matched, r.bucket, r.score) for r in rules.decide(df, RULES).collect()}
    assert out == {1: (True, "one", 7.0), 2: (True, "two", 4.0), 3: (False, None, 0.0), 4: (False, None, 0.0)}
    assert sorted((r.id, r.phrase_group, r.field, r.phrase) for r in rules.long_hits(df, RULES, "id").collect())[:2] == [(1, "a", "abstract", "large language model"), (1, "a", "title", "llm")]


def test_greedy_keeps_the_first_of_what_meets(spark):
    """No two kept rows share a key; every dropped row shares one with an earlier kept row. Only one set of rows has both."""
    rng = random.Random(3)
    for _ in range(3):
        rows = [(i, rng.choice([None, "", *"abcdefg"]), rng.choice([None, *"pqrst"])) for i in range(40)]
        df = spark.createDataFrame(rows, "o long, id string, url string")
        kept = {r.o for r in dedupe.greedy(df, "o", [F.col("id"), F.col("url")]).collect()}
        meet = lambda x, y: any(p and p == q for p, q in zip(x[1:], y[1:]))
        assert not any(meet(x, y) for x in rows for y in rows if x[0] < y[0] and x[0] in kept and y[0] in kept)
        assert all(any(meet(x, y) for x in rows if x[0] < y[0] and x[0] in kept) for y in rows if y[0] not in kept)
    assert dedupe.greedy(df.where("false"), "o", [F.col("id")]).count() == 0


def test_greedy_follows_long_chains(spark):
    """A chain of alternating keys, in which every second row stays."""
    rows = [(i, f"a{(i + 1) // 2}", f"b{i // 2}") for i in range(24)]
    df = spark.createDataFrame(rows, "o long, id string, url string")
    assert sorted(r.o for r in dedupe.greedy(df, "o", [F.col("id"), F.col("url")]).collect()) == list(range(0, 24, 2))


def test_fuzzy_pairs_match_brute_force(spark):
    assert round(dedupe.indel_similarity("kitten", "sitting"), 2) == 61.54
    rng = random.Random(5)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randint(20, 60))) for _ in range(30)]
    other = [b[:i] + rng.choice("abcd") + b[i + rng.randint(0, 2) :] for b in base for i in [rng.randrange(len(b))]] + ["", None]
    left = spark.createDataFrame(list(enumerate(base)), "id long, text string")
    right = spark.createDataFrame(list(enumerate(other)), "id long, text string")
    got = {(r.left_id, r.right_id) for r in dedupe.fuzzy_pairs(left, right, 96).collect()}
    assert got == {(i, j) for i, a in enumerate(base) for j, b in enumerate(other) if b and dedupe.indel_similarity(a, b) >= 96}


def test_provenance_and_first(spark):
    df = spark.createDataFrame([("k", 2, "h2", ["b", None, "a"]), ("k", 1, "h1", ["c", "b"]), (None, 0, "h", ["z"]), ("e", 3, "h", None)], "id string, o long, h string, g array<string>")
    out = {r.id: (r.o, r.h, r.g) for r in dedupe.merged_provenance(df, "id", "o", ["g"]).collect()}
    assert out == {"k": (1, "h1", ["c", "b", "a"]), "e": (3, "h", [])}
    assert [r.o for r in dedupe.first_by_id(df, "id", "o").orderBy("o").collect()] == [1, 3]


def test_balanced_selection(spark):
    """Forced core rows stand first, the limited bucket keeps its cap, nothing better is left out, places count up."""
    rng = random.Random(1)
    rows = [(i, rng.choice(["core", "tool", "adj", None])) for i in range(25)]
    df = spark.createDataFrame(rows, "o long, bucket string")
    for least, most, target in ((3, 2, 8), (0, 0, 5), (9, 1, 4)):
        got = rank.balanced(df, [F.col("o")], "bucket", "core", least, "tool", most, target).orderBy("place").collect()
        assert [r.place for r in got] == list(range(1, len(got) + 1)) and len(got) == target
        core_rows = [i for i, b in rows if b == "core"][: min(least, target)]
        assert [r.o for r in got[: len(core_rows)]] == core_rows and sum(r.bucket == "tool" for r in got) <= most
        rest = [r.o for r in got[len(core_rows) :]]
        out = [i for i, b in rows if i not in {r.o for r in got} and (b != "tool" or sum(r.bucket == "tool" for r in got) < most)]
        assert rest == sorted(rest) and (not rest or not out or max(rest) < min(out))


def test_scores_and_backfill(spark):
    ages = spark.createDataFrame([(None,), (-2,), (0,), (5,), (10,), (11,), (100,), (102,)], "a int")
    assert [round(r[0], 5) for r in ages.select(rank.recency(F.col("a"), 10)).collect()] == [0.3, 1.2, 1.0, 0.5, 0.0, 0.24726, 0.00342, 0.0]
    assert one(spark, rank.as_score, "120", "-3", "x", "7.5", None) == [100.0, 0.0, 0.0, 7.5, 0.0]
    assert one(spark, rank.as_bool, "Yes", "0", "maybe", None) == [True, False, None, None]
    df = spark.createDataFrame([(i, i % 2) for i in range(6)], "o long, r int")
    chosen = df.where("o = 5").withColumn("place", F.lit(1))
    assert [r.o for r in rank.backfill(chosen, df, "o", F.col("r") == 0, [F.col("o")], 5).orderBy("place").collect()] == [5, 0, 2, 4, 1]
    assert rank.accepted(df, F.lit(None).cast("boolean")).count() == 6 and rank.accepted(df, F.col("r") == 1).count() == 3


def test_merges(spark):
    stored = spark.createDataFrame([(1, "a", "u", "t"), (2, "b", None, "s"), (3, "a", "v", "")], "o long, id string, url string, title string")
    new = spark.createDataFrame([(10, "z", "u", "n1"), (11, None, "", ""), (12, "n", None, "new"), (13, "n", None, "newer")], "n long, id string, url string, title string")
    out = merge.archive_merge(stored.withColumn("seen", F.lit("old")), new, ["id", "url", "title"], "o", "n", ["id", "url", "title"], {"seen": F.lit("now")})
    assert sorted((r.id or "", r.title or "", r.seen, r.origin) for r in out.collect()) == [("", "", "now", "new"), ("a", "", "old", "kept"), ("b", "s", "old", "kept"), ("n", "newer", "now", "new"), ("z", "n1", "old", "updated")]
    t = spark.createDataFrame([("k", 1, "x"), ("k", 2, ""), (None, 3, "q")], "key string, o long, v string")
    assert merge.last_rows(t, "key", "o", ["v"]).first().v == "" and merge.ordered_items(t, "key", "o", F.col("v"), "l").first().l == ["x"]
    known = dedupe.known_reason(new, stored, [("id", "id"), ("url", "url")], "o")
    assert {r.n: r.reason for r in known.collect()} == {10: "url", 11: None, 12: None, 13: None}


def test_rendering(spark):
    df = spark.createDataFrame([("s", 1, "T", ["A"], None), (None, 1, None, None, "d")], "source string, place int, title string, authors array<string>, date string")
    body = render.entry(F.col("place"), F.col("title"), F.col("authors"), F.col("source"), F.col("date"), F.lit(None).cast("string"))
    out = {r.source: r.markdown for r in render.digest(df, ["source"], "place", body, 2).collect()}
    assert "Only 1 of 2" in out["s"] and "- Authors: unknown" in out[None]
    assert one(spark, notes.clean_note, "文章  很好", "使用 FALLBACK 路径", "", None, "这篇文章值得一读，因为它新", "如果你关心债券，这篇论文给出的证据充分。", "如果你关心债券，这篇论文") == [
        "这篇论文 很好。", "", "", None, "这篇论文新。", "这篇论文围绕债券，给出了充分的证据。", "这篇论文围绕债券，提供了直接证据。",
    ]
    assert one(spark, notes.settled_terms, "LLM 与LLM", " finbert ", None) == ["大语言模型 与LLM", "FinBERT", None]
    empty = render.with_empty(render.digest(df.where("place = 1 and source is not null"), ["source"], "place", body, 1), spark.createDataFrame([("s",), ("t",)], "source string"), ["source"])
    assert {r.source: (r.records, "No new" in r.markdown) for r in empty.collect()} == {"s": (1, False), "t": (0, True)}
    assert one(spark, lambda c: render.too_short(c, F.lit("x" * 70)), "y" * 240, "y" * 239, None) == [True, False, False]


def test_state_and_sources(spark, tmp_path):
    ids = spark.createDataFrame([("s", "doi:1"), ("s", "doi:1"), ("s", ""), ("s", "N/A"), ("s", " doi:2 ")], "source string, id string")
    assert state.ids_by_source(ids).first().ids == ["doi:1", "doi:2"]
    v = state.Versions(spark, f"file://{tmp_path}/v", state.IDS)
    assert v.read().count() == 0
    v.replace(ids)
    v.replace(v.read().limit(1))
    assert v.read().count() == 1
    (tmp_path / "a.tsv").write_text("paper\ttitle\nw1\t NULL \nw2\tx\textra\n")
    assert [tuple(r) for r in readers.delimited(spark, f"file://{tmp_path}/a.tsv", ["paper", "title"]).collect()] == [("w1", ""), ("w2", "x")]
    (tmp_path / "f.xml").write_text("<feed><entry><id>http://x/abs/1v2</id><title>A\n B</title><summary>s</summary><published>2024-01-02T00:00:00Z</published><author><name>N</name></author></entry></feed>")
    feed = readers.atom_entries(spark, f"file://{tmp_path}/f.xml").select(F.struct("*").alias("e"), F.lit(1).alias("o"), F.lit("g").alias("q"))
    entry = items.atom_rows(feed, F.col("e"), "o", "q").first()
    assert (entry.paper_id, entry.title, entry.authors, entry.date, entry.link) == ("arxiv:1v2", "A B", ["N"], "2024-01-02", "http://x/abs/1v2")
    (tmp_path / "b.csv").write_text("title, paper \nT,w9\n")
    assert readers.delimited(spark, f"file://{tmp_path}/b.csv", ["paper", "title", "none"], ",").first() == ("w9", "T", "")
    assert readers.bulk_table(spark, f"file://{tmp_path}/b", ["paper"]).first().paper == "w9" and readers.bulk_table(spark, f"file://{tmp_path}/nowhere", ["paper"]).count() == 0
    load = lambda s: s.range(3)
    fail = lambda s: s.read.parquet(f"file://{tmp_path}/missing")
    cache = f"file://{tmp_path}/cache"
    with pytest.raises(Exception):
        readers.cached(spark, cache, fail, 50, 10)
    assert [readers.cached(spark, cache, f, now, 10).count() for f, now in ((load, 100), (fail, 105), (fail, 900))] == [3, 3, 3]
    lines = spark.createDataFrame([('"paper","abstract"',), ('"w1\tfirst, second",,',), ("no tab",)], "value string")
    assert [tuple(r) for r in readers.tabbed_abstracts(lines).collect()] == [("w1", "first, second")]
    good = lambda s: ids

    def broken(s):
        raise OSError("down")

    df, failed = readers.united(spark, {"good": good, "broken": broken}, state.IDS)
    assert df.count() == 5 and failed == {"broken": "down"}
    (tmp_path / "bad.json").write_text('{"source": "s", "id": "1"}\n{broken\n')
    late = lambda s: readers.json_lines(s, f"file://{tmp_path}/bad.json", state.IDS)
    df, failed = readers.united(spark, {"late": late, "good": good}, state.IDS)
    assert df.count() == 5 and set(failed) == {"late"} and df.first().source_nth == 1
    (tmp_path / "p").mkdir()
    landed = {"j-000": {"items": [{"a": 1}, 2], "next": "c"}, "j-001": {"items": [3], "next": "c"}, "j-002": {"items": [4]}, "k-000": {"items": [], "next": "c"}, "k-001": {"items": [5]}, "l-000": {"status": 429}, "l-001": {"items": [6]}, "m-000": {"items": [7]}}
    for name, page in landed.items():
        (tmp_path / "p" / f"{name}.json").write_text(json.dumps(page))
    (tmp_path / "p" / "x-000.json").write_text("{broken")
    assert [r.item for r in pages.landed(spark, f"file://{tmp_path}/p").orderBy("stream", "page", "nth").collect()] == ['{"a":1}', "2", "3"]
    works = spark.createDataFrame([(json.dumps({"published": {"date-parts": [[2024, 13]]}, "issued": {"date-parts": [[2023]]}}),)], "j string").select(F.from_json("j", readers.WORK).alias("w"))
    assert works.select(D.first_parts(F.col("w"), ["published", "issued"]).alias("a"), D.first_parts(F.col("w"), ["issued"], 3).alias("b")).first() == ("2023-01-01", None)


def test_delivery_is_replay_safe(spark, tmp_path):
    published = []
    d = Delivery(spark, f"file://{tmp_path}/d", "id", "o", lambda df, key: published.append((key, df.count())))
    first = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (None, 4)], "id long, o long")
    second = spark.createDataFrame([(2, 5), (3, 6)], "id long, o long")
    for batch, df in ((0, first), (1, second), (1, second)):
        d.run(df, batch)
    assert published == [("batch-0", 2), ("batch-1", 1), ("batch-1", 1)]
    assert sorted(r.id for r in d.delivered().collect()) == [1, 2, 3]
    first.write.parquet(f"file://{tmp_path}/in")
    s = Delivery(spark, f"file://{tmp_path}/s", "id", "o")
    s.start(spark.readStream.schema(first.schema).parquet(f"file://{tmp_path}/in"), f"file://{tmp_path}/c").awaitTermination(60)
    assert s.delivered().count() == 2


def test_queries_are_named_alike():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_capped_and_batches(spark):
    df = spark.createDataFrame([(g, i) for g in "ab" for i in range(5)], "g string, i long")
    assert rank.capped(df, "g", F.col("g"), F.col("i"), 3, 4).count() == 4
    assert max(r.batch for r in rank.batches(df, ["g"], [F.col("i")], 2).collect()) == 2
    with pytest.raises(Exception):
        readers.json_lines(spark, "/nonexistent", state.IDS).count()


def test_bulk_merge_takes_every_order(spark, tmp_path):
    d = f"file://{tmp_path}"
    spark.createDataFrame([(1, 3, "O", "low"), (1, 7, "F", "high"), (2, 14, "P", "low")], "o_custkey long, o_orderkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(1, "a", "x"), (3, "", "y")], "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{d}/customer.parquet")
    out = {r.key: tuple(r)[1:] for r in core.bulk_full_outer_merge(spark, d).collect()}
    assert out == {1: ("a", 7, "F", "low;high"), 2: ("unknown", 14, "P", "low"), 3: ("unknown", None, None, None)}


def test_notes_keep_the_whole_text(spark, tmp_path):
    text = "A heading of more than forty characters in one line\nbody; of\nthe text? Then more"
    spark.createDataFrame([(10, text), (20, "title\n出现报错"), (30, None)], "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in core.note_sanitize(spark, f"file://{tmp_path}").collect()}
    head = "A heading of more than forty characters in one line"
    assert (out[10].note, out[10].first) == (f"{head} body; of the text? Then more。", f"{head} body;")
    assert out[10].closed == out[10].note and out[20].note == "" and out[30].note is None


def test_unreadable_state_is_no_empty_state(spark, tmp_path):
    (tmp_path / "d" / "ids" / "batch=0").mkdir(parents=True)
    (tmp_path / "d" / "ids" / "batch=0" / "part.parquet").write_text("broken")
    d = Delivery(spark, f"file://{tmp_path}/d", "id", "o")
    with pytest.raises(Exception):
        d.run(spark.createDataFrame([(1, 1)], "id long, o long"), 1)


def test_documents_grow_by_run_keys(spark, tmp_path):
    doc = sinks.Document(spark, f"file://{tmp_path}/doc")
    assert doc.sections().count() == 0
    body = spark.createDataFrame([("top3-1", "x\n\n"), ("nber-1", "y")], "k string, t string").select(sinks.section(F.lit("T"), F.lit("top3"), F.col("k"), F.col("t")).alias("body"))
    assert [r.body for r in body.collect()] == ["## T | 1\n\nx\n\n---\n\n", None]
    for key, nth in (("a", 1), ("b", 2), ("a", 1)):
        doc.put(body.where("body is not null"), key, nth)
    assert [r.run_key for r in doc.sections().collect()] == ["b", "a"] and [r.run_key for r in doc.sections(False).collect()] == ["a", "b"]
    rows = spark.createDataFrame([(1, None), (2, "é")], "a long, b string")
    sinks.write_json_lines(rows, f"file://{tmp_path}/lines")
    assert sorted(map(tuple, readers.json_lines(spark, f"file://{tmp_path}/lines", rows.schema).collect())) == [(1, None), (2, "é")]
    sinks.write_markdown(rows.select(F.lit("# a\nb").alias("markdown")).limit(1), f"file://{tmp_path}/md")
    assert [r.value for r in spark.read.text(f"file://{tmp_path}/md").collect()] == ["# a", "b"]


def test_configuration(tmp_path):
    (tmp_path / ".env").write_text("# c\nA=1\nexport B='two'\nA=3\n=x\nC\nSET=new\n")
    env = {"SET": "old"}
    assert config.load_env(str(tmp_path / ".env"), env) == {"A": "1", "B": "two"} and env["SET"] == "old"
    assert config.first_set("NONE", "B", env=env) == "two" and config.load_env(str(tmp_path / "none"), env) == {} and config.load_yaml(str(tmp_path / "none.yml")) == {}
    (tmp_path / "r.yml").write_text("groups: {a: [llm]}\nbuckets: {one: {require_all: [a], bonus: 1.5}}\nextras: [{groups: [a], weight: 2, bucket: one}]\nweights: {require_all: 1}\n")
    loaded = rules.from_config(config.load_yaml(str(tmp_path / "r.yml")))
    assert loaded == rules.Rules(groups={"a": ["llm"]}, buckets=[rules.Bucket("one", require_all=["a"], bonus="1.5")], extras=[rules.Extra(["a"], "2", bucket="one")], weights={"require_all": "1"})
    with pytest.raises(TypeError):
        rules.from_config({"buckets": {"b": {"unknown": 1}}})


def test_extras_add_to_scores(spark):
    base = dict(groups={"a": ["llm"], "b": ["stock"]}, buckets=[rules.Bucket("one", require_any=["a"]), rules.Bucket("two", require_any=["b"])])
    df = spark.createDataFrame([(1, "llm", "stock", []), (2, "stock", None, None)], "id long, title string, abstract string, authors array<string>")
    score = lambda extras: {r.id: (r.bucket, r.score) for r in rules.decide(df, rules.Rules(**base, extras=extras)).collect()}
    assert score([]) == {1: ("one", 3.0), 2: ("two", 2.0)}
    assert score([rules.Extra(["b"], "1.5", bucket="two"), rules.Extra(["a"], "0.25", fields=("abstract",))]) == {1: ("two", 4.5), 2: ("two", 3.5)}


def test_backends_fail_by_batch(spark):
    class Flaky:
        """Fails on batches that hold a bad prompt; answers with fenced JSON."""

        def answer(self, prompts):
            if any("bad" in p for p in prompts):
                raise OSError("down")
            return [f'sure:\n```json\n{{"relevance_score": {len(p)}, "is_relevant": true, "why": ""}}\n```' for p in prompts]

    df = spark.createDataFrame([(1, "abc"), (2, "bad"), (3, "de"), (4, "f")], "id long, text string").coalesce(1)
    got = {r.id: r.answer for r in enrich.answered(df, "id", "text", Flaky(), 2).collect()}
    assert got[1] is None and got[2] is None and json.loads(got[3])["relevance_score"] == 2
    out = {r.id: (r.relevance, r.verdict, r.why) for r in enrich.with_verdicts(df, enrich.answered(df, "id", "text", Flaky(), 2), "id").collect()}
    assert out == {1: (0.0, None, None), 2: (0.0, None, None), 3: (2.0, True, None), 4: (1.0, True, None)}
    papers = spark.createDataFrame([(1, "T", "x" * 300, "S", "2024"), (2, "T", None, "S", None), (3, None, "", None, None)], "id long, title string, abstract string, source string, date string")
    answers = spark.createDataFrame([(1, '{"translation": "短"}'), (2, None)], "id long, answer string")
    got = {r.id: r for r in enrich.with_translations(papers, answers, "id").collect()}
    assert got[1].translated == "x" * 300 and got[2].translated == "未获取到 abstract。该论文题目为《T》，来源为 S。" and got[3].translated == "未获取到 abstract。该论文当前只拿到了题录元数据。"
    assert got[1].note == "这篇论文的重点是" + "x" * 300 + "。" and got[2].note.startswith("这篇论文目前只拿到了标题与元数据") and got[2].note.endswith("发布的原文。")


def test_numbering_over_partitions(spark):
    rng = random.Random(2)
    values = rng.sample(range(1000), 300)
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    assert [(r.place, r.v) for r in rank.numbered(df, [F.col("v").desc()]).orderBy("place").collect()] == list(enumerate(sorted(values, reverse=True), 1))


def test_addresses_of_links(spark):
    hrefs = ["http://a/b", "//c/d", "/e", "?q", "#f", "g/h", "", "mailto:x"]
    assert one(spark, lambda c: docs.absolute(F.lit("https://s.org/p/q?x=1#y"), c), *hrefs) == ["http://a/b", "https://c/d", "https://s.org/e", "https://s.org/p/q?q", "https://s.org/p/q?x=1#f", "https://s.org/p/g/h", "https://s.org/p/q?x=1", "mailto:x"]
    assert one(spark, lambda c: docs.absolute(F.lit("https://s.org"), c), "/e", "g") == ["https://s.org/e", "https://s.org/g"]
    assert one(spark, items.bulk_number, "w12", "W3", "h4", " 5 ", "w", None) == ["12", "3", "h4", "5", "w", ""]
    assert one(spark, items.bulk_url, "12", "h4", "", None) == ["https://www.nber.org/papers/w12", "https://www.nber.org/papers/h4", "", ""]


def test_similar_titles_are_known(spark, tmp_path):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(30, 70))).strip() for _ in range(12)]
    titles = [t if rng.random() < 0.3 else t[:i] + rng.choice("abcxyz") * rng.randint(0, 2) + t[i + rng.randint(0, 2) :] for t in base * 5 for i in [rng.randrange(len(t))]] + ["", None]
    rng.shuffle(titles)
    rows = [(i, rng.choice([f"p{i}", "p"]), rng.choice([f"u{i}", "u", None]), t) for i, t in enumerate(titles)]
    kept, reasons = [], {}
    for o, p, u, t in rows:
        if not any(p == q or (u and u == v) or (t and x and dedupe.indel_similarity(t, x) >= 96) for _, q, v, x in kept):
            kept.append((o, p, u, t))
    d = f"file://{tmp_path}"
    schema = "o long, paper_id string, canonical_url string, normalized_title string"
    spark.createDataFrame(rows, schema).withColumnRenamed("o", "row_no").write.parquet(f"{d}/papers.parquet")
    assert sorted(r.row_no for r in core.greedy_dedupe(spark, d).collect()) == [r[0] for r in kept]
    stored = [(i, f"s{i}", None, t) for i, t in enumerate(base[:6])]
    spark.createDataFrame(stored, schema).withColumnRenamed("o", "hist_no").write.parquet(f"{d}/accepted_papers.parquet")
    spark.createDataFrame(rows, schema).withColumnRenamed("o", "arrival_no").write.parquet(f"{d}/incoming_papers.parquet")
    for o, _, _, t in rows:
        if t and any(dedupe.indel_similarity(t, x) >= 96 for x in base[:6]):
            reasons[o] = "title" if t in base[:6] else "title_similarity"
    assert {r.arrival_no: r.reason for r in core.pushed_match_reason(spark, d).collect()} == reasons and {*reasons.values()} == {"title", "title_similarity"}


def test_segments_are_not_broadcast(spark, monkeypatch):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(25, 80))).strip() for _ in range(40)]
    texts = sorted({t[:i] + rng.choice(["", "a", "z9"]) + t[i + rng.randint(0, 1) :] for t in base * 3 for i in [rng.randrange(len(t))]})
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    plans, staged = [], dedupe.stage
    plan = lambda d: plans.append(d._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(dedupe, "stage", lambda d, name: plan(d) or staged(d, name))
    monkeypatch.setattr(dedupe, "PASS_ROWS", 5_000, raising=False)
    out = dedupe.similar_texts(df, df, once=True)
    plan(out)
    # The planner takes a text's segments for one row, so it would send them all to the driver.
    assert not any("BroadcastHashJoin [h#" in p for p in plans) and sum("SortMergeJoin [h#" in p for p in plans) > 1
    near = {(min(p, key=lambda x: (len(x), x)), max(p, key=lambda x: (len(x), x))) for p in itertools.combinations(texts, 2) if dedupe.indel_similarity(*p) >= 96}
    assert near and {(r.left_text, r.right_text) for r in out.collect()} == near


def test_an_indel_changes_one_bit(spark):
    rng = random.Random(10)
    pairs = [(t, t[:i] + t[i + 1 :]) for _ in range(300) for t in ["".join(rng.choice("abcz 0129é-") for _ in range(rng.randint(1, 40)))] for i in [rng.randrange(len(t))]]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert df.where(F.bit_count(dedupe.letters(F.col("a")).bitwiseXOR(dedupe.letters(F.col("b")))) > 1).isEmpty()


def test_plans_of_similar_titles_stay_small(spark, monkeypatch):
    """What a step writes is read again, so no plan holds the steps before it, and the rules run over rows that no join has shuffled."""
    plans = []
    staged = dedupe.stage

    def plan(d, name="stage"):
        plans.append((name, d._jdf.queryExecution().optimizedPlan().toString().count("\n"), d._jdf.queryExecution().executedPlan().toString()))
        return staged(d, name)

    for m in (dedupe, core):
        monkeypatch.setattr(m, "stage", plan)
    sf = "/root/testdata/sf0.001"
    core.pushed_match_reason(spark, sf)
    # The join with the stored keys is written before its new rows are compared; these then read what was written.
    assert [n for n, *_ in plans][:2] == ["known", "texts"] and "accepted_papers" not in plans[1][2]
    assert "abstract" not in plans[0][2]
    plans.clear()
    core.ranked_pipeline(spark, sf)
    assert [n for n, *_ in plans].count("decisions") == 1
    assert "Exchange hashpartitioning" not in next(p for n, _, p in plans if n == "decisions")
    assert max(lines for _, lines, _ in plans) < 60


def test_keys_of_one_row_settle_nothing(spark, monkeypatch):
    rows, written = [], dedupe.stage
    monkeypatch.setattr(dedupe, "stage", lambda d, name: rows.append((d.columns, d.count())) or written(d, name))
    df = spark.createDataFrame([(i, f"id{i}", "u" * 500 if i in (3, 7) else f"u{i}") for i in range(50)], "o long, id string, url string")
    assert {r.o for r in dedupe.greedy(df, "o", [F.col("id"), F.col("url")]).collect()} == {*range(50)} - {7}
    assert [n for c, n in rows if c == ["_o", "i", "k"]][0] == 2
