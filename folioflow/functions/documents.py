"""The few functions that need a parser or sequential state, as Arrow UDFs over the standard library."""

from __future__ import annotations

import html
import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class _Page(HTMLParser):
    """Collects text, title, meta values, links and JSON-LD blocks."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.text: list[str] = []
        self.title: list[str] = []
        self.meta: list[tuple[str, str]] = []
        self.links: list[str] = []
        self.data: list[str] = []
        self.inside: list[str] = []

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            name = a.get("name") or a.get("property") or a.get("itemprop")
            if name and a.get("content"):
                self.meta.append((name.lower(), a["content"].strip()))
            return
        if tag == "a" and a.get("href"):
            self.links.append(a["href"])
        if tag in ("script", "style", "title"):
            self.inside.append("ld" if a.get("type") == "application/ld+json" else tag)

    def handle_endtag(self, tag):
        if tag in ("script", "style", "title") and self.inside:
            self.inside.pop()

    def handle_data(self, data):
        where = self.inside[-1] if self.inside else ""
        if where == "title":
            self.title.append(data)
        elif where == "ld":
            self.data.append(data)
        elif not where:
            self.text.append(data)


PAGE = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("title", T.StringType()), T.StructField("meta", T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]))),
    T.StructField("links", T.ArrayType(T.StringType())), T.StructField("json_ld", T.ArrayType(T.StringType())),
])


def read_page(source: str | None) -> dict | None:
    if source is None:
        return None
    p = _Page()
    p.feed(source)
    p.close()
    flat = lambda parts: " ".join(" ".join(parts).split())
    return {"text": flat(p.text), "title": flat(p.title), "meta": [{"name": n, "value": v} for n, v in p.meta], "links": list(dict.fromkeys(p.links)), "json_ld": p.data}


def absolute(base: Column, href: Column) -> Column:
    """Address of a link on a page: absolute ones stay; ``//host``, ``/path``, ``?query``, ``#part`` and relative ones are put on the base."""
    scheme, host = F.regexp_extract(base, r"\A([A-Za-z][A-Za-z0-9+.-]*):", 1), F.regexp_extract(base, r"\A([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    bare = F.regexp_replace(base, r"[#].*\z", "")
    plain = F.regexp_replace(bare, r"[?].*\z", "")
    folder = F.concat(host, F.regexp_replace(F.concat(F.lit("/"), F.regexp_replace(plain.substr(F.length(host) + 1, F.length(plain)), r"\A/", "")), r"[^/]*\z", ""))
    x = F.trim(href)
    return (
        F.when(x.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*:"), x).when(x.startswith("//"), F.concat(scheme, F.lit(":"), x)).when(x.startswith("/"), F.concat(host, x))
        .when(x.startswith("?"), F.concat(plain, x)).when(x.startswith("#") | (x == ""), F.concat(bare, x)).otherwise(F.concat(folder, x))
    )


def meta_values(page: Column, *names: str) -> Column:
    """ARRAY of the values of a page's meta entries by the given names, names in order, then place."""
    def of(name: str) -> Column:
        return F.transform(F.filter(page["meta"], lambda m: m["name"] == name.lower()), lambda m: m["value"])

    return F.flatten(F.array(*[of(n) for n in names]))


def links_like(page: Column, base: Column, pattern: str) -> Column:
    """ARRAY of the page's links, absolute, once each in order, that the pattern is found in."""
    return F.array_distinct(F.filter(F.transform(page["links"], lambda h: absolute(base, h)), lambda h: h.rlike(pattern)))


@F.pandas_udf(PAGE)
def page(c: pd.Series) -> pd.DataFrame:
    """Text, title, meta, links and JSON-LD of an HTML page; null for null."""
    return pd.DataFrame([read_page(x) or dict.fromkeys(f.name for f in PAGE.fields) for x in c], columns=[f.name for f in PAGE.fields])


@F.pandas_udf(T.StringType())
def markup_text(c: pd.Series) -> pd.Series:
    """Text of a marked-up snippet: entities first, so that escaped tags are tags too; a leading ``Abstract:`` goes."""

    def one(x: str | None) -> str | None:
        if x is None:
            return None
        return re.sub(r"^abstract\s*:?\s+", "", read_page(html.unescape(x))["text"], flags=re.I)

    return c.map(one)


def chunks_of(text: str, most: int) -> list[str]:
    """Pieces of whole lines, joined by line feeds they give the text again.

    A piece is closed before the line that would take it over ``most`` characters (with its line feed), but not inside a fenced
    block; a fence opens and closes with a line that begins with three backticks or tildes. A text of up to ``most`` is one piece.
    """
    lines = text.split("\n")
    opens = [x.startswith(("```", "~~~")) for x in lines]
    out, size, fenced = [[]], 0, False
    for line, mark in zip(lines, opens if len(text) > most else [False] * len(lines)):
        fenced ^= mark
        if len(text) > most and out[-1] and not fenced and size + len(line) + 1 > most:
            out.append([])
            size = 0
        out[-1].append(line)
        size += len(line) + 1
    return ["\n".join(x) for x in out]


def packed(sizes: list[int], most: int) -> list[int]:
    """Number of the batch of each block, in order: a block that no longer fits opens the next batch. One over ``most`` is refused."""
    out, batch, held = [], 0, 0
    for n in sizes:
        if n > most:
            raise ValueError(f"a block of {n} does not fit a batch of {most}")
        if held + n > most:
            batch, held = batch + 1, 0
        held += n
        out.append(batch)
    return out


@F.pandas_udf(T.DoubleType())
def rounded(c: pd.Series) -> pd.Series:
    """To three decimals as binary fractions round: 2.6675 reads 2.667 where its double lies below the tie; exact ties go to even."""
    return pd.Series([None if pd.isna(x) else round(float(x), 3) for x in c], dtype="float64")


def chunks(most: int):
    """UDF: ARRAY of the pieces of a Markdown text."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(c: pd.Series) -> pd.Series:
        return c.map(lambda x: None if x is None else chunks_of(x, most))

    return split


def json_in(text: str | None, kind: type | None = None) -> str | None:
    """The first JSON object or array in a text (only a dict or list, if ``kind`` says so), fenced blocks first, as compact JSON; null if there is none."""
    if text is None:
        return None
    decoder = json.JSONDecoder()
    for part in [*re.findall(r"```(?:json)?\s*\n(.*?)```", text, flags=re.S), text]:
        at = 0
        while (m := re.compile(r"[\[{]").search(part, at)) is not None:
            try:
                value, _ = decoder.raw_decode(part, m.start())
                if kind is not None and not isinstance(value, kind):
                    at = m.start() + 1
                    continue
                return json.dumps(value, ensure_ascii=False, separators=(",", ":"))
            except ValueError:
                at = m.start() + 1
    return None


@F.pandas_udf(T.StringType())
def first_json(c: pd.Series) -> pd.Series:
    return c.map(json_in)


#: Fields that hold an answer's text as it is, containers that may hold it deeper, and where it lies last of all.
DIRECT = ("reply", "text", "message", "assistant", "content")
CONTAINERS = ("reply", "text", "message", "content", "assistant", "output")
LAST = ("result", "messages")


def answer_in(value) -> str:
    """Text of a container: of the parts of a list, of all payloads (their text, else their content), else of the first field that has some."""
    if isinstance(value, str):
        return value.strip()
    if isinstance(value, dict):
        payloads = value.get("payloads")
        told = [answer_in(p["text"] if isinstance(p.get("text"), str) and p["text"].strip() else p.get("content")) for p in payloads if isinstance(p, dict)] if isinstance(payloads, list) else []
        return "\n".join(filter(None, told)) or next(filter(None, (answer_in(value.get(k)) for k in CONTAINERS)), "")
    return "\n".join(filter(None, map(answer_in, value))) if isinstance(value, list) else ""


def whole_answer(text: str | None) -> str | None:
    """Text of an answer given as JSON; text that is no JSON is its own answer. Null if there is none."""
    if text is None:
        return None
    try:
        value = json.loads(text)
    except ValueError:
        return text.strip() or None
    if not isinstance(value, dict):
        return answer_in(value) or None
    plain = next((value[k].strip() for k in DIRECT if isinstance(value.get(k), str) and value[k].strip()), "")
    return plain or answer_in(value) or next(filter(None, (answer_in(value.get(k)) for k in LAST)), None)


@F.pandas_udf(T.StringType())
def answer_text(c: pd.Series) -> pd.Series:
    """Text of an answer in nested containers, or its last resorts; null if there is none."""
    return c.map(whole_answer)
