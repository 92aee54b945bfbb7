"""Text functions as Columns. White space is Unicode white space everywhere, as one literal class that codegen compiles once."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, and what counts as a word character, for regexps shared by Spark and DuckDB.
WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
#: Cells that mean "no value".
NULL_TOKENS = ("NULL", "NONE", "N/A", "NA")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used; else long chains of rules repeat it in each use."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def strip(c: Column) -> Column:
    """No white space at the ends."""
    return F.regexp_replace(c, rf"\A{WS}+|{WS}+\z", "")


def blank_to_null(c: Column) -> Column:
    """Empty text is no text."""
    return F.when(c != "", c)


def clean_cell(c: Column) -> Column:
    """Stripped; null tokens in any case become the empty string, as does null."""
    x = strip(F.coalesce(c, F.lit("")))
    return F.when(F.upper(x).isin(*NULL_TOKENS), "").otherwise(x)


def normalize_title(c: Column) -> Column:
    """Lower-case a-z0-9 words joined by single spaces; other letters separate. Null gives the empty string."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def canonical_url(c: Column) -> Column:
    """Without query and fragment, scheme in lower case, host as typed. Text without a scheme is only stripped; empty gives null."""
    x = strip(c)
    scheme = F.regexp_extract(x, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    cut = F.regexp_replace(x, r"(?s)[?#].*\z", "")
    whole = F.concat(F.lower(scheme), F.expr("''"), cut.substr(F.length(scheme) + 1, F.length(cut)))
    return F.when(c != "", F.when(scheme != "", whole).otherwise(x))


def strip_tags(c: Column) -> Column:
    """Tags become spaces, common entities their characters, white space is squeezed."""
    x = F.regexp_replace(c, r"<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(char))
    return squeeze(x)


def clean_list(c: Column) -> Column:
    """Squeezed items without null and empty ones; a null array is empty."""
    return F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), squeeze), lambda x: x != "")


def stable_id(source: Column, ident: Column, title: Column) -> Column:
    """``source:id``, or 16 hex digits of the normalised title's SHA-1 in place of a missing id."""
    key = F.coalesce(blank_to_null(strip(ident)), F.substring(F.sha1(normalize_title(title)), 1, 16))
    return F.concat(F.lower(F.coalesce(source, F.lit(""))), F.lit(":"), key)


def phrase_pattern(phrase: str) -> str:
    """Regexp of a phrase as whole words, without case; inner blanks match any white space."""
    body = f"{WS}+".join(re.escape(w) for w in phrase.split())
    return rf"(?iu)(?<!{WORD}){body}(?!{WORD})"


def has_phrase(lower: Column, phrase: str) -> Column:
    """Whether the phrase stands in a text given in lower case; a plain search for its first word goes before the regexp."""
    word = phrase.split()[0].lower()
    return F.coalesce(lower.contains(word) & lower.rlike(phrase_pattern(phrase)), F.lit(False))


#: Fixed value: the marks that end a sentence. A full stop is none: it also ends abbreviations and numbers.
ENDS = "。！？!?；;"


def end_sentence(c: Column) -> Column:
    """A full-width stop is added unless the text ends in one of ``ENDS``; empty stays empty."""
    return let(squeeze(c), lambda x: F.when(x == "", "").when(x.rlike(rf"[{ENDS}]\z"), x).otherwise(F.concat(x, F.lit("。"))))


def first_sentence(c: Column) -> Column:
    """Up to the first of ``ENDS`` that white space or the end follows; without one the whole text, closed."""
    x = squeeze(c)
    found = F.regexp_extract(x, rf"\A(.+?[{ENDS}])(?:{WS}|\z)", 1)
    return F.when(found != "", F.trim(found)).otherwise(end_sentence(c))


def replaced_word(c: Column, word: str, to: str) -> Column:
    """Every whole word, in any case, replaced; letters of any script, ideographs too, make it part of a longer word."""
    return F.regexp_replace(c, rf"(?iu)(?<!{WORD}){re.escape(word)}(?!{WORD})", to)


def slug(c: Column) -> Column:
    """Lower-case runs of a-z0-9 joined by hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "-"), r"\A-+|-+\z", "")


def first_text(*cs: Column) -> Column:
    """The first non-empty text, squeezed; empty if there is none."""
    return F.coalesce(*[blank_to_null(squeeze(c)) for c in cs], F.lit(""))


def wiki_token(c: Column) -> Column:
    """The token after ``/wiki/`` in an address, else the text as it is, stripped."""
    x = strip(F.coalesce(c, F.lit("")))
    found = F.regexp_extract(x, "/wiki/([A-Za-z0-9]+)", 1)
    return F.when(found != "", found).otherwise(x)
