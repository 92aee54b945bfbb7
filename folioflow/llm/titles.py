"""Canonical forms of titles as Columns, and the comparison of two titles that may differ by clerical slips."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _folding() -> tuple[str, str]:
    """Accented Latin letters and their base letters, derived from Unicode's decompositions."""
    src, dst = [], []
    for cp in range(0xC0, 0x250):
        base = unicodedata.normalize("NFKD", chr(cp))[0]
        if base != chr(cp) and base.isascii() and base.isalpha():
            src.append(chr(cp))
            dst.append(base)
    return "".join(src), "".join(dst)


FOLD_FROM, FOLD_TO = _folding()


def fold(c: Column) -> Column:
    """Without accents and combining marks."""
    return F.translate(F.regexp_replace(c, r"\p{M}+", ""), FOLD_FROM, FOLD_TO)


#: Remarks that do not name a work, before and after a title.
BEFORE = r"^(?:(?:draft|preliminary draft|preliminary|preprint|working paper|revised|new|forthcoming)\s*:\s*|(?:the|a|an|on)\s+)+"
_REMARK = r"(?:working paper|discussion draft|preliminary draft|preliminary version|preliminary|draft|revised version|revised|forthcoming|preprint|with appendix|with appendices|with online appendix|online appendix|extended version|accepted version|in press)"
AFTER = rf"(?:\s*(?:[\[(]\s*{_REMARK}\s*[\])]|\s[-–—]+\s*{_REMARK}|[*†‡§¹²³]+))+\s*$"
CUT = r"(?:\.{3,}|…)\s*$"


#: What the plainest titles lack: markup, entities, and an end that a remark or a footnote mark could have.
_MARKED = r"[<&]|(?:[\])*]|paper|draft|version|preliminary|revised|forthcoming|preprint|appendix|appendices|press)\s*$"
_SPACE = r"[\s\x{85}\p{Z}]+"


def plain(title: Column) -> Column:
    """Lower-case text without markup, accents, and remarks around the title; ``&`` reads ``and``.

    Plain ASCII titles, most of them, skip the replacements that cannot change them.
    """
    x = F.regexp_replace(title, r"</?[A-Za-z][^<>]*>", "")
    x = F.regexp_replace(x, r"(?i)&amp;", "&")
    x = F.regexp_replace(x, r"(?i)&(?:lt|gt|quot|apos|nbsp|#[0-9]{1,7}|#x[0-9a-f]{1,6});", " ")
    x = F.lower(fold(x))
    x = F.trim(F.regexp_replace(F.regexp_replace(x, "&", " and "), _SPACE, " "))
    x = F.regexp_replace(x, AFTER, "")
    low = F.lower(title)
    simple = (F.octet_length(title) == F.length(title)) & ~low.rlike(_MARKED)
    return F.regexp_replace(F.when(simple, F.trim(F.regexp_replace(low, _SPACE, " "))).otherwise(x), BEFORE, "")


def words(plain_title: Column) -> Column:
    """ARRAY of the runs of a-z0-9."""
    return F.array_remove(F.split(F.trim(F.regexp_replace(plain_title, r"[^a-z0-9]+", " ")), " "), "")


def is_cut(plain_title: Column) -> Column:
    return plain_title.rlike(CUT)
