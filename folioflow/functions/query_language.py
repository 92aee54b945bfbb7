"""Boolean search queries: tokens, terms, free text and fielded syntax, as higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: a token is a quoted phrase, a parenthesis or a bare word.
TOKEN = r'"[^"]*"|[()]|[^\s()"]+'
OPERATORS = ("AND", "OR", "NOT")


def tokens(c: Column) -> Column:
    """ARRAY of the query's tokens."""
    return F.regexp_extract_all(c, F.lit(f"({TOKEN})"), F.lit(1))


def _is_word(t: Column) -> Column:
    return ~F.upper(t).isin(*OPERATORS) & ~t.isin("(", ")")


def terms(c: Column) -> Column:
    """Terms without operators, parentheses and quotes, once each without regard to case, in order."""
    bare = F.filter(F.transform(F.filter(tokens(c), _is_word), lambda t: F.trim(F.replace(t, F.lit('"'), F.lit("")))), lambda t: t != "")
    lower = F.transform(bare, F.lower)
    return F.filter(bare, lambda t, i: F.array_position(lower, F.lower(t)) == i + 1)


def free_text(c: Column) -> Column:
    """The terms joined by blanks."""
    return F.array_join(terms(c), " ")


def fielded(c: Column, field: str = "all") -> Column:
    """Every term prefixed by the field, phrases in quotes, operators in upper case."""

    def one(t: Column) -> Column:
        bare = F.trim(F.replace(t, F.lit('"'), F.lit("")))
        term = F.when(bare.contains(" "), F.concat(F.lit(f'{field}:"'), bare, F.lit('"'))).otherwise(F.concat(F.lit(f"{field}:"), bare))
        return F.when(F.upper(t).isin(*OPERATORS), F.upper(t)).when(t.isin("(", ")"), t).otherwise(term)

    return F.array_join(F.transform(tokens(c), one), " ")
