"""Rows that fail to parse: every field is loaded as nullable text, rules fill an error array, empty arrays pass.

All of it is Column expressions: one narrow stage, no shuffle, no Python, so it runs at scan speed at any size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Unicode white space as a class that Java, RE2 and Python read alike.
SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
#: U+FFFD and control characters other than tab, line feed and carriage return.
BROKEN = r"[\x{FFFD}\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x{9F}]"


def strip(c: Column) -> Column:
    """Removes Unicode white space at both ends."""
    return F.regexp_replace(c, rf"\A{SPACE}+|{SPACE}+\z", "")


@dataclass(frozen=True)
class Field:
    """A field of the record. ``cast``: SQL type the text must have. ``checks``: (reason, Column -> Column true if bad)."""

    name: str
    cast: str = "string"
    checks: Sequence[tuple[str, Callable[[Column], Column]]] = field(default_factory=tuple)


def field_pattern(sep: str) -> str:
    """One delimited field. Possessive groups: matching needs no stack and no backtracking however long the text is."""
    return rf'(?:"(?:[^"]++|"")*+"|(?!")[^{sep}]*+)'


def parse_delimited(df: DataFrame, raw: str, fields: Sequence[Field], seps: Sequence[tuple[Column, str]], default_sep: str = ",", prefix: str = "") -> DataFrame:
    """Adds one column for each field and ``errors`` ARRAY<STRING>, the reasons in order of precedence.

    ``seps``: (condition, separator as a regexp character), the first that holds counts, else ``default_sep``.
    A null record has no fields: its reason is ``column_count``. Fields of records that do not split are null.
    Field names that clash with a column of ``df`` replace it unless ``prefix`` is given.
    Reasons: ``quoting``, ``column_count``, then each field's cast and checks (``value`` for a failed cast).
    """
    text = F.col(f"`{raw}`")

    def by_sep(make: Callable[[str], Column]) -> Column:
        out = None
        for when, sep in seps:
            out = F.when(when, make(sep)) if out is None else out.when(when, make(sep))
        return make(default_sep) if out is None else out.otherwise(make(default_sep))

    def whole(sep: str) -> str:
        return rf"\A{field_pattern(sep)}(?:{sep}{field_pattern(sep)})*+\z"

    def exact(sep: str) -> str:
        return r"\A" + sep.join([f"({field_pattern(sep)})"] * len(fields)) + r"\z"

    quoted = F.coalesce(by_sep(lambda s: text.rlike(whole(s))), F.lit(True))
    counted = F.coalesce(by_sep(lambda s: text.rlike(exact(s))), F.lit(False))
    out = df.withColumns({"_quoted": quoted, "_counted": counted})
    ok = F.col("_quoted") & F.col("_counted")
    cells = {}
    for i, f in enumerate(fields, 1):
        cell = by_sep(lambda s, i=i: F.regexp_extract(text, exact(s), i))
        cell = F.when(cell.startswith('"'), F.replace(cell.substr(F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))).otherwise(cell)
        cells[prefix + f.name] = F.when(ok, cell)
    out = out.withColumns(cells)
    errors = [F.when(~F.col("_quoted"), F.lit("quoting")), F.when(~F.col("_counted"), F.lit("column_count"))]
    for f in fields:
        c = F.col(f"`{prefix + f.name}`")
        if f.cast != "string":
            errors.append(F.when(ok & (strip(c) != "") & strip(c).try_cast(f.cast).isNull(), F.lit("value")))
        errors += [F.when(ok & F.coalesce(bad(c), F.lit(False)), F.lit(reason)) for reason, bad in f.checks]
    out = out.withColumn("errors", F.array_compact(F.array(*errors)))
    casts = {prefix + f.name: strip(F.col(f"`{prefix + f.name}`")).try_cast(f.cast) for f in fields if f.cast != "string"}
    return (out.withColumns(casts) if casts else out).drop("_quoted", "_counted")


def loaded(parsed: DataFrame) -> DataFrame:
    """The rows without an error."""
    return parsed.where(F.size("errors") == 0).drop("errors")


def rejected(parsed: DataFrame) -> DataFrame:
    """The rows with errors; ``reason`` is the first."""
    return parsed.where(F.size("errors") > 0).withColumn("reason", F.col("errors")[0])


#: Paper number and abstract, as the raw abstract files hold them.
ABSTRACT_FIELDS = (
    Field("paper", checks=[("value", lambda c: ~strip(c).rlike(r"\A[whtcWHTC]?[0-9]{1,6}\z"))]),
    Field("abstract", checks=[("value", lambda c: c.rlike(BROKEN))]),
)


def abstract_records(df: DataFrame) -> DataFrame:
    """Parses records of abstract files: .tsv files separate by tab, all others by comma; each file's line 1 is its header.

    Rows whose line_no is null count as data.
    """
    data = df.where(~F.col("line_no").eqNullSafe(1))
    return parse_delimited(data, "raw_text", ABSTRACT_FIELDS, [(F.lower("file_name").endswith(".tsv"), "\t")])
