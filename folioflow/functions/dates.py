"""Date functions as Columns. Every age is taken against an explicit ``as_of``, never the clock."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import squeeze, strip


def try_date(year: Column, month: Column, day: Column) -> Column:
    """DATE of the parts (text or numbers), null if no such day exists."""
    return F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")).try_cast("date")


def strict_date(c: Column) -> Column:
    """DATE of text of three dash-separated numbers, padded or not; else null."""
    x = strip(c)
    p = r"^([0-9]{1,4})-([0-9]{1,2})-([0-9]{1,2})$"
    return F.when(x.rlike(p), try_date(*[F.regexp_extract(x, p, i) for i in (1, 2, 3)]))


#: The layouts that typed dates come in, in order of trial.
LAYOUTS = ("yyyy-M-d", "yyyy/M/d", "d MMMM yyyy", "d MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy H:m:s")
#: Hours of the named zones of message dates.
ZONES = {"UT": 0, "UTC": 0, "GMT": 0, "Z": 0, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}
MESSAGE = r"(?i)^(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s*)?([0-9]{1,2})\s+([a-z]{3})[a-z]*\s+([0-9]{4})\s+([0-9]{1,2}):([0-9]{2})(?::[0-9]{2})?(?:\s+([+-][0-9]{4}|[a-z]{1,3}))?$"


def message_date(c: Column) -> Column:
    """DATE in UTC of a date as messages carry it (``Tue, 05 Mar 2024 23:30:00 -0500``); without a zone its own day."""
    part = lambda i: F.regexp_extract(c, MESSAGE, i)
    day = F.to_date(F.try_to_timestamp(F.concat_ws(" ", part(1), part(2), part(3)), F.lit("d MMM yyyy")))
    zone = F.upper(part(6))
    named = F.try_element_at(F.create_map(*[F.lit(x) for k, v in ZONES.items() for x in (k, v * 60)]), zone)
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    numeric = sign * (F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, 4, 2).try_cast("int"))
    offset = F.coalesce(F.when(zone.rlike("^[+-]"), numeric).otherwise(named), F.lit(0))
    hour, minute = part(4).try_cast("int"), part(5).try_cast("int")
    shifted = F.date_add(day, F.floor((hour * 60 + minute - offset) / 1440).cast("int"))
    return F.when(c.rlike(MESSAGE) & (hour < 24) & (minute < 60), shifted)


def parse_date(c: Column) -> Column:
    """ISO text of a date as typed: known layouts, then message dates, then the first 20dd-dd-dd in the text (not validated); else null."""
    x = F.regexp_replace(squeeze(c), "Published:|Posted:", "")
    x = F.regexp_replace(x, r"\A[, ]+|[, ]+\z", "")
    full = F.coalesce(*[F.to_date(F.try_to_timestamp(x, F.lit(f))) for f in LAYOUTS], message_date(x))
    loose = F.regexp_extract(x, r"(20[0-9]{2}-[0-9]{2}-[0-9]{2})", 1)
    return F.coalesce(F.date_format(full, "yyyy-MM-dd"), F.when(loose != "", loose))


def days_since(iso: Column, as_of: datetime.date) -> Column:
    """Days from an ISO date to ``as_of``, negative for later ones; null if it is no date."""
    return F.datediff(F.lit(as_of), iso.try_cast("date"))


def first_parts(record: Column, names: list[str], least: int = 1) -> Column:
    """ISO date of the first of the structs whose date-parts give a valid day; missing month and day read as 1."""
    out = []
    for n in names:
        parts = F.get(record[n]["date-parts"], 0)
        day = try_date(F.get(parts, 0), F.coalesce(F.get(parts, 1), F.lit(1)), F.coalesce(F.get(parts, 2), F.lit(1)))
        out.append(F.when(F.size(parts) >= least, F.date_format(day, "yyyy-MM-dd")))
    return F.coalesce(*out)


def stated_parts(record: Column, names: list[str], least: int = 1) -> Column:
    """YYYY-MM-DD of the first of the structs that holds ``least`` date-parts, as stated, not validated; missing month and day read as 1."""
    out = []
    for n in names:
        parts = F.get(record[n]["date-parts"], 0)
        text = F.format_string("%04d-%02d-%02d", F.get(parts, 0), F.coalesce(F.get(parts, 1), F.lit(1)), F.coalesce(F.get(parts, 2), F.lit(1)))
        out.append(F.when((F.size(parts) >= max(1, least)) & F.get(parts, 0).isNotNull(), text))
    return F.coalesce(*out)


def day_key(source: Column, day: Column) -> Column:
    """``source-YYYY-MM-DD``."""
    return F.concat(source, F.lit("-"), F.date_format(day, "yyyy-MM-dd"))


def week_key(source: Column, day: Column) -> Column:
    """``source-IYYY-Www`` of the ISO week."""
    return F.concat(source, F.lit("-"), F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def key_suffix(source: Column, key: Column) -> Column:
    """What follows ``source-`` in a run key; null if the key is of another source or nothing follows."""
    prefix = F.concat(source, F.lit("-"))
    rest = key.substr(F.length(prefix) + 1, F.length(key))
    return F.when(key.startswith(prefix) & (rest != ""), rest)
