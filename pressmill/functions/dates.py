"""Dates of news feeds and portals, and their Indonesian display. Times are zone-less WIB (UTC+7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ["Januari", "Februari", "Maret", "April", "Mei", "Juni", "Juli", "Agustus", "September", "Oktober", "November", "Desember"]
SHORT_MONTHS = ["Jan", "Feb", "Mar", "Apr", "Mei", "Jun", "Jul", "Agu", "Sep", "Okt", "Nov", "Des"]
DAYS = ["Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu", "Minggu"]
WIB_HOURS = 7


def _name(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), index)


def to_wib(value: Column, run_date: Column | None = None) -> Column:
    """RFC-2822 or ISO text to zone-less WIB; values with a zone are shifted, others taken as they are; unparsable is null.

    'N hours/days ago' counts back from run_date."""
    text = F.trim(value)
    bare = F.regexp_replace(text, r"^[A-Za-z]{3},\s*", "")
    offset = F.regexp_extract(text, r"([+-]\d{2}):?(\d{2})$", 1).try_cast("int") * 60
    minutes = F.regexp_extract(text, r"([+-])\d{2}:?(\d{2})$", 2).try_cast("int") * F.when(F.regexp_extract(text, r"([+-])\d{2}:?\d{2}$", 1) == "-", -1).otherwise(1)
    zoned = text.rlike(r"(Z|GMT|UTC|[+-]\d{2}:?\d{2})$") & text.rlike(r"\d:\d")
    local = F.regexp_replace(F.regexp_replace(bare, r"\s*(Z|GMT|UTC|[+-]\d{2}:?\d{2})$", ""), r"\.\d+$", "")
    stamp = F.coalesce(*(F.try_to_timestamp(local, F.lit(f)) for f in ("d MMM yyyy HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm", "yyyy-MM-dd")))
    shift = F.when(zoned, F.lit(60 * WIB_HOURS) - F.coalesce(offset + minutes, F.lit(0))).otherwise(0)
    out = F.timestamp_add("MINUTE", shift, stamp)
    if run_date is not None:
        n = F.regexp_extract(text, r"(?i)^(\d+)\s+(hour|day|week)s? ago$", 1).try_cast("int")
        unit = F.lower(F.regexp_extract(text, r"(?i)^(\d+)\s+(hour|day|week)s? ago$", 2))
        hours = n * F.when(unit == "hour", 1).when(unit == "day", 24).otherwise(168)
        out = F.coalesce(out, F.timestamp_add("HOUR", -hours, run_date.cast("timestamp")))
    return out


def to_day(value: Column) -> Column:
    """Date of any supported text, else an ISO date anywhere inside it."""
    return F.coalesce(F.to_date(to_wib(value)), F.try_to_date(F.regexp_extract(value, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd"), slash_date(value))


def indonesian_date(value: Column) -> Column:
    """'Rabu, 7 Oktober 2026' to a date."""
    pattern = rf"(?i)(\d{{1,2}})\s+({'|'.join(MONTHS)})\s+(\d{{4}})"
    month = F.array_position(F.array(*(F.lit(m.lower()) for m in MONTHS)), F.lower(F.regexp_extract(value, pattern, 2)))
    return F.try_to_date(F.concat_ws("-", F.regexp_extract(value, pattern, 3), month.cast("string"), F.regexp_extract(value, pattern, 1)), "yyyy-M-d")


def slash_date(value: Column) -> Column:
    """'dd/mm/yyyy' anywhere in the text."""
    return F.try_to_date(F.regexp_extract(value, r"(\d{1,2}/\d{1,2}/\d{4})", 1), "d/M/yyyy")


def long_display(day: Column) -> Column:
    return F.concat_ws(" ", F.concat(_name(DAYS, F.weekday(day) + 1), F.lit(",")), F.dayofmonth(day).cast("string"), _name(MONTHS, F.month(day)), F.year(day).cast("string"))


def short_display(day: Column) -> Column:
    return F.concat_ws(" ", F.dayofmonth(day).cast("string"), _name(SHORT_MONTHS, F.month(day)), F.year(day).cast("string"))


def duration(seconds: Column) -> Column:
    """Seconds, one at least, as 'Xm YYs'."""
    s = F.greatest(F.lit(1), seconds.cast("int"))
    return F.format_string("%dm %02ds", F.floor(s / 60).cast("int"), F.pmod(s, F.lit(60)))


def seconds(text: Column) -> Column:
    """'Xm YYs' back to seconds; null where it is not of that form."""
    return F.regexp_extract(text, r"^(\d+)m (\d+)s$", 1).try_cast("int") * 60 + F.regexp_extract(text, r"^(\d+)m (\d+)s$", 2).try_cast("int")


def in_range(at: Column, first: str, last: str) -> Column:
    """Whether a time lies in the days from first to last; null without a time, which a filter drops. Plain bounds, so that scans skip by it."""
    return (at >= F.to_timestamp(F.lit(first))) & (at < F.to_timestamp(F.lit(last)) + F.expr("INTERVAL 1 DAY"))
