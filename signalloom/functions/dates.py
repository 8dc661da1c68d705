"""Lenient dates and month keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_timestamp(col: Column) -> Column:
    """ISO timestamps (zone optional, UTC if absent), bare dates and RFC-822 dates; null otherwise."""
    iso = col.rlike(r"^\d{4}-\d{2}-\d{2}")
    rfc = F.regexp_replace(F.trim(col), r"^[A-Za-z]{3},\s*", "")
    rfc = F.regexp_replace(rfc, r"\s+(?:GMT|UTC|Z)$", " +0000")
    mail = F.coalesce(
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss xx")),
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm xx")),
    )
    return F.when(iso, F.try_to_timestamp(col)).otherwise(mail)


def parse_timestamp_or_day(col: Column) -> Column:
    """Like parse_timestamp; an unreadable time of day falls back to its date."""
    return F.coalesce(
        parse_timestamp(col), F.when(col.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(F.substring(col, 1, 10)))
    )


def month_key(col: Column) -> Column:
    """Year and month as written in the stamp itself, not shifted to UTC."""
    return F.when(parse_timestamp(col).isNotNull(), F.substring(col, 1, 7)).otherwise(F.lit(""))


def last_months(as_of: str, count: int = 6) -> list[str]:
    """Month keys of the `count` months ending with that of `as_of`, oldest first."""
    last = int(as_of[:4]) * 12 + int(as_of[5:7]) - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(last - count + 1, last + 1)]


def instant(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp")


def days_before(as_of: str, days: float) -> Column:
    return instant(as_of) - F.make_dt_interval(F.lit(int(days)))


def in_trailing(ts: Column, as_of: str, start_days: int, end_days: int = 0) -> Column:
    """Half-open window (as_of - start_days, as_of - end_days]."""
    return (ts > days_before(as_of, start_days)) & (ts <= days_before(as_of, end_days))


def age_in_days(ts: Column, as_of: str) -> Column:
    """Whole days between `ts` and `as_of`, floored (negative for future stamps)."""
    seconds = F.unix_micros(instant(as_of)) - F.unix_micros(ts)
    return F.floor(seconds / F.lit(86400 * 1000000))


def relative_date(col: Column, today: str) -> Column:
    """Date of texts such as `about 3 days`; ISO dates pass, anything else becomes empty."""
    text = F.coalesce(F.trim(F.regexp_replace(col, r"(?U)\s+", " ")), F.lit(""))
    pattern = r"(?i)^(?:about )?(\d+)\s+(hour|day|month|year)s?$"
    amount = F.try_to_number(F.regexp_extract(text, pattern, 1), F.lit("999999999")).cast("int")
    unit = F.lower(F.regexp_extract(text, pattern, 2))
    days = F.when(unit == "hour", 0).when(unit == "day", amount).when(unit == "month", amount * 30).otherwise(
        amount * 365
    )
    shifted = F.date_format(F.date_sub(F.lit(today).cast("date"), days), "yyyy-MM-dd")
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text).when(text.rlike(pattern), shifted).otherwise(F.lit(""))
