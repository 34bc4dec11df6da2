"""ISO-8601 text → instant, and the time-decayed recency score."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil import constants as C

# The usual shape; texts of it are cast as they are (one guard, one cast).
ISO_PLAIN = (r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})?)?$")
# All accepted shapes: calendar or week date, extended or compact, optional time
# (hours, minutes, seconds, fraction with '.' or ','), optional zone ('Z', +HH,
# +HHMM, +HH:MM, with seconds too).
ISO_PATTERN = (r"^(\d{4})-?(?:(\d{2})-?(\d{2})|W(\d{2})(?:-?([1-7]))?)"
               r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
               r"(Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?)?$")


def to_epoch_micros(now: dt.datetime | str) -> int:
    """Python instant (naive = UTC) or ISO text → microseconds since the epoch."""
    if isinstance(now, str):
        now = dt.datetime.fromisoformat(now.replace("Z", "+00:00"))
    if now.tzinfo is None:
        now = now.replace(tzinfo=dt.timezone.utc)
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return (now - epoch) // dt.timedelta(microseconds=1)


def _parse_any(text: Column) -> Column:
    """Timestamp of any accepted shape, NULL for everything else."""
    def grp(i: int, empty: str) -> Column:
        g = F.regexp_extract(text, ISO_PATTERN, i)
        return F.when(g == "", F.lit(empty)).otherwise(g)

    year, week = grp(1, ""), grp(4, "")
    day = F.concat_ws("-", year, grp(2, ""), grp(3, "")).try_cast("date")
    # Monday of week 1 is that of the week with 4 January
    first = F.date_trunc("week", F.concat(year, F.lit("-01-04")).try_cast("timestamp")).cast("date")
    in_week = F.date_add(first, ((week.try_cast("int") - 1) * 7 + grp(5, "1").try_cast("int") - 1).cast("int"))
    in_week = F.when(F.weekofyear(in_week) == week.try_cast("int"), in_week)
    date = F.when(week != "", in_week).otherwise(day).cast("string")
    digits = F.regexp_replace(grp(10, "Z"), ":", "")
    zone = F.when(digits == "Z", F.lit("Z")).otherwise(F.concat(
        F.substring(digits, 1, 3), F.lit(":"), F.rpad(F.substring(digits, 4, 2), 2, "0"),
        F.when(F.length(digits) > 5, F.concat(F.lit(":"), F.substring(digits, 6, 2))).otherwise(F.lit(""))))
    canon = F.concat(date, F.lit("T"), grp(6, "00"), F.lit(":"), grp(7, "00"), F.lit(":"), grp(8, "00"),
                     F.lit("."), F.substring(grp(9, "0"), 1, 6), zone)
    return F.when(text.rlike(ISO_PATTERN), canon.try_cast("timestamp"))


def parse_iso_micros(text: Column) -> Column:
    """Epoch microseconds of ISO text, NULL when empty or unparsable.

    A missing zone means UTC: it is written into the text before the cast, so
    the result never depends on the session time zone.
    """
    zoned = (F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z")))
             .when(text.endswith("Z") | F.substring(text, -6, 1).isin("+", "-"), text)
             .otherwise(F.concat(text, F.lit("Z"))))
    return F.unix_micros(F.when(text.rlike(ISO_PLAIN), zoned.try_cast("timestamp")).otherwise(_parse_any(text)))


def recency_score(last_seen_text: Column, now_micros: int) -> Column:
    """exp(-age_days / 30); 0.3 when the date is unknown, 1.0 for future dates."""
    age_days = ((F.lit(now_micros) - parse_iso_micros(last_seen_text)) / F.lit(1e6)) / F.lit(86400.0)
    # greatest() would skip a NULL age; adding it keeps the NULL for coalesce
    decay = F.exp(-(age_days + F.abs(age_days)) / F.lit(2.0) / F.lit(C.RECENCY_E_FOLD_DAYS))
    return F.coalesce(decay, F.lit(C.UNKNOWN_RECENCY))


def iso_text_ms(ts: Column) -> Column:
    """Timestamp → 'YYYY-MM-DDTHH:MM:SS.mmm' text (no zone), the feeds' own format."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")
