"""Text, date and pattern helpers, all as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space, ASCII and Unicode.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_OTHER_SPACE = WHITE_SPACE.replace(" ", "")
_ZONE = "(?:[zZ]|[+-][0-9]{2}:?[0-9]{2}|[+-][0-9]{2})$"
# The two accepted date formats.
DATE_FORMATS = ("yyyy-M-d", "yyyy-M-d H:m:s")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def normalize_text(text: Column) -> Column:
    """Trimmed, lower case, each run of white space as one space.

    All white space becomes spaces first: a pattern of two or more spaces is several times faster than a class of 29.
    """
    spaced = F.translate(text, _OTHER_SPACE, " " * len(_OTHER_SPACE))
    return F.lower(F.trim(F.regexp_replace(spaced, "  +", " ")))


def normalize_items(items: Column) -> Column:
    """List items are trimmed and lower-cased; inner white space stays."""
    return F.transform(items, lambda item: F.lower(strip(item)))


def parse_date(text: Column) -> Column:
    """First matching format as a timestamp, else null."""
    tries = [F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in DATE_FORMATS]
    return F.coalesce(*tries)


def parse_iso_utc(text: Column) -> Column:
    """ISO text as UTC wall time, null when it cannot be read.

    Text with a zone is shifted to UTC; text without one is taken as UTC. Neither depends on the session zone.
    """
    micros = F.unix_micros(text.try_cast("timestamp"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    zoned = epoch + F.make_dt_interval(secs=micros.cast("decimal(20,0)") / F.lit(1_000_000))
    has_zone = text.rlike("[T ].*" + _ZONE)
    return F.when(has_zone, zoned).otherwise(text.try_cast("timestamp_ntz"))


def duration_ms(text: Column) -> Column:
    """First number in a duration such as `0.123s`, in milliseconds; null when there is none."""
    number = F.nullif(F.regexp_extract(text, "([0-9.]+)", 1), F.lit(""))
    return number.try_cast("double") * 1000


def matches(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(pattern), F.lit(False))
