"""ISO-8601 timestamps in the extended format."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the accepted shape (extended format; a bare date, a partial
# time and an offset are allowed, a basic or week date is not).
ISO_SHAPE = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)


def parse_iso(text: Column) -> Column:
    """Timestamp of an accepted ISO-8601 text, else null."""
    dotted = F.translate(text, ",", ".")
    with_minutes = F.regexp_replace(dotted, r"^(.{10}[T ]\d{2})(Z|[+-].*)?$", "$1:00:00$2")
    with_seconds = F.regexp_replace(with_minutes, r"^(.{10}[T ]\d{2}:\d{2})(Z|[+-].*)?$", "$1:00$2")
    return F.when(text.rlike(ISO_SHAPE), F.try_to_timestamp(with_seconds))


def is_iso(text: Column) -> Column:
    return parse_iso(text).isNotNull()


def utc_text(ts: Column) -> Column:
    """ISO-8601 text ending in Z, microseconds kept."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
