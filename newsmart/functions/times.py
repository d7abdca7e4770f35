"""Timestamps as the feeds write them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_COMPACT = "yyyyMMdd'T'HHmmss"
# Always six fractional digits, so a round trip keeps microseconds.
WIRE_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def compact_timestamp(text: Column) -> Column:
    """``20231215T143000`` as UTC; null where it does not read as one."""
    return F.try_to_timestamp(text, F.lit(_COMPACT))


def feed_timestamp(text: Column) -> Column:
    """ISO 8601 or RFC 822 text as an instant; null where it reads as neither."""
    rfc822 = F.regexp_replace(text, r"^\s*[A-Za-z]{3},\s*", "")
    return F.coalesce(
        F.try_to_timestamp(text),
        F.try_to_timestamp(rfc822, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(rfc822, F.lit("d MMM yyyy HH:mm:ss xx")),
    )


def entry_timestamp(updated: Column, published: Column) -> Column:
    """When a filing entry was updated, else published; null if neither reads."""
    return F.coalesce(feed_timestamp(updated), feed_timestamp(published))
