"""Event identifiers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Keeps ("ab", "c") and ("a", "bc") apart.
_SEPARATOR = "\x1f"


def derived_event_id(*parts: Column) -> Column:
    """A UUID-shaped id that depends only on the given parts.

    Random ids would change when a lost task is run again; these do not, so a
    replayed record keeps its identity.
    """
    digest = F.sha2(F.concat_ws(_SEPARATOR, *parts), 256)
    return F.regexp_replace(
        digest, r"^(.{8})(.{4}).(.{3}).(.{3})(.{12}).*$", "$1-$2-8$3-8$4-$5"
    )


def canonical_uuid(text: Column) -> Column:
    """Lower-case hyphenated form, or null where ``text`` is not a UUID."""
    hexa = F.regexp_replace(F.lower(text), r"^urn:uuid:|[{}-]", "")
    spelled = F.regexp_replace(
        hexa, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"
    )
    return F.when(hexa.rlike("^[0-9a-f]{32}$"), spelled)
