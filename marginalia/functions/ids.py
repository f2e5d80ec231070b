"""Record ids: one letter and a number, bare or as an address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An id as delivered: blanks, an optional address, a letter in either case, a number, an optional final slash.
RECORD_ID = r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*://[^/\s]+/(?:[^/\s]+/)*)?([A-Za-z])0*([0-9]+)/*\s*$"


def canonical_id(c: Column) -> Column:
    """The bare id, letter in upper case, no leading zeros.

    Null, empty and blank ids give null. Text that is no record id is kept, trimmed, so that it still compares
    with itself.
    """
    bare = F.regexp_replace(c, RECORD_ID, "$1$2")
    other = F.nullif(F.regexp_replace(c, r"^\s+|\s+$", ""), F.lit(""))
    # the two usual forms are told by one cheap expression each
    return F.when(c.rlike("^[A-Z][1-9][0-9]*$"), c).when(c.rlike(r"^https?://[^/\s]+/[A-Z][1-9][0-9]*$"), F.substring_index(c, "/", -1)).when(bare.rlike("^[A-Za-z][0-9]+$"), F.upper(bare)).otherwise(other)


def id_space(canonical: Column) -> Column:
    """The integer space of a canonical id: its letter; the whole text where it is no record id of 64 bits."""
    return F.when(id_number(canonical).isNotNull(), F.substring(canonical, 1, 1)).otherwise(canonical)


def id_number(canonical: Column) -> Column:
    """The number of a canonical id, null where it is no record id or exceeds 64 bits."""
    return F.when(canonical.rlike("^[A-Z][0-9]+$"), F.substring(canonical, 2, 40).try_cast("long"))
