"""Columns for the formats that extracts are delivered in."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def dats(c: str) -> Column:
    """YYYYMMDD as a date; blank and 00000000 are the initial value, null."""
    return F.to_date(F.nullif(F.nullif(F.col(c), F.lit("")), F.lit("00000000")), "yyyyMMdd")


def stamp(c: str | Column) -> Column:
    """yyyyMMddHHmmss as a timestamp."""
    return F.to_timestamp(c, "yyyyMMddHHmmss")


def amount(c: str) -> Column:
    """Text as an amount; what is no number is null, so that an expectation can drop it."""
    return F.col(c).try_cast("decimal(23,2)")


def lookup(table: Mapping, c: str | Column) -> Column:
    """The entry of a small literal table, null where there is none."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), F.col(c) if isinstance(c, str) else c)


def key_part(c: str, start: int, size: int) -> Column:
    """A field of a fixed-width key."""
    return F.trim(F.substring(c, start, size))


#: Where the fields of a change item's table key begin, and their widths.
KEY_FIELDS = {"LIFNR": (4, 10), "BUKRS": (14, 4), "BANKS": (14, 3), "BANKL": (17, 15), "BANKN": (32, 18)}


def encode_key(*parts: tuple[Column, int], client: str = "100") -> Column:
    """The inverse: client, then each part padded to its width."""
    return F.concat(F.lit(client), *[F.rpad(c, n, " ") for c, n in parts])
