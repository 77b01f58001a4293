"""Names, addresses and ZIP codes in one canonical form, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Long forms and the short forms they become.
NAME_FORMS = {
    "INCORPORATED": "INC", "CORPORATION": "CORP", "COMPANY": "CO", "LIMITED": "LTD", "L L C": "LLC", "L L P": "LLP", "AND": "&",
}
ADDRESS_FORMS = {
    "STREET": "ST", "AVENUE": "AVE", "ROAD": "RD", "DRIVE": "DR", "BOULEVARD": "BLVD", "LANE": "LN", "COURT": "CT", "PLACE": "PL",
    "PARKWAY": "PKWY", "HIGHWAY": "HWY", "SUITE": "STE", "BUILDING": "BLDG", "FLOOR": "FL", "ROOM": "RM", "APARTMENT": "APT",
    "NORTH": "N", "SOUTH": "S", "EAST": "E", "WEST": "W", "NORTHEAST": "NE", "NORTHWEST": "NW", "SOUTHEAST": "SE", "SOUTHWEST": "SW",
    "POST OFFICE BOX": "PO BOX", "P O BOX": "PO BOX",
}


#: Fixed value: the article, at the beginning or the end.
ARTICLE = "^THE |(?<= )THE$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def cleaned(c: str | Column) -> Column:
    """Upper case, dots dropped, ampersands apart, everything else but letters and digits a space."""
    c = F.replace(F.upper(F.coalesce(_col(c), F.lit(""))), F.lit("."), F.lit(""))
    return _squeezed(F.regexp_replace(F.replace(c, F.lit("&"), F.lit(" & ")), r"[^A-Z0-9& ]+", " "))


def _shortened(c: Column, forms: dict[str, str]) -> Column:
    for form in sorted(forms, key=len, reverse=True):  # longest first, so that phrases win over their words
        c = F.regexp_replace(c, rf"\b{form}\b", forms[form])
    return _squeezed(c)


def normalize_name(c: str | Column) -> Column:
    spaced = _squeezed(F.replace(_shortened(cleaned(c), NAME_FORMS), F.lit("&"), F.lit(" & ")))
    # Both ends lose the article, also where they share a space.
    return F.trim(F.regexp_replace(spaced, ARTICLE, ""))


def normalize_address(c: str | Column) -> Column:
    return _shortened(F.replace(cleaned(c), F.lit("&"), F.lit(" AND ")), ADDRESS_FORMS)


def zip5(c: str | Column) -> Column:
    digits = F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"\D", "")
    return F.when(F.length(digits) >= 5, F.substring(digits, 1, 5)).otherwise(F.lit(""))
