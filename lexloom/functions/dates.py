"""Dates of documents, from their XML and from print."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Years that a document's date may lie from the document's own year.
YEARS = 2
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
#: Characters of a print in which its date is looked for; None looks everywhere.
PREAMBLE = 6000
#: Fixed value: "Made", whose M a scan may lack, then dots, dashes or spaces up to a day.
MADE = rf"(?U)\b[Mm]?ade\b[\s.\u2013\u2014\-]{{0,30}}(\d{{1,2}})(?:st|nd|rd|th)?\s+({'|'.join(MONTHS)}),?\s+(\d{{4}})"


def plausible(date: Column, year: Column) -> Column:
    """Whether ``date`` is near the document's ``year``; a document without a year takes any date."""
    return year.isNull() | (F.abs(F.year(date) - year) <= YEARS)


def legal_date(xml: Column, year: Column) -> Column:
    """struct(date, kind) of a document's XML: its first making or enactment date, null if it is not plausible."""
    pattern = r'<(?:\w+:)?(Made|EnactmentDate)\b[^>]*\bDate="(\d{4}-\d{2}-\d{2})"'
    date = F.try_to_date(F.nullif(F.regexp_extract(xml, pattern, 2), F.lit("")))
    good = plausible(date, year) & date.isNotNull()
    kind = F.when(F.regexp_extract(xml, pattern, 1) == "Made", "made").otherwise("enacted")
    return F.struct(F.when(good, date).alias("date"), F.when(good, kind).alias("kind"))


def printed_date(text: Column, year: Column | None = None, within: int | None = PREAMBLE) -> Column:
    """The first date behind "Made" in a print; null where there is no such day, or none plausible for ``year``."""
    head = text if within is None else F.substring(text, 1, within)
    date = F.try_to_date(F.concat_ws(" ", *[F.regexp_extract(head, MADE, k) for k in (1, 2, 3)]), "d MMMM yyyy")
    return date if year is None else F.when(plausible(date, year), date)
