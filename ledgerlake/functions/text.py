"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_spaces(col: Column | str) -> Column:
    """Remove leading and trailing space characters only (tabs survive)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(c)


def empty_to_null(col: Column | str) -> Column:
    """An empty element (``<x></x>``) reads as ``""``; a document reader gives NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.nullif(c, F.lit(""))


def xml_escape(col: Column | str) -> Column:
    """Escape text for an XML element body or attribute."""
    c = F.col(col) if isinstance(col, str) else col
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    c = F.replace(c, F.lit(">"), F.lit("&gt;"))
    return F.replace(c, F.lit('"'), F.lit("&quot;"))
