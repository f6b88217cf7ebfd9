"""JSON message bodies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def record_json(*cols: Column | str) -> Column:
    """Serialise columns as one JSON object; NULL values are written as ``null``
    (Spark omits them by default) and non-ASCII text is kept as is."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def text_fields_schema(fields: list[str]) -> StructType:
    return StructType([StructField(f, StringType(), True) for f in fields])


def extract_text_fields(payload: Column | str, fields: list[str]) -> Column:
    """Parse a JSON object once and return the named top-level keys as text.

    Equivalent to ``get_json_object(payload, '$.<key>')`` per key: a number
    or nested value comes back as its JSON text, and an absent key, a JSON
    ``null`` or a payload that is not a JSON object gives NULL -- never an
    exception.
    """
    p = F.col(payload) if isinstance(payload, str) else payload
    return F.from_json(p, text_fields_schema(fields), {"mode": "PERMISSIVE"})
