"""Fields of payloads whose shape changes from row to row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(payload) -> Column:
    """A JSON text as a variant, read once however many fields are taken; null where it is no JSON."""
    return F.try_parse_json(F.col(payload) if isinstance(payload, str) else payload)


def field(variant, path: str, kind: str = "string") -> Column:
    """The value at a path, null where the path is missing or the value is not of that kind."""
    return F.try_variant_get(F.col(variant) if isinstance(variant, str) else variant, path, kind)


def shape(variant) -> Column:
    """Type of the payload as a whole, such as OBJECT<k: BIGINT>."""
    return F.schema_of_variant(F.col(variant) if isinstance(variant, str) else variant)
