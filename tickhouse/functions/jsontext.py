"""JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode(col: Column, schema: str) -> Column:
    """JSON text to a struct of the declared schema; malformed text gives null fields."""
    return F.from_json(col, schema, {"mode": "PERMISSIVE"})


def encode(*cols: Column | str) -> Column:
    """Columns to one JSON object; null fields are written, not left out."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
