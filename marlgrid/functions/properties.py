"""Typed access to the JSON in ``events.props``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_field(col: Column, name: str, dtype: str) -> Column:
    """One top-level field of a JSON object; null where it is missing or malformed."""
    return F.from_json(col, f"`{name}` {dtype}").getField(name)
