"""Event-envelope attribute helpers (binary mode: attributes in headers)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Binary-mode attribute header names.
BINARY_ATTRIBUTE_HEADERS = ("ce_id", "ce_source", "ce_specversion", "ce_type", "ce_time", "content-type")


def header(headers: Column, name: str) -> Column:
    """Value of one header as STRING (last one wins); NULL when absent."""
    found = F.filter(headers, lambda h: h["key"] == F.lit(name))
    return F.try_element_at(found, F.lit(-1))["value"].cast("string")


def make_headers(pairs: dict[str, Column]) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value")) for k, v in pairs.items()])
