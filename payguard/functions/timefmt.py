"""Event-time text: ``M/d/yy H:mm`` (sample files) -> RFC3339 UTC text.

Two-digit years follow the producer's rule: 69-99 are 19xx, 00-68 are 20xx.
Spark's ``yy`` maps every two-digit year into 2000-2099, so years from 2069
on are moved back one century. The session time zone must be UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Input and output formats.
SAMPLE_TIME_FORMAT = "M/d/yy H:mm"
RFC3339_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_sample_time(c: Column) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) or NULL when the text does not parse."""
    ts = F.try_to_timestamp(F.trim(c), F.lit(SAMPLE_TIME_FORMAT)).cast("timestamp_ntz")
    return F.when(F.year(ts) >= 2069, ts - F.expr("INTERVAL 100 YEARS")).otherwise(ts)


def rfc3339(ts: Column) -> Column:
    return F.date_format(ts, RFC3339_FORMAT)


def sample_time_text(ts: Column) -> Column:
    """Render a timestamp the way sample files carry it."""
    return F.date_format(ts, SAMPLE_TIME_FORMAT)
