"""Formatting expressions used by progress lines and size reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: size units and their byte thresholds (binary multiples)
KB = 1024
MB = 1024 * 1024
GB = 1024 * 1024 * 1024

# fixed value: release-notes metadata comment (first match, spans lines)
METADATA_PATTERN = r"(?s)<!-- METADATA:\s*(\{.*?\})\s*-->"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def format_duration(x: Column | str) -> Column:
    """Seconds -> ``1h 01m 05s`` | ``1m 05s`` | ``5s``; negatives -> ``0s``;
    fractions are truncated."""
    s = F.greatest(F.floor(_c(x).cast("double")).cast("bigint"), F.lit(0).cast("bigint"))
    h = F.floor(s / 3600).cast("bigint")
    m = F.floor((s % 3600) / 60).cast("bigint")
    sec = (s % 60).cast("bigint")
    return (F.when(h > 0, F.format_string("%dh %02dm %02ds", h, m, sec))
             .when(m > 0, F.format_string("%dm %02ds", m, sec))
             .otherwise(F.format_string("%ds", sec)))


def embedded_json(x: Column | str) -> Column:
    """The JSON object inside the first ``<!-- METADATA: {...} -->`` comment as a
    VARIANT; NULL when there is no comment or the JSON does not parse."""
    body = F.regexp_extract(_c(x), METADATA_PATTERN, 1)
    return F.when(body != "", F.try_parse_json(body))


def pct_change(value: Column | str, base: Column | str) -> Column:
    """Percent difference against a baseline, 0 when the baseline is 0/NULL."""
    v, b = _c(value).cast("double"), _c(base).cast("double")
    return F.when(b > 0, (v - b) / b * 100.0).otherwise(F.lit(0.0))


def signed_pct(x: Column | str) -> Column:
    """``+12.5%`` / ``-3.0%`` text for a percentage."""
    return F.format_string("%+.1f%%", _c(x).cast("double"))
