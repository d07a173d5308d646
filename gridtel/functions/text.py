"""Text helpers: topics, keys, deterministic site index."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P

TOPIC_PATTERN = rf"^{P.TOPIC_PREFIX}/([^/]+)/{P.TOPIC_SUFFIX}$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def topic_unit(topic) -> Column:
    """Unit id of ``transformers/<id>/telemetry``; NULL for any other shape."""
    return F.nullif(F.regexp_extract(_c(topic), TOPIC_PATTERN, 1), F.lit(""))


def telemetry_topic(unit) -> Column:
    return F.concat(F.lit(P.TOPIC_PREFIX + "/"), _c(unit), F.lit("/" + P.TOPIC_SUFFIX))


def dedup_key(unit, ts_text) -> Column:
    """Natural key ``<unit>@<timestamp text>``."""
    return F.concat_ws("@", _c(unit), _c(ts_text))


def location_index(unit, buckets: int = 10) -> Column:
    """Deterministic bucket of a unit id, portable across engines.

    First 8 hex digits of md5 as an unsigned integer, modulo ``buckets``.
    """
    return (F.conv(F.substring(F.md5(_c(unit)), 1, 8), 16, 10).cast("long") % buckets).cast("int")
