"""Text, JSON, hashing and time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the canonical textual UUID form accepted by the reference.
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank(x) -> Column:
    """Null or empty after trimming."""
    c = _c(x)
    return c.isNull() | (F.length(F.trim(c.cast("string"))) == 0)


def is_uuid(x) -> Column:
    return _c(x).rlike(UUID_PATTERN)


def request_hash(x) -> Column:
    """SHA-256 hex of the request body (the idempotency fingerprint)."""
    return F.sha2(_c(x).cast("string"), 256)


def json_is_object(x) -> Column:
    """True when the text parses as a JSON object; bad JSON or non-objects are False."""
    # What parses and opens with a brace is an object; its schema need not be worked out.
    opens = F.ltrim(_c(x), F.lit(" \t\r\n")).startswith("{")
    return F.coalesce(opens & F.try_parse_json(_c(x)).isNotNull(), F.lit(False))


def ts_literal(text: str) -> Column:
    """A timestamp_ntz literal that does not depend on the session time zone."""
    return F.to_timestamp_ntz(F.lit(text))


def utc_instant(ntz) -> Column:
    """timestamp_ntz → timestamp (instant) reading the wall time as UTC, whatever the session
    time zone (watermarks and event-time windows need ``timestamp``)."""
    c = _c(ntz)
    secs = F.date_format(c, "ss.SSSSSS").cast("decimal(8,6)")
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            secs, F.lit("UTC"))


def utc_wall(instant) -> Column:
    """timestamp (instant) → timestamp_ntz of its UTC wall time, whatever the session zone."""
    micros = F.unix_micros(_c(instant))
    return (F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
            + F.make_dt_interval(secs=(micros / F.lit(1_000_000)).cast("decimal(18,6)")))
