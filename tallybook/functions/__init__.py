"""Column-level helpers (all JVM-side built-ins, no Python UDFs)."""

from tallybook.functions.money import (  # noqa: F401
    money, total, signed_amount, money_text, parse_money, zero_money,
)
from tallybook.functions.text import (  # noqa: F401
    blank, is_uuid, request_hash, json_is_object, ts_literal,
)
