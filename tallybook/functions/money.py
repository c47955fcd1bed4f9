"""Money arithmetic: decimal(20,8) per row, decimal(38,8) for totals, never floats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.schemas import MONEY, TOTAL


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x) -> Column:
    """Cast to decimal(20,8) (half-up at scale 8, like numeric(20,8))."""
    return _c(x).cast(MONEY)


def total(x) -> Column:
    return _c(x).cast(TOTAL)


def zero_money() -> Column:
    return F.lit(0).cast(MONEY)


def signed_amount(side="side", normal_side="ledger_normal_side", amount="amount") -> Column:
    """+amount when the line is on the account's normal side, else -amount."""
    a = _c(amount)
    return F.when(_c(side) == _c(normal_side), a).otherwise(-a)


def parse_money(x) -> Column:
    """Text → decimal(20,8); unparsable or blank text → null (caller routes to rejects)."""
    return F.expr("try_cast(trim({}) AS decimal(20,8))".format(x)) if isinstance(x, str) \
        else F.try_to_number(x, F.lit("9" * 12 + "." + "9" * 8)).cast(MONEY)


def money_text(x) -> Column:
    """Decimal → its text form, null → "0.00" (the reference's formatting of a missing amount)."""
    return F.coalesce(_c(x).cast("string"), F.lit("0.00"))
