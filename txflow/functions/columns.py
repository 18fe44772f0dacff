"""Column expressions; every one is a built-in Catalyst expression."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.schemas import MONEY

# The named merchants that follow the numbered stores.
NAMED_MERCHANTS = ["ONLINE_SHOP", "GAS_STATION", "SUPERMARKET", "PHARMACY", "RESTAURANT"]
# What no name may hold: markup brackets and control characters other than tabs and line breaks, signs of a damaged file.
DAMAGED_TEXT = r"[<>\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"


def customer_code(number: Column, width: int = 5) -> Column:
    """``7`` -> ``C00007``; longer numbers keep all their digits, where a bare ``lpad`` cuts them."""
    digits = number.cast("string")
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.concat(F.lit("C"), padded)


def merchant_name(index: Column, stores: int = 25) -> Column:
    """``STORE_1`` .. ``STORE_n`` for 0 .. n-1, then the named merchants."""
    named = F.element_at(F.array(*[F.lit(m) for m in NAMED_MERCHANTS]), (index - stores + 1).cast("int"))
    return F.when(index < stores, F.concat(F.lit("STORE_"), (index + 1).cast("string"))).otherwise(named)


def transaction_date(ts: Column) -> Column:
    """Calendar day in the session time zone, which is pinned to UTC."""
    return F.to_date(ts)


def parse_ts(text: Column) -> Column:
    """Timestamp with an optional offset; text that is no timestamp gives NULL."""
    return F.try_to_timestamp(text)


def parse_money(text: Column) -> Column:
    """Exact decimal from text; text that is no number gives NULL."""
    return text.try_cast(MONEY)


def money_float(amount: Column) -> Column:
    """The 32-bit form of an amount."""
    return amount.cast(T.FloatType())


def scaled(amount: Column, factor: str = "1.01") -> Column:
    """``round(amount * factor, 2)`` with an exact decimal factor."""
    return F.round(amount * F.lit(factor).cast("decimal(9,4)"), 2)


def instant(moment: datetime) -> Column:
    """A timestamp literal; without an offset it is read in the session time zone, not the machine's."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def days_before(day: Column, n: Column | int) -> Column:
    return F.date_sub(day, n)


def time_before(ts: Column, days: Column, hours: Column, minutes: Column, seconds: Column) -> Column:
    return ts - F.make_dt_interval(days, hours, minutes, seconds)


def digest(*parts: Column | int | str) -> Column:
    """MD5 of the parts joined by colons, as hex text: 128 bits that depend on the parts alone, and that SQL can repeat."""
    return F.md5(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(p) for p in parts]).cast("binary"))


def digest_draw(bound: int, digest: Column, number: int = 0) -> Column:
    """Integer in ``[0, bound)`` from the first (0) to the fourth (3) quarter of a digest."""
    return F.conv(F.substring(digest, 8 * number + 1, 8), 16, 10).cast("bigint") % F.lit(bound).cast("bigint")
