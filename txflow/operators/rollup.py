"""Daily totals per customer, ordered reads and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txflow.functions import columns as fx
from txflow.schemas import MONEY

TOTAL_KEYS = ["customer_id", "transaction_date"]


def daily_totals(df: DataFrame) -> DataFrame:
    """Exact total and number of transactions per customer and day.

    Partial sums run before the shuffle, so a customer with a third of all rows reaches
    the final aggregate as one row per map task and day.
    """
    return df.groupBy(*TOTAL_KEYS).agg(
        F.sum("amount").cast(MONEY).alias("daily_total"),
        F.count(F.lit(1)).alias("transaction_count"),
    )


# Powers of two at which a 32-bit float is cut into whole numbers, each below 2^54 or, the first, below 2^61.
CUTS = (67, 13, -41, -95, -149)


def exact_float_sum(amount: Column) -> Column:
    """The sum of 32-bit floats, rounded half up to two decimals once, as a double: the same bits in any order.

    Every float is cut into whole multiples of powers of two, and each kind is summed as an integer; only the whole sum
    is rounded. NULLs are left out; NaN and infinities give what a plain sum gives. Sums up to 10^20 fit.
    """
    x = fx.money_float(amount).cast("double")
    finite = ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    rest, sums = F.abs(x), []
    for power in CUTS:
        unit = F.lit(2.0**power)
        whole = F.floor(rest / unit)
        part = F.when(x < 0, -whole).otherwise(whole).cast("decimal(20,0)")
        sums.append(F.coalesce(F.sum(F.when(finite, part)), F.lit(0)).cast("decimal(38,0)"))
        rest = rest - whole.cast("double") * unit
    step = F.lit(str(1 << 54)).cast("decimal(38,0)")
    # In units of 2^-41; what is below them matters only by its sign, for a sum that lies on a half.
    units = _whole(_whole(_whole(sums[0] * step) * step) + _whole(sums[1] * step) + sums[2])
    lower = _whole(_whole(sums[3] * step) + sums[4])
    return F.when(F.count_if(~finite) > 0, F.sum(x)).when(F.count(x) > 0, _cents(units, lower) / F.lit(100.0))


def _whole(number: Column) -> Column:
    return number.cast("decimal(38,0)")


def _floored(number: Column, unit: int) -> Column:
    """The whole part of a quotient of integers, rounded down; what is divided is a multiple, so nothing is rounded."""
    by = _whole(F.lit(str(unit)))
    return _whole(F.round(_whole(number - F.pmod(number, by)) / by, 0))


def _cents(units: Column, lower: Column) -> Column:
    """Whole cents, rounded half away from zero, of units of 2^-41 and a rest (in units of 2^-149) of either sign."""
    negative = (units < 0) | ((units == 0) & (lower < 0))
    hundred = F.lit(100).cast("decimal(3,0)")
    size, rest = (_whole(F.when(negative, -x).otherwise(x) * hundred) for x in (units, lower))
    near = _whole(size + _floored(rest, 1 << 108))
    cents = _floored(_whole(near + F.lit(str(1 << 40)).cast("decimal(38,0)")), 1 << 41).cast("double")
    return F.when(negative, -cents).otherwise(cents)


def daily_totals_float(df: DataFrame) -> DataFrame:
    """The 32-bit variant: amounts cast to float, summed exactly, rounded to cents."""
    return df.groupBy(*TOTAL_KEYS).agg(exact_float_sum(F.col("amount")).alias("daily_total"))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def first_rows(df: DataFrame, n: int, order_by: Sequence[Column | str]) -> DataFrame:
    """The first ``n`` rows of a stated order; runs as a distributed top-k."""
    return df.orderBy(*order_by).limit(n)


def numbered(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], name: str) -> DataFrame:
    """Position of each row inside its group; a customer's group is bounded by the calendar."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order_by)))


def latest_per_customer(totals: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` days of every customer; each map task passes on ``n`` rows per customer at most."""
    ranked = numbered(totals, ["customer_id"], [F.col("transaction_date").desc()], "recency")
    return ranked.filter(F.col("recency") <= n)
