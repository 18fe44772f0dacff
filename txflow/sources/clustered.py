"""A serving copy of daily totals, laid out for reads by customer and by date alike.

Rows are put in the order of interleaved bits of the customer's and the date's place among all customers and dates, and
cut into files by ranges of that order, so each file covers a small rectangle of customers and dates. The least and
greatest values of every file are stored beside the files; a lookup opens those files alone that can hold its rows.

Layout below the root::

    data/month=<yyyy-mm>/gen=<id>/*.parquet    totals; a refresh adds a generation
    files/month=<yyyy-mm>/*.parquet            the files that count, with their bounds; replaced as a whole
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.schemas import DAILY_TOTALS
from txflow.sources import storage
from txflow.sources.keyed import KeyedTable

# Bits of each column's place. Every lookup names a customer and few name a short range, so customers get more.
BITS = {"customer_id": 7, "transaction_date": 4}
ROWS_PER_FILE = 2_000_000
BOUNDS = (
    "month string, name string, rows bigint, least_customer_id string, most_customer_id string, "
    "least_transaction_date date, most_transaction_date date"
)


def cuts(df: DataFrame, column: str, pieces: int) -> list:
    """Values that cut the distinct values of a column into about equal ranges: ``pieces - 1`` of them at most."""
    dealt = df.select(column).filter(F.col(column).isNotNull()).distinct().repartitionByRange(pieces, column)
    ends = dealt.groupBy(F.spark_partition_id()).agg(F.max(column).alias("last"))
    return sorted(r["last"] for r in ends.collect())[:-1]


def place(value: Column, ends: list) -> Column:
    """How many cuts lie before a value; found by halving, so it takes a few comparisons."""
    if not ends:
        return F.lit(0)
    middle = len(ends) // 2
    below, above = place(value, ends[:middle]), place(value, ends[middle + 1 :])
    return F.when(value <= F.lit(ends[middle]), below).otherwise(above + middle + 1)


def interleaved(places: Mapping[str, tuple[Column, int]]) -> Column:
    """One number from several, each of so many bits: the highest bit of each in turn, until all are used up."""
    numbers = [(number.cast("long"), bits) for number, bits in places.values()]
    order = sorted((-bit, k) for k, (_, bits) in enumerate(numbers) for bit in range(bits))
    out = F.lit(0).cast("long")
    for bit, k in order:
        out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(numbers[k][0], -bit).bitwiseAND(F.lit(1).cast("long")))
    return out


class ClusteredTotals:
    """The copy at ``root``; ``files`` is how many files a month gets, by default one for ``ROWS_PER_FILE`` rows."""

    def __init__(self, spark: SparkSession, root: str, files: int | None = None):
        self.spark, self.root, self.files = spark, root.rstrip("/"), files

    def refresh(self, table: KeyedTable, months: list[str] | None = None) -> None:
        """Bring some months (``yyyy-mm``), or all, up to date with a table.

        New files are written first, then the list of files that count is replaced, then old files go: a reader meets
        either all old rows of a month or all new ones.
        """
        rows = table.read().withColumn("month", F.date_format("transaction_date", "yyyy-MM"))
        if months is not None:
            rows = rows.filter(F.col("month").isin(months))
        counts = {r["month"]: r["count"] for r in rows.groupBy("month").count().collect()}
        gone = [m for m in (months if months is not None else self._months()) if m not in counts]
        if counts:
            self._write(rows, counts)
        for month in gone:
            storage.delete(self.spark, f"{self.root}/files/month={month}")
            storage.delete(self.spark, f"{self.root}/data/month={month}")

    def _months(self) -> list[str]:
        return [n.split("=")[1] for n, _, _ in storage.children(self.spark, f"{self.root}/files") if "=" in n]

    def _write(self, rows: DataFrame, counts: dict[str, int]) -> None:
        generation = uuid.uuid4().hex[:12]
        pieces = sum(self.files or -(-n // ROWS_PER_FILE) for n in counts.values())
        places = {c: (place(F.col(c), cuts(rows, c, 1 << bits)), bits) for c, bits in BITS.items()}
        keyed = rows.withColumns({"gen": F.lit(generation), "_z": interleaved(places)})
        order = ["month", "_z", *BITS]
        dealt = keyed.repartitionByRange(pieces, *order).sortWithinPartitions("month", *BITS).drop("_z")
        dealt.write.mode("append").partitionBy("month", "gen").parquet(f"{self.root}/data")
        fresh = [f"{self.root}/data/month={m}/gen={generation}" for m in counts]
        written = self.spark.read.schema(DAILY_TOTALS).parquet(*fresh)
        path = F.col("_metadata.file_path")
        bounds = [f(c).alias(f"{n}_{c}") for c in BITS for n, f in (("least", F.min), ("most", F.max))]
        listed = written.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("rows"), *bounds)
        named = listed.select(
            F.regexp_extract("path", "/month=([^/]+)/", 1).alias("month"),
            F.regexp_extract("path", "/data/(month=[^/]+/gen=[^/]+/[^/]+)$", 1).alias("name"),
            *[c for c in listed.columns if c != "path"],
        )
        writer = named.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("month").parquet(f"{self.root}/files")
        for month in counts:
            for name, _, _ in storage.children(self.spark, f"{self.root}/data/month={month}"):
                if name != f"gen={generation}":
                    storage.delete(self.spark, f"{self.root}/data/month={month}/{name}")

    def bounds(self) -> DataFrame:
        """A row for each file that counts."""
        if not storage.exists(self.spark, f"{self.root}/files"):
            return self.spark.createDataFrame([], BOUNDS)
        return self.spark.read.schema(BOUNDS).parquet(f"{self.root}/files")

    def files_for(self, customer_id: str, since: date | None = None, until: date | None = None) -> list[str]:
        """The files that can hold rows of a customer within a range of dates."""
        held = self.bounds().filter(F.lit(customer_id).between(F.col("least_customer_id"), F.col("most_customer_id")))
        if since is not None:
            held = held.filter((F.col("most_transaction_date") >= F.lit(since)) & (F.col("month") >= f"{since:%Y-%m}"))
        if until is not None:
            held = held.filter((F.col("least_transaction_date") <= F.lit(until)) & (F.col("month") <= f"{until:%Y-%m}"))
        return sorted(r.name for r in held.select("name").collect())

    def lookup(
        self, customer_id: str, since: date | None = None, until: date | None = None, newest_first: bool = False
    ) -> DataFrame:
        """One customer's days, optionally within a range of dates (both ends included)."""
        names = self.files_for(customer_id, since, until)
        if names:
            df = self.spark.read.schema(DAILY_TOTALS).parquet(*[f"{self.root}/data/{n}" for n in names])
        else:
            df = self.spark.createDataFrame([], DAILY_TOTALS)
        df = df.filter(F.col("customer_id") == customer_id)
        if since is not None:
            df = df.filter(F.col("transaction_date") >= F.lit(since))
        if until is not None:
            df = df.filter(F.col("transaction_date") <= F.lit(until))
        return df.orderBy(F.col("transaction_date").desc()) if newest_first else df
