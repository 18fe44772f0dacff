"""The surviving copy of every transaction, in append-only files, and what each batch did to the daily totals.

Layout below the root::

    winners/bucket=<hash of the id>/batch=<id>/*.parquet   copies that became survivors in a batch
    deltas/day=<date>/batch=<id>/*.parquet                 what a batch added to and took from each customer's day
    done/<batch id>                                        the batch has been applied

Nothing is rewritten. The survivor of a transaction is the least of its stored copies, and the total of a customer's day
is the sum of its deltas; so a batch that is written twice changes nothing, and a copy that gives way may stay. Files
are sorted by id and carry Bloom filters, so a batch opens the buckets of its ids alone, and a few ids only some pages of
these.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.schemas import MONEY, RAW_TRANSACTIONS, conform
from txflow.sources import storage

ROW_ORDER = ["timestamp", "customer_id", "amount", "merchant"]
BUCKETS = 32
DELTAS = "customer_id string, delta_total decimal(18,2), delta_count bigint"
BLOOM = {
    "parquet.bloom.filter.enabled#transaction_id": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.max.bytes": str(1 << 20),
}


class SurvivorStore:
    """Survivors by hash bucket of the id; the number of buckets is fixed when the store is made."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root = spark, root.rstrip("/")
        layout = f"{self.root}/_layout.json"
        if storage.exists(spark, layout) or not storage.create_text(spark, layout, json.dumps({"buckets": buckets})):
            buckets = json.loads(storage.read_text(spark, layout))["buckets"]
        self.buckets = buckets

    # -- layout ----------------------------------------------------------------

    def _bucket(self):
        return F.pmod(F.xxhash64("transaction_id"), F.lit(self.buckets).cast("bigint")).cast("int")

    def _folders(self, kind: str, values: Collection | None = None) -> list[str]:
        """Folders of some buckets or days, or of all, as far as they exist."""
        names = [n for n, is_dir, _ in storage.children(self.spark, f"{self.root}/{kind}") if is_dir and "=" in n]
        wanted = None if values is None else {str(v) for v in values}
        return [f"{self.root}/{kind}/{n}" for n in sorted(names) if wanted is None or n.split("=")[1] in wanted]

    def _scan(self, kind: str, folders: Sequence[str], schema) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}").parquet(*folders)

    def _write(self, rows: DataFrame, kind: str, place: str, sort: str, options: dict[str, str]) -> None:
        """Write a batch's rows; folders it wrote before are replaced, all others are left alone."""
        dealt = rows.hint("rebalance", F.col(place)).sortWithinPartitions(place, sort)
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options)
        writer.partitionBy(place, "batch").parquet(f"{self.root}/{kind}")

    # -- survivors -------------------------------------------------------------

    def _copies(self, buckets: Collection[int] | None = None) -> DataFrame:
        schema = RAW_TRANSACTIONS.simpleString()[7:-1].replace(":", " ") + ", bucket int, batch string"
        return self._scan("winners", self._folders("winners", buckets), schema)

    def read(self) -> DataFrame:
        """All survivors, in the schema of raw transactions."""
        return conform(self._least(self._copies()), RAW_TRANSACTIONS)

    @staticmethod
    def _least(copies: DataFrame) -> DataFrame:
        least = copies.groupBy("transaction_id").agg(F.min(F.struct(*ROW_ORDER)).alias("_row"))
        return least.select("transaction_id", *[F.col(f"_row.{c}").alias(c) for c in ROW_ORDER])

    def known(self, ids: DataFrame, batch: str) -> DataFrame:
        """Survivors of some transactions (rows of unique ids) as they were before a batch.

        Only the buckets of these ids are listed and read. If the ids are so few that Parquet can look each of them up,
        they are handed to the scan as well, where statistics and Bloom filters skip what cannot hold them.
        """
        few = int(self.spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold"))
        located = ids.select("transaction_id", self._bucket().alias("bucket"))
        first = located.limit(few + 1).collect()
        if len(first) <= few:
            copies = self._copies({r.bucket for r in first}).filter(F.col("transaction_id").isin([r[0] for r in first]))
        else:
            copies = self._copies([r.bucket for r in located.select("bucket").distinct().collect()])
            copies = copies.join(ids.select("transaction_id"), ["transaction_id"], "left_semi")
        return self._least(copies.filter(F.col("batch") != batch))

    def append(self, rows: DataFrame, batch: str) -> None:
        """Store copies that became survivors in a batch."""
        placed = rows.select(*RAW_TRANSACTIONS.names, self._bucket().alias("bucket"), F.lit(batch).alias("batch"))
        self._write(placed, "winners", "bucket", "transaction_id", BLOOM)

    # -- daily totals ----------------------------------------------------------

    def append_deltas(self, deltas: DataFrame, batch: str) -> None:
        """Store what a batch changes: ``customer_id``, ``transaction_date``, ``delta_total`` and ``delta_count``."""
        named = deltas.withColumnRenamed("transaction_date", "day").withColumn("batch", F.lit(batch))
        self._write(named, "deltas", "day", "customer_id", {})

    def changed_days(self, batch: str) -> list[str]:
        """The days for which a batch has stored deltas."""
        found = storage.matching(self.spark, f"{self.root}/deltas/day=*/batch={batch}")
        return sorted(f.split("/day=")[1].split("/")[0] for f in found)

    def totals_after(self, batch: str) -> DataFrame:
        """The totals of all keys that a batch changed, from the deltas of their days; a count of 0 is a key that is gone.

        They are sums over all batches, not differences to a stored total, so working them out again is harmless.
        """
        days = self._folders("deltas", self.changed_days(batch))
        held = self._scan("deltas", days, f"{DELTAS}, day date, batch string")
        summed = held.groupBy("customer_id", F.col("day").alias("transaction_date")).agg(
            F.sum("delta_total").cast(MONEY).alias("daily_total"),
            F.sum("delta_count").alias("transaction_count"),
            F.bool_or(F.col("batch") == batch).alias("_changed"),
        )
        return summed.filter("_changed").drop("_changed")

    # -- batches ---------------------------------------------------------------

    def is_done(self, batch: str) -> bool:
        return storage.exists(self.spark, f"{self.root}/done/{batch}")

    def finish(self, batch: str) -> None:
        storage.create_text(self.spark, f"{self.root}/done/{batch}", "")

    def compact(self) -> int:
        """Put the survivors of each bucket into one folder; returns how many folders went.

        The joined rows are written before the old folders go, and rows in both count once. Not while a batch is staged.
        """
        name, gone = f"joined-{uuid.uuid4().hex[:12]}", []
        for folder in self._folders("winners"):
            held = [f"{folder}/{n}" for n, is_dir, _ in storage.children(self.spark, folder) if is_dir]
            gone += held if len(held) > 1 else []
        if gone:
            buckets = sorted({int(g.split("/bucket=")[1].split("/")[0]) for g in gone})
            self.append(self._least(self._copies(buckets)), name)
        for folder in gone:
            storage.delete(self.spark, folder)
        return len(gone)
