"""Keyed tables: insert or replace by key, and the reads that serve from them."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.operators import rollup, upsert
from txflow.operators.quality import QualityGateError
from txflow.operators.dml import keys_present
from txflow.schemas import AUDIT_TRANSACTIONS, DAILY_TOTALS, conform
from txflow.sources import storage
from txflow.sources.versioned import VersionedTable


class KeyedTable:
    """A table with a unique, non-NULL key, stored in partitions that depend on the key alone.

    An upsert rewrites only the partitions its batch falls into and becomes visible at once,
    as a new version. Files are sorted by key, so lookups skip row groups.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: Sequence[str],
        partition_by: Mapping[str, str] | None = None,
    ):
        self.schema = schema
        self.keys = list(keys)
        self.table = VersionedTable(spark, root, partition_by, sort_by=keys)
        self.table.create(schema)

    @classmethod
    def daily_totals(cls, spark: SparkSession, root: str, schema: T.StructType = DAILY_TOTALS) -> KeyedTable:
        """Result table: one folder per day, sorted by customer.

        With ``DAILY_TOTALS_FLOAT`` exact totals are rounded to 32 bits as they are loaded.
        """
        keys = ["customer_id", "transaction_date"]
        return cls(spark, root, schema, keys, {"transaction_date": "transaction_date"})

    @classmethod
    def audit(cls, spark: SparkSession, root: str, schema: T.StructType = AUDIT_TRANSACTIONS, buckets: int = 64):
        """Raw transactions by id, spread evenly over hash buckets of the id."""
        bucket = f"cast(pmod(xxhash64(transaction_id), {int(buckets)}) as int)"
        return cls(spark, root, schema, ["transaction_id"], {"id_bucket": bucket})

    # -- writes ----------------------------------------------------------------

    def upsert(
        self,
        batch: DataFrame,
        *,
        sequence: Sequence[str] | None = None,
        deletes: DataFrame | None = None,
        stored_at: str | None = None,
        tag: str | None = None,
        unique: bool = False,
        within: Sequence[str] | None = None,
    ) -> int:
        """Insert or replace by key; with ``deletes``, also drop the keys listed there.

        A batch that repeats a key needs ``sequence``, the columns that say which row is last; one that was just
        grouped by the key is ``unique`` and not checked again. A caller that knows the partitions of all keys names them
        in ``within`` (``column=value``).
        The batch is staged first, unless it is a plain read of files at ``stored_at``.
        A batch already committed under ``tag`` is skipped.
        """
        if tag is not None and self.table.has_tag(tag):
            return self.table.version()
        if sequence is not None:
            batch, stored_at = upsert.collapse_batch(batch, self.keys, sequence), None
        with storage.staged(conform(batch, self.schema), "upsert-batch", stored_at) as stage:
            rows = stage.rows
            if not unique:
                self._check_keys(rows)
            base = self.table._commit_at()
            if within is None:
                touched = rows.select(*self.keys)
                if deletes is not None:
                    touched = touched.unionByName(deletes.select(*self.keys))
                dropped = self._folders_for(base, touched)
            else:
                dropped = self._folders_named(base, within)
            kept = self.table._scan(base, dropped)
            result = upsert.apply_upsert(kept, rows, self.keys, deletes)
            return self.table.replace(result, dropped, "UPSERT", base=base, tag=tag)

    def replace_dates(self, batch: DataFrame, dates: Sequence[date], tag: str | None = None) -> int:
        """Rewrite whole days: keys of these days that the batch lacks disappear."""
        if list(self.table._commit_at().partition_by) != ["transaction_date"]:
            raise ValueError("replace_dates needs a table partitioned by transaction_date")
        batch = batch.filter(F.col("transaction_date").isin(list(dates)))
        with storage.staged(conform(batch, self.schema), "replace-dates") as stage:
            rows = stage.rows
            self._check_keys(rows)
            base = self.table._commit_at()
            names = {f"transaction_date={d.isoformat()}" for d in dates}
            dropped = [d for d in base.data_dirs if d.split("/")[1] in names]
            return self.table.replace(rows, dropped, "REPLACE", base=base, tag=tag)

    def _check_keys(self, rows: DataFrame) -> None:
        """One pass over the key columns, counted per key before the shuffle."""
        counts = rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("copies"))
        for bad in counts.filter((F.col("copies") > 1) | ~keys_present(self.keys)).take(1):
            raise QualityGateError(f"batch has a NULL or repeated key: {bad}; a repeated key needs a sequence")

    def _folders_for(self, base, keys: DataFrame) -> list[str]:
        """Data folders of the partitions these keys fall into: at most one value per day or bucket."""
        if not base.partition_by:
            return base.data_dirs
        values = keys.select(*[F.expr(e).alias(c) for c, e in base.partition_by.items()]).distinct().collect()
        return self._folders_named(base, {"/".join(f"{c}={row[c]}" for c in base.partition_by) for row in values})

    @staticmethod
    def _folders_named(base, names: Collection[str]) -> list[str]:
        return [d for d in base.data_dirs if d.split("/", 1)[1] in names]

    # -- serving reads ---------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        return self.table.read(version)

    def read_touching(self, keys: DataFrame | None = None, within: Sequence[str] = ()) -> DataFrame:
        """The partitions that some keys fall into, or those that are named, and no others."""
        base = self.table._commit_at()
        return self.table._scan(base, self._folders_named(base, within) if keys is None else self._folders_for(base, keys))

    def lookup(
        self,
        customer_id: str,
        since: date | None = None,
        until: date | None = None,
        newest_first: bool = False,
    ) -> DataFrame:
        """One customer's days, optionally within a range of dates (both ends included)."""
        df = self.read().filter(F.col("customer_id") == customer_id)
        if since is not None:
            df = df.filter(F.col("transaction_date") >= F.lit(since))
        if until is not None:
            df = df.filter(F.col("transaction_date") <= F.lit(until))
        return df.orderBy(F.col("transaction_date").desc()) if newest_first else df

    def latest_per_customer(self, n: int) -> DataFrame:
        return rollup.latest_per_customer(self.read(), n)

    def count(self) -> int:
        return self.read().count()

    def sample(self, n: int) -> DataFrame:
        return rollup.first_rows(self.read(), n, self.keys)
