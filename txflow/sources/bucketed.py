"""Tables kept in hash buckets of their key, so that merges and upserts leave the target where it is.

A bucketed table tells Spark that rows of one key are in one bucket; a batch is dealt into as many buckets and meets the
target there. Only the batch is shuffled, however large the target. A generation of files is written whole and then named
as the current one. All rows of a key share a bucket: for keys that hold a large part of the rows, use
:class:`~txflow.sources.versioned.VersionedTable`, whose merge can split them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.operators import dml
from txflow.operators.dedup import duplicate_keys
from txflow.operators.dml import keys_present
from txflow.operators.upsert import collapse_batch
from txflow.schemas import conform
from txflow.sources import storage
from txflow.sources.versioned import AmbiguousMergeError


class BucketedTable:
    """Rows of ``schema`` below ``root`` in ``buckets`` buckets of ``keys``, sorted by them within each bucket."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.buckets = list(keys), buckets

    def _generations(self) -> list[str]:
        """Names of the generations that were finished, oldest first."""
        names = [n for n, _, _ in storage.children(self.spark, f"{self.root}/_done")]
        return sorted(n for n in names if re.fullmatch(r"\d{8}-[0-9a-f]{12}", n))

    def exists(self) -> bool:
        return bool(self._generations())

    def read(self) -> DataFrame:
        """All rows; the scan keeps the buckets, so grouping or joining by the keys needs no shuffle."""
        done = self._generations()
        if not done:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.table(self._declared(done[-1]))

    def _declared(self, generation: str) -> str:
        """The generation as a table of this session's catalog, which is where Spark keeps a table's buckets."""
        name = "txflow_" + re.sub(r"\W", "_", f"{generation}")
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"create table {name} ({columns}) using parquet clustered by ({keys}) sorted by ({keys}) "
                f"into {self.buckets} buckets location '{self.root}/{generation}'"
            )
        return name

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, *self.keys)

    def _write(self, rows: DataFrame) -> str:
        """A new generation from rows that already lie in their buckets, so each task writes one file."""
        before = self._generations()
        generation = f"{len(before):08d}-{uuid.uuid4().hex[:12]}"
        name = self._declared(generation)
        conform(rows, self.schema).write.mode("append").insertInto(name)
        storage.create_text(self.spark, f"{self.root}/_done/{generation}", "")
        return generation

    def overwrite(self, rows: DataFrame) -> str:
        """Replace all rows; returns the name of the new generation."""
        return self._write(self._dealt(conform(rows, self.schema)))

    def merge(self, source: DataFrame) -> str:
        """Update all rows whose keys the source has, insert the others; NULL keys match nothing and are inserted.

        Several source rows under one key raise. The target is scanned once and shuffled nowhere.
        """
        with storage.staged(dml.cast_like(source, self.read()), "bucketed-source") as stage:
            keyed = stage.rows.filter(keys_present(self.keys))
            for row in duplicate_keys(keyed, self.keys).take(1):
                raise AmbiguousMergeError(f"several source rows under one key, for example {row}")
            merged = self.merged(stage.rows)
            return self._write(merged)

    def merged(self, source: DataFrame) -> DataFrame:
        """Target and source as one frame: a full join by buckets, in which the source's row stands where there is one."""
        names = [f.name for f in self.schema]
        values = [c for c in names if c not in self.keys]
        target = self.read().select(*self.keys, F.struct(*values).alias("_old"))
        fresh = self._dealt(source).select(*self.keys, F.struct(*values).alias("_new"))
        joined = target.join(fresh, self.keys, "full")
        row = F.coalesce("_new", "_old")
        return joined.select(*[F.col(c) if c in self.keys else row[c].alias(c) for c in names])

    def upsert(self, batch: DataFrame, sequence: Sequence[str] | None = None) -> str:
        """Insert or replace by key; a batch that repeats a key needs ``sequence``, which says which row is last."""
        if sequence is not None:
            batch = collapse_batch(batch, self.keys, sequence)
        if not conform(batch, self.schema).filter(~keys_present(self.keys)).isEmpty():
            raise ValueError("an upsert batch has a NULL key")
        return self.merge(batch)

    def vacuum(self) -> list[str]:
        """Delete all generations but the newest; returns their names."""
        *old, _ = self._generations() or [None]
        for generation in old:
            self.spark.sql(f"drop table if exists txflow_{generation.replace('-', '_')}")
            storage.delete(self.spark, f"{self.root}/{generation}")
            storage.delete(self.spark, f"{self.root}/_done/{generation}")
        return old
