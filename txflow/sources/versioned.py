"""Versioned tables: immutable Parquet snapshots, one commit record per version.

Layout below the table root::

    snapshot=<version>-<id>/[<partition>=<value>/]*.parquet   data, never changed once written
    _commits/<version>.json                                   which data folders make up a version

Data is written first and the commit record last, so an interrupted write is invisible.
The record is created only if it is not there yet: of two writers of one version, one
fails. A partitioned table rewrites only the folders that hold affected rows; the other
folders are shared with the version before.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.operators import dml
from txflow.operators.dedup import duplicate_keys
from txflow.operators.dml import keys_present
from txflow.operators.quality import QualityGateError
from txflow.sources import storage

log = logging.getLogger("txflow")

COMMIT_SCHEMA = (
    "version bigint, timestamp timestamp, operation string, predicate string, "
    "operationMetrics map<string,string>, tag string, data_dirs array<string>, "
    "partition_by map<string,string>, partition_types map<string,string>, schema_json string"
)
RAW_BUCKETS = 16


def raw_layout(buckets: int = RAW_BUCKETS) -> dict[str, str]:
    """How raw transactions are stored by default: by a bucket of the id, so that a change of one id rewrites one bucket."""
    return {"id_bucket": f"cast(pmod(xxhash64(transaction_id), {int(buckets)}) as int)"}


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
PARTITION_TYPES = {"date": T.DateType(), "int": T.IntegerType(), "bigint": T.LongType()}


class ConcurrentCommitError(RuntimeError):
    """Another writer committed the same version first."""


class VersionNotFoundError(LookupError):
    """The version was never committed, or its data was vacuumed."""


class AmbiguousMergeError(QualityGateError):
    """Several source rows would update the same target row."""


@dataclass(frozen=True)
class Commit:
    version: int
    timestamp: str
    operation: str
    data_dirs: list[str]
    schema_json: str
    predicate: str | None = None
    operationMetrics: dict[str, str] = field(default_factory=dict)
    tag: str | None = None
    partition_by: dict[str, str] = field(default_factory=dict)
    partition_types: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema_json))

    @property
    def committed_at(self) -> datetime:
        return datetime.fromisoformat(self.timestamp)


class VersionedTable:
    """A table with history. One writer at a time; readers always see a whole version.

    ``partition_by`` maps partition columns to SQL expressions over the row, for example
    ``{"day": "to_date(timestamp)"}``. A partition column must be a date or an integer.
    One that is also a column of the table keeps its name and expression equal.
    ``sort_by`` orders the rows inside each file, so that reads skip row groups.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        partition_by: Mapping[str, str] | None = None,
        sort_by: Sequence[str] = (),
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.sort_by = list(sort_by)
        self._partition_by = dict(partition_by or {})

    # -- commits ---------------------------------------------------------------

    def _versions(self) -> list[int]:
        names = [n for n, is_dir, _ in storage.children(self.spark, f"{self.root}/_commits") if not is_dir]
        return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json"))

    def _commit_at(self, version: int | None = None) -> Commit:
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"no versioned table at {self.root}; write one with overwrite() first")
        if version is None:
            version = versions[-1]
        if version not in versions:
            raise VersionNotFoundError(f"{self.root} has no version {version}")
        return Commit(**json.loads(storage.read_text(self.spark, f"{self.root}/_commits/{version:020d}.json")))

    def exists(self) -> bool:
        return bool(self._versions())

    def version(self) -> int:
        return self._commit_at().version

    def has_tag(self, tag: str) -> bool:
        """Whether some version was committed under this tag."""
        return self.exists() and not self.history().filter(F.col("tag") == tag).isEmpty()

    def _commit(self, operation: str, data_dirs: list[str], schema: T.StructType, *, after: int, **details: object) -> int:
        """Commit onto version ``after``, the one the change was worked out from (-1 for a new table); any other
        commit made since then is an error, and its rows stay."""
        versions = self._versions()
        if (versions[-1] if versions else -1) != after:
            raise ConcurrentCommitError(f"{self.root} has moved on from version {after} to {versions[-1]}")
        commit = Commit(
            version=after + 1,
            timestamp=datetime.now(timezone.utc).isoformat(),
            operation=operation,
            data_dirs=data_dirs,
            schema_json=schema.json(),
            **details,
        )
        path = f"{self.root}/_commits/{commit.version:020d}.json"
        if not storage.create_text(self.spark, path, json.dumps(asdict(commit))):
            raise ConcurrentCommitError(f"version {commit.version} of {self.root} is already there")
        return commit.version

    # -- data folders ----------------------------------------------------------

    def _scan(self, commit: Commit, dirs: Sequence[str] | None = None, located: bool = False) -> DataFrame:
        """Rows of some data folders; ``located`` adds the columns that name each row's folder."""
        dirs = commit.data_dirs if dirs is None else list(dirs)
        schema = commit.schema
        derived = [c for c in commit.partition_by if c not in schema.names]
        place = ["snapshot", *commit.partition_by]
        full = T.StructType([f for f in schema if f.name not in commit.partition_by]).add("snapshot", "string")
        for name, dtype in commit.partition_types.items():
            full = full.add(name, PARTITION_TYPES[dtype])
        if dirs:
            paths = [f"{self.root}/{d}" for d in dirs]
            df = self.spark.read.schema(full).option("basePath", self.root).parquet(*paths)
        else:
            df = self.spark.createDataFrame([], full)
        own = [F.col(c) for c in schema.names]
        extra = [F.col(c) for c in place if c == "snapshot" or c in derived] if located else []
        return df.select(*own, *extra)

    def _layout(self, schema: T.StructType, partition_by: Mapping[str, str]) -> dict[str, dict[str, str]]:
        """The partitioning as a commit records it: expressions, and the types they give."""
        types = {}
        for name, expression in partition_by.items():
            if name in schema.names and expression != name:
                raise ValueError(f"partition column {name} would replace the table's own column of that name")
        if partition_by:
            empty = self.spark.createDataFrame([], schema)
            types = dict(empty.select(*[F.expr(e).alias(c) for c, e in partition_by.items()]).dtypes)
        for name, dtype in types.items():
            if dtype not in PARTITION_TYPES:
                raise ValueError(f"partition column {name} is {dtype}; it must be one of {list(PARTITION_TYPES)}")
        return {"partition_by": dict(partition_by), "partition_types": types}

    @staticmethod
    def _dir_of(row, partition_by: Mapping[str, str]) -> str:
        parts = [f"snapshot={row['snapshot']}"]
        parts += [f"{c}={NO_VALUE if row[c] is None else row[c]}" for c in partition_by]
        return "/".join(parts)

    def _write(self, df: DataFrame, partition_by: Mapping[str, str], shuffle: bool = True) -> list[str]:
        """Write a new snapshot folder and list its data folders.

        With ``shuffle``, rows are gathered by partition in chunks of AQE's advisory size: a
        day with a third of all rows is split over many tasks, small days share one.
        """
        name = f"snapshot={len(self._versions()):08d}-{uuid.uuid4().hex[:8]}"
        for c, e in partition_by.items():
            df = df.withColumn(c, F.expr(e))
        if partition_by and shuffle:
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        if partition_by or self.sort_by:
            df = df.sortWithinPartitions(*partition_by, *[c for c in self.sort_by if c not in partition_by])
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{self.root}/{name}")
        if not partition_by:
            return [name]
        return self._leaves(name, len(partition_by))

    def _leaves(self, prefix: str, depth: int) -> list[str]:
        if depth == 0:
            return [prefix]
        names = [n for n, is_dir, _ in storage.children(self.spark, f"{self.root}/{prefix}") if is_dir and "=" in n]
        return [leaf for n in sorted(names) for leaf in self._leaves(f"{prefix}/{n}", depth - 1)]

    def _counts(self, commit: Commit, before: Sequence[str], fresh: Sequence[str]) -> tuple[int, int]:
        """Rows in the folders that go and in those that come, from Parquet footers.

        Exact also when tasks were repeated, unlike accumulators.
        """
        new = {d.split("/")[0].removeprefix("snapshot=") for d in fresh}
        rows = self._scan(commit, [*before, *fresh], located=True).groupBy("snapshot").count().collect()
        after = sum(r["count"] for r in rows if r["snapshot"] in new)
        return sum(r["count"] for r in rows) - after, after

    def _affected(self, commit: Commit, rows: DataFrame) -> tuple[list[str], int]:
        """Data folders that hold some of ``rows`` (located), and the number of such rows."""
        place = ["snapshot", *commit.partition_by]
        counted = rows.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).collect()
        return sorted(self._dir_of(r, commit.partition_by) for r in counted), sum(r["n"] for r in counted)

    def folders_with(self, unique: DataFrame, keys: Sequence[str]) -> list[str]:
        """Data folders that hold rows under some unique keys; reads the key columns only."""
        base = self._commit_at()
        return self._affected(base, self._located_under(base, unique, keys))[0]

    def _located_under(
        self, commit: Commit, unique: DataFrame, keys: Sequence[str], within: Sequence[str] | None = None
    ) -> DataFrame:
        """Rows under some unique keys, with their folders; a semi join, whose large side AQE can split."""
        located = self._scan(commit, within, located=True).filter(keys_present(keys))
        return located.join(unique.select(*keys), list(keys), "left_semi")

    def read_folders(self, dirs: Sequence[str]) -> DataFrame:
        """Rows of some of the latest version's data folders."""
        return self._scan(self._commit_at(), dirs)

    # -- reads -----------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The latest version, or the table as of a version."""
        commit = self._commit_at(version)
        try:
            return self._scan(commit)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raise VersionNotFoundError(f"version {commit.version} of {self.root} was vacuumed") from error

    def history(self) -> DataFrame:
        """One row per version, newest first."""
        if not self.exists():
            raise FileNotFoundError(f"no versioned table at {self.root}")
        commits = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.root}/_commits")
        return commits.orderBy(F.col("version").desc())

    def diff(self, before: int, after: int, keys: Sequence[str] | None = None) -> DataFrame:
        """What changed between two versions: by key, or as whole rows for tables with repeated keys.

        Folders that both versions share hold the same rows and are not read. Where the schema
        was replaced, the columns that both versions have are compared, as text if their types differ.
        """
        old, new = self._commit_at(before), self._commit_at(after)
        shared = set(old.data_dirs) & set(new.data_dirs) if old.schema_json == new.schema_json else set()
        a = self._scan(old, [d for d in old.data_dirs if d not in shared])
        b = self._scan(new, [d for d in new.data_dirs if d not in shared])
        common = [c for c in old.schema.names if c in new.schema.names]
        lost = [k for k in keys or [] if k not in common]
        if lost or not common:
            raise ValueError(f"versions {before} and {after} do not both have {lost or 'any column in common'}")
        others = sorted(set(old.schema.names) ^ set(new.schema.names))
        if others:
            log.warning("diff of %s: columns %s are in one version only", self.root, others)
        same = {c: old.schema[c].dataType == new.schema[c].dataType for c in common}
        a, b = (df.select(*[F.col(c) if same[c] else F.col(c).cast("string") for c in common]) for df in (a, b))
        return dml.diff_keyed(a, b, keys) if keys else dml.diff_rows(a, b)

    # -- writes ----------------------------------------------------------------

    def create(self, schema: T.StructType) -> bool:
        """Declare an empty table unless it is there already."""
        if self.exists():
            return False
        self._commit("CREATE", [], schema, after=-1, **self._layout(schema, self._partition_by))
        return True

    def overwrite(self, df: DataFrame, tag: str | None = None) -> int:
        """A new version with these rows and this schema; earlier versions stay readable."""
        if "snapshot" in df.columns:
            raise ValueError("a column may not be named 'snapshot'")
        parts, base = self._partition_by, self._commit_at() if self.exists() else None
        if not parts and base:
            parts = base.partition_by
        layout = self._layout(df.schema, parts)
        dirs = self._write(df, parts)
        draft = Commit(0, "", "WRITE", dirs, df.schema.json(), **layout)
        metrics = {"numOutputRows": str(self._counts(draft, [], dirs)[1])}
        after = base.version if base else -1
        return self._commit("WRITE", dirs, df.schema, after=after, operationMetrics=metrics, tag=tag, **layout)

    def replace(
        self,
        df: DataFrame,
        dropped: Sequence[str],
        operation: str,
        *,
        base: Commit | None = None,
        metrics: Mapping[str, str] | None = None,
        predicate: str | None = None,
        tag: str | None = None,
        shuffle: bool = True,
    ) -> int:
        """A new version in which the ``dropped`` data folders give way to ``df``."""
        base = base or self._commit_at()
        gone = set(dropped)
        fresh = self._write(df, base.partition_by, shuffle)
        before, after = self._counts(base, dropped, fresh)
        all_metrics = {"numRowsBefore": str(before), "numRowsAfter": str(after), **(metrics or {})}
        if operation == "DELETE":
            all_metrics["numDeletedRows"] = str(before - after)
        if operation == "MERGE":
            all_metrics["numTargetRowsInserted"] = str(after - before)
        return self._commit(
            operation,
            [d for d in base.data_dirs if d not in gone] + fresh,
            base.schema,
            after=base.version,
            predicate=predicate,
            operationMetrics=all_metrics,
            partition_by=base.partition_by,
            partition_types=base.partition_types,
            tag=tag,
        )

    def _unchanged(self, operation: str, base: Commit, metrics: Mapping[str, str], **details: object) -> int:
        return self._commit(
            operation,
            base.data_dirs,
            base.schema,
            after=base.version,
            operationMetrics=dict(metrics),
            partition_by=base.partition_by,
            partition_types=base.partition_types,
            **details,
        )

    def update(self, condition: Column, assignments: Mapping[str, Column], tag: str | None = None) -> int:
        """Set columns where the condition is true, in every matching row.

        One pass reads the condition's columns with the filter pushed down and finds the
        folders to rewrite; only these are read whole.
        """
        base = self._commit_at()
        touched, hits = self._affected(base, self._scan(base, located=True).filter(condition))
        metrics = {"numUpdatedRows": str(hits)}
        if not touched:
            return self._unchanged("UPDATE", base, metrics, predicate=_text(condition), tag=tag)
        moved = any(name in expr for expr in base.partition_by.values() for name in assignments)
        df = dml.apply_update(self._scan(base, touched), condition, assignments)
        return self.replace(
            df, touched, "UPDATE", base=base, metrics=metrics, predicate=_text(condition), tag=tag, shuffle=moved
        )

    def delete(self, condition: Column, tag: str | None = None) -> int:
        """Drop the rows where the condition is true."""
        base = self._commit_at()
        touched, _ = self._affected(base, self._scan(base, located=True).filter(condition))
        if not touched:
            return self._unchanged("DELETE", base, {"numDeletedRows": "0"}, predicate=_text(condition), tag=tag)
        df = dml.apply_delete(self._scan(base, touched), condition)
        return self.replace(df, touched, "DELETE", base=base, predicate=_text(condition), tag=tag, shuffle=False)

    def merge(
        self,
        source: DataFrame,
        keys: Sequence[str],
        *,
        stored_at: str | None = None,
        within: Sequence[str] | None = None,
        tag: str | None = None,
    ) -> int:
        """Update all matched rows, insert all unmatched source rows.

        The source is staged once, unless it is a plain read of files at ``stored_at``. Several source rows under
        one non-NULL key raise. A caller that has already found the data folders with matches (``folders_with``)
        passes them as ``within``.
        """
        base, keys = self._commit_at(), list(keys)
        with storage.staged(dml.cast_like(source, self._scan(base)), "merge-source", stored_at) as stage:
            src = stage.rows
            keyed = src.filter(keys_present(keys))
            repeated = duplicate_keys(keyed, keys).take(1)
            if repeated:
                raise AmbiguousMergeError(f"several source rows under one key, for example {repeated[0]}")
            touched, hits = self._affected(base, self._located_under(base, keyed, keys, within))
            merged = dml.apply_merge(self._scan(base, touched), src, keys)
            return self.replace(
                merged,
                touched,
                "MERGE",
                base=base,
                metrics={"numTargetRowsUpdated": str(hits)},
                predicate=f"keys {', '.join(keys)}",
                tag=tag,
            )

    # -- maintenance -----------------------------------------------------------

    def vacuum(self, hours: float = 168, dry_run: bool = True, now: datetime | None = None) -> DataFrame:
        """Data folders that no version of the last ``hours`` uses; deleted only with ``dry_run=False``.

        A version counts as used until ``hours`` after its successor was committed. The latest
        version always stays. Folders of unfinished writes go once they are that old.
        """
        now = now or datetime.now(timezone.utc)
        limit = now - timedelta(hours=hours)
        commits = [self._commit_at(v) for v in self._versions()]
        keep: set[str] = set()
        known: set[str] = set()
        for commit, successor in zip(commits, [*commits[1:], None]):
            known.update(commit.data_dirs)
            if successor is None or successor.committed_at > limit:
                keep.update(commit.data_dirs)
        doomed = [(d, "superseded") for d in sorted(known - keep)]
        referenced = {d.split("/")[0] for d in known}
        for name, is_dir, modified in storage.children(self.spark, self.root):
            if is_dir and name.startswith("snapshot=") and name not in referenced:
                if datetime.fromtimestamp(modified, timezone.utc) <= limit:
                    doomed.append((name, "unfinished"))
        doomed = [(d, why) for d, why in doomed if storage.exists(self.spark, f"{self.root}/{d}")]
        if not dry_run:
            for d, _ in doomed:
                storage.delete(self.spark, f"{self.root}/{d}")
        return self.spark.createDataFrame(doomed, "data_dir string, reason string")


def _text(condition: Column) -> str:
    return str(condition).removeprefix("Column<'").removesuffix("'>")
