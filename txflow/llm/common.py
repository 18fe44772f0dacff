"""What the operators share: written intermediate tables, document keys and a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.sources.storage import fresh_dir

# ASCII white space, which separates words; everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the cluster's shared folder: cuts lineage and survives lost executors."""
    path = fresh_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text; NULL counts as empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


_HELD: dict = {}


def of_worker(key, make):
    """A large object that outlives the tasks of a Python worker; it goes when a task asks for another one."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def with_rank(keys: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Distinct rows with their place in the order from 0, and how many there are."""
    return ranked(keys.distinct(), order)


def ranked(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """All rows with their place in the order from 0 (``rank``), and how many there are.

    A range-partitioned sort numbers rows within its partitions; the offsets are one number for each
    partition, so that no task ever sees all rows. The sorted rows are written before they are counted,
    because a second run of the sort could cut its ranges elsewhere.
    """
    spark = rows.sparkSession
    place = F.monotonically_increasing_id()
    by = [F.col(c).asc_nulls_first() for c in order]
    placed = written(rows.orderBy(*by).select("*", place.alias("_place")), "rank")
    part, row = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())
    offsets, total = [], 0
    for p, n in sizes:
        offsets.append((p, total))
        total += n
    starts = spark.createDataFrame(offsets, "_part long, _start long")
    located = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return located.select(*rows.columns, (F.col("_start") + row).alias("rank")), total
