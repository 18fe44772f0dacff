"""Records of CSV files whose quoted fields may hold line breaks, without giving a file to one task.

A line alone does not say whether it begins inside a quoted field, but it says what it does to that: each line maps
"outside" and "inside" to the state it ends in. Such maps can be joined from left to right in any grouping, so every
split of a file is worked out by itself for both states; a row for each split then tells which of the two was true.
Fields are quoted as usual: a quote opens a field only where the field begins, and is doubled inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A whole quoted field, and the end of one that was open; possessive, so that no text makes them go back.
BODY = r'[^"]*+(?:""[^"]*+)*+'
FIELD = rf'(^|,)"{BODY}"'
REST = rf'^{BODY}"'
OPENING = r'(^|,)"'
MAX_LINES = 10_000


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place: file, first byte of the split, and a number that rises within the split."""
    text = spark.read.option("lineSep", "\n").text(path)
    place = ("_metadata.file_path", "file"), ("_metadata.file_block_start", "block")
    return text.select("value", *[F.col(c).alias(n) for c, n in place], F.monotonically_increasing_id().alias("row"))


def _open_after(text: Column) -> Column:
    return F.regexp_replace(text, FIELD, "$1").rlike(OPENING).cast("int")


def ends(line: Column) -> tuple[Column, Column]:
    """The state after a line, 1 for inside a quoted field, if it begins outside and if it begins inside."""
    quoted = line.contains('"')
    closed = F.regexp_replace(line, REST, "x")
    inside = F.when(closed == line, F.lit(1)).otherwise(_open_after(closed))
    return F.when(quoted, _open_after(line)).otherwise(0), F.when(quoted, inside).otherwise(1)


def _running(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The joined map of all rows before each, in two parts: ``fixed``, a state that some row sets whatever was before,
    with ``turns`` since then (or since the start, if ``fixed`` is NULL) that each change the state.
    """
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turned = rows.withColumn("_all", F.coalesce(F.sum("turn").over(before), F.lit(0)))
    last = F.last(F.when(F.col("sets").isNotNull(), F.struct("sets", "_all", "turn")), ignorenulls=True).over(before)
    held = turned.withColumn("_last", last)
    return held.withColumns(
        {
            "fixed": F.col("_last.sets"),
            "turns": F.col("_all") - F.coalesce(F.col("_last._all") + F.col("_last.turn"), F.lit(0)),
        }
    ).drop("_all", "_last")


def _state(start: Column) -> Column:
    return (F.coalesce(F.col("fixed"), start) + F.col("turns")) % 2


def records(spark: SparkSession, path: str, max_lines: int = MAX_LINES) -> DataFrame:
    """The records of all files, header and blank lines left out: ``record`` (NULL if it never ends) and ``line``.

    Where no line leaves a field open, each line is a record and nothing is shuffled. Otherwise the lines of a split are
    put in order, and only records of several lines are grouped. A field that is open at the end of its file, or for more
    than ``max_lines`` lines, was never closed: its lines come back one by one with a NULL record, so no such field
    gathers a file in one task.
    """
    lines = lines_of(spark, path)
    outside, inside = ends(F.col("value"))
    mapped = lines.withColumns({"_out": outside, "_in": inside})
    first = Window.partitionBy("file", "block").orderBy("row")
    if mapped.filter("_out = 1").isEmpty():
        heads = lines.filter("block = 0").groupBy("file").agg(F.min("row").alias("row"))
        body = lines.join(heads.withColumn("_head", F.lit(True)), ["file", "row"], "left").filter("_head is null")
        whole = _without_break(F.col("value"))
        return body.filter(F.trim(whole) != "").select(whole.alias("record"), whole.alias("line"))

    maps = mapped.withColumns(
        {
            "sets": F.when(F.col("_out") == F.col("_in"), F.col("_out")),
            "turn": ((F.col("_out") == 1) & (F.col("_in") == 0)).cast("int"),
        }
    )
    local = _running(maps, ["file", "block"], "row").withColumn("header", (F.col("block") == 0) & (F.row_number().over(first) == 1))

    # A row for each split: its own map, and where its last record begins for either state at its start.
    after = (F.coalesce(F.col("sets"), F.col("fixed")), F.when(F.col("sets").isNotNull(), 0).otherwise(F.col("turns") + F.col("turn")))
    begins = lambda start: F.max(F.when(_state(F.lit(start)) == 0, F.col("row")))
    splits = local.groupBy("file", "block").agg(
        F.max_by(F.struct(after[0].alias("sets"), (after[1] % 2).alias("turn")), "row").alias("map"),
        begins(0).alias("begins_0"),
        begins(1).alias("begins_1"),
    )
    # A split that sets the state and turns it afterwards sets the turned state.
    sets = F.when(F.col("map.sets").isNotNull(), (F.col("map.sets") + F.col("map.turn")) % 2)
    whole_splits = splits.select(
        "file", "block", "begins_0", "begins_1", sets.alias("sets"), F.when(sets.isNull(), F.col("map.turn")).otherwise(0).alias("turn")
    )
    started = _running(whole_splits, ["file"], "block").withColumn("start", _state(F.lit(0)))
    own = F.when(F.col("start") == 0, F.col("begins_0")).otherwise(F.col("begins_1"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.when(own.isNotNull(), F.struct(F.col("block"), own.alias("row"))), ignorenulls=True).over(earlier)
    starts = started.select("file", "block", "start", carried.alias("carried"))

    placed = local.join(starts, ["file", "block"]).withColumn("state", _state(F.col("start")))
    ended = F.when(F.col("state") == 0, F.col("_out")).otherwise(F.col("_in"))
    here = F.last(F.when(F.col("state") == 0, F.col("row")), ignorenulls=True).over(first)
    keyed = placed.withColumns({"ended": ended, "_here": here})
    begin = F.when(F.col("_here").isNotNull(), F.struct("block", F.col("_here").alias("row"))).otherwise(F.col("carried"))
    keyed = keyed.withColumn("begin", begin)

    single = keyed.filter("state = 0 and ended = 0 and not header")
    single = single.select(_without_break(F.col("value")).alias("record")).filter(F.trim("record") != "")
    several = keyed.filter("state = 1 or ended = 1")
    sizes = several.groupBy("file", "begin").agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_or("header").alias("headed"),
        F.max_by("ended", F.struct("block", "row")).alias("open"),
    )
    several = several.join(sizes, ["file", "begin"])
    closes = (F.col("n") <= max_lines) & (F.col("open") == 0)
    parts = F.array_sort(F.collect_list(F.struct("block", "row", "value")))
    joined = (
        several.filter(closes)
        .groupBy("file", "begin")
        .agg(parts.alias("parts"), F.bool_or("headed").alias("headed"))
        .filter("not headed")
        .select(_without_break(F.array_join(F.transform("parts", lambda p: p["value"]), "\n")).alias("record"))
    )
    endless = several.filter(~closes).select(F.lit(None).cast("string").alias("record"), F.col("value").alias("line"))
    closed = single.unionByName(joined)
    return closed.select("record", F.col("record").alias("line")).unionByName(endless)


def _without_break(text: Column) -> Column:
    return F.regexp_replace(text, "\r$", "")
