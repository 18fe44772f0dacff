"""Every operator as a query over the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txflow.config import FlowConfig
from txflow.functions import columns as fx
from txflow.operators import cleanse, digests, dml, quality, rollup, sketches, upsert
from txflow.operators.dedup import dedupe, duplicate_keys
from txflow.plans import daily
from txflow.plans.fixtures import copies, dirty_tx, load, originals
from txflow.plans.run import ROW_ORDER, check_session, quarantined, run_daily, run_incremental, stage_batch, survivor_table
from txflow.schemas import DAILY_TOTALS, DAILY_TOTALS_FLOAT, MONEY, RAW_TRANSACTIONS, conform
from txflow.sources import files, generate, storage
from txflow.sources.bucketed import BucketedTable
from txflow.sources.clustered import ClusteredTotals
from txflow.sources.keyed import KeyedTable
from txflow.sources.versioned import VersionedTable, raw_layout
from txflow.streaming.stateful import StreamConfig, run_available, totals

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}

# -- shared SQL ----------------------------------------------------------------

_B = """
  b as (
    select 'T' || event_id as transaction_id, 'C' || lpad(user_id::varchar, 5, '0') as customer_id,
           event_id, value::decimal(18,2) as amount, ts as "timestamp", event_type as merchant
    from events),
  originals as (
    select transaction_id, customer_id,
           (case when event_id % 33 = 1 then 0 when event_id % 50 = 2 then -amount else amount end)::decimal(18,2)
             as amount,
           "timestamp", merchant
    from b),
  copies as (
    select transaction_id, customer_id,
           (case when event_id % 60 = 0 then 0 else amount end)::decimal(18,2) as amount,
           "timestamp" + interval 30 hours as "timestamp", merchant
    from b where event_id % 20 = 0),
  dirty_tx as (select * from originals union all select * from copies)"""

_FIRST = """
  first_tx as (
    select transaction_id, customer_id, amount, "timestamp", merchant
    from (select *, row_number() over (partition by transaction_id
                                       order by "timestamp", customer_id, amount, merchant) as rn from dirty_tx)
    where rn = 1)"""

_TOTALS = """
  totals as (
    select customer_id, "timestamp"::date as transaction_date,
           sum(amount)::decimal(18,2) as daily_total, count(*)::bigint as transaction_count
    from first_tx where amount > 0 group by all)"""

_BASE_BATCH = """
  base as (
    select customer_id, "timestamp"::date as transaction_date,
           sum(amount)::decimal(18,2) as daily_total, count(*)::bigint as transaction_count
    from originals where amount > 0 group by all),
  batch as (
    select customer_id, "timestamp"::date as transaction_date,
           sum(amount)::decimal(18,2) as daily_total, count(*)::bigint as transaction_count
    from copies where amount > 0 group by all),
  upserted as (
    select * from batch
    union all
    select * from base a where not exists (
      select 1 from batch c where c.customer_id = a.customer_id and c.transaction_date = a.transaction_date))"""

_SOURCE = """
  source as (
    select * from copies
    union all
    select 'O' || o_orderkey, 'C' || lpad(o_custkey::varchar, 5, '0'), o_totalprice::decimal(18,2),
           o_orderdate, o_orderstatus
    from orders)"""

_MERGED = """
  merged as (
    select * from source
    union all
    select * from dirty_tx t where not exists (select 1 from source s where s.transaction_id = t.transaction_id)
    union all
    select s.* from source s
    join (select transaction_id, count(*) - 1 as extra from dirty_tx group by 1) t using (transaction_id),
    unnest(range(t.extra)) as u(i))"""


def _with(*parts: str) -> str:
    return "with" + ",".join(parts) + "\n"


TX, FIRST, TOTALS = _with(_B), _with(_B, _FIRST), _with(_B, _FIRST, _TOTALS)


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            check_session(spark)
            return fn(spark, sf_dir)

        _QUERIES[name] = run
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


# -- cleanse -------------------------------------------------------------------


@_query("dedup_first_by_time", FIRST + "select * from first_tx")
def _(spark, sf):
    return dedupe(dirty_tx(spark, sf), ["transaction_id"], ROW_ORDER)


@_query(
    "dedup_latest_by_time",
    TX
    + """
select transaction_id, customer_id, amount, "timestamp", merchant
from (select *, row_number() over (partition by transaction_id
        order by "timestamp" desc, customer_id desc, amount desc, merchant desc) as rn from dirty_tx)
where rn = 1""",
)
def _(spark, sf):
    return dedupe(dirty_tx(spark, sf), ["transaction_id"], ROW_ORDER, latest=True)


@_query(
    "dedup_lineitem_orderkey",
    """
select l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus
from (select *, row_number() over (partition by l_orderkey
        order by l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                 l_returnflag, l_linestatus) as rn from lineitem)
where rn = 1""",
)
def _(spark, sf):
    return dedupe(load(spark, sf, "lineitem"), ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey"])


@_query("filter_positive_amount", "select c_custkey, c_acctbal from customer where c_acctbal > 0")
def _(spark, sf):
    return cleanse.valid_rows(load(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@_query(
    "rejects_by_reason",
    FIRST
    + """
select case when amount is null then 'null_amount' when amount = 0 then 'zero_amount'
            else 'negative_amount' end as reject_reason,
       count(*)::bigint as row_count
from first_tx where amount is null or amount <= 0 group by 1""",
)
def _(spark, sf):
    return cleanse.rejects(daily.keep_first(dirty_tx(spark, sf))).groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@_query(
    "derive_transaction_date",
    TX + """select transaction_id, "timestamp", "timestamp"::date as transaction_date from dirty_tx""",
)
def _(spark, sf):
    return cleanse.with_transaction_date(dirty_tx(spark, sf).select("transaction_id", "timestamp"))


@_query("cast_amount_float", TX + "select transaction_id, amount::float as amount from dirty_tx")
def _(spark, sf):
    return cleanse.cast_amount(dirty_tx(spark, sf).select("transaction_id", "amount"))


@_query(
    "scalar_scale_round",
    TX + "select transaction_id, amount, round(amount * 1.01, 2)::decimal(18,2) as scaled_amount from dirty_tx",
)
def _(spark, sf):
    return dirty_tx(spark, sf).select(
        "transaction_id", "amount", fx.scaled(F.col("amount")).cast(MONEY).alias("scaled_amount")
    )


@_query(
    "format_customer_code", "select event_id, 'C' || lpad(user_id::varchar, 5, '0') as customer_code from events"
)
def _(spark, sf):
    return load(spark, sf, "events").select("event_id", fx.customer_code(F.col("user_id")).alias("customer_code"))


@_query(
    "date_offset",
    """
select event_id, (ts::date - (event_id % 7)::integer)::date as earlier_date,
       ts - to_hours((event_id % 24)::integer) as earlier_time
from events""",
)
def _(spark, sf):
    number, none = F.col("event_id"), F.lit(0)
    return load(spark, sf, "events").select(
        "event_id",
        fx.days_before(fx.transaction_date(F.col("ts")), (number % 7).cast("int")).alias("earlier_date"),
        fx.time_before(F.col("ts"), none, (number % 24).cast("int"), none, none).alias("earlier_time"),
    )


# -- totals --------------------------------------------------------------------


@_query("transform_daily_totals", TOTALS + "select * from totals")
def transform_daily_totals(spark, sf):
    return daily.transform(dirty_tx(spark, sf))


@_query(
    "transform_validate_first",
    TX
    + """
select customer_id, "timestamp"::date as transaction_date,
       sum(amount)::decimal(18,2) as daily_total, count(*)::bigint as transaction_count
from (select *, row_number() over (partition by transaction_id
        order by "timestamp", customer_id, amount) as rn from dirty_tx where amount > 0)
where rn = 1 group by all""",
)
def _(spark, sf):
    return daily.transform(dirty_tx(spark, sf), validate_first=True)


@_query(
    "daily_totals",
    TX
    + """
select customer_id, "timestamp"::date as transaction_date,
       sum(amount)::decimal(18,2) as daily_total, count(*)::bigint as transaction_count
from dirty_tx where amount > 0 group by all""",
)
def _(spark, sf):
    return rollup.daily_totals(cleanse.with_transaction_date(cleanse.valid_rows(dirty_tx(spark, sf))))


@_query(
    "daily_totals_float",
    FIRST
    + """
select customer_id, "timestamp"::date as transaction_date, round(sum(amount::float), 2) as daily_total
from first_tx where amount > 0 group by all""",
)
def _(spark, sf):
    valid = cleanse.valid_rows(daily.keep_first(dirty_tx(spark, sf)))
    return rollup.daily_totals_float(cleanse.with_transaction_date(valid))


@_query(
    "daily_totals_orders",
    """
select 'C' || lpad(o_custkey::varchar, 5, '0') as customer_id, o_orderdate::date as transaction_date,
       sum(o_totalprice::decimal(18,2))::decimal(18,2) as daily_total, count(*)::bigint as transaction_count
from orders where o_totalprice > 0 group by all""",
)
def _(spark, sf):
    return rollup.daily_totals(cleanse.with_transaction_date(cleanse.valid_rows(_orders_as_tx(spark, sf))))


@_query("count_rows", TX + "select count(*)::bigint as row_count from dirty_tx")
def _(spark, sf):
    return rollup.count_rows(dirty_tx(spark, sf))


@_query(
    "sorted_totals",
    TOTALS
    + """
select *, row_number() over (partition by customer_id order by transaction_date)::integer as day_number
from totals""",
)
def _(spark, sf):
    totals = daily.transform(dirty_tx(spark, sf))
    placed = rollup.numbered(totals, ["customer_id"], [F.col("transaction_date").asc()], "day_number")
    return placed.orderBy(*rollup.TOTAL_KEYS)


@_query(
    "top_daily_totals",
    TOTALS
    + """
select customer_id, transaction_date, daily_total, transaction_count, rank::integer as rank
from (select *, row_number() over (order by daily_total desc, customer_id, transaction_date) as rank from totals)
where rank <= 10""",
)
def _(spark, sf):
    order = [F.col("daily_total").desc(), F.col("customer_id").asc(), F.col("transaction_date").asc()]
    top = rollup.first_rows(daily.transform(dirty_tx(spark, sf)), 10, order)
    return rollup.numbered(top.withColumn("_all", F.lit(1)), ["_all"], order, "rank").drop("_all")


# -- keyed table ---------------------------------------------------------------


def _totals_of(df: DataFrame) -> DataFrame:
    return rollup.daily_totals(cleanse.with_transaction_date(cleanse.valid_rows(df)))


def _totals_table(spark: SparkSession, *batches: DataFrame) -> KeyedTable:
    table = KeyedTable.daily_totals(spark, storage.fresh_dir(spark, "daily-totals"))
    for batch in batches:
        table.upsert(batch)
    return table


def _stored_totals(spark: SparkSession, sf: str) -> KeyedTable:
    return _totals_table(spark, daily.transform(dirty_tx(spark, sf)))


@_query("upsert_daily_totals", _with(_B, _BASE_BATCH) + "select * from upserted")
def _(spark, sf):
    return _totals_table(spark, _totals_of(originals(spark, sf)), _totals_of(copies(spark, sf))).read()


@_query("upsert_idempotent", _with(_B, _BASE_BATCH) + "select * from upserted")
def _(spark, sf):
    batch = _totals_of(copies(spark, sf))
    return _totals_table(spark, _totals_of(originals(spark, sf)), batch, batch).read()


@_query(
    "lww_collapse_batch",
    TX
    + """
select customer_id, transaction_date, transaction_id, amount
from (select *, "timestamp"::date as transaction_date,
             row_number() over (partition by customer_id, "timestamp"::date
                                order by "timestamp" desc, transaction_id desc, amount desc) as rn from dirty_tx)
where rn = 1""",
)
def _(spark, sf):
    batch = cleanse.with_transaction_date(dirty_tx(spark, sf).drop("merchant"))
    last = upsert.collapse_batch(batch, rollup.TOTAL_KEYS, ["timestamp", "transaction_id"])
    return last.select(*rollup.TOTAL_KEYS, "transaction_id", "amount")


@_query(
    "audit_upsert_raw",
    TX
    + """
select transaction_id, customer_id, amount, "timestamp" as ts, merchant
from (select *, row_number() over (partition by transaction_id
        order by "timestamp" desc, customer_id desc, amount desc, merchant desc) as rn from dirty_tx)
where rn = 1""",
)
def _(spark, sf):
    table = KeyedTable.audit(spark, storage.fresh_dir(spark, "audit"), buckets=16)
    for part in (originals(spark, sf), copies(spark, sf)):
        table.upsert(part.withColumnRenamed("timestamp", "ts"), sequence=["ts"])
    return table.read().withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@_query("keyed_read_all", TOTALS + "select * from totals")
def _(spark, sf):
    return _stored_totals(spark, sf).read()


@_query("serve_customer_lookup", TOTALS + "select * from totals where customer_id = 'C00001'")
def _(spark, sf):
    return _stored_totals(spark, sf).lookup("C00001")


@_query(
    "serve_customer_range",
    TOTALS
    + """
select * from totals
where customer_id = 'C00001' and transaction_date between date '2024-01-08' and date '2024-01-21'""",
)
def _(spark, sf):
    return _stored_totals(spark, sf).lookup("C00001", since=date(2024, 1, 8), until=date(2024, 1, 21))


@_query(
    "serve_latest_first",
    TOTALS
    + """
select *, row_number() over (order by transaction_date desc)::integer as recency
from totals where customer_id = 'C00001'""",
)
def _(spark, sf):
    newest = _stored_totals(spark, sf).lookup("C00001", newest_first=True)
    return rollup.numbered(newest, ["customer_id"], [F.col("transaction_date").desc()], "recency")


@_query(
    "serve_latest_n_per_customer",
    TOTALS
    + """
select * from (select *, row_number() over (partition by customer_id
                                            order by transaction_date desc)::integer as recency from totals)
where recency <= 3""",
)
def _(spark, sf):
    return _stored_totals(spark, sf).latest_per_customer(3)


def _clustered(spark: SparkSession, sf: str) -> ClusteredTotals:
    copy = ClusteredTotals(spark, storage.fresh_dir(spark, "clustered"), files=128)
    copy.refresh(_stored_totals(spark, sf))
    return copy


@_query("serve_clustered_range", TOTALS + "select * from totals where customer_id = 'C00007' and transaction_date >= date '2024-01-10'")
def _(spark, sf):
    return _clustered(spark, sf).lookup("C00007", since=date(2024, 1, 10))


@_query(
    "lookup_files_read",
    TOTALS
    + """
select customer_id, count(*)::bigint as days, sum(daily_total)::decimal(18,2) as total, 'at most a tenth' as files_read
from totals where customer_id = 'C00001' group by 1""",
)
def _(spark, sf):
    """All days of a customer, and whether more than a tenth of the files was opened for them."""
    copy = _clustered(spark, sf)
    few = len(copy.files_for("C00001")) * 10 <= copy.bounds().count()
    return copy.lookup("C00001").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("daily_total").cast(MONEY).alias("total"),
        F.lit("at most a tenth" if few else "more").alias("files_read"),
    )


@_query("serve_count", TOTALS + "select count(*)::bigint as row_count from totals")
def _(spark, sf):
    return rollup.count_rows(_stored_totals(spark, sf).read())


@_query(
    "replace_dates",
    _with(_B, _BASE_BATCH)
    + """
select * from batch where transaction_date = date '2024-01-15'
union all
select * from base where transaction_date <> date '2024-01-15'""",
)
def _(spark, sf):
    table = _totals_table(spark, _totals_of(originals(spark, sf)))
    table.replace_dates(_totals_of(copies(spark, sf)), [date(2024, 1, 15)])
    return table.read()


# -- versioned table -----------------------------------------------------------


def _orders_as_tx(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("transaction_id"),
        fx.customer_code(F.col("o_custkey")).alias("customer_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_orderstatus").alias("merchant"),
    )


def _merge_source(spark: SparkSession, sf: str) -> DataFrame:
    return copies(spark, sf).unionByName(_orders_as_tx(spark, sf))


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", F.col("c_acctbal").cast(MONEY).alias("c_acctbal")
    )


def _versioned(spark: SparkSession, first: DataFrame, by_month: bool = False) -> VersionedTable:
    parts = {"month": "trunc(timestamp, 'MM')"} if by_month else None
    table = VersionedTable(spark, storage.fresh_dir(spark, "versioned"), parts)
    table.overwrite(first)
    return table


@_query("versioned_read_latest", TX + "select * from dirty_tx where not coalesce(amount < 0, false)")
def _(spark, sf):
    table = _versioned(spark, dirty_tx(spark, sf))
    table.delete(F.col("amount") < 0)
    return table.read()


@_query("versioned_as_of", TX + "select * from dirty_tx")
def _(spark, sf):
    table = _versioned(spark, dirty_tx(spark, sf), by_month=True)
    table.update(F.col("customer_id") == "C00001", {"amount": fx.scaled(F.col("amount"))})
    table.delete(F.col("amount") < 0)
    return table.read(version=0)


@_query(
    "versioned_overwrite",
    FIRST + """select transaction_id, amount, "timestamp"::date as transaction_date from first_tx""",
)
def _(spark, sf):
    table = _versioned(spark, dirty_tx(spark, sf))
    first = dedupe(table.read(), ["transaction_id"], ROW_ORDER)
    table.overwrite(cleanse.with_transaction_date(first).select("transaction_id", "amount", "transaction_date"))
    return table.read()


@_query(
    "versioned_update",
    """
select c_custkey, c_mktsegment,
       (case when c_mktsegment = 'BUILDING' then round(c_acctbal::decimal(18,2) * 1.01, 2)
             else c_acctbal::decimal(18,2) end)::decimal(18,2) as c_acctbal
from customer""",
)
def _(spark, sf):
    table = _versioned(spark, _customers(spark, sf))
    table.update(F.col("c_mktsegment") == "BUILDING", {"c_acctbal": fx.scaled(F.col("c_acctbal"))})
    return table.read()


@_query(
    "versioned_delete",
    """
select c_custkey, c_mktsegment, c_acctbal::decimal(18,2) as c_acctbal
from customer where not coalesce(c_acctbal < 0, false)""",
)
def _(spark, sf):
    table = _versioned(spark, _customers(spark, sf))
    table.delete(F.col("c_acctbal") < 0)
    return table.read()


@_query("versioned_merge_upsert", _with(_B, _SOURCE, _MERGED) + "select * from merged")
def _(spark, sf):
    table = _versioned(spark, dirty_tx(spark, sf), by_month=True)
    table.merge(_merge_source(spark, sf), ["transaction_id"])
    return table.read()


def _bucketed(spark: SparkSession, name: str, schema: StructType, keys: list[str]) -> BucketedTable:
    return BucketedTable(spark, storage.fresh_dir(spark, name), schema, keys, buckets=8)


@_query("bucketed_merge_upsert", _with(_B, _SOURCE, _MERGED) + "select * from merged")
def _(spark, sf):
    """The merge above on a table in buckets of the id; the target is not shuffled."""
    table = _bucketed(spark, "bucketed-raw", dirty_tx(spark, sf).schema, ["transaction_id"])
    table.overwrite(dirty_tx(spark, sf))
    table.merge(_merge_source(spark, sf))
    return table.read()


@_query("bucketed_upsert_totals", _with(_B, _BASE_BATCH) + "select * from upserted")
def _(spark, sf):
    table = _bucketed(spark, "bucketed-totals", DAILY_TOTALS, rollup.TOTAL_KEYS)
    for rows in (originals(spark, sf), copies(spark, sf)):
        table.upsert(_totals_of(rows))
    return table.read()


@_query(
    "merge_change_counts",
    _with(_B, _SOURCE)
    + """
select (select count(*) from dirty_tx t where exists (
          select 1 from source s where s.transaction_id = t.transaction_id))::bigint as rows_updated,
       (select count(*) from source s where not exists (
          select 1 from dirty_tx t where s.transaction_id = t.transaction_id))::bigint as rows_inserted""",
)
def _(spark, sf):
    return dml.merge_change_counts(dirty_tx(spark, sf), _merge_source(spark, sf), ["transaction_id"])


_DIFF = """,
  kept as (select * from first_tx where not coalesce(amount < 0, false)),
  after_merge as (
    select * from source
    union all
    select * from kept t where not exists (select 1 from source s where s.transaction_id = t.transaction_id))
select coalesce(o.transaction_id, n.transaction_id) as transaction_id,
       case when o.transaction_id is null then 'added' when n.transaction_id is null then 'removed'
            else 'changed' end as change,
       o.amount as old_amount, n.amount as new_amount
from first_tx o full outer join after_merge n on o.transaction_id = n.transaction_id
where o.transaction_id is null or n.transaction_id is null
   or (o.customer_id, o.amount, o."timestamp", o.merchant)
      is distinct from (n.customer_id, n.amount, n."timestamp", n.merchant)"""


@_query("versioned_diff", _with(_B, _FIRST, _SOURCE) + _DIFF)
def _(spark, sf):
    table = _versioned(spark, daily.keep_first(dirty_tx(spark, sf)), by_month=True)
    table.delete(F.col("amount") < 0)
    table.merge(_merge_source(spark, sf), ["transaction_id"])
    return table.diff(0, 2, ["transaction_id"]).select("transaction_id", "change", "old_amount", "new_amount")


@_query("digest_diff", _with(_B, _FIRST, _SOURCE) + _DIFF)
def _(spark, sf):
    """The same changes, found by digests of days and id buckets and a join within those that differ."""
    before = daily.keep_first(dirty_tx(spark, sf))
    after = dml.apply_merge(dml.apply_delete(before, F.col("amount") < 0), _merge_source(spark, sf), ["transaction_id"])
    place = {"day": F.to_date("timestamp"), "bucket": digests.key_bucket(["transaction_id"], 4)}
    found = digests.diff(before, after, ["transaction_id"], place)
    return found.select("transaction_id", "change", "old_amount", "new_amount")


@_query(
    "digest_differing_leaves",
    TX
    + """
select distinct "timestamp"::date as day, ('0x' || substr(md5(transaction_id), 1, 8))::bigint % 16 as bucket
from dirty_tx where customer_id = 'C00003'""",
)
def _(spark, sf):
    """The days and id buckets that an update of one customer touched."""
    raw = dirty_tx(spark, sf)
    changed = dml.apply_update(raw, F.col("customer_id") == "C00003", {"merchant": F.lit("MOVED")})
    place = {"day": F.to_date("timestamp"), "bucket": digests.key_bucket(["transaction_id"], 16).cast("bigint")}
    return digests.differing(digests.leaves(raw, place), digests.leaves(changed, place), list(place))


@_query(
    "update_rewrites_one_bucket",
    TX
    + """
select (select count(*) from dirty_tx where transaction_id = (select max(transaction_id) from dirty_tx))::bigint as rows_updated,
       16::bigint as folders, 1::bigint as folders_rewritten""",
)
def _(spark, sf):
    """A change of one id in raw transactions as they are stored by default."""
    raw = dirty_tx(spark, sf)
    table = VersionedTable(spark, storage.fresh_dir(spark, "raw"), raw_layout(), sort_by=["transaction_id"])
    table.overwrite(raw)
    folders = lambda: {f.rsplit("/", 1)[0] for f in table.read().inputFiles()}
    before, one = folders(), raw.agg(F.max("transaction_id")).first()[0]
    table.update(F.col("transaction_id") == one, {"amount": fx.scaled(F.col("amount"))})
    updated = F.col("operationMetrics")["numUpdatedRows"].cast("bigint").alias("rows_updated")
    counts = [F.lit(n).cast("bigint").alias(c) for c, n in (("folders", len(before)), ("folders_rewritten", len(before - folders())))]
    return table.history().limit(1).select(updated, *counts)


@_query(
    "versioned_diff_rows",
    TX
    + """
select transaction_id, customer_id, amount, "timestamp", merchant, 'removed' as change, count(*)::bigint as copies
from dirty_tx where amount < 0 group by all""",
)
def _(spark, sf):
    table = _versioned(spark, dirty_tx(spark, sf), by_month=True)
    table.delete(F.col("amount") < 0)
    return table.diff(0, 1)


@_query(
    "history_projection",
    _with(_B, _SOURCE)
    + """
select 0::bigint as version, 'WRITE' as operation, (select count(*) from dirty_tx)::bigint as rows_changed
union all
select 1, 'UPDATE', (select count(*) from dirty_tx where customer_id = 'C00001')
union all
select 2, 'DELETE', (select count(*) from dirty_tx where amount < 0)
union all
select 3, 'MERGE', (select count(*) from dirty_tx t where not coalesce(amount < 0, false) and exists (
                      select 1 from source s where s.transaction_id = t.transaction_id))
                 + (select count(*) from source s where not exists (
                      select 1 from dirty_tx t where s.transaction_id = t.transaction_id
                                                 and not coalesce(amount < 0, false)))""",
)
def _(spark, sf):
    table = _versioned(spark, dirty_tx(spark, sf))
    table.update(F.col("customer_id") == "C00001", {"amount": fx.scaled(F.col("amount"))})
    table.delete(F.col("amount") < 0)
    table.merge(_merge_source(spark, sf), ["transaction_id"])
    changed = ["numUpdatedRows", "numDeletedRows", "numTargetRowsUpdated", "numTargetRowsInserted"]
    metric = lambda name: F.coalesce(F.col("operationMetrics")[name].cast("bigint"), F.lit(0))
    rows = sum((metric(name) for name in changed), metric("numOutputRows"))
    return table.history().select("version", "operation", rows.alias("rows_changed"))


# -- quality -------------------------------------------------------------------


@_query(
    "quality_gate_status",
    TOTALS
    + """
select count(*)::bigint as row_count, 10::bigint as minimum,
       case when count(*) >= 10 then 'pass' else 'fail' end as status
from totals""",
)
def _(spark, sf):
    return quality.gate_status(daily.transform(dirty_tx(spark, sf)), 10)


@_query(
    "reconcile_batch",
    _with(_B, _BASE_BATCH, _FIRST, _TOTALS)
    + """
select count(*)::bigint as batch_rows,
       (count(*) filter (where u.customer_id is null))::bigint as missing_keys,
       (count(*) filter (where u.customer_id is not null and (t.daily_total, t.transaction_count)
          is distinct from (u.daily_total, u.transaction_count)))::bigint as differing_values
from totals t left join batch u using (customer_id, transaction_date)""",
)
def _(spark, sf):
    batch = daily.transform(dirty_tx(spark, sf))
    stored = _totals_table(spark, _totals_of(copies(spark, sf)))
    return quality.reconcile(batch, stored.read(), stored.keys)


@_query(
    "stage_counts",
    TOTALS
    + """
select r.n as raw_rows, 0::bigint as quarantined_rows, d.n as deduplicated_rows, v.n as valid_rows,
       a.n as aggregated_rows, r.n - d.n as removed_by_dedup, d.n - v.n as removed_by_filter
from (select count(*)::bigint as n from dirty_tx) r, (select count(*)::bigint as n from first_tx) d,
     (select count(*)::bigint as n from first_tx where amount > 0) v, (select count(*)::bigint as n from totals) a""",
)
def _(spark, sf):
    return daily.stage_counts(daily.rollup_with_counts(dirty_tx(spark, sf)))


@_query(
    "audit_duplicate_ids",
    TX + "select transaction_id, count(*)::bigint as copies from dirty_tx group by 1 having count(*) > 1",
)
def _(spark, sf):
    return duplicate_keys(dirty_tx(spark, sf), ["transaction_id"])


@_query(
    "audit_amount_profile",
    TX
    + """
select count(*)::bigint as total_rows, count(distinct transaction_id)::bigint as distinct_ids,
       (count(*) - count(distinct transaction_id))::bigint as duplicate_rows,
       (count(*) filter (where amount > 0))::bigint as positive_rows,
       (count(*) filter (where amount = 0))::bigint as zero_rows,
       (count(*) filter (where amount < 0))::bigint as negative_rows,
       (count(*) filter (where amount is null))::bigint as missing_rows,
       0::bigint as future_rows
from dirty_tx""",
)
def _(spark, sf):
    return quality.profile_amounts(dirty_tx(spark, sf))


@_query(
    "audit_sketched_periods",
    TX
    + """
select month, sum(n)::bigint as total_rows, sum(positive)::bigint as positive_rows, sum(zero)::bigint as zero_rows,
       sum(negative)::bigint as negative_rows, sum(missing)::bigint as missing_rows,
       max(case when merchant is not null then n end)::bigint as most_frequent_rows,
       true as distinct_within_bound, true as median_within_bound
from (select date_trunc('month', "timestamp")::date as month, merchant, count(*) as n,
             count(*) filter (where amount > 0) as positive, count(*) filter (where amount = 0) as zero,
             count(*) filter (where amount < 0) as negative, count(*) filter (where amount is null) as missing
      from dirty_tx group by 1, 2)
group by month""",
)
def _(spark, sf):
    """Months put together from stored day summaries of two batches; estimates are held against the exact ones."""
    store = sketches.SketchStore(spark, storage.fresh_dir(spark, "sketches"), item="merchant")
    store.add("originals", originals(spark, sf))
    store.add("copies", copies(spark, sf))
    month = F.trunc("day", "month").alias("month")
    found = sketches.sketched_profile(sketches.merge_sketches(store.days(), month), {"median": 0.5}, top=1)
    rows = dirty_tx(spark, sf).withColumn("month", F.trunc(F.to_date("timestamp"), "month"))
    once = rows.groupBy("month", "transaction_id").agg(F.count(F.lit(1)).alias("n"))
    distinct = once.groupBy("month").agg(F.count("transaction_id").alias("ids"))
    placed = rows.join(found.select("month", "median"), "month").groupBy("month").agg(
        F.count("amount").alias("n"), F.count_if(F.col("amount") < F.col("median")).alias("below"),
        F.count_if(F.col("amount") <= F.col("median")).alias("upto"),
    )
    near = (F.col("below") - 0.02 * F.col("n") <= 0.5 * F.col("n")) & (F.col("upto") + 0.02 * F.col("n") >= 0.5 * F.col("n"))
    return found.join(distinct, "month").join(placed, "month").select(
        "month",
        *sketches.COUNTERS,
        F.get("frequent", F.lit(0))["count"].alias("most_frequent_rows"),
        (F.abs(F.col("distinct_ids") - F.col("ids")) <= 0.04 * F.col("ids")).alias("distinct_within_bound"),
        near.alias("median_within_bound"),
    )


# -- fixture and incremental run -----------------------------------------------


@_query("dirty_events", TX + "select * from dirty_tx")
def _(spark, sf):
    return dirty_tx(spark, sf)


def _sql_draw(salt: str, quarter: int, bound: str, row: str = "row_no") -> str:
    return f"(('0x' || substr(md5('42:' || {row} || ':{salt}'), {8 * quarter + 1}, 8))::bigint % {bound})"


def _sql_time(salt: str) -> str:
    draws = [_sql_draw(salt, k, bound) for k, bound in enumerate(("61", "24", "60", "60"))]
    units = zip(("days", "hours", "minutes", "seconds"), draws, strict=True)
    return "timestamp '2024-02-01 00:00:00'" + "".join(f" - to_{unit}({draw}::int)" for unit, draw in units)


_GENERATED = f"""
  numbers as (select event_id as row_no, md5('42:' || event_id) as d from events),
  generated as (
    select row_no, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-' || substr(d, 13, 4) || '-' || substr(d, 17, 4) || '-'
             || substr(d, 21, 12) as transaction_id,
           'C' || lpad(({_sql_draw("draw", 0, "80")} + 1)::varchar, 5, '0') as customer_id,
           (({_sql_draw("draw", 1, "199901")} + 100)::decimal(18,2) / 100)::decimal(18,2) as amount,
           {_sql_time("time")} as "timestamp",
           case when {_sql_draw("draw", 2, "30")} < 25 then 'STORE_' || ({_sql_draw("draw", 2, "30")} + 1)
                else ['ONLINE_SHOP', 'GAS_STATION', 'SUPERMARKET', 'PHARMACY', 'RESTAURANT'][{_sql_draw("draw", 2, "30")} - 24]
           end as merchant
    from numbers)"""

_ISSUES = f"""
  sizes as (select n, greatest(1, n // 20) as copies, greatest(1, n // 33) as zeros, greatest(1, n // 50) as negatives
            from (select count(*) as n from events)),
  steps as (select *, least(n + copies, zeros + negatives) as spoiled, greatest(1, n // copies) as step from sizes),
  doubled as (
    select * from generated
    union all
    select n + row_no // step, transaction_id, customer_id, amount, {_sql_time("again")}, merchant
    from generated, steps where row_no % step = step - 1 and row_no // step < copies),
  placed as (select *, greatest(1, (n + copies) // spoiled) as pace from doubled, steps),
  spoilt as (select *, row_no % pace = pace - 1 and row_no // pace < spoiled as hit, row_no // pace as k from placed),
  issues as (
    select transaction_id, customer_id,
           (case when hit and ((k + 1) * zeros) // spoiled > (k * zeros) // spoiled then 0
                 when hit then -({_sql_draw("refund", 0, "50000")} + 1)::decimal(18,2) / 100 else amount end)::decimal(18,2) as amount,
           "timestamp", merchant
    from spoilt)"""

_GENERATED_AT = datetime(2024, 2, 1)


def _generated(spark: SparkSession, sf: str) -> DataFrame:
    """A transaction for each event, numbered by its id."""
    return generate.transactions(load(spark, sf, "events").select(F.col("event_id").alias("row_no")), _GENERATED_AT)


def _local_time(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@_query("generated_transactions", _with(_GENERATED) + "select * from generated")
def _(spark, sf):
    return _local_time(_generated(spark, sf))


@_query("injected_issues", _with(_GENERATED, _ISSUES) + "select * from issues")
def _(spark, sf):
    """Copies at other times, zeros and negative amounts among the generated transactions, in exact numbers."""
    return _local_time(generate.inject_issues(_generated(spark, sf), load(spark, sf, "events").count(), _GENERATED_AT))


@_query(
    "generated_totals",
    f"""
select 'C' || lpad((row_no // 7 + 1)::varchar, 5, '0') as customer_id,
       date '2024-02-01' - (row_no % 7)::int as transaction_date,
       (({_sql_draw("total", 0, "145001")} + 5000)::decimal(18,2) / 100)::decimal(18,2) as daily_total,
       1::bigint as transaction_count
from range((select count(distinct user_id) * 7 from events)) t(row_no)""",
)
def _(spark, sf):
    """A week of totals for as many customers as the events have users."""
    customers = load(spark, sf, "events").select(F.count_distinct("user_id")).first()[0]
    return generate.generate_daily_totals(spark, _GENERATED_AT.date(), customers=customers)


@_query("incremental_equals_full", TOTALS + "select * from totals")
def _(spark, sf):
    """Copies and most originals first; the purchases arrive late, and are the earlier copies."""
    root = storage.fresh_dir(spark, "incremental")
    config = FlowConfig(source="", target=f"{root}/totals", survivors=f"{root}/survivors", min_result_rows=1)
    late = F.col("merchant") == "purchase"
    early = originals(spark, sf).filter(~late).unionByName(copies(spark, sf))
    run_incremental(spark, early, config, "first")
    run_incremental(spark, originals(spark, sf).filter(late), config, "second")
    return KeyedTable.daily_totals(spark, config.target).read()


def _resumed(spark: SparkSession, sf: str, halfway: bool) -> DataFrame:
    root = storage.fresh_dir(spark, "resumed")
    config = FlowConfig(source="", target=f"{root}/totals", survivors=f"{root}/survivors", min_result_rows=1)
    late = F.col("merchant") == "purchase"
    a = originals(spark, sf).filter(~late).unionByName(copies(spark, sf))
    stage_batch(spark, a, config, "a")
    if halfway:
        store = survivor_table(spark, config.survivors)
        store.append(spark.read.parquet(f"{config.survivors}/_stage/a/changes"), "a")
    run_incremental(spark, originals(spark, sf).filter(late), config, "b")
    run_incremental(spark, a, config, "a")
    return KeyedTable.daily_totals(spark, config.target).read()


@_query("incremental_resume_after_other_batch", TOTALS + "select * from totals")
def _(spark, sf):
    """A batch is staged and not applied, another one runs, and the first is called again."""
    return _resumed(spark, sf, False)


@_query("incremental_resume_between_commits", TOTALS + "select * from totals")
def _(spark, sf):
    """As above, but the survivors of the first batch are stored and its totals are not."""
    return _resumed(spark, sf, True)


_ONE_ID = """
  one_id as (
    select * from dirty_tx
    union all
    select max(transaction_id), max_by(customer_id, transaction_id), 12.5::decimal(18,2),
           timestamp '2020-02-29 12:00:00', 'KIOSK' from dirty_tx where merchant = 'purchase')"""


@_query(
    "incremental_one_id",
    _with(_B, _ONE_ID, _FIRST.replace("dirty_tx", "one_id"), _TOTALS) + "select * from totals",
)
def _(spark, sf):
    """All rows, then a batch of a single id: an earlier copy, which takes the amount to another day."""
    root = storage.fresh_dir(spark, "incremental")
    config = FlowConfig(source="", target=f"{root}/totals", survivors=f"{root}/survivors", min_result_rows=1)
    raw = dirty_tx(spark, sf)
    run_incremental(spark, raw, config, "all")
    early = raw.filter("merchant = 'purchase'").agg(
        F.max("transaction_id").alias("transaction_id"),
        F.max_by("customer_id", "transaction_id").alias("customer_id"),
        F.lit("12.50").cast(MONEY).alias("amount"),
        F.to_timestamp(F.lit("2020-02-29 12:00:00")).alias("timestamp"),
        F.lit("KIOSK").alias("merchant"),
    )
    run_incremental(spark, early, config, "one")
    return KeyedTable.daily_totals(spark, config.target).read()


@_query("stream_equals_batch", TOTALS + "select * from totals")
def _(spark, sf):
    """Copies, most originals and the late purchases as three arriving files of a stateful stream, then its close."""
    root = storage.fresh_dir(spark, "stream")
    config = StreamConfig(f"{root}/in", f"{root}/out", delay="60 days")
    late = F.col("merchant") == "purchase"
    for part in (copies(spark, sf), originals(spark, sf).filter(~late), originals(spark, sf).filter(late)):
        conform(part, RAW_TRANSACTIONS).write.mode("append").parquet(config.source)
        run_available(spark, config)
    latest = dirty_tx(spark, sf).agg(F.max(F.col("timestamp").cast("timestamp"))).first()[0]
    run_available(spark, config, close_at=latest + timedelta(days=120))
    return totals(spark, config)


_VALID_FIRST = """
  valid_first as (
    select transaction_id, customer_id, amount, "timestamp", merchant
    from (select *, row_number() over (partition by transaction_id
                                       order by "timestamp", customer_id, amount, merchant) as rn
          from dirty_tx where amount > 0)
    where rn = 1),
  valid_first_totals as (
    select customer_id, "timestamp"::date as transaction_date,
           sum(amount)::decimal(18,2) as daily_total, count(*)::bigint as transaction_count
    from valid_first group by all)"""


@_query("incremental_validate_first", _with(_B, _VALID_FIRST) + "select * from valid_first_totals")
def _(spark, sf):
    root = storage.fresh_dir(spark, "incremental")
    config = FlowConfig("", f"{root}/totals", f"{root}/survivors", min_result_rows=1, validate_first=True)
    run_incremental(spark, originals(spark, sf), config, "first")
    run_incremental(spark, copies(spark, sf), config, "second")
    return KeyedTable.daily_totals(spark, config.target).read()


def _daily(spark: SparkSession, sf: str, validate_first: bool) -> tuple[DataFrame, str]:
    """A full run over a stored source; the report and the folder of what was left out."""
    root = storage.fresh_dir(spark, "daily")
    dirty_tx(spark, sf).write.parquet(f"{root}/source")
    config = FlowConfig(f"{root}/source", f"{root}/totals", quarantine=f"{root}/left-out", validate_first=validate_first)
    return run_daily(spark, config, run_id="r"), f"{root}/left-out/run=r"


@_query(
    "run_daily_report",
    TOTALS
    + """
select r.n as source_rows, 0::bigint as quarantined_rows, d.n as deduplicated_rows, v.n as valid_rows,
       a.n as batch_keys, a.n as table_rows, 'pass' as status
from (select count(*)::bigint as n from dirty_tx) r, (select count(*)::bigint as n from first_tx) d,
     (select count(*)::bigint as n from first_tx where amount > 0) v, (select count(*)::bigint as n from totals) a""",
)
def _(spark, sf):
    return _daily(spark, sf, False)[0].drop("run_id", "finished_at", "table_version")


_LEFT_OUT = """
select transaction_id, customer_id, amount, "timestamp", merchant,
       case when amount is null then 'null_amount' when amount = 0 then 'zero_amount' else 'negative_amount' end
         as reject_reason
from first_tx f where not coalesce(amount > 0, false)"""


def _left_out(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@_query("run_daily_quarantine", FIRST + _LEFT_OUT)
def _(spark, sf):
    return _left_out(spark, _daily(spark, sf, False)[1])


@_query(
    "run_daily_quarantine_validate_first",
    FIRST
    + _LEFT_OUT
    + """
  and not exists (select 1 from dirty_tx t where t.transaction_id = f.transaction_id and t.amount > 0)""",
)
def _(spark, sf):
    return _left_out(spark, _daily(spark, sf, True)[1])


@_query(
    "quarantined_by_reason",
    FIRST + "select reject_reason, count(*)::bigint as row_count from (" + _LEFT_OUT + ") group by 1",
)
def _(spark, sf):
    left_out = quarantined(conform(dirty_tx(spark, sf), RAW_TRANSACTIONS))
    return left_out.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("row_count"))


@_query("csv_round_trip", TX + "select * from dirty_tx")
def _(spark, sf):
    """The fixture as CSV files and back; a refused row would be missing."""
    path = storage.fresh_dir(spark, "csv")
    files.write_csv(conform(dirty_tx(spark, sf), RAW_TRANSACTIONS), path)
    good, _ = files.read_transactions_csv(spark, path)
    return good.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@_query(
    "csv_multiline_round_trip",
    TX
    + """
select transaction_id, customer_id, amount, "timestamp",
       case when transaction_id like '%7' then merchant || chr(10) || ',"second" line' || chr(13) || chr(10) || chr(10) || ' end '
            when transaction_id like '%8' then '"' || merchant else merchant end as merchant
from dirty_tx""",
)
def _(spark, sf):
    """As above, with line breaks, commas, quotes and blanks inside the texts."""
    name, last = F.col("merchant"), F.substring("transaction_id", -1, 1)
    odd = F.when(last == "7", F.concat(name, F.lit('\n,"second" line\r\n\n end '))).when(last == "8", F.concat(F.lit('"'), name)).otherwise(name)
    path = storage.fresh_dir(spark, "csv")
    files.write_csv(conform(dirty_tx(spark, sf).withColumn("merchant", odd), RAW_TRANSACTIONS), path)
    good, _ = files.read_transactions_csv(spark, path)
    return good.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@_query(
    "csv_sample",
    FIRST + "select * from (select * from first_tx order by transaction_id limit 20)",
)
def _(spark, sf):
    """The sample file of the first 20 survivors, read back."""
    path = storage.fresh_dir(spark, "csv-sample")
    files.write_sample_csv(conform(daily_survivors(spark, sf), RAW_TRANSACTIONS), path)
    good, _ = files.read_transactions_csv(spark, path)
    return good.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def daily_survivors(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe(dirty_tx(spark, sf), ["transaction_id"], ROW_ORDER)


@_query(
    "gate_source_empty",
    TX + "select count(*)::bigint as row_count, 1::bigint as minimum, 'fail' as status from dirty_tx where amount > 1e12",
)
def _(spark, sf):
    return quality.gate_status(dirty_tx(spark, sf).filter("amount > 1e12"), 1)


@_query(
    "gate_few_rows",
    TOTALS
    + """
select count(*)::bigint as row_count, 1000000000::bigint as minimum,
       case when count(*) >= 1000000000 then 'pass' else 'fail' end as status
from totals""",
)
def _(spark, sf):
    return quality.gate_status(daily.transform(dirty_tx(spark, sf)), 1_000_000_000)


@_query(
    "keyed_sample",
    TOTALS + "select * from (select * from totals order by customer_id, transaction_date limit 10)",
)
def _(spark, sf):
    return _stored_totals(spark, sf).sample(10)


@_query(
    "parse_timestamps",
    TX
    + """
select transaction_id, case when merchant = 'purchase' then null else "timestamp" - interval 90 minutes end as parsed
from dirty_tx""",
)
def _(spark, sf):
    """Times written with an offset, and text that is no time."""
    text = F.when(F.col("merchant") == "purchase", "no time").otherwise(
        F.concat(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+01:30"))
    )
    return dirty_tx(spark, sf).select("transaction_id", fx.parse_ts(text).cast("timestamp_ntz").alias("parsed"))


@_query(
    "daily_totals_float_load",
    TOTALS + "select customer_id, transaction_date, daily_total::float as daily_total, transaction_count from totals",
)
def _(spark, sf):
    """Exact totals in a table of the 32-bit layout."""
    table = KeyedTable.daily_totals(spark, storage.fresh_dir(spark, "daily-totals"), DAILY_TOTALS_FLOAT)
    table.upsert(daily.transform(dirty_tx(spark, sf)))
    return table.read()


@_query(
    "audit_range_violations",
    TX
    + """
select transaction_id, amount from dirty_tx
where not coalesce(amount > 0, false) or "timestamp" > timestamp '2024-01-20 00:00:00'""",
)
def _(spark, sf):
    """Rows that are not positive, or lie after a stated moment."""
    return quality.range_violations(dirty_tx(spark, sf), datetime(2024, 1, 20)).select("transaction_id", "amount")
