"""The daily mart's state, kept up from new orders alone.

A day's exact number of customers can't be added up from parts, but bitmaps
can be joined: a row for each (day, block of 32,768 customer numbers) has the
customers seen as bits, and one row a day has the sums. New orders are reduced
the same way and joined with the rows they touch; no day is read again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moraine.operators.gold import MONEY
from moraine.sources.versioned import BUCKET, VersionedTable, bucket_of

KEY = ["revenue_date", "block"]
#: The block of a day's sums; bitmaps have the block that Spark numbers.
SUMS = None


def _union(rows: DataFrame) -> DataFrame:
    """Rows of one key joined: sums added, bitmaps or-ed."""
    return rows.groupBy(*KEY).agg(
        F.bitmap_or_agg(F.coalesce("seen", F.lit(b""))).alias("seen"),
        *[F.sum(c).cast(kind).alias(c) for c, kind in (("order_count", "long"), ("priced", "long"), ("gross", "decimal(28,2)"), ("cancelled", "decimal(28,2)"), ("net", "decimal(28,2)"))],
    )


def reduced(orders: DataFrame) -> DataFrame:
    """Staged orders as state rows: one a day with sums, one for each day and block of customers with their bits."""
    day, total = F.col("order_date").alias("revenue_date"), F.col("total_amount")
    sums = orders.groupBy(day).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count("total_amount").alias("priced"),
        F.sum(total).cast("decimal(28,2)").alias("gross"),
        F.sum(F.when(F.col("status") == "cancelled", total).otherwise(0)).cast("decimal(28,2)").alias("cancelled"),
        F.sum(F.when(F.col("status") != "cancelled", total).otherwise(0)).cast("decimal(28,2)").alias("net"),
    )
    customer = F.col("customer_id").cast("long")
    bits = orders.filter("customer_id is not null").groupBy(day, F.bitmap_bucket_number(customer).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(customer)).alias("seen"))
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    left = sums.select("revenue_date", none("block", "long"), none("seen", "binary"), "order_count", "priced", "gross", "cancelled", "net")
    right = bits.select("revenue_date", "block", "seen", none("order_count", "long"), none("priced", "long"), none("gross", "decimal(28,2)"), none("cancelled", "decimal(28,2)"), none("net", "decimal(28,2)"))
    return left.unionByName(right)


def append(spark: SparkSession, path: str, orders: DataFrame, *, batch: tuple[str, int] | None = None, buckets: int = 16) -> bool:
    """Takes new staged orders into the state at ``path``; tells whether it did.

    Only buckets with the orders' (day, block) pairs are read and rewritten.
    ``batch`` (a stream and its batch number) that the state has seen already
    changes nothing. Orders that were changed or taken back can't be told
    from new ones: after such events the state is made anew.
    """
    store = VersionedTable(spark, path)
    new = reduced(orders).persist()
    try:
        if not store.exists():
            store.write(new, key=KEY, buckets=buckets, operation="append", batch=batch)
            return True
        last = store.commit()
        if batch is not None and batch[0] in last.applied and batch[1] <= last.applied[batch[0]]["batch"]:
            return False
        touched = sorted(r[0] for r in new.select(bucket_of(KEY, last.bucket_count).alias("b")).distinct().collect())  # at most as many numbers as buckets
        if not touched:
            return True
        both = _union(store.read(buckets=touched).unionByName(new))
        seen = F.when(F.col("block").isNotNull(), F.col("seen")).alias("seen")
        rows = both.select(*[seen if c == "seen" else F.col(c) for c in new.columns]).withColumn(BUCKET, bucket_of(KEY, last.bucket_count))
        store.write(rows, key=KEY, buckets=touched, operation="append", replace=False, batch=batch)
        return True
    finally:
        new.unpersist()


def revenue_daily_of(state: DataFrame, *, days: Column | None = None) -> DataFrame:
    """The mart from its state, of all days or those that ``days`` holds for."""
    rows = state if days is None else state.filter(days)
    customers = F.coalesce(F.sum(F.bitmap_count("seen")), F.lit(0)).cast("long")
    total = lambda c: F.sum(c).cast(MONEY)
    mean = F.round(F.sum("gross").cast("decimal(28,6)") / F.nullif(F.sum("priced"), F.lit(0)), 2).cast(MONEY)
    return rows.groupBy("revenue_date").agg(
        F.sum("order_count").alias("order_count"),
        customers.alias("unique_customers"),
        total("gross").alias("gross_revenue"),
        total("cancelled").alias("cancelled_revenue"),
        total("net").alias("net_revenue"),
        mean.alias("avg_order_value"),
    )


def rebuilt(spark: SparkSession, path: str, parts: list[DataFrame]) -> DataFrame:
    """The state at ``path`` after all parts, one append each."""
    reduce(lambda _, p: append(spark, path, p), parts, None)
    return VersionedTable(spark, path).read()
