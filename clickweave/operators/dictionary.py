"""Dictionary codes in order of first appearance.

Code = 0-based rank of a value's first row in the given total order; NULL
and values missing from the dictionary get -1.  (Frequency-ordered indexers
give other codes.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.session import write_table

MAX_BROADCAST_CODES = 1_000_000


def global_rank(df: DataFrame, order: Sequence[Column], out: str, name: str = "rank") -> DataFrame:
    """Add ``out``: the 0-based rank of every row in a total order (BIGINT), with no task that sees all rows.

    Rows are dealt into ranges of the order and written with their range
    number (so a lost executor cannot deal them anew); a range's rows are
    ranked where they lie and shifted by the rows of the ranges before it.
    Only one count per range passes the driver.
    """
    dealt = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    dealt = write_table(dealt, name)
    sizes = sorted((r["__range"], r["count"]) for r in dealt.groupBy("__range").count().collect())
    starts, total = [], 0
    for place, size in sizes:
        starts.append((place, total))
        total += size
    offsets = df.sparkSession.createDataFrame(starts, "__range int, __start bigint")
    within = Window.partitionBy("__range").orderBy(*order)
    ranked = dealt.withColumn(out, F.row_number().over(within)).join(F.broadcast(offsets), "__range", "left")
    return ranked.withColumn(out, F.col(out) + F.col("__start") - 1).drop("__range", "__start")


def first_seen_codes(df: DataFrame, value: str, order: Sequence[Column], code: str = "code") -> DataFrame:
    """(value, code) for every non-NULL value.

    The first row of each value is a grouped ``min(struct(order))`` (partial
    aggregation, one row per distinct value); the distinct values are ranked
    by ranges of their first rows (``global_rank``), so a domain that grows
    with the data (user agents, urls) needs no single task.  The table is
    written: readers share it without a cache.
    """
    firsts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.min(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("__first"))
    )
    ranked = global_rank(firsts, [F.col("__first")], code, "first-seen")
    return write_table(ranked.select(value, F.col(code).cast("int").alias(code)), "dictionary")


def encode_first_seen(
    df: DataFrame,
    value: str,
    order: Sequence[Column],
    out: str | None = None,
    codes: DataFrame | None = None,
) -> DataFrame:
    """Replace ``value`` (or add ``out``) by its first-seen code, -1 when
    missing.  ``codes`` may come from another table (train + test together).

    The dictionary is counted and broadcast when it has at most
    ``MAX_BROADCAST_CODES`` rows; a larger one is joined by a shuffle.
    """
    out = out or value
    codes = codes if codes is not None else first_seen_codes(df, value, order)
    codes = codes.withColumnRenamed("code", "__code")
    small = F.broadcast(codes) if codes.count() <= MAX_BROADCAST_CODES else codes
    joined = df.join(small, value, "left")
    coded = F.coalesce(F.col("__code"), F.lit(-1)).cast("int")
    if out == value:
        return joined.withColumn(value, coded).drop("__code").select(*df.columns)
    return joined.withColumn(out, coded).drop("__code")
