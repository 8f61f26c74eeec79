"""Grouped aggregates joined back onto every row.

Every aggregate is a ``groupBy(...).agg(...)`` (partial aggregation before the
shuffle, so a hot key costs one partial row per map task) followed by a left
equi-join on the same keys.  Rows whose key has a NULL part find no group and
get NULL, as a grouped table has no such group.  When the input is already
hash-partitioned by a prefix of the keys (the per-user layout), the aggregate
and the join need no further shuffle
(``spark.sql.requireAllClusterKeysForCoPartition=false``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.dates import micros_to_seconds

STATS = ("min", "max", "mean", "std")


def join_back(df: DataFrame, table: DataFrame, keys: Sequence[str], right_keys: Sequence[str] | None = None) -> DataFrame:
    """Left join of a table that is unique on its keys (row count kept).

    ``right_keys`` renames the table's keys first (a join of differently named
    keys, e.g. impression date against log date), so no duplicate columns
    arise.  The table of a partition is hashed there and the rows stream past
    it, so no join sorts the wide rows.
    """
    keys = list(keys)
    if right_keys is not None:
        table = table.withColumnsRenamed(dict(zip(right_keys, keys)))
    return df.join(table.hint("shuffle_hash"), keys, "left")


def stat_columns(value: str | Column, prefix: str, seconds: bool = True) -> list[Column]:
    """min / max / mean / sample std of ``value`` named ``{prefix}_{stat}``.

    NULLs are skipped; std is NULL below two values.  With ``seconds`` the
    value is in integer microseconds and the results are seconds.
    """
    v = F.col(value) if isinstance(value, str) else value
    conv = micros_to_seconds if seconds else (lambda c: c)
    return [
        conv(F.min(v)).alias(f"{prefix}_min"),
        conv(F.max(v)).alias(f"{prefix}_max"),
        conv(F.avg(v)).alias(f"{prefix}_mean"),
        conv(F.stddev_samp(v)).alias(f"{prefix}_std"),
    ]


def count_rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def count_distinct(value: str, name: str, bounded: bool = False) -> Column:
    """Distinct non-NULL values.

    ``bounded``: the value is a small integer in 0..63 (hour, weekday, week,
    day, minute, month flags).  Then the count is the number of set bits of
    a 64-bit mask ``bit_or(1 << value)``: a fixed-width buffer, so the plan
    stays a hash aggregate with partial aggregation and no row expansion
    (a per-group set would fall back to sort-based aggregation).  Any other
    value is an error, so nothing is dropped from the count in silence.
    """
    if bounded:
        v = F.col(value)
        outside = F.raise_error(F.concat(F.lit(f"{value} is outside 0..63: "), v.cast("string"))).cast("bigint")
        bit = F.when(v.isNull(), F.lit(None).cast("bigint")).when(
            v.between(0, 63), F.expr(f"shiftleft(cast(1 as bigint), cast(`{value}` as int))")).otherwise(outside)
        return F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0)).cast("bigint").alias(name)
    return F.count_distinct(F.col(value)).alias(name)


def mode_table(df: DataFrame, group: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """Most frequent non-NULL ``value`` per group, smallest value on ties.

    Two grouped aggregates, both partially aggregated before their shuffle:
    counts per (group, value), then per group the minimum of
    ``(-count, value)``.  No group is ever collected into one list.
    """
    group = list(group)
    name = name or value
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    best = counts.groupBy(*group).agg(F.min(F.struct((-F.col("__n")).alias("n"), F.col(value).alias("v"))).alias("__m"))
    return best.select(*group, F.col("__m.v").alias(name))


def _long_values(df: DataFrame, group: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """One narrow record (group, __i, typed slots) per row and column, NULL values included.

    One slot per value type, so values are counted and compared in their own
    type.  Returns the records, all slots, and the slot of each column."""
    types = dict(df.dtypes)
    kinds = sorted({types[c] for c in columns})
    slots = [f"__v{i}" for i in range(len(kinds))]
    entries = []
    for i, c in enumerate(columns):
        values = [(F.col(c) if types[c] == kind else F.lit(None).cast(kind)).alias(slot) for kind, slot in zip(kinds, slots)]
        entries.append(F.struct(F.lit(i).alias("__i"), *values))
    long = df.select(*group, F.explode(F.array(*entries)).alias("__e")).select(*group, "__e.*")
    return long, slots, [slots[kinds.index(types[c])] for c in columns]


def distinct_counts_table(df: DataFrame, group: Sequence[str], columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Exact distinct non-NULL values of several columns per group: ``columns`` = [(source, output)].

    Several ``count(distinct)`` in one aggregate repeat every wide row once per
    column.  Here only the group and the values are repeated; equal (group,
    column, value) records meet in a grouped aggregate, partially before any
    shuffle, and the rest is a conditional count.  A group whose values are all
    NULL has 0; a NULL in the group keys is a group of its own, as in
    ``groupBy``.
    """
    group = list(group)
    long, slots, slot_of = _long_values(df, group, [src for src, _ in columns])
    seen = long.groupBy(*group, "__i", *slots).agg(F.lit(1).alias("__one"))
    return seen.groupBy(*group).agg(*[
        F.count(F.when(F.col("__i") == i, F.col(slot_of[i]))).alias(name) for i, (_, name) in enumerate(columns)])


def modes_table(df: DataFrame, group: Sequence[str], columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Modes of several columns at once: ``columns`` = [(source, output)].

    Each row is expanded to one record per column; then one grouped count per
    (group, column, value), and one grouped minimum of (-count, value) per
    group and column.  Same rule as ``mode_table``: most frequent non-NULL
    value, smallest on ties; NULL when a column has no value in the group.
    """
    group = list(group)
    long, slots, slot_of = _long_values(df, group, [src for src, _ in columns])
    filled = long.filter(" or ".join(f"{s} is not null" for s in slots))
    counts = filled.groupBy(*group, "__i", *slots).agg(F.count(F.lit(1)).alias("__n"))
    best = counts.groupBy(*group).agg(*[
        F.min(F.when(F.col("__i") == i, F.struct((-F.col("__n")).alias("n"), F.col(slot_of[i]).alias("v")))).alias(f"__m{i}")
        for i in range(len(columns))])
    return best.select(*group, *[F.col(f"__m{i}.v").alias(name) for i, (_, name) in enumerate(columns)])
