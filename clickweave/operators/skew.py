"""Hot keys: find the groups too large for one task, split them off and lay them out in chunks.

The list of hot keys is bounded by construction: a key is hot when it has
more than ``threshold`` rows, so there are at most ``rows / threshold`` of
them.  The list is counted: up to ``max_hot_keys`` it is broadcast, a longer
one is joined by shuffle.  Rows with a NULL key belong to no group; they are
split off, so they never meet in one task.

The rows of hot keys are cut into chunks: (key, range of the row order), about
``CHUNK_ROWS`` rows each whatever their times, so a key whose rows all share
one instant is split as well.  ``chunked`` deals them by range and then by
(key, chunk); after that, windows and aggregates by (key, chunk, ...) need no
shuffle of rows, and ``chunk_join_back`` brings a table grouped by (key, ...)
to the rows by way of the keys that each chunk holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.session import write_table

DEFAULT_HOT_ROWS = 2_000_000
MAX_HOT_KEYS = 200_000
#: Rows of one chunk of a hot key.
CHUNK_ROWS = 250_000
CHUNK = "__chunk"


@dataclass
class HotSplit:
    """Rows of ordinary keys, of hot keys and without a key, and the hot key list."""

    normal: DataFrame
    hot: DataFrame
    unkeyed: DataFrame
    keys: DataFrame
    n_hot: int
    small: bool
    hot_rows: int


def hot_keys(df: DataFrame, key: Sequence[str], threshold: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Keys with more than ``threshold`` rows (NULL keys excluded).

    A grouped count: partial aggregation runs before the shuffle, so even a
    key holding a third of all rows costs one counter per map task.
    """
    key = list(key)
    return _hot_counts(df, key, threshold).select(*key)


def _hot_counts(df: DataFrame, key: Sequence[str], threshold: int) -> DataFrame:
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__rows"))
    cond = F.col("__rows") > F.lit(threshold)
    for k in key:
        cond = cond & F.col(k).isNotNull()
    return counts.filter(cond)


def split_hot(
    df: DataFrame,
    key: Sequence[str],
    threshold: int = DEFAULT_HOT_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> HotSplit:
    """Split ``df`` into rows of ordinary keys, of hot keys, and with a NULL key part.

    The hot list is counted (a small job over a pre-aggregated table).  When
    there is no hot key the ``hot`` frame is empty and the caller can skip
    its plan.
    """
    key = list(key)
    real = F.lit(True)
    for k in key:
        real = real & F.col(k).isNotNull()
    keys = write_table(_hot_counts(df, key, threshold), "hot-keys")
    n_hot, hot_rows = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("__rows"), F.lit(0))).first()
    keys = keys.select(*key)
    small = n_hot <= max_hot_keys
    listed = F.broadcast(keys) if small else keys
    rows = df.filter(real)
    return HotSplit(
        normal=rows.join(listed, key, "left_anti") if n_hot else rows,
        hot=rows.join(listed, key, "left_semi"),
        unkeyed=df.filter(~real),
        keys=keys,
        n_hot=n_hot,
        small=small,
        hot_rows=hot_rows,
    )


def chunk_count(rows: int, chunk_rows: int = CHUNK_ROWS) -> int:
    return max(1, -(-rows // chunk_rows))


def dealt_by(df: DataFrame, key: Sequence[str], rows: int, task_rows: int) -> DataFrame:
    """Rows dealt by ``key`` to about ``task_rows`` a partition, and no fewer partitions than cores.

    The number is given: left to itself, the shuffle is merged by the bytes of
    its narrow rows, and a task then holds more rows the more there are.
    """
    n = max(df.sparkSession.sparkContext.defaultParallelism, chunk_count(rows, task_rows))
    return df.repartition(n, *key)


def chunked(df: DataFrame, key: Sequence[str], order: Sequence[Column], rows: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``CHUNK``, a number that never decreases along (key, order): rows dealt by range, about ``chunk_rows`` each.

    Written, so that a lost executor cannot deal them anew.
    """
    n = chunk_count(rows, chunk_rows)
    return write_table(df.repartitionByRange(n, *key, *order).withColumn(CHUNK, F.spark_partition_id()), "chunks")


def chunk_join_back(df: DataFrame, base: DataFrame, table: DataFrame, keys: Sequence[str], layout: Sequence[str]) -> DataFrame:
    """Left join of a table that is unique on ``keys`` onto rows that lie by ``layout`` = (key..., ``CHUNK``).

    The keys each chunk holds (grouped where the rows of ``base`` lie, the
    persisted frame that ``df`` extends) take the table's rows and carry them
    to the chunk, so the wide rows stay in place.
    """
    by = list(dict.fromkeys([*layout, *keys]))
    held = base.select(*by).distinct()
    return df.join(held.join(table, list(keys), "left"), by, "left")
