"""Fold tables (M1, K1, K2).

A fold list is a handful of values (dates, years); it becomes a tiny
DataFrame that is broadcast.  Nothing loops over folds on the driver: per-fold
sizes come from one grouped count and window totals over that small table.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def fold_table(spark: SparkSession, folds: Sequence[Any], fold_type: str, name: str = "fold") -> DataFrame:
    """Listed folds with their 0-based index ``fold_idx`` (D rows)."""
    rows = [(f, i) for i, f in enumerate(folds)]
    return spark.createDataFrame(rows, f"{name} {fold_type}, fold_idx int")


def fold_sizes(train: DataFrame, fold: str, label: str, folds: DataFrame) -> DataFrame:
    """Per listed fold: rows and positives held out, rows and positives kept
    for fitting (all train rows on other folds, listed or not)."""
    per = train.groupBy(fold).agg(
        F.count(F.lit(1)).alias("n_fold"), F.sum(F.col(label).cast("bigint")).alias("pos_fold")
    )
    everything = Window.partitionBy()
    per = per.select(
        fold,
        "n_fold",
        "pos_fold",
        F.sum("n_fold").over(everything).alias("n_all"),
        F.sum("pos_fold").over(everything).alias("pos_all"),
    )
    joined = folds.join(per, fold, "left")
    # folds without rows still need the totals: take them from any row
    filled = joined.withColumn("n_all", F.max("n_all").over(everything)).withColumn(
        "pos_all", F.max("pos_all").over(everything)
    )
    return filled.select(
        fold,
        F.coalesce("n_fold", F.lit(0)).cast("bigint").alias("n_valid"),
        F.coalesce("pos_fold", F.lit(0)).cast("bigint").alias("pos_valid"),
        (F.coalesce("n_all", F.lit(0)) - F.coalesce("n_fold", F.lit(0))).cast("bigint").alias("n_fit"),
        (F.coalesce("pos_all", F.lit(0)) - F.coalesce("pos_fold", F.lit(0))).cast("bigint").alias("pos_fit"),
    )


def timeseries_split_sizes(train: DataFrame, fold: str, label: str, folds: DataFrame) -> DataFrame:
    """Expanding-window split (K2): fit on rows with fold < d, hold out d."""
    per = train.groupBy(fold).agg(
        F.count(F.lit(1)).alias("n_fold"), F.sum(F.col(label).cast("bigint")).alias("pos_fold")
    )
    # listed folds without rows take their place in the order with zero counts
    empty = folds.join(per, fold, "left_anti").select(fold, F.lit(0).cast("bigint").alias("n_fold"), F.lit(0).cast("bigint").alias("pos_fold"))
    per = per.unionByName(empty)
    before = Window.orderBy(fold).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        fold,
        "n_fold",
        "pos_fold",
        F.coalesce(F.sum("n_fold").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("pos_fold").over(before), F.lit(0)).alias("pos_before"),
    )
    listed = folds.join(per, fold, "left")
    return listed.select(
        fold,
        F.coalesce("n_fold", F.lit(0)).cast("bigint").alias("n_valid"),
        F.coalesce("pos_fold", F.lit(0)).cast("bigint").alias("pos_valid"),
        F.col("n_before").cast("bigint").alias("n_fit"),
        F.col("pos_before").cast("bigint").alias("pos_fit"),
    )


def kfold_assign(df: DataFrame, id_col: str, k: int, label: str | None = None, seed: int = 42) -> DataFrame:
    """k-fold (K1).  Rows are put in the order of ``md5(seed:id)``, then id, and
    dealt round-robin; with ``label``, inside each label (NULL is a label of
    its own), so each fold gets every k-th row of each label.  Rows are ranked
    inside (label, digest prefix) buckets and shifted by the buckets' running
    offsets, one row per (label, bucket): never a whole label in one task."""
    by = [F.col(label)] if label else [F.lit(0)]
    staged = df.withColumn("__h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))))
    staged = staged.withColumns({"__b": F.coalesce(F.substring("__h", 1, 3), F.lit("")), "__l": by[0]})
    w_in = Window.partitionBy("__l", "__b").orderBy("__h", id_col)
    staged = staged.withColumn("__rn", F.row_number().over(w_in))
    counts = staged.groupBy("__l", "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__l").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__l").alias("__ol"), F.col("__b").alias("__ob"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    out = staged.join(offsets, F.col("__l").eqNullSafe(F.col("__ol")) & (F.col("__b") == F.col("__ob")))
    out = out.withColumn("fold", F.pmod(F.col("__off") + F.col("__rn") - 1, F.lit(k)).cast("int"))
    return out.select(*df.columns, "fold")
