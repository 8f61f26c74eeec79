"""Helpers shared by the operators: stage tables, hot-key safe joins, components."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.session import scratch_path

#: The characters that separate words and that text normalisation deletes (fixed values).
SEPARATORS = " \t\n\x0b\x0c\r"
#: Rows of one Arrow batch sent to Python; texts are long, so batches are short.
BATCH_ROWS = 1000


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers (once per application, as a zip that Spark
    distributes), and bound the Arrow batches of this session (in rows)."""
    if spark.sparkContext.applicationId not in _SHIPPED:
        import clickweave

        package = os.path.dirname(os.path.abspath(clickweave.__file__))
        at = os.path.join(tempfile.mkdtemp(), "clickweave-package")
        spark.sparkContext.addPyFile(shutil.make_archive(at, "zip", os.path.dirname(package), os.path.basename(package)))
        _SHIPPED.add(spark.sparkContext.applicationId)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a stage table into the shared checkpoint folder and read it back.

    It cuts lineage (a lost executor costs no recomputation of earlier
    stages), and a join of two written tables has its shuffles directly below
    it, so that adaptive execution can split hot keys.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                                       for c, f in zip(columns, schema, strict=True)], schema=schema)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit(""))


def without_separators(col: Column) -> Column:
    """Delete every separator character (plain byte replacement, no regular expression)."""
    return functools.reduce(lambda c, ch: F.replace(c, F.lit(ch), F.lit("")), SEPARATORS, col)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected long edges: (node, component = smallest node).

    Alternating star contraction as DataFrame joins: every node points to the
    smallest node it knows of; each round links the larger neighbours of a
    node to that smallest one (large star), then the smaller ones (small
    star).  Rounds are logarithmic in the longest path in practice.  The
    grouped minimum is pre-aggregated in each task and the joins are between
    written tables, so a hub with a third of all edges is split.  Each round
    is written to the shared folder.
    """
    pairs = edges.select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).filter("x <> y").distinct()
    pairs = written(pairs, "cc-edges")
    if pairs.isEmpty():
        return pairs.select(F.col("x").alias("node"), F.col("y").alias("component"))
    while True:
        both = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = written(both.groupBy(F.col("x").alias("v")).agg(F.min("y").alias("m"))
                        .select("v", F.least("v", "m").alias("m")), "cc-least")
        # large star: neighbours above v point to the smallest node around v
        large = pairs.select(F.col("y").alias("v"), F.col("x").alias("u")).join(least, "v").select(
            F.col("u").alias("x"), F.col("m").alias("y")).filter("x <> y")
        own = least.filter("v <> m").select(F.col("v").alias("x"), F.col("m").alias("y"))
        large = written(large.unionByName(own).distinct(), "cc-large")
        # small star: of the nodes below x, the smallest becomes the parent of x and of the others
        low = written(large.groupBy(F.col("x").alias("v")).agg(F.min("y").alias("m")), "cc-low")
        moved = large.select(F.col("x").alias("v"), F.col("y").alias("u")).join(low, "v").filter("u <> m").select(
            F.col("u").alias("x"), F.col("m").alias("y"))
        new = written(low.select(F.col("v").alias("x"), F.col("m").alias("y")).unionByName(moved).distinct(), "cc-edges")
        # done when the edges are stars: every node has one parent, and no parent has a parent
        extra = moved.isEmpty() and new.select(F.col("y").alias("x")).distinct().join(new, "x", "left_semi").isEmpty()
        pairs = new
        if extra:
            roots = pairs.select(F.col("y").alias("node")).distinct()
            return pairs.select(F.col("x").alias("node"), F.col("y").alias("component")).unionByName(
                roots.select("node", F.col("node").alias("component")))
