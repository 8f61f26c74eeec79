"""Exact deduplication by 128-bit content hash with byte comparison.

Rows are grouped by the 128-bit digest of the normalised text.  For digests
with two rows or more the normalised texts themselves are compared, byte by
byte, as grouping keys; a digest shared by different texts (a collision) is
split into one class per text.  Narrow rows (digest, id, length) carry the
grouping; texts move only for digests that occur more than once.

Defined results: a null text counts as empty; empty texts equal each other;
a null id is kept last; of equal texts the row with most code points, then
the smallest id, stays; rows repeated with the kept id and length all refer
to that id.  An empty table gives an empty result.  Other columns are not
read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import fresh_name, text_or_empty, without_separators, written

#: Digests that occur more than once are broadcast to the text scan up to this count (16 bytes each).
BROADCAST_DIGESTS = 1_000_000


def md5_digest(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  digest: Callable[[Column], Column] = md5_digest) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``digest`` maps the normalised text to the grouping hash; tests pass a
    weak one to force collisions.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t")).select(
        "doc_id", F.length("t").alias("n"), without_separators(F.col("t")).alias("norm"))
    source = source.withColumn("h", digest(F.col("norm")))
    rows = written(source.select("doc_id", "n", "h", F.sha2(F.col("norm"), 256).alias("sha")), "dedup-rows")

    repeated = written(rows.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h"), "dedup-repeated")
    few = repeated.count() <= BROADCAST_DIGESTS
    texts = source.join(F.broadcast(repeated) if few else repeated, "h", "left_semi").select("h", "norm").distinct()
    # digests whose rows hold different bytes; their classes are told apart by the text's own digest
    clashes = written(texts.groupBy("h").agg(F.count("*").alias("texts")).filter("texts > 1").select("h"), "dedup-clashes")
    if clashes.isEmpty():
        rows = rows.withColumn("k", F.col("h"))
    else:
        marked = rows.join(clashes.withColumn("clash", F.lit(True)), "h", "left")
        rows = written(marked.withColumn("k", F.when(F.col("clash"), F.unhex("sha")).otherwise(F.col("h"))).drop("clash"),
                       "dedup-rows")

    best = F.max(F.struct("n", F.isnotnull("doc_id").alias("real"), (-F.col("doc_id")).alias("low")))
    classes = written(rows.groupBy("k").agg(F.count("*").alias("group_size"), best.alias("best")).filter("group_size > 1")
                      .select("k", "group_size", (-F.col("best.low")).alias("keep_id")), "dedup-classes")
    out = rows.join(classes, "k", "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns.

    Rows are told apart by (id, text digest): ids that occur with different
    texts are judged one by one, and rows repeated with the same id and text
    are collapsed to one.
    """
    kept = written(exact_classes(docs, id_col, text_col).filter("kept")
                   .select(F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__sha")), "dedup-kept")
    sha = F.unhex(F.sha2(without_separators(text_or_empty(docs[text_col])), 256))
    same = docs[id_col].eqNullSafe(kept["__id"]) & (sha == kept["__sha"])
    out = docs.join(kept.distinct(), same, "left_semi")
    if kept.groupBy("__id", "__sha").agg(F.count("*").alias("c")).filter("c > 1").isEmpty():
        return out
    key = fresh_name(docs, "class")
    return out.withColumn(key, sha).dropDuplicates([id_col, key]).drop(key)


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""
