"""Mixing sources to target weights by Pfair scheduling (DataFrame operations only).

Each source with integer weight a of total Q owns blocks 0, 1, 2, ... with
release time floor(i * Q / a) and deadline ceil((i + 1) * Q / a).  In every
slot the released block with the earliest deadline runs (ties: heavier
weight, then source order), so after any number of slots t each source has
had its share t * a / Q up to less than one block.  The schedule repeats
after Q slots; the shorter of one period and the mix is computed in segments
that run side by side, and every block takes its slot from it by arithmetic.

The integer weights are as fine as the mix is long (Q of about 2^40, less
where block times Q would not fit 64 bits), so that they leave the given
weights by a small part of a block over the whole mix.  With ``resolution``
they are rounded to that many slots instead: the bound then holds for the
rounded weights, and each weight above 0 has at least one slot of a period.

A block is ``block_rows`` consecutive rows of a source's stream.  The stream
of a source is its rows in a fixed pseudo-random order (digest of the id, id,
text), started again from its first row when it runs out.  The mix ends with
the slot in which the last source has given each of its rows once, so no row
is lost; rows of sources weighted above their size appear in several epochs.

Weights: a map {source: weight}, or size ** alpha of the input's own sources.
Defined results: null is a source of its own; a weight of 0 leaves a source
out and a source missing from the map is an error; null ids and repeated rows
are rows like others; an empty table gives an empty result.

Scale: rows are ranked inside (source, digest prefix) buckets, with running
offsets from the bucket counts, so that no source meets in one task.  The
schedule has one row per slot (a block of rows); its segments are folds over
``SEGMENT`` slots each (or as many as there are sources), rows like others.
Work per slot grows with the number of sources.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clickweave.llm.common import written

#: Exponent of the sizes in the default weights (1: as given; 0: all sources alike).
ALPHA = 0.7
#: Largest number of slots where weights are not rounded to one, and the largest product of blocks and slots.
FINEST, LARGEST = 1 << 40, 1 << 60
#: Slots of the schedule made in one array, slots of a segment, and slots that are broadcast at most.
CHUNK, SEGMENT, BROADCAST_SLOTS = 64, 4096, 100_000
BLOCK_ROWS = 8
#: Rows of one ranking bucket, about.
BUCKET_ROWS = 4096


def _name(col: Column) -> Column:
    """Sources as text that keeps null apart from every string."""
    return F.when(col.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), col.cast("string")))


def source_weights(counts: DataFrame, weights: dict | None = None, alpha: float = ALPHA, resolution: int | None = None,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``source, n, a``: integer weights, at least 1 for each weight above 0."""
    if weights is None:
        w = F.pow(F.col("n").cast("double"), F.lit(float(alpha)))
    else:
        given = F.create_map(*[x for k, v in sorted(weights.items(), key=str) for x in (
            F.lit("null" if k is None else f"={k}"), F.lit(float(v)))]) if weights else F.create_map().cast("map<string,double>")
        w = F.coalesce(F.element_at(given, F.col("source")), F.raise_error(F.concat(F.lit("no weight for source "), F.col("source"))).cast("double"))
    rows = counts.withColumn("w", w).filter("w > 0")
    if resolution is None:  # as fine as the length of the mix allows
        length = F.max(F.ceil(F.col("n") / block_rows) / F.col("w")) * F.sum("w") + F.count("*")
        r = F.least(F.lit(float(FINEST)), F.floor(F.lit(float(LARGEST)) / length))
    else:
        r = F.greatest(F.lit(resolution), 4 * F.count("*"))
    total = rows.agg(F.sum("w").alias("total"), r.alias("r"))
    return rows.join(F.broadcast(total)).select(
        "source", "n", F.greatest(F.lit(1), F.round(F.col("w") / F.col("total") * F.col("r"))).cast("long").alias("a"))


def _quotient(x: Column, y: Column) -> Column:
    return F.call_function("div", x, y)


def _job(i: Column, j: Column, a: Column) -> Column:
    """Block j of source i, in the order of the schedule: deadline, heavier weight, source; and its release."""
    q = F.col("q")
    return F.struct(_quotient((j + 1) * q + a - 1, a).alias("d"), (-a).alias("h"), i.alias("i"), j.alias("j"), _quotient(j * q, a).alias("r"))


def _assumed(segments: DataFrame, length: int) -> DataFrame:
    """``done`` per source where segment k begins: the whole blocks of its share and, of the begun ones, those due first."""
    at = F.col("k") * length
    rows = segments.withColumn("whole", F.transform("a", lambda a: _quotient(at * a, F.col("q"))))
    rows = rows.withColumn("more", (at - F.aggregate("whole", F.lit(0).cast("long"), lambda x, y: x + y)).cast("int"))
    begun = F.transform("a", lambda a, i: F.when((at * a) % F.col("q") > 0, _job(i, F.get("whole", i), a)))
    rows = rows.withColumn("begun", begun).withColumn("order", F.sort_array(F.filter("begun", lambda x: x.isNotNull())))
    rows = rows.withColumn("last", F.get("order", F.col("more") - 1))
    return rows.select("k", "q", "a", F.transform("whole", lambda x, i: x + F.when(
        (F.col("more") > 0) & (F.get("begun", i) <= F.col("last")), 1).otherwise(0)).alias("done"))


def _run(segments: DataFrame, length: int, total: int) -> DataFrame:
    """``k, done, ended, chunks``: each segment's slots in order, from ``done`` blocks per source to ``ended``."""

    def step(acc: Column, t: Column) -> Column:
        pick = F.array_min(F.filter(acc["jobs"], lambda x: x["r"] <= t))
        # bound to a variable, or it is worked out again for each source
        return F.transform(F.array(pick), lambda p: F.struct(
            F.transform(acc["jobs"], lambda x: F.when(x["i"] == p["i"], _job(x["i"], x["j"] + 1, -x["h"])).otherwise(x)).alias("jobs"),
            F.concat(acc["runs"], F.array(F.struct(p["i"].alias("i"), p["j"].alias("j")))).alias("runs")))[0]

    def chunk(acc: Column, c: Column) -> Column:  # short arrays, since each slot copies what it appends to
        none = F.array().cast("array<struct<i:int,j:bigint>>")
        made = F.aggregate(F.sequence(c, F.least(c + CHUNK, F.col("until")) - 1), F.struct(acc["jobs"].alias("jobs"), none.alias("runs")), step)
        return F.transform(F.array(made), lambda m: F.struct(
            m["jobs"].alias("jobs"), F.concat(acc["chunks"], F.array(m["runs"])).alias("chunks")))[0]

    rows = segments.withColumn("since", F.col("k") * length).withColumn("until", F.least(F.col("since") + length, F.lit(total)))
    first = F.struct(F.transform("done", lambda x, i: _job(i, x, F.get("a", i))).alias("jobs"),
                     F.array().cast("array<array<struct<i:int,j:bigint>>>").alias("chunks"))
    rows = rows.withColumn("made", F.aggregate(F.sequence("since", F.col("until") - 1, F.lit(CHUNK).cast("long")), first, chunk))
    return rows.select("k", "done", F.transform("made.jobs", lambda x: x["j"]).alias("ended"), F.col("made.chunks").alias("chunks"))


def pfair_period(weights: DataFrame, slots: int | None = None) -> DataFrame:
    """One period of the schedule, or its first ``slots`` slots: ``source, a, q, j, slot`` for block j of a source within the period.

    Segments of slots run side by side from assumed beginnings.  A segment
    that ends otherwise than the next one began makes that one run again from
    there, until all fit; the rows are those of one run from slot 0.  Two runs
    from different beginnings agree from the last deadline on in which these
    differ, so that mostly one or two rounds do; each makes at least one more
    segment final.
    """
    spark = weights.sparkSession
    listed = written(weights.groupBy().agg(F.sort_array(F.collect_list(F.struct("source", "a"))).alias("s"), F.sum("a").alias("q"),
                                           F.count("*").alias("n")).filter("q IS NOT NULL"), "mix-sources")
    size = listed.select("q", "n").first()
    if size is None:
        return spark.createDataFrame([], "source string, a long, q long, j long, slot long")
    total = size.q if slots is None else min(size.q, slots)
    length = max(SEGMENT, size.n)  # the beginnings of all segments are no more numbers than there are slots
    count = -(-total // length)
    tasks = min(count, 4 * spark.sparkContext.defaultParallelism)
    sources = F.broadcast(listed.select("q", F.transform("s", lambda x: x["a"]).alias("a")))  # one row
    todo, rounds = _assumed(spark.range(0, count, 1, tasks).withColumnRenamed("id", "k").join(sources), length), []
    while True:
        made = written(_run(todo, length, total), "mix-segments")
        rounds.append(made)
        state = made.select("k", "done", "ended")
        if len(rounds) > 1:
            state = latest.join(made, "k", "left_anti").unionByName(state)
        latest = written(state, "mix-state")
        ends = latest.select((F.col("k") + 1).alias("k"), F.col("ended").alias("begin"))
        wrong = latest.join(ends, "k").filter("done <> begin").select("k", F.col("begin").alias("done"))
        wrong = written(wrong, "mix-again")
        if wrong.isEmpty():
            break
        todo = wrong.repartition(tasks, "k").join(sources)

    final = rounds[-1]
    for made in reversed(rounds[:-1]):
        final = final.unionByName(made.join(final.select("k"), "k", "left_anti"))
    runs = final.select("k", F.posexplode("chunks").alias("c", "runs")).select("k", "c", F.posexplode("runs").alias("at", "run")).select(
        F.col("run.i").alias("i"), F.col("run.j").alias("j"), (F.col("k") * length + F.col("c") * CHUNK + F.col("at")).alias("slot"))
    names = listed.select("q", F.posexplode("s").alias("i", "x")).select("i", F.col("x.source").alias("source"), F.col("x.a").alias("a"), "q")
    return runs.join(F.broadcast(names) if size.n <= BROADCAST_SLOTS else names, "i").select("source", "a", "q", "j", "slot")


def _places(docs: DataFrame, weights: dict | None, alpha: float, block_rows: int, source_col: str, id_col: str,
            resolution: int, carry: list[str]) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("src"),
                       F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(0)]).alias("kept"))
    rows = rows.withColumn("source", _name(F.col("src"))).withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    counts = written(rows.groupBy("source").agg(F.count("*").alias("n")), "mix-counts")
    w = written(source_weights(counts, weights, alpha, resolution, block_rows), "mix-weights")
    # no source's last block runs behind its deadline
    length = w.join(F.broadcast(w.agg(F.sum("a").alias("q")))).agg(
        F.max(F.ceil(F.ceil(F.col("n") / block_rows) * (F.col("q") / F.col("a")))) + 1, F.max("q")).first()
    slots = min(length[0] or 0, length[1] or 0)
    period = written(pfair_period(w, slots), "mix-period")

    # rank rows inside (source, digest prefix); prefixes of hexadecimal digits in the same order as the digests
    largest = counts.agg(F.max("n")).first()[0] or 1
    digits = max(0, math.ceil(math.log(max(1, largest / BUCKET_ROWS), 16)))
    rows = rows.withColumn("bucket", F.substring("h", 1, digits))
    sizes = rows.groupBy("source", "bucket").agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("source", "bucket", F.coalesce(before, F.lit(0)).alias("offset"))
    in_bucket = Window.partitionBy("source", "bucket").orderBy("h", "doc_id")
    ranked = rows.withColumn("r", F.row_number().over(in_bucket) - 1).join(offsets, ["source", "bucket"]).select(
        "doc_id", "src", "kept", "source", (F.col("r") + F.col("offset")).alias("rank"))

    # the mix ends when the last source is through: slot of each source's last block, and blocks of each source up to there
    b = F.lit(block_rows)
    last = w.withColumn("i", F.expr(f"(n - 1) div {int(block_rows)}")).withColumn("j", F.expr("i % a")).join(
        period.select("source", "j", "slot", "q"), ["source", "j"])
    end = written(last.agg(F.max(F.expr("(i div a) * q + slot")).alias("end")), "mix-end")
    held = period.join(F.broadcast(end)).groupBy("source", "a", "q").agg(
        F.max(F.expr("end div q")).alias("whole"), F.sum(F.expr("CASE WHEN slot <= end % q THEN 1 ELSE 0 END")).alias("part"))
    spans = w.select("source", "n").join(held, "source").select(
        "source", "n", "a", "q", ((F.col("whole") * F.col("a") + F.col("part")) * b).alias("places"))
    # one row per source, and one per slot of the period or the mix
    at = period.select("source", "j", F.col("slot").alias("at"))
    placed = ranked.join(F.broadcast(written(spans, "mix-spans")), "source").filter("rank < places").withColumn(
        "epoch", F.explode(F.expr("sequence(0L, (places - 1 - rank) div n)")))
    placed = placed.withColumn("p", F.expr("rank + epoch * n")).withColumn("block", F.expr(f"p div {int(block_rows)}")).withColumn(
        "j", F.expr("block % a")).join(F.broadcast(at) if slots <= BROADCAST_SLOTS else at, ["source", "j"])
    slot = F.expr("(block div a) * q + at")
    out = placed.withColumn("slot", slot)
    return out.select("doc_id", F.col("src").alias("source"), "epoch", "block", "slot",
                      (F.col("slot") * b + F.expr(f"p % {int(block_rows)}")).alias("position"), "kept")


def mix(docs: DataFrame, weights: dict | None = None, alpha: float = ALPHA, block_rows: int = BLOCK_ROWS,
        source_col: str = "source", id_col: str = "doc_id", resolution: int | None = None) -> DataFrame:
    """``doc_id, source, epoch, block, slot, position``, one row per place in the mix.

    ``position`` numbers the mix from 0 without gaps; ``slot`` is the block's
    place and ``block`` the block's number within its source's stream.
    """
    return _places(docs, weights, alpha, block_rows, source_col, id_col, resolution, []).drop("kept")


def mix_rows(docs: DataFrame, weights: dict | None = None, alpha: float = ALPHA, block_rows: int = BLOCK_ROWS,
             source_col: str = "source", id_col: str = "doc_id", resolution: int | None = None) -> DataFrame:
    """The mix itself: the rows of ``docs`` (all columns), once per epoch, range-partitioned and sorted by position."""
    placed = _places(docs, weights, alpha, block_rows, source_col, id_col, resolution, docs.columns)
    return placed.repartitionByRange("position").sortWithinPartitions("position").select("kept.*")


ORACLE_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, md5(doc_id::VARCHAR) AS h FROM documents
), counts AS (SELECT source, count(*) AS n FROM docs GROUP BY source),
weighted AS (SELECT source, n, pow(n::DOUBLE, {ALPHA}) AS w FROM counts),
fine AS (
  SELECT sum(w) AS total, least({FINEST}, floor({LARGEST} / (max(ceil(n / {BLOCK_ROWS}) / w) * sum(w) + count(*)))) AS r FROM weighted
), whole AS (
  SELECT source, n, greatest(1, round(w / total * r))::BIGINT AS a FROM weighted, fine
), named AS (
  SELECT *, (SELECT sum(a) FROM whole)::BIGINT AS q, row_number() OVER (ORDER BY coalesce('=' || source, 'null')) AS i FROM whole
), run(t, done, i) AS (
  SELECT -1::BIGINT, list_transform(range((SELECT count(*) FROM named)), lambda x: 0::BIGINT), 0::BIGINT
  UNION ALL
  SELECT t + 1, list_transform(done, lambda x, k: CASE WHEN k = pick THEN x + 1 ELSE x END), pick
  FROM (SELECT t, done, (SELECT arg_min(named.i, (((run.done[named.i] + 1) * q + a - 1) // a, -a, named.i)) FROM named
                         WHERE (run.done[named.i] * q) // a <= run.t + 1) AS pick
        FROM run WHERE t + 1 < (SELECT least(max(q), max(ceil(ceil(n / {BLOCK_ROWS}) * (q / a))) + 1) FROM named))
), period AS (
  SELECT i, t AS slot, row_number() OVER (PARTITION BY i ORDER BY t) - 1 AS j FROM run WHERE t >= 0
), ending AS (
  SELECT max((((n - 1) // {BLOCK_ROWS}) // a) * q + slot) AS e
  FROM named JOIN period ON named.i = period.i AND period.j = ((n - 1) // {BLOCK_ROWS}) % a
), spans AS (
  SELECT named.i, any_value(source) AS source, any_value(n) AS n, any_value(a) AS a, any_value(q) AS q,
         ((max(e) // any_value(q)) * any_value(a) + count(*) FILTER (slot <= e % q)) * {BLOCK_ROWS} AS places
  FROM named JOIN period ON named.i = period.i, ending GROUP BY named.i
), ranked AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY h, doc_id) - 1 AS r FROM docs
), placed AS (
  SELECT doc_id, ranked.source, i, a, q, n, r, unnest(range((places - 1 - r) // n + 1)) AS epoch
  FROM ranked JOIN spans ON ranked.source IS NOT DISTINCT FROM spans.source WHERE r < places
), cut AS (SELECT *, (r + epoch * n) AS p, (r + epoch * n) // {BLOCK_ROWS} AS block FROM placed)
SELECT doc_id, source, epoch::BIGINT AS epoch, block::BIGINT AS block, ((block // a) * q + slot)::BIGINT AS slot,
       (((block // a) * q + slot) * {BLOCK_ROWS} + p % {BLOCK_ROWS})::BIGINT AS position
FROM cut JOIN period ON cut.i = period.i AND period.j = block % a
"""
