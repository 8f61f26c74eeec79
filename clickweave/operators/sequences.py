"""Per-group sequences: neighbour values (lag / lead) and running positions.

Both operators take an explicit total order (the last order column must be
unique) so results never depend on the input row order.

Hot groups.  A plain ``Window.partitionBy(group)`` puts every row of a group
into one task.  When ``bucket`` is given (a column that never decreases along
the order), the rows are windowed per
``(group, bucket)`` instead, so a group with a third of all rows is spread over
many tasks (``skew.chunked`` gives buckets of about equal size).  Only the first and last ``depth`` rows of each bucket can have
neighbours outside it; those "rim" rows (at most ``2 * depth`` per bucket) are
windowed again per group, which yields their exact neighbours, because the
rows between a rim row and its true k-th neighbour are all rim rows too.
A NULL bucket means "the whole group is one bucket" (no rim), so callers give
a bucket only to the bounded set of hot groups
(``clickweave.operators.skew``) and the rim table stays small.  With ``row_id``
the rim's neighbours are joined back onto the rows, which then keep their
partitioning by (group, bucket).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B, _RN, _CNT = "__cw_bucket", "__cw_rn", "__cw_cnt"


def prev_name(col: str, k: int) -> str:
    return f"{col}__prev{k}"


def next_name(col: str, k: int) -> str:
    return f"{col}__next{k}"


def _not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def with_neighbors(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    depths: Mapping[str, int],
    bucket: Column | None = None,
    row_id: str | None = None,
) -> DataFrame:
    """Add ``{c}__prev{k}`` / ``{c}__next{k}`` for k = 1..depths[c].

    Equivalent to ``lag(c, k)`` / ``lead(c, k)`` over
    ``Window.partitionBy(group).orderBy(order)``; all of them share one
    window node (one sort).  Rows with a NULL group part get NULL neighbours
    (a grouped shift has no group for them).
    """
    group = list(group)
    if bucket is None:
        w = Window.partitionBy(*group).orderBy(*order)
        return _guard(df.select("*", *_shift_columns(depths, w)), group, depths)

    base_cols = df.columns
    depth = max(depths.values())
    wb = Window.partitionBy(*group, _B).orderBy(*order)
    wc = Window.partitionBy(*group, _B)
    staged = df.withColumn(_B, bucket).select(
        "*",
        F.row_number().over(wb).alias(_RN),
        F.count(F.lit(1)).over(wc).alias(_CNT),
        *_shift_columns(depths, wb),
    )
    rim_cond = F.col(_B).isNotNull() & ((F.col(_RN) <= depth) | (F.col(_RN) > F.col(_CNT) - depth))
    wg = Window.partitionBy(*group).orderBy(*order)
    fixed = []
    for c, d in depths.items():
        for k in range(1, d + 1):
            fixed.append(
                F.when(F.col(_RN) <= k, F.lag(c, k).over(wg)).otherwise(F.col(prev_name(c, k))).alias(prev_name(c, k))
            )
        for k in range(1, d + 1):
            fixed.append(
                F.when(F.col(_RN) > F.col(_CNT) - k, F.lead(c, k).over(wg))
                .otherwise(F.col(next_name(c, k)))
                .alias(next_name(c, k))
            )
    rim = staged.filter(rim_cond)
    if row_id is None:
        inner = staged.filter(~rim_cond).drop(_B, _RN, _CNT)
        return _guard(inner.unionByName(rim.select(*base_cols, *fixed)), group, depths)
    names = [f(c, k) for c, d in depths.items() for k in range(1, d + 1) for f in (prev_name, next_name)]
    values = rim.select(*group, _B, row_id, *fixed)
    values = values.withColumnsRenamed({n: f"__rim_{n}" for n in names}).withColumn("__rim", F.lit(True))
    out = staged.join(values, [*group, _B, row_id], "left")
    out = out.select(*base_cols, *[F.when(F.col("__rim"), F.col(f"__rim_{n}")).otherwise(F.col(n)).alias(n) for n in names])
    return _guard(out, group, depths)


def _guard(df: DataFrame, group: Sequence[str], depths: Mapping[str, int]) -> DataFrame:
    ok = _not_null(group)
    names = [f(c, k) for c, d in depths.items() for k in range(1, d + 1) for f in (prev_name, next_name)]
    return df.withColumns({n: F.when(ok, F.col(n)) for n in names})


def _shift_columns(depths: Mapping[str, int], w) -> list[Column]:
    out = []
    for c, d in depths.items():
        out += [F.lag(c, k).over(w).alias(prev_name(c, k)) for k in range(1, d + 1)]
        out += [F.lead(c, k).over(w).alias(next_name(c, k)) for k in range(1, d + 1)]
    return out


def with_positions(
    df: DataFrame,
    specs: Sequence[tuple[Sequence[str], str, str]],
    order: Sequence[Column],
    bucket: Column | None = None,
) -> DataFrame:
    """For each ``(group, position, size)`` spec add the 1-based position of
    the row in its group and the group size (BIGINT).

    With ``bucket`` (never NULL here), positions are counted per (group, bucket) and shifted by
    the rows of the group's earlier buckets; the offsets come from
    pre-aggregated (group, bucket) count tables, never from a whole group.
    Rows with a NULL group part get NULL.
    """
    if bucket is None:
        cols = []
        for group, position, size in specs:
            ok = _not_null(group)
            w = Window.partitionBy(*group).orderBy(*order)
            wc = Window.partitionBy(*group)
            cols.append(F.when(ok, F.row_number().over(w)).cast("bigint").alias(position))
            cols.append(F.when(ok, F.count(F.lit(1)).over(wc)).alias(size))
        return df.select("*", *cols)

    base = df.withColumn(_B, bucket)  # a plain column keeps the partitioning by (group, bucket)
    staged = base
    for i, (group, _, _) in enumerate(specs):
        wb = Window.partitionBy(*group, _B).orderBy(*order)
        staged = staged.withColumn(f"{_RN}{i}", F.row_number().over(wb))
    for i, (group, position, size) in enumerate(specs):
        group = list(group)
        counts = base.groupBy(*group, _B).agg(F.count(F.lit(1)).alias(_CNT))
        before = Window.partitionBy(*group).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy(*group)
        offsets = counts.select(
            *group,
            _B,
            F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(f"__cw_off{i}"),
            F.sum(_CNT).over(whole).alias(f"__cw_tot{i}"),
        )
        staged = staged.join(offsets, [*group, _B], "left")
    cols = []
    for i, (group, position, size) in enumerate(specs):
        ok = _not_null(group)
        cols.append(F.when(ok, F.col(f"__cw_off{i}") + F.col(f"{_RN}{i}")).cast("bigint").alias(position))
        cols.append(F.when(ok, F.col(f"__cw_tot{i}")).cast("bigint").alias(size))
    return staged.select(*df.columns, *cols)
