"""Out-of-fold label encodings: mean, count and sum per key (V1-V7).

Meaning, per listed fold d (leave one fold out): the "dev" rows are all train
rows whose fold is not d.

* mean:  mean label of the key over dev rows; a missing key falls back to the
  mean label of *all* dev rows (NULL keys included).
* count: dev rows of the key; fallback = mean of that count over the keys
  present in dev (a plain mean over groups).
* sum:   dev label sum of the key; fallback = mean of that sum over groups.

A train row on a listed fold d gets the value for d; a train row on an
unlisted fold gets 0.0; a test row gets the average over all D listed folds
(folds without rows included).  Keys with a NULL part never form a group.

No loop over folds.  With s/n the label sum/count per (key, fold), S_k/N_k
per key, S/N over all train rows and ' marking rows with a non-NULL key,
G the number of keys and o_d the keys seen only on fold d::

    value(k, d)    = (S_k - s_kd) / (N_k - n_kd)  |  N_k - n_kd  |  S_k - s_kd
                     if N_k - n_kd > 0, else fallback(d)
    fallback_mean  = (S - s_d) / (N - n_d)
    fallback_count = (N' - n'_d) / (G - o_d)
    fallback_sum   = (S' - s'_d) / (G - o_d)
    test(k)        = [sum of value(k, d) over listed folds where k has rows
                      + (D - that many) * full value of k] / D

One (key, fold) aggregate feeds all three encodings; the fold tables have
D rows and are broadcast.  A division by zero (every train row on one fold)
gives NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.session import cut_lineage, write_table

KINDS = ("mean", "count", "sum")
SUFFIX = {"mean": "_enc", "count": "_countenc", "sum": "_sumenc"}
SLOT = "__cw_slot"
TEST_SLOT = -1


def _all_not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def _sum_or_null(c: str) -> Column:
    """Sum that is NULL when any input is NULL (NaN semantics)."""
    return F.when(F.count_if(F.col(c).isNull()) > 0, F.lit(None).cast("double")).otherwise(F.sum(c))


def with_slots(df: DataFrame, fold: str, train_flag: str, folds: DataFrame) -> DataFrame:
    """Add the encoder slot: index of the row's listed fold for train rows
    (NULL when its fold is not listed), -1 for test rows."""
    idx = F.broadcast(folds.select(fold, F.col("fold_idx").alias("__cw_fidx")))
    out = df.join(idx, fold, "left")
    slot = F.when(F.col(train_flag) == 1, F.col("__cw_fidx")).otherwise(F.lit(TEST_SLOT))
    return out.withColumn(SLOT, slot.cast("int")).drop("__cw_fidx")


def fold_fallbacks(
    train: DataFrame, keys: Sequence[str], fold: str, label: str, folds: DataFrame, n_folds: int
) -> DataFrame:
    """Fallback values per slot: one row per listed fold plus the test slot
    (their average).  Built from two small grouped tables (per fold value)."""
    key_ok = _all_not_null(keys)
    y = F.col(label).cast("bigint")
    kd = train.filter(key_ok).groupBy(*keys, fold).agg(F.count(y).alias("n_kd"))
    ktot = kd.groupBy(*keys).agg(F.count(F.lit(1)).alias("nf"), F.min(fold).alias("__f1"))
    per_key = ktot.groupBy(F.col("__f1").alias(fold)).agg(
        F.count(F.lit(1)).alias("g_first"), F.count_if(F.col("nf") == 1).alias("o_d")
    )
    per_fold = train.groupBy(fold).agg(
        F.sum(y).alias("s_d"),
        F.count(y).alias("n_d"),
        F.sum(F.when(key_ok, y)).alias("s1_d"),
        F.count(F.when(key_ok, y)).alias("n1_d"),
    )
    fall = per_fold.join(per_key, fold, "full")
    cols = ["s_d", "n_d", "s1_d", "n1_d", "g_first", "o_d"]
    fall = fall.select(fold, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in cols])
    everything = Window.partitionBy()
    totals = {t: F.sum(c).over(everything) for t, c in
              [("S", "s_d"), ("N", "n_d"), ("S1", "s1_d"), ("N1", "n1_d"), ("G", "g_first")]}
    fall = fall.select(fold, "s_d", "n_d", "s1_d", "n1_d", "o_d", *[v.alias(k) for k, v in totals.items()])
    listed = F.broadcast(folds).join(fall, fold, "left")
    listed = listed.select(
        "fold_idx",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ["s_d", "n_d", "s1_d", "n1_d", "o_d"]],
        *[F.max(k).over(everything).alias(k) for k in totals],
    )
    dbl = lambda c: F.col(c).cast("double")
    per_slot = listed.select(
        F.col("fold_idx").alias(SLOT),
        F.try_divide(dbl("S") - dbl("s_d"), dbl("N") - dbl("n_d")).alias("fb_mean"),
        F.try_divide(dbl("N1") - dbl("n1_d"), dbl("G") - dbl("o_d")).alias("fb_count"),
        F.try_divide(dbl("S1") - dbl("s1_d"), dbl("G") - dbl("o_d")).alias("fb_sum"),
    )
    test = per_slot.agg(
        *[(_sum_or_null(f"fb_{k}") / F.lit(float(n_folds))).alias(f"fb_{k}") for k in KINDS]
    ).select(F.lit(TEST_SLOT).alias(SLOT), *[f"fb_{k}" for k in KINDS])
    return per_slot.unionByName(test)


def encoding_table(
    train: DataFrame, keys: Sequence[str], fold: str, label: str, folds: DataFrame, fallbacks: DataFrame, n_folds: int
) -> DataFrame:
    """(keys, slot) -> mean / count / sum value, for every key seen in train:
    one row per listed fold where the key has rows, and one test-slot row."""
    keys = list(keys)
    key_ok = _all_not_null(keys)
    y = F.col(label).cast("bigint")
    kd = train.filter(key_ok).groupBy(*keys, fold).agg(F.sum(y).alias("s_kd"), F.count(y).alias("n_kd"))
    ktot = kd.groupBy(*keys).agg(F.sum("s_kd").alias("S_k"), F.sum("n_kd").alias("N_k"))
    fb = F.broadcast(fallbacks.filter(F.col(SLOT) != TEST_SLOT))
    kv = (
        kd.join(F.broadcast(folds.select(fold, F.col("fold_idx").alias(SLOT))), fold)
        .join(ktot, keys)
        .join(fb, SLOT)
    )
    rest_n = F.col("N_k") - F.col("n_kd")
    rest_s = F.col("S_k") - F.col("s_kd")
    has = rest_n > 0
    kv = kv.select(
        *keys,
        SLOT,
        F.when(has, rest_s.cast("double") / rest_n.cast("double")).otherwise(F.col("fb_mean")).alias("v_mean"),
        F.when(has, rest_n.cast("double")).otherwise(F.col("fb_count")).alias("v_count"),
        F.when(has, rest_s.cast("double")).otherwise(F.col("fb_sum")).alias("v_sum"),
    )
    per_key = kv.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__nl"), *[_sum_or_null(f"v_{k}").alias(f"__s_{k}") for k in KINDS]
    )
    full = {
        "mean": F.col("S_k").cast("double") / F.col("N_k").cast("double"),
        "count": F.col("N_k").cast("double"),
        "sum": F.col("S_k").cast("double"),
    }
    d = float(n_folds)
    missing = F.lit(d) - F.coalesce(F.col("__nl"), F.lit(0)).cast("double")
    test = ktot.join(per_key, keys, "left").select(
        *keys,
        F.lit(TEST_SLOT).alias(SLOT),
        *[((F.when(F.col("__nl").isNull(), F.lit(0.0)).otherwise(F.col(f"__s_{k}")) + missing * full[k]) / F.lit(d))
          .alias(f"v_{k}") for k in KINDS],
    )
    return kv.unionByName(test)


def oof_encode(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    fold: str,
    train_flag: str,
    folds: DataFrame,
    n_folds: int,
    kinds: Sequence[str] = KINDS,
    name: str | None = None,
    base: DataFrame | None = None,
) -> DataFrame:
    """Add ``{name}_enc`` / ``_countenc`` / ``_sumenc`` for one key set.

    ``df`` holds train and test rows; labels are read from train rows only.
    ``folds`` is ``fold_table(...)`` with the fold column named like ``fold``.
    ``base`` (default ``df``) is the table the statistics are grouped from;
    pass a fixed table when chaining many key sets so the plan grows
    linearly.
    """
    keys = list(keys)
    name = name or "_".join(keys)
    staged = df if SLOT in df.columns else with_slots(df, fold, train_flag, folds)
    source = base if base is not None else df
    train = source.filter(F.col(train_flag) == 1)
    fallbacks = fold_fallbacks(train, keys, fold, label, folds, n_folds)
    table = encoding_table(train, keys, fold, label, folds, fallbacks, n_folds)
    out = staged.join(table, [*keys, SLOT], "left").join(F.broadcast(fallbacks), SLOT, "left")
    enc = {}
    for k in kinds:
        value = F.coalesce(F.col(f"v_{k}"), F.col(f"fb_{k}"))
        enc[name + SUFFIX[k]] = F.when(F.col(SLOT).isNull(), F.lit(0.0)).otherwise(value)
    out = out.withColumns(enc)
    keep = staged.columns + list(enc)
    return out.select(*keep)


def fold_values(
    rows: DataFrame,
    train: DataFrame,
    keys: Sequence[str],
    label: str,
    fold: str,
    folds: DataFrame,
    n_folds: int,
    kind: str = "mean",
) -> DataFrame:
    """The fold-d value of one encoding for rows that carry a fold slot
    (``SLOT`` = index of a listed fold): what the fold-d encoder assigns to
    the row's key.  Used to build per-fold score tables (M5)."""
    keys = list(keys)
    key_ok = _all_not_null(keys)
    y = F.col(label).cast("bigint")
    fallbacks = fold_fallbacks(train, keys, fold, label, folds, n_folds).filter(F.col(SLOT) != TEST_SLOT)
    table = encoding_table(train, keys, fold, label, folds, fallbacks, n_folds).filter(F.col(SLOT) != TEST_SLOT)
    ktot = train.filter(key_ok).groupBy(*keys).agg(F.sum(y).alias("__S"), F.count(y).alias("__N"))
    full = {
        "mean": F.col("__S").cast("double") / F.col("__N").cast("double"),
        "count": F.col("__N").cast("double"),
        "sum": F.col("__S").cast("double"),
    }[kind]
    out = (rows.join(table.select(*keys, SLOT, f"v_{kind}"), [*keys, SLOT], "left")
           .join(ktot, keys, "left")
           .join(F.broadcast(fallbacks.select(SLOT, f"fb_{kind}")), SLOT, "left"))
    value = F.coalesce(F.col(f"v_{kind}"), full, F.col(f"fb_{kind}"))
    return out.withColumn("score", value).drop(f"v_{kind}", "__S", "__N", f"fb_{kind}")


def _key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """Injective text form of a key tuple: each part length-prefixed; -0.0 is
    folded into 0.0 (they are equal keys); NULL when any part is NULL."""
    types = dict(df.dtypes)
    parts = []
    for k in keys:
        c = F.col(k)
        if types[k] in ("double", "float"):
            c = c + F.lit(0.0)
        s = c.cast("string")
        parts += [F.length(s).cast("string"), F.lit(":"), s]
    return F.when(_all_not_null(keys), F.concat(*parts))


def oof_encode_long(
    df: DataFrame,
    key_sets: Sequence[Sequence[str]],
    label: str,
    fold: str,
    train_flag: str,
    folds: DataFrame,
    n_folds: int,
    id_col: str,
    kinds: Sequence[str] = KINDS,
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """All encodings of many key sets in one plan (V7).

    One grouped aggregate per ``(set, key, fold)`` feeds every set.  Key sets
    with few keys are looked up where the rows lie, one broadcast table each;
    for the others every row gives one narrow record per key set
    ``(id, set, key text, slot)``, joined by shuffle and brought back by a
    grouped pivot per id.  The number of shuffles does not grow with the
    number of key sets, and the wide feature row is shuffled once.  ``id_col``
    must be unique.
    """
    key_sets = [list(k) for k in key_sets]
    max_broadcast_rows = MAX_BROADCAST_ROWS if max_broadcast_rows is None else max_broadcast_rows
    staged = with_slots(df.select(id_col, fold, train_flag, label, *{k for ks in key_sets for k in ks}),
                        fold, train_flag, folds)
    keyed = {j: _key_text(staged, ks).alias(f"__k{j}") for j, ks in enumerate(key_sets)}

    def records(rows: DataFrame, sets: Sequence[int], cols: Sequence[str]) -> DataFrame:
        """One record (cols, j, k) per row and key set."""
        entries = F.array(*[F.struct(F.lit(j).alias("j"), keyed[j].alias("k")) for j in sets])
        return rows.select(*cols, F.explode(entries).alias("e")).select(*cols, F.col("e.j").alias("j"), F.col("e.k").alias("k"))

    every = range(len(key_sets))
    train = staged.filter(F.col(train_flag) == 1)
    y = F.col(label).cast("bigint")
    key_ok = F.col("k").isNotNull()
    kd = records(train, every, [fold, label]).filter(key_ok).groupBy("j", "k", fold).agg(F.sum(y).alias("s_kd"), F.count(y).alias("n_kd"))
    kd = cut_lineage(kd)  # read by the key counts below and by every table
    ktot = kd.groupBy("j", "k").agg(
        F.sum("s_kd").alias("S_k"), F.sum("n_kd").alias("N_k"),
        F.count(F.lit(1)).alias("nf"), F.min(fold).alias("__f1"))

    # fallbacks per (set, listed fold) and the test slot: tiny tables
    per_key = ktot.groupBy("j", F.col("__f1").alias(fold)).agg(
        F.count(F.lit(1)).alias("g_first"), F.count_if(F.col("nf") == 1).alias("o_d"))
    all_rows = train.groupBy(fold).agg(F.sum(y).alias("s_d"), F.count(y).alias("n_d"))
    all_rows = all_rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(len(key_sets) - 1))))
    key_rows = kd.groupBy("j", fold).agg(F.sum("s_kd").alias("s1_d"), F.sum("n_kd").alias("n1_d"))
    cols = ["s_d", "n_d", "s1_d", "n1_d", "g_first", "o_d"]
    parts = all_rows.unionByName(key_rows, allowMissingColumns=True).unionByName(per_key, allowMissingColumns=True)
    fall = parts.groupBy("j", fold).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in cols])
    per_set = Window.partitionBy("j")
    totals = {"S": "s_d", "N": "n_d", "S1": "s1_d", "N1": "n1_d", "G": "g_first"}
    fall = fall.select("j", fold, *cols[:4], "o_d", *[F.sum(c).over(per_set).alias(t) for t, c in totals.items()])
    grid = folds.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(len(key_sets) - 1))))
    listed = grid.join(fall, ["j", fold], "left")
    listed = listed.select(
        "j", "fold_idx",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ["s_d", "n_d", "s1_d", "n1_d", "o_d"]],
        *[F.max(t).over(per_set).alias(t) for t in totals])
    dbl = lambda c: F.col(c).cast("double")
    fb_fold = listed.select(
        "j", F.col("fold_idx").alias(SLOT),
        F.try_divide(dbl("S") - dbl("s_d"), dbl("N") - dbl("n_d")).alias("fb_mean"),
        F.try_divide(dbl("N1") - dbl("n1_d"), dbl("G") - dbl("o_d")).alias("fb_count"),
        F.try_divide(dbl("S1") - dbl("s1_d"), dbl("G") - dbl("o_d")).alias("fb_sum"))
    fb_test = fb_fold.groupBy("j").agg(
        *[(_sum_or_null(f"fb_{k}") / F.lit(float(n_folds))).alias(f"fb_{k}") for k in KINDS]
    ).select("j", F.lit(TEST_SLOT).alias(SLOT), *[f"fb_{k}" for k in KINDS])
    fallbacks = fb_fold.unionByName(fb_test)

    # values per (set, key, slot)
    kv = (kd.join(F.broadcast(folds.select(fold, F.col("fold_idx").alias(SLOT))), fold)
          .join(ktot.select("j", "k", "S_k", "N_k"), ["j", "k"])
          .join(F.broadcast(fb_fold), ["j", SLOT]))
    rest_n, rest_s = F.col("N_k") - F.col("n_kd"), F.col("S_k") - F.col("s_kd")
    has = rest_n > 0
    kv = kv.select(
        "j", "k", SLOT,
        F.when(has, rest_s.cast("double") / rest_n.cast("double")).otherwise(F.col("fb_mean")).alias("v_mean"),
        F.when(has, rest_n.cast("double")).otherwise(F.col("fb_count")).alias("v_count"),
        F.when(has, rest_s.cast("double")).otherwise(F.col("fb_sum")).alias("v_sum"))
    per_key_sum = kv.groupBy("j", "k").agg(
        F.count(F.lit(1)).alias("__nl"), *[_sum_or_null(f"v_{k}").alias(f"__s_{k}") for k in KINDS])
    full = {"mean": dbl("S_k") / dbl("N_k"), "count": dbl("N_k"), "sum": dbl("S_k")}
    d = float(n_folds)
    missing = F.lit(d) - F.coalesce(F.col("__nl"), F.lit(0)).cast("double")
    test_vals = ktot.join(per_key_sum, ["j", "k"], "left").select(
        "j", "k", F.lit(TEST_SLOT).alias(SLOT),
        *[((F.when(F.col("__nl").isNull(), F.lit(0.0)).otherwise(F.col(f"__s_{k}")) + missing * full[k]) / F.lit(d))
          .alias(f"v_{k}") for k in KINDS])
    table = write_table(kv.unionByName(test_vals), "encodings", by=["j"])

    # Key sets with few keys (e.g. app_code) are where single key values hold
    # large shares of the rows: their lookup rows are broadcast, so no shuffle
    # partition holds a hot key.  The per-set key counts are J numbers; sets
    # are taken from the smallest on while all their keys x (D + 1) slots
    # together stay under the limit.  NULL keys need no lookup at all.
    keys_per_set = {r["j"]: r["count"] for r in ktot.groupBy("j").count().collect()}
    keys_per_set = {j: keys_per_set.get(j, 0) for j in every}
    small, budget = [], max_broadcast_rows
    for n, j in sorted((n, j) for j, n in keys_per_set.items()):
        budget -= n * (n_folds + 1)
        if budget < 0:
            break
        small.append(j)
    large = [j for j in every if j not in small]
    outputs = {(j, k): "_".join(ks) + SUFFIX[k] for j, ks in enumerate(key_sets) for k in kinds}
    unlisted = F.col(SLOT).isNull()

    parts = []
    # few sets at a time: each lookup is a join in the rows' own stage
    for group in (small[i:i + SETS_PER_PASS] for i in range(0, len(small), SETS_PER_PASS)):
        rows = staged.select(id_col, SLOT, *[keyed[j] for j in group])
        falls = fallbacks.filter(F.col("j").isin(group)).groupBy(SLOT).agg(
            *[F.max(F.when(F.col("j") == j, F.col(f"fb_{k}"))).alias(f"__f{j}_{k}") for j in group for k in kinds])
        rows = rows.join(F.broadcast(falls), SLOT, "left")
        for j in group:
            values = table.filter(F.col("j") == j).select(F.col("k").alias(f"__k{j}"), SLOT, *[F.col(f"v_{k}").alias(f"__v{j}_{k}") for k in kinds])
            rows = rows.join(F.broadcast(values), [f"__k{j}", SLOT], "left")
        parts.append(rows.groupBy(id_col).agg(*[
            F.max(F.when(unlisted, F.lit(0.0)).otherwise(F.coalesce(F.col(f"__v{j}_{k}"), F.col(f"__f{j}_{k}")))).alias(outputs[j, k])
            for k in kinds for j in group]))
    if large:
        rows = records(staged, large, [id_col, SLOT])
        looked = rows.filter(key_ok).join(table.filter(F.col("j").isin(large)), ["j", "k", SLOT], "left")
        looked = looked.unionByName(rows.filter(~key_ok), allowMissingColumns=True)
        looked = looked.join(F.broadcast(fallbacks), ["j", SLOT], "left")
        looked = looked.select(id_col, "j", *[
            F.when(unlisted, F.lit(0.0)).otherwise(F.coalesce(F.col(f"v_{k}"), F.col(f"fb_{k}"))).alias(k) for k in kinds])
        parts.append(looked.groupBy(id_col).agg(*[
            F.max(F.when(F.col("j") == j, F.col(k))).alias(outputs[j, k]) for k in kinds for j in large]))
    out = df
    for part in parts:
        out = out.join(part, id_col, "left")
    return out.select(*df.columns, *[outputs[j, k] for k in kinds for j in every])


MAX_BROADCAST_ROWS = 2_000_000
#: Key sets looked up by broadcast in one pass over the rows.
SETS_PER_PASS = 16
