"""Feature build: view-log features, impression features, both joined per row.

Layout (see README, "Scale"):

* Impressions of ordinary users are hash-partitioned by ``user_id`` once;
  every later window and every (user, ...) aggregate and join-back runs inside
  those partitions with no further shuffle.
* Users with more rows than ``hot_rows`` (a counted, bounded list) are split
  off and laid out in chunks of about ``chunk_rows`` rows, (user, range of the
  row order), by two shuffles; their rows are not shuffled again.  Sequences
  are windowed per (user, chunk) with an exact fix-up of the border rows,
  aggregates are partially aggregated where the rows lie, and tables come back
  by way of the keys that each chunk holds (``skew.chunk_join_back``).
* The view log is never joined back onto itself: its features are grouped
  tables keyed by user, (user, date), (user, weekday) and (user, hour).  Its
  lag window is partitioned by (user, chunk), where the chunk is NULL for
  ordinary users.

Features that look ahead (leads, counts over train and test) follow the
reference on purpose; they are not point-in-time safe.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.dates import date_part_columns, epoch_micros, epoch_seconds, micros_to_seconds
from clickweave.functions.gaps import ratio, second_difference, step_gap, total_gap
from clickweave.operators.aggregates import (
    count_distinct,
    count_rows,
    distinct_counts_table,
    join_back,
    modes_table,
    stat_columns,
)
from clickweave.operators.dictionary import encode_first_seen
from clickweave.operators.sequences import next_name, prev_name, with_neighbors, with_positions
from clickweave.operators.skew import CHUNK, CHUNK_ROWS, DEFAULT_HOT_ROWS, chunk_count, chunk_join_back, chunked, dealt_by, split_hot
from clickweave.session import cut_lineage, forget, scratch_path, write_table

U, APP, OS, NET = "user_id", "app_code", "os_version", "is_4G"
TIME, IID, LABEL, TRAIN = "impression_time", "impression_id", "is_click", "train_set"
DATE, TORD, US = "impression_date", "impression_time_ord", "__us"
AFTER = "__after"  # 0 for train rows, 1 for test rows: the first part of the row order as a column
WEEK, DAY, DOW = "impression_timeWeek", "impression_timeDay", "impression_timeDayofweek"
HOUR, MINUTE = "impression_timeHour", "impression_timeMinute"
MOE, MOS = "impression_timeIs_month_end", "impression_timeIs_month_start"

MAX_BROADCAST_ROWS = 2_000_000
#: Rows of ordinary users per task; narrow rows grow to hundreds of columns there, so their own size says little.
TASK_ROWS = 25_000
#: Left join of a grouped table onto the rows of one path: (rows, table, keys, keys of the table or None).
JoinBack = Callable[..., DataFrame]


@dataclass(frozen=True)
class FeatureConfig:
    """Parameters of the build (column roles of the log, skew handling)."""

    log_order: tuple[str, ...] = ("server_time", "session_id", "item_id", "row_id")
    hot_rows: int = DEFAULT_HOT_ROWS
    chunk_rows: int = CHUNK_ROWS
    task_rows: int = TASK_ROWS
    time_lags: int = 5
    price_lags: int = 4
    count_lags: int = 2
    item_columns: tuple[str, ...] = field(
        default=("item_id", "item_price", "category_1", "category_2", "category_3", "product_type")
    )


# --------------------------------------------------------------------------
# shared helpers


def impression_order() -> list[Column]:
    """Row order of the impressions: train before test, then time, then id."""
    return [(F.lit(1) - F.col(TRAIN)), F.col(TIME), F.col(IID)]


def _checked_broadcast(small: DataFrame, limit: int = MAX_BROADCAST_ROWS,
                       held: list[DataFrame] | None = None) -> DataFrame:
    """Broadcast a grouped table only after counting it.  The table is
    cached so the count and the join read it once; pass ``held`` to release
    it after the consuming stage is written."""
    small = small.cache()
    if held is not None:
        held.append(small)
    return F.broadcast(small) if small.count() <= limit else small


def _filled(cached: DataFrame) -> DataFrame:
    """Fill a persisted frame before several branches read it; otherwise
    stages that AQE runs side by side each compute it."""
    cached.count()
    return cached


def _sec(c: Column) -> Column:
    return micros_to_seconds(c)


# --------------------------------------------------------------------------
# sources -> base columns


def prepare_impressions(imps: DataFrame) -> DataFrame:
    """Epoch values, date parts and the first-seen os code (train then test
    order).  Keeps every input column; ``os_version`` becomes the code."""
    df = imps.withColumns({US: epoch_micros(TIME), TORD: epoch_seconds(TIME)})
    df = df.withColumns(date_part_columns(TIME, "impression_time"))
    return encode_first_seen(df, OS, impression_order())


def join_items(view_log: DataFrame, items: DataFrame) -> DataFrame:
    """View log left join items (J1).  The item table is counted and broadcast
    when small; a large one is joined by a shuffle on item_id."""
    return view_log.join(_checked_broadcast(items), "item_id", "left")


def prepare_log(log: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Epoch values, date and date parts of ``server_time``; device code in
    order of first appearance over the log order."""
    df = log.withColumns({US: epoch_micros("server_time"), "server_time_date": F.to_date("server_time")})
    df = df.withColumns(date_part_columns("server_time", "server_time"))
    return encode_first_seen(df, "device_type", [F.col(c) for c in cfg.log_order])


# --------------------------------------------------------------------------
# view log


@dataclass
class LogTables:
    """Grouped log features, one table per join key."""

    user: DataFrame  # user_id
    user_date: DataFrame  # user_id, server_time_date
    user_dow: DataFrame  # user_id, server_timeDayofweek
    user_hour: DataFrame  # user_id, server_timeHour


def log_gap_columns(log: DataFrame, cfg: FeatureConfig, bucket: Column | None) -> DataFrame:
    """Time gaps k = 1..5 (total form, microseconds) and price gaps
    k = 1..4 (total form) over each user's log rows in log order."""
    order = [F.col(c) for c in cfg.log_order]
    depths = {US: cfg.time_lags, "item_price": cfg.price_lags}
    df = with_neighbors(log, [U], order, depths, bucket)
    gaps = {}
    for k in range(1, cfg.time_lags + 1):
        back, fwd = total_gap(US, prev_name(US, k)), total_gap(US, next_name(US, k), backward=False)
        gaps[f"__log_d{k}"] = second_difference(back, fwd)
    for k in range(1, cfg.price_lags + 1):
        back = total_gap("item_price", prev_name("item_price", k))
        fwd = total_gap("item_price", next_name("item_price", k), backward=False)
        gaps[f"user_price_diff{k}"] = second_difference(back, fwd)
    helper = [f(c, k) for c, d in depths.items() for k in range(1, d + 1) for f in (prev_name, next_name)]
    return df.withColumns(gaps).drop(*helper)


def compact(df: DataFrame) -> DataFrame:
    """Lineage cut into a compressed table: for tables that are dealt anew, so their partitioning is not worth plain rows."""
    return write_table(df, "log-table")


def log_features(log: DataFrame, cfg: FeatureConfig, cut: Callable[[DataFrame], DataFrame] = cut_lineage) -> LogTables:
    """All grouped view-log features (A2, A3, A5, A7, log count).

    ``log`` is ``prepare_log(join_items(...))``.  The lagged log is persisted
    while its aggregates run on the user layout: statistics per user and per
    (user, date) and (user, weekday) read the wide rows once each and repeat
    none of them; modes and exact distinct counts repeat only keys and values.
    Then each table is lineage-cut, the cache released and the written log
    deleted.  ``cut`` keeps the user layout of the tables by default; a build
    whose impressions are dealt by their number passes ``compact``.
    """
    spark = log.sparkSession
    path = scratch_path(spark, "log")
    used = [U, US, "item_price", "device_type", "session_id", "item_id", "server_time_date", "server_timeWeek",
            "server_timeDayofweek", "server_timeHour", "server_timeDay", *cfg.item_columns, *cfg.log_order]
    # every table is keyed by user, and a missing user is no group; written once, as the joins below it are read twice
    log = write_table(log.filter(F.col(U).isNotNull()).select(*dict.fromkeys(used)), "log", path)
    split = split_hot(log, [U], cfg.hot_rows)
    if split.n_hot:
        order = [F.col(c) for c in cfg.log_order]
        hot = chunked(split.hot, [U], order, split.hot_rows, cfg.chunk_rows)
        log = split.normal.withColumn(CHUNK, F.lit(None).cast("int")).unionByName(hot)
        gapped = log_gap_columns(log, cfg, F.col(CHUNK)).drop(CHUNK)
    else:
        gapped = log_gap_columns(dealt_by(log, [U], log.count(), cfg.task_rows), cfg, None)
    diffs = [f"__log_d{k}" for k in range(1, cfg.time_lags + 1)]
    prices = [f"user_price_diff{k}" for k in range(1, cfg.price_lags + 1)]
    keep = [U, "device_type", "session_id", "item_id", "server_time_date", "server_timeWeek",
            "server_timeDayofweek", "server_timeHour", "server_timeDay", *cfg.item_columns, *diffs, *prices]
    gapped = _filled(gapped.select(*dict.fromkeys(keep)).persist())
    try:
        per_user = gapped.groupBy(U).agg(
            *[c for k in range(1, cfg.time_lags + 1) for c in stat_columns(f"__log_d{k}", f"user_time_diff{k}_log")],
            *[c for k in range(1, cfg.price_lags + 1)
              for c in stat_columns(f"user_price_diff{k}", f"user_price_diff{k}_log", seconds=False)],
            count_distinct("server_timeWeek", "ser_wk_user_uniq", bounded=True),
            count_distinct("server_timeDayofweek", "ser_daywk_user_uniq", bounded=True),
            count_distinct("server_timeHour", "ser_hr_user_uniq", bounded=True),
            count_rows("user_id_cnt"),
        )
        modes = [(c, c) for c in cfg.item_columns] + [
            ("server_timeDay", "server_timeDay"),
            ("server_timeDayofweek", "server_timeDayofweek_mode"),
            ("server_timeHour", "server_timeHour"),
        ]
        uniques = distinct_counts_table(gapped, [U], [
            ("device_type", "device_uniq"), ("session_id", "sess_uniq"), ("item_id", "item_uniq"),
            ("server_time_date", "ser_dat_user_uniq")])
        per_user = cut(join_back(join_back(per_user, uniques, [U]), modes_table(gapped, [U], modes), [U]))

        def keyed(key: str, prefix: str | None, sess: str, item: str) -> DataFrame:
            rows = gapped.filter(F.col(key).isNotNull())
            out = distinct_counts_table(rows, [U, key], [("session_id", sess), ("item_id", item)])
            if prefix:
                stats = [c for k in range(1, cfg.time_lags + 1) for c in stat_columns(f"__log_d{k}", prefix.format(k=k))]
                out = join_back(rows.groupBy(U, key).agg(*stats), out, [U, key])
            return cut(out)

        user_date = keyed("server_time_date", "user_date_time_diff{k}_log", "user_date_sess_uniq", "user_date_item_uniq")
        user_dow = keyed("server_timeDayofweek", "user_daywk_diff{k}_log", "user_daywk_sess_uniq", "user_daywk_item_uniq")
        user_hour = keyed("server_timeHour", None, "user_hr_sess_uniq", "user_hr_item_uniq")
    finally:
        gapped.unpersist()
        forget(spark, path)
    return LogTables(per_user, user_date, user_dow, user_hour)


# --------------------------------------------------------------------------
# impressions

COUNT_LAG_BASES = {
    "user_week_impcnt": "user_wkcnt",
    "user_app_week_impcnt": "user_app_wkcnt",
    "user_app_dayofweek_impcnt": "user_app_daywkcnt",
    "user_app_hr_impcnt": "user_app_hrcnt",
    "user_app_min_impcnt": "user_app_mincnt",
    "user_app_time_impcnt": "user_app_timecnt",
}


COUNT_KEYS = [
    ([U, WEEK], "user_week_impcnt"),
    ([U, APP, WEEK], "user_app_week_impcnt"),
    ([U, APP, DOW], "user_app_dayofweek_impcnt"),
    ([U, APP, HOUR], "user_app_hr_impcnt"),
    ([U, APP, MINUTE], "user_app_min_impcnt"),
    ([U, MINUTE], "user_min_impcnt"),
    ([U, APP, TORD], "user_app_time_impcnt"),
    ([U, APP, OS], "user_app_os_impression_count"),
    ([U, APP, NET], "user_app_4g_impression_count"),
]


def _impression_counts(base: DataFrame, back: JoinBack = join_back, rows: DataFrame | None = None) -> DataFrame:
    """Per-row counts keyed by user and something else (A4).

    Every count table is grouped from the same ``base`` and left-joined onto
    it (or onto ``rows``), so the plan grows linearly with the number of tables."""
    out = base if rows is None else rows
    for keys, name in COUNT_KEYS:
        out = back(out, base.groupBy(*keys).agg(count_rows(name)), keys)
    return out


def _time_lag_columns(cfg: FeatureConfig) -> dict[str, Column]:
    """Time lags (W1, step form) from the neighbours of the time."""
    cols: dict[str, Column] = {}
    for k in range(1, cfg.time_lags + 1):
        sfx = "" if k == 1 else str(k)
        p, n = F.col(prev_name(US, k)), F.col(next_name(US, k))
        near_p = F.col(US) if k == 1 else F.col(prev_name(US, k - 1))
        near_n = F.col(US) if k == 1 else F.col(next_name(US, k - 1))
        back, fwd = step_gap(near_p, p), step_gap(near_n, n, backward=False)
        cols[f"__d{k}"] = second_difference(back, fwd)
        cols[f"user_prev_time{sfx}"] = _sec(p)
        cols[f"user_next_time{sfx}"] = _sec(n)
        cols[f"user_time_diffprev{sfx}"] = _sec(back)
        cols[f"user_time_diffnext{sfx}"] = _sec(fwd)
        cols[f"user_time_diff{k}"] = _sec(second_difference(back, fwd))
    return cols


def _count_lag_columns() -> dict[str, Column]:
    """Count lags (W4) from the neighbours of the counts."""
    cols: dict[str, Column] = {}
    for c, base in COUNT_LAG_BASES.items():
        p1, p2 = F.col(prev_name(c, 1)), F.col(prev_name(c, 2))
        n1, n2 = F.col(next_name(c, 1)), F.col(next_name(c, 2))
        cols.update({
            f"{base}_prev": p1,
            f"{base}_nxt": n1,
            f"{base}_diffprev": F.col(c) - p1,
            f"{base}_diffnext": n1 - F.col(c),
            f"{base}_prev2": p2,
            f"{base}_nxt2": n2,
            f"{base}_diffprev2": p1 - p2,
            f"{base}_diffnext2": n2 - n1,
        })
    return cols


def _helpers(depths: dict[str, int]) -> list[str]:
    return [f(c, k) for c, d in depths.items() for k in range(1, d + 1) for f in (prev_name, next_name)]


def _impression_lags(df: DataFrame, bucket: Column | None, cfg: FeatureConfig) -> DataFrame:
    """Time lags (W1, step form) and count lags (W4), one window pass."""
    depths = {US: cfg.time_lags, **{c: cfg.count_lags for c in COUNT_LAG_BASES}}
    df = with_neighbors(df, [U], impression_order(), depths, bucket, IID if bucket is not None else None)
    return df.withColumns({**_time_lag_columns(cfg), **_count_lag_columns()}).drop(*_helpers(depths))


def _impression_sequence(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Running positions (W5) and the neighbours of the time (W1), which ask for no count, on the narrow rows of
    ordinary users; the rows of a user lie in row order afterwards."""
    order = [F.col(AFTER), F.col(TIME), F.col(IID)]
    placed = _impression_positions(df.withColumn(AFTER, F.lit(1) - F.col(TRAIN)), None)
    return with_neighbors(placed, [U], order, {US: cfg.time_lags}).sortWithinPartitions(U, *order)


def _impression_aggregates(base: DataFrame, back: JoinBack = join_back, rows: DataFrame | None = None) -> DataFrame:
    """Gap statistics (A1), distinct counts (A6), time ranges (A8) and the
    user / (user, app) counts: one aggregate per key, all grouped from the
    same ``base`` and joined onto ``rows`` (default ``base``)."""
    per_user = base.groupBy(U).agg(
        count_rows("user_impression_count"),
        *[c for k in range(1, 6) for c in stat_columns(f"__d{k}", f"user_time_diff{k}")],
        count_distinct(APP, "user_app_unicount"),
        count_distinct(WEEK, "user_wk_unicount", bounded=True),
        count_distinct(DAY, "user_day_unicount", bounded=True),
        count_distinct(DOW, "user_daywk_unicount", bounded=True),
        count_distinct(MOE, "user_moe_unicount", bounded=True),
        count_distinct(MOS, "user_mos_unicount", bounded=True),
        count_distinct(HOUR, "user_hr_unicount", bounded=True),
        count_distinct(MINUTE, "user_min_unicount", bounded=True),
        F.min(TORD).alias("user_time_min"),
        F.max(TORD).alias("user_time_max"),
    )
    per_user_app = base.groupBy(U, APP).agg(
        count_rows("user_app_impression_count"),
        *stat_columns("__d1", "user_app_time_diff1"),
        count_distinct(TORD, "user_app_time_unicount"),
        F.min(TORD).alias("user_app_code_time_min"),
        F.max(TORD).alias("user_app_code_time_max"),
    )
    per_user_app_dow = base.groupBy(U, APP, DOW).agg(*stat_columns("__d1", "user_app_daywk_time_diff1"))
    out = back(base if rows is None else rows, per_user, [U])
    out = back(out, per_user_app, [U, APP])
    return back(out, per_user_app_dow, [U, APP, DOW])


POSITION_SPECS = [
    ([U, APP], "user_app_cumcount", "user_app_code_inv_cumcount",
     "user_app_code_cumcount_ratio", "user_app_code_inv_cumcount_ratio", "user_app_impression_count"),
    ([U, MINUTE], "user_min_cumcount", "user_min_inv_cumcount",
     "user_min_cumcount_ratio", "user_min_inv_cumcount_ratio", "user_min_impcnt"),
    ([U, APP, NET], "user_app_4g_cumcount", "user_app_4g_inv_cumcount",
     "user_app_4g_cumcount_ratio", "user_app_4g_inv_cumcount_ratio", "user_app_4g_impression_count"),
]


def _impression_positions(df: DataFrame, bucket: Column | None) -> DataFrame:
    """Running counts up and down with their shares."""
    specs = [(keys, f"__pos{i}", f"__size{i}") for i, (keys, *_rest) in enumerate(POSITION_SPECS)]
    df = with_positions(df, specs, impression_order(), bucket)
    cols: dict[str, Column] = {}
    for i, (_, up, down, up_r, down_r, total) in enumerate(POSITION_SPECS):
        cols[up] = F.col(f"__pos{i}") - 1
        cols[down] = F.col(f"__size{i}") - F.col(f"__pos{i}")
    df = df.withColumns(cols)
    shares = {}
    for i, (_, up, down, up_r, down_r, _total) in enumerate(POSITION_SPECS):
        # the group size is the group's row count (the named count column)
        shares[up_r] = ratio(up, f"__size{i}")
        shares[down_r] = ratio(down, f"__size{i}")
    drop = [f"__{n}{i}" for i in range(len(POSITION_SPECS)) for n in ("pos", "size")]
    return df.withColumns(shares).drop(*drop)


def _join_log(df: DataFrame, log: LogTables, back: JoinBack = join_back) -> DataFrame:
    """Log tables onto impressions; right keys renamed first."""
    for table, left, right in [(log.user, [U], [U]), (log.user_date, [U, DATE], [U, "server_time_date"]),
                               (log.user_dow, [U, DOW], [U, "server_timeDayofweek"]),
                               (log.user_hour, [U, HOUR], [U, "server_timeHour"])]:
        df = back(df, table, left, right)
    return df


def _chunk_back(base: DataFrame) -> JoinBack:
    def back(df: DataFrame, table: DataFrame, keys: list[str], right_keys: list[str] | None = None) -> DataFrame:
        if right_keys is not None:
            table = table.withColumnsRenamed(dict(zip(right_keys, keys)))
        return chunk_join_back(df, base, table, keys, [U, CHUNK])
    return back


def hot_layout(hot: DataFrame, rows: int, cfg: FeatureConfig) -> DataFrame:
    """Impressions of hot users by (user, chunk): one shuffle by range, one by hash."""
    dealt = chunked(hot, [U], impression_order(), rows, cfg.chunk_rows)
    return dealt.repartition(chunk_count(rows, cfg.chunk_rows), U, CHUNK)


def _user_block(df: DataFrame, log: LogTables, cfg: FeatureConfig, held: list[DataFrame], hot: bool = False) -> DataFrame:
    """Features of one path; ``held`` collects persisted frames for release after the result is lineage-cut.

    Ordinary users lie by user.  What is persisted are the narrow rows in row
    order with their positions and the neighbours of their time, from which
    the counts are grouped, and then in their place the same with the counts,
    from which the statistics are.  The grouped tables are hashed beside
    the rows, which keeps that order, so the lags of the counts need no sort,
    and the wide rows are neither sorted nor held.  What a join does not ask
    for is carried as one struct per table: a join copies a struct at once, but
    hundreds of columns one by one, in a method too large for the JIT compiler.

    ``hot`` ones lie by (user, ``CHUNK``): ``df`` is read by every count branch
    and the lagged frame by every statistics branch, so both are persisted."""
    gaps = [f"__d{k}" for k in range(1, cfg.time_lags + 1)]
    if not hot:
        base = _filled(_impression_sequence(df, cfg).persist())
        held.append(base)
        keys = [U, APP, OS, NET, DATE, WEEK, DOW, HOUR, MINUTE, TORD, AFTER, TIME, IID]
        packs: dict[str, list[str]] = {}

        def packed(table: DataFrame, beside: list[str]) -> DataFrame:
            name = f"__pack{len(packs)}"
            packs[name] = [c for c in table.columns if c not in beside]
            return table.select(*beside, F.struct(*packs[name]).alias(name))

        def back(rows: DataFrame, table: DataFrame, on: list[str], right_keys: list[str] | None = None) -> DataFrame:
            table = table if right_keys is None else table.withColumnsRenamed(dict(zip(right_keys, on)))
            return join_back(rows, packed(table, on), on)

        lags = _time_lag_columns(cfg)
        depths = {c: cfg.count_lags for c in COUNT_LAG_BASES}
        order = [F.col(AFTER), F.col(TIME), F.col(IID)]
        counted = _impression_counts(base, rows=packed(base, keys))
        counted = counted.select(*keys, "__pack0.*", *[n for _, n in COUNT_KEYS]).sortWithinPartitions(U, *order)
        # a task holds the hashed tables of one stage: those of the counts are let go before the others come
        counted = _filled(counted.persist())
        held.append(counted)
        base.unpersist()
        packs.clear()
        rows = packed(with_neighbors(counted, [U], order, depths), keys)
        rows = _impression_aggregates(counted.withColumns({n: lags[n] for n in gaps}), back, rows)
        rows = _join_log(rows, log, back)
        rows = rows.select(*keys, *[F.col(f"{name}.{c}").alias(c) for name, cols in packs.items() for c in cols])
        rows = rows.withColumns({**_count_lag_columns(), **{n: c for n, c in lags.items() if n not in gaps}})
        return rows.drop(AFTER, *_helpers({**depths, US: cfg.time_lags}))
    bucket = F.col(CHUNK)
    base = _filled(df.persist())
    held.append(base)
    # running positions sort narrow rows here, before the wide statistics
    placed = _impression_positions(_impression_counts(base, _chunk_back(base)), bucket)
    lagged = _filled(_impression_lags(placed, bucket, cfg).persist())
    held.append(lagged)
    back = _chunk_back(lagged)
    return _join_log(_impression_aggregates(lagged, back), log, back).drop(CHUNK, *gaps)


def _global_tables(df: DataFrame, held: list[DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Aggregates over all users: per app and per os (small domains, counted
    before broadcast)."""
    per_app = df.groupBy(APP).agg(
        count_rows("app_impression_count"),
        F.min(TORD).alias("app_code_time_min"),
        F.max(TORD).alias("app_code_time_max"),
    )
    per_os = df.groupBy(OS).agg(count_rows("os_impression_count"))
    return _checked_broadcast(per_app, held=held), _checked_broadcast(per_os, held=held)


def _finish_row(df: DataFrame) -> DataFrame:
    """Ratios (D9) and distances to the (user, app) time range."""
    return df.withColumns({
        "user_log_cnt_r": ratio("user_impression_count", "user_id_cnt"),
        "user_device_uniq_log_r": ratio("device_uniq", "user_id_cnt"),
        "user_sess_uniq_log_r": ratio("sess_uniq", "user_id_cnt"),
        "user_item_uniq_log_r": ratio("item_uniq", "user_id_cnt"),
        "user_ser_tim_uniq_log_r": ratio("ser_dat_user_uniq", "user_id_cnt"),
        "user_user_day_sess_uniq_log_r": ratio("user_date_sess_uniq", "user_id_cnt"),
        "user_app_app_impr_cnt_r": ratio("user_app_impression_count", "user_impression_count"),
        "user_app_app_over_cnt_r": ratio("user_app_impression_count", "app_impression_count"),
        "user_app_4g_over_cnt_r": ratio("user_app_4g_impression_count", "app_impression_count"),
        "user_app_weekbytot_r": ratio("user_app_dayofweek_impcnt", "user_app_impression_count"),
        "user_app_hrbytot_r": ratio("user_app_hr_impcnt", "user_app_impression_count"),
        "user_app_minbytot_r": ratio("user_app_min_impcnt", "user_app_impression_count"),
        "user_app_timebytot_r": ratio("user_app_time_impcnt", "user_app_impression_count"),
        "user_app_over_min_timediff": F.col(TORD) - F.col("user_app_code_time_min"),
        "user_app_over_max_timediff": F.col("user_app_code_time_max") - F.col(TORD),
    })


def impression_features(imps: DataFrame, log: LogTables, cfg: FeatureConfig = FeatureConfig(), path: str | None = None) -> DataFrame:
    """Every base feature of every impression (train and test), written (to ``path`` where given).

    ``imps`` is ``prepare_impressions(...)``, lineage-cut by the caller (it is
    read by several branches); the result keeps its rows (all joins are left
    joins on unique keys).
    """
    held: list[DataFrame] = []
    per_app, per_os = _global_tables(imps, held)
    split = split_hot(imps, [U], cfg.hot_rows)
    rows = imps.count()
    normal = dealt_by(split.normal, [U], rows, cfg.task_rows)
    # the log tables follow the rows to their partitions, so the rows never move to theirs
    near = replace(log, **{n: dealt_by(getattr(log, n), [U], rows, cfg.task_rows) for n in ("user", "user_date", "user_dow", "user_hour")})
    parts = [_user_block(normal, near, cfg, held)]
    if split.n_hot:
        parts.append(_user_block(hot_layout(split.hot, split.hot_rows, cfg), log, cfg, held, hot=True))
    # rows without a user are in no group: every per-user feature is NULL
    known = set(split.unkeyed.columns)
    parts.append(split.unkeyed.select(*[F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name)
                                        for f in parts[0].schema.fields]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    out = out.join(per_app, APP, "left").join(per_os, OS, "left")
    result = write_table(_finish_row(out).drop(US), "features", path)
    for frame in held:
        frame.unpersist()
    return result


def build_features(
    impressions: DataFrame, view_log: DataFrame, items: DataFrame, cfg: FeatureConfig = FeatureConfig(), path: str | None = None
) -> DataFrame:
    """Sources to the full base-feature table (entry point E1)."""
    log = prepare_log(join_items(view_log, items), cfg)
    tables = log_features(log, cfg, compact)
    return impression_features(cut_lineage(prepare_impressions(impressions)), tables, cfg, path)
