"""Oracle SQL for DuckDB, written independently of the Spark plans.

Every query starts from the binding views (``bindings.cte_prefix``) and uses
the plain definitions: grouped shifts via window ``lag`` / ``lead``, naive
leave-one-fold-out encoders (a fold table joined to every other-fold row),
modes by ranking counts, AUC by average ranks.  Float columns that come from
sums (std, means of doubles, fold averages, AUC) are compared after
``round(x * (1 + 1e-12), 6)`` in both engines: the tiny relative nudge moves
exact decimal ties off the rounding boundary in both engines alike.
"""

from __future__ import annotations

from bindings import cte_prefix
from clickweave.plans.matrix import feature_names

STATS = ("min", "max", "mean", "std")


def fr(expr: str, digits: int = 6) -> str:
    return f"round(({expr}) * (1 + 1e-12), {digits})"


IMP_TMPL = """
imp0 as (
  select *, epoch_us(impression_time) as us,
         epoch_us(impression_time) // 1000000 as impression_time_ord,
         cast(day(impression_time) as int) as impression_timeDay,
         cast(weekofyear(impression_time) as int) as impression_timeWeek,
         cast(isodow(impression_time) - 1 as int) as impression_timeDayofweek,
         cast(last_day(impression_time) = cast(impression_time as date) as int) as impression_timeIs_month_end,
         cast(day(impression_time) = 1 as int) as impression_timeIs_month_start,
         cast(hour(impression_time) as int) as impression_timeHour,
         cast(minute(impression_time) as int) as impression_timeMinute
  from {imp_view}),
os_first as (
  select os_version, 1 - train_set as o1, impression_time as o2, impression_id as o3,
         row_number() over (partition by os_version order by 1 - train_set, impression_time, impression_id) as rn
  from imp0 where os_version is not null),
os_codes as (
  select os_version, cast(row_number() over (order by o1, o2, o3) - 1 as int) as code from os_first where rn = 1),
imp as (
  select imp0.* exclude (os_version), coalesce(c.code, -1) as os_version
  from imp0 left join os_codes c on imp0.os_version = c.os_version)"""
IMP = IMP_TMPL.format(imp_view="a_impressions")

IMP_LAGS = """
imp_l as (
  select *,
    lag(us, 1) over w as p1, lag(us, 2) over w as p2, lag(us, 3) over w as p3, lag(us, 4) over w as p4,
    lag(us, 5) over w as p5,
    lead(us, 1) over w as n1, lead(us, 2) over w as n2, lead(us, 3) over w as n3, lead(us, 4) over w as n4,
    lead(us, 5) over w as n5
  from imp window w as (partition by user_id order by 1 - train_set, impression_time, impression_id)),
imp_d as (
  select *,
    (us - p1) as bk1, (n1 - us) as fw1,
    (p1 - p2) as bk2, (n2 - n1) as fw2,
    (p2 - p3) as bk3, (n3 - n2) as fw3,
    (p3 - p4) as bk4, (n4 - n3) as fw4,
    (p4 - p5) as bk5, (n5 - n4) as fw5,
    (us - p1) - (n1 - us) as d1, (p1 - p2) - (n2 - n1) as d2, (p2 - p3) - (n3 - n2) as d3,
    (p3 - p4) - (n4 - n3) as d4, (p4 - p5) - (n5 - n4) as d5
  from imp_l)"""

LOG_TMPL = """
item as (select * from a_item_data),
lg0 as (
  select v.*, i.item_price, i.category_1, i.category_2, i.category_3, i.product_type,
         epoch_us(v.server_time) as us, cast(v.server_time as date) as server_time_date,
         cast(day(v.server_time) as int) as server_timeDay,
         cast(weekofyear(v.server_time) as int) as server_timeWeek,
         cast(isodow(v.server_time) - 1 as int) as server_timeDayofweek,
         cast(hour(v.server_time) as int) as server_timeHour
  from {log_view} v left join item i on v.item_id = i.item_id),
dev_first as (
  select device_type, {order_as},
         row_number() over (partition by device_type order by {order}) as rn
  from lg0 where device_type is not null),
dev_codes as (
  select device_type, cast(row_number() over (order by {order_o}) - 1 as int) as code from dev_first where rn = 1),
lg as (
  select lg0.* exclude (device_type), coalesce(c.code, -1) as device_type
  from lg0 left join dev_codes c on lg0.device_type = c.device_type),
lg_l as (
  select *,
    lag(us, 1) over w as p1, lag(us, 2) over w as p2, lag(us, 3) over w as p3, lag(us, 4) over w as p4,
    lag(us, 5) over w as p5,
    lead(us, 1) over w as n1, lead(us, 2) over w as n2, lead(us, 3) over w as n3, lead(us, 4) over w as n4,
    lead(us, 5) over w as n5,
    lag(item_price, 1) over w as pp1, lag(item_price, 2) over w as pp2, lag(item_price, 3) over w as pp3,
    lag(item_price, 4) over w as pp4,
    lead(item_price, 1) over w as np1, lead(item_price, 2) over w as np2, lead(item_price, 3) over w as np3,
    lead(item_price, 4) over w as np4
  from lg window w as (partition by user_id order by {order})),
lg_d as (
  select *,
    (us - p1) - (n1 - us) as d1, (us - p2) - (n2 - us) as d2, (us - p3) - (n3 - us) as d3,
    (us - p4) - (n4 - us) as d4, (us - p5) - (n5 - us) as d5,
    (item_price - pp1) - (np1 - item_price) as pd1, (item_price - pp2) - (np2 - item_price) as pd2,
    (item_price - pp3) - (np3 - item_price) as pd3, (item_price - pp4) - (np4 - item_price) as pd4
  from lg_l)"""


def log_ctes(log_view: str, order: list[str]) -> str:
    return LOG_TMPL.format(
        log_view=log_view, order=", ".join(order),
        order_as=", ".join(f"{c} as o{i}" for i, c in enumerate(order)),
        order_o=", ".join(f"o{i}" for i in range(len(order))))


LOG = log_ctes("a_view_log", ["server_time", "session_id", "item_id", "row_id"])
IMP_B = IMP_TMPL.format(imp_view="b_impressions")
LOG_B = log_ctes("b_view_log", ["server_time", "l_orderkey", "l_linenumber", "item_id", "l_suppkey"])


def _with(*parts: str, views: list[str] | None = None, binding: str = "a") -> str:
    return cte_prefix(views, binding).rstrip("\n") + "," + ",".join(parts) + "\n"


def _sec_stats(col: str, prefix: str) -> str:
    return (f"min({col}) / 1e6 as {prefix}_min, max({col}) / 1e6 as {prefix}_max, "
            f"avg({col}) / 1e6 as {prefix}_mean, {fr(f'stddev_samp({col}) / 1e6')} as {prefix}_std")


def _val_stats(col: str, prefix: str) -> str:
    return (f"min({col}) as {prefix}_min, max({col}) as {prefix}_max, "
            f"{fr(f'avg({col})')} as {prefix}_mean, {fr(f'stddev_samp({col})')} as {prefix}_std")


def q_imp_time_lags() -> str:
    cols = []
    for k in range(1, 6):
        s = "" if k == 1 else str(k)
        cols += [f"bk{k} / 1e6 as user_time_diffprev{s}", f"fw{k} / 1e6 as user_time_diffnext{s}",
                 f"d{k} / 1e6 as user_time_diff{k}"]
    return _with(IMP, IMP_LAGS) + f"select impression_id, {', '.join(cols)} from imp_d"


def q_imp_gap_stats_user() -> str:
    stats = ", ".join(_sec_stats(f"d{k}", f"user_time_diff{k}") for k in range(1, 6))
    names = ", ".join(f"g.user_time_diff{k}_{s}" for k in range(1, 6) for s in STATS)
    return _with(IMP, IMP_LAGS, f"g as (select user_id, {stats} from imp_d group by user_id)") + (
        f"select i.impression_id, {names} from imp i left join g on i.user_id = g.user_id")


def q_imp_gap_stats_user_app() -> str:
    return _with(IMP, IMP_LAGS, f"g as (select user_id, app_code, {_sec_stats('d1', 'user_app_time_diff1')} "
                 "from imp_d group by user_id, app_code)") + (
        "select i.impression_id, " + ", ".join(f"g.user_app_time_diff1_{s}" for s in STATS) +
        " from imp i left join g on i.user_id = g.user_id and i.app_code = g.app_code")


def q_imp_gap_stats_user_app_dow() -> str:
    return _with(IMP, IMP_LAGS, "g as (select user_id, app_code, impression_timeDayofweek, "
                 f"{_sec_stats('d1', 'user_app_daywk_time_diff1')} "
                 "from imp_d group by user_id, app_code, impression_timeDayofweek)") + (
        "select i.impression_id, " + ", ".join(f"g.user_app_daywk_time_diff1_{s}" for s in STATS) +
        " from imp i left join g on i.user_id = g.user_id and i.app_code = g.app_code"
        " and i.impression_timeDayofweek = g.impression_timeDayofweek")


IMP_COUNTS = [
    ("user_impression_count", ["user_id"]),
    ("user_app_impression_count", ["user_id", "app_code"]),
    ("app_impression_count", ["app_code"]),
    ("os_impression_count", ["os_version"]),
    ("user_app_os_impression_count", ["user_id", "app_code", "os_version"]),
    ("user_app_4g_impression_count", ["user_id", "app_code", "is_4G"]),
    ("user_week_impcnt", ["user_id", "impression_timeWeek"]),
    ("user_app_week_impcnt", ["user_id", "app_code", "impression_timeWeek"]),
    ("user_app_dayofweek_impcnt", ["user_id", "app_code", "impression_timeDayofweek"]),
    ("user_app_hr_impcnt", ["user_id", "app_code", "impression_timeHour"]),
    ("user_app_min_impcnt", ["user_id", "app_code", "impression_timeMinute"]),
    ("user_min_impcnt", ["user_id", "impression_timeMinute"]),
    ("user_app_time_impcnt", ["user_id", "app_code", "impression_time_ord"]),
]

IMP_CNT = "imp_c as (select *, " + ", ".join(
    f"cast(count(*) over (partition by {', '.join(keys)}) as bigint) as {name}" for name, keys in IMP_COUNTS
) + " from imp)"


def q_imp_counts() -> str:
    return _with(IMP, IMP_CNT) + "select impression_id, " + ", ".join(n for n, _ in IMP_COUNTS) + " from imp_c"


COUNT_LAGS = [
    ("user_week_impcnt", "user_wkcnt"), ("user_app_week_impcnt", "user_app_wkcnt"),
    ("user_app_dayofweek_impcnt", "user_app_daywkcnt"), ("user_app_hr_impcnt", "user_app_hrcnt"),
    ("user_app_min_impcnt", "user_app_mincnt"), ("user_app_time_impcnt", "user_app_timecnt"),
]


def q_imp_count_lags() -> str:
    w = "(partition by user_id order by 1 - train_set, impression_time, impression_id)"
    inner = []
    for c, b in COUNT_LAGS:
        inner += [f"lag({c}, 1) over {w} as {b}_prev", f"lead({c}, 1) over {w} as {b}_nxt",
                  f"lag({c}, 2) over {w} as {b}_prev2", f"lead({c}, 2) over {w} as {b}_nxt2"]
    outer = []
    for c, b in COUNT_LAGS:
        outer += [f"{b}_prev", f"{b}_nxt", f"{c} - {b}_prev as {b}_diffprev", f"{b}_nxt - {c} as {b}_diffnext",
                  f"{b}_prev2", f"{b}_nxt2", f"{b}_prev - {b}_prev2 as {b}_diffprev2",
                  f"{b}_nxt2 - {b}_nxt as {b}_diffnext2"]
    return _with(IMP, IMP_CNT, f"x as (select *, {', '.join(inner)} from imp_c)") + (
        f"select impression_id, {', '.join(outer)} from x")


def q_imp_cumcounts() -> str:
    specs = [
        (["user_id", "app_code"], "user_app_cumcount", "user_app_code_inv_cumcount",
         "user_app_code_cumcount_ratio", "user_app_code_inv_cumcount_ratio"),
        (["user_id", "impression_timeMinute"], "user_min_cumcount", "user_min_inv_cumcount",
         "user_min_cumcount_ratio", "user_min_inv_cumcount_ratio"),
        (["user_id", "app_code", "is_4G"], "user_app_4g_cumcount", "user_app_4g_inv_cumcount",
         "user_app_4g_cumcount_ratio", "user_app_4g_inv_cumcount_ratio"),
    ]
    cols = []
    for keys, up, down, up_r, down_r in specs:
        part = ", ".join(keys)
        rn = f"row_number() over (partition by {part} order by 1 - train_set, impression_time, impression_id)"
        cnt = f"count(*) over (partition by {part})"
        cols += [f"cast({rn} - 1 as bigint) as {up}", f"cast({cnt} - {rn} as bigint) as {down}",
                 f"cast({rn} - 1 as double) / {cnt} as {up_r}", f"cast({cnt} - {rn} as double) / {cnt} as {down_r}"]
    return _with(IMP) + f"select impression_id, {', '.join(cols)} from imp"


def q_imp_nunique_user() -> str:
    return _with(IMP, """g as (select user_id,
      cast(count(distinct app_code) as bigint) as user_app_unicount,
      cast(count(distinct impression_timeWeek) as bigint) as user_wk_unicount,
      cast(count(distinct impression_timeDay) as bigint) as user_day_unicount,
      cast(count(distinct impression_timeDayofweek) as bigint) as user_daywk_unicount,
      cast(count(distinct impression_timeIs_month_end) as bigint) as user_moe_unicount,
      cast(count(distinct impression_timeIs_month_start) as bigint) as user_mos_unicount,
      cast(count(distinct impression_timeHour) as bigint) as user_hr_unicount,
      cast(count(distinct impression_timeMinute) as bigint) as user_min_unicount
    from imp group by user_id)""") + (
        "select i.impression_id, g.* exclude (user_id) from imp i left join g on i.user_id = g.user_id")


def q_imp_nunique_user_app() -> str:
    return _with(IMP, "g as (select user_id, app_code, cast(count(distinct impression_time_ord) as bigint) as "
                 "user_app_time_unicount from imp group by user_id, app_code)") + (
        "select i.impression_id, g.user_app_time_unicount from imp i left join g "
        "on i.user_id = g.user_id and i.app_code = g.app_code")


def q_imp_time_range() -> str:
    return _with(IMP) + """select impression_id,
      min(impression_time_ord) over (partition by user_id) as user_time_min,
      max(impression_time_ord) over (partition by user_id) as user_time_max,
      min(impression_time_ord) over (partition by app_code) as app_code_time_min,
      max(impression_time_ord) over (partition by app_code) as app_code_time_max,
      min(impression_time_ord) over (partition by user_id, app_code) as user_app_code_time_min,
      max(impression_time_ord) over (partition by user_id, app_code) as user_app_code_time_max,
      impression_time_ord - min(impression_time_ord) over (partition by user_id, app_code) as user_app_over_min_timediff,
      max(impression_time_ord) over (partition by user_id, app_code) - impression_time_ord as user_app_over_max_timediff
    from imp"""


LOG_USER = """
lu as (select user_id, count(*) as user_id_cnt,
    count(distinct device_type) as device_uniq, count(distinct session_id) as sess_uniq,
    count(distinct item_id) as item_uniq, count(distinct server_time_date) as ser_dat_user_uniq
  from lg group by user_id),
ld as (select user_id, server_time_date, count(distinct session_id) as user_date_sess_uniq from lg
  group by user_id, server_time_date)"""


def q_imp_ratios() -> str:
    return _with(IMP, IMP_CNT) + """select impression_id,
      cast(user_app_impression_count as double) / user_impression_count as user_app_app_impr_cnt_r,
      cast(user_app_impression_count as double) / app_impression_count as user_app_app_over_cnt_r,
      cast(user_app_4g_impression_count as double) / app_impression_count as user_app_4g_over_cnt_r,
      cast(user_app_dayofweek_impcnt as double) / user_app_impression_count as user_app_weekbytot_r,
      cast(user_app_hr_impcnt as double) / user_app_impression_count as user_app_hrbytot_r,
      cast(user_app_min_impcnt as double) / user_app_impression_count as user_app_minbytot_r,
      cast(user_app_time_impcnt as double) / user_app_impression_count as user_app_timebytot_r
    from imp_c"""


def q_log_ratios() -> str:
    return _with(IMP, IMP_CNT, LOG, LOG_USER) + """select i.impression_id,
      cast(i.user_impression_count as double) / lu.user_id_cnt as user_log_cnt_r,
      cast(lu.device_uniq as double) / lu.user_id_cnt as user_device_uniq_log_r,
      cast(lu.sess_uniq as double) / lu.user_id_cnt as user_sess_uniq_log_r,
      cast(lu.item_uniq as double) / lu.user_id_cnt as user_item_uniq_log_r,
      cast(lu.ser_dat_user_uniq as double) / lu.user_id_cnt as user_ser_tim_uniq_log_r,
      cast(ld.user_date_sess_uniq as double) / lu.user_id_cnt as user_user_day_sess_uniq_log_r
    from imp_c i left join lu on i.user_id = lu.user_id
    left join ld on i.user_id = ld.user_id and i.impression_date = ld.server_time_date"""


def q_log_count_user() -> str:
    return _with(IMP, LOG, LOG_USER) + "select user_id, cast(user_id_cnt as bigint) as user_id_cnt from lu"


def q_log_time_lags() -> str:
    return _with(IMP, LOG) + "select row_id, " + ", ".join(f"d{k} / 1e6 as log_time_diff{k}" for k in range(1, 6)) + \
        " from lg_d"


def q_log_price_lags() -> str:
    return _with(IMP, LOG) + "select row_id, " + ", ".join(f"pd{k} as user_price_diff{k}" for k in range(1, 5)) + \
        " from lg_d"


def q_log_gap_stats_user() -> str:
    stats = ", ".join(_sec_stats(f"d{k}", f"user_time_diff{k}_log") for k in range(1, 6))
    return _with(IMP, LOG) + f"select user_id, {stats} from lg_d group by user_id"


def _log_keyed_stats(key: str, imp_key: str, prefix: str) -> str:
    stats = ", ".join(_sec_stats(f"d{k}", prefix.format(k=k)) for k in range(1, 6))
    names = ", ".join(f"g.{prefix.format(k=k)}_{s}" for k in range(1, 6) for s in STATS)
    return _with(IMP, LOG, f"g as (select user_id, {key}, {stats} from lg_d group by user_id, {key})") + (
        f"select i.impression_id, {names} from imp i left join g on i.user_id = g.user_id and i.{imp_key} = g.{key}")


def q_log_gap_stats_user_date() -> str:
    return _log_keyed_stats("server_time_date", "impression_date", "user_date_time_diff{k}_log")


def q_log_gap_stats_user_dow() -> str:
    return _log_keyed_stats("server_timeDayofweek", "impression_timeDayofweek", "user_daywk_diff{k}_log")


def q_log_price_gap_stats_user() -> str:
    stats = ", ".join(_val_stats(f"pd{k}", f"user_price_diff{k}_log") for k in range(1, 5))
    return _with(IMP, LOG) + f"select user_id, {stats} from lg_d group by user_id"


def q_log_nunique_user() -> str:
    return _with(IMP, LOG) + """select user_id,
      cast(count(distinct device_type) as bigint) as device_uniq,
      cast(count(distinct session_id) as bigint) as sess_uniq,
      cast(count(distinct item_id) as bigint) as item_uniq,
      cast(count(distinct server_time_date) as bigint) as ser_dat_user_uniq,
      cast(count(distinct server_timeWeek) as bigint) as ser_wk_user_uniq,
      cast(count(distinct server_timeDayofweek) as bigint) as ser_daywk_user_uniq,
      cast(count(distinct server_timeHour) as bigint) as ser_hr_user_uniq
    from lg group by user_id"""


def _log_keyed_nunique(key: str, imp_key: str, sess: str, item: str) -> str:
    return _with(IMP, LOG, f"g as (select user_id, {key}, cast(count(distinct session_id) as bigint) as {sess}, "
                 f"cast(count(distinct item_id) as bigint) as {item} from lg group by user_id, {key})") + (
        f"select i.impression_id, g.{sess}, g.{item} from imp i left join g "
        f"on i.user_id = g.user_id and i.{imp_key} = g.{key}")


def q_log_nunique_user_date() -> str:
    return _log_keyed_nunique("server_time_date", "impression_date", "user_date_sess_uniq", "user_date_item_uniq")


def q_log_nunique_user_dow() -> str:
    return _log_keyed_nunique("server_timeDayofweek", "impression_timeDayofweek", "user_daywk_sess_uniq",
                              "user_daywk_item_uniq")


def q_log_nunique_user_hour() -> str:
    return _log_keyed_nunique("server_timeHour", "impression_timeHour", "user_hr_sess_uniq", "user_hr_item_uniq")


MODE_COLS = [("item_id", "item_id"), ("item_price", "item_price"), ("category_1", "category_1"),
             ("category_2", "category_2"), ("category_3", "category_3"), ("product_type", "product_type"),
             ("server_timeDay", "server_timeDay"), ("server_timeDayofweek", "server_timeDayofweek_mode"),
             ("server_timeHour", "server_timeHour")]


def _mode_ctes() -> list[str]:
    out = []
    for i, (src, name) in enumerate(MODE_COLS):
        out.append(
            f"m{i} as (select user_id, v as {name} from (select user_id, {src} as v, row_number() over "
            f"(partition by user_id order by count(*) desc, {src} asc) as rk from lg where {src} is not null "
            f"group by user_id, {src}) where rk = 1)")
    return out


def q_log_mode_user() -> str:
    joins = " ".join(f"left join m{i} on u.user_id = m{i}.user_id" for i in range(len(MODE_COLS)))
    names = ", ".join(f"m{i}.{name}" for i, (_, name) in enumerate(MODE_COLS))
    return _with(IMP, LOG, *_mode_ctes(), "u as (select distinct user_id from lg)") + (
        f"select u.user_id, {names} from u {joins}")


def q_log_item_join() -> str:
    return _with(IMP, LOG) + ("select row_id, item_id, item_price, category_1, category_2, category_3, "
                              "product_type from lg0")


def q_date_parts() -> str:
    return _with(IMP) + ("select impression_id, impression_date, impression_timeDay, impression_timeWeek, "
                         "impression_timeDayofweek, impression_timeIs_month_end, impression_timeIs_month_start, "
                         "impression_timeHour, impression_timeMinute from imp")


def q_epoch_columns() -> str:
    return _with(IMP) + "select impression_id, impression_time_ord, us / 1e6 as total_time_secs from imp"


def q_factorize_os() -> str:
    return _with(IMP) + "select impression_id, os_version from imp"


def q_factorize_device() -> str:
    return _with(IMP, LOG) + "select row_id, device_type from lg"


def q_train_cutoff() -> str:
    return cte_prefix() + ("select impression_id, impression_time, user_id, app_code, is_click, impression_date "
                           "from a_impressions where impression_date <= date '2024-01-23'")


def q_train_test_split() -> str:
    return cte_prefix() + "select impression_id, is_click, impression_date from a_impressions where train_set = 1"


def q_union_train_test() -> str:
    return cte_prefix() + (
        "select impression_id, user_id, impression_time, is_click, 1 as train_set from a_impressions "
        "where impression_date <= date '2024-01-23' union all "
        "select impression_id, user_id, impression_time, null as is_click, 0 as train_set from a_impressions "
        "where impression_date > date '2024-01-23'")


def q_head_n() -> str:
    return cte_prefix() + ("select impression_id, user_id, impression_time, train_set from a_impressions "
                           "order by 1 - train_set, impression_time, impression_id limit 1000")


def q_scan_impressions() -> str:
    return cte_prefix() + ("select cast(impression_id as varchar) as impression_id, impression_time, user_id, "
                           "app_code, os_version, is_4G, is_click from a_impressions")


_PLANTED_OK = "{0} % 50 not in (0, 1, 2)"


def q_scan_view_log() -> str:
    return cte_prefix() + ("select server_time, device_type, session_id, user_id, item_id from a_view_log where "
                           + _PLANTED_OK.format("row_id"))


def q_scan_items() -> str:
    return ("select p_partkey as item_id, p_retailprice as item_price, cast(p_size % 5 as int) as category_1, "
            "cast(p_size % 7 as int) as category_2, cast(p_size % 11 as int) as category_3, cast(p_partkey % 13 as int) as product_type "
            "from part where " + _PLANTED_OK.format("p_partkey"))


def q_scan_rejects() -> str:
    """Planted lines: a word in one column, or a wrong number of fields."""
    one = ("select '{0}' as input, case {1} % 50 when 0 then '{2}' else '' end as columns, count(*) as n from {3} "
           "where {1} % 50 in (0, 1, 2) group by 1, 2")
    return cte_prefix() + (one.format("view_log", "row_id", "server_time", "a_view_log") + " union all "
                           + one.format("items", "p_partkey", "category_2", "part"))


def q_text_timestamps() -> str:
    return cte_prefix() + (
        "select impression_id, case when impression_id % 10 = 0 then null when impression_id % 3 = 0 "
        "then date_trunc('day', cast(impression_time as timestamp)) else date_trunc('second', cast(impression_time as timestamp)) end "
        "as parsed_time from a_impressions")


def q_run_predictions() -> str:
    return cte_prefix() + ("select cast(impression_id as varchar) as impression_id, true as is_probability "
                           "from a_impressions where train_set = 0")


def q_gbt_fold_sizes() -> str:
    return cte_prefix() + (
        "select cast(row_number() over (order by d) - 1 as int) as fold_idx, d as impression_date, n_valid from ("
        "select f.d, count(i.impression_id) as n_valid from (select cast(d as date) as d from "
        "generate_series(date '2024-01-01', date '2024-01-23', interval 1 day) t(d)) f "
        "left join a_impressions i on i.impression_date = f.d and i.train_set = 1 group by f.d)")


FOLDS = "folds as (select cast(d as date) as d from generate_series(date '2024-01-01', date '2024-01-23', interval 1 day) t(d))"


def _enc_ctes(keys: list[str], src: str = "imp", tag: str = "", fold: str = "impression_date") -> list[str]:
    """Naive per-fold encoders for one key set (fold table x other-fold rows)."""
    kl = ", ".join(f"t.{k}" for k in keys)
    nn = " and ".join(f"t.{k} is not null" for k in keys)
    on = " and ".join(f"g.{k} = r.{k}" for k in keys)
    return [
        f"tr{tag} as (select * from {src} where train_set = 1)",
        f"grp{tag} as (select f.d, {kl}, avg(t.is_click) as m, count(t.is_click) as c, sum(t.is_click) as s "
        f"from folds f join tr{tag} t on t.{fold} <> f.d where {nn} group by f.d, {kl})",
        f"dall{tag} as (select f.d, avg(t.is_click) as fm from folds f join tr{tag} t on t.{fold} <> f.d "
        "group by f.d)",
        f"dgm{tag} as (select d, avg(c) as fc, avg(s) as fs from grp{tag} group by d)",
        f"fb{tag} as (select f.d, a.fm, g.fc, g.fs from folds f left join dall{tag} a on a.d = f.d "
        f"left join dgm{tag} g on g.d = f.d)",
        f"enc_tr{tag} as (select r.impression_id, "
        f"case when r.{fold} in (select d from folds) then coalesce(g.m, fb.fm) else 0.0 end as e_mean, "
        f"case when r.{fold} in (select d from folds) then coalesce(cast(g.c as double), fb.fc) else 0.0 end "
        f"as e_count, "
        f"case when r.{fold} in (select d from folds) then coalesce(cast(g.s as double), fb.fs) else 0.0 end "
        f"as e_sum "
        f"from tr{tag} r left join fb{tag} fb on fb.d = r.{fold} "
        f"left join grp{tag} g on g.d = r.{fold} and {on})",
        f"enc_te{tag} as (select r.impression_id, sum(coalesce(g.m, fb.fm)) / (select count(*) from folds) as e_mean, "
        f"sum(coalesce(cast(g.c as double), fb.fc)) / (select count(*) from folds) as e_count, "
        f"sum(coalesce(cast(g.s as double), fb.fs)) / (select count(*) from folds) as e_sum "
        f"from {src} r join fb{tag} fb on true left join grp{tag} g on g.d = fb.d and {on} "
        f"where r.train_set = 0 group by r.impression_id)",
    ]


def _enc_query(kind: str, part: str) -> str:
    name = {"mean": "user_id_app_code_enc", "count": "user_id_app_code_countenc", "sum": "user_id_app_code_sumenc"}
    return _with(IMP, FOLDS, *_enc_ctes(["user_id", "app_code"])) + (
        f"select impression_id, {fr('e_' + kind)} as {name[kind]} from enc_{part}")


def q_enc(kind: str, part: str):
    return lambda: _enc_query(kind, part)


#: Key sets of the encoder batch, by query.
ENC_BATCHES = {
    "enc_batch": [["app_code"], ["user_id", "app_code"], ["user_id", "item_id", "product_type"]],
    "enc_batch_time": [["impression_timeHour"], ["impression_timeDayofweek"], ["os_version"], ["app_code", "impression_timeHour"],
                       ["os_version", "app_code"]],
    "enc_batch_items": [["item_price"], ["item_id"], ["user_id", "item_price"], ["user_id", "item_id"], ["product_type"]],
    "enc_batch_categories": [["category_3", "server_timeDay"], ["category_3"], ["category_2"]],
}

#: Key sets of counted features, by query: the counts come from their own plain definitions.
ENC_COUNT_BATCHES = {
    "enc_batch_counts": [["app_impression_count"], ["user_week_impcnt"], ["user_app_hr_impcnt"], ["user_app_min_impcnt"]],
    "enc_batch_distinct": [["user_day_unicount"], ["user_daywk_unicount"], ["user_moe_unicount"], ["user_mos_unicount"],
                           ["user_hr_unicount"], ["user_min_unicount"]],
    "enc_batch_log_counts": [["user_date_item_uniq"], ["user_hr_item_uniq"], ["user_hr_sess_uniq"], ["item_uniq"],
                             ["user_daywk_item_uniq"]],
}

#: Queries that define the counted features: (SQL, key).
COUNT_SOURCES = {
    "enc_batch_counts": [(q_imp_counts, "impression_id")],
    "enc_batch_distinct": [(q_imp_nunique_user, "impression_id")],
    "enc_batch_log_counts": [(q_log_nunique_user, "user_id"), (q_log_nunique_user_date, "impression_id"),
                             (q_log_nunique_user_dow, "impression_id"), (q_log_nunique_user_hour, "impression_id")],
}


def _enc_batch(key_sets: list[list[str]], source_ctes: list[str]) -> str:
    """Encodings of the key sets over the table ``impm`` that ``source_ctes`` define."""
    ctes = [*source_ctes]
    cols = []
    joins = []
    for i, keys in enumerate(key_sets):
        ctes += _enc_ctes(keys, "impm", f"_{i}")
        ctes.append(f"e_{i} as (select * from enc_tr_{i} union all select * from enc_te_{i})")
        n = "_".join(keys)
        cols += [f"{fr(f'e_{i}.e_mean')} as {n}_enc", f"{fr(f'e_{i}.e_count')} as {n}_countenc",
                 f"{fr(f'e_{i}.e_sum')} as {n}_sumenc"]
        joins.append(f"left join e_{i} on e_{i}.impression_id = x.impression_id")
    return _with(IMP, LOG, FOLDS, *ctes) + (
        f"select x.impression_id, {', '.join(cols)} from impm x {' '.join(joins)}")


def q_enc_batch(key_sets: list[list[str]]) -> str:
    joined = [(i, name) for i, (_, name) in enumerate(MODE_COLS)]
    return _enc_batch(key_sets, [*_mode_ctes(), f"impm as (select imp.*, {', '.join(f'm{i}.{n}' for i, n in joined)} from imp "
                      + " ".join(f"left join m{i} on imp.user_id = m{i}.user_id" for i, _ in joined) + ")"])


def q_enc_count_batch(name: str) -> str:
    joins = " ".join(f"left join ({sql()}) c{i} on imp.{key} = c{i}.{key}" for i, (sql, key) in enumerate(COUNT_SOURCES[name]))
    cols = [c for keys in ENC_COUNT_BATCHES[name] for c in keys]
    return _enc_batch(ENC_COUNT_BATCHES[name], [f"impm as (select imp.*, {', '.join(cols)} from imp {joins})"])


def q_model_matrix() -> str:
    """All features by their own plain definitions, put side by side."""
    by_row = [q_factorize_os, q_imp_time_lags, q_imp_gap_stats_user, q_imp_gap_stats_user_app,
              q_imp_gap_stats_user_app_dow, q_log_gap_stats_user_date, q_log_gap_stats_user_dow, q_log_nunique_user_date,
              q_log_nunique_user_dow, q_log_nunique_user_hour, q_imp_counts, q_log_ratios, q_imp_ratios, q_imp_count_lags,
              q_imp_cumcounts, q_imp_nunique_user, q_imp_nunique_user_app, q_imp_time_range,
              *[lambda k=k: q_enc_batch(k) for k in ENC_BATCHES.values()],
              *[lambda n=n: q_enc_count_batch(n) for n in ENC_COUNT_BATCHES]]
    by_user = [q_log_gap_stats_user, q_log_nunique_user, q_log_count_user, q_log_price_gap_stats_user, q_log_mode_user]
    joins = [f"left join ({sql()}) r{i} on r{i}.impression_id = i.impression_id" for i, sql in enumerate(by_row)]
    joins += [f"left join ({sql()}) u{i} on u{i}.user_id = i.user_id" for i, sql in enumerate(by_user)]
    own = ["impression_id", "user_id", "app_code", "is_4G", "train_set", "impression_date",
           *[c for c in feature_names() if c.startswith("impression_time") and not c.endswith("enc")]]
    rest = [c for c in feature_names() if c not in own]
    return _with(IMP) + (
        f"select {', '.join(f'i.{c}' for c in own)}, case when i.train_set = 1 then i.is_click end as is_click, "
        f"{', '.join(rest)} from (select {', '.join(own)}, is_click from imp) i {' '.join(joins)}")


def q_fold_sizes() -> str:
    return _with(IMP, FOLDS) + """select f.d as impression_date,
      cast(count(t.impression_id) filter (where t.impression_date = f.d) as bigint) as n_valid,
      cast(coalesce(sum(t.is_click) filter (where t.impression_date = f.d), 0) as bigint) as pos_valid,
      cast(count(t.impression_id) filter (where t.impression_date <> f.d) as bigint) as n_fit,
      cast(coalesce(sum(t.is_click) filter (where t.impression_date <> f.d), 0) as bigint) as pos_fit
    from folds f join imp t on t.train_set = 1 group by f.d"""


def q_timeseries_split() -> str:
    return _with(IMP, FOLDS) + """select f.d as impression_date,
      cast(count(t.impression_id) filter (where t.impression_date = f.d) as bigint) as n_valid,
      cast(coalesce(sum(t.is_click) filter (where t.impression_date = f.d), 0) as bigint) as pos_valid,
      cast(count(t.impression_id) filter (where t.impression_date < f.d) as bigint) as n_fit,
      cast(coalesce(sum(t.is_click) filter (where t.impression_date < f.d), 0) as bigint) as pos_fit
    from folds f join imp t on t.train_set = 1 group by f.d"""


def q_timeseries_split_gaps() -> str:
    """The fold list of A with days before and after all rows, and one listed day without rows."""
    return q_timeseries_split().replace("from folds f join imp t on t.train_set = 1 group by f.d", """from (
      select d from folds union all select date '2023-12-30' union all select date '2030-01-01') f
    join (select * from imp where impression_date <> date '2024-01-05') t on t.train_set = 1 group by f.d""")


def q_kfold_assign() -> str:
    return _with(IMP) + """select impression_id, is_click, cast((row_number() over (partition by is_click
      order by md5('42:' || cast(impression_id as varchar)), impression_id) - 1) % 5 as int) as fold
    from imp where train_set = 1"""


AUC_CTES = [
    "sc as (select r.impression_date as fold, r.is_click as y, e.e_mean as s from tr r join enc_tr e "
    "on e.impression_id = r.impression_id)",
    "per as (select fold, s, count(*) as n, sum(y) as p from sc group by fold, s)",
    "rk as (select fold, s, n, p, sum(n) over (partition by fold order by s rows between unbounded preceding "
    "and current row) - n as before from per)",
    "au as (select fold, sum(p) as npos, sum(n) - sum(p) as nneg, "
    "sum(p * (before + (n + 1) / 2.0)) as ranksum from rk group by fold)",
    "auc as (select fold, cast(npos as bigint) as n_pos, cast(nneg as bigint) as n_neg, "
    "case when npos > 0 and nneg > 0 then (ranksum - npos * (npos + 1) / 2.0) / (npos * nneg) end as auc from au)",
]


def q_auc_exact() -> str:
    return _with(IMP, FOLDS, *_enc_ctes(["user_id", "app_code"]), *AUC_CTES) + (
        f"select fold as impression_date, n_pos, n_neg, {fr('auc')} as auc from auc")


def q_fold_metrics() -> str:
    return _with(IMP, FOLDS, *_enc_ctes(["user_id", "app_code"]), *AUC_CTES) + (
        f"select cast(count(auc) as bigint) as n_folds, {fr('avg(auc)')} as mean_auc from auc")


def q_avg_fold_predictions() -> str:
    return _with(IMP, FOLDS, *_enc_ctes(["user_id", "app_code"])) + (
        f"select impression_id, {fr('e_mean')} as is_click from enc_te")



QUERIES = {
    "imp_time_lags": q_imp_time_lags,
    "imp_gap_stats_user": q_imp_gap_stats_user,
    "imp_gap_stats_user_app": q_imp_gap_stats_user_app,
    "imp_gap_stats_user_app_dow": q_imp_gap_stats_user_app_dow,
    "imp_counts": q_imp_counts,
    "imp_count_lags": q_imp_count_lags,
    "imp_cumcounts": q_imp_cumcounts,
    "imp_nunique_user": q_imp_nunique_user,
    "imp_nunique_user_app": q_imp_nunique_user_app,
    "imp_time_range": q_imp_time_range,
    "imp_ratios": q_imp_ratios,
    "log_ratios": q_log_ratios,
    "log_count_user": q_log_count_user,
    "log_time_lags": q_log_time_lags,
    "log_price_lags": q_log_price_lags,
    "log_gap_stats_user": q_log_gap_stats_user,
    "log_gap_stats_user_date": q_log_gap_stats_user_date,
    "log_gap_stats_user_dow": q_log_gap_stats_user_dow,
    "log_price_gap_stats_user": q_log_price_gap_stats_user,
    "log_nunique_user": q_log_nunique_user,
    "log_nunique_user_date": q_log_nunique_user_date,
    "log_nunique_user_dow": q_log_nunique_user_dow,
    "log_nunique_user_hour": q_log_nunique_user_hour,
    "log_mode_user": q_log_mode_user,
    "log_item_join": q_log_item_join,
    "date_parts": q_date_parts,
    "epoch_columns": q_epoch_columns,
    "factorize_os": q_factorize_os,
    "factorize_device": q_factorize_device,
    "train_cutoff": q_train_cutoff,
    "train_test_split": q_train_test_split,
    "union_train_test": q_union_train_test,
    "head_n": q_head_n,
    "scan_impressions": q_scan_impressions,
    "scan_view_log": q_scan_view_log,
    "scan_items": q_scan_items,
    "scan_rejects": q_scan_rejects,
    "text_timestamps": q_text_timestamps,
    "run_predictions": q_run_predictions,
    "gbt_fold_sizes": q_gbt_fold_sizes,
    "enc_mean_train": q_enc("mean", "tr"),
    "enc_mean_test": q_enc("mean", "te"),
    "enc_count_train": q_enc("count", "tr"),
    "enc_count_test": q_enc("count", "te"),
    "enc_sum_train": q_enc("sum", "tr"),
    "enc_sum_test": q_enc("sum", "te"),
    **{name: (lambda keys=keys: q_enc_batch(keys)) for name, keys in ENC_BATCHES.items()},
    **{name: (lambda name=name: q_enc_count_batch(name)) for name in ENC_COUNT_BATCHES},
    "model_matrix": q_model_matrix,
    "fold_sizes": q_fold_sizes,
    "timeseries_split": q_timeseries_split,
    "timeseries_split_gaps": q_timeseries_split_gaps,
    "kfold_assign": q_kfold_assign,
    "auc_exact": q_auc_exact,
    "fold_metrics": q_fold_metrics,
    "avg_fold_predictions": q_avg_fold_predictions,
    "predictions_sink": lambda: q_avg_fold_predictions().replace(
        "select impression_id, round", "select cast(impression_id as varchar) as impression_id, round"),
}


def all_sql() -> dict[str, str]:
    return {k: f() for k, f in QUERIES.items()}


# ---- binding B: day-granular times (lag ties broken by id), string app codes,
# year folds with train years outside the fold list -------------------------

FOLDS_B = "folds as (select cast(range as int) as d from range(1995, 2001))"


def _b(*parts: str) -> str:
    return _with(*parts, binding="b")


def _b_wrap(sql_a: str, parts_a: list[str], parts_b: list[str]) -> str:
    """Binding-B twin of an A query: same CTE chain after the binding parts."""
    head = _with(*parts_a).rstrip("\n")
    assert sql_a.startswith(head)
    return _b(*parts_b).rstrip("\n") + sql_a[len(head):]


def q_b_imp_cumcounts() -> str:
    return _b_wrap(q_imp_cumcounts(), [IMP], [IMP_B])


def q_b_log_gap_stats_user() -> str:
    return _b_wrap(q_log_gap_stats_user(), [IMP, LOG], [IMP_B, LOG_B])


def q_b_log_price_gap_stats_user() -> str:
    return _b_wrap(q_log_price_gap_stats_user(), [IMP, LOG], [IMP_B, LOG_B])


def q_b_log_mode_user() -> str:
    joins = " ".join(f"left join m{i} on u.user_id = m{i}.user_id" for i in range(len(MODE_COLS)))
    names = ", ".join(f"m{i}.{name}" for i, (_, name) in enumerate(MODE_COLS))
    return _b(IMP_B, LOG_B, *_mode_ctes(), "u as (select distinct user_id from lg)") + (
        f"select u.user_id, {names} from u {joins}")


def q_b_enc_user_app() -> str:
    return _b(IMP_B, FOLDS_B, *_enc_ctes(["user_id", "app_code"], fold="fold")) + (
        f"select impression_id, {fr('e_mean')} as user_id_app_code_enc, {fr('e_count')} as user_id_app_code_countenc, "
        f"{fr('e_sum')} as user_id_app_code_sumenc from (select * from enc_tr union all select * from enc_te)")


QUERIES.update({
    "b_imp_time_lags": lambda: _b_wrap(q_imp_time_lags(), [IMP, IMP_LAGS], [IMP_B, IMP_LAGS]),
    "b_imp_gap_stats_user": lambda: _b_wrap(q_imp_gap_stats_user(), [IMP, IMP_LAGS], [IMP_B, IMP_LAGS]),
    "b_imp_count_lags": lambda: _b_wrap(q_imp_count_lags(), [IMP, IMP_CNT], [IMP_B, IMP_CNT]),
    "b_imp_cumcounts": q_b_imp_cumcounts,
    "b_log_gap_stats_user": q_b_log_gap_stats_user,
    "b_log_price_gap_stats_user": q_b_log_price_gap_stats_user,
    "b_log_mode_user": q_b_log_mode_user,
    "b_enc_user_app": q_b_enc_user_app,
})
