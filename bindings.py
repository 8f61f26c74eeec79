"""Bindings: the contest's tables as views over the driver's test tables.

The same SQL text runs in Spark SQL and in DuckDB (the oracle), so both
engines see identical inputs.  Binding A (``events`` + ``part``) is the
correctness binding; binding B (``orders`` + ``lineitem`` + ``part``) has
day-granular times (real ties) and ten times more log rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

TABLES = ("events", "part", "orders", "lineitem")

# Fixed values of binding A: train dates 2024-01-01..2024-01-23 (23 folds),
# test 2024-01-24..2024-01-30.
A_CUTOFF = dt.date(2024, 1, 23)
A_FOLDS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(23)]
# Fixed values of binding B: folds are the order years 1995..2000.
B_FOLDS = list(range(1995, 2001))

A_VIEWS = {
    "a_ev": """
select event_id, ts, user_id, event_type, value,
       cast(regexp_extract(props, '[0-9]+', 0) as int) as k
from events""",
    "a_impressions": """
select event_id as impression_id, ts as impression_time, user_id, k % 7 as app_code,
       case k % 3 when 0 then 'latest' when 1 then 'intermediate' else 'old' end as os_version,
       k % 2 as is_4G,
       case when event_type = 'click' then 1 else 0 end as is_click,
       cast(ts as date) as impression_date,
       case when cast(ts as date) <= date '2024-01-23' then 1 else 0 end as train_set
from a_ev where event_type in ('click', 'view')""",
    "a_view_log": """
select event_id as row_id, ts as server_time, event_type as device_type,
       user_id * 1000 + cast(floor(hour(ts) / 6) as bigint) as session_id,
       user_id, cast(floor(value) as bigint) * 7 as item_id
from a_ev where event_type in ('purchase', 'signup', 'error')""",
    "a_item_data": """
select p_partkey as item_id, p_retailprice as item_price, p_type as category_1,
       p_brand as category_2, p_size as category_3, p_name as product_type
from part""",
}

B_VIEWS = {
    "b_impressions": """
select o_orderkey as impression_id, o_orderdate as impression_time, o_custkey as user_id,
       o_orderpriority as app_code,
       case o_custkey % 3 when 0 then 'latest' when 1 then 'intermediate' else 'old' end as os_version,
       cast(o_orderkey % 2 as int) as is_4G,
       case when o_orderstatus = 'F' then 1 else 0 end as is_click,
       cast(o_orderdate as date) as impression_date,
       case when year(o_orderdate) <= 2000 then 1 else 0 end as train_set,
       year(o_orderdate) as fold
from orders""",
    "b_view_log": """
select l_orderkey, l_linenumber, l_suppkey, l_shipdate as server_time, l_returnflag as device_type,
       l_orderkey as session_id, o_custkey as user_id, l_partkey as item_id
from lineitem join orders on l_orderkey = o_orderkey""",
}

A_LOG_ORDER = ("server_time", "session_id", "item_id", "row_id")
B_LOG_ORDER = ("server_time", "l_orderkey", "l_linenumber", "item_id", "l_suppkey")


def cte_prefix(names: list[str] | None = None, binding: str = "a") -> str:
    """``WITH`` clause defining the binding views (for DuckDB oracle SQL)."""
    views = dict(A_VIEWS)
    if binding == "b":
        views.update(B_VIEWS)
        views["b_item_data"] = views["a_item_data"]
    order = list(views) if names is None else names
    return "with " + ",\n".join(f"{n} as ({views[n].strip()})" for n in order) + "\n"


def register(spark: SparkSession, sf_dir: str, binding: str = "a") -> dict[str, DataFrame]:
    """Register the source tables and the binding views in Spark; return the
    views.  Only the needed columns reach the parquet scans (pruning)."""
    for t in TABLES:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").createOrReplaceTempView(t)
    views = dict(A_VIEWS)
    if binding == "b":
        views.update(B_VIEWS)
    out = {}
    for name, sql in views.items():
        df = spark.sql(sql)
        df.createOrReplaceTempView(name)
        out[name] = df
    if binding == "b":
        out["b_item_data"] = out["a_item_data"]
    return out
