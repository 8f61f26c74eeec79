"""Skew handling and plan shape."""
from pyspark.sql import functions as F

import bindings
from clickweave.plans import features as fp

SF = "/root/testdata/sf0.001"


def _build(spark, cfg):
    v = bindings.register(spark, SF)
    log = fp.prepare_log(fp.join_items(v["a_view_log"], v["a_item_data"]), cfg)
    return fp.impression_features(fp.prepare_impressions(v["a_impressions"]), fp.log_features(log, cfg), cfg)


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def test_hot_users_give_same_features(spark):
    normal = _build(spark, fp.FeatureConfig(log_order=bindings.A_LOG_ORDER))
    hot = _build(spark, fp.FeatureConfig(log_order=bindings.A_LOG_ORDER, hot_rows=15, chunk_rows=40))
    cols = sorted(normal.columns)
    assert sorted(hot.columns) == cols
    a, b = _rounded(normal.select(cols)), _rounded(hot.select(cols))
    assert a.count() == b.count() == 398
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_user_block_shuffles_once_by_user(spark):
    v = bindings.register(spark, SF)
    cfg = fp.FeatureConfig(log_order=bindings.A_LOG_ORDER)
    imps = fp.prepare_impressions(v["a_impressions"])
    held = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # plan as at scale: no broadcasts
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        log = fp.log_features(fp.prepare_log(fp.join_items(v["a_view_log"], v["a_item_data"]), cfg), cfg)
        block = fp._user_block(imps.repartition("user_id"), log, cfg, held)
        plan = block._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for h in held:
            h.unpersist()
    user_shuffles, other_shuffles = _shuffles(block._jdf.queryExecution().executedPlan())
    # the repartition by user is the only shuffle of impression rows; every
    # count, window and (user, ...) join runs on that partitioning
    assert user_shuffles == 1, plan
    # the (user, date / weekday / hour) log tables were built on the user layout and join without a shuffle
    assert other_shuffles == [], other_shuffles


def _row_shuffles(root):
    """Exchanges whose rows carry an impression id, each cached sub-plan counted once: (wide, of border rows)."""
    seen, stack, wide, rim = set(), [root], [], []
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "InMemoryTableScanExec":
            cached = node.relation().cachedPlan()
            if cached.toString() not in seen:
                seen.add(cached.toString())
                stack.append(cached)
        if name == "ShuffleExchangeExec":
            columns = [node.output().apply(i).name() for i in range(node.output().size())]
            if "impression_id" in columns:
                border = any(c.startswith(("__cw_rn", "__rim")) for c in columns)
                (rim if border else wide).append((node.outputPartitioning().toString(), len(columns), [c for c in columns if c.startswith("__")]))
        stack += [node.children().apply(i) for i in range(node.children().size())]
    return wide, rim


def _one_hour(spark, n=900):
    """A user whose rows all share one hour, many of them one instant, beside an ordinary one."""
    return spark.range(n).selectExpr(
        "cast(id as string) as impression_id", "timestamp_ntz'2024-01-03 10:00:00' + make_interval(0, 0, 0, 0, 0, 0, greatest(0, id - 500) % 1800) as impression_time",
        "case when id < 800 then 1L else 2L end as user_id", "cast(id % 3 as int) as app_code", "'a' as os_version", "cast(id % 2 as int) as is_4G",
        "cast(id % 5 = 0 as int) as is_click", "date'2024-01-03' as impression_date", "cast(id % 7 > 0 as int) as train_set")


def _one_hour_log(spark, n=700):
    return spark.range(n).selectExpr(
        "id as row_id", "timestamp_ntz'2024-01-03 10:00:00' + make_interval(0, 0, 0, 0, 0, 0, greatest(0, id - 300) % 600) as server_time",
        "cast(id % 4 as string) as device_type", "id % 9 as session_id", "case when id < 600 then 1L else 2L end as user_id", "id % 11 as item_id")


def test_a_user_with_all_rows_in_one_hour_is_split(spark):
    v = bindings.register(spark, SF)
    built = []
    for cfg in (fp.FeatureConfig(log_order=bindings.A_LOG_ORDER),
                fp.FeatureConfig(log_order=bindings.A_LOG_ORDER, hot_rows=200, chunk_rows=100)):
        log = fp.prepare_log(fp.join_items(_one_hour_log(spark), v["a_item_data"]), cfg)
        built.append(_rounded(fp.impression_features(fp.prepare_impressions(_one_hour(spark)), fp.log_features(log, cfg), cfg)))
    assert built[0].count() == 900 and built[0].exceptAll(built[1]).count() == 0 and built[1].exceptAll(built[0]).count() == 0
    split = fp.split_hot(fp.prepare_impressions(_one_hour(spark)), ["user_id"], 200)
    assert (split.n_hot, split.hot_rows) == (1, 800)
    sizes = [r["count"] for r in fp.hot_layout(split.hot, split.hot_rows, cfg).groupBy("user_id", fp.CHUNK).count().collect()]
    assert len(sizes) == 8 and sum(sizes) == 800 and max(sizes) <= 200


def test_hot_rows_are_shuffled_twice(spark):
    """By range (before the written chunks) and by (user, chunk); after that only border rows and grouped tables move."""
    cfg = fp.FeatureConfig(log_order=bindings.A_LOG_ORDER, hot_rows=15, chunk_rows=40)
    v = bindings.register(spark, SF)
    imps = fp.prepare_impressions(v["a_impressions"])
    held = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        log = fp.log_features(fp.prepare_log(fp.join_items(v["a_view_log"], v["a_item_data"]), cfg), cfg)
        split = fp.split_hot(imps, ["user_id"], cfg.hot_rows)
        block = fp._user_block(fp.hot_layout(split.hot, split.hot_rows, cfg), log, cfg, held, hot=True)
        wide, rim = _row_shuffles(block._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for h in held:
            h.unpersist()
    assert len(wide) == 1 and "__chunk" in wide[0][0], wide  # the shuffle by range lies before the written chunks
    assert len(rim) <= 2, rim


def _shuffles(root):
    """(repartition-by-user shuffle count, other shuffles) in a physical plan,
    each cached sub-plan counted once."""
    seen, stack, user, other = set(), [root], 0, []
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "InMemoryTableScanExec":
            cached = node.relation().cachedPlan()
            key = cached.toString()
            if key not in seen:
                seen.add(key)
                stack.append(cached)
        if name == "ShuffleExchangeExec":
            text = node.toString()
            if "REPARTITION_BY_COL" in text and "hashpartitioning(user_id" in text:
                user += 1
            else:
                other.append(node.toString())
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
    return user, other


def test_cutoff_reaches_the_scan(spark):
    import __spark_entry__ as se
    df = se.queries()["train_cutoff"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts,2024-01-24T00:00)" in plan, plan
    assert "value:" not in plan.split("ReadSchema:")[1].split("\n")[0]  # unused column pruned


def test_rows_are_dealt_by_their_number(spark):
    """the rows of a task do not grow with the table, whatever the shuffle would merge by bytes."""
    from clickweave.operators.skew import dealt_by

    rows = spark.range(1000).selectExpr("id", "id % 300 as user_id")
    assert dealt_by(rows, ["user_id"], 1000, 50).rdd.getNumPartitions() == 20
    assert dealt_by(rows, ["user_id"], 1000, 10**6).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_join_back_sorts_no_rows(spark):
    """a grouped table is hashed beside the rows; sorting wide rows once per table took a task's memory."""
    from clickweave.operators.aggregates import join_back

    rows = spark.range(100).selectExpr("id", "if(id % 9 = 0, null, id % 7) as k").repartition(3, "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = join_back(rows, rows.groupBy("k").agg(F.count("*").alias("n")), ["k"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r.id: r.n for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "Sort [" not in plan, plan
    assert len(got) == 100 and all((got[i] is None) == (i % 9 == 0) for i in got)


def test_only_narrow_rows_are_held_and_wide_ones_not_sorted(spark):
    """Persisted frames have no lags of counts, statistics or log columns; joins carry structs."""
    v = bindings.register(spark, SF)
    cfg = fp.FeatureConfig(log_order=bindings.A_LOG_ORDER)
    held = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        log = fp.log_features(fp.prepare_log(fp.join_items(v["a_view_log"], v["a_item_data"]), cfg), cfg)
        block = fp._user_block(fp.prepare_impressions(v["a_impressions"]).repartition("user_id"), log, cfg, held)
        nodes, widest, sorts = [block._jdf.queryExecution().executedPlan()], 0, 0
        while nodes:
            node = nodes.pop()
            name = node.getClass().getSimpleName()
            widest = max(widest, node.output().size() if name == "ShuffledHashJoinExec" else 0)
            sorts += name == "SortExec"
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for h in held:
            h.unpersist()
    assert max(len(h.columns) for h in held) < 60
    assert not {c for h in held for c in h.columns if c.endswith(("_nxt", "_mean", "_uniq"))}
    assert len(block.columns) > 250 and widest < 40 and sorts == 0, (widest, sorts)


def test_log_tables_of_a_build_are_compressed_and_the_log_is_dropped(spark, monkeypatch):
    """A checkpoint holds plain rows; tables that are dealt anew need none, and the written log is read no more."""
    from clickweave.session import path_exists

    v = bindings.register(spark, SF)
    cfg = fp.FeatureConfig(log_order=bindings.A_LOG_ORDER)
    written, whole = [], fp.write_table
    monkeypatch.setattr(fp, "write_table", lambda df, name, path=None, by=(): written.append(path) or whole(df, name, path, by))
    log = fp.prepare_log(fp.join_items(v["a_view_log"], v["a_item_data"]), cfg)
    plain, tables = fp.log_features(log, cfg), fp.log_features(log, cfg, fp.compact)
    assert not any(path_exists(spark, p) for p in written if p) and sum(p is not None for p in written) == 2
    for name in ("user", "user_date", "user_dow", "user_hour"):
        a, b = _rounded(getattr(plain, name)), _rounded(getattr(tables, name))
        assert "FileScan parquet" in b._jdf.queryExecution().executedPlan().toString()
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
