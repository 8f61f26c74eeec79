"""Hand-made fixtures, one per rule (FIXTURES.md section 5)."""
import datetime as dt

from pyspark.sql import functions as F

from clickweave.functions.dates import date_part_columns
from clickweave.operators.aggregates import mode_table, modes_table, stat_columns
from clickweave.operators.dictionary import encode_first_seen
from clickweave.operators.folds import fold_table
from clickweave.operators.outoffold import oof_encode
from clickweave.plans import features as fp

D = dt.datetime


def _imps(spark, rows):
    schema = ("impression_id long, impression_time timestamp_ntz, user_id long, app_code int, "
              "os_version string, is_4G int, is_click int, impression_date date, train_set int")
    return spark.createDataFrame(rows, schema)


def _lagged(spark, rows):
    df = fp.prepare_impressions(_imps(spark, rows))
    return fp._impression_lags(fp._impression_counts(df), None, fp.FeatureConfig())


def test_one_row_user(spark):
    df = _lagged(spark, [(1, D(2018, 12, 1, 10), 7, 1, "a", 0, 1, dt.date(2018, 12, 1), 1)])
    r = df.collect()[0]
    assert r["user_prev_time"] is None and r["user_time_diff1"] is None
    s = df.groupBy("user_id").agg(*stat_columns("__d1", "x")).collect()[0]
    assert s["x_std"] is None and s["x_min"] is None


def test_two_row_user_second_difference_null(spark):
    rows = [(1, D(2018, 12, 1, 10), 7, 1, "a", 0, 1, dt.date(2018, 12, 1), 1),
            (2, D(2018, 12, 1, 11), 7, 1, "a", 0, 0, dt.date(2018, 12, 1), 1)]
    df = _lagged(spark, rows)
    assert all(r["user_time_diff1"] is None for r in df.collect())
    assert sorted(r["user_time_diffprev"] for r in df.collect() if r["user_time_diffprev"] is not None) == [3600.0]


def test_tied_modes_take_smallest(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 3), (1, 3), (2, None)], "u long, item long")
    assert {r["u"]: r["item"] for r in mode_table(df, ["u"], "item").collect()} == {1: 3}
    users = df.select("u").distinct()
    many = users.join(modes_table(df, ["u"], [("item", "item")]), "u", "left").collect()
    assert {r["u"]: r["item"] for r in many} == {1: 3, 2: None}


def test_all_null_column_keeps_row(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "u long, price double")
    users = df.select("u").distinct()
    r = users.join(modes_table(df, ["u"], [("price", "price")]), "u", "left").collect()
    assert len(r) == 1 and r[0]["price"] is None
    s = df.groupBy("u").agg(*stat_columns("price", "p", seconds=False)).collect()[0]
    assert s["p_mean"] is None and s["p_std"] is None


def _enc(spark, rows, folds):
    schema = "rid long, k long, d date, y int, train int"
    df = spark.createDataFrame(rows, schema)
    ft = fold_table(spark, folds, "date", "d")
    out = oof_encode(df, ["k"], "y", "d", "train", ft, len(folds))
    return {r["rid"]: (r["k_enc"], r["k_countenc"], r["k_sumenc"]) for r in out.collect()}


def test_key_on_one_date_falls_back(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [(1, 5, d1, 1, 1), (2, 6, d1, 0, 1), (3, 6, d2, 1, 1), (4, 6, d2, 1, 1)]
    got = _enc(spark, rows, [d1, d2])
    # key 5 lives on d1 only: on d1 it falls back to the mean of d2's rows
    assert got[1][0] == 1.0 and got[1][1] == 2.0 and got[1][2] == 2.0
    assert got[2] == (1.0, 2.0, 2.0)  # key 6 on d2 has 2 rows, 2 clicks


def test_unseen_and_null_keys_and_empty_fold(spark):
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    rows = [(1, 5, d1, 1, 1), (2, 6, d2, 0, 1), (3, None, d2, 1, 1),
            (4, 9, d3, None, 0), (5, None, d3, None, 0), (6, 5, dt.date(2024, 1, 9), 1, 1)]
    got = _enc(spark, rows, [d1, d2, d3])  # d3 has no train rows
    # fold fallbacks of the mean: d1 -> mean of rows 2,3,6 = 2/3; d2 -> rows 1,6 = 1; d3 -> all = 3/4
    assert abs(got[3][0] - 2 / 3) > 0 and abs(got[3][0] - 1.0) < 1e-12  # null key on d2 -> fallback of d2
    expect_test = (2 / 3 + 1.0 + 0.75) / 3
    assert abs(got[4][0] - expect_test) < 1e-12 and abs(got[5][0] - expect_test) < 1e-12
    assert got[6] == (0.0, 0.0, 0.0)  # train date outside the fold list


def test_month_edges_week_and_sunday(spark):
    df = spark.createDataFrame([(D(2018, 11, 30, 5),), (D(2018, 12, 1, 5),), (D(2018, 12, 31, 5),),
                                (D(2018, 12, 2, 5),)], "t timestamp_ntz")
    got = df.select("t", *[c.alias(n) for n, c in date_part_columns("t", "t").items()]).collect()
    by = {r["t"].date(): r for r in got}
    assert by[dt.date(2018, 11, 30)]["tIs_month_end"] == 1 and by[dt.date(2018, 11, 30)]["tIs_month_start"] == 0
    assert by[dt.date(2018, 12, 1)]["tIs_month_start"] == 1
    assert by[dt.date(2018, 12, 31)]["tWeek"] == 1
    assert by[dt.date(2018, 12, 2)]["tDayofweek"] == 6


def test_unseen_or_null_category_is_minus_one(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "o long, os string")
    out = {r["o"]: r["os"] for r in encode_first_seen(df, "os", [F.col("o")]).collect()}
    assert out == {1: 0, 2: 1, 3: -1, 4: 0}
    codes = spark.createDataFrame([("b", 0)], "os string, code int")
    other = {r["o"]: r["os"] for r in encode_first_seen(df, "os", [F.col("o")], codes=codes).collect()}
    assert other[2] == -1


def test_epoch_and_parts_ignore_session_zone(spark):
    from clickweave.functions.dates import epoch_micros

    df = spark.createDataFrame([(D(2018, 11, 4, 1, 30),), (D(2018, 12, 31, 23, 59, 59),)], "t timestamp_ntz")

    def snapshot():
        cols = [epoch_micros("t").alias("us"), *[c.alias(n) for n, c in date_part_columns("t", "t").items()]]
        return sorted(tuple(r) for r in df.select(*cols).collect())

    before = snapshot()
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # a DST change on 2018-11-04
        after = snapshot()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert before == after
    assert before[0][0] == 1541295000 * 10**6  # 2018-11-04 01:30:00 wall clock, no zone


def test_modes_keep_each_value_in_its_own_type(spark):
    from decimal import Decimal
    rows = [(1, 2**53 + 1, Decimal("10.00"), "b"), (1, 2**53 + 1, Decimal("9.00"), "a"), (1, 2**53, None, None)]
    df = spark.createDataFrame(rows, "u int, id bigint, price decimal(10,2), name string")
    got = modes_table(df, ["u"], [("id", "id"), ("price", "price"), ("name", "name")]).collect()[0]
    assert (got["id"], got["price"], got["name"]) == (2**53 + 1, Decimal("9.00"), "a")


def test_bounded_distinct_counts_refuse_other_values(spark):
    import pytest

    from clickweave.operators.aggregates import count_distinct
    ok = spark.createDataFrame([(1, 0), (1, 63), (1, 63), (1, None)], "u int, v int")
    assert ok.groupBy("u").agg(count_distinct("v", "n", bounded=True)).collect()[0]["n"] == 2
    for bad in (64, -1):
        rows = spark.createDataFrame([(1, 5), (1, bad)], "u int, v int")
        with pytest.raises(Exception, match="outside 0..63"):
            rows.groupBy("u").agg(count_distinct("v", "n", bounded=True)).collect()


def test_time_series_split_with_empty_folds(spark):
    from clickweave.operators.folds import fold_table, timeseries_split_sizes
    train = spark.createDataFrame([(1, 1), (3, 0), (3, 1)], "f int, y int")
    got = {r["f"]: tuple(r)[1:] for r in timeseries_split_sizes(train, "f", "y", fold_table(spark, [1, 2, 3, 9], "int", "f")).collect()}
    assert got == {1: (1, 1, 0, 0), 2: (0, 0, 1, 1), 3: (2, 1, 1, 1), 9: (0, 0, 3, 2)}


def test_rows_without_a_user_are_split_off_and_long_hot_lists_joined(spark):
    from clickweave.operators.skew import split_hot
    rows = [(None, i) for i in range(500)] + [(i % 5, i) for i in range(500)]
    df = spark.createDataFrame(rows, "u int, x int")
    for limit in (100, 1):
        s = split_hot(df, ["u"], threshold=50, max_hot_keys=limit)
        assert (s.n_hot, s.small) == (5, limit == 100)
        assert (s.normal.count(), s.hot.count(), s.unkeyed.count()) == (0, 500, 500)


def test_folds_are_dealt_within_each_label(spark):
    from collections import Counter

    from clickweave.operators.folds import kfold_assign
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 2) for i in range(300)], "id int, y int")
    got = Counter((r["y"], r["fold"]) for r in kfold_assign(df, "id", 3, label="y").collect())
    for y in (None, 0, 1):
        sizes = [got[y, f] for f in range(3)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) > 0
