"""Exact distinct counts of several columns without repeating wide rows."""
import datetime as dt
import random

from clickweave.operators.aggregates import distinct_counts_table

COLUMNS = [("device", "n_device"), ("session", "n_session"), ("day", "n_day"), ("price", "n_price")]


def _rows(n=600):
    rng = random.Random(7)
    some = lambda values: rng.choice([None, *values])
    return [(some(range(6)), some("abc"), some(range(2 ** 53, 2 ** 53 + 9)), some([dt.date(2024, 1, d) for d in range(1, 8)]),
             some([0.5, 1.0, 1.5])) for _ in range(n)] + [(99, None, None, None, None)]


def _df(spark, rows):
    return spark.createDataFrame(rows, "user int, device string, session bigint, day date, price double")


def test_distinct_counts_against_sets(spark):
    rows = _rows()
    expected = {u: tuple(len({r[i] for r in rows if r[0] == u and r[i] is not None}) for i in range(1, 5))
                for u in {r[0] for r in rows}}
    got = {r[0]: tuple(r)[1:] for r in distinct_counts_table(_df(spark, rows), ["user"], COLUMNS).collect()}
    assert got == expected and got[99] == (0, 0, 0, 0)


def test_distinct_counts_of_an_empty_table(spark):
    out = distinct_counts_table(_df(spark, []), ["user"], COLUMNS)
    assert out.columns == ["user", *[n for _, n in COLUMNS]] and out.count() == 0


def test_distinct_counts_stay_on_the_user_layout(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = distinct_counts_table(_df(spark, _rows()).repartition("user"), ["user"], COLUMNS)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == 1, plan
