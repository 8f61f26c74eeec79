"""Neighbour values and running positions against pandas, with and without
hot-group buckets."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from clickweave.operators.sequences import next_name, prev_name, with_neighbors, with_positions


def _frame(spark, n=400, groups=7, seed=0):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "id": np.arange(n),
        "g": rng.integers(0, groups, n).astype(float),
        "t": rng.integers(0, 50, n),  # many ties, broken by id
        "v": rng.normal(size=n),
    })
    pdf.loc[rng.choice(n, 15, replace=False), "g"] = np.nan
    return pdf, spark.createDataFrame(pdf.astype({"g": "object"}).where(pdf.notna(), None))


def _expected(pdf, depth):
    s = pdf.sort_values(["t", "id"])
    out = s[["id"]].copy()
    for k in range(1, depth + 1):
        out[f"p{k}"] = s.groupby("g")["v"].shift(k)  # NaN groups are dropped by groupby
        out[f"n{k}"] = s.groupby("g")["v"].shift(-k)
    return out.set_index("id").sort_index()


def _got(df, depth):
    pdf = df.toPandas().set_index("id").sort_index()
    return pd.DataFrame({**{f"p{k}": pdf[prev_name("v", k)] for k in range(1, depth + 1)},
                         **{f"n{k}": pdf[next_name("v", k)] for k in range(1, depth + 1)}}, index=pdf.index)


def test_neighbors_match_grouped_shift(spark):
    pdf, df = _frame(spark)
    got = _got(with_neighbors(df, ["g"], [F.col("t"), F.col("id")], {"v": 3}), 3)
    exp = _expected(pdf, 3)
    pd.testing.assert_frame_equal(got[exp.columns].astype(float), exp.astype(float), check_names=False)


def test_bucketed_neighbors_equal_plain(spark):
    pdf, df = _frame(spark, seed=1)
    order = [F.col("t"), F.col("id")]
    bucket = F.when(F.col("g") < 4, F.floor(F.col("t") / 7))  # groups 0-3 "hot", others whole
    got = _got(with_neighbors(df, ["g"], order, {"v": 5}, bucket), 5)
    exp = _expected(pdf, 5)
    pd.testing.assert_frame_equal(got[exp.columns].astype(float), exp.astype(float), check_names=False)


def test_positions_bucketed_equal_plain(spark):
    _, df = _frame(spark, seed=2)
    order = [F.col("t"), F.col("id")]
    specs = [(["g"], "pos", "size")]
    a = with_positions(df, specs, order).select("id", "pos", "size")
    b = with_positions(df, specs, order, F.floor(F.col("t") / 5)).select("id", "pos", "size")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    nulls = a.filter(F.col("pos").isNull()).count()
    assert nulls == df.filter(F.col("g").isNull()).count()
