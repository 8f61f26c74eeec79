"""Closed-form out-of-fold encoders against the per-fold loop (brute force)."""
import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from clickweave.operators.folds import fold_table
from clickweave.operators.outoffold import oof_encode, oof_encode_long

FOLDS = [dt.date(2024, 1, d) for d in range(1, 7)]  # day 6 has no rows


def _data(seed=0, n=300):
    rng = np.random.default_rng(seed)
    days = rng.integers(1, 9, n)  # days 7-8: train rows outside the fold list
    pdf = pd.DataFrame({
        "rid": np.arange(n),
        "d": [dt.date(2024, 1, int(x)) for x in days],
        "a": rng.integers(0, 6, n).astype(float),
        "b": rng.integers(0, 3, n).astype(float),
        "y": rng.integers(0, 2, n),
        "train": (rng.random(n) < 0.75).astype(int),
    })
    pdf.loc[pdf.d == dt.date(2024, 1, 6), "train"] = 0
    pdf.loc[rng.choice(n, 20, replace=False), "a"] = np.nan
    pdf.loc[(pdf.train == 0) & (rng.random(n) < 0.1), "a"] = 99.0  # unseen in train
    return pdf


def _loop(pdf, keys):
    """The per-fold definition, written plainly."""
    train = pdf[pdf.train == 1].reset_index(drop=True)
    test = pdf[pdf.train == 0].reset_index(drop=True)
    out = {}
    for kind in ("mean", "count", "sum"):
        tr = np.zeros(len(train))
        te = np.zeros(len(test))
        for d in FOLDS:
            dev = train[train.d != d]
            g = dev.groupby(keys)["y"].agg(kind).reset_index().rename(columns={"y": "v"})
            fb = dev["y"].mean() if kind == "mean" else g["v"].mean()
            mask = (train.d == d).values
            tr[mask] = train[mask][keys].merge(g, how="left", on=keys)["v"].fillna(fb).values
            te += test[keys].merge(g, how="left", on=keys)["v"].fillna(fb).values
        out[kind] = (dict(zip(train.rid, tr)), dict(zip(test.rid, te / len(FOLDS))))
    return out


def _check(spark, pdf, keys, long, max_broadcast_rows=None):
    df = spark.createDataFrame(pdf.astype({"a": "object", "b": "object"}).where(pdf.notna(), None))
    ft = fold_table(spark, FOLDS, "date", "d")
    if long:
        got = oof_encode_long(df, [keys], "y", "d", "train", ft, len(FOLDS), "rid",
                              max_broadcast_rows=max_broadcast_rows).toPandas()
    else:
        got = oof_encode(df, keys, "y", "d", "train", ft, len(FOLDS)).toPandas()
    exp = _loop(pdf, keys)
    name = "_".join(keys)
    for kind, sfx in (("mean", "_enc"), ("count", "_countenc"), ("sum", "_sumenc")):
        tr, te = exp[kind]
        for rid, value in zip(got.rid, got[name + sfx]):
            want = tr.get(rid, te.get(rid))
            assert abs(value - want) < 1e-9, (kind, rid, value, want)


def test_closed_form_single_key(spark):
    _check(spark, _data(0), ["a"], long=False)


def test_closed_form_pair_key_long_format(spark):
    _check(spark, _data(1), ["a", "b"], long=True)


def test_long_format_shuffle_lookup(spark):
    _check(spark, _data(4), ["a", "b"], long=True, max_broadcast_rows=0)


def test_no_leak_from_own_fold(spark):
    pdf = _data(2)
    ft = fold_table(spark, FOLDS, "date", "d")
    to_df = lambda p: spark.createDataFrame(p.astype({"a": "object", "b": "object"}).where(p.notna(), None))  # noqa
    base = oof_encode(to_df(pdf), ["a"], "y", "d", "train", ft, len(FOLDS)).toPandas().set_index("rid")
    flipped = pdf.copy()
    on_d = (flipped.d == FOLDS[0])
    flipped.loc[on_d, "y"] = 1 - flipped.loc[on_d, "y"]
    test_flip = flipped.copy()
    test_flip.loc[test_flip.train == 0, "y"] = 1 - test_flip.loc[test_flip.train == 0, "y"]
    again = oof_encode(to_df(test_flip), ["a"], "y", "d", "train", ft, len(FOLDS)).toPandas().set_index("rid")
    rows = pdf.rid[on_d & (pdf.train == 1)]
    assert np.allclose(base.loc[rows, "a_enc"], again.loc[rows, "a_enc"])  # own labels never seen
    test_rows = pdf.rid[pdf.train == 0]
    flipped_only_test = pdf.copy()
    flipped_only_test.loc[flipped_only_test.train == 0, "y"] = 1 - flipped_only_test.loc[flipped_only_test.train == 0, "y"]
    third = oof_encode(to_df(flipped_only_test), ["a"], "y", "d", "train", ft, len(FOLDS)).toPandas().set_index("rid")
    assert np.allclose(base.loc[test_rows, "a_enc"], third.loc[test_rows, "a_enc"])  # test labels unused


def test_small_key_sets_are_looked_up_in_place(spark, monkeypatch):
    """No row is repeated per key set of few keys; sets of both kinds together equal each alone."""
    from clickweave.operators import outoffold

    pdf = _data(7)
    df = spark.createDataFrame(pdf.astype({"a": "object", "b": "object"}).where(pdf.notna(), None))
    ft, sets = fold_table(spark, FOLDS, "date", "d"), [["a"], ["b"], ["a", "b"]]
    encode = lambda sets, most=None: oof_encode_long(df, sets, "y", "d", "train", ft, len(FOLDS), "rid", max_broadcast_rows=most)
    alone = [encode([k]).toPandas().set_index("rid").sort_index() for k in sets]
    monkeypatch.setattr(outoffold, "SETS_PER_PASS", 1)
    for most, in_place in ((None, True), (80, False)):
        out = encode(sets, most)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert (not any("Generate explode" in x and "[e#" in x for x in plan.splitlines())) is in_place
        got = out.toPandas().set_index("rid").sort_index()
        for keys, one in zip(sets, alone):
            for sfx in ("_enc", "_countenc", "_sumenc"):
                assert np.allclose(got["_".join(keys) + sfx], one["_".join(keys) + sfx], atol=1e-9)
