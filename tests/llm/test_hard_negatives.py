import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, part int, positives int, norm string, v int"


def vectors():
    r = np.random.default_rng(4)
    centres = r.normal(size=(6, 8))
    rows = [(i, [float(np.float32(v)) for v in centres[i % 6] + r.normal(size=8) * 0.7], int(r.integers(0, 4))) for i in range(500)]
    rows += [(i, rows[3][1], rows[3][2]) for i in range(500, 560)]  # a group of copies
    rows += [(600, [0.0] * 8, 1), (601, [0.001] * 8, 2), (-50, rows[0][1], 1), (650, [1.0, 2.0], 1), (651, [1.0, 2.0], 1), (652, [1.0, 1.0], 2)]
    rows += [(700, None, 1), (701, [], 1), (702, [1.0] * 7 + [None], 1), (750, [math.nan] * 8, 1), (751, [math.inf] * 8, 1), (752, [1.0] * 8, None),
             (None, [1.0] * 8, 1), rows[5], rows[5]]
    return rows


def brute(rows):
    ok = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            ok[i] = ([math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label)
    out = []
    for a, (q, label) in ok.items():
        if a % 50:
            continue
        score = {i: sum(x * y for x, y in zip(q, v, strict=True)) for i, (v, _) in ok.items() if i != a and len(v) == len(q)}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if ok[i][1] == label][:5]:
            window = [i for i in order if ok[i][1] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(window[:3])]
    return sorted(out)


def mined(spark, rows):
    df = spark.createDataFrame([(*x, 1, 2, "n", 3) for x in rows], SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hn.mine(df, F.col("vec_id") % 50 == 0, label)
    assert dict(got.dtypes)["rank"] == "int" and dict(got.dtypes)["negative_score"] == "bigint"
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("values", [hn.PART_VALUES, 8 * 64])
def test_mining_against_brute_force(spark, monkeypatch, values):
    monkeypatch.setattr(hn, "PART_VALUES", values)
    rows = vectors()
    assert mined(spark, rows) == brute(rows)


def test_empty_tables_and_huge_components(spark):
    assert mined(spark, []) == []
    big = [(0, [1e18, 1.0], 1), (1, [1e18, 2.0], 1), (2, [9e17, 0.5], 2), (3, [1e300, 1.0], 2), (4, [1e307, 0.0], 2), (5, [1e3, 3.0], 3)]
    got = mined(spark, big)
    # 0 becomes label 2; scores beyond long are returned at its end, and such windows hold exact scores only
    assert all(g[0] == 0 and abs(g[4]) <= 1 << 63 for g in got)


def test_bounds_hold_and_filter():
    r = np.random.default_rng(1)
    x = np.floor(256 * np.vstack([r.normal(size=(300, 16)), r.normal(size=(1, 16)) + 0.01 * r.normal(size=(100, 16)), np.zeros((1, 16))]))
    references = np.vstack([x[:4], x[301:305]])
    theta, norm = hn.angles(x, references), hn.norms(x)
    skipped = 0
    for i in range(0, 400, 7):
        least, most = hn.score_bounds(theta, norm, theta[i], norm[i])
        exact = x @ x[i]
        assert (least <= exact).all() and (exact <= most).all()
        skipped += (most < 0.9 * norm[i] ** 2).sum()
    assert skipped > 1000  # rows that cannot come near are known without their score
