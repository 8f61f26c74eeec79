from collections import Counter
from fractions import Fraction

import pytest
from helpers import awkward_rows, documents
from pyspark.sql import functions as F

from clickweave.llm import mixing


def test_every_prefix_is_within_one_block(spark):
    w = spark.createDataFrame([("=a", 5, 7), ("=b", 5, 2), ("=c", 5, 1), ("=d", 5, 11), ("null", 1, 3)], "source string, n long, a long")
    rows = mixing.pfair_period(w).collect()
    q = 24
    order = {r.slot: r for r in rows}
    assert sorted(order) == list(range(q))
    done = Counter()
    for t in range(q):
        r = order[t]
        assert (r.j * q) // r.a <= t < -(-(r.j + 1) * q // r.a)  # between release and deadline
        assert r.j == done[r.source]
        done[r.source] += 1
        for s, a in (("=a", 7), ("=b", 2), ("=c", 1), ("=d", 11), ("null", 3)):
            assert abs(done[s] - Fraction(a * (t + 1), q)) < 1
    assert done == {"=a": 7, "=b": 2, "=c": 1, "=d": 11, "null": 3}


@pytest.mark.parametrize("block", [1, 3])
def test_the_mix_is_whole_and_meets_the_weights(spark, block):
    rows = [(i, f"t{i}", "en", "ab"[i % 3 == 0]) for i in range(90)] + [(500, "x", "en", None)]
    got = mixing.mix(documents(spark, rows, clash=True), {"a": 0.5, "b": 0.3, None: 0.2}, block_rows=block, resolution=20).collect()
    assert sorted(r.position for r in got) == list(range(len(got)))
    assert {r.doc_id for r in got} == {r[0] for r in rows}
    share = {"a": 0.5, "b": 0.3, None: 0.2}
    seen = Counter()
    for t, r in enumerate(sorted(got, key=lambda r: r.position), 1):
        seen[r.source] += 1
        assert all(abs(seen[s] - w * t) < 2 * block for s, w in share.items())
        if t % block == 0:
            assert all(abs(seen[s] - w * t) < block + 1e-9 for s, w in share.items())
    # within a source, an epoch starts when all rows have been given
    for s in share:
        ids = [r.doc_id for r in sorted(got, key=lambda r: r.position) if r.source == s]
        n = len(set(ids))
        assert all(len(set(ids[k:k + n])) == len(ids[k:k + n]) for k in range(0, len(ids), n))


def test_awkward_rows_and_empty_tables(spark):
    rows = awkward_rows()
    docs = documents(spark, rows, clash=True)
    got = mixing.mix_rows(docs)
    assert got.columns == docs.columns
    counts = Counter(map(tuple, got.collect()))
    assert set(counts) == set(map(tuple, docs.collect()))
    assert mixing.mix(documents(spark, [])).count() == 0 and mixing.mix_rows(documents(spark, [])).count() == 0


def test_weights(spark):
    docs = documents(spark, [(i, "t", "en", "ab"[i % 2]) for i in range(10)])
    assert {r.source for r in mixing.mix(docs, {"a": 1, "b": 0}).collect()} == {"a"}
    with pytest.raises(Exception, match="no weight for source"):
        mixing.mix(docs, {"a": 1}).collect()


def test_no_python_on_the_main_path(spark):
    plan = mixing.mix(documents(spark, awkward_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_ranking_buckets_give_the_same_mix(spark, monkeypatch):
    rows = [(i, f"t{i}", "en", "ab"[i % 3 == 0]) for i in range(200)]
    docs = documents(spark, rows)
    one = Counter(map(tuple, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    assert Counter(map(tuple, mixing.mix(docs).withColumn("slot", F.col("slot")).collect())) == one


def test_a_one_row_source_is_within_one_block_of_its_real_weight(spark):
    rows = [(i, "t", "en", f"s{i % 4}") for i in range(40_000)] + [(99_999, "x", "en", "tiny")]
    got = mixing.mix(documents(spark, rows), block_rows=8).groupBy("slot", "source").agg(F.count("*").alias("c")).orderBy("slot").collect()
    sizes = Counter(r[3] for r in rows)
    total = sum(n ** 0.7 for n in sizes.values())
    done = Counter()
    for t, r in enumerate(got, 1):
        assert r.slot == t - 1 and r.c == 8
        done[r.source] += 1
        assert all(abs(done[s] - t * n ** 0.7 / total) < 1 + 1e-6 for s, n in sizes.items())
    assert len(got) >= 5000 and done["tiny"] <= 3


def plain_schedule(weights, slots):
    """(source index, block) per slot: the released block with the earliest deadline."""
    q, done, out = sum(weights), [0] * len(weights), []
    for t in range(slots):
        _, _, i = min((-(-(done[i] + 1) * q // a), -a, i) for i, a in enumerate(weights) if done[i] * q // a <= t)
        out.append((i, done[i]))
        done[i] += 1
    return out


@pytest.mark.parametrize("weights, segment", [
    ([999_983, 1, 17, 400, 5_000, 70_001], 16), ([449, 450, 451, 3, 2, 2, 1], 8), ([1] * 9, 9), ([2**39, 2**38 + 1, 12345, 3], 32)])
def test_segments_give_the_schedule_of_one_run(spark, monkeypatch, weights, segment):
    monkeypatch.setattr(mixing, "SEGMENT", segment)
    monkeypatch.setattr(mixing, "CHUNK", 5)
    slots = min(sum(weights), 700)
    w = spark.createDataFrame([(f"={i:02}", 1, a) for i, a in enumerate(weights)], "source string, n long, a long")
    rows = sorted(mixing.pfair_period(w, slots).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(slots))
    assert [(int(r.source[1:]), r.j) for r in rows] == plain_schedule(weights, slots)
    assert all(r.a == weights[int(r.source[1:])] and r.q == sum(weights) for r in rows)
