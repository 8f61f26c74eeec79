import hashlib
import random
from collections import Counter, defaultdict

from helpers import awkward_rows, documents, words
from pyspark.sql import functions as F

from clickweave.llm import exact_dedup, near_dedup, substring_dedup
from clickweave.llm.common import components


def exact_expected(rows):
    norm = lambda t: (t or "").translate({c: None for c in (32, *range(9, 14))})
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[norm(t)].append((-len(t or ""), i is None, i or 0, i))
    out = Counter()
    for i, t, *_ in rows:
        g = groups[norm(t)]
        keep = min(g)[3]
        out[i, keep, len(g), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()] += 1
    return out


def test_exact_classes_on_awkward_rows(spark):
    rows = awkward_rows()
    expected = exact_expected(rows)
    assert Counter(map(tuple, exact_dedup.exact_classes(documents(spark, rows, clash=True)).collect())) == expected


def test_exact_classes_survive_hash_collisions(spark):
    rows = awkward_rows()
    weak = lambda norm: F.unhex(F.hex(F.length(norm) % 3))
    got = exact_dedup.exact_classes(documents(spark, rows), digest=weak)
    assert Counter(map(tuple, got.collect())) == exact_expected(rows)


def test_drop_exact_copies_keeps_one_row_of_each_text(spark):
    rows = awkward_rows()
    docs = documents(spark, rows, clash=True)
    got = exact_dedup.drop_exact_copies(docs)
    assert got.columns == docs.columns
    kept = {(k[1], k[4]) for k in exact_expected(rows)}
    assert Counter(r.doc_id for r in got.collect()) == Counter(i for i, _ in kept)


def test_dedup_of_empty_tables(spark):
    docs = documents(spark, [])
    assert exact_dedup.exact_classes(docs).count() == 0 and exact_dedup.drop_exact_copies(docs).count() == 0
    assert near_dedup.near_duplicates(docs).count() == 0
    assert substring_dedup.remove_repeats(docs).count() == 0


def shingles(t):
    w = words(t, lower=True)
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def near_expected(rows):
    sets = [(i, shingles(t)) for i, t, *_ in rows]
    up = {i: i for i, _ in sets if i is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (i, x) in enumerate(sets):
        for j, y in sets[:n]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((root(i), root(j)))
                up[q] = p
    return Counter((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets)


def copies(n, edits, seed):
    r = random.Random(seed)
    base = [f"w{r.randint(0, 400)}" for _ in range(120)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"e{r.randint(0, 999)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_match_brute_force(spark):
    rows = awkward_rows() + [(100 + i, t, "en", "s9") for i, t in enumerate(copies(150, 6, 1) + copies(40, 12, 2))]
    docs = documents(spark, rows, clash=True)
    expected = near_expected(rows)
    assert Counter(map(tuple, near_dedup.near_duplicates(docs).collect())) == expected
    # nodes above 30 members are branched by Spark
    assert Counter(map(tuple, near_dedup.near_duplicates(docs, task_members=30).collect())) == expected


def test_a_large_group_next_to_the_threshold(spark):
    """Some thousand variants of one text, most pairs at a similarity of 0.6 to 0.85: recall of linked documents."""
    import numpy as np

    r = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(1500):
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(150)] = f"e{r.randint(0, 99999)}"
        rows.append((i, " ".join(w), "en", "s"))
    sets = [shingles(t) for _, t, *_ in rows]
    number: dict = {}
    have = np.zeros((len(sets), 400_000), np.float32)
    for i, x in enumerate(sets):
        have[i, [number.setdefault(h, len(number)) for h in x]] = 1
    have = have[:, :len(number)]
    both, n = have @ have.T, np.array([len(x) for x in sets])
    linked = 100 * both >= 75 * (n[:, None] + n[None, :] - both)
    assert 0.1 < ((100 * both >= 65 * (n[:, None] + n[None, :] - both)) & ~linked).mean() and 0.1 < linked.mean() < 0.9
    component = np.arange(len(sets))
    while True:
        new = np.where(linked, component[None, :], len(sets)).min(1)
        if (new == component).all():
            break
        component = new
    got = {x.doc_id: x.component_id for x in near_dedup.near_duplicates(documents(spark, rows)).collect()}
    assert all(got[i] >= c for i, c in enumerate(component))  # nothing is linked that is not
    assert np.mean([got[i] == c for i, c in enumerate(component)]) >= 0.99


def test_a_node_emits_a_forest_and_keeps_the_callers_cache(spark):
    import numpy as np

    r = np.random.default_rng(2)
    ids = np.arange(300) * 7
    sets = [np.unique(np.append(r.choice(10_000, 4), np.arange(40))).astype(np.uint64) for _ in ids]
    sketch = r.integers(0, 3, size=(300, near_dedup.COORDINATES)).astype(np.uint8)
    a, b = near_dedup.forest(5, ids, ids, sketch * 0, sets)
    assert len(a) == 299 and (a < b).all() and set(a) | set(b) == set(ids)
    exact = np.array([[len(np.intersect1d(x, y)) for y in sets[:40]] for x in sets[:40]])
    assert ((near_dedup.overlaps(sets[:40]) == exact) | np.eye(40, dtype=bool)).all()
    held = spark.range(10).cache()
    held.count()
    components(spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "a long, b long"))
    assert held.storageLevel.useMemory
    held.unpersist()


def removal_expected(rows, k):
    texts = [words(t) for _, t, *_ in rows]
    seen = Counter(tuple(w[i:i + k]) for w in texts for i in range(len(w) - k + 1))
    out = Counter()
    for (i, *_), w in zip(rows, texts, strict=True):
        gone = set()
        for p in range(len(w) - k + 1):
            if seen[tuple(w[p:p + k])] > 1:
                gone.update(range(p, p + k))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept] += 1
    return out


def test_repeated_windows_match_brute_force(spark):
    rows = awkward_rows()
    docs = documents(spark, rows, clash=True)
    for k in (35, 6):
        got = substring_dedup.remove_repeats(docs, window=k, with_text=True)
        assert Counter(map(tuple, got.collect())) == removal_expected(rows, k)


def test_a_crowded_sketch_loses_nothing(spark):
    rows = [r for r in awkward_rows() if r[0] is not None and r[0] not in (6, 7)]
    got = substring_dedup.remove_repeats(documents(spark, rows), window=6, with_text=True, max_columns=64, flush=100)
    assert Counter(map(tuple, got.collect())) == removal_expected(rows, 6)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 140)] + [(7, 7), (5, 4), (200, 201), (201, 139)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys([*range(100, 140), 200, 201], 100)}
