import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward_rows, documents, words
from pyspark.sql import functions as F

from clickweave.llm import context_mixing, cross_polytope, licenses, quality


# ---- nearest neighbours ------------------------------------------------------------------


def vectors(n=400, size=12, seed=3):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, size)) * r.uniform(0.5, 2.0, size=(n, 1))
    x[5], x[6], x[7] = x[20], x[20], 0  # ties and a zero vector
    rows = [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]
    odd = [(1000, None), (1001, []), (1002, [1.0, None] + [0.0] * 10), (1003, [math.nan] * 12), (1004, [math.inf] + [0.0] * 11),
           (None, [1.0] * 12), (1020, [1.0, 2.0]), (1040, [2.0, 1.0]), (1041, [3.0, 3.0])]
    return rows + odd + [rows[3]]


def brute(rows, k, asked):
    ok = {i: np.array(v) for i, v in sorted(((i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)), reverse=True)}
    out = {}
    for q in ok:
        if asked(q):
            scored = sorted((-float((ok[q] * v).sum()), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


@pytest.mark.parametrize("cell_rows", [4096, 7])
def test_search_recall_ranks_and_scores(spark, cell_rows):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, id int, cell string")
    expected = brute(rows, 20, lambda q: q % 20 == 0)
    got: dict = {}
    for r in cross_polytope.nearest(df, F.col("vec_id") % 20 == 0, cell_rows=cell_rows).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(expected)
    hit = total = 0
    for q, best in expected.items():
        assert [x[0] for x in got[q]] == list(range(1, len(best) + 1))
        assert [(x[1], x[2]) for x in got[q]] == sorted(((x[1], x[2]) for x in got[q]), key=lambda x: (-x[1], x[0]))
        hit += len({i for i, _ in best} & {x[1] for x in got[q]})
        total += len(best)
    assert hit / total >= 0.9


def test_few_vectors_are_all_found(spark):
    rows = [(i, [float(i), 1.0, -float(i)]) for i in range(0, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = cross_polytope.nearest(df, F.col("vec_id") == 4, tables=1, probes=1).collect()
    assert {r.vec_id for r in got} == {0, 1, 2, 3, 5, 6, 7, 8}
    assert cross_polytope.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_rotations_keep_inner_products():
    x = np.random.default_rng(0).normal(size=(5, 16))
    y = cross_polytope.rotate(x, cross_polytope._signs(16, 1)[0])
    assert np.allclose(y @ y.T, x @ x.T)


# ---- language model ------------------------------------------------------------------------


def base_expected(rows):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, *_ in rows]
    tokens = [[*words(t, lower=True), None] for _, t, *_ in rows]
    c = Counter(w for h, ws in zip(held, tokens, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
            for (i, *_), h, ws in zip(rows, held, tokens, strict=True)]


@pytest.mark.parametrize("table_words", [10**6, 3])
def test_language_model_base_and_probability(spark, table_words):
    rows = awkward_rows()
    got = context_mixing.scores(documents(spark, rows, clash=True), table_words=table_words).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == Counter(base_expected(rows))
    assert all(r.score < 0 and math.isfinite(r.score) and r.bits_per_byte > 0 for r in got)


def test_probabilities_of_tokens_sum_to_one():
    tables = [context_mixing.log_odds(*np.random.default_rng(i).integers(0, 5, size=(2, 1 << b)).astype(np.float32)) for i, b in enumerate(context_mixing.SLOTS)]
    mixer = context_mixing.Mixer()
    # all first bytes: the eight bits of a byte are a distribution over 256 values
    first = [bytes([x]) for x in range(256) if x != 32]
    s = context_mixing.Spelled(first + [b""], 0)
    total = np.zeros(len(s.data))
    for node, bit, slots in s.bits():
        odds = np.stack([t[0][x] for t, x in zip(tables, slots, strict=True)])
        level = np.stack([t[1][x] for t, x in zip(tables, slots, strict=True)])
        p = mixer.probability(odds, level, node)
        total += np.log(np.where(bit == 1, p, 1 - p))
    begin = np.concatenate([[True], s.word[1:] != s.word[:-1]])
    assert abs(np.exp(total[s.event[begin]]).sum() - 1) < 1e-9


def test_language_model_learns(spark):
    text = lambda i: " ".join(["alpha", "beta", "gamma", "delta"][(i + j) % 4] for j in range(30))
    rows = [(i, text(i), "en", "s") for i in range(60)] + [(i, "qzxv kjwq " * 15, "en", "s") for i in range(1000, 1010)]
    got = {r.doc_id: r for r in context_mixing.scores(documents(spark, rows[:60])).collect()}
    assert all(r.bits_per_byte < 1.0 for r in got.values())
    assert context_mixing.scores(documents(spark, [])).count() == 0
    only_held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 == 2]
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in context_mixing.scores(documents(spark, only_held)).collect())


# ---- quality -------------------------------------------------------------------------------------


def quality_tables(spark, n=300, extra=()):
    import random
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(80)]
    rows, labels = [], []
    for i in range(n):
        w = [r.choice(vocabulary) for _ in range(40)]
        kind = i % 8
        if kind == 0:
            w[r.randrange(40)] = "vileword"
        if kind == 1:
            w = [x + "***" for x in w]
        rows.append((i, " ".join(w), "en", f"s{i % 4}"))
        if i % 3 != 2 or i % 2:
            labels.append((i, 0 if kind == 1 else 1, 1 if kind == 0 else 0))
    return documents(spark, rows + list(extra), clash=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = quality_tables(spark)
    got = {r.doc_id: r.kept for r in quality.judge(docs, labels.filter("doc_id < 200")).collect()}
    wrong = [i for i in range(200, 300) if got[i] != (i % 8 > 1)]
    assert len(wrong) <= 3
    kept = quality.accepted(docs, labels.filter("doc_id < 200"))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, k in got.items() if k}


def test_awkward_documents_and_labels(spark):
    docs, labels = quality_tables(spark, extra=awkward_rows())
    more = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 0, None), (2, 1, 0)], "doc_id long, quality int, toxic int")
    n = docs.count()
    assert quality.judge(docs, labels.union(more)).filter("kept IS NOT NULL AND path_posterior BETWEEN 0 AND 1").count() == n
    assert quality.judge(docs, labels.limit(0)).filter("kept").count() == n
    assert quality.judge(docs.limit(0), labels).count() == 0 and quality.accepted(docs.limit(0), labels).count() == 0


def test_sites_shrink_towards_their_parents(spark):
    rows = [(f"h{h}", f"p{p}", 4.0 if h == 0 else -4.0) for h in range(5) for p in range(2) for _ in range(50)] + [("rare", "p", 4.0)]
    df = spark.createDataFrame(rows, "host string, path string, score double")
    got = {(r.host, r.path): r for r in quality.site_posteriors(df, F.col("host"), F.col("path"), "score").collect()}
    corpus = got["h0", "p0"].corpus
    assert got["h0", "p0"].host_rate > 0.9 and got["h1", "p0"].host_rate < 0.1
    assert corpus < got["rare", "p"].host_rate < got["h0", "p0"].host_rate


# ---- licenses --------------------------------------------------------------------------------------


WRAPPED = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""
MIT_LONG = max(range(len(licenses.TEMPLATES)), key=lambda i: len(licenses.TEMPLATES[i][1]))


def license_expected(files, templates, threshold):
    import re
    terms = lambda t: [x for x in re.split(r"[^\w]|_", t.lower()) if x]
    lines = {p: [x for x in (t or "").split("\n") if x.strip(" ")] for p, t in files}
    every = [x for ls in lines.values() for x in ls]
    df = Counter(t for x in every for t in set(terms(x)))
    idf = lambda t: math.log((1 + len(every)) / (1 + df[t])) + 1
    vec = lambda t: {x: c * idf(x) for x, c in Counter(terms(t)).items()}
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    own, speaks = {}, {}
    unit = [{x: w / size(v) for x, w in v.items()} for v in (vec(t) for _, t in templates)]
    deciding = licenses.deciding_terms(unit, threshold, {x: idf(x) for v in unit for x in v})
    for p, ls in lines.items():
        best, covered = [], set()
        named = re.search(licenses.LICENSE_FILE, p.split("/")[-1])
        runs = {(i, k) for k in range(1, licenses.HEADER_LINES + 1) for i in range(len(ls) - k + 1)} | ({(0, len(ls))} if named else set())
        for i, k in runs:
            v = vec(" ".join(ls[i:i + k]))
            if v:
                scored = [(round(sum(v.get(t, 0) * w for t, w in u.items()) / size(u) / size(v), 9), n) for n, u in ((n, vec(t)) for n, t in templates)]
                top = min((-s, n) for s, n in scored)
                if -top[0] >= threshold:
                    best.append(top)
                    covered |= {n for n in range(i, i + k) if deciding & set(terms(ls[n]))}
        if best:
            own[p] = (min(best)[1], -min(best)[0])
            if named or 2 * len(covered) >= len(ls):
                speaks.setdefault("/".join(p.split("/")[:-1]), []).append(own[p])
    voice = {}
    for d, xs in speaks.items():
        count = Counter(n for n, _ in xs)
        voice[d] = min((-count[n], -max(s for m, s in xs if m == n), n) for n in count)[2]
    out = {}
    for p in lines:
        d = p.split("/")[:-1]
        up = next((("/".join(d[:k])) for k in range(len(d), -1, -1) if "/".join(d[:k]) in voice), None)
        out[p] = own[p][0] if p in own else voice.get(up), own.get(p, (None,))[0], voice.get(up), up
    return out


def test_license_scan_matches_brute_force(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [("a/LICENSE", mit), ("a/b/c/x.txt", "some text\nand more text here"), ("a/b/y.txt", "words\n" + apache + "\nmore\nlines\nhere"),
             ("z/q.txt", "the of this work is"), ("NOTICE", "This work is licensed under the GNU General Public License, version 3."),
             ("z/k/half.txt", apache + "\nbody"), ("z/k/other.txt", ""), ("z/k/none.txt", None), ("z/long.txt", "word " * 20000),
             ("z/near.txt", "released under a MIT license"), ("top.txt", "plain"), ("w/gpl.py", WRAPPED + "\n\nimport os\nrun()\n" * 3),
             ("w/v/COPYING", "Copyright\n\n" + "\n".join(licenses.TEMPLATES[MIT_LONG][1].split(", "))),
             ("w/cut.py", "# This work is licensed under the GNU\n# General Public License, version 3.\nx = 1\ny = 2\nz = 3")]
    df = spark.createDataFrame([(i, p, t, "x") for i, (p, t) in enumerate(files)], "doc_id long, path string, text string, license string")
    got = licenses.scan(df, F.col("path"))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    expected = license_expected(files, licenses.TEMPLATES, licenses.THRESHOLD)
    assert {r.path: (r.license, r.own_license, r.inherited_license, r.inherited_from) for r in got.collect()} == expected


def test_wrapped_headers_and_many_notices_in_one_text(spark):
    many = "\n".join(["Released under the MIT License."] * 3000)
    files = [("g/a.py", WRAPPED), ("g/cut.py", "# This work is licensed under the GNU\n# General Public License, version 3."), ("m/many.txt", many),
             ("m/many.txt", "x\ny"), ("q/COPYING", "\n".join(licenses.TEMPLATES[MIT_LONG][1].split(" ")))]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(files)], "doc_id long, path string, text string")
    got = {r.doc_id: r for r in licenses.scan(df, F.col("path")).collect()}
    assert [got[i].own_license for i in range(5)] == ["GPL-3.0", "GPL-3.0", "MIT", "MIT", "MIT"]
    assert all(got[i].score > 1 - 1e-6 for i in range(5)) and got[2].inherited_license == "MIT"


def test_license_scan_of_awkward_rows(spark):
    docs = documents(spark, awkward_rows(), clash=True)
    got = licenses.scan(docs, F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))
    assert got.count() == docs.count() and got.filter("license IS NOT NULL").count() == 0
    assert licenses.scan(docs, F.lit(None)).count() == docs.count()
    assert licenses.scan(documents(spark, []), F.col("source")).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_ordinary_words_around_a_notice(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(licenses, "BROADCAST_TERMS", -1)
    common = "that en it for with was one not all you".split()
    notice = "released under the mit license"
    files = [(f"n{k}/x.txt", " ".join([*common[:k // 2], notice, *common[k // 2:k]])) for k in (0, 5, 8, 10)]
    files += [(f"o{i}/x.txt", " ".join(common) + f" w{i}") for i in range(300)]
    files += [("rare/x.txt", notice + " q1 q2 q3 q4 q5 q6 q7 q8")]  # rare words still weigh
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(files)], "doc_id long, path string, text string")
    got = {r.path: r for r in licenses.scan(df, F.col("path")).filter("license IS NOT NULL").collect()}
    every = [set(t.split()) for _, t in files]
    weigh = lambda x: math.log((1 + len(every)) / (1 + sum(x in t for t in every))) + 1
    size = lambda t: math.sqrt(sum(weigh(x) ** 2 for x in t.split()))
    assert set(got) == {"n0/x.txt", "n5/x.txt", "n8/x.txt", "n10/x.txt"}
    for p, t in files[:4]:
        assert got[p].license == "MIT" and abs(got[p].score - size(notice) / size(t)) < 1e-6


def test_deciding_terms_bound_the_cosine():
    v = {"a": 0.8, "b": 0.5, "c": math.sqrt(1 - 0.64 - 0.25)}
    assert licenses.deciding_terms([v], 0.6) == {"a", "b"} and licenses.deciding_terms([v], 0.61) == {"a"}


def test_language_model_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(context_mixing, "LEARN_ROWS", 40)  # several blocks of words
    docs = documents(spark, awkward_rows())
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for n in (3, 13):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            got.append(sorted((tuple(r) for r in context_mixing.scores(docs.repartition(n)).collect()), key=str))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert got[0] == got[1] and len(got[0]) == len(awkward_rows())


def test_counts_of_bits_above_32_bits():
    rows = [(b"the", 0, 5_000_000_000), (b"then", 0, 3), (b"the", 1, 4_000_000_000), (b"a", 0, 7_000_000_001)]
    schema = pa.schema([("word", pa.binary()), ("class", pa.int32()), ("c", pa.int64())])
    pieces = []
    for part in (rows[:2], rows[2:], rows):  # three tasks
        b = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*part), schema, strict=True)], schema=schema)
        pieces += [r for out in context_mixing._count_bits(iter([b])) for r in out.to_pylist()]
    pieces.sort(key=lambda r: r["chunk"])
    columns = list(zip(*[tuple(r.values()) for r in pieces]))
    merged = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, context_mixing._PIECE, strict=True)], schema=context_mixing._PIECE)
    total = np.zeros(2)
    for out in context_mixing._add_pieces(iter([merged])):
        for r in out.to_pylist():
            n = len(r["slots"]) // 2
            total += [context_mixing._read_numbers(r[k], n).sum() for k in ("zeros", "ones")]
    bits = [0, 0]
    for word, _, c in rows:
        for byte in word + b" ":
            ones = bin(byte).count("1")
            bits[0] += 2 * c * (8 - ones)
            bits[1] += 2 * c * ones
    assert total.tolist() == [x * len(context_mixing.SLOTS) for x in bits]
