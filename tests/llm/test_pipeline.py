import random
from collections import Counter

import numpy as np
import pytest
from helpers import documents, words
from test_dedup import near_expected

import corpus_pipeline
from clickweave.llm import byte_bpe, mixing, queries, quality


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(9)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(80)]
    rows, labels = [], []
    for i in range(400):
        w = [r.choice(vocabulary) for _ in range(40)]
        kind = i % 8
        if kind == 0:
            w[r.randrange(40)] = "vileword"
        if kind == 1:
            w = [x + "***" for x in w]
        rows.append((i, " ".join(w), ["en", "de"][i % 2], "big" if i % 3 else f"s{i % 5}"))
        if i < 250:
            labels.append((i, 0 if kind == 1 else 1, 1 if kind == 0 else 0))
    by_id = {x[0]: x for x in rows}
    rows += [(1000 + i, by_id[i][1].replace(" ", "\n"), "en", "big") for i in range(2, 60, 8)]       # exact copies
    rows += [(2000 + i, by_id[i][1] + " tail", "en", "big") for i in range(3, 60, 8)]                  # near copies
    rows += [(3000, None, "en", None), (3001, "", None, "s1"), (None, "a row without id here", "en", "s1")]
    path = str(tmp_path_factory.mktemp("tables"))
    documents(spark, rows, clash=True).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def test_stages_take_effect(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, path).cache()
        steps[name] = (before, docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
    assert list(steps) == ["quality_classifier", "exact_dedup", "minhash_near_dedup", "mix_sources", "byte_bpe"]

    before, after = steps["quality_classifier"]
    judged = {(x.doc_id, x.kept) for x in quality.judge(before, spark.read.parquet(f"{path}/labels.parquet")).collect()}
    assert {x.doc_id for x in after.collect()} == {i for i, k in judged if k}
    assert not {x.doc_id for x in after.collect()} & {i for i in range(400) if i % 8 < 2}
    clean = {i for i in range(400) if i % 8 > 1}
    assert len(clean - {x.doc_id for x in after.collect()}) <= 4

    before, after = steps["exact_dedup"]
    norm = lambda t: "".join(words(t))
    groups: dict = {}
    for x in before.collect():
        groups.setdefault(norm(x.text), []).append((-len(x.text or ""), x.doc_id is None, x.doc_id or 0))
    assert Counter(x.doc_id or 0 for x in after.collect()) == Counter(min(g)[2] for g in groups.values())

    before, after = steps["minhash_near_dedup"]
    plain = [(x.doc_id, x.text) for x in before.collect()]
    kept = Counter()
    for (i, _, _, stays), n in near_expected(plain).items():
        kept[i] += n * stays
    assert Counter(x.doc_id for x in after.collect()) == +kept

    before, after = steps["mix_sources"]
    places = mixing.mix(before).collect()
    assert Counter(x.doc_id for x in after.collect()) == Counter(p.doc_id for p in places)
    assert {x.doc_id for x in after.collect()} == {x.doc_id for x in before.collect()}

    before, after = steps["byte_bpe"]
    bpe = byte_bpe.ByteBPE.load(queries.tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    back = Counter((x.doc_id, bpe.decode(np.frombuffer(x.ids, "<u4").tolist()).decode(), x.n_tokens == len(x.ids) // 4) for x in after.collect())
    assert back == Counter((x.doc_id, x.text or "", True) for x in before.collect())


def test_run_is_the_stages_in_turn(spark, folder):
    path, _ = folder
    got = corpus_pipeline.run(spark, path)
    assert got.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and got.count() > 250


def test_registry_names_every_operator_and_the_pipeline():
    import __spark_entry__ as entry
    names = entry.queries()
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names
