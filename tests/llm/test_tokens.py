import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import awkward_rows, documents

from clickweave.llm import byte_bpe, queries, token_shards

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("tokenizers")
RANKS, WORDS = queries.tokenizer_path("byte_bpe_multi_50k.tiktoken"), queries.tokenizer_path("word_bpe_49k.json")
SNIPPETS = ["a", "B", " ", "é", "É", "漢", "the", "The", "\n", "\t", "==", "12", "🙂", ".", ",", "'s", "<|endoftext|>", "ß", "İ", "Σ", " \x1c", "́"]


def snippets(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(SNIPPETS) for _ in range(r.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBPE.load(RANKS)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=queries.split_pattern(), mergeable_ranks=bpe.ranks, special_tokens={})


def test_byte_bpe_equals_the_library(bpe, library):
    encode, _ = byte_bpe.encoder(RANKS, queries.split_pattern())
    for t in snippets(400, 1) + ["=" * 3000, "word" * 700, " " * 500]:
        ids = np.frombuffer(encode(t), "<u4").tolist()
        assert ids == library.encode_ordinary(t)
        assert bpe.decode(ids) == t.encode()


def test_appends_and_edits_equal_encoding_anew(bpe):
    r = random.Random(3)
    data = bytes(r.choice(b"theaniong ") for _ in range(400))
    piece = byte_bpe.EditablePiece(bpe)
    for i in range(0, 400, 37):
        piece.append(data[i:i + 37])
    assert piece.ids() == bpe.encode(data)
    for _ in range(60):
        at = r.randrange(len(data))
        cut, new = r.randint(0, 5), bytes(r.choice(b"theaniong ") for _ in range(r.randint(0, 6)))
        data = data[:at] + new + data[at + cut:]
        piece.splice(at, cut, new)
        assert piece.data == data and piece.last == bpe.extend(data, []) and piece.ids() == bpe.encode(data)


def test_byte_bpe_digests(spark, library):
    rows = awkward_rows()
    expected = Counter()
    for i, t, *_ in rows:
        ids = np.array(library.encode_ordinary(t or ""), "<u4")
        expected[i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    docs = documents(spark, rows, clash=True)
    assert Counter(map(tuple, byte_bpe.digests(docs, RANKS, queries.split_pattern()).collect())) == expected
    coded = byte_bpe.encode_documents(docs, RANKS, queries.split_pattern())
    assert set(coded.columns) == set(docs.columns) and coded.schema["ids"].dataType.simpleString() == "binary"
    assert Counter((r.doc_id, len(r.ids) // 4) for r in coded.collect()) == Counter({(k[0], k[1]): 0 for k in expected} | Counter((k[0], k[1]) for k in expected.elements()))
    assert byte_bpe.digests(documents(spark, []), RANKS, queries.split_pattern()).count() == 0


def test_unseen_pieces_are_encoded_side_by_side(bpe, library, monkeypatch):
    """op7_byte_bpe: pieces that are no token do not fill a table each; ids, order and repeats stay, also across groups and in a full store."""
    r = random.Random(7)
    words = ["".join(r.choice("theaniongé漢🙂") for _ in range(r.randint(1, 30))) for _ in range(300)]
    pieces = [w.encode() for w in words] + [bytes(r.randrange(256) for _ in range(r.randint(0, 70))) for _ in range(300)]
    expected = [np.array(bpe.encode(p), "<u4").tobytes() for p in pieces]
    left, right = (np.array([r.choice(list(bpe.usable.values())) for _ in range(3000)]) for _ in range(2))
    assert bpe.fit_many(left, right).tolist() == [bpe.fits(int(a), int(b)) for a, b in zip(left, right)]
    alone, whole = [], byte_bpe.ByteBPE.table
    monkeypatch.setattr(byte_bpe.ByteBPE, "table", lambda self, data: alone.append(data) or whole(self, data))
    monkeypatch.setattr(byte_bpe, "SIDE_BY_SIDE", 100)
    assert bpe.encode_many(pieces) == expected
    assert all(len(p) > byte_bpe.LONGEST_PIECE or not p for p in alone)
    monkeypatch.setattr(byte_bpe, "GROUP_CHARS", 500)
    monkeypatch.setattr(byte_bpe, "STORED_PIECES", 50)
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(100)] + [None, ""]
    encode, _ = byte_bpe.text_encoder(RANKS, queries.split_pattern())
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == [library.encode_ordinary(t or "") for t in texts]
    with pytest.raises(KeyError):
        bpe.decode([len(bpe.bytes_of) + 1000])


def test_word_encoder_equals_the_library():
    tok = tokenizers.Tokenizer.from_file(WORDS)
    encode = token_shards.batch_encoder(WORDS, "<u4")
    texts = snippets(600, 2) + ["Straße. ÉTÉ, l'été don't 3.14 tion. tion, TION;"]
    for t, got in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-2**62, 2**62, 5000))
    for k in (keys, keys[:1], np.arange(3)):
        levels = token_shards.build_levels(k)
        slots = token_shards.find_slots(levels, [np.cumsum(b) for b in levels], k)
        assert sorted(slots.tolist()) == list(range(len(k)))


def shard_expected(rows):
    tok = tokenizers.Tokenizer.from_file(WORDS)
    coded = sorted(((i is not None, i or 0), np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u2").tobytes()) for i, t, *_ in rows)
    at, out = 0, Counter()
    for (there, i), data in coded:
        ids = np.frombuffer(data, "<u2").astype("<u4")
        out[i if there else None, at, len(ids), zlib.crc32(ids.tobytes())] += 1
        at += len(ids)
    return out


@pytest.mark.parametrize("shard_ids", [token_shards.SHARD_IDS, 50])
def test_shards_round_trip(spark, tmp_path, shard_ids):
    rows = awkward_rows()
    manifest = token_shards.write_shards(documents(spark, rows, clash=True), WORDS, folder=f"file://{tmp_path}", shard_ids=shard_ids)
    # repeated ids come in the order of their ids' bytes
    assert Counter(map(tuple, token_shards.read_shards(manifest).collect())) == shard_expected(rows)


def test_keyed_access(tmp_path):
    path = f"file://{tmp_path}/one.shard"
    ids = [np.arange(n, dtype="<u2") for n in (3, 0, 5, 2, 4)]
    token_shards.write_shard(path, [None, 5, 9, 9, 12], ids, "<u2")
    shard = token_shards.Shard(path)
    assert [x.tolist() for x in shard.get(None)] == [[0, 1, 2]]
    assert [x.tolist() for x in shard.get(9)] == [[0, 1, 2, 3, 4], [0, 1]]
    assert [x.tolist() for x in shard.get(5)] == [[]] and [len(x) for x in shard.get(12)] == [4]
    assert all(shard.get(k) == [] for k in range(100, 400))


def test_no_documents_no_shards(spark):
    manifest = token_shards.write_shards(documents(spark, []), WORDS)
    assert manifest.count() == 0 and token_shards.read_shards(manifest).count() == 0
