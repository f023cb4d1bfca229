import os
import random
import zlib

import numpy as np
import pytest

from riskloom.llm import token_store as T
from riskloom.llm import word_ids
from riskloom.llm.queries import tokenizer_file
from riskloom.session import scratch_path
from tests.llm.conftest import invented

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
PATH = tokenizer_file("word_bpe_49k.json")
BITS = ["'", "'s", "'re", "'ll", "'v", "'d", "s", "t", "re", " ", "\n", "\t", "\r", "a", "É", "ſ", "ŉ", "Ÿ", "1", "12", "²", "×", "!", '"', "—", "<|endoftext|>", "\0", "\x0b", "İ", "é", "日", "Σ", "\xa0"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def plain(library, rows):
    """Start, number and CRC-32 of the ids of each row, in order of id, text hash left aside."""
    out, start = {}, 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.setdefault(doc, []).append((start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_words_equal_the_library(library):
    rng = random.Random(3)
    encoder = word_ids.Encoder(PATH)
    assert encoder.by_words
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 14))) for _ in range(2_000)] + [t for _, t in invented(5, 100)] + ["x" * 5_000, ""]
    for at in range(0, len(texts), 97):
        got = encoder.encode(texts[at : at + 97])
        assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts[at : at + 97]]


def test_words_are_forgotten(library, monkeypatch):
    monkeypatch.setattr(word_ids, "REMEMBERED", 50)
    monkeypatch.setattr(word_ids, "AT_ONCE", 500)
    encoder = word_ids.Encoder(PATH)
    texts = [t for _, t in invented(6, 200)]
    assert [g.tolist() for g in encoder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_grammar_round_trip(seed):
    rng = np.random.default_rng(seed)
    for ids in (rng.integers(0, 4, 5_000), rng.zipf(1.3, 30_000) % 40_000, np.full(4_097, 7), np.tile([1, 2, 3], 2_000), np.zeros(0), np.array([5]), np.repeat(rng.integers(0, 9, 500), 20)):
        ids = ids.astype(np.uint32)
        grammar = T.Grammar.load(T.Grammar.of(ids).stored())
        assert (grammar.expand() == ids).all() and (grammar.rules < grammar.first + np.arange(len(grammar.rules))[:, None]).all()
        for _ in range(20):
            a, b = sorted(rng.integers(-2, len(ids) + 3, 2).tolist())
            assert grammar.slice(a, b).tolist() == ids[max(a, 0) : max(b, 0)].tolist()


def test_frequent_pairs_become_rules():
    ids = np.tile(np.array([3, 1, 4, 1, 5, 9, 2, 6], np.uint32), 1_000)
    grammar = T.Grammar.of(ids)
    assert len(grammar.sequence) < 100 and grammar.lengths.max() >= 64
    for k, (a, b) in enumerate(grammar.rules):
        sizes = [1 if s < grammar.first else grammar.lengths[s - grammar.first] for s in (a, b)]
        assert grammar.lengths[k] == sum(sizes)


def test_store_equals_the_library(spark, library):
    rows = invented(9, 150) + [(1_000, "Größe <|endoftext|> 日本"), (1_001, None), (None, "no id")]
    path = scratch_path(spark, "store")
    T.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), PATH, path, shard=700)
    want = plain(library, rows)
    got = T.read(spark, path).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32, list(r.ids)) for r in got} == {d: v[0] for d, v in want.items()} and len(got) == len(rows)
    shards = T.shards(spark, path).collect()
    assert len(shards) > 10 and all(len(s.doc_id) == 1 or s.n_tokens <= 700 + len(s.doc_id) for s in shards)


def test_fetch(spark, library):
    rows = invented(9, 60)
    path = scratch_path(spark, "store")
    T.write(spark.createDataFrame(rows, "doc_id long, text string"), PATH, path, shard=700)
    want = plain(library, rows)
    asked = [(d, a, a + n) for d in range(0, 60, 3) for a, n in ((0, 3), (5, 40), (10_000, 10_001))] + [(999, 0, 4), (None, 0, 1), (3, None, 2), (3, -1, 2)]
    got = T.fetch(spark, path, spark.createDataFrame(asked, "doc_id long, from long, to long")).collect()
    assert sorted((r.doc_id, r["from"], r.to, list(r.ids)) for r in got) == [(d, a, b, want[d][0][3][a:b]) for d, a, b in sorted(asked[:-4])]


def test_repeated_ids_and_odd_rows(spark, library, odd, empty):
    path = scratch_path(spark, "store")
    T.write(odd, PATH, path)
    got = T.read(spark, path).collect()
    want = plain(library, [(r.doc_id, r.text) for r in odd.collect()])
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted((str(d), *x[:3]) for d, v in want.items() for x in v)
    path = scratch_path(spark, "store")
    T.write(empty, PATH, path)
    assert T.read(spark, path).collect() == [] and T.fetch(spark, path, spark.createDataFrame([(1, 0, 2)], "doc_id long, from long, to long")).collect() == []
