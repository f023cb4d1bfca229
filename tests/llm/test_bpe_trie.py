import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskloom.llm import bpe_trie as B
from tests.llm.conftest import LONG, invented

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return B.Encoder(B.vocabulary(PATH))


def test_equals_the_library(library, encoder):
    rng = random.Random(4)
    texts = [t for _, t in invented(2, 200)]
    texts += ["", " ", "\n\n  \t x", "<|endoftext|>", "a<|endoftext|><|endoftext|> b <|endoftex", "it's we'll I'D 12345  6", "日本語のテキスト 👩‍👩‍👧 ﷽", "a" * 5000, "0" * 3000, " " * 999, "x" * 3 + "\0\1\x7f"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF)])) for _ in range(200)) for _ in range(100)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:80]
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(library, encoder, text):
    assert encoder.encode([text])[0] == library.encode(text, add_special_tokens=False).ids


def test_words_share_prefix_states(encoder):
    words = [w.encode() for w in ("the", "then", "thenth", " thing", "things", "", "th")]
    got = B.encode_words(words, encoder.v)
    ids = encoder.v.ids
    assert got == {w: tuple(ids[t] for t in encoder.v.merge(w)) for w in words}


def test_memory_bound_does_not_change_results(monkeypatch, encoder, library):
    monkeypatch.setattr(B, "REMEMBERED", 10)
    monkeypatch.setattr(B, "AT_ONCE", 300)
    texts = [t for _, t in invented(8, 60)]
    assert B.Encoder(encoder.v).encode(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_decode_replaces_bad_bytes(library, encoder):
    ids = library.encode("日本é", add_special_tokens=False).ids
    for cut in range(len(ids)):
        assert encoder.decode(ids[cut:]) == library.decode(ids[cut:], skip_special_tokens=False)


def test_odd_rows(odd, empty, library):
    got = B.encode(odd, PATH, with_ids=True).collect()
    assert len(got) == odd.count()
    none = hashlib.sha256(b"").hexdigest()
    by = {r.doc_id: r for r in got}
    assert (by[1].n_tokens, by[1].ids_sha256, by[1].decoded_sha256) == (by[2].n_tokens, none, none) == (0, none, none)
    assert by[7].decoded == LONG and by[7].ids == library.encode(LONG, add_special_tokens=False).ids
    assert B.encode(empty, PATH).collect() == []
