import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import spelling as S
from tests.llm.conftest import invented


def plain_words(rows):
    out = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(words):
    """All pairs, then every chain followed step by step."""
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            if words[best] >= 10 * words[w]:
                form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None)
    return out


def typos(seed, n, counts=(1, 2, 25, 300)):
    """Long words of different commonness with misspellings, some of them chains."""
    rng = random.Random(seed)
    letters = "abcdeéÿxÀ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 12))) for _ in range(n)]
    said = []
    for w in base:
        for k in counts:
            if rng.random() < 0.7:
                at = rng.randrange(len(w))
                v = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :], w])
                said += [v if rng.random() < 0.8 else v.upper()] * k
                w = v if rng.random() < 0.5 else w
    rng.shuffle(said)
    return [(i, " ".join(said[i * 40 : i * 40 + 40])) for i in range(len(said) // 40 + 1)]


def got(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_all_pairs(spark, seed):
    rows = typos(seed, 120) + [(10_000 + d, t) for d, t in invented(seed, 60)]
    words = plain_words(rows)
    want = plain(words)
    out = S.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert got(out) == want and out.count() == len(want)
    assert sum(f is not None for f, *_ in want.values()) > 20 and any(f is not None and f != r for f, r, *_ in want.values())
    assert out.select("n", "n_near", "form_n").dtypes == [("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]


def test_chains_of_forms(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2_000, "aaabbbb": 20_000, "aaabbbc": 1_999, "zzzzzzzz": 5}
    chain = [(w, f) for w, f in {w: v[0] for w, v in plain(words).items()}.items() if f]
    assert {r.word: r.root for r in S.roots(spark.createDataFrame(chain, "word string, form string")).collect()} == {w: plain(words)[w][1] for w, _ in chain}


def test_ties_go_to_the_smallest(spark):
    text = " ".join(["abcdefgé"] * 40 + ["abcdefgz"] * 40 + ["abcdefgh"] * 2)
    rows = [(d, text) for d in (2, 3, 5, 7)]
    want = plain(plain_words(rows))
    assert got(S.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == want and want["abcdefgh"][0] == "abcdefgz"


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text("abé", min_size=5, max_size=9), min_size=2, max_size=60, unique=True))
def test_no_near_pair_is_lost(spark, words):
    pairs = S.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()
    assert sorted((r.word, r.other) for r in pairs) == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(S.variants(odd)) == plain(plain_words(rows))
    long = [(1, "x" * 60_000 + " " + "x" * 60_001), (2, "x" * 60_000 + " " + "x" * 60_001), (None, "Straßen straßen STRAßEN")]
    assert got(S.variants(spark.createDataFrame(long, "doc_id long, text string"))) == plain(plain_words(long))
    assert S.variants(empty).collect() == []
