import random

import numpy as np
import pytest

from riskloom.llm import decontaminate as D
from tests.llm.conftest import LONG

rng = random.Random(12)
COMMON = "the of and to in a is that it was for on are with as his they at be this".split()
RARE = ["".join(rng.choice("bcdfglmnprstaeiou") for _ in range(rng.randint(3, 9))) for _ in range(6000)]


def say(k):
    return [rng.choice(COMMON) if rng.random() < 0.4 else rng.choice(RARE) for _ in range(k)]


ITEMS = [(i, say(rng.randint(12, 90))) for i in range(60)]


def brute(docs):
    """Exact containment of the words of an item."""
    out = {}
    for d, words in docs:
        line = " " + " ".join(words) + " "
        out[d] = {i for i, w in ITEMS if f" {' '.join(w)} " in line}
    return out


def found(spark, docs, items=ITEMS):
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    return {r.doc_id: {int(x) for x in r.item_ids.split(",") if x} for r in D.contaminated(df, bench).collect()}


@pytest.mark.parametrize("block", [D.BLOCK_PIECES, 20])
def test_passages_are_found_and_clean_texts_left(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_PIECES", block)
    monkeypatch.setattr(D, "BLOCKS_AT_ONCE", 3)
    docs = []
    for d in range(200):
        words = say(rng.randint(0, 300))
        for i in rng.sample(range(60), rng.choice([0, 0, 1, 2])):
            at = rng.randint(0, len(words))
            words = words[:at] + ITEMS[i][1] + words[at:]
        docs.append((d, words))
    want, got = brute(docs), found(spark, docs)
    assert all(want[d] <= got[d] for d in want)
    assert [d for d in want if got[d] and not want[d]] == []


def test_paraphrases(spark):
    docs = [(i, say(50) + [x if rng.random() > 0.2 else rng.choice(RARE) for x in w] + say(50)) for i, w in ITEMS]
    got = found(spark, docs)
    assert sum(i in got[i] for i, _ in ITEMS) >= 0.9 * len(ITEMS)


def test_recall_of_the_candidate_search_against_all_cosines(spark):
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in ITEMS], "item_id long, text string")
    block = next(D._blocks(bench))[0]
    weights = np.zeros((len(block.pieces), len(block.vocabulary)))
    for k, p in enumerate(block.pieces):
        at, w = D._weights(p, block.vocabulary, block.idf)
        weights[k, at] = w / np.linalg.norm(w)
    exact = weights @ weights.T
    latent = block.folded @ block.folded.T
    assert np.abs(exact - latent).max() < 0.05


def test_lcs():
    for _ in range(200):
        a = np.array([rng.randrange(6) for _ in range(rng.randint(1, 20))], np.uint64)
        b = np.array([rng.randrange(6) for _ in range(rng.randint(0, 30))], np.uint64)
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert D.lcs(D.places(a), len(a), b) == t[-1][-1]
        assert D.lcs(D.places(a), len(a), b, t[-1][-1]) == t[-1][-1]


def test_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, " ".join(LONG.split()[5000:5040]), "x"), (2, None, "x"), (None, "", "x"), (3, "a b", None)], "item_id long, text string, doc_id string")
    got = {r.doc_id: r for r in D.contaminated(odd, bench).collect()}
    assert {d for d, r in got.items() if r.contaminated} == {6, 7} and got[6].item_ids == "1" and got[6].best_share == 1.0
    assert D.contaminated(odd, bench).count() == odd.count()
    assert D.contaminated(empty, bench).collect() == []
    assert not any(r.contaminated for r in D.contaminated(odd, bench.limit(0)).collect())


def test_short_items_are_found_word_by_word(spark):
    items = [(1, "what colour is a zebra".split()), (2, "three blind mice".split()), (3, "a b".split()), (4, say(20)), (5, "three blind mice".split())]
    docs = [(1, say(30) + items[0][1] + say(30)), (2, "see three Blind, mice run".split()), (3, "three blind grey mice".split()), (4, say(40) + items[3][1]), (5, "a b c".split()), (6, ["three", "blind"]), (7, ["mice", "run"])]
    assert found(spark, docs, items) == {1: {1}, 2: {2, 5}, 3: set(), 4: {4}, 5: set(), 6: set(), 7: set()}


@pytest.mark.parametrize("passes", [1, 2])
def test_rows_of_one_id_are_judged_by_their_own_text(spark, monkeypatch, passes):
    if passes > 1:
        monkeypatch.setattr(D, "BLOCK_PIECES", 20)
        monkeypatch.setattr(D, "BLOCKS_AT_ONCE", 1)
    df = spark.createDataFrame([(1, " ".join(say(80))), (1, " ".join(say(20) + ITEMS[3][1])), (None, " ".join(ITEMS[5][1]))], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in ITEMS], "item_id long, text string")
    got = sorted((str(r.doc_id), r.contaminated, r.item_ids) for r in D.contaminated(df, bench).collect())
    assert [(d, c) for d, c, _ in got] == [("1", False), ("1", True), ("None", True)] and got[1][2] == "3" and got[2][2] == "5"
    assert D.clean(df, bench).count() == 1
