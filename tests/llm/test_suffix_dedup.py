import hashlib
import random

import numpy as np
import pytest

from riskloom.llm import suffix_dedup as S
from tests.llm.conftest import LONG, invented


def brute(rows):
    first, out = {}, []
    for d, t in sorted(rows):
        raw = t.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - S.WINDOW + 1):
            if first.setdefault(raw[i : i + S.WINDOW], (d, i)) != (d, i):
                gone[i : i + S.WINDOW] = b"\1" * S.WINDOW
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("hot", [S.HOT_RUNS, 3])
def test_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT_RUNS", hot)
    rows = invented(3, 160)
    rows += [(900, "ab" * 400), (901, "é" * 300 + "z"), (902, "\0" * 250), (903, "q" * 99), (904, "q" * 100), (905, "q" * 101)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(S.dedup(df)) == brute(rows)


def test_long_text_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 1 << 12)
    rows = invented(5, 40)
    rows.append((1000, " ".join(t for _, t in rows)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.undo()
    assert rows_of(S.dedup(df)) == brute(rows)


def test_pieces_share_no_string(monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 256)
    raw = bytes(range(256)) * 4
    seen = [at + i for at, p in S._pieces(raw) for i in range(len(p) - S.WINDOW + 1)]
    assert sorted(seen) == list(range(len(raw) - S.WINDOW + 1)) and len(set(seen)) == len(seen)


def test_levels_grow_geometrically():
    rng = np.random.default_rng(0)
    levels, seen = S.SuffixLevels(), set()
    for _ in range(40):
        batch = np.array([b"%03d" % x for x in rng.integers(0, 900, 30)], f"S{S.WINDOW}")
        found = levels.add(batch)
        for b, f in zip(batch.tolist(), found):
            assert f == (b in seen)
            seen.add(b)
    sizes = [len(x) for x in levels.levels]
    assert sum(sizes) == len(seen) and all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))


def test_odd_rows(odd, empty):
    got = {(r.doc_id, r.n_bytes, r.n_removed) for r in S.dedup(odd).collect()}
    assert {(1, 0, 0), (2, 0, 0), (6, len(LONG), len(LONG)), (7, len(LONG), len(LONG))} & got >= {(1, 0, 0), (2, 0, 0), (7, len(LONG), len(LONG))}
    assert (9, 50_000, 49_999) in got or (9, 50_000, 50_000 - 1) in got
    assert S.dedup(odd).count() == 13
    assert S.dedup(empty).collect() == []
