import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from riskloom.llm import filter_audit as A
from riskloom.llm.queries import ORACLES
from tests.llm.conftest import invented


def fails(rows):
    """Filters that each ``(doc_id, text, source)`` fails, by the stated conditions."""
    low = lambda d: -(2**63) if d is None else d
    first = {}
    for d, t, _ in rows:
        first[t or ""] = min(first.get(t or "", 2**63), low(d))
    for d, t, _ in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        out = ""
        out += "A" if len(words) < 50 else ""
        out += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        out += "C" if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else ""
        out += "D" if re.search("[#$%&*|]", t) else ""
        out += "E" if first[t] < low(d) else ""
        yield out


def brute(rows, quality, toxic):
    """Every figure by walking each order over each document."""
    sets = list(fails(rows))
    out = Counter()
    for (d, _, s), failed in zip(rows, sets, strict=True):
        part = s or ""
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                key = part, order, step
                out[(*key, "kept")] += 0
                if f in failed:
                    out[(*key, "unique_fails")] += len(failed) == 1
                    out[(*key, "redundant")] += gone
                    if not gone:
                        out[(*key, "removed")] += 1
                        out[part, f] += 1
                        out[(*key, "good_lost")] += quality.get(d) == 1
                        out[(*key, "toxic_lost")] += toxic.get(d) == 1
                    gone = True
                out[(*key, "kept")] += not gone
    return out


def invented_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for d, t in invented(seed, n):
        if rng.random() < 0.3:
            t = t.upper() if rng.random() < 0.5 else t + " #1 | 2"
        if rng.random() < 0.2:
            t = " ".join([t[:40]] * rng.randint(2, 30))
        rows.append((d, t, rng.choice(["web", "web", "news", None, ""])))
    return rows + [(n + 1, None, "news"), (n + 2, "", "news"), (None, rows[0][1], "web"), (None, rows[0][1], "web"), (3, rows[3][1], "x")]


def labelled(seed, n):
    rng = random.Random(seed)
    return [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d in range(0, n, 2)] + [(0, 0, 0), (None, 1, 1)]


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = invented_rows(4, 150), labelled(5, 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    return rows, labels, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def result(docs, labels):
    return A.audit(A.failures(docs, labels), "ABCDE", "part", ["good", "toxic"]).withColumnsRenamed({"lost_good": "good_lost", "lost_toxic": "toxic_lost"})


def test_equal_to_walking_every_order(tables):
    rows, labels, docs, known = tables
    quality, toxic = ({d: max((x[k] or 0) for x in labels if x[0] == d) for d, _, _ in labels if d is not None} for k in (1, 2))
    want = brute(rows, quality, toxic)
    got = result(docs, known).collect()
    assert len(got) == 600 * len({s or "" for _, _, s in rows}) == len({(r.part, r.filter_order, r.step) for r in got})
    for r in got:
        for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"):
            assert r[c] == want[r.part, r.filter_order, r.step, c], (r, c)
        assert r.shapley == want[r.part, r.filter_order[r.step - 1]]
    assert sum(r.toxic_lost for r in got) and sum(r.redundant for r in got) and any(r.unique_fails for r in got)


def test_equal_to_sql(tables):
    _, _, docs, known = tables
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    con.register("labels", known.toPandas().astype({"doc_id": "Int64", "quality": "Int64", "toxic": "Int64"}))
    want = con.sql(ORACLES["op13_filter_audit"])
    columns = want.columns
    assert sorted(map(tuple, result(docs, known).select(columns).collect())) == sorted(want.fetchall())


def test_removal_steps():
    orders, steps = A.removal_steps(3)
    assert len(orders) == 6 and steps.shape == (8, 6) and (steps[0] == 3).all()
    for o, order in enumerate(orders):
        for pattern in range(1, 8):
            assert steps[pattern, o] == min(list(order).index(f) for f in range(3) if pattern >> f & 1)


def test_any_filters(spark):
    rows = spark.createDataFrame([("x", True, None), ("x", True, True), (None, False, True), ("y", False, False)], "p string, short boolean, long boolean")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in A.audit(rows, ["short", "long"], "p").collect()}
    assert got["x", "shortlong", 1] == (0, 2, 0, 1, 3) and got["x", "shortlong", 2] == (0, 0, 1, 0, 1)
    assert got["x", "longshort", 2] == (0, 1, 1, 1, 3) and got["", "longshort", 1] == (0, 1, 0, 1, 2) and got["y", "longshort", 2] == (1, 0, 0, 0, 0)
    with pytest.raises(ValueError):
        A.audit(rows, "ABCDEFGH", "p")


def test_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(6, 1, 0), (7, 1, 1)], "doc_id long, quality int, toxic int")
    got = result(odd, labels).collect()
    assert len(got) == 600 * 4
    last = {r.part: r for r in got if r.filter_order == "EABCD" and r.step == 1}
    assert last["b"].removed == 2 and last["b"].toxic_lost == 2 and last["a"].removed == 1  # two rows of 7 copy 6, the empty text copies the null one
    assert result(empty, labels).collect() == []
    assert len(result(odd, labels.limit(0)).collect()) == 600 * 4
