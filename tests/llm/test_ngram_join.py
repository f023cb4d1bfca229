import numpy as np
import pytest

from riskloom.llm import ngram_join as N
from riskloom.llm.components import components
from tests.llm.conftest import invented


def grams(text):
    words = (text or "").split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def brute(rows):
    """Class of each id from all pairs, and for each id the others it is linked to."""
    sets = [(d, grams(t)) for d, t in rows]
    links = {d: set() for d, _ in rows}
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            if x and y and len(x & y) >= 0.8 * len(x | y):
                links[a].add(b)
                links[b].add(a)
    root = {}
    for d in sorted(links):
        if d not in root:
            stack = [d]
            while stack:
                v = stack.pop()
                if v not in root:
                    root[v] = d
                    stack.extend(links[v])
    return root, links


def test_classes_equal_all_pairs(spark):
    rows = invented(17, 300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    root, links = brute(rows)
    got = {r.doc_id: r for r in N.similar(df).collect()}
    assert {d: r.class_id for d, r in got.items()} == root
    assert all((r.n_links > 0) == bool(links[d]) for d, r in got.items())
    assert all(r.n_links <= len(links[d]) for d, r in got.items())


def test_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(N, "PER_SALT", 7)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):
        words = list(base)
        words[(i * 7) % 200] = f"z{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"u{i}v{j}" for j in range(50))) for i in range(30)]
    got = {r.doc_id: r.class_id for r in N.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 0 for i in range(120)) and all(got[1000 + i] == 1000 + i for i in range(30))


@pytest.mark.parametrize("block_docs, block_grams, columns", [(1_000, 1_000_000, 4_096), (16, 1_000_000, 7), (1_000, 2_000, 4_096)])
def test_every_link_is_counted(spark, monkeypatch, block_docs, block_grams, columns):
    monkeypatch.setattr(N, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(N, "BLOCK_GRAMS", block_grams)
    monkeypatch.setattr(N, "COLUMNS", columns)
    rows = invented(17, 150)
    for i in range(120):
        words = [f"w{k}" for k in range(200)]
        words[(i * 7) % 200] = f"z{i}"
        rows += [(1000 + 3 * i + k, " ".join(words)) for k in range(1 + (i % 40 == 0))]
    links = brute(rows)[1]
    got = N.similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.n_links for r in got} == {d: len(x) for d, x in links.items()}


def test_bands_reach_the_recall():
    for s, r in ((0.8, 0.9995), (0.9, 0.99), (0.7, 0.9)):
        bands, rows = N.choose_bands(s, r)
        assert 1 - (1 - s**rows) ** bands >= r


def test_ngram_sets_are_exact():
    a, b = "one two three four five six", "one  two\nthree four five\tseven"
    x, y = N.ngram_set(a), N.ngram_set(b)
    assert len(x) == len(y) == 2 and len(np.intersect1d(x, y)) == 1
    assert len(N.ngram_set("a b")) == 1 and len(N.ngram_set(" ")) == len(N.ngram_set(None)) == 0


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (200, 150)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 150: 100, 200: 100}


def test_odd_rows(odd, empty):
    got = {r.doc_id: r for r in N.similar(odd).collect()}
    assert got[7].class_id == 6 and got[6].n_links == 1 and got[6].n_copies == 2
    assert got[1].class_id == 1 and got[2].class_id == 2 and got[3].class_id == 3 and got[None].class_id is None
    assert len(got) == 12
    assert N.similar(empty).collect() == []


def cloud(seed, n, words=150):
    """Copies of one text with a random number of words of their own, so that many lie about the threshold, some of them copied again."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(n):
        text = list(rows[rng.integers(len(rows))][1].split()) if rows and rng.random() < 0.3 else list(base)
        for at in rng.integers(0, words, rng.integers(1, 8)):
            text[at] = f"z{rng.integers(10**6)}"
        rows.append((i, " ".join(text)))
    return rows


def passage(n, start=0):
    """Short texts around a common passage."""
    common = " ".join(f"p{i}" for i in range(40))
    return [(start + i, f"{' '.join(f'a{i}x{k}' for k in range(6))} {common} {' '.join(f'b{i}x{k}' for k in range(6))}") for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_clouds_about_the_threshold(spark, seed):
    rows = cloud(seed, 150) + passage(60, 10_000)
    root, links = brute(rows)
    got = {r.doc_id: r for r in N.similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert {d: r.class_id for d, r in got.items()} == root
    assert {d: r.n_links for d, r in got.items()} == {d: len(x) for d, x in links.items()}


def test_checked_pairs_grow_with_the_texts(spark, monkeypatch):
    made, check = [], N.check_pairs
    monkeypatch.setattr(N, "check_pairs", lambda texts, pairs, parts: made.append(pairs.count()) or check(texts, pairs, parts))
    counts = []
    for n in (500, 2_000):
        made.clear()
        rows = cloud(5, n // 2) + passage(n // 2, 10_000)
        N.similar(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), with_links=False).collect()
        counts.append(sum(made))
    assert counts[1] <= 6 * counts[0]


def test_rare_pairs_lose_no_link(spark):
    rows = cloud(7, 80, 60) + passage(20, 10_000)
    sets = {d: grams(t) for d, t in rows}
    nodes = spark.createDataFrame([(d, len(sets[d]), d, True) for d, _ in rows], "doc long, n long, root long, seeks boolean")
    found = {(r.hub, r.doc) for r in N.rare_pairs(spark.createDataFrame(rows, "doc long, text string"), nodes, 0.8).collect()}
    linked = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert linked <= found and len(found) < 100 * 99 / 4


def test_only_texts_of_buckets_travel(spark, monkeypatch):
    seen = []
    for name in ("check_pairs", "count_links", "rare_pairs"):
        real = getattr(N, name)
        monkeypatch.setattr(N, name, lambda texts, *a, real=real: seen.append({r.doc for r in texts.collect()}) or real(texts, *a))
    words = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(words)), (1, " ".join([*words[:-1], "x"]))] + [(10 + k, " ".join(f"t{k}v{j}" for j in range(50))) for k in range(40)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in N.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: (0, 1), 1: (0, 1)} | {10 + k: (10 + k, 0) for k in range(40)}
    assert len(seen) == 5 and all(s == {0, 1} for s in seen)


def test_what_stays_is_not_shuffled(spark, tmp_path):
    rows = [(i, f"some words of text {i % 7} and some more", "x") for i in range(50)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "docs"))
    left = N.keep_one(spark.read.parquet(str(tmp_path / "docs")))
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert sorted(r.doc_id for r in left.collect()) == list(range(7))
