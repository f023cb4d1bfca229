import base64
import random
import string
import zlib

import numpy as np

from riskloom.llm import langid as G
from tests.conftest import SF_SMALL


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")
    truth = {r.doc_id: r for r in docs.select("doc_id", "lang", "n_chars").collect()}
    got = G.identify(docs).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    out = [r for r in got if r.held_out]
    right = sum(r.lang_pred == truth[r.doc_id].lang for r in out)
    assert len(out) > 250 and right / len(out) > 0.97
    assert not any(r.rejected for r in got)


def test_prediction_reads_the_text_only(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = G.fit(docs.select("text", "lang"))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").limit(30).collect()]
    a = G.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    b = G.predict(spark.createDataFrame([(None, t, "xx") for _, t in rows], "doc_id long, text string, lang string"), model).collect()
    assert sorted((r.lang_pred, round(r.score, 9)) for r in a) == sorted((r.lang_pred, round(r.score, 9)) for r in b)


def test_counts_do_not_depend_on_pieces(monkeypatch):
    raw = bytes(np.random.default_rng(0).integers(0, 256, 5000, dtype=np.uint8))
    whole = G.counts(raw)
    monkeypatch.setattr(G, "PIECE", 7)
    pieces = G.counts(raw)
    assert (whole[0] == pieces[0]).all() and (whole[1] == pieces[1]).all()
    assert whole[1].sum() == 5000 + 4999 + 4998


def test_rejects_what_is_far_from_all_centroids(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = G.fit(docs.select("text", "lang"))
    rows = [(1, "日本語の文章です。これは英語ではありません。" * 5), (2, "And the that of ontion inger was with the."), (3, None), (4, "123 !?"), (5, "")]
    got = {r.doc_id: r for r in G.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[1].rejected and got[1].lang_pred in model.languages
    assert not got[2].rejected and got[2].lang_pred == "en"
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected for i in (3, 4, 5))


POLISH = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa."
FINNISH = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä."


def test_rejects_random_letters_and_unlearnt_languages(spark):
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")
    model = G.fit_documents(docs)
    rng = random.Random(4)
    noise = {f"letters {n}": " ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(n // 6)) for n in (200, 1000, 3000)}
    noise |= {f"base64 {n}": base64.b64encode(rng.randbytes(n)).decode() for n in (200, 3000)} | {"Polish": POLISH, "Finnish": FINNISH}
    assert {k: G.judge(t, model) for k, t in noise.items() if not G.judge(t, model)[2]} == {}
    clean = [r.text for r in docs.filter(G.held_out()).collect() if G.has_letter(r.text or "")]
    assert len(clean) > 250 and not any(G.judge(t, model)[2] for t in clean)


def test_odd_rows(odd, empty):
    got = {r.doc_id: r for r in G.identify(odd).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == got[4].lang_pred == got[10].lang_pred == "und"
    assert got[6].lang_pred in ("en", "de", "fr") and got[None].held_out is False
    assert G.identify(odd).count() == odd.count() and G.identify(empty).collect() == []


def test_nothing_to_learn_from(spark):
    got = G.identify(spark.createDataFrame([(3, "some text", None), (4, "other", None)], "doc_id long, text string, lang string")).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2


def test_every_language_is_learnt(spark):
    rows = [(f"wa ka {'zu' * (k % 5 + 1)} nori {'ta' * (k % 7 + 1)}", "aa") for k in range(40)] + [("bleep gronk fnord blip quux", "bb"), (None, "cc"), ("12 3", "dd")]
    model = G.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == ["aa", "bb"] and G.judge("gronk blip fnord", model)[0] == "bb" and G.judge("wa ka nori", model)[0] == "aa"


def test_equal_to_comparing_with_every_centroid(spark):
    """Plain nearest centroid: dense vectors, one cosine after another."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = G.fit_documents(docs)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in G.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for d, t in rows:
        if t is None or not any(c.isalpha() for c in t):
            assert got[d].lang_pred == "und"
            continue
        raw = " ".join("".join(c if c.isalpha() or ord(c) >= 128 else " " for c in t).split()).encode().lower()
        v = np.zeros(G.DIMS)
        for n, m in zip((1, 2, 3), (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D), strict=True):
            for i in range(len(raw) - n + 1):
                v[((int.from_bytes(raw[i : i + n], "big") + n) % 2**32) * m % 2**32 >> 18] += 1
        v = np.log1p(v) * model.idf
        cosine = [float(v @ model.centroids[:, k]) / np.linalg.norm(v) for k in range(model.centroids.shape[1])]
        best = max(range(len(cosine)), key=cosine.__getitem__)
        assert got[d].score == np.float64(got[d].score) and abs(got[d].score - cosine[best]) < 1e-4
        assert got[d].lang_pred == model.languages[model.owner[best]] or sorted(cosine)[-1] - sorted(cosine)[-2] < 1e-4
