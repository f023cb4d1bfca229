import hashlib

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from riskloom.llm import langid
from riskloom.llm.common import load
from tests.conftest import SF_SMALL
from tests.llm.test_ngram_join import brute as classes
from tests.llm.test_pii import brute as spans

FULL = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_against_plain_versions(spark):
    docs = load(spark, SF_SMALL, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert len(corpus_pipeline.STAGES) == 5

    model = langid.fit_documents(docs)
    kept = stages["language_id"](spark, docs, SF_SMALL)
    rows = {r.doc_id: r for r in docs.collect()}
    got = {r.doc_id: r for r in kept.collect()}
    assert kept.columns == columns and got == {d: r for d, r in rows.items() if not langid.judge(r.text, model)[2]}
    assert set(rows) - set(got) <= {d for d, r in rows.items() if not any(map(str.isalpha, r.text or ""))}

    single = stages["near_copies"](spark, kept, SF_SMALL)
    root, _ = classes([(d, r.text) for d, r in got.items()])
    got = {r.doc_id: r for r in single.collect()}
    assert single.columns == columns and set(got) == {d for d in root if root[d] == d}

    items = [r.text for r in load(spark, SF_SMALL, "benchmark").collect()]
    clean = stages["decontamination"](spark, single, SF_SMALL)
    left = {r.doc_id: r for r in clean.collect()}
    assert clean.columns == columns and set(left) == {d for d, r in got.items() if not any(i in r.text for i in items)}

    private = stages["personal_data"](spark, clean, SF_SMALL)
    after = {r.doc_id: r for r in private.collect()}
    assert private.columns == columns and set(after) == set(left)
    for d, r in left.items():
        assert not spans(after[d].text) and (spans(r.text) or after[d].text == r.text)

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in stages["encoding"](spark, private, SF_SMALL).collect():
        ids = library.encode(after[r.doc_id].text, add_special_tokens=False).ids
        assert r.ids == ids and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_run(spark):
    assert 100 < corpus_pipeline.run(spark, SF_SMALL).count() <= 200


def test_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = stage(spark, docs, SF_SMALL)
            assert docs.columns == columns
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
        assert {r.doc_id for r in last} <= {6, None, 5, 8, 9}


def test_repeated_rows_leave_one(spark):
    rows = [(1, "one two three four five six seven", "en", "a", 9)] * 3 + [(2, "one two three four five six seven", "en", "a", 9), (None, "other words of a text", "en", "a", 1)]
    got = dict(corpus_pipeline.STAGES)["near_copies"](spark, spark.createDataFrame(rows, FULL), SF_SMALL).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 1]
