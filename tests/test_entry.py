"""Driver contract and a streaming round trip on the smoke tables."""

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert set(df.columns) == {"feature", "psi", "ks_stat", "ks_pvalue", "drifted"}
    assert len(rows) == 3


def test_every_oracle_has_a_query():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 50


def test_stream_scores_equal_batch_scores(spark):
    qs = E.queries()
    stream = qs["score_stream"](spark, SF_SMALL)
    batch = qs["score_requests"](spark, SF_SMALL)
    s = {r["event_id"]: r["probability"] for r in stream.collect()}
    b = {r["event_id"]: r["probability"] for r in batch.collect()}
    assert s.keys() == b.keys() and all(abs(s[k] - b[k]) < 1e-12 for k in s)
