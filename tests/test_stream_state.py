import json

from pyspark.sql import functions as F

from riskloom.operators.contract import Contract, Rule
from riskloom.operators.scoring import ScoringModel
from riskloom.operators.trees import fit_trees
from riskloom.spec import JobSpec, Trees, numbers
from riskloom.streaming.request_state import LATE, RequestState
from riskloom.streaming.score_stream import start_scoring_stream

CONTRACT = Contract("req", [Rule("a", "double", ge=0), Rule("at", "timestamp")])


def model(spark):
    train = spark.range(400).select((F.col("id") % 20).cast("double").alias("a"), (F.col("id") % 20 > 11).cast("int").alias("y"))
    return ScoringModel(JobSpec("d", "y", "k", numbers("a"), learner=Trees()), "gbt", 0.5, trees=fit_trees(train, ["a"], [], "y", {"maxIter": 3, "maxDepth": 2}), continuous=["a"])


def send(folder, name, requests):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"k": k, "a": a, "at": at}) for k, a, at in requests) + "\n")


def test_restarts_and_replays_score_once(spark, tmp_path):
    m = model(spark)
    state = RequestState(spark, str(tmp_path / "state"), "k", F.col("at"), "1 hour")
    out = {"scored_dir": str(tmp_path / "scored"), "rejected_dir": str(tmp_path / "rejected"), "checkpoint_dir": str(tmp_path / "ck")}

    def run():
        start_scoring_stream(spark, str(tmp_path / "in"), CONTRACT, m, "k", max_files_per_trigger=1, state=state, **out).awaitTermination()
        scored = [(r.k, round(r.probability, 9)) for r in spark.read.parquet(out["scored_dir"]).collect()]
        return sorted(scored), sorted((r.k, r.reasons) for r in spark.read.parquet(out["rejected_dir"]).collect())

    first = [(k, float(k), f"2024-05-01 12:{k:02d}:00") for k in range(15)]
    send(tmp_path / "in", "1.json", [*first, first[3], (99, -1.0, "2024-05-01 12:00:00")])
    scored, rejected = run()
    assert [k for k, _ in scored] == list(range(15)) and rejected == [(99, "a:greater_than_or_equal_to(0)")]
    # sent again, some too late, some new; then the stream stops and starts again
    send(tmp_path / "in", "2.json", [*first[:5], (50, 3.0, "2024-05-01 10:00:00"), (51, 4.0, "2024-05-01 11:30:00"), (52, 5.0, "2024-05-01 18:00:00")])
    send(tmp_path / "in", "3.json", [(52, 5.0, "2024-05-01 18:00:00"), (53, 6.0, "2024-05-01 16:59:00"), (54, 6.0, "2024-05-01 17:30:00")])
    scored, rejected = run()
    assert [k for k, _ in scored] == [*range(15), 51, 52, 54]
    assert rejected == [(50, LATE), (53, LATE), (99, "a:greater_than_or_equal_to(0)")]
    want = m.score(spark.createDataFrame([(k, a) for k, a, _ in [*first, (51, 4.0, ""), (52, 5.0, ""), (54, 6.0, "")]], "k long, a double"), keep=["k"])
    assert scored == sorted((r.k, round(r.probability, 9)) for r in want.collect())
    assert run() == (scored, rejected)
    state.record_scores(want, "train")
    drift = state.score_drift("train").report().collect()
    assert len(drift) == 1 and drift[0].feature == "probability" and abs(drift[0].ks_stat) < 1e-9


def test_a_batch_that_is_run_again_finds_the_same_state(spark, tmp_path):
    state = RequestState(spark, str(tmp_path), "k", F.col("at"), "1 hour")
    rows = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (1, "2024-01-01 09:30:00"), (2, None), (None, "2024-01-01 10:00:00"), (None, "2024-01-01 10:00:00")], "k long, at string")
    for _ in range(2):
        fresh, late = state.judge(rows, 4)
        assert sorted((str(r.k), str(r.at)) for r in fresh.collect()) == [("1", "2024-01-01 09:30:00"), ("2", "None"), ("None", "2024-01-01 10:00:00"), ("None", "2024-01-01 10:00:00")]
        assert late.count() == 0
        state.record(fresh, 4)
    assert state.judge(rows, 5)[0].where("k = 1").count() == 0
