import json

import pytest
from pyspark.sql import functions as F

from tierwise.operators import gold
from tierwise.plans import layers
from tierwise.sources import results, runlog
from tierwise.sources.layers import LayerStore, load_fitted, save_fitted
from tierwise.spec import DEFAULT as SPEC


@pytest.fixture(scope="module", params=["folders", "catalog"])
def store(request, spark, survey, tmp_path_factory):
    made = LayerStore(spark, str(tmp_path_factory.mktemp("store")) if request.param == "folders" else None)
    made.write("raw", "train", survey.where("id <= 8"))
    made.write("raw", "test", survey.where("id > 8").drop("Personality"))
    return made


def test_layers_build_on_demand(store):
    assert not store.exists("bronze") and not store.exists("silver", "test")
    train, test = store.require("silver", layers.build_silver)
    assert store.exists("bronze") and store.exists("silver", "test")
    assert train.count() == 8 and test.count() == 4
    assert set(train.columns) - {"Personality"} == set(test.columns)
    layers.build_gold(store, k=5)
    a, b = store.load("gold")
    assert [c for c in a.columns if c not in SPEC.not_features] == [c for c in b.columns if c != "id"]


def test_unknown_layer_and_part(store):
    with pytest.raises(ValueError):
        store.read("platinum")
    with pytest.raises(ValueError):
        store.read("raw", "validation")


def test_fitted_values_round_trip(spark, survey, tmp_path):
    fitted = gold.fit_gold(survey, k=4)
    save_fitted(fitted, spark, str(tmp_path / "gold"))
    back = load_fitted(spark, str(tmp_path / "gold"))
    want = sorted(map(tuple, gold.apply_gold(survey, fitted).collect()))
    assert sorted(map(tuple, gold.apply_gold(survey, back).collect())) == want


def test_submission_needs_one_prediction_per_row(spark):
    rows = spark.createDataFrame([(1,), (2,)], "id bigint")
    good = spark.createDataFrame([(2, 0.5), (1, 0.6)], "id bigint, p double")
    assert {tuple(r) for r in results.submission_for(rows, good, "p").collect()} == {(1, "Extrovert"), (2, "Introvert")}
    for bad in ([(1, 0.5)], [(1, 0.5), (3, 0.5)]):
        with pytest.raises(ValueError):
            results.submission_for(rows, spark.createDataFrame(bad, "id bigint, p double"), "p")


def test_records_append_and_read_back(spark, tmp_path):
    path = str(tmp_path / "cv")
    for scores in ([0.9, 0.8], [0.7, 0.7]):
        results.write_json(results.cv_record(spark, "boosted", {"n_splits": 2}, scores, 1.5, note="x"), path)
    got = {tuple(r["fold_scores"]): r for r in results.read_json(spark, path, results.CV_RECORD).collect()}
    assert got[0.7, 0.7]["std_score"] == 0.0 and got[0.9, 0.8]["mean_score"] == pytest.approx(0.85)
    assert got[0.9, 0.8]["extra"] == {"note": "x"}


def test_run_log_document(spark, tmp_path):
    runs = [{"timestamp": f"2024-01-0{i + 1}T00:00:00", "duration": d} for i, d in enumerate([1.0, 2.0, 6.0])]
    doc = {"workflows": {"train": {"executions": runs, "statistics": {}}, "once": {"executions": runs[:1], "statistics": {"count": 1}}}}
    path = tmp_path / "log.json"
    path.write_text(json.dumps(doc, indent=2))
    stats = {r["workflow"]: r for r in runlog.workflow_stats(runlog.import_document(spark, str(path))).collect()}
    assert (stats["train"]["average"], stats["train"]["median"], stats["train"]["count"]) == (3.0, 2.0, 3)
    assert stats["once"]["std_dev"] is None
    estimate = runlog.estimated_durations(runlog.workflow_stats(runlog.import_document(spark, str(path))))
    assert {r["workflow"]: r["estimate"] for r in estimate.collect()}["train"] == pytest.approx(2.3)


def test_run_log_appends_and_clears(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert runlog.read_runs(spark, path).count() == 0
    for name, seconds in (("a", 1.0), ("b", 2.0), ("a", 3.0)):
        runlog.append_run(spark, path, name, seconds)
    assert {r["workflow"] for r in runlog.workflows(runlog.read_runs(spark, path)).collect()} == {"a", "b"}
    assert runlog.clear_workflow(spark, path, "a") and not runlog.clear_workflow(spark, path, "a")
    assert runlog.read_runs(spark, path).count() == 1
    many = spark.range(250).select(F.lit("w").alias("workflow"), F.timestamp_seconds("id").alias("ts"), F.col("id").cast("double").alias("duration"))
    assert runlog.latest_runs(many).agg(F.min("duration"), F.count("*")).first()[:] == (150.0, 100)


def test_scratch_needs_a_shared_folder_off_local(monkeypatch):
    from tierwise import runtime

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://x:1", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        runtime.scratch_root(Session())



def test_runs_without_workflow_or_duration(spark, tmp_path):
    rows = [("a", "2024-01-01 00:00:00", d) for d in (1.0, None, None, 5.0)] + [("b", "2024-01-02 00:00:00", 3.0), (None, "2024-01-03 00:00:00", 2.0)]
    runs = spark.createDataFrame(rows, "workflow string, ts string, duration double").withColumn("ts", F.col("ts").cast("timestamp"))
    stats = {r["workflow"]: (r["median"], r["count"]) for r in runlog.workflow_stats(runs).collect()}
    assert stats == {"a": (3.0, 2), "b": (3.0, 1), None: (2.0, 1)}
    path = str(tmp_path / "runs")
    runs.write.parquet(path)
    assert runlog.clear_workflow(spark, path, "a")
    assert {r["workflow"] for r in runlog.read_runs(spark, path).collect()} == {"b", None}
