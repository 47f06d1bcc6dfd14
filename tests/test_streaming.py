from conftest import values

from tierwise.models.boosting import BoostedModel
from tierwise.operators import encode, gold
from tierwise.operators.bronze import normalise_types
from tierwise.plans import layers
from tierwise.streaming import frozen


def test_a_stream_gets_the_same_features_as_a_table(spark, survey, tmp_path):
    source = str(tmp_path / "in")
    survey.repartition(3).write.parquet(source)
    bronze_fit = layers.fit_bronze(survey)
    table = layers.apply_bronze(normalise_types(survey), bronze_fit)
    silver_fit = layers.fit_silver(table, scaling=True)
    want = encode.power_transform(layers.apply_silver(table, silver_fit), {"Going_outside": 0.5})

    stream = frozen.features(frozen.raw_stream(spark, source, survey.schema, 1), bronze_fit, silver_fit)
    stream = encode.power_transform(stream, {"Going_outside": 0.5})
    frozen.append_to(stream, str(tmp_path / "out"), str(tmp_path / "marks")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(got.columns) == sorted(want.columns)
    for c in ("extrovert_score", "social_percentage", "poly_social_ratio_pow_2", "Going_outside_scaled", "Going_outside_power"):
        assert values(got, c) == values(want, c)


def test_late_files_are_appended_once(spark, survey, tmp_path):
    source, out, marks = (str(tmp_path / p) for p in ("in", "out", "marks"))
    bronze_fit, silver_fit = layers.fit_bronze(survey), {"basic": {}, "polynomial": False, "scaling": {}}
    for part in ("id <= 5", "id > 5"):
        survey.where(part).write.mode("append").parquet(source)
        stream = frozen.features(frozen.raw_stream(spark, source, survey.schema), bronze_fit, silver_fit)
        frozen.append_to(stream, out, marks).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).select("id").collect()) == list(range(1, 13))


def test_a_stream_is_scored_with_a_fitted_model(spark, survey, tmp_path):
    source = str(tmp_path / "in")
    survey.write.parquet(source)
    bronze_fit = layers.fit_bronze(survey)
    silver_fit = layers.fit_silver(survey, polynomial=False)
    table = layers.apply_silver(layers.apply_bronze(normalise_types(survey), bronze_fit), silver_fit)
    gold_fit = {"clean": gold.fit_clean(table)}
    names = ["Going_outside", "extrovert_score"]
    cleaned = gold.encode_label(gold.clean(table, gold_fit["clean"])).withColumnRenamed("Personality_encoded", "label")
    model = BoostedModel.fit(cleaned, names, {"iterations": 2, "min_child_samples": 1})
    stream = frozen.features(frozen.raw_stream(spark, source, survey.schema), bronze_fit, silver_fit)
    frozen.append_to(frozen.scored(stream, gold_fit, model).select("id", "p"), str(tmp_path / "out"), str(tmp_path / "m")).awaitTermination()
    assert values(spark.read.parquet(str(tmp_path / "out")), "p") == values(model.score(cleaned), "p")
