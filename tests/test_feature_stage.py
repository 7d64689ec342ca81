"""The feature stage in a Spark ML Pipeline: saved, loaded, equal to the plain build."""

import datetime as dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from matchstats.operators.feature_stage import LookBackFeatures, LookBackFeaturesModel
from matchstats.operators.features import build_features, feature_names
from matchstats.operators.master import complete_matches
from matchstats.plans.pipeline import fixture_inputs
from tests.conftest import SF0001


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stage_in_a_pipeline(spark, scratch):
    inp = fixture_inputs(spark, SF0001)
    master = inp.master.withColumn("label", (F.col("result") == "home_win").cast("double")).persist()
    inp.shootouts.write.parquet(f"{scratch}/shootouts")
    played = complete_matches(master)
    want = rows_of(build_features(master, inp.shootouts))
    model = LookBackFeatures(shootoutsPath=f"{scratch}/shootouts").fit(master)
    assert model.get_feature_names() == feature_names() and len(feature_names()) == 45
    assert rows_of(model.transform(played)) == want
    model.write().save(f"{scratch}/alone")
    back = LookBackFeaturesModel.load(f"{scratch}/alone")
    assert back.getOrDefault("historyPath") == f"{scratch}/alone/history" and rows_of(back.transform(played)) == want

    stage = LookBackFeatures(keepCols=["label"])
    pipeline = Pipeline(stages=[stage, VectorAssembler(inputCols=feature_names(), outputCol="features"), LogisticRegression(maxIter=5)])
    pipeline.write().save(f"{scratch}/unfitted")
    fitted = Pipeline.load(f"{scratch}/unfitted").fit(played)
    fitted.write().save(f"{scratch}/fitted")
    loaded = PipelineModel.load(f"{scratch}/fitted")
    cols = ["match_id", "prediction", "home_form_5"]
    assert rows_of(loaded.transform(played).select(*cols)) == rows_of(fitted.transform(played).select(*cols))
    # a fixture still to be played
    fixture = played.limit(1).withColumn("match_id", F.lit(-1).cast("long")).withColumn("date", F.lit(dt.date(2030, 1, 1)))
    got = loaded.transform(fixture).first()
    assert got["match_id"] == -1 and got["days_since_last_match_home"] > 365
