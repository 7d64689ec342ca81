"""The look-back features as a Spark ML stage.

``LookBackFeatures`` is an Estimator: ``fit`` keeps the history (the match
table and, where given, the shootouts) in the shared folder; the model's
``transform`` adds the features of any matches, those of the history or fixtures
still to be played.  Both stand in a ``Pipeline`` and are saved and loaded with
it: a saved model holds its history beside its parameters.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession

from matchstats import config as C
from matchstats.operators.features import MASTER_FEATURE_COLS, build_features, feature_names
from matchstats.session import work_table

SHOOTOUT_COLS = ["date", "home_team", "away_team", "winner"]


class _LookBackParams(Params):
    keys = Param(Params._dummy(), "keys", "columns that name a match", TypeConverters.toListString)
    windows = Param(Params._dummy(), "windows", "lengths of the form windows", TypeConverters.toListInt)
    keepCols = Param(Params._dummy(), "keepCols", "columns of the matches that stay beside the features", TypeConverters.toListString)
    shootoutsPath = Param(Params._dummy(), "shootoutsPath", "Parquet table of shootouts; empty for none", TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(keys=["match_id"], windows=list(C.FORM_WINDOWS), keepCols=["result", "match_weight"], shootoutsPath="")

    def get_feature_names(self) -> list[str]:
        """The feature columns, in order."""
        return feature_names(self.getOrDefault("windows"))


class LookBackFeatures(Estimator, _LookBackParams, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the history that features look back on."""

    def __init__(self, keys: list[str] | None = None, windows: list[int] | None = None, keepCols: list[str] | None = None,
                 shootoutsPath: str | None = None):
        super().__init__()
        given = {"keys": keys, "windows": windows, "keepCols": keepCols, "shootoutsPath": shootoutsPath}
        self._set(**{k: v for k, v in given.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "LookBackFeaturesModel":
        spark, path = dataset.sparkSession, self.getOrDefault("shootoutsPath")
        cols = [c for c in dict.fromkeys([*self.getOrDefault("keys"), *MASTER_FEATURE_COLS]) if c in dataset.columns]
        master = work_table(dataset.select(*cols), "history")
        shootouts = work_table(spark.read.parquet(path).select(*SHOOTOUT_COLS), "history-shootouts") if path else None
        model = LookBackFeaturesModel(master._work_path, shootouts._work_path if path else "")
        return self._copyValues(model)


class LookBackFeaturesModel(Model, _LookBackParams, MLReadable, MLWritable):
    """Adds the features of matches from the history of the fit."""

    historyPath = Param(Params._dummy(), "historyPath", "Parquet table of the history's matches", TypeConverters.toString)
    historyShootoutsPath = Param(Params._dummy(), "historyShootoutsPath", "and of its shootouts", TypeConverters.toString)

    def __init__(self, history: str = "", shootouts: str = ""):
        super().__init__()
        self._set(historyPath=history, historyShootoutsPath=shootouts)

    def history(self, spark: SparkSession) -> tuple[DataFrame, DataFrame | None]:
        path = self.getOrDefault("historyShootoutsPath")
        return spark.read.parquet(self.getOrDefault("historyPath")), spark.read.parquet(path) if path else None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        master, shootouts = self.history(dataset.sparkSession)
        return build_features(master, shootouts, queries=dataset, keys=self.getOrDefault("keys"),
                              windows=self.getOrDefault("windows"), keep_cols=self.getOrDefault("keepCols"), materialize=False)

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: LookBackFeaturesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        master, shootouts = self.model.history(self.sparkSession)
        master.write.parquet(f"{path}/history")
        if shootouts is not None:
            shootouts.write.parquet(f"{path}/shootouts")


class _ModelReader(MLReader):
    def load(self, path: str) -> LookBackFeaturesModel:
        found = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = LookBackFeaturesModel()
        model._resetUid(found["uid"])
        DefaultParamsReader.getAndSetParams(model, found)
        had_shootouts = bool(model.getOrDefault("historyShootoutsPath"))
        return model._set(historyPath=f"{path}/history", historyShootoutsPath=f"{path}/shootouts" if had_shootouts else "")
