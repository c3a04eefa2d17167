"""Linear SVM by gradient descent as Spark ML estimator and model (M3): hinge loss, L2, no intercept."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasRawPredictionCol, HasRegParam, HasSeed, HasStepSize, HasTol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grid import Settings, descend, fold_facts, vector_blocks


class _Columns(HasFeaturesCol, HasPredictionCol, HasRawPredictionCol):
    pass


class SgdSvm(Estimator, _Columns, HasLabelCol, HasMaxIter, HasRegParam, HasSeed, HasStepSize, HasTol, DefaultParamsReadable, DefaultParamsWritable):
    """Learns labels 0 and 1 in ``maxIter`` steps of ``stepSize`` / sqrt(i), each over a drawn ``miniBatchFraction`` of the rows."""

    miniBatchFraction = Param(Params._dummy(), "miniBatchFraction", "share of the rows that a step learns from", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", rawPredictionCol="rawPrediction", maxIter=100, regParam=0.01, stepSize=1.0, tol=1e-3, miniBatchFraction=1.0, seed=0):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", rawPredictionCol="rawPrediction", maxIter=100, regParam=0.01, stepSize=1.0, tol=1e-3, miniBatchFraction=1.0, seed=0)

    def _fit(self, dataset: DataFrame) -> SgdSvmModel:
        value = self.getOrDefault
        data = vector_to_array(F.col(value("featuresCol")))
        rows = dataset.select(F.lit("").alias("feature"), data.alias("feature_data"), F.lit(0).alias("fold"), F.col(value("labelCol")).alias("label"))
        blocks = vector_blocks(rows.withColumn("sample", F.xxhash64("feature_data", "label")))
        facts = fold_facts(blocks, 1, False)
        settings = Settings(k=1, seed=value("seed"), iterations=value("maxIter"), step=value("stepSize"), reg=value("regParam"), tol=value("tol"), batch_fraction=value("miniBatchFraction"))
        weights = descend(blocks, facts, (None,), settings, folds=(-1,))
        if not weights:
            raise ValueError("no rows to learn from")
        model = SgdSvmModel(weights=weights[""][0, 0].tolist())
        return self._copyValues(model)


class SgdSvmModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """The raw prediction is (-margin, margin); a margin above zero is label 1."""

    weights = Param(Params._dummy(), "weights", "one weight a dimension", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, weights=()):
        super().__init__()
        self._set(weights=list(weights))
        self._setDefault(featuresCol="features", predictionCol="prediction", rawPredictionCol="rawPrediction")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value = self.getOrDefault
        terms = F.zip_with(vector_to_array(F.col(value("featuresCol"))), F.lit(value("weights")), lambda x, w: x * w)
        margin = F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)
        raw = dataset.withColumn(value("rawPredictionCol"), array_to_vector(F.array(-margin, margin)))
        return raw.withColumn(value("predictionCol"), (vector_to_array(F.col(value("rawPredictionCol")))[1] > 0).cast("double"))
