"""Learned models on Spark ML. Training rows stay distributed; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VarianceThresholdSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from zonecast import rules as fixed
from zonecast.functions.scalar import clip, floor_zero
from zonecast.functions.stats import exact_quantiles
from zonecast.operators.prep import log_minmax, log_minmax_inverse, target_scaler
from zonecast.session import scratch_path


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def _fit(stages: list, data: DataFrame) -> PipelineModel:
    """Fits, saves to the shared folder and loads back: the model used for predictions carries
    coefficients only, not the training summary with its plan, and outlives the session.
    """
    path = scratch_path(data.sparkSession, "model")
    Pipeline(stages=stages).fit(data).write().overwrite().save(path)
    return PipelineModel.load(path)


def _linear_stages(features: Sequence[str], model) -> list:
    """Constant columns (a month in one month of data) are dropped: they make the normal equations
    of a linear model singular. Collinear ones are handled by its regularisation.
    """
    varying = VarianceThresholdSelector(featuresCol="features", outputCol="varying", varianceThreshold=1e-12)
    return [_assembler(features), varying, model.setFeaturesCol("varying")]


def _trimmed(df: DataFrame, features: Sequence[str], *others: str) -> DataFrame:
    """Only what training reads, as doubles."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in dict.fromkeys([*features, *others])])


@dataclass
class MainModel:
    """Boosted trees on the scaled log target; the scaler row travels with the model."""

    model: PipelineModel
    scaler: DataFrame

    def predict(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        scored = self.model.transform(df).withColumn("_s", self.scaler.scalar())
        return scored.withColumn(out, floor_zero(log_minmax_inverse(F.col("prediction"), F.col("_s")))).drop(
            "_s", "prediction", "features"
        )


def fit_main(
    train: DataFrame, features: Sequence[str], weight: str | None = "weight", val: DataFrame | None = None, trees: int = 5000, depth: int = 7,
    tolerance: float = 1e-4, seed: int = 42,
) -> MainModel:
    """Main regressor with absolute-error loss (robust like the Huber loss it stands for).

    With ``val`` rounds stop once the error on these rows no longer falls by ``tolerance``; ``trees`` is the most rounds. Rows of
    ``val`` weigh 1 and are not trained on.
    """
    scaler = target_scaler(train)
    inputs = ["target_demand", *([weight] if weight else [])]
    data = _trimmed(train, features, *inputs).withColumn("held", F.lit(False))
    if val is not None:
        rows = val.withColumn(weight, F.lit(1.0)) if weight else val
        data = data.unionByName(_trimmed(rows, features, *inputs).withColumn("held", F.lit(True)))
    data = data.withColumn("_s", scaler.scalar()).withColumn("label", log_minmax(F.col("target_demand"), F.col("_s"))).drop("_s")
    gbt = GBTRegressor(
        labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=0.1, subsamplingRate=0.85,
        lossType="absolute", seed=seed, validationTol=tolerance, **({"weightCol": weight} if weight else {}),
        **({"validationIndicatorCol": "held"} if val is not None else {}),
    )
    return MainModel(_fit([_assembler(features), gbt], data), scaler)


@dataclass
class ZeroInflatedModel:
    """Probability of any demand, and the expected demand."""

    classifier: PipelineModel
    intensity: PipelineModel

    def predict(self, df: DataFrame) -> DataFrame:
        keep = df.columns
        scored = self.classifier.transform(df).withColumn("prob", vector_to_array("probability")[1])
        scored = scored.select(*keep, "prob")
        scored = self.intensity.transform(scored).withColumn("intensity", clip("prediction", 0.0, None))
        return scored.select(*keep, "prob", "intensity")


def fit_zero_inflated(train: DataFrame, features: Sequence[str], iterations: int = 50) -> ZeroInflatedModel:
    """Weighted logistic regression for demand above one half, and a Poisson regression."""
    data = _trimmed(train, features, "target_demand", "w_class", "w_intensity").withColumn("label", (F.col("target_demand") > 0.5).cast("double"))
    classifier = LogisticRegression(labelCol="label", weightCol="w_class", maxIter=iterations, regParam=0.01)
    intensity = GeneralizedLinearRegression(
        family="poisson", link="log", labelCol="target_demand", weightCol="w_intensity", maxIter=25, regParam=0.1
    )
    return ZeroInflatedModel(
        _fit(_linear_stages(features, classifier), data), _fit(_linear_stages(features, intensity), data)
    )


def fit_tweedie(train: DataFrame, features: Sequence[str], power: float = 1.25) -> PipelineModel:
    """Tweedie regression with log link."""
    data = _trimmed(train, features, "target_demand", "weight")
    glm = GeneralizedLinearRegression(
        family="tweedie", variancePower=power, linkPower=0.0, labelCol="target_demand", weightCol="weight", maxIter=25, regParam=0.1
    )
    return _fit(_linear_stages(features, glm), data)


def predict(model: PipelineModel, df: DataFrame, out: str) -> DataFrame:
    return model.transform(df).withColumn(out, floor_zero("prediction")).select(*df.columns, out)


def quantile_head(train: DataFrame, alpha: float = 0.45) -> DataFrame:
    """Exact demand quantile per zone, weekday and hour: the conservative companion model."""
    keys = ["PULocationID", "day_of_week", "hour"]
    return exact_quantiles(train, "target_demand", {"quantile": alpha}, keys=keys).select(*keys, "quantile")


def with_quantile(df: DataFrame, head: DataFrame, out: str = "pred_quantile") -> DataFrame:
    """Quantile of the row's key; the row's zone-hour mean where the key is new."""
    keys = ["PULocationID", "day_of_week", "hour"]
    joined = df.join(head, on=keys, how="left")
    return joined.withColumn(out, F.coalesce("quantile", "zone_hour_mean")).drop("quantile")


def enough_rows(train: DataFrame, val: DataFrame, where: Column, min_train: int, min_val: int) -> DataFrame:
    """One row: n_train, n_val and whether a specialist has enough rows to be used."""
    counted = train.filter(where).select(F.lit(1).alias("t"), F.lit(0).alias("v")).unionByName(val.filter(where).select(F.lit(0).alias("t"), F.lit(1).alias("v")))
    sums = counted.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("n_train"), F.coalesce(F.sum("v"), F.lit(0)).alias("n_val"))
    return sums.withColumn("enabled", (F.col("n_train") >= min_train) & (F.col("n_val") >= min_val))


def residual_enabled(train: DataFrame, val: DataFrame, min_train: int = 500, min_val: int = 150) -> DataFrame:
    return enough_rows(train, val, F.col("hour").isin(fixed.LATE_HOURS), min_train, min_val)


def expert_enabled(train: DataFrame, val: DataFrame, min_train: int = 400, min_val: int = 80) -> DataFrame:
    return enough_rows(train, val, _sunday_late(), min_train, min_val)


def _sunday_late() -> Column:
    return (F.col("day_of_week") == 6) & F.col("hour").isin(fixed.WEEKEND_LATE_HOURS)


def fit_residual(train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Linear model of the late-hour residual; ``residual_enabled`` says whether it is to be used."""
    inputs = list(dict.fromkeys([*features, "predicted"]))
    data = _trimmed(train.filter(F.col("hour").isin(fixed.LATE_HOURS)), inputs, "actual").withColumns(
        {"label": F.col("actual") - F.col("predicted"), "weight": clip(F.col("actual") / 8.0, 0.8, 3.0)}
    )
    glm = GeneralizedLinearRegression(family="gaussian", link="identity", labelCol="label", weightCol="weight", regParam=1.0)
    return _fit(_linear_stages(inputs, glm), data)


def residual_delta(model: PipelineModel, df: DataFrame, enabled: DataFrame, out: str = "delta") -> DataFrame:
    """The residual the model expects, NULL (no correction) if it is not enabled."""
    delta = F.when(enabled.select("enabled").scalar(), F.col("prediction"))
    return model.transform(df).withColumn(out, delta).select(*df.columns, out)


def sunday_expert(train: DataFrame, enabled: DataFrame, alpha: float = 0.40) -> DataFrame:
    """Quantile table for Sunday late hours, empty if it is not enabled."""
    return quantile_head(train.filter(_sunday_late()), alpha).filter(enabled.select("enabled").scalar())
