"""Train, evaluate and register the three regressors."""

from __future__ import annotations

from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.functions.expr import drop_missing
from airloom.ml import boosting
from airloom.ml.features import feature_columns
from airloom.operators.stats import regression_metrics
from airloom.operators.timeseries import add_lags, chrono_marks
from airloom.session import materialize
from airloom.sources.registry import ModelRegistry

RANDOM_FOREST = "Random Forest"
XGBOOST = "XGBoost"
GRADIENT_BOOSTING = "Gradient Boosting"


@dataclass
class TrainingPlan:
    """Hyperparameters. The defaults are the full settings; tests use fewer trees."""

    forest_trees: int = 200
    xgb_rounds: int = 500
    gbt_rounds: int = 300
    seed: int = 42
    scale: bool = False
    validation_share: float = 0.1
    patience: int = 30
    models: tuple[str, ...] = (RANDOM_FOREST, XGBOOST, GRADIENT_BOOSTING)
    keys: tuple[str, ...] = ("city",)
    order: str = "ts"
    target: str = "us_aqi"
    series: dict = field(default_factory=dict)


def estimator(name: str, plan: TrainingPlan):
    """The Spark ML regressor behind a model name."""
    common = {"featuresCol": "features", "labelCol": plan.target, "seed": plan.seed}
    if name == RANDOM_FOREST:
        return RandomForestRegressor(
            numTrees=plan.forest_trees, maxDepth=8, minInstancesPerNode=8,
            featureSubsetStrategy="all", **common,
        )
    if name == GRADIENT_BOOSTING:
        return GBTRegressor(
            maxIter=plan.gbt_rounds, maxDepth=3, stepSize=0.05, minInstancesPerNode=10,
            subsamplingRate=0.8, **common,
        )
    raise ValueError(f"unknown model {name!r}")


def fit(name: str, data: DataFrame, plan: TrainingPlan):
    """Fit one model on the training rows of an assembled frame.

    The regularised ensemble finds its number of rounds on the validation tail of the training rows, and is
    fitted on all of them.
    """
    train = data.filter("is_train")
    if name == XGBOOST:
        settings = boosting.Boosting(rounds=plan.xgb_rounds, patience=plan.patience, seed=plan.seed)
        return boosting.fit(train, settings, target=plan.target, validation=F.col("is_validation"))
    return estimator(name, plan).fit(train)


def hyperparameters(fitted) -> dict[str, object]:
    """What a fitted stage was asked for."""
    if isinstance(fitted, boosting.BoostedModel):
        return fitted.hyperparameters()
    return {p.name: v for p, v in fitted.extractParamMap().items()}


def assembly(features: list[str], scale: bool = False) -> Pipeline:
    """Median imputation, vector assembly and, if asked for, standardisation."""
    filled = [f"{c}__filled" for c in features]
    stages = [
        Imputer(strategy="median", inputCols=features, outputCols=filled),
        VectorAssembler(
            inputCols=filled, outputCol="raw_features" if scale else "features",
            handleInvalid="error",
        ),
    ]
    if scale:
        stages.append(StandardScaler(
            inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    return Pipeline(stages=stages)


def training_frame(features: DataFrame, plan: TrainingPlan) -> DataFrame:
    """Rows with all lags known, flagged ``is_train`` and ``is_validation``.

    The frame is stored: three estimators and six evaluations scan it.
    """
    lagged = add_lags(
        features, plan.target, keys=plan.keys, order=plan.order, **plan.series
    )
    complete = materialize(drop_missing(lagged))
    marked = chrono_marks(
        complete, {"is_train": 0.8, "_fitting": 0.8 * (1 - plan.validation_share)},
        keys=plan.keys, order=plan.order,
    )
    validation = F.col("is_train") & ~F.col("_fitting")
    return materialize(marked.withColumn("is_validation", validation).drop("_fitting"))


def evaluate(scored: DataFrame, target: str) -> dict[str, float]:
    """R2, MAE and RMSE of the training and the test part."""
    rows = regression_metrics(scored, "prediction", target, keys=("is_train",)).collect()
    out = {}
    for row in rows:  # two rows
        part = "train" if row["is_train"] else "test"
        for name in ("r2", "mae", "rmse"):
            if row[name] is not None:  # an undefined score is no entry
                out[f"{name}_{part}"] = row[name]
    return out


def train_models(
    features: DataFrame, registry: ModelRegistry, plan: TrainingPlan | None = None
) -> DataFrame:
    """Fit, evaluate and register each model; returns the comparison table.

    The models are fitted side by side: each is a long row of small jobs, which leave most executors idle.
    """
    plan = plan or TrainingPlan()
    data = training_frame(features, plan)
    names = feature_columns(data, plan.target)
    train = data.filter("is_train")
    prepared = assembly(names, plan.scale).fit(train)
    slim = [*plan.keys, plan.order, plan.target, "is_train", "is_validation"]
    vectors = materialize(prepared.transform(data).select(*slim, "features"))

    def fitted_and_scored(name: str):
        fitted = fit(name, vectors, plan)
        return fitted, evaluate(fitted.transform(vectors), plan.target)

    with ThreadPool(max(1, len(plan.models))) as pool:
        done = pool.map(inheritable_thread_target(features.sparkSession)(fitted_and_scored), plan.models)
    for name, (fitted, metrics) in zip(plan.models, done):
        registry.register(
            name, PipelineModel(stages=[*prepared.stages, fitted]), metrics, names,
            hyperparameters(fitted),
        )
    return registry.write_comparison()


def feature_importance(spark: SparkSession, model: PipelineModel, names: list[str]) -> DataFrame:
    """Importance of each feature in the final tree ensemble, highest first."""
    rows = list(zip(names, model.stages[-1].featureImportances.toArray().tolist()))
    schema = T.StructType([
        T.StructField("feature_name", T.StringType()), T.StructField("importance", T.DoubleType()),
    ])
    return spark.createDataFrame(rows, schema).orderBy(F.desc("importance"), "feature_name")
