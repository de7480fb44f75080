"""Model registry: fitted Spark ML models and what is known about each of them."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from airloom.functions.expr import clean_double, metric, model_status
from airloom.schemas import MODEL_COMPARISON, MODEL_REGISTRY
from airloom.sources.tables import Warehouse


def best_model(models: DataFrame, by: str = "r2_test", *, active_only: bool = True) -> DataFrame:
    """The model with the highest metric; a missing metric counts as 0, the first name
    wins a tie."""
    rows = models.filter(F.col("status") == "active") if active_only else models
    return rows.orderBy(F.desc(metric(by)), "model_name").limit(1)


def model_report(models: DataFrame) -> DataFrame:
    """Test metrics and verdict of each model."""
    return models.select(
        "model_name", metric("r2_test").alias("r2_test"), metric("mae_test").alias("mae_test"),
        metric("rmse_test").alias("rmse_test"), model_status(metric("r2_test")).alias("status"),
    )


def feature_list(models: DataFrame, model_name: str) -> DataFrame:
    """Numbered features of one model."""
    return models.filter(F.col("model_name") == model_name).select(
        F.posexplode("feature_names").alias("i", "feature_name")
    ).select((F.col("i") + 1).alias("number"), "feature_name")


def comparison_rows(models: DataFrame) -> DataFrame:
    """The comparison table of all registered models, best test R2 first."""
    return models.select(
        F.col("model_name").alias("Model"),
        *[
            clean_double(F.try_element_at("metrics", F.lit(f"{kind.lower()}_{part.lower()}")))
            .alias(f"{kind} ({part})")
            for kind in ("R2", "MAE", "RMSE") for part in ("Train", "Test")
        ],
    ).orderBy(F.desc_nulls_last("R2 (Test)"), "Model")


class ModelRegistry:
    """Registered models of a warehouse."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse
        self.spark = warehouse.spark

    def register(
        self, model_name: str, model: PipelineModel, metrics: dict[str, float],
        feature_names: list[str], hyperparameters: dict[str, object] | None = None,
    ) -> Row:
        """Save a fitted pipeline and add or replace its registry row."""
        path = f"{self.warehouse.models_dir}/{model_name}"
        model.write().overwrite().save(path)
        row = (
            model_name, path, {k: float(v) for k, v in metrics.items()}, list(feature_names),
            {k: str(v) for k, v in (hyperparameters or {}).items()},
            datetime.now(timezone.utc), "active",
        )
        new = self.spark.createDataFrame([row], MODEL_REGISTRY)
        self.warehouse.model_registry.upsert(new, keys=("model_name",))
        return new.first()

    def models(self) -> DataFrame:
        return self.warehouse.model_registry.read()

    def get(self, model_name: str) -> tuple[PipelineModel, Row] | None:
        """The model and its row, or None if the row or its files are missing."""
        row = self.models().filter(F.col("model_name") == model_name).limit(1).first()
        return self.load(row) if row else None

    def load(self, row: Row) -> tuple[PipelineModel, Row] | None:
        """The model of a registry row, or None if its files are missing."""
        try:
            self.spark.read.text(f"{row['model_path']}/metadata")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return PipelineModel.load(row["model_path"]), row

    def best(self, by: str = "r2_test", *, active_only: bool = True) -> Row | None:
        return best_model(self.models(), by, active_only=active_only).first()

    def write_comparison(self) -> DataFrame:
        """Write the comparison table as CSV and return it."""
        comparison_rows(self.models()).coalesce(1).write.mode("overwrite").csv(
            self.warehouse.comparison_path, header=True
        )
        return self.read_comparison()

    def read_comparison(self) -> DataFrame:
        return self.spark.read.schema(MODEL_COMPARISON).csv(
            self.warehouse.comparison_path, header=True
        )
