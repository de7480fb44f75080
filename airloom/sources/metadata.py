"""Feature store: the stored features and what is known about each of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.operators.stats import feature_profile
from airloom.schemas import STATISTICS, feature_dim
from airloom.session import materialize
from airloom.sources.tables import Warehouse


def registrations(features: DataFrame) -> DataFrame:
    """Metadata update of a registration: descriptive columns and both time stamps."""
    now = F.current_timestamp()
    return features.select(
        "feature_name", "description", "data_type", "source",
        now.alias("created_at"), now.alias("updated_at"),
    )


def statistics_update(profile: DataFrame) -> DataFrame:
    """Metadata update of a store: only the statistics and the update time."""
    now = F.current_timestamp()
    stats = F.struct(*[
        (now if f.name == "timestamp" else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in STATISTICS
    ])
    return profile.select("feature_name", stats.alias("statistics"), now.alias("updated_at"))


class FeatureStore:
    """Features and their metadata in a warehouse."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse

    def register(self, features: DataFrame) -> DataFrame:
        """Add or update descriptions (feature_name, description, data_type, source)."""
        return self.warehouse.feature_metadata.merge(
            registrations(features), key="feature_name", keep_first=("created_at",)
        )

    def register_feature(
        self, feature_name: str, description: str, data_type: str, source: str
    ) -> DataFrame:
        """Add or update the description of one feature."""
        row = self.warehouse.spark.createDataFrame(
            [(feature_name, description, data_type, source)],
            "feature_name string, description string, data_type string, source string",
        )
        return self.register(row)

    def register_defaults(self) -> DataFrame:
        """Register the nine standard features."""
        return self.register(feature_dim(self.warehouse.spark))

    def store(self, df: DataFrame, *, approx: bool = False) -> DataFrame:
        """Profile ``df`` into the metadata and make it the stored feature table."""
        stored = self.warehouse.features.overwrite(df)
        profile = materialize(feature_profile(stored, approx=approx))
        self.warehouse.feature_metadata.merge(statistics_update(profile), key="feature_name")
        return stored

    def features(self) -> DataFrame:
        return self.warehouse.features.read()

    def metadata(self) -> DataFrame:
        return self.warehouse.feature_metadata.read()
