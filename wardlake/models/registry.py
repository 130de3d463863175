"""Model registry in shared storage: versions of pipelines, each with a metadata row that is written last."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.models.training import Trained

logger = logging.getLogger(__name__)

REGISTRY_SCHEMA = (
    "model_name string, target_column string, model_type string, rmse double, "
    "feature_columns array<string>, training_timestamp string, model_path string, version int"
)


def save_model(spark: SparkSession, trained: Trained, base: str) -> str:
    """Save the pipeline as a new version in a folder of its own, then its metadata row.

    Until the row is there the version does not exist: readers load the one before, whose files stay. What
    a save that died has left is replaced by the next one. One save of a model runs at a time.
    """
    known = model_versions(spark, base).filter(F.col("model_name") == trained.name)
    version = (known.agg(F.max("version")).first()[0] or 0) + 1
    path = f"models/{trained.name}/version={version}"
    trained.model.write().overwrite().save(f"{base}/{path}")
    row = (
        trained.name,
        trained.target,
        trained.model_type,
        trained.rmse,
        trained.feature_columns,
        trained.trained_at,
        path,
        version,
    )
    spark.createDataFrame([row], REGISTRY_SCHEMA).coalesce(1).write.mode("overwrite").json(
        f"{base}/metadata/{trained.name}/version={version}"
    )
    return path


def model_versions(spark: SparkSession, base: str) -> DataFrame:
    """A row for every saved version; none before the first save."""
    try:
        rows = spark.read.schema(REGISTRY_SCHEMA).option("recursiveFileLookup", True).json(f"{base}/metadata")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    return rows


def registry(spark: SparkSession, base: str) -> DataFrame:
    """The newest version of every model."""
    rows = model_versions(spark, base)
    newest = F.max_by(F.struct(*[c for c in rows.columns if c != "model_name"]), "version").alias("newest")
    return rows.groupBy("model_name").agg(newest).select("model_name", "newest.*")


def list_models(spark: SparkSession, base: str, all_versions: bool = False) -> DataFrame:
    """Names, targets, errors and versions of the newest versions, or of all."""
    rows = model_versions(spark, base) if all_versions else registry(spark, base)
    return rows.select(
        "model_name",
        "target_column",
        "model_type",
        "rmse",
        F.size("feature_columns").alias("feature_count"),
        "training_timestamp",
        "version",
    )


def load_models(spark: SparkSession, base: str) -> dict[str, PipelineModel]:
    """The newest version of every model; one that cannot be loaded is logged and left out."""
    models = {}
    for row in registry(spark, base).select("model_name", "model_path").collect():
        try:
            models[row.model_name] = PipelineModel.load(f"{base}/{row.model_path}")
        except Exception as error:
            logger.warning("model %s could not be loaded: %s", row.model_name, error)
    return models
