"""Model artefacts: one pipeline folder and one metadata row."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_model(model: PipelineModel, path: str) -> None:
    """Encoders, feature list and classifier in one folder."""
    model.write().overwrite().save(path)


def load_model_or_none(path: str) -> PipelineModel | None:
    """The model, or None when the path does not exist: scoring then uses the rules. A folder that cannot be read is an error."""
    spark = SparkSession.active()
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return None
    return PipelineModel.load(path)


def model_metadata(
    data, board: DataFrame, importances: DataFrame, dropped: list[str], trained_at: str | None = None
) -> DataFrame:
    """One nested row about a training run.

    ``data`` is the training set. The board has one row per model family and the
    importances one row per feature, so both may be gathered into arrays.
    """
    spark: SparkSession = board.sparkSession
    by_class = data.rows.groupBy("risk_level").agg(
        F.count_if(~F.col("is_test")).alias("train"), F.count_if("is_test").alias("test")
    )
    counts = by_class.agg(
        F.sum("train").alias("training_samples"),
        F.sum("test").alias("test_samples"),
        F.lit(len(data.names)).alias("features_count"),
        F.sort_array(F.collect_list(F.struct("risk_level", "train"))).alias("class_distribution"),
    )
    best = F.min_by(F.struct(*board.columns), F.struct(-F.col("Accuracy"), F.col("Model")))
    models = board.agg(best.alias("best"), F.collect_list(F.struct(*board.columns)).alias("all_models"))
    top = importances.orderBy(F.desc("importance"), F.asc("feature")).limit(20)
    ranked = top.agg(
        F.reverse(F.sort_array(F.collect_list(F.struct("importance", "feature")))).alias("feature_importance")
    )
    stamp = F.lit(trained_at) if trained_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return spark.range(1).select(
        F.struct(
            models.select("best.Model").scalar().alias("model_type"),
            models.select("best.Accuracy").scalar().alias("accuracy"),
            stamp.alias("training_date"),
        ).alias("model_info"),
        F.struct(
            *[counts.select(c).scalar().alias(c) for c in counts.columns],
            F.array(*[F.lit(c) for c in data.classes]).alias("classes"),
        ).alias("data_info"),
        F.struct(
            F.array(*[F.lit(c) for c in data.names]).alias("selected_features"),
            F.array(*[F.lit(c) for c in dropped]).cast("array<string>").alias("removed_multicollinear"),
            F.lit(len(data.names)).alias("feature_count"),
        ).alias("features"),
        F.struct(
            models.select("all_models").scalar().alias("all_models"),
            models.select("best").scalar().alias("best_model_metrics"),
        ).alias("performance"),
        ranked.scalar().alias("feature_importance"),
    )


def save_metadata(metadata: DataFrame, path: str) -> None:
    metadata.write.mode("overwrite").json(path)
