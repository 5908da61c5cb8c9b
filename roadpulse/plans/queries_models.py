"""Training queries. Trained models have no SQL; the driver checks rows only."""

from __future__ import annotations

from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluation, information, scoring, training
from ..session import scratch_path
from ..sources import models
from . import oracle_views as o
from . import views
from .queries_features import rounded_frame
from .queries_history import sql


# Families of the chained query; train_all and model_metadata compare all six.
CHAIN = ("Decision Tree", "AdaBoost", "KNN")


def _data(spark, sf_dir) -> training.TrainingSet:
    return training.prepare(views.accidents(spark, sf_dir, dealt=True))


def train(make):
    """Fit one family on the training rows and report it on the test rows."""

    def run(spark, sf_dir) -> DataFrame:
        data = _data(spark, sf_dir)
        rows = data.rows.filter("not is_test")
        model = make(rows).fit(rows)
        pred = training.named_predictions(model.transform(data.rows.filter("is_test")), data.classes)
        return rounded_frame(evaluation.class_report(pred), ["precision", "recall", "f1"])

    return run


def train_all(spark, sf_dir) -> DataFrame:
    """Every family with its default parameters and folds."""
    board, _ = training.train_all(_data(spark, sf_dir))
    return rounded_frame(board, ["Accuracy", "Precision", "Recall", "F1", "cv_mean", "cv_std"])


def cross_validate(spark, sf_dir) -> DataFrame:
    return rounded_frame(training.cross_validate(training.tree(), _data(spark, sf_dir)), ["accuracy"])


def grid_search(spark, sf_dir) -> DataFrame:
    data = _data(spark, sf_dir)
    tree = training.tree()
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [5, 10]).build()
    found = training.grid_search(tree, grid, data)
    rows = [(p[tree.maxDepth], float(m)) for p, m in zip(grid, found.avgMetrics)]
    return rounded_frame(spark.createDataFrame(rows, "max_depth int, accuracy double"), ["accuracy"])


def importance(spark, sf_dir) -> DataFrame:
    data = _data(spark, sf_dir)
    model = training.tree().fit(data.rows.filter("not is_test"))
    return rounded_frame(training.importance(model, data.names, spark), ["importance"])


def select_features(spark, sf_dir) -> DataFrame:
    """Selected and removed features of the whole selection chain."""
    chosen, dropped = training.select_features(views.accidents(spark, sf_dir))
    rows = [(n, "selected") for n in chosen] + [(n, "removed") for n in dropped]
    return spark.createDataFrame(rows, "feature string, state string")


def _saved_model(spark, sf_dir) -> tuple:
    data = _data(spark, sf_dir)
    model = training.tree().fit(data.rows.filter("not is_test"))
    path = scratch_path(spark, "model")
    models.save_model(training.as_pipeline(data, model), path)
    return data, model, path


def predict(spark, sf_dir) -> DataFrame:
    """Model saved, loaded, and applied to accident rows."""
    _, _, path = _saved_model(spark, sf_dir)
    pred = models.load_model_or_none(path).transform(views.accidents(spark, sf_dir))
    return pred.select("id", F.col("prediction"), scoring.class_probabilities(pred).alias("probabilities"))


def score_with_model(spark, sf_dir) -> DataFrame:
    """Live events scored by a loaded model."""
    _, _, path = _saved_model(spark, sf_dir)
    return scoring.score_events(views.raw_traffic(spark, sf_dir), model=models.load_model_or_none(path), mode="aligned")


def train_save_score(spark, sf_dir) -> DataFrame:
    """The whole chain: features selected, families compared, the best saved, loaded and applied to live events."""
    accidents = views.accidents(spark, sf_dir, dealt=True)
    chosen, _ = training.select_features(accidents, neighbours=information.NEIGHBOUR)
    data = training.prepare(accidents, chosen)
    train = data.rows.filter("not is_test")
    board, fitted = training.train_all(data, {k: v for k, v in training.default_specs(train.count()).items() if k in CHAIN}, folds=2)
    best = board.orderBy(F.desc("Accuracy"), F.asc("Model")).first()["Model"]
    path = scratch_path(spark, "best-model")
    models.save_model(training.as_pipeline(data, fitted[best]), path)
    return scoring.score_events(views.raw_traffic(spark, sf_dir), model=models.load_model_or_none(path), mode="aligned").drop("PredictionId")


def score_without_model(spark, sf_dir) -> DataFrame:
    """A model that cannot be loaded leaves the rules."""
    missing = models.load_model_or_none(scratch_path(spark, "no-model"))
    return scoring.score_events(views.raw_traffic(spark, sf_dir), model=missing)


def model_metadata(spark, sf_dir) -> DataFrame:
    """Metadata of a run over all families on the selected features, with the best one's importances."""
    accidents = views.accidents(spark, sf_dir, dealt=True)
    chosen, dropped = training.select_features(accidents)
    data = training.prepare(accidents, chosen)
    board, fitted = training.train_all(data)
    best = board.orderBy(F.desc("Accuracy"), F.asc("Model")).first()["Model"]
    ranking = training.importance(fitted[best], data.names, spark)
    return models.model_metadata(data, board, ranking, dropped=dropped, trained_at="2024-01-31 00:00:00")


QUERIES = {
    "train_logreg": (train(lambda rows: training.logreg(rows.count())), None),
    "train_tree": (train(lambda rows: training.tree()), None),
    "train_forest": (train(lambda rows: training.forest()), None),
    "train_gbt": (train(lambda rows: training.gbt()), None),
    "train_adaboost": (train(lambda rows: training.adaboost()), None),
    "train_knn": (train(lambda rows: training.Knn()), None),
    "train_all": (train_all, None),
    "cross_validate": (cross_validate, None),
    "grid_search": (grid_search, None),
    "importance": (importance, None),
    "select_features": (select_features, None),
    "predict": (predict, None),
    "model_load": (score_with_model, None),
    "train_save_score": (train_save_score, None),
    "rule_fallback": (score_without_model, sql("SELECT * FROM traffic", o.TRAFFIC)),
    "model_metadata": (model_metadata, None),
}
