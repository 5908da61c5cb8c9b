"""Model training, comparison, tuning and importance on MLlib."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..session import shared_dir
from ..sources.tables import union_rows
from . import evaluation, features, information, ordering
from .boosting import AdaBoost, EnsembleModel, GradientBoosting
from .neighbours import Knn
from .scoring import class_probabilities

log = logging.getLogger(__name__)

# The training parameters of every model family.
SEED = 42
FOLDS = 5
TEST_SHARE = 0.2
LOGREG_ITERATIONS = 1000
LOGREG_TOLERANCE = 1e-4
TREE_DEPTH = 10
TREES = 100
BOOST_ROUNDS = 100
BOOST_DEPTH = 5
NEIGHBOURS = 5
# Fits of one family that run side by side.
PARALLEL = 3


@dataclass
class TrainingSet:
    """Vectors, labels and the fitted stages that made them."""

    rows: DataFrame
    stages: list
    classes: list[str]
    names: list[str]


def prepare(accidents: DataFrame, names=features.CANDIDATES, key: str = "id") -> TrainingSet:
    """Accident rows to (id, features, label, risk_level, is_test, fold).

    Split and folds come from keyed hashes. The frame is persisted, because
    every training pass reads it.
    """
    shared_dir(accidents.sparkSession)  # boosting checkpoints there
    indexer = StringIndexer(inputCol="risk_level", outputCol="label", stringOrderType="alphabetAsc").fit(accidents)
    stages = [indexer, *features.fit_stages(accidents, names)]
    ready = PipelineModel(stages).transform(accidents).select(key, "features", "label", "risk_level")
    split = ordering.stratified_split(ready, "risk_level", key, TEST_SHARE, SEED)
    rows = ordering.assign_folds(split, "risk_level", key, FOLDS, SEED).persist()
    return TrainingSet(rows, stages, list(indexer.labels), list(names))


def select_features(
    accidents: DataFrame, limit: float = features.PRUNE_LIMIT, k: int = features.SELECTED, neighbours: int | None = None
) -> tuple:
    """Candidate features without correlated ones, then the best by mutual information.

    The information is that of bins, or by nearest ``neighbours`` if their number is given.
    Returns the selected names and the removed ones.
    """
    found = features.profile(accidents)
    corr = features.corr_of(accidents.sparkSession, found.whole())
    kept, dropped = features.corr_prune(corr, limit)
    table = features.candidate_features(accidents, found=found)
    if neighbours:
        scores = information.mutual_info_knn(table, kept, "risk_level", neighbours, found.whole())
    else:
        scores = features.mutual_info(table, kept, "risk_level", found=found.whole())
    chosen = [r["feature"] for r in features.top_features(scores, min(k, len(kept))).collect()]
    return chosen, dropped


def logreg(rows: int, iterations: int = LOGREG_ITERATIONS) -> LogisticRegression:
    """Multinomial regression with a unit-strength L2 penalty, as a share of the rows."""
    return LogisticRegression(
        family="multinomial", maxIter=iterations, regParam=1.0 / max(rows, 1), elasticNetParam=0.0,
        standardization=False, tol=LOGREG_TOLERANCE,
    )


def tree(depth: int = TREE_DEPTH, seed: int = SEED) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=depth, seed=seed)


def forest(n: int = TREES, depth: int = TREE_DEPTH, seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=n, maxDepth=depth, seed=seed)


def gbt(n: int = BOOST_ROUNDS, depth: int = BOOST_DEPTH) -> GradientBoosting:
    return GradientBoosting(n, depth)


def adaboost(n: int = BOOST_ROUNDS) -> AdaBoost:
    return AdaBoost(n)


def default_specs(rows: int) -> dict:
    """Every model family with its fixed parameters."""
    return {
        "Logistic Regression": logreg(rows),
        "Decision Tree": tree(),
        "Random Forest": forest(),
        "Gradient Boosting": gbt(),
        "AdaBoost": adaboost(),
        "KNN": Knn(NEIGHBOURS),
    }


def named_predictions(pred: DataFrame, classes: list[str]) -> DataFrame:
    """Label and prediction as class names."""
    names = F.array(*[F.lit(c) for c in classes])

    def name(c: str) -> Column:
        return F.element_at(names, (F.col(c) + 1).cast("int"))

    return pred.select("id", name("label").alias("label"), name("prediction").alias("prediction"))


def with_probabilities(pred: DataFrame) -> DataFrame:
    """Prediction with its class probabilities as an array."""
    return pred.withColumn("probabilities", class_probabilities(pred))


def fit_folds(estimator, data: TrainingSet, folds: int = FOLDS) -> list:
    """A model without each fold, and last the one of all training rows.

    Boosting fits all in the same passes; other families are fitted side by side.
    """
    train = data.rows.filter("not is_test")
    if hasattr(estimator, "fit_folds"):
        return estimator.fit_folds(train, folds)
    frames = [train.filter(F.col("fold") != i) for i in range(folds)] + [train]
    with ThreadPoolExecutor(PARALLEL) as pool:
        return list(pool.map(inheritable_thread_target(train.sparkSession)(estimator.fit), frames))


def fold_accuracy(models: list, data: TrainingSet) -> DataFrame:
    """Accuracy of each fold by the model that was fitted without it."""
    train = data.rows.filter("not is_test")
    scores = []
    for i, model in enumerate(models):
        pred = model.transform(train.filter(F.col("fold") == i))
        scores.append(
            pred.agg(
                F.lit(i).alias("fold"),
                (F.count_if(F.col("label") == F.col("prediction")) / F.count(F.lit(1))).alias("accuracy"),
            )
        )
    return union_rows(*scores)


def cross_validate(estimator, data: TrainingSet, folds: int = FOLDS) -> DataFrame:
    """Accuracy of every fold of the training rows."""
    return fold_accuracy(fit_folds(estimator, data, folds)[:-1], data)


def train_all(data: TrainingSet, specs: dict | None = None, folds: int = FOLDS) -> tuple[DataFrame, dict]:
    """Fit and evaluate every family; a family that fails is skipped.

    Returns the leaderboard and the fitted models.
    """
    train, test = data.rows.filter("not is_test"), data.rows.filter("is_test")
    specs = specs or default_specs(train.count())
    rows, models = [], {}
    for name, estimator in specs.items():
        try:
            *parts, model = fit_folds(estimator, data, folds)
            scores = evaluation.model_scores(named_predictions(model.transform(test), data.classes), name)
            summary = evaluation.cv_summary(fold_accuracy(parts, data))
            row = {**scores.first().asDict(), **summary.first().asDict()}
        except Exception as error:  # one family must not end the comparison
            log.warning("%s skipped: %s", name, error)
            continue
        rows.append(row)
        models[name] = model
    layout = "Model string, Accuracy double, Precision double, Recall double, F1 double, cv_mean double, cv_std double"
    board = data.rows.sparkSession.createDataFrame(
        [[r[c.split()[0]] for c in layout.split(", ")] for r in rows], layout
    )
    return evaluation.leaderboard(board), models


def grid_search(estimator, grid: list, data: TrainingSet, parallelism: int = 4):
    """Best parameters by fold accuracy; returns the cross-validation model."""
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy", labelCol="label")
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=FOLDS,
        foldCol="fold", parallelism=parallelism, seed=SEED,
    )
    return search.fit(data.rows.filter("not is_test"))


def importance(model, names: list[str], spark) -> DataFrame:
    """Importance of every feature: of trees, the say of boosted stumps or the gain of boosted trees by feature,
    else absolute coefficients of the first class, else 0."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif isinstance(model, EnsembleModel):
        values = model.importances
    elif hasattr(model, "coefficientMatrix"):
        values = abs(model.coefficientMatrix.toArray()[0])
    else:
        values = [0.0] * len(names)
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), F.asc("feature")
    )


def as_pipeline(data: TrainingSet, model) -> PipelineModel:
    """One artefact from accident or serving rows to a prediction."""
    return PipelineModel([*data.stages, model])
