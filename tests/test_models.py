"""Features, selection, training, persistence and scoring."""

import numpy as np
import pytest
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from roadpulse.operators import boosting, features, information, moments, scoring, training
from roadpulse.plans import views
from roadpulse.schemas import EVENT_SCHEMA
from roadpulse.sources import models


@pytest.fixture(scope="module")
def data(spark, sf_dir):
    return training.prepare(views.accidents(spark, sf_dir))


@pytest.fixture(scope="module")
def tree_model(data):
    return training.tree().fit(data.rows.filter("not is_test"))


def accuracy(data, model):
    pred = model.transform(data.rows.filter("is_test"))
    return pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0]


def majority(data):
    test = data.rows.filter("is_test")
    return test.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]


def test_codes_missing_and_unseen(spark):
    rows = spark.createDataFrame([("b",), ("a",), (None,)], "weather string")
    prepare, indexer = features.label_indexers(["weather"])
    model = indexer.fit(prepare.transform(rows))
    new = spark.createDataFrame([("a",), ("b",), (None,), ("zzz",)], "weather string")
    coded = features.known_codes(model, ["weather"]).transform(model.transform(prepare.transform(new)))
    # "None" sorts before lower-case names; an unseen value counts as class 0.
    assert [r.weather_encoded for r in coded.collect()] == [1.0, 2.0, 0.0, 0.0]


def numeric_frame(spark, n=400):
    rng = np.random.default_rng(3)
    x = rng.normal(size=n)
    z = rng.normal(size=n)
    table = {"x": x + 2, "y": x * 3 + rng.normal(scale=0.4, size=n) - 1, "z": z, "twin": z * 2, "flat": np.full(n, 7.0)}
    names = list(table)
    return spark.createDataFrame([tuple(map(float, r)) for r in zip(*table.values())], names), table


def inflation(table, name, names):
    target = table[name]
    others = np.column_stack([table[n] for n in names if n != name])
    fit, *_ = np.linalg.lstsq(others, target, rcond=None)
    residual = ((target - others @ fit) ** 2).sum()
    constant = np.linalg.matrix_rank(np.column_stack([others, np.ones(len(target))])) == np.linalg.matrix_rank(others)
    total = ((target - target.mean()) ** 2).sum() if constant else (target**2).sum()
    return total / residual


def test_inflation_factors(spark):
    frame, table = numeric_frame(spark)
    for names in (["x", "y", "z"], ["x", "y", "z", "flat"]):
        got = {r.feature: r.vif for r in features.vif(frame, names).collect()}
        for n in names:
            if n != "flat":
                assert got[n] == pytest.approx(inflation(table, n, names), rel=1e-6)
    got = {r.feature: r.vif for r in features.vif(frame, list(table)).collect()}
    assert got["z"] == got["twin"] == 999.0
    assert {r.feature for r in features.high_vif(features.vif(frame, list(table))).collect()} == {
        n for n, v in got.items() if v > 10
    }


def test_correlation_and_pruning(spark):
    frame, table = numeric_frame(spark)
    corr = features.corr_matrix(frame, list(table))
    got = {(r.feature_a, r.feature_b): r.r for r in corr.collect()}
    assert got[("x", "y")] == pytest.approx(np.corrcoef(table["x"], table["y"])[0, 1])
    assert got[("x", "flat")] is None
    assert features.corr_prune(corr) == (["x", "z", "flat"], ["y", "twin"])
    assert [(r.feature_a, r.feature_b) for r in features.corr_pairs(corr).collect()][0] == ("z", "twin")


def test_moments_of_many_tasks_equal_plain_ones(spark):
    """Labels, missing values and categories that only some tasks hold, merged pairwise."""
    rng = np.random.default_rng(5)
    n = 3000
    x, y = rng.normal(1e6, 1, n), rng.normal(size=n)
    y[rng.random(n) < 0.1] = np.nan
    place = np.where(np.arange(n) < 40, "rare", np.where(rng.random(n) < 0.5, "a", "b"))
    label = np.where(rng.random(n) < 0.3, "High", "Low")
    rows = [(float(a), None if np.isnan(b) else float(b), str(c), str(d)) for a, b, c, d in zip(x, y, place, label)]
    frame = spark.createDataFrame(rows, "x double, y double, place string, label string").repartitionByRange(40, "place", "x")
    found = moments.moments_by(frame, ["x", "y"], "label", ["place"])
    every = moments.whole(found, ["x", "y"])
    assert every.categories() == {"place": ["a", "b", "rare"]} and every.present_mean("y") == pytest.approx(np.nanmean(y))
    codes = {"code": ("place", {"a": 0.0, "b": 1.0, "rare": 5.0})}
    names = ["x", "y", "code"]
    table = np.column_stack([x, np.where(np.isnan(y), np.nanmean(y), y), [codes["code"][1][p] for p in place]])
    for got, rows in [(every, label != ""), (found["High"], label == "High"), (found["Low"], label == "Low")]:
        got = got.mapped({"x": 0.0, "y": float(np.nanmean(y))}, codes, names)
        assert got.count == rows.sum() and np.allclose(got.mean, table[rows].mean(axis=0))
        assert np.allclose(got.spread / (rows.sum() - 1), np.cov(table[rows].T), atol=1e-9)
        assert np.allclose(got.low, table[rows].min(axis=0)) and np.allclose(got.high, table[rows].max(axis=0))


def test_moments_of_nothing_and_of_gaps_only(spark):
    frame = spark.createDataFrame([(None, None), (None, None)], "x double, label string")
    found = moments.moments_by(frame, ["x"], "label")
    assert set(found) == {None} and found[None].count == 2 and found[None].present_mean("x") == 0.0
    assert features.corr_matrix(frame.limit(0), ["x"]).first().r is None
    assert features.anova_f(frame, ["x"], "label").first().score is None


def test_profile_equals_the_features_it_describes(spark, sf_dir):
    """The linear maps give what a pass over the encoded, filled features gives; one job is run."""
    rows = views.accidents(spark, sf_dir).withColumn("windspeed", F.when(F.col("hour") != 3, F.col("windspeed")))
    names = list(features.CANDIDATES)
    found = features.profile(rows, label="risk_level")
    again = features.moments(features.candidate_features(rows, found=found), names)
    got = found.whole()
    assert got.names == names and got.count == again.count
    assert np.allclose(got.mean, again.mean) and np.allclose(got.low, again.low) and np.allclose(got.high, again.high)
    assert np.allclose(got.spread, again.spread, rtol=1e-9, atol=1e-7)


def test_split_keeps_every_label(data):
    rows = data.rows.groupBy("risk_level").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()
    assert all(r.t == round(0.2 * r.n) for r in rows)


def test_families_beat_the_majority(data, tree_model):
    floor = majority(data)
    train = data.rows.filter("not is_test")
    fitted = {
        "tree": tree_model,
        "forest": training.forest(n=10).fit(train),
        "adaboost": training.adaboost(n=15).fit(train),
        "logreg": training.logreg(train.count(), iterations=50).fit(train),
        "gbt": training.gbt(n=3).fit(train),
    }
    got = {name: accuracy(data, model) for name, model in fitted.items()}
    assert all(v > floor for v in got.values()), (floor, got)
    assert got["tree"] > 0.85


def test_boosting_follows_its_definition(spark):
    """Every round must equal a plain weighted search over all splits."""
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(5)
    x = rng.integers(0, 8, size=(120, 3)).astype(float)
    y = ((x[:, 0] > 3).astype(int) + (x[:, 1] > 5)).astype(int)
    frame = spark.createDataFrame([(Vectors.dense(r), float(c)) for r, c in zip(x, y)], ["features", "label"])
    model = training.AdaBoost(n=6, cut_every=2).fit(frame)
    w = np.ones(len(y))
    for stump in model.stumps:
        best = -1.0
        for j in range(3):
            for t in np.unique(x[:, j])[:-1]:
                side = x[:, j] <= t
                score = 0.0
                for part in (side, ~side):
                    sums = np.bincount(y[part], w[part], minlength=3)
                    score += (sums**2).sum() / sums.sum()
                best = max(best, score)
        side = x[:, stump.feature] <= stump.threshold
        mine = sum((np.bincount(y[p], w[p], minlength=3) ** 2).sum() / w[p].sum() for p in (side, ~side))
        assert mine == pytest.approx(best)
        pred = np.where(side, stump.left, stump.right)
        error = w[pred != y].sum() / w.sum()
        assert stump.say == pytest.approx(np.log((1 - error) / error) + np.log(2))
        w = w * np.exp(stump.say * (pred != y))


def boosted_frame(spark, n=240):
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(11)
    x = rng.integers(0, 9, size=(n, 4)).astype(float)
    y = ((x[:, 0] > 4).astype(int) + (x[:, 1] * x[:, 2] > 20)).astype(int)
    fold = rng.integers(0, 3, n)
    rows = [(i, Vectors.dense(r), float(c), int(k)) for i, (r, c, k) in enumerate(zip(x, y, fold))]
    return spark.createDataFrame(rows, ["id", "features", "label", "fold"]), x, y, fold


def plain_boosting(x, y, rounds, depth, rate):
    """Scores after boosting with exact splits at every value, written the straight way."""
    classes = y.max() + 1
    f = np.tile(np.log(np.bincount(y) / len(y)), (len(y), 1))

    def grow(rows, residual, weight, level):
        value = rate * (classes - 1) / classes * residual[rows].sum() / weight[rows].sum()
        best, split = 1e-12, None
        for j in range(x.shape[1]):
            for t in np.unique(x[:, j])[:-1]:
                left, right = rows[x[rows, j] <= t], rows[x[rows, j] > t]
                if level < depth and len(left) and len(right):
                    gain = len(left) * len(right) / len(rows) * (residual[left].mean() - residual[right].mean()) ** 2
                    if gain > best + 1e-9:
                        best, split = gain, (left, right)
        if split is None:
            return [(rows, value)]
        return grow(split[0], residual, weight, level + 1) + grow(split[1], residual, weight, level + 1)

    for _ in range(rounds):
        p = np.exp(f) / np.exp(f).sum(axis=1, keepdims=True)
        step = np.zeros_like(f)
        for c in range(classes):
            for rows, value in grow(np.arange(len(y)), (y == c) - p[:, c], p[:, c] * (1 - p[:, c]), 0):
                step[rows, c] = value
        f += step
    return f


def test_tree_boosting_follows_its_definition(spark):
    frame, x, y, fold = boosted_frame(spark)
    models_ = training.GradientBoosting(n=4, depth=3, cut_every=2).fit_folds(frame, 3)
    assert models_[-1].scores(x) == pytest.approx(plain_boosting(x, y, 4, 3, 0.1))
    for k in range(3):
        rows = fold != k
        alone = training.GradientBoosting(n=4, depth=3, cut_every=3).fit(frame.filter(F.col("fold") != k))
        assert models_[k].scores(x) == pytest.approx(alone.scores(x))
        assert (models_[k].scores(x[rows]).argmax(axis=1) == y[rows]).mean() > 0.9
    assert models_[-1].importances.sum() == pytest.approx(1.0)


def test_stumps_of_all_folds_at_once(spark):
    frame, x, _, _ = boosted_frame(spark)
    together = training.AdaBoost(n=7, cut_every=3).fit_folds(frame, 3)
    for k, model in enumerate(together):
        alone = training.AdaBoost(n=7, cut_every=2).fit(frame.filter(F.col("fold") != k) if k < 3 else frame)
        assert [(s.feature, s.threshold, s.left, s.right) for s in model.stumps] == [(s.feature, s.threshold, s.left, s.right) for s in alone.stumps]
        assert [s.say for s in model.stumps] == pytest.approx([s.say for s in alone.stumps])


def test_a_round_of_boosting_starts_no_more_tasks_than_cores(spark):
    """Every pass starts all its tasks, so a boosting round costs a task for each partition, however few rows these hold."""
    frame, x, y, fold = boosted_frame(spark, 2500)
    cores = spark.sparkContext.defaultParallelism
    blocks, data = boosting.binned(frame.repartition(5 * cores), 3)
    assert blocks.getNumPartitions() == cores
    held = blocks.collect()
    assert sorted(np.concatenate([b.y for b in held])) == sorted(y) and sorted(np.concatenate([b.fold for b in held])) == sorted(fold)


def test_features_counted_together_give_each_its_histogram(spark):
    """Joint bins of several fits, summed over, against a count of each feature alone."""
    rng = np.random.default_rng(2)
    v = np.column_stack([rng.integers(0, n, 3000) for n in (3, 60, 1, 7, 2, 300)]).astype(float)
    edges = [[list(np.unique(rng.choice(v[:, j], 31))[:-1].tolist()) for j in range(6)] for _ in range(4)]
    data = boosting.Layout(edges, 2, 6, 32)
    assert sorted(j for g in data.groups for j in g) == list(range(6)) and len(data.groups) < 6
    assert all(len(g) == 1 or data.joint(g) <= boosting.JOINT for g in data.groups)
    x, w = data.binned(v), rng.random(3000)
    for t in range(4):
        got = data.by_feature(t, [np.bincount(z, w, data.joint(g)) for g, z in zip(data.groups, data.joined(x))])
        for j in range(6):
            own = np.searchsorted(edges[t][j], v[:, j])
            assert got[j] == pytest.approx(np.bincount(own, w, 32))
            for i, place in enumerate(data.places[t][j]):
                assert ((x[j] <= place) == (v[:, j] <= edges[t][j][i])).all()


def test_boosting_of_one_class(spark):
    frame, x, _, _ = boosted_frame(spark, 40)
    flat = frame.withColumn("label", F.lit(0.0))
    for estimator in (training.AdaBoost(n=3), training.GradientBoosting(n=2, depth=2)):
        rows = estimator.fit(flat).transform(flat).collect()
        assert {r.prediction for r in rows} == {0.0} and all(r.probability.toArray().tolist() == [1.0] for r in rows)


def test_every_family_saves_loads_and_scores(spark, sf_dir, data, tmp_path):
    train = data.rows.filter("not is_test")
    families = {
        "logreg": training.logreg(train.count(), 20), "tree": training.tree(4), "forest": training.forest(3, 4),
        "gbt": training.gbt(2, 2), "adaboost": training.adaboost(4), "knn": training.Knn(3),
    }
    assert len(families) == len(training.default_specs(10))
    raw = views.raw_traffic(spark, sf_dir).limit(60)
    for name, estimator in families.items():
        model, path = estimator.fit(train), str(tmp_path / name)
        models.save_model(training.as_pipeline(data, model), path)
        loaded = models.load_model_or_none(path)
        rows = data.rows.filter("is_test").limit(40)
        plain = {r.id: (r.prediction, r.probability.toArray().tolist()) for r in model.transform(rows).collect()}
        again = {r.id: (r.prediction, r.probability.toArray().tolist()) for r in loaded.stages[-1].transform(rows).collect()}
        assert plain == again and len(plain) == 40
        scored = scoring.score_events(raw, model=loaded).collect()
        assert len(scored) == 60 and all(r.AIExplanation.startswith("ML model prediction: ") for r in scored)


def test_a_broken_model_folder_is_an_error(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    with pytest.raises(Exception):
        models.load_model_or_none(str(tmp_path / "broken"))


def test_knn_model_matches_a_plain_vote(spark):
    frame, x, y, _ = boosted_frame(spark, 150)
    got = {r.id: r for r in training.Knn(5).fit(frame).transform(frame.union(frame)).collect()}
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    for i in range(len(y)):
        near = sorted(range(len(y)), key=lambda j: (distance[i, j], j))[:5]
        votes = np.bincount(y[near], minlength=3)
        assert got[i].prediction == votes.argmax() and got[i].probability.toArray() == pytest.approx(votes / 5)


def test_comparison_of_all_six_families(spark, sf_dir, monkeypatch):
    """A small real run: every family and fold, nothing replaced but the size of the ensembles."""
    small = training.prepare(views.accidents(spark, sf_dir), features.CANDIDATES[:6])
    monkeypatch.setattr(training, "forest", lambda: training.RandomForestClassifier(numTrees=3, maxDepth=3, seed=1))
    monkeypatch.setattr(training, "gbt", lambda: training.GradientBoosting(2, 2))
    monkeypatch.setattr(training, "adaboost", lambda: training.AdaBoost(3))
    board, fitted = training.train_all(small)
    rows = board.collect()
    assert {r.Model for r in rows} == set(fitted) == set(training.default_specs(10)) and len(rows) == 6
    assert all(0 < r.Accuracy <= 1 and 0 < r.cv_mean <= 1 for r in rows)


def test_comparison_skips_a_failing_family(data):
    class Broken:
        def fit(self, rows):
            raise ValueError("cannot fit")

    board, fitted = training.train_all(data, {"Broken": Broken(), "Tree": training.tree(depth=4)}, folds=2)
    assert [r.Model for r in board.collect()] == ["Tree"] and list(fitted) == ["Tree"]
    assert 0 <= board.first().cv_std < 0.2


def test_grid_search(data):
    tree = training.tree()
    found = training.grid_search(tree, ParamGridBuilder().addGrid(tree.maxDepth, [1, 6]).build(), data)
    assert found.bestModel.depth > 1


def test_importance(spark, data, tree_model):
    ranks = training.importance(tree_model, data.names, spark).collect()
    assert len(ranks) == len(features.CANDIDATES)
    assert sum(r.importance for r in ranks) == pytest.approx(1.0)
    assert ranks[0].importance >= ranks[-1].importance


def test_selection(spark, sf_dir):
    chosen, dropped = training.select_features(views.accidents(spark, sf_dir))
    assert len(chosen) <= 20 and not set(chosen) & set(dropped)
    assert set(chosen) | set(dropped) <= set(features.CANDIDATES)


def test_saved_model_scores_events(spark, sf_dir, data, tree_model, tmp_path):
    path = str(tmp_path / "model")
    models.save_model(training.as_pipeline(data, tree_model), path)
    loaded = models.load_model_or_none(path)
    assert features.feature_names(loaded) == list(features.CANDIDATES)
    raw = views.raw_traffic(spark, sf_dir)
    for mode in ("reference", "aligned"):
        scored = scoring.score_events(raw, model=loaded, mode=mode)
        assert scored.columns == EVENT_SCHEMA.names
        rows = scored.collect()
        assert len(rows) == 1000 and all(r.AIExplanation.startswith("ML model prediction: ") for r in rows)
        for r in rows:
            total = r.RiskProbabilityHigh + r.RiskProbabilityMedium + r.RiskProbabilityLow
            assert total == pytest.approx(1.0, abs=2e-4)
            named = {"High": r.RiskProbabilityHigh, "Medium": r.RiskProbabilityMedium, "Low": r.RiskProbabilityLow}
            assert named[r.RiskLevel] == pytest.approx(r.Confidence) and 0.3 <= r.RiskScore <= 0.9
    # The event keeps its own coordinates, whatever the features were.
    assert {(r.EventId, r.Latitude) for r in rows} == {(r.EventId, r.Latitude) for r in raw.collect()}
    boosted = training.gbt(n=2, depth=2).fit(data.rows.filter("not is_test"))
    by_votes = scoring.score_events(raw, model=training.as_pipeline(data, boosted)).first()
    assert 0 <= by_votes.Confidence <= 1


def test_missing_model_means_rules(spark, sf_dir, tmp_path):
    assert models.load_model_or_none(str(tmp_path / "none")) is None
    scored = scoring.score_events(views.raw_traffic(spark, sf_dir), model=None)
    assert scored.filter("AIExplanation like 'ML%'").count() == 0


def test_feature_row_fills_missing_with_zero(spark):
    frame = spark.createDataFrame([(1, None)], "hour int, month int")
    assert tuple(scoring.feature_row(frame, ["month", "hour", "absent"]).first()) == (0.0, 1.0, 0.0)


def test_metadata(spark, data, tree_model, tmp_path):
    board, _ = training.train_all(data, {"Tree": training.tree(depth=3)}, folds=2)
    meta = models.model_metadata(data, board, training.importance(tree_model, data.names, spark), ["x"], "2024-01-01 00:00:00")
    models.save_metadata(meta, str(tmp_path / "meta"))
    row = spark.read.json(str(tmp_path / "meta")).first()
    assert row.model_info.model_type == "Tree" and row.data_info.training_samples + row.data_info.test_samples == 1000
    assert len(row.feature_importance) == 20 and row.features.removed_multicollinear == ["x"]


def test_new_ids_differ(spark):
    rows = scoring.new_ids(spark.range(5)).collect()
    assert len({r.EventId for r in rows} | {r.PredictionId for r in rows}) == 10


def test_registered_training_runs_all_families_and_folds(spark, sf_dir, monkeypatch):
    from roadpulse.operators import training
    from roadpulse.plans import queries_models

    names = list(training.default_specs(10))
    calls = []

    def run(data, specs=None, folds=training.FOLDS):
        found = list(specs or training.default_specs(10))
        calls.append((len(found), folds))
        rows = [(n, 0.5, 0.5, 0.5, 0.5, 0.5, 0.1) for n in found]
        layout = "Model string, Accuracy double, Precision double, Recall double, F1 double, cv_mean double, cv_std double"
        return spark.createDataFrame(rows, layout), dict.fromkeys(found)

    monkeypatch.setattr(training, "train_all", run)
    monkeypatch.setattr(training, "select_features", lambda accidents: (["hour", "month"], ["is_weekend"]))
    assert {r.Model for r in queries_models.train_all(spark, sf_dir).collect()} == set(names) and len(names) == 6
    row = queries_models.model_metadata(spark, sf_dir).first()
    assert {m.Model for m in row.performance.all_models} == set(names)
    assert row.features.removed_multicollinear == ["is_weekend"] and row.features.selected_features == ["hour", "month"]
    assert calls == [(6, training.FOLDS)] * 2


def plain_information(values, labels, k=3):
    """The estimate from all distances, and digamma from harmonic numbers."""
    lo, hi = values.min(), values.max()
    grid = np.floor((values - lo) / (hi - lo) * information.STEPS + 0.5).astype(np.int64) if hi > lo else np.zeros(len(values), np.int64)
    sizes = {c: int((labels == c).sum()) for c in set(labels)}
    kept = np.array([sizes[c] > 1 for c in labels])
    grid, labels = grid[kept], labels[kept]
    psi = np.concatenate([[0.0], -np.euler_gamma + np.concatenate([[0.0], np.cumsum(1 / np.arange(1, len(grid) + 1))])])
    total = 0.0
    for x, c in zip(grid, labels):
        distance = np.abs(grid - x)
        own = distance[labels == c]
        take = min(k, sizes[c] - 1)
        d = np.partition(own, take)[take]
        if d == 0:
            total += psi[(own == 0).sum() - 1] - psi[(distance == 0).sum() - 1]
        else:
            total += psi[take] - psi[(distance < d).sum()]
        total -= psi[sizes[c]]
    return max(total / len(grid) + psi[len(grid)], 0.0)


def test_information_by_neighbours_matches_all_distances(spark):
    draw = np.random.default_rng(5)
    n = 10_000
    labels = np.array(["a", "b", "c"], dtype=object)[draw.choice(3, n, p=[0.7, 0.25, 0.05])]
    labels[7] = "once"
    shift = np.array([{"a": 0.0, "b": 1.0, "c": 3.0, "once": 0.0}[c] for c in labels])
    columns = {
        "far": draw.normal(shift, 0.5), "noise": draw.uniform(size=n), "few": np.round(draw.normal(shift, 1.0)),
        "hot": np.where(draw.uniform(size=n) < 0.4, 0.25, draw.exponential(1 + shift)), "flat": np.full(n, 2.0),
    }
    rows = [(str(labels[i]), *[float(v[i]) for v in columns.values()]) for i in range(n)]
    frame = spark.createDataFrame(rows, "label string, " + ", ".join(f"{c} double" for c in columns))
    got = {r.feature: r.score for r in information.mutual_info_knn(frame, list(columns), "label").collect()}
    assert set(got) == set(columns)
    for name, values in columns.items():
        assert got[name] == pytest.approx(plain_information(values, labels), abs=1e-9), name
    binned = {r.feature: r.score for r in features.mutual_info(frame, list(columns), "label").collect()}
    assert sorted(got, key=got.get)[-2:] == sorted(binned, key=binned.get)[-2:] == ["few", "far"]
    assert got["far"] > 0.3 and got["noise"] < 0.02 and got["flat"] == 0.0


def test_information_of_short_ranges_and_no_rows(spark):
    """Ranges of one row, labels of fewer rows than neighbours, null labels and an empty table."""
    rows = [("a", 1.0), ("a", 4.0), ("b", 2.0), ("b", 2.5), ("b", 9.0), ("a", 7.0), ("b", 3.0), ("once", 5.0)]
    frame = spark.createDataFrame([*rows, (None, 6.0)], "label string, x double").repartition(8)
    want = plain_information(np.array([x for _, x in rows]), np.array([c for c, _ in rows]))
    assert information.mutual_info_knn(frame, ["x"], "label").first().score == pytest.approx(want, abs=1e-9)
    assert information.mutual_info_knn(frame.limit(0), ["x"], "label").count() == 0
