"""Feature, evaluation and nearest-neighbour queries with their SQL."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluation, features, information, neighbours, ordering
from ..sources import tables
from . import oracle_views as o
from . import views
from .queries_history import r6, sql

NAMES = list(features.CANDIDATES)


def rounded_frame(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def candidates(spark, sf_dir) -> DataFrame:
    return features.candidate_features(views.accidents(spark, sf_dir))


def feature_rows(spark, sf_dir) -> DataFrame:
    return rounded_frame(candidates(spark, sf_dir), NAMES)


def label_encode(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir)
    prepare, indexer = features.label_indexers()
    model = indexer.fit(prepare.transform(rows))
    coded = PipelineModel([prepare, model, features.known_codes(model)]).transform(rows)
    return coded.select("id", *[f"{c}_encoded" for c in features.CATEGORICAL])


def mean_impute(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir)
    filled = features.mean_impute(rows, ["temperature", "windspeed"])
    return filled.select("id", r6("temperature").alias("temperature"), r6("windspeed").alias("windspeed"))


def correlations(spark, sf_dir) -> DataFrame:
    found = features.profile(views.accidents(spark, sf_dir))
    return features.corr_of(spark, found.whole()).withColumn("r", r6("r"))


def corr_matrix(spark, sf_dir) -> DataFrame:
    return correlations(spark, sf_dir).filter("pos_a < pos_b").select("feature_a", "feature_b", "r")


def corr_pairs(spark, sf_dir) -> DataFrame:
    return features.corr_pairs(correlations(spark, sf_dir))


def corr_prune(spark, sf_dir) -> DataFrame:
    kept, dropped = features.corr_prune(correlations(spark, sf_dir))
    rows = [(n, True) for n in kept] + [(n, False) for n in dropped]
    return spark.createDataFrame(rows, "feature string, kept boolean")


def vif(spark, sf_dir) -> DataFrame:
    found = features.profile(views.accidents(spark, sf_dir))
    return rounded_frame(features.vif_of(spark, found.whole()), ["vif"])


def high_vif(spark, sf_dir) -> DataFrame:
    return features.high_vif(vif(spark, sf_dir))


def anova_f(spark, sf_dir) -> DataFrame:
    found = features.profile(views.accidents(spark, sf_dir), label="risk_level")
    return features.anova_of(spark, found.classes, NAMES).withColumn("score", r6("score"))


def mutual_info(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir)
    found = features.profile(rows)
    frame = features.candidate_features(rows, found=found)
    return features.mutual_info(frame, NAMES, "risk_level", found=found.whole()).withColumn("score", r6("score"))


def mutual_info_knn(spark, sf_dir) -> DataFrame:
    """The same by nearest neighbours, as the reference selects features."""
    rows = views.accidents(spark, sf_dir)
    found = features.profile(rows)
    frame = features.candidate_features(rows, found=found)
    return information.mutual_info_knn(frame, NAMES, "risk_level", found=found.whole()).withColumn("score", r6("score"))


def top_features(spark, sf_dir) -> DataFrame:
    return features.top_features(mutual_info(spark, sf_dir), 20)


def existing_columns(spark, sf_dir) -> DataFrame:
    """Requested columns a table has; the others are left out."""
    rows = views.accidents(spark, sf_dir)
    return rows.select("id", *tables.existing(rows, ["hour", "no_such_column", "lanes"]))


def stratified_split(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir).select("id", "risk_level")
    return ordering.stratified_split(rows, "risk_level", "id")


def folds(spark, sf_dir) -> DataFrame:
    rows = views.accidents(spark, sf_dir).select("id", "risk_level")
    return ordering.assign_folds(rows, "risk_level", "id")


def confusion_matrix(spark, sf_dir) -> DataFrame:
    return evaluation.confusion(views.predictions(spark, sf_dir))


def class_report(spark, sf_dir) -> DataFrame:
    return rounded_frame(evaluation.class_report(views.predictions(spark, sf_dir)), ["precision", "recall", "f1"])


def cv_summary(spark, sf_dir) -> DataFrame:
    folded = ordering.assign_folds(views.predictions(spark, sf_dir), "label", "id")
    return rounded_frame(evaluation.cv_summary(evaluation.fold_accuracy(folded)), ["cv_mean", "cv_std"])


def leaderboard(spark, sf_dir) -> DataFrame:
    """The live rules against two one-class rules."""
    pred = views.predictions(spark, sf_dir)
    boards = [evaluation.model_scores(pred, "rules")]
    for name in ("High", "Low"):
        boards.append(evaluation.model_scores(pred.withColumn("prediction", F.lit(name)), f"always {name}"))
    board = rounded_frame(tables.union_rows(*boards), ["Accuracy", "Precision", "Recall", "F1"])
    return evaluation.leaderboard(board)


def vectors(spark, sf_dir) -> DataFrame:
    table = views.table(spark, sf_dir, "embeddings")
    rows = table.select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").cast("string").alias("label")
    )
    return ordering.stratified_split(rows, "label", "id")


def knn_classify(spark, sf_dir) -> DataFrame:
    rows = vectors(spark, sf_dir)
    return neighbours.knn_predict(rows.filter("not is_test"), rows.filter("is_test"))


def code(column: str) -> str:
    return f"CAST(list_position((SELECT list(DISTINCT {column} ORDER BY {column}) FROM accidents), {column}) - 1 AS DOUBLE)"


DAY_CODE = code("day_of_week")
FEATURES = f"""{o.ACCIDENTS},
feats AS (
  SELECT id, risk_level, CAST(hour AS DOUBLE) AS hour, sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos,
         {DAY_CODE} AS day_of_week_encoded, sin(2 * pi() * {DAY_CODE} / 7) AS day_sin, cos(2 * pi() * {DAY_CODE} / 7) AS day_cos,
         CAST(month AS DOUBLE) AS month, sin(2 * pi() * month / 12) AS month_sin, cos(2 * pi() * month / 12) AS month_cos,
         CAST(is_weekend AS INT)::DOUBLE AS is_weekend, CAST(is_rush_hour AS INT)::DOUBLE AS is_rush_hour,
         CAST(is_holiday AS INT)::DOUBLE AS is_holiday, latitude, longitude, {code('road_type')} AS road_type_encoded,
         CAST(speed_limit AS DOUBLE) AS speed_limit, CAST(lanes AS DOUBLE) AS lanes, base_location_risk,
         {code('weather')} AS weather_encoded, coalesce(temperature, (SELECT avg(temperature) FROM accidents)) AS temperature,
         precipitation, cloudcover, windspeed, {code('road_surface')} AS road_surface_encoded,
         CAST(traffic_density AS DOUBLE) AS traffic_density, CAST(average_speed AS DOUBLE) AS average_speed,
         time_risk_factor, weather_risk_factor, day_risk_factor
  FROM accidents
)"""
POSITIONS = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"
LONG = f"""{FEATURES},
long AS (
  SELECT id, risk_level, feature, x, list_position({POSITIONS}, feature) AS pos
  FROM (UNPIVOT feats ON COLUMNS(* EXCLUDE (id, risk_level)) INTO NAME feature VALUE x)
)"""
CORR = f"""
, corr AS (
  SELECT a.feature AS feature_a, b.feature AS feature_b, a.pos AS pos_a, b.pos AS pos_b,
         CASE WHEN stddev_pop(a.x) > 1e-9 AND stddev_pop(b.x) > 1e-9 THEN {o.rnd('corr(a.x, b.x)', 6)} END AS r
  FROM long a JOIN long b ON a.id = b.id AND a.pos < b.pos GROUP BY ALL
)"""
MI = f"""
, bounds AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM long GROUP BY feature),
binned AS (
  SELECT feature, risk_level AS label, CASE WHEN hi > lo
    THEN least(CAST(floor((x - lo) / (hi - lo) * 10 + 1e-9::DOUBLE) AS INT), 9) ELSE 0 END AS bin
  FROM long JOIN bounds USING (feature)
),
cells AS (SELECT feature, bin, label, count(*) AS n FROM binned GROUP BY ALL),
info AS (
  SELECT feature, n::DOUBLE / sum(n) OVER (PARTITION BY feature) * ln(n::DOUBLE * sum(n) OVER (PARTITION BY feature)
         / (sum(n) OVER (PARTITION BY feature, bin) * sum(n) OVER (PARTITION BY feature, label))) AS term FROM cells
),
scores AS (SELECT feature, {o.rnd('greatest(sum(term), 0.0::DOUBLE)', 6)} AS score FROM info GROUP BY feature)"""
# Row by row: the third distance among three rows of the same label on either side, and a window by distance.
MI_KNN = f"""
, bounds AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM long GROUP BY feature),
points AS (
  SELECT feature, risk_level AS label, CASE WHEN hi > lo
    THEN CAST(floor((x - lo) / (hi - lo) * 1073741824 + 0.5::DOUBLE) AS BIGINT) ELSE 0 END AS g,
         count(*) OVER (PARTITION BY feature, risk_level) AS size
  FROM long JOIN bounds USING (feature)
),
far AS (
  SELECT *, least(3, size - 1) AS k, count(*) OVER (PARTITION BY feature) AS total, count(*) OVER (PARTITION BY feature, label, g) AS n,
         list_sort(list_filter([g - lag(g, 1) OVER w, g - lag(g, 2) OVER w, g - lag(g, 3) OVER w,
             lead(g, 1) OVER w - g, lead(g, 2) OVER w - g, lead(g, 3) OVER w - g], lambda v: v IS NOT NULL))[least(3, size - 1)] AS d
  FROM points WHERE size > 1 WINDOW w AS (PARTITION BY feature, label ORDER BY g)
),
met AS (
  SELECT *, count(*) OVER (
      PARTITION BY feature ORDER BY g RANGE BETWEEN greatest(d - 1, 0) PRECEDING AND greatest(d - 1, 0) FOLLOWING) AS m
  FROM far
),
psi AS (
  SELECT i, sum(CASE WHEN i > 1 THEN 1::DOUBLE / (i - 1) ELSE 0 END) OVER (ORDER BY i) - 0.5772156649015329::DOUBLE AS v
  FROM range(1, (SELECT count(*) + 1 FROM accidents)) r(i)
),
scores AS (
  SELECT feature, {o.rnd('greatest(avg(a.v - b.v - c.v) + max(t.v), 0.0::DOUBLE)', 6)} AS score
  FROM met JOIN psi a ON a.i = CASE WHEN d = 0 THEN n - 1 ELSE k END JOIN psi b ON b.i = CASE WHEN d = 0 THEN m - 1 ELSE m END
  JOIN psi c ON c.i = size JOIN psi t ON t.i = total GROUP BY feature
)"""
ANOVA = f"""
, by_class AS (SELECT feature, risk_level, count(*) AS n, avg(x) AS m, coalesce(var_samp(x), 0) AS v FROM long GROUP BY ALL),
grand AS (SELECT feature, avg(x) AS g, max(x) > min(x) AS varies FROM long GROUP BY feature)
SELECT feature, CASE WHEN bool_and(varies) THEN {o.rnd('(sum(n * (m - g) ** 2) / (count(*) - 1))'
    ' / (sum((n - 1) * v) / (sum(n) - count(*)))', 6)} END AS score
FROM by_class JOIN grand USING (feature) GROUP BY feature"""


def rank_sql(label: str, key: str, salt: str) -> str:
    return f"row_number() OVER (PARTITION BY {label} ORDER BY {o.draw(f'CAST({key} AS VARCHAR)', salt)}, {key})"


REPORT = f"""
, cells AS (SELECT label, prediction, count(*) AS n FROM predictions GROUP BY ALL),
classes AS (SELECT label AS class FROM cells UNION SELECT prediction FROM cells),
sums AS (
  SELECT class, coalesce((SELECT sum(n) FROM cells WHERE label = class AND prediction = class), 0) AS tp,
         coalesce((SELECT sum(n) FROM cells WHERE prediction = class), 0) AS predicted,
         coalesce((SELECT sum(n) FROM cells WHERE label = class), 0) AS support FROM classes
),
rates AS (
  SELECT *, CASE WHEN predicted = 0 THEN 0.0::DOUBLE ELSE tp / predicted::DOUBLE END AS p,
         CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE tp / support::DOUBLE END AS r FROM sums
),
ratings AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0::DOUBLE ELSE 2 * p * r / (p + r) END AS f FROM rates)"""


def board_sql(name: str, prediction: str) -> str:
    """Leaderboard row of a model whose prediction is an expression over ``predictions``."""
    return f"""
SELECT '{name}' AS "Model", {o.rnd('sum(tp) / sum(support)::DOUBLE', 6)} AS "Accuracy",
       {o.rnd('sum(p * support) / sum(support)::DOUBLE', 6)} AS "Precision",
       {o.rnd('sum(r * support) / sum(support)::DOUBLE', 6)} AS "Recall",
       {o.rnd('sum(f * support) / sum(support)::DOUBLE', 6)} AS "F1"
FROM (
  SELECT *, CASE WHEN p + r = 0 THEN 0.0::DOUBLE ELSE 2 * p * r / (p + r) END AS f FROM (
    SELECT c.label, count(*) AS support, count(*) FILTER (c.label = {prediction}) AS tp,
           coalesce(count(*) FILTER (c.label = {prediction}) / nullif((SELECT count(*) FROM predictions x
               WHERE {prediction.replace('c.', 'x.')} = c.label), 0)::DOUBLE, 0.0::DOUBLE) AS p,
           count(*) FILTER (c.label = {prediction}) / count(*)::DOUBLE AS r
    FROM predictions c GROUP BY c.label)
)"""


LEADERBOARD = f"""SELECT * FROM ({board_sql('rules', 'c.prediction')})
UNION ALL SELECT * FROM ({board_sql('always High', "'High'")})
UNION ALL SELECT * FROM ({board_sql('always Low', "'Low'")})"""

KNN_SQL = f"""WITH rows AS (
  SELECT vec_id AS id, embedding, CAST(label AS VARCHAR) AS label,
         {rank_sql('label', 'vec_id', ':split:42')} <= round(0.2 * count(*) OVER (PARTITION BY label)) AS is_test
  FROM embeddings
),
pairs AS (
  SELECT t.id AS test_id, r.id AS train_id, r.label,
         list_sum(list_transform(generate_series(1, len(t.embedding)),
             lambda i: (t.embedding[i]::DOUBLE - r.embedding[i]::DOUBLE) ** 2)) AS distance
  FROM rows t JOIN rows r ON t.is_test AND NOT r.is_test
),
near AS (SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY distance, train_id) AS place FROM pairs),
votes AS (SELECT test_id, label, count(*) AS votes FROM near WHERE place <= 5 GROUP BY ALL)
SELECT test_id, label AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY votes DESC, label) AS place FROM votes
) WHERE place = 1"""

FEATURE_LIST = ", ".join(f"{o.rnd(n, 6)} AS {n}" for n in NAMES)
QUERIES = {
    "features": (feature_rows, sql(f"SELECT id, risk_level, {FEATURE_LIST} FROM feats", FEATURES)),
    "label_encode": (
        label_encode,
        sql("SELECT id, day_of_week_encoded, weather_encoded, road_type_encoded, road_surface_encoded FROM feats", FEATURES),
    ),
    "mean_impute": (
        mean_impute,
        sql(f"SELECT id, {o.rnd('temperature', 6)} AS temperature, {o.rnd('windspeed', 6)} AS windspeed FROM feats", FEATURES),
    ),
    "available_features": (existing_columns, sql("SELECT id, hour, lanes FROM accidents")),
    "corr_matrix": (corr_matrix, sql(f"{CORR} SELECT feature_a, feature_b, r FROM corr", LONG)),
    "corr_pairs": (
        corr_pairs,
        sql(f"""{CORR} SELECT feature_a, feature_b, r FROM corr WHERE abs(r) > 0.8
ORDER BY abs(r) DESC, pos_a, pos_b LIMIT 10""", LONG),
    ),
    "corr_prune": (
        corr_prune,
        sql(f"""{CORR} SELECT f.feature, NOT EXISTS (SELECT 1 FROM corr c WHERE c.feature_b = f.feature AND abs(c.r) > 0.9) AS kept
FROM (SELECT unnest({POSITIONS}) AS feature) f""", LONG),
    ),
    "vif": (vif, None),
    "high_vif": (high_vif, None),
    "anova_f": (anova_f, sql(ANOVA, LONG)),
    "mutual_info": (mutual_info, sql(f"{MI} SELECT * FROM scores", LONG)),
    "mutual_info_knn": (mutual_info_knn, sql(f"{MI_KNN} SELECT * FROM scores", LONG)),
    "top_features": (top_features, sql(f"{MI} SELECT * FROM scores ORDER BY score DESC, feature LIMIT 20", LONG)),
    "stratified_split": (
        stratified_split,
        sql(f"""SELECT id, risk_level, {rank_sql('risk_level', 'id', ':split:42')}
<= round(0.2 * count(*) OVER (PARTITION BY risk_level)) AS is_test FROM accidents"""),
    ),
    "folds": (
        folds, sql(f"SELECT id, risk_level, ({rank_sql('risk_level', 'id', ':fold:42')} - 1) % 5 AS fold FROM accidents"),
    ),
    "confusion_matrix": (
        confusion_matrix,
        sql("""SELECT label, count(*) FILTER (prediction = 'High') AS "High", count(*) FILTER (prediction = 'Low') AS "Low",
count(*) FILTER (prediction = 'Medium') AS "Medium",
count(*) FILTER (prediction IS NULL OR prediction NOT IN ('High', 'Low', 'Medium')) AS other FROM predictions GROUP BY label""", o.PREDICTIONS),
    ),
    "class_report": (
        class_report,
        sql(f"""{REPORT}
SELECT class, {o.rnd('p', 6)} AS precision, {o.rnd('r', 6)} AS recall, {o.rnd('f', 6)} AS f1, support FROM ratings
UNION ALL SELECT 'accuracy', {o.rnd('sum(tp) / sum(support)::DOUBLE', 6)}, {o.rnd('sum(tp) / sum(support)::DOUBLE', 6)},
  {o.rnd('sum(tp) / sum(support)::DOUBLE', 6)}, sum(support) FROM ratings
UNION ALL SELECT 'macro avg', {o.rnd('avg(p)', 6)}, {o.rnd('avg(r)', 6)}, {o.rnd('avg(f)', 6)}, sum(support) FROM ratings
UNION ALL SELECT 'weighted avg', {o.rnd('sum(p * support) / sum(support)::DOUBLE', 6)},
  {o.rnd('sum(r * support) / sum(support)::DOUBLE', 6)}, {o.rnd('sum(f * support) / sum(support)::DOUBLE', 6)}, sum(support)
  FROM ratings""", o.PREDICTIONS),
    ),
    "cv_summary": (
        cv_summary,
        sql(f"""
, folded AS (SELECT *, ({rank_sql('label', 'id', ':fold:42')} - 1) % 5 AS fold FROM predictions),
scores AS (SELECT fold, avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy FROM folded GROUP BY fold)
SELECT {o.rnd('avg(accuracy)', 6)} AS cv_mean, {o.rnd('stddev_pop(accuracy)', 6)} AS cv_std FROM scores""", o.PREDICTIONS),
    ),
    "leaderboard": (leaderboard, sql(LEADERBOARD, o.PREDICTIONS)),
    "knn_classify": (knn_classify, KNN_SQL),
}
