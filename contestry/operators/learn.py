"""Probability models on the feature table, by Spark ML."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestry.operators import fits
from contestry.operators.evaluate import TRIPLE, normalised
from contestry.operators.form import MEASURES
from contestry.sources.store import cleaned, stored

SIDE = [*MEASURES, "points_l5", "gd_l5"]
#: The 25 features in order.
FEATURES = [
    *[f"{s}_{c}" for s in ("home", "away") for c in SIDE],
    "home_home_win_rate_l5", "away_away_win_rate_l5", "h2h_home_win_rate_n", "h2h_draw_rate_n", "home_elo", "away_elo",
    "elo_abs_diff", "ppg_diff_l5", "gf_diff_l5", "ga_diff_l5", "recent_total_goals_avg_l5",
]
MODELS = ("logreg", "logreg_balanced", "random_forest", "boosted")


def fill_head_to_head(df: DataFrame) -> DataFrame:
    return df.fillna(0.5, ["h2h_home_win_rate_n", "h2h_draw_rate_n"])


def impute(train: DataFrame, *frames: DataFrame) -> list[DataFrame]:
    """Missing features take the training rows' exact median; a feature without values takes 0.

    An exact median gathers a feature's distinct values, which for ratings are as many as rows: it is taken only of features
    that some frame lacks somewhere.
    """
    every = reduce(DataFrame.unionByName, [f.select(*FEATURES) for f in frames])
    lacking = every.agg(*[F.bool_or(F.col(c).isNull() | F.isnan(c)).alias(c) for c in FEATURES]).first()
    wanted = [c for c in FEATURES if lacking[c]]
    if not wanted:
        return list(frames)
    medians = train.agg(*[F.coalesce(F.median(c), F.lit(0.0)).alias(c) for c in wanted]).first().asDict()
    return [f.fillna(medians) for f in frames]


def balanced(train: DataFrame) -> DataFrame:
    """Weight n / (classes x n of the class)."""
    counts = train.groupBy("result_code").agg(F.count("*").alias("n_class"))
    n, k = counts.agg(F.sum("n_class"), F.count("*")).first()
    return train.join(F.broadcast(counts), "result_code").withColumn("weight", F.lit(float(n)) / (k * F.col("n_class")))  # three rows


def _inputs(scaled: bool) -> list:
    raw = VectorAssembler(inputCols=FEATURES, outputCol="raw" if scaled else "x")
    return [raw, StandardScaler(withMean=True, withStd=True, inputCol="raw", outputCol="x")] if scaled else [raw]


def classifier(name: str, n: int):
    common = {"featuresCol": "x", "labelCol": "result_code", "weightCol": "weight"}
    if name == "random_forest":
        return RandomForestClassifier(numTrees=100, maxDepth=3, seed=42, **common)
    return LogisticRegression(family="multinomial", regParam=1.0 / n, elasticNetParam=0.0, standardization=False, maxIter=1000, **common)


def fit_predict(name: str, train: DataFrame, rows: DataFrame) -> DataFrame:
    """rows with p_away, p_draw and p_home of a model fitted on train (features and result_code)."""
    train, rows = impute(fill_head_to_head(train), fill_head_to_head(train), fill_head_to_head(rows))
    train = balanced(train) if name in ("logreg_balanced", "random_forest") else train.withColumn("weight", F.lit(1.0))
    train = stored(train, "train")  # read by every iteration of the solvers
    if name == "boosted":
        return _boosted(train, rows)
    model = Pipeline(stages=[*_inputs(name.startswith("logreg")), classifier(name, max(train.count(), 1))]).fit(train)
    scored = model.transform(rows).withColumn("p_", vector_to_array("probability"))
    out = scored.withColumns({t: F.get("p_", F.lit(i)) for i, t in enumerate(TRIPLE)})
    return normalised(out).drop("p_", "raw", "x", "rawPrediction", "probability", "prediction")


def _boosted(train: DataFrame, rows: DataFrame) -> DataFrame:
    """One-against-rest boosted trees: 50 rounds of depth 2 for each class.

    The classes are fitted side by side: a round's jobs are short and follow from each other, and those of one class run
    where another's leave cores idle.
    """
    def fit(code: int):
        own = train.withColumn("is_class", (F.col("result_code") == code).cast("double"))
        gbt = GBTClassifier(maxIter=50, maxDepth=2, stepSize=0.1, seed=42, featuresCol="x", labelCol="is_class", weightCol="weight")
        return Pipeline(stages=[*_inputs(False), gbt]).fit(own)

    with ThreadPool(len(TRIPLE)) as pool:
        models = pool.map(inheritable_thread_target(train.sparkSession)(fit), range(len(TRIPLE)))
    out = rows
    for model, t in zip(models, TRIPLE):
        out = model.transform(out).withColumn(t, F.get(vector_to_array("probability"), F.lit(1))).drop("x", "rawPrediction", "probability", "prediction")
    return normalised(out)


#: What is fitted for each group, and how its rows are scored.
ALGORITHMS = {
    "logistic_regression": (lambda blocks, keys: fits.logistic(blocks, keys, len(FEATURES), False), fits.logistic_triples),
    "logistic_regression_balanced": (lambda blocks, keys: fits.logistic(blocks, keys, len(FEATURES), True), fits.logistic_triples),
    "random_forest": (lambda blocks, keys: fits.forest(blocks, keys, len(FEATURES)), fits.forest_triples()),
    "xgboost": (lambda blocks, keys: fits.boosted(blocks, keys, len(FEATURES)), fits.boosted_triples),
}


def walk_forward(rows: DataFrame, keys: list[str], algorithms: tuple[str, ...] = tuple(ALGORITHMS)) -> DataFrame:
    """model, keys, match_id, result_code and triples of every row that isn't for training, by each algorithm fitted on its group's training rows.

    rows: keys (fold, competition), role, match_id, result_code and FEATURES. All groups are fitted in the same
    jobs; fits.unfitted tells why a group has no rows.
    """
    filled = stored(fill_head_to_head(rows).select(*keys, "role", "match_id", "result_code", *FEATURES), "rows")
    found = fits.statistics(filled, keys, FEATURES)
    blocks = stored(fits.packed(fits.applied(filled, found, keys, FEATURES), keys), "blocks")
    # side by side: a step's jobs are short and follow from each other
    with cleaned(rows.sparkSession), ThreadPool(len(algorithms)) as pool:
        models = pool.map(inheritable_thread_target(rows.sparkSession)(lambda a: ALGORITHMS[a][0](blocks, keys)), algorithms)
    scored = [fits.predicted(blocks, model, keys, ALGORITHMS[a][1]).withColumn("model", F.lit(a)) for a, model in zip(algorithms, models)]
    return reduce(DataFrame.unionByName, scored)


# Models that are kept: a row for each run and group.

KEPT = ["algorithm", "middle", "mean", "scale", "edges", "counts", "weights", "pending"]


def trained(rows: DataFrame, keys: list[str], algorithm: str) -> DataFrame:
    """keys and KEPT: what has to be stored of each group's model to score rows later on."""
    training = stored(fill_head_to_head(rows).withColumn("role", F.lit("train")), "training")
    found = stored(fits.statistics(training, keys, FEATURES), "statistics")
    blocks = stored(fits.packed(fits.applied(training, found, keys, FEATURES), keys), "blocks")
    models = ALGORITHMS[algorithm][0](blocks, keys)
    return found.drop("n", "counts").join(models.drop("change"), keys).select(*keys, F.lit(algorithm).alias("algorithm"), *KEPT[1:])


def score(rows: DataFrame, models: DataFrame, keys: list[str], algorithm: str) -> DataFrame:
    """keys, match_id and triple of rows (keys, match_id, FEATURES) by the stored models of one algorithm."""
    own = models.where(F.col("algorithm") == algorithm)
    given = fill_head_to_head(rows).withColumns({"role": F.lit("upcoming"), "result_code": F.lit(None).cast("int")})
    sized = own.select(*keys, "middle", "mean", "scale", "edges", "counts").join(rows.groupBy(*keys).agg(F.count("*").alias("n")), keys)
    blocks = stored(fits.packed(fits.applied(given, sized, keys, FEATURES), keys), "blocks")
    return fits.predicted(blocks, own.select(*keys, "weights", "pending", "counts"), keys, ALGORITHMS[algorithm][1]).drop("result_code")
