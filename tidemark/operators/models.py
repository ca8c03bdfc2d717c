"""Churn models on MLlib: split, balance, fit, cross-validate, score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import attach
from tidemark.functions.ranks import quantile_row, quantiles
from tidemark.functions.stats import moments
from tidemark.operators import balance
from tidemark.operators.draws import uniform
from tidemark.operators.evaluation import evaluate
from tidemark.operators.offers import literal_table
from tidemark.session import cut_lineage

# The published training columns
PROGRAMME_FEATURES = [
    "recency_months", "active_month_ratio", "avg_flights_per_month", "redemption_rate", "clv_log",
    "tenure_months", "active_months", "q4_flights", "total_distance", "momentum_h2_minus_h1",
    "flight_consistency", "total_points_accumulated", "salary", "salary_missing",
    "engagement_health_score", "points_balance", "tier_numeric", "education_numeric", "is_female",
    "is_married", "is_promo_enrollment", "dollar_cost_per_flight", "is_early_member",
    "is_recent_member", "is_ontario", "is_bc", "is_quebec",
]

# Ids, labels and text, which never train a model; the partial labels would leak the target
NOT_FEATURES = {
    "loyalty_number", "loyalty_card", "churn", "churned", "hard_churn", "activity_churn",
    "label_year_flights", "country", "province", "city", "postal_code", "gender", "education",
    "marital_status", "enrollment_type", "enrollment_year", "enrollment_month",
    "cancellation_year", "cancellation_month", "last_activity_date", "segment", "segment_id",
    "segment_name",
}

LOGISTIC, FOREST, BOOSTED = "Logistic Regression", "Random Forest", "Boosted Trees"


@dataclass(frozen=True)
class ModelSettings:
    """Sizes of the three learners; defaults are the programme's."""

    inverse_penalty: float = 0.1
    forest_trees: int = 200
    forest_depth: int = 10
    forest_min_leaf: int = 5
    boosted_trees: int = 300
    boosted_depth: int = 6
    step: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    max_iter: int = 1000
    seed: int = 42
    # boosting ends when these training rows gain less than `validation_gain` by another round; 0: all rounds
    validation_share: float = 0.1
    validation_gain: float = 0.001


# --- split ------------------------------------------------------------------------------------------


def _strata_cuts(df: DataFrame, label: str, id_column: str, seed: int, shares: Sequence[float]) -> DataFrame:
    """Per label value, the quantiles of the uniform number at `shares`: a share s has exactly
    floor((n - 1) x s) + 1 of the n rows at or under its cut."""
    drawn = df.select(label, uniform(id_column, seed).alias("_u"))
    names = {f"_cut_{i}": ("_u", share) for i, share in enumerate(shares)}
    cuts = quantiles(drawn, names, [label])
    return cuts.select(F.col(label).alias("_stratum"), F.array(*names).alias("_cuts"))


def stratified_split(
    df: DataFrame, label: str, id_column: str = "loyalty_number", test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add `is_test`: the same share of each class to the row, without sorting a class."""
    cuts = _strata_cuts(df, label, id_column, seed, [test_share])
    joined = df.join(cuts, F.col(label) == F.col("_stratum"))
    inside = uniform(id_column, seed) <= F.col("_cuts")[0]
    return joined.withColumn("is_test", inside.cast("int")).drop("_stratum", "_cuts")


def stratified_folds(
    df: DataFrame, label: str, id_column: str = "loyalty_number", folds: int = 5, seed: int = 42
) -> DataFrame:
    """Add `fold` 0..folds-1 with the classes spread evenly."""
    shares = [i / folds for i in range(1, folds)]
    cuts = _strata_cuts(df, label, id_column, seed + 1, shares)
    joined = df.join(cuts, F.col(label) == F.col("_stratum"))
    u = uniform(id_column, seed + 1)
    number = F.size(F.filter("_cuts", lambda c: c < u))
    return joined.withColumn("fold", number.cast("int")).drop("_stratum", "_cuts")


# --- balance ----------------------------------------------------------------------------------------


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """One row: members per class and the balanced and positive weights."""
    n, pos = F.count(F.lit(1)), F.count_if(F.col(label) == 1)
    counts = df.agg(n.alias("members"), pos.alias("positives"))
    negatives = F.col("members") - F.col("positives")
    return counts.withColumn("negatives", negatives).withColumns({
        "weight_negative": F.try_divide(F.col("members").cast("double"), 2.0 * F.col("negatives")),
        "weight_positive": F.try_divide(F.col("members").cast("double"), 2.0 * F.col("positives")),
        "scale_positive": F.col("negatives") / F.greatest(F.col("positives"), F.lit(1)),
    })


def with_class_weight(df: DataFrame, label: str, kind: str = "balanced", name: str = "weight") -> DataFrame:
    """`balanced`: n / (2 n_class); `positive`: negatives / positives for churners, 1 for the rest."""
    counts = class_counts(df, label).select("weight_negative", "weight_positive", "scale_positive")
    churned = F.col(label) == 1
    if kind == "balanced":
        weight = F.when(churned, F.col("weight_positive")).otherwise(F.col("weight_negative"))
    else:
        weight = F.when(churned, F.col("scale_positive")).otherwise(1.0)
    return attach(df, counts).withColumn(name, weight).drop(*counts.columns)


# --- preparation ------------------------------------------------------------------------------------


def fit_preparation(train: DataFrame, features: Sequence[str], standardise: bool = True) -> PipelineModel:
    """Median imputation and population scaling with the training table's numbers.

    The statistics are one row; they go into a SQL stage, so the preparation is saved and loaded
    with the model and runs inside the scoring query's own projection.
    """
    found = quantile_row(train, {c: (c, 0.5) for c in features}).first()
    medians = {c: float(found[c] or 0.0) for c in features}  # 0 for a column without any value
    filled = train.select(*[F.coalesce(F.col(c).cast("double"), F.lit(medians[c])).alias(c) for c in features])
    stats = moments(filled, features).first()

    def prepared(c: str) -> str:
        value = f"coalesce(cast(`{c}` as double), {medians[c]!r}D)"
        if not standardise:
            return f"{value} AS `x_{c}`"
        mean, std = float(stats[f"{c}__mean"]), float(stats[f"{c}__std"])
        return f"({value} - {mean!r}D) / {std if std > 0 else 1.0!r}D AS `x_{c}`"

    statement = f"SELECT *, {', '.join(prepared(c) for c in features)} FROM __THIS__"
    stages = [
        SQLTransformer(statement=statement),
        VectorAssembler(inputCols=[f"x_{c}" for c in features], outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(train)


# --- learners ---------------------------------------------------------------------------------------


def logistic(train_rows: int, settings: ModelSettings) -> LogisticRegression:
    """The penalty is on the mean loss here and on the summed loss in the published setting."""
    return LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight", maxIter=settings.max_iter,
        regParam=1.0 / (settings.inverse_penalty * train_rows), elasticNetParam=0.0, standardization=False,
    )


def forest(settings: ModelSettings) -> RandomForestClassifier:
    """`cacheNodeIds` keeps each row's node per tree from one level to the next, so that a level does not walk down from the roots."""
    return RandomForestClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", numTrees=settings.forest_trees,
        maxDepth=settings.forest_depth, minInstancesPerNode=settings.forest_min_leaf,
        featureSubsetStrategy="sqrt", seed=settings.seed, cacheNodeIds=True,
    )


def boosted(settings: ModelSettings) -> GBTClassifier:
    """`checkpointInterval` cuts the residual lineage through the session's checkpoint folder. The rows marked `validation`
    say when a further round no longer helps."""
    learner = GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", maxIter=settings.boosted_trees,
        maxDepth=settings.boosted_depth, stepSize=settings.step, subsamplingRate=settings.row_share,
        featureSubsetStrategy=str(settings.column_share), seed=settings.seed, checkpointInterval=10,
        validationTol=settings.validation_gain,
    )
    return learner.setValidationIndicatorCol("validation") if settings.validation_share > 0 else learner


def probability(df: DataFrame, name: str = "probability") -> DataFrame:
    """The churn probability as a number in place of the model's vector columns."""
    churn = vector_to_array("probability")[1]
    kept = [c for c in df.columns if c not in ("probability", "rawPrediction", "prediction", "features")]
    return df.select(*kept, churn.alias(name))


SYNTHETIC, WEIGHTS = "synthetic", "weights"
# rows per task of an iterative fit: under the first, tasks cost more than they share out; under the second, as many tasks as cores,
# since each task of a forest's pass sends the counts of all nodes
ROWS_PER_TASK, MOST_ROWS_PER_TASK = 10_000, 400_000


def learning_table(
    prepared: PipelineModel, train: DataFrame, features: Sequence[str], settings: ModelSettings, balancing: str = WEIGHTS,
    id_column: str = "loyalty_number",
) -> DataFrame:
    """What the learners read: id, `features`, `label`, `weight`, `validation`, `synthetic`, over the rows of `train`.

    `weights` keeps the rows and their class weights. `synthetic` adds rows between a member of the smaller class and
    its neighbours, among these training rows alone, and all rows weigh the same. Only real rows validate.
    """
    ready = prepared.transform(train)
    scaled = [f"x_{c}" for c in features]
    if balancing == SYNTHETIC:
        table = cut_lineage(ready.select(id_column, "label", *scaled))
        whole = balance.oversample(table, scaled, seed=settings.seed).withColumn("weight", F.lit(1.0))
    else:
        whole = ready.select(id_column, "label", *scaled, "weight").withColumn("synthetic", F.lit(0))
    held = (uniform(id_column, settings.seed + 2) < settings.validation_share) & (F.col("synthetic") == 0)
    vector = array_to_vector(F.array(*[F.col(c) for c in scaled]))
    return whole.select(id_column, vector.alias("features"), "label", "weight", held.alias("validation"), "synthetic")


def tasks_for(rows: int, cores: int) -> int:
    """As many as the rows need, up to the cluster's cores; more only where a task would hold too many rows."""
    return max(min(rows // ROWS_PER_TASK + 1, cores), -(-rows // MOST_ROWS_PER_TASK))


def gathered(table: DataFrame) -> DataFrame:
    """The staged table in as many partitions as its rows and the cluster ask for, whatever files it lies in: the many short jobs of a fit
    over few rows are mostly the cost of their tasks, and a fit over many rows is to use every core."""
    held = cut_lineage(table)
    tasks = tasks_for(held.count(), held.sparkSession.sparkContext.defaultParallelism)
    return held.coalesce(1) if tasks == 1 else held.repartition(tasks)


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over the cluster's cores: a forest takes far longer to score a row than to move it, and the row groups of
    a staged table are few and uneven."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def fit(learner, prepared: PipelineModel, table: DataFrame) -> PipelineModel:
    """The preparation and the learner, fitted on a learning table, as one saveable model."""
    return PipelineModel(stages=[*prepared.stages, learner.fit(table)])


def cross_validate(
    learner, prepared: PipelineModel, train: DataFrame, features: Sequence[str], settings: ModelSettings, folds: int = 5,
    balancing: str = WEIGHTS,
) -> tuple[float, float]:
    """Mean and deviation of the AUC over stratified folds. All folds are masks over one staged table and are fitted together.
    Synthetic rows are made inside each fold's training part, so none is a neighbour of its own test row, and the test
    rows are the members as they are."""
    folded = cut_lineage(stratified_folds(train, "label", folds=folds, seed=settings.seed))
    judge = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    whole = None
    if balancing == WEIGHTS:
        marks = folded.select("loyalty_number", "fold")
        whole = gathered(learning_table(prepared, folded, features, settings).join(marks, "loyalty_number"))

    def one(k: int) -> float:
        if whole is not None:
            table, test = whole.where(F.col("fold") != k), whole.where(F.col("fold") == k)
        else:
            table = gathered(learning_table(prepared, folded.where(F.col("fold") != k), features, settings, balancing))
            test = prepared.transform(folded.where(F.col("fold") == k))
        return float(judge.evaluate(learner.copy().fit(table).transform(test)))

    with ThreadPool(folds) as pool:
        found = pool.map(one, range(folds), chunksize=1)
    return float(np.mean(found)), float(np.std(found))


def logistic_gradient(model: PipelineModel, table: DataFrame, features: Sequence[str]) -> DataFrame:
    """`feature, gradient` of the penalised loss at the fitted weights, one aggregate over the learning table; all are 0 at the
    optimum. The row `intercept` has no penalty."""
    fitted = model.stages[-1]
    weights, penalty = [float(w) for w in fitted.coefficients], fitted.getRegParam()
    x = vector_to_array("features")
    margin = sum((x[i] * w for i, w in enumerate(weights)), F.lit(float(fitted.intercept)))
    pull = F.col("weight") * (1 / (1 + F.exp(-margin)) - F.col("label"))
    mass = F.sum("weight")
    wide = table.agg(
        *[(F.sum(pull * x[i]) / mass + F.lit(penalty * w)).alias(c) for i, (c, w) in enumerate(zip(features, weights))],
        (F.sum(pull) / mass).alias("intercept"),
    )
    return wide.unpivot([], [*features, "intercept"], "feature", "gradient")


def score(model: PipelineModel, df: DataFrame, features: Sequence[str], name: str = "churn_probability") -> DataFrame:
    """Probability for every member, over the training columns; a missing column counts as 0."""
    missing = {c: F.lit(0.0) for c in features if c not in df.columns}
    out = model.transform(df.withColumns(missing) if missing else df)
    scored = probability(out, name)
    return scored.drop(*[f"x_{c}" for c in features], *missing)


# --- tables -----------------------------------------------------------------------------------------


def comparison_row(name: str, scored_test: DataFrame) -> tuple:
    """(model, auc, recall, precision, f1, accuracy) of one scored test table."""
    m = evaluate(scored_test).first()
    return (name, *[round(float(m[c]), 4) for c in ("roc_auc", "recall", "precision", "f1", "accuracy")])


COMPARISON_SCHEMA = (
    "model string, auc double, recall double, precision double, f1 double, accuracy double"
)


def comparison_table(df: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    return literal_table(df.sparkSession, list(rows), COMPARISON_SCHEMA).orderBy(F.desc("auc"), "model")


def choose_model(rows: Sequence[tuple], pinned: str | None = BOOSTED) -> str:
    """The pinned production model, or the one with the best AUC."""
    return pinned or max(rows, key=lambda r: r[1])[0]


def importance_table(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """`feature, importance`, largest first. A row per feature."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(w)) for f, w in zip(features, weights)]
    table = literal_table(df.sparkSession, rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def training_table(features: DataFrame, label: str, columns: Sequence[str], id_column: str = "loyalty_number") -> DataFrame:
    """Id, label and the training columns as doubles."""
    return features.select(
        id_column, F.col(label).cast("double").alias("label"),
        *[F.col(c).cast("double").alias(c) for c in columns],
    )


def split_parts(split: DataFrame) -> Mapping[str, DataFrame]:
    return {
        "train": split.where("is_test = 0").drop("is_test"),
        "test": split.where("is_test = 1").drop("is_test"),
    }
