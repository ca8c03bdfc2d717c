"""The staged and the module run: the same steps as the programme's, each with its own matrix, scaler, names, offers and cuts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import features, kmeans, labels, models, offers, retention, segments
from tidemark.plans.pipeline import clean_inputs
from tidemark.plans.training import ID, Trainer
from tidemark.session import cut_lineage
from tidemark.settings import Settings
from tidemark.sources.columns import feature_columns, preferred_columns


@dataclass(frozen=True)
class Variant:
    matrix: Callable[[DataFrame, DataFrame, Settings], DataFrame]
    clustered: Sequence[str]
    least_columns: int
    ks: Sequence[int]
    names: Callable[[DataFrame], DataFrame]
    staged_archetypes: bool
    recommend: Callable[[DataFrame], DataFrame]
    at_risk: Sequence[str]


def _trailing(members: DataFrame, activity: DataFrame, settings: Settings) -> DataFrame:
    """Members seen by the day, with the label of the record window."""
    labelled = labels.record_window_labels(members, activity, settings.prediction_date)
    return cut_lineage(features.trailing_matrix(labelled, activity, settings.prediction_date))


def _module_profiles(profiles: DataFrame) -> DataFrame:
    """The module's rules read plain means."""
    return profiles.select("segment_id", *[F.col(c).alias(c.removeprefix("avg_")) for c in profiles.columns if c.startswith("avg_")])


VARIANTS = {
    "staged": Variant(
        features.record_matrix, segments.STAGED_FEATURES, 8, range(3, 9),
        lambda p: segments.unique_names(segments.staged_rules(p)), True, retention.staged_recommendations,
        ("High Risk", "Medium Risk"),
    ),
    "module": Variant(
        _trailing, segments.MODULE_FEATURES, 3, range(3, 8),
        lambda p: segments.unique_names(segments.module_rules(_module_profiles(p)), list(offers.ARCHETYPES), "Segment"),
        False, retention.module_recommendations, ("high", "medium"),
    ),
}


@dataclass
class VariantRun:
    features: DataFrame
    segments: DataFrame
    recommendations: DataFrame
    priorities: DataFrame
    comparison: DataFrame
    k_table: DataFrame
    fitted: dict[str, PipelineModel]
    best: str


def run(
    members: DataFrame, activity: DataFrame, variant: str, settings: Settings | None = None,
    model_settings: models.ModelSettings | None = None, order_by: str | None = None,
    ks: Sequence[int] | None = None, restarts: int = 10,
) -> VariantRun:
    """`variant` is `staged` (features over all records, standard scaling, names by relative rank, the 8 x 3 library) or `module`
    (trailing features, names by rank and threshold, the 7 x 3 library). Learners train on synthetic rows; the best by AUC scores."""
    v = VARIANTS[variant]
    settings = settings or Settings()
    model_settings = model_settings or models.ModelSettings(seed=settings.seed)
    members, activity = clean_inputs(members, activity, order_by)
    table = v.matrix(members, activity, settings)

    chosen = preferred_columns(table, v.clustered, models.NOT_FEATURES | {"activity_churn_6m", "activity_churn_12m"}, v.least_columns)
    vector = segments.point(table, chosen, standard=True)[0]
    vectors = segments.assemble(table, chosen, vector)
    tried = kmeans.try_k(vectors, ks or v.ks, restarts, settings.seed)
    placed = table.withColumn("segment_id", kmeans.nearest(vector, kmeans.best_k(tried).centres))
    names = cut_lineage(v.names(segments.segment_profiles(placed, chosen, "churn")))
    profiles = segments.attach_archetypes(segments.put_names(
        segments.segment_profiles(placed, chosen, "churn"), names
    ), v.staged_archetypes)

    columns = feature_columns(table, models.NOT_FEATURES | {"activity_churn_6m", "activity_churn_12m"})
    trainer = Trainer(
        table, model_settings, settings.seed, settings.test_share, "churn", models.SYNTHETIC, columns
    )
    fitted = trainer.fit_all((models.LOGISTIC, models.FOREST, models.BOOSTED))
    rows = [models.comparison_row(n, cut_lineage(trainer.scored_test(m))) for n, m in fitted.items()]
    best = models.choose_model(rows, pinned=None)
    scored = models.score(fitted[best], segments.put_names(placed, names), columns)
    recommended = cut_lineage(v.recommend(scored))
    urgent = recommended.where(F.lower("risk_level").isin([r.lower() for r in v.at_risk]))
    return VariantRun(
        features=table, segments=profiles, recommendations=recommended,
        priorities=urgent.orderBy(F.desc("priority_score"), ID),
        comparison=models.comparison_table(table, rows), k_table=kmeans.elbow_table(tried, vectors), fitted=fitted, best=best,
    )
