"""The whole run: clean, label, build features, cluster, train, score, assign offers, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import cleaning, features, kmeans, models, reports, retention, segments
from tidemark.plans.training import ID, Trainer
from tidemark.session import cut_lineage
from tidemark.settings import Settings
from tidemark.sources import files
from tidemark.sources.columns import normalise_headers


@dataclass
class Run:
    """Tables and models of one run; the large tables are already written."""

    labels: DataFrame
    features: DataFrame
    scored: DataFrame
    actions: DataFrame
    k_table: DataFrame
    comparison: DataFrame
    importance: DataFrame
    summary: DataFrame
    fitted: dict[str, PipelineModel]
    production: str


def clean_inputs(
    members: DataFrame, activity: DataFrame, order_by: str | None
) -> tuple[DataFrame, DataFrame]:
    """Normalised headers, one row per member, and one activity row per member and month (the first by
    `order_by`, or by all columns in turn)."""
    tidy_members, tidy_activity = normalise_headers(members), normalise_headers(activity)
    return (
        cleaning.keep_first(tidy_members, [ID]),
        cleaning.keep_first(tidy_activity, [ID, "year", "month"], order_by),
    )


def segment(table: DataFrame, ks: Sequence[int], restarts: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The table with `segment_id` and `segment_name`, and the table of tried k. The segment is an expression over the
    member's own row, so nothing is joined but the names."""
    chosen = segments.PROGRAMME_FEATURES
    vector, _ = segments.point(table, chosen)
    vectors = segments.assemble(table, chosen, vector)
    tried = kmeans.try_k(vectors, ks, restarts, seed)
    placed = table.withColumn("segment_id", kmeans.nearest(vector, kmeans.best_k(tried).centres))
    names = cut_lineage(segments.names_by_rank(segments.programme_profiles(placed)))
    return segments.put_names(placed, names), kmeans.elbow_table(tried, vectors)


def run(
    members: DataFrame, activity: DataFrame, settings: Settings | None = None,
    model_settings: models.ModelSettings | None = None, order_by: str | None = None,
    ks: Sequence[int] = range(4, 9), restarts: int = 10, folds: int = 5, out: str | None = None,
    balancing: str = models.SYNTHETIC,
) -> Run:
    """The programme's run. The published logistic and forest models learn on synthetic rows, the boosted one on weights."""
    settings = settings or Settings()
    model_settings = model_settings or models.ModelSettings(seed=settings.seed)
    members, activity = clean_inputs(members, activity, order_by)

    table = features.labelled_matrix(members, activity, settings)
    named, k_table = segment(table, ks, restarts, settings.seed)

    trainer = Trainer(table, model_settings, settings.seed, settings.test_share, balancing=balancing)
    names = (models.LOGISTIC, models.FOREST, models.BOOSTED)
    fitted = trainer.fit_all(names)
    rows = [models.comparison_row(n, cut_lineage(trainer.scored_test(m))) for n, m in fitted.items()]
    validated = {n: trainer.cross_validate(n, folds) for n in (models.LOGISTIC, models.BOOSTED)} if folds else {}
    production = models.choose_model(rows)

    whole = models.score(fitted[production], named, models.PROGRAMME_FEATURES)
    scored = cut_lineage(retention.programme_actions(retention.score_revenue(whole, settings)))
    by_model = {r[0]: r for r in rows}
    summary = reports.summary_document(scored, {
        "best_model_auc": F.lit(max(r[1] for r in rows)),
        "production_auc": F.lit(by_model[production][1]),
        "production_recall": F.lit(by_model[production][2]),
        "production_precision": F.lit(by_model[production][3]),
        "cv_scores": F.array(*[
            F.struct(F.lit(n).alias("model"), F.lit(m).alias("auc"), F.lit(s).alias("deviation"))
            for n, (m, s) in validated.items()
        ]),
        "analysis_date": F.current_timestamp(),
    })
    result = Run(
        labels=scored.select(ID, "hard_churn", "activity_churn", "churned"),
        features=table, scored=scored, actions=retention.action_list(scored), k_table=k_table,
        comparison=models.comparison_table(table, rows),
        importance=models.importance_table(fitted[models.BOOSTED], table, models.PROGRAMME_FEATURES),
        summary=summary, fitted=fitted, production=production,
    )
    if out is not None:
        write(result, out)
    return result


def write(result: Run, out: str) -> None:
    """Tables as parquet, hand-over lists as CSV, the summary as JSON, models as ML folders."""
    files.write_parquet(result.features, f"{out}/features")
    files.write_parquet(result.scored, f"{out}/segments")
    for name in ("labels", "actions", "comparison", "importance", "k_table"):
        files.write_csv(getattr(result, name), f"{out}/{name}")
    files.write_json(result.summary, f"{out}/summary")
    for name, model in result.fitted.items():
        model.write().overwrite().save(f"{out}/models/{name.lower().replace(' ', '_')}")
