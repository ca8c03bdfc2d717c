"""Registered queries whose result comes from a fitted model, a file round trip or a random draw.
They have no SQL twin; tests check their properties."""

from __future__ import annotations

import uuid
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import stats
from tidemark.operators import balance, kmeans, models, offers, reports, retention, segments, trees
from tidemark.plans import training
from tidemark.plans.bed import Bed, tidy
from tidemark.plans.queries import ID, query
from tidemark.session import cut_lineage, ensure_checkpoint_dir
from tidemark.sources import files, schemas

# the published sizes; queries over one folder share their fits within a session
_TRAINERS: dict[tuple, training.Trainer] = {}
_TRIED: dict[tuple, tuple] = {}


def _shared(b: Bed, made: dict, make):
    key = (b.spark.sparkContext.applicationId, b.folder, b.settings.seed)
    if key not in made:
        made[key] = make()
    return made[key]


def trainer(b: Bed) -> training.Trainer:
    return _shared(b, _TRAINERS, lambda: training.Trainer(
        b.features, models.ModelSettings(seed=b.settings.seed), b.settings.seed, b.settings.test_share, keep=["clv"]
    ))


def _scratch(b: Bed) -> str:
    return f"{ensure_checkpoint_dir(b.spark)}/{uuid.uuid4().hex}"


# --- files ------------------------------------------------------------------------------------------


@query
def csv_roundtrip(b: Bed) -> DataFrame:
    path = _scratch(b)
    kept = b.activity.select(*[f.name for f in schemas.ACTIVITY.fields])
    files.write_csv(kept, path)
    return tidy(files.read_csv(b.spark, path, schemas.ACTIVITY))


@query
def source_fallback(b: Bed) -> DataFrame:
    base = _scratch(b)
    files.write_parquet(b.members, f"{base}/features")
    found = files.read_first_existing(b.spark, [f"{base}/segmented", f"{base}/features"])
    none = files.read_optional(b.spark, f"{base}/dictionary", schemas.CALENDAR)
    return tidy(found.crossJoin(F.broadcast(none.agg(F.count(F.lit(1)).alias("missing_rows")))))


@query
def json_roundtrip(b: Bed) -> DataFrame:
    path = _scratch(b)
    document = reports.segment_revenue(b.scored)
    files.write_json(document, path)
    return tidy(files.read_json(b.spark, path, document.schema))


@query
def model_roundtrip(b: Bed) -> DataFrame:
    t = trainer(b)
    path = _scratch(b)
    t.fit(models.LOGISTIC).write().overwrite().save(path)
    return tidy(t.scored_test(PipelineModel.load(path)))


# --- segments ---------------------------------------------------------------------------------------


@query
def kmeans_segments(b: Bed) -> DataFrame:
    vector, _ = segments.point(b.features, segments.PROGRAMME_FEATURES)
    vectors = segments.assemble(b.features, segments.PROGRAMME_FEATURES, vector)
    centres = kmeans.fit(vectors, [4], seed=b.settings.seed)[4]
    placed = b.features.withColumn("segment_id", kmeans.nearest(vector, centres))
    names = segments.names_by_rank(segments.programme_profiles(placed))
    return tidy(segments.put_names(placed, names), ID, "segment_id", "segment_name")


def _tried(b: Bed) -> tuple[list, DataFrame]:
    def make() -> tuple[list, DataFrame]:
        vector, _ = segments.point(b.features, segments.PROGRAMME_FEATURES)
        vectors = segments.assemble(b.features, segments.PROGRAMME_FEATURES, vector)
        return kmeans.try_k(vectors, range(4, 9), seed=b.settings.seed), vectors

    return _shared(b, _TRIED, make)


@query
def k_selection(b: Bed) -> DataFrame:
    tried, vectors = _tried(b)
    return kmeans.elbow_table([kmeans.best_k(tried)], vectors)


@query
def elbow_table(b: Bed) -> DataFrame:
    tried, vectors = _tried(b)
    return kmeans.elbow_table(tried, vectors)


@query
def cluster_optimality(b: Bed) -> DataFrame:
    """Per k, whether the reported fit is one: every cluster has members and its centre is their mean, the inertia is the sum of the squared
    distances to the nearest centre, no larger k costs more, and the silhouette lies in its range."""
    tried, vectors = _tried(b)
    out = None
    for before, c in zip([None, *tried], tried):
        gap = F.array_min(F.array(*kmeans.gaps(F.col("vector"), c.centres)))
        at = kmeans.nearest(F.col("vector"), c.centres)
        placed = vectors.select("vector", gap.alias("gap"), at.alias("id"))
        means = placed.groupBy("id").agg(
            F.count(F.lit(1)).alias("n"), F.sum("gap").alias("cost"),
            *[F.avg(F.col("vector")[j]).alias(f"x{j}") for j in range(c.centres.shape[1])],
        )
        centre = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in c.centres])[F.col("id")]
        off = F.array_max(F.array(*[F.abs(F.col(f"x{j}") - centre[j]) for j in range(c.centres.shape[1])]))
        falls = before is None or c.inertia <= before.inertia * 1.0001
        row = means.agg(
            F.lit(c.k).alias("k"), F.sum("n").alias("members"), F.count(F.lit(1)).alias("clusters"),
            (F.max(off) < 0.02).cast("int").alias("centres_are_means"),
            (F.abs(F.sum("cost") - c.inertia) < 1e-6 * c.inertia).cast("int").alias("inertia_agrees"),
            F.lit(int(falls)).alias("inertia_falls"), F.lit(int(-1 <= c.silhouette <= 1)).alias("silhouette_fits"),
        )
        out = row if out is None else out.unionByName(row)
    return tidy(out)


@query
def pca_projection(b: Bed) -> DataFrame:
    chosen = segments.PROGRAMME_FEATURES
    scaled = cut_lineage(stats.standard_scale(b.features.select(ID, *chosen), chosen))
    projected, explained = segments.principal_components(scaled, chosen, [ID])
    return tidy(projected.withColumns({f"explained_{i + 1}": F.lit(v) for i, v in enumerate(explained)}))


# --- models -----------------------------------------------------------------------------------------


@query
def stratified_split(b: Bed) -> DataFrame:
    split = models.stratified_split(cut_lineage(b.labels.select(ID, "churned")), "churned")
    return tidy(split.groupBy("churned").agg(
        F.count(F.lit(1)).alias("members"), F.sum("is_test").alias("test_members")
    ))


@query
def stratified_folds(b: Bed) -> DataFrame:
    folded = models.stratified_folds(cut_lineage(b.labels.select(ID, "churned")), "churned")
    return tidy(folded.groupBy("churned", "fold").agg(F.count(F.lit(1)).alias("members")))


@query
def smote_balance(b: Bed) -> DataFrame:
    chosen = segments.PROGRAMME_FEATURES
    scaled = cut_lineage(stats.minmax_scale(
        b.features.select(ID, F.col("churned").cast("double").alias("label"), *chosen), chosen
    ))
    whole = balance.oversample(scaled, chosen, seed=b.settings.seed)
    return tidy(whole.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("members")))


@query
def logistic_scores(b: Bed) -> DataFrame:
    t = trainer(b)
    return tidy(t.scored_test(t.fit(models.LOGISTIC)))


@query
def forest_scores(b: Bed) -> DataFrame:
    t = trainer(b)
    return tidy(t.scored_test(t.fit(models.FOREST)))


@query
def boosted_scores(b: Bed) -> DataFrame:
    t = trainer(b)
    return tidy(t.scored_test(t.fit(models.BOOSTED)))


@query
def cv_auc(b: Bed) -> DataFrame:
    t = trainer(b)
    rows = [(name, *t.cross_validate(name)) for name in (models.LOGISTIC, models.BOOSTED)]
    return offers.literal_table(b.spark, rows, "model string, cv_auc_mean double, cv_auc_std double")


@query
def smote_training_counts(b: Bed) -> DataFrame:
    """What the synthetic balancing trains on: the training part, and each fold's training part."""
    t = trainer(b)
    folded = cut_lineage(models.stratified_folds(t.train, "label", folds=5, seed=t.settings.seed))
    parts = {"train": t.train, **{f"fold {k}": folded.where(F.col("fold") != k) for k in range(5)}}
    prepared = t.prepared

    def counts(named: tuple[str, DataFrame]) -> DataFrame:
        table = models.learning_table(prepared, named[1], t.columns, t.settings, models.SYNTHETIC)
        return table.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("members")).withColumn("part", F.lit(named[0]))

    # the parts are independent, so their jobs are submitted together
    with ThreadPool(len(parts)) as pool:
        rows = pool.map(counts, parts.items(), chunksize=1)
    return tidy(reduce(DataFrame.unionByName, rows))


def _walked(t: training.Trainer, name: str, df: DataFrame, keep: list[str]) -> DataFrame:
    """`keep...` and the probability read off the model's tree table."""
    model = t.fit(name).stages[-1]
    nodes = cut_lineage(trees.tree_table(df.sparkSession, model, t.columns))
    ready = t.prepared.transform(df).withColumn("x", vector_to_array("features"))
    depth = t.settings.forest_depth if name == models.FOREST else t.settings.boosted_depth
    total = trees.walk(ready, nodes, "x", keep, depth)
    return total.withColumn("walked", trees.probability(F.col("total"), name == models.BOOSTED)).drop("total")


@query
def tree_table_scores(b: Bed) -> DataFrame:
    """Per ensemble, how many members get another probability from the exported tree table than from the model."""
    t = trainer(b)
    t.fit_all([models.FOREST, models.BOOSTED])
    out = None
    for name in (models.FOREST, models.BOOSTED):
        scored = t.scored_members(t.fit(name)).select(ID, "churn_probability")
        both = scored.join(_walked(t, name, t.members, [ID]), ID, "left")
        p = F.col("churn_probability")
        row = both.agg(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("members"),
            F.count_if(F.abs(p - F.col("walked")).isNull() | (F.abs(p - F.col("walked")) > 1e-9)).alias("differing"),
            F.count_if((p < 0) | (p > 1)).alias("out_of_range"),
            F.count_if((p >= 0.5) != (F.col("walked") >= 0.5)).alias("at_risk_differing"),
        )
        out = row if out is None else out.unionByName(row)
    return tidy(out)


@query
def tree_table_importance(b: Bed) -> DataFrame:
    """Per ensemble and feature, whether the gains in the tree table give the model's importance."""
    t = trainer(b)
    out = None
    for name in (models.FOREST, models.BOOSTED):
        model = t.fit(name)
        own = trees.importances(trees.tree_table(b.spark, model.stages[-1], t.columns), per_tree=name == models.FOREST)
        listed = models.importance_table(model, t.train, t.columns).withColumnRenamed("importance", "listed")
        same = F.abs(F.col("listed") - F.coalesce("importance", F.lit(0.0))) < 1e-9
        row = listed.join(own, "feature", "left").select(F.lit(name).alias("model"), "feature", same.cast("int").alias("agrees"))
        out = row if out is None else out.unionByName(row)
    return tidy(out)


@query
def tree_table_predictions(b: Bed) -> DataFrame:
    """Test rows per class, and those whose class or risk band differs between the tree table and the model."""
    t = trainer(b)
    scored = t.scored_test(t.fit(models.FOREST))
    both = scored.join(_walked(t, models.FOREST, t.test, [ID]), ID, "left")

    def band(p: str) -> Column:
        return retention.risk_level(F.col(p), retention.STAGED_CUTS, retention.STAGED_BANDS)

    return tidy(both.groupBy(F.col("label").cast("int").alias("churned")).agg(
        F.count(F.lit(1)).alias("test_members"),
        F.count_if((F.col("probability") >= 0.5) != (F.col("walked") >= 0.5)).alias("class_differs"),
        F.count_if(~band("probability").eqNullSafe(band("walked"))).alias("band_differs"),
    ))


@query
def logistic_optimality(b: Bed) -> DataFrame:
    """Whether each derivative of the penalised loss is 0 at the fitted weights."""
    t = trainer(b)
    found = models.logistic_gradient(t.fit(models.LOGISTIC), t.table(models.LOGISTIC), t.columns)
    return tidy(found.select("feature", (F.abs("gradient") < 1e-4).cast("int").alias("is_zero")))


@query
def saved_model_scores(b: Bed) -> DataFrame:
    """Test rows per class whose probability changes when a model is saved and loaded."""
    t = trainer(b)
    path = _scratch(b)
    t.fit(models.LOGISTIC).write().overwrite().save(path)
    before = t.scored_test(t.fit(models.LOGISTIC))
    after = t.scored_test(PipelineModel.load(path)).select(ID, F.col("probability").alias("loaded"))
    return tidy(before.join(after, ID, "left").groupBy(F.col("label").cast("int").alias("churned")).agg(
        F.count(F.lit(1)).alias("test_members"),
        F.count_if(~F.col("probability").eqNullSafe(F.col("loaded"))).alias("changed"),
    ))


@query
def model_comparison(b: Bed) -> DataFrame:
    t = trainer(b)
    names = (models.LOGISTIC, models.FOREST, models.BOOSTED)
    fitted = t.fit_all(names)
    rows = [models.comparison_row(n, cut_lineage(t.scored_test(m))) for n, m in fitted.items()]
    chosen = models.choose_model(rows, pinned=None)
    return models.comparison_table(t.train, rows).withColumn("chosen", F.col("model") == chosen)


@query
def feature_importance(b: Bed) -> DataFrame:
    t = trainer(b)
    return models.importance_table(t.fit(models.BOOSTED), t.train, models.PROGRAMME_FEATURES)


@query
def score_members(b: Bed) -> DataFrame:
    t = trainer(b)
    return tidy(t.scored_members(t.fit(models.FOREST)), ID, "churn_probability")


@query
def test_predictions(b: Bed) -> DataFrame:
    t = trainer(b)
    scored = t.scored_test(t.fit(models.FOREST))
    return tidy(scored.withColumns({
        "predicted": (F.col("probability") >= 0.5).cast("int"),
        "risk_level": retention.risk_level(F.col("probability"), retention.STAGED_CUTS, retention.STAGED_BANDS),
    }))


@query
def at_risk_members(b: Bed) -> DataFrame:
    t = trainer(b)
    scored = t.scored_members(t.fit(models.FOREST))
    return tidy(scored.where(F.col("churn_probability") >= 0.5), ID, "clv", "churn_probability")
