import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import balance, evaluation, kmeans, models, segments, trees
from tidemark.plans import pipeline, variants
from tidemark.plans.bed import Bed
from tidemark.plans.training import Trainer
from tidemark.session import cut_lineage

QUICK = models.ModelSettings(forest_trees=8, forest_depth=4, boosted_trees=5, boosted_depth=3, max_iter=50)


def planted(spark, n=1200):
    """Label 1 for about a quarter, with one telling and one useless feature."""
    df = spark.range(n).toDF("loyalty_number")
    noise = F.pmod(F.xxhash64("loyalty_number", F.lit(5)), F.lit(1000)) / 1000.0
    other = F.pmod(F.xxhash64("loyalty_number", F.lit(6)), F.lit(1000)) / 1000.0
    return df.select(
        "loyalty_number", (F.col("loyalty_number") % 4 == 0).cast("double").alias("label"),
        (noise + F.when(F.col("loyalty_number") % 4 == 0, 0.6).otherwise(0.0)).alias("telling"),
        F.when(F.col("loyalty_number") % 10 != 0, other).alias("useless"),
    )


FEATURES = ["telling", "useless"]


def test_split_and_folds_are_even_and_repeatable(spark):
    df = planted(spark)
    split = models.stratified_split(df.repartition(5), "label")
    sizes = {(r["label"], r["is_test"]): r["n"] for r in split.groupBy("label", "is_test").agg(F.count("*").alias("n")).collect()}
    assert sizes == {(0.0, 0): 720, (0.0, 1): 180, (1.0, 0): 240, (1.0, 1): 60}
    again = models.stratified_split(df.repartition(2), "label")
    ids = [{r[0] for r in s.where("is_test = 1").select("loyalty_number").collect()} for s in (split, again)]
    assert ids[0] == ids[1]
    folds = models.stratified_folds(df, "label").groupBy("label", "fold").count().collect()
    assert len(folds) == 10 and {r["count"] for r in folds} == {180, 60}


def test_weights(spark):
    df = planted(spark, 400)
    balanced = models.with_class_weight(df, "label").groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert [r["w"] for r in balanced] == pytest.approx([200.0, 200.0])
    positive = models.with_class_weight(df, "label", "positive").where("label = 1").first()["weight"]
    assert positive == 3.0


def test_models_find_the_signal_and_survive_saving(spark, tmp_path):
    split = models.stratified_split(planted(spark), "label")
    parts = models.split_parts(split)
    train = models.with_class_weight(parts["train"], "label").cache()
    prepared = models.fit_preparation(train, FEATURES)
    for learner in (models.logistic(train.count(), QUICK), models.forest(QUICK), models.boosted(QUICK)):
        model = models.fit(learner, prepared, models.learning_table(prepared, train, FEATURES, QUICK))
        scored = models.score(model, parts["test"], FEATURES, "probability")
        auc = evaluation.roc_auc(scored).first()["roc_auc"]
        assert auc > 0.75
        judge = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="probability", numBins=0)
        assert auc == pytest.approx(judge.evaluate(scored), abs=1e-6)
    ranked = models.importance_table(model, train, FEATURES).collect()
    assert ranked[0]["feature"] == "telling" and sum(r["importance"] for r in ranked) == pytest.approx(1.0)
    path = str(tmp_path / "model")
    model.write().save(path)
    loaded = models.score(PipelineModel.load(path), parts["test"], FEATURES, "probability")
    assert sorted(map(tuple, loaded.collect())) == sorted(map(tuple, scored.collect()))
    for balancing in (models.WEIGHTS, models.SYNTHETIC):
        learner = models.logistic(960, QUICK)
        mean, deviation = models.cross_validate(learner, prepared, train, FEATURES, QUICK, folds=3, balancing=balancing)
        assert mean > 0.75 and deviation < 0.2


def trained(spark, balancing=models.WEIGHTS, settings=QUICK):
    features = planted(spark).withColumnRenamed("label", "churned")
    return Trainer(features, settings, columns=FEATURES, balancing=balancing)


def test_tree_table_gives_the_scores_and_importances(spark):
    t = trained(spark)
    for name, depth in ((models.FOREST, QUICK.forest_depth), (models.BOOSTED, QUICK.boosted_depth)):
        model = t.fit(name)
        nodes = trees.tree_table(spark, model.stages[-1], FEATURES)
        leaves = nodes.where("feature IS NULL").agg(F.count(F.lit(1)), F.count("left"), F.count("threshold")).first()
        assert leaves[0] > 0 and leaves[1:] == (0, 0)
        ready = t.prepared.transform(t.test).withColumn("x", vector_to_array("features"))
        walked = {r[0]: r[1] for r in trees.walk(ready, nodes, "x", ["loyalty_number"], depth).select(
            "loyalty_number", trees.probability(F.col("total"), name == models.BOOSTED)).collect()}
        for r in t.scored_test(model).collect():
            assert walked[r["loyalty_number"]] == pytest.approx(r["probability"], abs=1e-12)
        own = {r["feature"]: r["importance"] for r in trees.importances(nodes, name == models.FOREST).collect()}
        for f, v in zip(FEATURES, model.stages[-1].featureImportances.toArray()):
            assert own.get(f, 0.0) == pytest.approx(v, abs=1e-12)


def test_members_are_scored_from_the_staged_table_on_every_core(spark):
    t = trained(spark)
    model = t.fit(models.FOREST)
    scored = t.scored_members(model)
    assert set(scored.inputFiles()) == set(t.members.inputFiles()) != set()
    cores = spark.sparkContext.defaultParallelism
    for rows in (scored, t.scored_test(model)):
        sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) == cores and max(sizes) - min(sizes) <= cores
    whole = models.score(model, planted(spark), FEATURES)
    pair = ["loyalty_number", "churn_probability"]
    assert sorted(map(tuple, scored.select(pair).collect())) == sorted(map(tuple, whole.select(pair).collect()))


def stumps(spark, count: int):
    """Trees that send x[0] <= 1 to a leaf of 1, and else ask for x[1] <= 5: leaves of 2 and 4."""
    rows = []
    for t in range(count):
        rows += [(t, 0, 0, 1.0, 1, 2, 0.0), (t, 1, None, None, None, None, 1.0), (t, 2, 1, 5.0, 3, 4, 0.0),
                 (t, 3, None, None, None, None, 2.0), (t, 4, None, None, None, None, 4.0)]
    schema = "tree int, node int, position int, threshold double, left int, right int, value double"
    return spark.createDataFrame(rows[::-1], schema).withColumn("weight", F.lit(0.5))


def test_a_walk_takes_each_side_and_stops_at_leaves(spark):
    rows = [(1, [1.0, 9.0]), (2, [1.5, 5.0]), (3, [1.5, 5.5]), (4, [float("nan"), 0.0]), (5, [0.0, None]), (6, [2.0, None]), (7, None)]
    df = spark.createDataFrame(rows, "id long, x array<double>")
    found = {r["id"]: r["total"] for r in trees.walk(df, stumps(spark, 3), "x", ["id"], 4).collect()}
    assert found == {1: 1.5, 2: 3.0, 3: 6.0, 4: 3.0, 5: 1.5, 6: 6.0, 7: 6.0}
    assert trees.walk(df.where("id < 0"), stumps(spark, 3), "x", ["id"], 4).collect() == []


def test_a_walk_makes_no_row_per_tree(spark):
    df = spark.range(50).selectExpr("id", "array(double(id), 0D) AS x")
    plan = trees.walk(df, stumps(spark, 3), "x", ["id"], 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_many_tasks_can_read_what_one_task_staged(spark):
    staged = cut_lineage(spark.range(6_000_000).select("id", F.rand(1).alias("x"), F.rand(2).alias("y")).coalesce(1))
    sizes = [r["count"] for r in staged.select("id", F.spark_partition_id().alias("p")).groupBy("p").count().collect()]
    assert len(sizes) > 4 and sum(sizes) == 6_000_000


def test_a_fit_uses_the_cores_whatever_files_its_table_lies_in(spark):
    assert [models.tasks_for(n, 12) for n in (0, 9_999, 72_000, 720_000, 4_320_000, 48_000_000)] == [1, 1, 8, 12, 12, 120]
    one_file = spark.range(30_000).coalesce(1)
    assert models.gathered(one_file).rdd.getNumPartitions() == 4
    assert models.gathered(one_file.limit(500)).rdd.getNumPartitions() == 1
    assert models.forest(QUICK).getCacheNodeIds()


def test_the_gradient_shows_the_optimum(spark):
    t = trained(spark)
    model = t.fit(models.LOGISTIC)
    at_best = models.logistic_gradient(model, t.weighted, FEATURES).collect()
    assert {r["feature"] for r in at_best} == {*FEATURES, "intercept"} and all(abs(r["gradient"]) < 1e-4 for r in at_best)
    early = models.fit(models.logistic(960, models.ModelSettings(max_iter=1)), t.prepared, t.weighted)
    assert any(abs(r["gradient"]) > 1e-4 for r in models.logistic_gradient(early, t.weighted, FEATURES).collect())


def test_synthetic_rows_come_from_the_training_part_alone(spark):
    t = trained(spark, models.SYNTHETIC)
    sizes = {(r["label"], r["synthetic"]): r["count"] for r in t.balanced.groupBy("label", "synthetic").count().collect()}
    assert sizes == {(0.0, 0): 720, (1.0, 0): 240, (1.0, 1): 480}
    assert t.balanced.where("synthetic = 1 AND validation").count() == 0
    held = {r[0] for r in t.test.select("loyalty_number").collect()}
    assert not held & {r[0] for r in t.balanced.select("loyalty_number").collect()}
    assert t.table(models.BOOSTED) is t.weighted and t.table(models.FOREST) is t.balanced
    for name in (models.LOGISTIC, models.BOOSTED):
        assert evaluation.roc_auc(t.scored_test(t.fit(name))).first()["roc_auc"] > 0.75
        mean, _ = t.cross_validate(name, 3)
        assert mean > 0.75


def test_boosting_ends_when_rounds_no_longer_help(spark):
    long = models.ModelSettings(boosted_trees=40, boosted_depth=3, step=0.5)
    rounds = trained(spark, settings=long).fit(models.BOOSTED).stages[-1].getNumTrees
    whole = trained(spark, settings=models.ModelSettings(boosted_trees=12, boosted_depth=2, validation_share=0.0))
    assert 1 <= rounds < 40 and whole.fit(models.BOOSTED).stages[-1].getNumTrees == 12


def test_the_larger_class_may_churn(spark):
    df = planted(spark, 410).fillna(0.5).withColumn("label", 1 - F.col("label"))
    sizes = {(r["label"], r["synthetic"]): r["count"] for r in balance.oversample(df, FEATURES).groupBy("label", "synthetic").count().collect()}
    assert sizes == {(1.0, 0): 307, (0.0, 0): 103, (0.0, 1): 204}


def test_metrics_with_no_predicted_churn(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    row = evaluation.classification_metrics(df).first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "label int, probability double")
    assert evaluation.roc_auc(df).first()["roc_auc"] == 0.875
    curve = evaluation.roc_curve(df).orderBy("threshold").collect()
    assert [(r["tpr"], r["fpr"]) for r in curve] == [(1.0, 1.0), (1.0, 0.5), (0.5, 0.0)]


def points(spark, rows):
    return spark.createDataFrame(rows, "id long, x array<double>")


def test_line_neighbours_are_near(spark):
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=4).tolist()) for i in range(200)]
    got = {r["id"]: r["near"] for r in balance.line_neighbours(points(spark, rows).repartition(4), 5).collect()}
    matrix = np.array([x for _, x in rows])
    mine = nearest = 0.0
    for i, x in rows:
        gaps = ((matrix - np.array(x)) ** 2).sum(1)
        gaps[i] = np.inf
        nearest += sum(sorted(gaps)[:5])
        mine += sum(float(((np.array(n) - np.array(x)) ** 2).sum()) for n in got[i])
    assert nearest <= mine <= 1.1 * nearest


@pytest.mark.parametrize("per_range", [100_000, 60])
def test_line_neighbours_serve_every_point(spark, monkeypatch, per_range):
    monkeypatch.setattr(balance, "ROWS_PER_RANGE", per_range)
    draw = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else draw.normal(size=3).tolist()) for i in range(400)]
    got = {r["id"]: r["near"] for r in balance.line_neighbours(points(spark, rows), 5).collect()}
    assert len(got) == 400 and {len(n) for n in got.values()} == {5}
    assert all(n == [1.0, 2.0, 3.0] for n in got[0])


def test_neighbours_across_a_range_border(spark, monkeypatch):
    rows = [(i, [float(i)]) for i in range(300)]
    monkeypatch.setattr(balance, "ROWS_PER_RANGE", 30)
    got = {r["id"]: sorted(x[0] for x in r["near"]) for r in balance.line_neighbours(points(spark, rows), 4).collect()}
    assert all(got[i] == [i - 2.0, i - 1.0, i + 1.0, i + 2.0] for i in range(2, 298))


def test_oversampling_balances_exactly(spark):
    df = planted(spark, 410).fillna(0.5)
    out = balance.oversample(df, FEATURES).cache()
    sizes = {(r["label"], r["synthetic"]): r["count"] for r in out.groupBy("label", "synthetic").count().collect()}
    assert sizes == {(0.0, 0): 307, (1.0, 0): 103, (1.0, 1): 204}
    bounds = df.where("label = 1").agg(F.min("telling"), F.max("telling")).first()
    made = out.where("synthetic = 1").agg(F.min("telling"), F.max("telling")).first()
    assert bounds[0] <= made[0] and made[1] <= bounds[1]


def test_a_feature_without_any_value(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    rows = models.fit_preparation(df, ["a", "b"]).transform(df).collect()
    assert len(rows) == 2


def test_clusters_of_planted_groups(spark):
    rows = [(i, float(i % 4) * 10 + (i % 7) * 0.01, float(i % 4 == 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "loyalty_number long, a double, b double")
    vectors = segments.assemble(df, ["a", "b"])
    tried = kmeans.try_k(vectors, [2, 4], restarts=3)
    assert kmeans.best_k(tried).k == 4
    assert tried[0].inertia > tried[1].inertia
    found = vectors.withColumn("id", kmeans.nearest(F.col("vector"), tried[1].centres)).groupBy("id").count()
    assert sorted(r["count"] for r in found.collect()) == [50, 50, 50, 50]
    projected, explained = segments.principal_components(df, ["a", "b"], ["loyalty_number"])
    assert projected.count() == 200 and sum(explained) == pytest.approx(1.0)


def test_kmeans_against_the_library(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [float(v) for v in draw.normal(size=3) + 3 * (i % 5)]) for i in range(600)] + [(900, [0.0, 0.0, 0.0])] * 40
    df = spark.createDataFrame(rows, "loyalty_number long, vector array<double>")
    tried = kmeans.try_k(df, [3, 5], restarts=4)
    for c in tried:
        vectors = df.select(array_to_vector("vector").alias("features"))
        library = min(KMeans(k=c.k, seed=s).fit(vectors).summary.trainingCost for s in range(4))
        assert c.inertia <= library * 1.02
        placed = df.select(array_to_vector("vector").alias("features"), kmeans.nearest(F.col("vector"), c.centres).alias("prediction"))
        assert c.silhouette == pytest.approx(ClusteringEvaluator().evaluate(placed), abs=1e-9)


def test_kmeans_with_more_centres_than_points(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0],), ([4.0, 2.0],)], "vector array<double>")
    tried = kmeans.try_k(df, [2, 4], restarts=2)
    assert [round(c.inertia, 9) for c in tried] == [0.0, 0.0]
    with pytest.raises(ValueError):
        kmeans.try_k(df.limit(0), [2])


def test_components_have_a_fixed_sign(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(300, 3)) @ np.array([[2.0, 0.3, 0.1], [0.0, 1.0, 0.2], [0.0, 0.0, 0.4]])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "loyalty_number long, a double, b double, c double")
    projected, explained = segments.principal_components(df, ["a", "b", "c"], ["loyalty_number"])
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    for i in (0, 1):
        v = vectors[:, 2 - i] * np.sign(vectors[np.abs(vectors[:, 2 - i]).argmax(), 2 - i])
        want = (x - x.mean(axis=0)) @ v
        got = [r[f"pc{i + 1}"] for r in projected.orderBy("loyalty_number").collect()]
        assert np.allclose(got, want) and explained[i] == pytest.approx(values[2 - i] / values.sum())


def test_whole_run(spark, tmp_path):
    bed = Bed(spark, "/root/testdata/sf0.001")
    result = pipeline.run(
        bed.members, bed.activity_raw, bed.settings, QUICK, order_by="record_id", ks=[4, 5], restarts=1,
        folds=2, out=str(tmp_path),
    )
    assert len(result.summary.first()["cv_scores"]) == 2
    members = bed.members.count()
    assert result.scored.count() == result.labels.count() == members
    assert result.scored.where("action IS NULL").count() == 0
    at_risk = result.scored.where(F.col("risk_level").isin("High", "Medium")).count()
    assert result.actions.count() == at_risk
    assert result.summary.first()["members"] == members
    assert spark.read.parquet(f"{tmp_path}/segments").count() == members
    assert {r["model"] for r in result.comparison.collect()} == {models.LOGISTIC, models.FOREST, models.BOOSTED}


@pytest.mark.parametrize("variant", ["staged", "module"])
def test_staged_and_module_runs(spark, variant):
    bed = Bed(spark, "/root/testdata/sf0.001")
    result = variants.run(bed.members, bed.activity_raw, variant, bed.settings, QUICK, "record_id", ks=[3, 4], restarts=1)
    found = result.recommendations
    rows = result.features.count()
    assert found.count() == rows and found.select("loyalty_number").distinct().count() == rows
    assert rows == (bed.members.count() if variant == "staged" else bed.activity.where("year <= 2000").select("loyalty_number").distinct().count())
    names = [r["segment_name"] for r in result.segments.collect()]
    assert len(set(names)) == len(names) in (3, 4) and result.segments.where("strategy IS NULL").count() == 0
    offer = "recommended_offer" if variant == "staged" else "offer"
    assert found.where(f"{offer} IS NULL OR priority_score IS NULL").count() == 0
    bands = {r[0] for r in result.priorities.select("risk_level").distinct().collect()}
    assert bands <= ({"High Risk", "Medium Risk"} if variant == "staged" else {"high", "medium"})
    assert result.best in {r["model"] for r in result.comparison.collect()}
