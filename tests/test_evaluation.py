import random
import threading

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from levyscan.operators import boosting, evaluation, forest, models
from levyscan.sources.staging import new_path, stage

SCHEMA = "model_name string, label int, prediction int, probability double"


def table(spark, rows, name="m"):
    return spark.createDataFrame([(name, y, int(p >= 0.5), p) for y, p in rows], SCHEMA)


def plain_auc(rows):
    pos = [p for y, p in rows if y]
    neg = [p for y, p in rows if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_ties_for_two_models(spark):
    draw = random.Random(5)
    a = [(int(draw.random() < 0.3), round(draw.random(), 1)) for _ in range(400)]
    b = [(y, round(min(1.0, p * 0.5 + y * 0.4), 2)) for y, p in a]
    both = table(spark, a, "a").union(table(spark, b, "b"))
    got = {r.model_name: r.roc_auc for r in evaluation.roc_auc(both).collect()}
    assert got["a"] == pytest.approx(plain_auc(a), abs=1e-12)
    assert got["b"] == pytest.approx(plain_auc(b), abs=1e-12)
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="label", numBins=0).evaluate(
        table(spark, a).withColumn("label", F.col("label").cast("double"))
    )
    assert got["a"] == pytest.approx(spark_auc, abs=1e-9)


def test_auc_extremes(spark):
    perfect = table(spark, [(1, 0.9), (1, 0.8), (0, 0.2)])
    assert evaluation.roc_auc(perfect).first().roc_auc == 1.0
    single = table(spark, [(0, 0.9), (0, 0.1)])
    assert evaluation.roc_auc(single).first().roc_auc == 0.0


def test_metrics_without_positives_are_zero(spark):
    got = evaluation.quality_metrics(table(spark, [(0, 0.1), (0, 0.2)])).first()
    assert (got.accuracy, got.precision, got.recall, got.f1) == (1.0, 0.0, 0.0, 0.0)


def test_roc_points_run_from_origin_to_corner(spark):
    rows = evaluation.roc_points(table(spark, [(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)])).collect()
    curve = sorted((r.FPR, r.TPR) for r in rows if r.Model == "m")
    assert curve == [(0.0, 0.0), (0.0, 0.5), (0.5, 1.0), (1.0, 1.0)]
    assert sorted((r.FPR, r.TPR) for r in rows if r.Model == "Random Baseline") == [(0.0, 0.0), (1.0, 1.0)]


@pytest.fixture(scope="module")
def split_features(silver):
    return stage(models.with_split(models.feature_matrix(silver)), "features")


def test_exact_split_keeps_class_shares(inputs):
    labels = inputs.raw.ground_truth.select("po_id", "is_anomalous")
    rows = models.with_exact_split(labels).groupBy("is_anomalous").agg(
        F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")
    )
    for r in rows.collect():
        assert abs(r.t - 0.2 * r.n) <= 0.5


def test_class_weights_balance(split_features):
    sums = models.with_class_weight(split_features).groupBy("is_anomalous").agg(F.sum("weight").alias("w")).collect()
    assert len(sums) == 2
    assert sums[0].w == pytest.approx(sums[1].w)


def test_forest_trains_saves_and_scores_alike(spark, split_features):
    model = models.train_forest(split_features.filter("not is_test"), trees=5, depth=4)
    test = split_features.filter("is_test")
    before = models.score_forest(model, test)
    again = models.load_model(models.save_model(model, new_path(spark, "model")))
    assert before.exceptAll(models.score_forest(again, test)).isEmpty()
    assert before.filter("probability < 0 or probability > 1").isEmpty()
    weights = models.feature_importance(model, "Random Forest").collect()
    assert len(weights) == 18
    assert sum(r.importance_score for r in weights) == pytest.approx(1.0)


def test_boosted_trees_use_their_threshold(split_features):
    model = models.train_boosted(split_features.filter("not is_test"), rounds=2)
    scored = models.score_boosted(model, split_features.filter("is_test"))
    assert scored.filter((F.col("probability") >= 0.35) != (F.col("prediction") == 1)).isEmpty()
    tiers = models.prediction_table(scored, "xgb", with_tier=True)
    assert tiers.columns == ["po_id", "actual", "xgb_prediction", "xgb_probability", "model_name", "risk_tier"]


def test_forest_rows_keep_their_nodes(split_features):
    model = models.train_forest(split_features.filter("not is_test"), trees=2, depth=2, trees_per_group=1)
    assert [stage.getCacheNodeIds() for stage in model.stages[1:]] == [True, True]


def test_queries_fit_only_the_models_they_ask_for(inputs, monkeypatch):
    from levyscan.checks import catalog_cases

    fitted = []
    trainers = {name: lambda train, name=name: fitted.append(name) or name for name in ("forest", "boosted")}
    monkeypatch.setattr(catalog_cases, "_TRAINERS", trainers, raising=False)
    monkeypatch.setattr(catalog_cases, "_fits", {})
    assert catalog_cases._fit_once(inputs, "forest")[1:] == ("forest",)
    assert catalog_cases._fit_once(inputs, "forest", "boosted")[1:] == ("forest", "boosted")
    assert fitted == ["forest", "boosted"]


def test_models_are_fitted_on_all_training_rows(inputs, split_features, monkeypatch):
    from levyscan.checks import catalog_cases

    counted = {}
    trainers = {name: lambda train, name=name: counted.update({name: train.count()}) for name in ("forest", "boosted")}
    monkeypatch.setattr(catalog_cases, "_TRAINERS", trainers)
    monkeypatch.setattr(catalog_cases, "_fits", {})
    monkeypatch.setattr(catalog_cases, "MAX_TRAINING_ROWS", 100, raising=False)
    catalog_cases._fit_once(inputs, "forest", "boosted")
    rows = split_features.filter("not is_test").count()
    assert rows > 100 and counted == {"forest": rows, "boosted": rows}


@pytest.fixture(scope="module")
def few_valued(spark):
    draw = random.Random(9)
    rows = [[draw.randrange(k) * 1.5 for k in (2, 3, 7, 12, 20)] for _ in range(600)]
    labelled = [(Vectors.dense(r), int(r[2] + r[4] > 18 or draw.random() < 0.1)) for r in rows]
    rows = spark.createDataFrame(labelled, ["features", "is_anomalous"])
    return stage(rows.withColumn("is_anomalous", F.col("is_anomalous").cast("int")), "few")


@pytest.mark.parametrize("depth", [1, 3, 4])
def test_boosted_trees_without_draws_are_those_of_spark(few_valued, depth, monkeypatch):
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", 200)
    monkeypatch.setattr(boosting, "ROUNDS_KEPT", 2)
    own = boosting.fit_boosted(few_valued, 5, depth, 0.3, 1.0, 1.0, 1)
    sparks = GBTClassifier(labelCol="is_anomalous", maxIter=5, maxDepth=depth, stepSize=0.3).fit(few_valued.coalesce(1))
    for column in ("probability", "rawPrediction"):
        both = sparks.transform(few_valued).select("features", models.positive_probability(F.col(column)).alias("theirs"))
        both = own.transform(both).select("theirs", models.positive_probability(F.col(column)).alias("ours"))
        assert both.agg(F.max(F.abs(F.col("theirs") - F.col("ours")))).first()[0] < 1e-9
    assert sum(own.featureImportances) == pytest.approx(1.0)
    assert list(own.treeWeights) == list(sparks.treeWeights)


def test_boosted_trees_of_one_feature_are_those_of_spark(spark):
    rows = [(Vectors.dense([float(i % 16)]), int(i % 16 in (3, 4, 9, 14) or i % 7 == 0)) for i in range(300)]
    one = stage(spark.createDataFrame(rows, ["features", "is_anomalous"]).withColumn("is_anomalous", F.col("is_anomalous").cast("int")), "one")
    own = boosting.fit_boosted(one, 2, 4, 0.3, 1.0, 1.0, 1)
    sparks = GBTClassifier(labelCol="is_anomalous", maxIter=2, maxDepth=4, stepSize=0.3).fit(one.coalesce(1))
    theirs = sparks.transform(one).select("features", models.positive_probability(F.col("probability")).alias("theirs"))
    both = own.transform(theirs).select("theirs", models.positive_probability(F.col("probability")).alias("ours"))
    assert both.agg(F.max(F.abs(F.col("theirs") - F.col("ours")))).first()[0] < 1e-9


def test_boosted_round_costs_a_job_for_two_levels(spark, few_valued):
    def jobs_of(rounds):
        group = f"boosted-{rounds}"
        spark.sparkContext.setJobGroup(group, "count the jobs")
        models.train_boosted(few_valued.select("is_anomalous", F.expr("hash(features) % 5").alias("x")), ["x"], rounds=rounds)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    try:
        assert jobs_of(12) - jobs_of(2) <= 2 * 10 + 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_boosted_trees_save_and_load_and_draw_alike(spark, split_features):
    train = split_features.filter("not is_test")
    model = models.train_boosted(train, rounds=3)
    scored = models.score_boosted(model, split_features)
    again = models.load_model(models.save_model(model, new_path(spark, "model")))
    assert scored.exceptAll(models.score_boosted(again, split_features)).isEmpty()
    assert models.tree_count(again) == 3
    assert scored.exceptAll(models.score_boosted(models.train_boosted(train, rounds=3), split_features)).isEmpty()


def test_stages_of_a_model_are_saved_and_loaded_side_by_side(spark, split_features, monkeypatch):
    from pyspark.ml.feature import VectorAssembler

    forest = models.train_forest(split_features.filter("not is_test"), trees=2, depth=2, trees_per_group=1)
    at_work = []
    write, load = VectorAssembler.write, VectorAssembler.load
    monkeypatch.setattr(VectorAssembler, "write", lambda self: at_work.append(threading.current_thread()) or write(self))
    monkeypatch.setattr(VectorAssembler, "load", lambda path: at_work.append(threading.current_thread()) or load(path))
    path = models.save_model(forest, new_path(spark, "model"))
    models.save_model(forest, path)  # overwrites
    again = models.load_model(path)
    assert len(at_work) == 3 and threading.main_thread() not in at_work
    assert [s.uid for s in again.stages] == [s.uid for s in models.PipelineModel.load(path).stages] == [s.uid for s in forest.stages]
    forest.write().overwrite().save(path)
    assert [s.uid for s in models.load_model(path).stages] == [s.uid for s in forest.stages]


def forest_of(rows, trees, depth, features, bootstrap=True):
    made = forest.fit_forest(rows, trees, depth, features, 7, 2, bootstrap)
    return made, forest.with_share(rows, made, "ours")


def plain_shares(rows, depth):
    """Each row's share of class 1 at its leaf; rows are (label, values)."""
    totals = [sum(y == c for y, _ in rows) for c in (0, 1)]
    weight = [len(rows) / (2 * n) for n in totals]

    def impurity(part):
        a, b = (weight[c] * sum(y == c for y, _ in part) for c in (0, 1))
        return 2 * a * b / (a + b)

    def below(part, left):
        a, b = (weight[c] * sum(y == c for y, _ in part) for c in (0, 1))
        found = []
        for f in range(len(rows[0][1])) if left and a and b else ():
            for cut in sorted({x[f] for _, x in part})[:-1]:
                sides = [r for r in part if r[1][f] <= cut], [r for r in part if r[1][f] > cut]
                found.append((-round(impurity(part) - impurity(sides[0]) - impurity(sides[1]), 9), f, cut, sides))
        best = min(found, key=lambda split: split[:3], default=(0,))
        if best[0] >= 0:
            return {x: b / (a + b) for _, x in part}
        return below(best[3][0], left - 1) | below(best[3][1], left - 1)

    return below(rows, depth)


@pytest.mark.parametrize("local", [500_000, 60])
@pytest.mark.parametrize("depth", [1, 4, 30])
def test_tree_without_draws_is_the_plain_one(few_valued, depth, local, monkeypatch):
    monkeypatch.setattr(forest, "LOCAL_CELLS", local)
    monkeypatch.setattr(forest, "LEAST_PER_BLOCK", 50)
    _, scored = forest_of(few_valued, 1, depth, 5, bootstrap=False)
    rows = scored.collect()
    assert len(rows) == few_valued.count()
    want = plain_shares([(r.is_anomalous, tuple(r.features)) for r in rows], depth)
    assert max(abs(r.ours - want[tuple(r.features)]) for r in rows) < 1e-9
    if depth <= 4:  # Spark's tree decides alike; its leaves differ, as it joins those of one decision
        weighted = stage(models.with_class_weight(scored.withColumn("po_id", F.monotonically_increasing_id())).drop("po_id"), "weighted")
        sparks = DecisionTreeClassifier(labelCol="is_anomalous", weightCol="weight", maxDepth=depth).fit(weighted.coalesce(1))
        assert sparks.transform(scored).filter((F.col("ours") > 0.5) != (F.col("prediction") == 1)).isEmpty()


def test_forest_is_the_same_however_it_is_cut(few_valued, monkeypatch):
    monkeypatch.setattr(forest, "LEAST_PER_BLOCK", 50)
    _, whole = forest_of(few_valued, 5, 30, 3)
    monkeypatch.setattr(forest, "CELLS_PER_WAVE", 700)
    monkeypatch.setattr(forest, "SCORED_AT_ONCE", 100)
    made, cut = forest_of(few_valued, 5, 30, 3)
    assert whole.exceptAll(cut).isEmpty() and whole.count() == cut.count() == few_valued.count()
    assert [len(g.treeWeights) for g in made] == [2, 2, 1]
    own = made[0].transform(few_valued).select(models.positive_probability(F.col("votes_0")).alias("p"))
    assert own.filter("p < 0 or p > 1 or p is null").isEmpty()


def test_forest_with_tops_is_as_good_as_one_without(few_valued, monkeypatch):
    def error(local):
        monkeypatch.setattr(forest, "LOCAL_CELLS", local)
        scored = forest_of(few_valued, 30, 30, 3)[1]
        return scored.agg(F.avg(F.abs(F.col("ours") - F.col("is_anomalous")))).first()[0]

    assert error(40) == pytest.approx(error(500_000), abs=0.02)


def test_draws_of_a_cell_are_those_of_its_rows():
    import numpy as np

    grower = forest._Grower(np.array([2]), np.ones(2), 1, 30, 1, True)
    counts = np.full((2, 20_000), 3)
    drawn = grower.drawn(0, 0, counts)
    assert drawn.mean() == pytest.approx(3, abs=0.05) and drawn.var() == pytest.approx(3, abs=0.1)
    assert (drawn == grower.drawn(0, 0, counts)).all() and (drawn != grower.drawn(1, 0, counts)).any()


def test_packed_bins_of_many_features_come_back():
    import numpy as np

    sizes = np.array([32, 1, 2, 7] * 12)
    codes = np.random.default_rng(3).integers(0, sizes, (100, 48)).astype(np.uint8)
    packing = forest.Packing(sizes)
    assert packing.words > 1 and (packing.unpack(packing.pack(codes)) == codes).all()


def test_boosted_trees_by_level_are_those_by_two(few_valued, monkeypatch):
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", 200)

    def shares(paired):
        monkeypatch.setattr(boosting, "PAIRED_ROWS", paired, raising=False)
        model = boosting.fit_boosted(few_valued, 4, 4, 0.3, 0.8, 0.8, 1)
        scored = model.transform(few_valued).select("features", models.positive_probability(F.col("probability")).alias("p"))
        return {tuple(r.features): r.p for r in scored.collect()}

    by_level, by_two = shares(0), shares(60_000)
    assert by_level.keys() == by_two.keys() and all(by_level[x] == pytest.approx(by_two[x], abs=1e-9) for x in by_two)


def test_rows_of_the_same_bins_are_one_in_boosting(spark, few_valued):
    twice = stage(few_valued.union(few_valued).union(few_valued), "thrice")
    alone, repeated = (boosting.fit_boosted(rows, 4, 4, 0.3, 1.0, 1.0, 1).transform(few_valued) for rows in (few_valued, twice))
    p = models.positive_probability(F.col("probability"))
    both = repeated.select("features", p.alias("theirs")).distinct().join(alone.select("features", p.alias("ours")).distinct(), "features")
    assert both.agg(F.max(F.abs(F.col("theirs") - F.col("ours")))).first()[0] < 1e-9
    block = boosting._Block(None, boosting.np.ones(10_000), boosting.np.full(10_000, 4), None)
    kept = block.kept(boosting.np.random.default_rng(2), 0.8)
    assert kept.mean() == pytest.approx(3.2, abs=0.05) and kept.var() == pytest.approx(4 * 0.8 * 0.2, abs=0.05)
