import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from revlens.ml import classifiers as cl
from revlens.ml import compare, search
from revlens.ml import evaluate as ev
from revlens.ml.stacking import Stacking
from revlens.ml.vectorize import Tfidf, TfidfParams, feature_steps
from revlens.plans import jobs
from revlens.session import staged


def rows(spark, classes=2, n=240, seed=1):
    """Separable up to some noise; the first feature carries the class."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        label = 0 if rng.random() < 0.6 else rng.randint(1, classes - 1)
        data.append((i, label, Vectors.dense([label * 2 + rng.gauss(0, 0.4), rng.gauss(0, 1)])))
    return staged(spark.createDataFrame(data, ["id", "label", "features"]))


@pytest.fixture(scope="module")
def binary(spark):
    return rows(spark)


@pytest.fixture(scope="module")
def three(spark):
    return rows(spark, 3)


def f1(df):
    return ev.MacroF1Evaluator().evaluate(df)


MODELS = {
    "logreg": lambda: cl.logistic(),
    "newton": lambda: cl.logistic(solver="newton"),
    "l1": lambda: cl.logistic(penalty="l1", C=0.5),
    "rf": lambda: cl.random_forest(n_estimators=5, max_depth=4),
    "gb": lambda: cl.gradient_boosting(n_estimators=3, validation_share=0.2),
    "svm": lambda: cl.linear_svm(max_iter=20),
    "perceptron": lambda: cl.perceptron(max_iter=10),
}


@pytest.mark.parametrize("name", MODELS)
def test_beats_the_constant(binary, name):
    baseline = f1(cl.constant(binary))
    assert f1(MODELS[name]().fit(binary).transform(binary)) > max(0.85, baseline)


def test_regularisation_follows_c(binary):
    n = binary.count()
    strong, weak = cl.logistic(C=1e-4).fit(binary), cl.logistic(C=100.0).fit(binary)
    assert np.linalg.norm(strong.coefficients.toArray()) < 0.1 * np.linalg.norm(weak.coefficients.toArray())
    assert weak.getRegParam() == pytest.approx(1 / (100 * n))


def test_boosting_for_three_classes(three):
    # The first tree is a step of the learning rate like every other one, so three small steps would not get far.
    out = cl.gradient_boosting(n_estimators=3, learning_rate=0.5, classes=3).fit(three).transform(three)
    p = np.array([r[0] for r in out.select(vector_to_array("probability")).collect()])
    assert p.shape[1] == 3 and np.allclose(p.sum(axis=1), 1)
    assert [r[0] for r in out.select("prediction").collect()] == list(p.argmax(axis=1))
    assert f1(out) > 0.85


def test_softmax_boosting_follows_its_definition(spark):
    """Rounds on one feature against plain numpy: leaves are the feature's values, steps are Newton's."""
    rng = np.random.default_rng(4)
    cell = rng.integers(0, 6, 400)
    label = np.minimum(3, (cell + rng.integers(0, 3, 400)) // 2)
    df = spark.createDataFrame([(i, int(y), Vectors.dense([float(c)])) for i, (y, c) in enumerate(zip(label, cell))], ["id", "label", "features"])
    model = cl.gradient_boosting(n_estimators=3, max_depth=6, learning_rate=0.3, classes=4).fit(df)
    s = np.tile(np.log(np.bincount(label, minlength=4) / 400), (400, 1))
    losses = []
    for t in range(4):
        p = np.exp(s) / np.exp(s).sum(1, keepdims=True)
        losses.append(-np.log(p[np.arange(400), label]).mean())
        if t == 3:
            break
        r = np.eye(4)[label] - p
        for c in range(6):
            at = cell == c
            s[at] += 0.3 * 0.75 * r[at].sum(0) / (np.abs(r[at]) * (1 - np.abs(r[at]))).sum(0)
    assert [h[0] for h in model.history] == pytest.approx(losses) and losses == sorted(losses, reverse=True)
    mine = np.array([x[0] for x in model.transform(df).orderBy("id").select(vector_to_array("probability")).collect()])
    assert np.allclose(mine, p)


def test_softmax_boosting_stops_early_and_samples(three):
    from revlens.ml.boosting import SoftmaxBoosting

    noise = three.withColumn("label", F.pmod(F.xxhash64("id"), F.lit(3)).cast("int")).withColumn("held", F.col("id") % 3 == 0)
    model = SoftmaxBoosting(classes=3, maxIter=12, stepSize=1.0, maxDepth=5, patience=2, subsamplingRate=0.6)._set(
        validationIndicatorCol="held").fit(noise)
    assert len(model.rounds) < 12 and len(model.history) == len(model.rounds) + 1
    held = [h for _, h in model.history]
    assert min(held[-3:]) + 1e-4 >= held[-3]
    assert f1(SoftmaxBoosting(classes=3, maxIter=3, stepSize=0.5, subsamplingRate=0.7).fit(three).transform(three)) > 0.85


def test_softmax_takes_maximum_and_sum_once_a_row(spark):
    """As plain columns inside the lambdas both were computed again for every class."""
    from revlens.ml.boosting import softmax

    df = spark.createDataFrame([([0.5, -1.0, 2.0],), ([1000.0, 1000.0, float("-inf")],)], "s array<double>")
    out = df.select(softmax(F.col("s")).alias("p"))
    got = np.array([r["p"] for r in out.collect()])
    e = np.exp([0.5 - 2, -3.0, 0.0])
    assert np.allclose(got, [e / e.sum(), [0.5, 0.5, 0.0]], atol=1e-15)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_max") == 1 and plan.count("aggregate(") == 1
    assert "- array_max" not in plan and "/ aggregate" not in plan


def test_a_class_without_rows_has_probability_zero(three):
    df = three.withColumn("label", F.when(F.col("label") == 1, 3).otherwise(F.col("label")))
    model = cl.gradient_boosting(n_estimators=2, learning_rate=0.5, classes=5).fit(df)
    p = np.array([r[0] for r in model.transform(df).select(vector_to_array("probability")).collect()])
    assert (p[:, [1, 4]] == 0).all() and np.allclose(p.sum(1), 1) and np.isfinite([h for h, _ in model.history]).all()


def test_leaf_numbers_are_spark_s(three):
    from pyspark.ml.regression import RandomForestRegressor

    from revlens.ml import boosting

    fitted = RandomForestRegressor(labelCol="label", numTrees=1, bootstrap=False, maxDepth=5, leafCol="spark_leaf").fit(three)
    tree = boosting.Tree.of(fitted.trees[0].toDebugString)
    mine = fitted.transform(three).withColumn("leaf", boosting.leaves("features", [tree])[0])
    assert mine.where(vector_to_array("spark_leaf")[0] != F.col("leaf")).count() == 0 and tree.leaves > 3


def test_a_boosting_fit_sends_no_row_to_python(three, monkeypatch):
    """Every table of a fit is written without Python and holds the residuals, so that a tree reads them instead of taking a softmax."""
    from revlens.ml import boosting

    written, keep = [], boosting.staged
    monkeypatch.setattr(boosting, "staged", lambda df, name: written.append(df) or keep(df, name))
    model = cl.gradient_boosting(n_estimators=2, learning_rate=0.5, classes=3).fit(three)
    assert len(written) == 3 and len(model.rounds) == 2
    for df in written:
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString() and {"r0", "r1", "r2", "loss"} <= set(df.columns)


def test_both_forms_of_a_batch_give_the_same_features():
    """Arrow rows, a slice of them included, and pandas rows."""
    import pandas as pd
    import pyarrow as pa

    from revlens.ml import boosting

    rows = [{"indices": [0], "values": [3.0]}, {"indices": None, "values": [1.0, 2.0, 4.0]}, {"indices": [1, 2], "values": [5.0, 6.0]}, {"indices": [], "values": []}]
    parts = pa.array(rows, pa.struct([("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])).slice(1)
    assert boosting.dense(parts, {0: 0, 2: 1}).tolist() == boosting.dense(pd.DataFrame(rows[1:]), {0: 0, 2: 1}).tolist() == [[1, 4], [0, 6], [0, 0]]


def test_sparse_and_dense_rows_give_the_same_features():
    from revlens.ml import boosting

    import pandas as pd

    column = {1: 0, 4: 1, 9: 2}
    parts = pd.DataFrame({"indices": [None, [1, 2, 9], [], [4]], "values": [list(range(10)), [5.0, 6.0, 7.0], [], [8.0]]})
    assert boosting.dense(parts, column).tolist() == [[1, 4, 9], [5, 0, 7], [0, 0, 0], [0, 8, 0]]


def test_newton_ends_at_the_optimum(spark, binary):
    """The gradient of the penalised, balanced loss vanishes; sparse rows, one without label and a constant column included."""
    sparse = [(10_000, 1, Vectors.sparse(2, [0], [0.3])), (10_001, None, Vectors.dense([9.0, 9.0]))]
    df = binary.union(spark.createDataFrame(sparse, binary.schema))
    model = cl.logistic(C=0.5, solver="newton").fit(df)
    rows = [(r["label"], r["features"].toArray()) for r in df.collect() if r["label"] is not None]
    y, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    w = len(y) / (2 * np.bincount(y))[y]
    p = 1 / (1 + np.exp(-(x @ model.coefficients + model.intercept)))
    assert np.abs(x.T @ (w * (p - y)) + model.coefficients / 0.5).max() < 1e-6 and abs((w * (p - y)).sum()) < 1e-6
    with pytest.raises(ValueError):
        cl.logistic(penalty="l1", solver="newton")


def test_unknown_name():
    with pytest.raises(ValueError):
        cl.named("nonsense")
    assert cl.named("logreg", C=2.0).getOrDefault("C") == 2.0


@pytest.mark.parametrize("classes", [2, 3])
def test_stacking(spark, classes, request):
    data = request.getfixturevalue("binary" if classes == 2 else "three")
    stack = jobs.stack(classes=classes, folds=3, trees=4, rounds=2, depth=3, iterations=20, parallelism=4)
    oof = stack.out_of_fold(data).select("id", vector_to_array("_base").alias("p")).collect()
    assert sorted(r["id"] for r in oof) == list(range(240))
    p = np.array([r["p"] for r in oof])
    assert p.shape[1] == (3 if classes == 2 else 9) and p.min() >= 0 and p.max() <= 1
    out = stack.fit(data).transform(data)
    assert set(out.columns) - set(data.columns) == {"rawPrediction", "probability", "prediction"}
    assert f1(out) > 0.85


def test_stacking_parameters_reach_the_parts(spark, binary):
    stack = jobs.stack(folds=2, trees=3, rounds=2, depth=3, iterations=10)
    changed = stack.copy(jobs.param_map(stack.steps(), {"rf__n_estimators": 2, "final_estimator__C": 0.25, "stack__numFolds": 4}))
    assert isinstance(changed, Stacking) and changed.getOrDefault("numFolds") == 4
    assert changed.bases["rf"].inner.getNumTrees() == 2 and changed.meta.getOrDefault("C") == 0.25
    assert stack.bases["rf"].inner.getNumTrees() == 3


def test_without_passthrough(binary):
    stack = jobs.stack(folds=2, trees=3, rounds=2, depth=3, iterations=20)
    model = stack.copy({stack.passthrough: False}).fit(binary)
    assert model.meta.numFeatures == 3


def test_cross_validated_predictions_cover_every_row_once(binary):
    folded = search.with_folds(binary, "id", 3)
    out = search.cross_val_predict(cl.logistic(max_iter=10), folded, 3).collect()
    assert sorted(r["id"] for r in out) == list(range(240))


def test_search(binary):
    folded = search.with_folds(binary, "id", 2)
    model = cl.logistic(max_iter=10, penalty="l1")
    found = search.Search(model, {"clf": model}, folded, 2, parallelism=4).grid({"clf__C": [1e-7, 1.0]})
    assert found.best.settings == {"clf__C": 1.0}
    assert found.table().first()["trial"] == found.best.number == 1
    assert f1(found.refit().transform(binary)) > 0.85
    space = {"clf__C": search.LogUniform(1e-2, 10.0)}
    assert len(search.Search(model, {"clf": model}, folded, 2).rounds(space, 2, 2).trials) == 4


def folded_texts(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, i % 2, " ".join(rng.choice(words[(i % 2) * 10:]) for _ in range(rng.randrange(12))) if i % 9 else None, float(i % 5)) for i in range(90)]
    return search.with_folds(spark.createDataFrame(rows, "id int, label int, reviewText string, a double"), "id", 3)


def vectors(df):
    return {r["id"]: r["features"] for r in df.select("id", "features").collect()}


@pytest.mark.parametrize("options", [
    dict(minDF=2.0, maxDF=0.9, maxFeatures=12), dict(maxNgram=2, minDF=3.0, sublinear=True, norm="l1"),
    dict(minDF=0.05, maxFeatures=7, binary=True, norm="none"), dict(maxNgram=2, minDF=2.0, maxCollected=3)])
def test_folds_share_their_texts_and_keep_their_features(spark, options):
    """A fold's features out of the shared counts are those of the pipeline that was fitted without it, to the last bit."""
    rows = folded_texts(spark)
    plain = Pipeline(stages=list(feature_steps(numeric=["a"], **options).values()))
    shared = search.FoldFeatures(plain, rows, 3, "fold")
    for i in (0, 1, 2, None):
        inside, on_texts = shared.fit(i)
        expected = vectors(plain.fit(rows if i is None else rows.where(F.col("fold") != i)).transform(rows))
        assert vectors(inside.transform(shared.rows)) == vectors(on_texts.transform(rows)) == expected and len(expected) == 90


def test_a_search_reads_its_texts_twice_and_refits_without_them(spark, monkeypatch):
    """Once for the folds' terms, once for the rows' counts; a second round and the refit read neither again."""
    rows, seen = folded_texts(spark), []
    terms = Tfidf.terms
    monkeypatch.setattr(TfidfParams, "terms", lambda self: seen.append(1) or terms(self))
    steps, model = feature_steps(numeric=["a"], minDF=2.0), cl.logistic(max_iter=10)
    found = search.Search(model, {**steps, "clf": model}, rows, 3, features=Pipeline(stages=list(steps.values())))
    found.grid({"clf__C": [0.1, 1.0]}).grid({"clf__C": [0.5]})
    assert len(seen) == 2 and len(found.trials) == 3
    refitted = found.refit()
    assert len(seen) == 2
    expected = found.with_settings(found.best.settings).fit(rows).transform(rows)
    got = {r["id"]: r["probability"] for r in refitted.transform(rows).collect()}
    assert all(np.allclose(r["probability"], got[r["id"]], atol=1e-6) for r in expected.collect()) and len(got) == 90


def test_draws_are_seeded_and_inside():
    space = {"a": search.Whole(2, 4), "b": search.LogUniform(1e-3, 1.0), "c": ["x", "y"], "d": search.Uniform(0.5, 0.9)}
    assert search.draws(space, 5, 1) == search.draws(space, 5, 1) != search.draws(space, 5, 2)
    for s in search.draws(space, 50):
        assert s["a"] in (2, 3, 4) and 1e-3 <= s["b"] <= 1 and s["c"] in "xy" and 0.5 <= s["d"] <= 0.9


def test_narrowed_ranges_stay_inside_and_hold_the_best():
    space = {"a": search.Whole(0, 100), "b": search.LogUniform(1e-4, 1.0), "c": [1, 2, 3, 4], "d": search.Uniform(0, 1)}
    got = search.narrowed(space, {"a": 90, "b": 1e-2, "c": 4, "d": 0.5})
    assert got["a"] == search.Whole(65, 100) and got["c"] == [3, 4] and got["d"] == search.Uniform(0.25, 0.75)
    assert got["b"].low == pytest.approx(1e-3) and got["b"].high == pytest.approx(1e-1)


def test_first_of_equal_trials_wins(binary):
    s = search.Search(None, {}, binary, 1)
    s.trials = [search.Trial(0, {}, [0.5]), search.Trial(1, {"x": 1}, [0.7]), search.Trial(2, {"x": 2}, [0.7])]
    assert s.best.number == 1


def test_comparison(binary):
    models = {"a": cl.logistic(max_iter=10), "b": cl.random_forest(n_estimators=2, max_depth=1)}
    out = compare.on_holdout(binary.where("id < 160"), binary.where("id >= 160"), models).collect()
    assert out[0]["macro_f1"] >= out[1]["macro_f1"]
    folded = search.with_folds(binary, "id", 2)
    assert {r["classifier"] for r in compare.on_folds(folded, models, 2).collect()} == {"a", "b"}


def test_shuffle_moves_values_only(spark):
    df = spark.range(500).withColumn("v", F.col("id") * 2)
    out = ev.shuffled(df, "id", "v", 1).collect()
    assert sorted(r["id"] for r in out) == list(range(500))
    assert sorted(r["v"] for r in out) == [2 * i for i in range(500)]
    assert sum(r["v"] == 2 * r["id"] for r in out) < 20


def test_permutation_importance(binary):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    scalar = binary.select("id", "label", vector_to_array("features")[0].alias("a"), vector_to_array("features")[1].alias("b"))
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), cl.logistic(max_iter=10)]).fit(scalar)
    out = {r["feature"]: r["importance_mean"] for r in ev.permutation_importance(model, scalar, "id", ["a", "b"], ev.MacroF1Evaluator(), 2).collect()}
    assert out["a"] > 0.2 > abs(out["b"])


def test_evaluation_tables(binary):
    out = cl.logistic(max_iter=10).fit(binary).transform(binary)
    tables = jobs.evaluation(out)
    assert tables["auc"].first()[0] > 0.9 and tables["confusion"].count() == 4


def test_no_depth_limit_grows_deep_trees(spark):
    from pyspark.ml.linalg import Vectors

    from revlens.ml.vectorize import param_map

    rows = spark.createDataFrame(
        [(i, (i * 7919 % 101) % 2, Vectors.dense([float(i), float(i % 13)])) for i in range(300)], ["id", "label", "features"])
    forest = cl.random_forest(n_estimators=3)
    model = forest.copy(param_map({"rf": forest}, {"rf__max_depth": None})).fit(rows)
    assert min(t.depth for t in model.trees) > 5
    with pytest.raises(ValueError):
        param_map({"rf": forest}, {"rf__n_estimators": None})


def test_penalty_and_ngram_range_are_named_settings():
    from revlens.ml.vectorize import Tfidf, param_map

    steps = {"lr": cl.logistic(), "text": Tfidf(), "gb": cl.gradient_boosting()}
    found = param_map(steps, {"lr__penalty": "l1", "text__ngram_range": (1, 3), "gb__validation_fraction": 0.1})
    assert sorted(found.values()) == [0.1, 1.0, 3]


def test_one_bucket_is_the_plain_perceptron(spark):
    """Row after row in the seeded order, weights times class weights; it stops in an epoch without mistakes."""
    import hashlib

    rng = np.random.default_rng(3)
    x = rng.standard_normal((80, 3))
    y = (x @ [1.0, -2.0, 0.5] > 0.3).astype(int)
    data = [(i, int(y[i]), Vectors.dense(x[i]) if i % 2 else Vectors.sparse(3, range(3), x[i])) for i in range(80)]
    df = spark.createDataFrame(data, ["id", "label", "features"]).repartition(5)
    model = cl.perceptron(max_iter=60, buckets=1).fit(df)
    w, c, weight = np.zeros(3), 0.0, 80 / (2 * np.bincount(y))
    for epoch in range(1, 61):
        wrong = 0
        for i in sorted(range(80), key=lambda i: hashlib.md5(f"{42 + epoch}:{i}".encode()).hexdigest()[:15]):
            sign = 2 * y[i] - 1
            if sign * (x[i] @ w + c) <= 0:
                w, c, wrong = w + weight[y[i]] * sign * x[i], c + weight[y[i]] * sign, wrong + 1
        if not wrong:
            break
    assert epoch < 60 and np.allclose(model.weights, w) and model.bias == pytest.approx(c)
    assert model.transform(df).where("label <> prediction").count() == 0


def test_kmeans_is_the_same_on_any_partitioning(spark):
    from revlens.ml import clustering

    rng = np.random.default_rng(6)
    x = np.vstack([rng.standard_normal((40, 3)) + c for c in ((0, 0, 9), (9, 0, 0), (0, 9, 0))])
    data = [(i, Vectors.dense(v) if i % 2 else Vectors.sparse(3, range(3), v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(data, ["id", "features"])
    a, b = (clustering.kmeans(df.repartition(n), 3) for n in (1, 7))
    assert np.allclose(a.centers, b.centers)
    got = {r["id"]: r["cluster"] for r in a.transform(df).collect()}
    assert all(len({got[i] for i in range(g * 40, g * 40 + 40)}) == 1 for g in range(3)) and set(got.values()) == {0, 1, 2}
    for c in range(3):
        assert np.allclose(a.centers[c], x[[i for i in got if got[i] == c]].mean(0))
    same = spark.createDataFrame([(i, Vectors.dense([1.0 * (i % 2)])) for i in range(10)], ["id", "features"])
    assert len(clustering.kmeans(same, 5).centers) == 2


def test_importance_by_any_evaluator(spark):
    """One pass over all copies gives what shuffling and evaluating one by one gives."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import SQLTransformer

    df = spark.createDataFrame([(i, float(i % 10), float(i % 7), 3.0 * (i % 10)) for i in range(200)], "id bigint, a double, b double, label double")
    model = SQLTransformer(statement="SELECT *, 3 * a + 0.1D * b AS prediction FROM __THIS__")
    evaluator = RegressionEvaluator(metricName="rmse")
    got = {r["feature"]: r for r in ev.permutation_importance(model, df, "id", ["a", "b"], evaluator, repeats=2, seed=5).collect()}
    base = evaluator.evaluate(model.transform(df))
    for i, c in enumerate("ab"):
        lost = [base - evaluator.evaluate(model.transform(ev.shuffled(df, "id", c, 5 + 31 * i + r))) for r in range(2)]
        assert got[c]["importance_mean"] == pytest.approx(np.mean(lost)) and got[c]["importance_std"] == pytest.approx(np.std(lost))


def test_tree_pieces_follow_rows_times_features(spark):
    """Trees keep four bytes for every feature, zeros too, so wide sparse rows need more partitions than their files have."""
    from pyspark.ml.linalg import SparseVector

    wide = spark.createDataFrame([(i, SparseVector(5000, [i % 5000], [1.0])) for i in range(400)], ["id", "features"]).coalesce(1)
    cut = cl.tree_pieces(wide, "features", "id", 200_000)
    assert cut.rdd.getNumPartitions() == 40 and cut.count() == 400
    assert cl.tree_pieces(wide, "features", "id").rdd.getNumPartitions() == 1


def test_newton_reads_blocks_of_rows(spark):
    """A pass moves blocks, not rows: sparse and dense rows mixed, more rows than a block has."""
    from pyspark.ml.linalg import Vectors

    from revlens.ml import newton

    rows = [(float(i % 3 == 0), Vectors.dense([i % 7, i % 5]) if i % 2 else Vectors.sparse(2, [1], [float(i % 5)])) for i in range(3000)]
    df = spark.createDataFrame(rows, ["label", "features"]).coalesce(1)
    parts = F.unwrap_udt("features")
    flat = df.select(F.col("label").alias("y"), F.lit(1.0).alias("w"), F.coalesce(parts["size"], F.size(parts["values"])).alias("size"), parts["indices"].alias("indices"), parts["values"].alias("values"))
    blocks = flat.mapInArrow(newton._blocks, "size int, y binary, w binary, row binary, at binary, value binary")
    assert blocks.count() == 3
    x = np.array([[*v.toArray(), 1.0] for _, v in rows])
    loss, slope, curve = newton._sums(blocks, np.zeros(3), np.zeros(3))
    assert abs(loss - np.log(2)) < 1e-12
    assert np.allclose(slope, x.T @ (0.5 - np.array([y for y, _ in rows])) / 3000) and np.allclose(curve, x.T @ x / 4 / 3000)
