"""Classifiers, stacking, search and clustering on the given tables.

What a fitted model answers is not unique, so SQL says what must hold: which rows are held out, with which labels, that
every answer is a class, its score in range and on the answer's side, and that the model is no worse than a constant.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from revlens.functions import text as tx
from revlens.ml import classifiers as cl
from revlens.ml import clustering, compare, search
from revlens.ml import evaluate as ev
from revlens.ml import vectorize as vec
from revlens.operators import metrics, split
from revlens.plans import jobs
from revlens.plans.catalog import query
from revlens.plans.catalog.features import CORPUS
from revlens.plans.catalog.metrics import sql_per_class
from revlens.session import spread, staged
from revlens.sources.standin import event_reviews, labelled_reviews, table


def text_rows(spark, folder):
    """Labelled documents with text statistics and sentiment."""
    from revlens.functions.sentiment import add_sentiment

    rows = labelled_reviews(spark, folder)
    return add_sentiment(tx.text_stats(tx.clean_columns(rows, "reviewText", "summary")), "reviewText", CORPUS)


def text_vectors(spark, folder):
    """(id, label, features, fold) of the labelled documents; vocabulary and scaling come from folds 1 and 2 only."""
    rows = search.with_folds(text_rows(spark, folder), "id", 3)
    fitted = Pipeline(stages=list(text_steps(rows).values())).fit(rows.where("fold <> 0"))
    return staged(fitted.transform(rows).select("id", "label", "features", "fold"), "text-vectors", by="fold")


def text_steps(rows):
    return vec.feature_steps(
        numeric=jobs.numeric_columns(rows), categorical=["category"], minDF=2.0, maxDF=0.9, maxFeatures=5000
    )


def rating_vectors(spark, folder):
    """(id, label 0..4, features, fold) of the rated events; scaling and levels come from folds 1 and 2 only."""
    rows = event_reviews(spark, folder).select(
        "id", (F.col("overall") - 1).alias("label"), "category",
        (F.col("value") + F.col("id") % 13).alias("value"), F.hour("ts").alias("review_hour"),
    )
    stages = [
        vec.Standardise(inputCols=["value", "review_hour"], outputCol="_numeric"),
        vec.OneHot(outputCol="_category"),
        VectorAssembler(inputCols=["_numeric", "_category"], outputCol="features"),
    ]
    rows = search.with_folds(rows, "id", 3)
    fitted = Pipeline(stages=stages).fit(rows.where("fold <> 0"))
    return staged(fitted.transform(rows).select("id", "label", "features", "fold"), "rating-vectors", by="fold")


def held_out(rows, model):
    """Fit on folds 1 and 2, predict fold 0."""
    fitted = model.fit(rows.where("fold <> 0"))
    return fitted.transform(rows.where("fold = 0"))


FEW = 10


def answers(predicted, classes: int = 2):
    """(id, label, valid, beats_constant): every answer checked, and all against the best constant.

    With fewer than `FEW` held-out rows of a class a score says nothing, so nothing is claimed there.
    """
    valid = F.col("prediction").isin([float(c) for c in range(classes)])
    if "probability" in predicted.columns:
        p = vector_to_array("probability")
        best = F.array_position(p, F.array_max(p)) - 1
        valid = valid & F.forall(p, lambda v: v.between(0, 1)) & (p[F.col("prediction").cast("int")] == F.array_max(p)) & (best <= F.col("prediction"))
    elif "rawPrediction" in predicted.columns:
        valid = valid & ((vector_to_array("rawPrediction")[1] >= 0) == (F.col("prediction") == 1))
    rows = staged(predicted.select(
        "id", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"), valid.alias("valid")), "answers")
    reached = metrics.macro_f1(rows).first()[0]
    constant = max(metrics.macro_f1(rows.withColumn("prediction", F.lit(c))).first()[0] or 0.0 for c in range(classes))
    least = min((r["count"] for r in rows.groupBy("label").count().collect()), default=0)
    return rows.select("id", "label", "valid", F.lit(bool(reached >= constant or least < FEW)).alias("beats_constant"))


SQL_TEXT = "(SELECT doc_id AS id, quality AS label FROM labels)"
SQL_RATINGS = "(SELECT event_id AS id, least(5, 1 + floor(value / 25))::INT - 1 AS label FROM events)"


def sql_answers(source: str = SQL_TEXT, where: str = "fold = 0") -> str:
    return f"""WITH f AS (
        SELECT id, label, (row_number() OVER (PARTITION BY label ORDER BY substr(md5('42:' || id), 1, 15), id) - 1) % 3 AS fold
        FROM {source} AS s)
    SELECT id, label, true AS valid, true AS beats_constant FROM f WHERE {where}"""


SQL_ZERO = "p AS (SELECT doc_id, quality AS label, 0 AS prediction FROM labels)"


@query(
    "constant_baseline",
    f"""WITH {SQL_ZERO}, {sql_per_class('p')}
    SELECT round(avg(f1), 6) AS macro_f1, round(sum(tp) / sum(support), 6) AS accuracy FROM per""",
)
def constant_baseline(spark, folder):
    rows = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    out = metrics.scores(cl.constant(rows, 0).withColumn("prediction", F.col("prediction").cast("int")))
    return out.withColumns({c: F.round(c, 6) for c in out.columns})


# Newton's steps on two features and a bias, in SQL: sums of the balanced weights, then Cramer's rule.
SQL_DET = "({0}) * (({4}) * ({8}) - ({5}) * ({7})) - ({1}) * (({3}) * ({8}) - ({5}) * ({6})) + ({2}) * (({3}) * ({7}) - ({4}) * ({6}))"
SQL_H = ["h00", "h01", "h02", "h01", "h11", "h12", "h02", "h12", "h22"]


def sql_step(i: int) -> str:
    """The i-th entry of the Newton step."""
    swapped = [f"g{k // 3}" if k % 3 == i else h for k, h in enumerate(SQL_H)]
    return f"({SQL_DET.format(*swapped)}) / ({SQL_DET.format(*SQL_H)})"


SQL_LOGISTIC = f"""
    e AS (SELECT event_id AS id, (value >= 50)::INT AS label, (value + event_id % 41) / 100 AS a, (event_id % 13) / 13 AS b FROM events),
    f AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY substr(md5('42:' || id), 1, 15), id) - 1) % 3 AS fold FROM e),
    t AS (SELECT *, count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY label)) AS w FROM f WHERE fold <> 0),
    steps AS (
        SELECT 0 AS step, 0.0::DOUBLE AS c, 0.0::DOUBLE AS x, 0.0::DOUBLE AS y
        UNION ALL
        SELECT step + 1, c - {sql_step(0)}, x - {sql_step(1)}, y - {sql_step(2)} FROM (
            SELECT step, c, x, y, sum(w * (p - label)) AS g0, sum(w * (p - label) * a) + x AS g1, sum(w * (p - label) * b) + y AS g2,
                sum(w * v) AS h00, sum(w * v * a) AS h01, sum(w * v * b) AS h02, sum(w * v * a * a) + 1 AS h11, sum(w * v * a * b) AS h12,
                sum(w * v * b * b) + 1 AS h22
            FROM (SELECT *, p * (1 - p) AS v FROM (SELECT steps.*, t.*, 1 / (1 + exp(-(c + x * a + y * b))) AS p FROM steps, t WHERE step < 12) AS s) AS q
            GROUP BY step, c, x, y) AS r)"""


def two_features(spark, folder):
    """Events above half of the value range or not, by a blurred value and a number without meaning; (rows with folds)."""
    rows = event_reviews(spark, folder).select(
        "id", (F.col("value") >= 50).cast("int").alias("label"), ((F.col("value") + F.col("id") % 41) / 100).alias("a"),
        (F.col("id") % 13 / 13).alias("b"))
    return staged(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(search.with_folds(rows, "id", 3)), "two", by="fold")


@query("logistic_newton", f"""WITH RECURSIVE {SQL_LOGISTIC}
    SELECT id, label, (c + x * a + y * b > 0)::INT AS prediction, round(1 / (1 + exp(-(c + x * a + y * b))), 6) AS score
    FROM f, steps WHERE fold = 0 AND step = 12""")
def logistic_newton(spark, folder):
    """Held-out scores at the optimum of the balanced, penalised log loss."""
    out = held_out(two_features(spark, folder), cl.logistic(C=1.0, solver="newton"))
    return out.select("id", "label", F.col("prediction").cast("int").alias("prediction"), F.round(vector_to_array("probability")[1], 6).alias("score"))


@query("logistic_coefficients", f"""WITH RECURSIVE {SQL_LOGISTIC}
    SELECT s.solver, round(c, 3) AS intercept, round(x, 3) AS a, round(y, 3) AS b FROM steps, (VALUES ('lbfgs'), ('newton')) AS s(solver) WHERE step = 12""")
def logistic_coefficients(spark, folder):
    """The optimum is one point, so both solvers end there."""
    rows = two_features(spark, folder).where("fold <> 0")
    found = []
    for solver in ("lbfgs", "newton"):
        model = cl.logistic(C=1.0, max_iter=300, solver=solver, tol=1e-12).fit(rows)
        found.append((solver, float(model.intercept), *map(float, model.coefficients)))
    out = spark.createDataFrame(found, "solver string, intercept double, a double, b double")
    return out.select("solver", *[F.round(c, 3).alias(c) for c in ("intercept", "a", "b")])


@query("logistic_regression", sql_answers())
def logistic_regression(spark, folder):
    return answers(held_out(text_vectors(spark, folder), cl.logistic(C=1.0, max_iter=50)))


@query("logistic_regression_l1", sql_answers())
def logistic_regression_l1(spark, folder):
    return answers(held_out(text_vectors(spark, folder), cl.logistic(C=1.0, penalty="l1", max_iter=50)))


@query("logistic_multinomial", sql_answers(SQL_RATINGS))
def logistic_multinomial(spark, folder):
    return answers(held_out(rating_vectors(spark, folder), cl.logistic(multinomial=True, max_iter=50)), 5)


@query("random_forest", sql_answers())
def random_forest(spark, folder):
    return answers(held_out(text_vectors(spark, folder), cl.random_forest(n_estimators=10, max_depth=8)))


@query("gradient_boosting", sql_answers())
def gradient_boosting(spark, folder):
    model = cl.gradient_boosting(n_estimators=8, max_depth=3, subsample=0.8, validation_share=0.1)
    return answers(held_out(text_vectors(spark, folder), model))


@query("gradient_boosting_multiclass", sql_answers(SQL_RATINGS))
def gradient_boosting_multiclass(spark, folder):
    model = cl.gradient_boosting(n_estimators=3, max_depth=3, classes=5)
    return answers(held_out(rating_vectors(spark, folder), model), 5)


ROUNDS = 4  # of the boosting that SQL follows step by step
SQL_CELLS = f"""
    e AS (SELECT event_id AS id, least(5, 1 + floor(value / 25))::INT - 1 AS label,
                 least(7, floor((value + event_id % 13) / 12.5))::INT AS cell FROM events),
    f AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY substr(md5('42:' || id), 1, 15), id) - 1) % 3 AS fold FROM e),
    counts AS (SELECT cell, count(*) AS n, [{", ".join(f"count(*) FILTER (label = {c})" for c in range(5))}] AS of_class
               FROM f WHERE fold <> 0 GROUP BY cell),
    start AS (SELECT [{", ".join(f"ln(greatest(count(*) FILTER (label = {c}) / count(*), 1e-7))" for c in range(5))}] AS s FROM f WHERE fold <> 0),
    rounds AS (
        SELECT 0 AS round, cell, n, of_class, s, list_transform(s, lambda x: exp(x) / list_sum(list_transform(s, lambda y: exp(y)))) AS p
        FROM counts, start
        UNION ALL
        SELECT round + 1, cell, n, of_class, s, list_transform(s, lambda x: exp(x) / list_sum(list_transform(s, lambda y: exp(y)))) AS p
        FROM (SELECT round, cell, n, of_class, list_transform(range(1, 6), lambda k:
                  s[k] + 0.1 * 0.8 * (of_class[k] - n * p[k]) / (n * p[k] * (1 - p[k]))) AS s FROM rounds WHERE round < {ROUNDS}))"""


def cell_boosting(spark, folder):
    """Boosting on one feature of eight values, deep enough for a leaf each; (rows, fitted model)."""
    rows = event_reviews(spark, folder).select(
        "id", (F.col("overall") - 1).alias("label"),
        F.least(F.lit(7), F.floor((F.col("value") + F.col("id") % 13) / 12.5)).cast("double").alias("cell"))
    rows = search.with_folds(rows, "id", 3)
    rows = staged(VectorAssembler(inputCols=["cell"], outputCol="features").transform(rows), "cells")
    return rows, cl.gradient_boosting(n_estimators=ROUNDS, max_depth=7, classes=5).fit(rows.where("fold <> 0"))


@query("gradient_boosting_cells", f"""WITH RECURSIVE
    e AS (SELECT event_id AS id, (value >= 25)::INT AS label, least(7, floor((value + event_id % 13) / 12.5))::INT AS cell FROM events),
    f AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY substr(md5('42:' || id), 1, 15), id) - 1) % 3 AS fold FROM e),
    counts AS (SELECT cell, avg(label) AS up FROM f WHERE fold <> 0 GROUP BY cell),
    rounds AS (SELECT 1 AS round, cell, up, 2 * up - 1 AS s FROM counts
               UNION ALL SELECT round + 1, cell, up, s + 0.1 * (up * 4 / (1 + exp(2 * s)) - (1 - up) * 4 / (1 + exp(-2 * s)))
               FROM rounds WHERE round < {ROUNDS})
    SELECT id, label, (s > 0)::INT AS prediction, round(1 / (1 + exp(-2 * s)), 6) AS score
    FROM f JOIN rounds USING (cell) WHERE fold = 0 AND round = {ROUNDS}""")
def gradient_boosting_cells(spark, folder):
    """Binary boosting on one feature of eight values: in every leaf the mean of the residuals."""
    rows = event_reviews(spark, folder).select(
        "id", (F.col("value") >= 25).cast("int").alias("label"),
        F.least(F.lit(7), F.floor((F.col("value") + F.col("id") % 13) / 12.5)).cast("double").alias("cell"))
    rows = staged(VectorAssembler(inputCols=["cell"], outputCol="features").transform(search.with_folds(rows, "id", 3)), "cells")
    out = cl.gradient_boosting(n_estimators=ROUNDS, max_depth=7).fit(rows.where("fold <> 0")).transform(rows.where("fold = 0"))
    return out.select("id", "label", F.col("prediction").cast("int").alias("prediction"),
                      F.round(vector_to_array("probability")[1], 6).alias("score"))


@query("softmax_boosting", f"""WITH RECURSIVE {SQL_CELLS}
    SELECT id, label, list_position(p, list_max(p)) - 1 AS prediction, list_transform(p, lambda x: round(x, 6)) AS probability
    FROM f JOIN rounds USING (cell) WHERE fold = 0 AND round = {ROUNDS}""")
def softmax_boosting(spark, folder):
    """Held-out probabilities after four rounds: in every leaf the Newton step of the softmax residuals."""
    rows, model = cell_boosting(spark, folder)
    out = model.transform(rows.where("fold = 0"))
    return out.select("id", "label", F.col("prediction").cast("int").alias("prediction"),
                      F.transform(vector_to_array("probability"), lambda v: F.round(v, 6)).alias("probability"))


@query("softmax_boosting_loss", f"""WITH RECURSIVE {SQL_CELLS}, l AS (
    SELECT round, sum(list_sum(list_transform(range(1, 6), lambda k: -of_class[k] * ln(p[k])))) / sum(n) AS loss FROM rounds GROUP BY round)
    SELECT round, round(loss, 6) AS loss, coalesce(loss < lag(loss) OVER (ORDER BY round), true) AS falls FROM l""")
def softmax_boosting_loss(spark, folder):
    """Log loss of the training rows before the first round and after each."""
    rows, model = cell_boosting(spark, folder)
    losses = [loss for loss, _ in model.history]
    falls = [True] + [b < a for a, b in zip(losses, losses[1:])]
    table_ = list(zip(range(len(losses)), losses, falls))
    out = spark.createDataFrame(table_, "round int, loss double, falls boolean")
    return out.withColumn("loss", F.round("loss", 6))


@query("linear_svm", sql_answers())
def linear_svm(spark, folder):
    return answers(held_out(text_vectors(spark, folder), cl.linear_svm(max_iter=30)))


EPOCHS, BUCKETS = 3, 8


def sql_epoch(k: int) -> str:
    """Epoch k: every bucket goes through its rows in order from the mixed weights of the last epoch."""
    return f"""
    p{k} AS (
        SELECT n, list_reduce(list_prepend({{'x': x, 'v': v, 'c': c, 'y': 0.0::DOUBLE, 'w': 0.0::DOUBLE}}, rows), lambda s, r:
            CASE WHEN r.y * (s.x * r.x + s.v * r.v + s.c) <= 0
            THEN {{'x': s.x + r.w * r.y * r.x, 'v': s.v + r.w * r.y * r.v, 'c': s.c + r.w * r.y, 'y': 0.0::DOUBLE, 'w': 0.0::DOUBLE}} ELSE s END) AS s
        FROM (SELECT count(*) AS n, list({{'x': a, 'v': b, 'c': 0.0::DOUBLE, 'y': 2.0 * label - 1, 'w': w}}
                     ORDER BY substr(md5('{42 + k}:' || id), 1, 15)) AS rows
              FROM t GROUP BY ('0x' || substr(md5('42:' || id), 1, 15))::BIGINT % {BUCKETS}) AS g, m{k - 1}),
    m{k} AS (SELECT sum(n * s.x) / sum(n) AS x, sum(n * s.v) / sum(n) AS v, sum(n * s.c) / sum(n) AS c FROM p{k})"""


@query("perceptron_online", f"""WITH
    e AS (SELECT event_id AS id, (value >= 50)::INT AS label, (value + event_id % 41) / 100 AS a, (event_id % 13) / 13 AS b FROM events),
    f AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY substr(md5('42:' || id), 1, 15), id) - 1) % 3 AS fold FROM e),
    t AS (SELECT *, count(*) OVER () / (2.0::DOUBLE * count(*) OVER (PARTITION BY label)) AS w FROM f WHERE fold <> 0),
    m0 AS (SELECT 0.0::DOUBLE AS x, 0.0::DOUBLE AS v, 0.0::DOUBLE AS c), {", ".join(map(sql_epoch, range(1, EPOCHS + 1)))}
    SELECT id, label, (x * a + v * b + c > 0)::INT AS prediction, round(x, 6) AS x, round(v, 6) AS v, round(c, 6) AS c
    FROM f, m{EPOCHS} WHERE fold = 0""")
def perceptron_online(spark, folder):
    """Held-out answers and weights after a few epochs of mixed online learning."""
    rows = two_features(spark, folder)
    model = cl.perceptron(max_iter=EPOCHS, buckets=BUCKETS).fit(rows.where("fold <> 0"))
    out = model.transform(rows.where("fold = 0"))
    return out.select("id", "label", F.col("prediction").cast("int").alias("prediction"), *[
        F.round(F.lit(float(value)), 6).alias(name) for name, value in zip("xvc", (*model.weights, model.bias))])


@query("perceptron", sql_answers())
def perceptron(spark, folder):
    return answers(held_out(text_vectors(spark, folder), cl.perceptron(max_iter=8)))


@query("stacking", sql_answers())
def stacking(spark, folder):
    rows = text_vectors(spark, folder)
    return answers(held_out(rows, jobs.stack(folds=3, trees=10, rounds=5, depth=6, iterations=20, parallelism=4)))


@query("stacking_multiclass", sql_answers(SQL_RATINGS))
def stacking_multiclass(spark, folder):
    rows = rating_vectors(spark, folder)
    model = jobs.stack(classes=5, folds=2, trees=5, rounds=2, depth=5, iterations=20, parallelism=4)
    return answers(held_out(rows, model), 5)


@query("stacking_out_of_fold")
def stacking_out_of_fold(spark, folder):
    """Meta features: each row scored by base models that did not see it."""
    model = jobs.stack(folds=2, trees=5, rounds=3, depth=5, iterations=20, parallelism=4)
    out = model.out_of_fold(text_vectors(spark, folder).drop("fold"))
    return out.select("id", F.transform(vector_to_array("_base"), lambda v: F.round(v, 6)).alias("base_scores"))


@query("out_of_fold_coverage", "SELECT doc_id AS id, 1 AS models, 3 AS scores, true AS in_range FROM labels")
def out_of_fold_coverage(spark, folder):
    """Every labelled row is scored by exactly one fold's models, with probabilities."""
    scores = stacking_out_of_fold(spark, folder)
    return scores.groupBy("id").agg(
        F.count("*").alias("models"), F.max(F.size("base_scores")).alias("scores"),
        F.bool_and(F.forall("base_scores", lambda v: v.between(0, 1))).alias("in_range"),
    )


@query("fit_all_predict_test")
def fit_all_predict_test(spark, folder):
    """The whole text model with named settings: fitted on the labelled documents, applied to all others."""
    from revlens.sources.standin import document_reviews

    train = staged(text_rows(spark, folder), "train")
    settings = {
        "text__max_features": 300, "text__min_df": 2.0, "text__max_df": 0.85, "text__max_ngram": 2,
        "lr__C": 0.5, "rf__n_estimators": 10, "rf__max_depth": 6, "gb__n_estimators": 5,
        "gb__learning_rate": 0.1, "final_estimator__C": 2.0,
    }
    stack = jobs.stack(folds=2, iterations=20, parallelism=4)
    model = jobs.train_stacked(train, settings, stack)
    others = spread(document_reviews(spark, folder), "id").join(train.select("id"), "id", "left_anti")
    cleaned = tx.text_stats(tx.clean_columns(others, "reviewText", "summary"))
    from revlens.functions.sentiment import add_sentiment

    test = add_sentiment(cleaned, "reviewText", CORPUS)
    out = jobs.predict_split(model, test)
    return out.select("id", "prediction", F.round(F.col("probability")[1], 6).alias("score"))


@query("model_comparison")
def model_comparison(spark, folder):
    rows = text_vectors(spark, folder)
    models = {
        "LogisticRegression": cl.logistic(max_iter=50), "Perceptron": cl.perceptron(max_iter=5),
        "SVM": cl.linear_svm(max_iter=20), "RandomForest": cl.random_forest(n_estimators=10, max_depth=6),
    }
    return compare.on_holdout(rows.where("fold <> 0"), rows.where("fold = 0"), models, 4)


@query("cutoff_comparison")
def cutoff_comparison(spark, folder):
    """Out-of-fold scores of one classifier for each rating cutoff."""
    rows = rating_vectors(spark, folder)
    out = None
    for cutoff in (1, 2, 3, 4):
        binary = rows.withColumn("label", (F.col("label") + 1 > cutoff).cast("int"))
        part = compare.on_folds(binary, {"logreg": cl.logistic(max_iter=20)}, 3, parallelism=3)
        part = part.withColumn("cutoff", F.lit(cutoff))
        out = part if out is None else out.unionByName(part)
    return out


@query("text_experiment")
def text_experiment(spark, folder):
    """Report of the best of a small grid on text alone."""
    rows = labelled_reviews(spark, folder)
    space = {"clf__C": [1.0, 10.0], "clf__max_iter": [20]}
    _, tables = jobs.text_experiment(rows, "logreg", k=2, space=space, parallelism=4, minDF=2.0, maxFeatures=1000)
    return tables["report"]


@query("cross_validated_predictions", sql_answers(where="true"))
def cross_validated_predictions(spark, folder):
    return answers(search.cross_val_predict(cl.logistic(max_iter=30), text_vectors(spark, folder), 3, parallelism=3))


def _search(spark, folder, model=None):
    """A search whose vocabulary and scaling are fitted inside each fold, once for all classifier settings."""
    model = model or cl.logistic(max_iter=20)
    rows = search.with_folds(text_rows(spark, folder), "id", 3)
    steps = text_steps(rows)
    return search.Search(model, {**steps, "clf": model}, rows, 3, parallelism=4, features=Pipeline(stages=list(steps.values())))


def trials(found):
    """(trial, settings, folds, mean_ok, in_range, best): the search's table, each score checked against its folds."""
    table_ = found.table()
    mean = F.aggregate("fold_scores", F.lit(0.0), lambda a, v: a + v) / F.size("fold_scores")
    return table_.select(
        "trial", "settings", F.size("fold_scores").alias("folds"), (F.abs(mean - F.col("score")) < 1e-9).alias("mean_ok"),
        F.forall("fold_scores", lambda v: v.between(0, 1)).alias("in_range"),
        F.lit(found.best.score == max(t.score for t in found.trials)).alias("best_ok"))


def sql_trials(settings: list[dict], folds: int = 3) -> str:
    values = ", ".join("({}, '{}')".format(i, str(sorted(s.items())).replace("'", "''")) for i, s in enumerate(settings))
    return (f"SELECT trial::INT AS trial, settings, {folds} AS folds, true AS mean_ok, true AS in_range, true AS best_ok "
            f"FROM (VALUES {values}) AS v(trial, settings)")


GRID = {"clf__C": [0.1, 1.0, 10.0]}
FOREST = {"clf__n_estimators": search.Whole(20, 100), "clf__min_samples_leaf": [1, 2, 5]}
C_RANGE = {"clf__C": search.LogUniform(1e-3, 4.0)}
TEXT_GRID = {"text__max_features": [500, 5000], "clf__C": [1.0, 10.0]}
DRAWS = 5  # for each search of this catalog; the operator takes any number


@query("grid_search", sql_trials(search.grid(GRID)))
def grid_search(spark, folder):
    return trials(_search(spark, folder).grid(GRID))


@query("random_search", sql_trials(search.draws(FOREST, DRAWS)))
def random_search(spark, folder):
    return trials(_search(spark, folder, cl.random_forest(max_depth=5)).random(FOREST, DRAWS))


# The same grid where SQL can follow every fit: Newton's steps for each setting and fold.
C_GRID = {"clf__C": [0.01, 1.0, 100.0]}
SQL_GRID = f"""
    e AS (SELECT event_id AS id, (value >= 50)::INT AS label, (value + event_id % 41) / 100 AS a, (event_id % 13) / 13 AS b FROM events),
    f AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY substr(md5('42:' || id), 1, 15), id) - 1) % 3 AS fold FROM e),
    g AS (SELECT * FROM (VALUES {", ".join(f"({i}, {c})" for i, c in enumerate(C_GRID["clf__C"]))}) AS v(trial, strength)),
    t AS (SELECT i, f.*, count(*) OVER (PARTITION BY i) / (2.0 * count(*) OVER (PARTITION BY i, label)) AS w
          FROM f, (SELECT unnest([0, 1, 2, 9]) AS i) AS r WHERE fold <> i),
    steps AS (
        SELECT trial, strength::DOUBLE AS strength, i, 0 AS step, 0.0::DOUBLE AS c, 0.0::DOUBLE AS x, 0.0::DOUBLE AS y FROM g, (SELECT unnest([0, 1, 2, 9]) AS i) AS r
        UNION ALL
        SELECT trial, strength, i, step + 1, c - {sql_step(0)}, x - {sql_step(1)}, y - {sql_step(2)} FROM (
            SELECT trial, strength, i, step, c, x, y, sum(w * (p - label)) AS g0, sum(w * (p - label) * a) + x / strength AS g1,
                sum(w * (p - label) * b) + y / strength AS g2, sum(w * v) AS h00, sum(w * v * a) AS h01, sum(w * v * b) AS h02,
                sum(w * v * a * a) + 1 / strength AS h11, sum(w * v * a * b) AS h12, sum(w * v * b * b) + 1 / strength AS h22
            FROM (SELECT *, p * (1 - p) AS v FROM (
                SELECT steps.*, t.* EXCLUDE (i), 1 / (1 + exp(-(c + x * a + y * b))) AS p FROM steps JOIN t ON t.i = steps.i WHERE step < 14) AS s) AS q
            GROUP BY trial, strength, i, step, c, x, y) AS r),
    fits AS (SELECT * FROM steps WHERE step = 14),
    told AS (SELECT trial, i, label, (c + x * a + y * b > 0)::INT AS prediction FROM fits JOIN f ON fold = i),
    classes AS (SELECT trial, i, class, sum((label = class AND prediction = class)::INT) AS tp, sum((label <> class AND prediction = class)::INT) AS fp,
                       sum((label = class AND prediction <> class)::INT) AS fn FROM told, (VALUES (0), (1)) AS k(class) GROUP BY trial, i, class),
    f1 AS (SELECT trial, i, avg(2 * tp / (2 * tp + fp + fn)) AS f1 FROM classes GROUP BY trial, i),
    trials AS (SELECT trial, list(f1 ORDER BY i) AS fold_scores, avg(f1) AS score FROM f1 GROUP BY trial),
    best AS (SELECT trial FROM trials ORDER BY round(score, 12) DESC, trial LIMIT 1)"""


def followed_search(spark, folder):
    model = cl.logistic(solver="newton")
    return search.Search(model, {"clf": model}, two_features(spark, folder), 3, parallelism=3).grid(C_GRID)


@query("grid_scores", f"""WITH RECURSIVE {SQL_GRID}
    SELECT trial::INT AS trial, list_transform(fold_scores, lambda v: round(v, 6)) AS fold_scores, round(score, 6) AS score,
        trial = (SELECT trial FROM best) AS best FROM trials""")
def grid_scores(spark, folder):
    """Macro-F1 of each setting on each fold, their mean, and which setting is taken."""
    found = followed_search(spark, folder)
    return found.table().select(
        "trial", F.transform("fold_scores", lambda v: F.round(v, 6)).alias("fold_scores"), F.round("score", 6).alias("score"),
        (F.col("trial") == found.best.number).alias("best"))


@query("cross_validated_scores", f"""WITH RECURSIVE {SQL_GRID}
    SELECT id, label, (c + x * a + y * b > 0)::INT AS prediction, round(1 / (1 + exp(-(c + x * a + y * b))), 6) AS score
    FROM fits JOIN f ON fold = i WHERE trial = 1""")
def cross_validated_scores(spark, folder):
    """Every row scored by the model that did not see its fold."""
    out = search.cross_val_predict(cl.logistic(C=1.0, solver="newton"), two_features(spark, folder), 3, parallelism=3)
    return out.select("id", "label", F.col("prediction").cast("int").alias("prediction"), F.round(vector_to_array("probability")[1], 6).alias("score"))


@query("refit_scores", f"""WITH RECURSIVE {SQL_GRID}
    SELECT id, label, round(1 / (1 + exp(-(c + x * a + y * b))), 6) AS score FROM f, fits WHERE i = 9 AND trial = (SELECT trial FROM best)""")
def refit_scores(spark, folder):
    """The best setting fitted on all rows."""
    found = followed_search(spark, folder)
    return found.refit().transform(found.rows).select("id", "label", F.round(vector_to_array("probability")[1], 6).alias("score"))


@query("narrowed_search", f"SELECT i::INT AS trial, 3 AS folds, true AS inside FROM range({2 * DRAWS}) AS r(i)")
def narrowed_search(spark, folder):
    """A second search in ranges shrunk around the best of the first; every draw lies inside its range."""
    found = _search(spark, folder).random(C_RANGE, DRAWS)
    space = search.narrowed(C_RANGE, found.best.settings)
    found.random(space, DRAWS, seed=43)
    ranges = [C_RANGE["clf__C"]] * DRAWS + [space["clf__C"]] * DRAWS
    inside = [r.low <= t.settings["clf__C"] <= r.high for r, t in zip(ranges, found.trials)]
    return found.table().select("trial", F.size("fold_scores").alias("folds"), F.get(F.array(*map(F.lit, inside)), "trial").alias("inside"))


@query("round_search", "SELECT i::INT AS trial, 3 AS folds, true AS narrower FROM range(8) AS r(i)")
def round_search(spark, folder):
    """Two rounds; the second one's draws are no further apart than its range, half of the first's."""
    import math

    found = _search(spark, folder).rounds(C_RANGE, rounds=2, per_round=4)
    logs = [math.log(t.settings["clf__C"]) for t in found.trials]
    width = (math.log(4.0) - math.log(1e-3)) / 2
    narrower = [True] * 4 + [max(logs[4:]) - min(logs[4:]) <= width + 1e-9] * 4
    return found.table().select("trial", F.size("fold_scores").alias("folds"), F.get(F.array(*map(F.lit, narrower)), "trial").alias("narrower"))


@query("refit_best", sql_answers(where="true"))
def refit_best(spark, folder):
    found = _search(spark, folder).grid({"clf__C": [0.1, 1.0]})
    return answers(found.refit().transform(found.rows))


@query("text_search", sql_trials(search.grid(TEXT_GRID), 2))
def text_search(spark, folder):
    """Search over vocabulary and classifier settings together: four settings, features fitted twice per fold."""
    rows = search.with_folds(text_rows(spark, folder), "id", 2)
    steps = vec.feature_steps(numeric=jobs.numeric_columns(rows), categorical=["category"], minDF=2.0)
    model = cl.logistic(max_iter=20)
    found = search.Search(model, {**steps, "clf": model}, rows, 2, parallelism=4, features=Pipeline(stages=list(steps.values())))
    return trials(found.grid(TEXT_GRID))


@query(
    "shuffled_column",
    "SELECT value, count(*) AS rows, true AS ids_kept, true AS moved FROM events GROUP BY value",
)
def shuffled_column(spark, folder):
    """A shuffled column holds the same values, and every row is still there once."""
    rows = event_reviews(spark, folder).select("id", "value")
    moved = ev.shuffled(rows, "id", "value", 3)
    whole = rows.agg(F.count("*"), F.sum("id")).first()
    same = tuple(moved.agg(F.count("*"), F.sum("id")).first()) == tuple(whole)
    stayed = moved.alias("m").join(rows.alias("r"), "id").agg(F.avg((F.col("m.value") == F.col("r.value")).cast("int"))).first()[0]
    return moved.groupBy("value").agg(F.count("*").alias("rows")).withColumns({"ids_kept": F.lit(same), "moved": F.lit(stayed < 0.5)})


REPEATS = 3
SQL_COPIES = "(0, 0, ''), " + ", ".join(f"({1 + i * REPEATS + r}, {42 + 31 * i + r}, '{c}')" for i, c in enumerate("ab") for r in range(REPEATS))


@query("permutation_importance_linear", f"""WITH e AS (
        SELECT event_id AS id, (value >= 50)::INT AS label, (value + event_id % 41) / 100 AS a, (event_id % 13) / 13 AS b FROM events),
    copies AS (SELECT * FROM (VALUES {SQL_COPIES}) AS v(copy, seed, col)),
    k AS (SELECT *, substr(md5(seed || ':' || id), 1, 15) AS key FROM e, copies),
    m AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN last_value(a) OVER whole ELSE lag(a) OVER w END AS ma,
                 CASE WHEN row_number() OVER w = 1 THEN last_value(b) OVER whole ELSE lag(b) OVER w END AS mb FROM k
          WINDOW w AS (PARTITION BY copy ORDER BY key, id),
                 whole AS (PARTITION BY copy ORDER BY key, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    p AS (SELECT copy, label, (2 * (CASE WHEN col = 'a' THEN ma ELSE a END) + 0.4 * (CASE WHEN col = 'b' THEN mb ELSE b END) >= 1.6)::INT AS prediction FROM m),
    classes AS (SELECT copy, class, sum((label = class AND prediction = class)::INT) AS tp, sum((label <> class AND prediction = class)::INT) AS fp,
                       sum((label = class AND prediction <> class)::INT) AS fn FROM p, (VALUES (0), (1)) AS c(class) GROUP BY copy, class),
    f AS (SELECT copy, avg(2 * tp / (2 * tp + fp + fn)) AS score FROM classes GROUP BY copy),
    lost AS (SELECT col, (SELECT score FROM f WHERE copy = 0) - score AS lost FROM f JOIN copies USING (copy) WHERE copy > 0)
    SELECT col AS feature, round(avg(lost), 6) AS importance_mean, round(stddev_pop(lost), 6) AS importance_std FROM lost GROUP BY col""")
def permutation_importance_linear(spark, folder):
    """A fixed linear score: what macro-F1 loses when a column is shuffled by hash, all copies in one pass."""
    rows = event_reviews(spark, folder).select(
        "id", (F.col("value") >= 50).cast("int").alias("label"), ((F.col("value") + F.col("id") % 41) / 100).alias("a"),
        (F.col("id") % 13 / 13).alias("b"))
    score = SQLTransformer(statement="SELECT *, CAST(2 * a + 0.4D * b >= 1.6D AS INT) AS prediction FROM __THIS__")
    out = ev.permutation_importance(score, rows, "id", ["a", "b"], ev.MacroF1Evaluator(), repeats=REPEATS)
    return out.withColumns({c: F.round(c, 6) for c in ("importance_mean", "importance_std")})


@query("permutation_importance")
def permutation_importance(spark, folder):
    rows = staged(
        event_reviews(spark, folder).select("id", (F.col("overall") > 2).cast("int").alias("label"), "value", F.hour("ts").alias("hour")),
        "importance",
    )
    stages = [vec.Standardise(inputCols=["value", "hour"], outputCol="features"), cl.logistic(max_iter=20)]
    rows = search.with_folds(rows, "id", 3)
    model = Pipeline(stages=stages).fit(rows.where("fold <> 0"))
    return ev.permutation_importance(model, rows.where("fold = 0"), "id", ["value", "hour"], ev.MacroF1Evaluator(), repeats=2)


def sql_centers(k: int) -> str:
    """c1, c2, ...: the lists of centers after each draw by squared distance."""
    key = "('0x' || substr(md5('{}:' || vec_id), 1, 15))::BIGINT"
    first = f"c1 AS (SELECT [arg_min(x, {key.format(42)})] AS c FROM x)"
    rest = (f"""c{j} AS (SELECT list_append(any_value(c), arg_min(x, -ln(({key.format(41 + j)} + 0.5) / 1152921504606846976.0) / far)) AS c
        FROM (SELECT x.*, c, power(list_min(list_transform(c, lambda m: list_distance(x, m))), 2) AS far FROM x, c{j - 1}) AS d WHERE far > 0)"""
            for j in range(2, k + 1))
    return ", ".join((first, *rest))


@query("kmeans_clusters", f"""WITH RECURSIVE x AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings), {sql_centers(10)},
    steps AS (
        SELECT 0 AS step, c FROM c10
        UNION ALL
        SELECT step + 1, list(center ORDER BY cluster) FROM (
            SELECT step, cluster, list(m ORDER BY dim) AS center FROM (
                SELECT step, cluster, dim, avg(v) AS m FROM (
                    SELECT step, cluster, unnest(x) AS v, generate_subscripts(x, 1) AS dim FROM (
                        SELECT step, x, list_position(far, list_min(far)) AS cluster FROM (
                            SELECT step, x, list_transform(c, lambda m: list_distance(x, m)) AS far FROM steps, x WHERE step < 20) AS a) AS b) AS e
                GROUP BY step, cluster, dim) AS f GROUP BY step, cluster) AS g GROUP BY step)
    SELECT cluster, label, count(*) AS rows FROM (
        SELECT label, (list_position(far, list_min(far)) - 1)::INT AS cluster FROM (
            SELECT label, list_transform(c, lambda m: list_distance(x, m)) AS far FROM steps, x WHERE step = 20) AS a) AS b GROUP BY ALL""")
def kmeans_clusters(spark, folder):
    """Cluster sizes against the known labels."""
    rows = staged(
        table(spark, folder, "embeddings").select(
            "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), "label"
        ),
        "embeddings",
    )
    clustered = clustering.kmeans(rows, 10, row_id="vec_id").transform(rows)
    return clustered.groupBy("cluster", "label").agg(F.count("*").alias("rows"))


@query("kmeans_text_quality")
def kmeans_text_quality(spark, folder):
    """K-means on text vectors, scored by silhouette and by Rand index against the category."""
    from revlens.sources.standin import document_reviews

    docs = spread(document_reviews(spark, folder), "id")
    tfidf = vec.Tfidf(minDF=5.0, maxDF=0.85, maxFeatures=300, outputCol="features").fit(docs)
    rows = staged(tfidf.transform(docs).select("id", "category", "features"), "text-vectors")
    clustered = clustering.kmeans(rows, 4).transform(rows)
    rand = metrics.rand_index(clustered, "cluster", "category").first()[0]
    return clustering.silhouette(clustered).withColumn("rand_index", F.lit(rand))


@query("oversampled_training", sql_answers())
def oversampled_training(spark, folder):
    """Training rows raised to equal classes instead of weighted."""
    rows = text_vectors(spark, folder)
    even = staged(split.oversample(rows.where("fold <> 0"), "id", "label"), "even")
    return answers(cl.logistic(balanced=False, max_iter=30).fit(even).transform(rows.where("fold = 0")))
