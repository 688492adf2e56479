"""The three whole jobs: features, stacked training, search."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from revlens.ml import classifiers as cl
from revlens.ml.search import Search, cross_val_predict, with_folds
from revlens.ml.stacking import Stacking
from revlens.ml.vectorize import Tfidf, feature_steps, param_map
from revlens.operators import metrics
from revlens.operators.labels import above
from revlens.operators.preprocess import review_features
from revlens.schema import UNUSED, drop_columns
from revlens.session import spread, staged
from revlens.sources.sinks import write_processed

# Numeric inputs of the models, and known good settings for cutoff 1.
NUMERIC = [
    "vote", "verified", "review_length", "num_words", "avg_word_length", "uppercase_ratio",
    "exclamation_count", "reviewer_freq", "review_year", "review_month", "review_day",
    "review_dayofweek", "pos_count", "neg_count", "polarity_score",
]
BEST_CUTOFF_1 = {
    "final_estimator__C": 2.1368329072358727,
    "gb__learning_rate": 0.020589728197687916,
    "gb__max_depth": 5,
    "gb__n_estimators": 89,
    "lr__C": 0.005415244119402535,
    "rf__max_depth": None,  # no limit
    "rf__n_estimators": 107,
    "text__max_df": 0.85,
    "text__max_features": 5000,
    "text__min_df": 5.0,
    "text__max_ngram": 3,
}


def feature_job(train: DataFrame, test: DataFrame, folder: str, row_id: str = "id") -> tuple[DataFrame, DataFrame]:
    """Feature tables of both sides, written and read back; each side counts its own reviewers."""
    return (
        write_processed(review_features(spread(train, row_id), row_id), f"{folder}/processed_train"),
        write_processed(review_features(spread(test, row_id), row_id), f"{folder}/processed_test"),
    )


def model_rows(features: DataFrame, label=None, row_id: str = "id") -> DataFrame:
    """A feature table without the columns that no model reads; `label` is a column expression."""
    rows = drop_columns(features, *UNUSED)
    return rows if label is None else rows.withColumn("label", label)


def stack(classes: int = 2, folds: int = 3, row_id: str = "id", seed: int = 42, parallelism: int = 2,
          trees: int = 100, rounds: int = 100, depth: int | None = None, iterations: int = 100,
          validation_share: float = 0.0) -> Stacking:
    """Logistic regression, forest and boosting under a logistic regression.

    With `validation_share`, boosting sets that share of its rows aside and stops early.
    """
    return Stacking(
        bases={
            "lr": cl.logistic(multinomial=classes > 2, max_iter=iterations),
            "rf": cl.random_forest(n_estimators=trees, max_depth=depth, seed=seed),
            "gb": cl.gradient_boosting(n_estimators=rounds, classes=classes, seed=seed, row_id=row_id,
                                       validation_share=validation_share),
        },
        meta=cl.logistic(multinomial=classes > 2, max_iter=iterations),
        numFolds=folds, classes=classes, idCol=row_id, seed=seed, parallelism=parallelism,
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c in NUMERIC if c in df.columns]


def text_and_stack(rows: DataFrame, stacking: Stacking, text: str = "reviewText", categorical: tuple[str, ...] = ("category",),
                   **features) -> tuple[Pipeline, dict]:
    """The whole model and its named steps."""
    steps = feature_steps(
        text=text, numeric=numeric_columns(rows), categorical=[c for c in categorical if c in rows.columns], **features
    )
    return Pipeline(stages=[*steps.values(), stacking]), {**steps, **stacking.steps()}


def train_stacked(train: DataFrame, settings: dict | None = None, stacking: Stacking | None = None,
                  **features) -> PipelineModel:
    """Fit the stacked model on all rows of a feature table with a `label` column."""
    model, steps = text_and_stack(train, stacking or stack(), **features)
    chosen = BEST_CUTOFF_1 if settings is None else settings
    return model.copy(param_map(steps, chosen)).fit(train)


def predict_split(model: PipelineModel, test: DataFrame, row_id: str = "id") -> DataFrame:
    scored = model.transform(test)
    return scored.select(
        row_id, F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability").alias("probability")
    )


def stacked_cutoff_job(train: DataFrame, test: DataFrame, cutoff: int = 1, settings: dict | None = None,
                       stacking: Stacking | None = None, row_id: str = "id", **features) -> DataFrame:
    """Ratings table and unlabelled table in, (id, prediction, probability) of the latter out."""
    rows = staged(model_rows(review_features(train, row_id), above("overall", cutoff)), "train")
    model = train_stacked(rows, settings, stacking, **features)
    return predict_split(model, model_rows(review_features(test, row_id)), row_id)


def stacked_rating_job(train: DataFrame, test: DataFrame, settings: dict | None = None, classes: int = 5,
                       stacking: Stacking | None = None, row_id: str = "id", **features) -> DataFrame:
    """As `stacked_cutoff_job` for the ratings 1..K themselves, on text and summary together."""
    label = (F.col("overall") - 1).cast("int")
    rows = staged(model_rows(review_features(train, row_id, combined=True).where("overall IS NOT NULL"), label), "train")
    model = train_stacked(rows, settings or {}, stacking or stack(classes, 5, row_id), text="combined_text", **features)
    answers = predict_split(model, model_rows(review_features(test, row_id, combined=True)), row_id)
    return answers.withColumn("prediction", F.col("prediction") + 1)


# The small grids of the text experiment.
EXPERIMENT_GRIDS = {
    "logreg": {"clf__C": [0.1, 1.0, 10.0]},
    "rf": {"clf__n_estimators": [50, 100], "clf__max_depth": [cl.MAX_DEPTH, 10]},
    "gb": {"clf__n_estimators": [50, 100], "clf__learning_rate": [0.01, 0.1]},
}


def text_experiment(rows: DataFrame, classifier: str, text: str = "reviewText", k: int = 5, row_id: str = "id",
                    space: dict | None = None, seed: int = 42, parallelism: int = 2,
                    **tfidf) -> tuple[dict, dict[str, DataFrame]]:
    """TF-IDF and one classifier: best settings of a small grid, then evaluation tables of the
    out-of-fold predictions with them. `rows` has a 0/1 column `label`."""
    clf = cl.named(classifier, balanced=False)
    if space is None and classifier not in EXPERIMENT_GRIDS:
        raise ValueError(f"no grid for {classifier!r}")
    steps = {"tfidf": Tfidf(inputCol=text, outputCol="features", **tfidf), "clf": clf}
    folded = with_folds(rows.select(row_id, text, "label"), row_id, k, "label", seed)
    model = Pipeline(stages=list(steps.values()))
    found = Search(model, steps, folded, k, parallelism=parallelism).grid(space or EXPERIMENT_GRIDS[classifier])
    best = found.with_settings(found.best.settings)
    return found.best.settings, evaluation(cross_val_predict(best, folded, k, parallelism=parallelism))


def search_job(rows: DataFrame, space: dict, n: int, k: int = 5, rounds: int = 1, row_id: str = "id",
               stacking: Stacking | None = None, seed: int = 42, parallelism: int = 2, **features) -> Search:
    """Random search over a stacked model; more than one round narrows around the best so far.

    Features, vocabulary and scaling are fitted inside each fold.
    """
    folded = with_folds(rows, row_id, k, "label", seed)
    model, steps = text_and_stack(rows, stacking or stack(), **features)
    return Search(model, steps, folded, k, parallelism=parallelism).rounds(space, rounds, n, seed=seed)


def evaluation(predicted: DataFrame, classes: int = 2) -> dict[str, DataFrame]:
    """Confusion, report, scores and AUC of rows with label, prediction and probability."""
    answers = staged(predicted.select("label", "prediction", "probability"), "answers")
    rows = answers.withColumn("score", vector_to_array("probability")[1])
    tables = {
        "confusion": metrics.confusion_matrix(rows),
        "report": metrics.classification_report(rows),
        "scores": metrics.scores(rows),
    }
    if classes == 2:
        tables["roc"] = metrics.roc_curve(rows)
        tables["auc"] = metrics.auc(rows)
    else:
        arrays = rows.withColumn("probability", vector_to_array("probability"))
        tables["auc"] = metrics.auc_per_class(arrays, "label", "probability", list(range(classes)))
    return tables
