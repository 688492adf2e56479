"""What the planner makes of the queries: no products of tables, no Python in feature code, narrow scans."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry

FEATURES = [
    "clean_text_documents", "text_stats", "preprocess_reviews", "combined_text", "numeric_from_text",
    "review_time_features", "review_time_all_or_nothing", "lenient_dates", "sentiment_stateful_corpus",
    "sentiment_window2_corpus", "review_features_by_category", "term_counts", "vocabulary",
]
TABLES = [
    "reviewer_freq", "reviewer_freq_train_test", "binary_labels", "class_distribution", "duplicate_texts", "class_weights",
    "stratified_split", "stratified_folds", "rebalance_under", "rebalance_over", "train_test_class_compare",
    "confusion_matrix", "macro_f1", "classification_report", "roc_curve", "auc", "ovr_auc", "rand_index",
]


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def plans(spark, folder):
    return {n: plan(entry.queries()[n](spark, folder)) for n in FEATURES + TABLES}


@pytest.mark.parametrize("name", FEATURES + TABLES)
def test_no_products_and_no_python(plans, name):
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython|MapInPandas|FlatMapGroups", plans[name])


@pytest.mark.parametrize("name", ["clean_text_documents", "text_stats", "sentiment_stateful_corpus", "term_counts"])
def test_row_wise_features_shuffle_at_most_to_fill_the_cores(plans, name):
    exchanges = re.findall(r"Arguments: (.*), plan_id|Arguments: (.*partitioning.*)", plans[name])
    assert all("REPARTITION_BY_NUM" in "".join(e) for e in exchanges)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("text_stats", {"doc_id", "text"}),
        ("reviewer_freq", {"o_orderkey", "o_custkey"}),
        ("duplicate_texts", {"doc_id", "text"}),
        ("class_weights", {"value"}),
        ("stratified_folds", {"event_id", "value"}),
    ],
)
def test_scans_read_only_what_is_used(plans, name, columns):
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plans[name])
    read = {c.split(":")[0] for s in schemas for c in s.split(",") if c}
    assert read == columns


def test_fits_open_only_the_files_of_their_folds(spark):
    """Folds are partitions, written by one job: a fit that leaves one out and its evaluation prune the others' files."""
    from pyspark.ml.linalg import Vectors

    from revlens.ml import search
    from revlens.plans import jobs

    rows = spark.createDataFrame([(i, i % 2, Vectors.dense([i % 7])) for i in range(60)], ["id", "label", "features"])
    for folded, fold in ((search.with_folds(rows, "id", 3), "fold"), (jobs.stack(folds=3)._prepare(rows), "_fold")):
        assert {f.rsplit("/", 2)[1] for f in folded.inputFiles()} == {f"{fold}={i}" for i in range(3)}
        for condition in (f"{fold} <> 1", f"{fold} = 1"):
            text = plan(folded.where(condition).select("features"))
            assert re.search(rf"PartitionFilters: \[[^\]]*{fold}", text) and "Filter (" not in text
        assert folded.where(f"{fold} = 1").count() == 20 and folded.columns[-1] == fold


def test_norms_are_taken_in_the_row(spark, folder):
    text = plan(entry.queries()["tfidf_all_terms"](spark, folder))
    assert "Window" not in text and "collect_list" in text
