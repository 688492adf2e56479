"""Reading and writing: CSV, row ids, predictions, versions, metric and feature tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from revlens.operators import metrics
from revlens.plans import jobs
from revlens.plans.catalog import query
from revlens.plans.catalog.features import CORPUS, SQL_REVIEWS, sql_clean, sql_stateful, sql_stats
from revlens.plans.catalog.metrics import SQL_RATED, labelled, rated, sql_per_class
from revlens.session import planned_bytes, staged, staging_dir
from revlens.sources import reviews, sinks
from revlens.sources.standin import document_reviews, table


def fresh(spark, name: str) -> str:
    return f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"


def as_csv(df, path: str) -> None:
    df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)


@query(
    "csv_scan",
    'SELECT doc_id, text AS "reviewText", lang AS category, n_chars::DOUBLE AS vote FROM documents',
)
def csv_scan(spark, folder):
    """Documents written as quoted CSV with line breaks inside the text, and read back; undeclared types are inferred."""
    path = fresh(spark, "csv")
    as_csv(
        table(spark, folder, "documents").select(
            "doc_id", F.col("text").alias("reviewText"), F.col("lang").alias("category"), F.col("n_chars").alias("vote")
        ),
        path,
    )
    return reviews.read_csv(spark, path)


@query(
    "csv_blocks",
    """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, doc_id, text AS "reviewText", lang AS category, n_chars / 8.0 AS size,
        n_chars % 2 = 0 AS even, '2020-01-01'::TIMESTAMP + to_seconds(doc_id * 1000) AS "seenAt" FROM documents""",
)
def csv_blocks(spark, folder):
    """CSV cut into a dozen blocks, which may begin anywhere in a quoted text; numbers, flags and times by inference."""
    path = fresh(spark, "one-csv")
    seen = F.date_format(F.timestamp_seconds(F.lit(1577836800) + F.col("doc_id") * 1000), "yyyy-MM-dd HH:mm:ss")
    rows = table(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("reviewText"), F.col("lang").alias("category"), (F.col("n_chars") / 8).alias("size"),
        (F.col("n_chars") % 2 == 0).alias("even"), seen.alias("seenAt"))
    as_csv(rows.orderBy("doc_id"), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(1 << 16, planned_bytes(spark.read.text(path)) // 12)))
    try:
        return staged(reviews.read_csv(spark, path, row_id="id"), "csv-rows")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@query(
    "csv_scan_mixed_headers",
    """SELECT doc_id, CASE WHEN doc_id % 3 <> 2 THEN text END AS "reviewText",
        CASE WHEN doc_id % 3 <> 1 THEN lang END AS category FROM documents""",
)
def csv_scan_mixed_headers(spark, folder):
    """Files that hold other columns in another order, read as one table."""
    path = fresh(spark, "mixed")
    rows = table(spark, folder, "documents").select("doc_id", F.col("text").alias("reviewText"), F.col("lang").alias("category"))
    for rest, columns in enumerate((["doc_id", "reviewText", "category"], ["reviewText", "doc_id"], ["category", "doc_id"])):
        as_csv(rows.where(F.col("doc_id") % 3 == rest).select(*columns), f"{path}/{rest}")
    return reviews.read_csv(spark, f"{path}/*")


@query("row_ids", "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, doc_id FROM documents")
def row_ids(spark, folder):
    """Rows of several CSV files numbered in file order."""
    path = fresh(spark, "ordered")
    as_csv(table(spark, folder, "documents").select("doc_id", "text").orderBy("doc_id"), path)
    return reviews.with_row_id(reviews.read_csv(spark, path)).select("id", "doc_id")


@query(
    "prediction_file",
    "SELECT l.doc_id AS id, (n_chars >= 1000)::INT AS predicted FROM labels l JOIN documents d USING (doc_id)",
)
def prediction_file(spark, folder):
    path = fresh(spark, "predicted")
    sinks.write_predictions(labelled(spark, folder), path, "doc_id")
    return spark.read.schema("id bigint, predicted int").option("header", True).csv(path)


@query(
    "versioned_output",
    """SELECT v AS version, doc_id AS id, (n_chars >= 1000)::INT AS binary_split_1
    FROM labels JOIN documents USING (doc_id), (SELECT unnest([1, 2]) AS v)""",
)
def versioned_output(spark, folder):
    """Two writes of the same predictions end up in versions 1 and 2."""
    target = fresh(spark, "versions")
    rows = labelled(spark, folder)
    out = None
    for _ in range(2):
        path = sinks.write_versioned(rows, target, "submission_cutoff1", row_id="doc_id", name=sinks.split_name(1))
        read = spark.read.schema("id bigint, binary_split_1 int").option("header", True).csv(path)
        read = read.withColumn("version", F.lit(int(path.rsplit("_v", 1)[1])))
        out = read if out is None else out.unionByName(read)
    return out


@query(
    "metric_table",
    f"""WITH {SQL_RATED}, {sql_per_class('p')}
    SELECT 'rule' AS classifier, round(avg(f1), 6) AS macro_f1, round(sum(tp) / sum(support), 6) AS accuracy FROM per""",
)
def metric_table(spark, folder):
    path = fresh(spark, "metrics")
    scored = metrics.scores(rated(spark, folder)).select(
        F.lit("rule").alias("classifier"), F.round("macro_f1", 6).alias("macro_f1"), F.round("accuracy", 6).alias("accuracy")
    )
    sinks.write_metrics(scored, path)
    return spark.read.schema("classifier string, macro_f1 double, accuracy double").option("header", True).csv(path)


@query(
    "feature_tables",
    f"""
    WITH sides AS (SELECT *, CASE WHEN id % 5 = 0 THEN 'test' ELSE 'train' END AS side FROM {SQL_REVIEWS}),
    cleaned AS (SELECT id, {sql_clean('reviewText')} AS text FROM sides),
    stats AS (SELECT id, {sql_stats('text')} FROM cleaned),
    feel AS ({sql_stateful('(SELECT id, text FROM cleaned)', 'text', CORPUS)}),
    freq AS (SELECT id, side, count(*) OVER (PARTITION BY side, "reviewerID") AS reviewer_freq FROM sides)
    SELECT side, id, review_length, num_words, avg_word_length, reviewer_freq FROM freq JOIN stats USING (id)
    JOIN feel USING (id)""",
)
def feature_tables(spark, folder):
    """The feature job on both sides, written as tables and read back."""
    rows = document_reviews(spark, folder)
    train, test = jobs.feature_job(rows.where("id % 5 <> 0"), rows.where("id % 5 = 0"), fresh(spark, "processed"))
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.select(
        "side", "id", "review_length", "num_words", F.round("avg_word_length", 6).alias("avg_word_length"), "reviewer_freq"
    )
