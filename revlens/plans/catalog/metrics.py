"""Evaluation tables on predictions that a simple rule makes from the given tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from revlens.ml.clustering import silhouette as silhouette_of
from revlens.operators import metrics
from revlens.plans.catalog import query
from revlens.sources.standin import event_reviews, table

SQL_LABELLED = """p AS (
    SELECT l.doc_id, quality AS label, (n_chars >= 1000)::INT AS prediction, n_chars::DOUBLE AS score
    FROM labels l JOIN documents d USING (doc_id))"""

SQL_RATED = """p AS (
    SELECT event_id AS id, least(5, 1 + floor(value / 25))::INT AS label,
        least(5, 1 + floor((value + event_id % 17) / 27))::INT AS prediction, value FROM events)"""


def labelled(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    return table(spark, folder, "labels").join(docs, "doc_id").select(
        "doc_id",
        F.col("quality").alias("label"),
        (F.col("n_chars") >= 1000).cast("int").alias("prediction"),
        F.col("n_chars").cast("double").alias("score"),
    )


def rated(spark, folder):
    guess = F.floor((F.col("value") + F.col("id") % 17) / 27)
    return event_reviews(spark, folder).select(
        "id", F.col("overall").alias("label"),
        F.least(F.lit(5), (1 + guess).cast("int")).alias("prediction"), "value",
    )


def sql_per_class(source: str) -> str:
    return f"""classes AS (SELECT label AS class FROM {source} UNION SELECT prediction FROM {source}),
    sums AS (
        SELECT class, sum((label = class AND prediction = class)::INT) AS tp,
            sum((label <> class AND prediction = class)::INT) AS fp,
            sum((label = class AND prediction <> class)::INT) AS fn
        FROM classes, {source} GROUP BY class),
    per AS (
        SELECT class, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
            CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
            CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
            tp + fn AS support, tp
        FROM sums)"""


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(
    "confusion_matrix",
    f"""WITH {SQL_RATED}, c AS (SELECT label AS v FROM p UNION SELECT prediction FROM p)
    SELECT a.v AS label, b.v AS prediction,
        (SELECT count(*) FROM p WHERE p.label = a.v AND p.prediction = b.v) AS rows FROM c a, c b""",
)
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(rated(spark, folder))


@query("macro_f1", f"WITH {SQL_RATED}, {sql_per_class('p')} SELECT round(avg(f1), 6) AS macro_f1 FROM per")
def macro_f1(spark, folder):
    return rounded(metrics.macro_f1(rated(spark, folder)), "macro_f1")


SQL_HOLES = f"""{SQL_RATED.replace('p AS', 'every AS', 1)}, p AS (
    SELECT * FROM (SELECT id, CASE WHEN id % 7 <> 0 THEN label END AS label, CASE WHEN id % 11 <> 0 THEN prediction END AS prediction
                   FROM every) AS h WHERE label IS NOT NULL AND prediction IS NOT NULL)"""


@query("macro_f1_null_labels", f"WITH {SQL_HOLES}, {sql_per_class('p')} SELECT round(avg(f1), 6) AS macro_f1 FROM per")
def macro_f1_null_labels(spark, folder):
    """Rows without label or prediction belong to no class."""
    holes = rated(spark, folder).withColumns({
        "label": F.when(F.col("id") % 7 != 0, F.col("label")), "prediction": F.when(F.col("id") % 11 != 0, F.col("prediction"))})
    return rounded(metrics.macro_f1(holes), "macro_f1")


@query("macro_f1_binary", f"WITH {SQL_LABELLED}, {sql_per_class('p')} SELECT round(avg(f1), 6) AS macro_f1 FROM per")
def macro_f1_binary(spark, folder):
    return rounded(metrics.macro_f1(labelled(spark, folder)), "macro_f1")


@query("accuracy", f"WITH {SQL_RATED} SELECT round(avg((label = prediction)::INT), 6) AS accuracy FROM p")
def accuracy(spark, folder):
    return rounded(metrics.accuracy(rated(spark, folder)), "accuracy")


@query(
    "classification_report",
    f"""WITH {SQL_RATED}, {sql_per_class('p')}, report AS (
        SELECT class::VARCHAR AS class, precision, recall, f1, support FROM per
        UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support),
            sum(support) FROM per
        UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per
        UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
            sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM per)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
        support::BIGINT AS support FROM report""",
)
def classification_report(spark, folder):
    return rounded(metrics.classification_report(rated(spark, folder)), "precision", "recall", "f1")


def sql_roc(source: str) -> str:
    return f"""points AS (
        SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM {source} GROUP BY score),
    curve AS (
        SELECT score, pos, neg, sum(pos) OVER o AS cp, sum(neg) OVER o AS cn,
            (SELECT sum(pos) FROM points) AS ap, (SELECT sum(neg) FROM points) AS an,
            lead(pos) OVER (ORDER BY score DESC) AS np, lead(neg) OVER (ORDER BY score DESC) AS nn
        FROM points WINDOW o AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


SQL_SCORED = "p AS (SELECT event_id, value AS score, (event_type IN ('click', 'purchase'))::INT AS label FROM events)"


def scored(spark, folder):
    return event_reviews(spark, folder).select(
        "id", F.col("value").alias("score"), F.col("category").isin("click", "purchase").cast("int").alias("label")
    )


@query(
    "roc_curve",
    f"""WITH {SQL_SCORED}, {sql_roc('p')}
    SELECT round(cn / an, 6) AS fpr, round(cp / ap, 6) AS tpr, score AS threshold FROM curve
    UNION ALL SELECT 0, 0, 'infinity'::DOUBLE""",
)
def roc_curve(spark, folder):
    return rounded(metrics.roc_curve(scored(spark, folder)), "fpr", "tpr")


@query(
    "roc_curve_one_class",
    """WITH p AS (SELECT value AS score FROM events WHERE event_type IN ('click', 'purchase')),
    c AS (SELECT score, count(*) AS pos FROM p GROUP BY 1)
    SELECT NULL::DOUBLE AS fpr, round(sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) / (SELECT sum(pos) FROM c), 6) AS tpr,
        score AS threshold FROM c
    UNION ALL SELECT 0, 0, 'infinity'::DOUBLE""",
)
def roc_curve_one_class(spark, folder):
    """Without negatives there is no false positive rate."""
    return rounded(metrics.roc_curve(scored(spark, folder).where("label = 1")), "fpr", "tpr")


@query(
    "roc_curve_bends",
    f"""WITH {SQL_SCORED}, {sql_roc('p')}
    SELECT round(cn / an, 6) AS fpr, round(cp / ap, 6) AS tpr, score AS threshold FROM curve
    WHERE np IS NULL OR np <> pos OR nn <> neg
    UNION ALL SELECT 0, 0, 'infinity'::DOUBLE""",
)
def roc_curve_bends(spark, folder):
    return rounded(metrics.roc_curve(scored(spark, folder), drop_collinear=True), "fpr", "tpr")


SQL_AUC = """SELECT round((sum(CASE WHEN label = 1 THEN r END) - max(np) * (max(np) + 1) / 2.0)
        / (max(np) * max(nn)), 6) AS auc"""


@query(
    "auc",
    f"""WITH {SQL_SCORED}, ranks AS (
        SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r,
            sum(label) OVER () AS np, sum(1 - label) OVER () AS nn FROM p)
    {SQL_AUC} FROM ranks""",
)
def auc(spark, folder):
    return rounded(metrics.auc(scored(spark, folder)), "auc")


@query(
    "auc_labelled",
    f"""WITH {SQL_LABELLED}, ranks AS (
        SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r,
            sum(label) OVER () AS np, sum(1 - label) OVER () AS nn FROM p)
    {SQL_AUC} FROM ranks""",
)
def auc_labelled(spark, folder):
    return rounded(metrics.auc(labelled(spark, folder)), "auc")


@query(
    "ovr_auc",
    f"""WITH {SQL_RATED},
    long AS (
        SELECT class, (label = class)::INT AS label, round(1 / (1 + abs(value / 30 + 1 - class)), 4) AS score
        FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS class)),
    ranks AS (
        SELECT class, label,
            rank() OVER (PARTITION BY class ORDER BY score)
                + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0 AS r,
            sum(label) OVER (PARTITION BY class) AS np, sum(1 - label) OVER (PARTITION BY class) AS nn FROM long)
    {SQL_AUC}, class FROM ranks GROUP BY class""",
)
def ovr_auc(spark, folder):
    classes = [1, 2, 3, 4, 5]
    near = [F.round(1 / (1 + F.abs(F.col("value") / 30 + 1 - c)), 4) for c in classes]
    rows = rated(spark, folder).withColumn("probability", F.array(*near))
    return rounded(metrics.auc_per_class(rows, "label", "probability", classes), "auc")


@query(
    "rand_index",
    """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
    c AS (SELECT label, max_by(i, (v, -i))::INT AS cluster FROM x GROUP BY vec_id, label),
    n AS (SELECT cluster, label, count(*) AS n FROM c GROUP BY ALL),
    a AS (SELECT sum(n * (n - 1) / 2) AS v FROM n),
    b AS (SELECT sum(s * (s - 1) / 2) AS v FROM (SELECT sum(n) AS s FROM n GROUP BY cluster)),
    d AS (SELECT sum(s * (s - 1) / 2) AS v FROM (SELECT sum(n) AS s FROM n GROUP BY label)),
    t AS (SELECT sum(n) * (sum(n) - 1) / 2 AS v FROM n)
    SELECT round((t.v + 2 * a.v - b.v - d.v) / t.v, 6) AS rand_index FROM a, b, d, t""",
)
def rand_index(spark, folder):
    """Vectors grouped by their largest element."""
    largest = F.array_position("embedding", F.array_max("embedding")).cast("int")
    rows = table(spark, folder, "embeddings").select("label", largest.alias("cluster"))
    return rounded(metrics.rand_index(rows, "cluster", "label"), "rand_index")


@query(
    "silhouette",
    """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i
                  FROM embeddings),
    norm AS (SELECT vec_id, label, sum(v * v) AS q FROM x GROUP BY ALL),
    total AS (SELECT label, count(*) AS n, sum(q) AS q FROM norm GROUP BY label),
    centre AS (SELECT label, i, sum(v) AS s FROM x GROUP BY ALL),
    dots AS (SELECT x.vec_id, x.label AS own, c.label AS other, sum(x.v * c.s) AS d
             FROM x JOIN centre c USING (i) GROUP BY ALL),
    dist AS (
        SELECT d.vec_id, own, other, n,
            (n * norm.q + total.q - 2 * d.d) / CASE WHEN own = other THEN greatest(n - 1, 1) ELSE n END AS m
        FROM dots d JOIN norm USING (vec_id) JOIN total ON total.label = d.other),
    ab AS (SELECT vec_id, max(CASE WHEN own = other THEN m END) AS a, max(CASE WHEN own = other THEN n END) AS own_n,
                  min(CASE WHEN own <> other THEN m END) AS b FROM dist GROUP BY vec_id)
    SELECT round(avg(CASE WHEN own_n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6)
        AS silhouette FROM ab""",
)
def silhouette(spark, folder):
    """Squared Euclidean silhouette of the given vectors under their labels."""
    rows = table(spark, folder, "embeddings").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), F.col("label").alias("cluster")
    )
    return rounded(silhouette_of(rows), "silhouette")
