"""Labels, profiles, frequencies, weights, splits and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.operators import frequency, labels, profile, split
from revlens.plans.catalog import query
from revlens.schema import fill_and_default as fill
from revlens.schema import aligned, by_type, drop_columns, ensure_columns, require_label
from revlens.sources.standin import event_reviews, table

RATING = "least(5, 1 + floor(value / 25))::INT"
KEY = "CAST('0x' || substr(md5('{seed}:' || {id}), 1, 15) AS BIGINT)"


def key(c: str, seed: int = 42) -> str:
    return KEY.format(seed=seed, id=c)


@query(
    "binary_labels",
    f"""WITH r AS (SELECT event_id AS id, CASE WHEN event_id % 11 <> 0 THEN {RATING} END AS overall FROM events)
    SELECT id, overall, coalesce(overall > 1, false)::INT AS binary_label_cutoff_1,
        coalesce(overall > 2, false)::INT AS binary_label_cutoff_2,
        coalesce(overall > 3, false)::INT AS binary_label_cutoff_3,
        coalesce(overall > 4, false)::INT AS binary_label_cutoff_4 FROM r""",
)
def binary_labels(spark, folder):
    rated = event_reviews(spark, folder).select("id", F.when(F.col("id") % 11 != 0, F.col("overall")).alias("overall"))
    return labels.binary_labels(rated)


@query(
    "fill_and_default",
    f"""SELECT event_id AS id, coalesce(CASE WHEN event_id % 5 <> 0 THEN event_type END, 'unknown') AS category,
        coalesce(CASE WHEN event_id % 3 <> 0 THEN value END, 0) AS vote, 0 AS verified, '' AS summary,
        '' AS "reviewText"
    FROM events WHERE event_id % 11 <> 0""",
)
def fill_and_default(spark, folder):
    """Rows without a rating go, missing values and missing columns get their defaults."""
    rows = event_reviews(spark, folder).select(
        "id",
        F.when(F.col("id") % 11 != 0, F.col("overall")).alias("overall"),
        F.when(F.col("id") % 5 != 0, F.col("category")).alias("category"),
        F.when(F.col("id") % 3 == 1, F.col("value")).when(F.col("id") % 3 == 2, F.col("value"))
        .otherwise(F.when(F.col("id") % 2 == 0, F.lit(float("nan")))).alias("vote"),
    )
    return fill(require_label(rows, "overall")).drop("overall")


@query(
    "reviewer_freq",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE n2 END AS reviewer_freq
    FROM (SELECT o_orderkey, count(CASE WHEN o_orderkey % 13 <> 0 THEN 1 END) OVER (PARTITION BY o_custkey) AS n2
          FROM orders)""",
)
def reviewer_freq(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey")).alias("reviewerID"),
    )
    return frequency.key_frequency(rows, "reviewerID", row_id="id").select("id", "reviewer_freq")


@query(
    "reviewer_freq_hot_keys",
    """SELECT l_returnflag, l_linestatus, count(*) AS reviews, max(n) AS reviewer_freq
    FROM (SELECT l_returnflag, l_linestatus, count(*) OVER (PARTITION BY l_returnflag || l_linestatus) AS n
          FROM lineitem) GROUP BY ALL""",
)
def reviewer_freq_hot_keys(spark, folder):
    """Few keys that hold a third of all rows each."""
    rows = table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", F.concat("l_returnflag", "l_linestatus").alias("reviewerID"),
        "l_orderkey", "l_linenumber",
    )
    counted = frequency.key_frequency(rows, "reviewerID")
    return counted.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("reviews"), F.max("reviewer_freq").alias("reviewer_freq")
    )


@query(
    "reviewer_freq_train_test",
    """WITH sides AS (SELECT event_id AS id, user_id, CASE WHEN event_id % 5 = 0 THEN 'test' ELSE 'train' END AS side
                     FROM events)
    SELECT id, side, count(*) OVER (PARTITION BY side, user_id) AS reviewer_freq FROM sides""",
)
def reviewer_freq_train_test(spark, folder):
    rows = event_reviews(spark, folder).select("id", "reviewerID")
    train, test = frequency.frequency_per_side(rows.where("id % 5 <> 0"), rows.where("id % 5 = 0"))
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.select("id", "side", "reviewer_freq")


def sql_profile(source: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS row_count,"
        f" count({c}) AS non_null_count, count(*) - count({c}) AS null_count FROM {source}"
        for c, t in columns.items()
    )


@query(
    "table_profile",
    sql_profile(
        "documents", {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
    ),
)
def table_profile(spark, folder):
    return profile.table_profile(table(spark, folder, "documents"))


@query(
    "table_profile_missing",
    sql_profile(
        "(SELECT event_id AS id, CASE WHEN event_id % 3 <> 0 THEN value END AS vote,"
        " CASE WHEN event_id % 5 <> 0 THEN event_type END AS category FROM events)",
        {"id": "bigint", "vote": "double", "category": "string"},
    ),
)
def table_profile_missing(spark, folder):
    rows = event_reviews(spark, folder).select(
        "id",
        F.when(F.col("id") % 3 != 0, F.col("value")).when(F.col("id") % 2 == 0, F.lit(float("nan"))).alias("vote"),
        F.when(F.col("id") % 5 != 0, F.col("category")).alias("category"),
    )
    return profile.table_profile(rows)


@query("head_rows", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def head_rows(spark, folder):
    return profile.head(table(spark, folder, "documents").select("doc_id", "lang", "n_chars"), "doc_id")


@query(
    "rating_histogram",
    "SELECT ceil(l_quantity / 10)::INT AS overall, count(*) AS rows FROM lineitem GROUP BY 1",
)
def rating_histogram(spark, folder):
    rated = table(spark, folder, "lineitem").select(F.ceil(F.col("l_quantity") / 10).cast("int").alias("overall"))
    return profile.histogram(rated, "overall")


@query(
    "category_histogram",
    """SELECT category, count(*) AS rows FROM (
        SELECT CASE WHEN p_partkey % 9 <> 0 THEN p_type END AS category FROM part) WHERE category IS NOT NULL
    GROUP BY 1""",
)
def category_histogram(spark, folder):
    parts = table(spark, folder, "part").select(F.when(F.col("p_partkey") % 9 != 0, F.col("p_type")).alias("category"))
    return profile.histogram(parts, "category", nulls=False)


@query(
    "class_distribution",
    " UNION ALL ".join(
        f"""SELECT 'binary_label_cutoff_{c}' AS label, class, count(*) AS rows,
            round(count(*) / sum(count(*)) OVER (), 6) AS share
        FROM (SELECT (ceil(l_quantity / 10) > {c})::INT AS class FROM lineitem) GROUP BY class"""
        for c in (1, 2, 3, 4)
    ),
)
def class_distribution(spark, folder):
    rated = table(spark, folder, "lineitem").select(F.ceil(F.col("l_quantity") / 10).cast("int").alias("overall"))
    names = [labels.label_name(c) for c in labels.CUTOFFS]
    out = profile.label_distributions(labels.binary_labels(rated), names)
    return out.withColumn("share", F.round("share", 6))


@query(
    "duplicate_texts",
    """SELECT sha256(text) AS digest, count(*) AS copies, min(doc_id) AS first_id FROM documents
    GROUP BY text HAVING count(*) > 1""",
)
def duplicate_texts(spark, folder):
    return profile.duplicates(table(spark, folder, "documents"), ["text"], "doc_id")


@query(
    "duplicate_rows",
    """SELECT count(*) AS copies, min(o_orderkey) AS first_id FROM orders
    GROUP BY o_custkey, o_orderstatus HAVING count(*) > 1""",
)
def duplicate_rows(spark, folder):
    found = profile.duplicates(table(spark, folder, "orders"), ["o_custkey", "o_orderstatus"], "o_orderkey")
    return found.drop("digest")


@query(
    "train_test_class_compare",
    f"""WITH r AS (SELECT event_id AS id, {RATING} AS class FROM events),
    train AS (SELECT class, count(*) AS n FROM r WHERE id % 5 <> 0 GROUP BY 1),
    test AS (SELECT class, count(*) AS n FROM r WHERE id % 5 = 0 GROUP BY 1)
    SELECT class, coalesce(a.n, 0) AS train_rows, coalesce(round(a.n / (SELECT sum(n) FROM train), 6), 0) AS train_share,
        coalesce(b.n, 0) AS test_rows, coalesce(round(b.n / (SELECT sum(n) FROM test), 6), 0) AS test_share
    FROM train a FULL JOIN test b USING (class)""",
)
def train_test_class_compare(spark, folder):
    rated = event_reviews(spark, folder).select("id", "overall")
    test = rated.where("id % 5 = 0")
    out = profile.compare_distributions(rated.where("id % 5 <> 0"), test, "overall")
    return out.withColumns({c: F.round(c, 6) for c in ("train_share", "test_share")})


@query(
    "class_weights",
    f"""WITH c AS (SELECT {RATING} AS overall, count(*) AS class_count FROM events GROUP BY 1)
    SELECT overall, class_count,
        round((SELECT sum(class_count) FROM c) / ((SELECT count(*) FROM c) * class_count), 6) AS weight FROM c""",
)
def class_weights(spark, folder):
    out = labels.balanced_weights(event_reviews(spark, folder), "overall")
    return out.withColumn("weight", F.round("weight", 6))


@query(
    "weighted_rows",
    """WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1)
    SELECT doc_id, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 6) AS class_weight
    FROM labels JOIN c USING (quality)""",
)
def weighted_rows(spark, folder):
    weighted = labels.add_class_weight(table(spark, folder, "labels"), "quality")
    return weighted.select("doc_id", F.round("class_weight", 6).alias("class_weight"))


SQL_RANKED = f"""WITH r AS (
    SELECT event_id AS id, {RATING} AS overall,
        row_number() OVER (PARTITION BY {RATING} ORDER BY {key('event_id')}, event_id) AS n,
        count(*) OVER (PARTITION BY {RATING}) AS total FROM events)"""


@query("stratified_split", SQL_RANKED + "SELECT id, overall, (n <= floor(total * 0.2 + 0.5))::INT AS is_test FROM r")
def stratified_split(spark, folder):
    return split.holdout(event_reviews(spark, folder).select("id", "overall"), "id", "overall")


@query(
    "plain_split",
    f"""SELECT event_id AS id, (row_number() OVER (ORDER BY {key('event_id', 7)}, event_id)
        <= floor(count(*) OVER () * 0.25 + 0.5))::INT AS is_test FROM events""",
)
def plain_split(spark, folder):
    return split.holdout(event_reviews(spark, folder).select("id"), "id", None, 0.25, 7)


@query("stratified_folds", SQL_RANKED + "SELECT id, overall, ((n - 1) % 5)::INT AS fold FROM r")
def stratified_folds(spark, folder):
    return split.folds(event_reviews(spark, folder).select("id", "overall"), "id", 5, "overall")


@query("rebalance_under", SQL_RANKED + "SELECT id, overall FROM r WHERE n <= (SELECT min(total) FROM r)")
def rebalance_under(spark, folder):
    return split.undersample(event_reviews(spark, folder).select("id", "overall"), "id", "overall")


@query(
    "rebalance_over",
    SQL_RANKED + """, t AS (SELECT *, (SELECT max(total) FROM r) AS most FROM r),
    u AS (SELECT id, overall, most // total + (n <= most % total)::INT AS times FROM t)
    SELECT id, overall, unnest(range(times)) AS copy FROM u""",
)
def rebalance_over(spark, folder):
    return split.oversample(event_reviews(spark, folder).select("id", "overall"), "id", "overall")


@query(
    "rebalance_over_chunked",
    SQL_RANKED + """, t AS (SELECT *, (SELECT max(total) FROM r) AS most FROM r),
    u AS (SELECT id, overall, most // total + (n <= most % total)::INT AS times FROM t)
    SELECT id, overall, unnest(range(times)) AS copy FROM u""",
)
def rebalance_over_chunked(spark, folder):
    """The same with single-row chunks: every repetition may move to another task."""
    return split.oversample(event_reviews(spark, folder).select("id", "overall"), "id", "overall", chunk=1)


@query(
    "column_slices",
    """SELECT o_orderkey AS id, o_totalprice AS vote, o_orderpriority AS category, 0.0::DOUBLE AS absent,
        (o_orderkey % 2)::INT AS label FROM orders""",
)
def column_slices(spark, folder):
    """Unused columns dropped, missing ones added, wanted ones kept in order."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").alias("vote"), F.lit("x").alias("style"), (F.col("o_orderkey") % 2).cast("int").alias("label"),
    )
    rows = ensure_columns(drop_columns(orders, "style", "image"), {"absent": 0.0})
    numeric, categorical = by_type(rows, ignore=("id", "label"))
    train, _ = aligned(rows, rows.drop("label"), ["id", *numeric, *categorical, "asin"], "label")
    return train


@query(
    "feature_blocks",
    """SELECT d.doc_id AS id, n_chars, (d.doc_id % 2 = 0)::INT AS block, quality, toxic
    FROM documents d LEFT JOIN labels USING (doc_id)""",
)
def feature_blocks(spark, folder):
    """Row blocks stacked by name, then column blocks joined by id; unmatched rows stay."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    even = docs.where("id % 2 = 0").withColumn("block", F.lit(1))
    odd = docs.where("id % 2 <> 0").select(F.lit(0).alias("block"), "n_chars", "id")
    labels_block = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), "quality", "toxic")
    return even.unionByName(odd).join(labels_block, "id", "left")
