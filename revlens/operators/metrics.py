"""Evaluation tables over (label, prediction, score)."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from revlens.operators.labels import MAX_CLASSES
from revlens.session import pieces, staged

BUCKET_BYTES = 64 << 20


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, rows) for every pair of classes seen on either side, zeros included.

    Rows are counted map-side first; classes and pairs come from that small count table.
    """
    whole = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    counts = whole.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("rows")
    )
    each = counts.select(F.explode(F.array("label", "prediction")).alias("c")).where("c IS NOT NULL").distinct()
    found = each.limit(MAX_CLASSES + 1).agg(F.collect_list("c").alias("classes"))
    too_many = F.raise_error(F.lit(f"more than {MAX_CLASSES} values: not class columns"))
    classes = found.select(F.when(F.size("classes") <= MAX_CLASSES, F.col("classes")).otherwise(too_many).alias("classes"))
    pairs = classes.select("classes", F.explode("classes").alias("label")).select(
        "label", F.explode("classes").alias("prediction")
    )
    return pairs.join(counts, on=["label", "prediction"], how="left").na.fill(0, ["rows"])


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction", by: tuple[str, ...] = ()) -> DataFrame:
    """(class, tp, fp, fn, precision, recall, f1, support); what is undefined is 0. With `by`, for each group of rows.

    Rows without label or prediction belong to no class and are left out, as in `confusion_matrix`.
    """
    counts = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).groupBy(*by, F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("bigint")
    right = F.col("l") == F.col("p")

    def share(cls: str, tp: Column, fp: Column, fn: Column) -> Column:
        return F.struct(F.col(cls).alias("class"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))

    hit = F.when(right, F.col("n")).otherwise(zero)
    miss = F.when(right, zero).otherwise(F.col("n"))
    parts = counts.select(*by, F.inline(F.array(share("l", hit, zero, miss), share("p", zero, miss, zero))))
    sums = parts.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])

    def ratio(top: Column, bottom: Column) -> Column:
        return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
            "support": tp + fn,
        }
    )


def macro_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return per_class(df, label, prediction).agg(F.avg("f1").alias("macro_f1"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Macro-F1 and accuracy from one pass."""
    classes = per_class(df, label, prediction)
    return classes.agg(F.avg("f1").alias("macro_f1"), (F.sum("tp") / F.sum("support")).alias("accuracy"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(class, precision, recall, f1, support): one row per class, then accuracy, macro, weighted."""
    names = ("precision", "recall", "f1")
    total = F.sum("support").alias("support")
    rolled = per_class(df, label, prediction).rollup("class").agg(
        F.grouping("class").alias("_all"),
        *[F.avg(n).alias(f"macro_{n}") for n in names],
        *[(F.sum(F.col(n) * F.col("support")) / F.sum("support")).alias(f"weighted_{n}") for n in names],
        (F.sum("tp") / F.sum("support")).alias("_accuracy"),
        total,
    )

    def row(name: Column, values: list[Column]) -> Column:
        columns = [v.alias(n) for n, v in zip(names, values)]
        return F.struct(name.alias("class"), *columns, F.col("support"))

    def of(kind: str) -> list[Column]:
        return [F.col(f"{kind}_{n}") for n in names]

    single = F.array(row(F.col("class").cast("string"), of("macro")))
    summary = F.array(
        row(F.lit("accuracy"), [F.col("_accuracy")] * 3),
        row(F.lit("macro avg"), of("macro")),
        row(F.lit("weighted avg"), of("weighted")),
    )
    return rolled.select(F.inline(F.when(F.col("_all") == 1, summary).otherwise(single)))


def _running(df: DataFrame, label: str, score: str, groups: tuple[str, ...], buckets: int | None) -> DataFrame:
    """Per group and distinct score, highest first: positives and negatives at the score (`pos`,
    `neg`), before it (`pos_before`, `neg_before`), at the next lower score (`next_pos`,
    `next_neg`), and in the group (`all_pos`, `all_neg`).

    Ties are combined map-side. The distinct scores are cut at their quantiles into even buckets;
    running sums are taken inside each bucket and shifted by the sums of the higher buckets, so no
    task holds more than one bucket of one group however many distinct scores there are.
    """
    positive = F.col(label) == 1
    points = (
        df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull())
        .groupBy(*groups, F.col(score).cast("double").alias("score"))
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    )
    if buckets is None:
        buckets = pieces(points, BUCKET_BYTES, 16, 4096)
    points = staged(points, "scores")  # read three times below, and scoring rows may be dear
    cuts = points.approxQuantile("score", [i / buckets for i in range(1, buckets)], 0.25 / buckets)
    splits = [-float("inf"), *sorted(set(cuts) - {float("inf"), -float("inf")}), float("inf")]
    if len(splits) > 2:
        points = Bucketizer(splits=splits, inputCol="score", outputCol="_b").transform(points)
    else:
        points = points.withColumn("_b", F.lit(0.0))
    key = F.struct(*[F.col(g) for g in groups]) if groups else F.struct(F.lit(0).alias("all"))
    points = points.withColumn("_g", key)
    sums = points.groupBy("_g", "_b").agg(
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"),
        F.max_by(F.struct("pos", "neg"), "score").alias("_first"),
    )
    higher = W.partitionBy("_g").orderBy(F.desc("_b"))  # at most `buckets` rows per group
    upto = higher.rowsBetween(W.unboundedPreceding, W.currentRow)
    shifts = sums.select(
        "_g", "_b",
        (F.sum("_p").over(upto) - F.col("_p")).alias("_p0"),
        (F.sum("_n").over(upto) - F.col("_n")).alias("_n0"),
        F.sum("_p").over(W.partitionBy("_g")).alias("all_pos"),
        F.sum("_n").over(W.partitionBy("_g")).alias("all_neg"),
        F.lead("_first").over(higher).alias("_next"),
    )
    inside = W.partitionBy("_g", "_b").orderBy(F.desc("score"))
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    return points.join(shifts, on=["_g", "_b"]).select(
        *groups, "score", "pos", "neg", "all_pos", "all_neg",
        (F.col("_p0") + F.sum("pos").over(upto) - F.col("pos")).alias("pos_before"),
        (F.col("_n0") + F.sum("neg").over(upto) - F.col("neg")).alias("neg_before"),
        F.coalesce(F.lead("pos").over(inside), F.col("_next.pos")).alias("next_pos"),
        F.coalesce(F.lead("neg").over(inside), F.col("_next.neg")).alias("next_neg"),
    )


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", groups: tuple[str, ...] = (),
              drop_collinear: bool = False, buckets: int | None = None) -> DataFrame:
    """(fpr, tpr, threshold), with the origin at an infinite threshold; a rate of an empty class is NULL.

    Rows without label or score (NULL or NaN) have no place on the curve; `unscored` counts them.
    `drop_collinear` leaves out inner points on a straight line between their neighbours.
    """
    points = _running(df, label, score, groups, buckets)
    first = (F.col("pos_before") == 0) & (F.col("neg_before") == 0)
    last = F.col("next_pos").isNull()
    bends = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
    point = F.struct(
        F.try_divide(F.col("neg_before") + F.col("neg"), F.col("all_neg")).alias("fpr"),
        F.try_divide(F.col("pos_before") + F.col("pos"), F.col("all_pos")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = F.struct(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold"))
    none = F.array().cast("array<struct<fpr:double,tpr:double,threshold:double>>")
    kept = F.when(last | bends, F.array(point)).otherwise(none) if drop_collinear else F.array(point)
    with_origin = F.concat(F.when(first, F.array(origin)).otherwise(none), kept)
    return points.select(*groups, F.inline(with_origin))


def unscored(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(rows, unscored): how many rows a curve has no place for."""
    missing = F.col(label).isNull() | F.col(score).isNull() | F.isnan(F.col(score).cast("double"))
    return df.agg(F.count("*").alias("rows"), F.count_if(missing).alias("unscored"))


def auc(df: DataFrame, label: str = "label", score: str = "score", groups: tuple[str, ...] = (),
        out: str = "auc", buckets: int | None = None) -> DataFrame:
    """Area under the exact curve; a tie counts one half. NULL when a class is empty."""
    points = _running(df, label, score, groups, buckets)
    area = F.sum(F.col("neg") * (F.col("pos_before") + F.col("pos") / 2.0))
    pairs = F.max("all_pos") * F.max("all_neg")
    return points.groupBy(*groups).agg(F.try_divide(area, pairs).alias(out))


def one_vs_rest(df: DataFrame, label: str, probabilities: str, classes: list, out: str = "class") -> DataFrame:
    """One row per row and class: (class, label 0/1, score); `probabilities` follows `classes`."""
    entries = [
        F.struct(
            F.lit(c).alias(out),
            (F.col(label) == F.lit(c)).cast("int").alias("label"),
            F.col(probabilities)[i].alias("score"),
        )
        for i, c in enumerate(classes)
    ]
    return df.select(F.inline(F.array(*entries)))


def auc_per_class(df: DataFrame, label: str, probabilities: str, classes: list) -> DataFrame:
    return auc(one_vs_rest(df, label, probabilities, classes), groups=("class",))


def rand_index(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Share of row pairs on which two groupings agree, from group sizes alone; NULL below two rows."""

    def pairs(n: Column) -> Column:
        return F.sum(n * (n - 1) / 2)

    cells = df.groupBy(cluster, label).agg(F.count("*").cast("double").alias("n"))
    both = cells.agg(pairs(F.col("n")).alias("both"), F.sum("n").alias("rows"))
    one = cells.groupBy(cluster).agg(F.sum("n").alias("n")).agg(pairs(F.col("n"))).scalar()
    other = cells.groupBy(label).agg(F.sum("n").alias("n")).agg(pairs(F.col("n"))).scalar()
    every = F.col("rows") * (F.col("rows") - 1) / 2
    return both.select(F.try_divide(every + 2 * F.col("both") - one - other, every).alias("rand_index"))
