from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens.operators import frequency, labels, profile, ranking, split
from revlens.schema import aligned, by_type, drop_columns, fill_and_default, require_label


def skewed(spark, n=3000):
    """A third of all rows in one group, some without a group."""
    rows = [(i, "hot" if i % 3 == 0 else None if i % 10 == 1 else f"k{i % 700}") for i in range(n)]
    return rows, spark.createDataFrame(rows, "id bigint, g string").repartition(5)


def test_ranked_numbers_every_group(spark):
    rows, df = skewed(spark)
    for bits in (0, 4, 14):
        out = ranking.ranked(df, "id", ("g",), 3, "r", "t", bits).collect()
        assert len(out) == len(rows)
        sizes = Counter(g for _, g in rows)
        for g in ("hot", None, "k2"):
            mine = [r for r in out if r["g"] == g]
            assert sorted(r["r"] for r in mine) == list(range(1, sizes[g] + 1))
            assert {r["t"] for r in mine} == {sizes[g]}


def test_ranks_do_not_depend_on_buckets_or_partitions(spark):
    _, df = skewed(spark)
    a = ranking.ranked(df, "id", ("g",), 3, "r", bits=0).orderBy("id").collect()
    b = ranking.ranked(df.repartition(2), "id", ("g",), 3, "r", bits=10).orderBy("id").collect()
    c = ranking.ranked(df, "id", ("g",), 4, "r", bits=10).orderBy("id").collect()
    assert a == b
    assert a != c


def test_folds_and_holdout(spark):
    _, df = skewed(spark)
    sizes = split.folds(df, "id", 5, "g").groupBy("g", "fold").count().groupBy("g").agg(
        (F.max("count") - F.min("count")).alias("gap"), F.count("*").alias("folds")
    ).collect()
    assert all(r["gap"] <= 1 for r in sizes)
    held = split.holdout(df, "id", "g").groupBy("g").agg(F.sum("is_test").alias("s"), F.count("*").alias("n")).collect()
    assert all(r["s"] == int(r["n"] * 0.2 + 0.5) for r in held)
    assert split.holdout(df, "id", None, 0.25).agg(F.sum("is_test")).first()[0] == 750


def test_resampling_evens_the_classes(spark):
    rows, df = skewed(spark, 400)
    df = df.where("g = 'hot' OR g IN ('k2', 'k4', 'k5', 'k7')")
    under = split.undersample(df, "id", "g").groupBy("g").count().collect()
    over = split.oversample(df, "id", "g")
    assert {r["count"] for r in under} == {1}
    assert {r["count"] for r in over.groupBy("g").count().collect()} == {134}
    assert over.select("id", "copy").distinct().count() == over.count()
    assert split.oversample(df, "id", "g", chunk=7).exceptAll(over).count() == 0
    assert over.select("id").distinct().count() == df.count()


def test_key_frequency(spark):
    rows, df = skewed(spark)
    sizes = Counter(g for _, g in rows)
    got = {r["id"]: r["n"] for r in frequency.key_frequency(df, "g", "n", "id").collect()}
    assert got == {i: 1 if g is None else sizes[g] for i, g in rows}
    plan = frequency.key_frequency(df, "g", "n")
    assert plan.columns == ["id", "g", "n"]
    assert frequency.key_frequency(df, "absent").first()["reviewer_freq"] == 1


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "label int")
    got = {(r["label"], round(r["class_weight"], 6)) for r in labels.add_class_weight(df, "label").collect()}
    assert got == {(0, 0.666667), (1, 2.0)}
    table = {(r["label"], round(r["weight"], 6)) for r in labels.balanced_weights(df, "label").collect()}
    assert table == got


def test_class_column_is_checked(spark, monkeypatch):
    monkeypatch.setattr(labels, "MAX_CLASSES", 10)
    with pytest.raises(ValueError):
        labels.class_counts(spark.range(20), "id")


def test_binary_labels(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,), (None,), (float("nan"),)], "overall double")
    got = [tuple(r)[1:] for r in labels.binary_labels(df).collect()]
    assert got == [(0, 0, 0, 0), (1, 1, 0, 0), (1, 1, 1, 1), (0, 0, 0, 0), (0, 0, 0, 0)]


def test_fill_and_default(spark):
    df = spark.createDataFrame([("3.5", True, None), (None, None, "b"), ("x", False, "c")], "vote string, verified boolean, category string")
    got = [(r["vote"], r["verified"], r["category"], r["summary"]) for r in fill_and_default(df).collect()]
    assert got == [(3.5, 1, "unknown", ""), (0.0, 0, "b", ""), (0.0, 0, "c", "")]


def test_shaping(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 1.0)], "n int, c string, label double")
    assert drop_columns(df, "c", "gone").columns == ["n", "label"]
    assert require_label(df, "label").count() == 1
    train, test = aligned(df, df.drop("c"), ["c", "gone", "n"], "label")
    assert train.columns == ["c", "n", "label"] and test.columns == ["n"]
    assert by_type(df) == (["n", "label"], ["c"])
    assert by_type(df, max_levels=1) == (["n", "label"], [])


def test_profile(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "id int, v double")
    got = {r["column_name"]: (r["data_type"], r["row_count"], r["non_null_count"], r["null_count"]) for r in profile.table_profile(df).collect()}
    assert got == {"id": ("int", 3, 3, 0), "v": ("double", 3, 1, 2)}
    assert profile.shape(df) == (3, 2)


def test_duplicates_keep_null_and_blank_apart(spark):
    df = spark.createDataFrame([(1, "", None), (2, None, ""), (3, "", None)], "id int, a string, b string")
    assert [(r["copies"], r["first_id"]) for r in profile.duplicates(df, ["a", "b"], "id").collect()] == [(2, 1)]


def test_skew_join_carries_all_columns(spark, monkeypatch):
    monkeypatch.setattr(frequency, "HOT_SHARE", 10)
    rows, df = skewed(spark)
    lookup = df.where("g IS NOT NULL AND g <> 'k4'").groupBy("g").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    out = frequency.skew_join(df, lookup, "g", "n", F.xxhash64("id")).select("id", "g", "found.n", "found.last").collect()
    want = {r["g"]: (r["n"], r["last"]) for r in lookup.collect()}
    assert len(out) == len(rows)
    assert all((r["n"], r["last"]) == want.get(r["g"], (None, None)) for r in out)


def test_rows_of_hot_keys_are_spread_over_the_join(spark, monkeypatch):
    """A third of the rows has one key and a third has none: no task gets all of either, also where only some entries are wanted."""
    monkeypatch.setattr(frequency, "HOT_SHARE", 10)
    df = spark.range(30_000).select("id", F.expr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN 'k' || id END").alias("g"))
    counts = df.where("g IS NOT NULL").groupBy("g").agg(F.count("*").alias("n"))
    flags = counts.where("g <> 'k1'").select("g", F.lit(True).alias("kept"))
    lookup = counts.join(flags, "g", "left")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(kept, ("false", "-1", "8")):
            spark.conf.set(k, v)
        out = frequency.skew_join(df, lookup, "g", "n", F.xxhash64("id"))
        sizes = [r["count"] for r in out.where("found.kept OR g IS NULL").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and sum(sizes) == 29_999 and max(sizes) < 6_000
        assert out.where("g = 'hot' AND found.n = 10000").count() == 10_000 and out.where("found IS NULL").count() == 10_000
        some = frequency.skew_join(df, lookup, "g", "n", F.xxhash64("id"), F.expr("g <> 'k1'"))
        assert {r["g"] for r in some.where("g IS NOT NULL AND found IS NULL").collect()} == {"k1"}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
