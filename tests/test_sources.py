import csv
import random

import pytest
from pyspark.sql import functions as F

from revlens.plans import jobs
from revlens.sources import csv_blocks, reviews, sinks

CSV = '''overall,verified,reviewTime,reviewerID,reviewText,summary,vote,extra
5.0,True,"06 3, 2014",A,"He said ""great"",
and left",ok,2.0,x
1.0,False,"06 4, 2014",B,,bad,,y
bad,,,,no rating,,many,
'''


def test_csv(spark, tmp_path):
    (tmp_path / "in.csv").write_text(CSV)
    rows = reviews.with_row_id(reviews.read_csv(spark, str(tmp_path / "in.csv"))).orderBy("id").collect()
    assert [r["id"] for r in rows] == [0, 1, 2]
    assert rows[0]["reviewText"] == 'He said "great",\nand left'
    assert [r["overall"] for r in rows] == [5.0, 1.0, None]
    assert [r["verified"] for r in rows] == [True, False, None]
    assert [r["vote"] for r in rows] == [2.0, None, None]
    assert rows[0]["extra"] == "x"


def test_row_ids_over_many_splits(spark, tmp_path):
    path = str(tmp_path / "numbers")
    spark.range(0, 5000, 1, 7).select("id", F.repeat(F.lit("x"), 200).alias("pad")).write.csv(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        out = reviews.with_row_id(spark.read.schema("v bigint, pad string").csv(path), "n")
        assert out.rdd.getNumPartitions() > 7
        assert out.where("n <> v").count() == 0 and out.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_versions(spark, tmp_path):
    folder = str(tmp_path / "out")
    df = spark.createDataFrame([(1, 0.0), (2, 1.0)], "id bigint, prediction double")
    assert sinks.versions(spark, folder, "s") == []
    assert sinks.write_versioned(df, folder, "s", name="binary_split_3").endswith("s_v1")
    (tmp_path / "out" / "s_v7.csv").write_text("")
    (tmp_path / "out" / "other_v9.csv").write_text("")
    target = sinks.write_versioned(df, folder, "s", name=sinks.split_name(3))
    assert target.endswith("s_v8") and sinks.versions(spark, folder, "s") == [1, 7, 8]
    back = spark.read.option("header", True).csv(target)
    assert back.columns == ["id", "binary_split_3"]
    assert sorted(tuple(r) for r in back.collect()) == [("1", "0"), ("2", "1")]


def test_outputs_are_never_replaced(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.0)], "id bigint, prediction double")
    sinks.write_predictions(df, str(tmp_path / "p"))
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        sinks.write_predictions(df, str(tmp_path / "p"))


def test_metric_table_is_sorted(spark, tmp_path):
    df = spark.createDataFrame([("a", 0.1), ("b", 0.9)], "classifier string, macro_f1 double")
    sinks.write_metrics(df, str(tmp_path / "m"))
    assert [r[0] for r in spark.read.option("header", True).csv(str(tmp_path / "m")).collect()] == ["b", "a"]


def review_rows(spark, n, seed):
    words = ["great", "love", "nice", "awful", "junk", "waste"]
    rows = []
    for i in range(n):
        good = (i * 7 + seed) % 3 > 0
        pick = words[:3] if good else words[3:]
        rows.append((i, 5.0 if good else 1.0, f"It is {pick[i % 3]} and {pick[(i + 1) % 3]} item{i % 4}!", "sum", f"r{i % 9}", "06 3, 2014", "toys" if i % 2 else None, True))
    return spark.createDataFrame(rows, "id bigint, overall double, reviewText string, summary string, reviewerID string, reviewTime string, category string, verified boolean")


def test_whole_jobs(spark, tmp_path):
    train, test = review_rows(spark, 120, 0), review_rows(spark, 30, 1)
    a, b = jobs.feature_job(train, test.drop("overall"), str(tmp_path))
    assert a.count() == 120 and "binary_label_cutoff_4" in a.columns and "binary_label_cutoff_4" not in b.columns
    assert {r[0] for r in b.select("reviewer_freq").collect()} <= {3, 4}
    stack = jobs.stack(folds=2, trees=3, rounds=2, depth=3, iterations=10, parallelism=4)
    settings = {**jobs.BEST_CUTOFF_1, "text__max_features": 50, "gb__n_estimators": 2, "rf__n_estimators": 3, "rf__max_depth": 4}
    out = jobs.stacked_cutoff_job(train, test.drop("overall"), 1, settings, stack)
    joined = out.join(test, "id")
    assert joined.count() == 30
    assert joined.where((F.col("overall") > 1).cast("int") == F.col("prediction")).count() >= 27


def test_search_job(spark):
    rows = review_rows(spark, 80, 0).withColumn("label", (F.col("overall") > 1).cast("int"))
    stack = jobs.stack(folds=2, trees=2, rounds=1, depth=2, iterations=5)
    found = jobs.search_job(rows, {"text__max_features": [10, 20]}, 1, k=2, stacking=stack, parallelism=2)
    assert len(found.trials) == 1 and found.best.score > 0.8


def test_rating_job(spark):
    train, test = review_rows(spark, 90, 0), review_rows(spark, 30, 1)
    train = train.withColumn("overall", F.when(F.col("id") % 30 == 0, None).otherwise(F.col("overall") / 2 + 0.5).cast("int"))
    stack = jobs.stack(classes=3, folds=2, trees=3, rounds=2, depth=3, iterations=10, parallelism=4)
    out = jobs.stacked_rating_job(train, test.drop("overall"), classes=3, stacking=stack)
    assert out.count() == 30 and {r[0] for r in out.select("prediction").distinct().collect()} == {1, 3}


def test_text_experiment(spark):
    rows = review_rows(spark, 80, 0).withColumn("label", (F.col("overall") > 1).cast("int"))
    settings, tables = jobs.text_experiment(rows, "logreg", k=2, parallelism=4)
    assert set(settings) == {"clf__C"} and tables["auc"].first()[0] > 0.95
    with pytest.raises(ValueError):
        jobs.text_experiment(rows, "nonsense")


def test_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("reviewText,summary\nt1,s1\n")
    (tmp_path / "b.csv").write_text("summary,reviewText\ns2,t2\n")
    (tmp_path / "c.csv").write_text("reviewText\nt3\n")
    rows = reviews.read_csv(spark, str(tmp_path / "*.csv")).select("reviewText", "summary").collect()
    assert sorted(map(tuple, rows), key=str) == [("t1", "s1"), ("t2", "s2"), ("t3", None)]


@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    for k, v in old.items():
        spark.conf.set(k, v)


FIELDS = ["plain", "", 'say "hi"', "two\nlines", "a,b", "\n\nblank\n", "x" * 150 + "\n" * 3, 'crlf\r\nin "it"', '"', "\n" * 400]


@pytest.mark.parametrize("line_end,header", [("\n", ["n", "reviewText", 'odd "name",x']), ("\r\n", ["n", "reviewText", "two\nlines"])])
def test_blocks_of_one_file(spark, tmp_path, small_blocks, line_end, header):
    """Blocks begin inside quoted texts, at line breaks and between records; one text is longer than a block."""
    rng = random.Random(len(line_end))
    rows = [[str(i), rng.choice(FIELDS), rng.choice(FIELDS[:-1])] for i in range(200)]
    path = tmp_path / "one.csv"
    with open(path, "w", newline="") as f:
        out = csv.writer(f, lineterminator=line_end)
        out.writerow(header)
        for row in rows:
            out.writerow(row)
            f.write(line_end if rng.random() < 0.1 else "")  # blank lines are no records
    small_blocks(path.stat().st_size // 11)
    assert csv_blocks.blocks(spark, str(path)).count() >= 10
    found = reviews.read_csv(spark, str(path), row_id="row")
    assert found.columns == ["row", *header] and dict(found.dtypes)["n"] == "bigint"
    got = sorted((r[0], r[1], r[2] or "", r[3] or "") for r in found.collect())
    assert got == [(i, int(r[0]), r[1], r[2]) for i, r in enumerate(rows)]
    # More blocks than may be broadcast: the lines are shuffled and put in order again.
    places = csv_blocks.blocks(spark, str(path))
    pieces = csv_blocks.records(spark, str(path), places, max_broadcast=0)
    whole = csv_blocks.records(spark, str(path), places)
    assert sorted(map(tuple, pieces.collect())) == sorted(map(tuple, whole.collect()))


def test_unclosed_quote_and_empty_files(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b\n1,x\n2,"never closed\n3,y\n')
    rows = reviews.read_csv(spark, str(tmp_path / "open.csv"), row_id="i").orderBy("i").collect()
    assert len(rows) == 2 and tuple(rows[0]) == (0, 1, "x")
    (tmp_path / "head.csv").write_text("a,b\n")
    assert reviews.read_csv(spark, str(tmp_path / "head.csv")).collect() == []
    (tmp_path / "none.csv").write_text("")
    assert reviews.read_csv(spark, str(tmp_path / "none.csv")).collect() == []


def test_inferred_types(spark, tmp_path):
    (tmp_path / "types.csv").write_text(
        "i,d,b,t,s,mixed,none,big\n1,1.5,true,2020-01-02,x,1,,12345678901234567890\n"
        "-2,1e-3,FALSE,2020-01-02 03:04:05,12,true,,1\n,3,,2020-01-02T03:04:05.5Z,,x,,\n")
    found = reviews.read_csv(spark, str(tmp_path / "types.csv"))
    assert dict(found.dtypes) == {"i": "bigint", "d": "double", "b": "boolean", "t": "timestamp", "s": "string",
                                  "mixed": "string", "none": "string", "big": "double"}
    assert [r["i"] for r in found.collect()] == [1, -2, None]
