import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from revlens.ml import pieces, vectorize as vec
from revlens.session import staged

TEXTS = ["the cat sat on the mat", "the dog", "a cat and a dog and a bird", "", "bird bird bird mat", "the the the"]


def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, reviewText string").repartition(3)


def by_hand(min_df, max_features, sublinear, binary, idf, norm):
    docs = [Counter(w for w in t.split() if len(w) > 1) for t in TEXTS]
    df = Counter(w for d in docs for w in d)
    tf = sum(docs, Counter())
    words = sorted((w for w in df if df[w] >= min_df), key=lambda w: (-tf[w], w))[:max_features or None]
    out = {}
    for i, d in enumerate(docs):
        weights = {}
        for w in words:
            if d[w]:
                v = 1.0 if binary else 1 + math.log(d[w]) if sublinear else float(d[w])
                weights[w] = v * (math.log((1 + len(docs)) / (1 + df[w])) + 1 if idf else 1)
        size = {"l2": math.sqrt(sum(v * v for v in weights.values())), "l1": sum(weights.values()), "none": 1.0}[norm]
        out.update({(i, w): v / size for w, v in weights.items()})
    return out


@pytest.mark.parametrize(
    "options",
    [
        dict(min_df=1, max_features=0, sublinear=False, binary=False, idf=True, norm="l2"),
        dict(min_df=2, max_features=3, sublinear=True, binary=False, idf=True, norm="l2"),
        dict(min_df=1, max_features=4, sublinear=False, binary=True, idf=False, norm="l1"),
        dict(min_df=2, max_features=0, sublinear=True, binary=False, idf=False, norm="none"),
    ],
)
def test_tfidf_in_both_forms(spark, options):
    settings = vec.Tfidf(
        minDF=float(options["min_df"]), maxFeatures=options["max_features"], sublinear=options["sublinear"],
        binary=options["binary"], useIdf=options["idf"], norm=options["norm"],
    )
    df = texts(spark)
    model = settings.fit(df)
    assert model.vocabulary_ == sorted(model.vocabulary_)
    want = by_hand(**options)
    for out in (model.long(df, "id"), vec.tfidf_table(df, "id", settings)):
        got = {(r["id"], r["term"]): r["weight"] for r in out.collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_row_norms_are_one_or_zero(spark):
    df = texts(spark)
    rows = vec.Tfidf(maxNgram=2).fit(df).transform(df).select(vector_to_array("tfidf").alias("v")).collect()
    assert sorted({round(float(np.linalg.norm(r["v"])), 9) for r in rows}) == [0.0, 1.0]


def test_share_limits(spark):
    kept = {r["term"] for r in vec.Tfidf(minDF=0.3, maxDF=0.4).vocabulary(texts(spark)).collect()}
    assert kept == {"cat", "dog", "mat", "bird"}


def test_no_term_left(spark):
    with pytest.raises(ValueError):
        vec.Tfidf(minDF=50.0).fit(texts(spark))


def test_stop_words_and_unseen_text(spark):
    model = vec.Tfidf(stopWords="english").fit(texts(spark))
    assert "the" not in model.vocabulary_ and "cat" in model.vocabulary_
    other = spark.createDataFrame([(1, "nothing known"), (2, None)], "id int, reviewText string")
    assert all(r["tfidf"].numNonzeros() == 0 for r in model.transform(other).collect())


@pytest.mark.parametrize("dense", [True, False])
def test_svd(spark, dense):
    rng = np.random.default_rng(4)
    x = rng.random((40, 7)) * (rng.random((40, 7)) < 0.4)
    x[3] = 0
    make = Vectors.dense if dense else (lambda r: Vectors.sparse(7, {i: v for i, v in enumerate(r) if v}))
    df = spark.createDataFrame([(i, make(list(r))) for i, r in enumerate(x)], ["id", "tfidf"]).repartition(3)
    model = vec.Svd(k=4).fit(df)
    assert np.allclose(model.v.T @ model.v, np.eye(4), atol=1e-8)
    assert np.allclose(model.singular_values, np.linalg.svd(x)[1][:4])
    assert all(c[np.abs(c).argmax()] > 0 for c in model.v.T)
    got = np.array([r["svd"].toArray() for r in model.transform(df).orderBy("id").collect()])
    assert np.allclose(got, x @ model.v)


def test_standardise(spark):
    rows = [(1.0, 5.0), (3.0, 5.0), (None, 5.0), (float("nan"), 5.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    model = vec.Standardise(inputCols=["a", "b"], sentimentWeight=2.0, weightedCols=["a"]).fit(df)
    got = np.array([r["numeric"].toArray() for r in model.transform(df).collect()])
    a = np.array([1.0, 3.0, 0.0, 0.0])
    assert np.allclose(got[:, 0], 2 * (a - a.mean()) / a.std())
    assert np.allclose(got[:, 1], 0)


def test_one_hot(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "category string")
    model = vec.OneHot().fit(train)
    assert model.levels == ["a", "b", "missing"]
    test = spark.createDataFrame([("a",), ("zzz",), (None,)], "category string")
    assert [r["levels"].toArray().tolist() for r in model.transform(test).collect()] == [[1, 0, 0], [0, 0, 0], [0, 0, 1]]


def test_column_transformer_and_addresses(spark):
    df = texts(spark).withColumns({"n": F.length("reviewText"), "category": F.lit("x"), "ignored": F.lit(1)})
    steps = vec.feature_steps(numeric=["n"], categorical=["category"], svd=2)
    model = Pipeline(stages=list(steps.values()))
    changed = model.copy(vec.param_map(steps, {"text__max_df": 0.4, "text__min_df": 2.0, "svd__n_components": 3, "num__sentiment_weight": 1.5}))
    fitted = changed.fit(df)
    assert fitted.stages[0].vocabulary_ == ["bird", "cat", "dog", "mat"]
    assert fitted.transform(df).first()["features"].size == 3 + 1 + 1
    assert model.fit(df).transform(df).first()["features"].size == 2 + 1 + 1
    with pytest.raises(ValueError):
        vec.param_map(steps, {"text__nonsense": 1})
    with pytest.raises(ValueError):
        vec.param_map(steps, {"nobody__C": 1})


def test_svd_of_many_terms(spark):
    """12,000 sparse columns and 170 components; leading values that fall like those of text are found to 1 %."""
    rng = np.random.default_rng(8)
    topics = np.zeros((60, 12_000))
    for t in topics:
        t[rng.choice(12_000, 40, replace=False)] = rng.random(40)
    rows = [((rng.random(60) ** 6) @ topics) * (rng.random(12_000) < 0.6) for _ in range(250)]
    df = spark.createDataFrame([(i, Vectors.sparse(12_000, np.flatnonzero(r).tolist(), r[r != 0].tolist())) for i, r in enumerate(rows)], ["id", "tfidf"])
    model = vec.Svd(k=170).fit(df.repartition(6))
    exact = np.linalg.svd(np.array(rows), compute_uv=False)
    assert np.allclose(model.v.T @ model.v, np.eye(170), atol=1e-9)
    assert np.abs(model.singular_values[:50] / exact[:50] - 1).max() < 0.01
    assert np.abs(model.singular_values / exact[:170] - 1).max() < 0.1
    scores = np.array([r["svd"].toArray() for r in model.transform(df).orderBy("id").collect()])
    assert np.allclose((scores ** 2).sum(0)[:50], exact[:50] ** 2, rtol=0.02)


def test_svd_edges(spark):
    mixed = [(0, Vectors.sparse(4, [1], [2.0])), (1, Vectors.dense([0.0, 2.0, 1.0, 0.0])), (2, Vectors.sparse(4, [], [])), (3, Vectors.sparse(4, [3], [1.0]))]
    df = spark.createDataFrame(mixed, ["id", "tfidf"])
    model = vec.Svd(k=9).fit(df)
    exact = np.linalg.svd(np.array([v.toArray() for _, v in mixed]), compute_uv=False)
    assert np.allclose(model.singular_values, np.r_[exact, np.zeros(4 - len(exact))], atol=1e-6)  # a zero from its square


@pytest.mark.parametrize("settings", [{}, {"maxNgram": 2, "sublinear": True, "norm": "l1"}, {"binary": True, "useIdf": False, "norm": "none"}])
def test_a_dictionary_table_gives_the_same_vectors(spark, settings):
    texts = [(i, t) for i, t in enumerate(["the cat sat", None, "", "the dog, the DOG", "a bird é", "unseen words"] * 3)]
    df = spark.createDataFrame(texts, "id bigint, reviewText string").withColumn("_hot", F.lit(1))
    fit_on = df.where("id <> 5")
    small, table = (vec.Tfidf(minDF=2.0, maxCollected=n, **settings).fit(fit_on) for n in (1000, 0))
    assert table.dictionary.orderBy("index").toPandas()["term"].tolist() == small.vocabulary_
    a, b = ({r["id"]: r["tfidf"] for r in m.transform(df).collect()} for m in (small, table))
    assert a.keys() == b.keys() and len(a) == 18
    for i, v in a.items():
        assert b[i].size == v.size and np.allclose(b[i].toArray(), v.toArray(), atol=1e-12)


def test_stop_words_of_the_sql_are_spark_s(spark):
    from pyspark.ml.feature import StopWordsRemover

    from revlens.plans.catalog.vectors import STOP_WORDS

    assert sorted(STOP_WORDS) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


def test_norm_is_taken_once_a_row(spark):
    """A long row: as a sum within the loop over entries the norm cost as many steps as entries squared."""
    import time

    n = 20_000
    rows = spark.createDataFrame([(1, " ".join(f"w{i:05d}" for i in range(n)))], "id int, reviewText string")
    model = vec.Tfidf(maxCollected=0, norm="l1").fit(rows)
    begin = time.time()
    found = model.long(rows, "id").agg(F.count("*"), F.sum("weight")).first()
    assert found[0] == n and abs(found[1] - 1) < 1e-9
    assert time.time() - begin < 20


def test_texts_are_counted_in_bounded_pieces(spark, folder, monkeypatch):
    """A text table beyond one piece a core is cut further: the terms of a larger piece don't fit a task's memory and are spilled."""
    from revlens.plans.catalog import vectors
    from revlens.session import planned_bytes

    size = planned_bytes(vectors.table(spark, folder, "documents").select("doc_id", "text", "lang", "source"))
    cores = spark.sparkContext.defaultParallelism
    assert vectors.docs(spark, folder).rdd.getNumPartitions() == cores
    monkeypatch.setattr(vectors, "TEXT_BYTES", size // (4 * cores))
    dealt = vectors.docs(spark, folder)
    assert dealt.rdd.getNumPartitions() >= 4 * cores
    assert dealt.count() == vectors.table(spark, folder, "documents").count()


ODD = ["The cat sat on the mat", "the the the dog", None, "", "...", "Ünï çat 42 猫猫 猫猫 cat", "the cat sat on the mat", "one",
       "cat " * 40 + "dog", "on the mat the cat sat"]


def odd_texts(spark):
    return spark.createDataFrame([(f"r{i}", t) for i, t in enumerate(ODD)], "id string, reviewText string").repartition(3, "id")


def counted_by_hand(most):
    """{term: {row: tf}} of the odd texts."""
    found = {}
    for i, text in enumerate(ODD):
        words = re.findall(r"\w{2,}", (text or "").lower())
        for n in range(1, most + 1):
            for at in range(len(words) - n + 1):
                term = " ".join(words[at:at + n])
                found.setdefault(term, Counter())[f"r{i}"] += 1
    return found


@pytest.mark.parametrize("size,bucket_bytes", [(3, 400), (12, 1000), (1 << 19, 8 << 20)])
def test_pieces_of_any_size_count_the_same(spark, monkeypatch, size, bucket_bytes):
    monkeypatch.setattr(pieces, "BUCKET_BYTES", bucket_bytes)
    settings, hand = vec.Tfidf(maxNgram=3), counted_by_hand(3)
    parts = staged(pieces.cut(odd_texts(spark), F.col("id"), settings.words(), size), "pieces")
    assert (pieces.n_buckets(parts, 3) > 1) == (bucket_bytes < 8 << 20)
    got = {r["term"]: (r["tf"], r["df"]) for r in pieces.counted(parts, 3).collect()}
    assert got == {t: (sum(rows.values()), len(rows)) for t, rows in hand.items()}
    plain = {"binary": False, "sublinear": False, "idf": False, "norm": "none"}
    dictionary = spark.createDataFrame([(t, len(rows), i) for i, (t, rows) in enumerate(sorted(hand.items())) if len(rows) > 1] + [("not there", 5, 9)],
                                       "term string, df bigint, index bigint")
    wanted = {(row, t): float(tf) for t, rows in hand.items() if len(rows) > 1 for row, tf in rows.items()}
    for answers in (pieces.answered(parts, 3, 2, 1e9), pieces.looked_up(parts, 3, dictionary)):
        out = pieces.weighted(parts, staged(answers, "answers"), 3, len(ODD), plain, "id").collect()
        assert len(out) == len(wanted) and {(r["id"], r["term"]): r["weight"] for r in out} == wanted


def test_terms_of_pieces_and_dictionary_hash_alike():
    words = pa.array(["cat", "猫猫", "dog"])
    codes = np.array([0, 1, 2, 0, 1], "i8")
    for _, _, terms, hashed in pieces.grams(codes, np.array([3, 2]), words, 3):
        assert pieces.term_hashes(terms).tolist() == hashed.tolist()


def shuffled_by(df):
    """The first key of each shuffle of the plan."""
    return set(re.findall(r"Exchange hashpartitioning\((\w+)#", df._jdf.queryExecution().executedPlan().toString()))


def test_dictionary_is_asked_by_pieces(spark):
    """No entry of a row is shuffled: only pieces and the answers to them are."""
    df = odd_texts(spark)
    model = vec.Tfidf(maxNgram=2, minDF=2.0, norm="none", useIdf=False, maxCollected=0).fit(df)
    out = model.long(df, "id")
    assert shuffled_by(out) == {"piece"}
    assert {(r["id"], r["term"]): r["weight"] for r in out.collect()} == {
        (row, t): float(tf) for t, rows in counted_by_hand(2).items() if len(rows) > 1 for row, tf in rows.items()}


def test_vectors_come_back_packed(spark, monkeypatch):
    """Rows without terms have empty vectors; the entries that are joined to the rows are compressed, not arrays of doubles."""
    df, seen, joined = odd_texts(spark), [], pieces.packed_rows
    monkeypatch.setattr(pieces, "packed_rows", lambda *args: seen.append(joined(*args)) or seen[-1])
    settings = dict(maxNgram=2, minDF=2.0, norm="l1")
    model = vec.Tfidf(maxCollected=0, **settings).fit(df)
    got = {r["id"]: r["tfidf"] for r in model.transform(df).collect()}
    want = {r["id"]: r["tfidf"] for r in vec.Tfidf(**settings).fit(df).transform(df).collect()}
    assert got.keys() == want.keys() and len(got) == len(ODD) and all(np.allclose(got[k].toArray(), want[k].toArray()) for k in want)
    assert got["r2"].numNonzeros() == 0 and [t for _, t in seen[0].dtypes] == ["bigint", "int", "binary"]
    assert seen[0].count() == sum(v.numNonzeros() > 0 for v in want.values())


@pytest.mark.parametrize("settings", [dict(sublinear=True), dict(maxNgram=2, minDF=2.0, maxDF=0.5, norm="l1"), dict(maxFeatures=3)])
def test_table_asks_by_pieces(spark, settings):
    """A vocabulary of any size: no entry of a row is shuffled."""
    df = odd_texts(spark)
    out = vec.tfidf_table(df, "id", vec.Tfidf(**settings), broadcast_rows=0)
    assert shuffled_by(out) == {"piece"}
    want = {(r["id"], r["term"]): r["weight"] for r in vec.Tfidf(**settings).fit(df).long(df, "id").collect()}
    assert {(r["id"], r["term"]): pytest.approx(r["weight"]) for r in out.collect()} == want
