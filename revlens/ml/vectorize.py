"""TF-IDF, truncated SVD, scaling and one-hot coding as fitted stages."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    OneHotEncoder,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from revlens.functions import text as tx
from revlens.ml import pieces
from revlens.operators.ranking import numbered
from revlens.session import constant_array, drop_staged, staged

MAX_TERMS = 1_000_000  # a vocabulary beyond this stays a table, joined to the rows' terms
MAX_LEVELS = 100_000


def _param(name: str, doc: str, convert) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=convert)


class TfidfParams(HasInputCol, HasOutputCol):
    maxNgram = _param("maxNgram", "n-grams of 1..maxNgram tokens", TypeConverters.toInt)
    minDF = _param("minDF", "least documents of a term; below 1 a share", TypeConverters.toFloat)
    maxDF = _param("maxDF", "most documents of a term; up to 1 a share", TypeConverters.toFloat)
    maxFeatures = _param("maxFeatures", "most frequent terms kept; 0 keeps all", TypeConverters.toInt)
    sublinear = _param("sublinear", "1 + ln(tf) instead of tf", TypeConverters.toBoolean)
    binary = _param("binary", "1 instead of tf", TypeConverters.toBoolean)
    useIdf = _param("useIdf", "weight by ln((1 + n) / (1 + df)) + 1", TypeConverters.toBoolean)
    norm = _param("norm", "l2, l1 or none", TypeConverters.toString)
    stopWords = _param("stopWords", "none, or a language with a stop word list", TypeConverters.toString)
    minTokenLength = _param("minTokenLength", "shortest token kept", TypeConverters.toInt)
    maxCollected = _param("maxCollected", "most terms that a model carries itself", TypeConverters.toInt)

    def _defaults(self):
        self._setDefault(
            maxNgram=1, minDF=1.0, maxDF=1.0, maxFeatures=0, sublinear=False, binary=False, useIdf=True,
            norm="l2", stopWords="none", minTokenLength=2, inputCol="reviewText", outputCol="tfidf", maxCollected=MAX_TERMS,
        )

    def words(self) -> Column:
        """The tokens of a row, less stop words."""
        words = tx.tokens(F.coalesce(F.col(self.getInputCol()), F.lit("")), self.getOrDefault("minTokenLength"))
        language = self.getOrDefault("stopWords")
        return tx.without_stop_words(words, [] if language == "none" else StopWordsRemover.loadDefaultStopWords(language))

    def terms(self) -> Column:
        """The n-grams of a row."""
        return tx.ngrams(self.words(), self.getOrDefault("maxNgram"))

    def cut(self, df: DataFrame, row_id: Column) -> DataFrame:
        """The rows' words in pieces, written once; no shuffle of the text stays behind."""
        return staged(pieces.cut(df, row_id, self.words()), "pieces", keep_shuffles=False)

    def weigh(self) -> dict:
        return {"binary": self.getOrDefault("binary"), "sublinear": self.getOrDefault("sublinear"),
                "idf": self.getOrDefault("useIdf"), "norm": self.getOrDefault("norm")}


def counted_terms(df: DataFrame, terms: Column) -> DataFrame:
    """(term, tf, df, n_docs) of every term.

    Terms are counted inside each row first and summed map-side, so the shuffle carries one row
    per term and task.
    """
    counted = df.select(F.inline(tx.term_counts(terms))).groupBy("term").agg(
        F.sum("tf").alias("tf"), F.count("*").alias("df")
    )
    return counted.withColumn("n_docs", df.agg(F.count("*")).scalar())


def counted_by_fold(df: DataFrame, terms: Column, fold: str) -> DataFrame:
    """(_fold, term, tf, df) of every term of each fold: counts without a fold are sums of these, without another pass over the texts."""
    return df.select(F.col(fold).alias("_fold"), F.inline(tx.term_counts(terms))).groupBy("_fold", "term").agg(
        F.sum("tf").alias("tf"), F.count("*").alias("df"))


def within_limits(min_df: float, max_df: float) -> Column:
    """Whether a counted term is inside the document limits."""
    least = F.lit(min_df) if min_df >= 1 else F.col("n_docs") * min_df
    most = F.col("n_docs") * max_df if max_df <= 1 else F.lit(max_df)
    return (F.col("df") >= least) & (F.col("df") <= most)


def kept_terms(counted: DataFrame, min_df: float = 1.0, max_df: float = 1.0, max_features: int = 0) -> DataFrame:
    """The terms inside the document limits; the most frequent ones, ties in order of the term."""
    out = counted.where(within_limits(min_df, max_df))
    return out.orderBy(F.desc("tf"), "term").limit(max_features) if max_features else out


def vocabulary(df: DataFrame, terms: Column, min_df: float = 1.0, max_df: float = 1.0,
               max_features: int = 0) -> DataFrame:
    """(term, tf, df, n_docs) of the kept terms."""
    return kept_terms(counted_terms(df, terms), min_df, max_df, max_features)


class Tfidf(Estimator, TfidfParams):
    """One vocabulary for the whole table; terms are indexed in alphabetical order.

    Up to `maxCollected` terms the model carries them. A larger vocabulary stays a table: terms get their
    index by range partitions, and rows are joined to it. Both give the same vectors.
    """

    @keyword_only
    def __init__(self, *, inputCol="reviewText", outputCol="tfidf", maxNgram=1, minDF=1.0, maxDF=1.0,
                 maxFeatures=0, sublinear=False, binary=False, useIdf=True, norm="l2",
                 stopWords="none", minTokenLength=2, maxCollected=MAX_TERMS):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def vocabulary(self, df: DataFrame) -> DataFrame:
        get = self.getOrDefault
        return vocabulary(df, self.terms(), get("minDF"), get("maxDF"), get("maxFeatures"))

    def _fit(self, df: DataFrame) -> TfidfModel | TfidfTableModel:
        if self.getOrDefault("maxFeatures"):
            return self._of(self.vocabulary(df))
        # Any number of terms may stay: pieces send each of theirs once, compressed.
        get, parts = self.getOrDefault, self.cut(df, F.lit(0))
        counted = pieces.counted(parts, get("maxNgram")).withColumn("n_docs", F.lit(df.count()).cast("bigint"))
        model = self._of(kept_terms(counted, get("minDF"), get("maxDF")))
        drop_staged(parts)
        return model

    def fit_counted(self, counted: DataFrame, n_docs: int) -> TfidfModel | TfidfTableModel:
        """As `fit` on a table of `n_docs` rows, from counts (term, tf, df) of parts that make up that table."""
        get = self.getOrDefault
        summed = counted.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
        summed = summed.withColumn("n_docs", F.lit(n_docs).cast("bigint"))
        return self._of(kept_terms(summed, get("minDF"), get("maxDF"), get("maxFeatures")))

    def _of(self, kept_: DataFrame) -> TfidfModel | TfidfTableModel:
        most = self.getOrDefault("maxCollected")
        terms = staged(kept_, "vocabulary", keep_shuffles=False)
        kept = terms.limit(most + 1).collect()
        if not kept:
            raise ValueError("no term is left: lower minDF or raise maxDF")
        if len(kept) > most:
            in_order = numbered(terms, "term", out="index")
            drop_staged(terms)
            dictionary = staged(in_order, "dictionary", codec="zstd")
            drop_staged(in_order)
            return self._copyValues(TfidfTableModel(dictionary))
        drop_staged(terms)
        kept.sort(key=lambda r: r["term"])
        n = kept[0]["n_docs"]
        idf = [float(np.log((1 + n) / (1 + r["df"])) + 1) for r in kept]
        return self._copyValues(TfidfModel([r["term"] for r in kept], idf))


def _sparse(size: Column, indices: Column, values: Column) -> Column:
    """A sparse vector from its parts.

    Arrays have no cast to a sparse vector, but the JSON reader fills one; that keeps the step in
    the JVM, and JSON carries doubles without loss.
    """
    parts = F.struct(F.lit(0).cast("byte").alias("type"), size.alias("size"), indices.alias("indices"), values.alias("values"))
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), schema)["v"]


def _sublinear(vector: Column) -> Column:
    """1 + ln of the stored values of a sparse vector."""
    parts = F.unwrap_udt(vector)
    return _sparse(parts["size"], parts["indices"], F.transform(parts["values"], lambda v: 1 + F.log(v)))


class TfidfModel(Model, TfidfParams):
    """Tokens to a sparse weighted vector, row by row."""

    def __init__(self, terms: list[str] | None = None, idf: list[float] | None = None):
        super().__init__()
        self._defaults()
        self.vocabulary_ = terms or []
        self.idf = idf or []
        self.counted: tuple[str, list[int]] | None = None

    def term_vectors(self, df: DataFrame, out: str, vocabulary_: list[str]) -> DataFrame:
        """Adds the rows' counts of the given terms, which follow from the text and not from the model's own terms."""
        words = f"{out}_words"
        count = CountVectorizerModel.from_vocabulary(vocabulary_, words, out)
        count.setBinary(self.getOrDefault("binary"))
        return count.transform(df.withColumn(words, self.terms())).drop(words)

    def on_counts(self, column: str, vocabulary_: list[str]) -> TfidfModel:
        """The same model reading the rows' counts of a larger, sorted vocabulary instead of their text."""
        place = {term: i for i, term in enumerate(vocabulary_)}
        that = self.copy()
        that.counted = column, [place[term] for term in self.vocabulary_]
        return that

    def _transform(self, df: DataFrame) -> DataFrame:
        get, out = self.getOrDefault, self.getOutputCol()
        raw, scaled = (f"_{out}_{s}" for s in ("raw", "scaled"))
        if self.counted:
            result = VectorSlicer(inputCol=self.counted[0], outputCol=raw, indices=self.counted[1]).transform(df)
        else:
            result = self.term_vectors(df, raw, self.vocabulary_)
        if get("sublinear") and not get("binary"):
            result = result.withColumn(raw, _sublinear(F.col(raw)))
        last = raw
        if get("useIdf"):
            product = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol=raw, outputCol=scaled)
            result, last = product.transform(result), scaled
        norm = get("norm")
        if norm == "none":
            result = result.withColumn(out, F.col(last))
        else:
            result = Normalizer(p={"l1": 1.0, "l2": 2.0}[norm], inputCol=last, outputCol=out).transform(result)
        return result.drop(raw, scaled)

    def long(self, df: DataFrame, row_id: str) -> DataFrame:
        """(row_id, term, weight) of the non-zero entries."""
        return entries(self.transform(df), row_id, self.getOutputCol(), self.vocabulary_)


class TfidfTableModel(Model, TfidfParams):
    """As `TfidfModel` with a dictionary of any size: (term, tf, df, n_docs, index), a written table.

    Rows are cut into pieces; each asks the dictionary for its different terms once and weighs its rows with the answers
    (`pieces`). A row has no more entries than different terms.
    """

    def __init__(self, dictionary: DataFrame | None = None):
        super().__init__()
        self._defaults()
        self.dictionary = dictionary

    def asked(self, df: DataFrame, row: str) -> tuple[DataFrame, DataFrame]:
        """The rows in pieces, and what the dictionary answers to them."""
        parts = self.cut(df, F.col(row))
        return parts, staged(pieces.looked_up(parts, self.getOrDefault("maxNgram"), self.dictionary), "answers", keep_shuffles=False)

    def _transform(self, df: DataFrame) -> DataFrame:
        # Written once: the rows are read for their terms and again for their other columns.
        keyed = staged(df.withColumn("_row", F.monotonically_increasing_id()), "tfidf-rows", codec="zstd", keep_shuffles=False)
        rows = pieces.packed_rows(*self.asked(keyed, "_row"), self.getOrDefault("maxNgram"), "_row")
        rows = rows.withColumnsRenamed({"n": "_n", "entries": "_entries"})
        parts = pieces.vector_parts(F.col("_n"), F.col("_entries"), self.dictionary.first()["n_docs"], self.weigh())
        vector = _sparse(F.lit(self.dictionary.count()), parts["indices"], parts["weights"])
        return keyed.join(rows, "_row", "left").select(*df.columns, vector.alias(self.getOutputCol()))

    def long(self, df: DataFrame, row_id: str) -> DataFrame:
        """(row_id, term, weight) of the non-zero entries; `row_id` is unique."""
        n_docs = self.dictionary.first()["n_docs"]
        return pieces.weighted(*self.asked(df, row_id), self.getOrDefault("maxNgram"), n_docs, self.weigh(), row_id)


def entries(df: DataFrame, row_id: str, vector: str, names: list[str], name: str = "term",
            value: str = "weight") -> DataFrame:
    """One row per stored entry of a sparse vector, with the entry's name."""
    parts = F.unwrap_udt(vector)
    pairs = df.select(row_id, F.explode(F.arrays_zip(parts["indices"].alias("i"), parts["values"].alias("v"))).alias("e"))
    return pairs.select(row_id, F.get(constant_array(names, "string"), F.col("e.i")).alias(name), F.col("e.v").alias(value))


def tfidf_table(df: DataFrame, row_id: str, settings: Tfidf, broadcast_rows: int = 100_000) -> DataFrame:
    """(row_id, term, weight) for a vocabulary of any size, with the settings of a `Tfidf`; `row_id` is unique.

    Pieces of rows send their different terms once; sums over all pieces come back and are the vocabulary, which is no table
    then. With `maxFeatures` the vocabulary is a table, written once; it is broadcast only when it is found to have at most
    `broadcast_rows` rows, and looked up by the pieces beyond that.
    """
    get, most = settings.getOrDefault, settings.getOrDefault("maxNgram")
    if get("maxFeatures"):
        kept = staged(settings.vocabulary(df), "vocabulary").select("term", "df", "n_docs")
        if kept.count() <= broadcast_rows:
            return weighted_terms(df.select(row_id, F.inline(tx.term_counts(settings.terms()))).join(F.broadcast(kept), "term"), row_id, settings)
        parts, n_docs = settings.cut(df, F.col(row_id)), kept.first()["n_docs"]
        answers = pieces.looked_up(parts, most, kept.withColumn("index", F.lit(0)))
    else:
        parts, n_docs = settings.cut(df, F.col(row_id)), df.count()
        least_df, most_df = get("minDF"), get("maxDF")
        limits = least_df if least_df >= 1 else n_docs * least_df, n_docs * most_df if most_df <= 1 else most_df
        answers = pieces.answered(parts, most, *limits)
    answers = staged(answers, "answers", keep_shuffles=False)
    return pieces.weighted(parts, answers, most, n_docs, settings.weigh(), row_id)


def weighted_terms(found: DataFrame, row_id: str, settings: Tfidf) -> DataFrame:
    """(row_id, term, weight) of (row_id, term, tf, df, n_docs), normed by row."""
    get, weight = settings.getOrDefault, F.col("tf").cast("double")
    if get("binary"):
        weight = F.lit(1.0)
    elif get("sublinear"):
        weight = 1 + F.log(weight)
    if get("useIdf"):
        weight = weight * (F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1)
    out = found.select(row_id, "term", weight.alias("weight"))
    if get("norm") == "none":
        return out
    # Put together by row, which needs no sort, normed in the row and exploded again.
    rows = out.groupBy(row_id).agg(F.collect_list(F.struct("term", "weight")).alias("entries")).withColumn("_norm", norm_of("entries", get("norm")))
    return rows.select(row_id, F.explode("entries").alias("e"), "_norm").select(row_id, "e.term", (F.col("e.weight") / F.col("_norm")).alias("weight"))


def norm_of(entries_: str, norm: str) -> Column:
    """The norm of a row's entries, an array of structs with a weight."""
    def total(of) -> Column:
        return F.aggregate(entries_, F.lit(0.0), lambda s, e: s + of(e["weight"]))

    return {"l1": total(F.abs), "l2": F.sqrt(total(lambda w: w * w)), "none": F.lit(1.0)}[norm]


def hashed_counts(df: DataFrame, text: str, features: int = 1 << 18, out: str = "hashed", min_length: int = 2) -> DataFrame:
    """Term counts at hashed positions: no vocabulary, no pass over the data before."""
    words = tx.tokens(F.coalesce(F.col(text), F.lit("")), min_length)
    stage = HashingTF(inputCol="_words", outputCol=out, numFeatures=features)
    return stage.transform(df.withColumn("_words", words)).drop("_words")


class Svd(Estimator, HasInputCol, HasOutputCol):
    """Uncentred truncated SVD by a random range finder: scores of a row are its vector times V.

    A block of k + `oversample` random directions goes through A^T A `passes` times, a pass over the staged rows each, with
    a QR between them; the last pass gives the small matrix whose eigenvectors turn the block to V. It ends earlier once the
    k eigenvalues change by less than `tolerance`, relatively. A task and the driver hold features x block numbers
    (12,000 terms and k = 170: 17 MB), whatever the number of rows; only features that a task met are sent. When the block spans
    all features one pass is exact. Each column of V is turned so that its entry of largest magnitude is positive.
    """

    k = _param("k", "number of components", TypeConverters.toInt)
    oversample = _param("oversample", "directions beyond k", TypeConverters.toInt)
    passes = _param("passes", "most passes over the rows", TypeConverters.toInt)
    tolerance = _param("tolerance", "relative change of the eigenvalues at which it ends", TypeConverters.toFloat)
    seed = _param("seed", "of the random directions", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="tfidf", outputCol="svd", k=100, oversample=10, passes=6, tolerance=1e-6, seed=42):
        super().__init__()
        self._setDefault(inputCol="tfidf", outputCol="svd", k=100, oversample=10, passes=6, tolerance=1e-6, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> SvdModel:
        get = self.getOrDefault
        rows = staged(df.select(F.unwrap_udt(self.getInputCol()).alias("v")).select("v.size", "v.indices", "v.values"), "svd-rows")
        n = rows.agg(F.max(F.coalesce("size", F.size("values")))).first()[0] or 0
        k = min(get("k"), n)
        width = min(n, k + get("oversample"))
        q = np.linalg.qr(np.random.default_rng(get("seed")).standard_normal((n, width)))[0]
        before = np.full(k, np.inf)
        for _ in range(max(1, get("passes"))):
            z = _products(rows, q)
            small = q.T @ z
            values, turn = np.linalg.eigh((small + small.T) / 2)
            values, turn = np.maximum(values[::-1], 0), turn[:, ::-1]
            v = q @ turn[:, :k]
            if width == n or np.all(np.abs(values[:k] - before) <= get("tolerance") * values[:k]):
                break
            before, q = values[:k], np.linalg.qr(z)[0]
        drop_staged(rows)
        top = np.abs(v).argmax(axis=0) if n else np.zeros(0, int)
        return self._copyValues(SvdModel(v * np.sign(v[top, np.arange(v.shape[1])]), np.sqrt(values[:k])))


def _products(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """A^T (A Q) of rows (size, indices, values): each task sums its rows, Spark sums the tasks' features."""
    shared = rows.sparkSession.sparkContext.broadcast(q)

    def partial(batches):
        block = shared.value
        total, met = np.zeros_like(block), np.zeros(len(block), bool)
        for batch in batches:
            dense = batch["indices"].isna()
            if dense.any():
                x = np.vstack(batch["values"][dense].to_list())
                total[: x.shape[1]] += x.T @ (x @ block[: x.shape[1]])
                met[: x.shape[1]] = True
            for at, values in zip(batch["indices"][~dense], batch["values"][~dense]):
                if len(at):
                    total[at] += np.outer(values, values @ block[at])
                    met[at] = True
        found = np.flatnonzero(met)
        for at in range(0, len(found), 1024):
            part = found[at:at + 1024]
            yield pd.DataFrame({"feature": part.astype("i4"), "sums": list(total[part])})

    parts = rows.mapInPandas(partial, "feature int, sums array<double>").withColumn("sums", array_to_vector("sums"))
    out = np.zeros_like(q)
    for r in parts.groupBy("feature").agg(Summarizer.sum(F.col("sums")).alias("sums")).toLocalIterator():
        out[r["feature"]] = r["sums"].toArray()
    shared.unpersist()
    return out


def placed(indices: pa.ListArray, values: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of all stored entries of Arrow vectors; a dense one has no indices."""
    lengths = values.value_lengths().to_numpy(zero_copy_only=False).astype("i8")
    rows = np.repeat(np.arange(len(values)), lengths)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    sparse = ~indices.is_null().to_numpy(zero_copy_only=False)
    if sparse.any():
        at[sparse[rows]] = indices.flatten().to_numpy(zero_copy_only=False)
    return rows, at, values.flatten().to_numpy(zero_copy_only=False)


class SvdModel(Model, HasInputCol, HasOutputCol):
    k, oversample, passes, tolerance, seed = Svd.k, Svd.oversample, Svd.passes, Svd.tolerance, Svd.seed

    def __init__(self, v=None, singular_values=None):
        super().__init__()
        self._setDefault(inputCol="tfidf", outputCol="svd", k=100)
        self.v, self.singular_values = v, singular_values

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(self.v))

        @F.pandas_udf("array<double>")
        def project(parts: pd.DataFrame) -> pd.Series:
            v = shared.value
            if parts["indices"].isna().any():
                dense = [
                    np.asarray(val) if idx is None else np.bincount(idx, val, v.shape[0])
                    for idx, val in zip(parts["indices"], parts["values"])
                ]
                return pd.Series(list(np.vstack(dense) @ v))
            scores = np.zeros((len(parts), v.shape[1]))
            pairs = zip(parts["indices"], parts["values"])
            for at, (rows, values) in enumerate(pairs):  # one row's products at a time
                if len(rows):
                    scores[at] = values @ v[rows]
            return pd.Series(list(scores))

        return df.withColumn(self.getOutputCol(), array_to_vector(project(F.unwrap_udt(self.getInputCol()))))


class Standardise(Estimator, HasInputCols, HasOutputCol):
    """(x - mean) / population deviation of numeric columns, missing values first set to a constant.

    `weights` multiplies named columns after scaling: before it a constant factor would cancel out.
    """

    fill = _param("fill", "value for NULL and NaN", TypeConverters.toFloat)
    withMean = _param("withMean", "subtract the mean", TypeConverters.toBoolean)
    sentimentWeight = _param("sentimentWeight", "factor of the weighted columns", TypeConverters.toFloat)
    weightedCols = _param("weightedCols", "columns that get the factor", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol="numeric", fill=0.0, withMean=True, sentimentWeight=1.0,
                 weightedCols=()):
        super().__init__()
        self._setDefault(outputCol="numeric", fill=0.0, withMean=True, sentimentWeight=1.0, weightedCols=[])
        self._set(**{k: list(v) if k == "weightedCols" else v for k, v in self._input_kwargs.items()})

    def filled(self, c: str) -> Column:
        value = F.col(c).cast("double")
        return F.when(value.isNull() | F.isnan(value), F.lit(self.getOrDefault("fill"))).otherwise(value)

    def _fit(self, df: DataFrame) -> StandardiseModel:
        names = self.getInputCols()
        aggregates = []
        for i, c in enumerate(names):
            aggregates += [F.avg(self.filled(c)).alias(f"m{i}"), F.stddev_pop(self.filled(c)).alias(f"s{i}")]
        row = df.agg(*aggregates).first()
        mean = [row[f"m{i}"] or 0.0 for i in range(len(names))]
        return self._copyValues(StandardiseModel(mean, [row[f"s{i}"] or 1.0 for i in range(len(names))]))


class StandardiseModel(Model, HasInputCols, HasOutputCol):
    fill, withMean = Standardise.fill, Standardise.withMean
    sentimentWeight, weightedCols = Standardise.sentimentWeight, Standardise.weightedCols

    def __init__(self, mean=None, deviation=None):
        super().__init__()
        self._setDefault(outputCol="numeric", fill=0.0, withMean=True, sentimentWeight=1.0, weightedCols=[])
        self.mean, self.deviation = mean, deviation

    def scaled(self) -> dict[str, Column]:
        """The scaled columns by name."""
        get = self.getOrDefault
        out = {}
        for c, mean, deviation in zip(self.getInputCols(), self.mean, self.deviation):
            value = Standardise.filled(self, c)
            value = (value - F.lit(mean if get("withMean") else 0.0)) / F.lit(deviation)
            out[c] = value * F.lit(get("sentimentWeight")) if c in get("weightedCols") else value
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), array_to_vector(F.array(*self.scaled().values())))


class OneHot(Estimator, HasInputCol, HasOutputCol):
    """All levels in alphabetical order; a missing value is the level `missing`, an unseen one zeros."""

    missing = _param("missing", "level of a missing value", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol="category", outputCol="levels", missing="missing"):
        super().__init__()
        self._setDefault(inputCol="category", outputCol="levels", missing="missing")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> OneHotModel:
        source, index = f"_{self.getOutputCol()}_text", f"_{self.getOutputCol()}_index"
        filled = df.select(F.coalesce(F.col(self.getInputCol()).cast("string"), F.lit(self.getOrDefault("missing"))).alias(source))
        if filled.agg(F.approx_count_distinct(source)).first()[0] > MAX_LEVELS:
            raise ValueError(f"{self.getInputCol()} has more than {MAX_LEVELS} levels: not a category")
        indexer = StringIndexer(inputCol=source, outputCol=index, stringOrderType="alphabetAsc", handleInvalid="keep")
        # The slot after the last level is the one of unseen values; dropping it leaves zeros.
        encoder = OneHotEncoder(inputCol=index, outputCol=self.getOutputCol(), dropLast=True)
        model = Pipeline(stages=[indexer, encoder]).fit(filled)
        return self._copyValues(OneHotModel(model))


class OneHotModel(Model, HasInputCol, HasOutputCol):
    missing = OneHot.missing

    def __init__(self, inner=None):
        super().__init__()
        self._setDefault(inputCol="category", outputCol="levels", missing="missing")
        self.inner = inner

    @property
    def levels(self) -> list[str]:
        return list(self.inner.stages[0].labels)

    def _transform(self, df: DataFrame) -> DataFrame:
        source, index = f"_{self.getOutputCol()}_text", f"_{self.getOutputCol()}_index"
        value = F.coalesce(F.col(self.getInputCol()).cast("string"), F.lit(self.getOrDefault("missing")))
        return self.inner.transform(df.withColumn(source, value)).drop(source, index)


def feature_steps(text: str = "reviewText", summary: str | None = None, numeric: list[str] | None = None,
                  categorical: list[str] | None = None, svd: int = 0, output: str = "features",
                  weighted: tuple[str, ...] = (), summary_svd: int = 0, summary_tfidf: dict | None = None,
                  **tfidf) -> dict[str, Params]:
    """Named stages of a column transformer; columns without a branch are dropped by the assembly.

    `tfidf` are the text's settings, `summary_tfidf` the summary's; either branch may end in an SVD.
    """
    steps: dict[str, Params] = {"text": Tfidf(inputCol=text, outputCol="_text", **tfidf)}
    parts = ["_text"]
    if svd:
        steps["svd"] = Svd(inputCol="_text", outputCol="_svd", k=svd)
        parts = ["_svd"]
    if summary:
        steps["summary"] = Tfidf(inputCol=summary, outputCol="_summary", **(summary_tfidf or {}))
        if summary_svd:
            steps["summary_svd"] = Svd(inputCol="_summary", outputCol="_summary_svd", k=summary_svd)
        parts.append("_summary_svd" if summary_svd else "_summary")
    if numeric:
        steps["num"] = Standardise(inputCols=numeric, outputCol="_numeric", weightedCols=weighted)
        parts.append("_numeric")
    for c in categorical or []:
        steps[f"cat_{c}"] = OneHot(inputCol=c, outputCol=f"_cat_{c}")
        parts.append(f"_cat_{c}")
    steps["assemble"] = VectorAssembler(inputCols=parts, outputCol=output)
    return steps


ALIASES = {  # setting name -> parameter name of the stage
    "max_ngram": "maxNgram", "min_df": "minDF", "max_df": "maxDF", "max_features": "maxFeatures",
    "sublinear_tf": "sublinear", "use_idf": "useIdf", "stop_words": "stopWords",
    "min_token_length": "minTokenLength", "n_components": "k", "sentiment_weight": "sentimentWeight",
    "n_estimators": ("numTrees", "maxIter"), "learning_rate": "stepSize", "max_depth": "maxDepth",
    "min_samples_leaf": "minInstancesPerNode", "subsample": "subsamplingRate", "max_iter": "maxIter",
    "feature_subset": "featureSubsetStrategy", "ngram_range": "maxNgram", "penalty": "elasticNetParam",
    "validation_fraction": "validationShare",
}
UNLIMITED_DEPTH = 30  # Spark's deepest tree
PENALTIES = {"l1": 1.0, "l2": 0.0}


def setting(name: str, value):
    """The value of a named setting as its parameter takes it."""
    if name == "max_depth":
        return UNLIMITED_DEPTH if value is None else value
    if value is None:
        raise ValueError(f"{name} has no meaning for None")
    if name == "ngram_range" and not isinstance(value, int):
        low, high = value
        if low != 1:
            raise ValueError("n-grams start at single words")
        return high
    if name == "penalty" and isinstance(value, str):
        return PENALTIES[value]
    return value


def param_map(steps: dict[str, Params], settings: dict) -> dict[Param, object]:
    """{"text__max_df": 0.85, "rf__n_estimators": 107} as a ParamMap over the named stages.

    A stage that wraps another estimator is searched too, its own parameters first.
    """
    out = {}
    for address, value in settings.items():
        step, _, name = address.partition("__")
        if step not in steps:
            raise ValueError(f"no step {step!r}; steps are {sorted(steps)}")
        wanted = ALIASES.get(name, name)
        wanted = wanted if isinstance(wanted, tuple) else (wanted,)
        owners = [steps[step]]
        while getattr(owners[-1], "inner", None) is not None:
            owners.append(owners[-1].inner)
        found = [o.getParam(w) for o in owners for w in wanted if o.hasParam(w)]
        if not found:
            raise ValueError(f"step {step!r} has no parameter {name!r}")
        out[found[0]] = setting(name, value)
    return out
