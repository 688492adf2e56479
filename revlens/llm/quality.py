"""A quality classifier without labelled text: heuristic labellers weighed by EM teach a linear scorer."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from revlens.llm.text import cutoff, narrow

# A labeller says 1 (reject), 2 (keep) or 0 (no opinion); each rule's two limits are (keep below, reject above).
LIMITS = {
    "symbols": (0.02, 0.08),      # share of # $ % & * | = and the like among the characters
    "shouting": (0.15, 0.50),     # share of capitals among the ASCII letters
    "exclaiming": (0.005, 0.05),  # share of ! among the characters
    "tagged": (0.05, 0.30),       # share of words that end in two symbols or more
    "listing": (0.02, 0.15),      # share of words that are a lone symbol
    "repeating": (0.50, 0.80),    # share of words that repeat a run of three words seen before
    "stuck": (0.02, 0.15),        # share of words equal to the word before
    "monotonous": (0.45, 0.70),   # 1 - share of distinct words, the mean over blocks of 50 words
}
LABELLERS = list(LIMITS)
SYMBOLS = b"#$%&*|=<>{}[]^~@\\+/_"
CAPITALS, LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
DIMENSIONS = 1 << 14


def measures(text: bytes, words: list[bytes]) -> list[float]:
    """The number each labeller looks at, for a text with words."""
    def share(chars: bytes) -> int:
        return len(text) - len(text.translate(None, chars))

    n, letters = len(words), share(LETTERS)
    odd = SYMBOLS + b"!?"
    symbols, shouts = share(SYMBOLS), text.count(b"!")
    tagged = lone = 0
    if symbols + shouts + text.count(b"?"):
        tagged = sum(1 for w in words if len(w) > 2 and w[-1] in odd and w[-2] in odd)
    if symbols:
        lone = sum(1 for w in words if len(w) == 1 and w in SYMBOLS)
    runs = len(set(zip(words, words[1:], words[2:])))
    stuck = sum(1 for a, b in zip(words, words[1:]) if a == b)
    blocks = [words[i:i + 50] for i in range(0, n, 50)]
    distinct = sum(len(set(b)) for b in blocks)
    return [symbols / len(text), share(CAPITALS) / letters if letters else 0.0, shouts / len(text),
            tagged / n, lone / n, 1 - runs / (n - 2) if n > 2 else 0.0,
            stuck / n, 1 - distinct / n]


def votes(values: list[float]) -> int:
    """All labellers' answers as the digits of one number in base 3."""
    code = 0
    for value, (low, high) in zip(values, LIMITS.values()):
        code = code * 3 + (1 if value > high else 2 if value < low else 0)
    return code


def _digits(codes: np.ndarray) -> np.ndarray:
    return np.stack([codes // 3 ** k % 3 for k in range(len(LABELLERS) - 1, -1, -1)], axis=1)


class LabelModel:
    """Accuracies of labellers that answer independently given the truth, from their agreement alone."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, rounds: int = 100):
        answers = _digits(codes)
        rejecting, keeping = (answers == 1).sum(1), (answers == 2).sum(1)
        bad = np.where(rejecting > 0, 0.9, 0.1) * np.where(keeping + rejecting > 0, 1, 0.5)
        for _ in range(rounds):
            self.prior = float((bad * counts).sum() / max(counts.sum(), 1e-9))
            weight = np.stack([(1 - bad) * counts, bad * counts])  # class x pattern
            table = np.stack([[np.bincount(answers[:, j], w, 3) for j in range(len(LABELLERS))] for w in weight])
            self.given = (table + 0.01) / (table + 0.01).sum(2, keepdims=True)  # class x labeller x answer
            bad = self.posterior(codes)

    def posterior(self, codes: np.ndarray) -> np.ndarray:
        """Probability that a document with these answers is to be rejected."""
        answers = _digits(codes)
        each = np.log(self.given[:, np.arange(len(LABELLERS)), answers])  # class x pattern x labeller
        odds = each.sum(2) + np.log(np.clip([1 - self.prior, self.prior], 1e-9, 1))[:, None]
        return 1 / (1 + np.exp(np.clip(odds[0] - odds[1], -500, 500)))


SHAPE = bytes(65 if 65 <= c < 91 else 97 if 97 <= c < 123 or c >= 128 else 48 if 48 <= c < 58 else c for c in range(256))


def shape_features(shape: bytes) -> tuple[int, ...]:
    """Hashed shape (runs of a class as one sign), ending and length of a word, all of which its shape tells."""
    short = bytes(c for i, c in enumerate(shape) if i == 0 or c != shape[i - 1])[:16]
    names = (b"s" + short, b"e" + shape[-3:], b"n%d" % min(len(shape), 24))
    return tuple(zlib.crc32(x) % DIMENSIONS for x in names)


class Features:
    """Sparse features of texts; words of one shape have the same ones, and those of a fixed number of shapes are remembered."""

    def __init__(self, remembered: int = 50_000):
        self.known: dict[bytes, tuple[int, ...]] = {}
        self.remembered = remembered

    def of(self, text: bytes, values: list[float]) -> tuple[np.ndarray, np.ndarray]:
        """(indices, values) of a text with words: roots of the shares of word features, and the labellers' numbers in tenths."""
        shapes = Counter(text.translate(SHAPE).split())
        if len(self.known) > self.remembered:
            self.known.clear()
        for shape in shapes:
            if shape not in self.known:
                self.known[shape] = shape_features(shape)
        flat = np.fromiter(chain.from_iterable(map(self.known.__getitem__, shapes)), np.int64, 3 * len(shapes))
        times = np.fromiter(shapes.values(), np.float64, len(shapes))
        counts = np.bincount(flat, np.repeat(times, 3), DIMENSIONS)
        index = np.flatnonzero(counts).astype(np.int32)
        tenths = [zlib.crc32(b"m%d:%d" % (j, min(10, int(v * 10)))) % DIMENSIONS for j, v in enumerate(values)]
        return (np.concatenate([index, np.array(tenths, np.int32)]),
                np.concatenate([np.sqrt(counts[index] / times.sum()), np.full(len(tenths), 0.3)]))


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, rounds: int = 400,
               penalty: float = 1e-4, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by gradient steps with adapted rates; (weights, bias)."""
    owner = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    index = np.concatenate([i for i, _ in rows]) if rows else np.zeros(0, int)
    value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)
    weights, bias = np.zeros(DIMENSIONS), 0.0
    square, bias_square = np.full(DIMENSIONS, 1e-8), 1e-8
    for _ in range(rounds if rows else 0):
        z = np.bincount(owner, value * weights[index], len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) / len(rows)
        slope = np.bincount(index, value * error[owner], DIMENSIONS) + penalty * weights
        square += slope ** 2
        bias_square += error.sum() ** 2
        weights -= rate * slope / np.sqrt(square)
        bias -= rate * error.sum() / np.sqrt(bias_square)
    return weights, bias


class Scorer:
    """The fitted model: `score` is the probability that a text is to be rejected."""

    def __init__(self, labels: LabelModel, weights: np.ndarray, bias: float):
        self.labels, self.weights, self.bias = labels, weights, bias

    def judge(self, text: Column) -> Column:
        """struct<answers, score>: the labellers' packed answers and the score; null and 1.0 for texts without words."""
        weights, bias = self.weights, self.bias

        @F.pandas_udf("struct<answers:int,score:double>")
        def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            features = Features()

            def one(text: bytes | None) -> tuple[int | None, float]:
                raw = text or b""
                words = raw.split()
                if not words:
                    return None, 1.0
                values = measures(raw, words)
                index, value = features.of(raw, values)
                return votes(values), float(1 / (1 + np.exp(-np.clip(value @ weights[index] + bias, -50, 50))))

            for texts in batches:
                yield pd.DataFrame([one(t) for t in texts], columns=["answers", "score"]).astype({"answers": "Int32", "score": "float64"})

        return judged(text.cast("binary"))


def answers(text: Column) -> Column:
    """The labellers' packed answers; null where there are no words to look at."""

    @F.pandas_udf("int")
    def packed(texts: pd.Series) -> pd.Series:
        def one(text: bytes | None) -> int | None:
            raw = text or b""
            words = raw.split()
            return votes(measures(raw, words)) if words else None

        return pd.Series([one(t) for t in texts], dtype="Int32")

    return packed(text.cast("binary"))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = 4000) -> Scorer:
    """Learn from `docs` alone, without labels.

    All documents are counted by the pattern of their labellers' answers (at most 3^8 rows), and
    expectation-maximisation on these counts finds how often each labeller is right. The linear
    scorer is fitted on the `max_train` documents with the smallest hashes of their ids, with the
    label model's posteriors as soft targets; only their sparse features come to the driver.
    """
    rows = narrow(docs, doc=id_col, text=text_col)
    counted = rows.select(answers(F.col("text")).alias("code")).where("code is not null").groupBy("code").count().toPandas()
    labels = LabelModel(counted["code"].to_numpy(np.int64), counted["count"].to_numpy(float))
    key = F.xxhash64(F.coalesce(F.col("doc").cast("string"), F.lit("")))
    chosen = cutoff(rows.select(key.alias("key")), rows.count(), max_train)

    @F.pandas_udf("struct<code:int,index:array<int>,value:array<double>>")
    def examples(texts: pd.Series) -> pd.DataFrame:
        features, out = Features(), []
        for text in texts:
            raw = text or b""
            words = raw.split()
            if not words:
                out.append((None, None, None))
                continue
            values = measures(raw, words)
            out.append((votes(values), *features.of(raw, values)))
        return pd.DataFrame(out, columns=["code", "index", "value"]).astype({"code": "Int32"})

    picked = [] if chosen is None else (
        rows.where(key <= chosen).withColumn("key", key).orderBy("key", "doc").limit(max_train)
        .select(examples(F.col("text").cast("binary")).alias("x")).where("x.code is not null").select("x.*").collect())
    features = [(np.array(r["index"], np.int32), np.array(r["value"])) for r in picked]
    target = labels.posterior(np.array([r["code"] for r in picked], np.int64)) if picked else np.zeros(0)
    return Scorer(labels, *fit_linear(features, target))


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = 4000,
             threshold: float = 0.5) -> DataFrame:
    """(doc, answers, weak, score, rejected): the label model's and the scorer's view of every document.

    `weak` is the label model's posterior of rejection, `score` the linear scorer's probability and
    `rejected` says that it is at least `threshold`. Whole texts are read; nothing is shuffled but
    the counts of patterns. Null texts and texts without words have no answers, score 1 and are
    rejected. Every row of the input gives one, repeated ones too; an empty table gives none.
    """
    model = fit(docs, id_col, text_col, max_train)
    rows = narrow(docs, doc=id_col, text=text_col)
    out = rows.select("doc", model.judge(F.col("text")).alias("x")).select("doc", "x.*")
    labels = model.labels
    codes = np.arange(3 ** len(LABELLERS))
    posterior = F.from_json(F.lit(str([round(float(p), 6) for p in labels.posterior(codes)])), "array<double>")
    return out.select("doc", "answers", F.get(posterior, F.col("answers")).alias("weak"), "score",
                      (F.col("score") >= threshold).alias("rejected"))


def without_rejected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = 4000,
                     threshold: float = 0.5) -> DataFrame:
    """`docs` less the rejected rows, each judged where it lies."""
    model = fit(docs, id_col, text_col, max_train)
    return docs.where(model.judge(F.col(f"`{text_col}`"))["score"] < threshold)
