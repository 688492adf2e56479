"""A word n-gram model by deleted interpolation, learned from and applied to all documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from revlens.session import drop_staged, staged

PIECE_TOKENS = 1 << 20  # of the texts that a task holds at once, or one text; their different pairs are counted there
BUCKET_TOKENS = 1 << 20  # for each group of pairs that are counted together
NO_ID = -(1 << 63)
TRAIN, HELD = 1, 2  # parts of the documents; 0 are those not learned from


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class Numbered(dict):
    """Words by order of appearance; the end of a text, which no word is, comes first and is also what a text begins after."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def packed(x: np.ndarray) -> bytes:
    """32-bit numbers, most of them small, in about half of their bytes."""
    return zlib.compress(x.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view("<i4").ravel()


def encoded(rows: DataFrame) -> DataFrame:
    """(piece, n, key, part, size, tokens, words): the texts' tokens as places in the hashes of their piece's words."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        first, made = TaskContext.get().partitionId() << 32, 0
        known, texts, keys, parts = Numbered({b"": 0}), [], [], []

        def piece() -> pd.DataFrame:
            found = np.concatenate(texts)
            words = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known)).view(np.int64)
            size = np.fromiter(map(len, texts), np.int32, len(texts))
            return pd.DataFrame({"piece": [first + made], "n": [len(found)], "key": [np.array(keys, np.int64)], "part": [np.array(parts, np.int32)],
                                 "size": [size], "tokens": [packed(found)], "words": [words]})

        n = 0
        for batch in batches:
            for key, text, part in zip(batch["key"], batch["text"], batch["part"]):
                found = tokens(text)
                found.append(b"")
                if n and n + len(found) > PIECE_TOKENS:
                    yield piece()
                    made, n, known, texts, keys, parts = made + 1, 0, Numbered({b"": 0}), [], [], []
                n += len(found)
                texts.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
                keys.append(key)
                parts.append(part)
        if n:
            yield piece()

    return rows.select("key", "text", "part").mapInPandas(
        pieces, "piece bigint, n bigint, key array<bigint>, part array<int>, size array<int>, tokens binary, words array<bigint>")


def before(found: np.ndarray, size: np.ndarray, start: int) -> np.ndarray:
    """What stands before each token: the token before it, or `start` at a text's first one."""
    prev = np.empty_like(found)
    prev[1:] = found[:-1]
    prev[np.cumsum(size) - size] = start
    return prev


def pair_hashes(found: np.ndarray, size: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Each token's hash together with what stands before it."""
    x = words.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return (x[before(found, size, 0)] + words.view(np.uint64)[found]) * np.uint64(0xBF58476D1CE4E5B9)


def by_word(found: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a piece's words, ascending, and each token's place there."""
    hashes = words.view(np.uint64)
    order = np.argsort(hashes)
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return hashes[order], place[found]


def by_pair(found: np.ndarray, size: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for each token together with what stands before it."""
    return np.unique(pair_hashes(found, size, words), return_inverse=True)


def asked(texts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, piece, hash, n, h): each piece's different words (buckets below 0) and pairs by ascending hash, counted in its training rows and in those held out."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                part, own = np.repeat(r.part, r.size), unpacked(r.tokens)
                for word, (found, at) in ((True, by_word(own, r.words)), (False, by_pair(own, r.size, r.words))):
                    n, h = (np.bincount(at[part >= least], minlength=len(found)).astype(np.int32) for least in (TRAIN, HELD))
                    bucket = ((found >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                    number, begin = np.unique(bucket, return_index=True)
                    yield pd.DataFrame({
                        "bucket": -1 - number if word else number, "piece": r.piece,
                        **{name: np.split(x, begin[1:]) for name, x in (("hash", found.view(np.int64)), ("n", n), ("h", h))}})

    return texts.select("piece", "part", "size", "tokens", "words").mapInPandas(
        ask, "bucket bigint, piece bigint, hash array<bigint>, n array<int>, h array<int>")


def counted(asks: DataFrame) -> DataFrame:
    """(bucket, piece, n, h, kinds, total, held): the counts over all pieces, in the order asked; a bucket's first row has its sums.

    `h` is given for what the piece itself holds out, since only its held-out tokens ask for that.
    """

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        found, at = np.unique(np.concatenate(rows["hash"].to_list()), return_inverse=True)
        each = {c: np.concatenate(rows[c].to_list()) for c in "nh"}
        n, h = (np.bincount(at, x, len(found)).astype(np.int64) for x in each.values())
        ends, own = np.cumsum(rows["hash"].str.len().to_numpy())[:-1], each["h"] > 0
        sums = {"kinds": (n > 0).sum(), "total": n.sum(), "held": h.sum()}
        return pd.DataFrame({"bucket": rows["bucket"], "piece": rows["piece"], "n": np.split(n[at], ends), "h": np.split(h[at[own]], np.cumsum(own)[ends - 1]),
                             **{name: np.where(np.arange(len(rows)) == 0, x, 0) for name, x in sums.items()}})

    return asks.groupBy("bucket").applyInPandas(
        count, "bucket bigint, piece bigint, n array<bigint>, h array<bigint>, kinds bigint, total bigint, held bigint")


def bits(count: np.ndarray) -> np.ndarray:
    """0 for 0, then 1 + whole log2."""
    return np.frexp(count)[1]


def log_share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    return np.where(count > 0, np.log2(np.maximum(count, 1) / np.maximum(total, 1)), -99.0)


CELL = ("context", "q2", "q1")


def judged(texts: DataFrame, counts: DataFrame, pieces: int, kept: int) -> DataFrame:
    """(key, part, word, pair) and cells: a text's tokens' counts as words and after the token before them, over all pieces.

    Held-out tokens against the other rows' estimates, of which `kept` tokens are the base, give a joint distribution in quarter octaves;
    a piece's cells are in its first text's row.
    """

    def judge(own: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        r = next(own.itertuples())
        found, held = unpacked(r.tokens), np.repeat(r.part, r.size) == HELD

        def answered(rows: pd.DataFrame, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Each token's count, and that in the rows not held out (right for held-out tokens)."""
            n, h = (np.concatenate(rows[c].to_list()) for c in "nh")
            others = n.copy()
            others[np.bincount(at[held], minlength=len(n)) > 0] -= h
            return n[at], others[at]

        # Words are asked in buckets -1, -2, ..., pairs in 0, 1, ..., each by ascending hash.
        word, single = answered(replies[replies["bucket"] < 0].sort_values("bucket", ascending=False), by_word(found, r.words)[1])
        pair, both = answered(replies[replies["bucket"] >= 0].sort_values("bucket"), by_pair(found, r.size, r.words)[1])
        end = np.cumsum(r.size) - 1
        context = before(single, r.size, single[end[held[end]]].max(initial=0))[held]
        l2, l1 = log_share(both[held], context), log_share(single[held], kept)
        cells, cell, n = np.unique(np.stack([bits(context), np.floor(4 * l2), np.floor(4 * l1)], axis=1).astype(np.int32),
                                   axis=0, return_inverse=True, return_counts=True)
        cell = cell.ravel()
        sums = {"held": n, "l2": np.bincount(cell, l2, len(cells)), "l1": np.bincount(cell, l1, len(cells))}
        more = [None] * (len(r.size) - 1)
        return pd.DataFrame({"key": r.key, "part": r.part, "word": np.split(word, end[:-1] + 1), "pair": np.split(pair, end[:-1] + 1),
                             **{name: [x, *more] for name, x in zip(CELL, cells.T)}, **{name: [x.astype(float), *more] for name, x in sums.items()}})

    own = texts.select("piece", "part", "key", "size", "tokens", "words").repartition(pieces, "piece").groupBy("piece")
    replies = counts.select("piece", "bucket", "n", "h").repartition(pieces, "piece").groupBy("piece")
    return own.cogroup(replies).applyInPandas(
        judge, "key bigint, part int, word array<bigint>, pair array<bigint>, "
        "context array<int>, q2 array<int>, q1 array<int>, held array<double>, l2 array<double>, l1 array<double>")


def mixture_weights(rows: DataFrame, uniform: float, rounds: int = 60) -> np.ndarray:
    """Weights [context bucket, (pair, single, uniform)], from the cells of `judged`.

    Together they are a table whose size doesn't depend on the input. Expectation-maximisation runs on that table.
    """
    cells = rows.select(F.inline(F.arrays_zip(*CELL, "held", "l2", "l1")))
    found = cells.groupBy(*CELL).agg(F.sum("held").alias("n"), F.sum("l2").alias("l2"), F.sum("l1").alias("l1")).toPandas()
    weights = np.tile([0.3, 0.6, 0.1], (65, 1))
    weights[0] = [0.0, 0.9, 0.1]
    for context, part in found.groupby("context"):
        n = part["n"].to_numpy()
        odds = np.stack([np.where(part["q2"] > -396, 2.0 ** (part["l2"] / n), 0), np.where(part["q1"] > -396, 2.0 ** (part["l1"] / n), 0),
                         np.full(len(n), uniform)], axis=1)
        now = weights[int(context)]
        for _ in range(rounds):
            each = odds * now
            now = (n[:, None] * each / each.sum(1, keepdims=True)).sum(0) / n.sum()
            now = np.maximum(now, [0.0, 1e-6, 1e-6])
            now /= now.sum()
        weights[int(context)] = now
    return weights


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, train, n_tokens, n_known, train_tokens, base_score, score), one row per id of `docs`.

    `training` is a condition on `docs`: the documents the model learns from. Tokens are the
    words of the text, A-Z lower-cased, and one end. `base_score` is the add-half unigram
    model's log10 probability, `score` that of the interpolated model: the maximum-likelihood estimates
    of a word after the word before it, of the word alone, and a uniform one over the known words and one unknown,
    mixed with weights for each power of two of the context's frequency; the weights come from
    expectation-maximisation on every tenth training document against counts of the other nine.

    All words and all pairs count, however rare, by 64-bit hashes. Texts are read once, into pieces of tokens; each
    piece counts its different words and pairs, sends them by ranges of hashes and gets the sums over all pieces back in
    the order it sent them, so that neither tokens nor hashes come back. A very common word or pair is one entry a piece.

    Null texts are empty: one token, the end. Rows that repeat an id are one document whose
    tokens are added up; rows without id are one document too. Without any training document
    scores are those of uniform choice. An empty table gives no rows.
    """
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(NO_ID)).alias("key"),
                       F.col(f"`{text_col}`").alias("text"), F.coalesce(training, F.lit(False)).alias("train"))
    held_out = F.pmod(F.xxhash64("key"), F.lit(10)) == 0
    rows = rows.withColumn("part", F.when(F.col("train") & held_out, HELD).when(F.col("train"), TRAIN).otherwise(0))
    texts = staged(encoded(rows), "pieces", codec="zstd")
    size, pieces = texts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    counts = staged(counted(asked(texts, 1 + size // BUCKET_TOKENS)), "counts", codec="zstd", keep_shuffles=False)
    total, held, kinds = (int(x) for x in counts.where("bucket < 0").agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "held", "kinds")]).first())
    uniform = 1.0 / (kinds + 1)
    found = staged(judged(texts, counts, max(pieces, 1), total - held), "judged", codec="zstd", keep_shuffles=False)
    if size:
        drop_staged(texts, counts)
    weights = mixture_weights(found, uniform) if total else np.tile([0.0, 0.0, 1.0], (65, 1))
    norm = np.log10(total + 0.5 * (kinds + 1))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, rows in batch.groupby(batch["word"].str.len().cumsum().to_numpy() // PIECE_TOKENS):
                word, pair = (np.concatenate(rows[c].to_list()) for c in ("word", "pair"))
                size = rows["word"].str.len().to_numpy(np.int64)
                context = before(word, size, word[size[0] - 1])  # a text's start is as frequent as its end
                w = weights[bits(context)]
                p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * word / max(total, 1) + w[:, 2] * uniform
                sums = {"n_known": word > 0, "base": np.log10(word + 0.5) - norm, "score": np.log10(p)}
                yield pd.DataFrame({"key": rows["key"], "train": rows["part"] >= TRAIN, "n_tokens": size, **{
                    name: np.add.reduceat(x, np.cumsum(size) - size, dtype=np.int64 if name == "n_known" else float) for name, x in sums.items()}})

    each = found.select("key", "part", "word", "pair").mapInPandas(
        scored, "key bigint, train boolean, n_tokens bigint, n_known bigint, base double, score double")
    out = each.groupBy("key").agg(F.max("train").alias("train"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")])
    return out.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc"), "train", "n_tokens", "n_known",
        F.lit(total).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score"), "score")
