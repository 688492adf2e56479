"""Terms of texts by pieces of rows: a piece sends each of its different terms once and gets their counts back.

A piece's rows stay together, as codes of its words, so (row, term) pairs never leave the task that makes them. Terms are dealt
to buckets by a hash and compared as strings; what travels is compressed, some bytes a term. A bucket gets a term once from
each piece at most, however frequent it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from revlens.session import planned_bytes

PIECE = 1 << 19  # tokens of a piece, unless a single row has more
BUCKET_BYTES = 8 << 20  # of pieces for each bucket and length of n-gram: its terms fit a Python worker many times
SENT = "bucket int, piece bigint, n int, lengths binary, terms binary, first binary, second binary"


def packed(values: np.ndarray, kind: str) -> bytes:
    """Whole numbers, compressed by planes of bytes: those of small numbers are zeros."""
    planes = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), -1).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(data, decompressed_size=n * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(kind).ravel()


def _offsets(terms: pa.StringArray) -> np.ndarray:
    return np.frombuffer(terms.buffers()[1], np.int32)[terms.offset:terms.offset + len(terms) + 1]


def packed_terms(terms: pa.StringArray) -> tuple[bytes, bytes]:
    """(lengths, characters) of at least one term, compressed."""
    offsets = _offsets(terms)
    data = terms.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    return packed(np.diff(offsets), "<i4"), pa.compress(data, codec="zstd", asbytes=True)


def unpacked_terms(lengths: list[bytes], data: list[bytes], n: list[int]) -> pa.StringArray:
    """The terms of several packed lists, one after the other."""
    sizes = [unpacked(x, k, "<i4") for x, k in zip(lengths, n)]
    raw = b"".join(pa.decompress(x, decompressed_size=int(s.sum()), codec="zstd", asbytes=True) for x, s in zip(data, sizes))
    offsets = np.zeros(sum(n) + 1, np.int32)
    np.cumsum(np.concatenate(sizes), out=offsets[1:])
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(raw))


def word_hashes(words: pa.StringArray) -> np.ndarray:
    return np.array([zlib.crc32(w) for w in words.cast(pa.binary()).to_pylist()], np.int64)


def _with_word(hashed: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (hashed * 31 + word) % (1 << 32)


def term_hashes(terms: pa.StringArray) -> np.ndarray:
    """The hashes that `grams` gives to the same terms."""
    words = pc.split_pattern(terms, " ")
    starts, sizes = words.offsets.to_numpy()[:-1], pc.list_value_length(words).to_numpy()
    coded = words.values.dictionary_encode()
    own = word_hashes(coded.dictionary)[coded.indices.to_numpy()]
    hashed = own[starts]
    for n in range(1, int(sizes.max(initial=1))):
        more = sizes > n
        hashed[more] = _with_word(hashed[more], own[starts[more] + n])
    return hashed


def cut(df: DataFrame, row_id: Column, words: Column, size: int = PIECE) -> DataFrame:
    """Pieces of rows one after the other: the ids and numbers of words of rows that have any, different words, and all words' codes."""
    rows = df.select(row_id.alias("id"), words.alias("words"))
    kind = rows.schema["id"].dataType.simpleString()

    def cutting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, held, tokens = TaskContext.get().partitionId() << 33, [], 0

        def piece() -> pa.RecordBatch:
            nonlocal made, held, tokens
            ids, sizes = pa.concat_arrays([x[0] for x in held]), np.concatenate([x[1] for x in held])
            coded = pa.concat_arrays([x[2] for x in held]).dictionary_encode()
            lengths, data = packed_terms(coded.dictionary)
            own = {"piece": pa.array([made], pa.int64()), "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)}
            own |= {k: pa.array([v], pa.int32()) for k, v in (("n_words", len(coded.dictionary)), ("n_tokens", len(coded)))}
            own |= {k: pa.array([v], pa.binary()) for k, v in (
                ("sizes", packed(sizes, "<i4")), ("lengths", lengths), ("words", data), ("codes", packed(coded.indices.to_numpy(), "<i4")))}
            made, held, tokens = made + 1, [], 0
            return pa.RecordBatch.from_pydict(own)

        for batch in batches:
            lists = batch.column(1)
            sizes, flat = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype("i8"), lists.flatten()
            ids, sizes = batch.column(0).filter(pa.array(sizes > 0)), sizes[sizes > 0]
            ends, at, done = np.cumsum(sizes), 0, 0
            while at < len(sizes):
                to = int(np.searchsorted(ends, done + size - tokens, side="right"))
                if to <= at and tokens:
                    yield piece()
                    continue
                to = max(to, at + 1)
                end = int(ends[to - 1])
                held.append((ids[at:to], sizes[at:to], flat[done:end]))
                tokens, at, done = tokens + end - done, to, end
                if tokens >= size:
                    yield piece()
        if held:
            yield piece()

    return rows.mapInArrow(cutting, f"piece bigint, ids array<{kind}>, n_words int, n_tokens int, sizes binary, lengths binary, "
                           "words binary, codes binary")


def grams(codes: np.ndarray, sizes: np.ndarray, words: pa.StringArray, most: int) -> Iterator[tuple]:
    """For n = 1 to `most`: each place's n-gram and row, and the different n-grams with their hashes. Codes stand for all of `words`."""
    places, row = np.arange(len(codes)), np.repeat(np.arange(len(sizes)), sizes)
    left, own = np.repeat(np.cumsum(sizes), sizes) - places, word_hashes(words)
    term, terms, hashed = codes, words, own
    yield term, row, terms, hashed
    for n in range(2, most + 1):
        whole = left[places] >= n
        places, term = places[whole], term[whole]
        if not len(places):
            return
        pairs, term = np.unique(term * len(words) + codes[places + n - 1], return_inverse=True)
        before, last = np.divmod(pairs, len(words))
        terms = pc.binary_join_element_wise(terms.take(pa.array(before)), words.take(pa.array(last)), " ")
        hashed = _with_word(hashed[before], own[last])
        yield term, row[places], terms, hashed


class Terms:
    """A piece's different n-grams, in a fixed order, and how often each row has them."""

    def __init__(self, piece: dict, most: int):
        self.sizes = unpacked(piece["sizes"], len(piece["ids"]), "<i4").astype("i8")
        words = unpacked_terms([piece["lengths"]], [piece["words"]], [piece["n_words"]])
        codes = unpacked(piece["codes"], piece["n_tokens"], "<i4").astype("i8")
        terms, hashed, rows, at, tf, n = [], [], [], [], [], 0
        for term, row, strings, own in grams(codes, self.sizes, words, most):
            pairs, counts = np.unique(row * len(strings) + term, return_counts=True)
            row, term = np.divmod(pairs, len(strings))
            for parts, x in ((terms, strings), (hashed, own), (rows, row), (at, term + n), (tf, counts)):
                parts.append(x)
            n += len(strings)
        self.terms, self.hashed = pa.concat_arrays(terms), np.concatenate(hashed)
        self.row, self.term, self.tf = (np.concatenate(x) for x in (rows, at, tf))

    def order(self, buckets: int) -> np.ndarray:
        return np.argsort(self.hashed % buckets, kind="stable")


def _sent(terms: pa.StringArray, hashed: np.ndarray, buckets: int, piece: int, first: np.ndarray | None,
          second: np.ndarray | None) -> pa.RecordBatch:
    """A row for each bucket that has terms: the terms and two numbers of each."""
    order = np.argsort(hashed % buckets, kind="stable")
    own, terms = (hashed % buckets)[order], terms.take(pa.array(order))
    starts = np.flatnonzero(np.diff(own, prepend=-1))
    ends = np.append(starts[1:], len(own))
    lists = [packed_terms(terms[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
    numbers = [[None if x is None else packed(x[order[a:b]], "<i8") for a, b in zip(starts, ends)] for x in (first, second)]
    return pa.RecordBatch.from_arrays(
        [pa.array(own[starts], pa.int32()), pa.array([piece] * len(starts), pa.int64()), pa.array(ends - starts, pa.int32()),
         *[pa.array(x, pa.binary()) for x in ([x[0] for x in lists], [x[1] for x in lists], *numbers)]],
        names=["bucket", "piece", "n", "lengths", "terms", "first", "second"])


def n_buckets(pieces: DataFrame, most: int) -> int:
    return max(1, -(-planned_bytes(pieces) * most // BUCKET_BYTES))


def sent(pieces: DataFrame, most: int, buckets: int, counts: bool) -> DataFrame:
    """(bucket, piece, terms) of all pieces; with `counts` each term's documents in the piece and its occurrences there."""
    def sending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                piece = batch.slice(i, 1).to_pylist()[0]
                own = Terms(piece, most)
                n = len(own.terms)
                numbers = (np.bincount(own.term, minlength=n), np.bincount(own.term, own.tf, n)) if counts else (None, None)
                yield _sent(own.terms, own.hashed, buckets, piece["piece"], *numbers)

    return pieces.mapInArrow(sending, SENT)


def _received(rows: pa.Table) -> tuple[pa.StringArray, list[int]]:
    n = rows["n"].to_pylist()
    return unpacked_terms(rows["lengths"].to_pylist(), rows["terms"].to_pylist(), n), n


def _numbers(rows: pa.Table, name: str, n: list[int]) -> np.ndarray:
    return np.concatenate([unpacked(x, k, "<i8") for x, k in zip(rows[name].to_pylist(), n)])


def _summed(rows: pa.Table) -> tuple[pa.StringArray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """The different terms of a bucket, where each of those received is among them, documents, occurrences, lengths of the lists."""
    terms, n = _received(rows)
    coded = terms.dictionary_encode()
    at, k = coded.indices.to_numpy(), len(coded.dictionary)
    df, tf = (np.bincount(at, _numbers(rows, x, n), k).astype("i8") for x in ("first", "second"))
    return coded.dictionary, at, df, tf, n


def counted(pieces: DataFrame, most: int) -> DataFrame:
    """(term, tf, df) of every n-gram of up to `most` words."""
    def summing(rows: pa.Table) -> pa.Table:
        terms, _, df, tf, _ = _summed(rows)
        return pa.table({"term": terms, "tf": pa.array(tf, pa.int64()), "df": pa.array(df, pa.int64())})

    rows = sent(pieces, most, n_buckets(pieces, most), True)
    return rows.groupBy("bucket").applyInArrow(summing, "term string, tf bigint, df bigint")


ANSWERS = "piece bigint, bucket int, n int, df binary, place binary"


def _answers(rows: pa.Table, n: list[int], df: np.ndarray, place: np.ndarray) -> pa.Table:
    ends = np.cumsum(n)[:-1]
    each = [[packed(x, "<i8") for x in np.split(values, ends)] for values in (df, place)]
    return pa.table({"piece": rows["piece"], "bucket": rows["bucket"], "n": rows["n"],
                     **{k: pa.array(x, pa.binary()) for k, x in zip(("df", "place"), each)}})


def answered(pieces: DataFrame, most: int, least_df: float, most_df: float) -> DataFrame:
    """The documents of each piece's terms in all pieces, in the order sent; 0 for terms outside the limits."""
    def answering(rows: pa.Table) -> pa.Table:
        _, at, df, _, n = _summed(rows)
        df = np.where((df >= least_df) & (df <= most_df), df, 0)[at]
        return _answers(rows, n, df, np.zeros_like(df))

    return sent(pieces, most, n_buckets(pieces, most), True).groupBy("bucket").applyInArrow(answering, ANSWERS)


def looked_up(pieces: DataFrame, most: int, dictionary: DataFrame) -> DataFrame:
    """As `answered`, from a dictionary (term, df, index) of unique terms; terms that it lacks get 0."""
    buckets = n_buckets(pieces, most)

    def entering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                terms = batch.column(0)
                yield _sent(terms, term_hashes(terms), buckets, -1, *(batch.column(i).to_numpy() for i in (1, 2)))

    def answering(rows: pa.Table) -> pa.Table:
        asked, known = rows.filter(pc.greater_equal(rows["piece"], 0)), rows.filter(pc.less(rows["piece"], 0))
        if not asked.num_rows:
            none = pa.array([], pa.binary())
            return pa.table({"piece": asked["piece"], "bucket": asked["bucket"], "n": asked["n"], "df": none, "place": none})
        terms, n = _received(asked)
        df = place = np.zeros(len(terms), "i8")
        if known.num_rows:
            entries, sizes = _received(known)
            at = pc.fill_null(pc.index_in(terms, value_set=entries), -1).to_numpy()
            df, place = (np.where(at >= 0, _numbers(known, x, sizes)[at], 0) for x in ("first", "second"))
        return _answers(asked, n, df, place)

    columns = [F.col("term"), F.col("df").cast("bigint"), F.col("index").cast("bigint")]
    both = sent(pieces, most, buckets, False).union(dictionary.select(*columns).mapInArrow(entering, SENT))
    return both.groupBy("bucket").applyInArrow(answering, ANSWERS)


def weights(tf: np.ndarray, df: np.ndarray, n_docs: int, weigh: dict) -> np.ndarray:
    """Before the norm; `weigh` has `binary`, `sublinear`, `idf` and `norm` of a `Tfidf`."""
    weight = tf.astype("f8")
    if weigh["binary"]:
        weight = np.ones_like(weight)
    elif weigh["sublinear"]:
        weight = 1 + np.log(weight)
    return weight * (np.log((1 + n_docs) / (1 + df)) + 1) if weigh["idf"] else weight


def normed(weight: np.ndarray, row: np.ndarray, n_rows: int, norm: str) -> np.ndarray:
    if norm == "none":
        return weight
    total = np.bincount(row, np.abs(weight) if norm == "l1" else weight * weight, n_rows)
    return weight / (total if norm == "l1" else np.sqrt(total))[row]


def _known(piece: pa.Table, got: pa.Table, most: int, buckets: int) -> tuple:
    """(ids, different terms, and row, term, tf, df, index of each entry whose term was found) of a piece and the answers to it."""
    own, got = Terms(piece.to_pylist()[0], most), pa.Table.from_pylist(got["answers"][0].as_py()).sort_by("bucket")
    sizes, order = got["n"].to_pylist(), own.order(buckets)
    df, place = np.empty((2, len(order)), "i8")
    df[order], place[order] = _numbers(got, "df", sizes), _numbers(got, "place", sizes)
    kept = df[own.term] > 0
    row, term, tf = own.row[kept], own.term[kept], own.tf[kept]
    return piece["ids"].combine_chunks().flatten(), own.terms, row, term, tf, df[term], place[term]


def _with_answers(pieces: DataFrame, answers: DataFrame):
    """Each piece with its answers, which are gathered before the shuffle: a row for each piece and task instead of one a bucket."""
    lists = answers.groupBy("piece").agg(F.collect_list(F.struct("bucket", "n", "df", "place")).alias("answers"))
    return pieces.groupBy("piece").cogroup(lists.groupBy("piece"))


def weighted(pieces: DataFrame, answers: DataFrame, most: int, n_docs: int, weigh: dict, row: str) -> DataFrame:
    """(row, term, weight) of all entries. Answers were made for these pieces, bucket by bucket."""
    kind, buckets = pieces.schema["ids"].dataType.elementType.simpleString(), n_buckets(pieces, most)

    def weighing(piece: pa.Table, got: pa.Table) -> pa.Table:
        ids, terms, at, term, tf, df, _ = _known(piece, got, most, buckets)
        weight = normed(weights(tf, df, n_docs, weigh), at, len(ids), weigh["norm"])
        return pa.Table.from_arrays([ids.take(pa.array(at)), terms.take(pa.array(term)), pa.array(weight)], names=[row, "term", "weight"])

    return _with_answers(pieces, answers).applyInArrow(weighing, f"`{row}` {kind}, term string, weight double")


def packed_rows(pieces: DataFrame, answers: DataFrame, most: int, row: str) -> DataFrame:
    """(row, n, entries) of rows that have any of the terms: steps of the index, occurrences and documents of each, compressed.

    A weight would take eight bytes that don't compress; `vector_parts` makes it from these.
    """
    kind, buckets = pieces.schema["ids"].dataType.elementType.simpleString(), n_buckets(pieces, most)

    def packing(piece: pa.Table, got: pa.Table) -> pa.Table:
        ids, _, at, _, tf, df, place = _known(piece, got, most, buckets)
        order = np.lexsort((place, at))
        has, counts = np.unique(at, return_counts=True)
        rows = np.split(np.stack([place, tf, df])[:, order], np.cumsum(counts)[:-1], axis=1)
        data = [packed(np.concatenate([np.diff(x[0], prepend=0), x[1], x[2]]), "<i8") for x in rows[:len(has)]]
        return pa.Table.from_arrays([ids.take(pa.array(has)), pa.array(counts, pa.int32()), pa.array(data, pa.binary())], names=[row, "n", "entries"])

    return _with_answers(pieces, answers).applyInArrow(packing, f"`{row}` {kind}, n int, entries binary")


def vector_parts(n: Column, entries: Column, n_docs: int, weigh: dict) -> Column:
    """struct<indices, weights> of `packed_rows`; both are empty for a row without entries."""
    @F.pandas_udf("struct<indices:array<int>,weights:array<double>>")
    def parts(sizes: pd.Series, rows: pd.Series) -> pd.DataFrame:
        out = []
        for size, data in zip(sizes, rows):
            step, tf, df = unpacked(data, 3 * int(size), "<i8").reshape(3, -1) if data is not None else np.zeros((3, 0), "i8")
            weight = normed(weights(tf, df, n_docs, weigh), np.zeros(len(tf), "i8"), 1, weigh["norm"])
            out.append((np.cumsum(step).astype("i4"), weight))
        return pd.DataFrame(out, columns=["indices", "weights"])

    return parts(n, entries)
