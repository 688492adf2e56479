"""Language of every word of a text that may switch languages, by a linear-chain conditional random field."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from revlens.llm.text import narrow

DIMENSIONS = 1 << 15
PIECE_CHARS = 2 << 20
CHARS = 1 << 18  # characters of words whose features are found at a time
STEP = 64  # words of a block in forward-backward
EDGES = ".,;:!?\"'()[]{}<>*%$#&|=~^`-_/\\"


def cleaned(token: str) -> str:
    """A token without ASCII punctuation at its ends; empty if no letter is left."""
    word = token.strip(EDGES)
    return word if word.isalpha() or any(c.isalpha() for c in word) else ""


def words_of(text: str | None) -> list[str]:
    """Words between white space, lower-cased, without ASCII punctuation at the ends, that have a letter."""
    return [w for w in map(cleaned, (text or "").lower().split()) if w]


def pieces(texts: pd.Series) -> Iterator[pd.Series]:
    """A batch in runs of about `PIECE_CHARS` characters, or one text: a task's memory follows this."""
    at = texts.str.len().fillna(0).cumsum().to_numpy(np.int64) // PIECE_CHARS
    for _, rows in texts.groupby(at, sort=True):
        yield rows


MIX = np.uint64(0x9E3779B97F4A7C15)
PREFIX, SUFFIX, PAIR, TRIPLE, CHARACTER, KNOWN = 0, 4, 8, 9, 10, 11  # kinds of features


def hashed(values: np.ndarray, kind: int) -> np.ndarray:
    """Feature numbers of packed bytes or code points, each kind in an order of its own."""
    return (((values.astype(np.uint64) << np.uint64(4)) + np.uint64(kind)) * MIX >> np.uint64(64 - 15)).astype(np.int64)


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(word's place, feature) of all words: prefixes and suffixes up to three bytes, two- and three-grams with the ends
    marked, different non-ASCII characters, and a feature of its own for a word of the lexicon; whole words, all at once."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    sizes = np.array([len(r) for r in raw], np.int64)
    x = np.frombuffer(b"".join(b"^" + r + b"$" for r in raw), np.uint8).astype(np.uint32)
    first = np.cumsum(sizes + 2) - sizes - 1
    last, place = first + sizes - 1, np.arange(len(words))
    owner = np.repeat(place, sizes + 2)
    found = []
    head, tail = np.zeros(len(words), np.uint32), np.zeros(len(words), np.uint32)
    for k in range(1, 4):
        more = sizes >= k
        head[more] = head[more] << 8 | x[first[more] + k - 1]
        tail[more] |= x[last[more] - k + 1] << 8 * (k - 1)
        found += [(place, hashed(head, PREFIX + k)), (place, hashed(tail, SUFFIX + k))]
    for size, kind in ((2, PAIR), (3, TRIPLE)):
        gram = x[:1 - size] if size == 2 else x[:-2] << 8 | x[1:-1]
        gram, inside = gram << 8 | x[size - 1:], owner[size - 1:] == owner[:1 - size]
        found.append((owner[:1 - size][inside], hashed(gram[inside], kind)))
    wide = [i for i, w in enumerate(words) if not w.isascii()]
    if wide:
        points = np.frombuffer("".join(words[i] for i in wide).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        by = np.repeat(np.array(wide, np.int64), [len(words[i]) for i in wide])
        each = np.unique((by << 21 | points)[points > 127])
        found.append((each >> 21, hashed(each & (1 << 21) - 1, CHARACTER)))
    listed = np.array([i for i, w in enumerate(words) if w in lexicon], np.int64)
    if len(listed):
        found.append((listed, hashed(np.array([zlib.crc32(raw[i]) for i in listed]), KNOWN)))
    return np.concatenate([w for w, _ in found]), np.concatenate([f for _, f in found])


def marginals(emissions: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: np.ndarray,
              count_moves: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over padded sequences [sequence, word, label]: label marginals, expected moves summed.

    Scaled probabilities; all sequences of a batch advance together.
    """
    n, steps, k = emissions.shape
    score = np.exp(emissions - emissions.max(axis=2, keepdims=True))
    turn, first = np.exp(moves), np.exp(start)
    forward = np.zeros_like(score)
    inside = np.arange(steps)[None, :] < lengths[:, None]
    at = first[None, :] * score[:, 0]
    forward[:, 0] = at / at.sum(1, keepdims=True)
    for t in range(1, steps):
        at = (forward[:, t - 1] @ turn) * score[:, t]
        at /= at.sum(1, keepdims=True)
        forward[:, t] = np.where(inside[:, t, None], at, forward[:, t - 1])
    backward = np.ones((n, k))
    out, expected = np.zeros_like(score), np.zeros((k, k))
    for t in range(steps - 1, -1, -1):
        both = forward[:, t] * backward
        out[:, t] = np.where(inside[:, t, None], both / both.sum(1, keepdims=True), 0.0)
        if t:
            ahead = score[:, t] * backward
            live = inside[:, t]
            if count_moves:
                pair = (forward[:, t - 1, :, None] * turn[None] * ahead[:, None, :])[live]
                expected += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(0)
            ahead = ahead @ turn.T
            backward = np.where(live[:, None], ahead / ahead.sum(1, keepdims=True), backward)
    return out, expected


def padded(rows: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows], np.int64)
    out = np.zeros((len(rows), max(int(lengths.max()), 1), k))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out, lengths


def switched(pieces: list[tuple[int, list[str]]], rng: np.random.Generator) -> list[list[tuple[str, int]]]:
    """Training sequences of the pieces in random order, each 3 to 40 words of one language, so that switches occur."""
    cut: list[tuple[int, list[str]]] = []
    for label, words in pieces:
        at = 0
        while at < len(words):
            step = int(rng.integers(3, 41))
            cut.append((label, words[at:at + step]))
            at += step
    order = rng.permutation(len(cut))
    sequences, now = [], []
    for i in order:
        label, words = cut[i]
        now += [(w, label) for w in words]
        if len(now) >= 60:
            sequences.append(now)
            now = []
    return sequences + ([now] if now else [])


class Field:
    """A fitted field: emission weights [feature, label], moves between labels, start weights, lexicon."""

    def __init__(self, labels: list[str], lexicon: dict[str, int]):
        self.labels, self.lexicon = labels, lexicon
        k = len(labels)
        self.weights, self.moves, self.start = np.zeros((DIMENSIONS, k)), np.zeros((k, k)), np.zeros(k)

    def fit(self, sequences: list[list[tuple[str, int]]], rounds: int = 8, batch: int = 64, rate: float = 0.25,
            penalty: float = 1e-6) -> "Field":
        """Gradient ascent on the conditional likelihood, features and moves together."""
        k = len(self.labels)
        words = list(dict.fromkeys(w for s in sequences for w, _ in s))
        owner, feature = word_features(words, self.lexicon) if words else (np.zeros(0, int),) * 2
        order = np.argsort(owner, kind="stable")
        known = dict(zip(words, np.split(feature[order], np.cumsum(np.bincount(owner, minlength=len(words)))[:-1])))
        rng = np.random.default_rng(7)
        squares = [np.full(x.shape, 1e-6) for x in (self.weights, self.moves, self.start)]
        for _ in range(rounds if k > 1 else 0):
            order = rng.permutation(len(sequences))
            for b in range(0, len(order), batch):
                chosen = [sequences[i] for i in order[b:b + batch]]
                index = [known[w] for s in chosen for w, _ in s]
                sizes = np.array([len(i) for i in index])
                where = np.concatenate(index)
                flat = np.add.reduceat(self.weights[where], np.cumsum(sizes) - sizes)
                rows = np.split(flat, np.cumsum([len(s) for s in chosen])[:-1])
                emissions, lengths = padded(rows, k)
                found, expected = marginals(emissions, lengths, self.moves, self.start)
                slope = np.zeros_like(self.weights)
                moved, begun = -expected, np.zeros(k)
                errors = []
                for j, s in enumerate(chosen):
                    truth = np.array([label for _, label in s])
                    np.add.at(moved, (truth[:-1], truth[1:]), 1.0)
                    begun[truth[0]] += 1
                    begun -= found[j, 0]
                    error = -found[j, :len(s)]
                    error[np.arange(len(s)), truth] += 1
                    errors.append(error)
                amount = np.repeat(np.concatenate(errors), sizes, axis=0)
                for c in range(k):
                    slope[:, c] = np.bincount(where, amount[:, c], DIMENSIONS)
                words = lengths.sum()
                for x, g, s in zip((self.weights, self.moves, self.start),
                                   (slope / words - penalty * self.weights, moved / words, begun / len(chosen)), squares):
                    s += g ** 2
                    x += rate * g / np.sqrt(s)
        return self

    def label_words(self, emissions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Label marginals [word, label] from the emissions [word, label] of whole texts, one after another."""
        return blocked_marginals(emissions, lengths, self.moves, self.start)


def blocked_marginals(emissions: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Forward-backward over texts of any length, in blocks of `STEP` words that all advance together.

    The moves through a block are one matrix, the product of its words' matrices. Products carry the forward and
    backward vectors from block to block, and with these at its ends each block finds its own words' marginals.
    """
    k, n = emissions.shape[1], len(emissions)
    if not n:
        return np.zeros((0, k))
    lengths = np.asarray(lengths, np.int64)
    blocks_of = -(-lengths // STEP)
    text = np.repeat(np.arange(len(lengths)), blocks_of)
    first_block = np.cumsum(blocks_of) - blocks_of
    nth = np.arange(len(text)) - first_block[text]  # of the block in its text
    word_at = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    block, place = np.repeat(first_block, lengths) + word_at // STEP, word_at % STEP
    score = np.ones((len(text), STEP, k))
    score[block, place] = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    inside = np.zeros((len(text), STEP), bool)
    inside[block, place] = True
    turn, begins = np.exp(moves), nth == 0
    entry = np.where(begins[:, None, None], np.exp(start)[None, None, :], turn[None])  # a text's first word has no move into it
    whole = entry * score[:, 0, None, :]
    for t in range(1, STEP):
        live = inside[:, t]
        if not live.any():
            break
        after = (whole @ turn) * score[:, t, None, :]
        whole = np.where(live[:, None, None], after / after.sum(axis=(1, 2), keepdims=True), whole)
    into, beyond = np.full((len(text), k), 1.0 / k), np.ones((len(text), k))
    at = [np.flatnonzero(nth == j) for j in range(int(nth.max()) + 1)]
    for here in at[1:]:
        v = np.einsum("bi,bij->bj", into[here - 1], whole[here - 1])
        into[here] = v / v.sum(1, keepdims=True)
    for here in at[:0:-1]:
        v = np.einsum("bij,bj->bi", whole[here], beyond[here])
        beyond[here - 1] = v / v.sum(1, keepdims=True)
    forward, now = np.empty_like(score), into
    for t in range(STEP):
        now = np.where(inside[:, t, None], (np.einsum("bi,bij->bj", now, entry) if t == 0 else now @ turn) * score[:, t], now)
        now = now / now.sum(1, keepdims=True)
        forward[:, t] = now
    back = beyond
    for t in range(STEP - 1, -1, -1):
        both = forward[:, t] * back
        forward[:, t] = both / both.sum(1, keepdims=True)
        ahead = (score[:, t] * back) @ turn.T
        back = np.where(inside[:, t, None], ahead / ahead.sum(1, keepdims=True), back)
    return forward[block, place]


class Emissions:
    """Emission scores of tokens; remembers up to a fixed number of them, also that one is no word."""

    def __init__(self, field: Field, remembered: int = 200_000):
        self.field, self.remembered = field, remembered
        self.row: dict[str, int] = {}
        self.table = np.zeros((1024, max(len(field.labels), 1)))

    def _add(self, tokens: list[str]) -> None:
        first = len(self.row)
        self.row.update(zip(tokens, range(first, first + len(tokens))))
        while len(self.row) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        words = [cleaned(t) for t in tokens]
        at, size = 0, 0
        for end, word in enumerate(words, 1):  # the grams of about `CHARS` characters at a time, or of one word
            size += len(word)
            if size >= CHARS or end == len(words):
                self.table[first + at:first + end] = self._sums(words[at:end])
                at, size = end, 0

    def _sums(self, words: list[str]) -> np.ndarray:
        out = np.full((len(words), self.table.shape[1]), np.nan)
        there = [i for i, w in enumerate(words) if w]
        if there:
            owner, feature = word_features([words[i] for i in there], self.field.lexicon)
            for c in range(out.shape[1]):
                out[there, c] = np.bincount(owner, self.field.weights[feature, c], len(there))
        return out

    def of(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """[word, label] of the tokens of all texts that are words, and how many each text has."""
        if len(self.row) > self.remembered:
            self.row.clear()
        tokens, sizes = list(chain.from_iterable(texts)), [len(t) for t in texts]
        new = [t for t in set(tokens) if t not in self.row]
        if new:
            self._add(new)
        at = np.fromiter(map(self.row.__getitem__, tokens), np.int64, len(tokens))
        is_word = ~np.isnan(self.table[at, 0])
        owner = np.repeat(np.arange(len(texts)), sizes)[is_word]
        return self.table[at[is_word]], np.bincount(owner, minlength=len(texts))


def sample(rows: DataFrame, most: int) -> dict[str, list[str]]:
    """The texts of `most` rows (doc, text, lang) of each language, by smallest hash of the id, in that order.

    Ids and languages are looked at first: hashes are even, so those below a bound that follows a language's rows are few, and
    the last hash to take comes from their counts. Only the texts up to it reach the driver. An id that has more rows than
    there is room for is passed over.
    """
    key = F.xxhash64(F.coalesce(F.col("doc").cast("string"), F.lit("")))
    keyed, low, width = rows.select("lang", key.alias("key"), "doc", "text"), -(1 << 63), 1 << 64
    totals = {r["lang"]: r["count"] for r in keyed.groupBy("lang").count().collect()}
    share, last, wanted = 2.0, {}, dict(totals)
    while wanted:
        bounds = {x: min(low + int(width * min(1.0, share * (most + 50) / n)), -low - 1) for x, n in wanted.items()}
        below = F.col("key") <= F.create_map(*[F.lit(v) for pair in bounds.items() for v in pair])[F.col("lang")]
        found: dict[str, list[tuple[int, int]]] = {x: [] for x in wanted}
        for r in keyed.where(F.col("lang").isin(list(wanted)) & below).groupBy("lang", "key").count().collect():
            found[r["lang"]].append((r["key"], r["count"]))
        for lang, counts in found.items():
            taken, keys = 0, []
            for k, n in sorted(counts):
                if n <= most - taken:
                    taken, keys = taken + n, [*keys, k]
            if taken >= most or len(counts) > most or bounds[lang] == -low - 1:
                last[lang] = set(keys)
                wanted.pop(lang)
        share *= 8
    chosen = [(x, k) for x, keys in last.items() for k in keys]
    if not chosen:
        return {}
    few = rows.sparkSession.createDataFrame(chosen, "lang string, key bigint")
    out: dict[str, list[str]] = {}
    for r in sorted(keyed.join(F.broadcast(few), ["lang", "key"]).collect(), key=lambda r: (r["key"], r["doc"] is not None, r["doc"] or 0, r["text"])):
        out.setdefault(r["lang"], []).append(r["text"])
    return out


def train(rows: DataFrame, max_train: int = 400, max_words: int = 60_000, lexicon_share: float = 1e-4) -> Field:
    """Fit on `rows` (doc, text, lang): at most `max_train` documents of each language, by smallest hash of the id.

    The lexicon holds the words that make up `lexicon_share` or more of a language's words, so at
    most 1 / `lexicon_share` a language, counted over all rows. Whole documents are taken as long as a
    language has at most `max_words`; one that would exceed them is passed over, unless it is the first. Without usable
    rows there are no languages, and every text is unknown.
    """
    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for texts in pieces(batch["text"]):
                for lang, part in texts.groupby(batch["lang"].loc[texts.index]):
                    seen: Counter = Counter()
                    for t in part:
                        seen.update(t.lower().split())
                    yield pd.DataFrame({"lang": lang, "word": [cleaned(t) for t in seen], "n": list(seen.values())})

    usable = rows.where("lang is not null and text is not null")
    counted = usable.select("lang", "text").mapInPandas(tokens, "lang string, word string, n bigint").where(
        "word != ''").groupBy("lang", "word").agg(F.sum("n").alias("count"))
    sums = counted.groupBy("lang").agg(F.sum("count").alias("total"))
    common = counted.join(F.broadcast(sums), "lang").where(F.col("count") >= F.greatest(F.lit(5.0), lexicon_share * F.col("total")))
    lexicon = {r[0]: 1 for r in common.select("word").distinct().collect()}
    sampled = sample(usable, max_train)
    languages = sorted(r[0] for r in sums.select("lang").collect())
    chosen: list[tuple[int, list[str]]] = []
    for label, lang in enumerate(languages):
        taken = 0
        for text in sampled.get(lang, []):
            words = words_of(text)
            if taken and taken + len(words) > max_words:
                continue
            taken += len(words)
            chosen.append((label, words))
    return Field(languages, lexicon).fit(switched(chosen, np.random.default_rng(3)))


def identify(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", unknown: str = "und") -> DataFrame:
    """(doc, lang_pred, score, n_words, shares, switches) for every whole text of `docs`.

    Every word gets its label's marginal; `shares` are the labels' mean marginals over the text,
    in the order of the learned languages, `lang_pred` the label of the largest (the first of
    equal ones), `score` its share, and `switches` counts the neighbouring words whose best labels
    differ. Texts of about `PIECE_CHARS` characters run together, a longer one alone; a task holds one such
    piece. Nothing is shuffled.

    A null text, or one without a letter, has `unknown` and score 0, as has every text if nothing
    was learned. Repeated rows get a row each; an empty table gives none.
    """
    labels = field.labels

    @F.pandas_udf("lang_pred string, score double, n_words int, shares array<double>, switches int")
    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Emissions(field)
        for batch in batches:
            out = []
            for texts in pieces(batch):
                tokens = [(t or "").lower().split() for t in texts] if labels else [[]] * len(texts)
                emissions, lengths = known.of(tokens)
                every, end = field.label_words(emissions, lengths), np.cumsum(lengths)
                for m in np.split(every, end[:-1]):
                    if not len(m):
                        out.append((unknown, 0.0, 0, [], 0))
                        continue
                    share, best = m.mean(0), m.argmax(1)
                    top = int(share.argmax())
                    out.append((labels[top], float(min(share[top], 1.0)), len(m), share.tolist(), int((best[1:] != best[:-1]).sum())))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "n_words", "shares", "switches"])

    rows = narrow(docs, doc=id_col, text=text_col)
    return rows.select("doc", labelled("text").alias("found")).select("doc", "found.*")


def held_out(id_col: str = "doc_id", parts: int = 3, part: int = 1):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts == part
