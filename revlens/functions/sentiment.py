"""Lexicon sentiment with negation, as one fold over the few tokens that matter."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from revlens.functions.text import tokens

# Word lists.
POSITIVE = (
    "great", "excellent", "love", "amazing", "wonderful", "perfect", "best", "awesome", "good",
    "like", "nice", "fine", "decent", "cool", "fantastic",
)
NEGATIVE = (
    "bad", "awful", "terrible", "waste", "hate", "poor", "disappointed", "sucks", "damn",
    "returned", "refund", "junk", "crap", "garbage", "horrible",
)
STATEFUL_NEGATION = (
    "not", "no", "never", "don't", "doesn't", "didn't", "won't", "wouldn't", "couldn't", "can't",
    "isn't", "aren't", "wasn't", "weren't",
)
STATEFUL_PREFIXES = ("un", "dis", "in", "im", "non", "ir")
WINDOW_NEGATION = (
    "not", "never", "no", "n't", "hardly", "scarcely", "rarely", "barely", "don't", "didn't",
    "wasn't",
)
WINDOW_PREFIXES = ("un", "dis", "mis", "in", "im", "il", "ir", "non")


@dataclass(frozen=True)
class Lexicon:
    positive: tuple[str, ...] = POSITIVE
    negative: tuple[str, ...] = NEGATIVE
    negation: tuple[str, ...] = STATEFUL_NEGATION
    prefixes: tuple[str, ...] = STATEFUL_PREFIXES

    def __post_init__(self):
        for a in self.prefixes:
            for b in self.prefixes:
                if a != b and b.startswith(a):
                    raise ValueError(f"prefix {a!r} starts {b!r}: a token could match both")

    def prefixed(self, words: tuple[str, ...], min_rest: int) -> list[str]:
        return [p + w for p in self.prefixes for w in words if len(w) >= min_rest]


STATEFUL = Lexicon()
WINDOW = Lexicon(negation=WINDOW_NEGATION, prefixes=WINDOW_PREFIXES)

_TRIPLE = "struct<pos_count:int,neg_count:int>"


def _marks(words: Column, sets: dict[str, list[str]]) -> Column:
    """Token positions that belong to any set, with one flag per set.

    Set membership is a hash lookup, so the lexicon size does not matter per token.
    """
    every = sorted({w for s in sets.values() for w in s})
    at = F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    hits = F.filter(at, lambda m: m["word"].isin(every))
    return F.transform(
        hits,
        lambda m: F.struct(
            m["at"].alias("at"), *[m["word"].isin(list(s)).alias(n) for n, s in sets.items()]
        ),
    )


def _one(flag: Column) -> Column:
    return F.when(flag, 1).otherwise(0)


def stateful(c: Column | str, lexicon: Lexicon = STATEFUL, keep_apostrophes: bool = False) -> Column:
    """struct<pos_count, neg_count, polarity_score>.

    A sentiment word changes sides when a negation word stands before it, not earlier than two
    tokens before the previous sentiment word. A negating prefix on a sentiment word counts for
    the other side, whatever stands before it.
    """
    return _with_polarity(_stateful_fold(_words(c, keep_apostrophes), lexicon))


def window2(c: Column | str, lexicon: Lexicon = WINDOW, keep_apostrophes: bool = False) -> Column:
    """struct<pos_count, neg_count, polarity_score>.

    A positive word counts as negative when one of the two tokens before it is a negation word;
    negative words are never turned.
    """
    return _with_polarity(_window_fold(_words(c, keep_apostrophes), lexicon))


def _words(c: Column | str, keep_apostrophes: bool) -> Column:
    if not keep_apostrophes:
        return tokens(c)
    text = F.lower(F.col(c) if isinstance(c, str) else c)
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]+(?:'[\p{L}\p{N}_]+)*"), F.lit(0))


def _stateful_fold(words: Column, lexicon: Lexicon) -> Column:
    marks = _marks(
        words,
        {
            "turn": list(lexicon.negation),
            "pos": list(lexicon.positive),
            "neg": [w for w in lexicon.negative if w not in lexicon.positive],
            "un_pos": lexicon.prefixed(lexicon.positive, 2),
            "un_neg": [
                w
                for w in lexicon.prefixed(lexicon.negative, 2)
                if w not in lexicon.prefixed(lexicon.positive, 2)
            ],
        },
    )
    start = F.struct(
        F.lit(-1).alias("turned_at"), F.lit(0).alias("word_at"),
        F.lit(0).alias("pos"), F.lit(0).alias("neg"),
    )

    def step(s: Column, m: Column) -> Column:
        word = m["pos"] | m["neg"]
        turned = (s["turned_at"] >= 0) & (s["turned_at"] >= s["word_at"] - 2)
        up = _one(m["un_neg"]) + _one(word & (m["pos"] != turned))
        down = _one(m["un_pos"]) + _one(word & (m["pos"] == turned))
        seen = F.struct(
            s["turned_at"].alias("turned_at"),
            F.when(word, m["at"]).otherwise(s["word_at"]).alias("word_at"),
            (s["pos"] + up).alias("pos"),
            (s["neg"] + down).alias("neg"),
        )
        return F.when(m["turn"], s.withField("turned_at", m["at"])).otherwise(seen)

    return F.aggregate(marks, start, step, lambda s: F.struct(s["pos"], s["neg"]).cast(_TRIPLE))


def _window_fold(words: Column, lexicon: Lexicon) -> Column:
    marks = _marks(
        words,
        {
            "turn": list(lexicon.negation),
            "pos": list(lexicon.positive),
            "neg": [w for w in lexicon.negative if w not in lexicon.positive],
            "un_pos": lexicon.prefixed(lexicon.positive, 1),
        },
    )
    start = F.struct(F.lit(-3).alias("turned_at"), F.lit(0).alias("pos"), F.lit(0).alias("neg"))

    def step(s: Column, m: Column) -> Column:
        turned = (s["turned_at"] >= m["at"] - 2) & (s["turned_at"] >= 0) | m["un_pos"]
        return F.struct(
            F.when(m["turn"], m["at"]).otherwise(s["turned_at"]).alias("turned_at"),
            (s["pos"] + _one(m["pos"] & ~turned)).alias("pos"),
            (s["neg"] + _one(m["neg"] | (m["pos"] & turned))).alias("neg"),
        )

    return F.aggregate(marks, start, step, lambda s: F.struct(s["pos"], s["neg"]).cast(_TRIPLE))


def _with_polarity(counts: Column) -> Column:
    return F.transform(
        F.array(counts),
        lambda c: c.withField("polarity_score", c["pos_count"] - c["neg_count"]),
    )[0]


def add_sentiment(df: DataFrame, text: str = "reviewText", lexicon: Lexicon | None = None,
                  form: str = "stateful", keep_apostrophes: bool = False) -> DataFrame:
    """Three columns from one fold per row; rows never move."""
    if form not in ("stateful", "window2"):
        raise ValueError(f"unknown sentiment form {form!r}")
    filled = F.coalesce(F.col(text), F.lit(""))
    if form == "stateful":
        triple = stateful(filled, lexicon or STATEFUL, keep_apostrophes)
    else:
        triple = window2(filled, lexicon or WINDOW, keep_apostrophes)
    return df.withColumn("_s", triple).select("*", "_s.*").drop("_s")


def weighted(df: DataFrame, weight: float,
             columns: tuple[str, ...] = ("pos_count", "neg_count", "polarity_score")) -> DataFrame:
    """Sentiment columns times a constant weight."""
    return df.withColumns({c: F.col(c) * F.lit(float(weight)) for c in columns})
