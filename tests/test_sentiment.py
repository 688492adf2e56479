import random

import pytest

from revlens.functions import sentiment as se

# Ten hand-labelled sentences and their labels.
SENTENCES = [  # text, stateful (pos, neg, polarity), window form
    ("I love this product, it's amazing!", (2, 0, 2), (2, 0, 2)),
    ("This is bad. I hate it!", (0, 2, -2), (0, 2, -2)),
    ("Not great, honestly disappointed.", (1, 1, 0), (0, 2, -2)),
    ("I didn't love this item, I returned it.", (1, 1, 0), (1, 1, 0)),
    ("Absolutely fantastic, best I've ever used!", (2, 0, 2), (2, 0, 2)),
    ("Terrible, absolute junk, do not buy!", (0, 2, -2), (0, 2, -2)),
    ("It's not terrible, but also not great.", (1, 1, 0), (0, 2, -2)),
    ("I thought it would be bad, but I actually like it.", (1, 1, 0), (1, 1, 0)),
    ("Not the worst, but far from good.", (0, 1, -1), (1, 0, 1)),
    ("This exceeded my expectations, I love it!", (1, 0, 1), (1, 0, 1)),
]
LABELS = ["Positive", "Negative", "Negative", "Negative", "Positive", "Negative", "Neutral", "Positive", "Negative", "Positive"]


def triples(spark, texts, form, lexicon=None, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, reviewText string").repartition(8)
    rows = se.add_sentiment(df, "reviewText", lexicon, form, **options).orderBy("id").collect()
    return [(r["pos_count"], r["neg_count"], r["polarity_score"]) for r in rows]


def test_sentences(spark):
    texts = [s for s, _, _ in SENTENCES]
    assert triples(spark, texts, "stateful") == [a for _, a, _ in SENTENCES]
    assert triples(spark, texts, "window2") == [b for _, _, b in SENTENCES]


def test_sign_against_hand_labels(spark):
    signs = {1: "Positive", 0: "Neutral", -1: "Negative"}
    got = [signs[(p > 0) - (p < 0)] for _, _, p in triples(spark, [s for s, _, _ in SENTENCES], "stateful")]
    assert [i + 1 for i, (a, b) in enumerate(zip(got, LABELS)) if a != b] == [3, 4, 8]


def test_edges(spark):
    texts = [None, "", "   ", "!!!", "good", "not", "ungood", "unbad not", "not ungood", "in fine", "infine inn"]
    assert triples(spark, texts, "stateful") == [
        (0, 0, 0), (0, 0, 0), (0, 0, 0), (0, 0, 0), (1, 0, 1), (0, 0, 0), (0, 1, -1), (1, 0, 1), (0, 1, -1),
        (1, 0, 1), (0, 1, -1),
    ]


def test_apostrophes_can_be_kept(spark):
    assert triples(spark, ["I don't like it"], "stateful") == [(1, 0, 1)]
    assert triples(spark, ["I don't like it"], "stateful", keep_apostrophes=True) == [(0, 1, -1)]


def stateful_by_rule(words, lex):
    """Word by word, from the rule about the last negation and the previous sentiment word."""
    pos = neg = 0
    spots = [i for i, w in enumerate(words) if w in lex.negation]
    previous = None
    for i, w in enumerate(words):
        if w in lex.negation:
            continue
        rest = next((w[len(p):] for p in lex.prefixes if w.startswith(p) and len(w) > len(p) + 1), None)
        neg += rest in lex.positive
        pos += rest in lex.negative
        if w in lex.positive or w in lex.negative:
            low = 0 if previous is None else previous - 2
            turned = any(low <= s < i for s in spots)
            good = (w in lex.positive) != turned
            pos += good
            neg += not good
            previous = i
    return pos, neg, pos - neg


def window_by_rule(words, lex):
    pos = neg = 0
    for i, w in enumerate(words):
        if w in lex.positive:
            turned = any(v in lex.negation for v in words[max(0, i - 2):i])
            pos += not turned
            neg += turned
        elif w in lex.negative:
            neg += 1
    return pos, neg, pos - neg


@pytest.mark.parametrize("form, rule, lex", [("stateful", stateful_by_rule, se.STATEFUL), ("window2", window_by_rule, se.WINDOW)])
def test_random_texts(spark, form, rule, lex):
    rng = random.Random(5)
    pool = ["good", "great", "bad", "junk", "not", "never", "the", "a", "ungood", "disbad", "x", "imnice", "unx"]
    lists = [[rng.choice(pool) for _ in range(rng.randint(0, 14))] for _ in range(3000)]
    assert triples(spark, [" ".join(w) for w in lists], form) == [rule(w, lex) for w in lists]


def test_weight(spark):
    df = spark.createDataFrame([(2, 1, 1)], "pos_count int, neg_count int, polarity_score int")
    assert tuple(se.weighted(df, 1.5).first()) == (3.0, 1.5, 1.5)


def test_overlapping_prefixes_are_refused():
    with pytest.raises(ValueError):
        se.Lexicon(prefixes=("in", "inter"))
