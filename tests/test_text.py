import re

import pytest

from revlens.functions import text as tx

CLEANED = [
    ("", ""),
    ("   ", ""),
    ("!!!", ""),
    ("<b>Good</b> see http://x.y/z now", "good see now"),
    ("a < b > c", "a c"),
    ("<a\nb> c", "a b c"),
    ("<a\rb> c", "c"),
    ("www.shop.com great", "great"),
    ("Don't-stop  it", "don't-stop it"),
    ("É à x", "x"),
    ("one two　three", "one two three"),
    ("http://a b", "b"),
    ("awww!! nice", "a nice"),
    ("smile \U0001f600 end", "smile end"),
    ("under_score 9", "under score 9"),
    ("KELVIN K", "kelvin k"),
]


def column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, t string")


def evaluate(spark, values, expression):
    rows = column(spark, values).select("id", expression.alias("r")).orderBy("id").collect()
    return [r["r"] for r in rows]


def test_clean_text(spark):
    assert evaluate(spark, [a for a, _ in CLEANED], tx.clean_text("t")) == [b for _, b in CLEANED]


def test_clean_columns_fill_null(spark):
    df = spark.createDataFrame([(None, "A!")], "reviewText string, other string")
    assert tx.clean_columns(df, "reviewText", "summary").first()[0] == ""


@pytest.mark.parametrize(
    "value, words, mean",
    [("", 0, 0.0), ("  ", 0, 0.0), ("one", 1, 3.0), ("a bb\tccc", 3, 2.0), ("x yy z", 3, 4 / 3),
     ("a\x1cb", 2, 1.0), (" lead trail ", 2, 4.5)],
)
def test_words(spark, value, words, mean):
    assert evaluate(spark, [value], tx.num_words("t")) == [words] == [len(value.split())]
    assert evaluate(spark, [value], tx.avg_word_length("t"))[0] == pytest.approx(mean)


def test_character_statistics(spark):
    df = column(spark, ["ABc!", "", "É\U0001f600!!", "Ⅰ"])
    out = tx.text_stats(df, "t", None).orderBy("id").collect()
    assert [r["review_length"] for r in out] == [4, 0, 4, 1]
    assert [r["exclamation_count"] for r in out] == [1, 0, 2, 0]
    assert [r["uppercase_ratio"] for r in out] == [0.5, 0.0, 0.25, 1.0]


def test_numeric_from_text(spark):
    df = spark.createDataFrame([("a b",), (None,)], "reviewText string")
    assert [tuple(r)[1:] for r in tx.numeric_from_text(df).collect()] == [(3, 2), (0, 0)]
    assert [tuple(r)[1:] for r in tx.numeric_from_text(df, "gone").collect()] == [(-1, -1)] * 2


def test_combined_text(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(tx.combined_text("x", "y")).collect()] == ["a b", " b", "a "]


def test_tokens_keep_unicode_letters_and_numbers(spark):
    assert evaluate(spark, ["Don't É à_1 ½ x"], tx.tokens("t")) == [["don", "t", "é", "à_1", "½", "x"]]
    assert evaluate(spark, ["a bc d ef"], tx.tokens("t", 2)) == [["bc", "ef"]]


@pytest.mark.parametrize("words", [[], ["a"], ["a", "b"], ["a", "b", "a", "b", "c"]])
def test_ngrams(spark, words):
    want = sorted(" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    got = evaluate(spark, [" ".join(words)], tx.ngrams(tx.tokens("t"), 3))[0]
    assert sorted(got) == want


def test_term_counts(spark):
    got = evaluate(spark, ["b a b", ""], tx.term_counts(tx.tokens("t")))
    assert [(r["term"], r["tf"]) for r in got[0]] == [("a", 1), ("b", 2)]
    assert got[1] == []


def test_stop_words(spark):
    words = tx.without_stop_words(tx.tokens("t"), ["the"])
    assert evaluate(spark, ["the end of the"], words) == [["end", "of"]]


def test_word_statistics_take_one_pass(spark):
    """Words are counted and measured by one regex over the text, with the values of a plain split."""
    texts = ["", " ", " \t", "one", " two  words ", "a b\x1cc\x85d　", "x\n\ny z\r\n", "​é \U0001f600\U0001f600 ß", "it's - a  'b'"]
    out = tx.text_stats(spark.createDataFrame([(t, t) for t in texts], "reviewText string, summary string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 2 and "regexp_extract_all(" not in plan
    for r in out.collect():
        words = re.findall(r"[^\x20\xa0  -     　\t-\r\x1c-\x1f\x85]+", r["reviewText"])
        assert r["num_words"] == len(words)
        assert r["avg_word_length"] == (sum(map(len, words)) / len(words) if words else 0.0)
    null = spark.createDataFrame([(None,)], "t string").select(tx.avg_word_length("t"), tx.num_words("t")).first()
    assert tuple(null) == (None, None)
