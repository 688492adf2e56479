"""Text cleaning, word statistics and tokens as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The characters that count as white space, as a regex class body. Class names and
# ASCII ranges only: the regex engine is an order of magnitude slower on a negated class that
# lists single characters beyond them.
SPACE = r"\p{Z}\t-\r\x1c-\x1f\x85"
WORD_CHAR = r"[\p{L}\p{N}_]"
NOT_SPACE_RUN = f"[^{SPACE}]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Lower case, tags and links removed, everything but ASCII letters, digits, ' and - blanked.

    Blanking and white-space folding are one pass: both turn a run of other characters into one
    space. A tag does not reach over a line break.
    """
    text = F.lower(_col(c))
    text = F.regexp_replace(text, r"<[^>\n]*>", "")
    text = F.regexp_replace(text, f"(?:http|www){NOT_SPACE_RUN}", "")
    text = F.regexp_replace(text, r"[^\p{Alnum}'-]+", " ")
    return F.trim(text)


def num_words(c: Column | str) -> Column:
    return F.regexp_count(_col(c), F.lit(NOT_SPACE_RUN)).cast("int")


def word_sizes(c: Column | str) -> Column:
    """struct<words, letters>: the number of words and of their characters, from one pass over the text.

    With one space between words, the spaces are one fewer than the words.
    """
    spaced = F.trim(F.regexp_replace(_col(c), f"[{SPACE}]+", " "))
    # One-element transforms: each value is computed once.
    both = F.transform(F.array(spaced), lambda s: F.struct(F.length(s).alias("all"), F.length(F.replace(s, F.lit(" "), F.lit(""))).alias("letters")))
    return F.transform(both, lambda s: F.struct(
        F.when(s["letters"] == 0, F.lit(0)).otherwise(s["all"] - s["letters"] + 1).alias("words"), s["letters"].alias("letters")))[0]


def mean_size(sizes: Column) -> Column:
    return F.when(sizes["words"] == 0, F.lit(0.0)).otherwise(sizes["letters"] / sizes["words"])


def avg_word_length(c: Column | str) -> Column:
    """Mean word length; the words' characters are what is left without white space."""
    return F.transform(F.array(word_sizes(c)), mean_size)[0]


def uppercase_ratio(c: Column | str) -> Column:
    upper = F.length(F.regexp_replace(_col(c), r"[^\p{IsUppercase}]+", ""))
    return upper / F.greatest(F.length(_col(c)), F.lit(1))


def exclamation_count(c: Column | str) -> Column:
    return (F.length(_col(c)) - F.length(F.replace(_col(c), F.lit("!"), F.lit("")))).cast("int")


def combined_text(text: Column | str, summary: Column | str) -> Column:
    blank = F.lit("")
    return F.concat(F.coalesce(_col(text), blank), F.lit(" "), F.coalesce(_col(summary), blank))


def text_stats(df: DataFrame, text: str = "reviewText", summary: str | None = "summary") -> DataFrame:
    """Lengths, word counts and character ratios of a text column that holds no NULL."""
    columns = {
        "review_length": F.length(text).cast("int"),
        "num_words": F.col("_sizes.words"),
        "avg_word_length": mean_size(F.col("_sizes")),
        "uppercase_ratio": uppercase_ratio(text),
        "exclamation_count": exclamation_count(text),
    }
    if summary:
        columns["summary_length"] = F.length(summary).cast("int")
    return df.withColumn("_sizes", word_sizes(text)).withColumns(columns).drop("_sizes")


def numeric_from_text(df: DataFrame, text: str = "reviewText") -> DataFrame:
    """`review_length` and `num_words`; both -1 when the table has no such column."""
    if text not in df.columns:
        return df.withColumns({"review_length": F.lit(-1), "num_words": F.lit(-1)})
    filled = df.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    return filled.withColumns(
        {"review_length": F.length(text).cast("int"), "num_words": num_words(text)}
    )


def clean_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fill and clean each named column that exists."""
    return df.withColumns(
        {n: clean_text(F.coalesce(F.col(n), F.lit(""))) for n in names if n in df.columns}
    )


def tokens(c: Column | str, min_length: int = 1) -> Column:
    """Lower-cased word tokens of at least `min_length` characters."""
    return F.regexp_extract_all(
        F.lower(_col(c)), F.lit(f"{WORD_CHAR}{{{min_length},}}"), F.lit(0)
    )


def without_stop_words(words: Column, stop_words: list[str]) -> Column:
    return F.filter(words, lambda w: ~w.isin(stop_words)) if stop_words else words


def ngrams(words: Column, n_max: int) -> Column:
    """All n-grams of 1..n_max tokens, joined by a space."""

    def expand(seq: Column) -> Column:
        parts = [seq]
        for n in range(2, n_max + 1):
            count = F.greatest(F.size(seq) - (n - 1), F.lit(0))
            shorter = F.slice(parts[-1], F.lit(1), count)
            ends = F.slice(seq, F.lit(n), count)
            parts.append(F.zip_with(shorter, ends, lambda gram, word: F.concat(gram, F.lit(" "), word)))
        return F.concat(*parts)

    if n_max == 1:
        return words
    # One-element transform: evaluates the token array once and binds it for the lambdas.
    return F.transform(F.array(words), expand)[0]


def term_counts(words: Column) -> Column:
    """array<struct<term, tf>> of one row's tokens, without any shuffle.

    Sorts the tokens and measures the runs; linear after the sort.
    """

    def runs(seq: Column) -> Column:
        n = F.size(seq)
        starts = F.filter(
            F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
            lambda i: (i == 0) | (F.get(seq, i) != F.get(seq, i - 1)),
        )
        return F.transform(
            F.array(starts),
            lambda s: F.transform(
                s,
                lambda at, j: F.struct(
                    F.get(seq, at).alias("term"),
                    (F.coalesce(F.get(s, j + 1), n) - at).alias("tf"),
                ),
            ),
        )[0]

    return F.transform(F.array(F.sort_array(words)), runs)[0]
