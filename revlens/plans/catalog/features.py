"""Text, time and sentiment features."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.functions import sentiment, text, timefeat
from revlens.operators.preprocess import preprocess, review_features
from revlens.plans.catalog import query
from revlens.session import spread
from revlens.sources.standin import document_reviews, event_reviews, order_times, table

# A lexicon of words that the given documents do use, so that every rule fires on them.
CORPUS = sentiment.Lexicon(
    positive=("the", "is", "it", "la", "on", "er", "ou"),
    negative=("of", "was", "by", "de", "an", "en"),
    negation=("not", "no", "and", "que", "und"),
)

SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def sql_clean(c: str) -> str:
    links = f"(http[^{SPACE}]+|www[^{SPACE}]+)"
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({c}), '<.*?>', '', 'g'),"
        f" '{links}', '', 'g'), '[^a-zA-Z0-9{SPACE}''-]', ' ', 'g'), '[{SPACE}]+', ' ', 'g'))"
    )


def sql_words(c: str) -> str:
    return f"len(regexp_extract_all({c}, '[^{SPACE}]+'))"


def sql_stats(c: str) -> str:
    """Word statistics of a text column, by lists instead of by lengths."""
    words = f"regexp_extract_all({c}, '[^{SPACE}]+')"
    return f"""
        length({c}) AS review_length, len({words}) AS num_words,
        round(coalesce(list_avg([length(w) FOR w IN {words}]), 0), 6) AS avg_word_length,
        round(length(regexp_replace({c}, '[^\\p{{Lu}}]', '', 'g')) / greatest(length({c}), 1), 6) AS uppercase_ratio,
        length({c}) - length(replace({c}, '!', '')) AS exclamation_count"""


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def sql_tokens(source: str, c: str) -> str:
    """tok(id, pos, w): one row per token."""
    return (
        f"lists AS (SELECT id, regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]+') AS ws FROM {source}),"
        " tok AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM lists)"
    )


def sql_stateful(source: str, c: str, lex: sentiment.Lexicon) -> str:
    """The set form: a word is turned iff the last negation lies at or after the previous
    sentiment word minus two."""
    p, n, neg = quoted(lex.positive), quoted(lex.negative), quoted(lex.negation)
    up = quoted(x + w for x in lex.prefixes for w in lex.positive if len(w) > 1)
    un = quoted(x + w for x in lex.prefixes for w in lex.negative if len(w) > 1)
    return f"""
    WITH {sql_tokens(source, c)},
    marks AS (
        SELECT id, pos, w IN ({neg}) AS is_turn,
               w NOT IN ({neg}) AND w IN ({p}) AS is_pos, w NOT IN ({neg}) AND w IN ({n}) AS is_neg,
               w NOT IN ({neg}) AND w IN ({up}) AS un_pos, w NOT IN ({neg}) AND w IN ({un}) AS un_neg
        FROM tok),
    seen AS (
        SELECT *, max(CASE WHEN is_turn THEN pos END) OVER before AS turned_at,
               max(CASE WHEN is_pos OR is_neg THEN pos END) OVER before AS word_at
        FROM marks
        WINDOW before AS (PARTITION BY id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    flags AS (
        SELECT *, turned_at IS NOT NULL AND (word_at IS NULL OR turned_at >= word_at - 2) AS turned FROM seen),
    sums AS (
        SELECT id,
            sum((is_pos AND NOT turned)::INT + (is_neg AND turned)::INT + un_neg::INT)::INT AS pos_count,
            sum((is_neg AND NOT turned)::INT + (is_pos AND turned)::INT + un_pos::INT)::INT AS neg_count
        FROM flags GROUP BY id)
    SELECT s.id, coalesce(pos_count, 0) AS pos_count, coalesce(neg_count, 0) AS neg_count,
           coalesce(pos_count, 0) - coalesce(neg_count, 0) AS polarity_score
    FROM {source} s LEFT JOIN sums USING (id)"""


def sql_window2(source: str, c: str, lex: sentiment.Lexicon) -> str:
    p, n, neg = quoted(lex.positive), quoted(lex.negative), quoted(lex.negation)
    up = quoted(x + w for x in lex.prefixes for w in lex.positive)
    return f"""
    WITH {sql_tokens(source, c)},
    near AS (
        SELECT id, w, coalesce(lag(w, 1) OVER o IN ({neg}), false) OR coalesce(lag(w, 2) OVER o IN ({neg}), false)
                      OR w IN ({up}) AS turned
        FROM tok WINDOW o AS (PARTITION BY id ORDER BY pos)),
    sums AS (
        SELECT id, sum((w IN ({p}) AND NOT turned)::INT)::INT AS pos_count,
               sum((w IN ({n}) OR (w IN ({p}) AND turned))::INT)::INT AS neg_count
        FROM near GROUP BY id)
    SELECT s.id, coalesce(pos_count, 0) AS pos_count, coalesce(neg_count, 0) AS neg_count,
           coalesce(pos_count, 0) - coalesce(neg_count, 0) AS polarity_score
    FROM {source} s LEFT JOIN sums USING (id)"""


DOCS = "(SELECT doc_id AS id, text FROM documents)"


def docs(spark, folder):
    return spread(table(spark, folder, "documents"), "doc_id")


def round6(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("clean_text_documents", f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents")
def clean_text_documents(spark, folder):
    return docs(spark, folder).select("doc_id", text.clean_text("text").alias("cleaned"))


@query(
    "clean_text_pages",
    f"SELECT page_id, {sql_clean('html')} AS cleaned, {sql_clean('url')} AS cleaned_url FROM pages",
)
def clean_text_pages(spark, folder):
    pages = spread(table(spark, folder, "pages"), "page_id")
    return pages.select(
        "page_id", text.clean_text("html").alias("cleaned"), text.clean_text("url").alias("cleaned_url")
    )


@query("text_stats", f"SELECT doc_id, {sql_stats('text')} FROM documents")
def text_stats(spark, folder):
    out = text.text_stats(docs(spark, folder), "text", None)
    return round6(out, "avg_word_length", "uppercase_ratio").select(
        "doc_id", "review_length", "num_words", "avg_word_length", "uppercase_ratio", "exclamation_count"
    )


@query("text_stats_pages", f"SELECT page_id, {sql_stats('html')} FROM pages")
def text_stats_pages(spark, folder):
    out = text.text_stats(spread(table(spark, folder, "pages"), "page_id"), "html", None)
    return round6(out, "avg_word_length", "uppercase_ratio").select(
        "page_id", "review_length", "num_words", "avg_word_length", "uppercase_ratio", "exclamation_count"
    )


SQL_REVIEWS = """(
    SELECT doc_id AS id, text AS reviewText, source || ' ' || lang AS summary, lang AS category,
           source AS reviewerID, 1388534400 + doc_id * 86399 AS unixReviewTime,
           CASE WHEN doc_id % 3 <> 0
                THEN strftime(make_timestamp((1388534400 + doc_id * 86399) * 1000000), '%m %-d, %Y') END AS reviewTime
    FROM documents)"""

SQL_PREPROCESSED = f"""
    WITH cleaned AS (
        SELECT id, {sql_clean('reviewText')} AS reviewText, {sql_clean('summary')} AS summary,
               coalesce(try_strptime(reviewTime, '%m %d, %Y'), make_timestamp(unixReviewTime * 1000000)) AS review_date
        FROM {SQL_REVIEWS})
    SELECT id, reviewText, summary, review_date,
        coalesce(year(review_date), 0) AS review_year, coalesce(month(review_date), 0) AS review_month,
        coalesce(day(review_date), 0) AS review_day, coalesce(isodow(review_date) - 1, 0) AS review_dayofweek,
        coalesce(hour(review_date), 0) AS review_hour, {sql_stats('reviewText')},
        length(summary) AS summary_length
    FROM cleaned"""

PREPROCESSED = [
    "id", "reviewText", "summary", "review_date", "review_year", "review_month", "review_day",
    "review_dayofweek", "review_hour", "review_length", "num_words", "avg_word_length",
    "uppercase_ratio", "exclamation_count", "summary_length",
]


@query("preprocess_reviews", SQL_PREPROCESSED)
def preprocess_reviews(spark, folder):
    out = preprocess(spread(document_reviews(spark, folder), "id"))
    return round6(out, "avg_word_length", "uppercase_ratio").select(*PREPROCESSED)


@query(
    "combined_text",
    "SELECT doc_id AS id, coalesce(nullif(text, ''), '') || ' ' ||"
    " CASE WHEN doc_id % 4 = 0 THEN '' ELSE source || ' ' || lang END AS combined_text FROM documents",
)
def combined_text(spark, folder):
    reviews = document_reviews(spark, folder).withColumn(
        "summary", F.when(F.col("id") % 4 != 0, F.col("summary"))
    )
    return reviews.select("id", text.combined_text("reviewText", "summary").alias("combined_text"))


@query(
    "numeric_from_text",
    f"SELECT conv_id, turn, length(text) AS review_length, {sql_words('text')} AS num_words,"
    " -1 AS absent_length, -1 AS absent_words FROM conversations",
)
def numeric_from_text(spark, folder):
    found = text.numeric_from_text(spread(table(spark, folder, "conversations"), "conv_id", "turn"), "text")
    kept = found.withColumnsRenamed({"review_length": "_l", "num_words": "_n"})
    absent = text.numeric_from_text(kept, "no_such_column")
    return absent.select(
        "conv_id", "turn", F.col("_l").alias("review_length"), F.col("_n").alias("num_words"),
        F.col("review_length").alias("absent_length"), F.col("num_words").alias("absent_words"),
    )


SQL_TIMES = """(
    SELECT o_orderkey AS id,
        CASE WHEN o_orderkey % 7 = 0 THEN 'on ' ELSE '' END || strftime(o_orderdate, '%m %-d, %Y') AS reviewTime,
        CASE WHEN o_orderkey % 5 <> 0 THEN epoch(o_orderdate)::BIGINT + 3600 * (o_orderkey % 24) END AS unixReviewTime
    FROM orders)"""

SQL_PARSED = f"""
    WITH parsed AS (
        SELECT id, try_strptime(reviewTime, '%m %d, %Y') AS p, make_timestamp(unixReviewTime * 1000000) AS u
        FROM {SQL_TIMES})"""


@query(
    "review_time_features",
    f"""{SQL_PARSED}, dated AS (SELECT id, coalesce(p, u) AS review_date FROM parsed)
    SELECT id, review_date, coalesce(year(review_date), 0) AS review_year,
        coalesce(month(review_date), 0) AS review_month, coalesce(day(review_date), 0) AS review_day,
        coalesce(isodow(review_date) - 1, 0) AS review_dayofweek, coalesce(hour(review_date), 0) AS review_hour
    FROM dated""",
)
def review_time_features(spark, folder):
    return timefeat.review_time_features(order_times(spark, folder)).select(
        "id", "review_date", "review_year", "review_month", "review_day", "review_dayofweek", "review_hour"
    )


AGE = ["id", "review_hour", "review_weekday", "review_days_since"]


def sql_age(date: str) -> str:
    return f"""
        coalesce(hour({date}), -1) AS review_hour, coalesce(isodow({date}) - 1, -1) AS review_weekday,
        coalesce(floor((epoch_us(TIMESTAMP '2000-06-15 10:30:00') - epoch_us({date})) / 86400000000.0)::INT, -1)
            AS review_days_since"""


@query("review_time_all_or_nothing", f"{SQL_PARSED} SELECT id, {sql_age('p')} FROM parsed")
def review_time_all_or_nothing(spark, folder):
    """Some texts parse, so no row falls back to its epoch seconds."""
    out = timefeat.review_time_features(
        order_times(spark, folder), missing=-1, fallback="all", asof="2000-06-15 10:30:00"
    )
    return out.select(*AGE)


@query("review_time_all_failed", f"{SQL_PARSED} SELECT id, {sql_age('u')} FROM parsed")
def review_time_all_failed(spark, folder):
    """No text parses, so every row falls back."""
    spoiled = order_times(spark, folder).withColumn("reviewTime", F.concat(F.lit("on "), "reviewTime"))
    out = timefeat.review_time_features(spoiled, missing=-1, fallback="all", asof="2000-06-15 10:30:00")
    return out.select(*AGE)


@query(
    "lenient_dates",
    f"""
    WITH texts AS (
        SELECT o_orderkey AS id, CASE o_orderkey % 4
            WHEN 0 THEN strftime(o_orderdate, '%m %-d, %Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
            WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE 'unknown' END AS reviewTime
        FROM orders),
    dated AS (
        SELECT id, coalesce(try_strptime(reviewTime, '%m %d, %Y'), try_strptime(reviewTime, '%Y-%m-%d'),
                            try_strptime(reviewTime, '%m/%d/%Y')) AS d FROM texts)
    SELECT id, {sql_age('d')} FROM dated""",
)
def lenient_dates(spark, folder):
    forms = ["MM d, yyyy", "yyyy-MM-dd", "MM/dd/yyyy"]
    text_of_day = F.lit("unknown")
    for i, f in enumerate(forms):
        text_of_day = F.when(F.col("o_orderkey") % 4 == i, F.date_format("o_orderdate", f)).otherwise(text_of_day)
    dates = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), text_of_day.alias("reviewTime"))
    out = timefeat.review_time_features(
        dates, missing=-1, fallback="none", asof="2000-06-15 10:30:00", formats=timefeat.LENIENT_FORMATS
    )
    return out.select(*AGE)


@query("sentiment_stateful", sql_stateful(DOCS, "text", sentiment.STATEFUL))
def sentiment_stateful(spark, folder):
    rows = docs(spark, folder).withColumnRenamed("doc_id", "id")
    return sentiment.add_sentiment(rows, "text").select("id", "pos_count", "neg_count", "polarity_score")


@query("sentiment_stateful_corpus", sql_stateful(DOCS, "text", CORPUS))
def sentiment_stateful_corpus(spark, folder):
    rows = docs(spark, folder).withColumnRenamed("doc_id", "id")
    return sentiment.add_sentiment(rows, "text", CORPUS).select("id", "pos_count", "neg_count", "polarity_score")


@query("sentiment_window2", sql_window2(DOCS, "text", sentiment.WINDOW))
def sentiment_window2(spark, folder):
    rows = docs(spark, folder).withColumnRenamed("doc_id", "id")
    out = sentiment.add_sentiment(rows, "text", form="window2")
    return out.select("id", "pos_count", "neg_count", "polarity_score")


@query("sentiment_window2_corpus", sql_window2(DOCS, "text", CORPUS))
def sentiment_window2_corpus(spark, folder):
    rows = docs(spark, folder).withColumnRenamed("doc_id", "id")
    out = sentiment.add_sentiment(rows, "text", CORPUS, form="window2")
    return out.select("id", "pos_count", "neg_count", "polarity_score")


@query(
    "sentiment_weighted",
    f"""SELECT id, pos_count * 1.5::DOUBLE AS pos_count, neg_count * 1.5::DOUBLE AS neg_count,
        polarity_score * 1.5::DOUBLE AS polarity_score
    FROM ({sql_stateful(DOCS, 'text', CORPUS)})""",
)
def sentiment_weighted(spark, folder):
    return sentiment.weighted(sentiment_stateful_corpus(spark, folder), 1.5)


@query(
    "sentiment_vs_label",
    f"""
    SELECT CASE WHEN quality = 1 THEN 'Positive' ELSE 'Negative' END AS expected,
           CASE WHEN polarity_score > 0 THEN 'Positive' WHEN polarity_score < 0 THEN 'Negative' ELSE 'Neutral' END
               AS extracted, count(*) AS reviews
    FROM ({sql_stateful(DOCS, 'text', CORPUS)}) s JOIN labels l ON l.doc_id = s.id GROUP BY ALL""",
)
def sentiment_vs_label(spark, folder):
    """Polarity sign next to the hand label."""
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), "quality")
    sign = F.when(F.col("polarity_score") > 0, "Positive").when(F.col("polarity_score") < 0, "Negative")
    return (
        sentiment_stateful_corpus(spark, folder)
        .join(labels, "id")
        .groupBy(
            F.when(F.col("quality") == 1, "Positive").otherwise("Negative").alias("expected"),
            sign.otherwise("Neutral").alias("extracted"),
        )
        .agg(F.count("*").alias("reviews"))
    )


@query(
    "review_features_by_category",
    f"""
    WITH cleaned AS (
        SELECT doc_id AS id, lang AS category, source AS reviewerID, {sql_clean('text')} AS text,
               {sql_clean("source || ' ' || lang")} AS summary FROM documents),
    stats AS (SELECT id, category, reviewerID, {sql_stats('text')}, length(summary) AS summary_length FROM cleaned),
    freq AS (SELECT reviewerID, count(*) AS reviewer_freq FROM cleaned GROUP BY 1),
    feel AS ({sql_stateful("(SELECT id, text FROM cleaned)", 'text', CORPUS)})
    SELECT category, count(*) AS reviews, sum(review_length) AS chars, sum(num_words) AS words,
        round(avg(avg_word_length), 6) AS avg_word_length, sum(summary_length) AS summary_chars,
        sum(pos_count) AS pos_count, sum(neg_count) AS neg_count, sum(polarity_score) AS polarity_score,
        sum(reviewer_freq) AS reviewer_freq
    FROM stats JOIN feel USING (id) JOIN freq USING (reviewerID) GROUP BY category""",
)
def review_features_by_category(spark, folder):
    """Flagship: the whole feature table, then one row per category."""
    features = review_features(spread(document_reviews(spark, folder), "id"), lexicon=CORPUS)
    return features.groupBy("category").agg(
        F.count("*").alias("reviews"),
        F.sum("review_length").alias("chars"),
        F.sum("num_words").alias("words"),
        F.round(F.avg(F.round("avg_word_length", 6)), 6).alias("avg_word_length"),
        F.sum("summary_length").alias("summary_chars"),
        F.sum("pos_count").alias("pos_count"),
        F.sum("neg_count").alias("neg_count"),
        F.sum("polarity_score").alias("polarity_score"),
        F.sum("reviewer_freq").alias("reviewer_freq"),
    )


@query(
    "rating_features_by_category",
    """
    WITH rated AS (
        SELECT user_id, event_type AS category, least(5, 1 + floor(value / 25)) AS overall, ts FROM events),
    freq AS (SELECT user_id, count(*) AS n FROM rated GROUP BY 1)
    SELECT category, overall::INT AS overall, count(*) AS reviews, sum(n) AS reviewer_freq, sum(hour(ts)) AS hours
    FROM rated JOIN freq USING (user_id) GROUP BY ALL""",
)
def rating_features_by_category(spark, folder):
    """Ratings with reviewer frequency, without text."""
    from revlens.operators.frequency import key_frequency

    rated = key_frequency(event_reviews(spark, folder), "reviewerID", row_id="id")
    return rated.groupBy("category", "overall").agg(
        F.count("*").alias("reviews"),
        F.sum("reviewer_freq").alias("reviewer_freq"),
        F.sum(F.hour("ts")).alias("hours"),
    )
