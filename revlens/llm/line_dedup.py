"""Lines that many documents share are dropped from all but one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from revlens.llm.text import SPACES, checked_broadcast, lower_ascii, narrow
from revlens.session import staged


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def shared_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(doc, key) of every long line, and (key, last) of the keys found in at least `min_docs` documents."""
    rows = narrow(docs, doc=id_col, text=text_col).where("doc is not null")
    keys = F.filter(F.transform(F.split("text", "\n", -1), line_key), lambda k: F.length(k) >= min_chars)
    lines = staged(rows.select("doc", F.explode(F.array_distinct(F.transform(keys, F.md5))).alias("key")), "lines")
    common = (
        lines.groupBy("key")
        .agg(F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("last"))
        .where(F.col("n_docs") >= min_docs)
    )
    return lines, staged(common.select("key", "last"), "shared-lines")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                min_docs: int = 5) -> DataFrame:
    """`docs` with `text` less its shared lines, and `n_lines` (before), `n_dropped` in front of the rest.

    A line's key is the line without ASCII spaces at its ends and with A-Z lower-cased; keys are
    compared by MD5. A key of `min_chars` code points that occurs in `min_docs` documents stays
    only in the one with the largest id, with all its lines there. Lines keep their order. The
    lines that a document loses come back to it as one array, so texts are shuffled once and only
    long lines' hashes are exploded; a line in a third of the documents is counted in two steps,
    by (key, document) and then by key.

    Null or empty text is one empty line and stays as it is; a row without id loses nothing and
    counts for nothing; rows that repeat an id are one document and lose the same lines. The
    result has two columns, `counts` struct<n_lines, n_dropped> and `row`, the input's row with the
    new text, so that no column of the input can clash.
    """
    lines, common = shared_lines(docs, id_col, text_col, min_chars, min_docs)
    lost = (
        lines.join(checked_broadcast(common, 200_000), "key").where(F.col("doc") != F.col("last"))
        .groupBy("doc").agg(F.collect_set("key").alias("lost"))
    )
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_key"), F.col(f"`{text_col}`").alias("old"), F.struct("*").alias("row"))
    joined = rows.join(lost, F.col("doc_key") == F.col("doc"), "left")
    split = F.split(F.coalesce("old", F.lit("")), "\n", -1)
    kept = F.filter(split, lambda x: ~F.array_contains(F.col("lost"), F.md5(line_key(x))))
    kept = F.when(F.col("lost").isNull(), split).otherwise(kept)
    text = F.when(F.col("lost").isNull(), F.col("old")).otherwise(F.array_join("kept", "\n"))
    return joined.withColumn("kept", kept).select(
        F.struct(
            F.size(split).cast("bigint").alias("n_lines"),
            (F.size(split) - F.size("kept")).cast("bigint").alias("n_dropped"),
        ).alias("counts"),
        F.col("row").withField(f"`{text_col}`", text).alias("row"),
    )
