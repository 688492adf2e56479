"""The pipeline's stages on planted cases, each judged on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from revlens.llm import simhash

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed, n=120):
    import random

    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeioutnsrl") for _ in range(rng.randrange(2, 9))) for _ in range(n)).capitalize() + "."


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], COLUMNS)


def test_stages_keep_the_columns_and_the_order(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "mixing"]
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and 0 < docs.count() <= before
        assert docs.select("doc_id").distinct().count() == docs.count()
        before = docs.count()
    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert set(docs.columns) < set(out.columns)


def test_near_duplicates_leave_one(spark):
    base = prose(1, 400)
    words = base.split()
    words[200] = "changed"
    apart = simhash.text_fingerprint(base.encode(), 4) ^ simhash.text_fingerprint(" ".join(words).encode(), 4)
    assert apart.bit_count() <= 4
    rows = [(5, base, "a"), (3, base, "a"), (3, base, "a"), (9, " ".join(words), "a"), (7, prose(2), "a"), (None, prose(3), "a")]
    out = corpus_pipeline.one_of_each(spark, make(spark, rows), "").collect()
    ids = sorted((r["doc_id"] for r in out), key=str)
    assert ids == [3, 7, None]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_empty_table(spark, folder, stage):
    assert stage(spark, make(spark, []), folder).count() == 0


def test_decontamination_drops_only_leaks(spark, folder):
    item = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(1, f"{prose(4)} {item} {prose(5)}", "a"), (2, prose(6), "a"), (None, item, "a")]
    out = corpus_pipeline.no_benchmark(spark, make(spark, rows), folder)
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == [2, None]


def test_line_stage_updates_the_length(spark):
    line = "a line of boilerplate that is long enough to count as shared"
    rows = [(i, f"{prose(i)}\n{line}", "a") for i in range(6)]
    out = corpus_pipeline.fresh_lines(spark, make(spark, rows), "")
    assert out.where(F.length("text") != F.col("n_chars")).count() == 0
    assert [r["doc_id"] for r in out.where(F.col("text").contains(line)).collect()] == [5]


@pytest.mark.parametrize("stage", [corpus_pipeline.one_of_each, lambda spark, docs, folder: simhash.near_duplicates(docs)])
def test_no_table_of_cells_is_broadcast(spark, monkeypatch, stage):
    """The cells are many times the points that the planner takes them for; the driver must not gather them."""
    plans, staged = {}, simhash.staged

    def seen(df, name, *args, **kwargs):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staged(df, name, *args, **kwargs)

    monkeypatch.setattr(simhash, "staged", seen)
    rows = [(i, prose(i), "a") for i in range(6)] + [(9, prose(2), "a")]
    assert stage(spark, make(spark, rows), "").count() in (6, 7)
    assert "SortMergeJoin" in plans["links"] and "Broadcast" not in plans["links"]
