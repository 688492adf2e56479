"""Cases of the second review: what the operators left out of the whole job."""

import math
import os
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from revlens.llm import fingerprints, language_id, lm_score, mixing, queries, simhash
from revlens.session import staging_dir
from test_llm_pipeline import make, prose


def test_near_dedup_matches_brute_force(spark):
    """Components over all pairs of fingerprints at most four bits apart; the smallest id of each stays."""
    rng, rows = random.Random(5), []
    for g in range(40):
        base = prose(g, rng.randrange(5, 400)).split()
        rows.append((len(rows), " ".join(base), "a"))
        for changes in (0, 1, 1, 2, 3, 8):
            words = list(base)
            for at in rng.sample(range(len(words)), min(changes, len(words))):
                words[at] = f"x{rng.random()}"
            rows.append((len(rows), " ".join(words), "a"))
    rows += [(1000, "", "a"), (1001, None, "a"), (1002, " \n", "a"), (1003, "Two words", "a"), (1004, "two  WORDS", "a")]
    prints = {i: plain_fingerprint(t) for i, t, _ in rows}
    root = {i: i for i in prints}

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 4:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    kept = {r["doc_id"] for r in corpus_pipeline.one_of_each(spark, make(spark, rows), "").collect()}
    assert kept == {find(i) for i in root} and 60 < len(kept) < len(rows) - 40


def test_more_shared_groups_find_the_same_links(spark):
    rng = random.Random(8)
    points = [rng.getrandbits(64) for _ in range(60)]
    points += [p ^ sum(1 << b for b in rng.sample(range(64), k)) for p in points for k in (1, 3, 4, 5)]
    signed = [p - (1 << 64) if p >> 63 else p for p in dict.fromkeys(points)]
    wanted = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    unique = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    for shared in (None, 3, 5, 6):
        assert {tuple(r) for r in simhash.links(unique, 4, shared=shared).collect()} == wanted
    sizes = [simhash.shared_groups(n, 4) for n in (1000, 300_000, 15_000_000, 10 ** 9)]
    assert sizes == sorted(sizes) and sizes[0] == 3 and sizes[-1] > 5


def plain_fingerprint(text):
    import xxhash

    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_match_a_plain_count_of_bits():
    rng = random.Random(3)
    for text in (None, "", " \t", "One", "a b c", "a b c d", "A b C d e", "x y " * 300, prose(1, 900), " ".join(rng.choices("abc", k=5000))):
        assert simhash.text_fingerprint(None if text is None else text.encode(), 4, block=1000) == plain_fingerprint(text)


def test_stages_take_columns_of_any_name_and_type(spark, folder):
    """Clashing names, dots and maps, together with null texts and ids and repeated rows, go through all stages unchanged."""
    rows = [(i, prose(i, 60), "ab"[i % 2]) for i in range(12)] + [(3, prose(3, 60), "b"), (3, prose(77, 60), "a"), (None, prose(50), "a"), (20, None, "a"), (21, "", None)]
    docs = make(spark, rows).withColumns({n: F.lit(i) for i, n in enumerate(("_doc", "_key", "doc", "row", "fp", "hash", "root", "key", "position"))})
    docs = docs.withColumn("a.b", F.lit("dot")).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        found = out.collect()
        assert [c for c in out.columns if c in docs.columns] == docs.columns
        kept = [r for r in found if r["doc_id"] == 5]
        assert kept and kept[0]["a.b"] == "dot" and kept[0]["m"] == {"k": 5} and kept[0]["_key"] == 1 and kept[0]["text"] == prose(5, 60), name


def test_rare_words_have_pairs_of_their_own(spark):
    """Words of like shape and frequency, x and y, p and q, are told apart by their pairs."""
    train = [(i, "a a a a a a a a b b b b b b b b xx pp" if i % 2 else "a a a a a a a a b b b b b b b b yy qq", "a") for i in range(60)]
    asked = [(1000, "xx pp", "a"), (1001, "xx qq", "a"), (1002, "yy qq", "a"), (1003, "yy pp", "a")]
    found = {r["doc"]: r["score"] for r in lm_score.score(make(spark, train + asked), F.col("doc_id") < 1000).collect()}
    assert found[1000] > found[1001] + 1 and found[1002] > found[1003] + 1


def test_scores_match_brute_force(spark, monkeypatch):
    """With fixed weights; the shares of all words, the end and one unknown after any word sum to one."""
    fixed = np.tile([0.6, 0.3, 0.1], (65, 1))
    fixed[0] = [0.0, 0.9, 0.1]
    monkeypatch.setattr(lm_score, "mixture_weights", lambda *_: fixed)
    rng = random.Random(2)
    texts = {i: " ".join(rng.choices("abcdefgh", weights=range(1, 9), k=12)) for i in range(60)} | {1000: "c zz a", 1001: "zz", 1002: "A b", 1003: ""}
    pairs, single = Counter(), Counter()
    for i, t in texts.items():
        seen = ["<s>", *t.lower().split(), "</s>"]
        if i < 1000:
            pairs.update(zip(seen, seen[1:]))
            single.update(seen)
    total, kinds = sum(single.values()) - single["<s>"], len(single) - 1

    def share(c, w):
        l = fixed[1 if single[c] else 0]
        return l[0] * pairs[c, w] / max(single[c], 1) + l[1] * single[w] / total + l[2] / (kinds + 1)

    assert sum(share("c", w) for w in [*"abcdefgh", "</s>", "zz"]) == pytest.approx(1.0)
    found = {r["doc"]: r["score"] for r in lm_score.score(make(spark, [(i, t, "a") for i, t in texts.items()]), F.col("doc_id") < 1000).collect()}
    for i, t in texts.items():
        seen = ["<s>", *t.lower().split(), "</s>"]
        assert found[i] == pytest.approx(sum(math.log10(share(c, w)) for c, w in zip(seen, seen[1:])))


AREAS = [lambda t: 0.5 * t + 0.5 * t * t, lambda t: 1.5 * t - 0.5 * t * t, lambda t: t]


def test_mixing_stage_follows_the_schedules(spark):
    """Words handed out by any time are the integrated schedule's: rising, falling, constant by rank of the source."""
    rows = [(i, "w " * (i % 5 + 1), "abc"[i % 3]) for i in range(600)]
    out = corpus_pipeline.training_order(spark, make(spark, rows), "").collect()
    assert [r["position"] for r in out] == sorted(r["position"] for r in out)
    for source, area in zip("abc", AREAS):
        mine = [r for r in out if r["source"] == source]
        total = sum(r["taken"] for r in mine)
        for t in (0.1, 0.25, 0.5, 0.75, 0.9):
            assert sum(r["taken"] for r in mine if r["position"] < t) == pytest.approx(total * area(t), abs=6)


def test_op2_comes_in_the_order_of_the_schedules(spark, folder):
    found = [r["doc_id"] for r in queries.op2_mixing(spark, folder).collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first = {r["doc"]: r["positions"][0] if r["positions"] else 2 for r in mixing.mix(docs, schedule=mixing.rotating_schedules).collect()}
    assert [first[i] for i in found] == sorted(first.values()) and len(set(first.values())) > 100


def test_null_and_repeated_ids_keep_their_readings(spark):
    rows = [(None, f"{prose(i)} n{i}", "a") for i in range(6)] + [(7, prose(20, 30), "a"), (7, prose(21, 90), "a"), (7, prose(21, 90), "b")]
    rows += [(8, prose(22), "b")] * 3 + [(i, prose(i), "c") for i in range(100, 110)]
    docs = make(spark, rows)
    out = corpus_pipeline.training_order(spark, docs, "").collect()
    mixed = mixing.mix(docs, schedule=mixing.rotating_schedules).collect()
    for source in "abc":
        assert sum(r["taken"] for r in out if r["source"] == source) == sum(r["taken"] for r in mixed if r["source"] == source)
    assert len(out) == sum(r["copies"] for r in mixed)
    assert sorted((r["doc"] or -1, r["source"], r["size"], p) for r in mixed for p in r["positions"]) == sorted(
        (r["doc_id"] or -1, r["source"], len(r["text"].split()), r["position"]) for r in out)
    assert len({(r["doc_id"], r["source"], r["text"]) for r in out}) == len({r["row"] for r in mixed if r["copies"]})
    assert all(0 < r["taken"] <= len(r["text"].split()) for r in out)


def test_near_dedup_keeps_each_text_of_an_id(spark):
    a, b = prose(1), prose(2)
    rows = [(3, a, "a"), (3, b, "a"), (4, a, "a"), (5, b, "a"), (3, b, "a"), (None, a, "a"), (None, prose(9), "b")]
    out = corpus_pipeline.one_of_each(spark, make(spark, rows), "").collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in out) == sorted([("3", a), ("3", b), ("None", a), ("None", prose(9))])


def test_language_of_glued_words_comes_from_all_of_them(spark, monkeypatch):
    vocabulary = {"aa": ["kato", "keto", "kito"], "bb": ["zuv", "zov", "zev"]}
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(vocabulary[x], k=40)), x) for i in range(40) for x in vocabulary]
    docs = spark.createDataFrame(rows, "doc bigint, text string, lang string")
    field = language_id.train(docs)
    glued = ",".join(["kato"] * 8 + rng.choices(vocabulary["bb"], k=60))
    asked = make(spark, [(1, glued, "a"), (2, ",".join(["kato"] * 3000 + ["zuv"] * 9000), "a"), (3, ",".join(["zuv"] * 10), "a")])
    assert {r["doc"]: r["lang_pred"] for r in language_id.identify(asked, field).collect()} == {1: "bb", 2: "bb", 3: "bb"}
    long = "kato\u00e9," * 3000
    monkeypatch.setattr(language_id, "CHARS", 1000)
    scores, lengths = language_id.Emissions(field).of([["kato", long, "..."], [], ["zuv"]])
    assert lengths.tolist() == [2, 0, 1]
    for row, word in zip(scores, ("kato", language_id.cleaned(long), "zuv")):
        owner, features = language_id.word_features([word], field.lexicon)
        assert not owner.any() and row == pytest.approx(field.weights[features].sum(0))


def test_a_very_long_document_does_not_end_the_sample(spark, monkeypatch):
    rows = [(i, "w " * (5000 if i % 3 == 0 else 10), "aa") for i in range(60)]
    seen = []
    monkeypatch.setattr(language_id, "switched", lambda chosen, rng: seen.extend(len(w) for _, w in chosen) or [])
    language_id.train(spark.createDataFrame(rows, "doc bigint, text string, lang string"), max_words=6000)
    assert seen.count(10) == 40 and seen.count(5000) == 1


def test_order_of_short_texts_matters(spark):
    """Turned-about sentences keep nearly all k-mers, but not their order."""
    pairs = []
    for n in (10, 20, 30, 60):
        w = [f"v{n}_{i}" for i in range(n)]
        pairs.append((n, " ".join(w), " ".join(w[n // 2:] + w[:n // 2])))
    pairs += [(1, "abcdefghijkl", "abcdefghijkx"), (2, "one two", "one two"), (3, "", " "), (4, "ab", "zz")]
    s = fingerprints.whole_signature
    rows = spark.createDataFrame(pairs, "n int, a string, b string").select("n", s(F.col("a")).alias("x"), s(F.col("b")).alias("y"))
    rows = {r["n"]: r for r in rows.withColumn("like", fingerprints.likeness(F.col("x"), F.col("y"))).collect()}
    for n in (10, 20, 30, 60):
        assert [t >> 32 for t in rows[n]["x"]] == list(range(64)) and rows[n]["like"] < 0.75
    assert 0.2 < rows[1]["like"] < 1 and rows[2]["like"] == rows[3]["like"] == 1.0 and rows[4]["like"] == 0.0
    whole = fingerprints.compare_edited(make(spark, [(n, a, "a") for n, a, _ in pairs])).collect()
    assert {len(r["signature"]) for r in whole if r["doc"] >= 10} == {64}


def test_language_model_leaves_little_on_disk(spark, monkeypatch):
    """Texts in many pieces have the scores of one, and what stays behind is less than the texts: neither pairs nor hashes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    shared = Path(staging_dir(spark).removeprefix("file:"))
    train = ~language_id.held_out(parts=5)
    before = set(shared.glob("*-*"))
    found = {r["doc"]: r for r in lm_score.score(docs, train).collect()}
    left = sum(p.stat().st_size for d in set(shared.glob("*-*")) - before for p in d.rglob("*.parquet"))
    assert 0 < left < os.path.getsize("/root/testdata/sf0.01/documents.parquet")
    monkeypatch.setattr(lm_score, "PIECE_TOKENS", 5000)
    monkeypatch.setattr(lm_score, "BUCKET_TOKENS", 20_000)
    texts = lm_score.encoded(docs.select(F.col("doc_id").alias("key"), "text", F.lit(1).alias("part")))
    assert texts.agg(F.sum("n"), F.sum(F.size("key"))).first()[:] == (sum(r["n_tokens"] for r in found.values()), len(found)) and texts.count() > 50
    for r in lm_score.score(docs, train).collect():
        assert r["n_known"] == found[r["doc"]]["n_known"] and r["train_tokens"] == found[r["doc"]]["train_tokens"]
        assert r["score"] == pytest.approx(found[r["doc"]]["score"]) and r["base_score"] == pytest.approx(found[r["doc"]]["base_score"])
