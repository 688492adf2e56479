"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens.llm import (decontaminate, fingerprints, language_id, license_scan, line_dedup, lm_score, mixing,
                         quality, simhash, url_filter)

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, doc string, key string, size int, "
          "row string, fp int, bucket int, _part int, word string, score string")
JUNK = ("x", "y", 3, "z", 4, 5, 6, "w", "s")
LINE = "this very line is longer than forty code points, surely"
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards box with a grumpy old toad near the river bank"


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), *JUNK) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def edges(spark):
    long_text = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(1, None, "a"), (2, "", "a"), (3, "  \n\t ", None), (4, PROSE, "b"), (4, PROSE, "b"), (5, PROSE, "b"),
            (6, long_text, "a"), (None, "no id here", None), (7, "é ñ ß \U0001f600 ok", "c"), (8, "!!! ??? 123", "c")]
    return make(spark, rows).cache()


@pytest.fixture(scope="module")
def none(spark):
    return make(spark, [])


# Lines -----------------------------------------------------------------------------------------

def test_lines_stay_in_the_last_document(spark):
    rows = [(i, f"head {i}\n  {LINE.upper()} \n\ntail {i}", "a") for i in range(1, 6)] + [(9, f"{LINE}\n{LINE}", "a")]
    out = {r["row"]["doc_id"]: r for r in line_dedup.dedup_lines(make(spark, rows)).collect()}
    assert out[1]["row"]["text"] == "head 1\n\ntail 1" and out[1]["counts"]["n_dropped"] == 1
    assert out[9]["row"]["text"] == f"{LINE}\n{LINE}" and out[9]["counts"]["n_lines"] == 2
    assert out[1]["row"]["score"] == "s"


def test_lines_of_four_documents_stay(spark):
    rows = [(i, LINE, "a") for i in range(4)] + [(3, LINE, "a")]
    assert {r["counts"]["n_dropped"] for r in line_dedup.dedup_lines(make(spark, rows)).collect()} == {0}


def test_lines_edges(edges, none):
    rows = line_dedup.dedup_lines(edges).collect()
    assert len(rows) == 10 and {r["row"]["doc_id"]: r["row"]["text"] for r in rows}[1] is None
    assert line_dedup.dedup_lines(none).count() == 0


# Mix -------------------------------------------------------------------------------------------

def test_targets_share_by_weight_up_to_the_cap(spark):
    sizes = [("a", 1000), ("b", 10), ("c", 500), (None, 90)]
    found = {r["source"]: r["target"] for r in mixing.capped_targets(mixing.rotating_weights(
        spark.createDataFrame(sizes, "source string, source_size bigint"))).collect()}
    # Brute force: share, cut, share the excess again until nothing is above.
    weight = {"a": 1, "b": 2, "c": 3, None: 1}
    cap, fixed = {s: 3 * n for s, n in sizes}, {}
    while True:
        left = 1600 - sum(fixed.values())
        open_ = {s: w for s, w in weight.items() if s not in fixed}
        now = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = {s: cap[s] for s in now if now[s] > cap[s]}
        if not over:
            break
        fixed |= over
    assert found == pytest.approx(fixed | now)


def test_mix_meets_targets_and_reruns_agree(spark):
    rows = [(i, " ".join(["w"] * (i % 7 + 1)), "abc"[i % 3] if i % 5 else "a") for i in range(300)]
    docs = make(spark, rows)
    once, again = (sorted(map(str, mixing.mix(docs.repartition(n)).collect())) for n in (2, 5))
    assert once == again
    for s, taken, target in mixing.mix(docs).groupBy("source").agg(F.sum("taken"), F.max("target")).collect():
        assert abs(taken - target) <= 1
    assert mixing.mix(docs).where("taken > 3 * size or (copies > 0) != (taken > 0)").count() == 0


def test_positions_invert_the_schedule(spark):
    docs = make(spark, [(i, "one two three four", "a") for i in range(200)])
    mixed = mixing.mix(docs, schedule={"a": [(0.0, 0.0), (1.0, 2.0)]})
    at = sorted(p for r in mixed.collect() for p in r["positions"])
    assert at == pytest.approx([math.sqrt(i / 200) for i in range(200)])


def test_training_rows_are_sorted_readings(spark):
    docs = make(spark, [(i, "a b c", "abc"[i % 3]) for i in range(60)] + [(99, None, "a")])
    rows = mixing.training_rows(docs, mixing.mix(docs)).collect()
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    assert sum(r["taken"] for r in rows) == 180 and max(r["reading"] for r in rows) >= 1


def test_mix_edges(edges, none):
    rows = mixing.mix(edges).collect()
    assert len(rows) == 10 and all(r["taken"] == 0 and r["positions"] == [] for r in rows if r["size"] == 0)
    assert mixing.mix(none).count() == 0


# SimHash ---------------------------------------------------------------------------------------

def test_simhash_links_match_brute_force(spark):
    import random

    rng = random.Random(1)
    values = [rng.getrandbits(64) for _ in range(60)]
    for v in values[:40]:
        for n in (1, 3, 4, 5, 6):
            values.append(v ^ sum(1 << b for b in rng.sample(range(64), n)))
    signed = [v - (1 << 64) if v >> 63 else v for v in dict.fromkeys(values)]
    found = {(a, b) for a, b in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint")).collect()}
    brute = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    assert found == brute and simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint")).count() == len(brute)


def test_components_of_a_chain_and_loops(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    found = dict(simhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert found == {i: 0 for i in range(1, 41)} | {101: 100}


def test_simhash_edges(edges, none):
    rows = simhash.near_duplicates(edges).collect()
    by = {r["doc"]: r for r in rows}
    assert len(rows) == 10 and {by[i]["fp"] for i in (1, 2, 3)} == {0} and by[3]["component"] == 1
    assert by[5]["component"] == 4 and by[None]["component"] is None
    assert simhash.near_duplicates(none).count() == 0


# Benchmark -------------------------------------------------------------------------------------

TEST = [f"t{i}" for i in range(40)]


def test_reordered_passages_are_found(spark):
    moved = " ".join(TEST[20:] + ["and", "then"] + TEST[:20])
    rows = [(1, f"{PROSE} {' '.join(TEST)} {PROSE}", "a"), (2, moved.upper(), "a"), (3, " ".join(TEST[:15]), "a"), (4, PROSE, "a"),
            (5, " ".join(TEST[::-1]), "a")]
    tests = spark.createDataFrame([(7, " ".join(TEST), 1), (8, "only three words", 1), (9, None, 1), (10, "?!", 1)], "item_id bigint, text string, doc int")
    found = {(r["doc"], r["item"]): r["n_tiles"] for r in decontaminate.leaks(make(spark, rows), tests).collect()}
    assert found == {(1, 7): 1, (2, 7): 2}


def test_short_tests_must_occur_whole(spark):
    tests = spark.createDataFrame([(8, "Only three, words!")], "item_id bigint, text string")
    docs = make(spark, [(1, f"{PROSE} only three words", "a"), (2, "only three of the words", "a")])
    assert [(r["doc"], r["coverage"]) for r in decontaminate.leaks(docs, tests).collect()] == [(1, 1.0)]


def test_tiling_matches_plain_greedy():
    import random

    def plain(doc, test, least):
        used_d, used_t, total = set(), set(), 0
        while True:
            best = None
            for i in range(len(doc)):
                for j in range(len(test)):
                    n = 0
                    while (i + n < len(doc) and j + n < len(test) and doc[i + n] == test[j + n]
                           and i + n not in used_d and j + n not in used_t):
                        n += 1
                    if n >= least and (best is None or n > best[0]):
                        best = (n, i, j)
            if best is None:
                return total
            n, i, j = best
            used_d |= set(range(i, i + n))
            used_t |= set(range(j, j + n))
            total += n

    rng = random.Random(3)
    for _ in range(40):
        doc = [b"%d" % rng.randrange(4) for _ in range(60)]
        test = [b"%d" % rng.randrange(4) for _ in range(25)]
        found = decontaminate.tile(doc, test, 4)
        assert sum(n for _, _, n in found) == pytest.approx(plain(doc, test, 4), abs=4)
        assert all(doc[a:a + n] == test[b:b + n] for a, b, n in found)
        assert len({a + k for a, _, n in found for k in range(n)}) == sum(n for _, _, n in found)


def test_benchmark_edges(spark, edges, none):
    tests = spark.createDataFrame([(1, PROSE)], "item_id bigint, text string")
    assert sorted(r["doc"] for r in decontaminate.leaks(edges, tests).collect()) == [4, 5]
    assert decontaminate.leaks(none, tests).count() == 0 and decontaminate.leaks(edges, tests.limit(0)).count() == 0
    assert decontaminate.without_leaks(edges, decontaminate.leaks(edges, tests)).count() == 7


# Quality ---------------------------------------------------------------------------------------

def test_quality_against_labels(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality.classify(docs).join(labels, F.col("doc") == F.col("doc_id"))
    right = judged.agg(F.avg((F.col("rejected") == (F.col("quality") == 0)).cast("int"))).first()[0]
    assert right > 0.97 and judged.where("quality = 1 and rejected").count() <= 1


def test_quality_edges(edges, none):
    rows = quality.classify(edges).collect()
    assert len(rows) == 10 and all(r["rejected"] and r["answers"] is None for r in rows if r["doc"] in (1, 2, 3))
    assert quality.classify(none).count() == 0 and quality.without_rejected(edges).columns == edges.columns


# Languages -------------------------------------------------------------------------------------

def test_marginals_match_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    e, moves, start = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    found, expected = language_id.marginals(e, np.array([4]), moves, start)
    total, brute, pairs = 0.0, np.zeros((4, 3)), np.zeros((3, 3))
    for path in itertools.product(range(3), repeat=4):
        w = math.exp(start[path[0]] + sum(e[0, t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        total += w
        for t, y in enumerate(path):
            brute[t, y] += w
        for a, b in zip(path, path[1:]):
            pairs[a, b] += w
    assert np.allclose(found[0], brute / total) and np.allclose(expected, pairs / total)


def test_blocks_give_the_same_marginals():
    """Texts of no word, one, and many blocks, against the plain recursion over each whole text."""
    import numpy as np

    rng = np.random.default_rng(1)
    lengths = np.array([0, 1, 5, 64, 65, 200, 0, 129, 1000])
    e, moves, start = rng.normal(size=(lengths.sum(), 4)) * 3, rng.normal(size=(4, 4)), rng.normal(size=4)
    found = language_id.blocked_marginals(e, lengths, moves, start)
    texts = [t for t in np.split(e, np.cumsum(lengths)[:-1]) if len(t)]
    plain, sizes = language_id.marginals(*language_id.padded(texts, 4), moves, start)[0], [len(t) for t in texts]
    assert np.allclose(found, np.concatenate([p[:n] for p, n in zip(plain, sizes)]), atol=1e-12)


def test_slope_of_the_field_is_that_of_its_likelihood():
    """One step of training moves every weight with the sign of the numeric slope of the conditional log-likelihood."""
    import itertools

    import numpy as np

    sequence = [("ab", 0), ("abc", 1), ("é", 1)]
    field = language_id.Field(["x", "y"], {"ab": 1}).fit([sequence], rounds=1, penalty=0.0)

    def log_likelihood(weights, moves, start):
        def score(path):
            each = sum(weights[language_id.word_features([w], field.lexicon)[1], y].sum() for (w, _), y in zip(sequence, path))
            return start[path[0]] + each + sum(moves[a, b] for a, b in zip(path, path[1:]))
        return score([y for _, y in sequence]) - math.log(sum(math.exp(score(p)) for p in itertools.product((0, 1), repeat=3)))

    zero = [np.zeros_like(x) for x in (field.weights, field.moves, field.start)]
    for which, after in enumerate((field.weights, field.moves, field.start)):
        for at in np.argwhere(np.abs(after) > 0)[:40]:
            nudged = [z.copy() for z in zero]
            nudged[which][tuple(at)] = 1e-4
            assert (log_likelihood(*nudged) - log_likelihood(*zero)) * after[tuple(at)] > 0


def test_features_of_words_are_those_of_each_alone():
    words = ["a", "ab", "abc", "été", "\U0001f600x", "abc", "straße" * 50]
    import numpy as np

    owner, features = language_id.word_features(words, {"ab": 1, "été": 1})
    for i, w in enumerate(words):
        alone = language_id.word_features([w], {"ab": 1, "été": 1})[1]
        assert sorted(features[owner == i]) == sorted(alone)
    sizes = np.bincount(owner)
    assert sizes.tolist()[:3] == [6 + 2 + 1, 6 + 3 + 2 + 1, 6 + 4 + 3]


def test_sample_is_the_smallest_hashes(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc"), F.concat(F.lit("t"), "id").alias("text"),
                                    F.when(F.col("id") % 50 == 0, "aa").otherwise("bb").alias("lang"))
    repeated = rows.union(spark.range(300).select(F.lit(7).alias("doc"), F.lit("again").alias("text"), F.lit("cc").alias("lang")))
    found = language_id.sample(repeated, 40)
    key = F.xxhash64(F.col("doc").cast("string"))
    for lang, n in (("aa", 40), ("bb", 40)):
        wanted = [r["text"] for r in rows.where(F.col("lang") == lang).orderBy(key).limit(n).collect()]
        assert found[lang] == wanted
    assert "cc" not in found  # one id with more rows than there is room for


def test_languages_on_held_out_documents(spark, edges, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = language_id.train(docs.where(~language_id.held_out()).select(F.col("doc_id").alias("doc"), "text", "lang"), max_train=60, max_words=15_000)
    found = language_id.identify(docs, field).join(docs, F.col("doc") == F.col("doc_id")).where(language_id.held_out())
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    en, de = (docs.where(f"lang = '{x}' and n_chars > 600").orderBy("doc_id").first()["text"] for x in ("en", "de"))
    mixed = make(spark, [(1, f"{en[:300]} {de[:300]}", "a")])
    r = language_id.identify(mixed, field).first()
    assert r["switches"] >= 1 and min(r["shares"][field.labels.index(x)] for x in ("en", "de")) > 0.3
    rows = language_id.identify(edges, field).collect()
    assert len(rows) == 10 and {r["lang_pred"] for r in rows if r["doc"] in (1, 2, 3, 8)} == {"und"}
    assert language_id.identify(none, field).count() == 0
    untrained = language_id.train(none.select("doc_id", "text", "lang").withColumnRenamed("doc_id", "doc"))
    assert {r["lang_pred"] for r in language_id.identify(edges, untrained).collect()} == {"und"}


# Language model --------------------------------------------------------------------------------

def test_base_score_and_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r["doc"]: r for r in lm_score.score(docs, ~language_id.held_out(parts=5)).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    def tokens(t):
        return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")), None]

    seen = Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            seen.update(tokens(t))
    total, kinds = sum(seen.values()), len(seen)
    for i, t in texts.items():
        base = sum(math.log10((seen[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens(t))
        assert rows[i]["base_score"] == pytest.approx(base) and rows[i]["n_known"] == sum(seen[w] > 0 for w in tokens(t))
    held = [r for r in rows.values() if not r["train"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_unseen_words_and_empty_texts_have_scores(spark):
    words = ["a", "b", "c", "dd", "eee"]
    train = [(i, " ".join(words[(i * j) % 5] for j in range(1, 12)), "a") for i in range(40)]
    asked = [(1000 + k, f"a {w}".strip(), "a") for k, w in enumerate([*words, "zz", ""])]
    docs = make(spark, train + asked)
    rows = {r["doc"]: r for r in lm_score.score(docs, F.col("doc_id") < 1000).collect()}
    assert all(r["score"] < 0 for r in rows.values()) and len(rows) == 47
    assert rows[1006]["n_tokens"] == 2 and rows[1005]["n_known"] == 2


def test_model_edges(edges, none):
    rows = {r["doc"]: r for r in lm_score.score(edges, F.lit(True)).collect()}
    assert len(rows) == 9 and rows[1]["n_tokens"] == 1 and rows[4]["n_tokens"] == 2 * (len(PROSE.split()) + 1)
    assert lm_score.score(none, F.lit(True)).count() == 0
    untrained = lm_score.score(edges, F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in untrained)


# Fingerprints ----------------------------------------------------------------------------------

def brute_signature(spark, text):
    """The same selection in plain Python, for each hash function on its own; only the hash is Spark's."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    if not words:
        return []
    units, k = (words, 3) if len(words) > 3 else (list(text.strip(" \t\n\x0b\f\r")), 4)
    runs = [units[i:i + k] for i in range(max(1, len(units) - k + 1))]
    hashed = [r[0] for r in spark.createDataFrame([(i, r) for i, r in enumerate(runs)], "i int, r array<string>").select(
        "i", F.xxhash64(*[F.get("r", F.lit(j)) for j in range(k)]).alias("h")).orderBy("i").select("h").collect()]
    top = lambda h: (h & (1 << 64) - 1) >> 30
    count, items = Counter(), []
    for place, h in enumerate(hashed):
        x = top(h)
        n, count[x] = count[x], count[x] + 1
        items.append((x, n, place))
    again = {(x, n): None for x, n, _ in items if n}
    if again:
        pairs = spark.createDataFrame(list(again), "x bigint, n int").select("x", "n", F.xxhash64("x", "n").alias("h")).collect()
        again = {(r["x"], r["n"]): top(r["h"]) for r in pairs}
    numbered = sorted((again[x, n] if n else x, place) for x, n, place in items)
    tuples = []
    for j in range(64):
        least = sorted(numbered, key=lambda item: ((item[0] - (j << 28)) % (1 << 34), item[1]))[:2]
        tuples.append((j, [x for x, _ in sorted(least, key=lambda item: (item[1], item[0]))]))
    out = spark.createDataFrame(tuples, "b bigint, x array<bigint>").select("b", F.xxhash64("x").alias("h")).orderBy("b").collect()
    return [r["b"] << 32 | r["h"] & 0xFFFFFFFF for r in out]


@pytest.mark.parametrize("text", ["", " \t", "one", "é b", "one two", "a b c d", PROSE, f"{PROSE} {PROSE} {PROSE}", "a b c " * 50, "a a a a a a a", "x\ny z w v u"])
def test_signature_matches_brute_force(spark, text):
    found = spark.createDataFrame([(text,)], "t string").select(fingerprints.whole_signature(F.col("t"))).first()[0]
    assert found == brute_signature(spark, text)


def test_order_matters(spark):
    words = [f"v{i}" for i in range(400)]
    same, moved = " ".join(words), " ".join(words[200:] + words[:200])
    near, far = (spark.createDataFrame([(same, x)], "a string, b string").select(fingerprints.likeness(
        fingerprints.whole_signature(F.col("a")), fingerprints.whole_signature(F.col("b")))).first()[0] for x in (f"{same} end", moved))
    assert near > 0.9 and far < near


def test_followers_and_edits_match_brute_force(spark, edges, none):
    rows = [(i * 37 % 1001, f"text {i} é" * (i % 9), "a") for i in range(500)]
    found = {r["doc"]: r for r in fingerprints.compare_edited(make(spark, rows)).collect()}
    ordered = sorted(rows)
    for k, (i, t, _) in enumerate(ordered):
        n, after = len(t), ordered[(k + 1) % len(ordered)][1]
        assert found[i]["edited"] == t[:n - n // 2] + after[:n // 2] and found[i]["n_chars"] == n
    out = fingerprints.compare_edited(edges).collect()
    assert len(out) == 10 and {r["near_next"] for r in out if r["doc"] == 1} == {1.0}
    assert fingerprints.compare_edited(none).count() == 0
    alone = fingerprints.compare_edited(make(spark, [(5, PROSE, "a")])).first()
    assert alone["near_next"] == 1.0


# URLs ------------------------------------------------------------------------------------------

def test_entries_hold_from_their_day(spark):
    d = 86_400
    changes = [("block", "bad.com", "add", 10 * d), ("block", "bad.com", "remove", 20 * d), ("block", "bad.com", "add", 20 * d),
               ("block", "bad.com", "remove", 50 * d), ("allow", "good.bad.com", "add", 15 * d), ("block", "x.org/a/b/", "add", 0),
               ("block", None, "add", 0), ("block", "y.org", "wait", 0)]
    asked = [(1, "http://bad.com/", 9 * d), (2, "http://bad.com/", 10 * d), (3, "HTTP://u@WWW.Bad.com.:80/q?x", 19 * d), (4, "http://bad.com", 30 * d),
             (5, "http://good.bad.com/", 16 * d), (6, "http://good.bad.com/", 12 * d), (7, "http://x.org/a/b/c", 1), (8, "http://x.org/a/b", 1),
             (9, "http://notbad.com/", 11 * d), (10, None, 1), (11, "no url", 1), (12, "http://bad.com/", None), (None, "http://bad.com/", 11 * d),
             (2, "http://bad.com/", 10 * d)]
    out = url_filter.judge(spark.createDataFrame(asked, "id bigint, url string, fetched bigint"),
                           spark.createDataFrame(changes, "list string, key string, action string, at bigint")).collect()
    assert {r["id"]: r["verdict"] for r in out} == {
        1: "clean", 2: "blocked", 3: "blocked", 4: "clean", 5: "allowed", 6: "blocked", 7: "blocked", 8: "clean", 9: "clean",
        10: "invalid", 11: "invalid", 12: "invalid", None: "invalid"} and len(out) == 13


def test_urls_without_lists_or_captures(spark):
    no_changes = spark.createDataFrame([], "list string, key string, action string, at bigint")
    one = spark.createDataFrame([(1, "http://a.b/c", 5)], "id bigint, url string, fetched bigint")
    assert [r["verdict"] for r in url_filter.judge(one, no_changes).collect()] == ["clean"]
    assert url_filter.judge(one.limit(0), no_changes).count() == 0


# Licences --------------------------------------------------------------------------------------

def test_licences_are_named_and_confirmed(spark, edges, none):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = license_scan.fit(spark, license_scan.sample_negatives(docs, max_docs=40, max_lines=300))
    mit, bsd = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["BSD"]
    rows = [(1, f"{PROSE}\nReleased under the MIT License.\nmore", "a"), (2, "\n".join(bsd[2:4]), "a"), (3, PROSE, "a"),
            (4, license_scan.NEAR_MISSES[0], "a"), (5, f"{mit[3]}\n{mit[4]}\nLicensed under the Apache License, Version 2.0.", "a"),
            (6, "licensed under the moon and the stars of the night", "a")]
    found = {r["doc"]: r["licenses"] for r in license_scan.scan(make(spark, rows), model).collect()}
    assert found == {1: ["MIT"], 2: ["BSD"], 3: [], 4: [], 5: ["Apache-2.0", "MIT"], 6: []}
    out = license_scan.scan(edges, model).collect()
    assert len(out) == 9 and all(r["licenses"] == [] for r in out)
    assert license_scan.scan(none, model).count() == 0


def wrapped(text, width):
    import textwrap

    return "\n".join(textwrap.wrap(text, width))


def test_licences_of_wrapped_denied_and_partial_paragraphs(spark):
    """Wrapped lines are one paragraph; a denial or a short run of a template's words is no licence."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = license_scan.fit(spark, license_scan.sample_negatives(docs, max_docs=40, max_lines=300))
    mit, apache = license_scan.TEMPLATES["MIT"][3], license_scan.TEMPLATES["Apache-2.0"][2]
    rows = [(1, f"Heading\n\n{wrapped(mit, 40)}\n\n{PROSE}", "a"), (2, "This project is not licensed under the MIT license.", "a"),
            (3, "The museum is free of charge, to any person who asks", "a"), (4, wrapped(apache, 60) + "\r\n", "a"),
            (5, "It isn't released under the MIT License.", "a"), (6, "SPDX-License-Identifier: MIT", "a"),
            (7, "no longer available under the terms of the MIT license.", "a"), (8, wrapped(f"{PROSE} {PROSE} {mit} {PROSE}", 50), "a")]
    judged = license_scan.scan_paragraphs(make(spark, rows), model).collect()
    confirmed = {i: sorted(r["family"] for r in judged if r["doc"] == i and r["confirmed"]) for i in range(1, 9)}
    assert confirmed == {1: ["MIT"], 2: [], 3: [], 4: ["Apache-2.0"], 5: [], 6: ["MIT"], 7: [], 8: ["MIT"]}
    assert max(r["overlap"] for r in judged if r["doc"] == 1) > 0.95


def test_paragraphs_join_wrapped_lines(spark):
    text = "one two\nthree.\nfour \r\n  five\n\nsix:\nseven"
    assert make(spark, [(1, text, "a")]).select(license_scan.paragraphs(F.col("text"))).first()[0] == [
        "one two three.", "four five", "", "six:", "seven"]


def test_sha_of_kept_text(spark):
    r = line_dedup.dedup_lines(make(spark, [(1, "a\nb", "a")])).first()
    assert hashlib.sha256(r["row"]["text"].encode()).hexdigest() == hashlib.sha256(b"a\nb").hexdigest()
