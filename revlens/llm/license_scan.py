"""Licence paragraphs in documents: a classifier trained on templates, and the templates confirm what it says."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from revlens.llm.text import cutoff, let, narrow
from revlens.session import staged

# Sentences of public licences and the lines that name them.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "To view a copy of this license, visit https://creativecommons.org/licenses/by/4.0/.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "To view a copy of this license, visit https://creativecommons.org/licenses/by-sa/4.0/.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "To view a copy of this license, visit https://creativecommons.org/licenses/by-nc/4.0/.",
    ],
    "Proprietary": [
        "All rights reserved. No part of this publication may be reproduced, distributed or transmitted in any form or by any means without the prior written permission of the publisher.",
        "This software is proprietary and confidential; unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}
# Lines that speak of licences or permission without granting one.
NEAR_MISSES = [
    "He lost his driving license after the accident and had to take the test again.",
    "The city council may grant a license to operate a taxi under the new rules.",
    "You must obtain permission from the owner before you enter the property.",
    "The warranty covers parts and labour for a period of two years from purchase.",
    "Free of charge admission to the museum on the first Sunday of the month.",
    "The copyright debate continued in parliament without a result for either side.",
    "Please read the terms and conditions of this contest before you take part in it.",
    "She published a copy of the letter and the notes to the files of the archive.",
    "The distribution of the software was delayed and the company changed the version.",
    "Under the general agreement the public may use the work of the foundation.",
]
UNKNOWN = "unknown"
# A denial right before one of these verbs takes a licence back, unless a template says so itself.
DENIALS = ("not", "never", "longer", "t")
VERBS = ("licensed", "released", "available", "distributed", "covered", "offered", "published")
LEAST_RUNS = 8  # three-word runs that a part of a template must share with a paragraph to confirm it


def words_of(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")


def grams(words: Column, n: int) -> Column:
    """Hashes of all runs of `n` words."""
    def runs(w: Column) -> Column:
        last = F.size(w) - n
        found = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(n)]))
        return F.when(last < 0, F.expr("array()").cast("array<bigint>")).otherwise(found)

    return let(words, runs)


def features(words: Column) -> Column:
    """Distinct one-, two- and three-word runs."""
    return let(words, lambda w: F.array_distinct(F.concat(grams(w, 1), grams(w, 2), grams(w, 3))))


def paragraphs(text: Column) -> Column:
    """The text's paragraphs: lines, with wrapped ones joined.

    A line goes on in the next one unless either is blank or it ends like a sentence.
    """
    return F.split(F.regexp_replace(text, r"(?<![.!?:;\s])[ \t\r]*\n[ \t]*(?=\S)", " "), "\n", -1)


def shared_runs(rows: DataFrame, shapes: DataFrame) -> DataFrame:
    """(words, of, both, n, m): how many of a paragraph's `n` runs (threes) each template, of `m` runs, has too."""
    ours = rows.select("words", F.size("threes").alias("n"), F.explode("threes").alias("gram"))
    theirs = shapes.select(F.col("family").alias("of"), F.xxhash64("theirs").alias("template"), F.size("theirs").alias("m"),
                           F.explode("theirs").alias("gram"))
    return ours.join(F.broadcast(theirs), "gram").groupBy("words", "of", "template", "n", "m").agg(F.count("*").alias("both"))


def template_shapes(lines: DataFrame) -> DataFrame:
    """(family, theirs): the different three-word runs of each template."""
    return lines.select("family", F.array_distinct(grams(F.col("words"), 3)).alias("theirs")).where(F.size("theirs") > 0)


def confirming_share(both: Column, n: Column, m: Column) -> Column:
    """How much of the template the paragraph has, or how much of the paragraph the template has, if that is `LEAST_RUNS` at least."""
    return F.greatest(both / m, F.when(both >= LEAST_RUNS, both / n).otherwise(0.0))


def denials(spark: SparkSession, lines: DataFrame) -> list[int]:
    """Hashes of the two-word runs that deny a licence and that no template has."""
    pairs = spark.createDataFrame([(d, v) for d in DENIALS for v in VERBS], "d string, v string").select(F.xxhash64("d", "v").alias("gram"))
    return [r[0] for r in pairs.join(lines.select(F.explode(grams(F.col("words"), 2)).alias("gram")), "gram", "left_anti").collect()]


def template_lines(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    rows = [(family, i, text) for family, texts in templates.items() for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "family string, n int, text string").withColumn("words", words_of(F.col("text")))


def training_rows(lines: DataFrame, near_misses: DataFrame, negatives: DataFrame) -> DataFrame:
    """(family, words, held): windows of every template, the template itself, and lines of no licence.

    Windows of 6, 10 and 16 words at every second word are what wrapped or cut paragraphs look like; a fifth
    of all rows, by hash, is held out for the calibration.
    """
    whole = lines.select("family", "words")
    sizes = F.array(F.lit(6), F.lit(10), F.lit(16))
    cut = lines.select("family", "words", F.explode(sizes).alias("size")).where(F.size("words") > F.col("size")).select(
        "family", "words", "size", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1, F.lit(2))).alias("at"))
    cut = cut.select("family", F.slice("words", F.col("at"), F.col("size")).alias("words"))
    not_one = near_misses.union(negatives).select(F.lit(UNKNOWN).alias("family"), "words")
    rows = whole.union(cut).union(not_one).where(F.size("words") > 0)
    return rows.withColumn("held", F.pmod(F.xxhash64("words"), F.lit(5)) == 0)


@dataclass
class LicenseModel:
    """Weights of the word runs that matter, by family, and what turns their sums into calibrated probabilities."""

    families: list[str]
    weights: DataFrame        # gram bigint, w array<double>
    intercept: list[float]
    temperature: float
    threshold: float
    trigrams: DataFrame       # distinct gram bigint of the templates


def _probabilities(logits: Column, temperature: Column | float) -> Column:
    powers = let(logits, lambda z: let(F.array_max(z), lambda top: F.transform(z, lambda x: F.exp((x - top) / temperature))))
    return let(powers, lambda e: let(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(e, lambda x: x / total)))


def fit(spark: SparkSession, negatives: DataFrame, templates: dict[str, list[str]] | None = None,
        near_misses: list[str] | None = None, false_alarms: float = 0.01) -> LicenseModel:
    """Train on the templates' windows against `negatives` (words) and near misses.

    Elastic-net regression keeps few runs of words. A temperature fitted on the held-out rows makes its
    probabilities mean what they say, and the threshold is the smallest of a grid at which
    at most `false_alarms` of the held-out unknown rows would be given a family: below it a
    line is of the unknown class whatever family leads. The templates bound the vocabulary, so
    the weights are a small table at any size of input.
    """
    lines = template_lines(spark, templates or TEMPLATES)
    misses = spark.createDataFrame([(t,) for t in near_misses or NEAR_MISSES], "text string").select(words_of(F.col("text")).alias("words"))
    rows = training_rows(lines, misses, negatives).coalesce(2).withColumn("grams", features(F.col("words"))).persist()
    families = sorted((templates or TEMPLATES)) + [UNKNOWN]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1
    seen = lines.select(F.explode(features(F.col("words"))).alias("gram")).union(
        misses.select(F.explode(features(F.col("words"))).alias("gram"))).distinct()
    vocabulary = sorted(r[0] for r in seen.collect())
    terms = CountVectorizerModel.from_vocabulary([str(g) for g in vocabulary], inputCol="terms", outputCol="features").setBinary(True)
    named = rows.select("held", label.alias("label"), F.transform("grams", lambda g: g.cast("string")).alias("terms"))
    vectors = terms.transform(named).select("held", "label", "features").persist()
    model = LogisticRegression(family="multinomial", regParam=0.003, elasticNetParam=0.3, maxIter=60).fit(vectors.where("not held"))
    held = vectors.where("held").collect()
    coefficients, intercept = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    rows.unpersist()
    vectors.unpersist()
    temperature, threshold = calibrated(
        [coefficients @ r["features"].toArray() + intercept for r in held], [int(r["label"]) for r in held], len(families) - 1, false_alarms)
    kept = [(vocabulary[j], [float(x) for x in coefficients[:, j]]) for j in range(len(vocabulary)) if abs(coefficients[:, j]).max() > 1e-9]
    trigrams = lines.select(F.explode(grams(F.col("words"), 3)).alias("gram")).distinct()
    return LicenseModel(families, spark.createDataFrame(kept, "gram bigint, w array<double>"),
                        [float(x) for x in intercept], temperature, threshold, trigrams)


def calibrated(logits: list, labels: list[int], unknown: int, false_alarms: float) -> tuple[float, float]:
    """Temperature of least log loss, and the least threshold that keeps to `false_alarms`, on held-out rows."""
    import numpy as np

    if not logits:
        return 1.0, 0.5
    x, y = np.stack(logits), np.array(labels)

    def probability(t: float) -> np.ndarray:
        e = np.exp((x - x.max(1, keepdims=True)) / t)
        return e / e.sum(1, keepdims=True)

    loss = {t: -np.log(np.maximum(probability(t)[np.arange(len(y)), y], 1e-12)).mean() for t in np.geomspace(0.1, 10, 41)}
    temperature = float(min(loss, key=loss.get))
    p = np.delete(probability(temperature), unknown, axis=1).max(1)[y == unknown]
    grid = np.arange(0.3, 1.0, 0.05)
    good = [float(g) for g in grid if not len(p) or (p >= g).mean() <= false_alarms]
    return temperature, good[0] if good else 0.95


def sample_negatives(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", max_docs: int = 200, max_lines: int = 1500,
                     templates: dict[str, list[str]] | None = None) -> DataFrame:
    """(words): at most `max_lines` paragraphs that are no licence, of the `max_docs` documents with the smallest id hashes each.

    Half come from documents that share three words with a template: their paragraphs are the ones that a scan meets. One that has
    a third of a template, or `LEAST_RUNS` runs of it, may be of a licence and is left out. Rows without text have none; an empty
    table gives no rows.
    """
    lines = template_lines(docs.sparkSession, templates or TEMPLATES)
    known = [r[0] for r in lines.select(F.explode(grams(F.col("words"), 3)).alias("g")).distinct().collect()]
    rows = narrow(docs, doc=id_col, text=text_col).where("text is not null")
    rows = rows.withColumn("key", F.xxhash64(F.coalesce(F.col("doc").cast("string"), F.lit(""))))
    meets = F.exists(grams(words_of(F.col("text")), 3), lambda g: g.isin(known))
    marked = staged(rows.select("key", meets.alias("meets")), "license-marks")
    found = None
    for side in (False, True):
        last = cutoff(marked.where(F.col("meets") == side).select("key"), marked.where(F.col("meets") == side).count(), max_docs)
        few = rows.where((F.col("key") <= F.lit(last)) & (meets == side)).orderBy("key", "doc").limit(max_docs)
        part = few.select(F.explode(paragraphs(F.col("text"))).alias("line")).select(words_of(F.col("line")).alias("words")).where(F.size("words") > 0)
        part = part.withColumn("threes", F.array_distinct(grams(F.col("words"), 3)))
        own = F.exists("threes", lambda g: g.isin(known))
        part = part.where(own if side else ~own).select("words", "threes").distinct().orderBy("words").limit(max_lines // 2)
        found = part if found is None else found.union(part)
    close = shared_runs(found, template_shapes(lines)).where((F.col("both") >= LEAST_RUNS) | (3 * F.col("both") >= F.col("m")))
    return found.join(close.select("words").distinct(), "words", "left_anti").select("words")


def scan_paragraphs(docs: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text",
               templates: dict[str, list[str]] | None = None, overlap: float = 0.6) -> DataFrame:
    """(doc, paragraph, words, family, probability, template_family, overlap, confirmed) of each paragraph that could be of a licence.

    A paragraph shares three words in a row with a template or can't be confirmed, so only such paragraphs
    of such documents are scored; all else is unknown. The leading family stands if its calibrated probability is
    at least the model's threshold, else the paragraph is of the unknown class. The templates
    confirm it if one of the same family shares `overlap` of its own three-word runs with it, or has `overlap` of the paragraph's
    and at least `LEAST_RUNS`, and if the paragraph doesn't deny a licence ("not licensed under ...").
    Rows without text or id have no paragraphs; equal paragraphs are judged once and alike.
    """
    lines_ = template_lines(docs.sparkSession, templates or TEMPLATES)
    known, denied = [r[0] for r in model.trigrams.collect()], denials(docs.sparkSession, lines_)
    rows = narrow(docs, doc=id_col, text=text_col).where("text is not null and doc is not null")
    some = rows.where(F.exists(grams(words_of(F.col("text")), 3), lambda g: g.isin(known)))
    lines = some.select("doc", F.posexplode(paragraphs(F.col("text"))).alias("paragraph", "line")).select(
        "doc", "paragraph", words_of(F.col("line")).alias("words"))
    lines = lines.withColumn("threes", F.array_distinct(grams(F.col("words"), 3))).where(
        F.exists("threes", lambda g: g.isin(known)))
    # Equal lines are scored once.
    each = lines.groupBy("words").agg(F.first("threes").alias("threes"))
    zeros = F.array(*[F.lit(0.0)] * len(model.families))
    scored = each.select("words", F.explode(features(F.col("words"))).alias("gram")).join(F.broadcast(model.weights), "gram")
    sums = scored.groupBy("words").agg(*[F.sum(F.get("w", F.lit(i))).alias(f"_{i}") for i in range(len(model.families))])
    found = each.join(sums.select("words", F.array(*[F.col(f"_{i}") for i in range(len(model.families))]).alias("sums")), "words", "left")
    bias = F.array(*[F.lit(x) for x in model.intercept])
    logits = F.zip_with(F.coalesce("sums", zeros), bias, lambda a, b: a + b)
    found = found.withColumn("p", _probabilities(logits, F.lit(model.temperature)))
    named = F.slice("p", 1, len(model.families) - 1)
    best = F.array_max(named)
    family = F.get(F.array(*[F.lit(f) for f in model.families]), F.array_position(named, best).cast("int") - 1)
    found = found.withColumns({"probability": best, "leading": family})
    common = shared_runs(found, template_shapes(lines_))
    share = confirming_share(F.col("both"), F.col("n"), F.col("m"))
    closest = common.groupBy("words").agg(F.collect_set(F.struct(share.alias("share"), F.col("of").alias("of"))).alias("shares"))
    joined = found.join(closest, "words", "left")
    own = F.coalesce(F.array_max(F.transform(F.filter("shares", lambda s: s["of"] == F.col("leading")), lambda s: s["share"])), F.lit(0.0))
    top = F.array_max("shares")
    judged = joined.select(
        "words", F.when(F.col("probability") >= model.threshold, F.col("leading")).otherwise(UNKNOWN).alias("family"), "probability",
        top["of"].alias("template_family"), own.alias("overlap"),
        ((F.col("probability") >= model.threshold) & (own >= overlap)
         & ~F.exists(grams(F.col("words"), 2), lambda g: g.isin(denied))).alias("confirmed"))
    return lines.select("doc", "paragraph", "words").join(judged, "words")


def scan(docs: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc, licenses, n_lines, n_unknown, probability), one row per id of `docs`, whatever other columns it has.

    `licenses` are the confirmed families in order, `n_lines` their paragraphs, `probability` the best
    one's, `n_unknown` the paragraphs that share words with a template but were left unknown or not
    confirmed. An empty table gives no rows. Null and empty texts have none, as have rows without id; rows that repeat an id are one document.
    """
    lines = scan_paragraphs(docs, model, id_col, text_col, templates)
    per = lines.groupBy("doc").agg(
        F.sort_array(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("licenses"),
        F.sum(F.col("confirmed").cast("bigint")).alias("n_lines"), F.sum((~F.col("confirmed")).cast("bigint")).alias("n_unknown"),
        F.max(F.when(F.col("confirmed"), F.col("probability"))).alias("probability"))
    ids = docs.select(F.col(f"`{id_col}`").alias("key")).distinct()
    none = F.expr("array()").cast("array<string>")
    return ids.join(per, F.col("key") == F.col("doc"), "left").select(
        F.col("key").alias("doc"), F.coalesce("licenses", none).alias("licenses"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_lines", "n_unknown")], "probability")
