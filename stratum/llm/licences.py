"""Licence paragraphs: a trained n-gram classifier with an unknown class, confirmed against templates.

DataFrame functions and Spark's own logistic regression only.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sampling import smallest_hashes
from .store import store, unstore

#: Sentences of public licence texts and of the notices that refer to them, by family.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
        "The rights granted include without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
        "SOFTWARE."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0"),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
        "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "Released under the GPL, version 3."),
    "LGPL-3.0": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "Released under the LGPL.", "Licensed under the GNU Lesser General Public License."),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "Released under the AGPL.", "Licensed under the GNU Affero General Public License."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "Released under the 3-clause BSD License.", "Use of this source code is governed by a BSD-style license."),
    "BSD-2-Clause": (
        "Released under the 2-clause BSD License.", "Licensed under the Simplified BSD License, also known as FreeBSD License."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE.",
        "Released under the ISC License."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "For more information, please refer to https://unlicense.org"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "You may not use the material for commercial purposes (CC BY-NC)."),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC0-1.0": (
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "proprietary": (
        "All rights reserved.", "Copyright holder. All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission "
        "of the publisher."),
}
FAMILIES = (*TEMPLATES, "unknown")
NEGATIVE_DOCS = 500       # documents (those of the smallest id hashes) whose paragraphs teach the unknown class
VOCABULARY = 4096         # n-grams of the model at most
COMMON = 0.01             # n-grams in this share of the unknown paragraphs say nothing and are left out
TEMPERATURES = (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0)
CONFIRM = 0.6


def tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits, of a whole paragraph."""
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def grams(words: str) -> Column:
    """Distinct words and word pairs of an array column."""
    w = F.col(words)
    pairs = F.when(F.size(w) > 1, F.transform(F.sequence(F.lit(0), F.size(w) - 2),
                                               lambda i: F.concat(F.get(w, i), F.lit(" "), F.get(w, i + 1)))) \
        .otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(w, pairs))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, paragraph, words): the lines of every text, numbered from 0; ``row`` tells rows apart within one scan."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return numbered.select("row", "id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line")) \
        .withColumn("words", tokens(F.col("line"))).drop("line")


def template_sentences(spark: SparkSession) -> DataFrame:
    rows = [(family, k, s) for family, sentences in TEMPLATES.items() for k, s in enumerate(sentences)]
    return spark.createDataFrame(rows, "family string, sentence int, text string").withColumn("words", tokens(F.col("text")))


def logits(rows: DataFrame, keys: list[str], weights: DataFrame) -> DataFrame:
    """(keys, logit array) of every row of ``rows(keys, grams)`` that has an n-gram of the model; without intercepts."""
    # the outer form: for the other the optimiser adds a filter that makes the n-grams again inside their own lambda
    hits = rows.select(*keys, F.explode_outer("grams").alias("gram")).join(F.broadcast(weights), "gram")
    return hits.groupBy(*keys).agg(*(F.sum(F.col("w")[c]).alias(f"s{c}") for c in range(len(FAMILIES)))).select(
        *keys, F.array(*(F.col(f"s{c}") for c in range(len(FAMILIES)))).alias("logit"))


def probabilities(logit: Column, intercepts: list[float], temperature: float) -> Column:
    """Array of the families' probabilities: a softmax in higher-order functions over the few families."""
    z = F.zip_with(logit, F.array(*map(F.lit, intercepts)), lambda a, b: (a + b) / temperature)
    return F.transform(z, lambda x: 1 / F.aggregate(F.transform(z, lambda y: F.exp(F.least(F.lit(500.0), y - x))),
                                                    F.lit(0.0), lambda a, y: a + y))


def train(docs: DataFrame, id_col: str, text_col: str):
    """(weights table, intercepts, temperature).

    Positive rows are the templates' sentences and their windows of 4, 6, 10 and 16 words, negatives the paragraphs
    of NEGATIVE_DOCS documents, less those that look like a template.  A fifth of the rows is held out, and
    the temperature that gives it the least log loss calibrates the probabilities.
    """
    spark = docs.sparkSession
    sentences = template_sentences(spark)
    label = F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1
    windows = F.flatten(F.array(F.array("words"), *(F.when(F.size("words") > n, F.transform(
        F.sequence(F.lit(1), F.size("words") - n + 1), lambda i, n=n: F.slice("words", i, n))).otherwise(
        F.array().cast("array<array<string>>")) for n in (4, 6, 10, 16))))
    positive = sentences.select(label.cast("double").alias("label"), F.explode(windows).alias("words"))
    # ids alone first; then the texts of these few
    named = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = smallest_hashes(named.select("id"), F.xxhash64("id"), NEGATIVE_DOCS).distinct()
    some = named.join(F.broadcast(chosen), "id", "left_semi")
    known = sentences.select(F.explode(F.expr("transform(sequence(0, greatest(0, size(words) - 2)), i -> concat(words[i], ' ', "
                                              "coalesce(get(words, i + 1), '')))")).alias("g")).agg(F.collect_set("g").alias("known"))
    lines = paragraphs(some, "id", "text").where(F.size("words") > 0).select("words", grams("words").alias("grams")).crossJoin(F.broadcast(known))
    pairs = F.filter("grams", lambda g: F.contains(g, F.lit(" ")))
    negative = lines.where(F.size(F.array_intersect(pairs, F.col("known"))) * 2 <= F.size(pairs)).select(
        F.lit(float(len(FAMILIES) - 1)).alias("label"), "words")
    rows, path = store(positive.unionByName(negative).distinct().select("label", grams("words").alias("grams")).coalesce(4), "licences")
    unknown = rows.where(F.col("label") == len(FAMILIES) - 1)
    common = unknown.select(F.explode("grams").alias("gram")).groupBy("gram").count().where(
        F.col("count") >= max(2.0, COMMON * unknown.count())).agg(F.collect_set("gram").alias("common"))
    held_out = F.pmod(F.xxhash64("grams"), F.lit(5)) == 0
    useful = rows.crossJoin(F.broadcast(common)).withColumn("grams", F.array_except("grams", "common")).drop("common")
    counted = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=VOCABULARY, binary=True).fit(
        useful.where(F.col("label") < len(FAMILIES) - 1))
    model = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60).fit(counted.transform(useful.where(~held_out)))
    matrix, seen = model.coefficientMatrix.toArray(), model.numClasses
    table = [(g, [float(x) for x in matrix[:, k]] + [0.0] * (len(FAMILIES) - seen)) for k, g in enumerate(counted.vocabulary)]
    weights = spark.createDataFrame(table, "gram string, w array<double>")
    intercepts = [float(x) for x in model.interceptVector] + [-50.0] * (len(FAMILIES) - seen)
    test = logits(rows.where(held_out).withColumn("row", F.monotonically_increasing_id()), ["label", "row"], weights)
    losses = test.agg(*(F.avg(-F.log(F.greatest(F.lit(1e-12), F.element_at(probabilities(
        F.col("logit"), intercepts, t), F.col("label").cast("int") + 1)))).alias(str(k)) for k, t in enumerate(TEMPERATURES))).first()
    best = min(range(len(TEMPERATURES)), key=lambda k: losses[k] if losses[k] is not None else 0)
    unstore(spark, path)
    return weights, intercepts, TEMPERATURES[best]


def licence_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph that the classifier gives a licence family: id_col, paragraph, n_words, family, probability,
    similarity, confirmed.

    A paragraph is a line of a text, numbered from 0.  Its distinct words and word pairs that the model knows add their weights
    to each family's logit; the family of the highest calibrated probability is taken unless it is "unknown", which paragraphs without any known
    n-gram are, and those give no row.  ``similarity`` is the share of the paragraph's word pairs in the family's templates, or the
    largest share of one template sentence's pairs in the paragraph, whichever is higher; ``confirmed`` is similarity >= 0.6.

    All lines of all texts are scored whole.  Null and empty texts have no paragraphs; rows with a null id or one that other rows
    have are scored each by its own text, repeated rows are reported each; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    weights, intercepts, temperature = train(docs, id_col, text_col)
    lines = paragraphs(docs, id_col, text_col)
    # rows are scored apart by a number that this one scan gives them, and found again by their paragraph's own words
    lines = lines.withColumn("own", F.xxhash64("words"))
    scored = logits(lines.select("id", "paragraph", "own", F.col("row").alias("row"), grams("words").alias("grams")),
                    ["id", "paragraph", "own", "row"], weights)
    p = probabilities(F.col("logit"), intercepts, temperature)
    best = scored.select("id", "paragraph", "own", p.alias("p")).withColumn("probability", F.array_max("p")).withColumn(
        "at", F.array_position("p", F.col("probability")).cast("int")).where(F.col("at") < len(FAMILIES)).groupBy("id", "paragraph", "own").agg(
        F.max("probability").alias("probability"), F.min("at").alias("at")).select(
        "id", "paragraph", "own", "probability", F.element_at(F.array(*map(F.lit, FAMILIES)), F.col("at")).alias("family"))
    found, _ = store(best, "families")
    text = lines.join(found, lines.id.eqNullSafe(found.id) & (lines.paragraph == found.paragraph) & (lines.own == found.own)).select(
        found.id.alias("id"), found.paragraph.alias("paragraph"), "family", "probability", "words", grams("words").alias("grams"))
    pairs = F.filter("grams", lambda g: F.contains(g, F.lit(" ")))
    sentences = template_sentences(spark).withColumn("grams", grams("words")).select("family", "sentence", pairs.alias("of_sentence"))
    known = sentences.groupBy("family").agg(F.flatten(F.collect_list("of_sentence")).alias("known"),
                                            F.collect_list("of_sentence").alias("each"))
    pair = text.withColumn("pairs", pairs).join(F.broadcast(known), "family")
    inside = F.size(F.array_intersect("pairs", "known")) / F.greatest(F.size("pairs"), F.lit(1))
    whole = F.array_max(F.transform("each", lambda s: F.size(F.array_intersect(s, "pairs")) / F.greatest(F.size(s), F.lit(1))))
    out = pair.withColumn("similarity", F.greatest(inside, whole))
    return out.select(F.col("id").alias(id_col), "paragraph", F.size("words").cast("long").alias("n_words"), "family", "probability",
                      "similarity", (F.col("similarity") >= CONFIRM).alias("confirmed"))
