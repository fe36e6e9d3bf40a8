"""Licence scan: a trained paragraph classifier with template confirmation.

Paragraphs are lines. A multinomial logistic regression (L1, Spark ML) over the
counts of word 1- to 3-grams names a licence family or 'none'. It is trained
here, on the templates below, on variants of them (words dropped, other words
before and after), on sentences that use the same words otherwise, and on
paragraphs of the corpus (a bounded sample) with a licence word put in.

The model decides about every paragraph. Most are proven 'none' without its
n-grams: each word has a worth, the most that it, and the n-grams counted with
it, can add to a family's score over that of 'none'. Where the worths of all
words stay below the lead that the intercepts give 'none', no family can win,
so the paragraph is left out; that changes no result.

The unknown class is calibrated on variants that the fit has not seen and on
held-out paragraphs without a licence: the threshold is the least probability
at which at least `PRECISION` of the named families are right. A family below
it, or one that no template confirms, becomes 'unknown'. A template confirms
when enough of its word 3-grams are in the paragraph.

Everything is DataFrame and SQL functions and Spark ML; the texts are scanned
once, without a shuffle. Defined cases: a null or empty text has no paragraphs;
a null doc_id is kept; repeated rows give repeated results; with no documents
the classifier is trained on the templates alone.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut

#: Rows of the corpus that training may see; the rest is never used to fit.
SAMPLE_DOCS = 300
SAMPLE_PARAGRAPHS = 1500
#: Variants per template, for the fit and for the calibration.
VARIANTS, HELD_OUT = 24, 8
PRECISION = 0.99
#: Share of a template's 3-grams that confirms a family.
CONFIRMED = 0.5
MAX_FEATURES = 20_000
NONE, UNKNOWN = "none", "unknown"
#: Training only: paragraphs with one of these are not taken for examples of
#: 'none', and the template words with one are put into those that are.
STEMS = ("licen", "copyright", "redistribut", "gpl", "permission", "cc0", "noncommercial", "unencumbered",
         "rights reserved")

#: Short notices and opening sentences of public licences.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License.",
                   "Released under the Apache 2.0 license.", "SPDX-License-Identifier: Apache-2.0",
                   "This project is available under the terms of the Apache License 2.0."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT",
            "This software is distributed under the terms of the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "Licensed under the GNU GPL v3.", "SPDX-License-Identifier: GPL-3.0-or-later",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any later "
                "version."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU GPL v2.",
                "SPDX-License-Identifier: GPL-2.0-only",
                "You may redistribute this program under the terms of the GNU General Public License version 2 as published "
                "by the Free Software Foundation."],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 3.", "Released under the LGPL v2.1.",
             "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.",
             "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", "Released under the AGPL v3.",
                 "SPDX-License-Identifier: AGPL-3.0-only",
                 "You can redistribute this program under the terms of the GNU Affero General Public License."],
    "BSD": ["Released under the BSD License.", "Licensed under the 3-clause BSD license.",
            "Use of this source code is governed by a BSD-style license.", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "ISC": ["Released under the ISC License.", "SPDX-License-Identifier: ISC",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                 "Text is available under the Creative Commons Attribution-ShareAlike License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "Available under CC BY-NC for noncommercial use only."],
    "CC0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related "
            "rights to this work.", "Dedicated to the public domain under CC0 1.0 Universal."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense.",
                  "SPDX-License-Identifier: Unlicense"],
    "Proprietary": ["All rights reserved. No part of this publication may be reproduced without prior written permission.",
                    "Copyright, all rights reserved.", "All rights reserved.",
                    "This document is confidential and may not be distributed without prior written permission."],
}
#: Sentences that use the words of licences for something else.
OTHERS = ["She renewed her driving license before the trip.", "The bar lost its license after the complaint.",
          "The software update needs permission from the user.", "Please read the terms of the contract carefully.",
          "A public hearing was held in version two of the plan.", "The apache helicopter landed near the village.",
          "The bank waived the fee for any person with an account.", "Distribution of food was free of charge.",
          "He studied at MIT before moving to Berkeley.", "Creative work in common rooms is encouraged.",
          "The source of the river is in the mountains.", "You can use this path without restriction.",
          "The general was licensed to teach in public schools.", "Copy the file to another folder first.",
          "The patent license fee was paid in full.", "The following conditions were measured in the lab.",
          "The foundation gave free software courses to schools.", "All seats are reserved for members.",
          "Her rights were reserved in the contract.", "The isc conference released its program."]


def words(text: str | Column) -> Column:
    """Lower-case words; letters, digits and inner dots, pluses and hyphens."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.+-]+|[.+-]+(?=[^\p{L}\p{N}]|$)|(?<![\p{L}\p{N}])[.+-]+"),
                    lambda w: w != "")


def grams(w: str | Column, n: int) -> Column:
    """Word n-grams of an array of words."""
    w = F.col(w) if isinstance(w, str) else w
    # by single words: a slice copies the whole array for every n-gram
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n),
                                              lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]))
                  ).otherwise(F.array().cast("array<string>"))


def _once(rows: DataFrame, name: str, value: str | Column) -> DataFrame:
    """rows with a column that is computed once: a later filter would otherwise
    take the expression in, down to the words inside the loop over their n-grams."""
    return rows.select(*[c for c in rows.columns if c != name], F.explode(F.array(value)).alias(name))


def _fixed_rows(spark: SparkSession) -> DataFrame:
    """family, template, text of all templates and other sentences."""
    rows = [(f, t) for f, ts in TEMPLATES.items() for t in ts] + [(NONE, t) for t in OTHERS]
    return spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(k).alias("template"),
                                                             F.lit(t).alias("text")) for k, (f, t) in enumerate(rows)]))
                                 .alias("r")).select("r.*")


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, paragraph (line number from 0), text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("paragraph", "text"))


def candidate(text: str | Column) -> Column:
    """Whether a text holds one of the stems."""
    low = F.lower(F.col(text) if isinstance(text, str) else text)
    return reduce(or_, [low.contains(x) for x in STEMS])


class LicenceModel:
    """Vocabulary, regression and threshold."""

    def __init__(self, vocabulary: CountVectorizerModel, regression, labels: list[str], least: float):
        self.vocabulary, self.regression, self.labels, self.least = vocabulary, regression, labels, least

    def lead(self) -> float:
        """By how much the intercepts put 'none' before every family."""
        first, *rest = self.regression.interceptVector.toArray().tolist()
        return first - max(rest)

    def uses(self) -> Counter:
        """In how many vocabulary entries a word is."""
        return Counter(w for g in self.vocabulary.vocabulary for w in g.split(" "))

    def worths(self) -> dict[str, float]:
        """Bounds per word: the sum over the words of a paragraph is at least
        what all its n-grams add to any family's score over that of 'none'. An
        n-gram counts with its word in the fewest vocabulary entries; an
        occurrence of a word has one n-gram per length and place in it."""
        weights = self.regression.coefficientMatrix.toArray()
        gain = dict(zip(self.vocabulary.vocabulary, (weights[1:] - weights[0]).max(axis=0).tolist()))
        uses = self.uses()
        out, slots = {g: x for g, x in gain.items() if " " not in g}, {}
        for g, x in gain.items():
            w = g.split(" ")
            if len(w) > 1 and x > 0:
                k = min(range(len(w)), key=lambda i: (uses[w[i]], i))
                slot = w[k], len(w), k
                slots[slot] = max(slots.get(slot, 0.0), x)
        for (w, _, _), x in slots.items():
            out[w] = out.get(w, 0.0) + x
        return {w: x for w, x in out.items() if x != 0}

    def possible(self, text: str | Column) -> Column:
        """False where the model's class is proven to be 'none'."""
        worths, lead = self.worths(), self.lead() - 1e-6
        if lead <= 0 or not worths:
            return F.lit(True)
        uses = self.uses()
        names = sorted(worths, key=lambda w: (-uses[w], w))  # a map is searched from its start
        known = F.create_map(*[F.lit(x) for w in names for x in (w, worths[w])])
        return F.aggregate(F.filter(words(text), lambda w: w.isin(names)), F.lit(0.0),
                           lambda total, w: total + F.try_element_at(known, w)) >= lead

    def scored(self, rows: DataFrame) -> DataFrame:
        """Adds family (best class), probability and grams3 to rows with words w."""
        rows = _once(rows, "grams", F.concat("w", grams("w", 2), grams("w", 3)))
        out = self.regression.transform(_once(self.vocabulary.transform(rows), "features", "features"))
        p = vector_to_array("probability")
        return (out.withColumn("probability", F.array_max(p))
                .withColumn("family", F.array(*map(F.lit, self.labels))[F.col("prediction").cast("int")])
                .drop("grams", "features", "rawPrediction", "prediction"))


def _variants(rows: DataFrame, background: DataFrame, low: int, high: int) -> DataFrame:
    """Rows (family, w): variant 0 is the row itself; others drop a tenth of the
    words and stand among the words of some other paragraph."""
    kept = F.expr("transform(filter(transform(w, (x, i) -> struct(x AS x, pmod(xxhash64(template, v, i), 10) AS h)), "
                  "s -> v = 0 OR s.h > 0), s -> s.x)")
    spread = rows.withColumn("v", F.explode(F.sequence(F.lit(low), F.lit(high - 1)))).withColumn("kept", kept)
    spread = spread.withColumn("other", F.expr("try_element_at(b, cast(pmod(xxhash64(template, v), greatest(size(b), 1)) + 1 as int))")
                               ) if background is not None else spread.withColumn("other", F.array().cast("array<string>"))
    some = F.expr("slice(other, 1, cast(pmod(xxhash64(v, template), 7) as int))")
    more = F.expr("slice(other, 8, cast(pmod(xxhash64(template, v, 1), 7) as int))")
    return spread.select("family", F.when(F.col("v") % 2 == 1, F.concat(F.coalesce(some, F.array().cast("array<string>")), "kept",
                                                                       F.coalesce(more, F.array().cast("array<string>"))))
                         .otherwise(F.col("kept")).alias("w"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LicenceModel:
    """Fits and calibrates the classifier; sees at most SAMPLE_DOCS documents."""
    spark = docs.sparkSession
    sample = docs.select(F.col(id_col).alias("doc_id"), F.substring(F.col(text_col).cast("string"), 1, 20_000).alias("text"),
                         F.xxhash64(text_col).alias("h")).filter("text is not null").orderBy("h", "doc_id").limit(SAMPLE_DOCS)
    fixed = _fixed_rows(spark).withColumn("w", words("text"))
    known = fixed.filter(F.col("family") != NONE)
    cues = sorted({w for r in known.select("w").collect() for w in r["w"] if any(x in w for x in STEMS)})
    plain = cut(paragraphs(sample, "doc_id", "text").filter(~candidate("text")).withColumn("w", words("text"))
                .filter(F.size("w") > 0).orderBy(F.xxhash64("text"), "text").limit(SAMPLE_PARAGRAPHS).select("w"))
    cue = F.array(*map(F.lit, cues))
    at = F.pmod(F.xxhash64("w"), F.size("w")).cast("int")
    others = plain.select(F.lit(NONE).alias("family"), F.xxhash64("w").alias("h"), F.concat(
        F.slice("w", F.lit(1), at), F.array(F.element_at(cue, (F.pmod(F.xxhash64("w", F.lit(1)), F.lit(len(cues))) + 1).cast("int"))),
        F.slice("w", at + 1, F.size("w"))).alias("w"))
    # at most SAMPLE_PARAGRAPHS arrays of words, as one value beside the templates
    pool = plain.filter(F.pmod(F.xxhash64("w"), F.lit(15)) == 0).select(F.slice("w", 1, 20).alias("w")).collect()
    literal = F.array(*[F.array(*map(F.lit, r["w"])) for r in pool[:100]]) if pool else F.array().cast("array<array<string>>")
    fixed = cut(fixed.withColumn("b", literal))
    fit_rows = _variants(fixed, pool, 0, VARIANTS).unionByName(
        others.filter(F.pmod(F.col("h"), F.lit(5)) > 0).select("family", "w"))
    test_rows = _variants(fixed, pool, VARIANTS, VARIANTS + HELD_OUT).unionByName(
        others.filter(F.pmod(F.col("h"), F.lit(5)) == 0).select("family", "w"))
    every = cut(fixed.select(F.explode(F.concat("w", grams("w", 2), grams("w", 3))).alias("g"))
                .distinct().orderBy("g").limit(MAX_FEATURES))
    vocabulary = CountVectorizerModel.from_vocabulary([r["g"] for r in every.orderBy("g").collect()], inputCol="grams",
                                                      outputCol="features")
    labels = [NONE, *TEMPLATES]
    number = F.array_position(F.array(*map(F.lit, labels)), F.col("family")) - 1
    rows = cut(fit_rows.select(number.cast("double").alias("label"),
                               F.concat("w", grams("w", 2), grams("w", 3)).alias("grams")))
    regression = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.002, elasticNetParam=0.5,
                                    maxIter=60, standardization=False).fit(vocabulary.transform(rows))
    model = LicenceModel(vocabulary, regression, labels, 0.0)
    judged = model.scored(_once(test_rows.withColumnRenamed("family", "truth"), "w", "w")).filter(F.col("family") != NONE)
    right = judged.select("probability", (F.col("family") == F.col("truth")).cast("int").alias("ok"))
    steps = F.explode(F.array(*[F.lit(k / 20) for k in range(20)])).alias("least")
    table = (right.select("*", steps).filter("probability >= least").groupBy("least")
             .agg(F.avg("ok").alias("precision")).filter(F.col("precision") >= PRECISION).agg(F.min("least")).first()[0])
    model.least = 0.95 if table is None else float(table)
    return model


def find_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: LicenceModel | None = None
                  ) -> DataFrame:
    """A row per paragraph that is taken for a licence: doc_id, paragraph, text,
    family ('unknown' if unsure or not confirmed), guess (the classifier's
    family), probability and template_share."""
    model = model or train(docs, id_col, text_col)
    rows = paragraphs(docs, id_col, text_col).filter(model.possible("text"))
    rows = _once(rows, "w", words("text"))
    scored = model.scored(rows).filter(F.col("family") != NONE)
    templates = F.create_map(*[x for f, ts in TEMPLATES.items() for x in (F.lit(f), F.array(*map(F.lit, ts)))])
    three = grams("w", 3)
    own = F.when(F.size("w") < 3, F.array(F.array_join("w", " "))).otherwise(three)

    def share(t: Column) -> Column:
        tw = words(t)
        tg = F.array_distinct(F.when(F.size(tw) < 3, F.array(F.array_join(tw, " "))).otherwise(grams(tw, 3)))
        return F.size(F.array_intersect(tg, F.col("own"))) / F.size(tg)

    scored = scored.withColumn("own", own).withColumn(
        "template_share", F.array_max(F.transform(templates[F.col("family")], share)))
    sure = (F.col("probability") >= model.least) & (F.col("template_share") >= CONFIRMED)
    return scored.select("doc_id", "paragraph", "text", F.when(sure, F.col("family")).otherwise(UNKNOWN).alias("verdict"),
                         F.col("family").alias("guess"), "probability", "template_share"
                         ).withColumnRenamed("verdict", "family")
