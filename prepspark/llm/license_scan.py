"""Licence scan: a trained paragraph classifier, confirmed against templates
(DataFrame functions and Spark ML in the JVM only).

1. Paragraphs are lines.  Those that hold one of the ``ANCHORS`` are candidates; every
   template has an anchor and a confirmed paragraph needs one, so nothing is lost.
2. Word one- and two-grams are hashed to ``2 ** FEATURE_BITS`` sparse features, and a
   multinomial logistic regression gives each family and ``unknown`` a probability.  It is
   trained on pieces of the templates and, for ``unknown``, on ordinary sentences with anchor
   words and at most ``negative_rows`` paragraphs of the corpus picked by a hash.
3. ``unknown`` is calibrated on a fifth of the training rows that fitting does not see: the
   temperature with the least log loss, then the lowest threshold at which at most
   ``false_share`` of the held-out unknown paragraphs would get a family.
4. A prediction counts when enough of the paragraph's two-grams are the family's template's.

Only candidate paragraphs leave the scan and only ids are shuffled.  The model and the
templates have a fixed size.

Results for odd input: a null or empty text has no paragraphs and no licence; null ids are
passed on and share their findings; rows that repeat an id share the findings of all of them,
counted once per distinct paragraph and line; extra columns are ignored; an empty table gives
an empty result.  Ties between families go to the first by name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, query, settle, table

FEATURE_BITS = 13
UNKNOWN = "unknown"

#: Words of licence notices; one of them stands in every template.
ANCHORS = (
    r"\b(licen[sc]\w*|copyright\w*|copyleft|warrant\w*|permission\w*|redistribut\w*|gpl\w*|lgpl\w*|agpl\w*|gnu|apache|mit|bsd|mpl|"
    r"mozilla|isc|cc0?|creative|spdx|unlicense|rights|domain|sublicense)\b"
)
#: Sentences by which licence families are recognised (public licence texts and notices).
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "Licensed under the Apache License, Version 2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache 2.0 license",
    ],
    "MIT": [
        "Released under the MIT License",
        "This project is licensed under the MIT License see the LICENSE file for details",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "SPDX-License-Identifier: MIT",
        "Licensed under the MIT license",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GPL version 3",
        "Released under GPLv3",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2",
        "This work is licensed under the GNU General Public License, version 2",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "SPDX-License-Identifier: GPL-2.0-only",
        "Released under GPLv2",
    ],
    "LGPL": [
        "GNU Lesser General Public License as published by the Free Software Foundation",
        "This library is licensed under the GNU Lesser General Public License, version 2.1",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "Released under the LGPL license",
    ],
    "AGPL-3.0": [
        "GNU Affero General Public License as published by the Free Software Foundation",
        "This work is licensed under the GNU Affero General Public License, version 3",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Licensed under the BSD 3-Clause License",
        "Released under the BSD license",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Licensed under the ISC License",
        "SPDX-License-Identifier: ISC",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Licensed under CC BY 4.0",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "Text is available under the Creative Commons Attribution-ShareAlike License",
        "Licensed under CC BY-SA 4.0",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Licensed under CC BY-NC 4.0",
        "Licensed under CC BY-NC-SA 4.0",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0",
        "Released under CC0 1.0 Universal public domain dedication",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain under the Unlicense",
        "SPDX-License-Identifier: Unlicense",
    ],
    "Proprietary": [
        "Copyright by the owner. All rights reserved",
        "All rights reserved. No part of this publication may be reproduced without permission of the copyright holder",
    ],
}
#: Ordinary sentences with anchor words.
ORDINARY = [
    "He lost his driving license last summer", "The city issues a fishing license to every resident", "She asked for permission to leave",
    "The apache helicopter landed near the base", "Students at MIT built a robot", "They hold a licence to sell alcohol",
    "The warranty of the car covers two years", "Human rights are universal", "Creative people like the public domain",
    "The domain name was registered yesterday", "Without permission nobody enters the room", "The committee will redistribute the money",
    "The copyright office opens at nine", "An isc member voted against it", "The license plate was stolen", "A mozilla engineer gave a talk",
    "The rights of the owner were discussed", "The permission expired", "It comes with a lifetime warranty", "A gnu crossed the river",
]


def words_of(line: Column) -> Column:
    """Lower-cased letter and digit runs; a version like 2.0 stays whole."""
    return F.regexp_extract_all(F.lower(line), F.lit(r"[\p{L}\p{N}]+(?:\.[0-9]+)*"), F.lit(0))


def pairs_of(words: Column) -> Column:
    """Distinct two-grams."""
    two = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, F.lit(2)), " ")
    )
    return F.when(F.size(words) < 2, F.array().cast("array<string>")).otherwise(F.array_distinct(two))


def _features(rows: DataFrame) -> DataFrame:
    """``line`` -> ``words``, ``pairs`` and the sparse vector ``features``."""
    rows = rows.withColumn("words", words_of(F.col("line"))).withColumn("pairs", pairs_of(F.col("words")))
    rows = rows.withColumn("grams", F.concat("words", "pairs"))
    return HashingTF(numFeatures=1 << FEATURE_BITS, inputCol="grams", outputCol="features", binary=True).transform(rows).drop("grams")


@dataclass
class LicenseModel:
    """Families (index = class), the regression, temperature and threshold."""

    families: list[str]
    regression: LogisticRegressionModel
    temperature: float
    threshold: float


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, position, line) of the candidate paragraphs."""
    lines = F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"\r\n?|\n")
    rows = docs.select(F.col(id_col).alias("id"), F.posexplode(lines).alias("position", "line"))
    return rows.where(F.lower("line").rlike(ANCHORS))


def training_rows(spark: SparkSession, families: list[str]) -> DataFrame:
    """(label, line): every template and ordinary sentence, whole, in pieces and with words left out."""
    given = [(float(families.index(f)), t) for f, texts in TEMPLATES.items() for t in texts]
    given += [(float(families.index(UNKNOWN)), t) for t in ORDINARY]
    base = spark.createDataFrame(given, "label double, line string").withColumn("w", F.split("line", " "))
    n = F.size("w")
    sizes = F.array_distinct(F.array(n, F.greatest(F.ceil(n * 0.75).cast("int"), F.lit(4)), F.greatest(F.ceil(n * 0.5).cast("int"), F.lit(4))))
    pieces = base.withColumn("size", F.explode(sizes)).where("size <= size(w)")
    pieces = pieces.withColumn("start", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)))
    pieces = pieces.select("label", F.slice("w", F.col("start"), F.col("size")).alias("w")).where(
        F.lower(F.array_join("w", " ")).rlike(ANCHORS)
    )
    less = pieces.withColumn("skip", F.explode(F.sequence(F.lit(0), F.size("w")))).select(
        "label", F.array_join(F.filter("w", lambda x, i: i + 1 != F.col("skip")), " ").alias("line")
    )
    return less.distinct()


def fit_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", negative_rows: int = 2_000, false_share: float = 0.01) -> LicenseModel:
    """Train on template pieces and a bounded sample of corpus lines without an anchor."""
    spark = docs.sparkSession
    families = sorted(TEMPLATES) + [UNKNOWN]
    unknown = float(len(families) - 1)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    share = min(1.0, negative_rows / max(1, rows.count()))
    rows = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    plain = rows.select(F.explode(F.slice(F.split("text", r"\r\n?|\n"), 1, 3)).alias("line")).where(~F.lower("line").rlike(ANCHORS))
    plain = plain.select(F.lit(unknown).alias("label"), F.substring("line", 1, 400).alias("line")).where("line <> ''")
    labelled = training_rows(spark, families).unionByName(plain.distinct())
    labelled = _features(labelled).select("label", "features", (F.pmod(F.xxhash64("line"), F.lit(5)) == 0).alias("check"))
    labelled = settle(labelled.repartition(4), "licence-train")
    regression = LogisticRegression(maxIter=40, regParam=0.002, family="multinomial").fit(labelled.where("NOT check"))
    held = regression.transform(labelled.where("check")).select("label", vector_to_array("rawPrediction").alias("raw"))
    held = settle(held, "licence-held")
    grid = [0.5, 0.7, 1.0, 1.4, 2.0, 3.0]
    losses = []
    for t in grid:
        top = F.array_max("raw")
        total = F.aggregate("raw", F.lit(0.0), lambda s, x: s + F.exp((x - F.array_max("raw")) / t))
        own = F.element_at("raw", (F.col("label") + 1).cast("int"))
        losses.append(F.avg(F.log(total) - (own - top) / t).alias(f"t{grid.index(t)}"))
    found = held.agg(*losses).first()
    best = min(range(len(grid)), key=lambda k: (found[k] if found[k] is not None else 0.0, k))
    family_p = F.lit(1.0) - F.element_at(_softened(F.col("raw"), grid[best]), len(families))
    bar = held.where(F.col("label") == unknown).agg(F.percentile(family_p, 1 - false_share)).first()[0]
    return LicenseModel(families, regression, grid[best], max(0.5, min(0.95, float(bar or 0.5))))


def _softened(raw: Column, temperature: float) -> Column:
    """Probabilities of raw scores at a temperature."""
    def powers(r: Column) -> Column:
        return let(F.array_max(r), lambda top: F.transform(r, lambda x: F.exp((x - top) / temperature)))

    def shares(p: Column) -> Column:
        return let(F.aggregate(p, F.lit(0.0), lambda s, y: s + y), lambda total: F.transform(p, lambda x: x / total))

    return let(raw, lambda r: let(powers(r), shares))


def classify_paragraphs(rows: DataFrame, model: LicenseModel, overlap: float = 0.5, hits: int = 5) -> DataFrame:
    """(id, position, line) -> the same with ``family``, ``probability``, ``template_share``; confirmed rows only."""
    scored = model.regression.transform(_features(rows))
    families = model.families
    listed = F.array(*map(F.lit, families))
    # Written before it is filtered: a predicate on the probabilities would be pushed below them and
    # the prediction evaluated for each mention of it.
    scored = settle(scored.select("id", "position", "line", "pairs", vector_to_array("rawPrediction").alias("raw")), "licence-raw")
    scored = settle(scored.withColumn("p", F.slice(_softened(F.col("raw"), model.temperature), 1, len(families) - 1)).drop("raw"), "licence-p")
    scored = scored.withColumn("probability", F.array_max("p"))
    scored = scored.withColumn("family", F.element_at(listed, F.array_position("p", F.col("probability")).cast("int")))
    scored = scored.where(F.col("probability") >= model.threshold)
    spark = rows.sparkSession
    given = [(f, t) for f, texts in TEMPLATES.items() for t in texts]
    templates = spark.createDataFrame(given, "family string, line string")
    templates = templates.select("family", F.explode(pairs_of(words_of(F.col("line")))).alias("pair"))
    templates = templates.groupBy("family").agg(F.collect_set("pair").alias("template"))
    scored = scored.join(F.broadcast(templates), "family")  # one row per family of TEMPLATES
    common = F.size(F.array_intersect("pairs", "template"))
    share = common / F.greatest(F.size("pairs"), F.lit(1))
    return scored.where((share >= overlap) | (common >= hits)).select(
        "id", "position", "line", "family", "probability", share.alias("template_share")
    )


def scan_licenses(docs: DataFrame, model: LicenseModel | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_paragraphs``, ``license`` (the likeliest family, null without
    one), ``families``, ``probability``, ``findings`` (position, family, probability)."""
    model = model or fit_licenses(docs, id_col, text_col)
    hits = classify_paragraphs(paragraphs(docs, id_col, text_col).distinct(), model)
    finding = F.struct("position", "family", "probability")
    order = F.struct((-F.col("probability")).alias("x"), "family")
    found = hits.groupBy("id").agg(
        F.min_by("family", order).alias("license"), F.sort_array(F.collect_set("family")).alias("families"),
        F.max("probability").alias("probability"), F.sort_array(F.collect_list(finding)).alias("findings"),
    )
    found = settle(found.withColumnRenamed("id", "__id"), "licence-found")
    lines = F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"\r\n?|\n")
    rows = docs.select(F.col(id_col).alias("id"), F.size(F.filter(lines, lambda x: F.trim(x) != "")).alias("n_paragraphs"))
    out = rows.join(found, F.col("id").eqNullSafe(F.col("__id")), "left")
    return out.select(
        F.col("id").alias(id_col), "n_paragraphs", "license",
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.coalesce("probability", F.lit(0.0)).alias("probability"),
        F.coalesce("findings", F.array().cast("array<struct<position:int,family:string,probability:double>>")).alias("findings"),
    )


@query("op2_license_scan")
def op2_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))
