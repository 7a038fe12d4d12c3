"""Licence scans: a trained paragraph classifier, and templates that confirm what it says.

Paragraphs end at blank lines and at lines that end a sentence; other lines are wrapped ones and are joined, without the marks
that comments set before lines. A multinomial logistic regression over hashed word n-grams (one and two words,
weights made sparse by an L1 penalty) names the licence family or ``unknown``. It is trained from variants of the
templates below and of neutral and misleading sentences. The least probability at which a family is
believed is calibrated on variants of sentences that training has not seen: the lowest at which at most ``FALSE_SHARE`` of them
are given a family. A prediction is confirmed where enough of a template's word pairs occur in the
paragraph. A paragraph without any of the cue words that all templates have is no licence paragraph.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hashed n-grams, variants of each template, share of them held out, and penalty.
BUCKETS, VARIANTS, HELD_OUT, PENALTY = 1 << 14, 40, 4, 0.002
FALSE_SHARE = 0.005
#: Share of a template's word pairs that confirms its family.
CONFIRMED = 0.6
UNKNOWN = "unknown"

#: Where a paragraph ends, and what stands between two of its lines.
BREAK = r"[ \t\r]*\n[ \t\r]*\n\s*|(?<=[.!?][\"')\]]{0,2}[ \t\r]{0,3})\n"
WRAP = r"[ \t\r]*\n[ \t]*(?:[#*;]+(?=\s)|//+|--+(?=\s))?[ \t]*"
CUE = r"(?i)licen[sc]e|copyright|warrant|redistribut|permission|spdx|public domain|rights reserved|creative commons|creativecommons"

# Notices of public licences, by family.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0": ["Licensed under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related rights, dedicating this work to the public domain"],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License.", "Licensed under the Simplified BSD License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "zlib": [
        "Released under the zlib License.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
        "SPDX-License-Identifier: Zlib",
    ],
    "EPL-2.0": [
        "Licensed under the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "Unlicense": [
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "OFL-1.1": ["This Font Software is licensed under the SIL Open Font License, Version 1.1.", "SPDX-License-Identifier: OFL-1.1"],
    "Artistic-2.0": ["You may use this package under the terms of the Artistic License 2.0.", "SPDX-License-Identifier: Artistic-2.0"],
    "proprietary": ["Copyright. All rights reserved.", "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher."],
}
NEUTRAL = [
    "She renewed her driving license at the office last week.",
    "The fishing licence costs more this year than last year.",
    "They asked for permission to leave the room early.",
    "The lecture on copyright law starts at noon in the main hall.",
    "The restaurant lost its liquor license after the inspection.",
    "The warranty covers parts and labour for two years.",
    "A licensed electrician must check the wiring of the house.",
    "The officer wrote down the license plate of the car.",
    "The government plans to redistribute land to small farmers.",
    "The old map is in the public domain and hangs in the library.",
    "Poetic license lets writers bend the truth a little.",
    "The town council gave permission for the new bridge.",
    "Under the new rules a version of the form must be filed.",
    "The software company announced new products and general terms.",
]
#: Sentences that only the calibration sees.
UNTRAINED = [
    "His pilot license was suspended after the second incident.",
    "The shop sells toys with a one year warranty and free delivery.",
    "Copyright disputes between the two studios lasted for a decade.",
    "Parents must sign a permission slip before the school trip.",
    "The charity will redistribute the food to families in need.",
    "Many songs of that time have entered the public domain since.",
    "A judge issued a warrant for the arrest of the driver.",
    "The ministry grants a licence to each radio station for five years.",
    "Without written permission nobody may enter the laboratory.",
    "The museum owns the copyright of the photographs on this floor.",
    "He wrote a book about software licences and the general public.",
    "The marriage license was signed by both witnesses at the town hall.",
]
FILLER = "the of and to in a is that for it was on are with as be this from or by an at we which one all has new more other time such our".split()


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^a-z0-9.+\-]+|[.\-]+(?=[^a-z0-9]|$)"), lambda w: w != "")


def _pairs(words: Column) -> Column:
    return F.array_distinct(F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.expr("slice(words, 2, greatest(size(words) - 1, 0))"), lambda a, b: F.concat_ws(" ", a, b)))


def _with_grams(rows: DataFrame) -> DataFrame:
    named = rows.withColumn("words", tokens(F.col("paragraph")))
    named = named.withColumn("pairs", _pairs(F.col("words")))
    return named.withColumn("grams", F.array_distinct(F.concat("words", "pairs")))


def training_rows(spark: SparkSession, variants: int = VARIANTS, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """(paragraph, family, label, variant) of ``texts`` (family, text), by default all templates and neutral sentences, with words dropped and added."""
    families = [*TEMPLATES, UNKNOWN]
    texts = texts or [(f, t) for f in TEMPLATES for t in TEMPLATES[f]] + [(UNKNOWN, t) for t in NEUTRAL for _ in range(2)]
    rows = F.explode(F.array(*(F.struct(F.lit(f).alias("family"), F.lit(float(families.index(f))).alias("label"), F.lit(t).alias("t"), F.lit(k).alias("k")) for k, (f, t) in enumerate(texts))))
    made = spark.range(variants).select(F.col("id").alias("variant"), rows.alias("x")).select("variant", "x.*")
    chance = lambda *of: F.pmod(F.xxhash64("variant", "k", *of), F.lit(100))
    kept = F.filter(F.split("t", " "), lambda w, i: (F.pmod(F.xxhash64(F.col("variant"), F.col("k"), i), F.lit(100)) >= 7) | (F.col("variant") == 0))
    filler = F.array(*map(F.lit, FILLER))
    side = lambda s: F.transform(
        F.sequence(F.lit(0), chance(F.lit(s)) % 8),
        lambda i: F.element_at(filler, (F.pmod(F.xxhash64(F.col("variant"), F.col("k"), F.lit(s), i), F.lit(len(FILLER))) + 1).cast("int")),
    )
    plain = (F.col("variant") == 0) | (chance(F.lit("plain")) < 30)
    whole = F.when(plain, kept).otherwise(F.concat(side("before"), kept, side("after")))
    return made.select(F.array_join(whole, " ").alias("paragraph"), "family", "label", "variant")


def train(spark: SparkSession) -> tuple[PipelineModel, float]:
    """The classifier and the calibrated least probability."""
    rows = _with_grams(training_rows(spark))
    held = F.pmod("variant", F.lit(HELD_OUT)) == HELD_OUT - 1
    model = Pipeline(
        stages=[
            HashingTF(inputCol="grams", outputCol="features", numFeatures=BUCKETS, binary=True),
            LogisticRegression(family="multinomial", regParam=PENALTY, elasticNetParam=0.5, maxIter=60),
        ]
    ).fit(rows.filter(~held))
    scored = model.transform(_with_grams(training_rows(spark, texts=[(UNKNOWN, t) for t in UNTRAINED])))
    best = F.array_max(F.slice(vector_to_array("probability"), 1, len(TEMPLATES)))
    cut = scored.agg(F.percentile(best, F.lit(1 - FALSE_SHARE))).head()[0]
    return model, max(0.5, cut if cut is not None else 0.0)


#: Model and least probability by application: trained once in each.
_trained: dict[str, tuple[PipelineModel, float]] = {}


def default_model(spark: SparkSession) -> tuple[PipelineModel, float]:
    key = spark.sparkContext.applicationId
    if key not in _trained:
        _trained.clear()
        _trained[key] = train(spark)
    return _trained[key]


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, number (from 0) and text, with its lines joined, of the paragraphs that have a cue word."""
    parts = docs.filter(F.col("text").rlike(CUE)).select("doc_id", F.posexplode(F.split("text", BREAK, -1)).alias("paragraph_no", "paragraph"))
    joined = F.regexp_replace("paragraph", WRAP, " ")
    return parts.filter(joined.rlike(CUE)).withColumn("paragraph", joined)


def _template_share(family: Column) -> Column:
    """The largest share of word pairs of one of the family's templates that are in ``pairs``."""
    share = F.lit(0.0)
    for name, texts in TEMPLATES.items():
        best = F.lit(0.0)
        for text in texts:
            words = F.transform(tokens(F.lit(text)), lambda w: w)
            own = F.array_distinct(F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b)))
            best = F.greatest(best, F.size(F.array_intersect(own, F.col("pairs"))) / F.greatest(F.size(own), F.lit(1)))
        share = F.when(family == name, best).otherwise(share)
    return share


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph_no, family, probability, template_share and confirmed for each paragraph with a cue word.

    ``family`` is unknown where no family is likely enough. Null and empty texts have no paragraphs; null doc_ids and
    repeated rows are scanned like others; an empty table gives no rows. Other columns of ``docs`` (doc_id,
    text, ...) are ignored.
    """
    model, least = default_model(docs.sparkSession)
    scored = model.transform(_with_grams(paragraphs(docs.select("doc_id", "text"))))
    names = F.array(*map(F.lit, [*TEMPLATES, UNKNOWN]))
    named = scored.withColumn("p", vector_to_array("probability"))
    known = F.slice("p", 1, len(TEMPLATES))
    best = F.array_max(known)
    family = F.when(best >= least, F.element_at(names, F.array_position(known, best).cast("int"))).otherwise(F.lit(UNKNOWN))
    named = named.withColumn("family", family).withColumn("template_share", F.round(_template_share(F.col("family")), 6))
    return named.select(
        "doc_id", "paragraph_no", "family", F.round(best, 6).alias("probability"), "template_share",
        ((F.col("family") != UNKNOWN) & (F.col("template_share") >= CONFIRMED)).alias("confirmed"),
    )
