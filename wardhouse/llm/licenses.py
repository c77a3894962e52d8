"""License scan by diagonal voting.

All rolling word k-grams of all documents are joined by hash to their positions in license templates. A hit at document
word p and template word t votes for the diagonal p - t. Votes are summed per diagonal, neighbouring diagonals (words
inserted or left out) are merged, and a span counts when the places of the template that its verified votes meet are enough of all.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardhouse.llm.common import ascii_lower, cut

# Phrases whose every exact place counts, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Texts and headers of public licenses, with the label of the license.
LONG = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software."""),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer."""),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
General Public License as published by the Free Software Foundation"""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at"""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""),
    ("cc-by", """This work is licensed under a Creative Commons Attribution 4.0 International License"""),
    ("cc-by-sa", """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"""),
    ("cc-by-nc", """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"""),
    ("cc-by-nd", """This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"""),
]
# How a short notice begins, and the names that licenses go by in one.
NOTICES = ("licensed under the", "released under the", "distributed under the", "available under the", "under the terms of the")
NAMES = [
    ("mit", "MIT License"), ("apache-2.0", "Apache License, Version 2.0"), ("apache-2.0", "Apache License 2.0"), ("apache-2.0", "Apache 2.0 License"),
    ("bsd", "BSD License"), ("bsd", "3-Clause BSD License"), ("bsd", "2-Clause BSD License"), ("gpl", "GNU General Public License"), ("gpl", "GNU GPL"),
    ("lgpl", "GNU Lesser General Public License"), ("agpl", "GNU Affero General Public License"), ("isc", "ISC License"), ("mpl-2.0", "Mozilla Public License"),
    ("unlicense", "Unlicense"),
]
# Identifiers of the SPDX list, and the names of the Creative Commons family.
SPDX = [("mit", "MIT"), ("apache-2.0", "Apache-2.0"), ("bsd", "BSD-2-Clause"), ("bsd", "BSD-3-Clause"), ("gpl", "GPL-2.0"), ("gpl", "GPL-3.0"),
        ("lgpl", "LGPL-2.1"), ("lgpl", "LGPL-3.0"), ("agpl", "AGPL-3.0"), ("isc", "ISC"), ("mpl-2.0", "MPL-2.0"), ("unlicense", "Unlicense")]
COMMONS = [("cc-by", "CC BY 4.0"), ("cc-by-sa", "CC BY-SA 4.0"), ("cc-by-nc", "CC BY-NC 4.0"), ("cc-by-nd", "CC BY-ND 4.0"), ("cc0", "CC0 1.0")]
TEMPLATES = [
    *LONG,
    *[(label, f"{notice} {name}") for notice in NOTICES for label, name in NAMES],
    *[(label, f"SPDX-License-Identifier: {name}") for label, name in SPDX],
    *[(label, f"{notice} {name}") for notice in ("licensed under", "released under", "available under") for label, name in COMMONS],
]
PHRASE_GRAM, TEMPLATE_GRAM = 2, 4
# Diagonals at most so many words apart are one span; the template's places that it meets must be this share of all, and
# all of them for a template of few grams, such as a notice of one line.
NEIGHBOUR_WORDS, COVERAGE, SHORT_GRAMS = 3, 0.75, 12
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of the text with A-Z lowered: ASCII letters, digits and everything beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS), "")


def _template_rows() -> list[tuple]:
    """(k, gram, template, label, exact, position, number of grams)"""
    out = []
    for exact, k, texts in ((True, PHRASE_GRAM, [(v, p) for p, v in PHRASES.items()]), (False, TEMPLATE_GRAM, TEMPLATES)):
        for number, (label, text) in enumerate(texts):
            parts = [w for w in re.split(SEPARATORS, text.lower()) if w]
            grams = [" ".join(parts[i : i + k]) for i in range(len(parts) - k + 1)]
            out += [(k, g, number + 1000 * exact, label, exact, i, len(grams)) for i, g in enumerate(grams)]
    return out


def _templates(spark: SparkSession) -> DataFrame:
    """As many rows as the templates have words; never more, whatever the documents."""
    schema = "k int, gram string, template int, label string, exact boolean, at int, grams int"
    return spark.createDataFrame(_template_rows(), schema)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    `n_base` counts the places of PHRASES, `first_word` and `last_word` are the least and largest word number where one
    starts (null if none). `labels` adds the licenses whose template is covered by COVERAGE at least, a short one in full.
    `score` is the largest share of a template found, 1 if a phrase was. Null and empty texts have no words. Ids may be null or
    repeated; other columns are ignored.
    """
    spark = df.sparkSession
    rows = _template_rows()
    # Hashes of the templates' grams, computed by the same function as those of the documents.
    hashed = spark.createDataFrame([(r[0], *r[1].split(" ")) for r in rows if r[0] == TEMPLATE_GRAM], "k int, a string, b string, c string, d string")
    long_hashes = [r[0] for r in hashed.select(F.xxhash64("a", "b", "c", "d")).distinct().collect()]
    hashed = spark.createDataFrame([tuple(r[1].split(" ")) for r in rows if r[0] == PHRASE_GRAM], "a string, b string")
    short_hashes = [r[0] for r in hashed.select(F.xxhash64("a", "b")).distinct().collect()]

    source = df.select(F.monotonically_increasing_id().alias("row"), df[id_col].alias("id"), words(df[text_col]).alias("words"))
    word = lambda i: F.get("words", F.col("pos") + i)
    # Position -1 stands for the document itself, so that one pass yields documents and hits.
    every = source.select("row", "id", "words", F.explode(F.sequence(F.lit(-1), F.greatest(F.size("words") - 2, F.lit(-1)))).alias("pos"))
    every = every.select(
        "*",
        F.xxhash64(word(0), word(1)).isin(short_hashes).alias("short"),
        (F.xxhash64(word(0), word(1), word(2), word(3)).isin(long_hashes) & word(3).isNotNull()).alias("long"),
    )
    alone = F.col("pos") == -1
    joined = lambda k: F.array_join(F.slice("words", F.col("pos") + 1, F.lit(k)), " ")
    met = cut(
        every.where(alone | F.col("short") | F.col("long")).select(
            "row",
            "pos",
            F.when(alone, F.col("id")).alias("id"),
            F.when(alone, F.size("words")).cast("long").alias("n_words"),
            F.when(~alone & F.col("short"), joined(PHRASE_GRAM)).alias("short"),
            F.when(~alone & F.col("long"), joined(TEMPLATE_GRAM)).alias("long"),
        )
    )
    grams = met.where("pos >= 0").select(
        "row", "pos", F.explode(F.expr(f"array(struct({PHRASE_GRAM} k, short gram), struct({TEMPLATE_GRAM} k, long gram))")).alias("g")
    )
    hits = grams.select("row", "pos", "g.k", "g.gram").join(F.broadcast(_templates(spark)), ["k", "gram"])
    diagonals = hits.groupBy("row", "template", "label", "exact", "grams", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.collect_set("at").alias("places"), F.min("pos").alias("first"), F.max("pos").alias("last")
    )
    # A phrase stands where a diagonal has all its votes; each vote was compared word by word.
    base = diagonals.where("exact and votes = grams").groupBy("row").agg(
        F.count(F.lit(1)).alias("n_base"),
        F.min("diagonal").alias("first_word"),
        F.max("diagonal").alias("last_word"),
        F.collect_set("label").alias("base_set"),
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    starts = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > NEIGHBOUR_WORDS, F.lit(True)).cast("int")
    spans = diagonals.where("not exact").withColumn("starts", starts)
    spans = spans.withColumn("span", F.sum("starts").over(order)).groupBy("row", "template", "label", "grams", "span").agg(
        F.collect_list("places").alias("places"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    # Places of the template that the span meets, each counted once: a gram that stands twice votes once.
    share = F.size(F.array_distinct(F.flatten("places"))) / F.col("grams")
    close = F.col("last") - F.col("first") < 2 * F.col("grams")
    needed = F.when(F.col("grams") < SHORT_GRAMS, 1.0).otherwise(COVERAGE).alias("needed")
    found = spans.select("row", "label", F.when(close, share).otherwise(F.lit(0.0)).alias("share"), needed).groupBy("row").agg(
        F.collect_set(F.when(F.col("share") >= F.col("needed"), F.col("label"))).alias("set"), F.max("share").alias("share")
    )
    empty = F.array().cast("array<string>")
    joined_labels = lambda c: F.array_join(F.array_sort(c), ",")
    base_set = F.coalesce("base_set", empty)
    docs = met.where("pos = -1").select("row", "id", "n_words")
    return docs.join(base, "row", "left").join(found, "row", "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        joined_labels(base_set).alias("base_labels"),
        joined_labels(F.array_union(base_set, F.coalesce("set", empty))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
