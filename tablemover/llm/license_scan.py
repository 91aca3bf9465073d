"""License scans by diagonal voting.

Every document and every template is cut into words, and each run of ``k`` words (a gram) is hashed.  A join of
all rolling grams with the templates' gram positions, confirmed on the words themselves, votes for the diagonal
(position in the document minus position in the template) on which the two run alongside.  Votes are counted by
diagonal; neighbouring diagonals of a template, as an inserted or left out word makes them, are merged; and a
merged region is a span if its grams cover enough of the template's words and of its own.

All steps are DataFrame functions.  Texts are told apart by their SHA-256, so copies vote once (a partial
aggregate drops them before the shuffle) and documents get the spans of their text by a join.  The templates are
broadcast up to ``MOST_WORDS`` of their words and joined by a shuffle beyond.

A template of ``gap`` 0 and ``least`` 1 is a phrase: its spans are exactly the places where its words stand
consecutively.  The base phrases are such templates.

Defined cases.  A null text is the empty text, which has no word; a text of fewer words than ``k`` has no gram.
Repeated rows get the same answer each.  A very long text is one row to split into words and many rows of votes.
Overlapping spans, also of several templates (ties), all stand.  An empty table gives an empty result.  The other
columns come back packed in ``row``, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..workspace import new_run_dir, stage
from .common import UPPER, ascii_lower, field, packed

# What is no word: ASCII other than digits and lower-case letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Words of all templates up to which they are broadcast.
MOST_WORDS = 200_000
# Grams that a diagonal of a long template needs to be merged with others.
LEAST_VOTES = 3


@dataclass(frozen=True)
class Template:
    """``least``: the share of the template's words, and of the span's, that the votes must cover; ``gap``: how far
    apart neighbouring diagonals are merged."""

    label: str
    text: str
    least: float = 1.0
    gap: int = 0
    base: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(BETWEEN, self.text.translate(str.maketrans(UPPER, UPPER.lower()))) if w]


def long_text(label: str, text: str) -> Template:
    """A license text or notice that may be quoted with changes."""
    n = len(Template(label, text).words)
    return Template(label, text, least=0.8, gap=max(2, n // 16))


# The phrases that the base scan names, and their labels.
BASE_PHRASES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)
# Wordings of further licenses, as their stewards publish them.
MORE_TEMPLATES = (
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gplv3 or later"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("mpl-2", "mozilla public license v 2"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-nc-sa", "cc by nc sa"),
    Template("cc-by-nc-nd", "cc by nc nd"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc0", "cc0 1 0 universal"),
    Template("public-domain", "released into the public domain"),
    Template("all-rights-reserved", "all rights reserved"),
    long_text("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software."""),
    long_text("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    long_text("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""),
    long_text("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    long_text("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    long_text("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    long_text("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means."""),
)
TEMPLATES = BASE_PHRASES + MORE_TEMPLATES


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), BETWEEN), "")


def _grams(df: DataFrame, words: Column, place: str, k: int, carry: list[str]) -> DataFrame:
    """A row for each run of ``k`` words: its hash ``gram``, its words and its first word's place."""
    # The array beside itself, moved by one word each time; where a later one has ended its word is null.
    moved = [words] + [F.slice(words, F.lit(j + 1), F.size(words)) for j in range(1, k)]
    zipped = F.arrays_zip(*[m.alias(f"w{j}") for j, m in enumerate(moved)])
    rows = df.select(*carry, F.posexplode(zipped).alias(place, "g")).where(F.col("g").getField(f"w{k - 1}").isNotNull())
    own = [F.col("g").getField(f"w{j}") for j in range(k)]
    return rows.select(*carry, place, F.xxhash64(*own).alias("gram"), *[w.alias(f"{place}_w{j}") for j, w in enumerate(own)])


def template_grams(spark: SparkSession, templates, k: int) -> DataFrame:
    """The grams of the templates, cut by the same expressions as the documents."""
    short = [t.text for t in templates if len(t.words) < k]
    if short:
        raise ValueError(f"Templates of fewer than {k} words have no gram: {short}")
    rows = F.array(*[F.struct(F.lit(n).alias("template"), F.lit(t.text).alias("t_text")) for n, t in enumerate(templates)])
    table = spark.range(1).select(F.inline(rows))
    return _grams(table, words_of(F.col("t_text")), "t", k, ["template"])


def diagonals(texts: DataFrame, templates=TEMPLATES, k: int = 3) -> DataFrame:
    """(digest, template, diagonal, at): the template's positions that each diagonal has votes for.  ``texts`` has
    (digest, words); a text may be there several times."""
    grams = template_grams(texts.sparkSession, templates, k)
    if sum(len(t.words) for t in templates) <= MOST_WORDS:
        grams = F.broadcast(grams)
    ours = _grams(texts, F.col("words"), "d", k, ["digest"])
    same = F.lit(True)
    for j in range(k):
        same &= F.col(f"d_w{j}") == F.col(f"t_w{j}")
    votes = ours.join(grams.withColumnRenamed("gram", "t_gram"), (F.col("gram") == F.col("t_gram")) & same)
    # At most one entry per word of the template.
    return votes.groupBy("digest", "template", (F.col("d") - F.col("t")).alias("diagonal")).agg(F.collect_set("t").alias("at"))


def spans_of(votes: DataFrame, templates=TEMPLATES, k: int = 3) -> DataFrame:
    """(digest, template, label, base, start, stop, score): the verified spans, in words, the stop exclusive."""
    told = F.array(*[F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.lit(len(t.words)).alias("n"),
                              F.lit(t.gap).alias("gap"), F.lit(float(t.least)).alias("least"),
                              F.lit(min(LEAST_VOTES, len(t.words) - k + 1) if t.gap else len(t.words) - k + 1).alias("votes"))
                     for t in templates])
    votes = votes.withColumn("told", F.element_at(told, F.col("template") + 1)).where(F.size("at") >= F.col("told.votes"))
    # A group is one template's diagonals in one text.
    by_diagonal = Window.partitionBy("digest", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > F.col("told.gap")
    apart = votes.withColumn("far", F.coalesce(far, F.lit(True)).cast("int"))
    merged = (apart.withColumn("region", F.sum("far").over(by_diagonal.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("digest", "template", "region").agg(F.first("told").alias("told"), F.collect_list(F.struct("diagonal", "at")).alias("votes")))

    def covered(places):
        return F.size(F.array_distinct(F.flatten(F.transform(F.array_distinct(F.flatten(places)), lambda p: F.sequence(p, p + (k - 1))))))

    ours = F.transform("votes", lambda v: F.transform(v["at"], lambda t: t + v["diagonal"]))
    theirs = F.transform("votes", lambda v: v["at"])
    regions = merged.select("digest", "template", "told", F.array_min(F.flatten(ours)).alias("start"),
                            (F.array_max(F.flatten(ours)) + k).alias("stop"), covered(theirs).alias("of_template"), covered(ours).alias("of_span"))
    score = F.least(F.col("of_template") / F.col("told.n"), F.col("of_span") / (F.col("stop") - F.col("start")))
    return regions.withColumn("score", score).where(F.col("score") >= F.col("told.least")).select(
        "digest", "template", "told.label", "told.base", "start", "stop", "score")


def _read(docs: DataFrame, text: str, kept) -> DataFrame:
    rows = packed(docs).withColumn("text", F.coalesce(field("row", text), F.lit("")))
    return rows.select(F.struct(*[field("row", c).alias(c) for c in kept]).alias("row") if kept else F.lit(None).alias("row"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("digest"), words_of(F.col("text")).alias("words"))


def license_spans(docs: DataFrame, text: str = "text", templates=TEMPLATES, k: int = 3) -> DataFrame:
    """The verified spans of each distinct text, told by the SHA-256 of its UTF-8 bytes (``digest``)."""
    return spans_of(diagonals(_read(docs, text, ()).select("digest", "words"), templates, k), templates, k)


def labelled(docs: DataFrame, text: str = "text", templates=TEMPLATES, k: int = 3, carry=None) -> DataFrame:
    """(row, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row: the base phrases'
    places, the labels, and the best span's score (0 without one).  ``carry`` names the columns of ``row`` where not
    all are wanted."""
    spark = docs.sparkSession
    folder = new_run_dir(spark, "licenses")
    kept = docs.columns if carry is None else list(carry)
    own = F.when(F.col("base"), F.col("start"))
    found = license_spans(docs, text, templates, k).groupBy(F.col("digest").alias("of")).agg(
        F.count(own).alias("n_base"), F.min(own).cast("long").alias("first_word"), F.max(own).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("score").alias("score"))
    # Written and read anew, the spans need a shuffle of their own, so that the join can split a text of many copies.
    found = stage(found, f"{folder}/found")
    light = _read(docs, text, kept).select("row", "digest", F.size("words").cast("long").alias("n_words"))
    return light.join(found, F.col("digest") == F.col("of"), "left").select(
        "row", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
