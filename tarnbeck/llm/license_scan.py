"""License scans by diagonal voting, in DataFrame operations alone."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The base phrases, each with its label.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Short notices, each with its label.
NOTICES = {
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "free software foundation either version 3 of the license or at your option any later version": "gpl",
    "you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "under the terms of the gnu lesser general public license": "lgpl",
    "under the terms of the gnu affero general public license": "agpl",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "this work is licensed under a creative commons attribution": "cc",
    "all rights reserved": "reserved",
}

#: Whole licences by label; each of their sentences is a template.
LICENCES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in
        the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
        and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
        TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
        OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source
        code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor
        the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software,
        either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a gram; a template of fewer words, and a base phrase, has bigrams.
GRAM = 4
#: Diagonals at most so many words apart belong to one span (words put in or left out).
NEAR = 3
#: The share of a template's words that a verified span covers.
SHARE = 0.6
_END = -1


def template_rows() -> list[tuple]:
    """(gram, template, k, at, grams, words, need, label, base) for each gram, of k words."""
    sentences = {" ".join(re.findall(WORD, x.lower())): label for label, text in LICENCES.items() for x in re.split(r"[.:] |\.$", text)}
    rows = []
    for t, (phrase, label) in enumerate([*BASE.items(), *NOTICES.items(), *((x, y) for x, y in sentences.items() if x)]):
        words, base = phrase.split(), phrase in BASE
        k = 2 if base or len(words) < GRAM else GRAM
        grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
        need = len(words) if base else -int(-SHARE * len(words) // 1)
        rows += [(g, t, k, i, len(grams), len(words), need, label, base) for i, g in enumerate(grams)]
    return rows


def lowered(text):
    """A-Z in lower case. Other letters may change too, but never to or from an ASCII letter."""
    kept = F.replace(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("K"), F.lit("ſ")), F.lit("İ"), F.lit("ı"))
    return F.lower(kept)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find licence phrases, notices and the sentences of whole licences in whole texts.

    Every rolling word bigram and GRAM-gram is hashed and joined with the template positions (a fixed
    table of a few hundred rows, broadcast); after its words are compared outright, a match votes for
    its template's offset diagonal. A diagonal with all votes of a base phrase is one of its places.
    Neighbouring diagonals are merged to spans; a span is verified by the template's words that its
    matches cover, each once, and gives its label if they are enough.

    Returns per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the
    largest share of a template's words that a labelled span covers; 0 without one).

    Null and empty texts have no words, no places and score 0. Repeated rows and rows with null ids
    are scanned each on its own (a row number keeps them apart); other columns are ignored; an empty
    table gives an empty result. One shuffle, of matches only, by row.
    """
    spark = docs.sparkSession
    values = ", ".join("({!r}, {}, {}, {}, {}, {}, {}, {!r}, {})".format(*r) for r in template_rows())
    templates = spark.sql(f"SELECT * FROM VALUES {values}, ('', {_END}, 0, 0, 1, 1, 1, NULL, False) AS t(words_of, template, k, at, grams, size, need, label, base)")
    own = F.split("words_of", " ")
    halves = [F.xxhash64(F.get(own, F.lit(i)), F.get(own, F.lit(i + 1))) for i in (0, GRAM - 2)]
    code = F.when(F.col("k") == 2, halves[0]).when(F.col("k") == GRAM, F.xxhash64(*halves)).otherwise(F.lit(_END).cast("long"))
    templates = templates.withColumn("gram", code)
    words = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.regexp_extract_all(lowered(F.col(text_col)), F.lit(WORD), F.lit(0)).alias("words"),
    ).withColumn("n_words", F.size("words"))
    twos = F.zip_with("words", F.slice("words", 2, F.greatest(F.col("n_words"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    words = words.withColumn("twos", twos)
    fours = F.zip_with("twos", F.slice("twos", GRAM - 1, F.greatest(F.col("n_words"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    # the last element stands for the text's end, so that texts without any match stay
    places = words.withColumn("all", F.concat("twos", fours, F.array(F.lit(_END).cast("long")))).select(
        "row", "doc_id", "words", "n_words", F.size("twos").alias("half"), F.posexplode_outer("all").alias("i", "gram")
    )
    pos = F.when(F.col("template") == _END, F.col("n_words")).when(F.col("k") == 2, F.col("i")).otherwise(F.col("i") - F.col("half"))
    same = F.array_join(F.slice("words", F.greatest(F.col("pos") + 1, F.lit(1)), F.col("k")), " ") == F.col("words_of")
    matches = (
        places.join(F.broadcast(templates), "gram")
        .withColumn("pos", pos)
        .where((F.col("template") == _END) | ((F.col("pos") >= 0) & same))
        .select("row", "doc_id", "template", "k", "at", "grams", "size", "need", "label", "base", (F.col("pos") - F.col("at")).alias("diagonal"))
        .repartition("row")
    )
    facts = ("k", "grams", "size", "need", "label", "base")
    diagonals = matches.groupBy("row", "doc_id", "template", "diagonal").agg(F.collect_set("at").alias("votes"), *(F.first(c).alias(c) for c in facts))
    full = F.size("votes") == F.col("grams")
    by = Window.partitionBy("row", "template").orderBy("diagonal")
    spans = (
        diagonals.withColumn("new", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by) > NEAR).cast("int"), F.lit(1)))
        .withColumn("span", F.sum("new").over(by))
        .groupBy("row", "doc_id", "template", "span")
        .agg(
            F.array_distinct(F.flatten(F.collect_set("votes"))).alias("votes"),
            F.count(F.when(full, 1)).alias("places"),
            F.min(F.when(full, F.col("diagonal"))).alias("first"),
            F.max(F.when(full, F.col("diagonal"))).alias("last"),
            F.max("diagonal").alias("end"),
            *(F.first(c).alias(c) for c in facts),
        )
        .withColumn("covered", F.size(F.array_distinct(F.flatten(F.transform("votes", lambda a: F.sequence(a, a + F.greatest(F.col("k"), F.lit(1)) - 1))))))
    )
    found = F.when(F.col("base"), F.col("places") > 0).otherwise(F.col("covered") >= F.col("need")) & (F.col("template") != _END)
    own = F.col("base") & (F.col("places") > 0)

    def joined(rule):
        return F.array_join(F.array_sort(F.collect_set(F.when(rule, F.col("label")))), ",")

    return (
        spans.groupBy("row", "doc_id")
        .agg(
            F.max(F.when(F.col("template") == _END, F.col("end"))).cast("long").alias("n_words"),
            F.coalesce(F.sum(F.when(own, F.col("places"))), F.lit(0)).cast("long").alias("n_base"),
            F.min(F.when(own, F.col("first"))).cast("long").alias("first_word"),
            F.max(F.when(own, F.col("last"))).cast("long").alias("last_word"),
            joined(own).alias("base_labels"),
            joined(found).alias("labels"),
            F.coalesce(F.max(F.when(found, F.col("covered") / F.col("size"))), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
