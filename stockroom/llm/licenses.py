"""License scan by diagonal voting, in DataFrame operations only.

All rolling three-word hashes of all texts meet the three-word hashes of license templates in one
join. A hit votes for a diagonal: its place in the text less its place in the template. Neighbouring
diagonals of a template (a word was put in or left out) merge into one span, and the span is
verified word by word: how many words of the template it covers, and how many words of the text
between its ends belong to no hit. Of spans that overlap the best one counts, since notices of
different licenses share most of their words.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # upper case is folded later
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM = 3
#: Diagonals this near each other belong to one span.
NEAR = 3
#: A span counts if it has at most one fault for so many words of the template: a word missing, put
#: in or replaced. In a short notice a single word ("lesser", "noncommercial") makes another license.
FAULT = 20

# Phrases that give a label wherever their words stand consecutively.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Notices and whole texts of public licenses.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
        "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for "
        "any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the "
        "software or the use or other dealings in the software",
        "mit",
    ),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2"),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain "
        "a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software "
        "distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied "
        "see the license for the specific language governing permissions and limitations under the license",
        "apache-2",
    ),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the "
        "above copyright notice and this permission notice appear in all copies",
        "isc",
    ),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "0bsd"),
    (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages "
        "arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial "
        "applications and to alter it and redistribute it freely",
        "zlib",
    ),
    (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or "
        "distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
        "unlicense",
    ),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu lesser general public license version 2 1", "lgpl-2.1"),
    ("licensed under the gnu lesser general public license version 3", "lgpl-3"),
    ("licensed under the gnu affero general public license version 3", "agpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license", "agpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", "epl-2"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", "epl-1"),
    ("to the extent possible under law the person who associated cc0 with this work has waived all copyright and related or neighboring rights", "cc0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution noderivatives 4 0 international license", "cc-by-nd"),
    ("this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license", "cc-by-nc-sa"),
    ("this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international license", "cc-by-nc-nd"),
)

Template = tuple[str, str]


def template_grams(spark: SparkSession, phrases: tuple[Template, ...], templates: tuple[Template, ...]) -> DataFrame:
    """(gram, words, template, label, base, length, place): a row for each three words of each
    template, and one with template -1 that every text hits once. As many rows as the given
    templates have words, so joins may broadcast them."""
    rows = ["(-1, '', false, 1, 0, cast(array() as array<string>))"]
    for number, (text, label) in enumerate([*phrases, *templates]):
        words = text.split()
        if len(words) < GRAM or not re.fullmatch("[a-z0-9 ]+", text) or not re.fullmatch("[\\w.-]+", label):
            raise ValueError(f"a template has {GRAM} or more words of a-z and 0-9 and a plain label: {text!r}, {label!r}")
        for place in range(len(words) - GRAM + 1):
            gram = ", ".join(f"'{w}'" for w in words[place : place + GRAM])
            rows.append(f"({number}, '{label}', {str(number < len(phrases)).lower()}, {len(words)}, {place}, array({gram}))")
    table = spark.sql(f"select * from values {', '.join(rows)} as t(template, label, base, length, place, words)")
    hashed = F.xxhash64(*[F.xxhash64(F.col("words")[i]) for i in range(GRAM)])
    return table.withColumn("gram", F.when(F.col("template") >= 0, hashed).otherwise(F.lit(0).cast("long")))


def _rolling() -> Column:
    """A 0 for the text itself, then the hashes of words i, i + 1, i + 2, from the column ``hashes``."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("hashes") - GRAM, F.lit(0)))
    grams = F.transform(starts, lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(GRAM)]))
    return F.concat(F.array(F.lit(0).cast("long")), F.when(F.size("hashes") >= GRAM, grams).otherwise(F.array().cast("array<long>")))


def scan_licenses(docs: DataFrame, phrases: tuple[Template, ...] = PHRASES, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_base (places of phrases), first_word
    and last_word (their smallest and largest start, else null), base_labels, labels and score: the
    largest share of a counted span, its covered template words over the template's words and the
    foreign words of the span (1 for a phrase).

    Of spans that overlap, directly or in a chain, the one with most covered words less its faults
    counts, then the first template. Phrases always count. A null or empty text has no words, no
    labels and score 0. Repeated rows and null ids are rows like any other; an empty table gives an
    empty result; other columns are not read. Texts are read once and never shuffled: only hits and
    one row for each text are.
    """
    grams = template_grams(docs.sparkSession, phrases, templates)
    words = F.coalesce(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), words.alias("said"))
    hashed = texts.withColumn("hashes", F.transform("said", lambda w: F.xxhash64(F.lower(w))))
    # generator and join stay free of lambdas: only then are they compiled together, and the words of
    # a text are not copied for each of its places
    rolled = hashed.select("doc_id", "row", "said", F.size("said").cast("long").alias("n_words"), _rolling().alias("rolling"))
    # outer: no array here is empty, but a plain explode would be guarded by a filter on its size,
    # and pushing that filter down would compute the hashes anew for each place
    places = rolled.select("doc_id", "row", "said", "n_words", F.posexplode_outer("rolling").alias("at", "gram"))
    met = places.join(F.broadcast(grams), "gram")
    spoken = F.array(*[F.translate(F.get("said", F.col("at") - 1 + k), UPPER, LOWER) for k in range(GRAM)])
    true_hit = F.when(F.col("template") < 0, F.col("at") == 0).otherwise((F.col("at") > 0) & (spoken == F.col("words")))
    place = F.when(F.col("template") >= 0, F.col("place")).otherwise(0)
    diagonal = F.when(F.col("template") >= 0, F.col("at") - 1 - F.col("place")).otherwise(0).cast("long")
    hits = met.where(true_hit).select("doc_id", "row", "n_words", "template", "label", "base", "length", diagonal.alias("diagonal"), place.alias("place"))

    # from here on all rows of a text stay in one partition: a text has fewer hits than words
    text = ["row", "doc_id", "n_words"]
    kind = [*text, "template", "label", "base", "length"]
    lines = hits.repartition("row").groupBy(*kind, "diagonal").agg(F.collect_list("place").alias("places"))
    along = Window.partitionBy(*kind).orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > NEAR).cast("int"), F.lit(0))
    # a phrase stands where all its places are on one diagonal
    exact = F.col("base") & (F.size("places") == F.col("length") - GRAM + 1)
    lines = lines.withColumn("apart", apart).withColumn("span", F.sum("apart").over(along)).withColumn("exact", exact)
    covered = lambda of: F.flatten(F.collect_set(F.flatten(F.transform("places", of))))
    spans = lines.groupBy(*kind, "span").agg(
        F.size(F.array_distinct(covered(lambda p: F.array(*[p + k for k in range(GRAM)])))).alias("covered"),
        F.size(F.array_distinct(covered(lambda p: F.array(*[p + k + F.col("diagonal") for k in range(GRAM)])))).alias("said"),
        F.min(F.array_min("places") + F.col("diagonal")).alias("from_word"),
        F.max(F.array_max("places") + F.col("diagonal") + GRAM - 1).alias("to_word"),
        F.sum(F.col("exact").cast("long")).alias("n_exact"),
        F.min(F.when(F.col("exact"), F.col("diagonal"))).alias("first_exact"),
        F.max(F.when(F.col("exact"), F.col("diagonal"))).alias("last_exact"),
    )
    foreign = F.col("to_word") - F.col("from_word") + 1 - F.col("said")
    spans = spans.withColumn("foreign", foreign)
    faults = F.greatest(F.col("length") - F.col("covered"), F.col("foreign"))
    fits = (F.col("template") >= 0) & ~F.col("base") & (faults * FAULT <= F.col("length"))
    spans = spans.withColumn("fits", fits).withColumn("agreed", F.col("covered") - faults)
    # overlapping spans form clusters: a new one starts behind the furthest end so far
    in_text = Window.partitionBy("row", "fits").orderBy("from_word", "to_word", "template")
    reach = F.max("to_word").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("opens", F.coalesce((F.col("from_word") > reach).cast("int"), F.lit(0)))
    spans = spans.withColumn("cluster", F.sum("opens").over(in_text.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    best = Window.partitionBy("row", "fits", "cluster").orderBy(F.desc("agreed"), "template", "from_word")
    chosen = F.col("fits") & (F.row_number().over(best) == 1)
    spans = spans.withColumn("found", chosen | (F.col("n_exact") > 0))
    spans = spans.withColumn("share", F.when(F.col("base"), F.lit(1.0)).otherwise(F.col("covered") / (F.col("length") + F.col("foreign"))))
    labels = lambda when: F.array_join(F.array_sort(F.collect_set(F.when(when, F.col("label")))), ",")
    return (
        spans.groupBy(*text)
        .agg(
            F.sum("n_exact").alias("n_base"),
            F.min("first_exact").alias("first_word"),
            F.max("last_exact").alias("last_word"),
            labels(F.col("found") & F.col("base")).alias("base_labels"),
            labels(F.col("found")).alias("labels"),
            F.coalesce(F.max(F.when(F.col("found"), F.col("share"))), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
