"""License scan by diagonal voting.

All rolling word pairs of a text are joined with the places of equal pairs in
license templates.  A hit at word p of the text and word q of the template
votes for the diagonal p - q, where the template would start.  Votes are
summed for each diagonal.  For a base phrase, all of its pairs must lie on one
diagonal.  For a notice, diagonals up to its length apart are merged (inserted,
missing or moved words), and a span is verified: some stretch of at most
STRETCH times the notice's length must hold at least COVERED of its different
pairs, wherever in the merged diagonals it starts.

Cases: a null or empty text has no words, no places and score 0; rows that
repeat id and text get equal results; a place that several templates claim
counts for each; repeated notices count once for the labels; a very long text
is scanned whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import ascii_lower, documents, id_key, stored, text_hash

# Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Wording of public license notices, as lower-case words.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files", "mit-text"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the "
     "gnu general public license", "gpl-notice"),
    ("redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("all rights reserved", "all-rights-reserved"),
)
WORD_BREAK = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
COVERED = 0.75             # least share of a notice's pairs
STRETCH = 1.5              # longest span, in lengths of the notice
APART = 1.0                # distance of diagonals that still belong together, in lengths of the notice


def templates(spark: SparkSession) -> DataFrame:
    """One row for each word pair of each template (a fixed, small table).
    Template -1 with an empty pair lets every text through the join."""
    rows = [(-1, "", -1, 1, False, "")]
    for i, (text, label) in enumerate((*PHRASES, *NOTICES)):
        words = text.split()
        rows += [(i, label, q, len(words), i < len(PHRASES), f"{words[q]} {words[q + 1]}")
                 for q in range(len(words) - 1)]
    return spark.createDataFrame(rows, "template int, label string, q int, m int, base boolean, pair string"
                                 ).withColumn("h", F.xxhash64("pair"))


def hits(docs: DataFrame) -> DataFrame:
    """Equal pairs of texts and templates: (row, n_words, template, p, q)."""
    words = f"filter(split(low, '{WORD_BREAK}', -1), w -> w <> '')"
    pairs = """concat(array(''), CASE WHEN size(ws) > 1 THEN zip_with(
        slice(ws, 1, size(ws) - 1), slice(ws, 2, size(ws) - 1), (a, b) -> concat(a, ' ', b)) ELSE array() END)"""
    rows = (docs.select(id_key().alias("__id"), text_hash().alias("__th"),
                        ascii_lower(F.coalesce("text", F.lit(""))).alias("low"))
            .selectExpr("__id", "__th", f"{words} AS ws")
            .selectExpr("__id", "__th", "CAST(size(ws) AS bigint) AS n_words", f"posexplode({pairs}) AS (p, pair)"))
    # the empty pair stands first, so the pair of words p and p + 1 has place p + 1
    rows = rows.withColumns({"p": F.col("p") - 1, "h": F.xxhash64("pair")})
    return rows.join(F.broadcast(templates(docs.sparkSession)), ["h", "pair"])


def spans(found: DataFrame) -> DataFrame:
    """Whole phrases and the fullest stretch of each group of merged diagonals:
    (row, n_words, template, d, share, base)."""
    row = ["__id", "__th", "n_words", "template", "label", "m", "base"]
    voted = found.withColumns({"d": F.col("p") - F.col("q"), "bit": F.expr("shiftleft(1L, greatest(q, 0))")})
    share = F.when(F.col("template") >= 0, F.bit_count("pairs") / (F.col("m") - 1)).otherwise(F.lit(0.0))
    phrases = voted.filter("base OR template < 0").groupBy(*row, "d").agg(F.bit_or("bit").alias("pairs"))
    own = Window.partitionBy("__id", "__th", "template").orderBy("d", "p")
    fresh = F.coalesce(F.col("d") - F.lag("d").over(own) > APART * F.col("m"), F.lit(True))
    merged = (voted.filter("NOT base AND template >= 0").withColumn("new", fresh.cast("int"))
              .withColumn("part", F.sum("new").over(own)))
    # the pairs of places p to p + STRETCH * m - 2 lie in a stretch of STRETCH * m words
    stretch = F.expr(f"""bit_or(bit) OVER (PARTITION BY __id, __th, template, part
        ORDER BY CAST(p / ({STRETCH} * m - 1.5) AS double) RANGE BETWEEN CURRENT ROW AND 1.0D FOLLOWING)""")
    fullest = merged.withColumn("pairs", stretch).groupBy(*row, "part").agg(
        F.max_by("pairs", F.struct(F.bit_count("pairs"), -F.col("d"))).alias("pairs"), F.min("d").alias("d"))
    return phrases.unionByName(fullest.drop("part")).withColumn("share", share)


def scan(docs: DataFrame) -> DataFrame:
    """One row for each distinct (id, text): places, labels and score."""
    # written, as phrases and notices both read the hits
    s = spans(stored(hits(docs), "license-hits"))
    phrase = F.col("base") & (F.col("share") == 1)
    notice = ~F.col("base") & (F.col("share") >= COVERED)
    label = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("label")))), ",")
    return s.groupBy("__id", "__th", "n_words").agg(
        F.count(F.when(phrase, 1)).alias("n_base"), F.min(F.when(phrase, F.col("d").cast("long"))).alias("first_word"),
        F.max(F.when(phrase, F.col("d").cast("long"))).alias("last_word"), label(phrase).alias("base_labels"),
        label(phrase | notice).alias("labels"),
        F.max(F.when(phrase | notice, F.lit(1.0)).otherwise(F.least("share", F.lit(0.99)))).alias("score"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base places, labels and score of every document."""
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", id_key().alias("__id"), text_hash().alias("__th"))
    return rows.join(scan(docs), ["__id", "__th"]).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
