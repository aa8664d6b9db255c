"""License scans by diagonal voting; built-in functions only.

Every two neighbouring words of a text are hashed and joined to the places of that pair in the
templates, a fixed small table. A hit votes for a diagonal: the place in the text less the place in
the template, which is where the template would begin. Votes are kept as a set of template places in the
bits of a long, one for every 64 places, so they are aggregated before the shuffle, repeated rows do not count
twice and templates, whole licence texts too, may be of any length. Short
phrases have to fill their diagonal. For notices, neighbouring diagonals, which words that were put in
or left out lead to, are merged before the share of the template that was found is verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

COVERAGE = 0.8  # share of a notice's word pairs that makes a finding
DRIFT = 2  # diagonals this close are one finding

# Labels and phrases that count wherever their words stand one after the other.
PHRASES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]
# Labels and wording of license notices.
NOTICES = [
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-notice", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("mit-notice", "released under the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of ASCII letters and digits and any other characters, A-Z lowered; null counts as empty.

    ``lower`` changes other letters too, which no template holds; the Kelvin sign, the one of them that
    would become an ASCII letter, is put aside.
    """
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(low, _BETWEEN), "")


def _templates(spark: SparkSession, phrases, notices) -> DataFrame:
    """A row per word pair of each template; its size is that of the fixed lists."""
    rows = []
    for number, (label, text, exact) in enumerate([(*p, True) for p in phrases] + [(*n, False) for n in notices]):
        parts = text.split()
        if len(parts) < 2:
            raise ValueError(f"a template has two words or more: {text!r}")
        rows += [(number, label, exact, len(parts) - 1, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
    frame = spark.createDataFrame(rows, "template int, label string, exact boolean, pairs int, place int, one string, two string")
    return frame.withColumns({"pair": F.xxhash64("one", "two"), "chunk": F.floor(F.col("place") / 64).cast("int")})


def diagonals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=None, notices=None) -> DataFrame:
    """(id, content, n_words, template, label, exact, pairs, start, chunk, found, copies) by diagonal.

    ``found`` has a bit for each word pair of the template that stands on the diagonal, a row per ``chunk`` of 64. For every distinct
    (id, text) there is one row without template, whose ``copies`` counts its rows; ``content`` tells
    different texts of one id apart.
    """
    phrases, notices = PHRASES if phrases is None else phrases, NOTICES if notices is None else notices
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("content"), words(F.col(text_col)).alias("words"))
    # The empty word after the last one stands for the text itself.
    spread = rows.select("id", "content", F.size("words").alias("n_words"), F.array_append("words", "").alias("words"))
    spread = spread.select("*", F.posexplode("words").alias("at", "word")).withColumn("after", F.get("words", F.col("at") + 1))
    spread = spread.select("id", "content", "n_words", "at", "word", "after", F.xxhash64("word", "after").alias("pair"))
    table = F.broadcast(_templates(docs.sparkSession, phrases, notices))  # fixed lists
    same = (spread.pair == table.pair) & (spread.word == table.one) & (spread.after == table.two)
    hits = spread.join(table, same, "left").filter(F.col("template").isNotNull() | (F.col("at") == F.col("n_words")))
    return hits.groupBy("id", "content", "n_words", "template", "label", "exact", "pairs", (F.col("at") - F.col("place")).alias("start"), "chunk").agg(
        F.bit_or(F.expr("shiftleft(1L, place % 64)")).alias("found"),
        F.count(F.lit(1)).alias("copies"),
    )


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, coverage: float = COVERAGE, phrases=None, notices=None
) -> DataFrame:
    """(id, n_words, spans, score) for every row.

    ``spans`` is sorted: (start, words, label, exact, share) with the first word's number from 0. Each
    place of a phrase is a span of its own (exact); of a notice each group of neighbouring diagonals that
    holds ``coverage`` of its word pairs. ``score`` is the largest share of any template found, 1 for a
    whole phrase or notice. Null and blank texts have no words; repeated rows give a row each; an empty
    table gives no rows. Texts may be of any length; other columns are not read, whatever their names.
    """
    found = diagonals(docs, id_col, text_col, phrases, notices)
    key = ["id", "content", "n_words"]
    order = Window.partitionBy(*key, "template").orderBy("start")
    first = F.coalesce(F.col("start") - F.lag("start").over(order) > F.when(F.col("exact"), 0).otherwise(DRIFT), F.lit(True))
    grouped = found.withColumn("first", first.cast("int")).withColumn("group", F.sum("first").over(order))
    template = ["template", "label", "exact", "pairs", "group"]
    chunks = grouped.groupBy(*key, *template, "chunk").agg(
        F.min("start").alias("start"), F.max("start").alias("last"), F.bit_or("found").alias("found"), F.max("copies").alias("copies"),
    )
    merged = chunks.groupBy(*key, *template).agg(
        F.min("start").alias("start"), F.max("last").alias("last"), F.sum(F.bit_count("found")).alias("found"), F.max("copies").alias("copies"),
    )
    share = F.col("found") / F.col("pairs")
    size = (F.col("pairs") + 1 + F.col("last") - F.col("start")).cast("int")
    verified = F.when(F.col("exact"), share == 1).otherwise(share >= coverage)
    span = F.struct(F.greatest("start", F.lit(0)).cast("int").alias("start"), size.alias("words"), "label", "exact", share.alias("share"))
    whole = merged.groupBy(*key).agg(
        F.max(F.when(F.col("template").isNull(), F.col("copies"))).alias("copies"),
        F.array_sort(F.collect_list(F.when(verified, span))).alias("spans"),
        F.coalesce(F.max(share), F.lit(0.0)).alias("score"),
    )
    each = whole.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select("id", F.col("n_words").cast("long").alias("n_words"), "spans", "score")
