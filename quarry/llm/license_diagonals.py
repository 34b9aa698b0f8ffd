"""License scans by diagonal voting (operator 4); DataFrame functions only.

Every pair of neighbouring words of every text is joined with the pairs of
the license templates (a fixed, small table, broadcast). A match at text
word p and template word t lies on the diagonal p - t; a template that
stands in a text shows as many matches on one diagonal. Votes are counted by
(text, template, diagonal) with partial sums; neighbouring diagonals, as
left by an inserted or lost word, are merged into runs.

A run with enough votes is verified: its span is the longest chain of matches
whose template places and text places both increase, with at most DRIFT
diagonals of change for each template place it goes on. The chain must hold
enough of the template's pairs; each counts once, so a repeated pair adds
nothing, and a chain is never longer than the template and what is inserted
in it, however long the run is.

A short phrase (a template marked exact) must have all its pairs on one
diagonal, so its words stand there consecutively. The join compares words
and not only their hashes, which verifies every vote.

A text is known by its 64-bit hash and length, so rows with equal texts
share one result and rows that repeat an id stay apart. Null and wordless
texts have no places, no labels and score 0. Long texts are read whole; an
empty table gives no rows. Other columns, which may have any name, are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, table, written

# Phrases of the contract and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices of well-known public licenses, and their labels.
NOTICES = {
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the Software), to deal in the Software without restriction, "
                "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                "sublicense, and/or sell copies of the Software",
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "gpl-notice": "licensed under the GNU General Public License, version 3",
    "gpl-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                "provided that the following conditions are met",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "mit-notice": "Released under the MIT License",
}
SHARE = 0.75            # share of a notice's word pairs that a span must hold
DRIFT = 3               # diagonals that far apart are merged

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _template_words(text: str) -> list[str]:
    lowered = text.translate({c: c + 32 for c in range(65, 91)})
    return [w for w in re.split(WORD_GAP, lowered) if w]


def templates(spark, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """(template, label, exact, pairs, tpos, w1, w2): a row a word pair."""
    rows = []
    for exact, label, text in [(True, v, k) for k, v in phrases.items()] + [(False, k, v) for k, v in notices.items()]:
        w = _template_words(text)
        number = len({r[0] for r in rows})
        rows += [(number, label, exact, len(w) - 1, t, a, b) for t, (a, b) in enumerate(zip(w, w[1:]))]
    return spark.createDataFrame(rows, "template int, label string, exact boolean, pairs int, tpos int, w1 string, w2 string")


def _words(text):
    return F.filter(F.split(ascii_lower(text), WORD_GAP), lambda w: w != "")


def votes(docs: DataFrame, tmpl: DataFrame) -> DataFrame:
    """(tid, size, template, tpos, pos): a row a matching word pair."""
    texts = docs.select(F.xxhash64("text").alias("tid"), F.octet_length("text").alias("size"), _words(F.col("text")).alias("words"))
    pairs = (texts.where(F.size("words") >= 2)
             .select("tid", "size", F.posexplode(F.transform(
                 "words", lambda w, i: F.struct(w.alias("w1"), F.get(F.col("words"), i + 1).alias("w2")))).alias("pos", "p"))
             .select("tid", "size", "pos", "p.w1", "p.w2", F.xxhash64("p.w1", "p.w2").alias("h")))
    small = F.broadcast(tmpl.withColumn("h", F.xxhash64("w1", "w2")))        # a few hundred fixed rows
    hit = (pairs.h == small.h) & (pairs.w1 == small.w1) & (pairs.w2 == small.w2)
    # equal texts give equal votes: one of each
    return (pairs.join(small, hit).select("tid", "size", "template", "label", "exact", "pairs", "tpos", "pos").distinct())


def _chain(matches, pairs):
    """(n, first): length and first text place of the longest chain of matches
    (pos, tpos), which come in this order. A chain's neighbours are less than
    (DRIFT + 1) * pairs words apart, so only that much is kept: linear in the run."""
    def step(state, m):
        near = F.filter(state["kept"], lambda k: k["pos"] > m["pos"] - (DRIFT + 1) * pairs)
        before = F.filter(near, lambda k: (k["pos"] < m["pos"]) & (k["tpos"] < m["tpos"])
                          & (F.abs((m["pos"] - k["pos"]) - (m["tpos"] - k["tpos"])) <= DRIFT * (m["tpos"] - k["tpos"])))
        # the longest chain so far, the leftmost of equals
        last = F.array_max(F.transform(before, lambda k: F.struct(k["n"].alias("n"), (-k["first"]).alias("left"))))
        n = F.coalesce(last["n"], F.lit(0)) + 1
        first = F.coalesce(-last["left"], m["pos"])
        now = F.array(F.struct(m["pos"].alias("pos"), m["tpos"].alias("tpos"), n.alias("n"), first.alias("first")))
        better = n > state["best"]["n"]
        return F.struct(F.concat(near, now).alias("kept"), F.struct(
            F.when(better, n).otherwise(state["best"]["n"]).alias("n"),
            F.when(better, first).otherwise(state["best"]["first"]).alias("first")).alias("best"))

    start = F.expr("named_struct('kept', cast(array() as array<struct<pos: int, tpos: int, n: int, first: int>>),"
                   " 'best', named_struct('n', 0, 'first', 0))")
    return F.aggregate(matches, start, step, lambda state: state["best"])


def spans(found: DataFrame) -> DataFrame:
    """(tid, size, label, exact, first, share): verified places of templates.
    `first` is the template's first word in the text, `share` the share of
    its pairs that are there."""
    diagonal = F.col("pos") - F.col("tpos")
    lines = (found.withColumn("d", diagonal)
             .groupBy("tid", "size", "template", "label", "exact", "pairs", "d")
             .agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first")))
    whole = lines.where("exact and n = pairs").select("tid", "size", "label", "exact", F.col("d").alias("first"),
                                                     F.lit(1.0).alias("share"))
    # notices: neighbouring diagonals within DRIFT make one run; a window holds a
    # text's diagonals on one template, at most as many as it has words
    key = ["tid", "size", "template"]
    order = Window.partitionBy(*key).orderBy("d")
    apart = F.coalesce(F.col("d") - F.lag("d").over(order) > DRIFT, F.lit(False)).cast("int")
    voted = (lines.where("not exact").withColumn("apart", apart)
                  .withColumn("run", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
                  .withColumn("votes", F.sum("n").over(Window.partitionBy(*key, "run")))
                  .where(F.col("votes") >= SHARE * F.col("pairs")).select(*key, "d", "run"))
    matches = (found.where("not exact").withColumn("d", diagonal).join(voted, [*key, "d"])
                    .groupBy(*key, "label", "exact", "pairs", "run")
                    .agg(F.array_sort(F.collect_list(F.struct("pos", "tpos"))).alias("matches"))
                    .where(F.size(F.array_distinct("matches.tpos")) >= SHARE * F.col("pairs")))
    partial = (matches.withColumn("best", _chain(F.col("matches"), F.col("pairs")))
                      .withColumn("share", F.col("best.n") / F.col("pairs"))
                      .where(F.col("share") >= SHARE)
                      .select("tid", "size", "label", "exact", F.col("best.first").alias("first"), "share"))
    return whole.unionByName(partial)


def scan(docs: DataFrame, tmpl: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    tmpl = templates(docs.sparkSession) if tmpl is None else tmpl
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    join = lambda c: F.array_join(F.array_sort(c), ",")
    found = spans(written(votes(src, tmpl), "votes")).groupBy("tid", "size").agg(
        F.count_if("exact").alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("first"))).cast("long").alias("last_word"),
        join(F.collect_set(F.when(F.col("exact"), F.col("label")))).alias("base_labels"),
        join(F.collect_set("label")).alias("labels"), F.max("share").alias("score"))
    # written: the join below then has an exchange on either side, and Spark can
    # split the key of a text with very many copies
    found = written(found, "found")
    keyed = src.select("doc_id", F.xxhash64("text").alias("tid"), F.octet_length("text").alias("size"),
                       F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    return keyed.join(found, ["tid", "size"], "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def query(spark, sf_dir) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
