"""License scan by an exact set-similarity join (operator 3).

The tokens of a notice are its pairs of neighbouring words, so that the same words in another
order are another text. A block of words holds a notice if it contains at least ``threshold`` of
the notice's distinct tokens. Tokens are ordered by their frequency over the corpus, rarest
first. A block that reaches the threshold shares a token of the notice's prefix, stands there not
further than its own prefix allows, is long enough, and has enough tokens after the place of the
match; only pairs that pass these filters are counted out. Blocks are runs of words, each half
covered by the next, so that every passage of half a block's length lies whole in one. Of notices
that are variants of one text, those with the largest share in a block hold there; a tie gives
all of them.

Beside this, places where a phrase's words stand one after another are found word by word.

Everything is DataFrame expressions. Null text is empty and has no label. Texts of any length are
taken whole. Rows with equal id and text get the same result. An empty table gives no rows. Extra
columns are left out, whatever their names. The notices and what is made of them are a parameter
of bounded size.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratemill.llm.textkeys import id_back, id_text, text_key
from ratemill.session import new_scratch, written

# What stands between words, the phrases with their labels.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Sentences of common license notices.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike International License"),
)
THRESHOLD = 0.8


def _plain_words(text: str) -> list[str]:
    return [w for w in re.split(BETWEEN, text.lower()) if w]


def template_pairs(notice: str) -> list[str]:
    """The distinct pairs of neighbouring words of a notice."""
    w = _plain_words(notice)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(w, w[1:])))


def families(notices: tuple[tuple[str, str], ...]) -> list[int]:
    """For each notice the number of the first one it is a variant of: of which it has half the
    pairs, or which has half of its own."""
    out: list[int] = []
    for n, (_, text) in enumerate(notices):
        own = set(template_pairs(text))
        same = (k for k in range(n) if 2 * len(own & (other := set(template_pairs(notices[k][1])))) >= min(len(own), len(other)))
        first = next(same, None)
        out.append(n if first is None else out[first])
    return out


def block_words(notices: tuple[tuple[str, str], ...]) -> int:
    """Half a block: twice the words of the longest notice."""
    return 2 * max(len(_plain_words(text)) for _, text in notices)


def words(text: Column) -> Column:
    """Words with A-Z in lower case.

    ``lower`` also folds other letters, which changes no border and, but for the Kelvin sign that
    is put out of the way first, makes no ASCII letter of another.
    """
    folded = F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u0137")))
    return F.array_remove(F.split(folded, BETWEEN), "")


def _rare_word(phrase: str) -> str:
    """A word that only few texts hold, to pass the others by."""
    return max(phrase.split(" "), key=len)


def _phrase_places(w: Column, phrase: str) -> Column:
    parts = phrase.split(" ")
    at = F.sequence(F.lit(0), F.size(w) - len(parts))

    def here(i: Column) -> Column:
        match = w[i] == parts[0]
        for k, part in enumerate(parts[1:], 1):
            match = match & (w[i + k] == part)
        return match

    found = F.filter(at, here)
    return F.when(F.array_contains(w, _rare_word(phrase)) & (F.size(w) >= len(parts)), found).otherwise(F.array().cast("array<int>"))


def _word_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(id_text(docs[id_col]).alias("_id"), text_key(docs[text_col]).alias("_key"), words(text).alias("_w"))
    return rows


def _pairs(w: Column, vocabulary: list[str]) -> Column:
    """The pairs of ``vocabulary`` in the words ``w``, as structs of place and pair."""
    first, second = (sorted({v.split(" ")[k] for v in vocabulary}) for k in (0, 1))
    at = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(w) - 2, F.lit(0))),
        lambda i: F.get(w, i).isin(first) & F.coalesce(F.get(w, i + 1).isin(second), F.lit(False)),
    )
    both = F.transform(at, lambda i: F.struct(i.alias("i"), F.concat(F.get(w, i), F.lit(" "), F.get(w, i + 1)).alias("p")))
    return F.filter(both, lambda x: x["p"].isin(vocabulary))


def pair_order(rows: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Place of each notice pair by the number of documents that hold it, rarest first."""
    held = rows.select(F.explode(F.array_distinct(F.transform("_pairs", lambda x: x["p"]))).alias("w"))
    docs = {r.w: r.n for r in held.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (docs.get(w, 0), w)))}


def scan(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """n_words, places and labels of every row, and the score: the largest share of a notice
    found in a block if it reaches the threshold, 1 where a phrase stands."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    vocabulary = sorted({w for _, text in notices for w in template_pairs(text)})
    rows = _word_table(docs, id_col, text_col).withColumn("_pairs", _pairs(F.col("_w"), vocabulary))
    order = pair_order(rows, vocabulary)

    templates = []
    for number, ((label, text), family) in enumerate(zip(notices, families(notices))):
        ranks = sorted(order[w] for w in template_pairs(text))
        templates.append((number, label, family, ranks, math.ceil(threshold * len(ranks) - 1e-9)))
    prefixes = sorted({r for *_, ranks, need in templates for r in ranks[: len(ranks) - need + 1]})
    by_rank = {r: w for w, r in order.items()}
    least = min(need for *_, need in templates)

    places = F.array_sort(F.flatten(F.array(*(_phrase_places(F.col("_w"), p) for p in PHRASES))))
    labels = [F.when(F.size(_phrase_places(F.col("_w"), p)) > 0, F.lit(label)) for p, label in PHRASES.items()]
    any_phrase = F.arrays_overlap("_w", F.array(*map(F.lit, sorted({_rare_word(p) for p in PHRASES}))))
    none = F.array().cast("array<int>")
    half = block_words(notices)
    rank_of = F.create_map(*(F.lit(x) for w in vocabulary for x in (w, order[w])))

    def block(i: Column) -> Column:
        inside = F.filter("_pairs", lambda x: (x["i"] >= i) & (x["i"] < i + 2 * half - 1))
        return F.array_sort(F.array_distinct(F.transform(inside, lambda x: F.element_at(rank_of, x["p"]))))

    starts = F.sequence(F.lit(0), F.greatest(F.size("_w") - 1, F.lit(0)), F.lit(half))
    blocks = F.filter(F.transform(starts, block), lambda b: F.size(b) >= least)
    # Too few pairs, or none of any prefix: no block of this document can reach the threshold.
    in_prefix = F.exists("_pairs", lambda x: x["p"].isin([by_rank[r] for r in prefixes]))
    candidate = (F.size("_pairs") >= least) & in_prefix
    found = rows.select(
        "_id",
        "_key",
        F.size("_w").cast("long").alias("n_words"),
        F.when(any_phrase, places).otherwise(none).alias("places"),
        F.when(any_phrase, F.array_compact(F.array(*labels))).otherwise(F.array().cast("array<string>")).alias("base"),
        F.when(candidate, blocks).otherwise(F.array().cast("array<array<int>>")).alias("blocks"),
    )
    found = written(found, new_scratch(spark, "licenses"))

    index = spark.createDataFrame(
        [(*t, i, r) for t in templates for *_, ranks, need in [t] for i, r in enumerate(ranks[: len(ranks) - need + 1])],
        "template int, label string, family int, ranks array<int>, need int, i int, rank int",
    )
    held = found.select("_id", "_key", F.posexplode("blocks").alias("block", "own"))
    tokens = held.select("*", F.posexplode("own").alias("j", "rank"))
    pairs = tokens.join(F.broadcast(index), "rank").where(
        (F.size("own") >= F.col("need"))
        & (F.col("j") <= F.size("own") - F.col("need"))
        & (F.least(F.size("ranks") - F.col("i"), F.size("own") - F.col("j")) >= F.col("need"))
    )
    share = F.size(F.array_intersect("own", "ranks"))
    hits = pairs.withColumn("common", share).where("common >= need").withColumn("share", F.col("common") / F.size("ranks"))
    # Of the variants of one text the nearest hold. A block has few notices.
    by_block = hits.groupBy("_id", "_key", "block", "family").agg(
        F.max("share").alias("share"), F.collect_set(F.struct("share", "label")).alias("found")
    )
    nearest = F.transform(F.filter("found", lambda x: x["share"] == F.col("share")), lambda x: x["label"])
    by_doc = by_block.withColumn("labels", nearest).groupBy("_id", "_key").agg(
        F.array_distinct(F.flatten(F.collect_set("labels"))).alias("by_method"), F.max("share").alias("share")
    )

    out = found.drop("blocks").join(by_doc, ["_id", "_key"], "left")
    both = F.array_union("base", F.coalesce("by_method", F.array().cast("array<string>")))
    score = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return out.select(
        id_back(F.col("_id"), id_type).alias(id_col),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        score.alias("score"),
    )


def oracle() -> str:
    """Every block against every notice, without filters."""
    half = block_words(NOTICES)

    def quoted(items: list[str]) -> str:
        return "[" + ", ".join(f"'{x}'" for x in items) + "]"

    numbered = zip(NOTICES, families(NOTICES))
    notices = ", ".join(f"('{label}', {family}, {quoted(template_pairs(text))})" for (label, text), family in numbered)
    phrases = ", ".join(f"({quoted(p.split(' '))}, '{label}')" for p, label in PHRASES.items())
    return f"""
WITH n(label, family, ws) AS (VALUES {notices}), p(ws, label) AS (VALUES {phrases}),
d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '{BETWEEN}'), lambda x: x <> '') AS w FROM documents),
places AS (
  SELECT doc_id, i - 1 AS pos, label
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d), p
  WHERE w[i] = ws[1] AND w[i:i + len(ws) - 1] = ws),
base AS (
  SELECT doc_id, count(*) AS n, min(pos) AS a, max(pos) AS b, list_sort(list_distinct(list(label))) AS labels
  FROM places GROUP BY doc_id),
pairs AS (
  SELECT doc_id, w, list_transform(range(1, greatest(len(w), 1)), lambda k: w[k] || ' ' || w[k + 1]) AS ps FROM d),
blocks AS (
  SELECT doc_id, i, list_distinct(ps[i + 1:i + {2 * half - 1}]) AS b
  FROM (SELECT doc_id, ps, unnest(range(0, greatest(len(w), 1), {half})) AS i FROM pairs)),
found AS (
  SELECT doc_id, i, label, family, len(list_intersect(b, ws)) / len(ws)::DOUBLE AS share
  FROM blocks, n WHERE len(list_intersect(b, ws)) >= ceil({THRESHOLD} * len(ws) - 1e-9)),
hits AS (SELECT * FROM found QUALIFY share = max(share) OVER (PARTITION BY doc_id, i, family)),
method AS (SELECT doc_id, list_distinct(list(label)) AS labels, max(share) AS share FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, b::BIGINT AS last_word,
  coalesce(array_to_string(base.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(method.labels, [])))), ','), '') AS labels,
  CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN method USING (doc_id)
"""
