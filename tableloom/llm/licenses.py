"""License scan: phrases, and an exact set-similarity join with license templates.

A text block matches a template if it holds enough of the template's distinct
words. Blocks are the lines, and across line breaks every run of as many
consecutive words as the template has, so that wrapped templates are found. One
pass over the texts finds phrases and the template words that each text holds;
only texts with enough words of some template are kept for the blocks.

Template words are put in the order of their document frequency over all texts,
rarest first. A block that holds ``k`` of the ``n`` words of a template holds one
of its ``n - k + 1`` rarest, so only blocks with such a word meet the template.

Lines: pairs too short or too late in the order to reach ``k`` are left out before
the words are compared.

Runs: the places of those rarest words are looked up, and for each the places of
the template's other words less than a run away. Where these are ``k`` at least,
the runs around the place are counted; each can be moved to begin with a word of
the template. Everything here is DataFrame functions.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.llm.tables import partitions, texts
from tableloom.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTER = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
WORD = f"{LETTER}+"
CONTAINMENT = 0.8

#: Phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Sentences by which licenses are declared, and the labels they give.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-header": "You may not use this file except in compliance with the License",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, "
    "are permitted provided that the following conditions are met",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": "Licensed under a Creative Commons Attribution ShareAlike 4.0 International License",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy "
    "of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License",
}


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"))


def all_template_words(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def template_words(text: str) -> list[str]:
    return list(dict.fromkeys(all_template_words(text)))


def needed(n_words: int, containment: float) -> int:
    """Words of a template that a block must hold; exact for decimal thresholds."""
    return max(1, math.ceil(round(containment * n_words, 9)))


def phrase_pieces(low: Column, phrase: str) -> Column:
    """The text cut at the first word of every place of the phrase; uncut, one piece.

    The other words are only looked at, so that places may overlap. A cut takes one
    whole word, so the words of the pieces are those of the text without it.
    """
    first, *others = [re.escape(part) for part in phrase.split(" ")]
    ahead = "".join(f"{BETWEEN}+{part}" for part in others)
    place = f"(?<!{LETTER}){first}(?={ahead}(?!{LETTER}))"
    possible = F.lit(True)
    for part in phrase.split(" "):
        possible = possible & F.contains(low, F.lit(part))
    return F.when(possible, F.split(low, place)).otherwise(F.array(low))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def base_columns(rows: DataFrame, phrases: Mapping[str, str]) -> DataFrame:
    """Places of the phrases and their labels, of ``low`` with its ``n_words``."""
    pieces = {f"_pieces{i}": phrase for i, phrase in enumerate(phrases)}
    found = rows.withColumns(
        {name: phrase_pieces(F.col("low"), phrase) for name, phrase in pieces.items()}
    )
    places = [F.size(name) - 1 for name in pieces]
    met = [F.size(name) > 1 for name in pieces]
    firsts = [
        F.when(here, n_words(F.get(name, F.lit(0))))
        for here, name in zip(met, pieces, strict=True)
    ]
    lasts = [
        F.when(here, F.col("n_words") - 1 - n_words(F.element_at(name, -1)))
        for here, name in zip(met, pieces, strict=True)
    ]
    labels = [
        F.when(here, F.lit(phrases[phrase]))
        for here, phrase in zip(met, pieces.values(), strict=True)
    ]
    return found.select(
        "doc_id",
        "row",
        "n_words",
        "held",
        "kept",
        sum(places, F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.array(*firsts)).alias("first_word"),
        F.array_max(F.array(*lasts)).alias("last_word"),
        F.array_distinct(F.array_compact(F.array(*labels))).alias("base"),
    )


def listed(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(word) for word in words]).cast("array<string>")


def scanned(rows: DataFrame, sets: Mapping[str, list[str]], containment: float) -> DataFrame:
    """``low`` with ``row``, ``n_words``, the template words ``held`` and ``kept``.

    A block with enough words of a template stands in a text with as many, so
    other texts are not ``kept``.
    """
    vocabulary = sorted({word for held in sets.values() for word in held})
    cut = rows.withColumn("words", words(F.col("low")))
    known = cut.select(
        "doc_id",
        "low",
        F.monotonically_increasing_id().alias("row"),
        F.size("words").cast("long").alias("n_words"),
        F.array_intersect(F.col("words"), listed(vocabulary)).alias("held"),
    )
    enough = F.lit(False)
    for held in sets.values():
        shared = F.size(F.array_intersect("held", listed(held)))
        enough = enough | (shared >= needed(len(held), containment))
    return known.withColumn("kept", F.when(enough, F.col("low")))


def word_frequencies(texts_read: DataFrame) -> dict[str, int]:
    """Texts holding each word of the templates; one row per such word is collected."""
    held = texts_read.select(F.explode("held").alias("word"))
    return {r["word"]: r["count"] for r in held.groupBy("word").count().collect()}


def ranks_of(texts_read: DataFrame, sets: Mapping[str, list[str]]) -> dict[str, int]:
    """Places of all template words in the order of frequency, rarest first."""
    often = word_frequencies(texts_read)
    vocabulary = {word for held in sets.values() for word in held}
    order = sorted(vocabulary, key=lambda word: (often.get(word, 0), word))
    return {word: place for place, word in enumerate(order)}


def line_blocks(kept: DataFrame, rank: Mapping[str, int]) -> DataFrame:
    """``row`` and the template words, rarest first, of every line."""
    lines = kept.select("row", F.explode(F.split("kept", "\n")).alias("line"))
    order = listed(sorted(rank, key=rank.get))
    return lines.select("row", F.array_intersect(order, words(F.col("line"))).alias("held"))


def line_matches(
    blocks: DataFrame, sets: Mapping[str, list[str]], rank: Mapping[str, int], containment: float
) -> DataFrame:
    """``row``, ``label`` and ``share`` of every line and template that match."""
    index = []
    for label, held in sets.items():
        ordered = sorted(held, key=rank.get)
        least = needed(len(ordered), containment)
        for place, word in enumerate(ordered[: len(ordered) - least + 1]):
            index.append((word, place, label, ordered, least))
    # as many rows as the templates have words
    indexed = blocks.sparkSession.createDataFrame(
        index, "word string, place int, label string, template array<string>, least int"
    )
    met = blocks.select("row", "held", F.posexplode("held").alias("at", "word"))
    reach = 1 + F.least(F.size("template") - F.col("place"), F.size("held") - F.col("at")) - 1
    shared = F.size(F.array_intersect("held", "template"))
    return (
        met.join(F.broadcast(indexed), "word")
        .where((F.size("held") >= F.col("least")) & (reach >= F.col("least")))
        .where(shared >= F.col("least"))
        .select("row", "label", (shared / F.size("template")).alias("share"))
    )


def template_hits(
    kept: DataFrame,
    sets: Mapping[str, list[str]],
    rank: Mapping[str, int],
    lengths: Mapping[str, int],
    containment: float,
) -> DataFrame:
    """Texts with each template that they hold enough words of, and the places of these words.

    ``lengths`` are the words of a run. Words are found by a join, so a text is split
    once and its words are not compared with every word of every template.
    """
    spark = kept.sparkSession
    # as many rows as the templates have words
    vocabulary = F.broadcast(spark.createDataFrame(list(rank.items()), "word string, rank int"))
    known = []
    for label, held in sets.items():
        ranks = sorted(rank[word] for word in held)
        least = needed(len(ranks), containment)
        known.append(
            F.struct(
                F.lit(label).alias("label"),
                F.array(*map(F.lit, ranks)).alias("ranks"),
                F.lit(ranks[len(ranks) - least]).alias("last_rare"),
                F.lit(least).alias("least"),
                F.lit(lengths[label]).alias("length"),
            )
        )
    hits = (
        kept.select("row", F.posexplode(words(F.col("kept"))).alias("at", "word"))
        .join(vocabulary, "word")
        .groupBy("row")
        .agg(
            F.array_sort(F.collect_list(F.struct("at", "rank"))).alias("hits"),
            F.collect_set("rank").alias("held"),
        )
    )
    possible = F.filter(
        F.array(*known),
        lambda one: F.size(F.array_intersect(F.col("held"), one["ranks"])) >= one["least"],
    )
    return hits.select("row", "hits", F.explode(possible).alias("one")).select(
        "row",
        "one",
        F.filter("hits", lambda hit: F.array_contains("one.ranks", hit["rank"])).alias("hits"),
    )


def run_matches(hits: DataFrame) -> DataFrame:
    """``row``, ``label`` and ``share`` of every text and template that match in a run."""
    length, least = F.col("one.length"), F.col("one.least")
    placed = F.transform("hits", lambda hit, i: F.struct(i.alias("i"), hit.alias("hit")))
    rare = F.filter(placed, lambda place: place["hit"]["rank"] <= F.col("one.last_rare"))
    # words less than a run away are less than a run's words away among the hits
    around = F.transform(
        rare,
        lambda place: F.struct(
            place["hit"]["at"].alias("at"),
            F.slice("hits", F.greatest(place["i"] - length + 2, F.lit(1)), 2 * length - 1).alias(
                "near"
            ),
        ),
    )
    places = hits.select("row", "one", F.inline(around)).select(
        "row",
        "one",
        "at",
        F.filter(
            "near", lambda hit: F.abs(hit["at"] - F.col("at")) < length
        ).alias("near"),
    )

    def distinct(start: Column) -> Column:
        run = F.filter("near", lambda hit: (hit["at"] >= start["at"]) & (hit["at"] < start["at"] + length))
        return F.size(F.array_distinct(F.transform(run, lambda hit: hit["rank"])))

    starts = F.filter("near", lambda hit: hit["at"] <= F.col("at"))
    best = (
        places.where(F.size("near") >= least)
        .select("row", "one", F.array_max(F.transform(starts, distinct)).alias("n"))
        .groupBy("row", "one.label")
        .agg(F.max(F.struct("n", least.alias("least"), F.size("one.ranks").alias("of"))).alias("best"))
    )
    return best.where("best.n >= best.least").select(
        "row", "label", (F.col("best.n") / F.col("best.of")).alias("share")
    )


def scan_licenses(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Phrases and templates found in every whole text.

    ``score`` is 1 with a phrase, else the largest share of a template found in
    one block, or 0. Null and empty texts have no words: counts are 0, places
    null, labels empty. A row for every row of ``docs``, repeated ones included;
    only ``doc_id`` and ``text`` are read. Texts are read once and not shuffled.
    """
    sets = {label: template_words(text) for label, text in templates.items()}
    rows = texts(docs, "doc_id", "text").select("doc_id", lowered(F.col("text")).alias("low"))
    base = cut_lineage(base_columns(scanned(rows, sets, containment), phrases))
    lengths = {label: len(all_template_words(text)) for label, text in templates.items()}
    # the few kept texts are dealt evenly, whatever files they came from
    kept = (
        base.where("kept IS NOT NULL")
        .select("row", "kept")
        .repartition(partitions(docs.sparkSession), "row")
    )
    matches = docs.sparkSession.createDataFrame([], "row long, label string, share double")
    if sets:
        rank = ranks_of(base, sets)
        # written out: a filter that reads the split words must not split them again
        blocks = cut_lineage(line_blocks(kept, rank))
        hits = cut_lineage(template_hits(kept, sets, rank, lengths, containment))
        matches = line_matches(blocks, sets, rank, containment).union(run_matches(hits))
    matches = matches.groupBy("row").agg(
        F.collect_set("label").alias("found"), F.max("share").alias("share")
    )
    joined = base.drop("held", "kept").join(cut_lineage(matches), "row", "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    every = F.array_sort(F.array_union("base", found))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0))
        .otherwise(F.coalesce("share", F.lit(0.0)))
        .alias("score"),
    )
