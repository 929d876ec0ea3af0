"""License scans by diagonal voting.

Every window of three words of a document is joined to the places of the
templates that hold it. Votes with one offset between document and template
lie on a diagonal; neighbouring diagonals, which words put in or left out
produce, are merged, and a run of votes counts if it covers enough of its
template in a span of about the template's length.

Templates of one family share nearly all windows. The words that tell two of
them apart vote at the places where they stand, and a run counts only if it
has its own template's such words and none that only a rival has.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from difflib import SequenceMatcher

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrears.llm.frames import text_key, text_or_empty

# Phrases that name a license, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# The opening words of common license notices, by label. At most 60 words each.
TEMPLATES = {
    "agpl": "is free software you can redistribute it and or modify it under the terms of the gnu affero general"
    " public license as published by the free software foundation",
    "apache": "licensed under the apache license version 2 0 the license you may not use this file except in"
    " compliance with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided"
    " that the following conditions are met redistributions of source code must retain the above copyright notice"
    " this list of conditions and the following disclaimer",
    "cc-by-nc": "licensed under cc by nc",
    "cc-by-sa": "licensed under cc by sa",
    "cc0": "to the extent possible under law the author has dedicated all copyright and related and neighboring"
    " rights to this software to the public domain worldwide",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu"
    " general public license as published by the free software foundation",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is"
    " hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "lgpl": "is free software you can redistribute it and or modify it under the terms of the gnu lesser general"
    " public license as published by the free software foundation",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and"
    " associated documentation files the software to deal in the software without restriction",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl"
    " was not distributed with this file you can obtain one at",
    "unlicense": "this is free and unencumbered software released into the public domain anyone is free to copy"
    " modify publish use compile sell or distribute this software",
}

GRAM = 3
# ASCII characters that no word has, in text whose letters are lower case.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    """Runs of ASCII letters, digits and other than ASCII characters, in lower case.

    Lower-casing all letters instead of A-Z cuts words at the same places and
    changes no word that a phrase has.
    """
    return F.array_remove(F.split(F.lower(text), _GAP), "")


def base_places(words: Column, text: Column, phrases: Mapping[str, str] = PHRASES) -> Column:
    """Array of (at, label): the places where a phrase's words stand consecutively."""

    def label_at(word: Column, i: Column) -> Column:
        found = F.lit(None).cast("string")
        for phrase, label in phrases.items():
            first, *rest = phrase.split()
            here = word == first
            for step, other in enumerate(rest, 1):
                here = here & (F.get(words, i + step) == other)
            found = F.when(here, label).otherwise(found)
        return found

    places = F.transform(words, lambda w, i: F.struct(i.cast("bigint").alias("at"), label_at(w, i).alias("label")))
    # Most texts have no phrase's last word at all; theirs need no look at every word.
    last = "|".join(sorted({re.escape(p.split()[-1]) for p in phrases if len(p.split()[-1]) > 3}))
    short = [p.split() for p in phrases if len(p.split()[-1]) <= 3]
    lower = F.lower(text)
    maybe = lower.rlike(last) if last else F.lit(False)
    for words_of in short:
        both = F.lit(True)
        for word in words_of:
            both = both & F.contains(lower, F.lit(word))
        maybe = maybe | both
    none = F.array().cast("array<struct<at:bigint,label:string>>")
    return F.when(maybe, F.filter(places, lambda p: p["label"].isNotNull())).otherwise(none)


def telling_words(templates: Mapping[str, str], cover: float) -> list[tuple[str, int, str, int, int]]:
    """``label``, ``place``, ``word``, ``own``, ``rival``: the words that tell a template from its rivals.

    A rival is another template whose text covers enough of this one to pass
    for it. ``own`` is the bit of a place that must hold one of its words,
    ``rival`` is 1 for a word that must not stand at its place. Words that one
    of the two merely has before or after the other tell nothing.
    """
    words = {label: text.split() for label, text in templates.items()}
    grams = {label: {tuple(w[i : i + GRAM]) for i in range(len(w) - GRAM + 1)} for label, w in words.items()}
    rows = []
    for label, mine in words.items():
        needed, forbidden = set(), set()
        for other, theirs in words.items():
            share = len(grams[label] & grams[other]) / len(grams[label])
            if other == label or share < _needed(len(mine) - GRAM + 1, cover):
                continue
            for _, a, b, c, d in SequenceMatcher(None, mine, theirs, autojunk=False).get_opcodes():
                if min(a, c) > 0 and b < len(mine) and d < len(theirs):
                    own = tuple((i, mine[i]) for i in range(a, b) if mine[i] not in theirs)
                    needed |= {own} if own else set()
                    forbidden |= set() if own else {(a, w) for w in theirs[c:d] if w not in mine}
        rows += [(label, i, w, 1 << bit, 0) for bit, own in enumerate(sorted(needed)) for i, w in own]
        rows += [(label, i, w, 0, 1) for i, w in sorted(forbidden)]
    return rows


def _needed(n_grams: int, cover: float) -> float:
    """The share of a template that must be there; of one of a few words all."""
    return 1.0 if n_grams < 8 else cover


def template_places(spark: SparkSession, templates: Mapping[str, str] = TEMPLATES, cover: float = 0.6) -> DataFrame:
    """``gram`` (the hash of a window of words, or of a telling word), ``label``, ``place``, ``n_grams``,
    ``own``, ``rival`` (both 0 for a window) and ``all_own`` of every template."""
    rows, marks = [], telling_words(templates, cover)
    for label, text in templates.items():
        words = text.split()
        if not GRAM <= len(words) <= 60:
            raise ValueError(f"template {label!r} has {len(words)} words")
        n = len(words) - GRAM + 1
        mine = [m[1:] for m in marks if m[0] == label]
        all_own = 0
        for _, _, own, _ in mine:
            all_own |= own
        rows += [(label, i, n, 0, 0, all_own, *words[i : i + GRAM]) for i in range(n)]
        rows += [(label, i, n, own, rival, all_own, word, None, None) for i, word, own, rival in mine]
    columns = ["label", "place", "n_grams", "own", "rival", "all_own"]
    frame = spark.createDataFrame(
        rows, "label string, place int, n_grams int, own bigint, rival int, all_own bigint, a string, b string, c string"
    )
    gram = F.when(F.col("b").isNull(), _mark_hash(F.col("a"))).otherwise(F.xxhash64("a", "b", "c"))
    return frame.select(gram.alias("gram"), *columns)


def _mark_hash(word: Column) -> Column:
    """Unlike the hash of any window, whose second word is never a number."""
    return F.xxhash64(word, F.lit(1))


def template_spans(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, cover: float = 0.6, drift: int = 3) -> DataFrame:
    """Verified matches: ``doc_id``, ``text_key``, ``label``, ``share``, ``first``, ``last`` (words from 0).

    ``docs`` has ``doc_id``, ``text_key``, ``text``. Only windows that a
    template holds leave the join; the templates are a fixed, small table.
    """
    telling = sorted({word for _, _, word, _, _ in telling_words(templates, cover)})
    maybe = F.lit(False)
    for word in telling:
        maybe = maybe | F.contains(F.lower(text_or_empty()), F.lit(word))
    words = docs.select("doc_id", "text_key", license_words(text_or_empty()).alias("words"), maybe.alias("maybe"))
    grams = F.transform(
        "words", lambda w, i: F.struct(i.alias("at"), F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("gram"))
    )
    if telling:
        marks = F.transform("words", lambda w, i: F.struct(i.alias("at"), F.when(w.isin(telling), _mark_hash(w)).alias("gram")))
        marks = F.filter(marks, lambda m: m["gram"].isNotNull())
        grams = F.when(F.col("maybe"), F.concat(grams, marks)).otherwise(grams)
    places = words.select("doc_id", "text_key", F.inline(grams))
    votes = places.join(F.broadcast(template_places(docs.sparkSession, templates, cover)), "gram")
    keys = ["doc_id", "text_key", "label"]
    window = (F.col("own") == 0) & (F.col("rival") == 0)
    diagonals = (
        votes.withColumn("diagonal", F.col("at") - F.col("place"))
        .groupBy(*keys, "n_grams", "all_own", "diagonal")
        .agg(
            F.bit_or(F.when(window, F.expr("shiftleft(1L, place)")).otherwise(F.lit(0).cast("bigint"))).alias("seen"),
            F.min(F.when(window, F.col("at"))).alias("first"),
            F.max(F.when(window, F.col("at"))).alias("last"),
            F.bit_or("own").alias("own"),
            F.max("rival").alias("rival"),
        )
    )
    order = Window.partitionBy(*keys).orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > drift).cast("int"), F.lit(0))
    runs = (
        diagonals.withColumn("apart", apart)
        .withColumn("run", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "n_grams", "all_own", "run")
        .agg(
            F.bit_or("seen").alias("seen"),
            F.min("first").alias("first"),
            (F.max("last") + GRAM - 1).alias("last"),
            F.bit_or("own").alias("own"),
            F.max("rival").alias("rival"),
        )
        .withColumn("share", F.bit_count("seen") / F.col("n_grams"))
    )
    needed = F.when(F.col("n_grams") < 8, F.lit(1.0)).otherwise(F.lit(cover))
    long_enough = (F.col("share") >= needed) & (F.col("last") - F.col("first") + 1 <= 1.5 * (F.col("n_grams") + GRAM))
    verified = long_enough & (F.col("own") == F.col("all_own")) & (F.col("rival") == 0)
    return runs.filter(verified).select(*keys, "share", "first", "last")


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels``, ``score`` and ``n_spans``.

    Base columns tell of phrases, ``labels`` adds those of verified templates.
    The score is 1 with a phrase, else the best verified share of a template,
    else 0. A null or empty text has no words, zeros, null places and empty
    labels. Rows that repeat id and text get equal results, rows that repeat
    the id only are kept apart, ids may be null, no rows give no rows, other
    columns are not read.
    """
    docs = docs.select("doc_id", text_key().alias("text_key"), "text")
    found = template_spans(docs, templates).groupBy("doc_id", "text_key").agg(
        F.collect_set("label").alias("found"), F.max("share").alias("share"), F.count("*").alias("n_spans")
    )
    found = found.toDF("_id", "_key", "found", "share", "n_spans")
    words = license_words(text_or_empty())
    base = docs.select("doc_id", "text_key", "text", words.alias("words")).select(
        "doc_id",
        "text_key",
        F.size("words").cast("bigint").alias("n_words"),
        base_places(F.col("words"), text_or_empty()).alias("base"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    labels = F.array_distinct(F.col("base.label"))
    n_base = F.size("base").cast("bigint")
    return base.join(found, same, "left").select(
        "doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.array_min("base.at").alias("first_word"),
        F.array_max("base.at").alias("last_word"),
        F.array_join(F.sort_array(labels), ",").alias("base_labels"),
        F.array_join(
            F.sort_array(F.array_union(labels, F.coalesce("found", F.array().cast("array<string>")))), ","
        ).alias("labels"),
        F.when(n_base > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
    )
