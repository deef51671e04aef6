"""License scans, in DataFrame operations only.

Two ways give `labels`:

- Base phrases: the words of a phrase one after another, anywhere in the text.
- Templates: an exact set-similarity join of text blocks (lines) with the notices of common
  licenses. A block matches where it holds at least THRESHOLD of a template's distinct words; of
  several templates those count that it holds the largest share of.

The join orders words by how often they stand in all texts, the rarest first. Of a template
of t words of which c must be held, any c meet the first t - c + 1 (prefix filter), so a
block is looked at only for the templates in whose prefix one of its words is. A block of
fewer words than c is left out (length filter), and so is one where too few words can follow
the first shared one, in the template or in the block (positional filter). What remains is
counted exactly. The templates are a fixed list, so their tables are small whatever the input;
only their words are counted, in one pass.

`notice_labels` come from the same join over wider blocks: every run of as many consecutive
words as a template has, across line breaks, so that a wrapped notice is found. Length and
prefix filter and the count are applied to the whole text first; of what remains the words
are rows, each a span of starts whose runs it is the first of its kind in, and a running sum
over the ends of these spans counts every run. Each template at or above the threshold counts
at its best place (of equal ones the first), unless one of a higher share overlaps it there:
two notices on one line are both found, a notice is not taken for its near namesakes.

Words are [0-9a-z] and all that is not ASCII, after A-Z has been lower-cased.

Defined results: a null text is empty; repeated rows are scanned each; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import lower_ascii, staged

THRESHOLD = 0.8
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Notices of common licenses, and their labels.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]


def _template_words(threshold: float) -> list[tuple[int, str, list[str], int]]:
    """Number, label, distinct words, words that must be held."""
    import re

    out = []
    for number, (label, text) in enumerate(TEMPLATES):
        words = sorted(set(filter(None, re.split(SEPARATORS, text.lower()))))
        out.append((number, label, words, math.ceil(threshold * len(words) - 1e-9)))
    return out


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id and text, in lower case."""
    text = lower_ascii(F.coalesce("text", F.lit("")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def _words(column):
    """The words of a text as an array."""
    return F.filter(F.split(column, SEPARATORS), lambda x: x != "")


def _frequencies(texts: DataFrame, words: list[str]) -> dict[str, int]:
    """How often each of a few words stands in all texts."""
    each = texts.select(F.explode(F.filter(F.split("text", SEPARATORS), lambda x: x.isin(words))).alias("word"))
    return {r.word: r.n for r in each.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def matches(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The scanned rows, staged: _row (a number), doc_id, n_words, text (where a phrase may stand in it), shares (per
    template, the highest share that a line holds), open (templates of which the text holds enough words) and its words
    where there are such."""
    texts = _lines(docs)
    templates = _template_words(threshold)
    vocabulary = sorted({w for _, _, words, _ in templates for w in words})
    counts = _frequencies(texts, vocabulary)
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    ordered = [(n, label, sorted(words, key=rank.get), need) for n, label, words, need in templates]
    rarest = sorted({w for _, _, words, need in ordered for w in words[: len(words) - need + 1]}, key=rank.get)

    # A line as the places of its template words in the global order: prefix filter.
    strings = lambda words: F.array(*(F.lit(w) for w in words))
    by_rank = strings(sorted(vocabulary, key=rank.get))
    lines = F.split("text", "\n")
    candidate = F.filter(lines, lambda line: F.exists(F.split(line, SEPARATORS), lambda x: x.isin(rarest)))
    held = F.transform(candidate, lambda line: F.array_intersect(by_rank, F.split(line, SEPARATORS)))

    def share(words, need):
        """Of a block: the share of the template that it holds; 0 where a filter or the count rules it out."""
        return lambda block: _share(block, words, need)

    def _share(block, words, need):
        own = strings(words)
        prefix = strings(words[: len(words) - need + 1])
        shared = F.array_intersect(prefix, block)
        first = F.get(shared, F.lit(0))
        in_template = F.lit(len(words)) - F.array_position(own, first) + 1
        in_block = F.size(block) - F.array_position(block, first) + 1
        possible = (F.size(block) >= need) & (F.size(shared) > 0) & (F.least(in_template, in_block) >= need)
        both = F.size(F.array_intersect(own, block))
        return F.when(possible & (both >= need), both / F.lit(float(len(words)))).otherwise(F.lit(0.0))

    # Where a line meets several templates, those that it holds most of count.
    taken = lambda i: lambda line: F.get(line, F.lit(i))
    by_line = F.transform("held", lambda b: F.array(*(share(words, need)(b) for _, _, words, need in ordered)))
    most = F.transform(by_line, lambda line: F.transform(line, lambda x: F.when(x == F.array_max(line), x).otherwise(F.lit(0.0))))
    best = [F.array_max(F.transform("most", taken(i))) for i in range(len(ordered))]
    scanned = texts.select(
        F.monotonically_increasing_id().alias("_row"),
        "doc_id",
        _words(F.col("text")).alias("words"),
        held.alias("held"),
        F.when(_may_hold_phrase(F.col("text")), F.col("text")).alias("text"),
    ).withColumn("all_held", F.array_intersect(by_rank, "words"))

    def enough(words, need):
        own, prefix = strings(words), strings(words[: len(words) - need + 1])
        return (F.size("all_held") >= need) & F.arrays_overlap(prefix, F.col("all_held")) & (F.size(F.array_intersect(own, "all_held")) >= need)

    opened = F.array_compact(F.array(*(F.when(enough(words, need), F.lit(n)) for n, _, words, need in ordered)))
    found = scanned.withColumn("most", most).withColumn("open", opened).select(
        "_row", "doc_id", F.size("words").cast("long").alias("n_words"), "text",
        F.when(F.size("held") > 0, F.array(*(F.coalesce(b, F.lit(0.0)) for b in best))).alias("shares"),
        "open", F.when(F.size("open") > 0, F.col("words")).alias("open_words"),
    )
    return staged(found, "licenses")


def notices(found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Of rows of `matches` with notices: _row, notice_labels, notice_score (highest share), first_notice (smallest start, words from 0)."""
    import re

    rows = []
    for number, label, words, need in _template_words(threshold):
        width = len([w for w in re.split(SEPARATORS, TEMPLATES[number][1].lower()) if w])
        values = {"template": number, "label": label, "width": width, "size": len(words), "need": need}
        rows += [F.struct(F.lit(word).alias("word"), *(F.lit(v).alias(k) for k, v in values.items())) for word in words]
    # A row for each word of the fixed list of templates.
    templates = found.sparkSession.range(1).select(F.inline(F.array(*rows)))
    words = found.where(F.size("open") > 0).select("_row", "open", F.posexplode("open_words").alias("pos", "word"))
    hits = words.join(F.broadcast(templates), "word").where(F.array_contains("open", F.col("template"))).drop("open")
    before = F.lag("pos").over(Window.partitionBy("_row", "template", "word").orderBy("pos"))
    low = F.greatest(F.col("pos") - F.col("width") + 1, F.coalesce(before, F.lit(-1)) + 1).cast("long")
    ends = F.array(F.struct(F.col("low").alias("at"), F.lit(1).alias("step")), F.struct((F.col("pos") + 1).cast("long").alias("at"), F.lit(-1).alias("step")))
    keys = ["_row", "template", "label", "width", "size", "need"]
    # The end of a hit's span: what is open just before it is held by the run that starts with the hit.
    upto = Window.partitionBy("_row", "template").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    spans = hits.repartition("_row", "template").withColumn("low", low).select(*keys, F.explode(ends).alias("end")).select(*keys, "end.*")
    runs = spans.withColumn("n", F.sum("step").over(upto)).where("step < 0").groupBy(*keys).agg(F.max(F.struct("n", (1 - F.col("at")).alias("back"))).alias("top"))
    start, share = -F.col("top.back"), F.col("top.n") / F.col("size").cast("double")
    each = runs.where("top.n >= need").select("_row", F.struct(start.alias("low"), (start + F.col("width") - 1).alias("high"), share.alias("share"), "label").alias("x"))

    def beaten(x):
        return F.exists("xs", lambda y: (y.share > x.share) & (y.low <= x.high) & (x.low <= y.high))

    kept = each.groupBy("_row").agg(F.collect_list("x").alias("xs")).withColumn("xs", F.filter("xs", lambda x: ~beaten(x)))
    return kept.select(
        "_row",
        F.array_join(F.array_sort(F.array_distinct("xs.label")), ",").alias("notice_labels"),
        F.array_max("xs.share").alias("notice_score"),
        F.array_min("xs.low").cast("long").alias("first_notice"),
    )


def _may_hold_phrase(text):
    """Whether the longest word of a phrase is in the text."""
    longest = sorted({max(p.split(), key=len) for p in PHRASES})
    return F.greatest(*(F.contains(text, F.lit(w)) for w in longest))


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and of runs of words across lines
    notice_labels (empty where there are none), notice_score (0 then) and first_notice (null then)."""
    matched = matches(docs, threshold)
    found = matched.withColumn("words", F.coalesce(_words(F.col("text")), F.array().cast("array<string>")))

    def places(phrase: str):
        words = phrase.split()
        last = F.size("words") - len(words)
        at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        for i, word in enumerate(words):
            at = F.filter(at, stands(word, i))
        return at

    def stands(word: str, after: int):
        return lambda place: F.get("words", place + after) == word

    for i, phrase in enumerate(PHRASES):
        found = found.withColumn(f"at{i}", places(phrase))
    every = F.concat(*(F.col(f"at{i}") for i in range(len(PHRASES))))
    base = F.array_compact(F.array(*(F.when(F.size(f"at{i}") > 0, F.lit(label)) for i, label in enumerate(PHRASES.values()))))
    more = F.array_compact(F.array(*(F.when(F.get("shares", F.lit(i)) > 0, F.lit(label)) for i, (label, _) in enumerate(TEMPLATES))))
    sorted_ = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    best = F.coalesce(F.array_max("shares"), F.lit(0.0))
    lines = found.select(
        "_row", "doc_id", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        sorted_(base).alias("base_labels"), sorted_(F.concat(base, F.coalesce(more, F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size(every) > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
    wide = lines.join(notices(matched, threshold), "_row", "left").drop("_row")
    return wide.fillna({"notice_labels": "", "notice_score": 0.0})
