"""License notices in texts: fixed phrases, and an exact set-similarity join with notice templates.

A word is a run of ASCII digits, letters (A-Z lowered) and characters beyond ASCII. The base scan finds
the places where the words of a phrase stand one after another.

The join compares the word sets of text blocks with those of templates. A template of up to 2^k words
belongs to width 2^k; its blocks are 2^(k+1) words long and start every 2^k words, so that every run of
2^k words lies inside one block. A block matches when it holds at least ``PERCENT`` % of the template's
distinct words. Blocks that hold fewer template words than any template of their width asks for are left
out where the text is read. The others are joined: words are ordered by how many blocks hold them, rarest
first; if a block shares ``need`` words with a template, the first shared one is among the first
``size - need + 1`` of either side (prefix filter); a block of fewer than ``need`` words is out (length
filter); so is a pair whose words after the first shared one cannot make up ``need`` (position filter).
What is left is compared in full, so the join finds every matching block and no other.

Defined results: a NULL text is empty; a text without a match has empty labels, NULL places and score 0;
repeated rows and rows with NULL or equal ids are judged one by one; other columns of the input are not
read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.llm import terms, texts
from barlab.llm.shared import need, prepare
from barlab.session import materialize

PERCENT = 90

# Phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices that the licenses themselves ask to be placed in works, and the short lines in use.
TEMPLATES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("mit", "Released under the MIT License"),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
    ),
    ("gpl", "This work is licensed under the GNU General Public License"),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software",
    ),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
]

_BLOCKS = "array<struct<width: int, start: long, words: array<int>>>"
_SCANNED = (
    f"doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, blocks {_BLOCKS}"
)


def needed(size: int, percent: int) -> int:
    """The fewest shared words that are ``percent`` % of a template's distinct words."""
    return max(1, -(-size * percent // 100))


def compile_templates(templates: list[tuple[str, str]], percent: int) -> list[tuple[str, int, np.ndarray, int]]:
    """(label, width, distinct word hashes, need) of every template that has words."""
    found = []
    for label, text in templates:
        words = terms.of_text(text)
        if len(words):
            width = 1 << int(len(words) - 1).bit_length()
            own = np.unique(words)
            found.append((label, width, own, needed(len(own), percent)))
    return found


class _Scan:
    """Per document: places of the base phrases, and the blocks worth joining."""

    def __init__(self, phrases, compiled, vocabulary):
        self.vocabulary = vocabulary
        self.phrases = [(terms.lookup(vocabulary, terms.of_text(p)), label) for p, label in phrases.items()]
        self.widths = []
        for width in sorted({t[1] for t in compiled}):
            own = [t for t in compiled if t[1] == width]
            inside = np.zeros(len(vocabulary) + 1, bool)  # the last place is that of all other words
            inside[terms.lookup(vocabulary, np.concatenate([t[2] for t in own]))] = True
            self.widths.append((width, inside, min(t[3] for t in own)))

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            for first, data, offsets in texts.slices(text):
                hashes, firsts = terms.hashed(data, offsets)
                words = terms.lookup(self.vocabulary, hashes)
                made = len(offsets) - 1
                columns = [ids.slice(first, made), pa.array(np.diff(firsts))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *self.base(words, firsts), self.blocks(words, firsts)],
                    names=[c.split()[0] for c in _SCANNED.split(", ")[:6]] + ["blocks"],
                )

    def base(self, words: np.ndarray, firsts: np.ndarray) -> list[pa.Array]:
        made = len(firsts) - 1
        owner = np.repeat(np.arange(made), np.diff(firsts))
        count = np.zeros(made, np.int64)
        low, high = np.full(made, len(words)), np.full(made, -1)
        labels: list[list[str]] = [[] for _ in range(made)]
        for phrase, label in self.phrases:
            last = len(words) - len(phrase) + 1
            if last <= 0:
                continue
            here = np.ones(last, bool)
            for k, word in enumerate(phrase):
                here &= words[k : k + last] == word
            at = np.flatnonzero(here)
            at = at[owner[at] == owner[at + len(phrase) - 1]]
            np.add.at(count, owner[at], 1)
            np.minimum.at(low, owner[at], at)
            np.maximum.at(high, owner[at], at)
            for d in np.unique(owner[at]):
                labels[d].append(label)
        none = count == 0
        places = [pa.array(x - firsts[:-1], mask=none) for x in (low, high)]
        return [pa.array(count), *places, pa.array([sorted(set(x)) for x in labels], pa.list_(pa.string()))]

    def blocks(self, words: np.ndarray, firsts: np.ndarray) -> pa.Array:
        made, n = len(firsts) - 1, len(self.vocabulary)
        owner = np.repeat(np.arange(made), np.diff(firsts))
        widths, docs, starts, sizes, held = [], [], [], [], []
        for width, inside, least in self.widths:
            at = np.flatnonzero(inside[words])
            doc, block = owner[at], (at - firsts[owner[at]]) // width
            doc, block, word = (np.concatenate(x) for x in ((doc, doc), (block, block - 1), (words[at], words[at])))
            real = block >= 0
            many = int(block.max(initial=0)) + 1
            key = np.unique((doc[real] * many + block[real]) * n + word[real])
            place, size = np.unique(key // n, return_counts=True)
            wide = size >= least
            held.append((key % n)[np.repeat(wide, size)])
            docs.append(place[wide] // many)
            starts.append(place[wide] % many * width)
            sizes.append(size[wide])
            widths.append(np.full(int(wide.sum()), width))
        doc, start, size, width = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (docs, starts, sizes, widths))
        words_of = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32()),
            pa.array(np.concatenate([np.zeros(0, np.int64), *held]), pa.int32()),
        )
        order = np.argsort(doc, kind="stable")
        flat = pa.StructArray.from_arrays(
            [pa.array(width, pa.int32()), pa.array(start, pa.int64()), words_of], names=["width", "start", "words"]
        ).take(pa.array(order))
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[order], np.arange(made + 1)), pa.int32()), flat)


def matches(blocks: DataFrame, compiled: list[tuple[str, int, np.ndarray, int]], vocabulary: np.ndarray) -> DataFrame:
    """(row, width, start, label, shared, size) of every stored block and every template that it matches.

    ``blocks`` has row, width, start and words: distinct places in the vocabulary. The templates are a
    parameter of the operator; their prefixes, a few hundred rows, are broadcast.
    """
    spark = blocks.sparkSession
    counts = blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    held = {r.word: r.n for r in counts.collect()}
    rank = {w: i for i, w in enumerate(sorted(range(len(vocabulary)), key=lambda w: (held.get(w, 0), w)))}
    rows, least = [], {}
    for label, width, own, need_ in compiled:
        ranks = sorted(rank[int(w)] for w in terms.lookup(vocabulary, own))
        least[width] = min(least.get(width, need_), need_)
        rows += [(width, r, i, label, ranks, len(ranks), need_) for i, r in enumerate(ranks[: len(ranks) - need_ + 1])]
    prefixes = spark.createDataFrame(
        rows, "t_width int, t_rank int, t_place int, label string, t_ranks array<int>, size int, need int"
    )
    ranked = F.array_sort(F.transform("words", lambda w: F.element_at(F.lit([rank[w] for w in range(len(vocabulary))]), w + 1)))
    fewest = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair])
    sides = blocks.select("row", "width", "start", ranked.alias("ranks"), F.size("words").alias("n"))
    prefix = F.slice("ranks", F.lit(1), F.greatest(F.col("n") - F.element_at(fewest, F.col("width")) + 1, F.lit(0)))
    probes = sides.select("*", F.posexplode(prefix).alias("place", "first"))
    close = (
        (F.col("n") >= F.col("need"))
        & (F.col("place") <= F.col("n") - F.col("need"))
        & (F.least(F.col("size") - F.col("t_place"), F.col("n") - F.col("place")) >= F.col("need"))
    )
    same = (F.col("width") == F.col("t_width")) & (F.col("first") == F.col("t_rank"))
    shared = F.array_intersect("ranks", "t_ranks")
    pairs = probes.join(F.broadcast(prefixes), same & close).withColumn("both", shared)
    # A pair may share several prefix words; the first shared one stands for it.
    pairs = pairs.filter((F.size("both") >= F.col("need")) & (F.col("both")[0] == F.col("first")))
    return pairs.select("row", "width", "start", "label", F.size("both").alias("shared"), "size")


def scan(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """(documents, matches): per row of ``docs`` its base results, and all matching blocks by row.

    Documents carry row (any number, unique), doc_id, n_words, n_base, first_word, last_word and
    base_labels; matches carry row, label, width and start (the block's first word and half its length),
    shared and size (words of the template that the block holds, and that it has).
    """
    need(docs, "doc_id", "text")
    prepare(docs.sparkSession)
    compiled = compile_templates(templates, percent)
    parts = [t[2] for t in compiled] + [terms.of_text(p) for p in PHRASES]
    vocabulary = np.unique(np.concatenate(parts))
    read = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_Scan(PHRASES, compiled, vocabulary), _SCANNED)
    stored = materialize(read.withColumn("row", F.monotonically_increasing_id()), "license-blocks")
    blocks = stored.select("row", F.explode("blocks").alias("b")).select("row", "b.*")
    return stored.drop("blocks"), matches(blocks, compiled, vocabulary)


def digest(found: tuple[DataFrame, DataFrame]) -> DataFrame:
    """One row per document: base results, all labels, and a score.

    The score is 1 where a base phrase stands, else the largest share of a matching template, else 0.
    """
    documents, matched = found
    by_row = matched.groupBy("row").agg(
        F.collect_set("label").alias("own"), F.max(F.col("shared") / F.col("size")).alias("share")
    )
    empty = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("own", empty)))
    return documents.join(by_row, "row", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
