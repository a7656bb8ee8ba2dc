"""Licence scan: an exact set-similarity join of text blocks with licence templates.

A template matches a block when at least `CONTAINMENT` of the template's distinct words are in the
block. Blocks are windows of `BLOCK_WORDS` words over the words of the whole text, across line ends,
that overlap by half, so a template of up to half a block lies whole in one of them however it is
wrapped; comment marks are no words. Lines longer than half a block are blocks besides, cut alike
where they are longer than a block; shorter lines lie whole in a window.

Method. Words of the templates are ordered by their global frequency, counted over all documents,
rarest first. With o words needed, a matching block holds one of the first n - o + 1 words of the
template (prefix filter), has at least o distinct words (length filter), and, when the first
prefix word it shares is at place p, needs o <= n - p (positional filter). Only blocks that pass
are compared whole. The templates are a fixed list of public licence sentences, so the prefix
index is small and goes to all tasks; documents are read once for the frequencies and once for the
join, and are never shuffled.

Phrases (`PHRASES`) are found besides: places where the words of a phrase stand consecutively.

Defined cases. Null text counts as empty. Rows with null or repeated ids are scanned row by row. Empty
tables give empty results; with no word counted, ties in frequency are ordered by word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import map_rows

CONTAINMENT = Fraction(4, 5)
BLOCK_WORDS = 64

# Phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Sentences of public licences and licence notices, with labels.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"),
)

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

SCAN = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double"
)


def words_of(text: str | bytes) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text
    return WORD.findall(raw.lower())


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(word number, label) of all places of all phrases."""
    out = []
    for phrase, label in phrases.items():
        parts = [p.encode() for p in phrase.split()]
        at = -1
        while True:
            try:
                at = words.index(parts[0], at + 1)
            except ValueError:
                break
            if words[at : at + len(parts)] == parts:
                out.append((at, label))
    return out


def template_frequencies(docs: DataFrame, text_col: str, templates: tuple) -> dict[bytes, int]:
    """In how many documents each template word occurs; all documents, words of templates only."""
    wanted = {w for _, t in templates for w in words_of(t)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(wanted.intersection(words_of(text)))
        yield pa.RecordBatch.from_pydict({"word": list(seen), "n": pa.array(list(seen.values()), type=pa.int64())}
                                         ) if seen else pa.RecordBatch.from_pydict(
            {"word": pa.array([], type=pa.binary()), "n": pa.array([], type=pa.int64())}
        )

    counts = docs.select(text_col).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counts.collect()}  # at most the words of the templates


def windows(words: list[bytes]) -> Iterator[list[bytes]]:
    """Blocks of `BLOCK_WORDS` words, each starting half a block after the one before."""
    half = BLOCK_WORDS // 2
    for at in range(0, max(1, len(words) - half), half):
        yield words[at : at + BLOCK_WORDS]


class TemplateIndex:
    """Frequency-ordered templates and the index of their prefixes."""

    def __init__(self, templates: tuple, frequency: dict[bytes, int], containment: Fraction = CONTAINMENT) -> None:
        self.rows = []
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for label, text in templates:
            words = sorted(set(words_of(text)), key=lambda w: (frequency.get(w, 0), w))
            need = ceil(containment * len(words))
            for place, w in enumerate(words[: len(words) - need + 1]):
                self.prefix.setdefault(w, []).append((len(self.rows), place))
            self.rows.append((label, frozenset(words), need))
        self.starts = frozenset(self.prefix)

    def block(self, words: list[bytes]) -> Iterator[tuple[str, float]]:
        """(label, containment) of the templates that the block holds."""
        block = set(words)
        done: set[int] = set()
        for w in self.starts & block:
            for row, place in self.prefix[w]:
                label, template, need = self.rows[row]
                if row in done or len(block) < need or len(template) - place < need:
                    continue
                done.add(row)
                shared = len(template & block)
                if shared >= need:
                    yield label, shared / len(template)

    def blocks(self, text: bytes) -> Iterator[list[bytes]]:
        yield from windows(words_of(text))
        for line in text.split(b"\n"):
            words = words_of(line)
            if len(words) > BLOCK_WORDS // 2:
                yield from windows(words)

    def matches(self, text: bytes) -> dict[str, float]:
        out: dict[str, float] = {}
        for words in self.blocks(text):
            if not self.starts.isdisjoint(words):
                for label, share in self.block(words):
                    out[label] = max(share, out.get(label, 0.0))
        return out


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: tuple = TEMPLATES,
    containment: Fraction = CONTAINMENT,
) -> DataFrame:
    """Phrase places, labels and the best containment of every document."""
    index = TemplateIndex(templates, template_frequencies(docs, text_col, templates), containment)

    def one(text: str | None) -> tuple:
        raw = (text or "").encode()
        words = words_of(raw)
        base = phrase_places(words, phrases)
        found = {} if index.starts.isdisjoint(words) else index.matches(raw)
        at = [p for p, _ in base]
        base_labels = {label for _, label in base}
        score = 1.0 if base else max(found.values(), default=0.0)
        return (
            len(words), len(base), min(at, default=None), max(at, default=None),
            ",".join(sorted(base_labels)), ",".join(sorted(base_labels | set(found))), score,
        )

    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")

    def make():
        def batch(cols: dict) -> dict:
            rows = [one(t) for t in cols["text"]]
            return {"doc_id": cols["doc_id"]} | {n: [r[k] for r in rows] for k, n in enumerate(names)}

        return batch

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(rows, make, SCAN)
