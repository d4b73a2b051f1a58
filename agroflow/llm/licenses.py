"""Licence texts found through a positional index of their rarest words.

The index holds, for each template, the positions of its rarest words by document frequency in the corpus.
A file looks up those of its words that have postings; each meeting of a word and a posting votes for a
place where the template would start. A place counts if the template's mandatory phrases stand exactly there
and enough of its other words stand at their places, give or take a few inserted words.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroflow.llm.common import read_table, texts, words_of

#: Postings of a template: so many of its rarest words.
RARE_WORDS = 4
#: Share of a template's words that must be at their places, and by how many words they may be off.
COVERAGE, SLACK = 0.8, 3


@dataclass(frozen=True)
class Template:
    """``phrases`` are the mandatory ones, as (place in the words, number of words)."""

    label: str
    words: tuple[bytes, ...]
    phrases: tuple[tuple[int, int], ...]
    is_base: bool


def template(label: str, text: str, *mandatory: str, is_base: bool = False) -> Template:
    words = tuple(words_of(text))
    phrases = []
    for phrase in mandatory or (text,):
        wanted = tuple(words_of(phrase))
        at = next(i for i in range(len(words)) if words[i : i + len(wanted)] == wanted)
        phrases.append((at, len(wanted)))
    return Template(label, words, tuple(phrases), is_base)


def base_templates() -> list[Template]:
    # Base phrases and their labels.
    phrases = {
        "gnu general public license": "gpl",
        "apache license": "apache",
        "cc by": "cc-by",
        "mit license": "mit",
    }
    return [template(label, phrase, is_base=True) for phrase, label in phrases.items()]


def licence_templates() -> list[Template]:
    """Statements of common licences, with the phrases that must be there word for word."""
    # Wording of the licences.
    return [
        template("gpl-2.0", "gnu general public license version 2", "gnu general public license version 2"),
        template("gpl-3.0", "gnu general public license version 3", "gnu general public license version 3"),
        template("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
        template("agpl", "gnu affero general public license", "gnu affero general public license"),
        template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
        template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
        template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
        template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
        template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
        template("epl", "eclipse public license", "eclipse public license"),
        template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software released into the public domain"),
        template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright and related or neighboring rights"),
        template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
        template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
        template("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
        template("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0 international"),
    ]


def document_frequencies(docs: DataFrame, vocabulary: frozenset[bytes]) -> tuple[int, dict[bytes, int]]:
    """(documents, documents with each word of ``vocabulary``) over all rows; as many numbers as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = Counter(), 0
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0):
                seen.update(vocabulary.intersection(words_of(text.as_py())))
        words = [None, *seen]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([n, *seen.values()], pa.int64())], ["word", "n"])

    counted = texts(docs).select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {None if r["word"] is None else bytes(r["word"]): r["n"] for r in counted.collect()}
    return found.pop(None, 0), found


class PositionalIndex:
    def __init__(self, templates: list[Template], documents: int, frequency: dict[bytes, int], rare_words: int = RARE_WORDS):
        self.templates = templates
        self.idf = {w: math.log((documents + 1) / (frequency.get(w, 0) + 1)) for t in templates for w in t.words}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for number, t in enumerate(templates):
            rarest = sorted(set(t.words), key=lambda w: (-self.idf[w], w))[: 1 if t.is_base else rare_words]
            for place, word in enumerate(t.words):
                if word in rarest:
                    self.postings[word].append((number, place))
        self.posted = frozenset(self.postings)

    def _starts(self, words: list[bytes], present: set[bytes]) -> dict[int, set[int]]:
        starts = defaultdict(set)
        # The file's rarest licence words first.
        for word in sorted(present, key=lambda w: (-self.idf[w], w)):
            at = -1
            for _ in range(words.count(word)):
                at = words.index(word, at + 1)
                for number, place in self.postings[word]:
                    starts[number].add(at - place)
        return starts

    def _coverage(self, t: Template, words: list[bytes], start: int) -> float:
        n = len(words)
        for place, size in t.phrases:
            at = start + place
            if at < 0 or words[at : at + size] != list(t.words[place : place + size]):
                return 0.0
        there = 0
        for place, word in enumerate(t.words):
            low = max(0, start + place - SLACK)
            there += word in words[low : min(n, start + place + SLACK + 1)]
        return there / len(t.words)

    def look_up(self, words: list[bytes], coverage: float = COVERAGE) -> tuple[list[tuple[str, int]], list[tuple[str, float]]]:
        """(base places as (label, start), the other templates found as (label, share of their words))."""
        base, other = [], []
        present = self.posted.intersection(words)
        if not present:
            return base, other
        for number, starts in self._starts(words, present).items():
            t = self.templates[number]
            if t.is_base:
                base += [(t.label, s) for s in starts if s >= 0 and words[s : s + len(t.words)] == list(t.words)]
                continue
            # Words inserted inside a template move its later words: a phrase may stand beside the vote.
            near = {s + d for s in starts for d in range(-SLACK, SLACK + 1)} if len(t.words) > t.phrases[0][1] else starts
            best = max((self._coverage(t, words, s) for s in near), default=0.0)
            if best >= coverage:
                other.append((t.label, best))
        return base, other


def scan_licenses(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): number of words, base places,
    their least and largest word position, base labels, all labels, and a score.

    The score is 1 with a base place, else the best share of a template's words, 0 without any. Null and empty
    texts have no words and no labels; repeated rows come out as often as they go in.
    """
    templates = templates or base_templates() + licence_templates()
    documents, frequency = document_frequencies(docs, frozenset(w for t in templates for w in t.words))
    index = PositionalIndex(templates, documents, frequency)
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                base, other = index.look_up(words)
                places = [s for _, s in base]
                labels = {label for label, _ in base}
                score = 1.0 if base else max((share for _, share in other), default=0.0)
                out.append((
                    doc_id, len(words), len(base), min(places, default=None), max(places, default=None),
                    ",".join(sorted(labels)), ",".join(sorted(labels | {label for label, _ in other})), score,
                ))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return texts(docs).mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    )


def op7_license_index(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(read_table(spark, folder, "documents"))
