"""License scans with a positional rare-token index."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases whose presence alone gives a label.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]


TEMPLATES = (
    Template("apache-2.0", "apache license version 2 0 january 2004", ("apache license version 2 0",)),
    Template("apache-2.0", "spdx license identifier apache 2 0", ("spdx license identifier apache",)),
    Template("gpl-3.0", "gnu general public license version 3 29 june 2007", ("gnu general public license version 3",)),
    Template("gpl-2.0", "gnu general public license version 2 june 1991", ("gnu general public license version 2",)),
    Template("gpl-3.0", "gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2.0", "gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "spdx license identifier gpl 3 0", ("spdx license identifier gpl 3",)),
    Template("gpl-2.0", "spdx license identifier gpl 2 0", ("spdx license identifier gpl 2",)),
    Template("mit", "the mit license mit", ("mit license",)),
    Template("mit", "spdx license identifier mit", ("spdx license identifier mit",)),
    Template("bsd", "spdx license identifier bsd 3 clause", ("spdx license identifier bsd",)),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        ("apache license version 2 0", "you may not use this file except in compliance with the license"),
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
        ("gnu general public license",),
    ),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        ("permission is hereby granted free of charge", "obtaining a copy"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        ("redistribution and use in source and binary forms",),
    ),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc0", "released under the cc0 1 0 universal public domain dedication", ("public domain dedication",)),
)
# Places of a template that must agree on where it stands, and the share of its words that must then stand there.
MIN_VOTES = 2
MIN_COVERAGE = 0.75

_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def places(line: bytes, phrase: bytes) -> list[int]:
    """Word numbers where a phrase starts; ``line`` and ``phrase`` have a space on both sides."""
    out, at, last, number = [], line.find(phrase), 0, 0
    while at >= 0:
        number += line.count(b" ", last, at)
        out.append(number)
        last, at = at, line.find(phrase, at + 1)
    return out


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...]) -> tuple[int, dict[bytes, int]]:
    """Number of documents, and of those that hold each licence word; only the templates' words reach the driver."""
    vocabulary = sorted({w for t in templates for w in t.text.encode().split()})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, found, known = 0, defaultdict(int), set(vocabulary)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total += 1
                for word in known.intersection(words_of(text or b"")):
                    found[word] += 1
        yield pa.record_batch({"word": pa.array([b"", *found], pa.binary()), "n": pa.array([total, *found.values()], pa.int64())})

    texts = docs.select(F.col("text").cast("binary").alias("text"))
    rows = texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {bytes(r.word): r.n for r in rows}
    return counts.pop(b"", 0), counts


class RareTokenIndex:
    """Postings (template, position) of each template's rarest words, of so many that ``MIN_COVERAGE`` always leaves ``MIN_VOTES`` of them."""

    def __init__(self, templates: tuple[Template, ...], total: int, frequency: dict[bytes, int]):
        self.templates = [(t.label, t.text.encode().split(), [b" " + p.encode() + b" " for p in t.phrases]) for t in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for number, (_, words, _) in enumerate(self.templates):
            idf = {w: math.log((total + 1) / (frequency.get(w, 0) + 1)) for w in words}
            wanted = len(words) - math.ceil(MIN_COVERAGE * len(words)) + MIN_VOTES
            for word in sorted(idf, key=lambda w: (-idf[w], w)):
                if wanted <= 0:
                    break
                held = [position for position, other in enumerate(words) if other == word]
                self.postings[word] += [(number, position) for position in held]
                wanted -= len(held)
        self.rare = frozenset(self.postings)

    def scan(self, words: list[bytes]) -> tuple[set[str], float]:
        """Labels of the templates found, and the best share of a template's words that stand in their places."""
        found = self.rare.intersection(words)
        if not found:
            return set(), 0.0
        votes: dict[tuple[int, int], int] = defaultdict(int)
        for at, word in enumerate(words):
            if word in found:
                for number, position in self.postings[word]:
                    votes[number, at - position] += 1
        labels, best = set(), 0.0
        for (number, start), count in votes.items():
            label, template, phrases = self.templates[number]
            if count < MIN_VOTES:
                continue
            hits = sum(words[start + i] == w for i, w in enumerate(template) if 0 <= start + i < len(words))
            coverage = hits / len(template)
            if coverage >= MIN_COVERAGE and all(self._holds(words, start, len(template), p) for p in phrases):
                labels.add(label)
                best = max(best, coverage)
        return labels, best

    @staticmethod
    def _holds(words: list[bytes], start: int, size: int, phrase: bytes) -> bool:
        return phrase in b" " + b" ".join(words[max(0, start) : start + size]) + b" "


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, phrases: dict[str, str] = BASE_PHRASES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    Base labels come from phrases anywhere in the text.  The index adds the labels of templates: a text's licence words
    are looked up, places where several rare words of one template keep their distances become candidates, and a
    candidate counts if ``MIN_COVERAGE`` of the template stands there with its mandatory phrases.  ``score`` is the best
    coverage, 0 without a template.  Template words are weighted by their frequency over all documents.

    Needs ``doc_id`` and ``text``; others are left out.  A null text is empty.  Ids pass on as they are, null or repeated.
    """
    total, frequency = document_frequencies(docs, templates)
    index = RareTokenIndex(templates, total, frequency)
    base = [(b" " + phrase.encode() + b" ", label) for phrase, label in phrases.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                words = words_of(text or b"")
                line = b" " + b" ".join(words) + b" "
                found = [(label, places(line, phrase)) for phrase, label in base if phrase in line]
                starts = [s for _, p in found for s in p]
                more, score = index.scan(words)
                own = sorted({label for label, _ in found})
                both = sorted({*own, *more})
                ends = (min(starts, default=None), max(starts, default=None))
                rows.append((len(words), len(starts), *ends, ",".join(own), ",".join(both), score))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True))], schema=schema)

    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    )
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return whole.mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    )
