"""Operator 10: license notices and texts by an exact set-similarity join.

Templates, a table of labels and wordings, are sets of words, and so are blocks: the sentences
of a text, cut at line breaks as well as across them, its paragraphs for templates of whole
texts, and all runs of words that are as much longer than the template as words of it may be
missing, whatever breaks stand in them. A block matches a template if it holds at least ``THRESHOLD`` of its words, each counted once.
Words are in one order, rare ones in the whole corpus first. A text can only hold a match if it
has a word of the template's prefix, its rarest words up to one more than may be missing; if it
has enough words of the template's kind; and if, at the first common word, enough are left on
both sides. Runs are looked at around words of the prefix only, and what a block has in common
with the template is counted exactly, so every match is found. A match names its label, but
where the block, or a run that holds all of it, has more words in common with another template
of the kind, as those of GPL are in LGPL.

Beside this, fixed phrases are found wherever their words stand consecutively.

A null text counts as empty, without words and labels. Templates without words or label match
nothing; of equal ones each matches. Templates are sent to all tasks, so they are bounded by
``MOST_TEMPLATE_BYTES``; more are an error. Only they and counts of their words come to the
driver. Empty tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from totelane.llm.common import as_bytes, entries, slices

THRESHOLD = 0.9
_AT_ONCE = 1 << 21
PHRASES = (
    (b"mit license", "mit"),
    (b"apache license", "apache"),
    (b"general public license", "gpl"),
)

# Wording of public licenses and of the usual notices.
NOTICES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "Licensed under the GNU General Public License."),
    ("gpl", "Released under the GPL version 3."),
    ("lgpl", "Licensed under the GNU Lesser General Public License."),
    ("agpl", "Licensed under the GNU Affero General Public License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd", "Released under the BSD License."),
    ("bsd", "Licensed under the BSD 3-Clause License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc0", "Released into the public domain under CC0 1.0."),
)
TEXTS = (
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    ),
    (
        "apache",
        "Unless required by applicable law or agreed to in writing, software distributed under "
        "the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or any later version.",
    ),
)
_BLANKED = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()
_SENTENCE = re.compile(rb"[\n\r\x0b\x0c]+|(?<=[.!?])[ \t]+")
#: Sentences over several lines: "v. 2.0" goes on, signs between stop and line end do not matter.
_VERSION = re.compile(rb"\b([vV])\.")
_STOP = re.compile(
    rb"([.!?])(?:[\x00-\x09\x0b-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]*\n|[ \t\n\r\x0b\x0c]+)"
)
_JOINED = re.compile(rb"\x1e|\n[ \t\r]*\n")
_PARAGRAPH = re.compile(rb"\n[ \t\r]*\n")
#: Kind of templates that are compared with paragraphs, all others with sentences.
WHOLE = "text"
#: Bytes of all templates together.
MOST_TEMPLATE_BYTES = 32 << 20
#: ``kind`` parts templates that are compared with each other, such as notices and whole texts.
TEMPLATES = "kind string, label string, text string"


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, ASCII letters in lower case, and whatever is not ASCII."""
    return text.translate(_BLANKED).split()


def blocks_of(text: bytes, kind: str) -> list[bytes]:
    if kind == WHOLE:
        return _PARAGRAPH.split(text)
    over_lines = _JOINED.split(_STOP.sub(rb"\1" + b"\x1e", _VERSION.sub(rb"\1", text)))
    return [*_SENTENCE.split(text), *over_lines]


class Templates:
    """Templates of one kind in the order of ``frequency``, with an index of their prefixes."""

    def __init__(self, texts, frequency: dict[bytes, int], threshold: float):
        self.threshold = threshold
        words = {w for _, text in texts for w in words_of(text.encode())}
        order = sorted(words, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.labels = [label for label, _ in texts]
        self.sets = [sorted({self.rank[w] for w in words_of(t.encode())}) for _, t in texts]
        self.every = [frozenset(own) for own in self.sets]
        self.needed = [math.ceil(threshold * len(x) - 1e-9) for x in self.sets]
        self.reach = [
            len(words_of(text.encode())) + len(own) - least
            for (_, text), own, least in zip(texts, self.sets, self.needed, strict=True)
        ]
        self.index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i, own in enumerate(self.sets):
            for place, word in enumerate(own[: len(own) - self.needed[i] + 1]):
                self.index[word].append((i, place))
        self.prefix = {order[word] for word in self.index}

    def candidates(self, words: set[bytes]) -> list[int]:
        """Templates that a text with these words may hold: all that it holds, as the words of
        a run are among those of the text."""
        known = sorted(self.rank[w] for w in words if w in self.rank)
        held, seen, found = set(known), set(), []
        for place, word in enumerate(known):
            for i, at in self.index.get(word, ()):
                if i in seen or len(known) < self.needed[i]:
                    continue
                seen.add(i)  # its first common word
                if min(len(self.sets[i]) - at, len(known) - place) < self.needed[i]:
                    continue
                if len(self.every[i] & held) >= self.needed[i]:
                    found.append(i)
        return sorted(found)

    def matches(self, words: list[bytes]) -> list[tuple[float, frozenset[int], str]]:
        """Containment, common words and label of the templates that a block matches."""
        held = frozenset(self.rank[w] for w in words if w in self.rank)
        common = ((i, self.every[i] & held) for i in self.candidates(set(words)))
        return [(len(own) / len(self.every[i]), own, self.labels[i]) for i, own in common]

    def runs(self, words: list[bytes]) -> list[tuple[float, str | None]]:
        """Containment and label of the windows of at most ``reach`` words of a whole text
        that match; no label where only windows around which more words of another template
        stand do."""
        near = self.candidates(set(words))
        if not near:
            return []
        ranks = [self.rank.get(w, -1) for w in words]
        found: list[tuple[float, str | None]] = []
        for i in near:
            share, label = 0.0, None
            for start, end, common in self._spans(ranks, i):
                share = max(share, len(common) / len(self.every[i]))
                if label is None and not any(
                    common < other for j in near for other in self._around(ranks, j, start, end)
                ):
                    label = self.labels[i]
            if share:
                found.append((share, label))
        return found

    def _spans(self, ranks: list[int], i: int) -> Iterator[tuple[int, int, frozenset[int]]]:
        """First place, end and common words of the tightest windows that match a template;
        each holds a word of the prefix."""
        own, reach = self.every[i], self.reach[i]
        prefix = set(self.sets[i][: len(own) - self.needed[i] + 1])
        until = 0
        last: dict[int, int] = {}  # the latest place of each word, oldest first
        for place in (k for k, rank in enumerate(ranks) if rank in prefix):
            for k in range(max(until, place - reach + 1), min(place + reach, len(ranks))):
                if ranks[k] not in own:
                    continue
                last.pop(ranks[k], None)
                last[ranks[k]] = k
                while last[oldest := next(iter(last))] <= k - reach:
                    del last[oldest]
                if len(last) >= self.needed[i]:
                    yield last[oldest], k + 1, frozenset(last)
            until = min(place + reach, len(ranks))

    def _around(self, ranks: list[int], j: int, start: int, end: int) -> Iterator[frozenset[int]]:
        """Common words of the windows of template ``j`` that match and hold a span."""
        for stop in range(end, min(len(ranks), start + self.reach[j]) + 1):
            common = self.every[j].intersection(ranks[max(0, stop - self.reach[j]) : stop])
            if len(common) >= self.needed[j]:
                yield common


class Scanner:
    """All that is found in one text. ``templates`` are rows of kind, label and text."""

    def __init__(self, frequency: dict[bytes, int], threshold: float, templates=None):
        kinds = defaultdict(list)
        for kind, label, text in templates or supplied():
            if label and text and words_of(text.encode()):
                kinds[kind].append((label, text))
        self.kinds = {kind: Templates(x, frequency, threshold) for kind, x in kinds.items()}

    def found(self, text: bytes, words: list[bytes]) -> tuple[set[str], float]:
        """The labels of all matches but those within others, and the largest containment."""
        every, labels, shares = set(words), set(), [0.0]
        for name, kind in self.kinds.items():
            if not kind.candidates(every):
                continue
            for block in blocks_of(text, name):
                matched = kind.matches(words_of(block))
                shares += [share for share, _, _ in matched]
                labels.update(
                    label for _, own, label in matched if not any(own < other for _, other, _ in matched)
                )
            for share, label in kind.runs(words):
                shares.append(share)
                labels.update([label] if label else [])
        return labels, max(shares)

    def scan(self, text: bytes) -> tuple:
        words = words_of(text)
        places, base = phrases(words)
        labels, share = self.found(text, words)
        return (
            len(words),
            len(places),
            min(places, default=None),
            max(places, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(base | labels)),
            1.0 if base else share,
        )


def phrases(words: list[bytes]) -> tuple[list[int], set[str]]:
    """Where the fixed phrases start, and their labels. All end with the same word."""
    places, labels = [], set()
    last = PHRASES[0][0].split()[-1]
    end = -1
    for _ in range(words.count(last)):
        end = words.index(last, end + 1)
        for phrase, label in PHRASES:
            own = phrase.split()
            start = end - len(own) + 1
            if start >= 0 and words[start : end + 1] == own:
                places.append(start)
                labels.add(label)
    return places, labels


def supplied() -> list[tuple[str, str, str]]:
    """The templates of this module as rows."""
    return [("notice", *x) for x in NOTICES] + [("text", *x) for x in TEXTS]


def _bounded(templates: DataFrame) -> list[tuple]:
    """The rows of a table of templates, if it is small enough to be sent to all tasks."""
    rows = templates.select("kind", "label", "text").filter("label IS NOT NULL AND text IS NOT NULL")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 100), F.lit(0))).first()[0]
    if size > MOST_TEMPLATE_BYTES:
        raise ValueError(f"templates of {size} bytes; {MOST_TEMPLATE_BYTES} can be sent to all tasks")
    return [tuple(row) for row in rows.collect()]


def word_counts(rows: DataFrame, templates: list[tuple]) -> dict[bytes, int]:
    """How often each word of a template stands in the whole corpus."""
    wanted = {w for _, _, text in templates for w in words_of(text.encode())}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches, "text", _AT_ONCE):
            for text in as_bytes(batch.column("text")):
                counts.update(filter(wanted.__contains__, words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([w.decode() for w in counts], pa.string()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["word", "n"],
        )

    found = rows.select("text").mapInArrow(count, "word string, n bigint")
    return {
        row["word"].encode(): row["n"]
        for row in found.groupBy("word").agg(F.sum("n").alias("n")).collect()
    }


_FOUND = (
    "at bigint, doc_id bigint, n_words bigint, n_base bigint, first_word bigint, "
    "last_word bigint, base_labels string, labels string, score double"
)


def license_scan(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: DataFrame | None = None,
) -> DataFrame:
    """``at``, ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels`` and ``score`` of each document; ``templates`` has the columns
    of ``TEMPLATES``, else those of this module are taken."""
    rows = entries(docs, id_col, text_col)
    wordings = supplied() if templates is None else _bounded(templates)
    frequency = word_counts(rows, wordings)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(frequency, threshold, wordings)
        kinds = {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64()}
        fields = [x.split() for x in _FOUND.split(", ")][2:]
        for batch in slices(batches, "text", _AT_ONCE):
            found = [scanner.scan(x) for x in as_bytes(batch.column("text"))]
            columns = [
                pa.array([row[i] for row in found], kinds[kind])
                for i, (_, kind) in enumerate(fields)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("at"), batch.column("doc_id"), *columns],
                names=["at", "doc_id", *(name for name, _ in fields)],
            )

    return rows.mapInArrow(scan, _FOUND)
