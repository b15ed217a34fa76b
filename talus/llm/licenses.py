"""License scans: an exact set-similarity join of text blocks with license templates.

Templates and blocks are sets of words. A template is contained in a block when
the block holds ``threshold`` or more of its words. Words are ordered by their
frequency over all documents, rarest first. A block that contains a template
must share one of the template's first ``|T| - needed + 1`` words (prefix
filter), hold enough words at all (length filter), and after the first shared
word have enough words left on both sides (positional filter); those that pass
are counted out. Blocks are windows that start every ``n`` words and are 2 1/4 ``n``
long, ``n`` being the template's words with repeats: every notice, also one with
a quarter of its words added, lies within one, wherever it stands. Short notices
of different licenses share most of their words, so a block that contains one
must also say what tells it from the others.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talus.shipping import with_package

THRESHOLD = 0.8

#: On UTF-8 bytes: letters a-z, digits and all that isn't ASCII, after lower-casing A-Z.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

#: Phrases whose words must stand consecutively, with their labels: fixed values.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Notices that licenses ask for, and openings of license texts.
TEMPLATES = (
    ("mit", "Released under the MIT license."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("public-domain", "This is free and unencumbered software released into the public domain."),
    ("reserved", "No part of this publication may be reproduced without prior written permission of the publisher."),
)


#: What a block must say, word after word, one of these at least, for a notice that others resemble: fixed values.
MARKS = {
    "Released under the MIT license.": ("mit license",),
    "Licensed under the Apache License, Version 2.0.": ("apache license", "apache software license"),
    "Licensed under CC BY-NC 4.0.": tuple(f"by nc {n}" for n in range(1, 5)),
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": tuple(
        f"attribution {n}" for n in range(1, 5)
    ),
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": ("attribution sharealike",),
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": ("mozilla public",),
    "This is free and unencumbered software released into the public domain.": ("public domain",),
    "No part of this publication may be reproduced without prior written permission of the publisher.": ("no part",),
}
#: What makes it another license than the label's: fixed values.
AGAINST = {
    "gpl": ("lesser general", "library general", "affero general"),
    "bsd": ("are not permitted",),
    "public-domain": ("not released into",),
}


def words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().lower())


def phrases(texts: Iterable[str]) -> tuple[bytes, ...]:
    """Each text's words as they stand within a text joined by single spaces."""
    return tuple(b" %b " % b" ".join(words(t)) for t in texts)


@dataclass(frozen=True)
class Template:
    label: str
    tokens: tuple[int, ...]  # ranks, rarest first
    needed: int
    words: int  # with repeats
    marks: tuple[bytes, ...] = ()
    against: tuple[bytes, ...] = ()

    @property
    def window(self) -> int:
        return 2 * self.words + self.words // 4

    def fits(self, block: list[bytes]) -> bool:
        """Whether a block with enough of the words says what it must, and nothing that it must not."""
        if not self.marks and not self.against:
            return True
        said = b" %b " % b" ".join(block)
        return (not self.marks or any(m in said for m in self.marks)) and not any(a in said for a in self.against)


class TemplateIndex:
    """Templates over one global order of words, with an inverted index of their prefixes."""

    def __init__(
        self,
        templates: Iterable[tuple[str, str]],
        frequency: dict[bytes, int],
        threshold: float = THRESHOLD,
        marks: Mapping[str, tuple[str, ...]] = {},
        against: Mapping[str, tuple[str, ...]] = {},
    ):
        lists = [(label, words(text), phrases(marks.get(text, ()))) for label, text in templates]
        order = sorted(set().union(*(found for _, found, _ in lists)), key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.templates = []
        for label, found, own in lists:
            if tokens := tuple(sorted(self.rank[w] for w in set(found))):
                needed = max(1, math.ceil(threshold * len(tokens) - 1e-9))
                self.templates.append(Template(label, tokens, needed, len(found), own, phrases(against.get(label, ()))))
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for t, template in enumerate(self.templates):
            for i, token in enumerate(template.tokens[: len(template.tokens) - template.needed + 1]):
                self.prefix.setdefault(token, []).append((t, i))

    def blocks(self, found: list[bytes]) -> list[tuple[str, int, int, float]]:
        """``(label, first word, words, containment)`` of every block that contains a template."""
        rank = self.rank.get
        known = [(i, r) for i, w in enumerate(found) if (r := rank(w)) is not None]
        at = [i for i, _ in known]
        out = []
        for t, first in sorted({window for i, r in known for window in self._windows(i, r)}):
            template = self.templates[t]
            size = template.window
            block = sorted({r for _, r in known[bisect_left(at, first) : bisect_left(at, first + size)]})
            overlap = self._overlap(template, block)
            if overlap >= template.needed and template.fits(found[first : first + size]):
                out.append((template.label, first, min(size, len(found) - first), overlap / len(template.tokens)))
        return out

    def _windows(self, i: int, token: int) -> Iterator[tuple[int, int]]:
        """The templates whose prefix has the token, each with the windows that hold place ``i``."""
        for t, _ in self.prefix.get(token, ()):
            template = self.templates[t]
            for start in range(i // template.words * template.words, max(-1, i - template.window), -template.words):
                yield t, start

    def _overlap(self, template: Template, block: list[int]) -> int:
        """Shared words; 0 as soon as a filter rules the template out."""
        if len(block) < template.needed:
            return 0
        shared, i, j = 0, 0, 0
        tokens = template.tokens
        while i < len(tokens) and j < len(block):
            if shared + min(len(tokens) - i, len(block) - j) < template.needed:
                return 0
            if tokens[i] == block[j]:
                shared, i, j = shared + 1, i + 1, j + 1
            elif tokens[i] < block[j]:
                i += 1
            else:
                j += 1
        return shared


def places(found: list[bytes], phrases: Iterable[tuple[str, str]] = PHRASES) -> list[tuple[int, str]]:
    """``(start, label)`` of each place where a phrase's words stand consecutively."""
    joined = b" " + b" ".join(found) + b" "
    out = []
    for phrase, label in phrases:
        needle = b" " + b" ".join(words(phrase)) + b" "
        at, before, nth = joined.find(needle), 0, 0
        while at >= 0:
            nth += joined.count(b" ", before, at)
            out.append((nth, label))
            before, at = at, joined.find(needle, at + 1)
    return sorted(out)


def frequencies(docs: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES, text: str = "text") -> dict[bytes, int]:
    """How often each word of the templates occurs in all documents; no more entries than the templates have words."""
    wanted = frozenset().union(*(words(t) for _, t in templates))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                seen.update(w for w in words(value.as_py()) if w in wanted)
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())}
        )

    counted = with_package(docs).select(F.col(text).cast("string").alias("text")).mapInArrow(count, "word binary, n long")
    return {bytes(r["word"]): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, blocks array<struct<label:string,start:long,length:long,containment:double>>"
)


def scan(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    marks: Mapping[str, tuple[str, ...]] = MARKS,
    against: Mapping[str, tuple[str, ...]] = AGAINST,
) -> DataFrame:
    """What each row of ``docs`` says about its license.

    Returns ``doc_id, n_words``; ``n_base, first_word, last_word, base_labels``
    of the phrases; ``labels``, theirs and the templates', distinct, sorted and
    comma-joined; ``score``, 1 for a phrase, else the best containment found;
    and ``blocks``, every block that contains a template, with its place in
    words. A block that has a template's words but none of its ``marks``, or a
    phrase ``against`` its label, names another license and doesn't count. Null and empty texts have no words, no labels and score 0; null ids
    and repeated rows each get a row. Other columns are not read.
    """
    index = TemplateIndex(templates, frequencies(docs, templates, text), threshold, marks, against)
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"]
    block_type = pa.list_(
        pa.struct([("label", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("containment", pa.float64())])
    )
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), block_type]
    schema = pa.schema(list(zip(names, types)))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for doc_id, value in zip(batch.column(0), batch.column(1)):
                found = words(value.as_py())
                base = places(found)
                blocks = index.blocks(found)
                own = {label for _, label in base}
                score = 1.0 if base else max((b[3] for b in blocks), default=0.0)
                made.append(
                    (
                        doc_id.as_py(),
                        len(found),
                        len(base),
                        base[0][0] if base else None,
                        base[-1][0] if base else None,
                        ",".join(sorted(own)),
                        ",".join(sorted(own | {b[0] for b in blocks})),
                        score,
                        [dict(zip(("label", "start", "length", "containment"), b)) for b in blocks],
                    )
                )
            columns = [pa.array(c, t) for c, t in zip(zip(*made), types)] if made else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    read = with_package(docs).select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return read.mapInArrow(judge, SCHEMA)
