"""License scan: exact phrases, and short notices with edits found from exact seeds.

A notice of ``n`` characters may differ by ``k`` edits. Cut into ``k + 1``
pieces, at least one of them stands in the text unchanged (pigeonhole), so one
pass for all pieces of all notices finds every candidate. The regex library's
bounded-error matching then looks at the few characters around a candidate,
counts the edits and reports the span. Of overlapping spans the one with the
fewest edits stays, and it must name the same license, variant and version as
its notice: edits there are another license.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from vacanta.llm.common import ASCII_LOWER

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EDITS_PER = 12  # one edit is allowed per so many characters

# Fixed values: (words, label) of phrases that are looked up exactly.
PHRASES = [
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
]

# Fixed values: (label, words) of short notices.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("bsd", "licensed under the bsd license"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("epl", "made available under the terms of the eclipse public license"),
    ("apache-1.1", "licensed under the apache license version 1 1"),
    ("gpl-1.0", "licensed under the gnu general public license version 1"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0"),
    ("cc-by-3.0", "licensed under cc by 3 0"),
    ("cc-by-sa-3.0", "licensed under cc by sa 3 0"),
    ("cc-by-nc-3.0", "licensed under cc by nc 3 0"),
    ("cc-by-nd-3.0", "licensed under cc by nd 3 0"),
    ("cc-by-2.0", "licensed under cc by 2 0"),
    ("cc-by-sa-2.0", "licensed under cc by sa 2 0"),
    ("cc-by-nc-2.0", "licensed under cc by nc 2 0"),
    ("cc-by-nd-2.0", "licensed under cc by nd 2 0"),
    ("cc-by", "licensed under a creative commons attribution"),
    ("cc0", "to the extent possible under law the author has waived all copyright"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "no part of this publication may be reproduced"),
]

# Words that tell one license from another; an edit may not change them.
TELLING = {
    "apache", "mit", "bsd", "gnu", "lesser", "affero", "mozilla", "eclipse", "cc", "by", "sa", "nc", "nd", "creative",
}


def telling(words: list[str]) -> list[str]:
    """Names, variants and versions among some words, in order."""
    return [w for w in words if w in TELLING or w.isdigit()]


RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "notices array<struct<label: string, first_word: long, last_word: long, edits: int>>"
)
COLUMNS = [c.split(" ", 1)[0] for c in RESULT.split(", notices")[0].split(", ")] + ["notices"]


class Found(NamedTuple):
    label: str
    start: int  # characters of the normal text
    end: int
    edits: int
    length: int
    telling: list[str]


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of nearly equal length, with their places."""
    cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    """Finds phrases and notices in a text of words joined by single spaces."""

    def __init__(self, phrases=PHRASES, notices=NOTICES):
        self.phrases = [(f" {words} ", label) for words, label in phrases]
        self.notices = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, (label, words) in enumerate(notices):
            edits = len(words) // EDITS_PER
            pattern = regex.compile(rf"(?b)(?:{regex.escape(words, literal_spaces=True)}){{e<={edits}}}")
            self.notices.append((label, words, edits, pattern))
            for at, piece in pieces(words, edits):
                seeds.setdefault(piece, []).append((number, at))
        self.seeds = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.seeds.add_word(piece, (len(piece), uses))
        if seeds:
            self.seeds.make_automaton()

    def exact(self, text: str) -> list[tuple[int, str]]:
        """(place, label) of every phrase; places count characters of `` text ``."""
        framed, found = f" {text} ", []
        for phrase, label in self.phrases:
            at = framed.find(phrase)
            while at >= 0:
                found.append((at, label))
                at = framed.find(phrase, at + 1)
        return sorted(found)

    def fuzzy(self, text: str) -> list[Found]:
        """Notices with at most their number of edits; no two overlap."""
        found, looked = [], {}
        for last, (length, uses) in self.seeds.iter(text) if len(self.seeds) else ():
            for number, at in uses:
                label, words, edits, pattern = self.notices[number]
                begin = last + 1 - length - at
                # Seeds of one notice at one place give one look.
                if looked.get(number, -1) >= begin:
                    continue
                window = (max(0, begin - edits), min(len(text), begin + len(words) + edits))
                match = pattern.search(text, *window)
                if match:
                    found.append(Found(label, match.start(), match.end(), sum(match.fuzzy_counts), len(words), telling(words.split())))
                    looked[number] = begin + edits
        kept: list[Found] = []  # in order; none overlaps another
        for f in sorted(found, key=lambda f: (f.edits / f.length, -f.length, f.start)):
            at = bisect.bisect(kept, f.start, key=lambda k: k.start)
            if (at == 0 or kept[at - 1].end <= f.start) and (at == len(kept) or kept[at].start >= f.end):
                kept.insert(at, f)
        return kept

    def _same_license(self, found: Found, words: list[str], word_at) -> bool:
        """Whether the words that tell licenses apart stand in the text as in the notice."""
        there = words[word_at(found.start) : word_at(found.end - 1) + 1]
        return telling(there) == found.telling

    def scan(self, text: str | None) -> dict:
        words = WORDS.findall((text or "").translate(ASCII_LOWER))
        normal = " ".join(words)
        starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])  # place of each word

        def word_at(place: int) -> int:
            return int(np.searchsorted(starts, place, "right")) - 1

        exact, fuzzy = self.exact(normal), [f for f in self.fuzzy(normal) if self._same_license(f, words, word_at)]
        places = np.searchsorted(starts, [at for at, _ in exact], "right") - 1 if exact else []
        places = [int(p) for p in places]
        base = {label for _, label in exact}
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min(places, default=None),
            "last_word": max(places, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {f.label for f in fuzzy})),
            "score": max([1.0] * bool(exact) + [1 - f.edits / f.length for f in fuzzy], default=0.0),
            "notices": [
                {"label": f.label, "first_word": word_at(f.start), "last_word": word_at(f.end - 1), "edits": f.edits}
                for f in fuzzy
            ],
        }


def scan_licenses(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """``docs`` (text and anything else) with counts, labels, score and the notices' spans.

    Whole texts are read. Null and empty texts have no words, no labels (empty
    strings) and score 0. Repeated rows are scanned alike, no rows give no
    rows, and columns named like the results are replaced.
    """
    docs = docs.drop(*COLUMNS)
    schema = StructType([*docs.schema, *StructType.fromDDL(RESULT)])
    at = docs.columns.index("text")
    kinds = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())])
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(kinds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices)
        for batch in batches:
            rows = [scanner.scan(text.as_py()) for text in batch.column(at)]
            new = [pa.array([r[c] for r in rows], t) for c, t in zip(COLUMNS, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *COLUMNS])

    return docs.mapInArrow(run, schema)
