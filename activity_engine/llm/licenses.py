"""Licence scans: exact phrases by word, and fuzzy search for short notices.

A notice may differ from its pattern by k edits. Cut into k + 1 pieces, at least one piece must then
stand in the text unchanged (pigeonhole), so an automaton over all pieces finds every place worth a
look, and bounded-error matching of the `regex` library runs on a window around these places only.
Both work on the text's lower-case words joined by single spaces, so that punctuation and line breaks
inside a notice do not count as edits.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from activity_engine.llm.common import pieces

# Phrases whose words must stand consecutively, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Short notices and their labels, in lower-case words.
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
)
# One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 12

_WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))

SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32())])
RESULT = pa.struct(
    [
        ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(SPAN)),
    ]
)
_DDL = (
    "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,labels:string,"
    "score:double,spans:array<struct<label:string,start:bigint,end:bigint,edits:int>>>"
)


def words_of(text: str) -> list[bytes]:
    """Runs of ASCII letters and digits and of anything beyond ASCII; A-Z in lower case."""
    return text.encode("utf-8", "replace").translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Notice:
    label: str
    text: str
    edits: int

    def seeds(self) -> list[tuple[str, int]]:
        """edits + 1 pieces of about one length, with their offsets; together they are the notice."""
        n, k = len(self.text), self.edits + 1
        borders = [n * i // k for i in range(k + 1)]
        return [(self.text[a:b], a) for a, b in zip(borders, borders[1:], strict=False)]


def notices(patterns: tuple[tuple[str, str], ...] = NOTICES, chars_per_edit: int = CHARS_PER_EDIT) -> list[Notice]:
    return [Notice(label, text, len(text) // chars_per_edit) for label, text in patterns]


class Scanner:
    """The automaton over all seeds and the bounded-error patterns."""

    def __init__(self, wanted: list[Notice]) -> None:
        self.wanted = wanted
        owners: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(wanted):
            for seed, offset in notice.seeds():
                owners.setdefault(seed, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for seed, places in owners.items():
            self.automaton.add_word(seed, (len(seed), places))
        self.automaton.make_automaton()
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n.text, literal_spaces=True)}){{e<={n.edits}}}") for n in wanted]

    def spans(self, joined: str) -> list[tuple[str, int, int, int]]:
        """(label, start, end, edits) of every notice in text of words joined by spaces.

        Each seed says where its notice would start. Starts of one notice that the allowed edits may have
        moved apart share a window, which is too short for two notices, so the best match inside is the one.
        """
        starts: dict[int, list[int]] = {}
        for end, (length, places) in self.automaton.iter(joined):
            for number, offset in places:
                starts.setdefault(number, []).append(end + 1 - length - offset)
        found = set()
        for number, places in starts.items():
            notice = self.wanted[number]
            places.sort()
            first = 0
            for k, start in enumerate(places):
                if k + 1 < len(places) and places[k + 1] - places[first] <= notice.edits:
                    continue
                lo, hi = max(0, places[first] - notice.edits), min(len(joined), start + len(notice.text) + notice.edits)
                first = k + 1
                m = self.patterns[number].search(joined, lo, hi)
                if m is not None:
                    found.add((notice.label, m.start(), m.end(), sum(m.fuzzy_counts)))
        # Of notices that overlap the one with the fewest edits is meant, the longest among equals.
        kept: list[tuple[int, int, str, int]] = []
        for label, start, end, edits in sorted(found, key=lambda s: (s[3], s[1] - s[2], s[1], s[0])):
            # Those kept do not overlap, so only the neighbours in order can.
            at = bisect_left(kept, (start, end))
            if (at == 0 or kept[at - 1][1] <= start) and (at == len(kept) or kept[at][0] >= end):
                kept.insert(at, (start, end, label, edits))
        return [(label, start, end, edits) for start, end, label, edits in kept]


def _ranks(places: list[int], gaps: list[int]) -> list[int]:
    """How many gaps lie before each place."""
    return [bisect_left(gaps, p) for p in places]


def scan_text(text: str | None, scanner: Scanner, phrases: dict[str, str] = PHRASES) -> dict:
    """What `scan` reports for one text."""
    words = words_of(text or "")
    joined = b" ".join(words)
    starts: list[int] = []
    labels = set()
    for phrase, label in phrases.items():
        wanted, size = phrase.encode(), len(phrase)
        at = joined.find(wanted)
        while at >= 0:
            if (at == 0 or joined[at - 1] == 0x20) and (at + size == len(joined) or joined[at + size] == 0x20):
                starts.append(at)
                labels.add(label)
            at = joined.find(wanted, at + 1)
    # Places in bytes, then in characters, as numbers of words, all found in one pass.
    starts = _ranks(starts, [m.start() for m in re.finditer(b" ", joined)]) if starts else []
    line = joined.decode("utf-8", "replace")
    spans = []
    best = 1.0 if starts else 0.0
    matched = scanner.spans(line)
    # Spans are given in words, as a reader of the text counts them.
    firsts = _ranks([a + (line[a : a + 1] == " ") for _, a, _, _ in matched], [m.start() for m in re.finditer(" ", line)]) if matched else []
    for first, (label, a, b, edits) in zip(firsts, matched, strict=True):
        spans.append({"label": label, "start": first, "end": first + line[a:b].strip().count(" ") + 1, "edits": edits})
        best = max(best, 1.0 - edits / max(1, b - a))
    return {
        "n_words": len(words),
        "n_base": len(starts),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(labels)),
        "labels": ",".join(sorted(labels | {s["label"] for s in spans})),
        "score": best,
        "spans": spans,
    }


def scan(text: Column, wanted: list[Notice] | None = None, phrases: dict[str, str] = PHRASES) -> Column:
    """struct<n_words, n_base, first_word, last_word, base_labels, labels, score, spans> of a text column.

    Base: places (by word, from 0) of the exact phrases. Spans: the fuzzy notices with their edits, in
    words. Score: 1 with an exact phrase, else one less the share of edits of the best notice, else 0.
    A null or empty text has no words, no labels and score 0. Every row is looked at by itself, so ties,
    repeated rows, empty tables and further columns make no difference.
    """
    wanted = notices() if wanted is None else wanted

    @F.arrow_udf(_DDL)
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(wanted)
        for array, cuts in pieces(arrays):
            parts = [
                pa.array([scan_text(t, scanner, phrases) for t in array.slice(s, n).to_pylist()], RESULT) for s, n in cuts
            ]
            yield pa.concat_arrays(parts) if parts else pa.array([], RESULT)

    return run(text)
