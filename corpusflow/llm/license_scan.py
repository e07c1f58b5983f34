"""License scanning: fixed phrases, and short notices that match with a bounded number of edits.

Texts are cut into words (runs of letters, digits and all that is not ASCII, A-Z lower-cased) joined by single spaces. A notice of
``k`` allowed edits is cut into ``k + 1`` pieces: whatever matches it with ``k`` edits or fewer holds one of the pieces unchanged, so exact
search for the pieces finds every candidate. Around them the ``regex`` library matches the notice with at most ``k`` inserted,
deleted or replaced characters, from the first character of a word to the last of one, and reports the span and its edits. Of
matches that overlap the leftmost the one with the fewest edits stays, and what lies between two of them is searched again.

Work per text is one pass for the words, one search per piece and one bounded match per candidate. A task holds a slice of
texts (about two MB, or one longer text) and the matches of windows it has met.

Edge cases: null, empty and wordless texts have no words, no spans and score 0. Matches never cross from one text into another. Ties are
settled as said above; repeated rows get equal results; an empty table gives an empty result. The input row
travels as a struct, so names cannot clash. Offsets are code points of the text, ends exclusive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import carried, raw_text, slices, text_in

# Phrases that count as they stand, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Short notices in normalised words, their labels, and the edits allowed.
NOTICES = (
    ("mit license", "mit", 1),
    ("apache license", "apache", 1),
    ("licensed under the apache license version 2 0", "apache", 4),
    ("gnu general public license", "gpl", 2),
    ("gnu lesser general public license", "lgpl", 2),
    ("gnu affero general public license", "agpl", 2),
    ("this program is free software you can redistribute it and or modify it", "gpl", 4),
    ("mozilla public license", "mpl", 2),
    ("eclipse public license", "epl", 2),
    ("boost software license", "bsl", 2),
    ("bsd 2 clause license", "bsd", 1),
    ("bsd 3 clause license", "bsd", 1),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 4),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 4),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", 4),
    ("creative commons attribution", "cc-by", 2),
    ("licensed under a creative commons", "cc", 3),
    ("dedicated to the public domain", "public-domain", 2),
    ("released into the public domain", "public-domain", 2),
    ("all rights reserved", "all-rights-reserved", 1),
)

SPAN = "array<struct<label:string,begin:int,end:int,edits:int,base:boolean>>"
MEMORY = 50_000  # windows a worker remembers, of at most REMEMBERED bytes each
REMEMBERED = 512
SPACE, END = 32, 10

_WORD = np.full(256, SPACE, np.uint8)
for _low, _high in ((48, 58), (97, 123), (128, 256)):
    _WORD[_low:_high] = np.arange(_low, _high)
_WORD[65:91] = np.arange(97, 123)


def cut_pieces(notice: str, edits: int) -> list[tuple[int, bytes]]:
    """``edits + 1`` pieces of nearly equal length and their places; one of them survives any ``edits`` edits."""
    ends = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b].encode()) for a, b in zip(ends, ends[1:])]


def compiled(notice: str, edits: int) -> tuple[regex.Pattern, regex.Pattern]:
    """The notice with at most ``edits`` edits, between ends of words: the leftmost match, and the match with the fewest edits."""
    whole = rf"(?<![^ ])(?=[^ ])(?:{notice}){{e<={edits}}}(?<=[^ ])(?![^ ])"
    return regex.compile(whole), regex.compile("(?b)" + whole)


class Words:
    """Normalised words of a slice of texts: one buffer, texts closed by a line end, and the way back to code points."""

    def __init__(self, array: pa.Array) -> None:
        data, at = raw_text(array)
        self.data, self.at = data, at
        n = len(at) - 1
        full = np.insert(_WORD[data], at[1:], END)
        gap = full <= SPACE
        after = np.ones(len(full), bool)  # whether the byte before is a gap
        after[1:] = gap[:-1]
        keep = ~((full == SPACE) & after)
        buffer = full[keep]
        self.bytes = buffer.tobytes()
        closed = np.flatnonzero(buffer == END)
        self.starts = np.append(0, closed + 1)[:n]
        self.ends = closed
        first = buffer > SPACE
        first[1:] &= buffer[:-1] <= SPACE
        self.words = np.flatnonzero(first)
        self.word_at = np.searchsorted(self.words, np.append(self.starts, len(buffer)))
        # place in ``data`` of every byte: line ends were put in, one a text
        self._source = np.flatnonzero(keep)

    def text_of(self, place: int) -> int:
        return int(np.searchsorted(self.starts, place, "right")) - 1

    def head(self, place: int) -> int:
        """``place``, moved back to the first byte of its character."""
        while self.bytes[place] & 0xC0 == 0x80:
            place -= 1
        return place

    def code_points(self, text: int, begin: int, end: int) -> tuple[int, int]:
        """Span in the text for a span of the buffer that begins and ends with a word."""
        first, last = int(self._source[begin]) - text, int(self._source[end - 1]) - text
        inside = self.data[self.at[text] : last + 1]
        heads = (inside & 0xC0) != 0x80
        return int(heads[: first - self.at[text]].sum()), int(heads.sum())

    def is_whole(self, begin: int, end: int) -> bool:
        """Whether no word goes on beyond either end."""
        return (begin == 0 or self.bytes[begin - 1] <= SPACE) and self.bytes[end] <= SPACE


def phrase_places(words: Words) -> list[tuple[int, int, int]]:
    """``(begin, end, phrase number)`` in the buffer of every fixed phrase whose words stand there whole."""
    out = []
    for number, (phrase, _) in enumerate(PHRASES):
        wanted = phrase.encode()
        at = words.bytes.find(wanted)
        while at >= 0:
            if words.is_whole(at, at + len(wanted)):
                out.append((at, at + len(wanted), number))
            at = words.bytes.find(wanted, at + 1)
    return out


class Notices:
    """Pieces and patterns of all notices, and the matches of windows met before."""

    def __init__(self, notices=NOTICES) -> None:
        self.notices = [(text, label, edits, cut_pieces(text, edits)) for text, label, edits in notices]
        self._patterns: dict[int, tuple[regex.Pattern, regex.Pattern]] = {}
        self._met: dict[tuple[int, bytes], list[tuple[int, int, int]]] = {}

    def windows(self, words: Words, number: int) -> list[list[int]]:
        """Stretches of the buffer that can hold a match, merged; each reaches further than any match around its pieces."""
        text, _, edits, pieces = self.notices[number]
        margin = 4 * edits + 4  # an inserted character has at most four bytes
        found = []
        for offset, piece in pieces:
            at = words.bytes.find(piece)
            while at >= 0:
                own = words.text_of(at)
                begin = max(at - offset - margin, int(words.starts[own]))
                end = min(at - offset + len(text) + margin, int(words.ends[own]))
                found.append((words.head(begin), words.head(end)))
                at = words.bytes.find(piece, at + 1)
        merged: list[list[int]] = []
        for begin, end in sorted(found):
            if merged and begin < merged[-1][1]:
                merged[-1][1] = max(end, merged[-1][1])
            else:
                merged.append([begin, end])
        return merged

    def matches(self, number: int, window: bytes) -> list[tuple[int, int, int]]:
        """``(begin, end, edits)`` of the matches in a window, in bytes."""
        known = self._met.get((number, window))
        if known is None:
            notice, _, edits, _ = self.notices[number]
            if number not in self._patterns:
                self._patterns[number] = compiled(notice, edits)
            text = " " + window.decode()
            known = [(b - 1, e - 1, n) for b, e, n in _chosen(*self._patterns[number], text, len(notice) + edits)]
            if not text.isascii():
                known = [(len(text[1 : b + 1].encode()), len(text[1 : e + 1].encode()), n) for b, e, n in known]
            if len(window) <= REMEMBERED:
                if len(self._met) >= MEMORY:
                    self._met.clear()
                self._met[(number, window)] = known
        return known


def _best(pattern: regex.Pattern, text: str, begin: int, end: int) -> list[tuple[int, int, int]]:
    """The match with the fewest edits, and so on to its left and right.

    The library inserts nothing at the place where a search begins, so each begins at the space before.
    """
    found = pattern.search(text, begin, end)
    if not found:
        return []
    here = (found.start(), found.end(), sum(found.fuzzy_counts))
    return [*_best(pattern, text, begin, here[0]), here, *_best(pattern, text, here[1], end)]


def _chosen(first: regex.Pattern, best: regex.Pattern, text: str, reach: int) -> list[tuple[int, int, int]]:
    """Matches of a text that begins with a space, from left to right; the stretch searched for better ones ends where nothing overlaps the leftmost any more."""
    out: list[tuple[int, int, int]] = []
    at = 0
    while found := first.search(text, at):
        stop = found.end() + reach
        stop = len(text) if stop >= len(text) else max(text.rfind(" ", found.end(), stop + 1), found.end())
        out += [m for m in _best(best, text, found.start() - 1, stop) if m[0] < found.end()]
        at = out[-1][1]
    return out


def scan(docs: DataFrame, text_column: str = "text", notices=NOTICES) -> DataFrame:
    """``[_row, n_words, n_base, first_word, last_word, spans, score]`` for every row.

    ``spans`` holds fixed phrases (``base``) and notices in order. ``score`` is one minus the share of edited characters in the best
    match: 1 for a phrase or an unchanged notice, 0 without any.
    """
    rows, place, row_kind = carried(docs, text_column)
    kind = pa.list_(pa.struct([("label", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("edits", pa.int32()), ("base", pa.bool_())]))

    def scanned(part: pa.RecordBatch, held: Notices) -> pa.RecordBatch:
        words = Words(text_in(part, place))
        n = len(words.starts)
        spans: list[list[dict]] = [[] for _ in range(n)]
        score = np.zeros(n)
        base: list[list[int]] = [[] for _ in range(n)]

        def add(begin: int, end: int, label: str, edits: int, is_base: bool, length: int) -> int:
            text = words.text_of(begin)
            b, e = words.code_points(text, begin, end)
            spans[text].append({"label": label, "begin": b, "end": e, "edits": edits, "base": is_base})
            score[text] = max(score[text], 1.0 - edits / length)
            return text

        for begin, end, number in phrase_places(words):
            text = add(begin, end, PHRASES[number][1], 0, True, end - begin)
            base[text].append(int(np.searchsorted(words.words, begin) - words.word_at[text]))
        for number, (notice, label, _, _) in enumerate(held.notices):
            for low, high in held.windows(words, number):
                for begin, end, edits in held.matches(number, words.bytes[low:high]):
                    add(low + begin, low + end, label, edits, False, len(notice))
        for found in spans:
            found.sort(key=lambda s: (s["begin"], s["end"], not s["base"], s["label"]))
        columns = [
            part.column("_row"),
            pa.array(np.diff(words.word_at), pa.int64()),
            pa.array([len(p) for p in base], pa.int64()),
            pa.array([min(p, default=None) for p in base], pa.int64()),
            pa.array([max(p, default=None) for p in base], pa.int64()),
            pa.array(spans, kind),
            pa.array(score),
        ]
        return pa.RecordBatch.from_arrays(columns, ["_row", "n_words", "n_base", "first_word", "last_word", "spans", "score"])

    def run(batches):
        held = Notices(notices)
        for batch in batches:
            for part in slices(batch, place):
                yield scanned(part, held)

    return rows.mapInArrow(run, f"_row {row_kind}, n_words long, n_base long, first_word long, last_word long, spans {SPAN}, score double")
