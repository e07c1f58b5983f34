"""Word pieces of whole Arrow columns: where they begin, and how pairs of symbols merge in them.

The pieces are those of ``bpe.SPLIT_PATTERN``, found for a slice of texts at once from the kinds of neighbouring characters. The
pattern takes runs of letters, numbers or other characters, with one space before them; of white space before them all but the last
character; at the end all of it; and a few endings after an apostrophe that begins a piece.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# bytes of text that are looked at together
SLICE = 1 << 21
# --- fixed values: kinds of characters, white space, and endings of the split pattern -------------------
LETTER, NUMBER, SPACE, OTHER = range(4)
WHITE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
# --------------------------------------------------------------------------------------------------------
LAST_LETTER = 0x40000  # planes from here on have neither letters nor numbers
_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    if not _KINDS:
        table = np.full(0x110000, OTHER, np.uint8)
        table[:LAST_LETTER] = [{"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(i))[0], OTHER) for i in range(LAST_LETTER)]
        table[WHITE] = SPACE
        _KINDS.append(table)
    return _KINDS[0]


def buffers(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """Bytes of all values end to end and the offsets of each; null is empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    size = int(at[-1] - at[0])
    return data.slice(int(at[0]), size).to_pybytes() if size else b"", at - at[0]


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[pa.Array]:
    """Parts of a column whose texts stay near ``limit`` bytes; one longer text comes alone."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64))
    start = 0
    while start < len(column):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield column.slice(start, stop - start)
        start = stop


def _marked(data: bytes, at: np.ndarray, marks: Sequence[bytes]) -> np.ndarray:
    """``[begin, end]`` of every place where a reserved token stands inside one text."""
    found = []
    for mark in marks:
        place = data.find(mark)
        while place >= 0:
            found.append((place, place + len(mark)))
            place = data.find(mark, place + 1)
    spans = np.array(found, np.int64).reshape(-1, 2)
    return spans[np.searchsorted(at, spans[:, 0], "right") == np.searchsorted(at, spans[:, 1] - 1, "right")]


def piece_starts(points: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Whether a piece begins at a code point; nothing reaches across a point that is ``fresh``."""
    kind = _kinds()[points]
    starts = fresh.copy()
    starts[1:] |= kind[1:] != kind[:-1]
    # the last white space before something else stands alone, a space joins what follows
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~fresh[1:])
    starts[last] = True
    starts[last[points[last] == 0x20] + 1] = False
    quotes = np.flatnonzero((points[:-1] == 0x27) & starts[:-1] & (kind[1:] == LETTER) & ~fresh[1:])
    one = points[quotes + 1]
    after = np.minimum(quotes + 2, len(points) - 1)
    two = np.where((after == quotes + 2) & ~fresh[after], points[after], 0)
    for ending in ENDINGS:
        hit = (one == ord(ending[0])) & ((len(ending) == 1) | (two == ord(ending[-1])))
        ends = quotes[hit] + 1 + len(ending)
        starts[quotes[hit] + 1] = False
        starts[ends[ends < len(points)]] = True
    return starts


def split(column: pa.Array, lines: bool = False, marks: Sequence[bytes] = ()) -> tuple[pa.Array, np.ndarray]:
    """All pieces of a column as one BINARY array, and where those of each text begin in it.

    ``lines`` splits every line by itself, the newline kept; places equal to one of ``marks`` are pieces of their own.
    """
    data, at = buffers(column)
    try:
        text = data.decode()
    except UnicodeDecodeError:  # as the JVM reads it
        texts = [data[a:b].decode(errors="replace").encode() for a, b in zip(at, at[1:])]
        data, at = b"".join(texts), np.cumsum([0, *map(len, texts)])
        text = data.decode()
    if not data:
        return pa.array([], pa.binary()), np.zeros(len(at), np.int64)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    raw = np.frombuffer(data, np.uint8)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    fresh = np.zeros(len(points), bool)
    fresh[np.searchsorted(lead, at[at < len(data)])] = True
    if lines:
        fresh[1:] |= points[:-1] == 0x0A
    spans = np.searchsorted(lead, _marked(data, at, marks))
    fresh[spans[spans < len(points)]] = True
    starts = piece_starts(points, fresh)
    for begin, end in spans:
        starts[begin + 1 : end] = fresh[begin + 1 : end]
    begins = lead[starts]
    offsets = pa.array(np.append(begins, len(data)).astype(np.int32))
    pieces = pa.Array.from_buffers(pa.binary(), len(begins), [None, offsets.buffers()[1], pa.py_buffer(data)])
    return pieces, np.searchsorted(begins, at)


# --- symbols of words: values end to end, and the offsets of each word -----------------------------------
def every_other(places: np.ndarray) -> np.ndarray:
    """Of hits that overlap, as in a run of one symbol, those that a pass from the left replaces."""
    fresh = np.ones(len(places), bool)
    fresh[1:] = places[1:] != places[:-1] + 1
    order = np.arange(len(places))
    return places[(order - order[fresh][np.cumsum(fresh) - 1]) % 2 == 0]


def inside(at: np.ndarray) -> np.ndarray:
    """Whether a symbol and the next are in one word."""
    out = np.ones(int(at[-1]), bool)
    out[at[1:][at[1:] > 0] - 1] = False
    return out[:-1]


def replaced(ids: np.ndarray, at: np.ndarray, places: np.ndarray, new: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs at ``places`` as one symbol each."""
    ids, keep = ids.copy(), np.ones(len(ids), bool)
    ids[places], keep[places + 1] = new, False
    return ids[keep], np.concatenate([[0], np.cumsum(keep)])[at]


def merge_one(ids: np.ndarray, at: np.ndarray, left: int, right: int, new: int) -> tuple[np.ndarray, np.ndarray]:
    places = np.flatnonzero((ids[:-1] == left) & (ids[1:] == right) & inside(at))
    return replaced(ids, at, every_other(places), new) if len(places) else (ids, at)


class Rules:
    """Merges as ``(left, right, new)`` in order of rank; of equal pairs the first counts."""

    def __init__(self, rules: Sequence[tuple[int, int, int]]) -> None:
        table = np.array(rules, np.int64).reshape(-1, 3)
        self.size = int(table.max(initial=255)) + 1
        self.codes, self.ranks = np.unique(table[:, 0] * self.size + table[:, 1], return_index=True)
        self.new = table[:, 2]

    def rank(self, codes: np.ndarray) -> np.ndarray:
        """Rank of each pair, the number of rules where there is none."""
        if not len(self.codes):
            return np.zeros(len(codes), np.int64)
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[place] == codes, self.ranks[place], len(self.new))

    def merge(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All words merged: in each its first-ranked pair, everywhere, until it has none; words that have none leave the loop."""
        none, sizes = len(self.new), np.diff(at)
        word = np.flatnonzero(sizes)
        ids, at = ids.astype(np.int64), np.append(at[:-1][word], len(ids))
        values, owners = [ids[:0]], [word[:0]]
        while len(ids):
            ranks = np.full(len(ids), none)
            near = np.flatnonzero(inside(at))
            ranks[near] = self.rank(ids[near] * self.size + ids[near + 1])
            best, lengths = np.minimum.reduceat(ranks, at[:-1]), np.diff(at)
            over, wide = best == none, np.repeat(best, lengths)
            sizes[word[over]] = lengths[over]
            values.append(ids[wide == none])
            owners.append(np.repeat(word[over], lengths[over]))
            ids, ranks, wide = (x[wide != none] for x in (ids, ranks, wide))
            word, at = word[~over], np.concatenate([[0], np.cumsum(lengths[~over])])
            places = every_other(np.flatnonzero(ranks == wide))
            ids, at = replaced(ids, at, places, self.new[ranks[places]])
        order = np.argsort(np.concatenate(owners), kind="stable")
        return np.concatenate(values)[order], np.concatenate([[0], np.cumsum(sizes)])


def gathered(values: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists with these row numbers, end to end, and the offsets of each."""
    lengths = np.diff(at)[rows]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return values[np.repeat(at[:-1][rows] - ends[:-1], lengths) + np.arange(ends[-1])], ends
