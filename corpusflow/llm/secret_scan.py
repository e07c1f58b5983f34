"""Secret scanning: fixed patterns, and strings that a character Markov model calls random.

Three patterns give the base spans (assigned values, access keys, hex runs). What they leave of every run of key characters is scored by
two first-order Markov models, one of random strings and one of ordinary identifiers. A segment of a run whose log-likelihood
ratios add up to ``LEAST`` nats is a span of kind ``random``, carried on to the next of ``JOINS`` or the end of the run; what is
ordinary around it does not dilute it, no length is asked for, and those joining characters never speak for chance. A sum that falls ``LEAST`` below its peak ends a segment.

In both models a transition is of no known kind with a chance of ``FLOOR``, so that one unseen pair of characters decides nothing.

Both models are trained on labelled samples of at most ``FIT_DOCS`` documents (smallest hash of the id): values of base spans and
digests of ids are random, runs of key characters outside base spans are ordinary.

Edge cases: null and empty texts have no spans. Offsets are code points, ends exclusive. Of equal starts the kinds come in the
order of ``KINDS``. Without documents to learn from, the models are equal and add nothing. Repeated rows get equal spans;
an empty table gives an empty result. The input row travels as a struct, so names cannot clash.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import cut_lineage
from .common import carried, slices, text_in

KINDS = ("assign", "access", "hex", "random")
LEAST = 14.0  # an ordinary character starts such a segment with a chance of e**-14 at most
FLOOR = 0.1
BREAK = -1e4
FIT_DOCS = 4_000
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
JOINS = "/+_=-"
SPAN = "array<struct<kind:string,begin:int,end:int>>"

# Fixed patterns of the base spans.
_NAMES = re.compile(r"password|passwd|secret|token|api_?key")
_ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_MARKS = ("passw", "secret", "token", "apikey", "api_key")
_LOWER = {c: c + 32 for c in range(65, 91)}
_KEY = r"[A-Za-z0-9+/_=-]"
_SAMPLES = re.compile(rf"(?<!{_KEY}){_KEY}{{2,}}")
_CODE = np.full(129, -1, np.int64)  # the last stands for all that is not ASCII
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def _assigned(text: str) -> list[tuple[int, int, int, int]]:
    """``(begin, end, value begin, value end)`` of assignments, leftmost first, short values dropped after matching."""
    low = text.translate(_LOWER) if not text.isascii() else text.lower()
    if not any(mark in low for mark in _MARKS):
        return []
    out, at = [], 0
    while name := _NAMES.search(low, at):
        found = _ASSIGN.match(text, name.start())
        if found and len(found[2]) >= 8:
            out.append((*found.span(), *found.span(2)))
        # another name may begin inside one that assigns nothing
        at = found.end() if found else name.start() + 1
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(begin, kind number, end)`` in order."""
    spans = [(b, 0, e) for b, e, _, _ in _assigned(text)]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def _transitions(text: str) -> np.ndarray:
    codes = _CODE[np.frombuffer(text.encode("ascii"), np.uint8)]
    return codes[:-1] * len(ALPHABET) + codes[1:]


def _free(begin: int, end: int, spans: list[tuple[int, int, int]]) -> bool:
    return all(end <= b or begin >= e for b, _, e in spans)


def _split(pattern: re.Pattern, text: str, spans: list) -> list[tuple[int, int]]:
    """Matches that overlap no base span."""
    return [m.span() for m in pattern.finditer(text) if not spans or _free(*m.span(), spans)]


def _codes(text: str, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Number of every key character outside base spans, -1 elsewhere; one more -1 at the end."""
    if text.isascii():
        found = _CODE[np.frombuffer(text.encode("ascii"), np.uint8)]
    else:
        found = _CODE[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 128)]
    for b, _, e in spans:
        found[b:e] = -1
    return np.append(found, -1)


def _segments(gains: list[float]) -> list[tuple[int, int]]:
    """First and last character of the segments of a run that add up to ``LEAST``; ``gains[i]`` joins characters i and i + 1."""
    out = []
    at = start = end = 0
    total = top = 0.0
    while True:
        done = at == len(gains)
        if not done:
            total += gains[at]
            at += 1
            if total > top:
                top, end = total, at
        if done or total <= 0 or top - total >= LEAST:
            if top >= LEAST:
                out.append((start, end))
                at = end
            elif done:
                return out
            start = end = at
            total = top = 0.0


def random_spans(text: str, spans: list[tuple[int, int, int]], ratios: np.ndarray) -> list[tuple[int, int]]:
    """``(begin, end)`` of random segments outside base spans; ``ratios`` has a row and a column of ``BREAK`` for other characters."""
    codes = _codes(text, spans)
    gains = ratios[codes[:-1], codes[1:]]
    sums = np.cumsum(gains)
    excess = sums - np.minimum(np.minimum.accumulate(sums), 0.0)
    hits = np.flatnonzero(excess >= LEAST - 1e-3)  # at least those of every run; a run is then scored by itself
    out: list[tuple[int, int]] = []
    if not len(hits):
        return out
    stops = np.flatnonzero(codes < 0)
    for k in np.unique(np.searchsorted(stops, hits)):
        begin, end = int(stops[k - 1]) + 1 if k else 0, int(stops[k])
        for first, last in _segments(gains[begin : end - 1].tolist()):
            b, e = begin + first, begin + last + 1
            while b > begin and text[b - 1] not in JOINS:
                b -= 1
            while e < end and text[e] not in JOINS:
                e += 1
            if out and b < out[-1][1]:
                out[-1] = (out[-1][0], max(e, out[-1][1]))
            else:
                out.append((b, e))
    return out


def samples(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rows: int = FIT_DOCS) -> DataFrame:
    """``[label, text]``: label 1 for random strings, 0 for ordinary ones, from at most ``rows`` documents."""
    chosen = docs.select(F.col(id_column).alias("_id")).orderBy(F.xxhash64("_id"), "_id").limit(rows).distinct()
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))
    digest = F.sha2(F.coalesce(F.col("_id").cast("string"), F.lit("")), 256)
    held = texts.join(F.broadcast(chosen), "_id").withColumns({"_hex": digest, "_b64": F.base64(F.unhex(digest))})

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text"):
                labels, out = [], []
                for text, *digests in zip(*(part.column(c).to_pylist() for c in ("_text", "_hex", "_b64"))):
                    text = text or ""
                    spans = base_spans(text)
                    values = [text[b:e] for _, _, b, e in _assigned(text)] + [text[b:e] for b, k, e in spans if k]
                    random = [*digests, *(re.sub(rf"[^{_KEY[1:]}", "", v) for v in values)]
                    plain = [text[b:e] for b, e in _split(_SAMPLES, text, spans)]
                    out += [x for x in random + plain if len(x) > 1]
                    labels += [1] * sum(len(x) > 1 for x in random) + [0] * len(plain)
                yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(out, pa.string())], ["label", "text"])

    return held.select("_text", "_hex", "_b64").mapInArrow(run, "label int, text string")


def fit(labelled: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of every transition; counts are summed by Spark into 2 * 67 * 67 cells."""

    def count(batches):
        cells = np.zeros((2, len(ALPHABET) ** 2), np.int64)
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                np.add.at(cells[label], _transitions(text), 1)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(cells.reshape(-1)[at])], ["cell", "n"])

    found = labelled.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    size = len(ALPHABET)
    counts = np.zeros(2 * size * size)
    counts[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    counts = counts.reshape(2, size, size) + 1.0
    logs = np.log((1 - FLOOR) * counts / counts.sum(axis=2, keepdims=True) + FLOOR / size)
    return (logs[1] - logs[0]).reshape(-1)


def scan(docs: DataFrame, ratios: np.ndarray, text_column: str = "text") -> DataFrame:
    """``[_row, spans]`` for every row: base spans and those the models add, in order."""
    rows, place, row_kind = carried(docs, text_column)
    size = len(ALPHABET)
    table = np.full((size + 1, size + 1), BREAK)
    table[:size, :size] = ratios.reshape(size, size)
    joins = [ALPHABET.index(c) for c in JOINS]
    table[joins], table[:, joins] = np.minimum(table[joins], 0), np.minimum(table[:, joins], 0)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("end", pa.int32())]))

    def spans_of(text: str) -> list[dict]:
        spans = base_spans(text)
        added = [(b, 3, e) for b, e in random_spans(text, spans, table)]
        return [{"kind": KINDS[k], "begin": b, "end": e} for b, k, e in sorted(spans + added)]

    def run(batches):
        for batch in batches:
            for part in slices(batch, place):
                found = [spans_of(t or "") for t in text_in(part, place).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(found, kind)], ["_row", "spans"])

    return rows.mapInArrow(run, f"_row {row_kind}, spans {SPAN}")


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> np.ndarray:
    return fit(cut_lineage(samples(docs, id_column, text_column)))
