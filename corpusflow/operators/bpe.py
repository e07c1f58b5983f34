"""Byte-level pair merges: learn from a word-count table, encode, decode.

Words are found, counted and merged inside tasks, a batch at a time as arrays of token ids (``functions/pieces``); a pair is one
number that sorts like its two ids, which makes the tie rule (count, then smaller left id, then smaller right id) a plain sort.
Column functions hold a word as a string with one character per token.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pieces as px
from ..functions import text as tx
from ..plans.storage import cut_lineage

# --- fixed values: reserved tokens and the published byte-level split pattern ---
SPECIALS = ("<s>", "</s>", "<pad>", "<unk>", "<mask>")
SPLIT_PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# -------------------------------------------------------------------------------
TOP_PAIRS = 128
CUT_EVERY = 8
# pairs of ids below the root of this are added up in a table, others by sorting a batch
TABLE_CELLS = 1 << 20


def _byte_order() -> list[int]:
    """Bytes in vocabulary order: printable ones first, each group ascending."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return printable + [b for b in range(256) if b not in set(printable)]


def _symbol(token: int) -> str:
    """The character that stands for a token id; surrogate code points are skipped."""
    point = 0x100 + token
    return chr(point if point < 0xD800 else point + 0x800)


def _token(symbol: str) -> int:
    point = ord(symbol)
    return (point if point < 0xD800 else point - 0x800) - 0x100


def byte_symbols(col: Column | str, n_special: int = len(SPECIALS)) -> Column:
    """Text as one symbol per UTF-8 byte."""
    order = _byte_order()
    source = "".join(chr(b) for b in order)
    target = "".join(_symbol(n_special + i) for i in range(256))
    return F.translate(tx.latin_bytes(col), source, target)


def pretokens(text: Column | str, pattern: str = SPLIT_PATTERN) -> Column:
    """Word pieces of a text, white space kept with the word that follows."""
    return F.regexp_extract_all(tx.as_col(text), F.lit(pattern), F.lit(0))


def pretoken_counts(df: DataFrame, text: str = "text", pattern: str = SPLIT_PATTERN) -> DataFrame:
    """``[word, n]``: the corpus as a distinct-word table. Lines are split separately, newline kept."""
    if pattern == SPLIT_PATTERN:
        return _task_counts(df, text).groupBy("word").agg(F.sum("n").alias("n"))
    lines = F.split(F.col(text), r"(?<=\n)")
    pieces = F.flatten(F.transform(lines, lambda line: pretokens(line, pattern)))
    return df.select(F.explode(pieces).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _task_counts(df: DataFrame, text: str) -> DataFrame:
    """``[word, n]`` for each slice of texts: equal pieces are counted before they become rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in px.slices(batch.column(0)):
                words, _ = px.split(part, lines=True)
                if len(words):
                    codes = words.dictionary_encode()
                    n = np.bincount(codes.indices.to_numpy(), minlength=len(codes.dictionary))
                    yield pa.RecordBatch.from_arrays([codes.dictionary.cast(pa.string()), pa.array(n.astype(np.int64))], ["word", "n"])

    return df.select(F.col(text).cast("string")).mapInArrow(run, "word string, n long")


def _id_of_byte(n_special: int) -> np.ndarray:
    out = np.empty(256, np.int64)
    out[_byte_order()] = np.arange(n_special, n_special + 256)
    return out


def adjacent_pairs(symbols: Column | str) -> Column:
    """All overlapping two-character pieces."""
    return F.regexp_extract_all(tx.as_col(symbols), F.lit("(?s)(?=(..))"), F.lit(1))


def pair_counts(words: DataFrame) -> DataFrame:
    """``[pair, c]`` from ``[w, n]``."""
    return words.select("n", F.explode(adjacent_pairs("w")).alias("pair")).groupBy("pair").agg(F.sum("n").alias("c"))


def top_pairs(words: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent adjacent pairs, ties by smaller ids."""
    return pair_counts(words).orderBy(F.desc("c"), "pair").limit(k)


def _safe_run(top: Sequence[tuple[str, int]], min_frequency: int, complete: bool) -> list[str]:
    """The longest prefix of ``top`` that merging one by one would also pick, in that order.

    Merging (a, b) only creates pairs (x, ab) and (ab, y), at most as frequent as (x, a) and (b, y) are
    now. The next pair is certain while its count exceeds all of those for every pair already
    taken. Counts below the list's last one are not known, so a tie with it stops the run.
    """
    if not top or top[0][1] < min_frequency:
        return []
    run, bound = [], 0
    for i, (pair, count) in enumerate(top):
        if i and (count <= bound or count < min_frequency or (not complete and count == top[-1][1])):
            break
        run.append(pair)
        left, right = pair
        touching = [c for p, c in top if (p[1] == left or p[0] == right) and (p != pair or left == right)]
        unseen = 0 if complete else top[-1][1]
        bound = max(bound, unseen, *touching) if touching else max(bound, unseen)
    return run


def _in_ids(words: DataFrame, n_special: int, kind: type) -> DataFrame:
    """``[w, n]``: ids of the bytes of every word of two bytes or more, as one BINARY value of ``kind``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _id_of_byte(n_special)
        for batch in batches:
            data, at = px.buffers(batch.column(0))
            yield _packed(table[np.frombuffer(data, np.uint8)], at, batch.column(1), kind)

    return words.select("word", "n").mapInArrow(run, "w binary, n long")


def _packed(ids: np.ndarray, at: np.ndarray, n: pa.Array, kind: type) -> pa.RecordBatch:
    """Words as rows again; those of one symbol have no pairs left and go."""
    offsets = pa.array((at * np.dtype(kind).itemsize).astype(np.int32))
    w = pa.Array.from_buffers(pa.binary(), len(n), [None, offsets.buffers()[1], pa.py_buffer(ids.astype(kind).tobytes())])
    return pa.RecordBatch.from_arrays([w, n], ["w", "n"]).filter(pa.array(np.diff(at) > 1))


def _replayed(batch: pa.RecordBatch, merges: Sequence[tuple[int, int, int]], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words of a batch after some more merges, and the offsets of each word."""
    data, at = px.buffers(batch.column(0))
    ids, at = np.frombuffer(data, kind).astype(np.int64), at // np.dtype(kind).itemsize
    for left, right, new in merges:
        ids, at = px.merge_one(ids, at, left, right, new)
    return ids, at


def _merged(words: DataFrame, merges: Sequence[tuple[int, int, int]], kind: type) -> DataFrame:
    merges = list(merges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _packed(*_replayed(batch, merges, kind), batch.column(1), kind)

    return words.mapInArrow(run, "w binary, n long")


def _top_codes(words: DataFrame, merges: Sequence[tuple[int, int, int]], kind: type, size: int, k: int) -> DataFrame:
    """``[code, c]`` of the ``k`` most frequent pairs after ``merges``; ``code`` is ``left * size + right``, ties by smaller codes."""
    merges = list(merges)

    def rows(codes: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(sums.astype(np.int64))], ["code", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size * size, np.int64) if size * size <= TABLE_CELLS else None
        for batch in batches:
            ids, at = _replayed(batch, merges, kind)
            if not len(ids):
                continue
            near = np.flatnonzero(px.inside(at))
            codes = ids[near] * size + ids[near + 1]
            weights = np.repeat(np.asarray(batch.column(1)), np.diff(at))[near]
            if table is not None:
                table += np.bincount(codes, weights, size * size).astype(np.int64)
            elif len(codes):
                found, place = np.unique(codes, return_inverse=True)
                yield rows(found, np.bincount(place, weights))
        if table is not None:
            seen = np.flatnonzero(table)
            yield rows(seen, table[seen])

    counts = words.mapInArrow(run, "code long, c long").groupBy("code").agg(F.sum("c").alias("c"))
    return counts.orderBy(F.desc("c"), "code").limit(k)


def train_bpe(
    df: DataFrame,
    vocab_size: int,
    text: str = "text",
    min_frequency: int = 2,
    specials: Sequence[str] = SPECIALS,
    pattern: str = SPLIT_PATTERN,
) -> tuple[DataFrame, DataFrame]:
    """Learn merges up to ``vocab_size``: ``(vocab, merges)`` tables.

    The corpus is read once, into distinct words. Each round counts pairs of that table and brings
    back at most ``TOP_PAIRS`` rows; every merge that is certain from them is applied in one
    go, so the result equals merging one pair at a time with fewer jobs.
    """
    spark = df.sparkSession
    kind = np.uint16 if vocab_size < 1 << 16 else np.uint32
    # every core gets an equal share: the rounds below are bound by work per word, not by bytes
    words = _in_ids(pretoken_counts(df, text, pattern), len(specials), kind)
    words = cut_lineage(words.repartition(spark.sparkContext.defaultParallelism, "w"))
    tokens: list[bytes] = [s.encode() for s in specials] + [bytes([b]) for b in _byte_order()]
    known = {value: i for i, value in enumerate(tokens) if i >= len(specials)}
    merges: list[tuple[int, int, int, int]] = []
    pending: list[tuple[int, int, int]] = []
    while len(tokens) < vocab_size:
        size = len(tokens)
        rows = _top_codes(words, pending, kind, size, TOP_PAIRS).collect()  # at most TOP_PAIRS rows
        top = [(_symbol(r["code"] // size) + _symbol(r["code"] % size), r["c"]) for r in rows]
        run = _safe_run(top, min_frequency, len(rows) < TOP_PAIRS)
        if not run:
            break
        for pair in run:
            left, right = _token(pair[0]), _token(pair[1])
            value = tokens[left] + tokens[right]
            new = known.get(value)
            reused = new is not None
            if not reused:
                new = known[value] = len(tokens)
                tokens.append(value)
            merges.append((len(merges), left, right, new))
            pending.append((left, right, new))
            # merging into an existing token adds to counts the run's bound did not cover
            if reused or len(tokens) >= vocab_size:
                break
        if len(pending) >= CUT_EVERY:
            words, pending = cut_lineage(_merged(words, pending, kind)), []
    vocab = spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(tokens)], "id int, bytes binary")
    table = spark.createDataFrame(merges, "rank int, left int, right int, new_id int")
    return vocab, table


def _split_specials(text: Column, specials: Sequence[str]) -> Column:
    marks = "|".join(s.replace("|", r"\|") for s in specials)
    return F.split(text, f"(?={marks})|(?<={marks})")


def bpe_pieces(text: Column | str, specials: Sequence[str] = SPECIALS, pattern: str = SPLIT_PATTERN) -> Column:
    """Word pieces as symbol strings; a reserved token is a piece of its own one-symbol name."""
    special_ids = {s: _symbol(i) for i, s in enumerate(specials)}

    def piece(segment: Column) -> Column:
        plain = F.transform(pretokens(segment, pattern), lambda w: byte_symbols(w, len(specials)))
        out = plain
        for name, symbol in special_ids.items():
            out = F.when(segment == name, F.array(F.lit(symbol))).otherwise(out)
        return out

    return F.flatten(F.transform(_split_specials(tx.as_col(text), specials), piece))


def bpe_encoder(merges: DataFrame, specials: Sequence[str] = SPECIALS) -> Callable[[Column | str], Column]:
    """Text to token ids as a column function, for every operator that takes ``encode=``.

    A slice of texts is split at once, its distinct pieces (those of ``bpe_pieces``) are merged together. The merge list has at most
    ``vocab_size`` rows and goes to the tasks with the function. No row moves, so hot words cost nothing.
    """
    rules = [(r["left"], r["right"], r["new_id"]) for r in merges.orderBy("rank").collect()]  # at most vocab_size rows
    marks = [s.encode() for s in specials]

    def ids_of(texts: pa.Array, table: px.Rules) -> pa.Array:
        words, at = px.split(texts, marks=marks)
        codes = words.dictionary_encode()
        data, begins = px.buffers(codes.dictionary)
        ids, keep = _id_of_byte(len(marks))[np.frombuffer(data, np.uint8)], np.ones(len(data), bool)
        for i, mark in enumerate(marks):
            if (place := codes.dictionary.index(mark).as_py()) >= 0:  # one id, and no bytes to merge
                keep[begins[place] + 1 : begins[place + 1]] = False
                ids[begins[place]] = i
        ids, begins = table.merge(ids[keep], np.concatenate([[0], np.cumsum(keep)])[begins])
        ids, ends = px.gathered(ids, begins, codes.indices.to_numpy())
        return pa.ListArray.from_arrays(pa.array(ends[at].astype(np.int32)), pa.array(ids, pa.int32()), mask=texts.is_null())

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = px.Rules(rules)
        for batch in batches:
            parts = [ids_of(part, table) for part in px.slices(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return lambda text: encode(tx.as_col(text))


def bpe_encode(df: DataFrame, merges: DataFrame, text: str = "text", out: str = "ids", specials: Sequence[str] = SPECIALS) -> DataFrame:
    """Token ids of each text."""
    return df.withColumn(out, bpe_encoder(merges, specials)(text))


def bpe_decode(df: DataFrame, vocab: DataFrame, ids: str = "ids", out: str = "text", skip: int = len(SPECIALS)) -> DataFrame:
    """Text of each id array, reserved tokens left out, broken UTF-8 shown as U+FFFD.

    The vocabulary (at most ``vocab_size`` rows) becomes one constant array indexed by id.
    """
    latin = F.decode("bytes", "ISO-8859-1")
    entries = vocab.agg(F.array_sort(F.collect_list(F.struct("id", latin.alias("s")))).alias("v"))
    names = entries.select(F.transform("v", lambda e: e["s"]).alias("v")).scalar()
    parts = F.transform(F.filter(ids, lambda i: i >= skip), lambda i: F.get("_names", i))
    return df.withColumn("_names", names).withColumn(out, tx.bytes_to_text(F.array_join(parts, ""), "�")).drop("_names")
